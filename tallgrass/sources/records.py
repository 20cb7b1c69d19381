"""Parsers for line-oriented records. Each takes a DataFrame with a ``value`` column.

Blank and null lines are no records. A line with a missing field, or with a
field that should be a number and is none, raises; with ``on_error="keep"`` it
stays as a row of nulls whose ``bad_line`` column holds the line.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

ON_ERROR = ("raise", "keep")


def _records(lines: DataFrame, fields: dict[str, Column], bad: Column, on_error: str) -> DataFrame:
    """Other columns of ``lines`` and the fields. Every field checks its line, so none can be pruned away."""
    if on_error not in ON_ERROR:
        raise ValueError(f"unknown on_error {on_error!r}: expected one of {ON_ERROR}")
    rows = lines.filter(F.coalesce(F.trim("value"), F.lit("")) != "")
    others = [c for c in lines.columns if c != "value"]
    bad = F.coalesce(bad, F.lit(True))
    if on_error == "keep":
        kept = [F.when(~bad, column).alias(name) for name, column in fields.items()]
        return rows.select(*others, *kept, F.when(bad, F.col("value")).alias("bad_line"))
    refused = F.raise_error(F.concat(F.lit("bad record: "), F.col("value")))
    kinds = rows.select(*[c.alias(n) for n, c in fields.items()]).schema
    checked = [F.when(bad, refused.cast(kinds[n].dataType)).otherwise(c).alias(n) for n, c in fields.items()]
    return rows.select(*others, *checked)


def _numbers(items: Column, kind: str) -> Column:
    return F.transform(items, lambda x: x.try_cast(kind))


def _from(parts: Column, position: int) -> Column:
    return F.slice(parts, position, F.greatest(F.size(parts) - position + 1, F.lit(0)))


def _any_null(items: Column) -> Column:
    return F.exists(items, lambda x: x.isNull())


def parse_adjacency(lines: DataFrame, on_error: str = "raise") -> DataFrame:
    """``id n1 n2 …`` → ``(id long, neighbors array<long>)``; repeated neighbours stay."""
    parts = F.split(F.trim("value"), r"\s+")
    key, neighbors = F.get(parts, 0).try_cast("long"), _numbers(_from(parts, 2), "long")
    return _records(lines, {"id": key, "neighbors": neighbors}, key.isNull() | _any_null(neighbors), on_error)


def parse_instances(lines: DataFrame, on_error: str = "raise") -> DataFrame:
    """``docid label f1 f2 …`` → ``(doc_id string, label string, features array<int>)``."""
    parts = F.split(F.rtrim("value"), " ")
    label, features = F.get(parts, 1), _numbers(_from(parts, 3), "int")
    fields = {"doc_id": F.get(parts, 0), "label": label, "features": features}
    return _records(lines, fields, label.isNull() | _any_null(features), on_error)


def parse_model(lines: DataFrame, model_id: str | Column = "0", on_error: str = "raise") -> DataFrame:
    """``(feature,weight)`` lines → ``(model_id string, feature int, weight double)``."""
    pattern = r"^\((-?\d+),(.+)\)$"
    name = F.lit(model_id) if isinstance(model_id, str) else model_id
    feature = F.regexp_extract("value", pattern, 1).try_cast("int")
    weight = F.regexp_extract("value", pattern, 2).try_cast("double")
    # A name that is a column of the lines is a field, not a column beside it.
    named = lines.select("value", name.alias("model_id"))
    fields = {"feature": feature, "weight": weight}
    return _records(named, fields, feature.isNull() | weight.isNull(), on_error)


def format_model(model: DataFrame) -> DataFrame:
    """The text form of a model, keyed by ``model_id``."""
    value = F.concat(F.lit("("), F.col("feature"), F.lit(","), F.col("weight"), F.lit(")"))
    return model.select("model_id", value.alias("value"))


def parse_trips(lines: DataFrame, on_error: str = "raise") -> DataFrame:
    """CSV trip lines → ``(event_type, x, y)``.

    The record type is field 0. Fixed layout: ``green`` records hold the
    drop-off point in fields 8 and 9, all others in fields 10 and 11.
    """
    parts = F.split("value", ",")
    green = F.get(parts, 0) == "green"
    x = F.when(green, F.get(parts, 8)).otherwise(F.get(parts, 10)).try_cast("double")
    y = F.when(green, F.get(parts, 9)).otherwise(F.get(parts, 11)).try_cast("double")
    return _records(lines, {"event_type": F.get(parts, 0), "x": x, "y": y}, x.isNull() | y.isNull(), on_error)
