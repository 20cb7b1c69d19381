"""Information-theoretic sanitisation of personal data.

Personal data of fixed shape (email, ip, card, phone) are the protected
entities. The ``NEAR`` words before and after them, on the same line, are
suspects; words inside base spans do not count: corpus counts tell how strongly a term reveals an entity,

    disclosure(c, t) = PMI(c, t) / IC(c) = log(p(c|t) / p(c)) / -log p(c),

with p(c|t) the share of all occurrences of t in the corpus that stand near c,
and p(c) the share of all words that do. 1 means that t occurs near c alone.
Terms that stand near one entity at least ``SUPPORT`` times are removed there
when the disclosure reaches ``REMOVE``, and generalised to their shape when it
reaches ``GENERALISE``. Only DataFrame functions are used.

Counts cover every word of every text; words are counted inside their task
before anything moves, so a frequent word is one row per task. Contexts are
bounded by ``NEAR``, so no two terms or entities of a line are paired. They are
written once. An entity or a term that stands in a large share of all texts is
looked up with its hot rows spread, so no task gets all its rows.

Defined cases: a null text is empty and has no spans. Rows that repeat a
``doc_id`` are told apart by their text; rows equal in both have equal spans.
Terms inside base spans are no suspects. Empty tables give empty tables.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallgrass.llm.common import stored
from tallgrass.operators.skew import lookup_join, lookup_used

NEAR = 8
SUPPORT = 2
GENERALISE = 0.75
REMOVE = 0.9
_LOWEST = -(1 << 63)
_WORD = r"[\p{L}\p{N}]{2,}+"
_SPAN = "struct<start:int,kind:int,end:int,value:string>"


class Kind(NamedTuple):
    name: str
    #: The stated pattern, with possessive loops where nothing could be given back, and
    #: started only where a run of its first characters starts: the same matches, without
    #: deep recursion or quadratic time on long runs.
    pattern: str
    #: What a text with a valid match certainly contains.
    guard: str


KINDS = (
    Kind("email", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@"),
    Kind("ip", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", r"[0-9]\.[0-9]"),
    Kind("card", r"[0-9](?:[\x20-]?[0-9])++", r"[0-9](?:[\x20-]?[0-9]){11}"),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", "+"),
)
TERM = len(KINDS)
NAMES = (*(k.name for k in KINDS), "term")


def _name(kind: Column) -> Column:
    return F.element_at(F.array(*[F.lit(n) for n in NAMES]), kind + 1)


def _valid(kind: int, value: Column) -> Column:
    if kind == 0:
        return F.lit(True)
    if kind == 1:
        small = r"^0*(?:25[0-5]|2[0-4][0-9]|[01]?[0-9]{1,2})$"
        return F.forall(F.split(value, r"\."), lambda part: part.rlike(small))
    digits = F.regexp_replace(value, "[^0-9]", "")
    if kind == 3:
        return F.length(digits).between(9, 15)
    # Luhn: from the right, every second digit counts double, less nine above nine.
    length = F.length(digits)

    def part(total, i):
        digit = F.substring(digits, length - i, 1).cast("int")
        twice = digit * 2 - F.when(digit > 4, 9).otherwise(0)
        return total + F.when(i % 2 == 1, twice).otherwise(digit)

    total = F.aggregate(F.sequence(F.lit(0), length - 1), F.lit(0), part)
    return F.when(length.between(12, 19), total % 10 == 0).otherwise(False)


def _found(text: Column, kind: int) -> Column:
    """Valid spans of a kind: the pieces between matches and the matches give the positions, in code points."""
    pattern = KINDS[kind].pattern
    gaps, hits = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))

    def step(state, pair):
        start = state["at"] + F.length(pair["gap"])
        end = start + F.length(pair["hit"])
        span = F.struct(start.alias("start"), F.lit(kind).alias("kind"), end.alias("end"), pair["hit"].alias("value"))
        return F.struct(end.alias("at"), F.when(pair["hit"].isNull(), state["spans"]).otherwise(F.concat(state["spans"], F.array(span))).alias("spans"))

    nothing = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{_SPAN}>").alias("spans"))
    spans = F.aggregate(F.arrays_zip(gaps.alias("gap"), hits.alias("hit")), nothing, step, lambda s: s["spans"])
    spans = F.filter(spans, lambda s: _valid(kind, s["value"]))
    guard = KINDS[kind].guard
    may = text.contains(guard) if len(guard) == 1 else text.rlike(guard)
    return F.when(may, spans).otherwise(F.array().cast(f"array<{_SPAN}>"))


def base_spans(text: Column) -> Column:
    """All valid spans of the fixed shapes, by start, then kind."""
    return F.sort_array(F.concat(*[_found(text, k) for k in range(len(KINDS))]))


def _keyed(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(
        "doc_id", F.coalesce("doc_id", F.lit(_LOWEST).cast("long")).alias("_id"),
        F.xxhash64(text).alias("_key"), text.alias("text"), base_spans(text).alias("_base"),
    )


def _contexts(keyed: DataFrame) -> DataFrame:
    """``_id, _key, entity, term, start, end``: each word near an entity, once per entity."""
    lines = F.split("text", "\n")
    # Line starts: one running sum per text.
    starts = F.aggregate(
        lines, F.array(F.lit(0)), lambda at, line: F.concat(at, F.array(F.element_at(at, -1) + F.length(line) + 1))
    )
    placed = F.transform(lines, lambda line, i: F.struct(F.get(starts, i).alias("at"), line.alias("line")))
    rows = (
        keyed.filter(F.size("_base") > 0).dropDuplicates(["_id", "_key"])
        .select("_id", "_key", "_base", F.explode(placed).alias("l"))
        .select("_id", "_key", "l.at", "l.line", F.filter("_base", lambda s: (s["start"] >= F.col("l.at")) & (s["end"] <= F.col("l.at") + F.length("l.line"))).alias("spans"))
        .filter(F.size("spans") > 0)
    )
    gaps, hits = F.split(F.col("line"), _WORD, -1), F.regexp_extract_all("line", F.lit(_WORD), F.lit(0))
    words = rows.select("_id", "_key", "at", F.posexplode(F.arrays_zip(gaps.alias("gap"), hits.alias("hit"))).alias("pos", "p"))
    line = Window.partitionBy("_id", "_key", "at")
    length = F.coalesce(F.length("p.hit"), F.lit(0))
    upto = line.orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    words = words.withColumn("end", (F.col("at") + F.sum(F.length("p.gap") + length).over(upto)).cast("int"))
    words = words.filter("p.hit is not null").select(
        "_id", "_key", "at", (F.col("end") - F.length("p.hit")).alias("start"), "end",
        F.lower("p.hit").alias("term"), F.lit(None).cast("string").alias("entity"),
    )
    spans = rows.select("_id", "_key", "at", F.explode("spans").alias("s")).select(
        "_id", "_key", "at", "s.start", "s.end", F.lit(None).cast("string").alias("term"),
        F.concat_ws(":", _name(F.col("s.kind")), F.lower("s.value")).alias("entity"),
    )
    # A word is outside all spans if those before it, in order of start, end before it and
    # those behind it start behind it.
    is_span = F.col("entity").isNotNull()
    forth = line.orderBy("start", F.col("entity").isNull(), "end", "entity").rowsBetween(Window.unboundedPreceding, 0)
    back = line.orderBy(F.desc("start"), is_span, "end", "entity").rowsBetween(Window.unboundedPreceding, 0)
    reach, onward = F.max(F.when(is_span, F.col("end"))).over(forth), F.min(F.when(is_span, F.col("start"))).over(back)
    outside = (F.coalesce(reach, F.lit(0)) <= F.col("start")) & (F.coalesce(onward, F.col("end")) >= F.col("end"))
    both = words.unionByName(spans).withColumn("_out", F.col("term").isNotNull() & outside)
    both = both.filter("_out or entity is not null")
    # Places count outside words; a span stands behind those that start before it.
    both = both.withColumn("place", F.sum(F.col("_out").cast("int")).over(forth))
    near = F.explode(F.sequence(F.col("place") - (NEAR - 1), F.col("place") + NEAR))
    keys = ["_id", "_key", "at", "place"]
    asked = both.filter("entity is not null").select("_id", "_key", "at", "entity", near.alias("place")).distinct()
    seen = asked.join(both.filter("_out").select(*keys, "term", "start", "end"), keys)
    return seen.select("_id", "_key", "entity", "term", "start", "end")


def disclosures(docs: DataFrame) -> DataFrame:
    """``entity, term, disclosure`` of the terms that stand near an entity at least ``SUPPORT`` times."""
    return _disclosures(docs, stored(_contexts(_keyed(docs)), "contexts")).select("entity", "term", "disclosure")


def _pair() -> Column:
    return F.concat(F.col("entity"), F.lit(" "), F.col("term"))


def _disclosures(docs: DataFrame, contexts: DataFrame) -> DataFrame:
    words = docs.select(F.explode_outer(F.regexp_extract_all(F.lower("text"), F.lit(_WORD), F.lit(0))).alias("term"))
    counts = words.filter("term is not null").groupBy(F.xxhash64("term").alias("_t")).agg(F.count(F.lit(1)).alias("_n"))
    total = counts.agg(F.sum("_n").cast("double").alias("_all")).select("_all", F.lit(1).alias("_one"))
    pairs = contexts.groupBy("entity", "term").agg(F.count(F.lit(1)).alias("_both")).filter(F.col("_both") >= SUPPORT)
    entities = contexts.groupBy("entity").agg(F.count(F.lit(1)).alias("_near"))
    pairs = lookup_join(pairs, entities, "entity", "_near", ["term"]).withColumn("_t", F.xxhash64("term"))
    # Only words of pairs are asked for, so the hottest are those with most pairs.
    found = lookup_used(pairs, counts, "_t", ["entity"])
    found = found.withColumn("_one", F.lit(1)).join(F.broadcast(total), "_one")  # one row
    given = F.least(F.col("_both") / F.col("_n"), F.lit(1.0))
    prior = F.least(F.col("_near") / F.col("_all"), F.lit(0.999999))
    return found.select("entity", "term", "_both", (F.log(given / prior) / -F.log(prior)).alias("disclosure"))


def find(docs: DataFrame) -> DataFrame:
    """``doc_id, text, spans`` per row: spans ``(start, kind, end, value)`` by start and kind.

    Kinds are numbers into ``NAMES``. A term's value is ``removed`` or ``generalised``.
    """
    keyed = _keyed(docs)
    contexts = stored(_contexts(keyed), "contexts")
    strong = stored(_disclosures(docs, contexts).filter(F.col("disclosure") >= GENERALISE), "disclosures")
    strong = strong.select(_pair().alias("_pair"), "disclosure", "_both")
    action = F.when(F.max("disclosure") >= REMOVE, "removed").otherwise("generalised")
    told = lookup_join(contexts.withColumn("_pair", _pair()), strong, "_pair", "_both", ["_id", "_key"]).filter("disclosure is not null")
    terms = told.groupBy("_id", "_key", "start", "end").agg(action.alias("value"))
    added = terms.groupBy("_id", "_key").agg(
        F.collect_list(F.struct("start", F.lit(TERM).alias("kind"), "end", "value")).alias("_terms")
    )
    clear = F.filter(
        F.coalesce("_terms", F.array().cast(f"array<{_SPAN}>")),
        lambda t: ~F.exists("_base", lambda b: (b["start"] < t["end"]) & (t["start"] < b["end"])),
    )
    return keyed.join(added, ["_id", "_key"], "left").select(
        "doc_id", "text", "_base", F.sort_array(F.concat("_base", clear)).alias("spans")
    )


def _joined(spans: str) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", _name(s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def sanitised(docs: DataFrame) -> DataFrame:
    """``doc_id, text`` with base spans as ``[KIND]``, removed terms as ``[TERM]`` and generalised ones as their shape."""

    def step(state, span):
        begin = F.greatest(state["at"], span["start"])
        plain = F.substring(F.col("text"), state["at"] + 1, begin - state["at"])
        word = F.substring(F.col("text"), span["start"] + 1, span["end"] - span["start"])
        shape = F.regexp_replace(F.regexp_replace(word, r"\p{N}+", "0"), r"\p{L}+", "x")
        put = F.when(span["start"] < state["at"], "").when(span["value"] == "generalised", shape)
        put = put.otherwise(F.concat(F.lit("["), F.upper(_name(span["kind"])), F.lit("]")))
        return F.struct(F.greatest(state["at"], span["end"]).alias("at"), F.concat(state["out"], F.array(plain, put)).alias("out"))

    first = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))
    rest = lambda s: F.concat(F.array_join(s["out"], ""), F.substring(F.col("text"), s["at"] + 1, F.length("text")))
    return find(docs).select("doc_id", F.aggregate("spans", first, step, rest).alias("text"))


def digests(docs: DataFrame) -> DataFrame:
    """``doc_id``, counts per kind, ``base_sha256`` and ``spans`` as text."""
    found = find(docs)
    kinds = F.transform("_base", lambda s: s["kind"])
    counts = [(F.size(kinds) - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{kind.name}") for k, kind in enumerate(KINDS)]
    return found.select("doc_id", *counts, F.sha2(_joined("_base"), 256).alias("base_sha256"), _joined("spans").alias("spans"))
