"""Logistic-regression text classifier on integer features, with ensembles.

Instances are ``(doc_id, label, features array<int>)``; a model is
``(model_id, feature, weight)``. There is no bias term and a feature that
occurs several times in a document counts every time.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from tallgrass.functions.permute import permuted
from tallgrass.functions.stats import label_to_target, logistic, predicted_label
from tallgrass.functions.tokens import explode_once
from tallgrass.operators.buckets import bucket_session, buckets_for, read_buckets, schema_of, write_buckets
from tallgrass.operators.numbering import numbered
from tallgrass.session import new_run_dir

RATE = 0.002  # fixed value: learning rate
SLOTS = 4096


def in_random_order(instances: DataFrame, seed: int, key: str = "doc_id") -> DataFrame:
    """``instances`` with ``position``, from 0: their place in a random order of all rows.

    Rows are numbered by ``key`` and the numbers permuted, so the order depends on the
    keys and ``seed`` alone, never on partitions or runs.
    """
    found = numbered(instances, [key])
    return found.withColumn("position", permuted(F.col("_index"), F.col("_total"), seed)).drop("_index", "_total")


class Occurrences(NamedTuple):
    """Feature occurrences ``doc_id, target, batch, feature, times`` as they are stored for training, below ``path``.

    ``by_doc`` holds all of them in buckets of the document, ``by_feature`` those of most
    features in buckets of the feature. Occurrences of the features with over 1/``SLOTS``
    of all, which are fewer than ``SLOTS``, are in ``often``, spread over all files.
    """

    path: str
    buckets: int
    any_often: bool
    schema: str


class Stage(NamedTuple):
    """The tables of :class:`Occurrences`, opened once for all steps."""

    session: SparkSession
    buckets: int
    by_doc: DataFrame
    by_feature: DataFrame
    often_features: DataFrame | None
    often: DataFrame | None


def open_stage(spark: SparkSession, stored: Occurrences) -> Stage:
    inner, path = bucket_session(spark, stored.buckets), stored.path
    by_doc = read_buckets(inner, f"{path}/by_doc", "doc_id", stored.buckets, stored.schema)
    by_feature = read_buckets(inner, f"{path}/by_feature", "feature", stored.buckets, stored.schema)
    if not stored.any_often:
        return Stage(inner, stored.buckets, by_doc, by_feature, None, None)
    often = inner.read.parquet(f"{path}/often_features"), inner.read.parquet(f"{path}/often")
    return Stage(inner, stored.buckets, by_doc, by_feature, *often)


def feature_counts(instances: DataFrame, keys: list[str], name: str, pieces: int | None = None) -> DataFrame:
    """``keys``, ``feature`` and, as ``name``, how often the feature occurs in the instances of these keys.

    A feature seldom occurs twice in a document, so tasks count nothing before occurrences
    meet: they would hold all of their input. ``pieces`` is the number of tasks in which they meet.
    """
    found = explode_once(instances, F.col("features"), "feature", keep=keys)
    dealt = found.repartition(pieces, *keys, "feature") if pieces else found
    return dealt.groupBy(*keys, "feature").agg(F.count(F.lit(1)).alias(name))


def store_occurrences(instances: DataFrame, path: str, batch: Column | None = None, pieces: int | None = None) -> Occurrences:
    """Count and store the feature occurrences of every document; the number of buckets follows from their size."""
    spark = instances.sparkSession
    batch = F.lit(0) if batch is None else batch
    bags = instances.select("doc_id", label_to_target(F.col("label")).alias("target"), batch.cast("int").alias("batch"), "features")
    counted = feature_counts(bags, ["doc_id", "target", "batch"], "times", pieces)
    counted.write.mode("overwrite").parquet(f"{path}/occurrences")
    counted = spark.read.parquet(f"{path}/occurrences")
    buckets = buckets_for(counted)
    inner = bucket_session(spark, buckets)
    counted = inner.read.parquet(f"{path}/occurrences")
    seen = Observation()
    often = frequent(counted, "feature").select("feature")
    often.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(f"{path}/often_features")
    stored = Occurrences(path, buckets, seen.get["n"] > 0, schema_of(counted))
    often = F.broadcast(inner.read.parquet(f"{path}/often_features"))
    write_buckets(counted.repartition(buckets, "doc_id"), f"{path}/by_doc", "doc_id", buckets)
    rare = counted.join(often, "feature", "left_anti")
    write_buckets(rare.repartition(buckets, "feature"), f"{path}/by_feature", "feature", buckets)
    if stored.any_often:
        counted.join(often, "feature", "left_semi").write.mode("overwrite").parquet(f"{path}/often")
    return stored


def next_weights(stage: Stage, weights: DataFrame, batch: int, rate: float) -> DataFrame:
    """``(feature, weight)`` after the gradient of one batch of documents.

    Occurrences stay where they are. Scores move, summed per document inside the tasks
    that hold the weights, and gradients, summed per feature, move back to the weights.
    """
    chosen = F.col("batch") == batch
    part = (F.col("times") * F.col("weight")).alias("score")
    scores = stage.by_feature.filter(chosen).join(weights.hint("shuffle_hash"), "feature").select("doc_id", part)
    if stage.often is not None:
        few = weights.join(F.broadcast(stage.often_features), "feature", "left_semi")
        found = stage.often.filter(chosen).join(F.broadcast(few), "feature")
        scores = scores.unionByName(found.select("doc_id", part))
    scores = scores.groupBy("doc_id").agg(F.sum("score").alias("score"))
    residual = F.col("target") - logistic(F.col("score"))
    gradient = (
        stage.by_doc.filter(chosen)
        .join(scores.hint("shuffle_hash"), "doc_id")
        .groupBy("feature")
        .agg(F.sum(F.col("times") * residual).alias("gradient"))
    )
    moved = F.col("weight") + F.lit(rate) * F.coalesce("gradient", F.lit(0.0))
    return weights.join(gradient.hint("shuffle_hash"), "feature", "left").select("feature", moved.alias("weight"))


def train_epochs(
    instances: DataFrame,
    epochs: int,
    rate: float = RATE,
    model_id: str = "0",
    base: str | None = None,
    batches: int = 1,
    batch: Column | None = None,
    pieces: int | None = None,
) -> DataFrame:
    """Gradient training: every step updates all weights from the instances of one batch.

    With one batch a step is a full gradient and an epoch. ``batch``, a column of 0 to
    ``batches`` - 1, deals the instances, by default by a hash of ``doc_id``. Weights of
    each step are written below ``base``, by default in the shared folder of the session,
    so plans do not grow and a lost executor costs one step. ``pieces`` is for :func:`feature_counts`.
    """
    spark = instances.sparkSession
    base = base or new_run_dir(spark, "weights")
    if batch is None:
        batch = F.pmod(F.xxhash64("doc_id"), F.lit(batches))
    stage = open_stage(spark, store_occurrences(instances, f"{base}/data", batch, pieces))

    def place(step: int) -> str:
        return f"{base}/step={step:05d}"

    features = stage.session.read.parquet(f"{base}/data/occurrences").groupBy("feature").agg(F.lit(0.0).alias("weight"))
    write_buckets(features, place(0), "feature", stage.buckets)
    for step in range(epochs * batches):
        weights = read_buckets(stage.session, place(step), "feature", stage.buckets, schema_of(features))
        write_buckets(next_weights(stage, weights, step % batches, rate), place(step + 1), "feature", stage.buckets)
    return spark.read.schema(features.schema).parquet(place(epochs * batches)).select(F.lit(model_id).alias("model_id"), "feature", "weight")


def train_one_pass(instances: DataFrame, batches: int, seed: int | None = None, rate: float = RATE, model_id: str = "0", base: str | None = None, pieces: int | None = None) -> DataFrame:
    """One pass over the instances in consecutive batches of one order: by ``doc_id``, or random by ``seed``.

    Every instance takes part once. A batch is a consecutive stretch of the order; with
    as many batches as instances this is the plain one-by-one pass.
    """
    order = numbered(instances, ["doc_id"])
    position = F.col("_index") if seed is None else permuted(F.col("_index"), F.col("_total"), seed)
    dealt = order.withColumn("_batch", F.floor(position * batches / F.col("_total")))
    return train_epochs(dealt, 1, rate, model_id, base, batches, F.col("_batch"), pieces)


def frequent(occurrences: DataFrame, feature: str) -> DataFrame:
    """``(feature, _slots)`` of the features with more than 1/``SLOTS`` of all occurrences: fewer than ``SLOTS`` rows.

    ``_slots`` is into how many parts of about that share a feature's occurrences are cut.
    """
    uses = occurrences.filter(F.col(feature).isNotNull()).groupBy(feature).agg(F.count(F.lit(1)).alias("_uses"))
    total = uses.agg(F.sum("_uses")).scalar()
    slots = F.ceil(F.col("_uses") * SLOTS / total).cast("int")
    return uses.select(feature, slots.alias("_slots")).filter("_slots > 1")


def _weighted(instances: DataFrame, model: DataFrame) -> DataFrame:
    """``(doc_id, label, model_id, weight)`` per feature occurrence and model.

    Occurrences that no model knows, and documents without features, keep one row with
    nulls. Occurrences meet the weights of all models in long form. Those of a frequent
    feature are dealt by document over its slots, to each of which the weights of the
    feature go: fewer than twice ``SLOTS`` copies of a weight per model in all.
    """
    occurrences = instances.select("doc_id", "label", F.explode_outer("features").alias("feature"))
    often = F.broadcast(frequent(occurrences, "feature"))
    cut = F.coalesce("_slots", F.lit(1))
    dealt = occurrences.join(often, "feature", "left").select(
        "doc_id", "label", "feature", F.pmod(F.xxhash64("doc_id"), cut).cast("int").alias("_slot")
    )
    copies = model.join(often, "feature", "left").select(
        "feature", "model_id", "weight", F.explode(F.sequence(F.lit(0), cut - 1)).alias("_slot")
    )
    return dealt.join(copies, ["feature", "_slot"], "left").select("doc_id", "label", "model_id", "weight")


def score(instances: DataFrame, model: DataFrame) -> DataFrame:
    """``(doc_id, label, score, predicted)`` with one model; unknown features add 0.

    ``doc_id`` is unique. More than one ``model_id`` raises.
    """
    sums = (
        _weighted(instances, model)
        .groupBy("doc_id", "label")
        .agg(F.coalesce(F.sum("weight"), F.lit(0.0)).alias("score"))
    )
    several = model.agg(F.count_distinct("model_id") > 1).scalar()
    message = F.lit("several models: use score_ensemble")
    sums = sums.withColumn("score", F.when(several, F.raise_error(message).cast("double")).otherwise(F.col("score")))
    return sums.withColumn("predicted", predicted_label(F.col("score")))


def score_ensemble(instances: DataFrame, models: DataFrame, method: str) -> DataFrame:
    """Combine all models by ``average`` score or by ``vote``.

    A vote is the number of models with a score above zero minus the others. A
    model that knows no feature of a document scores 0.
    """
    if method not in ("average", "vote"):
        raise ValueError(f"unknown method {method!r}: expected 'average' or 'vote'")
    n_models = models.agg(F.count_distinct("model_id")).scalar()
    per_model = (
        _weighted(instances, models)
        .groupBy("doc_id", "label", "model_id")
        .agg(F.coalesce(F.sum("weight"), F.lit(0.0)).alias("score"))
    )
    if method == "average":
        combined = F.sum("score") / n_models
    else:
        combined = (2 * F.sum((F.col("score") > 0).cast("long")) - n_models).cast("double")
    return (
        per_model.groupBy("doc_id", "label")
        .agg(combined.alias("score"))
        .withColumn("predicted", predicted_label(F.col("score")))
    )
