import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallgrass.functions.permute import permuted
from tallgrass.operators import classifier

RNG = random.Random(3)
ROWS = [
    (f"d{i:03d}", "spam" if RNG.random() < 0.4 else "ham", [RNG.randrange(30) for _ in range(RNG.randrange(0, 12))] + [99])
    for i in range(60)
]
SCHEMA = "doc_id string, label string, features array<int>"


@pytest.fixture
def instances(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


def one_pass(rows, rate=0.002):
    w = {}
    for _, label, features in rows:
        p = 1 / (1 + math.exp(-sum(w.get(f, 0.0) for f in features)))
        for f in features:
            w[f] = w.get(f, 0.0) + ((label == "spam") - p) * rate
    return w


def weights(df):
    return {r.feature: r.weight for r in df.collect()}


def test_as_many_batches_as_instances_are_the_plain_pass(spark, instances):
    model = classifier.train_one_pass(instances.limit(12), 12)
    trained = sorted(r.doc_id for r in instances.limit(12).collect())
    assert {f: w for f, w in weights(model).items() if w} == pytest.approx(one_pass([r for r in ROWS if r[0] in trained]))


def test_batches_of_a_random_order(instances):
    order = {r.doc_id: r.position for r in classifier.in_random_order(instances, 7).collect()}
    assert sorted(order.values()) == list(range(60)) and [*order] != sorted(order, key=order.get)
    w = {f: 0.0 for _, _, fs in ROWS for f in fs}
    for b in range(4):
        some = [r for r in ROWS if order[r[0]] * 4 // 60 == b]
        step = full_gradient(some, 1, start=w)
        w |= step
    assert weights(classifier.train_one_pass(instances, 4, seed=7)) == pytest.approx(w)


def test_the_order_depends_on_keys_and_seed_alone(spark, instances):
    orders = [{r.doc_id: r.position for r in classifier.in_random_order(instances.repartition(n), s).collect()} for n, s in ((1, 7), (9, 7), (3, 8))]
    assert orders[0] == orders[1] != orders[2]


@pytest.mark.parametrize("total", [1, 2, 3, 64, 65, 1000])
def test_permutations_are_one_to_one(spark, total):
    found = [r.p for r in spark.range(total).select(permuted(F.col("id"), F.lit(total), 3).alias("p")).collect()]
    assert sorted(found) == list(range(total))
    if total == 1000:
        assert sum(a == i for i, a in enumerate(found)) < 10
        assert abs(np.corrcoef(range(total), found)[0, 1]) < 0.1 and abs(np.corrcoef(found[1:], found[:-1])[0, 1]) < 0.1


def test_large_numbers_stay_inside(spark):
    total = (1 << 60) - 12345
    numbers = spark.range(1000).select((F.lit(total) - 1 - F.col("id") * 1_000_003).alias("i"))
    found = [r.p for r in numbers.select(permuted(F.col("i"), F.lit(total), 1).alias("p")).collect()]
    assert len(set(found)) == 1000 and 0 <= min(found) and max(found) < total


def full_gradient(rows, epochs, rate=0.002, start=None):
    w = {f: start[f] if start else 0.0 for _, _, fs in rows for f in fs}
    for _ in range(epochs):
        gradient = dict.fromkeys(w, 0.0)
        for _, label, fs in rows:
            residual = (label == "spam") - 1 / (1 + math.exp(-sum(w[f] for f in fs)))
            for f in fs:
                gradient[f] += residual
        w = {f: w[f] + rate * g for f, g in gradient.items()}
    return w


@pytest.mark.parametrize("slots", [4, 4096])
def test_epochs(instances, no_broadcast, monkeypatch, slots):
    monkeypatch.setattr(classifier, "SLOTS", slots)
    assert weights(classifier.train_epochs(instances, 3)) == pytest.approx(full_gradient(ROWS, 3))


def test_epoch_weights_are_stored(spark, instances, tmp_path):
    classifier.train_epochs(instances, 2, base=str(tmp_path / "w"))
    middle = spark.read.parquet(str(tmp_path / "w" / "step=00001"))
    assert weights(middle) == pytest.approx(full_gradient(ROWS, 1))


MODELS = [("a", 1, 0.5), ("a", 2, -0.5), ("b", 1, -0.25), ("b", 3, 1.0), ("c", 4, -2.0)]
DOCS = [
    ("none", "ham", [7, 8]),
    ("empty", "ham", []),
    ("zero", "spam", [1, 2]),
    ("twice", "spam", [1, 1, 3]),
    ("mixed", "ham", [2, 3, 4]),
]


def scores(model, features):
    w = {f: x for m, f, x in MODELS if m == model}
    return sum(w.get(f, 0.0) for f in features)


@pytest.fixture
def docs(spark):
    return spark.createDataFrame(DOCS, SCHEMA)


@pytest.fixture
def models(spark):
    return spark.createDataFrame(MODELS, "model_id string, feature int, weight double")


@pytest.mark.parametrize("slots", [2, 4096])
def test_scores(docs, models, no_broadcast, monkeypatch, slots):
    monkeypatch.setattr(classifier, "SLOTS", slots)
    got = {r.doc_id: (r.label, r.score, r.predicted) for r in classifier.score(docs, models.filter("model_id = 'a'")).collect()}
    assert got == {
        d: (label, scores("a", fs), "spam" if scores("a", fs) > 0 else "ham") for d, label, fs in DOCS
    }
    assert got["zero"][2] == "ham"


@pytest.mark.parametrize("slots", [2, 4096])
@pytest.mark.parametrize("method", ["average", "vote"])
def test_ensembles(docs, models, no_broadcast, monkeypatch, method, slots):
    monkeypatch.setattr(classifier, "SLOTS", slots)
    got = {r.doc_id: (r.score, r.predicted) for r in classifier.score_ensemble(docs, models, method).collect()}
    for d, _, fs in DOCS:
        each = [scores(m, fs) for m in "abc"]
        wanted = sum(each) / 3 if method == "average" else sum(1 if s > 0 else -1 for s in each)
        assert got[d] == (pytest.approx(wanted), "spam" if wanted > 0 else "ham")


@pytest.mark.parametrize("method", ["average", "vote"])
def test_five_hundred_models(spark, instances, method):
    """Long form: no row holds the weights of more than one model."""
    weight = lambda m, f: ((f * (m + 3)) % 21 - 10) / 64
    rows = [(f"m{m}", f, weight(m, f)) for m in range(500) for f in [*range(0, 30, 2), 99]]
    models = spark.createDataFrame(rows, "model_id string, feature int, weight double").repartition(4)
    got = {r.doc_id: (r.score, r.predicted) for r in classifier.score_ensemble(instances, models, method).collect()}
    known = {*range(0, 30, 2), 99}
    for d, _, fs in ROWS:
        each = [sum(weight(m, f) for f in fs if f in known) for m in range(500)]
        wanted = sum(each) / 500 if method == "average" else sum(1 if s > 0 else -1 for s in each)
        assert got[d] == (pytest.approx(wanted), "spam" if wanted > 0 else "ham")


def test_unknown_method_raises(docs, models):
    with pytest.raises(ValueError):
        classifier.score_ensemble(docs, models, "median")
