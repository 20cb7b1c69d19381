import random
from collections import Counter, defaultdict
from itertools import combinations

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tallgrass.operators import paircells, words


def brute(stretches):
    singles, pairs = Counter(), Counter()
    for s in stretches:
        singles.update(s)
        pairs.update(combinations(sorted(s), 2))
    return singles, pairs


def some_stretches(n, vocabulary, seed):
    rng = random.Random(seed)
    return [rng.sample(vocabulary, rng.randrange(0, 12)) for _ in range(n)]


@pytest.mark.parametrize("held", [1, 7, 1 << 22])
@pytest.mark.parametrize("bits", [2, 23])
@pytest.mark.parametrize("groups", [3, 30])
def test_cells_of_many_parts_add_up(monkeypatch, held, bits, groups):
    monkeypatch.setattr(paircells, "PAIRS_HELD", held)
    monkeypatch.setattr(paircells, "COUNT_BITS", bits)
    vocabulary = ["the", "été", "\U0001f600", "￿", "a\x00b"] + [f"w{i}" for i in range(60)]
    parts = [some_stretches(40, vocabulary[: 20 + 15 * i], i) for i in range(4)] + [[[]], [["lone"]]]
    blocks = defaultdict(list)
    for i, part in enumerate(parts):
        half = len(part) // 2
        held_rows = [pa.array(part[:half], pa.list_(pa.string())), pa.array(part[half:], pa.list_(pa.string()))]
        for batch in paircells._sent(held_rows, groups, i):
            for row in batch.to_pylist():
                blocks[row["x"], row["y"]].append(row)
    schema = paircells._batch([(0, 0, 0, None, None, None, None, None)]).schema
    rows = [r for b in blocks.values() for r in paircells._added(pa.Table.from_pylist(b, schema), 2).to_pylist()]
    singles, pairs = brute([s for part in parts for s in part])
    code_points = lambda x, y: (x, y) if x.encode() < y.encode() else (y, x)
    wanted = {code_points(x, y): (n, *(singles[w] for w in code_points(x, y))) for (x, y), n in pairs.items() if n >= 2}
    assert {(r["x"], r["y"]): (r["n"], r["n_x"], r["n_y"]) for r in rows if r["kind"] == "pair"} == wanted
    assert {r["y"]: r["n"] for r in rows if r["kind"] == "word"} == {w: n for w, n in singles.items() if n >= 2}
    assert [r["n"] for r in rows if r["kind"] == "total"] == [sum(map(len, parts))]
    assert len(rows) == len(wanted) + sum(n >= 2 for n in singles.values()) + 1


def shuffled_bytes(spark, run):
    store = spark.sparkContext._jsc.sc().statusStore()
    gateway = spark.sparkContext._gateway

    def stages():
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
        found = store.stageList(None, False, False, gateway.new_array(gateway.jvm.double, 0), None)
        return [found.apply(i) for i in range(found.size())]

    seen = {s.stageId() for s in stages()}
    run()
    return sum(s.shuffleWriteBytes() for s in stages() if s.stageId() not in seen)


@pytest.mark.parametrize("operator", [words.pair_counts, words.pmi_pairs], ids=["pairs", "pmi"])
def test_a_pair_moves_as_few_bytes(spark, operator):
    """Less than two bytes for an occurrence of a pair; rows of two words take ten and more."""
    token = F.translate((F.abs(F.xxhash64("id", "k")) % 3000).cast("string"), "0123456789", "abcdefghij")
    lines = spark.range(0, 3000, 1, 4).withColumn("k", F.explode(F.sequence(F.lit(1), F.lit(40)))).select("id", token.alias("w"))
    lines = lines.groupBy("id").agg(F.concat_ws(" ", F.collect_list("w")).alias("value")).select("value").localCheckpoint()
    tokenized = words.tokenized_lines(lines)
    moved = shuffled_bytes(spark, lambda: operator(tokenized, 10).write.format("noop").mode("overwrite").save())
    assert 0 < moved < 2 * 3000 * 780
