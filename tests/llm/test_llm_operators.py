"""Operators against plain versions, on rows with every awkward case."""

import base64
import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
import xxhash
from pyspark.sql import functions as F

from test_skew import largest_share

from tallgrass.llm import bpe, common, dedup, embeddings, mixing, passages, pii, quality, sharding, simhash, urls

# Extra columns carry the names of results and of helpers.
SCHEMA = "size string, doc_id long, text string, source string, score int, spans string, n int"
RNG = random.Random(3)
WORDS = ["".join(RNG.choice("abcdefghijklmnop") for _ in range(RNG.randint(2, 9))) for _ in range(400)]
PASSAGE = "a passage of more than fifty bytes that stands in several texts, with Ünïcode "


def prose(n):
    return " ".join(RNG.choice(WORDS) for _ in range(n))


def corpus():
    texts = [prose(RNG.randint(3, 60)) for _ in range(40)]
    texts += [prose(5) + "\n" + PASSAGE + prose(6) for _ in range(5)] + [PASSAGE * 3, "a" * 400, "a" * 300 + "b"]
    texts += [texts[0].upper(), texts[0], texts[0], "", "", " \t\n", "x", "two words", "ÄÖ äö", "é" * 60]
    texts += [prose(9) + f" mail joe.{i}@x-{i}.example.com, 10.0.0.{250 + i} or +1 (20{i}) 555-0199 " + prose(3) for i in range(8)]
    texts += ["card 4111 1111 1111 1111 and 4111111111111112 on 1.2.3.4.5", "a@b.c_d@e.f " + "1" * 5000 + " " + "z" * 5000 + "@"]
    texts += [prose(200).replace(WORDS[1], WORDS[2]), prose(30) + "😀 don't  stop 12345 $$$"]
    rows = [(i * 7 - 9, t, f"s{i % 4}") for i, t in enumerate(texts)]
    rows += [(None, texts[0], None), (None, None, "s1"), (500, None, None), rows[3], rows[3], (rows[4][0], "other text of a repeated id " * 4, "s2")]
    return [("9", d, t, s, 1, "x", 2) for d, t, s in rows]


ROWS = corpus()


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def pairs():
    return [(r[1], r[2] or "") for r in ROWS]


def low(text):
    return text.encode().lower()


def bag(df, *columns):
    return Counter(tuple(r) for r in df.select(*columns).collect())


def test_exact_duplicates(docs):
    groups = defaultdict(list)
    for d, t in pairs():
        groups[low(t)].append(d)
    keep = {c: max((d for d in g if d is not None), default=None) for c, g in groups.items()}
    wanted = Counter((d, keep[low(t)], len(groups[low(t)]), hashlib.sha256(low(t)).hexdigest()) for d, t in pairs())
    found = dedup.exact_duplicates(docs)
    assert bag(found, "doc_id", "keep_id", "group_size", "text_sha256") == wanted
    assert found.filter("kept").count() == len(groups) == dedup.keep_one(docs).count()
    assert dedup.keep_one(docs).columns == docs.columns


def test_grace_buckets_spill_and_compare_whole_contents():
    records = [(hashlib.sha256(str(i % 500).encode()).digest(), str(i % 500).encode() * 50, i, 1) for i in range(3000)]
    same_digest = [(bytes(32), b"one", 1, 1), (bytes(32), b"two", 2, 1), (bytes(32), b"one", 3, 1)]
    found = [row for t in dedup.grace_tables(iter(records + same_digest), fit_bytes=5000) for row in t.rows]
    assert len(found) == 502 and sum(r[3] for r in found) == 3003
    assert {bytes(r[1]): r[2] for r in found}[b"one"] == 3


def test_jump_hash_and_slots(docs):
    def jump(key, n):
        key, b, j = key & (1 << 64) - 1, -1, 0
        while j < n:
            b, key = j, key * 2862933555777941757 + 1 & (1 << 64) - 1
            j = int((b + 1) * (float(1 << 31) / ((key >> 33) + 1)))
        return b

    found = sharding.assign(docs)
    wanted = Counter((d, len(t.encode()) + 1, zlib.crc32(t.encode()), jump(d or 0, 8), jump(d or 0, 9)) for d, t in pairs())
    assert bag(found, "doc_id", "size", "text_crc32", "shard", "grown_shard") == wanted
    assert all(x in (a, 8) for *_, a, x in wanted)
    slots = defaultdict(list)
    for r in found.collect():
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


@pytest.mark.parametrize("block", [7, 1024])
def test_mixing(docs, block):
    rows = mixing.taken(docs, block=block).collect()
    sizes = Counter()
    for r in ROWS:
        sizes[r[3]] += len(re.findall(r"[^\x20\x09-\x0D]+", r[2] or ""))
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    left, goal, full = 1.5 * sum(sizes.values()), {}, True
    rest = set(order)
    while full:
        level = left / sum(weight[s] for s in rest)
        full = {s for s in rest if level * weight[s] > 2 * sizes[s]}
        for s in full:
            goal[s], left = 2.0 * sizes[s], left - 2 * sizes[s]
        rest -= full
    goal |= {s: level * weight[s] for s in rest}
    taken = Counter()
    for r in rows:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(goal[r.source]) and r.taken <= 2 * r["size"]
        taken[r.source] += r.taken
    assert len(rows) == len(ROWS) and all(abs(taken[s] - goal[s]) <= 0.5 + 1e-9 for s in order)
    slots = mixing.schedule(docs, block=block).collect()
    assert sum(s.words for s in slots) == sum(taken.values())
    assert Counter(sorted(rows, key=str)) == Counter(sorted(mixing.taken(docs, block=block).collect(), key=str))
    mixed = mixing.repeated(docs)
    assert mixed.columns == docs.columns and mixed.count() == sum(-(-r.taken // r["size"]) for r in rows if r.taken)


def test_bpe_equals_tiktoken_and_comes_back(docs):
    lines = open(public_tokenizers.path(bpe.RANKS), "rb")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    plain = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    coded = bpe.encode(docs)
    assert Counter((r.doc_id, tuple(r.ids)) for r in coded.collect()) == Counter((d, tuple(plain.encode_ordinary(t))) for d, t in pairs())
    assert bag(bpe.decode(coded), "doc_id", "text") == Counter(pairs())
    assert bag(bpe.digests(docs), "doc_id", "decoded_sha256") == Counter((d, hashlib.sha256(t.encode()).hexdigest()) for d, t in pairs())
    encoder = bpe.Encoder(public_tokenizers.path(bpe.RANKS))
    for token in ("abcab" * 9, "é" * 200, "the" * 700):
        assert bpe.merge_one(token.encode(), encoder.vocab) == plain.encode_ordinary(token)


def test_url_rules_and_odd_urls(spark):
    cases = {
        "http://A.Example.COM/en/1?x": ("a.example.com", "/en/1", "example.com/en/", "block"),
        "https://www.example.com/en/": ("www.example.com", "/en/", "www.example.com/en/", "allow"),
        "x://notexample.com/en/": ("notexample.com", "/en/", "com/", "allow"),
        "http://b.net/fr/9#t": ("b.net", "/fr/9", "net/fr/", "block"),
        "http://com": ("com", "", None, "allow"), "no scheme": ("", "", None, "allow"), None: ("", "", None, "allow"),
        "http://h.org?q=/en/": ("h.org", "", None, "allow"), "": ("", "", None, "allow"),
    }
    pages = spark.createDataFrame([(i, u, "x") for i, u in enumerate(cases)] + [(0, next(iter(cases)), "y")], "page_id long, url string, host string")
    labels = spark.createDataFrame([], "doc_id long, quality int")
    found = urls.judge(pages, urls.page_outcomes(pages, labels))
    wanted = Counter((i, *v) for i, v in enumerate(cases.values())) + Counter([(0, *next(iter(cases.values())))])
    assert bag(found, "page_id", "host", "path", "rule", "verdict") == wanted
    assert urls.judge(pages.limit(0), urls.page_outcomes(pages.limit(0), labels)).count() == 0


def test_bad_hosts_are_blocked_and_unknown_ones_are_not(spark):
    pages = spark.createDataFrame([(i, f"http://{'bad' if i % 2 else 'good'}.d{i % 2}.org/p/{i}") for i in range(400)] + [(999, "http://new.org/p/x")], "page_id long, url string")
    labels = spark.createDataFrame([(i, 1 - i % 2) for i in range(300)], "doc_id long, quality int")
    verdicts = {r.host: r.verdict for r in urls.judge(pages, urls.page_outcomes(pages, labels)).collect()}
    assert verdicts == {"bad.d1.org": "block", "good.d0.org": "allow", "new.org": "allow"}


def roots(nodes, links):
    up = {n: n for n in nodes}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def plain_print(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", low(text))
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(len(words) - 2, 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash_components(docs):
    prints = [plain_print(t) for _, t in pairs()]
    links = [(i, j) for i in range(len(prints)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 3]
    root = roots(range(len(prints)), links)
    least = defaultdict(list)
    for i, (d, _) in enumerate(pairs()):
        least[root[i]].append(d)
    low_id = {r: min((d for d in g if d is not None), default=None) for r, g in least.items()}
    wanted = Counter((d, f"{prints[i]:016x}", low_id[root[i]]) for i, (d, _) in enumerate(pairs()))
    assert bag(simhash.near_duplicates(docs), "doc_id", "fingerprint", "component_id") == wanted


def test_anchors_find_every_link_up_to_three_bits(spark):
    rng = np.random.default_rng(5)
    base = rng.integers(0, 1 << 63, 150, dtype=np.int64)
    flips = [sum(1 << int(b) for b in rng.choice(63, k, replace=False)) for k in (1, 2, 3, 4) for _ in range(40)]
    points = sorted({int(p) for p in base} | {int(base[i % 150]) ^ f for i, f in enumerate(flips)})
    found = simhash.links(spark.createDataFrame([(p,) for p in points], "fp long"))
    wanted = roots(points, [(a, b) for i, a in enumerate(points) for b in points[:i] if (a ^ b).bit_count() <= 3])
    assert roots(points, [(r.u, r.v) for r in found.collect()]) == wanted


def test_a_crowded_anchor_is_cut_into_pieces_that_find_the_same_links(spark, monkeypatch):
    rng = np.random.default_rng(12)
    base = 0x1234567 << 32 | 0x7654321
    points = sorted({base ^ sum(1 << int(b) for b in rng.choice(63, int(rng.integers(1, 7)), replace=False)) for _ in range(500)})
    frame = spark.createDataFrame([(p,) for p in points], "fp long")
    monkeypatch.setattr(simhash, "HOMES", 16)
    monkeypatch.setattr(simhash, "ROWS", 64)
    schema = "anchor long, fp long, home boolean"
    visits = common.map_batches(frame, simhash._visits, schema)
    dealt = simhash.pieces(visits, simhash.hot_anchors(frame, simhash._visits, schema, "fp"), "fp")
    largest = dealt.groupBy("anchor", "_h", "_g").count().agg({"count": "max"}).first()[0]
    assert visits.groupBy("anchor").count().agg({"count": "max"}).first()[0] > 100 >= largest
    wanted = roots(points, [(a, b) for i, a in enumerate(points) for b in points[:i] if (a ^ b).bit_count() <= 3])
    assert len(set(wanted.values())) > 1
    assert roots(points, [(r.u, r.v) for r in simhash.links(frame).collect()]) == wanted


def test_one_text_of_each_group_of_fingerprints_stays(spark):
    """Copies with few and with many edits, repeated words, a text that a third of all rows repeat, and null ids."""
    rng = random.Random(21)
    texts = [" ".join(rng.choice(WORDS) for _ in range(rng.randint(60, 400))) for _ in range(60)]
    rows = [(i, t) for i, t in enumerate(texts)]
    for i, t in enumerate(texts):
        words = t.split()
        words[rng.randrange(len(words))] = "changed"
        more = [t + " again" * (i % 40), t[: len(t) * 7 // 8], " ".join(words), t.upper()]
        rows += [(100 + 4 * i + n, x) for n, x in enumerate(more)]
    rows += [(7, texts[7])] * 150 + [(None, texts[3]), (None, "an own text"), (None, "an own text"), (5000, ""), (5001, None)]
    prints = {t: plain_print(t or "") for _, t in rows}
    points = sorted(set(prints.values()))
    root = roots(points, [(a, b) for i, a in enumerate(points) for b in points[:i] if (a ^ b).bit_count() <= 3])
    groups = defaultdict(list)
    for d, t in rows:
        groups[root[prints[t]]].append((d is None, d or 0))
    wanted = sorted((min(g) for g in groups.values()))
    kept = simhash.keep_one(spark.createDataFrame([("e", d, t, 1) for d, t in rows], "_root string, doc_id long, text string, fp int").repartition(6))
    assert kept.columns == ["_root", "doc_id", "text", "fp"]
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in kept.collect()) == wanted
    assert len(groups) > 80 and sum(len(g) > 1 for g in groups.values()) > 40


def repeated_rows(spark):
    """A third of all rows equal in id and text, a third with a null id."""
    third = F.col("id") % 3
    return spark.range(0, 9000, 1, 6).select(
        F.when(third == 0, 5).when(third == 1, F.col("id")).alias("doc_id"), F.when(third == 0, F.lit("same")).otherwise(F.concat(F.lit("text "), "id")).alias("text")
    )


@pytest.mark.parametrize("copies", [100, 1 << 14])
def test_rows_that_a_third_repeats_are_counted_before_they_move(spark, monkeypatch, copies):
    monkeypatch.setattr(common, "COPIES", copies)
    docs = repeated_rows(spark)
    found = dedup.exact_duplicates(docs)
    rows = found.filter("doc_id = 5").collect()
    assert len(rows) == 3000 and sum(r.kept for r in rows) == 1 and {r.group_size for r in rows} == {3000}
    assert found.count() == 9000 and found.filter("kept").count() == 6001
    placed = sharding.assign(docs).collect()
    slots = defaultdict(list)
    for r in placed:
        slots[r.shard].append(r.slot)
    assert len(placed) == 9000 and all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert sum(r.doc_id == 5 for r in placed) == sum(r.doc_id is None for r in placed) == 3000


@pytest.mark.parametrize("operator", [dedup.exact_duplicates, sharding.assign, simhash.keep_one])
def test_no_task_reads_the_rows_that_a_third_repeats(spark, monkeypatch, operator):
    monkeypatch.setattr(sharding, "PARTS", 64)  # the counts of all parts are a small table of fixed size
    keys = ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")
    before = [spark.conf.get(k) for k in keys]
    for k, v in zip(keys, ("16", "false")):
        spark.conf.set(k, v)
    try:
        docs = repeated_rows(spark)
        assert largest_share(spark, lambda: operator(docs).write.format("noop").mode("overwrite").save(), 2500) < 0.16
    finally:
        for k, v in zip(keys, before):
            spark.conf.set(k, v)


def test_rows_repeated_in_a_task_are_dropped_there(spark):
    frame = spark.range(0, 3000, 1, 3).selectExpr("if(id % 3 = 0, 1, id) as k", "0L as n", "'t' as text")
    found = common.without_repeats(frame, ["k", "n"])
    assert found.columns == frame.columns and found.filter("k = 1").count() <= 4
    assert found.select("k").distinct().count() == frame.select("k").distinct().count()


def passages_by_bytes(rows):
    first = {}
    for d, t in sorted((p for p in rows if p[0] is not None), key=lambda p: p[0]):
        raw = t.encode()
        for i in range(len(raw) - 49):
            first.setdefault(raw[i : i + 50], d)
    wanted = Counter()
    for d, t in rows:
        raw = t.encode()
        gone = np.zeros(len(raw), bool)
        for i in range(len(raw) - 49):
            if d is not None and first[raw[i : i + 50]] < d:
                gone[i : i + 50] = True
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        runs = int((np.diff(gone.astype(int), prepend=0) == 1).sum())
        wanted[d, len(raw), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()] += 1
    return wanted


def passages_by_spark(docs):
    return bag(passages.digests(docs), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


@pytest.mark.parametrize("hot", [passages.HOT, 1])
def test_passages(docs, monkeypatch, hot):
    monkeypatch.setattr(passages, "HOT", hot)
    assert passages_by_spark(docs) == passages_by_bytes(pairs())


def edged(n):
    """A passage in a third of all texts, with a text of its own on both sides."""
    rng = random.Random(5)
    letters = "abcdefghijklmnopqrstuvwxyz "
    own = lambda k: "".join(rng.choice(letters) for _ in range(k))
    return [(i, own(90) + (PASSAGE if i % 3 == 0 else own(20)) + own(90)) for i in range(n)]


def test_a_passage_with_other_text_around_it_is_dealt_by_windows(spark, monkeypatch):
    rows = edged(300)
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    wanted = passages_by_bytes(rows)
    asked = []
    whole = passages.hot_anchors
    monkeypatch.setattr(passages, "hot_anchors", lambda texts: asked.append(whole(texts)) or asked[-1])
    assert passages_by_spark(frame) == wanted and not len(asked[-1])
    monkeypatch.setattr(passages, "HOT", 20)
    assert passages_by_spark(frame) == wanted and len(asked[-1])
    monkeypatch.setattr(passages, "HOT_WINDOWS", 100)
    assert passages_by_spark(frame) == wanted


def sent_per_part(rows, parts, hot):
    """Stretches of texts, in four tasks, that each part gets."""
    got = np.zeros(parts, np.int64)
    for task in range(4):
        some = rows[task::4]
        raw = [t.encode() for _, t in some]
        doc, start, *_ = passages.cut(*common.as_bytes(pa.array(raw, pa.binary())))
        marks = [start[doc == i].astype(np.int32).tobytes() for i in range(len(raw))]
        ids = pa.array([d for d, _ in some], pa.int64())
        batch = pa.record_batch({"doc": ids, "row": ids, "text": pa.array(raw, pa.binary()), "starts": pa.array(marks, pa.binary())})
        for out in passages._texts(parts, hot)([batch]):
            for part, docs in zip(out["part"].to_pylist(), out["_doc"].to_pylist()):
                got[part] += len(docs or b"") // 8
    return got


def test_no_part_gets_the_stretches_of_a_hot_anchor(spark, monkeypatch):
    monkeypatch.setattr(passages, "HOT", 20)
    rows = [(i, t[85 : 95 + len(PASSAGE)]) for i, t in edged(1200) if i % 3 == 0]
    hot = passages.hot_anchors(spark.createDataFrame(rows, "doc_id long, text string"))
    before, after = sent_per_part(rows, 64, hot[:0]), sent_per_part(rows, 64, hot)
    assert before.max() > 350 and before.max() > before.sum() / 4
    assert after.max() < after.sum() / 16


def test_suffix_sort_equals_plain_sort_even_if_hashes_collide(monkeypatch):
    rng = np.random.default_rng(1)
    text = rng.integers(97, 99, 3000).astype(np.uint8)
    starts = rng.integers(0, 2900, 700)
    group = np.sort(rng.integers(0, 40, 700))
    order, shared = passages.sort_suffixes(text, starts, group, 12)
    raw = text.tobytes()
    keys = [(g, raw[s : s + 12]) for g, s in zip(group, starts)]
    assert [keys[i] for i in order] == sorted(keys)
    assert all((shared[k] >= 12) == (keys[order[k]] == keys[order[k - 1]]) for k in range(1, 700))
    text[200:260] = text[100:160]
    starts, group = np.array([100, 200, 101, 500, 201]), np.zeros(5, np.int64)
    monkeypatch.setattr(passages, "common_extension", lambda p, d, a, b, limit: np.full(len(a), limit))
    number = passages.window_classes(text, starts, group)
    assert number[0] == number[1] != number[3] and number[2] == number[4] != number[0]


def test_personal_data(docs):
    patterns = (
        r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]",
    )

    def luhn(digits):
        return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(digits))) % 10 == 0

    def fits(kind, value):
        digits = re.sub("[^0-9]", "", value)
        if kind == 1:
            return all(int(x) <= 255 for x in value.split("."))
        return kind == 0 or (12 <= len(digits) <= 19 and luhn(digits) if kind == 2 else 9 <= len(digits) <= 15)

    wanted = Counter()
    for d, t in pairs():
        found = sorted((m.start(), k, m.end()) for k, p in enumerate(patterns) for m in re.finditer(p, t) if fits(k, m.group()))
        joined = ",".join(f"{pii.NAMES[k]}:{a}:{b}" for a, k, b in found)
        wanted[d, *(sum(f[1] == k for f in found) for k in range(4)), hashlib.sha256(joined.encode()).hexdigest()] += 1
    assert bag(pii.digests(docs), "doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256") == wanted


def disclosures_by_counts(rows):
    """Entity, term and disclosure, counted in the open; addresses only."""
    words, near = Counter(), defaultdict(Counter)
    for _, text in rows:
        words.update(w.lower() for w in re.findall(r"[^\W_]{2,}", text))
        for line in text.split("\n"):
            spans = [m.span() for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", line)]
            outside = [m for m in re.finditer(r"[^\W_]{2,}", line) if all(m.end() <= a or m.start() >= b for a, b in spans)]
            seen = set()
            for a, b in spans:
                before = [m for m in outside if m.end() <= a]
                behind = [m for m in outside if m.start() >= b]
                seen |= {("email:" + line[a:b].lower(), m.start(), m.group().lower()) for m in before[-pii.NEAR :] + behind[: pii.NEAR]}
            for entity, _, term in seen:
                near[entity][term] += 1
    every, found = sum(words.values()), {}
    for entity, terms in near.items():
        prior = sum(terms.values()) / every
        found |= {(entity, t): np.log(n / words[t] / prior) / -np.log(prior) for t, n in terms.items() if n >= pii.SUPPORT}
    return found


@pytest.mark.parametrize("copies", [1, 60])
def test_disclosures_equal_plain_counts(spark, no_broadcast, copies):
    rng = random.Random(8)
    some = lambda n: " ".join(rng.choice(WORDS) for _ in range(n))
    hosts = ["joe.smith@mail.example.com", "a-b.c-d@very-long.host-name.of-many.parts.example.org", "x@y.zz"]
    texts = [f"{some(12)} {rng.choice(hosts)} {some(rng.randint(0, 12))} {rng.choice(hosts)} {some(3)}\n{some(20)}" for _ in range(60)]
    texts += [f"zorblat {hosts[0]},{hosts[2]}"] * copies + ["", some(50), f"{hosts[1]}" * 2]
    rows = list(enumerate(texts))
    got = {(r.entity, r.term): r.disclosure for r in pii.disclosures(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    wanted = disclosures_by_counts(rows)
    assert got.keys() == wanted.keys() and wanted
    assert all(abs(got[k] - wanted[k]) < 1e-9 for k in wanted)


def test_telling_terms_are_removed_and_common_ones_stay(spark):
    rows = [(i, f"the zorblat office of joe@x.com writes the letter {prose(4)}") for i in range(3)] + [(10 + i, "the letter of the office " + prose(20)) for i in range(200)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    texts = {r.doc_id: r.text for r in pii.sanitised(frame).collect()}
    assert texts[0].startswith("the [TERM] office of [EMAIL] writes" ) or texts[0].startswith("the [TERM] office of [EMAIL] [TERM]")
    assert all(texts[d] == t for d, t in rows[3:])


def test_embeddings_find_all_links(spark):
    rng = np.random.default_rng(2)
    base = rng.standard_normal((60, 32))
    vectors = [b for b in base] + [base[i % 20] + rng.standard_normal(32) * 0.15 * rng.random() for i in range(300)] + [base[0]] * 30
    rows = [(i, [float(np.float32(x)) for x in v], i % 2) for i, v in enumerate(vectors)]
    rows += [(900, None, 0), (901, [0.0] * 32, 0), (902, [float("nan")] * 32, 0), (903, [None] * 32, 0), (904, rows[0][1], None), (905, [1.0], 0), (906, [], 0)]
    found = embeddings.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int"))
    x = np.array([r[1] for r in rows[:390]])
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    label = np.arange(390) % 2
    near = (unit @ unit.T >= 0.98) & (label[:, None] == label)
    np.fill_diagonal(near, False)
    root = roots(range(390), zip(*map(np.ndarray.tolist, np.nonzero(near)))) | {i: i for i in range(900, 907)}
    degree = dict(enumerate(near.sum(axis=1).tolist()))
    assert bag(found, "vec_id", "n_links", "component_id", "kept") == Counter((i, degree.get(i, 0), r, r == i) for i, r in root.items())
    assert sum(degree.values()) > 1000


def test_quality_tells_junk_by_held_out_labels(spark):
    texts = {i: prose(60) if i % 4 else " ".join(w.upper() + "!!" for w in prose(60).split()) for i in range(300)}
    frame = spark.createDataFrame([(i, t, 7) for i, t in texts.items()] + [(None, "x", 1), (1000, None, 1), (1001, "", 1)], "doc_id long, text string, score int")
    labels = spark.createDataFrame([(i, int(i % 4 > 0)) for i in texts], "doc_id long, quality int")
    rows = quality.classify(frame, labels).collect()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows) and len(rows) == 303
    held = [r for r in rows if r.held_out and r.doc_id in texts]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows if r.doc_id is not None)
    assert len(held) > 30 and all(r.predicted == int(r.doc_id % 4 > 0) for r in held)
    assert quality.accepted(frame, labels).columns == frame.columns
    assert {r.score for r in quality.classify(frame, labels.limit(0)).collect()} == {1.0}


def test_a_repeated_labelled_id_is_one_row_of_the_model(spark):
    ids = [i for i in range(40) if zlib.crc32(str(i).encode()) % 5][:10]
    rows = [(i, prose(20)) for i in ids] + [(ids[0], prose(20)) for _ in range(200)] + [(ids[1], "the same text")] * 200
    labels = spark.createDataFrame([(i, i % 2) for i in ids], "doc_id long, quality int")
    model = quality.train(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), labels)
    assert len(model.vectors) == len(model.labels) == 10 and model.mean == sum(i % 2 for i in ids) / 10


def test_votes_equal_a_plain_count_of_neighbours():
    rng = np.random.default_rng(9)
    vectors = quality._unit(rng.integers(-2, 3, (80, 6)).astype(np.float32))  # many ties
    labels, rows = rng.integers(0, 2, 80).astype(float), rng.integers(0, 3, (300, 9)).astype(np.float32)
    rows[4] = 0
    model = quality.Model(rng.standard_normal((9, 6)).astype(np.float32), np.full(6, 0.1, np.float32), vectors, labels, 0.7)
    cosine = quality._unit(rows @ model.projection - model.shift) @ vectors.T
    for i, score in enumerate(quality.vote(model, rows, 25)):
        near = sorted(range(80), key=lambda j: (-cosine[i, j], j))[:25]
        weight = [max(float(cosine[i, j]), 0) ** 4 for j in near]
        assert score == pytest.approx(sum(w * labels[j] for w, j in zip(weight, near)) / sum(weight) if rows[i].any() else 0.7)


def test_the_model_is_that_of_all_rows_at_once(spark):
    """The sample in blocks gives the leading directions of the centred, weighted rows."""
    rng = random.Random(2)
    rows = [(i, " ".join(rng.choice(WORDS[: 20 + 10 * (i % 5)]) for _ in range(50))) for i in range(400)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(400)], "doc_id long, quality int")
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    model = quality.train(frame, labels, rank=6)
    some = [t.encode() for i, t in rows if zlib.crc32(str(i).encode()) % 5]
    flat, ends = np.frombuffer(b"".join(some), np.uint8), np.cumsum([0, *map(len, some)])
    x = quality.frequencies(quality.term_counts(flat, ends)).astype(np.float16).astype(np.float64)
    x *= np.log((1 + len(x)) / (1 + (x > 0).sum(axis=0))) + 1
    x -= x.mean(axis=0)
    wanted = np.linalg.svd(x, full_matrices=False)[1]
    assert len(model.vectors) == len(x) and model.vectors.shape[1] == 6
    latent = x @ (np.linalg.svd(x, full_matrices=False)[2][:2].T)
    got = model.vectors[:, :2]
    assert wanted[0] > 0 and abs(np.corrcoef(np.abs(latent[:, 0]), np.abs(got[:, 0] * np.linalg.norm(latent, axis=1)))[0, 1]) > 0.5
    again = quality.train(frame.repartition(3), labels, rank=6)
    assert np.array_equal(model.vectors, again.vectors) and np.array_equal(model.projection, again.projection)


@pytest.mark.parametrize("letters", ["abcdefghijklmnopqrst", "абвгдежзийклмнопрсту"])
def test_quality_sees_the_words(spark, letters):
    """Good and bad texts of the same form, in other words."""
    rng = random.Random(len(letters.encode()))
    sizes = [rng.randint(3, 8) for _ in range(300)]
    good, bad = (["".join(rng.choice(letters) for _ in range(n)) for n in sizes] for _ in range(2))
    rows = []
    for i in range(600):
        at = [rng.randrange(300) for _ in range(80)]
        rows.append((i, " ".join(good[j] if i % 3 or rng.random() < 0.5 else bad[j] for j in at) + "."))
    labels = spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(600)], "doc_id long, quality int")
    held = quality.classify(spark.createDataFrame(rows, "doc_id long, text string"), labels).filter("held_out").collect()
    assert len(held) > 80 and sum(r.predicted == int(r.doc_id % 3 > 0) for r in held) >= 0.95 * len(held)


@pytest.mark.parametrize("operator", [dedup.exact_duplicates, sharding.assign, mixing.taken, bpe.digests, simhash.near_duplicates, passages.digests, pii.digests])
def test_empty_tables(none, operator):
    assert operator(none).count() == 0


def test_quality_and_embeddings_of_empty_tables(spark, none):
    labels = spark.createDataFrame([(1, 1)], "doc_id long, quality int")
    assert quality.classify(none, labels).count() == quality.accepted(none, labels.limit(0)).count() == 0
    assert embeddings.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).count() == 0


def test_chunks_cover_a_batch_once():
    import pyarrow as pa

    batch = pa.RecordBatch.from_pydict({"text": pa.array([b"x" * n for n in (0, 5, 50, 1, 0, 9)], pa.binary())})
    parts = list(common.chunks(batch, size=10))
    assert [t for p in parts for t in p.column("text").to_pylist()] == batch.column("text").to_pylist()
    assert all(len(p) == 1 or sum(map(len, p.column("text").to_pylist())) <= 10 for p in parts)
