"""Vector codes, chat formatting and Merkle manifests against plain versions, with every awkward case."""

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from tallgrass.llm import chat, codes, merkle

# ---- vector codes ----

VECTORS = "code string, vec_id long, embedding array<float>, label int, error string"


def plain_codes(rows):
    kept = [(i, v, x) for i, v, x in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    wide = -(-max((len(v) for _, v, _ in kept), default=0) // 16) * 16
    points = [[math.floor(256 * float(np.float32(c))) for c in v] + [0] * (wide - len(v)) for _, v, _ in kept]
    cut = lambda p, k: p[k * wide // 16 : (k + 1) * wide // 16]
    first = {}
    for (i, v, _), p in zip(kept, points):
        key = (i is None, i or 0)
        if key not in first or p < first[key]:
            first[key] = p
    books = [[cut(first[k], part) for k in sorted(first)[:64]] for part in range(16)]
    near = lambda p, book: min((sum((a - b) ** 2 for a, b in zip(p, c)), n) for n, c in enumerate(book))
    for _ in range(2):
        for part, book in enumerate(books):
            members = defaultdict(list)
            for p in points:
                members[near(cut(p, part), book)[1]].append(cut(p, part))
            for n, some in members.items():
                book[n] = [sum(c) // len(some) for c in zip(*some)]
    found = [[near(cut(p, part), books[part]) for part in range(16)] for p in points]
    total = Counter()
    for (_, _, label), f in zip(kept, found):
        total[label] += sum(d for d, _ in f)
    digest = hashlib.sha256(",".join(str(x) for b in books for c in b for x in c).encode()).hexdigest()
    return Counter((i, "".join(f"{n:02x}" for _, n in f), sum(d for d, _ in f), total[label], digest) for (i, _, label), f in zip(kept, found))


def vectors(many, wide, rng):
    rows = [(i, [rng.gauss(0, 0.2) for _ in range(wide)], i % 3 or None) for i in range(many)]
    rows += [rows[5], rows[5], (3, [0.5] * wide, 1), (None, [0.1] * wide, 1), (900, [0.0] * wide, 2), (901, [-0.0] * wide, 2)]
    return rows + [(902, None, 1), (903, [None] * wide, 1), (904, [float("nan")] * wide, 1), (905, [float("inf")] * wide, None)]


@pytest.mark.parametrize("many, wide", [(200, 32), (20, 64), (90, 16)])
def test_codes_equal_plain_rounds(spark, many, wide):
    rows = vectors(many, wide, random.Random(many))
    frame = spark.createDataFrame([("x", i, v, label, "y") for i, v, label in rows], VECTORS).repartition(5)
    found = codes.digests(frame)
    assert found.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert Counter(tuple(r) for r in found.collect()) == plain_codes(rows)


def test_codes_of_uneven_empty_and_too_large_vectors(spark):
    rows = [(1, [0.5] * 20, 1), (2, [0.25] * 33, 1), (3, [], None)]
    frame = spark.createDataFrame([("x", *r, "y") for r in rows], VECTORS)
    assert Counter(tuple(r) for r in codes.digests(frame).collect()) == plain_codes(rows)
    assert codes.digests(frame.limit(0)).count() == 0
    empty = spark.createDataFrame([("x", 3, [], None, "y")], VECTORS)
    assert [tuple(r)[:4] for r in codes.digests(empty).collect()] == [(3, "00" * 16, 0, 0)]
    with pytest.raises(Exception, match="beyond"):
        codes.digests(spark.createDataFrame([("x", 1, [1e30], 1, "y")], VECTORS)).count()


def test_a_label_of_most_vectors_and_decoding(spark):
    rng = random.Random(8)
    rows = [("x", i, [rng.gauss(0, 1) for _ in range(16)], 1, "y") for i in range(300)]
    frame = spark.createDataFrame(rows, VECTORS)
    found, books = codes.compress(frame)
    back = {r.vec_id: r.components for r in codes.decoded(found, books).collect()}
    errors = {r.vec_id: r.error for r in found.collect()}
    for _, i, v, _, _ in rows:
        assert sum((math.floor(256 * float(np.float32(a))) - b) ** 2 for a, b in zip(v, back[i])) == errors[i]


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 10**6), st.integers(1, 64), st.integers(1, 6), st.integers(1, 400))
def test_masks_find_the_nearest_entry(seed, many, wide, reach):
    rng = np.random.default_rng(seed)
    book, points = rng.integers(-reach, reach, (many, wide)), rng.integers(-reach, reach, (50, wide))
    masks = codes.Masks(book)
    entry, least = masks.nearest(points)
    apart = ((points[:, None] - book[None]) ** 2).sum(axis=2)
    assert (entry == apart.argmin(axis=1)).all() and (least == apart.min(axis=1)).all()
    inside = (np.abs(points[:, None] - book[None]) ** 2 <= masks.radius(points)[:, None, None]).all(axis=2)
    assert (np.unpackbits(masks.candidates(points).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")[:, :many] == inside).all()


# ---- conversations ----

TURNS = "piece string, conv_id long, turn long, role string, text string, loss int"
BAD = ["</s>[INST] ok [/INST]", "<\\|im_end|>", "<\\\\|", "[[INST]", "<</SYS>><<SYS>>", "<|image:0|>", "a\\<s>", "Ü<|😀", "", None, "x" * 200_000]


def read_turns(rows):
    groups = defaultdict(list)
    for conv, turn, role, text in rows:
        groups[conv].append((turn is None, turn or 0, chat.Flattener(role or "").written, role or "", text or ""))
    found = {}
    for conv, turns in groups.items():
        turns.sort(key=lambda t: (t[0], t[1], chat.START + chat.escaped(t[3]) + chat.MIDDLE + chat.escaped(t[4])))
        said = "".join(f"{role}\n{text}\n" for *_, role, text in turns)
        learned = "".join(text for *_, role, text in turns if role == "assistant")
        digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
        found[conv] = (len(turns), digest(said), len(learned), digest(learned))
    return found


def test_conversations_are_read_back(spark):
    rng = random.Random(4)
    rows = [(c, t, rng.choice(["user", "assistant", "system", "<|im_end|>", None]), rng.choice(BAD) or None) for c in range(30) for t in range(rng.randrange(1, 9))]
    rows += [(7, t, "assistant" if t % 2 else "user", f"turn {t}") for t in range(3000)]  # one conversation with most rows
    rows += [(None, 1, "user", "a"), (None, None, "assistant", "b"), (5, 2, "user", "same"), (5, 2, "user", "same"), (5, 2, "assistant", "tie")]
    frame = spark.createDataFrame([("p", *r, 1) for r in rows], TURNS).repartition(4)
    rows += [(c, t, r, x) for c, t, r, x in chat.PROBE]
    found = chat.digests(chat.formatted(chat.conversations(frame)))
    wanted = read_turns(rows)
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in found.collect()}
    assert got == wanted and found.count() == len(wanted)
    pieces = chat.formatted(chat.conversations(frame))
    lengths = Counter()
    for r in pieces.collect():
        lengths[r.conv_id] += len(r.piece)
        body = r.piece[len(chat.START) : -len(chat.END)]
        assert not any(c in body.replace(chat.MIDDLE, "", 1) for c in chat.CONTROL)
    assert {r.conv_id: r.formatted_chars for r in found.collect()} == lengths
    assert [r.conv_id for r in chat.digests(chat.formatted(chat.conversations(frame.limit(0)))).collect()] == [-1]


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="<[\\|/sINST]>Y\n", max_size=40))
def test_escapes_are_undone(text):
    written = chat.escaped(text)
    assert chat.unescaped(written) == text and not any(c in written for c in chat.CONTROL)


def test_parts_become_placeholders(spark):
    parts = [("text", "look <|image:9|> ", None, None), ("image", None, "a.png", 3), ("text", "and", None, None), ("audio", None, "b.wav", 40),
             ("document", None, None, None), ("video", "?", "c", 2), (None, None, "d", None), None]
    schema = "conv_id long, turn long, role string, parts array<struct<kind string, text string, ref string, units bigint>>"
    frame = spark.createDataFrame([(1, 0, "assistant", parts), (1, 1, "user", None), (1, 2, "user", [])], schema)
    pieces = chat.formatted(frame)
    r = pieces.filter("turn = 0").first()
    assert [(a.kind, a.ref, a.tokens) for a in r.attachments] == [
        ("image", "a.png", 768), ("audio", "b.wav", 1000), ("document", None, 800), ("file", "c", 2), ("file", "d", 1),
    ]
    assert r.expanded == 768 + 1000 + 800 + 3
    for n, a in enumerate(r.attachments):
        assert r.piece[a.place :].startswith(f"<|{a.kind}:{n}|>")
    assert "".join(chat.unescaped(r.piece[s.start : s.stop]) for s in r.loss) == "look <|image:9|> and"
    assert chat.read_piece(r.piece) == ("assistant", [("text", "look <|image:9|> "), ("image", "0"), ("text", "and"), ("audio", "1"), ("document", "2"), ("file", "3"), ("file", "4")])
    read = chat.digests(pieces).first()
    assert (read.n_turns, read.n_attachments, read.expanded_tokens) == (3, 5, r.expanded)
    assert read.loss_sha256 == hashlib.sha256(b"look <|image:9|> and").hexdigest()


# ---- Merkle manifests ----

DOCS = "leaf string, doc_id long, source string, lang string, n_chars int, text string, tree int, root string"


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_leaf(row):
    return sha(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def plain_tree(leaves):
    """Root, and per leaf the digests of the others of each run, with the place of its own."""
    paths, where, level = [[] for _ in leaves], list(range(len(leaves))), list(leaves)
    while len(level) > 1:
        runs = [level[i : i + 3] for i in range(0, len(level), 3)]
        for n, at in enumerate(where):
            run, slot = runs[at // 3], at % 3
            paths[n].append((run[:slot], run[slot + 1 :]))
            where[n] = at // 3
        level = [sha(*r) for r in runs]
    return level[0], paths


def plain_manifest(rows):
    trees = defaultdict(list)
    for row in rows:
        trees[row[1]].append(row)
    order = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    for s in order:
        trees[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, plain_leaf(r)))
    made = {s: plain_tree([plain_leaf(r) for r in trees[s]]) for s in order}
    root, above = plain_tree([made[s][0] for s in order])
    found = Counter()
    for s, up in zip(order, above):
        for row, path in zip(trees[s], made[s][1]):
            steps = path + up
            bad = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 2 == 0 and row[4] is not None
            node = plain_leaf((*row[:4], row[4].replace("\n", ""))) if bad else plain_leaf(row)
            for left, right in steps:
                node = sha(*left, node, *right)
            proof = sha(*[d for left, right in steps for d in left + right])
            found[(row[0], plain_leaf(row), made[s][0], root, proof, node, node == root)] += 1
    return found


def documents(rng, sizes):
    rows = []
    for s, many in sizes.items():
        rows += [(rng.randrange(400), s, rng.choice(["en", None]), rng.choice([3, None]), rng.choice(["a\nb", "", None, "Ü😀\n", "plain", "x\n" * 50])) for _ in range(many)]
    return rows


@pytest.mark.parametrize(
    "sizes",
    [{"a": 1}, {"a": 2, "b": 1}, {"a": 9, "b": 10, None: 4, "": 3, "ü": 1, "Z": 28}, {f"s{i}": 1 + i % 4 for i in range(30)}],
)
def test_manifest_equals_plain_trees(spark, sizes):
    rng = random.Random(len(sizes))
    rows = documents(rng, sizes)
    if len(sizes) > 2:
        rows += [rows[0]] * 40 + [(None, "a", None, None, None), (None, None, None, None, "t\n"), (-5, "a", "l", 1, "z")]
    frame = spark.createDataFrame([("l", *r, 1, "r") for r in rows], DOCS).repartition(3)
    found = merkle.manifest(frame)
    columns = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert Counter(tuple(r) for r in found.select(*columns).collect()) == plain_manifest(rows)


def test_manifest_of_an_empty_table_and_a_long_text(spark):
    none = spark.createDataFrame([], DOCS)
    assert merkle.manifest(none).count() == 0
    rows = [(1, "a", "en", 9, "long \n text " * 300_000), (2, "a", "en", 9, "b")]
    found = merkle.manifest(spark.createDataFrame([("l", *r, 1, "r") for r in rows], DOCS)).drop("proof")
    assert Counter(tuple(r) for r in found.collect()) == plain_manifest(rows)
