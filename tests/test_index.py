import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from tallgrass.operators import index

DOCS = [
    (0, "alpha beta alpha"),
    (1, "beta gamma"),
    (2, ""),
    (5, "alpha gamma gamma zeta"),
    (7, "delta alpha " + "x" * 100),
    (11, "zeta"),
]


@pytest.fixture
def docs(spark):
    return spark.createDataFrame(DOCS, "doc_id long, text string")


@pytest.fixture
def built(docs):
    return index.build_index(docs, docs_per_block=4)


def brute(term):
    return [(d, text.split().count(term)) for d, text in DOCS if term in text.split()]


def test_all_terms_and_documents_are_kept(built):
    by_term = {}
    for r in built.postings.orderBy("term", "block").collect():
        by_term.setdefault(r.term, []).extend((p.doc_id, p.tf) for p in r.postings)
        assert len(r.postings) <= 4 and all(p.doc_id // 4 == r.block for p in r.postings)
    terms = {w for _, text in DOCS for w in text.split()}
    assert by_term == {t: brute(t) for t in terms}
    assert {r.term: r.df for r in built.terms.collect()} == {t: len(brute(t)) for t in terms}


def test_gaps_decode_to_the_postings(built):
    encoded = index.gap_encode(built.postings)
    alpha = {r.block: [(g.gap, g.tf) for g in r.gaps] for r in encoded.filter("term = 'alpha'").collect()}
    assert alpha == {0: [(0, 2)], 1: [(5, 1), (2, 1)]}
    decoded = {tuple(r) for r in index.gap_decode(encoded).collect()}
    assert decoded == {tuple(r) for r in index.flat_postings(built.postings).collect()}


@pytest.mark.parametrize(
    "query, expected",
    [
        ("alpha", [0, 5, 7]),
        ("alpha gamma AND", [5]),
        ("beta zeta OR", [0, 1, 5, 11]),
        ("alpha gamma AND beta OR", [0, 1, 5]),
        ("alpha gamma beta OR AND", [0, 5]),
        ("absent alpha AND", []),
        ("absent alpha OR", [0, 5, 7]),
        ("alpha alpha AND", [0, 5, 7]),
        ("Alpha", []),
    ],
)
def test_boolean_search(built, query, expected):
    assert [r.doc_id for r in index.boolean_search(built, query).collect()] == expected


@pytest.mark.parametrize("query", ["", "alpha AND", "alpha beta", "alpha beta gamma AND"])
def test_bad_postfix_raises(built, query):
    with pytest.raises(ValueError):
        index.boolean_search(built, query)


def test_set_operations_give_the_same(built):
    with_alpha, with_gamma = index.docs_with(built, "alpha"), index.docs_with(built, "gamma")
    assert {r.doc_id for r in index.docs_and(with_alpha, with_gamma).collect()} == {5}
    assert {r.doc_id for r in index.docs_or(with_alpha, with_gamma).collect()} == {0, 1, 5, 7}


def test_snippets(built, docs):
    found = {r.doc_id: r.snippet for r in index.search_snippets(built, docs, "alpha zeta OR").collect()}
    assert found[11] == "zeta"
    assert found[7] == DOCS[4][1][:80] + "..."


def test_stored_index_is_read_by_term(spark, built, tmp_path):
    stored = index.save_index(built, str(tmp_path / "ix"), files=3)
    assert sorted(stored.terms.collect()) == sorted(built.terms.collect())
    assert [r.doc_id for r in index.boolean_search(stored, "alpha gamma AND").collect()] == [5]
    assert "EqualTo(term,alpha)" in plan_of(index.docs_with(stored, "alpha"))


def test_a_large_index_has_more_files(spark, tmp_path, monkeypatch):
    """What a task sorts stays the same; a small index keeps the number asked for."""
    words = F.array_join(F.transform(F.sequence(F.lit(0), F.lit(20)), lambda i: F.translate((F.col("id") * 7 + i).cast("string"), "0123456789", "abcdefghij")), " ")
    docs = spark.range(600).select(F.col("id").alias("doc_id"), words.alias("text"))
    built, files = index.build_index(docs, docs_per_block=64), {}
    for size in (index.FILE_BYTES, 1000):
        monkeypatch.setattr(index, "FILE_BYTES", size)
        stored = index.save_index(built, str(tmp_path / str(size)), files=3)
        files[size] = stored.postings.select(F.input_file_name().alias("f")).distinct().count()
        assert sorted(stored.terms.collect()) == sorted(built.terms.collect())
    assert files.pop(1000) > 6 and [*files.values()] == [3]
