import math

import pytest
from pyspark.sql import functions as F

from quire.functions.text import ENGLISH_STOP_WORDS, tokens, word_break_pattern
from quire.operators import blockmax
from quire.operators import index as ix
from quire.operators import rank as rk
from quire.operators.loop import RoundState


def approx(a, b, tol=1e-5):
    return abs(a - b) <= tol


@pytest.fixture(scope="module")
def idx(fixture_docs):
    return ix.build_index(fixture_docs)


def test_postings_and_df(idx):
    post = {(r.doc_id, r.term): r.tf for r in idx.postings.collect()}
    assert post[(0, "apple")] == 2 and post[(2, "date")] == 2 and post[(4, "banana")] == 1
    assert sum(post.values()) == 16  # token count
    stats = {r.term: (r.df, r.idf) for r in idx.term_stats.collect()}
    assert stats["apple"][0] == 3 and approx(stats["apple"][1], 0.510826)
    assert stats["date"][0] == 2 and approx(stats["date"][1], 0.916291)
    assert stats["fig"][0] == 1 and approx(stats["fig"][1], 1.609438)


def test_norms(idx):
    n = {r.doc_id: (r.tf_norm, r.tfidf_norm) for r in idx.doc_norms.collect()}
    for d, tfn, tin in [(0, 2.449490, 1.251262), (1, 1.732051, 1.166822), (2, 2.449490, 2.111608),
                        (3, 1.732051, 1.921151), (4, 1.414214, 0.722417)]:
        assert approx(n[d][0], tfn) and approx(n[d][1], tin)


def test_lowest_idf(idx):
    got = [(r.term, r.idf) for r in ix.lowest_idf_terms(idx.term_stats).collect()]
    assert got == [("apple", 0.510826), ("banana", 0.510826), ("cherry", 0.510826),
                   ("date", 0.916291), ("elder", 0.916291)]


def _ranked(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.doc_id, round(r.cosine, 6), r.score))
    return out


def test_rank_tf(idx, fixture_queries):
    got = _ranked(rk.rank(idx, fixture_queries, mode=1))
    assert got[0] == [(0, 0.816497, 1.0), (4, 0.707107, 0.73205), (2, 0.408248, 0.0)]
    assert got[1] == [(4, 1.414214, 1.0), (0, 1.224745, 0.81165), (1, 0.57735, 0.1681), (2, 0.408248, 0.0)]
    assert got[2] == [(3, 0.57735, 0.5)]
    assert 3 not in got


def test_rank_tfidf(idx, fixture_queries):
    got = _ranked(rk.rank(idx, fixture_queries, mode=2))
    assert got[0] == [(0, 0.816497, 1.0), (4, 0.707107, 0.80962), (2, 0.241913, 0.0)]
    assert got[1] == [(4, 1.414214, 1.0), (0, 1.224745, 0.83838), (1, 0.437792, 0.16709), (2, 0.241913, 0.0)]
    assert got[2] == [(3, 0.837747, 0.5)]


def test_session_scaling(idx, fixture_queries):
    tf = _ranked(rk.rank(idx, fixture_queries, mode=1, normalize="session"))
    ti = _ranked(rk.rank(idx, fixture_queries, mode=2, normalize="session"))
    assert tf[2] == [(3, 0.57735, 0.1681)]
    assert ti[2] == [(3, 0.837747, 0.50826)]
    assert tf[0][1][2] == 0.73205 and ti[1][2][2] == 0.16709


def test_missing_keywords(idx, fixture_queries):
    got = sorted((r.query_id, r.pos, r.word) for r in rk.missing_keywords(idx, fixture_queries).collect())
    assert got == [(3, 0, "Apple"), (3, 1, "kiwi")]


def test_query_split(spark):
    q = spark.createDataFrame([(0, " a  b "), (1, ""), (2, "   "), (3, "x\ty")], "query_id bigint, query string")
    got = {}
    for r in rk.query_terms(q).collect():
        got.setdefault(r.query_id, []).append(r.word)
    assert got[0] == ["", "a", "b"] and got[1] == [""] and 2 not in got and got[3] == ["x", "y"]


def test_unranked(idx, fixture_queries):
    rows = rk.unranked_search(idx, fixture_queries).orderBy("query_id", "pos", "doc_id").collect()
    assert [(r.query_id, r.doc_id) for r in rows if r.query_id == 1] == [(1, 0), (1, 2), (1, 4), (1, 0), (1, 1), (1, 4)]
    assert rows[0].url == "www.example.edu/d0.html"


def test_nan_norm_sorts_first(spark):
    # doc 0 holds only a word that is in every doc: TF-IDF norm 0 -> NaN score
    docs = spark.createDataFrame([(0, "p", "the"), (1, "p", "the cat"), (2, "p", "the dog dog")],
                                 "doc_id bigint, path string, text string")
    q = spark.createDataFrame([(0, "the cat")], "query_id bigint, query string")
    got = rk.rank(ix.build_index(docs), q, mode=2).orderBy("rank").collect()
    assert got[0].doc_id == 0 and math.isnan(got[0].cosine) and got[0].score == 0.0
    assert [r.doc_id for r in got] == [0, 1, 2]


def test_audit_and_slice(spark, idx, fixture_docs):
    a = ix.doc_id_audit(fixture_docs).collect()[0]
    assert (a.n_docs, a.missing_ids, a.complete) == (5, 0, True)
    holes = fixture_docs.filter("doc_id != 2")
    assert ix.doc_id_audit(holes).collect()[0].missing_ids == 1
    assert [r.doc_id for r in ix.missing_doc_ids(holes).collect()] == [2]
    sl = ix.vocabulary_slice(idx.postings, offset=2, size=3).collect()
    assert [(r.ordinal, r.term) for r in sl] == [(2, "cherry"), (3, "date"), (4, "elder")]


def test_stop_words(spark, fixture_queries):
    docs = spark.createDataFrame([(0, "p", "the cat and the dog"), (1, "p", "the the"), (2, "p", "a dog")],
                                 "doc_id bigint, path string, text string")
    index = ix.build_index(docs, stop_words=ENGLISH_STOP_WORDS)
    assert {(r.doc_id, r.term) for r in index.postings.collect()} == {(0, "cat"), (0, "dog"), (2, "dog")}
    q = spark.createDataFrame([(0, "the"), (1, "dog the")], "query_id bigint, query string")
    assert {(r.query_id, r.doc_id) for r in rk.rank(index, q).collect()} == {(1, 0), (1, 2)}
    assert index.docs.select(index.n_docs.alias("n")).first().n == 3


def test_terms_of_other_fields(spark, idx):
    terms = spark.createDataFrame([("fig",), ("www.example.edu",)], "term string")
    got = {r.term: r.idf for r in ix.term_idf_with_missing(terms, idx.term_stats).collect()}
    assert approx(got["fig"], 1.609438) and got["www.example.edu"] == -1.0


def test_session_range_on_sparse_ids(spark):
    ids = [5, 10**6, 10**9, 3 * 10**9, 10**15]
    scores = spark.createDataFrame([(q, float(i % 3), 0) for i, q in enumerate(ids)], "query_id bigint, cosine double, first_pos int")
    got = {r.query_id: (r.max_score, r.min_score) for r in rk.session_range(scores.repartition(4)).collect()}
    assert got == {5: (0.0, 0.0), 10**6: (1.0, 0.0), 10**9: (2.0, 0.0), 3 * 10**9: (2.0, 0.0), 10**15: (2.0, 0.0)}


def test_plans_read_the_corpus_once(spark, idx, fixture_queries):
    ranked = rk.rank(idx, fixture_queries)._jdf.queryExecution().toString()
    assert "regexp_extract_all" not in ranked  # tokenised before, into a written table
    norms = ix.tf_norms(idx.postings)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in norms


@pytest.mark.parametrize("text, want", [
    ("The quick (\u201cbrown\u201d) fox can\u2019t jump 32.3 feet, right?", "the quick brown fox can\u2019t jump 32.3 feet right"),
    ("don't 'quoted' O'Neil's", "don't quoted o'neil's"),
    ("example.org. www.example.org/a:b c:", "example.org www.example.org a:b c"),
    ("3.14 1,234.5 3. .5 1;2 a,b a;b", "3.14 1,234.5 3 5 1;2 a b a b"),
    ("a.1 1.a a1.b2 x2y 2nd", "a 1 1 a a1 b2 x2y 2nd"),
    ("snake_case _x __ A_b_3 _", "snake_case _x a_b_3"),
    ("\u5b57\u5178a \u3072\u3089 \u30ab\u30bf \u0915\u093f", "\u5b57 \u5178 a \u3072 \u3089 \u30ab\u30bf \u0915\u093f"),
    ("", ""), ("...", ""),
])
def test_word_breaks_of_the_analyzer(spark, text, want):
    df = spark.createDataFrame([(text,)], "text string")
    assert df.select(tokens("text", word_break_pattern()).alias("t")).first().t == want.split()


def test_large_vocabulary_leaves_the_postings_in_place(spark, fixture_docs):
    """No table of terms is small enough for the planner: the frequent terms still come to the postings."""
    index = ix.build_index(fixture_docs)
    loop = RoundState(spark, "stats")
    stats = loop.settle(index.term_stats)
    want = {r.doc_id: round(r.tfidf_norm, 12) for r in ix.tfidf_norms(index.postings, stats).collect()}
    post = loop.settle(index.postings.join(index.doc_norms, "doc_id").withColumn("bucket", ix.term_bucket("term")))
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    kept = {k: spark.conf.get(k) for k in keys}
    try:
        for k in keys:
            spark.conf.set(k, "-1")
        for frequent in (0, 2, 100):
            got = ix.stored_tfidf_norms(post.select("doc_id", "term", "tf"), stats, frequent)
            assert {r.doc_id: round(r.tfidf_norm, 12) for r in got.collect()} == want
        maxima = blockmax.block_maxima(post, stats, 2, 2)
        assert "SortMergeJoin" not in maxima._jdf.queryExecution().executedPlan().toString()
        assert {r.term for r in maxima.collect()} == {"apple", "banana", "cherry", "date", "elder"}
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)
