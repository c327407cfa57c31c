"""Block-max pruning against ranking all scores."""
import random
import tempfile

import pytest
from pyspark.sql import functions as F

from quire.operators import blockmax
from quire.operators import graph as gr
from quire.operators import index as ix
from quire.operators import rank as rk
from quire.sources.files import read_index, write_index


def stored(spark, docs, block_docs, min_df):
    out = tempfile.mkdtemp(prefix="quire-block-")
    write_index(ix.build_index(docs), out, block_docs, min_df)
    return read_index(spark, out)


@pytest.fixture(scope="module")
def small(spark):
    rnd = random.Random(11)
    words = [f"w{i}" for i in range(40)]
    texts = [" ".join(["the"] * rnd.randint(0, 5) + rnd.choices(words, weights=range(40, 0, -1), k=rnd.randint(0, 25))) for _ in range(400)]
    texts += ["all all", "all"] + ["the"] * 30  # equal scores
    docs = spark.createDataFrame([(i, f"p{i}", t) for i, t in enumerate(texts)], "doc_id bigint, path string, text string")
    return stored(spark, docs, 16, 40)


@pytest.mark.parametrize("mode", ["tf", "tfidf"])
@pytest.mark.parametrize("size", [1, 11, 500])
def test_equal_to_ranking_all(spark, small, mode, size):
    queries = spark.createDataFrame(list(enumerate(["the", "the w1 w1 the", "w39 the", "all nothere", "nothere", "w5 w6 w7", "The", ""])),
                                    "query_id bigint, query string")
    want = gr.root_set(rk.cosine_scores(small, queries, mode), size).collect()
    got = blockmax.root_set(small, queries, mode, size).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want)) and len(got) >= size


def test_a_term_of_every_document_gives_no_numbers(spark):
    """IDF 0: documents of such terms only have norm 0 and the score NaN, which comes first."""
    docs = spark.createDataFrame([(i, "p", "same same" if i % 7 else "same other") for i in range(100)], "doc_id bigint, path string, text string")
    index = stored(spark, docs, 4, 10)
    queries = spark.createDataFrame([(0, "same other"), (1, "other")], "query_id bigint, query string")
    want = gr.root_set(rk.cosine_scores(index, queries), 11).collect()
    assert sorted(map(tuple, blockmax.root_set(index, queries).collect())) == sorted(map(tuple, want))


def test_a_word_of_most_documents_is_read_in_part(spark):
    """The best documents of a word of all documents lie in a few blocks: the others' postings are not read."""
    n = 60_000
    rest = F.array_join(F.transform(F.sequence(F.lit(1), F.when(F.col("id") % 9000 == 17, 1).otherwise(8)),
                                    lambda k: F.concat(F.lit("x"), (F.col("id") * 8 + k).cast("string"))), " ")
    docs = spark.range(n).where("id <> 5").select(F.col("id").alias("doc_id"), F.lit("p").alias("path"), F.concat(F.lit("often "), rest).alias("text"))
    index = stored(spark, docs, 1024, 4096)
    queries = spark.createDataFrame([(0, "often")], "query_id bigint, query string")
    words = rk.query_terms(queries).select("query_id", "pos", F.col("word").alias("term")).join(index.term_stats, "term").withColumn("bucket", ix.term_bucket("term"))
    kept = blockmax.pruned_blocks(index, words, "tf", 6)
    assert kept.count() < index.block_max.count() / 3
    scores = blockmax._scores(blockmax._of_words(index, words), words, "tf", kept)
    scores.collect()

    def rows(node):
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            return rows(node.executedPlan())
        if "QueryStage" in node.getClass().getSimpleName():
            return rows(node.plan())
        own = node.metrics().get("numOutputRows").get().value() if name.startswith("Scan parquet") and "tf_norm" in node.schema().fieldNames() else 0
        kids = node.children()
        return own + sum(rows(kids.apply(i)) for i in range(kids.size()))

    read = rows(scores._jdf.queryExecution().executedPlan())
    assert 0 < read < n / 3
    want = gr.root_set(rk.cosine_scores(index, queries, "tf"), 6).collect()
    assert sorted(map(tuple, blockmax.root_set(index, queries, "tf", 6).collect())) == sorted(map(tuple, want))
