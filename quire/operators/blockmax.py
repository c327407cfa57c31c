"""Top documents by cosine with block-max pruning (L4, R10 on a stored index).

Documents are dealt into blocks of consecutive ids. For every term of many
documents the index keeps, for each block, the largest share that the term adds
to a score there. A block's bound for a query is the sum over its words, so
no document of the block scores higher. The blocks of the best bounds are
scored first; the score that the last wanted document reaches there prunes
all blocks with a lower bound before the postings are read again.

Rare terms have no block maxima: their few postings give the bounds. Where the
remaining blocks form few ranges of ids, these are pushed to the scan, which
then skips the pages of hot terms outside them.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quire.functions.scaling import ratio_or_nan
from quire.operators.index import FREQUENT_TERMS, Index, term_bucket
from quire.operators.loop import RoundState
from quire.operators.rank import MODE_TF, _mode, known_words, order_key, query_terms

#: Documents of a block, and the least document frequency of a term with block maxima.
BLOCK_DOCS = 1024
MIN_DF = 16 * BLOCK_DOCS
#: Ranges of ids that are pushed to the scan; beyond, the join alone prunes.
MAX_RANGES = 100
#: Words of a batch that are pushed to the scan.
MAX_WORDS = 100
#: Bounds are sums in another order than scores: what they may differ by.
SLACK = 1e-9


def block_of(doc_id, block_docs: int) -> Column:
    return F.floor(F.col(doc_id) / block_docs).cast("long")


def _share(mode: str, idf: str = "idf") -> Column:
    """What one posting adds to a document's score."""
    if mode == MODE_TF:
        return ratio_or_nan(F.col("tf").cast("double"), F.col("tf_norm"))
    return ratio_or_nan(F.col("tf") * F.col(idf), F.col("tfidf_norm"))


def block_maxima(post: DataFrame, stats: DataFrame, block_docs: int = BLOCK_DOCS, min_df: int = MIN_DF) -> DataFrame:
    """``(bucket, term, block, tf_max, tfidf_max)`` for terms of at least ``min_df``
    documents, from stored postings; partly maximised before the shuffle. These
    terms are few beside the vocabulary: up to ``FREQUENT_TERMS``, they come to the
    postings, which the planner would else shuffle by what the whole table weighs."""
    often = stats.where(F.col("df") >= min_df).select("term", "idf", term_bucket("term").alias("bucket"))
    if often.count() <= FREQUENT_TERMS:
        often = F.broadcast(often)
    return (post.join(often, ["bucket", "term"]).withColumn("block", block_of("doc_id", block_docs))
            .groupBy("bucket", "term", "block").agg(F.max(_share(MODE_TF)).alias("tf_max"), F.max(_share("tfidf")).alias("tfidf_max")))


def _of_words(index: Index, words: DataFrame) -> Index:
    """The index with the postings of a batch's words only: a filter that prunes
    folders and is pushed to the scan, if the batch has few words."""
    few = [(r.bucket, r.term) for r in words.select("bucket", "term").distinct().limit(MAX_WORDS + 1).collect()]
    if len(few) > MAX_WORDS:
        return index
    buckets, terms = sorted({b for b, _ in few}), sorted({t for _, t in few})
    return replace(index, postings=index.postings.where(F.col("bucket").isin(buckets) & F.col("term").isin(terms)))


def _scores(index: Index, words: DataFrame, mode: str, blocks: DataFrame) -> DataFrame:
    """R3/R4 for the documents of ``blocks (query_id, block)`` only."""
    post = index.postings
    ids = [r.block for r in blocks.select("block").distinct().orderBy("block").limit(MAX_RANGES * 8 + 1).collect()]
    if len(ids) <= MAX_RANGES * 8:
        ranges: list[list[int]] = []
        for b in ids:
            if ranges and ranges[-1][1] == b:
                ranges[-1][1] = b + 1
            else:
                ranges.append([b, b + 1])
        if len(ranges) <= MAX_RANGES:
            size = index.block_docs
            here = F.lit(False)
            for lo, hi in ranges:
                here = here | ((F.col("doc_id") >= lo * size) & (F.col("doc_id") < hi * size))
            post = post.where(here)
    own = words.where(F.col("bucket") >= 0).join(post, ["bucket", "term"]).withColumn("block", block_of("doc_id", index.block_docs))
    own = own.join(blocks, ["query_id", "block"], "left_semi").select("query_id", "doc_id", "pos", _share(mode).alias("c"))
    parts = F.array_sort(F.collect_list(F.struct("pos", "c")))
    return own.groupBy("query_id", "doc_id").agg(
        F.aggregate(parts, F.lit(0.0), lambda a, x: a + x["c"]).alias("cosine"), F.min("pos").alias("first_pos"))


def _best(scores: DataFrame, size: int) -> DataFrame:
    w = Window.partitionBy("query_id").orderBy(*order_key())
    return scores.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= size)


def pruned_blocks(index: Index, words: DataFrame, mode: str, size: int) -> DataFrame:
    """``(query_id, block)``: the blocks that may hold one of the ``size`` best documents."""
    loop = RoundState(index.postings.sparkSession, "block-max")
    top = "tf_max" if mode == MODE_TF else "tfidf_max"
    often = (words.where(F.col("bucket") >= 0).join(index.block_max, ["bucket", "term"]).select("query_id", "pos", "block", F.col(top).alias("most")))
    rare = words.where(F.col("df") < index.block_min_df).join(index.postings, ["bucket", "term"])
    rare = rare.groupBy("query_id", "pos", block_of("doc_id", index.block_docs).alias("block")).agg(F.max(_share(mode)).alias("most"))
    bounds = loop.settle(often.unionByName(rare).groupBy("query_id", "block").agg(F.sum("most").alias("bound")))
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("bound"), "block"))
    first = loop.settle(bounds.withColumn("place", place).where(F.col("place") <= size).select("query_id", "block"))
    reached = _best(_scores(index, words, mode, first), size).groupBy("query_id").agg(F.count(F.lit(1)).alias("n"), F.min("cosine").alias("least"))
    enough = reached.where(F.col("n") == size).select("query_id", "least")
    kept = bounds.join(enough, "query_id", "left").where(
        F.col("least").isNull() | F.isnan("least") & F.isnan("bound") | ~F.isnan("least") & (F.col("bound") >= F.col("least") - SLACK * (1 + F.abs("least"))))
    return loop.settle(kept.select("query_id", "block"))


def top_documents(index: Index, queries: DataFrame, mode="tfidf", size: int = 11) -> DataFrame:
    """The ``size`` best documents of each query: ``(query_id, doc_id, cosine,
    first_pos, rank)``, the same as ranking all scores. Needs a stored index."""
    if index.block_max is None:
        raise ValueError("block-max pruning needs an index that has been written")
    mode = _mode(mode)
    qt = query_terms(queries)
    words = qt.join(known_words(index, qt).select("word", "df", "idf"), "word").select("query_id", "pos", F.col("word").alias("term"), "df", "idf")
    words = RoundState(queries.sparkSession, "query-words").settle(words.withColumn("bucket", term_bucket("term")))
    index = _of_words(index, words)
    return _best(_scores(index, words, mode, pruned_blocks(index, words, mode, size)), size)


def root_set(index: Index, queries: DataFrame, mode="tfidf", size: int = 11) -> DataFrame:
    """L4 on a stored index: ``(query_id, node, root_rank)``."""
    return top_documents(index, queries, mode, size).select("query_id", F.col("doc_id").alias("node"), F.col("rank").alias("root_rank"))
