"""Keyword search and cosine ranking over an :class:`Index`.

A batch of queries is a DataFrame ``(query_id bigint, query string)``. The
plan for a batch is: split the queries into words, attach each word's IDF (the
words are the small side of that join), write that word table, join it with
the postings, sum the per-word contributions per (query, document), and keep
the top k per query with a window whose group limit is applied before the
shuffle, so a query matching every document still moves only k rows per
partition. Whether the word table is broadcast is the planner's choice by its
written size; a stored index is also joined on the term's bucket, so the
folders that hold no query word are pruned when it is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quire.functions.scaling import (RANGE_MAX_START, RANGE_MIN_START, SCORE_DIGITS,
                                     minmax_scale, not_nan, ratio_or_nan)
from quire.functions.text import decode_path, query_words
from quire.operators.index import Index, term_bucket
from quire.operators.loop import RoundState
from quire.operators.numbering import running_extremes

# Result list length; digits used to compare scores for ties.
TOP_K = 10
TIE_DIGITS = 12
MODE_TF = "tf"
MODE_TFIDF = "tfidf"

def _mode(mode) -> str:
    """The reference takes 1 for TF and any other integer for TF-IDF."""
    if mode in (1, "1", MODE_TF):
        return MODE_TF
    return MODE_TFIDF


def query_terms(queries: DataFrame, analyze: bool = False) -> DataFrame:
    """``(query_id, pos, word)``; words are not lower-cased unless asked."""
    words = query_words("query")
    if analyze:
        words = F.transform(words, lambda w: F.lower(w))
    return queries.select("query_id", F.posexplode(words).alias("pos", "word"))


def _written(index: Index, words: DataFrame) -> tuple[DataFrame, list[str]]:
    """The word table as a written table, whose size the planner then knows, and
    the columns to join it with the postings on."""
    if "bucket" not in index.postings.columns:
        return RoundState(words.sparkSession, "query-words").settle(words), ["term"]
    words = RoundState(words.sparkSession, "query-words").settle(words.withColumn("bucket", term_bucket("term")))
    # the planner prunes folders at run time only for a filtered side
    return words.where(F.col("bucket") >= 0), ["bucket", "term"]


def unranked_search(index: Index, queries: DataFrame) -> DataFrame:
    """R2: for each word in order, each posting's document and URL (bag)."""
    words, keys = _written(index, query_terms(queries).withColumnRenamed("word", "term"))
    hits = words.join(index.postings, keys).select("query_id", "pos", F.col("term").alias("word"), "doc_id")
    return hits.join(index.docs, "doc_id").select(
        "query_id", "pos", "word", "doc_id", decode_path("path").alias("url"))


def known_words(index: Index, qt: DataFrame) -> DataFrame:
    """The distinct words of ``qt`` that the index has, with their statistics:
    few rows, so that words without any are found between two small sides."""
    return index.term_stats.join(qt.select(F.col("word").alias("term")).distinct(), "term").withColumnRenamed("term", "word")


def missing_keywords(index: Index, queries: DataFrame) -> DataFrame:
    """Query words with no postings, one row per occurrence."""
    qt = query_terms(queries)
    return qt.join(known_words(index, qt).select("word"), "word", "left_anti").select("query_id", "pos", "word")


def cosine_scores(index: Index, queries: DataFrame, mode="tfidf") -> DataFrame:
    """``(query_id, doc_id, cosine, first_pos)``.

    TF: sum over query words of ``tf / sqrt(sum tf^2)``. TF-IDF: sum of
    ``tf*idf / sqrt(sum (tf*idf)^2)``. The query norm is left out, as it is
    equal for all documents. Contributions are added in word order, as the
    reference does; ``first_pos`` is the first word that matched.
    """
    mode = _mode(mode)
    qt = query_terms(queries)
    # attach the IDF to the (few) query words first, then meet the postings
    qw = qt.join(known_words(index, qt).select("word", "idf"), "word").select("query_id", "pos", F.col("word").alias("term"), "idf")
    qw, keys = _written(index, qw)
    post = index.postings
    if mode == MODE_TF:
        weight, norm_col = F.col("tf").cast("double"), "tf_norm"
    else:
        weight, norm_col = F.col("tf") * F.col("idf"), "tfidf_norm"
    if norm_col in post.columns:
        # a stored index keeps each document's norms on its postings
        hits = qw.join(post.select(*keys, "doc_id", "tf", norm_col), keys)
    else:
        hits = qw.join(post, keys).join(index.doc_norms.select("doc_id", norm_col), "doc_id")
    hits = hits.select("query_id", "doc_id", "pos", ratio_or_nan(weight, F.col(norm_col)).alias("c"))
    parts = F.array_sort(F.collect_list(F.struct("pos", "c")))
    return hits.groupBy("query_id", "doc_id").agg(
        F.aggregate(parts, F.lit(0.0), lambda a, x: a + x["c"]).alias("cosine"),
        F.min("pos").alias("first_pos"))


def _extremes(scores: DataFrame) -> DataFrame:
    """Greatest and least score of each query, NaN skipped. It reads all columns of
    the scores, so that their shuffle is the same as the top list's, and shared."""
    value = F.when(F.col("first_pos").isNotNull(), not_nan("cosine"))
    return scores.groupBy("query_id").agg(F.max(value).alias("q_max"), F.min(value).alias("q_min"))


def score_range(scores: DataFrame) -> DataFrame:
    """Per query ``(query_id, max_score, min_score)``; NaN skipped; max
    starts at 0.0 and min at the largest double."""
    return _extremes(scores).select(
        "query_id",
        F.greatest(F.lit(RANGE_MAX_START), F.coalesce("q_max", F.lit(RANGE_MAX_START))).alias("max_score"),
        F.coalesce("q_min", F.lit(RANGE_MIN_START)).alias("min_score"))


def session_range(scores: DataFrame) -> DataFrame:
    """Running range over the batch in query order (the reference keeps
    max/min across queries), by range partitions of the query ids."""
    return running_extremes(_extremes(scores), "query_id", "q_max", "q_min").select(
        "query_id", F.greatest(F.lit(RANGE_MAX_START), F.coalesce("run_max", F.lit(RANGE_MAX_START))).alias("max_score"),
        F.coalesce("run_min", F.lit(RANGE_MIN_START)).alias("min_score"))


def order_key(score: str = "cosine") -> list[Column]:
    """Best first (NaN first, as Java orders it), ties by first matching
    word, then document id (the reference's insertion order)."""
    return [F.round(score, TIE_DIGITS).desc(), F.col("first_pos").asc(), F.col("doc_id").asc()]


def top_k(scores: DataFrame, k: int = TOP_K) -> DataFrame:
    """R10 for a batch: ``rank <= k`` per query (window group limit)."""
    w = Window.partitionBy("query_id").orderBy(*order_key())
    return scores.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def rank(index: Index, queries: DataFrame, mode="tfidf", k: int = TOP_K,
         normalize: str = "query") -> DataFrame:
    """Ranked search: ``(query_id, rank, doc_id, url, cosine, score)``.

    ``score`` is the min-max scaled cosine, half-up to 5 digits (R7);
    ``normalize="session"`` scales by the running range over the batch (R8).
    On a stored index the range and the top k read one shuffle of the scores by
    query and document; scores of an index that is not stored are written once.
    The URL is fetched after the limit, for k rows per query only.
    """
    scores = cosine_scores(index, queries, mode)
    if "bucket" not in index.postings.columns:
        scores = RoundState(queries.sparkSession, "scores").settle(scores)
    ranges = session_range(scores) if normalize == "session" else score_range(scores)
    best = top_k(scores, k).join(ranges, "query_id")
    best = best.join(index.docs, "doc_id", "left")
    return best.select(
        "query_id", "rank", "doc_id", decode_path("path").alias("url"), "cosine",
        minmax_scale("cosine", "min_score", "max_score", SCORE_DIGITS).alias("score"))
