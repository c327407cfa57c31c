"""Inverted index and term/document statistics.

Postings are counted inside each document's row: the token array is sorted
and its runs are measured, so building the postings needs no shuffle at all.
Statistics that cross documents (document frequency, TF-IDF norms) are
group-bys with partial aggregation; the one join by term that TF-IDF norms
need is left to the adaptive planner, which broadcasts the term table when
its runtime size allows and splits skewed term partitions otherwise.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.functions.scaling import IDF_DIGITS
from quire.functions.text import TOKEN_PATTERN, decode_path, tokens
from quire.operators.loop import RoundState
from quire.operators.numbering import dense_ids

# IDF of a term seen only in another field; the terms printed by
# the vocabulary slice (0-based 100001..100010); the five lowest IDF words.
MISSING_TERM_IDF = -1.0
VOCAB_SLICE_OFFSET = 100001
VOCAB_SLICE_SIZE = 10
LOWEST_IDF_COUNT = 5


def doc_terms(docs: DataFrame, text_col: str = "text", pattern: str = TOKEN_PATTERN,
              stop_words: list[str] | None = None, keep: list[str] | None = None) -> DataFrame:
    """One row per document: ``(doc_id, terms array<struct<term, tf>>)`` and the
    columns to ``keep``.

    Postings are counted inside each document's row, so no shuffle is needed:
    sort the tokens, mark where each run of equal tokens starts, and take the
    distance to the next start as the count (linear after the sort). Each
    array is a column of its own projection, so the lambdas read it instead
    of re-evaluating it per element. ``stop_words`` (a short literal list) are
    removed from each token array.
    """
    toks = tokens(text_col, pattern)
    if stop_words:
        toks = F.filter(toks, lambda t: ~t.isin(list(stop_words)))
    kept = keep or []
    s, n, st = F.col("_s"), F.col("_n"), F.col("_st")
    step1 = docs.select("doc_id", *kept, F.sort_array(toks).alias("_s"))
    step2 = step1.select("doc_id", *kept, "_s", F.size("_s").alias("_n"))
    step3 = step2.select("doc_id", *kept, "_s", "_n", F.filter(
        F.sequence(F.lit(1), F.greatest(n, F.lit(1))),
        lambda i: (n > 0) & ((i == 1) | (F.element_at(s, i) != F.element_at(s, i - 1)))).alias("_st"))
    return step3.select("doc_id", *kept, F.transform(st, lambda x, k: F.struct(
        F.element_at(s, x).alias("term"),
        (F.coalesce(F.try_element_at(st, k + 2), n + 1) - x).cast("long").alias("tf"))).alias("terms"))


def explode_terms(dt: DataFrame) -> DataFrame:
    """``(doc_id, term, tf)`` rows from per-document term arrays.

    ``inline_outer`` plus a null filter above it: the plain generator would
    get an inferred ``size(terms) > 0`` filter pushed under the projections,
    re-evaluating the tokeniser there.
    """
    return dt.select("doc_id", F.inline_outer("terms")).filter(F.col("term").isNotNull())


def postings(docs: DataFrame, text_col: str = "text", pattern: str = TOKEN_PATTERN,
             stop_words: list[str] | None = None) -> DataFrame:
    """``(doc_id, term, tf)``, one row per document and term."""
    return explode_terms(doc_terms(docs, text_col, pattern, stop_words))


def corpus_size(docs: DataFrame) -> Column:
    """Number of documents (with or without tokens) as a scalar column."""
    return docs.agg(F.count(F.lit(1))).scalar()


def vocabulary(post: DataFrame) -> DataFrame:
    """T4: distinct terms (order with ``orderBy('term')`` where needed)."""
    return post.select("term").distinct()


def vocabulary_slice(post: DataFrame, offset: int = VOCAB_SLICE_OFFSET,
                     size: int = VOCAB_SLICE_SIZE) -> DataFrame:
    """T5: terms ``offset .. offset+size-1`` of the sorted vocabulary.

    The vocabulary is numbered by range partitions and filtered by number, so
    an offset deep in a large vocabulary costs no task more than its range.
    """
    numbered = dense_ids(vocabulary(post), ["term"], id_col="ordinal")
    return numbered.where(F.col("ordinal").between(offset, offset + size - 1)).select("ordinal", "term")


def document_frequency(post: DataFrame) -> DataFrame:
    """``(term, df)``; postings are unique per (doc, term)."""
    return post.groupBy("term").agg(F.count(F.lit(1)).alias("df"))


def term_stats(post: DataFrame, n_docs: Column) -> DataFrame:
    """``(term, df, idf)``, ``idf = ln(N / df)`` with no smoothing."""
    return document_frequency(post).select(
        "term", "df", F.ln(n_docs.cast("double") / F.col("df").cast("double")).alias("idf"))


def term_idf_with_missing(terms: DataFrame, stats: DataFrame) -> DataFrame:
    """T11 for an arbitrary term list: terms absent from the contents get -1.0."""
    return terms.join(stats, "term", "left").select(
        "term", F.coalesce("idf", F.lit(MISSING_TERM_IDF)).alias("idf"))


#: Folders that a stored index deals its terms into.
TERM_BUCKETS = 64


def term_bucket(term) -> Column:
    """The folder of a term in a stored index."""
    return F.pmod(F.xxhash64(term), F.lit(TERM_BUCKETS)).cast("int")


def postings_lookup(post: DataFrame, term: str) -> DataFrame:
    """``(doc_id, tf)`` of one term. On a stored index the term's folder is
    known from the term, and the filter is pushed to its files."""
    found = post.filter(F.col("term") == term)
    if "bucket" in post.columns:
        found = found.filter(F.col("bucket") == term_bucket(F.lit(term)))
    return found.select("doc_id", "tf")


def document_lookup(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """T8 + T9: decoded path for each requested doc id (join, not a loop)."""
    return ids.select("doc_id").join(docs.select("doc_id", "path"), "doc_id").select(
        "doc_id", decode_path("path").alias("url"))


def tf_norms_from_terms(dt: DataFrame) -> DataFrame:
    """T12 from per-document term arrays: no shuffle, summed in term order.

    Documents without tokens get 0 here; callers that need only documents
    with postings join on them (a filter on the derived array would be pushed
    under the projections and re-run the tokeniser).
    """
    return dt.select("doc_id", F.sqrt(F.aggregate(
        "terms", F.lit(0.0), lambda a, t: a + (t["tf"] * t["tf"]).cast("double"))).alias("tf_norm"))


def tf_norms(post: DataFrame) -> DataFrame:
    """``(doc_id, tf_norm = sqrt(sum tf^2))``."""
    return post.groupBy("doc_id").agg(
        F.sqrt(F.sum((F.col("tf") * F.col("tf")).cast("double"))).alias("tf_norm"))


def weighted_postings(post: DataFrame, stats: DataFrame) -> DataFrame:
    """Q2: ``(doc_id, term, tf, idf)``."""
    return post.join(stats.select("term", "idf"), "term").select("doc_id", "term", "tf", "idf")


def tfidf_norms(post: DataFrame, stats: DataFrame) -> DataFrame:
    """``(doc_id, tfidf_norm = sqrt(sum (tf*idf)^2))``."""
    w = weighted_postings(post, stats)
    return w.groupBy("doc_id").agg(
        F.sqrt(F.sum(F.pow(F.col("tf") * F.col("idf"), 2))).alias("tfidf_norm"))


#: Terms of most documents whose statistics come to the postings as a broadcast of fixed size.
FREQUENT_TERMS = 100_000


def stored_tfidf_norms(post: DataFrame, stats: DataFrame, frequent_terms: int = FREQUENT_TERMS) -> DataFrame:
    """``tfidf_norms`` where ``stats`` (with ``df``) is a written table.

    A vocabulary too large for a broadcast would send all postings by term and
    their products back by document. Most postings are of few terms: these meet
    them where they lie, and only the postings of the other terms move.
    """
    frequent = F.broadcast(stats.orderBy(F.desc("df"), "term").limit(frequent_terms).select("term", "idf"))
    rare = post.join(frequent, "term", "left_anti").join(stats.select("term", "idf"), "term")
    w = post.join(frequent, "term").select("doc_id", "tf", "idf").unionByName(rare.select("doc_id", "tf", "idf"))
    return w.groupBy("doc_id").agg(F.sqrt(F.sum(F.pow(F.col("tf") * F.col("idf"), 2))).alias("tfidf_norm"))


def lowest_idf_terms(stats: DataFrame, k: int = LOWEST_IDF_COUNT) -> DataFrame:
    """The k smallest IDF >= 0, ties in term order, IDF to 6 digits."""
    return (stats.filter(F.col("idf") >= 0).orderBy("idf", "term").limit(k)
            .select("term", F.round("idf", IDF_DIGITS).alias("idf")))


def doc_id_audit(docs: DataFrame) -> DataFrame:
    """T10 as one summary row, with no id range materialised.

    Ids ``0..n-1`` are all present exactly when ``n`` distinct ids fall in
    ``[0, n)``, so a single aggregate answers it.
    """
    n = corpus_size(docs)
    in_range = F.when((F.col("doc_id") >= 0) & (F.col("doc_id") < n), F.col("doc_id"))
    return docs.agg(
        F.count(F.lit(1)).alias("n_docs"),
        F.count_distinct(in_range).alias("ids_in_range")).select(
        "n_docs", (F.col("n_docs") - F.col("ids_in_range")).alias("missing_ids"),
        (F.col("n_docs") == F.col("ids_in_range")).alias("complete"))


def missing_doc_ids(docs: DataFrame) -> DataFrame:
    """T10 as the list of absent ids: ``range(n)`` anti-joined with the docs.

    The one action here fetches the single number ``n`` to size the range.
    """
    spark = docs.sparkSession
    n = docs.count()
    return spark.range(n).withColumnRenamed("id", "doc_id").join(
        docs.select("doc_id"), "doc_id", "left_anti")


@dataclass
class Index:
    """A corpus index: every member is a lazily defined DataFrame."""
    docs: DataFrame          # doc_id, path, modified where the corpus has it
    postings: DataFrame      # doc_id, term, tf; in a stored index also bucket and both norms
    term_stats: DataFrame    # term, df, idf
    doc_norms: DataFrame     # doc_id, tf_norm, tfidf_norm
    n_docs: Column           # scalar
    terms: DataFrame | None = None  # doc_id, terms array<struct<term, tf>>: postings by document, of an index just built
    block_max: DataFrame | None = None  # bucket, term, block, tf_max, tfidf_max, of a stored index
    block_docs: int = 0      # documents of a block
    block_min_df: int = 0    # least document frequency of a term in block_max


def document_norms(dt: DataFrame, stats: DataFrame, stored: bool = False) -> DataFrame:
    """T12 and T13 together from per-document term arrays; only documents with
    postings, as in the reference. ``stored``: ``stats`` is a written table."""
    norms = stored_tfidf_norms if stored else tfidf_norms
    return norms(explode_terms(dt), stats).join(tf_norms_from_terms(dt), "doc_id").select("doc_id", "tf_norm", "tfidf_norm")


def build_index(docs: DataFrame, text_col: str = "text", pattern: str = TOKEN_PATTERN,
                stop_words: list[str] | None = None) -> Index:
    """Tokenise a corpus and derive all statistics.

    The corpus is read and tokenised once, into a written table with one row
    of counted terms per document; every statistic comes from that table.
    """
    own = docs.select("doc_id", *(c for c in ("path", "modified") if c in docs.columns), text_col)
    terms = doc_terms(own, text_col, pattern, stop_words, keep=[c for c in own.columns if c not in ("doc_id", text_col)])
    dt = RoundState(docs.sparkSession, "doc-terms").settle(terms)
    post = explode_terms(dt)
    n = corpus_size(dt)
    stats = term_stats(post, n)
    # inner join: only documents with postings have norms, as in the reference
    return Index(docs=dt.drop("terms"), postings=post, term_stats=stats, doc_norms=document_norms(dt, stats), n_docs=n, terms=dt)
