"""Readers for the given Parquet tables and the corpora/graphs derived from them.

A corpus is a DataFrame ``(doc_id bigint, path string, text string)``; a link
graph is ``links (src, dst, pos)`` plus ``citations (doc, citing, pos)``.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions.text import hashed_node, hrefs


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def spread(df: DataFrame, key: str) -> DataFrame:
    """``df``, dealt out by ``key`` if its files have fewer splits than the session
    has cores (a small table of one row group); larger tables keep their splits,
    and no text is shuffled. Spark sizes the partitions."""
    if df._jdf.queryExecution().toRdd().getNumPartitions() >= df.sparkSession.sparkContext.defaultParallelism:
        return df
    return df.repartition(key)


def documents_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``documents`` table as a corpus; ``source`` serves as the stored path."""
    return spread(read_table(spark, sf_dir, "documents").select("doc_id", F.col("source").alias("path"), "text"), "doc_id")


def pages_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``pages`` table as a corpus: raw HTML is the content, URL the path."""
    return spread(read_table(spark, sf_dir, "pages").select(
        F.col("page_id").alias("doc_id"), F.col("url").alias("path"), F.col("html").alias("text")), "doc_id")


def _with_page_count(pages: DataFrame) -> DataFrame:
    # the page count, a scalar subquery run once, as a plain column: subqueries
    # may not appear inside the lambdas below, column references may
    return pages.select("page_id", "html", pages.agg(F.count(F.lit(1))).scalar().alias("_n_pages"))


def _page_targets():
    return F.array_distinct(F.filter(
        F.transform(hrefs("html"), lambda h: hashed_node(h, F.col("_n_pages"))),
        lambda x: x != F.col("page_id")))


def page_links(pages: DataFrame) -> DataFrame:
    """Link graph of the test pages: ``(src, dst, pos)``.

    Each ``href`` of a page maps to node ``md5-prefix mod count(pages)``;
    self-links are dropped and repeats removed, keeping first-seen order in
    ``pos``. Computed per page row (no shuffle); the page count is a scalar
    subquery evaluated once.
    """
    with_n = _with_page_count(pages)
    return with_n.select(F.col("page_id").alias("src"),
                         F.posexplode(_page_targets()).alias("pos", "dst")).select("src", "dst", "pos")


def transpose_links(links: DataFrame) -> DataFrame:
    """Citations as the transpose of links: ``(doc, citing, pos)``.

    ``pos`` orders a document's citing list; with no citations file the
    citing id itself is the order.
    """
    return links.select(F.col("dst").alias("doc"), F.col("src").alias("citing"),
                        F.col("src").alias("pos"))


def adjacency_lines(pages: DataFrame) -> DataFrame:
    """Render the page graph in the adjacency-file form ``src->d1,d2,...``.

    One line per page, built from the page's own row, so hot pages never meet
    in one task.
    """
    with_n = _with_page_count(pages)
    return with_n.select(
        F.col("page_id").alias("line_no"),
        F.concat(F.col("page_id").cast("string"), F.lit("->"),
                 F.array_join(F.transform(_page_targets(), lambda x: x.cast("string")), ",")).alias("value"))
