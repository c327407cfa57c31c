"""Adjacency-list files ``src->d1,d2,...`` (S7 links, S8 citations).

Parsing is per line with built-in string functions. A line with no targets
(``5->``) gives no edge row; when a source appears on several lines the last
line wins, which needs a line order: either an explicit ``line_no`` column or,
for files, the position of the line in its file (file path, split start, row
order within the split). Lines that do not parse go to a rejects DataFrame
instead of stopping the load.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_adjacency_lines(spark: SparkSession, path: str) -> DataFrame:
    """``(line_no struct, value)`` for every line of the adjacency file(s)."""
    df = spark.read.text(path).select("value", "_metadata")
    order = F.struct(F.col("_metadata.file_path").alias("file"),
                     F.col("_metadata.file_block_start").alias("block"),
                     F.monotonically_increasing_id().alias("row"))
    return df.select(order.alias("line_no"), "value")


def _split_line(lines: DataFrame) -> DataFrame:
    # the second piece holds the targets, whatever follows a second arrow
    parts = F.split(F.col("value"), "->")
    return lines.select(
        "line_no", "value",
        F.trim(F.get(parts, 0)).alias("src_text"),
        F.coalesce(F.get(parts, 1), F.lit("")).alias("rest"))


def parse_adjacency(lines: DataFrame, src: str = "src", dst: str = "dst") -> tuple[DataFrame, DataFrame]:
    """Parse adjacency lines into ``(src, dst, pos)`` edges and rejects.

    ``lines`` has ``value`` and ``line_no`` (any orderable type). Targets keep
    their order in ``pos``; repeats on a line are kept (the reference counts
    them). Returns ``(edges, rejects)``.
    """
    sp = _split_line(lines)
    sp = sp.withColumn("src_id", F.col("src_text").try_cast("bigint"))
    # Java's split drops trailing empty pieces: "1,2," is two targets
    targets = F.split(F.regexp_replace("rest", ",+$", ""), ",")
    sp = sp.withColumn("targets", F.when(F.col("rest") == "", F.array().cast("array<string>"))
                       .otherwise(targets))
    sp = sp.withColumn("bad", F.col("src_id").isNull() | F.exists(
        "targets", lambda t: F.trim(t).try_cast("bigint").isNull()))
    rejects = sp.filter("bad").select("line_no", "value")
    good = sp.filter(~F.col("bad"))
    # the last line per source wins
    last = good.groupBy("src_id").agg(F.max_by(F.col("targets"), F.col("line_no")).alias("targets"))
    edges = last.select(F.col("src_id").alias(src), F.posexplode("targets").alias("pos", "t")).select(
        src, F.trim(F.col("t")).cast("bigint").alias(dst), "pos")
    return edges, rejects


def read_links(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Links file → ``(src, dst, pos)`` and the lines that do not parse."""
    return parse_adjacency(read_adjacency_lines(spark, path))


def read_citations(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Citations file → ``(doc, citing, pos)`` and the lines that do not parse;
    an independent file."""
    return parse_adjacency(read_adjacency_lines(spark, path), "doc", "citing")
