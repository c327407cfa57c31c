"""Result files and display strings.

The reference writes ``TF/TF.txt`` and ``TF/IDF.txt`` (``doc|norm``) and
``PR/PageRank.txt`` (``doc|score``), each only when the target does not exist
yet: both norm files when their folder is there, the score file when it is
there itself. Here each file is a Spark text folder of part files, each with
the header line (names separated by a comma) and ``|`` between the values.
Doubles print as Java's ``Double.toString``, as in the reference.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.functions.scaling import SCORE_DIGITS
from quire.functions.text import decode_path
from quire.operators.index import Index

SEPARATOR = "|"


def _write(df: DataFrame, header: str, path: str) -> None:
    line = F.concat_ws(SEPARATOR, *(F.col(c).cast("string") for c in df.columns)).alias(header)
    df.select(line).write.option("header", True).option("sep", "\t").option("quote", "\u0000").csv(path)


def _exists(df: DataFrame, path: str) -> bool:
    spark = df.sparkSession
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def write_norms(index: Index, folder: str) -> None:
    """``folder/TF.txt`` and ``folder/IDF.txt``; neither if the folder exists."""
    n = index.doc_norms
    if _exists(n, folder):
        return
    _write(n.select("doc_id", "tf_norm"), "DocID,TFNorm", os.path.join(folder, "TF.txt"))
    _write(n.select("doc_id", "tfidf_norm"), "DocID,IDFNorm", os.path.join(folder, "IDF.txt"))


def write_link_scores(scores: DataFrame, folder: str) -> None:
    """``folder/PageRank.txt`` in id order, unless it exists."""
    path = os.path.join(folder, "PageRank.txt")
    if not _exists(scores, path):
        _write(scores.select("node", "score").orderBy("node"), "DocID,PageRank", path)


def ranked_display(ranked: DataFrame) -> DataFrame:
    """``[doc|score] - url`` lines of a ranked result (score already scaled)."""
    return ranked.select("query_id", "rank", F.concat(
        F.lit("["), F.col("doc_id").cast("string"), F.lit(SEPARATOR),
        F.round("score", SCORE_DIGITS).cast("string"), F.lit("] - "),
        decode_path("url") if "url" in ranked.columns else F.lit("")).alias("line"))


def id_list_display(top: DataFrame) -> DataFrame:
    """``[doc]`` lines of a top list (hubs, authorities)."""
    return top.select("query_id", "rank", F.concat(F.lit("["), F.col("node").cast("string"), F.lit("]")).alias("line"))


def vector_display(vec: DataFrame, col: str = "score") -> DataFrame:
    """``id : value`` lines of a whole vector."""
    return vec.select("node", F.concat(F.col("node").cast("string"), F.lit(" : "),
                                       F.col(col).cast("string")).alias("line"))
