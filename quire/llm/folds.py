"""Labelled rows for the classifiers: folds and bounded samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.llm.common import doc_texts


def held_out(id_col: str = "doc_id") -> Column:
    """True for the rows no model may learn from: crc32(id as text) mod 3 is 1."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def training_labels(labels: DataFrame, label_col: str, per_class: int) -> DataFrame:
    """``(doc_id, y)``: at most ``per_class`` learnable labelled ids of each class,
    the first by a hash of the id. Rows with a null id or label take no part; of
    an id labelled twice the larger label counts."""
    own = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("y"))
           .where(F.col("doc_id").isNotNull() & F.col("y").isin(0, 1) & ~held_out())
           .groupBy("doc_id").agg(F.max("y").alias("y")))
    some = [own.where(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class) for y in (0, 1)]
    return some[0].unionByName(some[1])


def labelled_texts(docs: DataFrame, labels: DataFrame, label_col: str, per_class: int) -> DataFrame:
    """``(doc_id, text, y)`` of the training sample: one row for each id, with the
    least of its texts where rows repeat the id. The sample is broadcast, being
    bounded by ``per_class``; the texts of a repeated id meet pre-aggregated."""
    chosen = training_labels(labels, label_col, per_class)
    return (doc_texts(docs).join(F.broadcast(chosen), "doc_id")
            .groupBy("doc_id", "y").agg(F.min("text").alias("text")).select("doc_id", "text", "y"))
