"""Corpus pipeline: from raw documents to packed training sequences.

``STAGES`` in order: quality rules and the quality classifier (documents they
reject go), SimHash near-duplicates (one document of each group stays),
substring dedup (repeated passages of 35 words go from the texts) and packing.
Each stage works on what the one before kept, written as Parquet and read
again. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm import packing, quality_classifier, quality_rules, simhash, substring_words
from quire.llm.common import settle
from quire.sources.tables import read_table

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.keep_good(docs)


def classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learns from the labelled rows among the documents at hand."""
    model = quality_classifier.learn(docs, read_table(spark, sf_dir, "labels"), "quality")
    return quality_classifier.keep_good(docs, model)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs, shingle=3, max_bits=2)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The text becomes its kept words; a null text stays null. ``n_chars`` follows the text."""
    done = substring_words.reports(docs, window=35)
    text = F.when(F.col("row.text").isNotNull(), F.col("report.kept_text")).alias("text")
    size = F.when(F.col("row.text").isNotNull(), F.length("report.kept_text").cast("bigint")).alias("n_chars")
    return done.select(*(text if c == "text" else size if c == "n_chars" else F.col(f"row.`{c}`") for c in docs.columns))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each piece of a document in a sequence."""
    return packing.pieces(packing.pack(docs, TOKENIZER, window=1024, end_id=0))


STAGES = [("quality rules", rules), ("quality classifier", classifier), ("SimHash near-dedup", near_dedup),
          ("substring dedup", substring_dedup), ("packing", pack)]

#: SQL has no zstandard, no network and no tokenizer; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return docs
