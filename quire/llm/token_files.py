"""Token-id files: Parquet list columns that can be read in part.

Documents are range-partitioned and sorted by id (those of one id, or none, by a
hash of their text and their place, so they need not meet in one task), tokenised in that order and
written as one Parquet folder. Ids are a dictionary-encoded list column;
the number columns are delta-encoded; row groups are small and every column
has a page index, so a reader of a few documents, or of the numbers only,
reads those pages and columns alone. A manifest holds each part's token total
and offset, so a document's global position needs no pass over the ids.

A null or empty text is its end id alone; documents with a null id come
first; rows of one id are ordered by a hash of their text; an empty table gives files
without rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm.common import doc_texts, release, text_blocks
from quire.llm.packing import TEXT_BYTES
from quire.llm.tokens import worker_ids

_SCHEMA = "doc_id bigint, part int, start_in_part bigint, n_tokens bigint, ids array<int>"
#: Row groups of 16 MB, pages of 64 KB: the unit of a selective read.
_WRITE = {
    "parquet.block.size": 16 << 20,
    "parquet.page.size": 64 << 10,
    "parquet.page.row.count.limit": 1000,
    "parquet.writer.version": "PARQUET_2_0",
    "parquet.enable.dictionary#doc_id": "false",
    "parquet.enable.dictionary#start_in_part": "false",
    "parquet.enable.dictionary#n_tokens": "false",
    "compression": "zstd",
}


def write_tokens(docs: DataFrame, path: str, tokenizer_path: str, end_id: int = 2) -> None:
    """Tokenise ``docs`` into ``path``: ``tokens`` (the files) and ``manifest``."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, part, at = worker_ids(tokenizer_path), TaskContext.get().partitionId(), 0
        for rows, texts in text_blocks(batches, max_bytes=TEXT_BYTES):
            ids, counts, _, _ = enc.encode(texts)
            ids = np.insert(ids, np.cumsum(counts), end_id)
            counts = counts + 1
            ends = np.cumsum(counts)
            offsets = np.concatenate([[0], ends]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), pa.array(np.full(len(counts), part, np.int32)), pa.array(at + ends - counts),
                 pa.array(counts), pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids, pa.int32()))],
                ["doc_id", "part", "start_in_part", "n_tokens", "ids"])
            at += int(ends[-1])
        release()

    own = doc_texts(docs).select("doc_id", "text", F.xxhash64("text").alias("h"), F.monotonically_increasing_id().alias("row"))
    ordered = own.repartitionByRange("doc_id", "h", "row").sortWithinPartitions("doc_id", "h", "text").select("doc_id", "text")
    ordered.mapInArrow(run, _SCHEMA).write.options(**_WRITE).parquet(f"{path}/tokens")
    spark = docs.sparkSession
    totals = sorted((r.part, r.n) for r in spark.read.schema(_SCHEMA).parquet(f"{path}/tokens")
                    .groupBy("part").agg(F.sum("n_tokens").alias("n")).collect())
    base = accumulate((n for _, n in totals), initial=0)
    (spark.createDataFrame([(p, n, b) for (p, n), b in zip(totals, base)], "part int, n_tokens bigint, base bigint")
     .coalesce(1).write.parquet(f"{path}/manifest"))


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """``(doc_id, start, n_tokens, ids)`` from the files; ``start`` counts the ids
    of all documents before. The manifest has a row for each written part."""
    tokens = spark.read.schema(_SCHEMA).parquet(f"{path}/tokens")
    manifest = spark.read.schema("part int, n_tokens bigint, base bigint").parquet(f"{path}/manifest").select("part", "base")
    return tokens.join(F.broadcast(manifest), "part").select(
        "doc_id", (F.col("base") + F.col("start_in_part")).alias("start"), "n_tokens", "ids")


def checksums(tokens: DataFrame) -> DataFrame:
    """``read_tokens`` rows with the CRC-32 of each document's ids instead of them."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            col = b.column(3)
            flat = col.flatten().to_numpy(zero_copy_only=False).astype("<u4")
            ends = np.cumsum(np.array(col.value_lengths(), np.int64))
            crc = [zlib.crc32(flat[lo:hi]) for lo, hi in zip([0, *ends[:-1].tolist()], ends.tolist())]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), pa.array(crc, pa.int64())],
                                             ["doc_id", "start", "n_tokens", "ids_crc32"])

    return tokens.select("doc_id", "start", "n_tokens", "ids").mapInArrow(
        run, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")
