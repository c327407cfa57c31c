"""Packing documents into fixed token windows: concatenate and cut.

Pass 1 tokenises every document once and writes its token stream, task by
task, as blocks with their position in the task's stream. The tasks' token
totals give, by a prefix sum, each task's offset in the one global stream.
Pass 2 cuts that stream every ``window`` tokens: windows inside one block are
complete there; the pieces of a window that spans blocks travel as boundary
records and are joined by sequence. Only the last sequence has padding.

The stream's order is that of the written blocks. A null or empty text is its
end id alone; a document longer than a block or a window is cut across them;
repeated rows are packed each for itself; an empty table gives no sequences.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quire.llm.common import arrow_batches, doc_texts, release, settle, text_blocks
from quire.llm.tokens import worker_ids

BLOCK_TOKENS = 32_768
TEXT_BYTES = 2 << 20  # text that is tokenised at once
BATCH_BYTES = 2 * TEXT_BYTES - TEXT_BYTES // 8  # of a batch from Spark: two such texts, and no short third
PAGE_TOKENS = 1 << 18  # of a Parquet page, whose buffers a task holds outside the heap

_BLOCK_DDL = ("part int, at bigint, n bigint, ids binary, pieces array<struct<doc_id: bigint, start: bigint, "
              "length: bigint, doc_tokens: bigint, at: bigint>>")


def token_blocks(docs: DataFrame, tokenizer_path: str, end_id: int, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """The token stream of each task as blocks of ``block_tokens`` (the last
    shorter): task, position in its stream, ids as little-endian unsigned 32-bit
    integers, and the pieces of documents (``at``: position in the block)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, part, at = worker_ids(tokenizer_path), TaskContext.get().partitionId(), 0
        stream = np.empty(0, np.int32)  # what no block holds yet, and its documents:
        doc_ids, none = pa.array([], pa.int64()), np.empty(0, np.int64)
        begin, start, total = none, none, none  # place in the stream, ids before it, all of the document's

        def blocks(upto: int) -> pa.RecordBatch:
            edges = np.append(np.arange(0, upto, block_tokens), upto)
            cuts = np.union1d(begin[begin < upto], edges[:-1])
            own = np.searchsorted(begin, cuts, side="right") - 1
            pieces = pa.StructArray.from_arrays(
                [doc_ids.take(pa.array(own)), *map(pa.array, (start[own] + cuts - begin[own], np.append(cuts[1:], upto) - cuts,
                                                              total[own], cuts % block_tokens))],
                ["doc_id", "start", "length", "doc_tokens", "at"])
            lists = pa.ListArray.from_arrays(pa.array(np.searchsorted(cuts, edges), pa.int32()), pieces)
            n = len(edges) - 1
            ids = pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer((edges * 4).astype(np.int32)),
                                                         pa.py_buffer(stream[:upto].astype("<u4"))])
            return pa.RecordBatch.from_arrays(
                [pa.array(np.full(n, part, np.int32)), pa.array(at + edges[:-1]), pa.array(np.diff(edges)), ids, lists],
                ["part", "at", "n", "ids", "pieces"])

        for rows, texts in text_blocks(batches, max_bytes=TEXT_BYTES):
            ids, counts, _, _ = enc.encode(texts)
            own = counts + 1
            begin = np.concatenate([begin, len(stream) + np.cumsum(own) - own])
            start, total = np.concatenate([start, np.zeros_like(own)]), np.concatenate([total, own])
            doc_ids = pa.concat_arrays([doc_ids, rows.column(0)])
            stream = np.concatenate([stream, np.insert(ids, np.cumsum(counts), end_id)])
            upto = len(stream) // block_tokens * block_tokens
            if upto:
                yield blocks(upto)
                at += upto
                stream = stream[upto:].copy()
                first = int(np.searchsorted(begin, upto, side="right")) - 1 if len(stream) else len(begin)
                doc_ids, begin, start, total = doc_ids.slice(first), begin[first:] - upto, start[first:], total[first:]
                if len(begin) and begin[0] < 0:  # a document that the cut parts
                    start[0], begin[0] = start[0] - begin[0], 0
        if len(stream):
            yield blocks(len(stream))
        del stream, doc_ids, begin, start, total
        release()

    return doc_texts(docs).mapInArrow(run, _BLOCK_DDL)


def _parts(placed: DataFrame, window: int, inner: bool) -> DataFrame:
    """The parts of blocks (``g``: a block's start in the global stream) in each
    window, with the pieces cut at the windows' borders: those that are whole
    windows (``inner``), or the others. ``first``: the part's place in its window.

    Every piece is cut once; the cuts of a window follow each other, from the one
    at the window's start on. No lambda runs beside the ids once windows are rows,
    so a block's ids are not copied for each."""
    g, n, size = F.col("g"), F.col("n"), F.lit(window).cast("bigint")

    def below(x: Column) -> Column:
        return ((x - F.pmod(x, size)) / size).cast("bigint")

    def cut(p: Column) -> Column:
        begin = g + p["at"]
        stop = begin + p["length"]

        def inside(w: Column) -> Column:
            lo = F.greatest(begin, w * size)
            return F.struct(p["doc_id"].alias("doc_id"), (p["start"] + lo - begin).alias("start"),
                            (F.least(stop, (w + 1) * size) - lo).alias("length"), p["doc_tokens"].alias("doc_tokens"),
                            (lo - w * size).alias("offset"))

        return F.transform(F.sequence(below(begin), below(stop - 1)), inside)

    cuts, at = F.col("cuts"), F.col("at")
    df = placed.select("g", "n", "ids", F.flatten(F.transform("pieces", cut)).alias("cuts"))
    df = df.select("*", F.filter(F.sequence(F.lit(1), F.size(cuts)), lambda i: (i == 1) | (F.element_at(cuts, i)["offset"] == 0)).alias("at"))
    df = df.select("g", "n", "ids", F.transform(at, lambda x, k: F.struct(
        (below(g) + k).alias("sequence_id"),
        F.slice(cuts, x, F.coalesce(F.try_element_at(at, k + 2), F.size(cuts) + 1) - x).alias("pieces"))).alias("parts"))
    whole = lambda t: t["sequence_id"].between(below(g + size - 1), below(g + n) - 1)
    df = df.select("g", "n", "ids", F.filter("parts", whole if inner else lambda t: ~whole(t)).alias("parts"))
    # the outer form: the plain one gets a filter on the array's size, pushed below where it would be evaluated for every element
    df = df.select("g", "n", "ids", F.inline_outer("parts")).where(F.col("sequence_id").isNotNull())
    lo = F.greatest(g, F.col("sequence_id") * size) - g
    hi = F.least(n, (F.col("sequence_id") + 1) * size - g)
    return df.select("sequence_id", (lo + g - F.col("sequence_id") * size).alias("first"), (hi - lo).alias("n_tokens"),
                     F.col("ids").substr((lo * 4 + 1).cast("int"), ((hi - lo) * 4).cast("int")).alias("ids"), "pieces")


def pack(docs: DataFrame, tokenizer_path: str, window: int = 1024, end_id: int = 0,
         block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """``(sequence_id, n_tokens, padded_length, ids, pieces)``: a row for each
    sequence. ``ids`` are its tokens as little-endian unsigned 32-bit integers
    without padding; ``pieces`` its parts of documents in order; a sequence is
    padded to ``window`` unless its length is a power of two.

    The offsets of the tasks' streams are broadcast: one number for each input
    partition. An executor's memory beside its heap is bounded: texts come to
    Python in small batches, the blocks' pages are small, and no other Python
    worker than the tokenising ones is started.
    """
    with arrow_batches(docs.sparkSession, BATCH_BYTES):
        blocks = settle(token_blocks(docs, tokenizer_path, end_id, block_tokens), "pack-blocks",
                        **{"parquet.page.row.count.limit": max(1, PAGE_TOKENS // block_tokens)})
    totals = blocks.groupBy("part").agg(F.sum("n").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    placed = blocks.join(F.broadcast(offsets), "part").select(
        (F.col("base") + F.col("at")).alias("g"), "n", "ids", "pieces")
    whole = _parts(placed, window, inner=True).select("sequence_id", "n_tokens", "ids", "pieces")
    joined = (_parts(placed, window, inner=False).groupBy("sequence_id")
              .agg(F.sort_array(F.collect_list(F.struct("first", "n_tokens", "ids", "pieces"))).alias("parts"))
              .select("sequence_id", F.aggregate("parts", F.lit(0).cast("bigint"), lambda n, p: n + p["n_tokens"]).alias("n_tokens"),
                      F.aggregate("parts", F.lit(b""), lambda b, p: F.concat(b, p["ids"])).alias("ids"),
                      F.flatten(F.transform("parts", lambda p: p["pieces"])).alias("pieces")))
    out = whole.unionByName(joined)
    two_power = F.col("n_tokens").bitwiseAND(F.col("n_tokens") - 1) == 0
    return out.select("sequence_id", "n_tokens",
                      F.when(two_power, F.col("n_tokens")).otherwise(F.lit(window).cast("bigint")).alias("padded_length"), "ids", "pieces")


def pieces(packed: DataFrame) -> DataFrame:
    """A row for each piece of ``pack``'s sequences, with its ids' CRC-32."""
    p = packed.select("sequence_id", "ids", F.explode("pieces").alias("p"))
    own = F.col("ids").substr((F.col("p.offset") * 4 + 1).cast("int"), (F.col("p.length") * 4).cast("int"))
    return p.select("p.doc_id", "p.start", "p.length", F.crc32(own).alias("ids_crc32"), "p.doc_tokens",
                    "sequence_id", "p.offset")
