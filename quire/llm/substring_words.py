"""Exact substring deduplication on words, by fixed-block anchors.

Every window of ``window`` words holds a whole block of ``(window + 1) // 2``
words whose start is a multiple of that length, so a repeated window shows as
a reference block whose words also occur elsewhere, at any position.

1. Index and probe: each text group sends the hashes of its non-overlapping
   reference blocks (the index) and of all its rolling windows of that length
   (the probes). A bucket says which indexed blocks are probed at two or more
   positions. Hashes are shortened to a few bits over the number of probes: a
   chance hit costs work and cannot change the result.
2. Extend: a hit block is extended by every full window around it; windows are
   compared by 128-bit hashes, and those at two or more positions repeat. The
   words that they cover are the maximal exact repeats.

Both sides of a repeat hold a hit block of their own, so no pair of positions
is ever listed, and a passage in any number of documents costs each of them
one message item.

A null or empty text has no words. Repeated rows repeat each other's windows.
A text shorter than the window loses nothing. An empty table gives no rows. A
text is held whole by one task, at about 20 bytes of memory for each of its
bytes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from quire.llm import exchange as ex
from quire.llm.words import single_spaced, text_of, word_ids, words

GROUP_BYTES = ex.GROUP_BYTES
BUCKET_BYTES = 6 << 20
_BASES = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4D  # odd multipliers
ANCHOR, WINDOW = 0, 1  # kinds of answers


class _Group:
    """Words, hashes and windows of one group of texts."""

    def __init__(self, texts: list[str], window: int, n_buckets: int, bits: int):
        self.flat, self.ends, self.counts = words(texts)
        self.window, self.block, self.n_buckets = window, (window + 1) // 2, n_buckets
        ids, known = word_ids(self.flat, self.ends)
        raw = b"".join(xxhash.xxh3_128_digest(w) for w in known.to_pylist())
        self.hash = np.frombuffer(raw, "<u8").reshape(-1, 2)[ids].T.copy()
        self.text = text_of(self.counts)
        first = np.cumsum(self.counts) - self.counts
        rolling = ex.window_hashes(self.hash[0], self.block, _BASES[0]) >> np.uint64(64 - bits)
        self.inside = np.flatnonzero(self._one_text(self.block))
        self.aligned = (self.inside - first[self.text[self.inside]]) % self.block == 0
        self.keys, self.item, times = np.unique(rolling[self.inside], return_inverse=True, return_counts=True)
        self.multi = times > 1
        self.indexed = np.zeros(len(self.keys), bool)
        self.indexed[self.item[self.aligned]] = True
        self.cuts = ex.bucket_cuts(self.keys, n_buckets, bits)

    def _one_text(self, size: int) -> np.ndarray:
        n = len(self.text)
        return self.text[:n - size + 1] == self.text[size - 1:] if n >= size else np.empty(0, bool)

    def anchors(self, group: int) -> pa.Table:
        return ex.messages(group, self.cuts, lambda lo, hi: ex.pack_sorted(self.keys[lo:hi]),
                           lambda lo, hi: np.packbits(self.multi[lo:hi]).tobytes() + np.packbits(self.indexed[lo:hi]).tobytes())

    def extend(self, replies: pa.Table) -> None:
        """Distinct full windows around the hit blocks, and where they are."""
        upto = np.concatenate([[0], np.cumsum(self.indexed)])
        hit = np.zeros(len(self.keys), bool)
        hit[self.indexed] = ex.statuses(replies, ANCHOR, upto[self.cuts]) > 0
        at = self.inside[self.aligned & hit[self.item]]
        near = np.zeros(len(self.text) + 1, np.int64)
        np.add.at(near, np.maximum(at - (self.window - self.block), 0), 1)
        np.add.at(near, at + 1, -1)
        whole = self._one_text(self.window)
        self.starts = np.flatnonzero(whole & (np.cumsum(near)[:len(whole)] > 0))
        a, b = (ex.window_hashes(h, self.window, m)[self.starts] for h, m in zip(self.hash, _BASES))
        order = np.lexsort((b, a))
        a, b = a[order], b[order]
        new = ex.run_starts(a, b)
        self.window_item = np.empty(len(order), np.int64)
        self.window_item[order] = np.cumsum(new) - 1
        self.window_keys = a[new], b[new]
        self.window_multi = np.bincount(self.window_item, minlength=int(new.sum())) > 1
        self.window_cuts = ex.bucket_cuts(self.window_keys[0], self.n_buckets)

    def windows(self, group: int) -> pa.Table:
        a, b = self.window_keys
        return ex.messages(group, self.window_cuts, lambda lo, hi: a[lo:hi].tobytes(),
                           lambda lo, hi: b[lo:hi].tobytes() + np.packbits(self.window_multi[lo:hi]).tobytes())

    def covered(self, replies: pa.Table) -> np.ndarray:
        """The words to remove."""
        again = self.starts[ex.statuses(replies, WINDOW, self.window_cuts)[self.window_item] > 0]
        step = np.zeros(len(self.text) + 1, np.int64)
        step[again] += 1
        step_end = np.bincount(again + self.window, minlength=len(step))[:len(step)]
        return np.cumsum(step - step_end)[:-1] > 0


def _bits(b: bytes, lo: int, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(b, np.uint8, offset=lo, count=(n + 7) // 8), count=n).astype(bool)


def _judge_anchors(table: pa.Table) -> pa.Table:
    """Of a bucket's indexed blocks, those probed at two or more positions."""
    keys = [ex.unpack_sorted(k) for k in table.column("keys").to_pylist()]
    counts = [len(k) for k in keys]
    data = table.column("data").to_pylist()
    multi = np.concatenate([_bits(d, 0, n) for d, n in zip(data, counts)])
    indexed = np.concatenate([_bits(d, (n + 7) // 8, n) for d, n in zip(data, counts)])
    keys = np.concatenate(keys)
    order = np.argsort(keys)
    run = np.cumsum(ex.run_starts(keys[order])) - 1
    times = np.bincount(run, weights=1.0 + multi[order])
    status = np.empty(len(keys), bool)
    status[order] = (times > 1)[run]
    own = np.repeat(np.arange(len(counts)), counts)
    return ex.answers(ANCHOR, table, np.bincount(own[indexed], minlength=len(counts)), status[indexed])


def _judge_windows(table: pa.Table) -> pa.Table:
    """Which of a bucket's windows are at two or more positions."""
    first = [np.frombuffer(k, "<u8") for k in table.column("keys").to_pylist()]
    counts = np.array([len(k) for k in first])
    data = table.column("data").to_pylist()
    a = np.concatenate(first)
    b = np.concatenate([np.frombuffer(d, "<u8", count=n) for d, n in zip(data, counts)])
    multi = np.concatenate([_bits(d, 8 * n, n) for d, n in zip(data, counts)])
    order = np.lexsort((b, a))
    run = np.cumsum(ex.run_starts(a[order], b[order])) - 1
    times = np.bincount(run, weights=1.0 + multi[order])
    status = np.empty(len(a), bool)
    status[order] = (times > 1)[run]
    return ex.answers(WINDOW, table, counts, status)


REPORT = StructType([
    StructField("n_words", LongType()), StructField("n_removed", LongType()),
    StructField("spans", ArrayType(StructType([StructField("start", LongType()), StructField("length", LongType())]))),
    StructField("kept_text", StringType())])


def reports(docs: DataFrame, window: int = 35, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(row, report)`` for each row of ``docs``: all its columns, and ``n_words``,
    ``n_removed``, the maximal removed runs ``spans`` (in words) and ``kept_text``,
    the other words joined by one space. Both are structs, so the names of the
    rows' columns are free."""
    docs = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), F.col(f"`{id_col}`").alias("doc_id"),
                       F.col(f"`{text_col}`").alias("text"))
    id_col, text_col = "doc_id", "text"
    total = ex.text_bytes(docs, text_col)
    n_groups, n_buckets = max(1, -(-total // GROUP_BYTES)), max(1, -(-total // BUCKET_BYTES))
    bits = min(64, max(total, 2).bit_length() + 10)  # a probe meets another by chance once in some thousands
    grouped = ex.into_groups(docs, id_col, text_col, n_groups, GROUP_BYTES)

    def load(rows: pa.Table) -> _Group:
        return _Group(ex.texts_of(rows, text_col), window, n_buckets, bits)

    def send_anchors(rows: pa.Table) -> pa.Table:
        return load(rows).anchors(ex.group_of(rows))

    def send_windows(rows: pa.Table, replies: pa.Table) -> pa.Table:
        if not rows.num_rows:
            return ex.MESSAGE.empty_table()
        g = load(rows)
        g.extend(replies)
        return g.windows(ex.group_of(rows))

    def remove(rows: pa.Table, replies: pa.Table) -> pa.Table:
        g = load(rows)
        g.extend(replies)
        gone = g.covered(replies)
        ends = np.cumsum(g.counts)
        upto = np.concatenate([[0], np.cumsum(gone)])
        n_gone = upto[ends] - upto[ends - g.counts]
        edge = np.flatnonzero(gone & (np.diff(gone, prepend=False) | np.diff(g.text, prepend=-1).astype(bool)))
        stop = np.flatnonzero(gone & (np.diff(gone, append=False) | np.diff(g.text, append=-1).astype(bool))) + 1
        first = (ends - g.counts)[g.text[edge]]
        runs = np.searchsorted(g.text[edge], np.arange(len(g.counts) + 1))
        spans = pa.ListArray.from_arrays(pa.array(runs, pa.int32()), pa.StructArray.from_arrays(
            [pa.array(edge - first, pa.int64()), pa.array(stop - edge, pa.int64())], ["start", "length"]))
        data, starts, _ = single_spaced(g.flat, g.ends)
        size = np.diff(starts, append=len(data))  # with the space after it
        stay = np.frombuffer(data, np.uint8)[np.repeat(~gone, size)].tobytes()
        cum = np.concatenate([[0], np.cumsum(np.where(gone, 0, size))])
        kept = [stay[a:max(a, b - 1)].decode() for a, b in zip(cum[ends - g.counts].tolist(), cum[ends].tolist())]
        report = pa.StructArray.from_arrays([pa.array(g.counts), pa.array(n_gone), spans, pa.array(kept, pa.string())],
                                            [f.name for f in REPORT])
        return rows.select(["row"]).append_column("report", report)

    anchors = ex.ask(grouped, send_anchors).groupBy("bucket").applyInArrow(_judge_anchors, ex.ANSWER_DDL)
    full = (ex.replied(grouped, anchors, send_windows, ex.MESSAGE_DDL)
            .groupBy("bucket").applyInArrow(_judge_windows, ex.ANSWER_DDL))
    schema = StructType([docs.schema["row"], StructField("report", REPORT)])
    return ex.replied(grouped, anchors.unionByName(full), remove, schema)


def remove_repeats(docs: DataFrame, window: int = 35, id_col: str = "doc_id", text_col: str = "text",
                   prefix: str = "") -> DataFrame:
    """``reports`` with all columns side by side; ``prefix`` goes before the report's
    names, for a ``docs`` that has them itself."""
    done = reports(docs, window, id_col, text_col)
    return done.select("row.*", *(F.col(f"report.{f.name}").alias(prefix + f.name) for f in REPORT))


def dedup(docs: DataFrame, window: int = 35) -> DataFrame:
    """``(doc_id, n_words, n_removed, spans, kept_text)`` for every document."""
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return remove_repeats(own, window).drop("text")
