"""Byte-level BPE encoding and decoding by public ranks.

Texts are cut by the vectorised pre-tokeniser (``pretoken``: code-point
classes and an associative scan, no regex). Distinct pieces that the worker's
cache does not hold are merged pair by pair: always the adjacent pair of
lowest rank, leftmost on ties, for all pieces side by side in numpy. Token ids
are the ranks. Decoding gathers each id's bytes.

A null or empty text has no tokens; texts of any length are encoded whole.
Repeated rows are encoded each for itself. An empty table gives no rows.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from quire.llm.common import doc_texts, text_blocks
from quire.llm.pretoken import PieceIds, ranges

NONE = np.int64(1) << 40  # no pair here
WIDE = 32  # longer pieces are merged one by one with a heap


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(tok): int(rank) for tok, rank in map(bytes.split, f)}


class PairMerger:
    """Merges pieces by rank. ``encode_new`` fits ``PieceIds``."""

    def __init__(self, ranks: dict[bytes, int]):
        self._ranks = ranks
        self._byte = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        pairs = [(ranks[t[:i]] << 32 | ranks[t[i:]], r) for t, r in ranks.items()
                 for i in range(1, len(t)) if t[:i] in ranks and t[i:] in ranks]
        pairs.sort()
        self._keys = np.array([k for k, _ in pairs] + [np.iinfo(np.int64).max], np.int64)
        self._vals = np.array([r for _, r in pairs] + [NONE], np.int64)

    def _rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a << 32 | b
        at = np.searchsorted(self._keys, key)
        return np.where(self._keys[at] == key, self._vals[at], NONE)

    def _merge_side_by_side(self, pieces: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
        """Merge pieces of at most ``width`` bytes; a row for each, one merge a round."""
        n = len(pieces)
        lens = np.fromiter(map(len, pieces), np.int64, n)
        cols = np.arange(width)
        inside = cols < lens[:, None]
        toks = np.zeros((n, width), np.int64)
        toks[inside] = self._byte[np.frombuffer(b"".join(pieces), np.uint8)]
        pair = np.full((n, width), NONE, np.int64)
        two = inside[:, 1:]
        pair[:, :-1][two] = self._rank(toks[:, :-1][two], toks[:, 1:][two])
        out, out_len, rows = np.zeros((n, width), np.int32), lens.copy(), np.arange(n)
        while len(rows):
            at = pair.argmin(1)
            best = pair[np.arange(len(rows)), at]
            busy = best < NONE
            if not busy.all():
                done = ~busy
                out[rows[done], :toks.shape[1]] = toks[done]
                out_len[rows[done]] = lens[done]
                rows, toks, pair, lens, at, best = (x[busy] for x in (rows, toks, pair, lens, at, best))
                if not len(rows):
                    break
            k, a = np.arange(len(rows)), at[:, None]
            toks[k, at] = best
            cols = np.arange(toks.shape[1] - 1)
            toks = np.take_along_axis(toks, cols + (cols > a), 1)
            pair = np.take_along_axis(pair, cols + (cols >= a), 1)
            lens = lens - 1
            left = at > 0
            pair[k[left], at[left] - 1] = self._rank(toks[k[left], at[left] - 1], best[left])
            right = at + 1 < lens
            pair[k[right], at[right]] = self._rank(best[right], toks[k[right], at[right] + 1])
            if toks.shape[1] == 1:
                out[rows, 0], out_len[rows] = toks[:, 0], 1
                break
        return out[np.arange(width) < out_len[:, None]], out_len

    def _merge_long(self, piece: bytes) -> list[int]:
        """One long piece: a heap of pairs over a linked list."""
        toks = [int(self._byte[b]) for b in piece]
        raw = [bytes([b]) for b in piece]
        n = len(toks)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        alive = [True] * n
        get = self._ranks.get
        heap = [(r, i, i + 1) for i in range(n - 1) if (r := get(raw[i] + raw[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            r, i, j = heapq.heappop(heap)
            if not (alive[i] and j < n and alive[j] and after[i] == j) or get(raw[i] + raw[j]) != r:
                continue
            raw[i] += raw[j]
            toks[i], alive[j] = r, False
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
                if (s := get(raw[i] + raw[after[i]])) is not None:
                    heapq.heappush(heap, (s, i, after[i]))
            if before[i] >= 0 and (s := get(raw[before[i]] + raw[i])) is not None:
                heapq.heappush(heap, (s, before[i], i))
        return [t for t, live in zip(toks, alive) if live]

    def encode_new(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        lens = np.fromiter(map(len, pieces), np.int64, len(pieces))
        parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        low = 0
        for width in (8, 16, WIDE):
            at = np.flatnonzero((lens > low) & (lens <= width))
            low = width
            for lo in range(0, len(at), 50_000):
                own = at[lo:lo + 50_000]
                parts.append((own, *self._merge_side_by_side([pieces[i] for i in own], width)))
        for i in np.flatnonzero(lens > WIDE):
            ids = self._merge_long(pieces[i])
            parts.append((np.array([i]), np.array(ids, np.int32), np.array([len(ids)])))
        out_len = np.zeros(len(pieces), np.int64)
        for own, _, n in parts:
            out_len[own] = n
        start = np.cumsum(out_len) - out_len
        flat = np.empty(int(out_len.sum()), np.int32)
        for own, ids, n in parts:
            flat[ranges(start[own], n)] = ids
        return flat, out_len


_encoders: dict[str, PieceIds] = {}
_vocabularies: dict[str, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}


def _encoder(path: str) -> PieceIds:
    if path not in _encoders:
        _encoders[path] = PieceIds(PairMerger(read_ranks(path)).encode_new)
    return _encoders[path]


def _vocabulary(path: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All tokens' bytes in a row, and each id's start and length there."""
    if path not in _vocabularies:
        ranks = read_ranks(path)
        toks = [b""] * (max(ranks.values()) + 1)
        for t, r in ranks.items():
            toks[r] = t
        lens = np.array([len(t) for t in toks], np.int64)
        _vocabularies[path] = np.frombuffer(b"".join(toks), np.uint8), np.cumsum(lens) - lens, lens
    return _vocabularies[path]


def _list(flat: np.ndarray, counts: np.ndarray) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, pa.int32()))


def encode(docs: DataFrame, ranks_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, ids array<int>, slice_offsets array<int>)``, a row for each
    input row. ``slice_offsets`` holds the byte at which each pre-token starts."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = _encoder(ranks_path)
        for rows, texts in text_blocks(batches):
            ids, counts, offsets, pieces = enc.encode(texts)
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), _list(ids, counts), _list(offsets, pieces)], ["doc_id", "ids", "slice_offsets"])

    return doc_texts(docs, id_col, text_col).mapInArrow(
        run, "doc_id bigint, ids array<int>, slice_offsets array<int>")


def decode(encoded: DataFrame, ranks_path: str) -> DataFrame:
    """``encoded`` (``doc_id``, ``ids``) with the ids' bytes as ``decoded``, all of
    a document's tokens in a row. A null ``ids`` gives empty bytes."""
    step = 1 << 19  # ids at once

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        data, start, length = _vocabulary(ranks_path)
        for batch in batches:
            col = batch.column(1)
            counts = np.array(col.value_lengths().fill_null(0), np.int64)
            lo = 0
            while lo < len(counts):
                hi = max(lo + 1, int(np.searchsorted(np.cumsum(counts[lo:]), step)) + lo)
                ids = col.slice(lo, hi - lo).flatten().to_numpy(zero_copy_only=False)
                lens = length[ids]
                raw = data[ranges(start[ids], lens)]
                upto = np.concatenate([[0], np.cumsum(lens)])
                ends = upto[np.concatenate([[0], np.cumsum(counts[lo:hi])])].astype(np.int32)
                out = pa.Array.from_buffers(pa.binary(), hi - lo, [None, pa.py_buffer(ends), pa.py_buffer(raw)])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), col.slice(lo, hi - lo), out], ["doc_id", "ids", "decoded"])
                lo = hi

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id bigint, ids array<int>, decoded binary")
