"""Exact byte-level deduplication by a distributed, sparse suffix array.

Removed is every byte covered by a string of ``size`` bytes that also starts
elsewhere. Sorting the suffix of every byte would move each byte hundreds of
times, so suffixes start at *leading tokens*: in each window of ``size`` bytes
the token is the 32-byte string with the least hash, which depends on the
window's bytes alone, so equal windows hold equal tokens at equal offsets.
Consecutive windows with the same token form a *span*; every window is in one.

1. Each text group sends, for its spans, the token's hash and the span's hash.
   A bucket finds tokens that occur once (nothing to do), spans that occur
   again whole (all their windows repeat) and tokens with several different
   spans; of equal spans one is compared for all.
2. Those spans are range-partitioned by their token, with splitters sampled
   from a share of the documents. A bucket sorts the suffixes at the tokens,
   and the reversed bytes before them, by a multikey quicksort (vectorised:
   only ties go on to the next eight bytes) and reads from the neighbours'
   common prefixes which windows are equal. Splitters never part one token's
   spans, so only the tokens of step 3 have neighbours in other buckets.
3. A token with more than ``HOT`` different spans would make one bucket long:
   its windows are compared across all buckets by 128-bit hashes instead, each
   distinct window sent once by each group.

A null or empty text has no bytes; texts under ``size`` bytes lose nothing;
repeated rows repeat each other; an empty table gives no rows. Matches never
cross rows. A text is held whole by one task, at about 60 bytes of memory for
each of its bytes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm import exchange as ex
from quire.llm.common import text_blocks
from quire.llm.pretoken import ranges

GROUP_BYTES = ex.GROUP_BYTES
BUCKET_BYTES = 24 << 20  # text whose spans make one bucket
HOT_BYTES = 2 << 20  # text whose windows, if all hot, make one bucket: 16 bytes for each byte
TOKEN = 32
HOT = 1024
BATCH = 8192  # spans that a bucket sorts at once
PART_BYTES = 3 << 20  # text whose spans make one sorted bucket
MAX_SPLITTERS = 16_384
SPREAD = 4  # a range's tokens are dealt on by hash into so many parts, or more beyond MAX_SPLITTERS
SAMPLED = 128  # one in so many documents gives splitters
_BASES = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4D
_BYTE = ex.mix(np.arange(1, 257, dtype=np.uint64)), ex.mix(np.arange(1001, 1257, dtype=np.uint64))
SPAN, COLD, HOT_WINDOW = 0, 1, 2  # kinds of answers
COVERED, COMPARE, IS_HOT = 1, 2, 4  # what a span's status says

_SENT = pa.schema([("part", pa.int64()), ("bucket", pa.int32()), ("group", pa.int32()),
                   ("token", pa.binary()), ("span", pa.binary()), ("at", pa.int32()), ("data", pa.binary())])
_SENT_DDL = "part bigint, bucket int, group int, token binary, span binary, at int, data binary"


def _leading(tokens: np.ndarray) -> np.ndarray:
    """Tokens (rows of bytes) as numbers in their order, by their first eight bytes."""
    return np.ascontiguousarray(tokens[:, :8]).view(">u8").reshape(-1).astype(np.uint64) >> np.uint64(1)


def sliding_argmin(h: np.ndarray, width: int) -> np.ndarray:
    """Position of the least (leftmost) value's upper half in each ``width`` values."""
    n = len(h)
    key = (h & np.uint64(0xFFFFFFFF00000000)) | np.arange(n, dtype=np.uint64)
    rows = -(-n // width)
    pad = np.full(rows * width, np.iinfo(np.uint64).max, np.uint64)
    pad[:n] = key
    pad = pad.reshape(rows, width)
    left = np.minimum.accumulate(pad, axis=1).reshape(-1)
    right = np.minimum.accumulate(pad[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    least = np.minimum(right[:n - width + 1], left[width - 1:n])
    return (least & np.uint64(0xFFFFFFFF)).astype(np.int64)


class _Group:
    """Bytes, spans and windows of one group of texts."""

    def __init__(self, texts: list[str], size: int, n_buckets: int, bits: int, n_hot: int = 1):
        raw = [t.encode() for t in texts]
        self.size, self.n_hot = size, n_hot
        self.lens = np.array([len(b) for b in raw], np.int64)
        self.bytes = b"".join(raw)
        self.data = np.frombuffer(self.bytes, np.uint8)
        n = len(self.data)
        self.first = self.count = self.at = np.empty(0, np.int64)
        token_keys = np.empty(0, np.uint64)
        if n >= size:
            tokens = ex.window_hashes(_BYTE[0][self.data], TOKEN, _BASES[0])
            best = sliding_argmin(tokens, size - TOKEN + 1)
            left = np.repeat(np.cumsum(self.lens), self.lens)[:len(best)] - np.arange(len(best))
            inside = left >= size  # the window ends in its text
            new = inside.copy()
            new[1:] &= (best[1:] != best[:-1]) | ~inside[:-1]
            self.first = np.flatnonzero(new)
            self.at = best[self.first]
            stop = np.flatnonzero(inside & np.append(~inside[1:] | new[1:], True)) + 1
            self.count = stop - self.first
            # the token is the one of least hash, so all of these hashes are small: buckets go by another
            token_keys = ex.mix(tokens[self.at] ^ np.uint64(_BASES[1])) >> np.uint64(64 - bits)
        span = self._span_hashes()
        order = np.lexsort((span, token_keys))
        fresh = ex.run_starts(token_keys[order], span[order])
        self.item = np.empty(len(order), np.int64)
        self.item[order] = np.cumsum(fresh) - 1
        self.keys, self.span_keys = token_keys[order][fresh], span[order][fresh]
        self.example = order[fresh]  # one span of each item
        self.multi = np.bincount(self.item, minlength=len(self.keys)) > 1
        self.cuts = ex.bucket_cuts(self.keys, n_buckets, bits)

    def _span_hashes(self) -> np.ndarray:
        n = len(self.data)
        if not len(self.first):
            return np.empty(0, np.uint64)
        up = np.full(n, _BASES[1], np.uint64)
        up[0] = 1
        np.multiply.accumulate(up, out=up)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_BYTE[1][self.data] * up, out=sums[1:])
        inverse = np.full(n, pow(_BASES[1], -1, 1 << 64), np.uint64)
        inverse[0] = 1
        np.multiply.accumulate(inverse, out=inverse)
        h = (sums[self.first + self.count + self.size - 1] - sums[self.first]) * inverse[self.first]
        shape = (self.count << 32 | (self.at - self.first)).astype(np.uint64)
        return ex.mix(ex.mix(h) + ex.mix(shape))

    def spans(self, group: int) -> pa.Table:
        # several items may share a token's hash: the first value, the steps, zero steps included
        return ex.messages(group, self.cuts, lambda lo, hi: ex.pack_sorted(self.keys[lo:hi]),
                           lambda lo, hi: self.span_keys[lo:hi].tobytes() + np.packbits(self.multi[lo:hi]).tobytes())

    def settle_spans(self, replies: pa.Table) -> None:
        self.status = ex.statuses(replies, SPAN, self.cuts)

    def _hot_windows(self) -> None:
        """Distinct windows of the group's hot spans, and where they are."""
        hot = self.example[(self.status & (COMPARE | IS_HOT)) == (COMPARE | IS_HOT)]
        self.hot_starts = ranges(self.first[hot], self.count[hot])
        if not len(hot):
            a = b = np.empty(0, np.uint64)
        else:
            a, b = (ex.window_hashes(t[self.data], self.size, m)[self.hot_starts] for t, m in zip(_BYTE, _BASES))
        order = np.lexsort((b, a))
        a, b = a[order], b[order]
        new = ex.run_starts(a, b)
        self.hot_item = np.empty(len(order), np.int64)
        self.hot_item[order] = np.cumsum(new) - 1
        self.hot_keys = a[new], b[new]
        self.hot_multi = np.bincount(self.hot_item, minlength=int(new.sum())) > 1
        self.hot_cuts = ex.bucket_cuts(self.hot_keys[0], self.n_hot)

    def sent(self, group: int, splitters: np.ndarray, sub: int) -> pa.Table:
        """The spans to compare, by range of their token, and messages of the hot
        ones' windows, by hash; the latter's parts are negative."""
        items = np.flatnonzero((self.status & (COMPARE | IS_HOT)) == COMPARE)
        own = self.example[items]
        tokens = self.data[self.at[own][:, None] + np.arange(TOKEN)] if len(own) else np.empty((0, TOKEN), np.uint8)
        part = np.searchsorted(splitters, _leading(tokens), side="right") * sub + self.keys[items].astype(np.int64) % sub
        lo = self.first[own].tolist()
        stop = (self.first[own] + self.count[own] + self.size - 1).tolist()
        rows = [(p, i, group, t.tobytes(), self.bytes[a:b], at - a, b"")
                for p, i, t, a, b, at in zip(part.tolist(), items.tolist(), tokens, lo, stop, self.at[own].tolist())]
        self._hot_windows()
        a, b = self.hot_keys
        got = ex.messages(group, self.hot_cuts, lambda lo, hi: a[lo:hi].tobytes(),
                          lambda lo, hi: b[lo:hi].tobytes() + np.packbits(self.hot_multi[lo:hi]).tobytes())
        rows += [(-1 - m["bucket"], m["bucket"], group, m["keys"], b"", 0, m["data"]) for m in got.to_pylist()]
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 7, _SENT.types)], schema=_SENT)

    def covered(self, replies: pa.Table) -> np.ndarray:
        """The bytes to remove."""
        starts = []
        whole = np.flatnonzero(self.status[self.item] & COVERED)
        starts.append(ranges(self.first[whole], self.count[whole]))
        for kind, item, status in zip(*(replies.column(c).to_pylist() for c in ("kind", "bucket", "status"))):
            if kind == COLD:
                s = self.example[item]
                bits = np.unpackbits(np.frombuffer(status, np.uint8), count=int(self.count[s]))
                starts.append(self.first[s] + np.flatnonzero(bits))
        self._hot_windows()
        starts.append(self.hot_starts[ex.statuses(replies, HOT_WINDOW, self.hot_cuts)[self.hot_item] > 0])
        again = np.unique(np.concatenate(starts)).astype(np.int64)
        step = np.zeros(len(self.data) + 1, np.int32)
        step[again] = 1
        step -= np.bincount(again + self.size, minlength=len(step))[:len(step)].astype(np.int32)
        return np.cumsum(step)[:-1] > 0


def _judge_spans(table: pa.Table) -> pa.Table:
    keys = [ex.unpack_sorted(k) for k in table.column("keys").to_pylist()]
    counts = np.array([len(k) for k in keys])
    data = table.column("data").to_pylist()
    a = np.concatenate(keys)
    b = np.concatenate([np.frombuffer(d, "<u8", count=n) for d, n in zip(data, counts)])
    multi = np.concatenate([np.unpackbits(np.frombuffer(d, np.uint8, offset=8 * n), count=n) for d, n in zip(data, counts.tolist())])
    group = np.repeat(np.array(table.column("group")), counts)
    order = np.lexsort((group, b, a))
    new_span = ex.run_starts(a[order], b[order])
    span, token = np.cumsum(new_span) - 1, np.cumsum(ex.run_starts(a[order])) - 1
    times = np.bincount(span, weights=1.0 + multi[order])
    distinct = np.bincount(token[new_span])[token]
    found = np.where(times[span] > 1, COVERED, 0) | np.where((distinct > 1) & new_span, COMPARE, 0) | np.where(distinct > HOT, IS_HOT, 0)
    status = np.empty(len(a), np.uint8)
    status[order] = found
    return ex.answers(SPAN, table, counts, status)


def _judge_hot(table: pa.Table) -> pa.Table:
    first = [np.frombuffer(k, "<u8") for k in table.column("token").to_pylist()]
    counts = np.array([len(k) for k in first])
    data = table.column("data").to_pylist()
    a = np.concatenate(first)
    b = np.concatenate([np.frombuffer(d, "<u8", count=n) for d, n in zip(data, counts)])
    multi = np.concatenate([np.unpackbits(np.frombuffer(d, np.uint8, offset=8 * n), count=n) for d, n in zip(data, counts.tolist())])
    order = np.lexsort((b, a))
    run = np.cumsum(ex.run_starts(a[order], b[order])) - 1
    status = np.empty(len(a), bool)
    status[order] = (np.bincount(run, weights=1.0 + multi[order]) > 1)[run]
    return ex.answers(HOT_WINDOW, table, counts, status)


def multikey_sort(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the byte strings ``rows`` (equal width, zero-padded), and the bytes
    that each shares with the one before it in that order."""
    n, width = rows.shape
    words = np.zeros((n, -(-width // 8) * 8), np.uint8)
    words[:, :width] = rows
    words = words.view(">u8").astype(np.uint64)
    order, run = np.arange(n), np.zeros(n, np.int64)
    open_at = np.arange(n)
    for w in range(words.shape[1]):
        if not len(open_at):
            break
        own = order[open_at]
        key, of = words[own, w], run[open_at]
        by = np.lexsort((key, of))
        order[open_at] = own[by]
        new = ex.run_starts(of[by], key[by])
        run[open_at] = open_at[new][np.cumsum(new) - 1]
        size = np.bincount(np.cumsum(new) - 1)
        open_at = open_at[(size > 1)[np.cumsum(new) - 1]]
    same = rows[order[1:]] == rows[order[:-1]]
    shared = np.where(same.all(axis=1), width, same.argmin(axis=1)) if n > 1 else np.empty(0, np.int64)
    return order, np.concatenate([[0], shared]).astype(np.int64)


def equal_windows(spans: list[bytes], at: np.ndarray, size: int) -> list[np.ndarray]:
    """For different spans with their token's offset: which of each span's windows
    another span holds too, with the token at the same offset."""
    m = len(spans)
    lens = np.array([len(s) for s in spans])
    count = lens - size + 1
    ends = np.cumsum(lens)
    flat = np.frombuffer(b"".join(spans), np.uint8)
    begin = ends - lens
    right_len, cols = lens - at, np.arange(size)
    right = np.where(cols < right_len[:, None], flat[np.minimum((begin + at)[:, None] + cols, len(flat) - 1)], 0).astype(np.uint8)
    left = np.where(cols < at[:, None], flat[np.maximum((begin + at)[:, None] - 1 - cols, 0)], 0).astype(np.uint8)
    out = [np.zeros(c, bool) for c in count]
    (r_order, r_shared), (l_order, l_shared) = multikey_sort(right), multikey_sort(left)
    r_class, l_class = np.empty(m, np.int64), np.empty(m, np.int64)
    low, high = at - count + 1, at
    for before in range(int(low.min()), int(high.max()) + 1):  # bytes of the window before the token
        ok = np.flatnonzero((low <= before) & (before <= high))
        if len(ok) < 2:
            continue
        r_class[r_order] = np.cumsum(r_shared < size - before)
        l_class[l_order] = np.cumsum(l_shared < before)
        _, item, times = np.unique(r_class[ok] * (m + 1) + l_class[ok], return_inverse=True, return_counts=True)
        for i in ok[times[item] > 1].tolist():
            out[i][at[i] - before] = True
    return out


def _judge_part(size: int):
    """Answers for one part: sorted spans, or hot windows."""

    def judge(table: pa.Table) -> pa.Table:
        if table.column("part")[0].as_py() < 0:
            return _judge_hot(table)
        n = table.num_rows
        token = np.frombuffer(b"".join(table.column("token").to_pylist()), np.uint8).reshape(n, TOKEN)
        order, shared = multikey_sort(token)
        new = np.flatnonzero(shared < TOKEN)
        new[0] = 0
        spans, at = table.column("span"), np.array(table.column("at"), np.int64)
        group, item = table.column("group").to_pylist(), table.column("bucket").to_pylist()
        out, lo = [], 0
        while lo < n:  # whole tokens, about BATCH spans at once
            k = np.searchsorted(new, min(lo + BATCH, n))
            hi = int(new[k]) if k < len(new) else n
            own = order[lo:hi]
            hit = equal_windows(spans.take(pa.array(own)).to_pylist(), at[own], size)
            out += [(COLD, group[i], item[i], np.packbits(x).tobytes()) for i, x in zip(own.tolist(), hit) if x.any()]
            lo = hi
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * 4, ex.ANSWER.types)], schema=ex.ANSWER)

    return judge


def _splitters(docs: DataFrame, size: int, n: int) -> np.ndarray:
    """``n - 1`` splitters of the tokens' order, from a share of the documents."""
    if n < 2:
        return np.empty(0, np.uint64)

    def tokens(batches):
        for _, texts in text_blocks(batches, max_bytes=GROUP_BYTES):
            g = _Group(texts, size, 1, 64)
            lead = _leading(g.data[g.at[:, None] + np.arange(TOKEN)]) if len(g.at) else np.empty(0, np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array(lead.astype(np.int64))], ["lead"])

    some = docs.where(F.pmod(F.xxhash64("text", "doc_id"), F.lit(SAMPLED)) == 0).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    at = [i / n for i in range(1, n)]
    found = some.mapInArrow(tokens, "lead bigint").agg(F.percentile_approx("lead", at, 50_000)).first()[0]
    return np.unique(np.array(found or [], np.uint64))


def dedup(docs: DataFrame, size: int = 200) -> DataFrame:
    """``(doc_id, n_bytes, n_removed, n_spans, kept)`` for every document; ``kept``
    are the bytes that stay, ``n_spans`` the maximal removed runs."""
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    total = ex.text_bytes(own, "text")
    n_groups, n_buckets, n_hot = (max(1, -(-total // b)) for b in (GROUP_BYTES, BUCKET_BYTES, HOT_BYTES))
    bits = min(64, max(total, 2).bit_length() + 6)
    grouped = ex.into_groups(own, "doc_id", "text", n_groups, GROUP_BYTES)

    parts = max(1, -(-total // PART_BYTES))
    n_ranges = min(parts, MAX_SPLITTERS)
    sub = max(SPREAD, -(-parts // n_ranges))
    splitters = _splitters(own, size, n_ranges)

    def load(rows: pa.Table) -> _Group:
        return _Group(ex.texts_of(rows, "text"), size, n_buckets, bits, n_hot)

    def send_spans(rows: pa.Table) -> pa.Table:
        return load(rows).spans(ex.group_of(rows))

    def send_compared(rows: pa.Table, replies: pa.Table) -> pa.Table:
        if not rows.num_rows or not replies.num_rows:
            return _SENT.empty_table()
        g = load(rows)
        g.settle_spans(replies)
        return g.sent(ex.group_of(rows), splitters, sub)

    def remove(rows: pa.Table, replies: pa.Table) -> pa.Table:
        g = load(rows)
        g.settle_spans(replies)
        gone = g.covered(replies)
        ends = np.cumsum(g.lens)
        begin = ends - g.lens
        upto = np.concatenate([[0], np.cumsum(gone)])
        edge = gone.copy()
        edge[1:] &= ~gone[:-1]
        starts = begin[(g.lens > 0)]
        edge[starts] = gone[starts]
        runs = np.concatenate([[0], np.cumsum(edge)])
        stay = g.data[~gone].tobytes()
        kept = [stay[a - x:b - y] for a, b, x, y in zip(begin.tolist(), ends.tolist(), upto[begin].tolist(), upto[ends].tolist())]
        return pa.Table.from_arrays(
            [rows.column("doc_id"), pa.array(g.lens), pa.array(upto[ends] - upto[begin]), pa.array(runs[ends] - runs[begin]),
             pa.array(kept, pa.binary())], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])

    spans = ex.ask(grouped, send_spans).groupBy("bucket").applyInArrow(_judge_spans, ex.ANSWER_DDL)
    judged = (ex.replied(grouped, spans, send_compared, _SENT_DDL)
              .groupBy("part").applyInArrow(_judge_part(size), ex.ANSWER_DDL))
    return ex.replied(grouped, spans.unionByName(judged), remove,
                      "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary")
