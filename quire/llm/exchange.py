"""Sets of hashes exchanged between text groups and hash buckets.

Rows are dealt into groups of a few megabytes of text; equal rows too many
for one group are dealt over all. A group sends each
bucket of hash values one message: the distinct values it holds there, sorted
and delta-coded, with a few bytes beside each. A value repeated in a group,
however often, is sent once, so no bucket grows with a hot value. A bucket
answers each message with one status byte for each value it asks about. The
answers meet the texts again by group.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.llm.common import release, settle

GROUP = "__group"
GROUP_BYTES = 2 << 20
ROW_BYTES = 64  # what a row counts besides its text
MESSAGE = pa.schema([("bucket", pa.int32()), ("group", pa.int32()), ("keys", pa.binary()), ("data", pa.binary())])
MESSAGE_DDL = "bucket int, group int, keys binary, data binary"
ANSWER = pa.schema([("kind", pa.int32()), ("group", pa.int32()), ("bucket", pa.int32()), ("status", pa.binary())])
ANSWER_DDL = "kind int, group int, bucket int, status binary"


def text_bytes(docs: DataFrame, text_col: str) -> int:
    return int(docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0)


def into_groups(docs: DataFrame, id_col: str, text_col: str, n_groups: int, group_bytes: int = GROUP_BYTES) -> DataFrame:
    """All columns and the row's group, by a hash of id and text.

    Rows of one id and text that together exceed ``group_bytes`` are dealt over
    all groups by partition and row number, and written, so that every pass
    finds a row in the same group."""
    if n_groups < 2:
        return docs.select("*", F.lit(0).alias(GROUP))
    key = F.xxhash64(id_col, text_col)
    size = F.coalesce(F.octet_length(text_col), F.lit(0)) + ROW_BYTES
    heavy = settle(docs.groupBy(key.alias("__heavy")).agg(F.sum(size).alias("n")).where(F.col("n") > group_bytes).select("__heavy"), "heavy-rows")

    def dealt(rows: DataFrame, by: Column) -> DataFrame:
        return rows.select("*", F.pmod(by, F.lit(n_groups)).cast("int").alias(GROUP))

    if heavy.isEmpty():
        return dealt(docs, key)
    few = F.broadcast(heavy)  # at most one for each ``group_bytes`` of the corpus
    often = docs.join(few, key == F.col("__heavy"), "left_semi")
    often = settle(dealt(often, F.xxhash64(F.monotonically_increasing_id())), "heavy-dealt")
    return dealt(docs.join(few, key == F.col("__heavy"), "left_anti"), key).unionAll(often)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def window_hashes(values: np.ndarray, size: int, base: int) -> np.ndarray:
    """Hash of every ``size`` consecutive 64-bit values: a polynomial in the odd
    ``base`` modulo 2**64, from prefix sums, then mixed."""
    n = len(values)
    if n < size:
        return np.empty(0, np.uint64)
    up = np.full(n, base, np.uint64)
    up[0] = 1
    np.multiply.accumulate(up, out=up)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(values * up, out=sums[1:])
    down = np.full(n - size + 1, pow(base, -1, 1 << 64), np.uint64)
    down[0] = 1
    np.multiply.accumulate(down, out=down)
    return mix((sums[size:] - sums[:-size]) * down)


def pack_sorted(v: np.ndarray) -> bytes:
    """Sorted distinct unsigned values as first value, width and byte planes of
    the differences."""
    steps = np.diff(v)
    width = max(1, (int(steps.max()).bit_length() + 7) // 8) if len(steps) else 1
    planes = np.ascontiguousarray(steps.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T)
    return int(v[0]).to_bytes(8, "little") + bytes([width]) + planes.tobytes()


def unpack_sorted(b: bytes) -> np.ndarray:
    width = b[8]
    planes = np.frombuffer(b, np.uint8, offset=9).reshape(width, -1)
    out = np.zeros((planes.shape[1] + 1, 8), np.uint8)
    out[1:, :width] = planes.T
    out = out.view("<u8").reshape(-1)
    out[0] = int.from_bytes(b[:8], "little")
    return np.cumsum(out, dtype=np.uint64)


def bucket_cuts(keys: np.ndarray, n_buckets: int, bits: int = 64) -> np.ndarray:
    """Where each bucket's share of the sorted ``bits``-bit ``keys`` begins; one
    more at the end. Buckets are equal ranges of values."""
    bounds = np.array([-(-(b << bits) // n_buckets) for b in range(1, n_buckets)], np.uint64)
    return np.concatenate([[0], np.searchsorted(keys, bounds), [len(keys)]]).astype(np.int64)


def messages(group: int, cuts: np.ndarray, keys: Callable[[int, int], bytes], data: Callable[[int, int], bytes]) -> pa.Table:
    """The group's messages, from ``keys`` and ``data`` of each bucket's range of items."""
    rows = [(b, group, keys(lo, hi), data(lo, hi)) for b, (lo, hi) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist())) if hi > lo]
    return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 4, MESSAGE.types)], schema=MESSAGE)


def answers(kind: int, table: pa.Table, counts: np.ndarray, status: np.ndarray) -> pa.Table:
    """One answer for each message of a bucket; ``counts``: statuses of each."""
    ends = np.cumsum(counts)
    raw = status.astype(np.uint8).tobytes()
    n = table.num_rows
    return pa.Table.from_arrays(
        [pa.array(np.full(n, kind, np.int32)), table.column("group"), table.column("bucket"),
         pa.array([raw[a:b] for a, b in zip((ends - counts).tolist(), ends.tolist())], pa.binary())], schema=ANSWER)


def statuses(replies: pa.Table, kind: int, cuts: np.ndarray) -> np.ndarray:
    """The answers of one kind to a group, one status for each of its items."""
    out = np.zeros(int(cuts[-1]), np.uint8)
    for k, b, s in zip(*(replies.column(c).to_pylist() for c in ("kind", "bucket", "status"))):
        if k == kind:
            out[cuts[b]:cuts[b + 1]] = np.frombuffer(s, np.uint8)
    return out


def run_starts(*keys: np.ndarray) -> np.ndarray:
    """True where sorted ``keys`` differ from the item before."""
    new = np.ones(len(keys[0]), bool)
    if len(new):
        new[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
    return new


def ask(grouped: DataFrame, send: Callable[[pa.Table], pa.Table]) -> DataFrame:
    """Messages of every group."""
    return grouped.groupBy(GROUP).applyInArrow(send, MESSAGE_DDL)


def texts_of(table: pa.Table, text_col: str) -> list[str]:
    release()
    return [t or "" for t in table.column(text_col).to_pylist()]


def group_of(table: pa.Table) -> int:
    return table.column(GROUP)[0].as_py()


def replied(grouped: DataFrame, replies: DataFrame, use: Callable[[pa.Table, pa.Table], pa.Table], ddl) -> DataFrame:
    """``use`` on every group's rows and the answers to it."""

    return grouped.groupBy(GROUP).cogroup(replies.groupBy("group")).applyInArrow(use, ddl)
