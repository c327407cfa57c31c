"""Exact top-k inner-product search with MaxScore pruning.

Dimensions are the terms, a vector's quantised components its postings, a
query's components the term weights. Rows and queries are dealt into cells of
a bounded number of both. In a cell, for each query, a term's bound is its
largest possible gain over its worst value there. Terms whose bounds together
cannot reach the query's k-th best score so far are non-essential: all rows
are scored on the essential terms only, and the others are probed, largest
bound first, only for rows that stay competitive. The cells' top lists are
merged by query.

A null vector, one with a null or non-finite component, and a row without an
id take no part. A component or a score that does not fit 64 bits raises an error
that names the row. A vector shorter than another counts as zero beyond its end.
Equal scores are ordered by id; repeated rows are candidates each for itself.
Fewer candidates than ``k`` give fewer rows; an empty table gives none.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quire.llm.common import settle

CELL_ROWS, CELL_QUERIES = 4096, 512
PROBE = 8  # non-essential terms probed between two prunings
_HITS = pa.schema([("query", pa.int64()), ("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])


def quantised(vectors: DataFrame, scale: int, id_col: str, vector_col: str) -> DataFrame:
    """``(row, vec_id, v)`` with ``v`` the components ``floor(scale * x)`` as
    little-endian 64-bit integers."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            col = batch.column(1)
            out = []
            for x in col:
                v = x.values
                if v is None or v.null_count:
                    out.append(None)
                    continue
                v = v.to_numpy(zero_copy_only=False).astype(np.float64)
                if not np.isfinite(v).all():
                    out.append(None)
                    continue
                with np.errstate(over="ignore"):
                    v = np.floor(v * scale)
                if len(v) and not np.abs(v).max() < 2.0**63:
                    raise ValueError(f"{id_col} {batch.column(0)[len(out)].as_py()}: a component times {scale} does not fit 64 bits")
                out.append(v.astype("<i8").tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], ["vec_id", "v"])

    own = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("x")).where("vec_id is not null")
    return (own.mapInArrow(run, "vec_id bigint, v binary").where("v is not null")
            .select(F.monotonically_increasing_id().alias("row"), "vec_id", "v"))


def _matrix(raw: list[bytes], width: int) -> np.ndarray:
    out = np.zeros((len(raw), width), np.int64)
    for i, b in enumerate(raw):
        out[i, :len(b) // 8] = np.frombuffer(b, "<i8")
    return out


def maxscore(rows: np.ndarray, ids: np.ndarray, row_no: np.ndarray, query: np.ndarray, own: int, k: int) -> list[tuple[int, int]]:
    """The ``k`` best ``(score, position)`` of ``rows`` (terms x vectors) for one
    query; ``own`` is the query's own row number. Ties go to the smaller id."""
    best, worst = _extremes(rows)
    high, low = np.maximum(query * best, query * worst), np.minimum(query * best, query * worst)
    order = np.argsort(low - high, kind="stable")  # largest bound first
    rest = np.concatenate([np.cumsum((high - low)[order][::-1])[::-1], [0]])  # bounds of the terms from here on
    floor = low.sum()
    n = rows.shape[1]
    found = np.empty(0, np.int64)
    found_score = np.empty(0, rows.dtype)

    def top(position: np.ndarray, score: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        by = np.lexsort((ids[position], -score))[:k]
        return position[by], score[by]

    step = 512  # the first rows are scored in full and give the first threshold
    for lo in range(0, n, step):
        here = np.arange(lo, min(lo + step, n))
        here = here[row_no[here] != own]
        if len(found) < k:
            score = query @ rows[:, here]
        else:
            limit = found_score[-1]
            # essential: the shortest run of largest-bound terms without which no row reaches the limit
            essential = int(np.searchsorted(-(floor + rest), -limit, side="right"))
            terms = order[:essential]
            score = query[terms] @ rows[terms][:, here]
            left = np.concatenate([[0], np.cumsum(high[order[essential:]][::-1])])[::-1]  # most that the others add
            stay = score + left[0] >= limit
            here, score = here[stay], score[stay]
            for at in range(essential, len(order), PROBE):
                if not len(here):
                    break
                terms = order[at:at + PROBE]
                score = score + query[terms] @ rows[terms][:, here]
                stay = score + left[min(at + PROBE, len(order)) - essential] >= limit
                here, score = here[stay], score[stay]
        found, found_score = top(np.concatenate([found, here]), np.concatenate([found_score, score]))
    return list(zip(found_score.tolist(), found.tolist()))


def _in_python(rows: np.ndarray, ids: np.ndarray, row_no: np.ndarray, query: np.ndarray, own: int, k: int) -> list[tuple[int, int]]:
    """``maxscore`` by integers of any size, for components whose bounds do not fit 64 bits."""
    score = query.astype(object) @ rows.astype(object)
    order = sorted((i for i in range(len(ids)) if row_no[i] != own), key=lambda i: (-score[i], ids[i]))
    return [(int(score[i]), i) for i in order[:k]]


_extremes_of: list = [None, None]


def _extremes(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each term's largest and least component in the cell; kept for its queries."""
    if _extremes_of[0] is not rows:
        _extremes_of[:] = [rows, (rows.max(axis=1), rows.min(axis=1))]
    return _extremes_of[1]


def top_k(vectors: DataFrame, k: int = 5, query_every: int = 50, scale: int = 256,
          id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` best other rows of each row
    whose id is divisible by ``query_every``."""
    data = settle(quantised(vectors, scale, id_col, vector_col), "topk")
    is_query = F.pmod("vec_id", F.lit(query_every)) == 0
    n, n_queries = data.agg(F.count("*"), F.count(F.when(is_query, 1))).first()
    shards, sets = max(1, -(-n // CELL_ROWS)), max(1, -(-n_queries // CELL_QUERIES))

    def dealt(df: DataFrame, parts: int, own: str, others: int, other: str) -> DataFrame:
        return df.select("row", "vec_id", "v", F.pmod(F.xxhash64("row"), F.lit(parts)).alias(own),
                         F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(others - 1).cast("bigint"))).alias(other))

    rows = dealt(data, shards, "shard", sets, "set").select("shard", "set", "row", "vec_id", "v")
    queries = dealt(data.where(is_query), sets, "set", shards, "shard").select(
        "shard", "set", F.col("row").alias("q_row"), F.col("vec_id").alias("query_id"), F.col("v").alias("q"))

    def cell(mine: pa.Table, asked: pa.Table) -> pa.Table:
        if not mine.num_rows or not asked.num_rows:
            return _HITS.empty_table()
        raw, q_raw = mine.column("v").to_pylist(), asked.column("q").to_pylist()
        width = max(map(len, raw + q_raw)) // 8
        m, q = _matrix(raw, width).T.copy(), _matrix(q_raw, width)
        if width and float(np.abs(q).max()) * float(np.abs(m).max()) * width < 2**52:  # exact in doubles, and faster
            m, q = m.astype(np.float64), q.astype(np.float64)
        ids, row_no = np.array(mine.column("vec_id")), np.array(mine.column("row"))
        huge = width and float(np.abs(q.astype(np.float64)).max()) * float(np.abs(m.astype(np.float64)).max()) * width >= 2**62
        out = []
        for own, qid, x in zip(asked.column("q_row").to_pylist(), asked.column("query_id").to_pylist(), q):
            found = _in_python(m, ids, row_no, x, own, k) if huge else maxscore(m, ids, row_no, x, own, k)
            if huge and any(not -(1 << 63) <= s < 1 << 63 for s, _ in found):
                raise ValueError(f"{id_col} {qid}: a score does not fit 64 bits")
            out += [(own, qid, int(ids[i]), int(s)) for s, i in found]
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * 4, _HITS.types)], schema=_HITS)

    hits = rows.groupBy("shard", "set").cogroup(queries.groupBy("shard", "set")).applyInArrow(
        cell, "query bigint, query_id bigint, vec_id bigint, score bigint")
    best = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "vec_id"))
    return hits.select("query_id", best.alias("rank"), "vec_id", "score").where(F.col("rank") <= k)
