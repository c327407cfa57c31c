"""Hard-negative mining with an inverted multi-index.

An anchor's positives are the rows of its label with the largest inner product;
its negatives for a positive are the rows of other labels whose score is
largest inside a window below the positive's score.

Rows are dealt into shards of about ``SHARD_BYTES``, anchors into sets. A shard cuts its vectors
in two halves, learns a codebook for each half from all of them, and files every
row in the cell of its two codewords. A codeword's bound for an anchor's half is
its inner product with it plus the codeword's radius times the half's length; a
cell's is the sum of its two, so no row of the cell scores higher. The
multi-sequence heap gives each anchor the cells in falling order of their
bounds. Anchors visit cells in waves, each of about twice the rows of the one
before, and those that want the same cell score its rows together, exactly. An
anchor's visit ends once every list asked for is certified: it is full and its
last score is above the next cell's bound, or the window lies above that bound.
Shards' lists are merged by anchor.

Scores are exact integers: components are ``floor(scale * x)``. Equal scores are
ordered by the smaller id. Rows with a null id, label or vector, or with a null
or non-finite component take no part; a vector shorter than another counts as
zero beyond its end; a component or score that does not fit 64 bits raises an
error that names the row. Repeated rows are candidates each for itself; fewer
candidates give fewer rows, an empty table none. Other columns are not read.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quire.llm.common import settle

SHARD_BYTES, SET_BYTES = 16 << 20, 2 << 20  # of 8-byte components: 32,768 rows and 4,096 anchors of 64
CODEWORDS = 16  # of each half: 256 cells of a shard
ROUNDS = 6  # of fitting a codebook
FIRST_WAVE = 512  # rows that an anchor visits before its lists are first looked at
TOGETHER = 1024  # rows, and anchors, that are scored in one step
HELD = 1 << 20  # rows offered to lists before these are cut
_HITS = pa.schema([("anchor", pa.int64()), ("slot", pa.int32()), ("vec_id", pa.int64()), ("score", pa.int64())])
_HITS_DDL = "anchor bigint, slot int, vec_id bigint, score bigint"


def quantised(vectors: DataFrame, scale: int, id_col: str, label_col: str, vector_col: str) -> DataFrame:
    """``(row, vec_id, label, v)`` of the rows that take part; ``v``: components
    ``floor(scale * x)`` as little-endian 64-bit integers."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            col = batch.column(2)
            flat = col.flatten()
            lens = np.array(col.value_lengths(), np.int64)
            of = np.repeat(np.arange(len(lens)), lens)
            x = flat.cast(pa.float64()).fill_null(np.nan).to_numpy(zero_copy_only=False)
            out = np.bincount(of[~np.isfinite(x)], minlength=len(lens)) > 0
            x = np.floor(np.where(np.isfinite(x), x, 0.0) * scale)
            if len(far := np.flatnonzero(~(np.abs(x) < 2.0**63) & ~out[of])):
                row = batch.column(0)[int(of[far[0]])].as_py()
                raise ValueError(f"{id_col} {row}: a component times {scale} does not fit 64 bits")
            x = np.where(out[of], 0, x).astype("<i8")
            offsets = np.concatenate([[0], np.cumsum(lens)]) * 8
            v = pa.Array.from_buffers(pa.binary(), len(lens), [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(x)])
            kept = pa.array(~out)
            yield pa.RecordBatch.from_arrays([c.filter(kept) for c in (batch.column(0), batch.column(1), v)], ["vec_id", "label", "v"])

    own = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("long").alias("label"), F.col(vector_col).alias("x"))
    return (own.where("vec_id is not null and label is not null and x is not null")
            .mapInArrow(run, "vec_id bigint, label bigint, v binary")
            .select(F.monotonically_increasing_id().alias("row"), "vec_id", "label", "v"))


def _matrix(raw: list[bytes], width: int) -> np.ndarray:
    out = np.zeros((len(raw), width), np.int64)
    for i, b in enumerate(raw):
        out[i, :len(b) // 8] = np.frombuffer(b, "<i8")
    return out


def codebook(x: np.ndarray, k: int = CODEWORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codewords of the rows of ``x``, each row's codeword, and the codewords'
    radii: the largest distance of their rows."""
    rng = np.random.default_rng(7)
    distinct = x[np.sort(rng.permutation(len(x))[:4 * k])]
    words = np.unique(distinct, axis=0)
    words = words[rng.permutation(len(words))[:k]]
    own = np.zeros(len(x), np.int64)
    square = (x * x).sum(axis=1)
    for _ in range(ROUNDS):
        far = square[:, None] - 2 * x @ words.T + (words * words).sum(axis=1)
        own = far.argmin(axis=1)
        size = np.bincount(own, minlength=len(words))
        sums = np.zeros_like(words)
        np.add.at(sums, own, x)
        words = np.where(size[:, None] > 0, sums / np.maximum(size, 1)[:, None], words)
    radius = np.zeros(len(words))
    np.maximum.at(radius, own, np.sqrt(((x - words[own]) ** 2).sum(axis=1)))
    return words, own, radius


class MultiIndex:
    """Rows filed by the codewords of their halves, in a cell by label."""

    def __init__(self, v: np.ndarray, ids: np.ndarray, labels: np.ndarray, row_no: np.ndarray):
        half = v.shape[1] // 2
        self.cut = half
        self.books = [codebook(x) for x in (v[:, :half].astype(np.float64), v[:, half:].astype(np.float64))]
        (w1, c1, _), (w2, c2, _) = self.books
        cell = c1 * len(w2) + c2
        order = np.lexsort((labels, cell))
        self.v, self.ids, self.labels, self.row_no = v[order], ids[order], labels[order], row_no[order]
        self.start = np.searchsorted(cell[order], np.arange(len(w1) * len(w2) + 1))

    def bounds(self, q: np.ndarray) -> list[np.ndarray]:
        """Each half's codewords' bounds for an anchor, rounding included."""
        out = []
        for (words, _, radius), part in zip(self.books, (q[:self.cut], q[self.cut:])):
            part = part.astype(np.float64)
            length = np.sqrt(part @ part)
            size = np.sqrt((words * words).sum(axis=1)) + radius
            out.append(words @ part + radius * length + (size * length + 1) * 1e-9)
        return out

    def cells(self, q: np.ndarray) -> Iterator[tuple[float, int]]:
        """Bound and number of every cell that has rows, by falling bounds: the
        multi-sequence heap over the two halves' sorted bounds."""
        first, second = self.bounds(q)
        a, b = np.argsort(-first, kind="stable").tolist(), np.argsort(-second, kind="stable").tolist()
        high, low = first[a].tolist(), second[b].tolist()
        heap = [(-(high[0] + low[0]), 0, 0)]
        start, width = self.start, len(b)
        while heap:
            bound, i, j = heapq.heappop(heap)
            if j + 1 < width:
                heapq.heappush(heap, (-(high[i] + low[j + 1]), i, j + 1))
            if j == 0 and i + 1 < len(a):  # each cell is reached in one way
                heapq.heappush(heap, (-(high[i + 1] + low[0]), i + 1, 0))
            cell = a[i] * width + b[j]
            if start[cell] < start[cell + 1]:
                yield -bound, cell


class Lists:
    """For each anchor and each of its windows ``least <= score <= most`` the ``k``
    best rows. Windows are rows of ``least`` and ``most``, one for each anchor."""

    def __init__(self, least: np.ndarray, most: np.ndarray, k: int):
        self.k, self.least, self.most = k, least, most
        self.width = least.shape[1]
        self.none = -np.inf if least.dtype != np.int64 else np.iinfo(np.int64).min
        self.last = np.full(least.shape, self.none, least.dtype)  # score and id of the last row of a full list
        self.last_id = np.full(least.shape, -1, np.int64)
        self.full = np.zeros(least.shape, bool)
        self.slots, self.ids, self.scores = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, least.dtype)
        self.held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.n_held = 0

    def offer(self, who: np.ndarray, ids: np.ndarray, scores: np.ndarray, allowed: np.ndarray) -> None:
        """Scores of rows (columns) for the anchors ``who`` (rows of ``scores``)."""
        for w in range(self.width):
            low, last, last_id = self.least[who, w][:, None], self.last[who, w][:, None], self.last_id[who, w][:, None]
            better = (scores > last) | ((scores == last) & (ids < last_id)) | ~self.full[who, w][:, None]
            a, r = np.nonzero((allowed & better & (scores >= low) & (scores <= self.most[who, w][:, None])).astype(bool))
            if len(a):
                self.held.append((who[a] * self.width + w, ids[r], scores[a, r]))
                self.n_held += len(a)
        if self.n_held > HELD:
            self.cut()

    def cut(self) -> None:
        """Keep the ``k`` best rows of every list."""
        if not self.held:
            return
        slots, ids, scores = (np.concatenate(x) for x in zip((self.slots, self.ids, self.scores), *self.held))
        if scores.dtype == object:
            order = np.array(sorted(range(len(ids)), key=lambda i: (slots[i], -scores[i], ids[i])))
        else:
            order = np.lexsort((ids, -scores, slots))
        slots, ids, scores = slots[order], ids[order], scores[order]
        place = np.arange(len(slots)) - np.searchsorted(slots, slots)
        end = place == self.k - 1
        at = np.divmod(slots[end], self.width)
        self.last[at], self.last_id[at], self.full[at] = scores[end], ids[end], True
        kept = place < self.k
        self.slots, self.ids, self.scores = slots[kept], ids[kept], scores[kept]
        self.held, self.n_held = [], 0

    def certified(self, who: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """The anchors whose lists rows that score at most ``bounds`` can no longer change."""
        bound = bounds[:, None]
        past = (bound < self.least[who]) | (self.most[who] < self.least[who])
        return (past | (self.full[who] & (bound < self.last[who]))).astype(bool).all(axis=1)


def visit(index: MultiIndex, q: np.ndarray, labels: np.ndarray, own: np.ndarray, lists: Lists, same_label: bool) -> int:
    """Fill ``lists`` with the anchors' best rows of the same label (not the
    anchor's own row), or of others; the number of scores computed."""
    cells = [index.cells(one) for one in q]
    ahead = [next(c, None) for c in cells]
    size = np.diff(index.start).tolist()
    active, wave, scored = np.arange(len(q)), FIRST_WAVE, 0
    while len(active):
        wanted: dict[int, list[int]] = {}
        for a in active.tolist():
            n = 0
            while n < wave and ahead[a] is not None:
                cell = ahead[a][1]
                wanted.setdefault(cell, []).append(a)
                n += size[cell]
                ahead[a] = next(cells[a], None)
        for cell, anchors in wanted.items():
            for lo in range(index.start[cell], index.start[cell + 1], TOGETHER):
                rows = slice(lo, min(lo + TOGETHER, index.start[cell + 1]))
                for k in range(0, len(anchors), TOGETHER):
                    who = np.array(anchors[k:k + TOGETHER])
                    same = labels[who][:, None] == index.labels[rows]
                    allowed = same & (own[who][:, None] != index.row_no[rows]) if same_label else ~same
                    lists.offer(who, index.ids[rows], q[who] @ index.v[rows].T, allowed)
                    scored += allowed.size
        lists.cut()
        bounds = np.array([-np.inf if ahead[a] is None else ahead[a][0] for a in active])
        active = active[~lists.certified(active, bounds) & (bounds > -np.inf)]
        wave *= 2
    return scored


def _exact(rows: np.ndarray, anchors: np.ndarray) -> type:
    """What scores are exact in: doubles, 64-bit integers or, for very large
    components, Python integers."""
    most = float(np.abs(rows.astype(np.float64)).max(initial=0)) * float(np.abs(anchors.astype(np.float64)).max(initial=0)) * max(rows.shape[1], 1)
    return np.float64 if most < 2.0**52 else np.int64 if most < 2.0**62 else object


def _fits(anchors: list[int], ids: list[int], scores: list) -> None:
    for anchor, i, s in zip(anchors, ids, scores):
        if not -(1 << 63) <= int(s) < 1 << 63:
            raise ValueError(f"the score of vec_id {i} for anchor row {anchor} does not fit 64 bits")


def _searched(data: DataFrame, anchors: DataFrame, shards: int, sets: int, k: int, same_label: bool) -> DataFrame:
    """Each shard's lists for each anchor: ``(anchor, slot, vec_id, score)``. Anchors
    may have ``windows``: the least and most score of each."""

    def dealt(df: DataFrame, own: str, parts: int, other: str, others: int) -> DataFrame:
        every = F.explode(F.sequence(F.lit(0), F.lit(others - 1)))
        return df.select("*", F.pmod(F.xxhash64("row"), F.lit(parts)).cast("int").alias(own), every.alias(other))

    def cell(mine: pa.Table, asked: pa.Table) -> pa.Table:
        if not mine.num_rows or not asked.num_rows:
            return _HITS.empty_table()
        raw, a_raw = mine.column("v").to_pylist(), asked.column("v").to_pylist()
        width = max(2, max(map(len, raw + a_raw)) // 8)
        v, q = _matrix(raw, width), _matrix(a_raw, width)
        kind = _exact(v, q)
        index = MultiIndex(v, *(np.array(mine.column(c)) for c in ("vec_id", "label", "row")))
        index.v, q = index.v.astype(kind), q.astype(kind)
        asked_rows = np.array(asked.column("row"))
        far = np.iinfo(np.int64).max
        if "windows" in asked.column_names:
            windows = asked.column("windows").to_pylist()
            slots = max(map(len, windows))
            least, most = (np.array([[w[side] for w in own] + [empty] * (slots - len(own)) for own in windows], dtype=object).astype(kind)
                           for side, empty in (("least", 1), ("most", 0)))
        else:
            least, most = (np.full((len(q), 1), x, dtype=object).astype(kind) for x in (-far, far))
        lists = Lists(least, most, k)
        visit(index, q, np.array(asked.column("label")), asked_rows, lists, same_label)
        of, slot = np.divmod(lists.slots, lists.width)
        if kind is object:
            _fits(asked_rows[of].tolist(), lists.ids.tolist(), lists.scores.tolist())
        return pa.Table.from_arrays([pa.array(asked_rows[of]), pa.array(slot, pa.int32()), pa.array(lists.ids),
                                     pa.array([int(x) for x in lists.scores.tolist()], pa.int64())], schema=_HITS)

    rows = dealt(data, "shard", shards, "set", sets)
    asked = dealt(anchors, "set", sets, "shard", shards)
    return rows.groupBy("shard", "set").cogroup(asked.groupBy("shard", "set")).applyInArrow(cell, _HITS_DDL)


def _merged(hits: DataFrame, k: int, rank: str) -> DataFrame:
    order = Window.partitionBy("anchor", "slot").orderBy(F.desc("score"), "vec_id")
    return hits.withColumn(rank, F.row_number().over(order)).where(F.col(rank) <= k)


def mine(vectors: DataFrame, anchor_every: int = 50, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95,
         scale: int = 256, id_col: str = "vec_id", label_col: str = "label", vector_col: str = "embedding") -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``.

    Anchors are the rows whose id is divisible by ``anchor_every``. Each has its
    first ``positives`` other rows of the same label, and for each of them the
    first ``negatives`` rows of other labels that score between ``low`` and
    ``high`` percent of the positive's score, both included."""
    data = settle(quantised(vectors, scale, id_col, label_col, vector_col), "negatives")
    is_anchor = F.pmod("vec_id", F.lit(anchor_every)) == 0
    n, n_anchors, width = data.agg(F.count("*"), F.count(F.when(is_anchor, 1)), F.max(F.octet_length("v"))).first()
    shards, sets = (max(1, -(-count * max(width or 8, 8) // size)) for count, size in ((n, SHARD_BYTES), (n_anchors, SET_BYTES)))
    anchors = settle(data.where(is_anchor), "negatives-anchors")
    near = _searched(data, anchors.select("row", "label", "v"), shards, sets, positives, True)
    best = _merged(near, positives, "place").select("anchor", "place", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    best = settle(best, "negatives-positives")
    # low * p <= 100 * s <= high * p, in integers
    p = F.col("positive_score").cast("decimal(38,0)")
    window = F.struct("place", F.ceil(low * p / 100).cast("long").alias("least"), F.floor(high * p / 100).cast("long").alias("most"))
    of = best.groupBy(F.col("anchor").alias("row")).agg(F.array_sort(F.collect_list(window)).alias("windows"))
    asked = settle(anchors.join(of, "row").select("row", "label", "v", "windows"), "negatives-asked")
    found = _merged(_searched(data, asked, shards, sets, negatives, False), negatives, "rank")
    found = found.select("anchor", (F.col("slot") + 1).alias("place"), "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
    ids = anchors.select(F.col("row").alias("anchor"), F.col("vec_id").alias("anchor_id"))
    return found.join(best, ["anchor", "place"]).join(ids, "anchor").select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
