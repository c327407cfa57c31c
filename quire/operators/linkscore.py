"""Corpus-wide link scores.

These are *not* the published PageRank: there is no damping and no division
by out-degree. Each document's row is the set of documents it links to or is
cited by; its score is the sum of the scores in its row, or ``1/n`` when that
sum is not positive, and the whole vector is min-max scaled afterwards.

* :func:`ordered_sweep` (L20) is what the reference computes: one pass over
  ids in ascending order where each id already sees the new scores of lower
  ids (an in-place update). That is a triangular solve, done by block forward
  substitution: contiguous blocks of ids one after another, in each block
  first what finished blocks contribute (a join and a sum), then the
  dependencies inside the block in one streaming task.
* :func:`converged` (L22) repeats a synchronous update until the L2 change
  drops below the tolerance, the evident aim of the reference's loop.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.observation import Observation

from quire.functions.scaling import FLAT_RANGE_VALUE, RANGE_MAX_START, RANGE_MIN_START, l2_change_term, minmax_scale
from quire.operators.edges import LARGE_BUCKET, SMALL_BUCKET, PlacedEdges
from quire.operators.graph import minmax_vector
from quire.operators.loop import NoConvergence, RoundState

# Fixed value: tolerance of the link-score stopping test.
LINK_TOL = 1e-5
MAX_ITER = 10_000
#: Rounds between two stop tests of the converged form.
BATCH = 8


def _number(df: DataFrame, n_nodes) -> float:
    """The node count as a number: a scalar column is evaluated once, not in every round's plan."""
    return float(n_nodes if isinstance(n_nodes, (int, float)) else df.sparkSession.range(1).select(n_nodes).first()[0])


#: Ids of one block of the sweep: eight bytes of task memory each.
BLOCK_IDS = 1 << 17
#: More blocks would read the finished scores too often: blocks grow beyond this number.
MAX_BLOCKS = 256


def _substitute(lo: int, size: int, floor: float):
    """Scores of one block from its rows ``(i, j, part)``, sorted: first ``j`` null,
    with what is known of ``i``'s sum, then its neighbours inside the block."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = [0.0] * size
        node, total = None, 0.0

        def result(nodes: list[int]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array([score[i - lo] for i in nodes], pa.float64())],
                                              ["node", "score"])

        for batch in batches:
            done = []
            for i, j, part in zip(*(batch.column(c).to_pylist() for c in range(3))):
                if i != node:
                    if node is not None:
                        score[node - lo] = total if total > 0 else floor
                        done.append(node)
                    node, total = i, 0.0
                total += part if j is None else score[j - lo]
            if done:
                yield result(done)
        if node is not None:
            score[node - lo] = total if total > 0 else floor
            yield result([node])

    return run


def ordered_sweep(rows: DataFrame, nodes: DataFrame, n_nodes, scale: bool = True, block_ids: int = BLOCK_IDS) -> DataFrame:
    """``(node, score)`` after one in-place ascending sweep (+ L21).

    ``rows (i, j)`` are deduplicated row entries (L18); ``nodes (node)`` all
    ids ``0..n-1``; ``n_nodes`` a scalar column or number. Row entries with
    ``j >= i`` (the id itself included) still hold the start value ``1/n``
    when ``i`` is computed, so they add a constant; entries with ``j < i``
    add the final score of ``j``. Row entries of ids that are no nodes, and
    nodes without an id, take no part.

    One job for each block of ``block_ids`` ids (at most ``MAX_BLOCKS`` blocks),
    however long the ascending paths are. The entries lie in a folder for each
    block of ``i``; a block reads its folder and the finished scores once. The
    task that finishes a block holds its scores and streams its inner entries,
    which Spark sorts; the sums over earlier blocks are partly added up before
    their shuffle, so a node of very many neighbours meets no task as a whole.
    """
    spark = rows.sparkSession
    loop = RoundState(spark, "sweep")
    floor = 1.0 / max(_number(rows, n_nodes), 1.0)
    ids = nodes.select(F.col("node").cast("long").alias("node")).where("node is not null").distinct()
    least, most = ids.agg(F.min("node"), F.max("node")).first()
    if least is None:
        return nodes.select("node", F.lit(None).cast("double").alias("score"))
    size = max(block_ids, -(-(most - least + 1) // MAX_BLOCKS))
    blocks = -(-(most - least + 1) // size)

    def block_of(c: str) -> Column:
        return F.floor((F.col(c) - least) / size).cast("int")

    lower = rows.where(F.col("j") < F.col("i")).select("i", "j", block_of("i").alias("b"))
    lower = loop.settle_by(lower.where((F.col("j") >= least) & F.col("b").between(0, blocks - 1)), "b", "lower")
    upper = rows.where(F.col("j") >= F.col("i")).groupBy(F.col("i").alias("node")).agg(F.count(F.lit(1)).alias("n"))
    start = ids.join(upper, "node", "left").select(
        "node", (F.coalesce("n", F.lit(0)) * F.lit(floor)).alias("part"), block_of("node").alias("b"))
    start = loop.settle_by(start, "b", "start")
    known = spark.createDataFrame([], "node bigint, score double")
    for b in range(blocks):
        lo = least + b * size
        own = lower.where(F.col("b") == b)
        begun = start.where(F.col("b") == b).select(F.col("node").alias("i"), "part")
        given = (own.where(F.col("j") < lo).join(known.withColumnRenamed("node", "j"), "j")
                 .groupBy("i").agg(F.sum("score").alias("part")))
        inner = own.where(F.col("j") >= lo).select("i", "j", F.lit(0.0).alias("part"))
        parts = begun.unionByName(given).groupBy("i").agg(F.sum("part").alias("part")) if b else begun
        entries = parts.select("i", F.lit(None).cast("long").alias("j"), "part").unionByName(inner.join(begun.select("i"), "i", "left_semi"))
        solved = entries.repartition(1).sortWithinPartitions("i", F.col("j").asc_nulls_first()).mapInArrow(
            _substitute(lo, size, floor), "node bigint, score double")
        loop.settle(solved, f"scores/block={b}")
        known = spark.read.schema("node bigint, score double").parquet(f"{loop.root}/scores")
    return minmax_vector(known) if scale else known


def converged(rows: DataFrame, nodes: DataFrame, n_nodes, tol: float = LINK_TOL,
              max_iter: int = MAX_ITER, broadcast: bool | None = None) -> DataFrame:
    """Repeat L19 + L21 with a synchronous update until
    ``sqrt(Σ (new-old)^2) < tol``. Returns ``(node, score, rounds)``; raises
    :class:`NoConvergence` when ``max_iter`` rounds do not suffice.

    Hundreds of rounds are usual, and as many jobs would cost far more than their
    sums: a graph of up to ``SMALL_VECTOR`` nodes and ``IN_TASK`` row entries (both
    are counted) is iterated in one task of one job (``_iterate_in_task``).

    The row entries of a larger one stay in place, in buckets, and a round is one job: it writes
    the unscaled vector beside the vector it came from and observes its range;
    the scaling (L21) is applied with that range when the vector is read. The
    changes of ``BATCH`` rounds are one scan of their tables, and the first that
    passes is the result. The vector stays in buckets too (``LinkRounds``).
    ``broadcast`` asks for rounds by jobs for any size, with the vector broadcast
    (``PlacedEdges``; every node has an entry of its own beside its row's, which
    brings its old score along) or in buckets.
    """
    loop = RoundState(rows.sparkSession, "linkscore")
    inv_n = 1.0 / max(_number(rows, n_nodes), 1.0)
    cur, counted = loop.settle_observed(nodes.select("node", F.lit(inv_n).alias("score")), F.count(F.lit(1)).alias("n"))
    n_rows = counted["n"]
    if not broadcast:
        rows, counted = loop.settle_observed(rows.where("i is not null and j is not null").select("i", "j"), F.count(F.lit(1)).alias("n"))
        if broadcast is None and n_rows <= SMALL_VECTOR and counted["n"] <= IN_TASK:
            return _iterated_in_task(loop, rows, counted["n"], cur, inv_n, tol, max_iter)
        placed = LinkRounds(loop, rows, counted["n"], cur)
        try:
            return _iterated(loop, placed.round, cur, inv_n, tol, max_iter)
        finally:
            placed.close()
    entries = rows.select("i", "j", F.lit(False).alias("own")).unionByName(
        nodes.select(F.col("node").alias("i"), F.col("node").alias("j"), F.lit(True).alias("own")))
    edges = PlacedEdges(loop, entries, ["j"], ["i"], n_rows, True)

    def small_round(cur: DataFrame, inv_n: float) -> tuple[DataFrame, dict]:
        return loop.next_round(link_round(edges, cur, inv_n), *_range(), keep=BATCH)

    try:
        return _iterated(loop, small_round, cur, inv_n, tol, max_iter)
    finally:
        edges.close()


#: Nodes, and row entries, of a graph that one task iterates: about a hundred bytes for a node, eight for an entry.
SMALL_VECTOR, IN_TASK = 1 << 20, 1 << 24
#: Entries whose scores the task looks up at once, unless one node has more.
ENTRIES_AT_ONCE = 1 << 20
_SCORES = "node bigint, score double, rounds int"


def _iterate_in_task(n_entries: int, inv_n: float, tol: float, max_iter: int):
    """All rounds over the rows ``(i, j)`` of one task: nodes first, with ``j`` null,
    then the row entries by ``i``. Where no round passes, a single row without a node."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        owner, other, n = np.empty(n_entries, np.int32), np.empty(n_entries, np.int32), 0
        given, nodes, times = [np.empty(0, np.int64)], None, None
        for batch in batches:
            first = batch.column(1).null_count
            given.append(batch.column(0).slice(0, first).to_numpy().copy())
            if first == batch.num_rows:
                continue
            if nodes is None:
                nodes, times = np.unique(np.concatenate(given), return_counts=True)
                if not len(nodes):
                    break
            ends = [batch.column(c).slice(first).to_numpy() for c in (0, 1)]
            at = [np.minimum(np.searchsorted(nodes, e), len(nodes) - 1) for e in ends]
            known = (nodes[at[0]] == ends[0]) & (nodes[at[1]] == ends[1])
            upto = n + int(known.sum())
            owner[n:upto], other[n:upto], n = at[0][known], at[1][known], upto
        if nodes is None:
            nodes, times = np.unique(np.concatenate(given), return_counts=True)
        if not len(nodes):
            return
        owner, other = owner[:n], other[:n]
        start = np.flatnonzero(np.diff(owner, prepend=-1))
        who, start = owner[start], np.append(start, n)
        del owner, given
        cuts = np.unique(np.searchsorted(start, np.arange(0, n + 1, ENTRIES_AT_ONCE)))
        cuts = np.unique(np.append(cuts, len(who)))
        old = np.full(len(nodes), inv_n)
        sent, passed = old * times, None  # a node that is given several times counts so often in the first round
        for r in range(1, max_iter + 1):
            raw = np.full(len(nodes), inv_n)
            for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                s = np.add.reduceat(sent[other[start[a]:start[b]]], start[a:b] - start[a])
                raw[who[a:b]] = np.where(s > 0, s, inv_n)
            lo, hi = min(RANGE_MIN_START, raw.min()), max(RANGE_MAX_START, raw.max())
            new = np.full(len(nodes), FLAT_RANGE_VALUE) if hi == lo else (raw - lo) / (hi - lo)
            new[np.isnan(new)] = 0.0
            change = float(np.sqrt(np.sum((new - old) ** 2)))
            old = sent = new
            if change < tol:
                passed = r
                break
        if passed is None:
            nodes, old = pa.nulls(1, pa.int64()), pa.nulls(1, pa.float64())
        for at in range(0, len(nodes), 1 << 16):
            own = [pa.array(x[at:at + (1 << 16)]) for x in (nodes, old)]
            yield pa.RecordBatch.from_arrays([*own, pa.array([passed] * len(own[0]), pa.int32())], ["node", "score", "rounds"])

    return run


def _iterated_in_task(loop: RoundState, rows: DataFrame, n_entries: int, cur: DataFrame, inv_n: float, tol: float,
                      max_iter: int) -> DataFrame:
    nodes = cur.where("node is not null").select(F.col("node").cast("long").alias("i"), F.lit(None).cast("long").alias("j"))
    every = nodes.unionByName(rows.select(F.col("i").cast("long"), F.col("j").cast("long")))
    solved = every.repartition(1).sortWithinPartitions(F.col("j").isNotNull(), "i").mapInArrow(
        _iterate_in_task(n_entries, inv_n, tol, max_iter), _SCORES)
    out, seen = loop.settle_observed(solved, F.count(F.lit(1)).alias("n"), F.count("node").alias("known"))
    if not seen["n"]:  # no nodes
        return cur.select("node", "score", F.lit(1).alias("rounds"))
    if not seen["known"]:
        raise NoConvergence(f"the link score has not converged in {max_iter} rounds")
    return out.withColumn("node", F.col("node").cast(cur.schema["node"].dataType))


#: Nodes of most row entries, whose scores are broadcast in every round where the vector is larger.
MAX_HUBS = 2048


def _range() -> tuple[Column, Column]:
    return F.max("raw").alias("mx"), F.min("raw").alias("mn")


def link_round(placed: PlacedEdges, cur: DataFrame, inv_n: float) -> DataFrame:
    """One synchronous update: ``(node, old, raw)``."""
    sums = placed.pull(cur.withColumnRenamed("node", "j")).groupBy(F.col("i").alias("node")).agg(
        F.max(F.when(F.col("own"), F.col("score"))).alias("old"), F.sum(F.when(~F.col("own"), F.col("score"))).alias("s"))
    return sums.where(F.col("old").isNotNull()).select(
        "node", "old", F.when(F.col("s") > 0, F.col("s")).otherwise(F.lit(inv_n)).alias("raw"))


class LinkRounds:
    """Rounds on a vector that stays in place: it and the entries lie in tables with
    the same buckets, so neither is shuffled.

    The ``MAX_HUBS`` nodes with most entries send their scores to all buckets (a
    broadcast of fixed size); their entries lie with the node ``i`` that they
    belong to. The other entries lie with ``j``; what a bucket adds up for each
    ``i`` is all that is shuffled, a row for each bucket and ``i`` where ``i`` is a hub.
    """

    def __init__(self, loop: RoundState, rows: DataFrame, n: int, cur: DataFrame):
        self.loop, self.spark, self.tables, self.vectors = loop, loop.spark, [], []
        cores = self.spark.sparkContext.defaultParallelism
        self.buckets = max(1, min(cores, -(-n // SMALL_BUCKET)), -(-n // LARGE_BUCKET))  # a round is one wave of tasks where that will do
        counted = rows.groupBy(F.col("j").alias("node")).agg(F.count(F.lit(1)).alias("n"))
        hubs = loop.settle(counted.where(F.col("n") > self.buckets).orderBy(F.desc("n"), "node").limit(MAX_HUBS).select("node"))
        of_hubs = F.broadcast(hubs.withColumnRenamed("node", "j"))
        self.from_hubs = self._place(rows.join(of_hubs, "j", "left_semi"), "i")
        self.others = self._place(rows.join(of_hubs, "j", "left_anti"), "j")
        # a node that is given several times counts so often in the first round
        first = cur.where("node is not null").groupBy("node").agg(F.max("score").alias("score"), F.sum("score").alias("sent"))
        self.first = self._place(first.join(F.broadcast(hubs.withColumn("hub", F.lit(True))), "node", "left").na.fill(False, ["hub"]), "node")

    def _place(self, df: DataFrame, key: str, path: str | None = None) -> DataFrame:
        name = f"quire_links_{uuid.uuid4().hex[:12]}"
        df = df if path else df.repartition(self.buckets, key)
        df.write.format("parquet").bucketBy(self.buckets, key).option("path", f"{self.loop.root}/{path or name}").saveAsTable(name)
        self.tables.append(name)
        return self.spark.table(name)

    def round(self, cur: DataFrame, inv_n: float) -> tuple[DataFrame, dict]:
        """One synchronous update, written: ``(node, hub, old, raw)`` and its range."""
        if not self.vectors:
            cur = self.first
        elif "sent" not in cur.columns:
            cur = cur.withColumn("sent", F.col("score"))
        sent = cur.select(F.col("node").alias("j"), "sent", "hub")
        low = self.from_hubs.join(F.broadcast(sent.where("hub")), "j").groupBy(F.col("i").alias("node")).agg(F.sum("sent").alias("s1"))
        rest = self.others.hint("merge").join(sent, "j").groupBy(F.col("i").alias("node")).agg(F.sum("sent").alias("s2"))
        s = F.coalesce("s1", F.lit(0.0)) + F.coalesce("s2", F.lit(0.0))
        nxt = cur.join(low.hint("merge"), "node", "left").join(rest.repartition(self.buckets, "node").hint("merge"), "node", "left").select(
            "node", "hub", F.col("score").alias("old"), F.when(s > 0, s).otherwise(F.lit(inv_n)).alias("raw"))
        obs = Observation(f"links-{uuid.uuid4().hex[:8]}")
        name = f"vector{len(self.vectors):06d}"
        out = self._place(nxt.observe(obs, *_range()), "node", name)
        self.vectors.append((name, self.tables[-1]))
        if len(self.vectors) > BATCH + 1:
            old, table = self.vectors[-BATCH - 2]
            self._drop(table)
            self.loop.delete(old)
        return out, obs.get

    def _drop(self, table: str) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {table}")
        self.tables.remove(table)

    def close(self) -> None:
        """Take the tables out of the catalog; the files of the last rounds stay with the loop's."""
        for table in [*self.tables]:
            self._drop(table)


def _iterated(loop: RoundState, one_round, cur: DataFrame, inv_n: float, tol: float, max_iter: int) -> DataFrame:
    rounds: list[tuple[int, DataFrame, Column]] = []
    for r in range(1, max_iter + 1):
        nxt, m = one_round(cur, inv_n)
        if m["mx"] is None:  # no nodes
            return cur.select("node", "score", F.lit(r).alias("rounds"))
        lo, hi = min(RANGE_MIN_START, m["mn"]), max(RANGE_MAX_START, m["mx"])
        ends = [F.lit(lo), F.lit(hi)]
        if "hub" in nxt.columns:
            # read from an array by a column: plain numbers would become part of the generated
            # code, which every executor would then compile anew in every round
            ends = [F.get(F.array(F.lit(lo), F.lit(hi)), F.col("hub").cast("int") * 0 + k) for k in (0, 1)]
        scaled = minmax_scale("raw", *ends, digits=None)
        cur = nxt.select("node", *(c for c in nxt.columns if c == "hub"), scaled.alias("score"))
        rounds.append((r, nxt, scaled))
        if len(rounds) == BATCH or r == max_iter:
            changes = reduce(DataFrame.unionByName, (t.select(F.lit(k).alias("r"), l2_change_term(new, "old").alias("d"))
                                                     for k, t, new in rounds))
            passed = [x.r for x in changes.groupBy("r").agg(F.sqrt(F.sum("d")).alias("c")).where(F.col("c") < tol).collect()]
            if passed:
                k, t, new = next(x for x in rounds if x[0] == min(passed))
                files = loop.spark.read.schema(t.schema).parquet(*t.inputFiles()) if "hub" in t.columns else t
                return files.select("node", new.alias("score"), F.lit(k).alias("rounds"))
            rounds = []
    raise NoConvergence(f"the link score has not converged in {max_iter} rounds")
