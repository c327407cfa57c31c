"""Hubs and authorities on each query's base set.

All queries of a batch iterate together: the state holds one row per
(query, base node). A round is authority update (L7), L2 normalisation (L9),
hub update from this round's authorities (L8), normalisation, and the
convergence test (L11) per query. Both updates are linear, so ``BATCH``
rounds run unnormalised, one job each: the edges stay in place
(``PlacedEdges``) and only vectors move. The hubs are written, and the
authorities of all the batch's rounds follow from them in one pass; another
over the vectors then gives all their norms and tests, and each query takes
the first round that passes. Queries that have converged leave the active
state; the loop ends when none is left.

How many rounds a base set takes depends on its eigenvalues, not on its size:
a few or thousands. Where the products fit (``AuthorityPowers``), rounds are
therefore not run one by one: the powers G, G^2, G^4, ... of one round on the
authorities are built by squaring, and G^m takes the vectors of ``m`` rounds to
those of the next ``m``. All rounds are still there and tested; the jobs grow
with the logarithm of a batch's rounds.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quire.functions.scaling import l2_change_term, signed_change_term
from quire.operators.edges import PlacedEdges
from quire.operators.graph import base_edges
from quire.operators.loop import NoConvergence, RoundState

# Tolerance of the HITS stopping test; lists print K + 1 = 11.
HITS_TOL = 1e-7
TOP_LIST_SIZE = 11
MAX_ITER = 10_000
#: Rounds between two tests. The vectors grow by the largest eigenvalue each
#: round, so the number is small enough for doubles on any graph.
BATCH = 6
#: Products of one join that a power, or its use on a batch's vectors, may take.
MAX_PRODUCTS = 50_000_000
#: Squarings before a batch's test: 2^4 rounds in the first batch, 2^10 at most.
FIRST_LEVEL, LAST_LEVEL = 4, 10


def convergence_passes(sum_col, tol: float):
    """L11 stop test on a per-query sum of terms: ``sqrt(sum) < tol``.

    With the signed criterion the sum can be negative; its square root is
    NaN and the test fails, as in the reference.
    """
    return F.coalesce(F.sqrt(sum_col) < F.lit(tol), F.lit(False))


def _unit(value: str, norm: str):
    return F.when(F.col(norm) > 0, F.col(value) / F.col(norm)).otherwise(F.lit(0.0))


def hits(base: DataFrame, links: DataFrame, citations: DataFrame, tol: float = HITS_TOL,
         max_iter: int = MAX_ITER, criterion: str = "l2", rounds: int | None = None,
         broadcast: bool | None = None) -> DataFrame:
    """Run HITS per query (L6-L10, with L9 norms per query; a zero norm gives
    zeros and stops, where the reference divides 0/0 forever). Returns
    ``(query_id, node, seen, authority, hub, rounds)``.

    ``criterion="l2"``: ``sqrt(Σ (new-old)^2) < tol`` for both vectors.
    ``criterion="signed"``: the reference's ``sqrt(Σ float(old^2-new^2))``.
    The previous vectors start at 0, the hub input at 1.0 (L6). A query that
    has not converged after ``max_iter`` rounds raises :class:`NoConvergence`;
    ``rounds`` runs exactly that many instead, without a test.
    """
    spark = base.sparkSession
    loop = RoundState(spark, "hits")
    term = l2_change_term if criterion == "l2" else signed_change_term
    base = loop.settle(base.select("query_id", "node", "seen"))
    n_rows = base.count()
    cit, lnk = base_edges(base, links, citations)
    cit, lnk = loop.settle(cit), loop.settle(lnk)
    powers = AuthorityPowers(loop, cit, lnk, n_rows)
    if powers.level(FIRST_LEVEL) == FIRST_LEVEL:
        return _by_powers(loop, base, cit, lnk, powers, tol, max_iter, term, rounds)
    cit = PlacedEdges(loop, cit, ["query_id", "citing"], ["query_id", "node"], n_rows, broadcast)
    lnk = PlacedEdges(loop, lnk, ["query_id", "dst"], ["query_id", "node"], n_rows, broadcast)
    try:
        return _iterated(loop, base, cit, lnk, tol, max_iter, term, rounds)
    finally:
        cit.close()
        lnk.close()


def _authorities(cit: PlacedEdges, hub: DataFrame, *keys: str) -> DataFrame:
    """a(p) = sum of hub(q) over q citing p, inside the base."""
    return cit.pull(hub.withColumnRenamed("node", "citing")).groupBy(*keys, "query_id", "node").agg(F.sum("value").alias("value"))


def _hubs(lnk: PlacedEdges, auth: DataFrame) -> DataFrame:
    """h(p) = sum of a(q) over q that p links to, inside the base."""
    return lnk.pull(auth.withColumnRenamed("node", "dst")).groupBy("query_id", "node").agg(F.sum("value").alias("value"))


def _iterated(loop: RoundState, base: DataFrame, cit: PlacedEdges, lnk: PlacedEdges, tol: float, max_iter: int, term,
              rounds: int | None) -> DataFrame:
    state = base.select("*", F.lit(0.0).alias("a0"), F.lit(0.0).alias("h0"))
    hub = base.select("query_id", "node", F.lit(1.0).alias("value"))
    done_rounds, batch = 0, 0
    while True:
        steps = min(BATCH, (rounds if rounds is not None else max_iter) - done_rounds)
        begin = hub
        names = [f"hubs{done_rounds + s}" for s in range(1, steps + 1)]
        hubs: list[DataFrame] = []
        for name in names:
            hub = loop.settle(_hubs(lnk, _authorities(cit, hub)), name)
            hubs.append(hub)
        before = reduce(DataFrame.unionByName, (h.select("*", F.lit(s).alias("step")) for s, h in enumerate([begin, *hubs[:-1]], 1)))
        auths = _authorities(cit, before, "step").select("query_id", "node", F.concat(F.lit("a"), "step").alias("of"), "value")
        after = reduce(DataFrame.unionByName, (h.select("query_id", "node", F.lit(f"h{s}").alias("of"), "value") for s, h in enumerate(hubs, 1)))
        vectors = auths.unionByName(after).groupBy("query_id", "node").agg(
            *(F.max(F.when(F.col("of") == f"{v}{k}", F.col("value"))).alias(f"{v}{k}") for k in range(1, steps + 1) for v in "ah"))
        state = loop.next_round(state.join(vectors, ["query_id", "node"], "left").na.fill(0.0))
        state, active = _tested(loop, state, steps, tol, term, rounds is None)
        done_rounds += steps
        at_end = rounds is not None and done_rounds >= rounds
        _finish(loop, state, at_end, steps, done_rounds, batch)
        batch += 1
        if at_end or not active:
            return _finished(loop, base)
        if rounds is None and done_rounds >= max_iter:
            raise NoConvergence(f"HITS has not converged in {max_iter} rounds for some query")
        state = state.where(F.col("stop").isNull()).select("query_id", "node", "seen", "a0", "h0")
        hub = state.select("query_id", "node", F.col("h0").alias("value"))
        for name in names:
            loop.delete(name)


def _finish(loop: RoundState, state: DataFrame, at_end: bool, steps: int, done_rounds: int, batch: int) -> None:
    """Write the rows of a batch's converged queries."""
    loop.settle(state.where(F.lit(True) if at_end else F.col("stop").isNotNull()).select(
        "query_id", "node", "seen", F.col("a0").alias("authority"), F.col("h0").alias("hub"),
        (F.coalesce("stop", F.lit(steps)) + (done_rounds - steps)).alias("rounds")), f"finished/batch={batch}")


def _finished(loop: RoundState, base: DataFrame) -> DataFrame:
    ddl = f"query_id {base.schema['query_id'].dataType.simpleString()}, node {base.schema['node'].dataType.simpleString()}, " \
          f"seen {base.schema['seen'].dataType.simpleString()}, authority double, hub double, rounds int"
    return loop.spark.read.schema(ddl).parquet(f"{loop.root}/finished").drop("batch")


class AuthorityPowers:
    """``(query_id, node, source, w)``: one round on the authorities (G, L8 then L7)
    and G^2, G^4, ..., each in a scale of its own per query (a power of two, so it
    changes no digit; the norms take it out). Authorities are fewer than hubs
    where pages cite few and the cited are cited by many. A power is built only
    where its products, counted before, stay within ``MAX_PRODUCTS``."""

    def __init__(self, loop: RoundState, cit: DataFrame, lnk: DataFrame, n_rows: int):
        self.loop, self.cit, self.lnk = loop, cit, lnk
        self.tables: list[DataFrame] = []
        self.entries: list[int] = []
        self.rows = n_rows + lnk.count() + cit.count()  # what a round of the batch takes besides
        self.full = False

    def level(self, wanted: int) -> int:
        """Builds what ``wanted`` doublings need; how many of them fit."""
        while len(self.tables) < wanted and not self.full:
            self.full = not self._built()
        fit = 0
        while fit < min(wanted, len(self.tables)) and max(self.entries[fit], 2 * self.rows) << fit <= MAX_PRODUCTS:
            fit += 1
        return fit

    def _built(self) -> bool:
        if not self.tables:
            left = self.cit.select("query_id", "node", F.col("citing").alias("mid"), F.lit(1.0).alias("w"))
            right = self.lnk.select("query_id", F.col("node").alias("mid"), F.col("dst").alias("source"), F.lit(1.0).alias("v"))
        else:
            left = self.tables[-1].withColumnRenamed("source", "mid")
            right = self.tables[-1].select("query_id", F.col("node").alias("mid"), "source", F.col("w").alias("v"))
        on = ["query_id", "mid"]
        n = left.groupBy(*on).agg(F.count(F.lit(1)).alias("n")).join(right.groupBy(*on).agg(F.count(F.lit(1)).alias("m")), on)
        if (n.agg(F.sum(F.col("n").cast("double") * F.col("m"))).first()[0] or 0) > MAX_PRODUCTS:
            return False
        raw = left.join(right.hint("merge"), on).groupBy("query_id", "node", "source").agg(F.sum(F.col("w") * F.col("v")).alias("w"))
        raw = self.loop.settle(raw)
        scale = raw.groupBy("query_id").agg(F.pow(F.lit(2.0), -F.floor(F.log2(F.max("w")))).alias("scale"))
        self.tables.append(self.loop.settle(raw.join(scale, "query_id").select("query_id", "node", "source", (F.col("w") * F.col("scale")).alias("w"))))
        self.entries.append(self.tables[-1].count())
        return True

    def rounds(self, hub: DataFrame, level: int) -> DataFrame:
        """The vectors of the ``2**level`` rounds that follow ``hub``, each up to a
        scale: ``(query_id, node, step, a, h)``; entries that are missing are 0."""
        first = hub.withColumnRenamed("node", "citing").join(self.cit.hint("merge"), ["query_id", "citing"])
        auth = self.loop.settle(first.groupBy("query_id", "node").agg(F.sum("value").alias("value")).withColumn("step", F.lit(1)))
        for k in range(level):
            ahead = auth.withColumnRenamed("node", "source").join(self.tables[k].hint("merge"), ["query_id", "source"]).groupBy(
                "query_id", "node", (F.col("step") + (1 << k)).alias("step")).agg(F.sum(F.col("w") * F.col("value")).alias("value"))
            auth = auth.unionByName(self.loop.settle(ahead))
        hubs = auth.withColumnRenamed("node", "dst").join(self.lnk.hint("merge"), ["query_id", "dst"]).select(
            "query_id", "node", "step", F.lit(None).cast("double").alias("a"), F.col("value").alias("h"))
        both = auth.select("query_id", "node", "step", F.col("value").alias("a"), F.lit(None).cast("double").alias("h")).unionByName(hubs)
        return self.loop.settle(both.groupBy("query_id", "node", "step").agg(
            *(F.coalesce(F.sum(v), F.lit(0.0)).alias(v) for v in "ah")))


def _by_powers(loop: RoundState, base: DataFrame, cit: DataFrame, lnk: DataFrame, powers: AuthorityPowers, tol: float, max_iter: int,
               term, rounds: int | None) -> DataFrame:
    """As ``_iterated``, with batches of a power of two of rounds that grow."""
    state = base.select("*", F.lit(0.0).alias("a0"), F.lit(0.0).alias("h0"))
    hub = base.select("query_id", "node", F.lit(1.0).alias("value"))
    done_rounds, batch, level = 0, 0, FIRST_LEVEL
    while True:
        left = (rounds if rounds is not None else max_iter) - done_rounds
        steps = min(1 << level, left)
        vectors = powers.rounds(hub, level).where(F.col("step") <= steps)
        state, active = _tested_steps(loop, state, vectors, steps, tol, term, rounds is None)
        done_rounds += steps
        at_end = rounds is not None and done_rounds >= rounds
        _finish(loop, state, at_end, steps, done_rounds, batch)
        batch += 1
        if at_end or not active:
            return _finished(loop, base)
        if rounds is None and done_rounds >= max_iter:
            raise NoConvergence(f"HITS has not converged in {max_iter} rounds for some query")
        state = state.where(F.col("stop").isNull()).select("query_id", "node", "seen", "a0", "h0")
        hub = state.select("query_id", "node", F.col("h0").alias("value"))
        level = powers.level(min(level + 2, LAST_LEVEL))


def _tested_steps(loop: RoundState, state: DataFrame, vectors: DataFrame, steps: int, tol: float, term,
                  test: bool) -> tuple[DataFrame, int]:
    """``_tested`` on vectors with a row for each step."""
    of = ["query_id", "step"]
    every = state.select("*", F.explode(F.sequence(F.lit(1), F.lit(steps))).alias("step"))
    rows = loop.settle(every.join(vectors.hint("merge"), ["query_id", "node", "step"], "left").na.fill(0.0, ["a", "h"]))
    norms = loop.settle(rows.groupBy(*of).agg(*(F.sqrt(F.sum(F.col(v) * F.col(v))).alias(f"n{v}") for v in "ah")))
    before = vectors.join(norms, of).select(
        "query_id", "node", (F.col("step") + 1).alias("step"), *(_unit(v, f"n{v}").alias(f"p{v}") for v in "ah"))
    unit = rows.join(norms, of).withColumns({v: _unit(v, f"n{v}") for v in "ah"})
    old = {f"p{v}": F.when(F.col("step") == 1, F.col(f"{v}0")).otherwise(F.coalesce(f"p{v}", F.lit(0.0))) for v in "ah"}
    sums = unit.join(before.hint("merge"), ["query_id", "node", "step"], "left").withColumns(old).groupBy(*of).agg(
        *(F.sum(term(v, f"p{v}")).alias(f"d{v}") for v in "ah"), *(F.first(f"n{v}").alias(f"n{v}") for v in "ah"))
    passes = ((convergence_passes(F.col("da"), tol) & convergence_passes(F.col("dh"), tol)) | (F.col("na") == 0) | (F.col("nh") == 0))
    stops = sums.groupBy("query_id").agg(F.min(F.when(passes & F.lit(test), F.col("step"))).alias("stop"))
    out = unit.join(loop.settle(stops), "query_id").where(F.col("step") == F.coalesce("stop", F.lit(steps))).select(
        "query_id", "node", "seen", F.col("a").alias("a0"), F.col("h").alias("h0"), "stop")
    out, counts = loop.next_round(out, F.count(F.when(F.col("stop").isNull(), 1)).alias("active"))
    return out, counts["active"]


def _tested(loop: RoundState, state: DataFrame, steps: int, tol: float, term, test: bool) -> tuple[DataFrame, int]:
    """Normalise the vectors of ``steps`` rounds (L9), find each query's first
    round that passes (L11), and keep that round's vectors, else the last's, as
    ``a0`` and ``h0``. Also the number of rows still active."""
    every = range(1, steps + 1)
    norms = state.groupBy("query_id").agg(
        *(F.sqrt(F.sum(F.col(f"{v}{s}") * F.col(f"{v}{s}"))).alias(f"n{v}{s}") for s in every for v in "ah"))
    unit = state.join(norms, "query_id").select(
        "query_id", "node", "seen", "a0", "h0", *(_unit(f"{v}{s}", f"n{v}{s}").alias(f"{v}{s}") for s in every for v in "ah"),
        *(F.col(f"n{v}{s}") for s in every for v in "ah"))
    sums = unit.groupBy("query_id").agg(
        *(F.sum(term(f"{v}{s}", f"{v}{s - 1}")).alias(f"d{v}{s}") for s in every for v in "ah"),
        *(F.first(f"n{v}{s}").alias(f"m{v}{s}") for s in every for v in "ah"))
    passes = [F.when((convergence_passes(F.col(f"da{s}"), tol) & convergence_passes(F.col(f"dh{s}"), tol))
                     | (F.col(f"ma{s}") == 0) | (F.col(f"mh{s}") == 0), F.lit(s)) for s in every]
    stop = F.coalesce(*passes, F.lit(None).cast("int")) if test else F.lit(None).cast("int")
    picked = unit.join(sums.select("query_id", stop.alias("stop")), "query_id")
    at = F.coalesce("stop", F.lit(steps))
    out = picked.select("query_id", "node", "seen", *(
        F.element_at(F.array(*(F.col(f"{v}{s}") for s in every)), at).alias(f"{v}0") for v in "ah"), "stop")
    out, counts = loop.next_round(out, F.count(F.when(F.col("stop").isNull(), 1)).alias("active"))
    return out, counts["active"]


def top_list(result: DataFrame, score: str, k: int = TOP_LIST_SIZE) -> DataFrame:
    """The k best nodes per query by ``score``; ties in base-set order."""
    w = Window.partitionBy("query_id").orderBy(F.round(score, 12).desc(), F.col("seen").asc())
    return result.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
