"""Edges that stay in place: no shuffle of them in a round, right sums in both forms, salted keys."""
import random

import pytest
from pyspark.sql import functions as F

from quire.operators import linkscore as ls
from quire.operators.edges import PlacedEdges
from quire.operators.loop import RoundState


def children(plan):
    it = plan.children().iterator()
    while it.hasNext():
        yield it.next()


def shuffles_above_scan(plan, name, above=()):
    """The exchanges between each scan of ``name`` and the first join over it."""
    node = plan.nodeName()
    if node.startswith("Adaptive"):
        yield from shuffles_above_scan(plan.initialPlan(), name)
    elif name in node:
        yield [n for n in above]
    else:
        own = () if "Join" in node else (*above, node) if "Exchange" in node else above
        for child in children(plan):
            yield from shuffles_above_scan(child, name, own)


def some_edges(spark, n=60, m=400, seed=3):
    rnd = random.Random(seed)
    edges = sorted({(rnd.randrange(n), rnd.randrange(n)) for _ in range(m)} | {(i, 7) for i in range(n)})
    return edges, spark.createDataFrame(edges, "i bigint, j bigint")


@pytest.mark.parametrize("broadcast, heavy", [(True, 10**9), (False, 10**9), (False, 10)])
def test_products_and_no_shuffle_of_edges(spark, broadcast, heavy):
    edges, df = some_edges(spark)
    loop = RoundState(spark, "edges")
    placed = PlacedEdges(loop, df, ["j"], ["i"], 60, broadcast, heavy_edges=heavy)
    assert (placed.heavy is not None) == (heavy == 10)
    vector = loop.settle(spark.range(60).select(F.col("id").alias("j"), (F.col("id") * 1.0).alias("v")))
    out = placed.pull(vector).groupBy("i").agg(F.sum("v").alias("s"))
    want = {}
    for i, j in edges:
        want[i] = want.get(i, 0) + j
    assert {r.i: r.s for r in out.collect()} == want
    plan = out.select("*")._jdf.queryExecution().executedPlan()  # as planned, before it runs
    found = list(shuffles_above_scan(plan, placed.name))
    assert found and not any(found)
    text = plan.toString()
    assert "Bucketed: true" in text
    if broadcast:
        assert "Exchange hashpartitioning" not in text
    placed.close()
    assert not spark.catalog.tableExists(placed.name)


@pytest.mark.parametrize("broadcast", [True, False])
def test_link_round_and_convergence_in_both_forms(spark, broadcast):
    edges, df = some_edges(spark, n=20, m=60)
    nodes = spark.range(22).withColumnRenamed("id", "node")  # two without edges
    rows = df.unionByName(spark.createDataFrame([(99, 1), (None, 3), (4, None)], "i bigint, j bigint"))  # strangers bring nothing
    out = ls.converged(rows, nodes, 22, broadcast=broadcast).collect()
    near = {}
    for i, j in edges:
        near.setdefault(i, []).append(j)
    x, rounds = [1 / 22] * 22, 0
    while True:
        raw = [s if (s := sum(x[j] for j in near.get(i, []))) > 0 else 1 / 22 for i in range(22)]
        lo, hi = min(raw), max(0.0, max(raw))
        new = [0.5 if hi == lo else (v - lo) / (hi - lo) for v in raw]
        rounds += 1
        change, x = sum((a - b) ** 2 for a, b in zip(new, x)) ** 0.5, new
        if change < ls.LINK_TOL:
            break
    got = {r.node: r.score for r in out}
    assert len(got) == 22 and {r.rounds for r in out} == {rounds}
    assert all(abs(got[i] - x[i]) < 1e-9 for i in range(22))


@pytest.mark.parametrize("at_once", [1 << 20, 7])
def test_converged_takes_as_many_jobs_for_any_number_of_rounds(spark, monkeypatch, at_once):
    """A ring with chords and a pair beside it: hundreds of rounds, run in one job, equal to rounds by hand."""
    monkeypatch.setattr(ls, "ENTRIES_AT_ONCE", at_once)
    written, settle = [], RoundState.settle
    monkeypatch.setattr(RoundState, "settle", lambda self, df, path=None: (written.append(path), settle(self, df, path))[1])
    n = 24
    pairs = [(k, k + 1) for k in range(n - 1)] + [(0, n - 1), (0, 8), (3, 15), (1, 12), (30, 31)]
    edges = [e for a, b in pairs for e in ((a, b), (b, a))] + [(5, 5)]
    ids = [*range(n), 30, 31, 40, 4]  # 40 alone; 4 twice: counts twice in the first round
    rows = spark.createDataFrame([*edges, (99, 1), (3, 99), (None, 3), (4, None)], "i bigint, j bigint").repartition(4)
    nodes = spark.createDataFrame([(k,) for k in [*ids, None]], "node bigint").repartition(3)
    x, sent, rounds = dict.fromkeys(ids, 1 / 29), dict.fromkeys(ids, 1 / 29) | {4: 2 / 29}, 0
    while True:
        raw = dict.fromkeys(ids, 0.0)
        for i, j in edges:
            raw[i] += sent[j]
        raw = {k: v if v > 0 else 1 / 29 for k, v in raw.items()}
        lo, hi = min(raw.values()), max(raw.values())
        new, rounds = {k: (v - lo) / (hi - lo) for k, v in raw.items()}, rounds + 1
        change, x = sum((new[k] - x[k]) ** 2 for k in x) ** 0.5, new
        sent = new
        if change < ls.LINK_TOL:
            break
    out = ls.converged(rows, nodes, 29)
    got = {r.node: r.score for r in out.collect()}
    assert rounds > 100 and {r.rounds for r in out.collect()} == {rounds}
    assert out.count() == len(got) == len(x) and all(abs(got[k] - x[k]) < 1e-9 for k in x)
    assert len(written) < 10
    with pytest.raises(ls.NoConvergence):
        ls.converged(rows, nodes, 29, max_iter=rounds - 1)
    none = ls.converged(rows, nodes.where("node is null"), 29).collect()
    assert [(r.node, r.score, r.rounds) for r in none] == [(None, 1 / 29, 1)]
    alone = ls.converged(rows.limit(0), nodes.where("node < 3"), 3).collect()
    assert sorted((r.node, r.score, r.rounds) for r in alone) == [(k, 0.5, 2) for k in range(3)]


def test_large_vector_stays_in_buckets(spark, monkeypatch):
    """Only the hubs' scores are broadcast, and neither entries nor hubs' products are shuffled."""
    monkeypatch.setattr(ls, "MAX_HUBS", 3)
    monkeypatch.setattr(ls, "SMALL_VECTOR", 5)
    placed, place, plans = [], ls.LinkRounds._place, []

    def recorded(self, df, key, path=None):
        placed.append(self)
        if path:
            plans.append(df._jdf.queryExecution().executedPlan())
        return place(self, df, key, path)

    monkeypatch.setattr(ls.LinkRounds, "_place", recorded)
    edges, df = some_edges(spark, n=20, m=60)
    nodes = spark.createDataFrame([(i,) for i in [*range(20), 4, None]], "node bigint")  # 4 twice: counts twice in the first round
    with pytest.raises(ls.NoConvergence):
        ls.converged(df, nodes, 20, max_iter=1)
    vector = spark.read.parquet(f"{placed[0].loop.root}/vector000000")
    got = {r.node: (r.old, r.raw) for r in vector.collect()}
    want = dict.fromkeys(range(20), 0)
    for i, j in edges:
        want[i] += 2 if j == 4 else 1
    assert sorted(got) == list(range(20))
    assert all(abs(got[i][0] - 1 / 20) < 1e-12 and abs(got[i][1] - (want[i] or 1) / 20) < 1e-12 for i in got)
    assert vector.where("hub").count() <= 3
    text = plans[0].toString()
    for table in ("from_hubs", "others"):
        name = getattr(placed[0], table).select("i")._jdf.queryExecution().analyzed().toString()
        found = list(shuffles_above_scan(plans[0], name[name.index("quire_links_"):][:24]))
        assert found and not any(found)
    assert text.count("BroadcastExchange") == 1 and "hub" in text
