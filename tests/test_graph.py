import os

import pytest
from pyspark.sql import functions as F

from conftest import FIXTURE_CITATIONS, FIXTURE_LINKS
from quire.operators import graph as gr
from quire.operators import hits as ht
from quire.operators import linkscore as ls
from quire.operators.runs import consecutive_runs, format_runs
from quire.operators import loop
from quire.operators.loop import NoConvergence, RoundState
from quire.sources.adjacency import parse_adjacency
from quire.sources.tables import transpose_links


def lines(spark, ls_):
    return spark.createDataFrame(list(enumerate(ls_)), "line_no bigint, value string")


@pytest.fixture(scope="module")
def graph(spark):
    links, rej = parse_adjacency(lines(spark, FIXTURE_LINKS))
    cits, rej2 = parse_adjacency(lines(spark, FIXTURE_CITATIONS), "doc", "citing")
    assert rej.count() == 0 and rej2.count() == 0
    nodes = spark.range(5).withColumnRenamed("id", "node")
    return links, cits, nodes


def vec(df, col="score"):
    return [round(r[col], 6) for r in df.orderBy("node").collect()]


def test_parse(spark, graph):
    links, cits, _ = graph
    assert sorted((r.src, r.dst, r.pos) for r in links.collect()) == [(0, 1, 0), (0, 2, 1), (1, 2, 0), (2, 0, 0), (3, 2, 0)]
    e, rej = parse_adjacency(lines(spark, ["1->2,3", "x->1", "2->4,,5", "1->7", "3->8,"]))
    assert sorted((r.src, r.dst) for r in e.collect()) == [(1, 7), (3, 8)]
    assert rej.count() == 2
    e, rej = parse_adjacency(lines(spark, ["5->3->4"]))  # the second piece holds the targets
    assert [(r.src, r.dst) for r in e.collect()] == [(5, 3)] and rej.count() == 0


def test_undirected_and_degrees(graph):
    links, cits, _ = graph
    und = gr.undirected_edges(links, cits)
    rows = {}
    for r in und.collect():
        rows.setdefault(r.i, set()).add(r.j)
    assert rows == {0: {1, 2}, 1: {0, 2}, 2: {0, 1, 3}, 3: {2}}
    deg = {r.node: (r.n_links, r.n_citations) for r in gr.degrees(links, cits).collect()}
    assert deg[2] == (1, 3) and deg[0] == (2, 1) and 4 not in deg


def test_sweep(graph):
    links, cits, nodes = graph
    rows = gr.undirected_edges(links, cits)
    raw = ls.ordered_sweep(rows, nodes, 5, scale=False)
    assert vec(raw) == [0.4, 0.6, 1.2, 1.2, 0.2]
    assert vec(ls.ordered_sweep(rows, nodes, 5)) == [0.2, 0.4, 1.0, 1.0, 0.0]


def test_converged(graph):
    links, cits, nodes = graph
    out = ls.converged(gr.undirected_edges(links, cits), nodes, 5)
    assert vec(out) == [0.858724, 0.858724, 1.0, 0.41416, 0.0]
    assert out.first().rounds == 43


def test_limits_raise_and_loops_keep_few_rounds(spark, graph, monkeypatch):
    links, cits, nodes = graph
    made = []
    monkeypatch.setattr(loop.RoundState, "__init__", lambda self, *a, init=loop.RoundState.__init__: (init(self, *a), made.append(self))[0])
    with pytest.raises(NoConvergence):
        ht.hits(whole_base(spark), links, cits, max_iter=8)
    with pytest.raises(NoConvergence):
        ls.converged(gr.undirected_edges(links, cits), nodes, 5, max_iter=12)
    for state in made:
        folder = state.root.removeprefix("file:")
        left = [f for f in os.listdir(folder) if f.startswith("round")] if os.path.exists(folder) else []
        assert len(left) <= (ls.BATCH + 1 if "linkscore" in folder else 2)


def whole_base(spark):
    return spark.createDataFrame([(0, i, (0, 0, i)) for i in range(5)],
                                 "query_id bigint, node bigint, seen struct<stage:int,rank:int,pos:bigint>")


def test_hits_rounds(spark, graph):
    links, cits, _ = graph
    r1 = ht.hits(whole_base(spark), links, cits, rounds=1)
    assert vec(r1, "authority") == [0.301511, 0.301511, 0.904534, 0.0, 0.0]
    assert vec(r1, "hub") == [0.676123, 0.507093, 0.169031, 0.507093, 0.0]
    r2 = ht.hits(whole_base(spark), links, cits, rounds=2)
    assert [round(x, 4) for x in vec(r2, "authority")] == [0.0925, 0.3698, 0.9245, 0.0, 0.0]
    end = ht.hits(whole_base(spark), links, cits)
    assert vec(end, "authority") == [0.0, 0.382683, 0.92388, 0.0, 0.0]
    assert vec(end, "hub") == [0.707107, 0.5, 0.0, 0.5, 0.0]
    assert end.first().rounds == 14


def test_runs(spark):
    # the sample list and its printed runs are fixed values
    arr = [4, 5, 6, 7, 8, 9, 12, 15, 16, 17, 18, 20, 22, 23, 24, 27]
    seq = spark.createDataFrame([(1, v) for v in arr], "seq_id bigint, v bigint")
    assert format_runs(consecutive_runs(seq)).first().runs == "0:57:1012:14"
    wide = [1, 2, 10**6, 10**9, 3 * 10**9, 3 * 10**9 + 1, 10**15, 10**15 + 1, 10**15 + 2]
    seq = spark.createDataFrame([(s, v) for s in (3_000_000_000, 7) for v in wide], "seq_id bigint, v bigint").repartition(5)
    assert {(r.seq_id, r.runs) for r in format_runs(consecutive_runs(seq)).collect()} == {(3_000_000_000, "0:14:56:8"), (7, "0:14:56:8")}


def test_large_ids(spark):
    big = 3_000_000_000
    links = spark.createDataFrame([(big, big + 1, 0), (big + 2, big, 0)], "src bigint, dst bigint, pos bigint")
    cits = transpose_links(links)
    root = spark.createDataFrame([(0, big, 1)], "query_id bigint, node bigint, root_rank int")
    base = gr.base_set(root, links, cits)
    assert {(r.node, r.seen.stage, r.seen.pos) for r in base.collect()} == {(big, 0, 0), (big + 1, 1, 0), (big + 2, 2, big + 2)}
    assert sorted((r.node, r.idx) for r in gr.node_positions(base).collect()) == [(big, 0), (big + 1, 1), (big + 2, 2)]


def hits_by_hand(base, edges, tol=ht.HITS_TOL):
    """One query's ``(rounds, authority, hub)``, round by round."""
    auth, hub, given, rounds = dict.fromkeys(base, 0.0), dict.fromkeys(base, 0.0), dict.fromkeys(base, 1.0), 0
    while True:
        a, h = dict.fromkeys(base, 0.0), dict.fromkeys(base, 0.0)
        for s, d in edges:
            a[d] += given[s]
        norm = sum(x * x for x in a.values()) ** 0.5
        a = {k: x / norm for k, x in a.items()}
        for s, d in edges:
            h[s] += a[d]
        norm = sum(x * x for x in h.values()) ** 0.5
        h = {k: x / norm for k, x in h.items()}
        rounds += 1
        change = max(sum((new[k] - old[k]) ** 2 for k in base) ** 0.5 for new, old in ((a, auth), (h, hub)))
        auth, hub, given = a, h, h
        if change < tol:
            return rounds, auth, hub


@pytest.mark.parametrize("products", [ht.MAX_PRODUCTS, 0])
def test_hits_jobs_do_not_grow_with_the_rounds(spark, monkeypatch, products):
    """Paths have close eigenvalues: hundreds of rounds on a few nodes. Without the
    powers (no products allowed) the same graph is run round by round."""
    monkeypatch.setattr(ht, "MAX_PRODUCTS", products)
    written, settle = [], RoundState.settle
    monkeypatch.setattr(RoundState, "settle", lambda self, df, path=None: (written.append(path), settle(self, df, path))[1])
    n = 10 if products else 5
    edges = {0: [(i, i + 1) for i in range(n)] + [(i + 1, i - 1) for i in range(1, n)] + [(50, 51), (50, 52), (51, 52)],
             7: [(60, 61), (62, 61), (60, 63)], 8: []}
    nodes = {0: [*range(n + 1), 50, 51, 52], 7: [60, 61, 62, 63], 8: [70]}
    every = [e for es in edges.values() for e in es]
    links = spark.createDataFrame([(s, d, k) for k, (s, d) in enumerate(every)], "src bigint, dst bigint, pos bigint")
    base = spark.createDataFrame([(q, v, (0, 0, v)) for q, vs in nodes.items() for v in vs],
                                 "query_id bigint, node bigint, seen struct<stage:int,rank:int,pos:bigint>")
    got = {(r.query_id, r.node): r for r in ht.hits(base, links, transpose_links(links)).collect()}
    assert len(got) == sum(map(len, nodes.values()))
    for q in (0, 7):
        rounds, auth, hub = hits_by_hand(nodes[q], edges[q])
        assert all(got[q, v].rounds == rounds and abs(got[q, v].authority - auth[v]) < 1e-9 and abs(got[q, v].hub - hub[v]) < 1e-9
                   for v in nodes[q])
        if q == 0 and products:
            assert rounds > 150 and len(written) < 80
    assert (got[8, 70].rounds, got[8, 70].authority, got[8, 70].hub) == (1, 0.0, 0.0)
