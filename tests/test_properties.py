"""Property checks against brute force on small inputs."""
import math
import os
import random
import tempfile

import pytest
from pyspark.sql import functions as F

from quire.operators import graph as gr
from quire.operators import hits as ht
from quire.operators import index as ix
from quire.operators import linkscore as ls
from quire.operators import rank as rk
from quire.operators.runs import consecutive_runs
from quire.sources.adjacency import read_citations, read_links


def _sequential_sweep(n, rows):
    """The reference's in-place ascending pass, then min-max scaling."""
    pr = [1.0 / n] * n
    for i in range(n):
        s = sum(pr[j] for j in sorted(rows.get(i, ())))
        pr[i] = s if s > 0 else 1.0 / n
    mx, mn = max(0.0, max(pr)), min(pr)
    return [0.5] * n if mx == mn else [(x - mn) / (mx - mn) for x in pr]


@pytest.mark.parametrize("block_ids", [1 << 17, 7, 1])
def test_sweep_equals_sequential_loop(spark, block_ids):
    rnd = random.Random(7)
    n = 30
    edges = {(rnd.randrange(n), rnd.randrange(n)) for _ in range(70)}
    edges = {(a, b) for a, b in edges if a != b}
    links = spark.createDataFrame([(a, b, 0) for a, b in edges], "src bigint, dst bigint, pos int")
    cits = links.select(F.col("dst").alias("doc"), F.col("src").alias("citing"), F.col("pos"))
    rows = {}
    for a, b in edges:
        rows.setdefault(a, set()).add(b)
        rows.setdefault(b, set()).add(a)
    want = _sequential_sweep(n, rows)
    nodes = spark.range(n).withColumnRenamed("id", "node")
    got = {r.node: r.score for r in ls.ordered_sweep(gr.undirected_edges(links, cits), nodes, n, block_ids=block_ids).collect()}
    assert all(abs(got[i] - want[i]) < 1e-9 for i in range(n))


def test_sweep_of_a_long_ascending_path(spark):
    """As many jobs write scores as there are blocks, not as the path has ids."""
    n = 100_000
    rows = spark.range(n - 1).select(F.col("id").alias("i"), (F.col("id") + 1).alias("j"))
    rows = rows.unionByName(rows.select(F.col("j").alias("i"), F.col("i").alias("j")))
    out = ls.ordered_sweep(rows, spark.range(n).withColumnRenamed("id", "node"), n, scale=False, block_ids=25_000)
    assert len({f.split("block=")[1].split("/")[0] for f in out.inputFiles()}) == 4
    want = [0.0] * n
    for i in range(n):
        s = (want[i - 1] if i else 0.0) + (1.0 / n if i < n - 1 else 0.0)
        want[i] = s if s > 0 else 1.0 / n
    assert out.count() == n
    worst = out.agg(F.max(F.abs(F.col("score") - (F.least(F.col("node") + 1, F.lit(n - 1)) / n)))).first()[0]
    assert worst < 1e-9 and abs(want[-1] - (n - 1) / n) < 1e-9


def test_sweep_of_a_hub_nulls_and_strangers(spark):
    """A hub in the last block and one in the first, ids that are no nodes, an isolated node."""
    n = 40
    edges = {(39, j) for j in range(38)} | {(0, j) for j in range(2, 39)}
    edges |= {(b, a) for a, b in edges}
    rows = spark.createDataFrame([*edges, (99, 1), (3, -7), (None, 2)], "i bigint, j bigint")
    nodes = spark.createDataFrame([(i,) for i in range(n)] + [(None,)], "node bigint")
    near = {}
    for a, b in edges:
        near.setdefault(a, set()).add(b)
    got = {r.node: r.score for r in ls.ordered_sweep(rows, nodes, n, block_ids=9).collect()}
    want = _sequential_sweep(n, near)
    assert len(got) == n and all(abs(got[i] - want[i]) < 1e-9 for i in range(n))
    assert ls.ordered_sweep(rows.limit(0), nodes.limit(0), 0).count() == 0


def test_tf_scores_unchanged_by_repeating_a_document(spark):
    base = [(0, "p", "apple banana apple cherry"), (1, "p", "banana cherry date"), (2, "p", "apple fig")]
    twice = [(d, p, t + " " + t if d == 0 else t) for d, p, t in base]
    q = spark.createDataFrame([(0, "apple banana")], "query_id bigint, query string")

    def scores(rows):
        docs = spark.createDataFrame(rows, "doc_id bigint, path string, text string")
        return {r.doc_id: r.cosine for r in rk.cosine_scores(ix.build_index(docs), q, "tf").collect()}
    a, b = scores(base), scores(twice)
    assert a.keys() == b.keys() and all(abs(a[k] - b[k]) < 1e-12 for k in a)


def test_postings_sum_equals_token_count(spark):
    docs = spark.createDataFrame([(0, "p", "A b, a! c3 c3 c3"), (1, "p", ""), (2, "p", "Ünï ünï")],
                                 "doc_id bigint, path string, text string")
    post = ix.postings(docs).collect()
    assert sum(r.tf for r in post) == 8
    assert {(r.doc_id, r.term): r.tf for r in post}[(2, "ünï")] == 2


def test_hits_vectors_have_unit_norm(spark):
    rnd = random.Random(3)
    edges = {(rnd.randrange(12), rnd.randrange(12)) for _ in range(30)}
    edges = [(a, b) for a, b in edges if a != b]
    links = spark.createDataFrame([(a, b, i) for i, (a, b) in enumerate(edges)], "src bigint, dst bigint, pos int")
    cits = links.select(F.col("dst").alias("doc"), F.col("src").alias("citing"), F.col("pos"))
    base = spark.createDataFrame([(0, i, (0, 0, i)) for i in range(12)],
                                 "query_id bigint, node bigint, seen struct<stage:int,rank:int,pos:bigint>")
    for crit in ("l2", "signed"):
        res = ht.hits(base, links, cits, criterion=crit, rounds=25).collect()
        assert abs(math.sqrt(sum(r.authority ** 2 for r in res)) - 1) < 1e-9
        assert abs(math.sqrt(sum(r.hub ** 2 for r in res)) - 1) < 1e-9


def test_runs_match_brute_force(spark):
    rnd = random.Random(11)
    rows, want = [], set()
    for seq in range(5):
        vals = sorted(set(rnd.randrange(60) for _ in range(35)))
        rows += [(seq, v) for v in vals] + [(seq, vals[0])]  # a repeat is ignored
        i = 0
        while i < len(vals):
            j = i
            while j + 1 < len(vals) and vals[j + 1] == vals[j] + 1:
                j += 1
            if j > i:
                want.add((seq, i, j))
            i = j + 1
    seq_df = spark.createDataFrame(rows, "seq_id bigint, v bigint")
    got = {(r.seq_id, r.run_start, r.run_end) for r in consecutive_runs(seq_df).collect()}
    assert got == want


def test_adjacency_file_last_line_wins(spark):
    d = tempfile.mkdtemp(prefix="quire-adj-")
    with open(os.path.join(d, "IntLinks.txt"), "w") as f:
        f.write("0->1,2\n1->2\n0->3\n2->\nx->1\n")
    with open(os.path.join(d, "IntCitations.txt"), "w") as f:
        f.write("1->0\n2->0,1\n3->0\n")
    links = sorted((r.src, r.dst, r.pos) for r in read_links(spark, os.path.join(d, "IntLinks.txt"))[0].collect())
    assert [r.value for r in read_links(spark, os.path.join(d, "IntLinks.txt"))[1].collect()] == ["x->1"]
    assert links == [(0, 3, 0), (1, 2, 0)]
    cits = sorted((r.doc, r.citing) for r in read_citations(spark, os.path.join(d, "IntCitations.txt"))[0].collect())
    assert cits == [(1, 0), (2, 0), (2, 1), (3, 0)]


def test_runs_across_partition_borders(spark):
    """Runs of any length over many range partitions, in many sequences and in one."""
    rnd = random.Random(21)
    rows = [(s, v) for s in range(12) for v in range(rnd.randint(1, 400)) if rnd.random() < (0.98 if s % 3 else 0.5)]
    rows += [(99, v) for v in range(5000)] + [(7, 10**9), (7, 10**9 + 1), (7, 10**9 + 1), (None, 3), (3, None), (5, -4), (5, -3)]
    keep = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = sorted(map(tuple, consecutive_runs(spark.createDataFrame(rows, "seq_id bigint, v bigint")).collect()))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", keep)
    want = []
    for s in {s for s, v in rows if s is not None}:
        vs = sorted({v for t, v in rows if t == s and v is not None})
        start = 0
        for k in range(1, len(vs) + 1):
            if k == len(vs) or vs[k] != vs[k - 1] + 1:
                if k - 1 > start:
                    want.append((s, start, k - 1))
                start = k
    assert got == sorted(want)
