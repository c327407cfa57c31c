"""Hard-negative mining against brute force."""
import math
import random

import numpy as np
import pytest

from quire.llm import hard_negatives as hn

DDL = "vec_id bigint, embedding array<float>, label int, shard string, row int, v int"


def brute(rows, every=50, positives=5, negatives=3, low=50, high=95):
    ok = [(i, [math.floor(256 * float(np.float32(x))) for x in e], lab) for i, e, lab in rows
          if i is not None and lab is not None and e is not None and all(x is not None and math.isfinite(x) for x in e)]
    out = []
    for n, (i, e, lab) in enumerate(ok):
        if i % every:
            continue
        score = [(-sum(a * b for a, b in zip(e, f)), j, m) for j, f, m in ok]
        near = sorted((s, j) for k, (s, j, m) in enumerate(score) if m == lab and k != n)[:positives]
        for p, pid in near:
            window = sorted((s, j) for s, j, m in score if m != lab and low * -p <= 100 * -s <= high * -p)[:negatives]
            out += [(i, pid, r, j, -p, -s) for r, (s, j) in enumerate(window, 1)]
    return sorted(out)


def some_vectors(n, dims, seed=0):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 0.2) for _ in range(dims)] for _ in range(6)]
    rows = []
    for i in range(n):
        c = rng.randrange(6)
        rows.append((i, [x + rng.gauss(0, 0.15) for x in centres[c]], c if rng.random() < 0.8 else rng.randrange(6)))
    same = [0.25] * dims
    rows += [(n + k, same, k % 2) for k in range(40)]  # ties
    rows += [(5 * n, None, 1), (5 * n + 50, [None] + [1.0] * (dims - 1), 1), (5 * n + 100, [float("nan")] * dims, 2), (None, same, 1),
             (6 * n, same, None), (50, same, 0), (50, same, 0), (7 * n, [1.0], 3), (7 * n + 50, [], 1), (8 * n, [-0.5] * dims, 2)]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, 2) for r in rows], DDL).repartition(3)


@pytest.mark.parametrize("dims, shard, sets", [(16, 1 << 24, 1 << 21), (7, 100 * 56, 3 * 56), (1, 1 << 24, 1 << 21)])
def test_equal_to_brute_force(spark, monkeypatch, dims, shard, sets):
    monkeypatch.setattr(hn, "SHARD_BYTES", shard)
    monkeypatch.setattr(hn, "SET_BYTES", sets)
    rows = some_vectors(500, dims, seed=dims)
    got = sorted(map(tuple, hn.mine(frame(spark, rows)).collect()))
    want = brute(rows)
    # equal (score, id) of repeated rows are interchangeable: compare as bags
    assert got == want and len(got) > 20


def test_cells_come_by_falling_bounds_that_hold():
    rng = np.random.default_rng(1)
    v = rng.integers(-80, 80, (900, 12))
    index = hn.MultiIndex(v, np.arange(900), rng.integers(0, 3, 900), np.arange(900))
    for q in rng.integers(-80, 80, (20, 12)):
        cells = list(index.cells(q))
        bounds = [b for b, _ in cells]
        assert bounds == sorted(bounds, reverse=True)
        assert sum(index.start[c + 1] - index.start[c] for _, c in cells) == 900
        assert all((index.v[index.start[c]:index.start[c + 1]] @ q).max() <= b for b, c in cells)


def test_visits_stop_early_and_stay_right(monkeypatch):
    rng = np.random.default_rng(2)
    centres = rng.normal(0, 200, (16, 16))
    v = np.concatenate([c + rng.normal(0, 5, (100, 16)) for c in centres]).astype(np.int64)
    index = hn.MultiIndex(v, np.arange(1600), np.zeros(1600, np.int64), np.arange(1600))
    monkeypatch.setattr(hn, "FIRST_WAVE", 50)
    q = v[::100].astype(float)
    index.v = index.v.astype(float)
    none = np.full((16, 1), np.inf)
    lists = hn.Lists(-none, none, 5)
    scored = hn.visit(index, q, np.zeros(16, np.int64), np.full(16, -1), lists, True)
    want = [sorted((v @ x).tolist(), reverse=True)[:5] for x in v[::100]]
    assert lists.scores.reshape(16, 5).tolist() == want and lists.slots.tolist() == sorted(list(range(16)) * 5)
    assert scored < 16 * 1600 / 3


def test_many_ties_are_cut(monkeypatch):
    monkeypatch.setattr(hn, "HELD", 100)
    v = np.ones((3000, 4), np.int64)
    ids = np.random.default_rng(3).permutation(3000)
    index = hn.MultiIndex(v, ids, np.zeros(3000, np.int64), np.arange(3000))
    most = np.full((2, 1), 100, np.int64)
    lists = hn.Lists(-most, most, 5)
    hn.visit(index, v[:2], np.zeros(2, np.int64), np.full(2, -1), lists, True)
    assert lists.ids.tolist() == [0, 1, 2, 3, 4] * 2


def test_very_large_components(spark):
    big = [(0, [1e13, 1.0], 0), (1, [1.0, 1.0], 0), (2, [0.7, 0.5], 1)]
    assert sorted(map(tuple, hn.mine(spark.createDataFrame(big, "vec_id bigint, embedding array<double>, label int")).collect())) == \
        [(0, 1, 1, 2, 256 * 256 * 10**13 + 256 * 256, 179 * 256 * 10**13 + 128 * 256)]
    for x in (1e300, 1e17):  # a component, then only the score
        rows = [(0, [x, 1.0], 0), (1, [x, 1.0], 0), (2, [x, 0.5], 1)]
        with pytest.raises(Exception, match="does not fit 64 bits"):
            hn.mine(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int")).collect()


def test_empty_table(spark):
    assert hn.mine(frame(spark, some_vectors(5, 3)).limit(0)).count() == 0
