"""SpotSigs fingerprints against a plain version."""
import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest

from quire.llm import spotsigs as sp

COMMON = set(sp.ANCHORS)
FEW = ["", "the", "x", "...", "the quick fox", "Der Hund und die Katze, das Haus.", "a b c", "  \n"]


def plain(text, chain=sp.CHAIN):
    """The signatures as tuples of words."""
    words = [w for w in re.split(r"[\x00-\x2f\x3a-\x60\x7b-\x7f]+", text.lower()) if w]
    out = []
    for i, w in enumerate(words):
        if w in COMMON and (rest := [v for v in words[i + 1:] if v not in COMMON][:chain]):
            out.append((w, *rest))
    return Counter(out or ([tuple(["all", *words])] if words else [("raw", text)] if text else []))


def alike(a, b):
    return sum((a & b).values()) / sum((a | b).values()) if a or b else 1.0


def some_texts(n, seed):
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        words = [rng.choice(["the", "and", "der", "la", "é", "Für", "of"]) if rng.random() < 0.4 else f"w{rng.randrange(60)}" for _ in range(rng.randint(0, 150))]
        out.append(" ".join(words) if rng.random() < 0.8 or not out else out[-1].replace("w1", "q", 1))
    return out + FEW + ["the 1 2 3 " * 3000, "the 1 2 3 " * 2999 + "the 1 2 4 "]


def test_signatures_and_likeness():
    texts = some_texts(150, 1)
    want = [plain(t) for t in texts]
    sigs, bounds = sp.signatures(texts)
    assert np.diff(bounds).tolist() == [sum(w.values()) for w in want]
    name = sp.names(sigs, bounds)
    for i in range(0, len(texts), 7):
        assert all((name[i] == name[j]) == (want[i] == want[j]) for j in range(len(texts)))
    a, b = np.random.default_rng(0).integers(0, len(texts), (2, 3000))
    exact = [alike(want[i], want[j]) for i, j in zip(a, b)]
    assert np.allclose(sp.likeness(sigs, bounds, a, b), exact)
    pruned = sp.likeness(sigs, bounds, a, b, least=0.8)
    assert np.allclose(pruned, [x if x >= 0.8 else 0 for x in exact])
    assert sum(pruned > 0) > 20


def test_pruning_of_long_sets():
    rng = random.Random(4)
    base = [f"the w{rng.randrange(10**6)} x{k}" for k in range(400)]
    texts = []
    for share in (0, 0.01, 0.05, 0.1, 0.2, 0.5, 0.9):
        texts.append(" ".join(s if rng.random() >= share else f"the z{rng.randrange(10**6)} x" for s in base))
    sigs, bounds = sp.signatures(texts, chain=2)
    want = [plain(t, 2) for t in texts]
    a, b = map(np.array, zip(*[(i, j) for i in range(7) for j in range(7)]))
    exact = [alike(want[i], want[j]) for i, j in zip(a, b)]
    assert np.allclose(sp.likeness(sigs, bounds, a, b, least=0.8), [x if x >= 0.8 else 0 for x in exact])


def expected(rows):
    rows = sorted(rows, key=lambda r: r[0])
    out = {}
    for (i, t), (_, following) in zip(rows, rows[1:] + rows[:1]):
        half = len(t) // 2
        e = t[:len(t) - half] + following[:half]
        out[i] = (len(t), hashlib.sha256(e.encode()).hexdigest(), alike(plain(t), plain(e)), alike(plain(t), plain(following)))
    return out


@pytest.mark.parametrize("partitions", [1, 7])
def test_query_form(spark, partitions):
    rows = [(3 * i - 40, t) for i, t in enumerate(some_texts(60, 2))]
    docs = spark.createDataFrame([(i, t or None, 1, 2, "n") for i, t in rows], "doc_id bigint, text string, h int, part int, edge string").repartition(4)
    got = sp.neighbours(docs, partitions=partitions).collect()
    want = expected(rows)
    assert len(got) == len(rows)
    by_name = {}
    for r in got:
        n, sha, near_edited, near_next = want[r.doc_id]
        assert (r.n_chars, r.edited_sha256) == (n, sha)
        assert r.near_edited == pytest.approx(near_edited) and r.near_next == pytest.approx(near_next)
        assert (r.fingerprint == r.edited_fingerprint) == (r.near_edited == 1.0)
        by_name[r.doc_id] = r.fingerprint
    prints = {r.doc_id: (r.fingerprint, len(r.signatures)) for r in sp.fingerprints(docs).collect()}
    assert {i: f for i, (f, _) in prints.items()} == by_name
    assert all(prints[i][1] == sum(plain(t).values()) for i, t in rows)


def test_repeated_ids_one_document_and_none(spark):
    ddl = "doc_id bigint, text string"
    same = spark.createDataFrame([(None, "the a b")] * 30 + [(1, "of x y z"), (1, "of x y q")], ddl)
    got = sp.neighbours(same, partitions=4).collect()
    assert sorted((r.doc_id is None, r.near_next) for r in got if r.doc_id is None)[:29] == [(True, 1.0)] * 29 or \
        sum(r.near_next == 1.0 for r in got) == 29
    assert len(got) == 32
    one = sp.neighbours(spark.createDataFrame([(5, "the long day is over")], ddl)).collect()
    assert len(one) == 1 and one[0].near_next == 1.0
    assert sp.neighbours(same.limit(0)).count() == 0
