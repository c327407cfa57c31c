"""Conversation repair against a plain dynamic program."""
import hashlib
import random
import zlib

import pytest

from quire.llm import conversations as cv

BLANKS = " \t\n\v\f\r"
AFTER = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
ROLE = {"u": "user", "a": "assistant"}


def plain(rows):
    """Cheapest edits of (initial, fault) rows: all of the least cost for each state, row by row."""
    def insert(states):
        out = dict(states)
        for _ in range(2):
            for q, (c, a) in list(out.items()):
                to = AFTER.get((q, "u")) or AFTER[q, "a"]
                out[to] = min(out.get(to, (1e9, "")), (c + 2, a + "I"))
        return out

    # a prefix of another audit only differs by what follows: keep both until the row is read
    def step(states, role, fault):
        out = {}

        def put(q, c, a):
            out[q] = min(out.get(q, (1e9, "")), (c, a))

        for q, (c, a) in states.items():
            for k in range(3):  # rows inserted before it
                at, cost, audit = q, c, a
                for _ in range(k):
                    at = AFTER.get((at, "u")) or AFTER[at, "a"]
                    cost, audit = cost + 2, audit + "I"
                put(at, cost + 3, audit + "D")
                if fault != "F":
                    extra = fault == "T"
                    if (at, role) in AFTER:
                        put(AFTER[at, role], cost + extra, audit + "K")
                    put(AFTER.get((at, "u")) or AFTER[at, "a"], cost + 2 + extra, audit + "R")
        return out

    states = {0: (0, "")}
    for role, fault in rows:
        states = step(states, role, fault)
    return min(insert(states)[q] for q in (0, 3) if q in insert(states))


def judged(rows):
    """What the query should return for one conversation's (turn, role, text) in order."""
    seen, faults = set(), []
    for _, role, text in rows:
        bare = text.strip(BLANKS)
        faults.append("B" if not bare else "D" if (role, text) in seen else "T" if bare[-1] not in ".!?" else " ")
        seen.add((role, text))
    initials = [(r[1] + " ")[:1] for r in rows]
    cost, audit = plain([(i, "F" if f in "BD" else f) for i, f in zip(initials, faults)])
    left, i, q = [], 0, 0
    for e in audit:
        want = ROLE["u" if (q, "u") in AFTER else "a"]
        if e != "D":
            role, text = (want, "") if e == "I" else (want if e == "R" else rows[i][1], rows[i][2])
            left.append(f"{role}:{text}")
            q = AFTER[q, role[:1]]
        i += e != "I"
    turns = [r[0] for r in rows if r[0] is not None]
    return {"gaps": max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, "blank": faults.count("B"),
            "duplicate": faults.count("D"), "truncated": faults.count("T"),
            "illegal": sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), "cost": cost, "audit": audit,
            "repaired_sha256": hashlib.sha256("\n".join(left).encode()).hexdigest()}


@pytest.mark.parametrize("length", [0, 1, 3, 8, 30, 120])
def test_search_finds_the_cheapest_and_least(length):
    rng = random.Random(length)
    for _ in range(120 if length < 50 else 25):
        rows = [rng.choice("uasx uaua") + rng.choice("  T F") for _ in range(length)]
        assert cv.cheapest(rows) == plain([tuple(r) for r in rows])


def some_rows(n_conversations, long, seed=0):
    rng = random.Random(seed)
    texts = ["Hi.", "hello", "", "  \t", "Well?", "a b c!", "same", None, "x." * 50, "No end", " ", "Yes! "]
    roles = ["user", "assistant", "system", "tool", None, "", "user", "assistant"]
    rows = []
    for c in range(n_conversations):
        n = long if c == 2 else rng.randint(1, 9)
        for k in range(n):
            text = rng.choice(texts) if rng.random() < 0.5 else f"text {rng.randrange(10_000)}."
            rows.append((None if c == 4 else c, None if rng.random() < 0.03 else 2 * k + (k > 3), rng.choice(roles) if rng.random() < 0.3 else roles[k % 2], text))
    return rows


DDL = "conv_id bigint, turn bigint, role string, text string, h int, pos int, segment string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, "x") for r in rows], DDL).repartition(3)


def ordered(rows):
    """Rows of each conversation in turn order (no two rows of a turn, but repeats, in these tests)."""
    out = {}
    for c, t, r, x in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0)):
        out.setdefault(c, []).append((t, r if r is not None else " ", x if x is not None else " "))
    return out


@pytest.mark.parametrize("partitions", [1, 9])
def test_repair_of_short_and_parted_conversations(spark, partitions):
    rows = [r for r in some_rows(25, 260) if r[1] is not None] + [(7, 500, "user", "twice"), (7, 500, "user", "twice")]
    got = {r.conv_id: r.asDict() for r in cv.digest(cv.repair(frame(spark, rows), partitions)).collect()}
    want = ordered(rows)
    assert set(got) == set(want)
    for c, own in want.items():
        assert {k: got[c][k] for k in judged(own)} == judged(own), c
    segments = cv.repair(frame(spark, rows), partitions).where("conv_id = 2").count()
    assert segments > 1 if partitions > 1 else segments == 1


def test_one_row_repeated_over_many_partitions(spark):
    rows = [(1, 5, "user", "Again.")] * 150 + [(1, 9, "assistant", "Yes.")] + [(2, None, "user", "No turn.")] * 3
    got = {r.conv_id: r for r in cv.digest(cv.repair(frame(spark, rows), 6)).collect()}
    assert (got[1].duplicate, got[1].cost, got[1].gaps) == (149, 3 * 149, 3)
    assert got[1].audit.count("K") == 2 and len(got[1].audit) == 151
    assert (got[2].duplicate, got[2].gaps, got[2].truncated) == (2, 0, 0)


def test_damage_and_query(spark, tmp_path):
    from quire.llm.queries import op11_conversation_repair

    rows = some_rows(60, 40, seed=3)
    rows = [r for r in rows if r[1] is not None] + [(900, None, "user", "x."), (901, 0, None, None)]
    frame(spark, rows).drop("h", "pos").write.parquet(str(tmp_path / "conversations.parquet"))
    got = {r.conv_id: r.asDict() for r in op11_conversation_repair(spark, str(tmp_path)).collect()}
    kept = []
    for c, t, r, x in rows:
        r, x = (" " if v is None else v for v in (r, x))
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        x = "" if kind == 1 else "".join(ch for ch in x if ch not in ".!?") if kind == 2 else x
        kept += [] if kind == 0 else [(c, t, "user" if kind == 4 else r, x)] * (2 if kind == 3 else 1)
    want = ordered(kept)
    assert set(got) == {r[0] for r in rows}
    nothing = {"gaps": 0, "blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0, "cost": 0, "audit": "",
               "repaired_sha256": hashlib.sha256(b"").hexdigest()}
    for c in got:
        assert {k: got[c][k] for k in nothing} == (judged(want[c]) if c in want else nothing), c


def test_empty_table(spark):
    assert cv.digest(cv.repair(frame(spark, [(1, 1, "user", "x")]).limit(0))).count() == 0
