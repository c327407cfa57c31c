"""Conversation structure repair by iterative-deepening A*.

A conversation's rows, by turn, should read: at most one system row, then pairs
of user and assistant. Edits in order of their initials: Delete a row (3, the
only edit for a blank or duplicate one), Insert an empty user or assistant row
(2), Keep a row (0), Rerole it to user or assistant (2); a truncated row that
is not deleted adds 1. The answer is the cheapest sequence of edits, of equally
cheap ones that with the least initials.

*Search.* Depth-first, edits in ASCII order, under a cost bound that grows to
the least cost found beyond it; a table keeps for each (row, state) that has
failed the least cost it can still have, so nothing fails twice. The first
accepting path is the answer: at the final bound every accepting path has that
cost, and they are met in ASCII order. Searches run over blocks of ``BLOCK``
rows from state to state, and blocks (below: segments) are put together by
their least costs. A block's edits end with an edit of its last row, so among
equally cheap ones none begins another, and the least initials of the whole are
those of the blocks in order.

*Long conversations.* Rows are range-partitioned by conversation and turn, so a
conversation of any length is parted. Conversations inside a partition are
repaired there. The first and last of a partition may go on in another: each
part of them is a *segment*. Segments learn which of their rows occur in
earlier ones (each sends a row once, however often it has it), give their costs
between all pairs of states, and get back the states that the whole
conversation's cheapest path has at their ends.

Null roles and texts are one space. Rows of one turn are ordered by role, then
by a hash of their text; rows without a turn come first. A role's first
character is its initial (none: a space). Repeated rows are duplicates. Rows
without a ``conv_id`` are one conversation. An empty table gives no rows. Other
columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.llm.common import settle

BLOCK = 24  # rows that one search covers
STATES = range(4)  # nothing yet, after the system row, after a user row, after an assistant row
END = 4  # goal: an accepted whole, with rows inserted after the last
_BLANKS = " \t\n\v\f\r"
_ROLE = {"u": "user", "a": "assistant"}
_WANTED = ["u", "u", "a", "u"]  # what a state may be followed by, but for a first system row
_AFTER = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
_LEGAL = {"su", "ua", "au"}
INF = float("inf")


def _reachable(rows: tuple[str, ...], state: int, goal: int) -> bool:
    if goal == END or goal == state:
        return True
    if goal == 1:
        return state == 0 and any(r[0] == "s" and r[1] != "F" for r in rows)
    return goal > 1


def search(rows: tuple[str, ...], state: int, goal: int) -> tuple[float, str]:
    """Least cost and initials of edits of ``rows`` from ``state`` to ``goal`` (a
    state right after the last row, or ``END``); infinite if there are none. A
    row is its role's initial and its fault: F must go, T truncated, or a blank."""
    if not _reachable(rows, state, goal):
        return INF, ""
    n = len(rows)
    rest, spare = [0] * (n + 1), [False] * (n + 1)  # least cost of the rows from here on after state 0; a system row there
    for i in range(n - 1, -1, -1):
        role, fault = rows[i]
        cut = fault == "T"
        rest[i] = rest[i + 1] + (3 if fault == "F" else min(3, 2 + cut) if role not in "ua" else cut)
        spare[i] = spare[i + 1] or (role == "s" and fault != "F")
    known: dict[tuple[int, int], float] = {}  # least cost still to come, as far as proven

    def least(i: int, q: int) -> float:
        return known.get((i, q), rest[i] - (2 if q == 0 and spare[i] else 0))

    def down(i: int, q: int, left: float) -> tuple[str | None, float]:
        """The edits from here within ``left``, or the least cost that they can have."""
        if least(i, q) > left:
            return None, least(i, q)
        if i == n and (goal == q or goal == END and q in (0, 3)):
            return "", 0
        wanted = _WANTED[q]
        put = _AFTER[q, wanted]
        edits: list[tuple[str, int, int, int]] = []  # in ASCII order: initial, cost, next row, next state
        if i < n:
            role, fault = rows[i]
            cut = int(fault == "T")
            edits.append(("D", 3, i + 1, q))
            edits.append(("I", 2, i, put))
            if fault != "F":
                if (q, role) in _AFTER:
                    edits.append(("K", cut, i + 1, _AFTER[q, role]))
                edits.append(("R", 2 + cut, i + 1, put))
        elif goal == END:
            edits.append(("I", 2, i, put))
        best = INF
        for edit, cost, to, then in edits:
            found, need = down(to, then, left - cost)
            if found is not None:
                return edit + found, cost + need
            best = min(best, cost + need)
        known[i, q] = best
        return None, best

    bound = least(0, state)
    while True:
        found, bound = down(0, state, bound)
        if found is not None:
            return bound, found


_search = lru_cache(maxsize=200_000)(search)


def _blocks(rows: list[str]) -> list[tuple[str, ...]]:
    return [tuple(rows[i:i + BLOCK]) for i in range(0, len(rows), BLOCK)]


def cheapest(rows: list[str], start: int = 0, goal: int = END) -> tuple[float, str]:
    """``search`` for any number of rows, over blocks."""
    blocks = _blocks(rows)
    if len(blocks) < 2:
        return _search(tuple(rows), start, goal)
    togo = {q: _search(blocks[-1], q, goal)[0] for q in STATES}
    all_togo = [togo]
    for block in blocks[-2::-1]:
        togo = {q: min(_search(block, q, r)[0] + togo[r] for r in STATES) for q in STATES}
        all_togo.append(togo)
    if togo[start] == INF:
        return INF, ""
    out, q = [], start
    for block, after in zip(blocks, all_togo[-2::-1]):
        best = min(_search(block, q, r)[0] + after[r] for r in STATES)
        edits, q = min((_search(block, q, r)[1], r) for r in STATES if _search(block, q, r)[0] + after[r] == best)
        out.append(edits)
    return togo[start], "".join(out) + _search(blocks[-1], q, goal)[1]


def _faults(roles: list[str], texts: list[str], seen: set[tuple[str, str]]) -> list[str]:
    """Each row as ``search`` takes it (B blank and D duplicate for F); ``seen``
    holds the rows before, and these afterwards."""
    out = []
    for role, text in zip(roles, texts):
        bare = text.rstrip(_BLANKS)
        again = (role, text) in seen
        seen.add((role, text))
        out.append((role[:1] or " ") + ("B" if not bare else "D" if again else "T" if bare[-1] not in ".!?" else " "))
    return out


def _searched(faults: list[str]) -> list[str]:
    return [f[0] + ("F" if f[1] in "BD" else f[1]) for f in faults]


def _apply(audit: str, start: int, roles: list[str], texts: list[str]) -> list[dict[str, str]]:
    """The rows that ``audit`` leaves, each with its edit."""
    out, i, q = [], 0, start
    for edit in audit:
        if edit == "D":
            i += 1
            continue
        if edit == "K":
            role, text = roles[i], texts[i]
        else:
            role, text = _ROLE[_WANTED[q]], "" if edit == "I" else texts[i]
        i += edit != "I"
        q = _AFTER[q, role[:1]]
        out.append({"edit": edit, "role": role, "text": text})
    return out


def _figures(faults: list[str], turns: list[int | None]) -> dict:
    """What can be added up over a conversation's segments."""
    own = [t for t in turns if t is not None]
    initials = [f[0] for f in faults]
    return {"blank": sum(f[1] == "B" for f in faults), "duplicate": sum(f[1] == "D" for f in faults),
            "truncated": sum(f[1] == "T" for f in faults),
            "illegal": sum(a + b not in _LEGAL for a, b in zip(initials, initials[1:])),
            "first": initials[0], "last": initials[-1], "low": own[0] if own else None, "high": own[-1] if own else None,
            "turns": len(set(own))}


def _added(parts: list[dict]) -> dict[str, int]:
    """A conversation's figures from its segments', in order."""
    out = {k: sum(p[k] for p in parts) for k in ("blank", "duplicate", "truncated", "illegal")}
    out["illegal"] += sum(a["last"] + b["first"] not in _LEGAL for a, b in zip(parts, parts[1:]))
    own = [p for p in parts if p["low"] is not None]
    turns = sum(p["turns"] for p in own) - sum(a["high"] == b["low"] for a, b in zip(own, own[1:]))
    out["gaps"] = own[-1]["high"] - own[0]["low"] + 1 - turns if own else 0
    return out


_ROW = "struct<edit: string, role: string, text: string>"
_COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
_COUNTS_DDL = ", ".join(f"{c} bigint" for c in _COUNTS)
_ROWS_TYPE = pa.list_(pa.struct([("edit", pa.string()), ("role", pa.string()), ("text", pa.string())]))
_FIGURES = ["blank", "duplicate", "truncated", "illegal", "first", "last", "low", "high", "turns"]
_FIGURES_DDL = ("blank bigint, duplicate bigint, truncated bigint, illegal bigint, first string, last string, "
                "low bigint, high bigint, turns bigint")


def _table(rows: list[dict], types: list[tuple[str, pa.DataType]]) -> pa.Table:
    return pa.Table.from_pylist(rows, pa.schema(types))


def repair(conversations: DataFrame, partitions: int | None = None) -> DataFrame:
    """``(conv_id, segment, segments, gaps, blank, duplicate, truncated, illegal,
    cost, audit, rows)``: for most conversations one row; for one that spans
    several partitions a row for each of its ``segments``, each with the
    conversation's figures and the segment's own part of ``audit`` (the edits'
    initials) and ``rows`` (what is left: edit, role, text)."""
    one = F.lit(" ")
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", one).alias("role"), F.coalesce("text", one).alias("text"))
    order = ["conv_id", "turn", "role", "h", "row"]
    keyed = rows.select("*", F.xxhash64("text").alias("h"), F.monotonically_increasing_id().alias("row"))
    dealt = keyed.repartitionByRange(partitions, *order) if partitions else keyed.repartitionByRange(*order)
    done_ddl = f"conv_id bigint, segment int, segments int, {_COUNTS_DDL}, audit string, rows array<{_ROW}>"
    done_types = [("conv_id", pa.int64()), ("segment", pa.int32()), ("segments", pa.int32()), *((c, pa.int64()) for c in _COUNTS),
                  ("audit", pa.string()), ("rows", _ROWS_TYPE)]
    row_types = [("pos", pa.int64()), ("turn", pa.int64()), ("role", pa.string()), ("text", pa.string())]

    def whole(conv_id, own: list[tuple]) -> dict:
        turns, roles, texts = map(list, zip(*own))
        faults = _faults(roles, texts, set())
        cost, audit = cheapest(_searched(faults))
        return {"conv_id": conv_id, "segment": 0, "segments": 1, **_added([_figures(faults, turns)]), "cost": cost,
                "audit": audit, "rows": _apply(audit, 0, roles, texts)}

    def inside(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Repair the conversations that end here; pass on the rows of the first and last."""
        part, schema = TaskContext.get().partitionId(), pa.schema(done_types + row_types)
        held: list[tuple] = []
        now, first = None, True

        def passed(conv_id) -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist([{"conv_id": conv_id, "segment": part, "pos": k, "turn": t, "role": r, "text": x}
                                               for k, (t, r, x) in enumerate(held)], schema)

        for batch in batches:
            out = []
            for conv_id, *row in zip(*(batch.column(c).to_pylist() for c in range(4))):
                if held and conv_id != now:
                    if first:
                        yield passed(now)
                    else:
                        out.append(whole(now, held))
                    held, first = [], False
                now = conv_id
                held.append(tuple(row))
            if out:
                yield pa.RecordBatch.from_pylist(out, schema)
        if held:
            yield passed(now)

    found = settle(dealt.sortWithinPartitions(*order).select("conv_id", "turn", "role", "text")
                   .mapInArrow(inside, done_ddl + ", pos bigint, turn bigint, role string, text string"), "repair")
    names = [n for n, _ in done_types]
    done = found.where("pos is null").select(*names)
    edge = found.where("pos is not null").select("conv_id", "segment", "pos", "turn", "role", "text")

    # which rows of a segment occur in an earlier one: each distinct row of a segment is asked once
    each = edge.groupBy("conv_id", "segment", "role", "text").agg(F.count("*").alias("n"))
    firsts = each.groupBy("conv_id", "role", "text").agg(F.min("segment").alias("s"))
    f = firsts.select(*(F.col(c).alias(f"f_{c}") for c in ("conv_id", "role", "text", "s")))
    earlier = each.join(f, F.col("conv_id").eqNullSafe(F.col("f_conv_id")) & (F.col("role") == F.col("f_role"))
                        & (F.col("text") == F.col("f_text")) & (F.col("segment") > F.col("f_s")))
    earlier = settle(earlier.select("conv_id", "segment", "role", "text"), "repair-earlier")

    def segment_of(own: pa.Table, told: pa.Table) -> tuple[list, list[str], list[str], list[str]]:
        own = own.sort_by("pos")
        seen = {(r, t) for r, t in zip(told.column("role").to_pylist(), told.column("text").to_pylist()) if r is not None}
        turns, roles, texts = (own.column(c).to_pylist() for c in ("turn", "role", "text"))
        return turns, roles, texts, _faults(roles, texts, seen)

    def summary(own: pa.Table, told: pa.Table) -> pa.Table:
        """The segment's figures, and for each state before and goal after it the
        least cost and the place of its edits among that state's."""
        turns, roles, texts, faults = segment_of(own, told)
        rows = _searched(faults)
        ways = [[cheapest(rows, q, goal) for goal in (*STATES, END)] for q in STATES]
        places = [[sorted(w[1] for w in way).index(w[1]) for w in way] for way in ways]
        return _table([{"conv_id": own.column("conv_id")[0].as_py(), "segment": own.column("segment")[0].as_py(), **_figures(faults, turns),
                        "costs": [-1 if c == INF else c for way in ways for c, _ in way], "places": sum(places, [])}], summary_types)

    summary_types = [("conv_id", pa.int64()), ("segment", pa.int32()), *zip(_FIGURES, [pa.int64()] * 4 + [pa.string()] * 2 + [pa.int64()] * 3),
                     ("costs", pa.list_(pa.int64())), ("places", pa.list_(pa.int32()))]
    by = ["conv_id", "segment"]
    summaries = settle(edge.groupBy(*by).cogroup(earlier.groupBy(*by)).applyInArrow(
        summary, f"conv_id bigint, segment int, {_FIGURES_DDL}, costs array<bigint>, places array<int>"), "repair-segments")
    chosen_types = [("conv_id", pa.int64()), ("segment", pa.int32()), ("segments", pa.int32()), *((c, pa.int64()) for c in _COUNTS),
                    ("start", pa.int32()), ("goal", pa.int32())]

    def choose(of: pa.Table) -> pa.Table:
        """The states at the ends of a conversation's segments, a row for each
        partition that holds some of it."""
        parts = of.sort_by("segment").to_pylist()
        ways = [[[INF if c < 0 else c for c in p["costs"][5 * q:5 * q + 5]] for q in STATES] for p in parts]
        togo = [[w[END] for w in ways[-1]]]
        for way in ways[-2::-1]:
            togo.append([min(way[q][r] + togo[-1][r] for r in STATES) for q in STATES])
        figures, q, out = {**_added(parts), "cost": togo[-1][0]}, 0, []
        for k, p in enumerate(parts):
            goal = END
            if k + 1 < len(parts):
                after = togo[-2 - k]
                best = min(ways[k][q][r] + after[r] for r in STATES)
                goal = min((p["places"][5 * q + r], r) for r in STATES if ways[k][q][r] + after[r] == best)[1]
            out.append({"conv_id": p["conv_id"], "segment": p["segment"], "segments": len(parts), **figures, "start": q, "goal": goal})
            q = goal
        return _table(out, chosen_types)

    chosen = summaries.groupBy("conv_id").applyInArrow(choose, f"conv_id bigint, segment int, segments int, {_COUNTS_DDL}, start int, goal int")
    told = earlier.unionByName(chosen, allowMissingColumns=True)

    def finish(own: pa.Table, told: pa.Table) -> pa.Table:
        way = next(r for r in told.select([n for n, _ in chosen_types]).to_pylist() if r["start"] is not None)
        _, roles, texts, faults = segment_of(own, told)
        _, audit = cheapest(_searched(faults), way["start"], way["goal"])
        return _table([{**{n: way[n] for n in names if n in way}, "audit": audit, "rows": _apply(audit, way["start"], roles, texts)}], done_types)

    parted = edge.groupBy(*by).cogroup(told.groupBy(*by)).applyInArrow(finish, done_ddl)
    return done.unionByName(settle(parted, "repair-parted"))


def digest(repaired: DataFrame) -> DataFrame:
    """A row for each conversation of ``repair``: its figures, the whole audit, and
    the SHA-256 of the rows left as ``role:text``, joined by new lines. Segments
    of a parted conversation are read one after another, in order."""
    line = F.array_join(F.transform("rows", lambda r: F.concat(r["role"], F.lit(":"), r["text"])), "\n")
    keep = ["conv_id", *_COUNTS]
    short = repaired.where("segments = 1").select(*keep, "audit", F.sha2(line.cast("binary"), 256).alias("repaired_sha256"))
    parted = repaired.where("segments > 1").select(*keep, "segment", "audit", F.size("rows").alias("n"), line.alias("lines"))
    types = [*((c, pa.int64()) for c in keep), ("audit", pa.string()), ("repaired_sha256", pa.string())]

    def stream(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, audit, sha, any_line = None, [], None, False

        def result() -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist([{**now, "audit": "".join(audit), "repaired_sha256": sha.hexdigest()}], pa.schema(types))

        for batch in batches:
            for row in batch.to_pylist():
                if now is None or row["conv_id"] != now["conv_id"]:
                    if now:
                        yield result()
                    now, audit, sha, any_line = {c: row[c] for c in keep}, [], hashlib.sha256(), False
                audit.append(row["audit"])
                if row["n"]:
                    sha.update((("\n" if any_line else "") + row["lines"]).encode())
                    any_line = True
        if now:
            yield result()

    ordered = parted.repartition("conv_id").sortWithinPartitions("conv_id", "segment")
    ddl = ", ".join(f"{c} bigint" for c in keep) + ", audit string, repaired_sha256 string"
    return short.unionByName(ordered.mapInArrow(stream, ddl))


def damage(conversations: DataFrame) -> DataFrame:
    """Conversations with faults, by the CRC-32 of ``conv_id:turn`` modulo 20: 0
    drops the row, 1 empties its text, 2 removes its full stops, exclamation and
    question marks, 3 repeats it, 4 makes it the user's. Nulls are one space."""
    def string(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(string("conv_id"), F.lit(":"), string("turn")).cast("binary")) % 20
    rows = conversations.select("conv_id", "turn", string("role").alias("role"), string("text").alias("text"), kind.alias("kind"))
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    copies = F.explode(F.array_repeat(F.lit(0), F.when(F.col("kind") == 3, 2).otherwise(1)))
    return (rows.where("kind <> 0")
            .select("conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), copies.alias("copy"))
            .drop("copy"))
