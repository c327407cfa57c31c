"""Consecutive-run compression of increasing integer sequences (Q1).

For each sequence (``seq_id``) of distinct integers taken in increasing order,
report every maximal run of consecutive values with length >= 2 as the
0-based positions ``run_start:run_end``. The sample sequence
``4 5 6 7 8 9 12 15 16 17 18 20 22 23 24 27`` gives ``0:5``, ``7:10``,
``12:14``, printed together as ``0:57:1012:14``.

Rows are range-partitioned and sorted by (sequence, value), so a huge sequence
spans many tasks. Each partition finds its runs by itself, as places in the
partition, and notes per sequence how many values it has there. Two small
tables then finish the work: the notes (one row for each sequence in each
partition) give the sequence's first place in a partition, and runs that touch a
partition's first or last row of a sequence are joined where the values go on.

Repeated values count once; rows with a null sequence or value take no part.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pyspark.sql.window import Window

from quire.operators.numbering import positions_within, ranged


def positions(seq: DataFrame) -> DataFrame:
    """``(seq_id, v, idx)``: 0-based position of each distinct value."""
    return positions_within(seq.select("seq_id", "v").distinct(), ["seq_id"], ["v"])


def consecutive_runs(seq: DataFrame) -> DataFrame:
    """``(seq_id, run_start, run_end)`` for every run of length >= 2."""
    rows = seq.select("seq_id", "v").where("seq_id is not null and v is not null").distinct()
    tagged = ranged(rows, ["seq_id", "v"])
    # inside a partition value less place is constant in a run, and in a run only
    pieces = tagged.groupBy("_part", "seq_id", (F.col("v") - F.col("_local")).alias("_g")).agg(
        F.min("_local").alias("lo"), F.max("_local").alias("hi"), F.min("v").alias("v_lo"), F.max("v").alias("v_hi"))
    notes = tagged.groupBy("_part", "seq_id").agg(F.count(F.lit(1)).alias("n"), F.min("_local").alias("first"), F.max("_local").alias("last"))
    before = Window.partitionBy("seq_id").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    notes = notes.select("_part", "seq_id", "first", "last", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    placed = pieces.join(notes, ["_part", "seq_id"]).select(
        "seq_id", "_part", "v_lo", "v_hi", (F.col("base") + F.col("lo") - F.col("first")).alias("run_start"),
        (F.col("base") + F.col("hi") - F.col("first")).alias("run_end"),
        ((F.col("lo") == F.col("first")) | (F.col("hi") == F.col("last"))).alias("edge"))
    inner = placed.where(~F.col("edge"))
    # at most two runs of a sequence in a partition touch its ends there: these may go on in the next
    order = Window.partitionBy("seq_id").orderBy("v_lo")
    edges = placed.where("edge").withColumn("fresh", F.coalesce(F.col("v_lo") != F.lag("v_hi").over(order) + 1, F.lit(True)).cast("int"))
    edges = edges.withColumn("run", F.sum("fresh").over(order))
    joined = edges.groupBy("seq_id", "run").agg(F.min("run_start").alias("run_start"), F.max("run_end").alias("run_end"))
    found = inner.select("seq_id", "run_start", "run_end").unionByName(joined.select("seq_id", "run_start", "run_end"))
    return found.where(F.col("run_end") > F.col("run_start"))


def format_runs(runs: DataFrame) -> DataFrame:
    """Display form ``start:end`` concatenated per sequence, as the reference
    prints it. One string per sequence: meant for display of bounded output."""
    return runs.groupBy("seq_id").agg(F.array_join(F.transform(
        F.array_sort(F.collect_list(F.struct("run_start", "run_end"))),
        lambda x: F.concat(x["run_start"].cast("string"), F.lit(":"), x["run_end"].cast("string"))), "").alias("runs"))
