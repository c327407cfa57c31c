"""Dense numbering and prefix ranges without a single-task sort.

Rows are range-partitioned and sorted by their key; what each partition needs
to know of the earlier ones is one row per partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quire.operators.loop import RoundState


def ranged(df: DataFrame, order_cols: list[str], num_partitions: int | None = None) -> DataFrame:
    """``df`` range-partitioned and sorted, with its partition ``_part`` and its
    place there ``_local``, as a written table: the range bounds come from
    sampling, and two evaluations could sample differently."""
    dealt = df.repartitionByRange(num_partitions, *order_cols) if num_partitions else df.repartitionByRange(*order_cols)
    tagged = dealt.sortWithinPartitions(*order_cols).select(
        "*", F.spark_partition_id().alias("_part"), F.monotonically_increasing_id().alias("_local"))
    # monotonically_increasing_id = (partition << 33) + row index in partition
    tagged = tagged.withColumn("_local", F.col("_local") - F.shiftleft(F.col("_part").cast("long"), 33))
    return RoundState(df.sparkSession, "ranged").settle(tagged)


def dense_ids(df: DataFrame, order_cols: list[str], id_col: str = "doc_id",
              num_partitions: int | None = None) -> DataFrame:
    """Dense ids ``0..n-1`` in the order of ``order_cols`` (a unique key).

    Number the rows inside each range partition and add the row count of all
    earlier partitions. The offsets table has one row per partition, so it is
    broadcast with a known bound; no step needs the whole input in one task.
    """
    tagged = ranged(df, order_cols, num_partitions)
    counts = tagged.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    return (tagged.join(F.broadcast(offsets), "_part")
            .withColumn(id_col, F.col("_off") + F.col("_local"))
            .drop("_part", "_local", "_off"))


def positions_within(df: DataFrame, group_cols: list[str], order_cols: list[str]) -> DataFrame:
    """``df`` with ``idx``, the 0-based place in its group by ``order_cols`` (unique
    there): a dense numbering over all groups, less each group's first number."""
    g = dense_ids(df, [*group_cols, *order_cols], id_col="_gid")
    first = g.groupBy(*group_cols).agg(F.min("_gid").alias("_first"))
    return g.join(first, group_cols).withColumn("idx", F.col("_gid") - F.col("_first")).drop("_gid", "_first")


def running_extremes(df: DataFrame, order_col: str, high: str, low: str) -> DataFrame:
    """``df`` with ``run_max`` of ``high`` and ``run_min`` of ``low`` over all rows up to
    each one by ``order_col``: within the range partition, and over the earlier
    partitions' extremes (one row per partition)."""
    tagged = ranged(df, [order_col])
    upto = Window.partitionBy("_part").orderBy(order_col).rowsBetween(Window.unboundedPreceding, 0)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = tagged.groupBy("_part").agg(F.max(high).alias("_h"), F.min(low).alias("_l"))
    parts = parts.select("_part", F.max("_h").over(before).alias("_bh"), F.min("_l").over(before).alias("_bl"))
    run = tagged.select("*", F.max(high).over(upto).alias("_rh"), F.min(low).over(upto).alias("_rl"))
    return run.join(F.broadcast(parts), "_part").select(
        *df.columns, F.greatest("_rh", "_bh").alias("run_max"), F.least("_rl", "_bl").alias("run_min"))
