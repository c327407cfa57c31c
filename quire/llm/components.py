"""Connected components of a link table, by alternating star contraction.

Every round is a few joins over the links; state is written to the shared
folder, and only a row count and a checksum come to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.common import settle
from quire.operators.loop import RoundState


def components(links: DataFrame) -> DataFrame:
    """``links``: ``(a bigint, b bigint)``, any direction. Returns ``(node, root)``
    for every linked node but the roots; ``root`` is its component's least node.

    Large star: each node hands its larger neighbours its least neighbour.
    Small star: each node hands its smaller neighbours, and itself, the least.
    The rounds end when the links no longer change; each is a star by then.
    The minima are written before they are joined, so that the join is between
    two plain shuffles, whose skewed partitions Spark splits.
    """
    state = RoundState(links.sparkSession, "components")
    hi, lo = F.greatest("a", "b"), F.least("a", "b")
    edges = links.select(hi.alias("a"), lo.alias("b")).where("a <> b").distinct()
    seen = None
    while True:
        edges, facts = state.settle_observed(edges, F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("sum"))
        now = (facts["n"], facts["sum"])
        if now == seen or not facts["n"]:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        seen = now
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = state.settle(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")))
        large = (both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .where("a <> b").distinct())
        large = state.settle(large)
        least = state.settle(large.groupBy("a").agg(F.min("b").alias("m")))
        edges = (large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .unionByName(least.select("a", F.col("m").alias("b"))).distinct())
