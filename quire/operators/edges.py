"""Edges that stay in place while vectors come to them, round after round.

The iterative operators multiply the same edges with a new vector in every
round. The edges are written once as a bucketed table, so that no round
shuffles them; what moves is the vector, or sums of its values.

* A vector within the session's broadcast threshold (its rows are counted) is
  broadcast. The edges are bucketed by what the products are summed by, so
  the sum needs no shuffle either: a round has no shuffle at all.
* A larger vector is shuffled to edges bucketed by the vector's key. Products
  are partly summed in each task before they are shuffled. The edges of a very
  frequent key are salted over several buckets, and its vector row is copied
  to them.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.operators.loop import RoundState

VECTOR_ROW_BYTES = 64  # of a vector row in a broadcast table
SMALL_BUCKET, LARGE_BUCKET = 50_000, 2_000_000  # edges of a bucket: up to the session's shuffle partitions, and beyond
HEAVY_EDGES = 4_000_000  # edges of one key that fill a bucket by themselves


class PlacedEdges:
    """``edges`` to be joined with vectors on ``source`` and summed by ``target``
    (lists of columns). ``vector_rows`` is the vectors' number of rows."""

    def __init__(self, loop: RoundState, edges: DataFrame, source: list[str], target: list[str], vector_rows: int,
                 broadcast: bool | None = None, heavy_edges: int = HEAVY_EDGES):
        spark = loop.spark
        self.source, self.spark = source, spark
        limit = spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
        self.broadcast = vector_rows * VECTOR_ROW_BYTES <= limit if broadcast is None else broadcast
        n = edges.count()
        parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.buckets = max(1, min(parts, -(-n // SMALL_BUCKET)), -(-n // LARGE_BUCKET))
        self.heavy = None
        keys = target
        if not self.broadcast:
            keys = source
            heavy = edges.groupBy(*source).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > heavy_edges)
            heavy = loop.settle(heavy.select(*source, F.ceil(F.col("_n") / heavy_edges).cast("int").alias("_parts")))
            if not heavy.isEmpty():  # at most one for each ``heavy_edges`` edges
                self.heavy, keys = heavy, [*source, "_salt"]
                others = [c for c in edges.columns if c not in source]
                spread = F.pmod(F.xxhash64(*others), F.coalesce("_parts", F.lit(1))).cast("int")
                edges = edges.join(F.broadcast(heavy), source, "left").select(*edges.columns, spread.alias("_salt"))
        self.keys = keys
        self.name = f"quire_edges_{uuid.uuid4().hex[:12]}"
        (edges.repartition(self.buckets, *keys).write.format("parquet").bucketBy(self.buckets, *keys).sortBy(*keys)
         .option("path", f"{loop.root}/{self.name}").saveAsTable(self.name))
        self.table = spark.table(self.name)

    def pull(self, vector: DataFrame) -> DataFrame:
        """The edges with the columns of ``vector``, which has ``source`` columns."""
        if self.broadcast:
            return self.table.join(F.broadcast(vector), self.source)
        on = self.source
        if self.heavy is not None:
            on = self.keys
            vector = vector.join(F.broadcast(self.heavy), self.source, "left").select(
                *vector.columns, F.explode(F.sequence(F.lit(0), F.coalesce("_parts", F.lit(1)) - 1)).alias("_salt"))
        return self.table.hint("merge").join(vector.repartition(self.buckets, *on), on)

    def close(self) -> None:
        """Take the table out of the catalog; its files stay with the loop's."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")
