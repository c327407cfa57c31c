"""Driver-side loop support for the iterative operators.

Each round is one DataFrame plan over the previous round's state. The state
is written as a table under the shared checkpoint folder
(``spark.checkpoint.dir``) and read back, which cuts both the lineage and the
logical plan: ``Dataset.checkpoint`` keeps the origin plan attached, and over
tens of rounds that plan (and its planning time) grows without bound. A lost
executor's work is then re-read from the shared folder instead of being
recomputed from round one. The only values that come back to the driver are
per-round counts and flags used to stop. Tables of rounds that are no longer
read are deleted as the loop goes on.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql.observation import Observation

from quire.session import checkpoint_dir


class RoundState:
    """Materialises loop state as written tables under one run folder."""

    def __init__(self, spark, name: str = "loop"):
        base = checkpoint_dir(spark).rstrip("/")
        self.spark = spark
        self.root = f"{base}/{name}-{uuid.uuid4().hex[:12]}"
        self._n = 0
        self._rounds: list[str] = []

    def settle(self, df: DataFrame, path: str | None = None) -> DataFrame:
        """Write ``df`` and read it back; the table stays until the folder's owner clears it."""
        self._n += 1
        path = f"{self.root}/{path or f't{self._n:06d}'}"
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def settle_by(self, df: DataFrame, key: str, path: str) -> DataFrame:
        """``settle`` with a folder for each value of ``key``, whose rows may span
        several files (the rebalancing splits what is large and joins what is small)."""
        path = f"{self.root}/{path}"
        df.hint("rebalance", key).write.mode("overwrite").partitionBy(key).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def settle_observed(self, df: DataFrame, *metrics, path: str | None = None) -> tuple[DataFrame, dict]:
        """Write the state and gather aggregate ``metrics`` over it in the
        same job (``DataFrame.observe``), so they cost no extra pass."""
        obs = Observation(f"round{self._n + 1}-{uuid.uuid4().hex[:6]}")
        out = self.settle(df.observe(obs, *metrics), path)
        return out, obs.get

    def next_round(self, df: DataFrame, *metrics, keep: int = 1):
        """Settle a round's state (observed, if there are metrics) and delete the
        states of all rounds but the last ``keep`` before it."""
        name = f"round{self._n + 1:06d}"
        out = self.settle_observed(df, *metrics, path=name) if metrics else self.settle(df, name)
        self._rounds.append(name)
        while len(self._rounds) > keep + 1:
            self.delete(self._rounds.pop(0))
        return out

    def delete(self, name: str) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


class NoConvergence(RuntimeError):
    """The stop test did not hold within the allowed number of rounds."""
