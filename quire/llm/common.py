"""Shared pieces of the training-data operators.

Every operator first projects the columns it needs, so extra columns of the
input (whatever their names) never meet the operator's own columns. A null
text counts as the empty text unless an operator's docstring says otherwise.
"""

from __future__ import annotations

import contextlib
import ctypes
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.session import checkpoint_dir

#: Text bytes that one numpy step works on at once, unless one document is longer.
BLOCK_BYTES = 1 << 20


def doc_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id bigint, text string)``; a null text becomes the empty text."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def settled_path(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def settle(df: DataFrame, name: str, **options) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back; ``options``
    are the writer's.

    Cuts lineage: a lost executor's share is read again from the folder. The
    table stays there, for the result may be evaluated later; the folder's
    owner clears it.
    """
    path = settled_path(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


@contextlib.contextmanager
def arrow_batches(spark: SparkSession, max_bytes: int) -> Iterator[None]:
    """While it holds, jobs hand Python batches of about ``max_bytes`` (or one row):
    a batch lies several times in an executor, in both processes of each core."""
    own = spark.conf.get(_BATCH_BYTES, None)
    spark.conf.set(_BATCH_BYTES, str(max_bytes))
    try:
        yield
    finally:
        spark.conf.unset(_BATCH_BYTES) if own is None else spark.conf.set(_BATCH_BYTES, own)


def release() -> None:
    """Give freed memory back to the system: a Python worker lives on between
    tasks, and its high mark would count against the executor."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def text_blocks(batches: Iterable[pa.RecordBatch], text_col: str = "text",
                max_bytes: int = BLOCK_BYTES) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Slices of the incoming batches with at most ``max_bytes`` of text (or one row)."""
    for batch in batches:
        release()
        col = batch.column(batch.schema.get_field_index(text_col))
        upto = np.cumsum(pc.binary_length(col).to_numpy(zero_copy_only=False), dtype=np.int64)
        lo = 0
        while lo < batch.num_rows:
            before = upto[lo - 1] if lo else 0
            hi = max(lo + 1, int(np.searchsorted(upto, before + max_bytes, side="right")))
            yield batch.slice(lo, hi - lo), col.slice(lo, hi - lo).to_pylist()
            lo = hi
