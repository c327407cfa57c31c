"""SimHash near-duplicates by meet-in-the-middle ball hashing.

A document's 64-bit fingerprint is the bitwise majority of its word shingles'
XXH64 values. Two fingerprints at most ``2 * half`` bits apart have a common
point within ``half`` bits of each: every distinct fingerprint emits all
points of its ball of radius ``half``; those that meet at a point are linked
to the least of them, each link is verified once on its bit distance, and the
links' connected components are the groups. A point's meeting is bounded by
the ball's size, however many documents share a fingerprint, because copies
are one fingerprint before anything is emitted.

A null or empty text, and one without words, has the fingerprint zero and is
linked like any other. A null ``doc_id`` belongs to its group but never names
it. Repeated rows are one group. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.llm.common import doc_texts, settle, text_blocks
from quire.llm.components import components
from quire.llm.words import single_spaced, text_of, words

_LOWER = bytes(range(256)).replace(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
SEED = 42


def fingerprint(texts: list[str], shingle: int = 3) -> np.ndarray:
    """Signed 64-bit fingerprints of some texts."""
    flat, ends, counts = words(texts)
    data, starts, stops = single_spaced(flat.translate(_LOWER), ends)
    first = np.cumsum(counts) - counts
    n_shingles = np.where(counts > 0, np.maximum(counts - shingle + 1, 1), 0)
    owner = text_of(n_shingles)
    at = first[owner] + np.arange(len(owner)) - (np.cumsum(n_shingles) - n_shingles)[owner]
    stop = stops[np.minimum(at + shingle, (first + counts)[owner]) - 1]
    digest = xxhash.xxh64_intdigest
    out = np.zeros(len(texts), np.int64)
    step = 1 << 17  # shingles whose bits are unpacked at once
    ones = np.zeros((len(texts), 64), np.int64)
    for lo in range(0, len(at), step):
        a, b, own = starts[at[lo:lo + step]].tolist(), stop[lo:lo + step].tolist(), owner[lo:lo + step]
        h = np.fromiter((digest(data[i:j], SEED) for i, j in zip(a, b)), ">u8", len(a))
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1)
        cuts = np.flatnonzero(np.diff(own, prepend=-1))
        ones[own[cuts]] += np.add.reduceat(bits, cuts, axis=0, dtype=np.int64)
    out = np.packbits(2 * ones > n_shingles[:, None], axis=1).view(">i8").reshape(-1)
    return out.astype(np.int64)


def fingerprints(docs: DataFrame, shingle: int = 3, key: Column | None = None) -> DataFrame:
    """``(doc_id, fp bigint)``, a row for each document; with ``key``, a bigint of
    its ``text``, also that."""
    own, names = doc_texts(docs), ["doc_id", "fp"]
    if key is not None:
        own, names = own.withColumn("key", key), [*names, "key"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in text_blocks(batches):
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(fingerprint(texts, shingle)), *rows.columns[2:]], names)

    return own.mapInArrow(run, ", ".join(f"{c} bigint" for c in names))


def _ball(radius: int) -> list[int]:
    """All 64-bit masks with at most ``radius`` bits, as signed integers."""
    masks = [sum(1 << b for b in bits) for k in range(radius + 1) for bits in combinations(range(64), k)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def links(fps: DataFrame, max_bits: int = 2) -> DataFrame:
    """Links ``(a, b)`` between the distinct values of ``fp`` that connect all
    pairs at most ``max_bits`` (an even number) apart: any two in a ball of
    radius half are that near, so each need only be linked to the ball's least."""
    if max_bits % 2:
        raise ValueError("max_bits must be even: a ball's radius is half of it")
    half = max_bits // 2
    balls = fps.select("fp", F.explode(F.array(*map(F.lit, _ball(half)))).alias("mask"))
    balls = balls.select("fp", F.col("fp").bitwiseXOR(F.col("mask")).alias("point"))
    far = F.bit_count(F.col("a").bitwiseXOR(F.col("b")))
    met = balls.select(F.col("fp").alias("a"), F.min("fp").over(Window.partitionBy("point")).alias("b"))
    return met.where("b < a").distinct().where(far <= max_bits)


def _groups(prints: DataFrame, max_bits: int) -> DataFrame:
    """``(fp, root, component_id)`` for every distinct ``fp`` of ``(doc_id, fp)``
    rows; ``root`` names the group itself, for ids may repeat."""
    fps = settle(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-distinct")
    roots = settle(components(links(fps, max_bits)), "simhash-roots")
    placed = settle(fps.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
                    .select("fp", F.coalesce("root", "fp").alias("root"), "least"), "simhash-placed")
    named = settle(placed.groupBy("root").agg(F.min("least").alias("component_id")), "simhash-named")
    return settle(placed.join(named, "root").select("fp", "root", "component_id"), "simhash-groups")


def near_duplicates(docs: DataFrame, shingle: int = 3, max_bits: int = 2) -> DataFrame:
    """``(doc_id, fp, component_id)``: ``component_id`` is the least ``doc_id`` that
    links reach (null if the group has no id)."""
    prints = settle(fingerprints(docs, shingle), "simhash")
    return prints.join(_groups(prints, max_bits), "fp").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, shingle: int = 3, max_bits: int = 2) -> DataFrame:
    """The rows of ``docs``, all columns, one of each group: that of the least
    ``doc_id``; of several texts with that id, the one of the least hash, and of
    repeated rows one. Rows without an id stay only where their group has none."""
    key = F.xxhash64(F.coalesce("text", F.lit("")))
    prints = settle(fingerprints(docs, shingle, key), "simhash")
    found = prints.join(_groups(prints, max_bits), "fp")
    stay = settle(found.where(F.col("doc_id").eqNullSafe(F.col("component_id")))
                  .groupBy("root").agg(F.min("doc_id").alias("id"), F.min("key").alias("key"))
                  .select(F.coalesce("id", F.lit(0)).alias("id"), F.isnull("id").alias("bare"), "key"), "simhash-stay")
    by = ["id", "bare", "key"]
    # the row travels as one struct: no column of its own meets these names
    own = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("id"),
                      F.isnull("doc_id").alias("bare"), key.alias("key"))
    return own.join(stay, by, "left_semi").dropDuplicates(by).select("row.*")
