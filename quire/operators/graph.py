"""Sparse link-graph operators.

``links (src, dst, pos)``: the out-links of ``src`` in file order.
``citations (doc, citing, pos)``: the documents citing ``doc``.
Sets of documents per query are ``(query_id, node, ...)`` DataFrames, so a
batch of queries is one plan. Matrices are edge lists ``(i, j, w)`` and
vectors are ``(i, v)``; nothing is dense.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quire.functions.scaling import RANGE_MAX_START, RANGE_MIN_START, minmax_scale
from quire.operators.loop import RoundState
from quire.operators.numbering import positions_within
from quire.operators.rank import order_key

# K = 10 but the root loop stops after count > K, so 11 roots.
ROOT_SIZE = 11

STAGE_ROOT, STAGE_LINK, STAGE_CITATION = 0, 1, 2


def out_links(links: DataFrame, nodes: DataFrame) -> DataFrame:
    """L1 for a set: ``nodes (…, node)`` ⋈ links on src → adds ``dst, pos``."""
    return nodes.join(links.withColumnRenamed("src", "node"), "node")


def in_links(citations: DataFrame, nodes: DataFrame) -> DataFrame:
    """L2 for a set: adds ``citing, pos``."""
    return nodes.join(citations.withColumnRenamed("doc", "node"), "node")


def degrees(links: DataFrame, citations: DataFrame) -> DataFrame:
    """L3: ``(node, n_links, n_citations)`` for every node with either."""
    lo = links.groupBy(F.col("src").alias("node")).agg(F.count(F.lit(1)).alias("n_links"))
    ci = citations.groupBy(F.col("doc").alias("node")).agg(F.count(F.lit(1)).alias("n_citations"))
    return lo.join(ci, "node", "full").select(
        "node", F.coalesce("n_links", F.lit(0)).alias("n_links"),
        F.coalesce("n_citations", F.lit(0)).alias("n_citations"))


def root_set(scores: DataFrame, size: int = ROOT_SIZE) -> DataFrame:
    """L4: the ``size`` best documents per query by cosine.

    ``scores`` is :func:`quire.operators.rank.cosine_scores` output; the root
    rank keeps the reference's order (best first, ties in insertion order).
    """
    w = Window.partitionBy("query_id").orderBy(*order_key())
    return (scores.withColumn("root_rank", F.row_number().over(w))
            .filter(F.col("root_rank") <= size)
            .select("query_id", F.col("doc_id").alias("node"), "root_rank"))


def base_set(root: DataFrame, links: DataFrame, citations: DataFrame) -> DataFrame:
    """Root ∪ links(root) ∪ citations(root), one row per (query, node).

    ``seen`` = (stage, root rank, position) of the first time the node enters
    the set, i.e. the reference's insertion order: roots, then link targets
    root by root, then citing documents.
    """
    r = root.select("query_id", "node", F.struct(
        F.lit(STAGE_ROOT).alias("stage"), F.col("root_rank").alias("rank"), F.lit(0).cast("bigint").alias("pos")).alias("seen"))
    lk = out_links(links, root).select("query_id", F.col("dst").alias("node"), F.struct(
        F.lit(STAGE_LINK).alias("stage"), F.col("root_rank").alias("rank"), F.col("pos").cast("bigint").alias("pos")
    ).alias("seen"))
    ct = in_links(citations, root).select("query_id", F.col("citing").alias("node"), F.struct(
        F.lit(STAGE_CITATION).alias("stage"), F.col("root_rank").alias("rank"),
        F.col("pos").cast("bigint").alias("pos")).alias("seen"))
    return r.unionByName(lk).unionByName(ct).groupBy("query_id", "node").agg(F.min("seen").alias("seen"))


def base_edges(base: DataFrame, links: DataFrame, citations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Edges with both ends in a query's base set, repeats kept.

    Returns ``(cit_edges (query_id, node, citing), link_edges (query_id, node, dst))``:
    the authority of ``node`` sums hubs over ``citing``; the hub of ``node``
    sums authorities over ``dst``.
    """
    b = base.select("query_id", "node")
    cit = in_links(citations, b).select("query_id", "node", "citing").join(
        b.withColumnRenamed("node", "citing"), ["query_id", "citing"], "left_semi")
    lnk = out_links(links, b).select("query_id", "node", "dst").join(
        b.withColumnRenamed("node", "dst"), ["query_id", "dst"], "left_semi")
    return cit, lnk


def base_adjacency(root: DataFrame, links: DataFrame, citations: DataFrame) -> DataFrame:
    """``(query_id, i, j, w=1)``: root doc ``i`` links to or is cited by ``j``."""
    lk = out_links(links, root).select("query_id", F.col("node").alias("i"), F.col("dst").alias("j"))
    ct = in_links(citations, root).select("query_id", F.col("node").alias("i"), F.col("citing").alias("j"))
    return lk.unionByName(ct).distinct().withColumn("w", F.lit(1))


def transpose(m: DataFrame) -> DataFrame:
    """Swap row and column."""
    return m.select(*[c for c in m.columns if c not in ("i", "j", "w")],
                    F.col("j").alias("i"), F.col("i").alias("j"), "w")


def matrix_vector(m: DataFrame, v: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """``(…, i, value = Σ_j w * v_j)``; ``v`` is ``(…, i, v)``."""
    keys = keys or []
    vv = v.select(*keys, F.col("i").alias("j"), F.col("v"))
    return m.join(vv, keys + ["j"]).groupBy(*keys, "i").agg(
        F.sum(F.col("w") * F.col("v")).alias("value"))


def node_positions(base: DataFrame) -> DataFrame:
    """Index of each base node in insertion order, ``0..|base|-1`` per query.

    Numbered with the range-partitioned dense numbering, then shifted by each
    query's first number, so a large base set is never sorted in one task.
    """
    flat = base.select("query_id", "node", F.col("seen.stage").alias("s1"),
                       F.col("seen.rank").alias("s2"), F.col("seen.pos").alias("s3"))
    return positions_within(flat, ["query_id"], ["s1", "s2", "s3", "node"]).select("query_id", "node", "idx")


def node_index(positions: DataFrame, lookups: DataFrame) -> DataFrame:
    """``(query_id, node, idx)`` with ``-1`` for nodes not in the base set."""
    return lookups.join(positions, ["query_id", "node"], "left").select(
        "query_id", "node", F.coalesce("idx", F.lit(-1)).alias("idx"))


def undirected_edges(links: DataFrame, citations: DataFrame) -> DataFrame:
    """``(i, j)`` for j in links(i) ∪ citations(i), deduplicated."""
    a = links.select(F.col("src").alias("i"), F.col("dst").alias("j"))
    b = citations.select(F.col("doc").alias("i"), F.col("citing").alias("j"))
    return a.unionByName(b).distinct()


def row_score_floor(rows: DataFrame, scores: DataFrame, nodes: DataFrame, n_nodes) -> DataFrame:
    """``score'(i) = Σ_{j in row(i)} score(j)``, or ``1/n`` when not > 0.

    ``rows (i, j)``, ``scores (node, score)``, ``nodes (node)``: every node
    gets a value, including nodes without a row.
    """
    s = rows.join(scores.withColumnRenamed("node", "j"), "j").groupBy("i").agg(
        F.sum("score").alias("s"))
    floor = F.lit(1.0) / n_nodes.cast("double") if not isinstance(n_nodes, (int, float)) else F.lit(1.0 / n_nodes)
    return nodes.join(s.withColumnRenamed("i", "node"), "node", "left").select(
        "node", F.when(F.col("s") > 0, F.col("s")).otherwise(floor).alias("score"))


def minmax_vector(vec: DataFrame, col: str = "score") -> DataFrame:
    """Scale a whole vector to [0, 1]; max starts at 0, all 0.5 when flat.

    The vector is written once, its range observed in the same job, and the
    scaling is applied when it is read.
    """
    raw, m = RoundState(vec.sparkSession, "minmax").settle_observed(vec, F.max(col).alias("mx"), F.min(col).alias("mn"))
    if m["mx"] is None:
        return raw
    lo, hi = min(RANGE_MIN_START, m["mn"]), max(RANGE_MAX_START, m["mx"])
    return raw.withColumn(col, minmax_scale(F.col(col), F.lit(lo), F.lit(hi), digits=None))
