"""Registered graph queries over the ``pages`` link graph, with DuckDB oracles.

The test tables carry no link file and their hrefs resolve to no page, so the
graph is derived the same way in Spark and in SQL: every ``href`` maps to node
``md5-prefix mod count(pages)``, self-links dropped, repeats removed.
Citations are the transpose. Root sets come from TF-IDF ranking of the pages'
HTML for a batch of typed queries.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions.scaling import l2_change_term, signed_change_term
from quire.operators import blockmax
from quire.operators import graph as gr
from quire.operators import hits as ht
from quire.operators import index as ix
from quire.operators import linkscore as ls
from quire.operators import rank as rk
from quire.operators.runs import consecutive_runs
from quire.sources.adjacency import parse_adjacency
from quire.operators.loop import RoundState
from quire.operators.numbering import dense_ids
from quire.session import checkpoint_dir
from quire.sources.files import read_index, upsert_documents, write_index
from quire.sources.tables import adjacency_lines, page_links, pages_corpus, read_table, transpose_links

# The root-set query batch over the pages (frequent words at
# sf0.01), and the ranking mode used to pick roots.
PAGE_QUERIES = ["the", "and", "der tion", "des"]
ROOT_MODE = "tfidf"
DIGITS = 6


def page_queries(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(enumerate(PAGE_QUERIES)), "query_id bigint, query string")


def _graph(spark, sf_dir):
    """Links and citations; the pages are read and parsed once, into a written table."""
    pages = read_table(spark, sf_dir, "pages").select("page_id", "html")
    links = RoundState(spark, "page-links").settle(page_links(pages))
    return links, transpose_links(links)


def _nodes(spark, sf_dir):
    return read_table(spark, sf_dir, "pages").select(F.col("page_id").alias("node"))


def _n(spark, sf_dir):
    return read_table(spark, sf_dir, "pages").agg(F.count(F.lit(1))).scalar()


def _root(spark, sf_dir):
    idx = ix.build_index(pages_corpus(spark, sf_dir))
    return RoundState(spark, "root").settle(gr.root_set(rk.cosine_scores(idx, page_queries(spark), ROOT_MODE)))


def _base(spark, sf_dir):
    links, cits = _graph(spark, sf_dir)
    return RoundState(spark, "base").settle(gr.base_set(_root(spark, sf_dir), links, cits))


def _hits(base, spark, sf_dir):
    """HITS on every query's base set, to the stop rule."""
    links, cits = _graph(spark, sf_dir)
    return ht.hits(base, links, cits, tol=ht.HITS_TOL)


def _flat_seen(df):
    return df.select(*[c for c in df.columns if c != "seen"], F.col("seen.stage").alias("seen_stage"),
                     F.col("seen.rank").alias("seen_rank"), F.col("seen.pos").alias("seen_pos"))


def q_adjacency_parse(spark, sf_dir):
    pages = read_table(spark, sf_dir, "pages").select("page_id", "html")
    edges, _ = parse_adjacency(adjacency_lines(pages))
    return edges


def q_out_links(spark, sf_dir):
    links, _ = _graph(spark, sf_dir)
    return gr.out_links(links, _root(spark, sf_dir)).select("query_id", "node", "dst", "pos")


def q_in_links(spark, sf_dir):
    _, cits = _graph(spark, sf_dir)
    return gr.in_links(cits, _root(spark, sf_dir)).select("query_id", "node", "citing")


def q_degrees(spark, sf_dir):
    links, cits = _graph(spark, sf_dir)
    return gr.degrees(links, cits)


def q_root_set(spark, sf_dir):
    return _root(spark, sf_dir)


def q_root_set_block_max(spark, sf_dir):
    """The root set from the stored index of the pages, by block-max pruning."""
    out = f"{checkpoint_dir(spark).rstrip('/')}/stored-pages-{uuid.uuid4().hex[:12]}"
    write_index(ix.build_index(pages_corpus(spark, sf_dir)), out, block_docs=16, block_min_df=32)
    return blockmax.root_set(read_index(spark, out), page_queries(spark), ROOT_MODE)


def q_base_set(spark, sf_dir):
    return _flat_seen(_base(spark, sf_dir))


def _top(spark, sf_dir, score):
    t = ht.top_list(_hits(_base(spark, sf_dir), spark, sf_dir), score)
    return t.select("query_id", "rank", "node", F.round(score, DIGITS).alias(score), "rounds")


def q_hits_authorities(spark, sf_dir):
    return _top(spark, sf_dir, "authority")


def q_hits_hubs(spark, sf_dir):
    return _top(spark, sf_dir, "hub")


def _link_iterates(spark, sf_dir):
    links, cits = _graph(spark, sf_dir)
    rows = RoundState(spark, "rows").settle(gr.undirected_edges(links, cits))
    nodes, n = _nodes(spark, sf_dir), _n(spark, sf_dir)
    v0 = nodes.select("node", (F.lit(1.0) / n.cast("double")).alias("score"))
    v1 = gr.minmax_vector(gr.row_score_floor(rows, v0, nodes, n))
    v2 = gr.minmax_vector(gr.row_score_floor(rows, v1, nodes, n))
    return v1, v2


def q_convergence_test(spark, sf_dir):
    v1, v2 = _link_iterates(spark, sf_dir)
    d = v2.withColumnRenamed("score", "new").join(v1.withColumnRenamed("score", "old"), "node")
    s = d.agg(F.sum(l2_change_term("new", "old")).alias("l2_sq"),
              F.sum(signed_change_term("new", "old")).alias("signed_sum"))
    return s.select(F.round(F.sqrt("l2_sq"), DIGITS).alias("l2_change"),
                    F.round("signed_sum", DIGITS).alias("signed_sum"),
                    (F.sqrt("l2_sq") < ls.LINK_TOL).alias("l2_passes"),
                    F.coalesce(F.sqrt("signed_sum") < ls.LINK_TOL, F.lit(False)).alias("signed_passes"))


def _base_adjacency(spark, sf_dir):
    links, cits = _graph(spark, sf_dir)
    return gr.base_adjacency(_root(spark, sf_dir), links, cits)


def q_base_adjacency(spark, sf_dir):
    return _base_adjacency(spark, sf_dir)


def q_adjacency_transpose(spark, sf_dir):
    return gr.transpose(_base_adjacency(spark, sf_dir))


def q_matrix_vector(spark, sf_dir):
    links, cits = _graph(spark, sf_dir)
    root = _root(spark, sf_dir)
    m = gr.transpose(gr.base_adjacency(root, links, cits))
    ones = gr.base_set(root, links, cits).select("query_id", F.col("node").alias("i"), F.lit(1.0).alias("v"))
    return gr.matrix_vector(m, ones, keys=["query_id"])


def q_node_index(spark, sf_dir):
    links, cits = _graph(spark, sf_dir)
    base = RoundState(spark, "base").settle(gr.base_set(_root(spark, sf_dir), links, cits))
    lookups = gr.out_links(links, base.select("query_id", "node")).select("query_id", F.col("dst").alias("node")).distinct()
    return gr.node_index(gr.node_positions(base), lookups)


def q_score_vector(spark, sf_dir):
    base = _base(spark, sf_dir)
    h = _hits(base, spark, sf_dir).select("query_id", "node", "authority", "rounds")
    return gr.node_positions(base).join(h, ["query_id", "node"]).select(
        "query_id", "idx", "node", F.round("authority", DIGITS).alias("authority"), "rounds")


def q_undirected_edges(spark, sf_dir):
    links, cits = _graph(spark, sf_dir)
    return gr.undirected_edges(links, cits)


def q_row_score_floor(spark, sf_dir):
    links, cits = _graph(spark, sf_dir)
    nodes, n = _nodes(spark, sf_dir), _n(spark, sf_dir)
    v0 = nodes.select("node", (F.lit(1.0) / n.cast("double")).alias("score"))
    out = gr.row_score_floor(gr.undirected_edges(links, cits), v0, nodes, n)
    return out.select("node", F.round("score", 9).alias("score"))


def q_minmax_scale(spark, sf_dir):
    v1, _ = _link_iterates(spark, sf_dir)
    return v1.select("node", F.round("score", 9).alias("score"))


def q_link_score_sweep(spark, sf_dir):
    links, cits = _graph(spark, sf_dir)
    out = ls.ordered_sweep(gr.undirected_edges(links, cits), _nodes(spark, sf_dir), _n(spark, sf_dir))
    return out.select("node", F.round("score", DIGITS).alias("score"))


def q_link_score_converged(spark, sf_dir):
    links, cits = _graph(spark, sf_dir)
    out = ls.converged(gr.undirected_edges(links, cits), _nodes(spark, sf_dir), _n(spark, sf_dir))
    return out.select("node", F.round("score", DIGITS).alias("score"), "rounds")


def q_consecutive_runs(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem")
    return consecutive_runs(li.select(F.col("l_suppkey").alias("seq_id"), F.col("l_orderkey").alias("v")))


def q_corpus_upsert(spark, sf_dir):
    """Old corpus: the pages. New: every document under its own path, and two
    re-crawls of the English pages (lower- and upper-cased HTML) under the same
    paths, the greater text of which replaces the old page."""
    pages = read_table(spark, sf_dir, "pages")
    old = pages.select(F.col("url").alias("path"), F.col("html").alias("text"))
    old = dense_ids(old, ["path"])
    docs = read_table(spark, sf_dir, "documents").select(
        F.concat(F.col("source"), F.lit("/"), F.col("doc_id").cast("string")).alias("path"), "text")
    recrawl = pages.filter(F.col("url").contains("/en/")).select(
        F.col("url").alias("path"), F.lower("html").alias("text"))
    again = recrawl.select("path", F.upper("text").alias("text"))
    merged = upsert_documents(old, docs.unionByName(recrawl).unionByName(again))
    return merged.select("doc_id", "path", F.length("text").alias("n_chars"),
                         F.md5("text").alias("text_md5"))


QUERIES = {
    "corpus_upsert": q_corpus_upsert,
    "adjacency_parse": q_adjacency_parse,
    "out_links": q_out_links,
    "in_links": q_in_links,
    "degrees": q_degrees,
    "root_set": q_root_set,
    "root_set_block_max": q_root_set_block_max,
    "base_set": q_base_set,
    "hits_authorities": q_hits_authorities,
    "hits_hubs": q_hits_hubs,
    "convergence_test": q_convergence_test,
    "base_adjacency": q_base_adjacency,
    "adjacency_transpose": q_adjacency_transpose,
    "matrix_vector": q_matrix_vector,
    "node_index": q_node_index,
    "score_vector": q_score_vector,
    "undirected_edges": q_undirected_edges,
    "row_score_floor": q_row_score_floor,
    "link_score_sweep": q_link_score_sweep,
    "minmax_scale": q_minmax_scale,
    "link_score_converged": q_link_score_converged,
    "consecutive_runs": q_consecutive_runs,
}

# ---------------------------------------------------------------- oracles --

from quire.plans.text_queries import corpus_sql, cosine_sql  # noqa: E402

GRAPH_CTE = """
g_n AS (SELECT count(*) AS n FROM pages),
g_hl AS (SELECT page_id, regexp_extract_all(html, 'href="([^"]*)"', 1) AS l FROM pages),
g_h AS (SELECT page_id AS src, unnest(l) AS href, generate_subscripts(l, 1) AS i FROM g_hl),
g_hd AS (SELECT src, ('0x' || substr(md5(href), 1, 8))::BIGINT % (SELECT n FROM g_n) AS dst, i FROM g_h),
g_lf AS (SELECT src, dst, min(i) AS fi FROM g_hd WHERE dst <> src GROUP BY src, dst),
links AS (SELECT src, dst, (row_number() OVER (PARTITION BY src ORDER BY fi) - 1)::INTEGER AS pos FROM g_lf),
citations AS (SELECT dst AS doc, src AS citing, src::BIGINT AS pos FROM links),
nodes AS (SELECT page_id AS node FROM pages),
und AS (SELECT DISTINCT i, j FROM (SELECT src AS i, dst AS j FROM links
                                   UNION ALL SELECT doc AS i, citing AS j FROM citations))
"""

ROOT_CTE = """,
root AS (SELECT query_id, doc_id AS node, root_rank FROM (
           SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(cosine, 12) DESC, first_pos, doc_id)
                  AS root_rank FROM scores) WHERE root_rank <= 11),
seen_all AS (SELECT query_id, node, 0 AS stage, root_rank AS rank, 0 AS pos FROM root
             UNION ALL SELECT r.query_id, l.dst, 1, r.root_rank, l.pos FROM root r JOIN links l ON l.src = r.node
             UNION ALL SELECT r.query_id, c.citing, 2, r.root_rank, c.pos FROM root r JOIN citations c ON c.doc = r.node),
base AS (SELECT query_id, node, stage AS seen_stage, rank AS seen_rank, pos AS seen_pos FROM (
           SELECT *, row_number() OVER (PARTITION BY query_id, node ORDER BY stage, rank, pos) AS k FROM seen_all)
         WHERE k = 1),
badj AS (SELECT DISTINCT query_id, i, j, 1 AS w FROM (
           SELECT r.query_id, r.node AS i, l.dst AS j FROM root r JOIN links l ON l.src = r.node
           UNION ALL SELECT r.query_id, r.node AS i, c.citing AS j FROM root r JOIN citations c ON c.doc = r.node)),
positions AS (SELECT query_id, node, row_number() OVER (PARTITION BY query_id
                ORDER BY seen_stage, seen_rank, seen_pos, node) - 1 AS idx FROM base)
"""


def _page_head() -> str:
    return (corpus_sql("SELECT page_id AS doc_id, url AS path, html AS text FROM pages", PAGE_QUERIES)
            + "," + GRAPH_CTE + cosine_sql(ROOT_MODE) + ROOT_CTE)


def _graph_head() -> str:
    return "WITH " + GRAPH_CTE


#: All rounds as one recursion: a query's rows carry their vectors, and leave it
#: in the round whose change passes the stop test (or whose vector is zero).
_HITS = """
h_cit AS MATERIALIZED (SELECT b.query_id, c.doc AS node, c.citing FROM base b JOIN citations c ON c.doc = b.node
          JOIN base b2 ON b2.query_id = b.query_id AND b2.node = c.citing),
h_lnk AS MATERIALIZED (SELECT b.query_id, l.src AS node, l.dst FROM base b JOIN links l ON l.src = b.node
          JOIN base b2 ON b2.query_id = b.query_id AND b2.node = l.dst),
h_base AS MATERIALIZED (SELECT * FROM base),
h_all AS (
  WITH RECURSIVE hs(query_id, node, auth, hub, hub_in, r, done) AS (
    SELECT query_id, node, 0.0::DOUBLE, 0.0::DOUBLE, 1.0::DOUBLE, 0, false FROM h_base
    UNION ALL
    (WITH cur AS (SELECT * FROM hs WHERE NOT done),
     ar AS (SELECT s.query_id, s.node, s.auth, s.hub, s.r, coalesce(x.a, 0.0) AS a_raw FROM cur s LEFT JOIN (
         SELECT c.query_id, c.node, sum(q.hub_in) AS a FROM h_cit c JOIN cur q
         ON q.query_id = c.query_id AND q.node = c.citing GROUP BY c.query_id, c.node) x
         ON x.query_id = s.query_id AND x.node = s.node),
     an AS (SELECT query_id, sqrt(sum(a_raw * a_raw)) AS na FROM ar GROUP BY query_id),
     au AS (SELECT ar.*, na, CASE WHEN na > 0 THEN a_raw / na ELSE 0.0 END AS a_new FROM ar JOIN an USING (query_id)),
     hr AS (SELECT s.*, coalesce(x.h, 0.0) AS h_raw FROM au s LEFT JOIN (
         SELECT l.query_id, l.node, sum(q.a_new) AS h FROM h_lnk l JOIN au q
         ON q.query_id = l.query_id AND q.node = l.dst GROUP BY l.query_id, l.node) x
         ON x.query_id = s.query_id AND x.node = s.node),
     hn AS (SELECT query_id, sqrt(sum(h_raw * h_raw)) AS nh FROM hr GROUP BY query_id),
     hu AS (SELECT hr.*, nh, CASE WHEN nh > 0 THEN h_raw / nh ELSE 0.0 END AS h_new FROM hr JOIN hn USING (query_id)),
     st AS (SELECT query_id, (sqrt(sum((a_new - auth) * (a_new - auth))) < 1e-7
                              AND sqrt(sum((h_new - hub) * (h_new - hub))) < 1e-7)
                             OR max(na) = 0 OR max(nh) = 0 AS done FROM hu GROUP BY query_id)
     SELECT hu.query_id, hu.node, hu.a_new, hu.h_new, hu.h_new, hu.r + 1, st.done
     FROM hu JOIN st USING (query_id)))
  SELECT * FROM hs WHERE done),
hits AS (SELECT s.query_id, s.node, s.auth AS authority, s.hub, s.r AS rounds, b.seen_stage, b.seen_rank, b.seen_pos
         FROM h_all s JOIN base b USING (query_id, node))
"""


def _hits_top(score: str) -> str:
    return _page_head() + "," + _HITS + f"""
SELECT query_id, rank, node, round({score}, 6) AS {score}, rounds FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id
         ORDER BY round({score}, 12) DESC, seen_stage, seen_rank, seen_pos) AS rank FROM hits)
WHERE rank <= 11
"""


def _link_round(r: int) -> str:
    return f"""
raw{r} AS MATERIALIZED (SELECT nd.node, CASE WHEN x.s > 0 THEN x.s ELSE 1.0 / (SELECT n FROM g_n) END AS score
    FROM nodes nd LEFT JOIN (SELECT u.i, sum(v.score) AS s FROM und u JOIN v{r - 1} v ON v.node = u.j
                              GROUP BY u.i) x ON x.i = nd.node),
v{r} AS MATERIALIZED (SELECT node, CASE WHEN g.mx = g.mn THEN 0.5 ELSE (score - g.mn) / (g.mx - g.mn) END AS score
    FROM raw{r}, (SELECT greatest(0.0, max(score)) AS mx, least(1.7976931348623157e308, min(score)) AS mn
                  FROM raw{r}) g)"""


_V0 = ",\nv0 AS (SELECT node, 1.0 / (SELECT n FROM g_n) AS score FROM nodes)"


#: The synchronous rounds as one recursion, which ends with the first round whose change is small.
_CONVERGED = """,
c_und AS MATERIALIZED (SELECT * FROM und),
c_n AS MATERIALIZED (SELECT n FROM g_n),
c_nodes AS MATERIALIZED (SELECT * FROM nodes),
c_all AS (
  WITH RECURSIVE cv(node, score, r, done) AS (
    SELECT node, 1.0::DOUBLE / n, 0, false FROM c_nodes, c_n
    UNION ALL
    (WITH cur AS (SELECT * FROM cv WHERE NOT done),
     raw AS (SELECT c.node, c.score AS old, c.r, CASE WHEN x.s > 0 THEN x.s ELSE 1.0::DOUBLE / n END AS raw
             FROM cur c LEFT JOIN (SELECT u.i, sum(v.score) AS s FROM c_und u JOIN cur v ON v.node = u.j GROUP BY u.i) x
             ON x.i = c.node, c_n),
     g AS (SELECT greatest(0.0, max(raw)) AS mx, least(1.7976931348623157e308, min(raw)) AS mn FROM raw),
     nw AS (SELECT node, old, r, CASE WHEN mx = mn THEN 0.5 ELSE (raw - mn) / (mx - mn) END AS score FROM raw, g),
     st AS (SELECT sqrt(sum((score - old) * (score - old))) < 1e-5 AS done FROM nw)
     SELECT nw.node, nw.score, nw.r + 1, st.done FROM nw, st))
  SELECT * FROM cv WHERE done)
SELECT node, round(score, 6) AS score, r AS rounds FROM c_all
"""

_SWEEP = """,
rowlist AS (SELECT i, list(j ORDER BY j) AS js FROM und GROUP BY i),
sweep AS (
  WITH RECURSIVE sw(i, s) AS (
    SELECT 0::BIGINT AS i, list_transform(range(g.n), lambda x: 1.0 / g.n) AS s FROM g_n g
    UNION ALL
    SELECT sw.i + 1,
           list_transform(sw.s, lambda x, k: CASE WHEN k - 1 = sw.i THEN
               CASE WHEN coalesce(list_sum(list_transform(r.js, lambda j: sw.s[j + 1])), 0.0) > 0
                    THEN list_sum(list_transform(r.js, lambda j: sw.s[j + 1])) ELSE sw.inv END
               ELSE x END)
    FROM (SELECT sw.*, 1.0 / (SELECT n FROM g_n) AS inv FROM sw) sw LEFT JOIN rowlist r ON r.i = sw.i
    WHERE sw.i < (SELECT n FROM g_n))
  SELECT s FROM sw WHERE i = (SELECT n FROM g_n)),
sv AS (SELECT generate_subscripts(s, 1) - 1 AS node, unnest(s) AS score FROM sweep),
sg AS (SELECT greatest(0.0, max(score)) AS mx, min(score) AS mn FROM sv)
SELECT node, round(CASE WHEN mx = mn THEN 0.5 ELSE (score - mn) / (mx - mn) END, 6) AS score FROM sv, sg
"""

_V12 = _V0 + "," + _link_round(1) + "," + _link_round(2)

ORACLE: dict[str, str] = {
    "corpus_upsert": """
WITH old AS (SELECT url AS path, html AS text FROM pages),
newd AS (SELECT path, max(text) AS text FROM (
         SELECT source || '/' || CAST(doc_id AS VARCHAR) AS path, text FROM documents
         UNION ALL SELECT url AS path, lower(html) AS text FROM pages WHERE contains(url, '/en/')
         UNION ALL SELECT url AS path, upper(lower(html)) AS text FROM pages WHERE contains(url, '/en/')) GROUP BY path),
merged AS (SELECT path, text FROM old WHERE path NOT IN (SELECT path FROM newd)
           UNION ALL SELECT path, text FROM newd)
SELECT row_number() OVER (ORDER BY path) - 1 AS doc_id, path, length(text) AS n_chars, md5(text) AS text_md5
FROM merged""",
    "adjacency_parse": _graph_head() + "SELECT src, dst, pos FROM links",
    "out_links": _page_head() + """SELECT r.query_id, r.node, l.dst, l.pos
        FROM root r JOIN links l ON l.src = r.node""",
    "in_links": _page_head() + """SELECT r.query_id, r.node, c.citing
        FROM root r JOIN citations c ON c.doc = r.node""",
    "degrees": _graph_head() + """SELECT coalesce(a.node, b.node) AS node, coalesce(a.c, 0) AS n_links,
        coalesce(b.c, 0) AS n_citations
        FROM (SELECT src AS node, count(*) AS c FROM links GROUP BY src) a
        FULL OUTER JOIN (SELECT doc AS node, count(*) AS c FROM citations GROUP BY doc) b ON a.node = b.node""",
    "root_set": _page_head() + "SELECT query_id, node, root_rank FROM root",
    "root_set_block_max": _page_head() + "SELECT query_id, node, root_rank FROM root",
    "base_set": _page_head() + "SELECT query_id, node, seen_stage, seen_rank, seen_pos FROM base",
    "hits_authorities": _hits_top("authority"),
    "hits_hubs": _hits_top("hub"),
    "convergence_test": _graph_head() + _V12 + """
SELECT round(sqrt(sum((b.score - a.score) * (b.score - a.score))), 6) AS l2_change,
       round(sum(((a.score * a.score - b.score * b.score)::FLOAT)::DOUBLE), 6) AS signed_sum,
       sqrt(sum((b.score - a.score) * (b.score - a.score))) < 1e-5 AS l2_passes,
       coalesce(sqrt(sum(((a.score * a.score - b.score * b.score)::FLOAT)::DOUBLE)) < 1e-5, false) AS signed_passes
FROM v1 a JOIN v2 b USING (node)""",
    "base_adjacency": _page_head() + "SELECT query_id, i, j, w FROM badj",
    "adjacency_transpose": _page_head() + "SELECT query_id, j AS i, i AS j, w FROM badj",
    "matrix_vector": _page_head() + """SELECT m.query_id, m.j AS i, sum(m.w * 1.0) AS value
        FROM badj m JOIN base b ON b.query_id = m.query_id AND b.node = m.i GROUP BY m.query_id, m.j""",
    "node_index": _page_head() + """SELECT k.query_id, k.node, coalesce(p.idx, -1) AS idx FROM (
        SELECT DISTINCT b.query_id, l.dst AS node FROM base b JOIN links l ON l.src = b.node) k
        LEFT JOIN positions p ON p.query_id = k.query_id AND p.node = k.node""",
    "score_vector": _page_head() + "," + _HITS + """
SELECT p.query_id, p.idx, p.node, round(h.authority, 6) AS authority, h.rounds
FROM positions p JOIN hits h ON h.query_id = p.query_id AND h.node = p.node""",
    "undirected_edges": _graph_head() + "SELECT i, j FROM und",
    "row_score_floor": _graph_head() + _V0 + "," + _link_round(1) + "SELECT node, round(score, 9) AS score FROM raw1",
    "link_score_sweep": _graph_head() + _SWEEP,
    "minmax_scale": _graph_head() + _V0 + "," + _link_round(1) + "SELECT node, round(score, 9) AS score FROM v1",
    "link_score_converged": _graph_head() + _CONVERGED,
    "consecutive_runs": """
WITH d AS (SELECT DISTINCT l_suppkey AS seq_id, l_orderkey AS v FROM lineitem),
p AS (SELECT seq_id, v, row_number() OVER (PARTITION BY seq_id ORDER BY v) - 1 AS idx FROM d)
SELECT seq_id, min(idx) AS run_start, max(idx) AS run_end FROM p GROUP BY seq_id, v - idx
HAVING max(idx) > min(idx)""",
}
