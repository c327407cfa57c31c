"""Registered text queries over the given tables, with their DuckDB oracles.

Every query reads whole tables (``documents`` for ranking, ``pages`` where a
URL is needed); the query batch is a literal list of typed lines, as the
reference reads them from a prompt.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions.text import decode_path
from quire.operators import index as ix
from quire.operators import rank as rk
from quire.functions.text import ENGLISH_STOP_WORDS, word_break_pattern
from quire.operators.numbering import dense_ids
from quire.session import checkpoint_dir
from quire.sources.files import read_index, upsert_index, write_index
from quire.sources.tables import documents_corpus, pages_corpus, read_table, spread

# The query batch typed at the prompt (a repeated word, an absent
# word, an upper-case word), and the term looked up directly.
DOC_QUERIES = ["the", "the und the", "von zu absentword", "The", "inon thnd of er"]
LOOKUP_TERM = "the"
# A slice inside a small vocabulary, beside the reference's deep one.
NEAR_SLICE_OFFSET = 1000


def doc_queries(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(enumerate(DOC_QUERIES)), "query_id bigint, query string")


def _index(spark, sf_dir) -> ix.Index:
    return ix.build_index(documents_corpus(spark, sf_dir))


def q_corpus_size(spark, sf_dir):
    d = read_table(spark, sf_dir, "documents")
    return d.agg(F.count(F.lit(1)).alias("n_docs"))


def q_postings(spark, sf_dir):
    return ix.postings(documents_corpus(spark, sf_dir))


def q_vocabulary(spark, sf_dir):
    return ix.vocabulary(ix.postings(documents_corpus(spark, sf_dir)))


def q_vocabulary_slice(spark, sf_dir):
    return ix.vocabulary_slice(ix.postings(documents_corpus(spark, sf_dir)))


def q_document_frequency(spark, sf_dir):
    return ix.document_frequency(ix.postings(documents_corpus(spark, sf_dir)))


def q_postings_lookup(spark, sf_dir):
    return ix.postings_lookup(ix.postings(documents_corpus(spark, sf_dir)), LOOKUP_TERM)


def q_document_lookup(spark, sf_dir):
    docs = pages_corpus(spark, sf_dir)
    ids = ix.postings_lookup(ix.postings(docs), LOOKUP_TERM)
    return ix.document_lookup(docs, ids)


def q_decoded_paths(spark, sf_dir):
    """T9 on paths in the stored form: each page's URL with its slashes encoded."""
    pages = read_table(spark, sf_dir, "pages")
    stored = pages.select("page_id", F.replace("url", F.lit("/"), F.lit("%%")).alias("path"))
    return stored.select("page_id", "path", decode_path("path").alias("url"))


def q_vocabulary_slice_near(spark, sf_dir):
    return ix.vocabulary_slice(ix.postings(documents_corpus(spark, sf_dir)), offset=NEAR_SLICE_OFFSET)


def q_postings_stop_words(spark, sf_dir):
    return ix.postings(documents_corpus(spark, sf_dir), stop_words=ENGLISH_STOP_WORDS)


def q_postings_word_breaks(spark, sf_dir):
    """Postings by the analyzer's word breaks: apostrophes, points and commas inside words and numbers stay."""
    return ix.postings(documents_corpus(spark, sf_dir), pattern=word_break_pattern())


def q_rank_stop_words(spark, sf_dir):
    """Ranked search over an index without stop words: ``the`` finds nothing."""
    index = ix.build_index(documents_corpus(spark, sf_dir), stop_words=ENGLISH_STOP_WORDS)
    r = rk.rank(index, doc_queries(spark), mode=rk.MODE_TFIDF)
    return r.select("query_id", "rank", "doc_id", "url", "score")


def _stored(spark, sf_dir):
    """The index of ``documents``, written and read back."""
    out = f"{checkpoint_dir(spark).rstrip('/')}/stored-index-{uuid.uuid4().hex[:12]}"
    write_index(_index(spark, sf_dir), out)
    return read_index(spark, out)


def q_stored_rank_tfidf(spark, sf_dir):
    r = rk.rank(_stored(spark, sf_dir), doc_queries(spark), mode=rk.MODE_TFIDF)
    return r.select("query_id", "rank", "doc_id", "url", "score")


def q_stored_postings_lookup(spark, sf_dir):
    return ix.postings_lookup(_stored(spark, sf_dir).postings, LOOKUP_TERM)


def q_index_upsert(spark, sf_dir):
    """The stored index of the pages, then an upsert: every document under its own
    path, and a changed text of the English pages under theirs."""
    pages = read_table(spark, sf_dir, "pages").select(F.col("url").alias("path"), F.col("html").alias("text"))
    out = f"{checkpoint_dir(spark).rstrip('/')}/upserted-index-{uuid.uuid4().hex[:12]}"
    write_index(ix.build_index(spread(dense_ids(pages, ["path"]), "doc_id")), out)
    docs = read_table(spark, sf_dir, "documents").select(F.concat("source", F.lit("/"), F.col("doc_id").cast("string")).alias("path"), "text")
    changed = pages.where(F.contains("path", F.lit("/en/"))).select("path", F.replace("text", F.lit("the"), F.lit("thee")).alias("text"))
    upsert_index(spark, out, docs.unionByName(changed))
    index = read_index(spark, out)
    return index.docs.join(index.doc_norms, "doc_id", "left").select(
        "path", F.round("tf_norm", 6).alias("tf_norm"), F.round("tfidf_norm", 6).alias("tfidf_norm"))


def q_dense_doc_ids(spark, sf_dir):
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url")
    return dense_ids(pages, ["url", "page_id"]).select("doc_id", "page_id", "url")


def q_doc_id_audit(spark, sf_dir):
    return ix.doc_id_audit(read_table(spark, sf_dir, "documents").select("doc_id"))


def q_term_idf(spark, sf_dir):
    return _index(spark, sf_dir).term_stats.select("term", "df", F.round("idf", 9).alias("idf"))


def q_tf_norms(spark, sf_dir):
    post = ix.postings(documents_corpus(spark, sf_dir))
    return ix.tf_norms(post).select("doc_id", F.round("tf_norm", 9).alias("tf_norm"))


def q_tfidf_norms(spark, sf_dir):
    return _index(spark, sf_dir).doc_norms.select("doc_id", F.round("tfidf_norm", 9).alias("tfidf_norm"))


def q_lowest_idf_terms(spark, sf_dir):
    return ix.lowest_idf_terms(_index(spark, sf_dir).term_stats)


def q_weighted_postings(spark, sf_dir):
    i = _index(spark, sf_dir)
    return ix.weighted_postings(i.postings, i.term_stats).select(
        "doc_id", "term", "tf", F.round("idf", 9).alias("idf"))


def q_query_terms(spark, sf_dir):
    # the batch words that the corpus vocabulary knows, with their df
    i = _index(spark, sf_dir)
    qt = rk.query_terms(doc_queries(spark))
    return qt.join(rk.known_words(i, qt), "word", "left").select(
        "query_id", "pos", "word", F.coalesce("df", F.lit(0)).alias("df"))


def q_unranked_search(spark, sf_dir):
    return rk.unranked_search(_index(spark, sf_dir), doc_queries(spark))


def _ranked(spark, sf_dir, mode, normalize="query"):
    r = rk.rank(_index(spark, sf_dir), doc_queries(spark), mode=mode, normalize=normalize)
    return r.select("query_id", "rank", "doc_id", "url", "score")


def q_rank_tf(spark, sf_dir):
    return _ranked(spark, sf_dir, rk.MODE_TF)


def q_rank_tfidf(spark, sf_dir):
    return _ranked(spark, sf_dir, rk.MODE_TFIDF)


def q_rank_session_scaled(spark, sf_dir):
    return _ranked(spark, sf_dir, rk.MODE_TFIDF, normalize="session")


def q_missing_keywords(spark, sf_dir):
    return rk.missing_keywords(_index(spark, sf_dir), doc_queries(spark))


def q_score_range(spark, sf_dir):
    s = rk.cosine_scores(_index(spark, sf_dir), doc_queries(spark), rk.MODE_TFIDF)
    return rk.score_range(s).select("query_id", F.round("max_score", 9).alias("max_score"),
                                    F.round("min_score", 9).alias("min_score"))


QUERIES = {
    "corpus_size": q_corpus_size,
    "postings": q_postings,
    "vocabulary": q_vocabulary,
    "vocabulary_slice": q_vocabulary_slice,
    "vocabulary_slice_near": q_vocabulary_slice_near,
    "decoded_paths": q_decoded_paths,
    "postings_stop_words": q_postings_stop_words,
    "postings_word_breaks": q_postings_word_breaks,
    "rank_stop_words": q_rank_stop_words,
    "stored_rank_tfidf": q_stored_rank_tfidf,
    "stored_postings_lookup": q_stored_postings_lookup,
    "document_frequency": q_document_frequency,
    "postings_lookup": q_postings_lookup,
    "document_lookup": q_document_lookup,
    "index_upsert": q_index_upsert,
    "dense_doc_ids": q_dense_doc_ids,
    "doc_id_audit": q_doc_id_audit,
    "term_idf": q_term_idf,
    "tf_norms": q_tf_norms,
    "tfidf_norms": q_tfidf_norms,
    "lowest_idf_terms": q_lowest_idf_terms,
    "weighted_postings": q_weighted_postings,
    "query_terms": q_query_terms,
    "unranked_search": q_unranked_search,
    "rank_tf": q_rank_tf,
    "rank_tfidf": q_rank_tfidf,
    "missing_keywords": q_missing_keywords,
    "score_range": q_score_range,
    "rank_session_scaled": q_rank_session_scaled,
}

# ---------------------------------------------------------------- oracles --

_TOKEN = r"[\p{L}\p{N}]+"
# The word breaks again for SQL, whose patterns have no class intersection: the given texts hold no ideographs.
_WORDS = (r"(?:_*(?:\p{L}[\p{L}\p{M}]*(?:[:.''·‘’․‧]\p{L}[\p{L}\p{M}]*)*"
          r"|\p{N}[\p{N}\p{M}]*(?:[.,;''‘’․⁄]\p{N}[\p{N}\p{M}]*)*))+_*")


def queries_values(queries: list[str]) -> str:
    rows = ", ".join(f"({i}, '{q}')" for i, q in enumerate(queries))
    return f"SELECT * FROM (VALUES {rows}) AS q(query_id, query)"


def corpus_sql(docs_select: str, queries: list[str], stop_words: list[str] = ()) -> str:
    """CTE chain: docs, toks, postings, n, term_stats, norms, queries, qwords, qt."""
    stop = "WHERE term NOT IN (" + ", ".join(f"'{w}'" for w in stop_words) + ")" if stop_words else ""
    return f"""
WITH docs AS ({docs_select}),
toks AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '{_TOKEN}')) AS term FROM docs),
postings AS (SELECT doc_id, term, count(*) AS tf FROM toks {stop} GROUP BY doc_id, term),
n AS (SELECT count(*) AS n FROM docs),
term_stats AS (SELECT term, count(*) AS df,
               ln((SELECT n FROM n)::DOUBLE / count(*)::DOUBLE) AS idf FROM postings GROUP BY term),
norms AS (SELECT p.doc_id, sqrt(sum((p.tf * p.tf)::DOUBLE)) AS tf_norm,
                 sqrt(sum(pow(p.tf * s.idf, 2))) AS tfidf_norm
          FROM postings p JOIN term_stats s USING (term) GROUP BY p.doc_id),
queries AS ({queries_values(queries)}),
qwords AS (SELECT query_id,
                  CASE WHEN query = '' THEN ['']
                       WHEN regexp_replace(query, '\\s+$', '') = '' THEN []::VARCHAR[]
                       ELSE string_split_regex(regexp_replace(query, '\\s+$', ''), '\\s+') END AS words
           FROM queries),
qt AS (SELECT query_id, unnest(words) AS word, generate_subscripts(words, 1) - 1 AS pos FROM qwords)
"""


BASE = corpus_sql("SELECT doc_id, source AS path, text FROM documents", DOC_QUERIES)
STOPPED = corpus_sql("SELECT doc_id, source AS path, text FROM documents", DOC_QUERIES, ENGLISH_STOP_WORDS)



def cosine_sql(mode: str) -> str:
    if mode == "tf":
        w, norm = "p.tf::DOUBLE", "nm.tf_norm"
    else:
        w, norm = "p.tf * s.idf", "nm.tfidf_norm"
    return f""",
contrib AS (SELECT qt.query_id, qt.pos, p.doc_id,
                   CASE WHEN {norm} = 0 THEN 'NaN'::DOUBLE ELSE {w} / {norm} END AS c
            FROM qt JOIN term_stats s ON qt.word = s.term
                    JOIN postings p ON p.term = s.term
                    JOIN norms nm ON nm.doc_id = p.doc_id),
scores AS (SELECT query_id, doc_id, list_reduce(list(c ORDER BY pos), lambda a, b: a + b) AS cosine,
                  min(pos) AS first_pos FROM contrib GROUP BY query_id, doc_id)
"""


_RANGE_Q = """,
ranges AS (SELECT query_id,
                  greatest(0.0, coalesce(max(CASE WHEN NOT isnan(cosine) THEN cosine END), 0.0)) AS max_score,
                  coalesce(min(CASE WHEN NOT isnan(cosine) THEN cosine END), 1.7976931348623157e308) AS min_score
           FROM scores GROUP BY query_id)
"""

_RANGE_SESSION = """,
per_q AS (SELECT query_id, max(CASE WHEN NOT isnan(cosine) THEN cosine END) AS q_max,
                 min(CASE WHEN NOT isnan(cosine) THEN cosine END) AS q_min FROM scores GROUP BY query_id),
ranges AS (SELECT query_id,
                  greatest(0.0, coalesce(max(q_max) OVER (ORDER BY query_id ROWS UNBOUNDED PRECEDING), 0.0)) AS max_score,
                  coalesce(min(q_min) OVER (ORDER BY query_id ROWS UNBOUNDED PRECEDING), 1.7976931348623157e308) AS min_score
           FROM per_q)
"""


def _ranked_sql(mode: str, session: bool = False, base: str = "") -> str:
    return (base or BASE) + cosine_sql(mode) + (_RANGE_SESSION if session else _RANGE_Q) + """,
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id
                   ORDER BY round(cosine, 12) DESC, first_pos, doc_id) AS rank FROM scores)
SELECT r.query_id, r.rank, r.doc_id, replace(d.path, '%%', '/') AS url,
       round(CASE WHEN g.max_score = g.min_score THEN 0.5
                  WHEN isnan((r.cosine - g.min_score) / (g.max_score - g.min_score)) THEN 0.0
                  ELSE (r.cosine - g.min_score) / (g.max_score - g.min_score) END, 5) AS score
FROM ranked r JOIN ranges g USING (query_id) LEFT JOIN docs d ON d.doc_id = r.doc_id
WHERE r.rank <= 10
"""


PAGE_POSTINGS = f"""
WITH pdocs AS (SELECT page_id AS doc_id, url AS path, html AS text FROM pages),
ptoks AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '{_TOKEN}')) AS term FROM pdocs),
ppostings AS (SELECT doc_id, term, count(*) AS tf FROM ptoks GROUP BY doc_id, term)
"""

ORACLE = {
    "corpus_size": "SELECT count(*) AS n_docs FROM documents",
    "postings": BASE + "SELECT doc_id, term, tf FROM postings",
    "vocabulary": BASE + "SELECT DISTINCT term FROM postings",
    "vocabulary_slice": BASE + """SELECT 100001 + row_number() OVER (ORDER BY term) - 1 AS ordinal, term
        FROM (SELECT DISTINCT term FROM postings ORDER BY term LIMIT 10 OFFSET 100001)""",
    "vocabulary_slice_near": BASE + f"""SELECT {NEAR_SLICE_OFFSET} + row_number() OVER (ORDER BY term) - 1 AS ordinal, term
        FROM (SELECT DISTINCT term FROM postings ORDER BY term LIMIT 10 OFFSET {NEAR_SLICE_OFFSET})""",
    "decoded_paths": "SELECT page_id, replace(url, '/', '%%') AS path, replace(replace(url, '/', '%%'), '%%', '/') AS url FROM pages",
    "postings_stop_words": STOPPED + "SELECT doc_id, term, tf FROM postings",
    "rank_stop_words": _ranked_sql("tfidf", base=STOPPED),
    "stored_rank_tfidf": _ranked_sql("tfidf"),
    "stored_postings_lookup": BASE + f"SELECT doc_id, tf FROM postings WHERE term = '{LOOKUP_TERM}'",
    "document_frequency": BASE + "SELECT term, count(*) AS df FROM postings GROUP BY term",
    "postings_lookup": BASE + f"SELECT doc_id, tf FROM postings WHERE term = '{LOOKUP_TERM}'",
    "document_lookup": PAGE_POSTINGS + f"""SELECT p.doc_id, replace(d.path, '%%', '/') AS url
        FROM ppostings p JOIN pdocs d USING (doc_id) WHERE p.term = '{LOOKUP_TERM}'""",
    "dense_doc_ids": "SELECT row_number() OVER (ORDER BY url, page_id) - 1 AS doc_id, page_id, url FROM pages",
    "doc_id_audit": """SELECT count(*) AS n_docs,
        count(*) - count(DISTINCT CASE WHEN doc_id >= 0 AND doc_id < (SELECT count(*) FROM documents)
                                       THEN doc_id END) AS missing_ids,
        count(*) = count(DISTINCT CASE WHEN doc_id >= 0 AND doc_id < (SELECT count(*) FROM documents)
                                       THEN doc_id END) AS complete
        FROM documents""",
    "postings_word_breaks": f"""SELECT doc_id, term, count(*) AS tf FROM (
        SELECT doc_id, unnest(regexp_extract_all(lower(text), '{_WORDS}')) AS term FROM documents) GROUP BY doc_id, term""",
    "index_upsert": f"""
WITH docs AS (SELECT url AS path, CASE WHEN contains(url, '/en/') THEN replace(html, 'the', 'thee') ELSE html END AS text FROM pages
              UNION ALL SELECT source || '/' || CAST(doc_id AS VARCHAR), text FROM documents),
toks AS (SELECT path, unnest(regexp_extract_all(lower(text), '{_TOKEN}')) AS term FROM docs),
postings AS (SELECT path, term, count(*) AS tf FROM toks GROUP BY path, term),
stats AS (SELECT term, ln((SELECT count(*) FROM docs) / count(*)) AS idf FROM postings GROUP BY term),
norms AS (SELECT path, sqrt(sum(tf * tf)) AS tf_norm, sqrt(sum(pow(tf * idf, 2))) AS tfidf_norm FROM postings JOIN stats USING (term) GROUP BY path)
SELECT path, round(tf_norm, 6) AS tf_norm, round(tfidf_norm, 6) AS tfidf_norm FROM docs LEFT JOIN norms USING (path)""",
    "term_idf": BASE + "SELECT term, df, round(idf, 9) AS idf FROM term_stats",
    "tf_norms": BASE + "SELECT doc_id, round(tf_norm, 9) AS tf_norm FROM norms",
    "tfidf_norms": BASE + "SELECT doc_id, round(tfidf_norm, 9) AS tfidf_norm FROM norms",
    "lowest_idf_terms": BASE + """SELECT term, round(idf, 6) AS idf FROM term_stats WHERE idf >= 0
        ORDER BY idf, term LIMIT 5""",
    "weighted_postings": BASE + """SELECT p.doc_id, p.term, p.tf, round(s.idf, 9) AS idf
        FROM postings p JOIN term_stats s USING (term)""",
    "query_terms": BASE + """SELECT qt.query_id, qt.pos, qt.word, coalesce(s.df, 0) AS df
        FROM qt LEFT JOIN term_stats s ON qt.word = s.term""",
    "unranked_search": BASE + """SELECT qt.query_id, qt.pos, qt.word, p.doc_id, replace(d.path, '%%', '/') AS url
        FROM qt JOIN postings p ON qt.word = p.term JOIN docs d ON d.doc_id = p.doc_id""",
    "rank_tf": _ranked_sql("tf"),
    "rank_tfidf": _ranked_sql("tfidf"),
    "rank_session_scaled": _ranked_sql("tfidf", session=True),
    "missing_keywords": BASE + """SELECT qt.query_id, qt.pos, qt.word FROM qt
        WHERE NOT EXISTS (SELECT 1 FROM term_stats s WHERE s.term = qt.word)""",
    "score_range": BASE + cosine_sql("tfidf") + _RANGE_Q + """SELECT query_id, round(max_score, 9) AS max_score,
        round(min_score, 9) AS min_score FROM ranges""",
}
