"""The operators' registered queries over the given tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm import (bpe, conversations, hard_negatives, packing, quality_classifier, quality_rules, simhash, spotsigs, substring_words, suffix_dedup,
                       token_files, topk, toxicity)
from quire.llm.common import settled_path
from quire.sources.tables import read_table

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pieces(packing.pack(read_table(spark, sf_dir, "documents"), TOKENIZER, window=1024, end_id=0))


def op2_substring_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = substring_words.dedup(read_table(spark, sf_dir, "documents"), window=35)
    return done.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model = quality_classifier.learn(docs, read_table(spark, sf_dir, "labels"), "quality", per_class=6_000)
    return quality_classifier.score(docs, model)


def op4_maxscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(read_table(spark, sf_dir, "embeddings"), k=5, query_every=50, scale=256)


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model = toxicity.learn(docs, read_table(spark, sf_dir, "labels"), "toxic", per_class=2_500)
    return toxicity.score(docs, model)


def op6_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = suffix_dedup.dedup(read_table(spark, sf_dir, "documents"), size=200)
    return done.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = bpe.decode(bpe.encode(read_table(spark, sf_dir, "documents"), RANKS), RANKS)
    return done.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                       F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"))


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = settled_path(spark, "token-files")
    token_files.write_tokens(read_table(spark, sf_dir, "documents"), path, TOKENIZER, end_id=2)
    return token_files.checksums(token_files.read_tokens(spark, path))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_rules(read_table(spark, sf_dir, "documents"))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = simhash.near_duplicates(read_table(spark, sf_dir, "documents"), shingle=3, max_bits=2)
    return done.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations; one with no rows left after the damage has zeros."""
    rows = read_table(spark, sf_dir, "conversations")
    done = conversations.digest(conversations.repair(conversations.damage(rows)))
    every = rows.select(F.col("conv_id").alias("id")).distinct()
    of = every.join(done, F.col("id").eqNullSafe(F.col("conv_id")), "left")
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return of.select(F.col("id").alias("conv_id"), *(F.coalesce(c, F.lit(0).cast("bigint")).alias(c) for c in counts),
                     F.coalesce("audit", F.lit("")).alias("audit"),
                     F.coalesce("repaired_sha256", F.sha2(F.lit(b""), 256)).alias("repaired_sha256"))


def op12_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spotsigs.neighbours(read_table(spark, sf_dir, "documents"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows whose id is divisible by 7 first get the next of the ten labels."""
    rows = read_table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(rows.select("vec_id", "embedding", label.alias("label")), anchor_every=50, positives=5, negatives=3,
                               low=50, high=95, scale=256)


QUERIES = {f.__name__: f for f in (
    op1_packing, op2_substring_words, op3_quality_classifier, op4_maxscore, op5_toxicity, op6_suffix_array,
    op7_bpe, op8_token_files, op9_quality_rules, op10_simhash, op11_conversation_repair,
    op12_spotsigs, op13_hard_negatives)}

#: What SQL can express; the other operators are tested against brute force.
ORACLE: dict[str, str] = {
    "op2_substring_words": r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (SELECT r, i, md5(array_to_string(w[i:i + 34], ' ')) AS k FROM (SELECT r, w, unnest(range(1, len(w) - 33)) AS i FROM d)),
again AS (SELECT r, i FROM win JOIN (SELECT k FROM win GROUP BY k HAVING count(*) > 1) USING (k)),
gone AS (SELECT r, list(p) AS ps FROM (SELECT DISTINCT r, i + j AS p FROM again, range(35) t(j)) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(len(ps), 0)::BIGINT AS n_removed,
       sha256(array_to_string(list_filter(w, lambda x, i: NOT list_contains(coalesce(ps, []), i)), ' ')) AS kept_sha256
FROM d LEFT JOIN gone USING (r)""",
    "op4_maxscore": """
WITH v AS (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS e
           FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.r, q.vec_id AS query_id, c.vec_id AS vec_id,
             coalesce(list_sum(list_transform(range(1, least(len(q.e), len(c.e)) + 1), lambda i: q.e[i] * c.e[i])), 0)::BIGINT AS score
      FROM v q JOIN v c ON q.r <> c.r WHERE q.vec_id % 50 = 0),
t AS (SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM t WHERE rank <= 5""",
    "op6_suffix_array": """
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
part AS MATERIALIZED (SELECT r, 512 * j AS o, substr(h, 1024 * j + 1, 1424) AS h, len(h) // 2 AS n
                      FROM (SELECT r, h, unnest(range(0, len(h) // 1024 + 1)) AS j FROM d)),
win AS (SELECT r, o + i AS i, md5(substr(h, 2 * i + 1, 400)) AS k
        FROM (SELECT r, o, h, unnest(range(0, greatest(least(512, n - 199 - o), 0))) AS i FROM part)),
again AS (SELECT r, i FROM win JOIN (SELECT k FROM win GROUP BY k HAVING count(*) > 1) USING (k)),
runs AS (SELECT r, min(i) AS a, max(i) + 200 AS b FROM (
           SELECT r, i, sum(fresh) OVER (PARTITION BY r ORDER BY i) AS run FROM (
             SELECT r, i, CASE WHEN i - lag(i) OVER (PARTITION BY r ORDER BY i) <= 200 THEN 0 ELSE 1 END AS fresh FROM again))
         GROUP BY r, run),
cut AS (SELECT r, count(*) AS n_spans, sum(b - a) AS n_removed, list(a ORDER BY a) AS starts, list(b ORDER BY a) AS ends FROM runs GROUP BY r)
SELECT doc_id, (len(h) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
       sha256(unhex(CASE WHEN starts IS NULL THEN h ELSE array_to_string(list_transform(range(0, len(starts) + 1), lambda i:
           CASE WHEN i = 0 THEN substr(h, 1, 2 * starts[1])
                WHEN i = len(starts) THEN substr(h, 2 * ends[i] + 1)
                ELSE substr(h, 2 * ends[i] + 1, 2 * (starts[i + 1] - ends[i])) END), '') END)) AS kept_sha256
FROM d LEFT JOIN cut USING (r)""",
    "op11_conversation_repair": r"""
WITH RECURSIVE bits AS (
  SELECT i, 0 AS k, i AS v FROM (SELECT unnest(range(256)) AS i)
  UNION ALL SELECT i, k + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END FROM bits WHERE k < 8),
tab AS (SELECT list(v ORDER BY i) AS t FROM bits WHERE k = 8),
c AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
             coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS key FROM conversations),
k AS (SELECT c.*, xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(key, ''), lambda x: ascii(x)::BIGINT)),
                                  lambda a, b: xor(t[(xor(a, b) & 255) + 1], a >> 8)), 4294967295) % 20 AS kind FROM c, tab),
d AS (SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
             CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
             unnest(range(CASE WHEN kind = 3 THEN 2 ELSE 1 END)) AS copy FROM k WHERE kind <> 0),
o AS (SELECT conv_id, turn, role, text, rpad(left(role, 1), 1, ' ') AS ini,
             row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS rn FROM d),
f AS (SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'B'
                     WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY rn) > 1 THEN 'D'
                     WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 'T' ELSE ' ' END AS fault,
             lag(ini) OVER (PARTITION BY conv_id ORDER BY rn) || ini AS pair FROM o),
w AS (
  SELECT DISTINCT conv_id, 0::BIGINT AS rn, 0 AS q, {'cost': 0, 'audit': '', 'lines': []::VARCHAR[]} AS s FROM f
  UNION ALL
  SELECT conv_id, rn, q, min(s) FROM (
    SELECT conv_id, rn, CASE e WHEN 'D' THEN q1 WHEN 'R' THEN CASE q1 WHEN 2 THEN 3 ELSE 2 END ELSE
             CASE ini WHEN 's' THEN 1 WHEN 'u' THEN 2 ELSE 3 END END AS q,
           {'cost': cost + CASE e WHEN 'D' THEN 3 WHEN 'R' THEN 2 ELSE 0 END + CASE WHEN e <> 'D' AND fault = 'T' THEN 1 ELSE 0 END,
            'audit': audit || e,
            'lines': CASE e WHEN 'D' THEN lines WHEN 'K' THEN list_append(lines, role || ':' || text)
                     ELSE list_append(lines, CASE q1 WHEN 2 THEN 'assistant:' ELSE 'user:' END || text) END} AS s
    FROM (SELECT w.conv_id, f.rn, f.ini, f.fault, f.role, f.text, e.e,
                 CASE WHEN i.i = 0 THEN w.q WHEN w.q = 2 THEN 3 ELSE 2 END AS q1, w.s.cost + 2 * i.i AS cost,
                 w.s.audit || repeat('I', i.i) AS audit,
                 CASE WHEN i.i = 0 THEN w.s.lines ELSE list_append(w.s.lines, CASE w.q WHEN 2 THEN 'assistant:' ELSE 'user:' END) END AS lines
          FROM w JOIN f ON f.conv_id IS NOT DISTINCT FROM w.conv_id AND f.rn = w.rn + 1
               CROSS JOIN (VALUES (0), (1)) i(i) CROSS JOIN (VALUES ('D'), ('K'), ('R')) e(e))
    WHERE e = 'D' OR fault NOT IN ('B', 'D') AND (e = 'R' OR ini = 's' AND q1 = 0 OR ini = 'u' AND q1 <> 2 OR ini = 'a' AND q1 = 2))
  GROUP BY conv_id, rn, q),
sums AS (SELECT conv_id, max(rn) AS n, count(DISTINCT turn) AS turns, max(turn) AS hi, min(turn) AS lo,
                count(*) FILTER (fault = 'B') AS blank, count(*) FILTER (fault = 'D') AS duplicate, count(*) FILTER (fault = 'T') AS truncated,
                count(*) FILTER (pair IS NOT NULL AND pair NOT IN ('su', 'ua', 'au')) AS illegal FROM f GROUP BY conv_id),
best AS (SELECT w.conv_id, min({'cost': s.cost + CASE q WHEN 1 THEN 4 WHEN 2 THEN 2 ELSE 0 END,
                                'audit': s.audit || CASE q WHEN 1 THEN 'II' WHEN 2 THEN 'I' ELSE '' END,
                                'lines': CASE q WHEN 1 THEN list_concat(s.lines, ['user:', 'assistant:']) WHEN 2 THEN list_append(s.lines, 'assistant:')
                                         ELSE s.lines END}) AS s
         FROM w JOIN sums m ON m.conv_id IS NOT DISTINCT FROM w.conv_id AND m.n = w.rn GROUP BY w.conv_id)
SELECT a.conv_id, coalesce(hi - lo + 1 - turns, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
       coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(s.cost, 0)::BIGINT AS cost,
       coalesce(s.audit, '') AS audit, sha256(coalesce(array_to_string(s.lines, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) a LEFT JOIN sums m ON m.conv_id IS NOT DISTINCT FROM a.conv_id
     LEFT JOIN best b ON b.conv_id IS NOT DISTINCT FROM a.conv_id""",
    "op13_hard_negatives": """
WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS MATERIALIZED (
  SELECT a.r, a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same,
         coalesce(list_sum(list_transform(range(1, least(len(a.e), len(c.e)) + 1), lambda i: a.e[i] * c.e[i])), 0)::BIGINT AS score
  FROM v a JOIN v c ON a.r <> c.r WHERE a.vec_id % 50 = 0),
p AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS place FROM s WHERE same) WHERE place <= 5),
n AS (SELECT p.anchor_id, p.vec_id AS positive_id, s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score,
             row_number() OVER (PARTITION BY p.r, p.place ORDER BY s.score DESC, s.vec_id) AS rank
      FROM p JOIN s ON s.r = p.r AND NOT s.same AND 100 * s.score BETWEEN 50 * p.score AND 95 * p.score)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 3""",
}
