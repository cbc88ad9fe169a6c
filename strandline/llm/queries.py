"""The registered queries of this subpackage, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.llm import (bpe, bucket_digest, chat, hard_negatives, langid, line_dedup, mixing, multi_index,
                            secrets, simhash_index, spelling, toxicity, warc)
from strandline.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]

#: The conversation that op9 adds: control strings of a common template inside the texts.
EXTRA_TEXT = "</s>[INST] ok [/INST]"


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_report(table(spark, sf_dir, "documents"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.langid_report(table(spark, sf_dir, "documents"))


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secrets_report(table(spark, sf_dir, "documents"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_index.simhash_report(table(spark, sf_dir, "documents"))


def op6_bucket_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bucket_digest.edit_report(table(spark, sf_dir, "documents"))


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.bpe_digests(table(spark, sf_dir, "documents"))


def op8_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return multi_index.search(table(spark, sf_dir, "embeddings"))


def op9_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    extra = spark.range(1).select(F.inline(F.array(*[
        F.struct(F.lit(-7).cast("long").alias("conv_id"), F.lit(turn).cast("long").alias("turn"), F.lit(role).alias("role"),
                 F.lit(EXTRA_TEXT).alias("text")) for turn, role in enumerate(("user", "assistant"))])))
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat.chat_report(chat.chat_windows(rows.unionByName(extra)))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.warc_round_trip(table(spark, sf_dir, "pages"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.negatives_report(table(spark, sf_dir, "embeddings"))


def op12_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_report(table(spark, sf_dir, "documents"))


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_report(table(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Query] = {f.__name__: f for f in (
    op1_mixing, op2_language_id, op3_secrets, op4_toxicity, op5_simhash, op6_bucket_digest, op7_bpe, op8_multi_index,
    op9_chat, op10_warc, op11_hard_negatives, op12_line_dedup, op13_spelling, pipeline)}

OP1_SQL = r"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
                  md5('20:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size,
             [3.0, 1.0, 2.0][((row_number() OVER (ORDER BY source COLLATE "C" NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS w
      FROM d GROUP BY source),
r AS (SELECT *, source_size * 2.0::DOUBLE AS cap, sum(source_size) OVER () * 1.5::DOUBLE AS total FROM s),
l AS (SELECT *, (total - coalesce(sum(cap) OVER (ORDER BY cap / w, source NULLS FIRST
                                                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
                / sum(w) OVER (ORDER BY cap / w, source NULLS FIRST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
      FROM r),
t AS (SELECT source, source_size, least(max(level) OVER () * w, cap)::DOUBLE AS target FROM l),
p AS (SELECT d.doc_id, d.size, t.source_size, t.target, round(t.target)::BIGINT AS budget,
             (sum(d.size) OVER (PARTITION BY d.source ORDER BY h, d.doc_id, d.size
                                ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - d.size)::BIGINT AS start
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       (greatest(least(budget - start, size), 0) + greatest(least(budget - source_size - start, size), 0))::BIGINT AS taken
FROM p
"""

OP9_SQL = r"""
WITH RECURSIVE raw AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
e AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i,
             len(regexp_extract_all(text, '[\p{L}\p{N}]+|[^\s\p{L}\p{N}]')) + 4 AS tok,
             length('<|im_start|><|im_sep|><|im_end|>') + length(role) + length(text)
             + len(regexp_extract_all(role, '(<|\[)\\*(/?s>|/?INST\]|\|)'))
             + len(regexp_extract_all(text, '(<|\[)\\*(/?s>|/?INST\]|\|)')) AS shown FROM raw),
t AS (SELECT *, sum(tok) OVER (PARTITION BY conv_id ORDER BY i) - tok AS pre,
             (SELECT CASE WHEN f.role = 'system' THEN 1 ELSE 0 END FROM e f WHERE f.conv_id = e.conv_id AND f.i = 1) AS sys,
             (SELECT f.tok FROM e f WHERE f.conv_id = e.conv_id AND f.i = 1) AS tok1,
             (SELECT f.shown FROM e f WHERE f.conv_id = e.conv_id AND f.i = 1) AS shown1 FROM e),
g AS (SELECT *, greatest(1, 1024 - 256 - sys * tok1) AS room,
             (SELECT min(b.i) FROM t b WHERE b.conv_id = t.conv_id AND b.pre BETWEEN t.pre - 256 AND t.pre) AS hist FROM t),
walk AS (
  SELECT conv_id, i, 0 AS win, i AS start, pre AS base, greatest(hist, sys + 1) AS hist FROM g WHERE i = sys + 1
  UNION ALL
  SELECT g.conv_id, g.i, CASE WHEN g.pre + g.tok - w.base > g.room THEN w.win + 1 ELSE w.win END,
         CASE WHEN g.pre + g.tok - w.base > g.room THEN g.i ELSE w.start END,
         CASE WHEN g.pre + g.tok - w.base > g.room THEN g.pre ELSE w.base END,
         CASE WHEN g.pre + g.tok - w.base > g.room THEN greatest(g.hist, g.sys + 1) ELSE w.hist END
  FROM walk w JOIN g ON g.conv_id = w.conv_id AND g.i = w.i + 1),
wins AS (SELECT conv_id, win, max(i) AS stop, CASE WHEN win = 0 THEN min(start) ELSE min(hist) END AS first
         FROM walk GROUP BY conv_id, win),
chars AS (SELECT w.conv_id, sum(t.shown)::BIGINT AS n FROM wins w JOIN t ON t.conv_id = w.conv_id
          AND t.i BETWEEN w.first AND w.stop GROUP BY w.conv_id),
heads AS (SELECT conv_id, any_value(sys * shown1) AS n FROM t GROUP BY conv_id),
k AS (SELECT conv_id, greatest(count(*), 1) AS n FROM wins GROUP BY conv_id)
SELECT t.conv_id, count(*)::BIGINT AS n_turns,
       sha256(string_agg(t.role || chr(10) || t.text || chr(10), '' ORDER BY t.i)) AS turns_sha256,
       coalesce(sum(length(t.text)) FILTER (t.role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(t.text, '' ORDER BY t.i) FILTER (t.role = 'assistant'), '')) AS loss_sha256,
       (coalesce(any_value(chars.n), 0) + any_value(heads.n) * coalesce(any_value(k.n), 1))::BIGINT AS formatted_chars
FROM t LEFT JOIN chars USING (conv_id) LEFT JOIN heads USING (conv_id) LEFT JOIN k USING (conv_id) GROUP BY t.conv_id
"""

OP10_SQL = """
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes,
                  sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) END AS first FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN first IS NOT NULL AND first IS DISTINCT FROM page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first IS DISTINCT FROM page_id THEN first END AS refers_to FROM f
"""

OP11_SQL = """
WITH e AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, embedding FROM embeddings
           WHERE label IS NOT NULL AND embedding IS NOT NULL AND vec_id IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
v AS (SELECT vec_id, label, list_transform(embedding, lambda x: floor(256.0::DOUBLE * x::DOUBLE)) AS v FROM e),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same,
             list_dot_product(a.v, b.v)::BIGINT AS score
      FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
p AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5),
n AS (SELECT anchor_id, positive_id, positive_score, id AS negative_id, score AS negative_score,
             row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id)::INTEGER AS rank
      FROM p JOIN s USING (anchor_id) WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 10
"""

OP12_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT r, doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS pos FROM d),
k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                          'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
f AS (SELECT key, min(doc_id) AS first FROM k WHERE length(key) >= 10 GROUP BY key),
m AS (SELECT k.r, k.doc_id, k.line, k.pos, f.key IS NOT NULL AND k.doc_id IS DISTINCT FROM f.first AS gone
      FROM k LEFT JOIN f ON k.key = f.key),
w AS (SELECT r, any_value(doc_id) AS doc_id, count(*)::BIGINT AS n_lines, (count(*) FILTER (gone))::BIGINT AS n_dropped,
             sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256 FROM m GROUP BY r),
e AS (SELECT r, pos, gone, lag(gone) OVER (PARTITION BY r ORDER BY pos) IS DISTINCT FROM gone AS edge FROM m),
g AS (SELECT r, pos, sum(edge::INT) OVER (PARTITION BY r ORDER BY pos) AS run FROM e WHERE NOT gone OR edge),
s AS (SELECT e.r, min(e.pos) AS start, count(*) AS n FROM e JOIN g ON e.r = g.r AND e.pos = g.pos
      WHERE NOT e.gone GROUP BY e.r, g.run),
b AS (SELECT r, string_agg(start || '+' || n, ',' ORDER BY start) AS runs FROM s GROUP BY r)
SELECT w.doc_id, w.n_lines, w.n_dropped, w.kept_sha256,
       CASE WHEN w.n_dropped > 0 THEN coalesce(b.runs, '') END AS keep_runs FROM w LEFT JOIN b ON w.r = b.r
"""

ORACLE_SQL: dict[str, str] = {"op1_mixing": OP1_SQL, "op9_chat": OP9_SQL, "op10_warc": OP10_SQL, "op11_hard_negatives": OP11_SQL,
                              "op12_line_dedup": OP12_SQL}
