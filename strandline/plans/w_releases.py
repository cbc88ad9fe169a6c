"""Witnesses for releases and the run log."""

from __future__ import annotations

from pyspark.sql import functions as F

from strandline.operators import releases as rel
from strandline.operators import variants as var
from strandline.plans.registry import witness

NAME = ("'clin_qa' || CASE p_size % 3 WHEN 0 THEN 'blue' WHEN 1 THEN 'green' ELSE '' END || '_' || "
        "CASE p_partkey % 4 WHEN 0 THEN 'variant_centric' WHEN 1 THEN 'gene_centric' WHEN 2 THEN 'cnv_centric' "
        "ELSE 'coverage_by_gene' END || '_re_' || lpad(CAST(p_partkey * 7 % 37 AS VARCHAR), 3, '0')")
PAT = rel.NAME_PATTERN
PARSED = (f"nm AS (SELECT DISTINCT {NAME} AS index_name FROM part), "
          f"p AS (SELECT index_name, nullif(regexp_extract(index_name, '{PAT}', 2), '') AS color, "
          f"regexp_extract(index_name, '{PAT}', 3) AS index_type, "
          f"CAST(string_split(index_name, '_')[-1] AS INTEGER) AS rn FROM nm)")
ALIASES = ("a AS (SELECT 'clin_qa_' || index_type AS alias, max(index_name) AS index_name FROM p GROUP BY index_type)")
NEW = ("nw AS (SELECT 'clin_qa_' || index_type AS alias, min(index_name) AS index_name FROM p "
       "WHERE color = 'green' GROUP BY index_type)")
RUNS = ("ev AS (SELECT *, user_id % 20 AS run_id FROM events), "
        "runs AS (SELECT run_id, CASE WHEN run_id % 4 = 0 THEN 'etl_ingest' ELSE 'etl' END AS dag_id, "
        "min(ts) OVER (PARTITION BY run_id) AS start_date, CASE event_type WHEN 'purchase' THEN 'success' "
        "WHEN 'error' THEN 'failed' ELSE 'running' END AS state FROM ev "
        "QUALIFY row_number() OVER (PARTITION BY run_id ORDER BY ts DESC, event_id DESC) = 1), "
        "tasks AS (SELECT run_id, 'task_' || CAST(event_id % 7 AS VARCHAR) AS task_id, CASE event_type WHEN 'error' "
        "THEN 'failed' WHEN 'signup' THEN 'upstream_failed' ELSE 'success' END AS state FROM ev)")


def _names(v):
    return v.part.select(F.expr(NAME.replace("VARCHAR", "STRING")).alias("index_name")).distinct()


def _parsed(v):
    n = _names(v)
    p = rel.parse_index_name(F.col("index_name"))
    return n.select("index_name", p["color"].alias("color"), p["index_type"].alias("index_type"))


def _aliases(v):
    return _parsed(v).groupBy("index_type").agg(
        F.concat(F.lit("clin_qa_"), F.col("index_type")).alias("alias"), F.max("index_name").alias("index_name")
    ).select("alias", "index_name")


def _runs(v):
    ev = v.events.withColumn("run_id", F.col("user_id") % 20)
    last = rel.latest_by(ev, ["run_id"], [F.col("ts"), F.col("event_id")])
    start = ev.groupBy("run_id").agg(F.min("ts").alias("start_date"))
    runs = last.join(start, "run_id").select(
        "run_id", F.when(F.col("run_id") % 4 == 0, "etl_ingest").otherwise("etl").alias("dag_id"), "start_date",
        F.when(F.col("event_type") == "purchase", "success").when(F.col("event_type") == "error", "failed")
        .otherwise("running").alias("state"))
    tasks = ev.select("run_id", F.concat(F.lit("task_"), (F.col("event_id") % 7).cast("string")).alias("task_id"),
                      F.when(F.col("event_type") == "error", "failed").when(F.col("event_type") == "signup",
                                                                            "upstream_failed")
                      .otherwise("success").alias("state"))
    return runs, tasks


@witness("rel_duplicates", f"""
WITH h AS (SELECT sha1(concat_ws('|', chromosome, CAST(start AS VARCHAR), reference, alternate, sequencing_id)) AS hash
           FROM occurrences),
d AS (SELECT hash FROM h GROUP BY hash HAVING count(*) >= 2)
SELECT count(*) > 0 AS has_duplicates, count(*) AS n_duplicated, min(hash) AS first_duplicate FROM d
""")
def _(v):
    docs = v.occurrences.select(var.document_hash([*var.VARIANT_KEY, "sequencing_id"]).alias("hash"))
    return rel.duplicate_documents(docs)


@witness("rel_next", f"""
WITH {PARSED}
SELECT color, index_type, 're_' || lpad(CAST(max(rn) AS VARCHAR), 3, '0') AS current_release,
       're_' || lpad(CAST(max(rn) + 1 AS VARCHAR), 3, '0') AS next_release
FROM p GROUP BY color, index_type
""")
def _(v):
    return rel.next_release(_names(v))


REL = ("r AS (SELECT DISTINCT CASE WHEN p_size % 10 = 0 THEN 'r_' || CAST(p_partkey % 40 AS VARCHAR) "
       "ELSE 're_' || lpad(CAST(p_partkey % 40 AS VARCHAR), 3, '0') END AS release FROM part)")


@witness("rel_previous", f"""
WITH {REL}, c AS (SELECT release, regexp_matches(release, '^re_([0-9]{{3}}|[1-9][0-9]{{3,8}})$') AS ok,
                          TRY_CAST(substr(release, 4) AS INTEGER) - 2 AS num FROM r)
SELECT release, CASE WHEN ok AND num >= 0 THEN 're_' || lpad(CAST(num AS VARCHAR), greatest(3, length(CAST(num AS VARCHAR)))::INTEGER, '0') END AS previous,
       CASE WHEN NOT ok THEN 'invalid' WHEN num < 0 THEN 'none' ELSE 'ok' END AS status
FROM c
""")
def _(v):
    r = v.part.select(F.expr(REL.split(" AS (SELECT DISTINCT ")[1].split(" AS release FROM part)")[0]
                             .replace("VARCHAR", "STRING")).alias("release")).distinct()
    prev, status = rel.previous_release(F.col("release"))
    return r.select("release", prev.alias("previous"), status.alias("status"))


@witness("rel_retention", f"""
WITH {PARSED}, cur AS (SELECT color, index_type, max(rn) AS c FROM p GROUP BY color, index_type)
SELECT DISTINCT p.index_name FROM p JOIN cur ON p.index_type = cur.index_type AND p.color IS NOT DISTINCT FROM cur.color
WHERE p.rn = cur.c - 2
""")
def _(v):
    return rel.retention_plan(_names(v))


@witness("rel_color", f"""
WITH {PARSED}, {ALIASES}
SELECT alias, index_name, CASE WHEN contains(index_name, 'blue') THEN 'blue'
                              WHEN contains(index_name, 'green') THEN 'green' END AS color FROM a
""")
def _(v):
    a = _aliases(v)
    return a.select("alias", "index_name", rel.active_color(F.col("index_name")).alias("color"))


@witness("rel_swap", f"""
WITH {PARSED}, {ALIASES}, {NEW}
SELECT alias, index_name FROM a WHERE alias NOT IN (SELECT alias FROM nw)
UNION ALL SELECT alias, index_name FROM nw
""")
def _(v):
    new = (_parsed(v).where(F.col("color") == "green").groupBy("index_type")
           .agg(F.concat(F.lit("clin_qa_"), F.col("index_type")).alias("alias"), F.min("index_name").alias("index_name"))
           .select("alias", "index_name"))
    return rel.swap_aliases(_aliases(v), new)


@witness("rel_last_failures", f"""
WITH {RUNS},
lr AS (SELECT run_id FROM runs WHERE dag_id = 'etl' AND state IN ('success', 'failed')
       ORDER BY start_date DESC, run_id DESC LIMIT 1)
SELECT DISTINCT run_id, task_id FROM tasks WHERE state IN ('failed', 'upstream_failed') AND run_id IN (SELECT run_id FROM lr)
""")
def _(v):
    runs, tasks = _runs(v)
    return rel.last_run_failures(runs, tasks)


DAGS = ["etl_run_release", "etl", "etl_ingest", "etl_import_franklin", "etl_cnv_frequencies"]


@witness("rel_conflicts", f"""
WITH {RUNS}
SELECT run_id, dag_id FROM runs WHERE dag_id IN ('etl_run_release', 'etl', 'etl_ingest', 'etl_import_franklin',
                                                 'etl_cnv_frequencies') AND state = 'running'
""")
def _(v):
    runs, _ = _runs(v)
    return rel.conflicting_runs(runs, DAGS).select("run_id", "dag_id")
