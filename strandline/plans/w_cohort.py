"""Witnesses for cohort resolution."""

from __future__ import annotations

from pyspark.sql import functions as F

from strandline.operators import cohort
from strandline.plans.registry import witness

TYPE_CASE = ("CASE bioinfo_analysis_code WHEN 'GEBA' THEN 'germline' WHEN 'TEBA' THEN 'somatic_tumor_only' "
             "WHEN 'TNEBA' THEN 'somatic_tumor_normal' END")
LATEST = ("QUALIFY row_number() OVER (PARTITION BY analysis_id ORDER BY sequencing_id DESC, batch_id DESC) = 1")
CHUNKS = ("c AS (SELECT id, CAST(floor((row_number() OVER (ORDER BY id) - 1) / 50) AS BIGINT) AS chunk_no "
          "FROM (SELECT DISTINCT analysis_id AS id FROM clinical))")


@witness("cohort_analysis_ids", """
SELECT DISTINCT analysis_id FROM clinical
WHERE analysis_id IN (SELECT id FROM req_analyses) OR sequencing_id IN (SELECT id FROM req_sequencings)
   OR batch_id IN (SELECT id FROM req_batches)
""")
def _(v):
    return cohort.analysis_ids(v.clinical, v.req_analyses, v.req_sequencings, v.req_batches)


@witness("cohort_batch_ids", """
SELECT DISTINCT batch_id FROM clinical
WHERE bioinfo_analysis_code = 'GEBA'
  AND (analysis_id IN (SELECT id FROM req_analyses) OR sequencing_id IN (SELECT id FROM req_sequencings))
""")
def _(v):
    return cohort.batch_ids(v.clinical, "GEBA", v.req_analyses, v.req_sequencings)


@witness("cohort_latest_batch", """
SELECT analysis_id, arg_max(batch_id, sequencing_id) AS batch_id FROM clinical GROUP BY analysis_id
""")
def _(v):
    return cohort.latest_batch(v.clinical)


@witness("cohort_one_batch", f"""
SELECT analysis_id, sequencing_id, batch_id FROM clinical {LATEST}
""")
def _(v):
    return cohort.one_batch_per_analysis(v.clinical).select("analysis_id", "sequencing_id", "batch_id")


@witness("cohort_group_by_batch", f"""
WITH l AS (SELECT analysis_id, batch_id FROM clinical WHERE analysis_id IN (SELECT id FROM req_analyses) {LATEST})
SELECT batch_id, part, count(*) AS n_ids, string_agg(analysis_id, ',' ORDER BY analysis_id) AS analysis_ids
FROM (SELECT *, CAST(floor((row_number() OVER (PARTITION BY batch_id ORDER BY analysis_id) - 1) / 5) AS BIGINT) AS part FROM l)
GROUP BY batch_id, part
""")
def _(v):
    g = cohort.group_by_batch(v.clinical, v.req_analyses, most=5)
    return g.select("batch_id", "part", F.size("analysis_ids").cast("bigint").alias("n_ids"),
                    F.array_join("analysis_ids", ",").alias("analysis_ids"))


@witness("cohort_analysis_types", f"""
SELECT DISTINCT batch_id AS id, bioinfo_analysis_code, {TYPE_CASE} AS analysis_type FROM clinical
""")
def _(v):
    return cohort.analysis_types(v.clinical, "batch_id")


@witness("cohort_unknown_codes", """
SELECT DISTINCT analysis_id AS id, code AS bioinfo_analysis_code
FROM (SELECT analysis_id, CASE WHEN gender = 'other' AND is_proband THEN 'WGBA' ELSE bioinfo_analysis_code END AS code
      FROM clinical)
WHERE code NOT IN ('GEBA', 'TEBA', 'TNEBA')
""")
def _(v):
    c = v.clinical.withColumn(
        "bioinfo_analysis_code",
        F.when((F.col("gender") == "other") & F.col("is_proband"), "WGBA").otherwise(F.col("bioinfo_analysis_code")))
    return cohort.unknown_codes(c)


@witness("cohort_missing_ids", """
SELECT DISTINCT CAST(o_orderkey AS VARCHAR) AS id FROM orders
WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)
""")
def _(v):
    req = v.orders.select(F.col("o_orderkey").cast("string").alias("id"))
    found = v.lineitem.select(F.col("l_orderkey").cast("string").alias("id"))
    return cohort.missing_ids(req, found)


META_SCHEMA = ("CASE n_regionkey WHEN 1 THEN 'CQGC_Exome_Tumeur_Seul' WHEN 3 THEN 'CQGC_Other' "
               "ELSE 'CQGC_Germline' END")


def _metadata(v):
    return v.nation.selectExpr("'BAT' || lpad(CAST(n_nationkey + 3 AS STRING), 3, '0') AS batch_id",
                               f"{META_SCHEMA} AS submission_schema")


def _folders(v):
    return (v.object_keys.where(F.col("object_key").startswith("BAT"))
            .select(F.substring_index("object_key", "/", 1).alias("batch_id")))


@witness("cohort_resolve_type", f"""
WITH req AS (SELECT DISTINCT id FROM req_batches),
clin AS (SELECT DISTINCT batch_id AS id, {TYPE_CASE} AS clin_type FROM clinical),
meta AS (SELECT 'BAT' || lpad(CAST(n_nationkey + 3 AS VARCHAR), 3, '0') AS id, {META_SCHEMA} AS submission_schema FROM nation),
meta2 AS (SELECT id, submission_schema, CASE submission_schema WHEN 'CQGC_Germline' THEN 'germline'
          WHEN 'CQGC_Exome_Tumeur_Seul' THEN 'somatic_tumor_only' END AS meta_type FROM meta),
fold AS (SELECT DISTINCT split_part(object_key, '/', 1) AS id, TRUE AS has_folder FROM object_keys WHERE object_key LIKE 'BAT%'),
j AS (SELECT req.id, clin_type, submission_schema, meta_type, has_folder,
             coalesce(clin_type, meta_type, CASE WHEN submission_schema IS NULL AND has_folder THEN 'somatic_tumor_normal' END) AS analysis_type
      FROM req LEFT JOIN clin USING (id) LEFT JOIN meta2 USING (id) LEFT JOIN fold USING (id))
SELECT id, analysis_type,
       CASE WHEN clin_type IS NOT NULL THEN 'clinical' WHEN submission_schema IS NOT NULL THEN 'metadata'
            WHEN has_folder THEN 'folder' END AS source,
       CASE WHEN clin_type IS NOT NULL THEN NULL
            WHEN submission_schema IS NOT NULL AND meta_type IS NULL THEN 'Invalid submissionSchema: ' || submission_schema
            WHEN analysis_type IS NULL THEN 'Batch ID ' || id || ' does not exist' END AS error
FROM j
""")
def _(v):
    return cohort.resolve_type(v.req_batches, v.clinical, _metadata(v), _folders(v))


@witness("cohort_type_conflicts", f"""
SELECT id, count(DISTINCT t) AS n_types, array_to_string(list_sort(list(DISTINCT t)), ',') AS types
FROM (SELECT batch_id AS id, {TYPE_CASE} AS t FROM clinical) WHERE t IS NOT NULL
GROUP BY id HAVING count(DISTINCT t) > 1
""")
def _(v):
    return cohort.type_conflicts(cohort.analysis_types(v.clinical, "batch_id"), "batch")


@witness("cohort_shared_ids", """
SELECT id FROM req_analyses INTERSECT SELECT analysis_id FROM clinical
""")
def _(v):
    return cohort.shared_identifiers(v.req_analyses, v.clinical.select("analysis_id"))


@witness("cohort_single_type", f"""
SELECT count(DISTINCT t) AS n_types, count(DISTINCT t) <= 1 AS single_type
FROM (SELECT {TYPE_CASE} AS t FROM clinical WHERE analysis_id IN (SELECT id FROM req_analyses))
""")
def _(v):
    return cohort.single_type_gate(cohort.analysis_types(v.clinical, "analysis_id", v.req_analyses))


@witness("cohort_filter_type", """
SELECT id FROM req_analyses WHERE id IN (SELECT analysis_id FROM clinical WHERE bioinfo_analysis_code = 'GEBA')
""")
def _(v):
    return cohort.filter_by_type(v.req_analyses, cohort.analysis_types(v.clinical, "analysis_id"), ["germline"])


@witness("cohort_any_type", """
SELECT batch_id AS id, bool_or(coalesce(bioinfo_analysis_code = 'TEBA', false)) AS any_match
FROM clinical GROUP BY batch_id
""")
def _(v):
    return cohort.any_of_type(cohort.analysis_types(v.clinical, "batch_id"), ["somatic_tumor_only"], by=["id"])


@witness("cohort_all_batches", """
SELECT batch_id, row_number() OVER (ORDER BY batch_id) AS position FROM (SELECT DISTINCT batch_id FROM clinical)
""")
def _(v):
    return cohort.all_batches(v.clinical)


@witness("cohort_merge_ids", """
SELECT id FROM req_analyses UNION SELECT analysis_id FROM clinical WHERE bioinfo_analysis_code = 'TEBA'
""")
def _(v):
    teba = v.clinical.where("bioinfo_analysis_code = 'TEBA'").select("analysis_id")
    return cohort.merge_ids(v.req_analyses, teba)


@witness("cohort_order_batches", """
SELECT batch_id, row_number() OVER (ORDER BY ends_with(batch_id, 'somatic_normal'), batch_id) AS position
FROM (SELECT DISTINCT batch_id || CASE WHEN bioinfo_analysis_code = 'TNEBA' THEN '_somatic_normal' ELSE '' END AS batch_id
      FROM clinical)
""")
def _(v):
    ids = v.clinical.select(F.concat("batch_id", F.when(F.col("bioinfo_analysis_code") == "TNEBA", "_somatic_normal")
                                     .otherwise("")).alias("batch_id"))
    return cohort.order_batches(ids)


def _chunks(v):
    return cohort.chunk(v.clinical.select("analysis_id"), 50)


@witness("cohort_chunk", f"""
WITH {CHUNKS}
SELECT chunk_no, count(*) AS n_ids, min(id) AS first_id, max(id) AS last_id FROM c GROUP BY chunk_no
""")
def _(v):
    return _chunks(v).groupBy("chunk_no").agg(F.count("*").alias("n_ids"), F.min("id").alias("first_id"),
                                              F.max("id").alias("last_id"))


@witness("cohort_job_hash", f"""
WITH {CHUNKS}
SELECT chunk_no, count(*) AS n_ids,
       left(rtrim(translate(to_base64(unhex(sha256('[' || array_to_string(list_transform(list_sort(list(id)),
            lambda x: '"' || x || '"'), ', ') || ']'))), '+/', '-_'), '='), 14) AS job_hash
FROM c GROUP BY chunk_no
""")
def _(v):
    return cohort.job_hash(_chunks(v), "chunk_no")


@witness("cohort_arg_list", f"""
WITH {CHUNKS}
SELECT chunk_no, array_to_string(list_sort(list(id)), ',') AS arg_list FROM c GROUP BY chunk_no
""")
def _(v):
    return cohort.arg_list(_chunks(v), "chunk_no")


@witness("cohort_prerequisites", """
SELECT 'no_snv_url' AS rule, analysis_id, sequencing_id FROM clinical WHERE coalesce(length(snv_url), 0) = 0
UNION ALL
SELECT 'proband_no_cnv_url', analysis_id, sequencing_id FROM clinical WHERE is_proband AND coalesce(length(cnv_url), 0) = 0
UNION ALL
SELECT 'proband_no_sign', analysis_id, sequencing_id FROM clinical c
WHERE is_proband AND NOT EXISTS (SELECT 1 FROM clinical_signs s WHERE s.sequencing_id = c.sequencing_id)
""")
def _(v):
    return cohort.prerequisites(v.clinical, v.clinical_signs)
