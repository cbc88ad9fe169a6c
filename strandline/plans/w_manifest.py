"""Witnesses for sample sheets."""

from __future__ import annotations

from pyspark.sql import functions as F

from strandline.operators import manifest as man
from strandline.plans.fixtures import nested_clinical
from strandline.plans.registry import witness
from strandline.session import scratch_dir
from strandline.sources.sinks import read_manifest, write_manifest


def fix(u: str) -> str:
    """DuckDB text: first s3a:// -> s3://."""
    return (f"CASE WHEN strpos({u}, 's3a://') > 0 THEN substr({u}, 1, strpos({u}, 's3a://') - 1) || 's3://' || "
            f"substr({u}, strpos({u}, 's3a://') + 6) ELSE {u} END")


SV = (f"m AS (SELECT DISTINCT aliquot_id AS sample, analysis_id AS familyId, "
      f"CASE WHEN bioinfo_analysis_code = 'GEBA' THEN {fix('cnv_url')} END AS germline_vcf, "
      f"CASE WHEN bioinfo_analysis_code <> 'GEBA' THEN {fix('cnv_url')} END AS somatic_vcf "
      f"FROM clinical WHERE cnv_url IS NOT NULL)")

RESUB_BASE = ("base AS (SELECT analysis_id, aliquot_id, father_aliquot_id, mother_aliquot_id, bioinfo_analysis_code, "
              "CASE WHEN bioinfo_analysis_code = 'GEBA' THEN cnv_url END AS g, "
              "CASE WHEN bioinfo_analysis_code <> 'GEBA' THEN cnv_url END AS s FROM clinical "
              "UNION ALL SELECT analysis_id, aliquot_id, father_aliquot_id, mother_aliquot_id, bioinfo_analysis_code, "
              "snv_url, NULL FROM clinical WHERE is_proband AND snv_url IS NOT NULL)")
PLAIN_BASE = ("base AS (SELECT analysis_id, aliquot_id, father_aliquot_id, mother_aliquot_id, bioinfo_analysis_code, "
              "CASE WHEN bioinfo_analysis_code = 'GEBA' THEN cnv_url END AS g FROM clinical)")
PARENTAL = (f"p AS (SELECT analysis_id AS familyId, aliquot_id AS sample, {fix('g')} AS vcf FROM base "
            f"WHERE bioinfo_analysis_code = 'GEBA' AND g IS NOT NULL AND analysis_id IN "
            f"(SELECT analysis_id FROM base WHERE bioinfo_analysis_code = 'GEBA' "
            f"AND (mother_aliquot_id IS NOT NULL OR father_aliquot_id IS NOT NULL)))")


def _resubmitted(v):
    """Probands submitted a second time with their SNV file as the CNV file."""
    n = nested_clinical(v)
    again = (n.where(F.col("is_proband") & F.col("snv_url").isNotNull())
             .withColumn("cnv_vcf_germline_urls", F.array("snv_url"))
             .withColumn("cnv_vcf_somatic_urls", F.lit(None).cast("array<string>")))
    return n.unionByName(again)


@witness("man_sv", f"WITH {SV} SELECT * FROM m")
def _(v):
    return man.sv_manifest(nested_clinical(v))


@witness("man_split", f"""
WITH {SV}
SELECT 'germline' AS kind, sample, familyId, germline_vcf AS vcf FROM m WHERE germline_vcf IS NOT NULL
UNION ALL
SELECT 'somatic' AS kind, sample, familyId, somatic_vcf AS vcf FROM m WHERE somatic_vcf IS NOT NULL
""")
def _(v):
    return man.split_manifest(man.sv_manifest(nested_clinical(v)))


@witness("man_duplicates", f"""
WITH {RESUB_BASE},
m AS (SELECT DISTINCT aliquot_id AS sample, analysis_id AS familyId, {fix('g')} AS germline_vcf, {fix('s')} AS somatic_vcf
      FROM base WHERE g IS NOT NULL OR s IS NOT NULL)
SELECT sample FROM m GROUP BY sample HAVING count(*) > 1
""")
def _(v):
    return man.duplicate_samples(man.sv_manifest(_resubmitted(v)))


@witness("man_dedup", f"""
WITH {RESUB_BASE}, {PARENTAL}
SELECT familyId, sample, vcf FROM p
QUALIFY row_number() OVER (PARTITION BY sample ORDER BY familyId NULLS FIRST, sample, vcf NULLS FIRST) = 1
""")
def _(v):
    return man.dedup_samples(man.parental_manifest(_resubmitted(v)), "first")


@witness("man_parental", f"WITH {PLAIN_BASE}, {PARENTAL} SELECT familyId, sample, vcf FROM p")
def _(v):
    return man.parental_manifest(nested_clinical(v))


def _pheno(v):
    return v.req_analyses.select(F.col("id").alias("analysis_id"),
                                 F.concat(F.lit("s3://nextflow/exomiser/"), "id", F.lit(".json")).alias("pheno_path"))


@witness("man_snv", f"""
SELECT c.analysis_id AS familyId, c.aliquot_id AS sample, 'WES' AS sequencingType, {fix('c.snv_url')} AS gvcf,
       's3://nextflow/exomiser/' || r.id || '.json' AS familyPheno
FROM clinical c JOIN req_analyses r ON c.analysis_id = r.id
""")
def _(v):
    return man.snv_manifest(nested_clinical(v), _pheno(v))


@witness("man_cnv", f"""
SELECT c.analysis_id AS sample, 'WES' AS sequencingType,
       CASE WHEN c.bioinfo_analysis_code = 'GEBA' THEN {fix('c.cnv_url')} END AS vcf,
       's3://nextflow/exomiser/' || r.id || '.json' AS pheno
FROM clinical c JOIN req_analyses r ON c.analysis_id = r.id WHERE c.is_proband
""")
def _(v):
    return man.cnv_manifest(nested_clinical(v), _pheno(v))


@witness("man_strict_recode", """
SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH')
""")
def _(v):
    bad = man.recode_violations(v.orders, "o_orderpriority", {"1-URGENT": "URGENT", "2-HIGH": "HIGH"})
    return bad.select("o_orderkey", "o_orderpriority")


@witness("man_roundtrip", f"WITH {PLAIN_BASE}, {PARENTAL} SELECT familyId, sample, vcf FROM p")
def _(v):
    path = scratch_dir(v.spark, "manifest")
    write_manifest(man.parental_manifest(nested_clinical(v)), path)
    return read_manifest(v.spark, path, "familyId string, sample string, vcf string")
