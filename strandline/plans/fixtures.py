"""Domain-shaped views over the driver's tables.

Each view is a projection (plus one equi-join for ``occurrences``) over the
base tables, written once as SQL expressions: Spark applies them with
``selectExpr`` so the scan keeps pushdown and pruning; the DuckDB oracle gets
the same expressions as a CTE. ``{end}`` and ``{json}`` render the two places
where the dialects differ.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.sources.tables import read_table

_SRA = "'SRA' || lpad(CAST(CAST(floor({k} / 4) AS BIGINT) AS STRING), CAST(greatest(7, length(CAST(CAST(floor({k} / 4) AS BIGINT) AS STRING))) AS INT), '0')"
_SRS = "'SRS' || lpad(CAST({k} AS STRING), CAST(greatest(7, length(CAST({k} AS STRING))) AS INT), '0')"

VIEWS: dict[str, tuple[str, list[str]]] = {
    "clinical": ("customer", [
        _SRS.format(k="c_custkey") + " AS sequencing_id",
        _SRA.format(k="c_custkey") + " AS analysis_id",
        "'BAT' || lpad(CAST((CAST(floor(c_custkey / 8) AS BIGINT) + (CASE WHEN c_custkey % 16 = 3 THEN 1 ELSE 0 END)) % 23 AS STRING), 3, '0') AS batch_id",
        "CASE WHEN CAST(floor(c_custkey / 4) AS BIGINT) % 6 = 5 THEN NULL "
        "ELSE 'FM' || lpad(CAST(CAST(floor(c_custkey / 4) AS BIGINT) AS STRING), CAST(greatest(6, length(CAST(CAST(floor(c_custkey / 4) AS BIGINT) AS STRING))) AS INT), '0') END AS family_id",
        "CAST(c_custkey AS STRING) AS aliquot_id",
        "c_custkey % 4 = 0 AS is_proband",
        "CASE WHEN c_custkey % 4 = 0 AND CAST(floor(c_custkey / 4) AS BIGINT) % 3 <> 1 THEN CAST(c_custkey + 1 AS STRING) "
        "WHEN c_custkey % 4 = 3 AND CAST(floor(c_custkey / 4) AS BIGINT) % 7 = 0 THEN CAST(c_custkey - 2 AS STRING) END AS father_aliquot_id",
        "CASE WHEN c_custkey % 4 = 0 AND CAST(floor(c_custkey / 4) AS BIGINT) % 3 <> 2 AND CAST(floor(c_custkey / 4) AS BIGINT) % 6 <> 1 "
        "THEN CAST(c_custkey + 2 AS STRING) END AS mother_aliquot_id",
        "CASE WHEN c_nationkey % 5 = 4 THEN 'TNEBA' WHEN c_nationkey % 5 = 3 THEN 'TEBA' ELSE 'GEBA' END AS bioinfo_analysis_code",
        "CASE c_mktsegment WHEN 'BUILDING' THEN 'Male' WHEN 'MACHINERY' THEN 'Female' WHEN 'HOUSEHOLD' THEN 'other' ELSE 'unknown' END AS gender",
        "c_acctbal > 0 AS affected_status",
        "CASE WHEN c_custkey % 9 = 0 THEN NULL ELSE 's3a://bucket/' || CAST(c_custkey AS STRING) || '.cnv.vcf.gz' END AS cnv_url",
        "CASE WHEN c_custkey % 10 = 0 THEN NULL ELSE 's3a://bucket/' || CAST(c_custkey AS STRING) || '.gvcf.gz' END AS snv_url",
    ]),
    "clinical_signs": ("orders", [
        _SRS.format(k="o_custkey") + " AS sequencing_id",
        "'HP:' || lpad(CAST(o_orderkey % 500 AS STRING), 7, '0') AS hpo_id",
        "o_orderstatus <> 'P' AS affected_status",
        "CASE o_orderpriority WHEN '1-URGENT' THEN 'HP:0030674' WHEN '2-HIGH' THEN 'HP:0003577' "
        "WHEN '3-MEDIUM' THEN 'HP:0011463' WHEN '5-LOW' THEN 'HP:0003584' END AS age_at_onset",
    ]),
    "occurrences": ("lineitem JOIN orders ON l_orderkey = o_orderkey", [
        "'chr' || CAST(l_partkey % 22 + 1 AS STRING) AS chromosome",
        "l_partkey * 10 AS start",
        "substr('ACGT', CAST(l_partkey % 4 + 1 AS INT), 1) AS reference",
        "CASE WHEN l_linenumber = 7 THEN '*' ELSE substr('ACGT', CAST((l_partkey + 1 + l_suppkey % 3) % 4 + 1 AS INT), 1) END AS alternate",
        _SRS.format(k="o_custkey") + " AS sequencing_id",
        "CAST(l_quantity AS INT) AS gq",
        "l_linenumber AS ad_alt",
        "CASE WHEN l_returnflag = 'R' THEN 'LowQual' ELSE 'PASS' END AS filters",
        "CASE WHEN l_linestatus = 'O' THEN 'HET' ELSE 'HOM' END AS zygosity",
        "l_orderkey AS order_key",
        "l_linenumber AS line_no",
    ]),
    "genes": ("part", [
        "'GENE' || CAST(p_partkey AS STRING) AS symbol",
        "'chr' || CAST(p_partkey % 22 + 1 AS STRING) AS chromosome",
        "p_partkey * 10 - p_size AS start",
        "p_partkey * 10 + p_size * 10 AS {end}",
        "p_brand AS panel",
    ]),
    "cnvs": ("orders", [
        "'CNV' || CAST(o_orderkey AS STRING) AS cnv_id",
        _SRS.format(k="o_custkey") + " AS sequencing_id",
        "'chr' || CAST(o_custkey % 22 + 1 AS STRING) AS chromosome",
        "(o_orderkey % 1000) * 20 AS start",
        "(o_orderkey % 1000) * 20 + 100 + (o_custkey % 7) * 50 AS {end}",
        "CASE WHEN o_orderstatus = 'F' THEN 'DEL' ELSE 'DUP' END AS type",
    ]),
    "status_events": ("events", [
        "event_id", "ts",
        "'SRA' || lpad(CAST(user_id AS STRING), CAST(greatest(7, length(CAST(user_id AS STRING))) AS INT), '0') AS analysis_id",
        "CASE event_type WHEN 'signup' THEN 'PENDING' WHEN 'view' THEN 'STARTED' WHEN 'click' THEN 'STARTED' "
        "WHEN 'purchase' THEN 'SUCCESS' ELSE 'FAILURE' END AS status",
        "'boot-' || CAST(CAST({json} AS INT) % 3 AS STRING) AS boot_id",
    ]),
    "object_keys": ("orders", [
        "o_orderkey AS object_id",
        "CASE WHEN o_orderkey % 3 = 0 THEN 'post_processing/output/ensemblvep/variants.SRA' || "
        "lpad(CAST(CAST(floor(o_custkey / 4) AS BIGINT) AS STRING), CAST(greatest(7, length(CAST(CAST(floor(o_custkey / 4) AS BIGINT) AS STRING))) AS INT), '0') || '.snv.norm.VEP.vcf.gz' "
        "WHEN o_orderkey % 3 = 1 THEN 'BAT' || lpad(CAST(CAST(floor(o_custkey / 8) AS BIGINT) % 23 AS STRING), 3, '0') || '/' || "
        "CAST(o_custkey AS STRING) || '.case.hard-filtered.formatted.norm.VEP.vcf.gz' "
        "ELSE 'raw/landing/franklin/analysis_id=SRA' || lpad(CAST(CAST(floor(o_custkey / 4) AS BIGINT) AS STRING), CAST(greatest(7, length(CAST(CAST(floor(o_custkey / 4) AS BIGINT) AS STRING))) AS INT), '0') || "
        "'/aliquot_id=' || (CASE WHEN o_orderkey % 5 = 0 THEN 'null' ELSE CAST(o_custkey AS STRING) END) || "
        "'/_FRANKLIN_STATUS_.txt' END AS object_key",
    ]),
}

# Request lists (what a user passes as analysis / sequencing / batch ids), derived
# from tables that grow with the scale factor.
VIEWS.update({
    "req_analyses": ("supplier", ["'SRA' || lpad(CAST(s_suppkey * 3 AS STRING), CAST(greatest(7, length(CAST(s_suppkey * 3 AS STRING))) AS INT), '0') AS id"]),
    "req_sequencings": ("supplier", ["'SRS' || lpad(CAST(s_suppkey * 7 AS STRING), CAST(greatest(7, length(CAST(s_suppkey * 7 AS STRING))) AS INT), '0') AS id"]),
    "req_batches": ("nation", ["'BAT' || lpad(CAST(n_nationkey + n_regionkey AS STRING), 3, '0') AS id"]),
})

_SPARK = {"end": "`end`", "json": "get_json_object(props, '$.k')"}
_DUCK = {"end": '"end"', "json": "json_extract_string(props, '$.k')"}


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Build one fixture view as a lazy DataFrame over the base tables."""
    source, exprs = VIEWS[name]
    exprs = [e.format(**_SPARK) for e in exprs]
    if name == "occurrences":
        li = read_table(spark, sf_dir, "lineitem")
        od = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
        base = li.join(od, F.col("l_orderkey") == F.col("o_orderkey"))
    else:
        base = read_table(spark, sf_dir, source)
    return base.selectExpr(*exprs)


def duck_view_sql(name: str) -> str:
    source, exprs = VIEWS[name]
    return "SELECT " + ",\n       ".join(e.format(**_DUCK) for e in exprs) + f"\nFROM {source}"


def with_views(sql: str, names: list[str]) -> str:
    """Prefix an oracle query with the fixture views it names, as CTEs."""
    body = sql.strip()
    if not names:
        return body
    ctes = ",\n".join(f"{n} AS (\n{duck_view_sql(n)}\n)" for n in names)
    if body.upper().startswith("WITH RECURSIVE "):
        return f"WITH RECURSIVE {ctes},\n{body[15:]}"
    if body.upper().startswith("WITH "):
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"


class Views:
    """Lazy accessor: ``Views(spark, sf_dir).clinical`` etc., plus base tables."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name in VIEWS:
            return view(self.spark, self.sf_dir, name)
        return read_table(self.spark, self.sf_dir, name)


def nested_clinical(v: "Views") -> DataFrame:
    """Clinical rows in the lake's nested shape: file URLs as arrays (NULL when
    absent), germline vs somatic CNV files by analysis code, sequencing
    strategy."""
    def arr(c):
        return F.when(c.isNotNull(), F.array(c))

    germ = F.col("bioinfo_analysis_code") == "GEBA"
    return v.clinical.select(
        "*",
        arr(F.col("snv_url")).alias("snv_vcf_germline_urls"),
        arr(F.when(germ, F.col("cnv_url"))).alias("cnv_vcf_germline_urls"),
        arr(F.when(~germ, F.col("cnv_url"))).alias("cnv_vcf_somatic_urls"),
        F.lit("WXS").alias("sequencing_strategy"),
    )
