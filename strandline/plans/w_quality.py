"""Witnesses for data-quality checks."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from strandline.operators import manifest as man
from strandline.operators import quality as qa
from strandline.operators import suites
from strandline.operators import variants as var
from strandline.plans.fixtures import nested_clinical
from strandline.plans.registry import witness
from strandline.plans.w_manifest import fix
from strandline.plans.w_variants import (BLOCKS, CLUSTERS, CNV_GENES, CONS, COV, DV, EXT, FREQ, GENE_PAIRS, K, KIND, NORM, ORIGIN,
                                         PAIRS, PICKED, QUAL, SCORES, TUMOR, _clinvar, _cons, _coverage, _pv, _scores, _sources,
                                         document_parts)
from strandline.session import cut_lineage, cut_together, scratch_dir

VK = var.VARIANT_KEY


def _exists_in(alias: str, other: str, where: str = "") -> str:
    cond = " AND ".join(f"{other}.{c} = {alias}.{c}" for c in VK)
    return f"EXISTS (SELECT 1 FROM {other} WHERE {cond}{' AND ' + where if where else ''})"


@witness("qa_non_empty", """
SELECT table_name FROM (
  SELECT 'clinical' AS table_name, (SELECT count(*) FROM (SELECT 1 FROM clinical LIMIT 1)) AS n
  UNION ALL SELECT 'occurrences', (SELECT count(*) FROM (SELECT 1 FROM occurrences LIMIT 1))
  UNION ALL SELECT 'genes', (SELECT count(*) FROM (SELECT 1 FROM genes LIMIT 1))
  UNION ALL SELECT 'cnvs', (SELECT count(*) FROM (SELECT 1 FROM cnvs LIMIT 1))
  UNION ALL SELECT 'negative_orders', (SELECT count(*) FROM (SELECT 1 FROM orders WHERE o_totalprice < 0 LIMIT 1))
) WHERE n = 0
""")
def _(v):
    return qa.non_empty({"clinical": v.clinical, "occurrences": v.occurrences, "genes": v.genes, "cnvs": v.cnvs,
                         "negative_orders": v.orders.where("o_totalprice < 0")})


@witness("qa_no_dup", f"""
SELECT {K}, sequencing_id, count(*) AS n_rows FROM occurrences GROUP BY {K}, sequencing_id HAVING count(*) > 1
""")
def _(v):
    return qa.no_duplicates(v.occurrences, [*VK, "sequencing_id"])


@witness("qa_included", f"""
WITH {NORM}, {FREQ}
SELECT DISTINCT {K} FROM n WHERE ad_alt >= 3 AND NOT {_exists_in('n', 'freq', "freq.analysis_code = 'all'")}
""")
def _(v):
    freq = var.frequencies(v.occurrences, v.clinical).where(F.col("analysis_code") == "all")
    return qa.included_in(var.normalize_snv(v.occurrences), freq, VK, F.col("ad_alt") >= 3)


@witness("qa_same_set", f"""
WITH {DV}, {NORM}, {FREQ}, fa AS (SELECT {K} FROM freq WHERE analysis_code = 'all')
SELECT {K}, 'left_only' AS side FROM v WHERE NOT {_exists_in('v', 'fa')}
UNION ALL
SELECT {K}, 'right_only' AS side FROM fa WHERE NOT {_exists_in('fa', 'v')}
""")
def _(v):
    freq = var.frequencies(v.occurrences, v.clinical).where(F.col("analysis_code") == "all")
    return qa.same_set(var.distinct_variants(v.occurrences), freq, VK)


@witness("qc_row_filter", f"""
SELECT {K}, sequencing_id, order_key, line_no FROM occurrences WHERE NOT coalesce(alternate <> '*', false)
""")
def _(v):
    return qa.row_filter(v.occurrences, "alternate <> '*'").select(*VK, "sequencing_id", "order_key", "line_no")


FT = f"ft AS (SELECT DISTINCT {K} FROM occurrences WHERE filters = 'PASS' AND gq >= 25)"


def _flawed_freq(v):
    return v.occurrences.where("filters = 'PASS' AND gq >= 25").select(*VK).distinct()


@witness("qc_extra", f"""
WITH {FT}, fl AS (SELECT {K}, bool_or({QUAL}) AS q FROM occurrences GROUP BY {K})
SELECT ft.chromosome, ft.start, ft.reference, ft.alternate FROM ft LEFT JOIN fl USING ({K}) WHERE NOT coalesce(fl.q, false)
""")
def _(v):
    o = v.occurrences
    return qa.should_not_have(_flawed_freq(v), o, VK, var.qualifies(o))


@witness("qc_missed", f"""
WITH {FT}, qv AS (SELECT DISTINCT {K} FROM occurrences WHERE {QUAL})
SELECT {K} FROM qv WHERE NOT {_exists_in('qv', 'ft')}
""")
def _(v):
    o = v.occurrences
    return qa.should_have(_flawed_freq(v), o, VK, var.qualifies(o))


CLIN_COLS = ["sequencing_id", "analysis_id", "batch_id", "family_id", "aliquot_id", "is_proband", "father_aliquot_id",
             "mother_aliquot_id", "bioinfo_analysis_code", "gender", "affected_status", "cnv_url", "snv_url"]


def _union(parts: list[str]) -> str:
    return "\nUNION ALL ".join(parts)


@witness("qc_no_null", "SELECT column_name, n_null FROM (" + _union(
    [f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS n_null FROM clinical" for c in CLIN_COLS])
    + ") WHERE n_null > 0")
def _(v):
    return qa.no_null(v.clinical, CLIN_COLS)


DBSNP = ("ds AS (SELECT 'chrM' AS chromosome, s_suppkey * 10 AS start, 'A' AS reference, 'C' AS alternate, "
         "'rs' || CAST(s_suppkey AS VARCHAR) AS rs FROM supplier)")
EXT2 = (f"gn AS (SELECT 'chr' || CAST(p_partkey % 22 + 1 AS VARCHAR) AS chromosome, p_partkey * 10 AS start, "
        f"substr('ACGT', CAST(p_partkey % 4 + 1 AS INT), 1) AS reference, "
        f"substr('ACGT', CAST((p_partkey + 1) % 4 + 1 AS INT), 1) AS alternate, CAST(p_size AS DOUBLE) / 100 AS af FROM part)")
EV_COLS = ["chromosome", "start", "reference", "alternate", "af", "rs"]


@witness("qc_only_null", f"""
WITH {DV}, {EXT2}, {DBSNP}, t AS (SELECT v.*, gn.af, ds.rs FROM v LEFT JOIN gn USING ({K}) LEFT JOIN ds USING ({K}))
SELECT column_name FROM ({_union([f"SELECT '{c}' AS column_name, count({c}) AS n FROM t" for c in EV_COLS])}) WHERE n = 0
""")
def _(v):
    gn = _pv(v, 1).select(*VK, (F.col("p_size").cast("double") / 100).alias("af"))
    ds = v.supplier.select(F.lit("chrM").alias("chromosome"), (F.col("s_suppkey") * 10).alias("start"),
                           F.lit("A").alias("reference"), F.lit("C").alias("alternate"),
                           F.concat(F.lit("rs"), F.col("s_suppkey").cast("string")).alias("rs"))
    t = var.external_frequencies(var.distinct_variants(v.occurrences), {"g": gn, "d": ds})
    t = t.select(*VK, F.col("g.af").alias("af"), F.col("d.rs").alias("rs"))
    return qa.only_null(t)


SNV_SHEET = (f"m AS (SELECT c.analysis_id AS familyId, c.aliquot_id AS sample, 'WES' AS sequencingType, "
             f"{fix('c.snv_url')} AS gvcf, 's3://nextflow/exomiser/' || r.id || '.json' AS familyPheno "
             f"FROM clinical c JOIN req_analyses r ON c.analysis_id = r.id)")
SHEET_COLS = ["familyId", "sample", "sequencingType", "gvcf", "familyPheno"]


@witness("qc_same_value", f"""
WITH {SNV_SHEET}
SELECT column_name FROM ({_union([f"SELECT '{c}' AS column_name, coalesce(min({c}) = max({c}) AND count({c}) > 0, false) AS s FROM m" for c in SHEET_COLS])})
WHERE s
""")
def _(v):
    pheno = v.req_analyses.select(F.col("id").alias("analysis_id"),
                                  F.concat(F.lit("s3://nextflow/exomiser/"), "id", F.lit(".json")).alias("pheno_path"))
    return qa.same_value(man.snv_manifest(nested_clinical(v), pheno))


@witness("qc_nested", f"""
WITH {NORM}, {FREQ} SELECT analysis_code, ac, an, af, pc, pn, pf, hom FROM freq WHERE analysis_code <> 'all'
""")
def _(v):
    donors = var.variant_donors(var.enrich_snv(v.occurrences, v.clinical))
    return qa.nested(var.variant_centric(donors, var.frequencies(v.occurrences, v.clinical)), "frequencies_by_analysis")


@witness("qc_dictionary", f"""
WITH {NORM}
SELECT 'zygosity' AS column_name, zygosity AS value, count(*) AS n_rows FROM n WHERE zygosity NOT IN ('HET') GROUP BY zygosity
UNION ALL
SELECT 'filters', filters, count(*) FROM n WHERE filters NOT IN ('PASS') GROUP BY filters
""")
def _(v):
    return qa.in_dictionary(var.normalize_snv(v.occurrences), {"zygosity": ["HET"], "filters": ["PASS"]})


# Faults put into the tables, so that each check has something to find: rows that come twice, rows that are left out.
TWICE = {"gnomad_joint": "start % 970 = 0", "clinical": "aliquot_id LIKE '%8'", "normalized_snv": "start % 970 = 0",
         "normalized_snv_somatic": "start % 980 = 0", "normalized_consequences": "start % 960 = 0",
         "normalized_variants": "start % 950 = 0", "snv": "start % 940 = 0", "snv_somatic": "start % 930 = 0",
         "consequences": "start % 920 = 0", "variants": "start % 910 = 0", "variant_centric": "start % 890 = 0",
         "cnv_centric": "cnv_id LIKE '%77'", "coverage_by_gene": "depth = 13",
         "nextflow_svclustering_germline": "cluster_id LIKE '%7'", "nextflow_svclustering_somatic": "cluster_id LIKE '%1'",
         "nextflow_svclustering_parental_origin": "cnv_id LIKE '%4'"}
LEFT_OUT = {"normalized_variants": "start % 1130 = 0", "variants": "start % 1120 = 0", "variant_centric": "start % 1070 = 0",
            "franklin": "start >= 0"}


def _faulty(name, df):
    kept = df.where(f"NOT ({LEFT_OUT[name]})") if name in LEFT_OUT else df
    return kept.unionByName(df.where(TWICE[name])) if name in TWICE else kept


def _faulty_sql(name, sql):
    kept = f"SELECT * FROM ({sql}) WHERE NOT ({LEFT_OUT[name]})" if name in LEFT_OUT else sql
    return f"t_{name} AS ({kept}" + (f" UNION ALL SELECT * FROM ({sql}) WHERE {TWICE[name]})" if name in TWICE else ")")


MUST_HAVE_ROWS = ["clinical", "normalized_snv", "variants", "cnv_centric", "franklin"]


def _qa_tables(v):
    occ = cut_lineage(v.occurrences)
    snv = cut_lineage(var.enrich_snv(occ, v.clinical))
    variants = cut_lineage(var.distinct_variants(occ))
    germline = F.col("bioinfo_analysis_code") == "GEBA"
    gene_scores = v.part.select(F.concat(F.lit("GENE"), F.col("p_partkey").cast("string")).alias("symbol"),
                                (F.col("p_retailprice") / 100).alias("cadd"))
    made = cut_together({
        "clusters": lambda: var.cluster_frequencies(v.cnvs, var.sv_clusters(v.cnvs), v.clinical),
        "docs": lambda: var.variant_centric(var.variant_donors(snv), var.frequencies(snv, v.clinical, enriched=True)),
        "cons": lambda: _cons(v, variants),
        "variants": lambda: var.enrich_variants(variants, _sources(v), _clinvar(v), v.genes,
                                                _scores(v, occ)).select(*VK, "clin_sig", "n_genes", "max_score"),
        "origin": lambda: var.parental_origin(v.cnvs, v.clinical).withColumnRenamed("proband_seq", "sequencing_id"),
        "normalized_variants": lambda: var.normalize_variants(snv, v.clinical, enriched=True),
        "coverage": lambda: var.normalize_coverage(_coverage(v))})
    cons, clusters = made["cons"], made["clusters"]
    tables = {
        "gnomad_joint": _sources(v)["gnomad"], "clinical": v.clinical,
        "normalized_snv": snv.where(germline).select(*occ.columns),
        "normalized_snv_somatic": snv.where(~germline).select(*occ.columns),
        "normalized_consequences": cons, "normalized_variants": made["normalized_variants"],
        "snv": snv.where(germline), "snv_somatic": snv.where(~germline),
        "consequences": cut_lineage(var.enrich_consequences(cons, gene_scores)), "variants": made["variants"],
        "variant_centric": made["docs"], "cnv_centric": var.cnv_centric(v.cnvs), "coverage_by_gene": made["coverage"],
        "nextflow_svclustering_germline": clusters.where("kind = 'germline'"),
        "nextflow_svclustering_somatic": clusters.where("kind = 'somatic'"),
        "nextflow_svclustering_parental_origin": made["origin"], "franklin": v.cnvs,
    }
    return {name: _faulty(name, df) for name, df in tables.items()}


QA_SQL = {
    "gnomad_joint": "SELECT * FROM gn", "clinical": "SELECT * FROM clinical",
    "normalized_snv": "SELECT n.* FROM n JOIN clinical c USING (sequencing_id) WHERE c.bioinfo_analysis_code = 'GEBA'",
    "normalized_snv_somatic": "SELECT n.* FROM n JOIN clinical c USING (sequencing_id) WHERE c.bioinfo_analysis_code <> 'GEBA'",
    "normalized_consequences": "SELECT * FROM cons", "normalized_variants": f"SELECT DISTINCT {K}, batch_id FROM n JOIN clinical USING (sequencing_id)",
    "snv": "SELECT n.*, c.analysis_id FROM n JOIN clinical c USING (sequencing_id) WHERE c.bioinfo_analysis_code = 'GEBA'",
    "snv_somatic": "SELECT n.*, c.analysis_id FROM n JOIN clinical c USING (sequencing_id) WHERE c.bioinfo_analysis_code <> 'GEBA'",
    "consequences": "SELECT * FROM cons", "variants": "SELECT * FROM v",
    "variant_centric": f"SELECT DISTINCT {K} FROM n JOIN clinical USING (sequencing_id)",
    "cnv_centric": "SELECT cnv_id FROM cnvs", "coverage_by_gene": "SELECT * FROM nc",
    "nextflow_svclustering_germline": "SELECT * FROM cf WHERE kind = 'germline'",
    "nextflow_svclustering_somatic": "SELECT * FROM cf WHERE kind = 'somatic'",
    "nextflow_svclustering_parental_origin": "SELECT cnv_id, proband_seq AS sequencing_id FROM org", "franklin": "SELECT * FROM cnvs",
}
_SEQ, _CONS = f"{K}, sequencing_id", f"{K}, symbol, transcript"
DUP_SQL = [("no_dup_gnomad_joint", "gnomad_joint", K), ("no_dup_clinical", "clinical", "analysis_id, sequencing_id, bioinfo_analysis_code"),
           ("no_dup_nor_snv", "normalized_snv", _SEQ), ("no_dup_nor_snv_somatic", "normalized_snv_somatic", _SEQ),
           ("no_dup_nor_consequences", "normalized_consequences", _CONS),
           ("no_dup_nor_variants", "normalized_variants", f"{K}, batch_id"), ("no_dup_snv", "snv", _SEQ),
           ("no_dup_snv_somatic", "snv_somatic", _SEQ), ("no_dup_consequences", "consequences", _CONS),
           ("no_dup_variants", "variants", K), ("no_dup_variant_centric", "variant_centric", K),
           ("no_dup_cnv_centric", "cnv_centric", "cnv_id"), ("no_dup_coverage_by_gene", "coverage_by_gene", "symbol, sample_id"),
           ("no_dup_nextflow_svclustering_germline", "nextflow_svclustering_germline", "cluster_id"),
           ("no_dup_nextflow_svclustering_somatic", "nextflow_svclustering_somatic", "cluster_id"),
           ("no_dup_nextflow_svclustering_parental_origin", "nextflow_svclustering_parental_origin", "cnv_id, sequencing_id")]
INCLUDED_SQL = [("same_list_nor_snv_nor_variants", "normalized_snv", "normalized_variants"),
                ("same_list_nor_snv_somatic_nor_variants", "normalized_snv_somatic", "normalized_variants"),
                ("same_list_snv_variants", "snv", "variants"), ("same_list_snv_somatic_variants", "snv_somatic", "variants")]


def _missing(left, right, where="true"):
    return (f"(SELECT count(*) FROM (SELECT DISTINCT {K} FROM t_{left} WHERE {where} "
            f"EXCEPT SELECT {K} FROM t_{right}))")


QA_ROWS = (
    ["SELECT 'non_empty_tables' AS check_name, 'all' AS table_name, " + " + ".join(
        f"(SELECT CAST(count(*) = 0 AS INT) FROM t_{t})" for t in MUST_HAVE_ROWS) + " AS n_violations"]
    + [f"SELECT '{c}', '{t}', (SELECT count(*) FROM (SELECT 1 FROM t_{t} GROUP BY {key} HAVING count(*) > 1))" for c, t, key in DUP_SQL]
    + [f"SELECT '{c}', '{r}', {_missing(l, r, 'ad_alt >= 3')}" for c, l, r in INCLUDED_SQL]
    + ["SELECT 'same_list_variants_variant_centric', 'variant_centric', "
       f"{_missing('variants', 'variant_centric')} + {_missing('variant_centric', 'variants')}"])


@witness("qa_suite", f"""
WITH RECURSIVE {NORM}, {DV}, {EXT}, {GENE_PAIRS}, {CONS}, {COV}, {PAIRS}, {CLUSTERS}, {KIND}, {ORIGIN},
{", ".join(_faulty_sql(t, q) for t, q in QA_SQL.items())},
rs AS ({_union(QA_ROWS)})
SELECT check_name, table_name, 'critical' AS severity, CAST(n_violations AS BIGINT) AS n_violations FROM rs
""")
def _(v):
    return suites.qa_suite(_qa_tables(v), MUST_HAVE_ROWS)


# Faults put into the blocks: a column without a value, one with a single value, and one with holes.
SEEDS = ["blank", "same", "holes"]
HOLES = "start % 40 = 0"


def _seeds():
    return {"blank": F.lit(None).cast("string"), "same": F.lit("x"), "holes": F.when(~F.expr(HOLES), F.lit("y"))}


def _seeded(df):
    """The faults as columns of the table and as fields of its structs and arrays of structs."""
    out = df
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, T.StructType):
            for name, value in _seeds().items():
                c = c.withField(name, value)
            out = out.withColumn(f.name, F.when(F.col(f.name).isNotNull(), c))
        elif isinstance(f.dataType, T.ArrayType) and isinstance(f.dataType.elementType, T.StructType):
            out = out.withColumn(f.name, F.transform(f.name, lambda e: e.withField("blank", _seeds()["blank"]).withField(
                "same", _seeds()["same"]).withField("holes", _seeds()["holes"])))
    return out.withColumns(_seeds())


def _qc_tables(v):
    """The suite's tables, and the profiles of those that column checks look at."""
    occ = cut_lineage(v.occurrences)
    variants = cut_lineage(var.distinct_variants(occ))
    cons = cut_lineage(_cons(v, variants))

    def profiled(name, df):
        return qa.write_profiled(_seeded(df), scratch_dir(v.spark, f"qc-{name}"))

    # the donors are written once, with their faults, and read back without them
    donors = var.variant_donors(var.enrich_snv(occ, v.clinical))
    written = {"variant_donors": profiled("variant_donors", donors)}
    parts = document_parts(v, occ, written["variant_donors"][0].select(*donors.columns), variants, cons)
    parts["freqs"] = cut_lineage(parts["freqs"])
    cnvs = v.cnvs
    n_genes = (var.gene_overlap(cnvs.select("cnv_id", "chromosome", "start", "end"),
                                v.genes.select("symbol", "chromosome", "start", "end"))
               .groupBy("cnv_id").agg(F.count("*").alias("n_genes")))
    coverage = var.coverage_by_gene_centric(var.normalize_coverage(_coverage(v)), v.genes)
    written |= {name: profiled(name, df) for name, df in {
        "variant_centric": var.variant_centric(**parts),
        "gene_centric": var.gene_centric(v.genes, var.gene_variants(cons)),
        "cnv_centric": var.cnv_centric(cnvs.join(n_genes, "cnv_id", "left")).select("cnv_id", "doc.*"),
        "coverage_by_gene": coverage.select("symbol", "sample_id", "doc.*")}.items()}
    # frequencies of variants that are not there, none of some that are, and a spanning deletion
    freqs = parts["freqs"].where("analysis_code = 'all'").where("start % 50 <> 30")
    freqs = freqs.unionByName(freqs.where(HOLES).withColumn("reference", F.lit("NN")))
    nor = var.normalize_snv(occ)
    spanning = nor.unionByName(nor.where(HOLES).withColumn("alternate", F.lit("*")))
    tables = {"occurrences": occ, "frequencies": freqs, "normalized_snv": spanning}
    return tables | {name: df for name, (df, _) in written.items()}, {name: p for name, (_, p) in written.items()}


NO_NULL = {"variant_centric": ["chromosome", "start", "n_donors", "cmc", "holes"], "variant_centric_donors": ["sequencing_id", "batch_id", "gender", "holes"],
           "variant_centric_freqbyanal": ["ac", "af", "holes"], "variant_centric_freqrqdm": ["ac", "pc", "holes"], "gene_centric": ["symbol", "panel", "holes"],
           "cnv_centric": ["cnv_id", "n_genes", "holes"], "coverage_by_gene": ["symbol", "depth", "holes"]}
VALUES = {"dictionary_cnv": {"type": ["DEL"]}, "dictionary_consequences": {"consequence": ["missense_variant", "synonymous_variant"]},
          "dictionary_donors": {"zygosity": ["HET"], "bioinfo_analysis_code": ["GEBA", "TEBA"]},
          "dictionary_snv": {"chromosome": ["chr1", "chr2", "chr3"]}}
_FIELDS = ["ac", "an", "af", "pc", "pn", "pf", "hom"]
# block -> (table of the oracle, columns)
QC_BLOCKS = {
    "variant_centric": ("doc", ["chromosome", "start", "reference", "alternate", "n_donors", "frequency_RQDM", "frequencies_by_analysis",
                                "freq_rqdm_tumor_only", "freq_rqdm_tumor_normal", "consequences", "clinvar", "cmc",
                                "external_frequencies", "exomiser_max", "franklin_max"]),
    "variant_centric_cmc": ("doc", ["mutation_count", "tier"]), "variant_centric_clinvar": ("doc", ["clin_sig"]),
    "variant_centric_consequences": ("ec", ["symbol", "transcript", "consequence", "cadd", "picked"]),
    "variant_centric_donors": ("dn", ["chromosome", "start", "reference", "alternate", "sequencing_id", "analysis_id", "batch_id",
                                      "bioinfo_analysis_code", "is_proband", "gender", "affected_status", "zygosity", "gq", "ad_alt",
                                      "filters"]),
    "variant_centric_exomax": ("doc", ["max_score", "max_sequencing_id"]), "variant_centric_extfreq": ("doc", ["gnomad_af", "topmed_af"]),
    "variant_centric_framax": ("doc", ["franklin_score"]),
    "variant_centric_freqbyanal": ("(SELECT * FROM freq WHERE analysis_code <> 'all')", ["analysis_code", *_FIELDS]),
    "variant_centric_freqrqdm": ("doc", _FIELDS),
    "variant_centric_freqrqdmtumor": ("doc", ["to_pc", "to_pn", "to_pf", "tn_pc", "tn_pn", "tn_pf"]),
    "gene_centric": ("gc", ["symbol", "chromosome", "start", '"end"', "panel", "n_variants"]),
    "cnv_centric": ("cc", ["cnv_id", "sequencing_id", "chromosome", "start", '"end"', "type", "n_genes"]),
    "coverage_by_gene": ("cv2", ["symbol", "sample_id", "chromosome", "start", '"end"', "depth"]),
}
QC_TABLE = {"variant_centric_donors": "variant_donors", "gene_centric": "gene_centric", "cnv_centric": "cnv_centric",
            "coverage_by_gene": "coverage_by_gene"}


def _seeded_sql(block, source):
    """The oracle's table with the faults; a field of a struct that is not there is NULL."""
    return f"(SELECT *, NULL::VARCHAR AS blank, 'x' AS same, CASE WHEN NOT {HOLES} THEN 'y' END AS holes FROM {source})"


def _qc_rows():
    for block, (source, columns) in QC_BLOCKS.items():
        columns = columns + SEEDS * len(suites.BLOCKS[block][1] or [""])
        kinds = {"only_null": [f"count({c}) = 0" for c in columns], "same_value": [f"coalesce(min({c}) = max({c}), false)" for c in columns],
                 "no_null": [f"count({c}) < count(*)" for c in NO_NULL.get(block, [])]}
        for kind, terms in kinds.items():
            if terms:
                yield (f"SELECT '{kind}_{block}', '{QC_TABLE.get(block, 'variant_centric')}', "
                       f"(SELECT {' + '.join(f'CAST({t} AS INT)' for t in terms)} FROM {_seeded_sql(block, source)})")


def _outside(source, column, values):
    listed = ", ".join(f"'{x}'" for x in values)
    return f"(SELECT count(DISTINCT {column}) FROM {source} WHERE {column} NOT IN ({listed}))"


@witness("qc_suite", f"""
WITH {NORM}, {FREQ}, {TUMOR}, {DV}, {GENE_PAIRS}, {CONS}, {EXT}, {SCORES}, {BLOCKS}, {PICKED}, {COV}, {CNV_GENES},
fk7 AS (SELECT {K} FROM freq WHERE analysis_code = 'all' AND start % 50 <> 30),
fa AS (SELECT {K} FROM fk7 UNION ALL SELECT chromosome, start, 'NN', alternate FROM fk7 WHERE {HOLES}),
fl AS (SELECT {K}, bool_or({QUAL}) AS q FROM occurrences GROUP BY {K}),
qv AS (SELECT DISTINCT {K} FROM occurrences WHERE {QUAL}),
dn AS (SELECT * FROM n JOIN clinical USING (sequencing_id)),
d AS (SELECT {K}, count(*) AS n_donors FROM dn GROUP BY {K}),
fc AS (SELECT {K}, string_agg(concat_ws(':', analysis_code, ac, pc, pn, hom), ',' ORDER BY analysis_code) AS frequencies_by_analysis
       FROM freq WHERE analysis_code <> 'all' GROUP BY {K}),
ec AS (SELECT pk.*, ps.p_retailprice / 100 AS cadd FROM pk LEFT JOIN part ps ON pk.pkey = ps.p_partkey),
ca AS (SELECT {K}, string_agg(concat_ws('/', symbol, transcript, consequence, cadd, picked), ',' ORDER BY symbol, transcript)
       AS consequences FROM ec GROUP BY {K}),
doc AS (SELECT d.*, f.ac, f.an, f.af, f.pc, f.pn, f.pf, f.hom, CASE WHEN f.pc IS NOT NULL THEN concat_ws('|', f.ac, f.pc, f.pn, f.hom) END AS frequency_RQDM,
        fc.frequencies_by_analysis, tf.to_pc, tf.to_pn, tf.to_pf, tf.tn_pc, tf.tn_pn, tf.tn_pf,
        CASE WHEN tf.to_pc IS NOT NULL THEN concat_ws('|', tf.to_pc, tf.to_pn) END AS freq_rqdm_tumor_only,
        CASE WHEN tf.tn_pc IS NOT NULL THEN concat_ws('|', tf.tn_pc, tf.tn_pn) END AS freq_rqdm_tumor_normal,
        ca.consequences, cv.clin_sig, cv.clin_sig AS clinvar, cm.mutation_count, cm.tier,
        CASE WHEN cm.tier IS NOT NULL THEN concat_ws('|', cm.mutation_count, cm.tier) END AS cmc,
        gn.af AS gnomad_af, tm.af AS topmed_af, coalesce(CAST(gn.af AS VARCHAR), '-') || '|' || coalesce(CAST(tm.af AS VARCHAR), '-') AS external_frequencies,
        ms.max_score, ms.max_sequencing_id, CASE WHEN ms.max_score IS NOT NULL THEN concat_ws('|', ms.max_score, ms.max_sequencing_id) END AS exomiser_max,
        fk.score AS franklin_score, fk.score AS franklin_max
        FROM d LEFT JOIN (SELECT * FROM freq WHERE analysis_code = 'all') f USING ({K}) LEFT JOIN fc USING ({K}) LEFT JOIN tf USING ({K})
        LEFT JOIN ca USING ({K}) LEFT JOIN cv USING ({K}) LEFT JOIN cm USING ({K}) LEFT JOIN gn USING ({K}) LEFT JOIN tm USING ({K})
        LEFT JOIN ms USING ({K}) LEFT JOIN fk USING ({K})),
gc AS (SELECT g.*, coalesce(c.n, 0) AS n_variants FROM genes g LEFT JOIN (SELECT symbol, count(*) AS n FROM cons GROUP BY symbol) c USING (symbol)),
cc AS (SELECT c.*, cg.n_genes FROM cnvs c LEFT JOIN cg USING (cnv_id)),
cv2 AS (SELECT nc.symbol, nc.sample_id, g.chromosome, g.start, g."end", nc.depth FROM nc JOIN genes g USING (symbol)),
r AS (
  SELECT 'filters_snv' AS check_name, 'normalized_snv' AS table_name, (SELECT count(*) FROM n WHERE alternate = '*' OR {HOLES}) AS n_violations
  UNION ALL SELECT 'filters_frequency_extra', 'normalized_variants',
         (SELECT count(*) FROM fa LEFT JOIN fl USING ({K}) WHERE NOT coalesce(fl.q, false))
  UNION ALL SELECT 'filters_frequency_missed', 'normalized_variants', (SELECT count(*) FROM qv WHERE NOT {_exists_in('qv', 'fa')})
  UNION ALL SELECT 'dictionary_cnv', 'cnv_centric', {_outside("cc", "type", ["DEL"])}
  UNION ALL SELECT 'dictionary_consequences', 'variant_centric', {_outside("ec", "consequence", ["missense_variant", "synonymous_variant"])}
  UNION ALL SELECT 'dictionary_donors', 'variant_donors', {_outside("dn", "zygosity", ["HET"])} + {_outside("dn", "bioinfo_analysis_code", ["GEBA", "TEBA"])}
  UNION ALL SELECT 'dictionary_snv', 'variant_centric', {_outside("doc", "chromosome", ["chr1", "chr2", "chr3"])}
  UNION ALL {_union(list(_qc_rows()))}
)
SELECT check_name, table_name, 'warning' AS severity, CAST(n_violations AS BIGINT) AS n_violations FROM r
""")
def _(v):
    tables, profiles = _qc_tables(v)
    return suites.qc_suite(tables, NO_NULL, VALUES, profiles=profiles)
