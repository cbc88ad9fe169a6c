"""Witnesses for variant tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from strandline.operators import variants as var
from strandline.plans.registry import witness
from strandline.session import cut_lineage, scratch_dir
from strandline.sources.sinks import overwrite_partitions, write_documents

K = "chromosome, start, reference, alternate"
NORM = ("n AS (SELECT * FROM occurrences WHERE alternate <> '*' QUALIFY row_number() OVER (PARTITION BY "
        f"{K}, sequencing_id ORDER BY gq DESC, order_key, line_no, filters, zygosity) = 1)")
QUAL = "gq >= 20 AND filters = 'PASS' AND ad_alt >= 3 AND alternate <> '*'"
ALLELES = "CASE WHEN zygosity = 'HOM' THEN 2 WHEN zygosity = 'HET' THEN 1 ELSE 0 END"
FREQ = (f"q AS (SELECT n.chromosome, n.start, n.reference, n.alternate, n.sequencing_id, c.bioinfo_analysis_code AS code, "
        f"{ALLELES} AS al, zygosity = 'HOM' AS hom FROM n JOIN clinical c USING (sequencing_id) WHERE {QUAL}), "
        f"agg AS (SELECT {K}, coalesce(code, 'all') AS analysis_code, CAST(sum(al) AS BIGINT) AS ac, count(*) AS pc, "
        f"count(CASE WHEN hom THEN 1 END) AS hom FROM q GROUP BY GROUPING SETS (({K}, code), ({K}))), "
        f"sizes AS (SELECT bioinfo_analysis_code AS analysis_code, count(DISTINCT sequencing_id) AS pn FROM clinical GROUP BY 1 "
        f"UNION ALL SELECT 'all', count(DISTINCT sequencing_id) FROM clinical), "
        f"freq AS (SELECT {K}, analysis_code, ac, pn * 2 AS an, ac / (pn * 2) AS af, pc, pn, pc / pn AS pf, hom "
        f"FROM agg JOIN sizes USING (analysis_code))")
DV = f"v AS (SELECT DISTINCT {K} FROM occurrences WHERE alternate <> '*')"
GENE_PAIRS = ('gp AS (SELECT v.chromosome, v.start, v.reference, v.alternate, g.symbol FROM v JOIN genes g '
              'ON v.chromosome = g.chromosome AND v.start <= g."end" AND g.start <= v.start + length(v.reference) - 1)')
CONS = ("cons AS (SELECT DISTINCT chromosome, start, reference, alternate, symbol, symbol || '-T1' AS transcript, "
        "CASE WHEN reference = 'A' OR alternate = 'A' THEN 'missense_variant' "
        "WHEN reference = 'C' OR alternate = 'C' THEN 'synonymous_variant' ELSE 'intron_variant' END AS consequence FROM gp)")
COV = ("cov AS (SELECT 'GENE' || CAST(l_partkey AS VARCHAR) AS symbol, 'SRS' || lpad(CAST(l_suppkey AS VARCHAR), CAST(greatest(7, length(CAST(l_suppkey AS VARCHAR))) AS INT), '0') AS sample_id, "
       "CAST(l_quantity AS INT) AS depth, l_orderkey AS order_key, l_linenumber AS line_no FROM lineitem), "
       "nc AS (SELECT * FROM cov QUALIFY row_number() OVER (PARTITION BY symbol, sample_id "
       "ORDER BY depth DESC, order_key DESC, line_no DESC) = 1)")
_PV = ("'chr' || CAST(p_partkey % 22 + 1 AS VARCHAR) AS chromosome, p_partkey * 10 AS start, "
       "substr('ACGT', CAST(p_partkey % 4 + 1 AS INT), 1) AS reference, ")
EXT = (f"gn AS (SELECT {_PV} substr('ACGT', CAST((p_partkey + 1) % 4 + 1 AS INT), 1) AS alternate, "
       f"CAST(p_size AS DOUBLE) / 100 AS af FROM part), "
       f"tm AS (SELECT {_PV} substr('ACGT', CAST((p_partkey + 2) % 4 + 1 AS INT), 1) AS alternate, "
       f"p_retailprice / 100000 AS af FROM part WHERE p_size % 2 = 0), "
       f"cv AS (SELECT {_PV} substr('ACGT', CAST((p_partkey + 1) % 4 + 1 AS INT), 1) AS alternate, "
       f"split_part(p_type, ' ', 1) AS clin_sig FROM part WHERE p_size > 25)")
SCORES = (f"sc AS (SELECT {K}, sequencing_id, CAST(gq AS DOUBLE) / 100 AS score FROM occurrences WHERE alternate <> '*'), "
          f"ms AS (SELECT {K}, score AS max_score, sequencing_id AS max_sequencing_id FROM sc "
          f"QUALIFY row_number() OVER (PARTITION BY {K} ORDER BY score DESC, sequencing_id DESC) = 1)")
PAIRS = ('pairs AS (SELECT a.cnv_id AS a_id, b.cnv_id AS b_id FROM cnvs a JOIN cnvs b ON a.chromosome = b.chromosome '
         'AND a.type = b.type AND a.cnv_id < b.cnv_id AND a.start <= b."end" AND b.start <= a."end" '
         'AND least((least(a."end", b."end") - greatest(a.start, b.start)) / (a."end" - a.start), '
         '(least(a."end", b."end") - greatest(a.start, b.start)) / (b."end" - b.start)) >= 0.8)')
CLUSTERS = ("e AS (SELECT a_id AS s, b_id AS d FROM pairs UNION SELECT b_id, a_id FROM pairs), "
            "r(node, label) AS (SELECT cnv_id, cnv_id FROM cnvs UNION SELECT e.d, r.label FROM r JOIN e ON r.node = e.s), "
            "cl AS (SELECT node AS cnv_id, min(label) AS cluster_id FROM r GROUP BY node)")
KIND = ("kd AS (SELECT sequencing_id, CASE WHEN bioinfo_analysis_code = 'GEBA' THEN 'germline' ELSE 'somatic' END AS kind "
        "FROM clinical), ksz AS (SELECT kind, count(DISTINCT sequencing_id) AS pn FROM kd GROUP BY kind), "
        "cf AS (SELECT a.*, pn, pc / pn AS pf FROM (SELECT cl.cluster_id, c.type, kd.kind, count(DISTINCT c.sequencing_id) AS pc "
        "FROM cnvs c JOIN cl ON c.cnv_id = cl.cnv_id JOIN kd USING (sequencing_id) GROUP BY 1, 2, 3) a JOIN ksz USING (kind))")
ORIGIN = ("prob AS (SELECT sequencing_id, father_aliquot_id, mother_aliquot_id FROM clinical WHERE is_proband), "
          "par AS (SELECT p.sequencing_id AS proband_seq, 'father' AS role, c.sequencing_id AS parent_seq FROM prob p "
          "JOIN clinical c ON c.aliquot_id = p.father_aliquot_id UNION ALL SELECT p.sequencing_id, 'mother', c.sequencing_id "
          "FROM prob p JOIN clinical c ON c.aliquot_id = p.mother_aliquot_id), "
          'pcn AS (SELECT cnv_id, sequencing_id AS proband_seq, chromosome, type, start, "end" FROM cnvs '
          "WHERE sequencing_id IN (SELECT sequencing_id FROM prob)), "
          "mm AS (SELECT pcn.cnv_id, par.role FROM pcn JOIN par USING (proband_seq) JOIN cnvs b ON b.sequencing_id = par.parent_seq "
          'AND b.chromosome = pcn.chromosome AND b.type = pcn.type AND pcn.start <= b."end" AND b.start <= pcn."end" '
          'AND least((least(pcn."end", b."end") - greatest(pcn.start, b.start)) / (pcn."end" - pcn.start), '
          '(least(pcn."end", b."end") - greatest(pcn.start, b.start)) / (b."end" - b.start)) >= 0.8), '
          "hh AS (SELECT cnv_id, bool_or(role = 'mother') AS m, bool_or(role = 'father') AS f FROM mm GROUP BY cnv_id), "
          "org AS (SELECT pcn.cnv_id, pcn.proband_seq, CASE WHEN m AND f THEN 'both' WHEN m THEN 'mother' WHEN f THEN 'father' "
          "ELSE 'none' END AS origin FROM pcn LEFT JOIN hh USING (cnv_id))")
CNV_GENES = ('cg AS (SELECT c.cnv_id, count(*) AS n_genes FROM cnvs c JOIN genes g ON c.chromosome = g.chromosome '
             'AND c.start <= g."end" AND g.start <= c."end" GROUP BY c.cnv_id)')


def _norm(v):
    return var.normalize_snv(v.occurrences)


def _freq(v):
    return var.frequencies(v.occurrences, v.clinical)


@witness("var_norm_snv", f"WITH {NORM} SELECT {K}, sequencing_id, gq, filters, zygosity, ad_alt FROM n")
def _(v):
    return _norm(v).select(*var.VARIANT_KEY, "sequencing_id", "gq", "filters", "zygosity", "ad_alt")


@witness("var_norm_cnv", """
SELECT cnv_id, sequencing_id, chromosome, CAST(start AS BIGINT) AS start, CAST("end" AS BIGINT) AS "end", type,
       CAST("end" - start AS BIGINT) AS length FROM cnvs WHERE start % 100 >= 40
""")
def _(v):
    # by place: no filters, failed, failed twice, passed, passed with a remark
    return var.normalize_cnv(v.cnvs.withColumn("filters", F.expr(
        "CASE start % 100 WHEN 0 THEN NULL WHEN 20 THEN array('cnvQual', 'cnvLength') WHEN 40 THEN array('PASS') "
        "ELSE array('PASS', 'remark') END")))


@witness("var_norm_variants", f"""
WITH {NORM}, j AS (SELECT n.*, c.batch_id FROM n JOIN clinical c USING (sequencing_id))
SELECT {K}, batch_id, count(*) AS n_occurrences, count(CASE WHEN {QUAL} THEN 1 END) AS pc,
       CAST(sum(CASE WHEN {QUAL} THEN {ALLELES} ELSE 0 END) AS BIGINT) AS ac
FROM j GROUP BY {K}, batch_id
""")
def _(v):
    return var.normalize_variants(v.occurrences, v.clinical)


@witness("var_frequencies", f"WITH {NORM}, {FREQ} SELECT * FROM freq")
def _(v):
    return _freq(v)


@witness("var_tumor_freq", f"""
WITH {NORM},
q AS (SELECT n.*, c.bioinfo_analysis_code AS code FROM n JOIN clinical c USING (sequencing_id) WHERE {QUAL}),
agg AS (SELECT {K}, count(DISTINCT CASE WHEN code = 'TEBA' THEN sequencing_id END) AS to_pc,
               count(DISTINCT CASE WHEN code = 'TNEBA' THEN sequencing_id END) AS tn_pc FROM q GROUP BY {K}),
s AS (SELECT count(DISTINCT CASE WHEN bioinfo_analysis_code = 'TEBA' THEN sequencing_id END) AS to_pn,
             count(DISTINCT CASE WHEN bioinfo_analysis_code = 'TNEBA' THEN sequencing_id END) AS tn_pn FROM clinical)
SELECT {K}, to_pc, to_pn, to_pc / to_pn AS to_pf, tn_pc, tn_pn, tn_pc / tn_pn AS tn_pf
FROM agg, s WHERE to_pc > 0 OR tn_pc > 0
""")
def _(v):
    return var.tumor_frequencies(v.occurrences, v.clinical)


@witness("var_enrich_snv", f"""
WITH {NORM}
SELECT n.chromosome, n.start, n.reference, n.alternate, n.sequencing_id, c.analysis_id, c.batch_id,
       c.bioinfo_analysis_code, n.gq, n.zygosity
FROM n JOIN clinical c USING (sequencing_id) WHERE c.analysis_id IN (SELECT id FROM req_analyses)
""")
def _(v):
    e = var.enrich_snv(v.occurrences, v.clinical, v.req_analyses)
    return e.select(*var.VARIANT_KEY, "sequencing_id", "analysis_id", "batch_id", "bioinfo_analysis_code", "gq",
                    "zygosity")


def _variants(v):
    return var.distinct_variants(v.occurrences)


@witness("var_gene_overlap", f"WITH {DV}, {GENE_PAIRS} SELECT * FROM gp")
def _(v):
    pairs = var.gene_overlap(var.variant_intervals(_variants(v)), v.genes.select("symbol", "chromosome", "start", "end"))
    return pairs.select(*var.VARIANT_KEY, "symbol")


def _cons(v, occ=None):
    return var.normalize_consequences(v.occurrences if occ is None else occ, v.genes)


@witness("var_norm_consequences", f"WITH {DV}, {GENE_PAIRS}, {CONS} SELECT * FROM cons")
def _(v):
    return _cons(v)


def _coverage(v):
    li = v.lineitem
    return li.select(F.concat(F.lit("GENE"), F.col("l_partkey").cast("string")).alias("symbol"),
                     F.concat(F.lit("SRS"), F.lpad(F.col("l_suppkey").cast("string"), F.greatest(F.lit(7), F.length(F.col("l_suppkey").cast("string"))), F.lit("0"))).alias("sample_id"),
                     F.col("l_quantity").cast("int").alias("depth"), F.col("l_orderkey").alias("order_key"),
                     F.col("l_linenumber").alias("line_no"))


@witness("var_norm_coverage", f"WITH {COV} SELECT * FROM nc")
def _(v):
    return var.normalize_coverage(_coverage(v))


@witness("var_enrich_coverage", f"""
WITH {COV}
SELECT a.symbol, a.n_samples, a.sum_depth, g.chromosome, g.start, g."end"
FROM (SELECT symbol, count(*) AS n_samples, CAST(sum(depth) AS BIGINT) AS sum_depth FROM nc GROUP BY symbol) a
JOIN genes g USING (symbol)
""")
def _(v):
    return var.enrich_coverage(var.normalize_coverage(_coverage(v)), v.genes)


@witness("var_scored", """
SELECT event_id, 'SRA' || lpad(CAST(user_id AS VARCHAR), CAST(greatest(7, length(CAST(user_id AS VARCHAR))) AS INT), '0') AS analysis_id, event_type,
       CAST(json_extract_string(props, '$.k') AS INTEGER) AS score
FROM events WHERE event_type IN ('purchase', 'click')
""")
def _(v):
    e = v.events.where(F.col("event_type").isin("purchase", "click"))
    s = var.scored_results(e)
    return s.select("event_id", F.concat(F.lit("SRA"), F.lpad(F.col("user_id").cast("string"), F.greatest(F.lit(7), F.length(F.col("user_id").cast("string"))), F.lit("0")))
                    .alias("analysis_id"), "event_type", F.col("k").alias("score"))


RESULT = ("SELECT 'chr' || (user_id % 22 + 1) AS chromosome, event_id * 10 AS start, substr('ACGT', CAST(event_id % 4 AS INT) + 1, 1) AS reference, "
          "'T' AS alternate, {extra}, CAST(json_extract_string(props, '$.k') AS DOUBLE) / 100 AS score, 'b' || (event_id % 3) AS batch_id, "
          "'SRA' || user_id AS analysis_id, CASE WHEN event_id % 7 <> 0 THEN 'A+' || (user_id % 9) END AS aliquot_id FROM events WHERE {where}")


def _result_files(v, fmt: str, where: str, extra) -> str:
    """Results as the services leave them: ids stand in the path, a NULL one as ``null``; some rows come twice."""
    e = v.events.where(where).select(
        F.concat(F.lit("chr"), (F.col("user_id") % 22 + 1).cast("string")).alias("chromosome"), (F.col("event_id") * 10).alias("start"),
        F.expr("substr('ACGT', cast(event_id % 4 as int) + 1, 1)").alias("reference"), F.lit("T").alias("alternate"), extra,
        (F.get_json_object("props", "$.k").cast("double") / 100).alias("score"),
        F.concat(F.lit("b"), (F.col("event_id") % 3).cast("string")).alias("batch_id"),
        F.concat(F.lit("SRA"), F.col("user_id").cast("string")).alias("analysis_id"),
        F.when(F.col("event_id") % 7 != 0, F.concat(F.lit("A+"), (F.col("user_id") % 9).cast("string"))).otherwise("null").alias("aliquot_id"))
    lesser = e.where("start % 50 = 0").withColumn("score", F.col("score") - 1)
    path = scratch_dir(v.spark, f"results-{fmt}")
    out = e.unionByName(lesser).repartition("analysis_id").write.partitionBy("batch_id", "analysis_id", "aliquot_id")
    out.option("sep", "\t").option("header", True).csv(path) if fmt == "csv" else out.json(path)
    return path


@witness("var_exomiser", RESULT.format(extra="'G' || (user_id % 5) AS symbol", where="event_type = 'purchase' AND user_id < 40"))
def _(v):
    symbol = F.concat(F.lit("G"), (F.col("user_id") % 5).cast("string")).alias("symbol")
    return var.normalize_exomiser(v.spark, _result_files(v, "csv", "event_type = 'purchase' AND user_id < 40", symbol))


@witness("var_franklin", RESULT.format(extra="event_type AS classification", where="event_type <> 'purchase' AND user_id < 20"))
def _(v):
    return var.normalize_franklin(v.spark, _result_files(v, "json", "event_type <> 'purchase' AND user_id < 20",
                                                         F.col("event_type").alias("classification")))


RESOURCE_SCHEMA = ("struct<id:bigint, extension:struct<segment:string, nation:int>, "
                   "telecom:array<struct<system:string, value:string>>>")


@witness("var_resources", """
SELECT c_custkey AS id, c_mktsegment AS segment, c_nationkey AS nation, 'phone' AS system, c_name AS value FROM customer
UNION ALL
SELECT c_custkey, c_mktsegment, c_nationkey, 'email', lower(c_name) || '@example.org' FROM customer
""")
def _(v):
    c = v.customer
    doc = F.to_json(F.struct(
        F.col("c_custkey").alias("id"),
        F.struct(F.col("c_mktsegment").alias("segment"), F.col("c_nationkey").alias("nation")).alias("extension"),
        F.array(F.struct(F.lit("phone").alias("system"), F.col("c_name").alias("value")),
                F.struct(F.lit("email").alias("system"),
                         F.concat(F.lower("c_name"), F.lit("@example.org")).alias("value"))).alias("telecom")))
    flat = var.flatten_resources(c.select(doc.alias("json")), RESOURCE_SCHEMA, "telecom")
    return flat.select("id", F.col("extension.segment").alias("segment"), F.col("extension.nation").alias("nation"),
                       "system", "value")


@witness("var_enrich_clinical", """
SELECT c.sequencing_id, c.analysis_id, c.bioinfo_analysis_code, coalesce(s.n, 0) AS n_signs, coalesce(s.na, 0) AS n_affected
FROM clinical c LEFT JOIN (SELECT sequencing_id, count(*) AS n, count(CASE WHEN affected_status THEN 1 END) AS na
                           FROM clinical_signs GROUP BY 1) s USING (sequencing_id)
""")
def _(v):
    e = var.enrich_clinical(v.clinical, v.clinical_signs)
    signs = F.col("clinical_signs")
    n = F.when(signs.isNull(), 0).otherwise(F.size(signs)).cast("bigint")
    na = F.when(signs.isNull(), 0).otherwise(F.size(F.filter(signs, lambda s: s["affected_status"]))).cast("bigint")
    return e.select("sequencing_id", "analysis_id", "bioinfo_analysis_code", n.alias("n_signs"), na.alias("n_affected"))


def _pv(v, shift: int):
    p = v.part
    return p.select(F.concat(F.lit("chr"), (F.col("p_partkey") % 22 + 1).cast("string")).alias("chromosome"),
                    (F.col("p_partkey") * 10).alias("start"),
                    F.expr("substr('ACGT', CAST(p_partkey % 4 + 1 AS INT), 1)").alias("reference"),
                    F.expr(f"substr('ACGT', CAST((p_partkey + {shift}) % 4 + 1 AS INT), 1)").alias("alternate"),
                    "p_size", "p_retailprice", "p_type", "p_brand")


def _sources(v):
    gn = _pv(v, 1).select(*var.VARIANT_KEY, (F.col("p_size").cast("double") / 100).alias("af"))
    tm = _pv(v, 2).where(F.col("p_size") % 2 == 0).select(*var.VARIANT_KEY, (F.col("p_retailprice") / 100000).alias("af"))
    return {"gnomad": gn, "topmed": tm}


def _clinvar(v):
    return _pv(v, 1).where(F.col("p_size") > 25).select(*var.VARIANT_KEY,
                                                         F.split_part("p_type", F.lit(" "), F.lit(1)).alias("clin_sig"))


def _scores(v, occ=None):
    o = (v.occurrences if occ is None else occ).where(F.col("alternate") != "*")
    return o.select(*var.VARIANT_KEY, "sequencing_id", (F.col("gq").cast("double") / 100).alias("score"))


@witness("var_external_freq", f"""
WITH {DV}, {EXT}
SELECT v.*, gn.af AS gnomad_af, tm.af AS topmed_af FROM v LEFT JOIN gn USING ({K}) LEFT JOIN tm USING ({K})
""")
def _(v):
    e = var.external_frequencies(_variants(v), _sources(v))
    return e.select(*var.VARIANT_KEY, F.col("gnomad.af").alias("gnomad_af"), F.col("topmed.af").alias("topmed_af"))


@witness("var_max_score", f"WITH {SCORES} SELECT * FROM ms")
def _(v):
    return var.max_score(_scores(v))


@witness("var_enrich_variants", f"""
WITH {DV}, {EXT}, {GENE_PAIRS}, {SCORES},
ga AS (SELECT {K}, count(*) AS n_genes, min(symbol) AS first_symbol FROM gp GROUP BY {K})
SELECT v.*, gn.af AS gnomad_af, tm.af AS topmed_af, cv.clin_sig, ga.n_genes, ga.first_symbol, ms.max_score
FROM v LEFT JOIN gn USING ({K}) LEFT JOIN tm USING ({K}) LEFT JOIN cv USING ({K}) LEFT JOIN ga USING ({K})
LEFT JOIN ms USING ({K})
""")
def _(v):
    e = var.enrich_variants(_variants(v), _sources(v), _clinvar(v), v.genes, _scores(v))
    return e.select(*var.VARIANT_KEY, F.col("gnomad.af").alias("gnomad_af"), F.col("topmed.af").alias("topmed_af"),
                    "clin_sig", "n_genes", "first_symbol", "max_score")


@witness("var_enrich_consequences", f"""
WITH {DV}, {GENE_PAIRS}, {CONS},
ps AS (SELECT 'GENE' || CAST(p_partkey AS VARCHAR) AS symbol, p_retailprice / 100 AS cadd FROM part)
SELECT {K}, symbol, consequence, cadd,
       row_number() OVER (PARTITION BY {K} ORDER BY CASE consequence WHEN 'missense_variant' THEN 1
           WHEN 'synonymous_variant' THEN 2 WHEN 'intron_variant' THEN 3 END NULLS LAST, symbol, transcript) = 1 AS picked
FROM cons LEFT JOIN ps USING (symbol)
""")
def _(v):
    scores = v.part.select(F.concat(F.lit("GENE"), F.col("p_partkey").cast("string")).alias("symbol"),
                           (F.col("p_retailprice") / 100).alias("cadd"))
    e = var.enrich_consequences(_cons(v), scores)
    return e.select(*var.VARIANT_KEY, "symbol", "consequence", "cadd", "picked")


@witness("var_sv_pairs", f"WITH {PAIRS} SELECT * FROM pairs")
def _(v):
    return var.sv_pairs(v.cnvs).select("a_id", "b_id")


def _clusters(v):
    return var.sv_clusters(v.cnvs)


@witness("var_sv_clusters", f"WITH RECURSIVE {PAIRS}, {CLUSTERS} SELECT * FROM cl")
def _(v):
    return _clusters(v)


@witness("var_cluster_freq", f"WITH RECURSIVE {PAIRS}, {CLUSTERS}, {KIND} SELECT * FROM cf")
def _(v):
    return var.cluster_frequencies(v.cnvs, _clusters(v), v.clinical)


@witness("var_parental_origin", f"WITH {ORIGIN} SELECT * FROM org")
def _(v):
    return var.parental_origin(v.cnvs, v.clinical)


@witness("var_enrich_cnv", f"""
WITH RECURSIVE {PAIRS}, {CLUSTERS}, {KIND}, {ORIGIN}, {CNV_GENES},
cfm AS (SELECT cluster_id, max(pf) AS max_cluster_pf FROM cf GROUP BY cluster_id)
SELECT c.cnv_id, cg.n_genes, cl.cluster_id, cfm.max_cluster_pf, org.origin
FROM cnvs c LEFT JOIN cg USING (cnv_id) LEFT JOIN cl USING (cnv_id) LEFT JOIN cfm USING (cluster_id)
LEFT JOIN org USING (cnv_id)
""")
def _(v):
    clusters = _clusters(v)
    cf = var.cluster_frequencies(v.cnvs, clusters, v.clinical)
    e = var.enrich_cnv(v.cnvs, v.genes, clusters, cf, var.parental_origin(v.cnvs, v.clinical))
    return e.select("cnv_id", "n_genes", "cluster_id", "max_cluster_pf", "origin")


TUMOR = (f"tq AS (SELECT n.*, c.bioinfo_analysis_code AS code FROM n JOIN clinical c USING (sequencing_id) WHERE {QUAL}), "
         f"tagg AS (SELECT {K}, count(DISTINCT CASE WHEN code = 'TEBA' THEN sequencing_id END) AS to_pc, "
         f"count(DISTINCT CASE WHEN code = 'TNEBA' THEN sequencing_id END) AS tn_pc FROM tq GROUP BY {K}), "
         "ts AS (SELECT count(DISTINCT CASE WHEN bioinfo_analysis_code = 'TEBA' THEN sequencing_id END) AS to_pn, "
         "count(DISTINCT CASE WHEN bioinfo_analysis_code = 'TNEBA' THEN sequencing_id END) AS tn_pn FROM clinical), "
         f"tf AS (SELECT {K}, to_pc, to_pn, to_pc / nullif(to_pn, 0) AS to_pf, tn_pc, tn_pn, tn_pc / nullif(tn_pn, 0) AS tn_pf "
         "FROM tagg, ts WHERE to_pc > 0 OR tn_pc > 0)")
BLOCKS = (f"cm AS (SELECT {_PV} substr('ACGT', CAST((p_partkey + 3) % 4 + 1 AS INT), 1) AS alternate, "
          "p_size AS mutation_count, p_brand AS tier FROM part WHERE p_size % 3 = 0), "
          f"fk AS (SELECT {K}, max(CAST(ad_alt AS DOUBLE) / 7) AS score FROM occurrences WHERE alternate <> '*' GROUP BY {K})")


def document_parts(v, occ, donors, variants, cons):
    """The tables that variant documents are made of: donors, frequencies, tumor frequencies, consequences, blocks.
    From written tables: occurrences, their donors, distinct variants and consequences."""
    gene_scores = v.part.select(F.concat(F.lit("GENE"), F.col("p_partkey").cast("string")).alias("symbol"),
                                (F.col("p_retailprice") / 100).alias("cadd"))
    cosmic = _pv(v, 3).where(F.col("p_size") % 3 == 0).select(*var.VARIANT_KEY, F.col("p_size").alias("mutation_count"),
                                                              F.col("p_brand").alias("tier"))
    franklin = occ.where("alternate <> '*'").groupBy(*var.VARIANT_KEY).agg(
        F.max(F.col("ad_alt").cast("double") / 7).alias("score"))
    external = var.external_frequencies(variants, _sources(v)).select(
        *var.VARIANT_KEY, F.col("gnomad.af").alias("gnomad_af"), F.col("topmed.af").alias("topmed_af"))
    return {"donors": donors, "freqs": var.frequencies(donors, v.clinical, enriched=True),
            "tumor": var.tumor_frequencies(donors, v.clinical, enriched=True),
            "consequences": var.enrich_consequences(cons, gene_scores),
            "blocks": {"clinvar": _clinvar(v), "cmc": cosmic, "external_frequencies": external,
                       "exomiser_max": var.max_score(_scores(v, occ)), "franklin_max": franklin}}


PICKED = (f"pk AS (SELECT {K}, symbol, transcript, consequence, CAST(substr(symbol, 5) AS BIGINT) AS pkey, "
          f"row_number() OVER (PARTITION BY {K} ORDER BY CASE consequence WHEN 'missense_variant' THEN 1 "
          "WHEN 'synonymous_variant' THEN 2 WHEN 'intron_variant' THEN 3 END NULLS LAST, symbol, transcript) = 1 AS picked "
          "FROM cons)")


@witness("var_centric_variant", f"""
WITH {NORM}, {FREQ}, {TUMOR}, {DV}, {GENE_PAIRS}, {CONS}, {EXT}, {SCORES}, {BLOCKS}, {PICKED},
d AS (SELECT {K}, count(*) AS n_donors FROM n JOIN clinical USING (sequencing_id) GROUP BY {K}),
fc AS (SELECT {K}, string_agg(analysis_code || ':' || CAST(ac AS VARCHAR) || ':' || CAST(pc AS VARCHAR) || ':'
       || CAST(pn AS VARCHAR) || ':' || CAST(hom AS VARCHAR), ',' ORDER BY analysis_code) AS by_analysis
       FROM freq WHERE analysis_code <> 'all' GROUP BY {K}),
cc AS (SELECT {K}, count(*) AS n_consequences, string_agg(symbol || '/' || transcript || '/' || consequence, ','
       ORDER BY symbol, transcript) AS consequences, max(CASE WHEN picked THEN symbol END) AS picked,
       sum(ps.p_retailprice / 100) AS sum_cadd FROM pk LEFT JOIN part ps ON pk.pkey = ps.p_partkey GROUP BY {K})
SELECT d.*, f.ac, f.an, f.af, f.pc, f.pn, f.pf, f.hom, fc.by_analysis, tf.to_pc, tf.to_pn, tf.to_pf, tf.tn_pc, tf.tn_pn,
       tf.tn_pf, cc.n_consequences, cc.consequences, cc.picked, cc.sum_cadd, cv.clin_sig, cm.mutation_count, cm.tier,
       gn.af AS gnomad_af, tm.af AS topmed_af, ms.max_score, ms.max_sequencing_id, fk.score AS franklin_score
FROM d LEFT JOIN (SELECT * FROM freq WHERE analysis_code = 'all') f USING ({K}) LEFT JOIN fc USING ({K})
LEFT JOIN tf USING ({K}) LEFT JOIN cc USING ({K}) LEFT JOIN cv USING ({K}) LEFT JOIN cm USING ({K})
LEFT JOIN gn USING ({K}) LEFT JOIN tm USING ({K}) LEFT JOIN ms USING ({K}) LEFT JOIN fk USING ({K})
""")
def _(v):
    occ = cut_lineage(v.occurrences)
    variants = cut_lineage(var.distinct_variants(occ))
    donors = cut_lineage(var.variant_donors(var.enrich_snv(occ, v.clinical)))
    docs = var.variant_centric(**document_parts(v, occ, donors, variants, _cons(v, variants)))
    code = F.array_join(F.transform("frequencies_by_analysis", lambda x: F.concat_ws(
        ":", x["analysis_code"], x["ac"].cast("string"), x["pc"].cast("string"), x["pn"].cast("string"),
        x["hom"].cast("string"))), ",")
    cons = F.array_join(F.transform("consequences", lambda x: F.concat_ws("/", x["symbol"], x["transcript"],
                                                                           x["consequence"])), ",")
    return docs.select(
        *var.VARIANT_KEY, "n_donors", "frequency_RQDM.*", code.alias("by_analysis"), "freq_rqdm_tumor_only.*",
        "freq_rqdm_tumor_normal.*", F.when(F.col("consequences").isNotNull(), F.size("consequences")).cast("bigint").alias("n_consequences"),
        cons.alias("consequences"), F.filter("consequences", lambda x: x["picked"])[0]["symbol"].alias("picked"),
        F.aggregate(F.transform("consequences", lambda x: x["cadd"]), F.lit(0.0), lambda a, x: a + x).alias("sum_cadd"),
        "clinvar.clin_sig", "cmc.mutation_count", "cmc.tier", "external_frequencies.gnomad_af",
        "external_frequencies.topmed_af", "exomiser_max.max_score", "exomiser_max.max_sequencing_id",
        F.col("franklin_max.score").alias("franklin_score"))


@witness("var_centric_cnv", f"""
WITH {CNV_GENES} SELECT c.cnv_id, c.chromosome, c.type, cg.n_genes FROM cnvs c LEFT JOIN cg USING (cnv_id)
""")
def _(v):
    cnvs = v.cnvs
    g = (var.gene_overlap(cnvs.select("cnv_id", "chromosome", "start", "end"),
                          v.genes.select("symbol", "chromosome", "start", "end"))
         .groupBy("cnv_id").agg(F.count("*").alias("n_genes")))
    docs = var.cnv_centric(cnvs.join(g, "cnv_id", "left"))
    return docs.select("cnv_id", F.col("doc.chromosome").alias("chromosome"), F.col("doc.type").alias("type"),
                       F.col("doc.n_genes").alias("n_genes"))


@witness("var_centric_gene", f"""
WITH {DV}, {GENE_PAIRS}, {CONS}
SELECT g.symbol, g.chromosome, g.start, g."end", g.panel, coalesce(c.n, 0) AS n_variants FROM genes g
LEFT JOIN (SELECT symbol, count(*) AS n FROM cons GROUP BY symbol) c USING (symbol)
""")
def _(v):
    return var.gene_centric(v.genes, var.gene_variants(_cons(v)))


@witness("var_centric_coverage", f"""
WITH {COV} SELECT nc.symbol, nc.sample_id, g.chromosome, nc.depth FROM nc JOIN genes g USING (symbol)
""")
def _(v):
    d = var.coverage_by_gene_centric(var.normalize_coverage(_coverage(v)), v.genes)
    return d.select("symbol", "sample_id", F.col("doc.chromosome").alias("chromosome"), F.col("doc.depth").alias("depth"))


SUGGEST_GENE = ("SELECT symbol, symbol AS text, 5 AS weight FROM genes UNION ALL "
                "SELECT symbol, chromosome || ':' || CAST(start AS VARCHAR) || '-' || CAST(\"end\" AS VARCHAR), 3 FROM genes")


@witness("var_suggest_gene", f"""{SUGGEST_GENE}
UNION ALL SELECT symbol, 'ALIAS' || CAST(start % 50 AS VARCHAR), 4 FROM genes WHERE start % 3 <> 0
UNION ALL SELECT symbol, symbol || '-A', 4 FROM genes WHERE start % 3 <> 0
""")
def _(v):
    alias, again = F.concat(F.lit("ALIAS"), (F.col("start") % 50).cast("string")), F.concat("symbol", F.lit("-A"))
    aliases = F.when(F.col("start") % 3 != 0, F.array(alias, again, F.col("symbol"), F.lit(""), alias))
    return var.gene_suggestions(v.genes.withColumn("aliases", aliases))


@witness("var_suggest_variant", f"""
WITH {DV}, vid AS (SELECT chromosome || '-' || CAST(start AS VARCHAR) || '-' || reference || '-' || alternate AS variant_id,
                          chromosome || ':' || CAST(start AS VARCHAR) AS pos FROM v)
SELECT variant_id, variant_id AS text, 4 AS weight FROM vid UNION ALL SELECT variant_id, pos, 2 FROM vid
""")
def _(v):
    return var.variant_suggestions(_variants(v))


@witness("var_documents", f"""
SELECT symbol, text, CAST(weight AS BIGINT) AS weight, 're_001' AS release FROM ({SUGGEST_GENE})
""")
def _(v):
    path = scratch_dir(v.spark, "documents")
    write_documents(var.gene_suggestions(v.genes).withColumn("release", F.lit("re_001")), path)
    return v.spark.read.json(path).select("symbol", "text", "weight", "release")


@witness("var_hash", f"""
WITH {DV} SELECT {K}, sha1(concat(length(chromosome), ':', chromosome, length(CAST(start AS VARCHAR)), ':', start,
                              length(reference), ':', reference, length(alternate), ':', alternate)) AS hash FROM v
""")
def _(v):
    return _variants(v).select(*var.VARIANT_KEY, var.document_hash(var.VARIANT_KEY).alias("hash"))


GROUP = ["chr1", "chr2", "chr3", "chr4"]


@witness("var_overwrite", f"""
WITH {DV}
SELECT chromosome, CASE WHEN chromosome IN ('chr1', 'chr2', 'chr3', 'chr4') THEN 'v2' ELSE 'v1' END AS version,
       count(*) AS n_variants
FROM v GROUP BY 1, 2
""")
def _(v):
    path = scratch_dir(v.spark, "variants")
    dv = _variants(v)
    overwrite_partitions(dv.withColumn("version", F.lit("v1")), path)
    overwrite_partitions(dv.where(F.col("chromosome").isin(GROUP)).withColumn("version", F.lit("v2")), path)
    back = v.spark.read.parquet(path)
    return back.groupBy("chromosome", "version").agg(F.count("*").alias("n_variants"))


@witness("var_incremental", f"""
WITH {NORM}
SELECT c.analysis_id, CASE WHEN c.analysis_id IN (SELECT id FROM req_analyses) THEN 'v2' ELSE 'v1' END AS version,
       count(*) AS n_rows
FROM n JOIN clinical c USING (sequencing_id) GROUP BY 1, 2
""")
def _(v):
    path = scratch_dir(v.spark, "snv")
    var.incremental_load(v.spark, path, var.enrich_snv(v.occurrences, v.clinical).withColumn("version", F.lit("v1")), "initial")
    again = var.enrich_snv(v.occurrences, v.clinical, v.req_analyses).withColumn("version", F.lit("v2"))
    table = var.incremental_load(v.spark, path, again, "default")
    return table.groupBy("analysis_id", "version").agg(F.count("*").alias("n_rows"))
