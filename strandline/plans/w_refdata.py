"""Witnesses for reference tables, registry and file formats."""

from __future__ import annotations

from pyspark.sql import functions as F

from strandline.operators import refdata as ref
from strandline.operators import variants as var
from strandline.plans.registry import witness
from strandline.plans.w_variants import DV, FREQ, GENE_PAIRS, K, NORM
from strandline.session import scratch_dir
from strandline.sources import blockgzip, formats

VK = var.VARIANT_KEY
TRACK = r"track\((\d+)\)"
LINK = r'<a href="/([^"]+)">'


@witness("ref_version", f"""
SELECT page_id, regexp_extract(html, '{TRACK}', 1) AS v_first,
       regexp_extract_all(html, '{LINK}', 1)[-1] AS v_last,
       list_max(regexp_extract_all(html, '{LINK}', 1)) AS v_max
FROM pages
""")
def _(v):
    h = F.col("html")
    return v.pages.select("page_id", ref.extract_version(h, TRACK, "first").alias("v_first"),
                          ref.extract_version(h, LINK, "last").alias("v_last"),
                          ref.extract_version(h, LINK, "max").alias("v_max"))


@witness("ref_changed", """
WITH c AS (SELECT 'dag_' || CAST(p_partkey AS VARCHAR) AS dag_id, p_brand AS version FROM part WHERE p_partkey % 3 <> 0),
l AS (SELECT 'dag_' || CAST(p_partkey AS VARCHAR) AS dag_id, CASE WHEN p_size % 4 = 0 THEN 'Brand#99' ELSE p_brand END AS version
      FROM part)
SELECT l.dag_id, l.version AS latest_version, c.version AS current_version,
       NOT (c.version IS NOT DISTINCT FROM l.version) AS is_new
FROM l LEFT JOIN c USING (dag_id)
""")
def _(v):
    p = v.part
    dag = F.concat(F.lit("dag_"), F.col("p_partkey").cast("string")).alias("dag_id")
    cur = p.where(F.col("p_partkey") % 3 != 0).select(dag, F.col("p_brand").alias("version"))
    lat = p.select(dag, F.when(F.col("p_size") % 4 == 0, "Brand#99").otherwise(F.col("p_brand")).alias("version"))
    return ref.changed_versions(cur, lat)


@witness("ref_changed_md5", """
WITH s AS (SELECT doc_id AS file_id, CASE WHEN doc_id % 7 = 0 THEN md5(text || 'x') ELSE md5(text) END AS md5
           FROM documents WHERE doc_id % 4 <> 0)
SELECT d.doc_id AS file_id, md5(d.text) AS md5, s.md5 AS stored_md5,
       NOT (md5(d.text) IS NOT DISTINCT FROM s.md5) AS is_new
FROM documents d LEFT JOIN s ON d.doc_id = s.file_id
""")
def _(v):
    d = v.documents
    stored = d.where(F.col("doc_id") % 4 != 0).select(
        F.col("doc_id").alias("file_id"),
        F.when(F.col("doc_id") % 7 == 0, F.md5(F.concat("text", F.lit("x")))).otherwise(F.md5("text")).alias("md5"))
    content = d.select(F.col("doc_id").alias("file_id"), F.col("text").alias("content"))
    return ref.changed_checksums(stored, content)


@witness("ref_verify_md5", """
WITH m AS (SELECT doc_id, text, CASE WHEN doc_id % 9 = 0 THEN md5(lang) ELSE md5(text) END || '  doc.txt' AS md5_text
           FROM documents)
SELECT doc_id, regexp_extract(md5_text, '^([0-9a-f]+)', 1) = md5(text) AS ok,
       CASE WHEN regexp_extract(md5_text, '^([0-9a-f]+)', 1) <> md5(text) THEN
            'MD5 checksum verification failed, expected ' || regexp_extract(md5_text, '^([0-9a-f]+)', 1) ||
            ' but got ' || md5(text) END AS error
FROM m
""")
def _(v):
    d = v.documents
    md5_text = F.concat(F.when(F.col("doc_id") % 9 == 0, F.md5("lang")).otherwise(F.md5("text")), F.lit("  doc.txt"))
    ok, err = ref.verify_checksum(F.col("text"), md5_text)
    return d.select("doc_id", ok.alias("ok"), err.alias("error"))


@witness("ref_keyed_version", """
SELECT p_partkey, 'gnomad' AS key, p_brand AS value FROM part
UNION ALL SELECT p_partkey, 'topmed', 'v' || CAST(p_size AS VARCHAR) FROM part
UNION ALL SELECT p_partkey, 'dbsnp', 'b' || CAST(p_size % 5 AS VARCHAR) FROM part
""")
def _(v):
    p = v.part
    m = F.create_map(F.lit("gnomad"), F.col("p_brand"), F.lit("topmed"),
                     F.split_part("p_type", F.lit(" "), F.lit(1)))
    m = ref.merge_keyed_version(m, "topmed", F.concat(F.lit("v"), F.col("p_size").cast("string")))
    m = ref.merge_keyed_version(m, "dbsnp", F.concat(F.lit("b"), (F.col("p_size") % 5).cast("string")))
    return p.select("p_partkey", F.explode(m).alias("key", "value"))


_REG = ("r AS (SELECT 'import_' || CAST(s_suppkey AS VARCHAR) AS dag_id, s_name AS source, "
        "'https://old/' || CAST(s_suppkey AS VARCHAR) AS url, 'v1' AS version, '2024-01-01T00:00:00' AS last_update, "
        "'@weekly' AS frequency FROM supplier WHERE s_suppkey % 3 <> 0), "
        "i AS (SELECT 'import_' || CAST(s_suppkey AS VARCHAR) AS dag_id, upper(s_name) AS source, "
        "'https://new/' || CAST(s_suppkey AS VARCHAR) AS url, CAST(NULL AS VARCHAR) AS version, "
        "CAST(NULL AS VARCHAR) AS last_update, CASE WHEN s_nationkey % 2 = 0 THEN '@daily' END AS frequency "
        "FROM supplier WHERE s_suppkey % 2 = 0), "
        "d AS (SELECT 'import_' || CAST(s_suppkey AS VARCHAR) AS dag_id, "
        "CASE WHEN s_suppkey % 10 = 0 THEN '' ELSE 'v' || CAST(s_nationkey AS VARCHAR) END AS version, "
        "'2024-06-01T00:00:00' AS last_update, CASE WHEN s_nationkey % 3 = 0 THEN NULL ELSE '@monthly' END AS frequency "
        "FROM supplier WHERE s_suppkey % 5 = 0)")


@witness("ref_upsert", f"""
WITH {_REG},
reg AS (SELECT coalesce(r.dag_id, i.dag_id) AS dag_id,
               CASE WHEN i.dag_id IS NOT NULL THEN i.source ELSE r.source END AS source,
               CASE WHEN i.dag_id IS NOT NULL THEN i.url ELSE r.url END AS url,
               CASE WHEN r.dag_id IS NOT NULL THEN r.version ELSE i.version END AS version,
               CASE WHEN r.dag_id IS NOT NULL THEN r.last_update ELSE i.last_update END AS last_update,
               CASE WHEN i.dag_id IS NOT NULL THEN i.frequency ELSE r.frequency END AS frequency
        FROM r FULL OUTER JOIN i ON r.dag_id = i.dag_id)
SELECT reg.dag_id, reg.source, reg.url,
       CASE WHEN d.dag_id IS NOT NULL AND coalesce(length(d.version), 0) > 0 THEN d.version ELSE reg.version END AS version,
       CASE WHEN d.dag_id IS NOT NULL THEN d.last_update ELSE reg.last_update END AS last_update,
       CASE WHEN d.dag_id IS NOT NULL THEN coalesce(d.frequency, '') ELSE reg.frequency END AS frequency
FROM reg LEFT JOIN d ON reg.dag_id = d.dag_id
""")
def _(v):
    s = v.supplier
    dag = F.concat(F.lit("import_"), F.col("s_suppkey").cast("string")).alias("dag_id")
    registry = s.where(F.col("s_suppkey") % 3 != 0).select(
        dag, F.col("s_name").alias("source"), F.concat(F.lit("https://old/"), F.col("s_suppkey").cast("string"))
        .alias("url"), F.lit("v1").alias("version"), F.lit("2024-01-01T00:00:00").alias("last_update"),
        F.lit("@weekly").alias("frequency"))
    info = s.where(F.col("s_suppkey") % 2 == 0).select(
        dag, F.upper("s_name").alias("source"), F.concat(F.lit("https://new/"), F.col("s_suppkey").cast("string"))
        .alias("url"), F.lit(None).cast("string").alias("version"), F.lit(None).cast("string").alias("last_update"),
        F.when(F.col("s_nationkey") % 2 == 0, "@daily").alias("frequency"))
    done = s.where(F.col("s_suppkey") % 5 == 0).select(
        dag, F.when(F.col("s_suppkey") % 10 == 0, "").otherwise(F.concat(F.lit("v"), F.col("s_nationkey")
                                                                         .cast("string"))).alias("version"),
        F.lit("2024-06-01T00:00:00").alias("last_update"),
        F.when(F.col("s_nationkey") % 3 != 0, "@monthly").alias("frequency"))
    return ref.upsert_registry(registry, info, done)


@witness("ref_last_success", """
WITH runs AS (SELECT 'source_' || CAST(user_id % 10 AS VARCHAR) AS source,
                     CASE WHEN event_type = 'purchase' THEN 'success' ELSE 'failed' END AS state, ts AS end_date FROM events),
a AS (SELECT source, max(CASE WHEN state = 'success' THEN end_date END) AS m FROM runs GROUP BY source)
SELECT s.source, strftime(a.m, '%Y-%m-%d %H:%M:%S.%f') AS last_success
FROM (SELECT 'source_' || CAST(n_nationkey AS VARCHAR) AS source FROM nation) s LEFT JOIN a USING (source)
""")
def _(v):
    runs = v.events.select(F.concat(F.lit("source_"), (F.col("user_id") % 10).cast("string")).alias("source"),
                           F.when(F.col("event_type") == "purchase", "success").otherwise("failed").alias("state"),
                           F.col("ts").alias("end_date"))
    sources = v.nation.select(F.concat(F.lit("source_"), F.col("n_nationkey").cast("string")).alias("source"))
    out = ref.last_success(runs, sources)
    return out.select("source", F.date_format("last_success", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("last_success"))


@witness("imp_vcf", f"""
WITH c AS (SELECT {K}, count(*) AS c FROM occurrences WHERE alternate <> '*' GROUP BY {K})
SELECT chromosome, CAST(start AS BIGINT) AS start, reference, alternate,
       CAST(sum(c) OVER w AS BIGINT) AS dp, count(*) OVER w AS nalt, c AS ac, 2 * c AS ad
FROM c WINDOW w AS (PARTITION BY chromosome, start, reference)
""")
def _(v):
    o = v.occurrences.where(F.col("alternate") != "*")
    per_alt = o.groupBy(*VK).agg(F.count("*").alias("c"))
    sites = per_alt.groupBy("chromosome", "start", "reference").agg(
        F.sort_array(F.collect_list(F.struct("alternate", "c"))).alias("alts"),
        F.sum("c").alias("dp"), F.count("*").alias("nalt"))
    counts = F.transform("alts.c", lambda c: c.cast("string"))
    doubled = F.transform("alts.c", lambda c: (c * 2).cast("string"))
    rec = sites.select("chromosome", "start", F.lit(None).cast("string").alias("id"), "reference",
                       F.array_join("alts.alternate", ",").alias("alternates"),
                       F.lit(None).cast("string").alias("qual"), F.lit("PASS").alias("filter"),
                       F.concat(F.lit("DP="), F.col("dp").cast("string"), F.lit(";NALT="),
                                F.col("nalt").cast("string"), F.lit(";AC="), F.array_join(counts, ","),
                                F.lit(";AD=0,"), F.array_join(doubled, ",")).alias("info"))
    path = scratch_dir(v.spark, "vcf")
    formats.write_vcf(rec, path)
    return ref.import_vcf(v.spark, path, "sites").select(*VK, "dp", "nalt", "ac", "ad")


@witness("imp_tsv", """
SELECT chromosome AS chr, start AS position_1_based, symbol,
       CASE WHEN start % 7 = 0 THEN NULL ELSE ("end" - start) / 10 END AS score
FROM genes
""")
def _(v):
    g = v.genes
    out = g.select(F.col("chromosome").alias("#chr"), F.col("start").alias("pos(1-based)"), "symbol",
                   F.when(F.col("start") % 7 != 0, (F.col("end") - F.col("start")) / 10).alias("score"))
    path = scratch_dir(v.spark, "tsv")
    out.write.mode("overwrite").option("header", True).option("sep", "\t").option("nullValue", ".").csv(path)
    t = ref.import_dbnsfp(v.spark, path, ["score"])
    return t.select("chr", F.col("`position_1-based`").cast("bigint").alias("position_1_based"), "symbol", "score")


@witness("imp_gnomad_constraint", """
SELECT symbol, chromosome, pli, oe_lof, mis_z, CASE WHEN start % 11 = 3 THEN 'pLI:' || CAST(start AS VARCHAR) || ';0' END AS rejected
FROM (SELECT *, CASE WHEN start % 7 <> 0 AND start % 11 <> 3 THEN CAST(start % 100 AS DOUBLE) / 128 END AS pli,
             CAST("end" - start AS DOUBLE) / 64 AS oe_lof, CASE WHEN start % 5 <> 0 THEN -CAST(start % 10 AS DOUBLE) END AS mis_z FROM genes)
""")
def _(v):
    g = v.genes.select(
        "symbol", "chromosome",
        F.when(F.col("start") % 11 == 3, F.concat(F.col("start").cast("string"), F.lit(";0"))).when(
            F.col("start") % 7 != 0, ((F.col("start") % 100).cast("double") / 128).cast("string")).alias("pLI"),
        ((F.col("end") - F.col("start")).cast("double") / 64).alias("oe_lof"),
        F.when(F.col("start") % 5 != 0, -(F.col("start") % 10).cast("double")).alias("mis_z"))
    path = scratch_dir(v.spark, "constraint")
    blockgzip.write_lines(g.select(blockgzip.delimited_line(g.columns, null_value="NA").alias("value")), path, "\t".join(g.columns))
    t = ref.import_gnomad_constraint(v.spark, path, block_gzip=True)
    bad = ref.constraint_rejects(v.spark, path, ["symbol"], block_gzip=True).select(
        "symbol", F.concat("field", F.lit(":"), "value").alias("rejected"))
    return t.join(bad, "symbol", "left").select("symbol", "chromosome", F.col("pLI").alias("pli"), "oe_lof", "mis_z", "rejected")


@witness("imp_csv", """
SELECT c_custkey AS custkey, c_name AS name, n_name AS nation, r_name AS region
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
""")
def _(v):
    nr = v.nation.join(v.region, F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", "n_name", "r_name")
    c = v.customer.join(F.broadcast(nr), F.col("c_nationkey") == F.col("n_nationkey"))  # 25 fixed rows
    out = c.select(F.col("c_custkey").alias("custkey"), F.col("c_name").alias("name"), F.col("n_name").alias("nation"),
                   F.col("r_name").alias("region"))
    path = scratch_dir(v.spark, "csv")
    out.write.mode("overwrite").option("header", True).csv(path)
    back = formats.read_csv(v.spark, path)
    return back.select(F.col("custkey").cast("bigint").alias("custkey"), "name", "nation", "region")


@witness("imp_xml", """
SELECT c_custkey AS orpha_code, c_name AS name, n_name AS nation FROM customer JOIN nation ON c_nationkey = n_nationkey
""")
def _(v):
    c = v.customer.join(F.broadcast(v.nation), F.col("c_nationkey") == F.col("n_nationkey"))
    out = c.select(F.col("c_custkey").alias("OrphaCode"), F.col("c_name").alias("Name"), F.col("n_name").alias("Nation"))
    path = scratch_dir(v.spark, "xml")
    formats.write_xml(out, path, "JDBOR", "Disorder")
    back = ref.import_orphanet(v.spark, path)
    return back.select(F.col("OrphaCode").cast("bigint").alias("orpha_code"), F.col("Name").alias("name"),
                       F.col("Nation").alias("nation"))


@witness("imp_orphanet", """
WITH g AS (SELECT p_partkey % 300 AS orpha_code, 'GENE' || p_partkey AS symbol, p_name AS gene_name,
                  CASE WHEN p_size % 2 = 0 THEN 'Disease-causing' ELSE 'Candidate' END AS association_type,
                  CASE WHEN p_size % 5 <> 0 THEN 'Assessed' END AS association_status FROM part)
SELECT g.orpha_code, 'Disorder ' || g.orpha_code AS disorder, symbol, gene_name, association_type, association_status,
       CASE WHEN g.orpha_code % 3 <> 0 THEN CASE WHEN g.orpha_code % 2 = 0 THEN 'Infancy|Adult' ELSE 'Childhood' END END AS ages,
       CASE WHEN g.orpha_code % 3 <> 0 THEN 'Autosomal ' || (g.orpha_code % 4) END AS inheritance
FROM g
""")
def _(v):
    name = lambda c: F.struct(c.alias("Name"))
    code = (F.col("p_partkey") % 300).alias("OrphaCode")
    association = F.struct(
        F.struct(F.concat(F.lit("GENE"), F.col("p_partkey").cast("string")).alias("Symbol"), F.col("p_name").alias("Name")).alias("Gene"),
        name(F.when(F.col("p_size") % 2 == 0, "Disease-causing").otherwise("Candidate")).alias("DisorderGeneAssociationType"),
        F.when(F.col("p_size") % 5 != 0, name(F.lit("Assessed"))).alias("DisorderGeneAssociationStatus"))
    genes = v.part.groupBy(code).agg(F.struct(F.collect_list(association).alias("DisorderGeneAssociation"))
                                     .alias("DisorderGeneAssociationList")).withColumn(
        "Name", F.concat(F.lit("Disorder "), F.col("OrphaCode").cast("string")))
    onset = F.when(F.col("OrphaCode") % 2 == 0, F.array(name(F.lit("Infancy")), name(F.lit("Adult")))).otherwise(
        F.array(name(F.lit("Childhood"))))
    ages = genes.where("OrphaCode % 3 <> 0").select(
        "OrphaCode", "Name", F.struct(onset.alias("AverageAgeOfOnset")).alias("AverageAgeOfOnsetList"),
        F.struct(F.array(name(F.concat(F.lit("Autosomal "), (F.col("OrphaCode") % 4).cast("string")))).alias("TypeOfInheritance"))
        .alias("TypeOfInheritanceList"))
    paths = [scratch_dir(v.spark, f"orphanet-{x}") for x in ("genes", "ages")]
    for df, path in zip((genes, ages), paths):
        formats.write_xml(df, path, "DisorderList", "Disorder")
    out = ref.import_orphanet(v.spark, *paths)
    return out.select("orpha_code", "disorder", "symbol", "gene_name", "association_type", "association_status",
                      F.array_join("average_age_of_onset", "|").alias("ages"), F.array_join("type_of_inheritance", "|").alias("inheritance"))


@witness("imp_gff", """
SELECT 'gene:' || symbol AS feature_id, symbol AS name, chromosome AS seqid, start, "end", panel FROM genes
""")
def _(v):
    g = v.genes
    attrs = formats.gff3_attributes([("ID", F.concat(F.lit("gene:"), F.col("symbol"))), ("Name", F.col("symbol")),
                                     ("panel", F.col("panel"))])
    rows = g.select(F.col("chromosome").alias("seqid"), F.lit("strandline").alias("source"), F.lit("gene").alias("type"),
                    "start", "end", F.lit(None).cast("string").alias("score"), F.lit("+").alias("strand"),
                    F.lit(None).cast("string").alias("phase"), attrs.alias("attributes"))
    path = scratch_dir(v.spark, "gff")
    formats.write_gff3(rows, path)
    back = ref.import_refseq_annotation(v.spark, path)
    return back.select("feature_id", "name", "seqid", "start", "end", F.col("attributes")["panel"].alias("panel"))


def _tree(v):
    regions = v.region.select(F.concat(F.lit("R:"), F.col("r_regionkey").cast("string")).alias("id"),
                              F.col("r_name").alias("name"), F.array().cast("array<string>").alias("parents"))
    nations = v.nation.select(F.concat(F.lit("N:"), F.col("n_nationkey").cast("string")).alias("id"),
                              F.col("n_name").alias("name"),
                              F.array(F.concat(F.lit("R:"), F.col("n_regionkey").cast("string"))).alias("parents"))
    customers = v.customer.select(F.concat(F.lit("C:"), F.col("c_custkey").cast("string")).alias("id"),
                                  F.col("c_name").alias("name"),
                                  F.array(F.concat(F.lit("N:"), F.col("c_nationkey").cast("string"))).alias("parents"))
    return regions.unionByName(nations).unionByName(customers)


def _terms(v):
    path = scratch_dir(v.spark, "obo")
    formats.write_obo(_tree(v), path)
    return ref.import_terms(v.spark, path)


TREE_SQL = ("SELECT 'R:' || CAST(r_regionkey AS VARCHAR) AS id, r_name AS name, NULL AS parent FROM region "
            "UNION ALL SELECT 'N:' || CAST(n_nationkey AS VARCHAR), n_name, 'R:' || CAST(n_regionkey AS VARCHAR) FROM nation "
            "UNION ALL SELECT 'C:' || CAST(c_custkey AS VARCHAR), c_name, 'N:' || CAST(c_nationkey AS VARCHAR) FROM customer")


@witness("imp_obo", TREE_SQL)
def _(v):
    return _terms(v).select("id", "name", F.explode_outer("parents").alias("parent"))


@witness("ref_ancestors", """
SELECT 'N:' || CAST(n_nationkey AS VARCHAR) AS term_id, 'R:' || CAST(n_regionkey AS VARCHAR) AS ancestor_id, 1 AS distance FROM nation
UNION ALL SELECT 'C:' || CAST(c_custkey AS VARCHAR), 'N:' || CAST(c_nationkey AS VARCHAR), 1 FROM customer
UNION ALL SELECT 'C:' || CAST(c_custkey AS VARCHAR), 'R:' || CAST(n_regionkey AS VARCHAR), 2
          FROM customer JOIN nation ON c_nationkey = n_nationkey
""")
def _(v):
    return ref.term_ancestors(_terms(v))


HPO = "'HP:' || lpad(CAST(l_orderkey % 500 AS VARCHAR), 7, '0')"


@witness("ref_genes", f"""
WITH h AS (SELECT 'GENE' || CAST(l_partkey AS VARCHAR) AS symbol, count(DISTINCT {HPO}) AS n, min({HPO}) AS f
           FROM lineitem GROUP BY 1),
o AS (SELECT 'GENE' || CAST(p_partkey AS VARCHAR) AS symbol, 'OMIM:' || CAST(p_partkey * 3 AS VARCHAR) AS omim
      FROM part WHERE p_size > 40)
SELECT g.symbol, coalesce(h.n, 0) AS n_hpo, h.f AS first_hpo, o.omim
FROM genes g LEFT JOIN h USING (symbol) LEFT JOIN o USING (symbol)
""")
def _(v):
    hpo = v.lineitem.select(F.concat(F.lit("GENE"), F.col("l_partkey").cast("string")).alias("symbol"),
                            F.concat(F.lit("HP:"), F.lpad((F.col("l_orderkey") % 500).cast("string"), 7, "0"))
                            .alias("term"))
    omim = v.part.where(F.col("p_size") > 40).select(
        F.concat(F.lit("GENE"), F.col("p_partkey").cast("string")).alias("symbol"),
        F.concat(F.lit("OMIM:"), (F.col("p_partkey") * 3).cast("string")).alias("term"))
    g = ref.build_genes(v.genes.select("symbol"), {"hpo": hpo, "omim": omim})
    return g.select("symbol", F.when(F.col("hpo").isNull(), 0).otherwise(F.size("hpo")).cast("bigint").alias("n_hpo"),
                    F.get("hpo", 0).alias("first_hpo"), F.array_join("omim", ",").alias("omim"))


@witness("ref_panels", """
SELECT 'GENE' || CAST(l_partkey AS VARCHAR) AS symbol,
       array_to_string(list_sort(list(DISTINCT 'PANEL' || CAST(l_suppkey % 7 AS VARCHAR))), ',') AS panels
FROM lineitem GROUP BY 1
""")
def _(v):
    rows = v.lineitem.select(F.concat(F.lit("GENE"), F.col("l_partkey").cast("string")).alias("symbol"),
                             F.concat(F.lit("PANEL"), (F.col("l_suppkey") % 7).cast("string")).alias("panel"))
    return ref.normalize_panels(rows).select("symbol", F.array_join("panels", ",").alias("panels"))


@witness("ref_rare", f"WITH {NORM}, {FREQ} SELECT {K}, af FROM freq WHERE analysis_code = 'all' AND af <= 0.001")
def _(v):
    f = var.frequencies(v.occurrences, v.clinical).where(F.col("analysis_code") == "all")
    return ref.rare_variants(f, 0.001).select(*VK, "af")


def _ds(expr: str) -> str:
    return f"CAST('0.' || lpad(CAST({expr} AS VARCHAR), 2, '0') AS DOUBLE)"


@witness("ref_spliceai_max", f"""
WITH {DV}, {GENE_PAIRS},
s AS (SELECT {K}, symbol, {_ds('start % 100')} AS ag, {_ds('start % 37')} AS al,
             {_ds('(start + length(symbol)) % 100')} AS dg, {_ds('(start * 3) % 100')} AS dl FROM gp)
SELECT {K}, symbol, greatest(ag, al, dg, dl) AS max_ds,
       CASE WHEN ag >= greatest(al, dg, dl) THEN 'AG' WHEN al >= greatest(dg, dl) THEN 'AL'
            WHEN dg >= dl THEN 'DG' ELSE 'DL' END AS max_type
FROM s
""")
def _(v):
    pairs = var.gene_overlap(var.variant_intervals(var.distinct_variants(v.occurrences)),
                             v.genes.select("symbol", "chromosome", "start", "end"))

    def ds(c):
        return F.concat(F.lit("0."), F.lpad(c.cast("string"), 2, "0"))

    st = F.col("start")
    ann = F.concat_ws("|", "alternate", "symbol", ds(st % 100), ds(st % 37), ds((st + F.length("symbol")) % 100),
                      ds((st * 3) % 100))
    rec = pairs.groupBy(*VK).agg(F.array_join(F.sort_array(F.collect_list(ann)), ",").alias("ann"))
    rows = rec.select("chromosome", "start", F.lit(None).cast("string").alias("id"), "reference",
                      F.col("alternate").alias("alternates"), F.lit(None).cast("string").alias("qual"),
                      F.lit("PASS").alias("filter"), F.concat(F.lit("SpliceAI="), "ann").alias("info"))
    path = scratch_dir(v.spark, "spliceai")
    formats.write_vcf(rows, path)
    return ref.enrich_spliceai(ref.import_spliceai(v.spark, path))
