"""Public reference tables: version detection, registry, importers (column
specs over the format readers), ontology closure and gene-level builders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.session import cut_lineage
from strandline.sources import blockgzip, formats

VARIANT_KEY = ["chromosome", "start", "reference", "alternate"]


# --- versions and registry ------------------------------------------------

def extract_version(text: Column, pattern: str, pick: str = "first") -> Column:
    """Version string out of a page: ``first`` (group 1 of the first match),
    ``last`` (last match) or ``max`` (lexicographic max of all matches)."""
    if pick == "first":
        return F.regexp_extract(text, pattern, 1)
    matches = F.regexp_extract_all(text, F.lit(pattern), 1)
    if pick == "last":
        return F.try_element_at(matches, F.lit(-1))
    if pick == "max":
        return F.array_max(matches)
    raise ValueError(pick)


def changed_versions(current: DataFrame, latest: DataFrame, key: str = "dag_id") -> DataFrame:
    """Per source: current and latest version; new when they differ (a missing
    current version counts as new)."""
    c = current.select(key, F.col("version").alias("current_version"))
    l = latest.select(key, F.col("version").alias("latest_version"))
    j = l.join(c, key, "left")
    return j.withColumn("is_new", ~F.col("current_version").eqNullSafe(F.col("latest_version")))


def changed_checksums(stored: DataFrame, content: DataFrame, key: str = "file_id",
                      content_col: str = "content") -> DataFrame:
    """New when the MD5 of the content differs from the stored one."""
    now = content.select(key, F.md5(F.col(content_col)).alias("md5"))
    j = now.join(stored.select(key, F.col("md5").alias("stored_md5")), key, "left")
    return j.select(key, "md5", "stored_md5", (~F.col("md5").eqNullSafe(F.col("stored_md5"))).alias("is_new"))


def verify_checksum(content: Column, md5_text: Column) -> tuple[Column, Column]:
    """(ok, error): the leading hex of the .md5 text must equal the MD5 of the
    content."""
    expected = F.regexp_extract(md5_text, r"^([0-9a-f]+)", 1)
    actual = F.md5(content)
    ok = expected == actual
    err = F.when(~ok, F.concat(F.lit("MD5 checksum verification failed, expected "), expected,
                               F.lit(" but got "), actual))
    return ok, err


def merge_keyed_version(versions: Column, key: Column | str, value: Column) -> Column:
    """Upsert ``key -> value`` into a map<string,string> of versions."""
    k = F.lit(key) if isinstance(key, str) else key
    kept = F.map_filter(F.coalesce(versions, F.create_map().cast("map<string,string>")), lambda kk, vv: kk != k)
    return F.map_concat(kept, F.create_map(k, value))


REGISTRY_COLUMNS = ["dag_id", "source", "url", "version", "last_update", "frequency"]


def register_sources(registry: DataFrame, info: DataFrame) -> DataFrame:
    """Existing ids: overwrite source, url, frequency (keep version, last
    update); new ids: appended as given."""
    r = registry.select(*[F.col(c).alias(f"r_{c}") for c in REGISTRY_COLUMNS])
    i = info.select(*[F.col(c).alias(f"i_{c}") for c in REGISTRY_COLUMNS])
    j = r.join(i, F.col("r_dag_id") == F.col("i_dag_id"), "full_outer")
    exists = F.col("r_dag_id").isNotNull()
    has_info = F.col("i_dag_id").isNotNull()

    def pick(c: str, overwrite: bool) -> Column:
        if overwrite:
            return F.when(has_info, F.col(f"i_{c}")).otherwise(F.col(f"r_{c}")).alias(c)
        return F.when(exists, F.col(f"r_{c}")).otherwise(F.col(f"i_{c}")).alias(c)

    return j.select(F.coalesce("r_dag_id", "i_dag_id").alias("dag_id"), pick("source", True), pick("url", True),
                    pick("version", False), pick("last_update", False), pick("frequency", True))


def complete_sources(registry: DataFrame, done: DataFrame) -> tuple[DataFrame, DataFrame]:
    """After an import: last update, version (only if non-empty) and frequency
    ('' if none). ``done``: (dag_id, version, last_update, frequency). Returns
    (registry, errors for unknown ids)."""
    d = done.select(F.col("dag_id"), F.col("version").alias("d_version"), F.col("last_update").alias("d_update"),
                    F.col("frequency").alias("d_frequency"), F.lit(True).alias("_done"))
    j = registry.join(d, "dag_id", "left")
    done_row = F.coalesce(F.col("_done"), F.lit(False))
    out = j.select(
        "dag_id", "source", "url",
        F.when(done_row & (F.coalesce(F.length("d_version"), F.lit(0)) > 0), F.col("d_version"))
        .otherwise(F.col("version")).alias("version"),
        F.when(done_row, F.col("d_update")).otherwise(F.col("last_update")).alias("last_update"),
        F.when(done_row, F.coalesce("d_frequency", F.lit(""))).otherwise(F.col("frequency")).alias("frequency"))
    errors = done.join(registry.select("dag_id"), "dag_id", "left_anti").select(
        "dag_id", F.concat(F.lit("PublicSource entry '"), F.col("dag_id"), F.lit("' not found")).alias("error"))
    return out, errors


def upsert_registry(registry: DataFrame, info: DataFrame, done: DataFrame) -> DataFrame:
    reg = register_sources(registry, info)
    out, _ = complete_sources(reg, done)
    return out


def last_success(runs: DataFrame, sources: DataFrame | None = None, key: str = "source") -> DataFrame:
    """End time of the last successful run per source (NULL when none)."""
    agg = runs.groupBy(key).agg(F.max(F.when(F.col("state") == "success", F.col("end_date"))).alias("last_success"))
    if sources is None:
        return agg
    return sources.select(key).join(agg, key, "left")


# --- importers: column specs over the format readers ----------------------

VCF_SPECS: dict[str, list[tuple[str, str, str, str]]] = {
    # importer -> [(INFO key, column, type, values: 1 a record, A an alternate)]  (bodies are external jobs: chosen specs)
    "1000_genomes": [("AC", "ac", "int", "A"), ("AF", "af", "double", "A"), ("AN", "an", "int", "1")],
    "clinvar": [("CLNSIG", "clin_sig", "string", "1"), ("GENEINFO", "gene_info", "string", "1")],
    "dbsnp": [("RS", "rs", "string", "1")],
    "gnomad_joint": [("AC_joint", "ac", "int", "A"), ("AN_joint", "an", "int", "1"), ("AF_joint", "af", "double", "A")],
    "gnomad_cnv": [("SVTYPE", "sv_type", "string", "1"), ("END", "end", "bigint", "1"), ("SF", "sf", "double", "A")],
    "gnomad_sv": [("SVTYPE", "sv_type", "string", "1"), ("END", "end", "bigint", "1"), ("AF", "af", "double", "A")],
    "topmed": [("AC", "ac", "int", "A"), ("AF", "af", "double", "A"), ("HOM", "hom", "int", "A")],
    "spliceai": [("SpliceAI", "spliceai", "string", "1")],
    "sites": [("DP", "dp", "bigint", "1"), ("NALT", "nalt", "bigint", "1"), ("AC", "ac", "bigint", "A"),
              ("AD", "ad", "bigint", "R")],
}


def import_vcf(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """One row per (record, alternate); values per alternate are those of the row's own."""
    v = formats.read_vcf(spark, path)
    return v.select(*VARIANT_KEY, "id", "qual", "filters",
                    *[formats.info_field(k, t, n).alias(c) for k, c, t, n in VCF_SPECS[kind]])


def vcf_rejects(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """INFO values of a file that the importer's types do not take."""
    return formats.info_rejects(formats.read_vcf(spark, path), VCF_SPECS[kind])


def import_1000_genomes(spark, path): return import_vcf(spark, path, "1000_genomes")
def import_clinvar(spark, path): return import_vcf(spark, path, "clinvar")
def chromosome_name(contig: Column) -> Column:
    """``chr*`` name of a RefSeq chromosome accession (NC_000001 to NC_000024, NC_012920 the mitochondrion); any
    other contig keeps its name."""
    number = F.regexp_extract(contig, r"^NC_0000(\d\d)\.\d+$", 1).try_cast("int")
    name = F.when(number == 23, "X").when(number == 24, "Y").when(number.between(1, 22), number.cast("string"))
    return (F.when(name.isNotNull(), F.concat(F.lit("chr"), name))
            .when(contig.rlike(r"^NC_012920\.\d+$"), "chrM").otherwise(contig))


def import_dbsnp(spark, path):
    return import_vcf(spark, path, "dbsnp").withColumn("chromosome", chromosome_name(F.col("chromosome")))


def import_gnomad_joint(spark, path): return import_vcf(spark, path, "gnomad_joint")
def import_gnomad_cnv(spark, path): return import_vcf(spark, path, "gnomad_cnv")
def import_gnomad_sv(spark, path): return import_vcf(spark, path, "gnomad_sv")
def import_topmed(spark, path): return import_vcf(spark, path, "topmed")


SPLICEAI_TYPES = ["AG", "AL", "DG", "DL"]
SPLICEAI_FIELDS = ["allele", "symbol", *[f"{p}_{t.lower()}" for p in ("ds", "dp") for t in SPLICEAI_TYPES]]
SPLICEAI_KINDS = ("snv", "indel")


def spliceai_kind(reference: Column, alternate: Column) -> Column:
    """``snv`` for one base against another, ``indel`` for anything else."""
    return F.when((F.length(reference) == 1) & (F.length(alternate) == 1), "snv").otherwise("indel")


def import_spliceai(spark: SparkSession, path: str, kind: str | None = None) -> DataFrame:
    """One row per (variant, SpliceAI annotation): allele, symbol, delta scores and delta positions (positions are NULL where the
    annotation ends after the scores), and the variant's kind. The source has a file for each ``kind``; with it, variants of
    the other kind are left out."""
    if kind is not None and kind not in SPLICEAI_KINDS:
        raise ValueError(kind)
    v = import_vcf(spark, path, "spliceai")
    of = spliceai_kind(F.col("reference"), F.col("alternate"))
    v = v if kind is None else v.where(of == kind)
    ann = v.select(*VARIANT_KEY, F.explode(F.split("spliceai", ",")).alias("_a"))
    parts = F.split("_a", r"\|")
    types = {"ds": "double", "dp": "int"}
    cols = [F.get(parts, F.lit(i)).try_cast(types.get(n[:2], "string")).alias(n) for i, n in enumerate(SPLICEAI_FIELDS)]
    return ann.select(*VARIANT_KEY, of.alias("kind"), *cols).where(F.col("allele") == F.col("alternate"))


def enrich_spliceai(spliceai: DataFrame) -> DataFrame:
    """Per variant x gene: the max delta score and its type (first in
    AG, AL, DG, DL order on ties)."""
    scores = F.array(*[F.struct(F.col(f"ds_{t.lower()}").alias("ds"), F.lit(-i).alias("o"), F.lit(t).alias("type"))
                       for i, t in enumerate(SPLICEAI_TYPES)])
    best = spliceai.select(*VARIANT_KEY, "symbol", F.array_max(scores).alias("_b"))
    agg = best.groupBy(*VARIANT_KEY, "symbol").agg(F.max("_b").alias("_b"))
    return agg.select(*VARIANT_KEY, "symbol", F.col("_b.ds").alias("max_ds"), F.col("_b.type").alias("max_type"))


def import_dbnsfp(spark: SparkSession, path: str, numeric: list[str]) -> DataFrame:
    """dbNSFP rows with the ``numeric`` columns as numbers; values that are none (lists by transcript, for instance) are
    NULL here and rows of :func:`typed_rejects`."""
    return _typed(formats.read_tsv(spark, path), numeric)


def import_dbnsfp_raw(spark: SparkSession, path: str) -> DataFrame:
    """Per-chromosome dbNSFP TSV as text columns (normalised header, '.' -> NULL)."""
    return formats.read_tsv(spark, path)


def _typed(df: DataFrame, numeric: list[str]) -> DataFrame:
    return df.select(*[F.col(f"`{c}`").try_cast("double").alias(c) if c in numeric else F.col(f"`{c}`")
                       for c in df.columns])


def typed_rejects(df: DataFrame, numeric: list[str], key: list[str]) -> DataFrame:
    """(key..., field, value) of the texts in ``numeric`` columns that are no numbers."""
    bad = [F.struct(F.lit(c).alias("field"), F.col(f"`{c}`").alias("value"),
                    F.col(f"`{c}`").try_cast("double").isNull().alias("null")) for c in numeric]
    return df.select(*key, F.explode(F.array(*bad)).alias("b")).where("b.value IS NOT NULL AND b.null").select(
        *key, "b.field", "b.value")


def import_gnomad_constraint(spark: SparkSession, path: str, numeric: list[str] | None = None,
                             block_gzip: bool | None = None) -> DataFrame:
    """Constraint metrics TSV, ``NA`` is NULL. Files that end in ``.bgz`` are read by their members (several tasks a file);
    with ``block_gzip`` files of any name are. Values of ``numeric`` columns that are no numbers are NULL here and rows of
    :func:`constraint_rejects`."""
    df = _constraint_table(spark, path, block_gzip)
    return _typed(df, constraint_numbers(df) if numeric is None else numeric)


def constraint_rejects(spark: SparkSession, path: str, key: list[str], numeric: list[str] | None = None,
                       block_gzip: bool | None = None) -> DataFrame:
    """(key..., field, value) of a constraint file's texts that should be numbers."""
    df = _constraint_table(spark, path, block_gzip)
    return typed_rejects(df, constraint_numbers(df) if numeric is None else numeric, key)


def constraint_numbers(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c.startswith(("pLI", "oe_", "mis_z", "lof_z", "syn_z"))]


def _constraint_table(spark: SparkSession, path: str, block_gzip: bool | None) -> DataFrame:
    if path.endswith(".bgz") if block_gzip is None else block_gzip:
        return blockgzip.read_delimited(spark, path, "\t", "NA")
    return formats.read_delimited(spark, path, "\t", null_value="NA")


def import_cosmic_genes(spark: SparkSession, path: str) -> DataFrame:
    """COSMIC cancer gene census (CSV)."""
    return formats.read_csv(spark, path)


def import_cosmic_mutations(spark: SparkSession, path: str) -> DataFrame:
    """COSMIC mutations (TSV)."""
    return formats.read_delimited(spark, path, "\t", null_value="")


def import_hpo_genes(spark: SparkSession, path: str) -> DataFrame:
    """genes_to_phenotype TSV: gene id/symbol, HPO id/name, frequency, disease."""
    return formats.read_delimited(spark, path, "\t", null_value="-")


def import_human_genes(spark: SparkSession, path: str) -> DataFrame:
    """NCBI gene_info TSV (header line starts with '#'); '-' means missing."""
    df = formats.read_delimited(spark, path, "\t", renames={"#tax_id": "tax_id"}, null_value="-")
    return df.withColumn("synonym_list", F.split(F.col("Synonyms"), r"\|")) if "Synonyms" in df.columns else df


def import_ddd(spark: SparkSession, path: str) -> DataFrame:
    """DDG2P gene-disease CSV."""
    return formats.read_csv(spark, path)


ENSEMBL_KEYS = ["gene_stable_id", "transcript_stable_id"]


def import_ensembl(spark: SparkSession, mappings: dict[str, str], gff_path: str | None = None) -> DataFrame:
    """Ensembl cross-references: one TSV per kind (ena, entrez, refseq,
    uniprot) with gene/transcript stable ids and an ``xref`` column, combined
    by full outer join on the two ids (each kind's xrefs as a sorted set);
    optionally joined with the GFF3 transcript features."""
    out = None
    for kind, path in mappings.items():
        t = formats.read_delimited(spark, path, "\t", null_value="")
        t = t.groupBy(*ENSEMBL_KEYS).agg(F.sort_array(F.collect_set("xref")).alias(kind))
        out = t if out is None else out.join(t, ENSEMBL_KEYS, "full_outer")
    if gff_path is not None:
        g = formats.read_gff3(spark, gff_path).select(
            F.regexp_replace(F.col("attributes")["ID"], "^transcript:", "").alias("transcript_stable_id"),
            F.col("seqid").alias("chromosome"), "start", "end", "strand", F.col("type").alias("biotype"))
        out = out.join(g, "transcript_stable_id", "left")
    return out


def import_omim(spark: SparkSession, path: str) -> DataFrame:
    return formats.read_hash_header_tsv(spark, path)


#: Nested elements of the two files that count, as the publisher names them.
ORPHANET_GENES = ("OrphaCode bigint, Name string, DisorderGeneAssociationList struct<DisorderGeneAssociation: array<struct<"
                  "Gene: struct<Symbol: string, Name: string>, DisorderGeneAssociationType: struct<Name: string>, "
                  "DisorderGeneAssociationStatus: struct<Name: string>>>>")
ORPHANET_AGES = ("OrphaCode bigint, Name string, AverageAgeOfOnsetList struct<AverageAgeOfOnset: array<struct<Name: string>>>, "
                 "TypeOfInheritanceList struct<TypeOfInheritance: array<struct<Name: string>>>")


def import_orphanet_genes(spark: SparkSession, path: str) -> DataFrame:
    """One row for each association of a disorder with a gene (a disorder without one has none)."""
    d = formats.read_xml(spark, path, "Disorder", ORPHANET_GENES)
    a = d.select(F.col("OrphaCode").alias("orpha_code"), F.col("Name").alias("disorder"),
                 F.explode("DisorderGeneAssociationList.DisorderGeneAssociation").alias("a"))
    return a.select("orpha_code", "disorder", F.col("a.Gene.Symbol").alias("symbol"), F.col("a.Gene.Name").alias("gene_name"),
                    F.col("a.DisorderGeneAssociationType.Name").alias("association_type"),
                    F.col("a.DisorderGeneAssociationStatus.Name").alias("association_status"))


def import_orphanet_ages(spark: SparkSession, path: str) -> DataFrame:
    """One row a disorder: its ages of onset and types of inheritance, in the file's order."""
    d = formats.read_xml(spark, path, "Disorder", ORPHANET_AGES)
    return d.select(F.col("OrphaCode").alias("orpha_code"),
                    F.col("AverageAgeOfOnsetList.AverageAgeOfOnset.Name").alias("average_age_of_onset"),
                    F.col("TypeOfInheritanceList.TypeOfInheritance.Name").alias("type_of_inheritance"))


def import_orphanet(spark: SparkSession, path: str, ages_path: str | None = None, row_tag: str = "Disorder") -> DataFrame:
    """Gene associations with their disorder's ages of onset and inheritance, of the two nested files; with one path only,
    the records of a flat file as they are."""
    if ages_path is None:
        return formats.read_xml(spark, path, row_tag)
    return import_orphanet_genes(spark, path).join(import_orphanet_ages(spark, ages_path), "orpha_code", "left")


def import_refseq_annotation(spark: SparkSession, path: str) -> DataFrame:
    g = formats.read_gff3(spark, path)
    return g.select("seqid", "type", "start", "end", "strand", "attributes",
                    F.col("attributes")["ID"].alias("feature_id"), F.col("attributes")["Name"].alias("name"))


def import_terms(spark: SparkSession, path: str, root: str | None = None) -> DataFrame:
    """OBO terms (id, name, parents); with ``root``, only its subtree."""
    t = formats.read_obo(spark, path).where(~F.col("is_obsolete"))
    if root is None:
        return t.drop("is_obsolete")
    anc = term_ancestors(t)
    keep = anc.where(F.col("ancestor_id") == root).select(F.col("term_id").alias("id")).union(
        spark.createDataFrame([(root,)], "id string"))
    return t.join(keep, "id", "left_semi").drop("is_obsolete")


def term_ancestors(terms: DataFrame) -> DataFrame:
    """Transitive closure (term_id, ancestor_id, distance), by frontier
    expansion until no new pair appears: each round joins the newest pairs with
    the parent edges, one row a pair, and drops pairs already known, so the
    distance is the shortest, several parents do not multiply paths, and a
    cycle ends. Lineage is cut every round."""
    edges = terms.select(F.col("id").alias("child"), F.explode("parents").alias("parent")).distinct()
    edges = cut_lineage(edges)
    frontier = edges.select(F.col("child").alias("term_id"), F.col("parent").alias("ancestor_id"),
                            F.lit(1).alias("distance"))
    frontier = cut_lineage(frontier)
    out = frontier
    while True:
        nxt = (frontier.join(edges, frontier["ancestor_id"] == edges["child"])
               .select("term_id", F.col("parent").alias("ancestor_id"), (F.col("distance") + 1).alias("distance"))
               .distinct().join(out, ["term_id", "ancestor_id"], "left_anti"))
        nxt = cut_lineage(nxt)
        if nxt.isEmpty():
            return out
        out = out.unionByName(nxt)
        frontier = nxt


def build_genes(genes: DataFrame, sources: dict[str, DataFrame]) -> DataFrame:
    """Gene table left-joined with one sorted term list per source
    (source DataFrames: symbol, term)."""
    out = genes
    for name, src in sources.items():
        agg = src.groupBy("symbol").agg(F.sort_array(F.collect_set("term")).alias(name))
        out = out.join(agg, "symbol", "left")
    return out


def normalize_panels(rows: DataFrame) -> DataFrame:
    """gene -> sorted distinct panel list."""
    return rows.groupBy("symbol").agg(F.sort_array(F.collect_set("panel")).alias("panels"))


def rare_variants(freq: DataFrame, max_af: float = 0.01, af_col: str = "af") -> DataFrame:
    """Variants whose allele frequency is at most ``max_af``."""
    return freq.where(F.col(af_col) <= max_af)
