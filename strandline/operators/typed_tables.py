"""Delimited reference tables with named, typed columns: which header becomes which column of which type. Texts that a type
does not take are NULL, and rows of :func:`rejects`."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.operators import refdata

# Headers as the publishers write them. (header, column, type); ``list;`` is a list with its separator,
# ``yes`` a boolean written as yes, y, no or n.
TABLES: dict[str, list[tuple[str, str, str]]] = {
    "cosmic_genes": [
        ("Gene Symbol", "symbol", "string"), ("Name", "name", "string"), ("Entrez GeneId", "entrez_gene_id", "bigint"),
        ("Genome Location", "genome_location", "string"), ("Tier", "tier", "int"), ("Hallmark", "hallmark", "yes"),
        ("Somatic", "somatic", "yes"), ("Germline", "germline", "yes"), ("Tumour Types(Somatic)", "tumour_types_somatic", "list,"),
        ("Tumour Types(Germline)", "tumour_types_germline", "list,"), ("Cancer Syndrome", "cancer_syndrome", "string"),
        ("Role in Cancer", "roles", "list,"), ("Mutation Types", "mutation_types", "list,"), ("Synonyms", "synonyms", "list,")],
    "cosmic_mutations": [
        ("GENE_SYMBOL", "symbol", "string"), ("TRANSCRIPT_ACCESSION", "transcript", "string"),
        ("GENOMIC_MUTATION_ID", "mutation_id", "string"), ("MUTATION_CDS", "mutation_cds", "string"), ("MUTATION_AA", "mutation_aa", "string"),
        ("CHROMOSOME", "chromosome", "string"), ("GENOME_START", "start", "bigint"), ("GENOME_STOP", "end", "bigint"),
        ("STRAND", "strand", "string"), ("PUBMED_PMID", "pubmed_id", "bigint")],
    "ddd": [
        ("gene symbol", "symbol", "string"), ("gene mim", "omim_gene_id", "bigint"), ("disease name", "disease_name", "string"),
        ("disease mim", "disease_omim_id", "bigint"), ("confidence category", "confidence", "string"),
        ("allelic requirement", "allelic_requirement", "string"), ("mutation consequence", "mutation_consequence", "string"),
        ("phenotypes", "phenotypes", "list;"), ("organ specificity list", "organs", "list;"), ("pmids", "pubmed_ids", "list;"),
        ("prev symbols", "previous_symbols", "list;"), ("hgnc id", "hgnc_id", "bigint")],
    "hpo_genes": [
        ("ncbi_gene_id", "entrez_gene_id", "bigint"), ("gene_symbol", "symbol", "string"), ("hpo_id", "hpo_term_id", "string"),
        ("hpo_name", "hpo_term_name", "string"), ("frequency", "frequency", "string"), ("disease_id", "disease_id", "string")],
    "human_genes": [
        ("tax_id", "tax_id", "int"), ("GeneID", "entrez_gene_id", "bigint"), ("Symbol", "symbol", "string"),
        ("Synonyms", "synonyms", "list|"), ("dbXrefs", "external_references", "list|"), ("chromosome", "chromosome", "string"),
        ("map_location", "map_location", "string"), ("description", "description", "string"), ("type_of_gene", "type_of_gene", "string")],
    "omim": [
        ("Chromosome", "chromosome", "string"), ("Genomic Position Start", "start", "bigint"), ("Genomic Position End", "end", "bigint"),
        ("Cyto Location", "cyto_location", "string"), ("MIM Number", "omim_gene_id", "bigint"), ("Gene Symbols", "symbols", "list,"),
        ("Gene Name", "name", "string"), ("Approved Gene Symbol", "approved_symbol", "string"), ("Entrez Gene ID", "entrez_gene_id", "bigint"),
        ("Ensembl Gene ID", "ensembl_gene_id", "string"), ("Phenotypes", "phenotypes", "list;")],
}
READERS = {"cosmic_genes": refdata.import_cosmic_genes, "cosmic_mutations": refdata.import_cosmic_mutations, "ddd": refdata.import_ddd,
           "hpo_genes": refdata.import_hpo_genes, "human_genes": refdata.import_human_genes, "omim": refdata.import_omim}


def _value(header: str, dtype: str) -> Column:
    text = F.trim(F.col(f"`{header}`"))
    if dtype == "string":
        return F.nullif(text, F.lit(""))
    if dtype == "yes":
        return F.when(F.lower(text).isin("yes", "y"), True).when(F.lower(text).isin("no", "n"), False)
    if dtype.startswith("list"):
        parts = F.transform(F.split(text, rf"\Q{dtype[4:]}\E"), lambda p: F.trim(p))
        return F.filter(parts, lambda p: F.length(p) > 0)
    return text.try_cast(dtype)


def typed(df: DataFrame, kind: str) -> DataFrame:
    """The columns of ``TABLES[kind]``; raises where the file lacks a header."""
    lacking = [h for h, _, _ in TABLES[kind] if h not in df.columns]
    if lacking:
        raise ValueError(f"{kind} table without the columns {lacking}")
    return df.select(*[_value(h, t).alias(c) for h, c, t in TABLES[kind]])


def rejects(df: DataFrame, kind: str, key: list[str]) -> DataFrame:
    """(key headers..., field, value) of the texts of a table as read that its types do not take."""
    checked = [F.struct(F.lit(c).alias("field"), F.trim(F.col(f"`{h}`")).alias("value"), _value(h, t).isNull().alias("null"))
               for h, c, t in TABLES[kind] if t != "string" and not t.startswith("list")]
    return df.select(*[F.col(f"`{k}`") for k in key], F.explode(F.array(*checked)).alias("b")).where(
        "b.null AND length(b.value) > 0").select(*[F.col(f"`{k}`") for k in key], "b.field", "b.value")


def import_table(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """A reference table of a kind of ``TABLES``, read as its format needs and typed."""
    return typed(READERS[kind](spark, path), kind)


def reference_of(external: Column, source: str) -> Column:
    """Id of a gene in ``source`` (``MIM``, ``HGNC``, ``Ensembl``) out of ``source:id`` references; the first counts."""
    own = F.filter(external, lambda x: x.startswith(f"{source}:"))
    return F.substring(F.get(own, F.lit(0)), len(source) + 2, 1 << 30)


def frequency_share(frequency: Column) -> Column:
    """Share of patients out of ``n/m`` or ``x%``; NULL for a frequency term or none."""
    n = F.regexp_extract(frequency, r"^\s*(\d+)\s*/\s*(\d+)\s*$", 1).try_cast("double")
    m = F.regexp_extract(frequency, r"^\s*(\d+)\s*/\s*(\d+)\s*$", 2).try_cast("double")
    percent = F.regexp_extract(frequency, r"^\s*([\d.]+)\s*%\s*$", 1).try_cast("double")
    return F.coalesce(F.when(m > 0, n / m), percent / 100)


_PHENOTYPE = r"^(.*?)(?:,\s*(\d{6}))?\s*\((\d)\)\s*(?:,\s*(.*))?$"


def omim_phenotypes(omim: DataFrame) -> DataFrame:
    """One row per gene and phenotype of a typed ``omim`` table: omim_gene_id, approved_symbol, name, omim_id, mapping_key,
    inheritance (list) and flags (``?`` provisional, ``{`` susceptibility, ``[`` no disease). A text of another form is a name
    without the rest."""
    p = omim.select("omim_gene_id", "approved_symbol", F.explode("phenotypes").alias("text"))
    fits = F.col("text").rlike(_PHENOTYPE)

    def part(i: int) -> Column:
        return F.when(fits, F.nullif(F.regexp_extract("text", _PHENOTYPE, i), F.lit("")))

    raw = F.when(fits, F.regexp_extract("text", _PHENOTYPE, 1)).otherwise(F.col("text"))
    flags = F.regexp_extract(raw, r"^([?{\[]*)", 1)
    return p.select("omim_gene_id", "approved_symbol", F.trim(F.translate(raw, "?{}[]", "")).alias("name"),
                    part(2).try_cast("bigint").alias("omim_id"), part(3).try_cast("int").alias("mapping_key"),
                    F.split(part(4), r",\s*").alias("inheritance"), F.split(F.nullif(flags, F.lit("")), "").alias("flags"))
