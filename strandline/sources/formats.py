"""Public-file readers (and the writers that render them): VCF, TSV/CSV, XML,
GFF3 and OBO. Every reader is a Spark scan plus column expressions; parsing
runs on the executors, line by line or record by record.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

VCF_COLUMNS = ["chromosome", "start", "id", "reference", "alternates", "qual", "filter", "info"]
# Fixed header renames applied when reading delimited files.
HEADER_RENAMES = {"pos(1-based)": "position_1-based", "hg19_pos(1-based)": "hg19_pos_1-based",
                  "hg18_pos(1-based)": "phg18_pos_1-based", "#chr": "chr"}


def pairs_map(text: Column, pair_sep: str = ";", value_sep: str = "=") -> Column:
    """``k1=v1;k2=v2;flag`` as map<string,string>: of a key that comes twice the first value counts, a flag has NULL, and
    empty parts are left out."""
    cut = F.filter(F.split(text, pair_sep), lambda p: F.length(F.trim(p)) > 0)
    keys = F.transform(cut, lambda p: F.trim(F.substring_index(p, value_sep, 1)))
    first = F.array_distinct(keys)
    value = F.transform(first, lambda k: F.element_at(cut, F.array_position(keys, k).cast("int")))
    return F.map_from_arrays(first, F.transform(value, lambda p: F.when(
        F.contains(p, F.lit(value_sep)), F.substr(p, F.instr(p, value_sep) + F.lit(len(value_sep))))))


# --- VCF -------------------------------------------------------------------

def read_vcf(spark: SparkSession, path: str) -> DataFrame:
    """One row per (record, alternate allele): chromosome, start, id,
    reference, alternate, allele (position in ALT, from 0), qual, filters
    (array), info (map<string,string> of the whole record; see
    :func:`info_field` for the value of the row's own allele). Positions and
    qualities that are no numbers are NULL."""
    lines = spark.read.text(path).where(~F.col("value").startswith("#"))
    f = F.split("value", "\t")
    rec = lines.select(*[F.get(f, F.lit(i)).alias(c) for i, c in enumerate(VCF_COLUMNS)])
    return rec.select("*", F.posexplode(F.split("alternates", ",")).alias("allele", "alternate")).select(
        "chromosome", F.col("start").try_cast("bigint").alias("start"), F.nullif("id", F.lit(".")).alias("id"),
        "reference", "alternate", "allele", F.nullif("qual", F.lit(".")).try_cast("double").alias("qual"),
        F.split("filter", ";").alias("filters"),
        F.when(F.col("info") == ".", F.create_map()).otherwise(pairs_map(F.col("info")))
        .alias("info"))


def info_text(name: str, number: str = "1") -> Column:
    """INFO value as text. ``number``: ``1`` for one of the record, ``A`` for
    one per alternate, ``R`` for one per allele with the reference first. NULL
    if absent, ``.``, or without an entry for the row's allele."""
    value = F.col("info")[name]
    if number != "1":
        value = F.get(F.split(value, ","), F.col("allele") + (1 if number == "R" else 0))
    return F.nullif(value, F.lit("."))


def info_field(name: str, dtype: str = "string", number: str = "1") -> Column:
    """:func:`info_text` as ``dtype``; NULL where the text is none (listed by :func:`info_rejects`)."""
    return info_text(name, number).try_cast(dtype)


def info_rejects(records: DataFrame, specs: Sequence[tuple[str, str, str, str]]) -> DataFrame:
    """(chromosome, start, reference, alternate, field, value) of INFO values that their type does not take."""
    bad = F.array(*[F.struct(F.lit(k).alias("field"), info_text(k, n).alias("value"),
                             info_field(k, t, n).isNull().alias("null")) for k, _, t, n in specs])
    return records.select("chromosome", "start", "reference", "alternate", F.explode(bad).alias("b")) \
        .where("b.value IS NOT NULL AND b.null").select(
        "chromosome", "start", "reference", "alternate", "b.field", "b.value")


def write_vcf(df: DataFrame, path: str, header: Sequence[str] = ("##fileformat=VCFv4.2",)) -> str:
    """``df`` columns: chromosome, start, id, reference, alternates, qual,
    filter, info (all rendered as text)."""
    spark = df.sparkSession
    head = list(header) + ["#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO"]
    body = df.select(F.concat_ws("\t", *[F.coalesce(F.col(c).cast("string"), F.lit(".")) for c in VCF_COLUMNS])
                     .alias("value"))
    spark.createDataFrame([(h,) for h in head], "value string").unionByName(body) \
        .write.mode("overwrite").text(path)
    return path


# --- delimited -----------------------------------------------------------

def normalize_header(name: str, renames: dict[str, str] | None = None) -> str:
    r = {**HEADER_RENAMES, **(renames or {})}
    return r.get(name, name)


def read_delimited(spark: SparkSession, path: str, sep: str = "\t", renames: dict[str, str] | None = None,
                   null_value: str | None = ".", comment: str | None = None) -> DataFrame:
    """Headered TSV/CSV with header normalisation; ``null_value`` -> NULL."""
    r = spark.read.option("header", True).option("sep", sep)
    if null_value is not None:
        r = r.option("nullValue", null_value)
    if comment:
        r = r.option("comment", comment)
    df = r.csv(path)
    return df.toDF(*[normalize_header(c, renames) for c in df.columns])


def read_tsv(spark: SparkSession, path: str, renames: dict[str, str] | None = None) -> DataFrame:
    return read_delimited(spark, path, "\t", renames)


def read_csv(spark: SparkSession, path: str, renames: dict[str, str] | None = None) -> DataFrame:
    return read_delimited(spark, path, ",", renames, null_value=None)


def read_hash_header_tsv(spark: SparkSession, path: str) -> DataFrame:
    """TSV whose header is the last line starting with ``#`` before the first
    data line (other ``#`` lines, including trailing ones, are comments). The
    header is found with two small aggregates over line positions (they run
    when called), then data lines are split by it on the executors; fields that a
    short line does not have are NULL."""
    raw = spark.read.text(path).withColumn("_pos", F.monotonically_increasing_id())
    is_comment = F.col("value").startswith("#")
    is_data = ~is_comment & (F.length("value") > 0)
    first = raw.where(is_data).agg(F.min("_pos")).first()[0]
    before = raw.where(is_comment) if first is None else raw.where(is_comment & (F.col("_pos") < first))
    header_line = before.agg(F.max_by("value", "_pos").alias("h")).first()["h"]
    if header_line is None:
        raise ValueError(f"{path} has no header line")
    names = [normalize_header(c.strip()) for c in header_line.lstrip("#").split("\t")]
    parts = F.split("value", "\t")
    return raw.where(is_data).select(*[F.nullif(F.get(parts, F.lit(i)), F.lit("")).alias(n) for i, n in enumerate(names)])


# --- XML -------------------------------------------------------------------

def read_xml(spark: SparkSession, path: str, row_tag: str, schema: str | None = None) -> DataFrame:
    r = spark.read.format("xml").option("rowTag", row_tag)
    if schema:
        r = r.schema(schema)
    return r.load(path)


def write_xml(df: DataFrame, path: str, root_tag: str, row_tag: str) -> str:
    df.write.format("xml").option("rootTag", root_tag).option("rowTag", row_tag).mode("overwrite").save(path)
    return path


# --- GFF3 ------------------------------------------------------------------

GFF_COLUMNS = ["seqid", "source", "type", "start", "end", "score", "strand", "phase", "attributes"]


def read_gff3(spark: SparkSession, path: str) -> DataFrame:
    """GFF3 records with ``attributes`` as map<string,string>; of a repeated attribute the first counts, positions that
    are no numbers and fields that a short line does not have are NULL."""
    lines = spark.read.text(path).where(~F.col("value").startswith("#") & (F.length("value") > 0))
    f = F.split("value", "\t")
    rec = lines.select(*[F.get(f, F.lit(i)).alias(c) for i, c in enumerate(GFF_COLUMNS)])
    return rec.select("seqid", "source", "type", F.col("start").try_cast("bigint").alias("start"),
                      F.col("end").try_cast("bigint").alias("end"), F.nullif("score", F.lit(".")).alias("score"),
                      "strand", "phase", pairs_map(F.col("attributes")).alias("attributes"))


def gff3_attributes(pairs: Sequence[tuple[str, Column]]) -> Column:
    """``k1=v1;k2=v2`` (pairs with a NULL value are skipped)."""
    return F.concat_ws(";", *[F.when(v.isNotNull(), F.concat(F.lit(f"{k}="), v)) for k, v in pairs])


def write_gff3(df: DataFrame, path: str) -> str:
    """``df`` has the nine GFF3 columns (attributes already rendered)."""
    spark = df.sparkSession
    body = df.select(F.concat_ws("\t", *[F.coalesce(F.col(c).cast("string"), F.lit(".")) for c in GFF_COLUMNS])
                     .alias("value"))
    spark.createDataFrame([("##gff-version 3",)], "value string").unionByName(body).write.mode("overwrite").text(path)
    return path


# --- OBO -------------------------------------------------------------------

def read_obo(spark: SparkSession, path: str) -> DataFrame:
    """OBO ``[Term]`` stanzas -> (id, name, parents array, is_obsolete). A stanza begins at a line that starts with
    ``[``; the same text inside a definition or a comment does not end it."""
    # records are cut before a line "[Term]"; the first one also holds the header and whatever is before
    stanzas = spark.read.option("lineSep", "\n[Term]").text(path).select(F.concat(F.lit("\n"), F.col("value")).alias("value"))
    # stanzas of other kinds, the header, and further lines of the heading are not part of a term
    stanzas = stanzas.select(F.regexp_replace("value", r"\r", "").alias("value"))
    stanzas = stanzas.select(F.regexp_replace("value", r"(?s)\n\[(?!Term\]).*$", "").alias("value"))
    t = stanzas.select(F.regexp_replace("value", r"(?s)^\n\[Term\]", "").alias("value")).where(F.col("value").rlike(r"(?m)^id: "))
    return t.select(
        F.regexp_extract("value", r"(?m)^id: *(\S+)", 1).alias("id"),
        F.regexp_extract("value", r"(?m)^name: *(.*?) *$", 1).alias("name"),
        F.regexp_extract_all("value", F.lit(r"(?m)^is_a: *(\S+)"), 1).alias("parents"),
        F.col("value").rlike(r"(?m)^is_obsolete: *true").alias("is_obsolete"))


def write_obo(terms: DataFrame, path: str) -> str:
    """``terms``: id, name, parents (array<string>) -> OBO text."""
    stanza = F.concat(F.lit("[Term]\nid: "), F.col("id"), F.lit("\nname: "), F.col("name"), F.lit("\n"),
                      F.array_join(F.transform("parents", lambda p: F.concat(F.lit("is_a: "), p, F.lit("\n"))), ""))
    spark = terms.sparkSession
    spark.createDataFrame([("format-version: 1.2\n",)], "value string").unionByName(
        terms.select(stanza.alias("value"))).write.mode("overwrite").option("lineSep", "\n").text(path)
    return path
