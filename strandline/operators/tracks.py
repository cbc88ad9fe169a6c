"""Genome-browser track conversion (TSV / UCSC tables -> GFF3) as Spark jobs.

Input is the raw text (one row per line, column ``value``); fields are the
columns ``$1..$n`` of the source format, separated by tabs (dosage files) or by any
white space (UCSC tables). Sequential ids (awk ``NR``) count every line and come from a distributed global row number over the caller's line
order column; sorting for the browser is a range-partitioned global sort.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandline.operators._util import global_row_number

GFF_COLUMNS = ["seqid", "source", "type", "start", "end", "score", "strand", "phase", "attributes"]
GFF_HEADER = "##gff-version 3"
# Fixed attribute layouts of the converted tracks.
GENE_DOSAGE_FIELDS = [("gene_id", 2), ("cytoband", 3), ("haploinsufficiency_score", 5),
                      ("haploinsufficiency_description", 6), ("triplosensitivity_score", 13),
                      ("triplosensitivity_description", 14), ("date_last_evaluated", 21),
                      ("haploinsufficiency_disease_id", 22), ("triplosensitivity_disease_id", 23)]
DESCRIPTION_FIELDS = {6, 14}
LOCATION_WARNING = "WARNING: Skipping line with invalid location data: "


def field(n: int) -> Column:
    """awk ``$n`` (1-based); missing fields are empty strings."""
    return F.coalesce(F.try_element_at(F.split(F.col("value"), "\t"), F.lit(n)), F.lit(""))


def num(n: int) -> Column:
    """awk's number of a field: 0 where it is empty or no number."""
    return F.coalesce(field(n).try_cast("double"), F.lit(0.0))


def whole(n: int) -> Column:
    return F.coalesce(field(n).try_cast("bigint"), F.lit(0).cast("bigint"))


def _data_lines(lines: DataFrame) -> DataFrame:
    return lines.where(~F.col("value").startswith("#") & (F.length("value") > 0))


def _location(lines: DataFrame) -> DataFrame:
    loc = F.split(field(4), "[:-]")
    return lines.select("*", F.coalesce(F.try_element_at(loc, F.lit(1)), F.lit("")).alias("_seqid"),
                        F.coalesce(F.try_element_at(loc, F.lit(2)), F.lit("")).alias("_start"),
                        F.coalesce(F.try_element_at(loc, F.lit(3)), F.lit("")).alias("_end"))


def _valid_location() -> Column:
    return (F.col("_seqid") != "") & F.col("_start").rlike("^[0-9]+$") & F.col("_end").rlike("^[0-9]+$")


def rejected_rows(lines: DataFrame) -> DataFrame:
    """Lines with a malformed location and the warning each one produces."""
    l = _location(_data_lines(lines))
    return l.where(~_valid_location()).select("value", F.concat(F.lit(LOCATION_WARNING), "value").alias("warning"))


def _number(c: Column) -> Column:
    return F.coalesce(c.try_cast("bigint"), F.lit(0).cast("bigint"))


def _gff(df: DataFrame, seqid, source, type_, start, end, score, strand, phase, attributes) -> DataFrame:
    lit = lambda x: F.lit(x) if isinstance(x, str) else x
    return df.select(lit(seqid).alias("seqid"), lit(source).alias("source"), lit(type_).alias("type"),
                     _number(start).alias("start"), _number(end).alias("end"),
                     lit(score).cast("string").alias("score"), lit(strand).alias("strand"), lit(phase).alias("phase"),
                     attributes.alias("attributes"))


def _underscored(c: Column) -> Column:
    return F.replace(c, F.lit(" "), F.lit("_"))


def gene_dosage_gff(lines: DataFrame) -> DataFrame:
    """Gene curation list -> GFF3 ``gene`` features; every attribute is written."""
    l = _location(_data_lines(lines)).where(_valid_location())
    attrs = [F.concat(F.lit("ID="), field(1), F.lit("_"), field(2), F.lit(";Name="), field(1))]
    for name, n in GENE_DOSAGE_FIELDS:
        v = _underscored(field(n)) if n in DESCRIPTION_FIELDS else field(n)
        attrs.append(F.concat(F.lit(f";{name}="), v))
    return _gff(l, F.col("_seqid"), "ClinGen", "gene", F.col("_start"), F.col("_end"), ".", ".", ".",
                F.concat(*attrs))


def region_dosage_gff(lines: DataFrame) -> DataFrame:
    """Region curation list -> GFF3 ``region`` features; optional attributes
    only when the field is non-empty."""
    l = _location(_data_lines(lines)).where(_valid_location())
    name = F.regexp_replace(_underscored(field(2)), "[();,]", "")
    parts = [F.concat(F.lit("ID="), field(1), F.lit(";Name="), name, F.lit(";isca_id="), field(1))]
    for key, n in [("cytoband", 3), ("haploinsufficiency_score", 5), ("haploinsufficiency_description", 6),
                   ("triplosensitivity_score", 13), ("triplosensitivity_description", 14),
                   ("date_last_evaluated", 21), ("haploinsufficiency_disease_id", 22),
                   ("triplosensitivity_disease_id", 23)]:
        v = _underscored(field(n)) if n in DESCRIPTION_FIELDS else field(n)
        parts.append(F.when(field(n) != "", F.concat(F.lit(f";{key}="), v)).otherwise(F.lit("")))
    return _gff(l, F.col("_seqid"), "ClinGen", "region", F.col("_start"), F.col("_end"), ".", ".", ".",
                F.concat(*parts))


def _columns(lines: DataFrame) -> DataFrame:
    """Lines of the UCSC tables: fields are separated by any run of blanks and tabs, as their scripts read them; blanks at
    both ends do not count. Rendered with tabs for :func:`field`."""
    return lines.withColumn("value", F.regexp_replace(F.btrim("value", F.lit(" \t\r")), "[ \t]+", "\t"))


def self_chain_gff(lines: DataFrame) -> DataFrame:
    """UCSC chainSelf -> GFF3 (0-based start -> 1-based)."""
    l = _data_lines(_columns(lines))
    attrs = F.format_string("ID=chainSelf_%s;score=%.0f;normScore=%.2f;Target=%s %d %d;target_strand=%s",
                            field(12), num(2), num(13), field(7), whole(10) + 1,
                            whole(11), field(9))
    return _gff(l, field(3), "UCSC_chainSelf", "self_chain_alignment", whole(5) + 1,
                field(6), field(2), ".", ".", attrs)


def _numbered(lines: DataFrame, order_col: str) -> DataFrame:
    """Data lines with their number among all lines, comments and empty ones included."""
    return _data_lines(_columns(global_row_number(lines, [order_col], name="_nr")))


def segdup_gff(lines: DataFrame, order_col: str = "line_no") -> DataFrame:
    """UCSC genomicSuperDups -> GFF3; ``ID=gsd_<line number>``."""
    l = _numbered(lines, order_col)
    attrs = F.format_string(
        "ID=gsd_%d;Name=%s;Target=%s %d %d;frac_match=%.6f;frac_match_indel=%.6f;align_length=%d;"
        "match_bases=%d;mismatch_bases=%d", F.col("_nr"), field(5), field(8), whole(9) + 1,
        whole(10), num(27), num(28), whole(19), whole(23),
        whole(24))
    return _gff(l, field(2), "UCSC_SuperDups", "", whole(3) + 1, field(4), field(6), field(7), ".",
                attrs)


def repeat_gff(lines: DataFrame, order_col: str = "line_no") -> DataFrame:
    """UCSC RepeatMasker -> GFF3; type = repeat class, ``ID=rmsk_<line number>``."""
    l = _numbered(lines, order_col)
    attrs = F.format_string("ID=rmsk_%d;Name=%s;rep_family=%s;milli_div=%d;milli_del=%d;milli_ins=%d",
                            F.col("_nr"), field(11), field(13), whole(3), whole(4),
                            whole(5))
    return _gff(l, field(6), "RepeatMasker", field(12), whole(7) + 1, field(8), field(2), field(10),
                ".", attrs)


def tandem_gff(lines: DataFrame, order_col: str = "line_no") -> DataFrame:
    """UCSC simpleRepeat -> GFF3; ``ID=trf_<counter>``."""
    l = _numbered(lines, order_col)
    attrs = F.format_string("ID=trf_%d;period=%d;copy_num=%.1f;entropy=%.2f;consensus_sequence=%s",
                            F.col("_nr"), whole(6), num(7), num(16), field(17))
    return _gff(l, field(2), field(5), "", whole(3) + 1, field(4), field(11), ".", ".", attrs)


def escape_percent(c: Column) -> Column:
    """``%`` not followed by two hex digits -> ``%25``."""
    return F.regexp_replace(c, "%(?![0-9a-fA-F]{2})", "%25")


def sort_track(gff: DataFrame) -> DataFrame:
    """Rows with ``rank``: seqid (byte order), then start (numeric); ties by
    end and attributes so the order is total."""
    return global_row_number(gff, ["seqid", "start", "end", "attributes"], name="rank")


def write_track(gff: DataFrame, path: str) -> str:
    """GFF3 text: header first, then features sorted by seqid and start (a
    range-partitioned global sort; part files are in order)."""
    spark = gff.sparkSession
    body = gff.select(F.lit(1).alias("_k"), "seqid", "start", "end", "attributes",
                      F.concat_ws("\t", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in GFF_COLUMNS])
                      .alias("value"))
    head = spark.createDataFrame([(0, "", 0, 0, "", GFF_HEADER)],
                                 "_k int, seqid string, start bigint, end bigint, attributes string, value string")
    (head.unionByName(body).orderBy("_k", "seqid", "start", "end", "attributes").select("value")
     .write.mode("overwrite").text(path))
    return path
