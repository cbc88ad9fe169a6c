"""Sample sheets (manifests) for downstream pipelines.

Clinical rows carry file URLs as ``array<string>`` (the lake's data model);
a sheet takes the first URL and rewrites the first ``s3a://`` to ``s3://``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandline.operators._util import first_by, literal_map

# Fixed values that must equal the reference's.
SEQUENCING_TYPE = {"WXS": "WES"}
DUPLICATE_MESSAGE = "Duplicate aliquot_ids: "


def first_s3(urls: Column) -> Column:
    """First URL of an array column, with ``s3a://`` rewritten to ``s3://``."""
    first = F.get(urls, 0)
    pos = F.instr(first, "s3a://")
    return F.when(pos > 0, F.concat(F.substring(first, F.lit(1), pos - 1), F.lit("s3://"),
                                    F.substring(first, pos + 6, F.lit(1 << 30)))).otherwise(first)


def sv_manifest(clinical: DataFrame) -> DataFrame:
    """Rows with a germline or somatic CNV file: sample, familyId, germline_vcf,
    somatic_vcf; whole-row duplicates removed."""
    rows = clinical.where(F.col("cnv_vcf_germline_urls").isNotNull() | F.col("cnv_vcf_somatic_urls").isNotNull())
    return rows.select(F.col("aliquot_id").alias("sample"), F.col("analysis_id").alias("familyId"),
                       first_s3(F.col("cnv_vcf_germline_urls")).alias("germline_vcf"),
                       first_s3(F.col("cnv_vcf_somatic_urls")).alias("somatic_vcf")).dropDuplicates()


def split_manifest(m: DataFrame) -> DataFrame:
    """Germline and somatic sheets in one pass: (kind, sample, familyId, vcf)."""
    long = m.unpivot(["sample", "familyId"], ["germline_vcf", "somatic_vcf"], "kind", "vcf")
    return (long.where(F.col("vcf").isNotNull())
            .select(F.regexp_replace("kind", "_vcf$", "").alias("kind"), "sample", "familyId", "vcf"))


TOLD_SAMPLES = 1_000


def duplicate_samples(m: DataFrame) -> DataFrame:
    """Distinct samples that appear on more than one row."""
    return m.groupBy("sample").agg(F.count("*").alias("n_rows")).where("n_rows > 1").select("sample")


def dedup_samples(m: DataFrame, on_duplicate: str = "first", vcf: str = "vcf") -> DataFrame:
    """``first``: keep the first row per sample after sorting by familyId,
    sample, vcf. ``error``: fail listing the duplicated samples, the first
    ``TOLD_SAMPLES`` of them (:func:`duplicate_samples` has them all)."""
    if on_duplicate == "error":
        dups = duplicate_samples(m).orderBy("sample").limit(TOLD_SAMPLES).agg(F.sort_array(F.collect_list("sample")).alias("s"))
        msg = F.concat(F.lit(DUPLICATE_MESSAGE + "["),
                       F.array_join(F.transform("s", lambda x: F.concat(F.lit("'"), x, F.lit("'"))), ", "),
                       F.lit("]"))
        # one-row scalar subquery: raises when any sample is duplicated
        check = dups.select(F.when(F.size("s") > 0, F.raise_error(msg)).cast("int").alias("_e")).scalar()
        return m.where(F.coalesce(check, F.lit(0)) == 0)
    return first_by(m, ["sample"], [F.col("familyId"), F.col(vcf)])


def parental_manifest(clinical: DataFrame, analysis_ids: DataFrame | None = None) -> DataFrame:
    """GEBA rows of analyses with at least one parent and a germline CNV file:
    familyId, sample, vcf."""
    c = clinical.where(F.col("bioinfo_analysis_code") == "GEBA")
    if analysis_ids is not None:
        c = c.join(analysis_ids.select(F.col(analysis_ids.columns[0]).alias("analysis_id")), "analysis_id", "left_semi")
    with_parent = (c.where(F.col("mother_aliquot_id").isNotNull() | F.col("father_aliquot_id").isNotNull())
                   .select("analysis_id").distinct())
    rows = c.where(F.col("cnv_vcf_germline_urls").isNotNull()).join(with_parent, "analysis_id", "left_semi")
    return rows.select(F.col("analysis_id").alias("familyId"), F.col("aliquot_id").alias("sample"),
                       first_s3(F.col("cnv_vcf_germline_urls")).alias("vcf"))


def strict_recode(c: Column, mapping: dict[str, str], what: str = "sequencing strategy") -> Column:
    """Mapped value; anything outside ``mapping`` raises."""
    return F.coalesce(literal_map(mapping)[c],
                      F.raise_error(F.concat(F.lit(f"Unsupported {what}: "), F.coalesce(c, F.lit("None")))))


def recode_violations(df: DataFrame, col: str, mapping: dict[str, str]) -> DataFrame:
    """Audit form of :func:`strict_recode`: the rows it would fail on."""
    return df.where(literal_map(mapping)[F.col(col)].isNull())


def snv_manifest(clinical: DataFrame, pheno: DataFrame) -> DataFrame:
    """All members of the analyses in ``pheno`` (analysis_id, pheno_path):
    familyId, sample, sequencingType, gvcf, familyPheno."""
    rows = clinical.join(pheno, "analysis_id")
    return rows.select(F.col("analysis_id").alias("familyId"), F.col("aliquot_id").alias("sample"),
                       strict_recode(F.col("sequencing_strategy"), SEQUENCING_TYPE).alias("sequencingType"),
                       first_s3(F.col("snv_vcf_germline_urls")).alias("gvcf"),
                       F.col("pheno_path").alias("familyPheno"))


def cnv_manifest(clinical: DataFrame, pheno: DataFrame) -> DataFrame:
    """Probands of the analyses in ``pheno``: sample (= analysis id),
    sequencingType, vcf, pheno."""
    rows = clinical.where("is_proband").join(pheno, "analysis_id")
    return rows.select(F.col("analysis_id").alias("sample"),
                       strict_recode(F.col("sequencing_strategy"), SEQUENCING_TYPE).alias("sequencingType"),
                       first_s3(F.col("cnv_vcf_germline_urls")).alias("vcf"),
                       F.col("pheno_path").alias("pheno"))
