"""Cohort resolution over the clinical table.

Request lists are DataFrames (or literal lists) and are applied with semi
joins, so a request of any size stays distributed; Spark broadcasts the
request side only when its measured size is under the broadcast threshold.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandline.operators._util import as_ids, empty_is_null, first_by, global_row_number, literal_map

# Fixed values that must equal the reference's enumerations.
CODE_TO_TYPE = {
    "GEBA": "germline",
    "TEBA": "somatic_tumor_only",
    "TNEBA": "somatic_tumor_normal",
}
SCHEMA_TO_TYPE = {
    "CQGC_Germline": "germline",
    "CQGC_Exome_Tumeur_Seul": "somatic_tumor_only",
}
TUMOR_NORMAL = "somatic_tumor_normal"
SOMATIC_NORMAL_SUFFIX = "somatic_normal"

IdInput = DataFrame | Iterable[str] | None


def code_to_type(code: Column) -> Column:
    return literal_map(CODE_TO_TYPE)[code]


def _semi(clinical: DataFrame, col: str, ids: IdInput) -> DataFrame:
    req = as_ids(clinical.sparkSession, ids, "_req")
    return clinical.join(req, clinical[col] == req["_req"], "left_semi")


def analysis_ids(clinical: DataFrame, analysis_ids: IdInput = None, sequencing_ids: IdInput = None,
                 batch_ids: IdInput = None) -> DataFrame:
    """Distinct analysis ids matched by any of three request lists (OR)."""
    parts = [
        _semi(clinical, "analysis_id", analysis_ids),
        _semi(clinical, "sequencing_id", sequencing_ids),
        _semi(clinical, "batch_id", batch_ids),
    ]
    out = parts[0].select("analysis_id")
    for p in parts[1:]:
        out = out.unionByName(p.select("analysis_id"))
    return out.distinct()


def batch_ids(clinical: DataFrame, code: str | None = None, analysis_ids: IdInput = None,
              sequencing_ids: IdInput = None) -> DataFrame:
    """Distinct batches of the requested analyses/sequencings, optionally one code."""
    base = clinical if code is None else clinical.where(F.col("bioinfo_analysis_code") == code)
    hit = _semi(base, "analysis_id", analysis_ids).select("batch_id").unionByName(
        _semi(base, "sequencing_id", sequencing_ids).select("batch_id"))
    return hit.distinct()


def latest_batch(clinical: DataFrame, by: str = "analysis_id") -> DataFrame:
    """Batch of the row with the greatest sequencing id, per ``by``."""
    return clinical.groupBy(by).agg(F.max_by("batch_id", "sequencing_id").alias("batch_id"))


def one_batch_per_analysis(clinical: DataFrame) -> DataFrame:
    """Keep the most recent row (by sequencing id) of every analysis."""
    return first_by(clinical, ["analysis_id"], [F.col("sequencing_id"), F.col("batch_id")], descending=True)


def group_by_batch(clinical: DataFrame, ids: IdInput, most: int = 10_000) -> DataFrame:
    """Requested analyses grouped by the batch of their latest row: (batch_id, part, analysis_ids), the ids sorted and at most
    ``most`` in a row. A batch with more has several rows, their ids in the order of ``part`` (from 0)."""
    latest = one_batch_per_analysis(_semi(clinical, "analysis_id", ids)).select("batch_id", "analysis_id")
    numbered = global_row_number(latest, ["batch_id", "analysis_id"], name="_n")
    start = numbered.groupBy("batch_id").agg(F.min("_n").alias("_first")).withColumnRenamed("batch_id", "_b")
    placed = numbered.join(start, F.col("batch_id").eqNullSafe(F.col("_b")))
    part = F.floor((F.col("_n") - F.col("_first")) / most).cast("bigint")
    return placed.groupBy("batch_id", part.alias("part")).agg(F.sort_array(F.collect_list("analysis_id")).alias("analysis_ids"))


def analysis_types(clinical: DataFrame, id_col: str = "analysis_id", ids: IdInput = None) -> DataFrame:
    """Distinct (identifier, analysis type) pairs; unknown codes give NULL type."""
    base = clinical if ids is None else _semi(clinical, id_col, ids)
    return (base.select(F.col(id_col).alias("id"), "bioinfo_analysis_code").distinct()
            .select("id", "bioinfo_analysis_code",
                    code_to_type(F.col("bioinfo_analysis_code")).alias("analysis_type")))


def unknown_codes(clinical: DataFrame, id_col: str = "analysis_id") -> DataFrame:
    """Identifiers carrying a code outside the enumeration (failure rows)."""
    return (clinical.where(code_to_type(F.col("bioinfo_analysis_code")).isNull())
            .select(F.col(id_col).alias("id"), "bioinfo_analysis_code").distinct())


def missing_ids(requested: DataFrame, found: DataFrame, req_col: str = "id", found_col: str = "id") -> DataFrame:
    """Requested identifiers not present in ``found`` (null-safe)."""
    f = found.select(F.col(found_col).alias("_f"))
    return (requested.select(F.col(req_col).alias("id")).distinct()
            .join(f, F.col("id").eqNullSafe(F.col("_f")), "left_anti"))


def resolve_type(requested: IdInput, clinical: DataFrame, metadata: DataFrame, folders: DataFrame,
                 id_col: str = "batch_id") -> DataFrame:
    """Type per requested batch: clinical codes, else metadata submission schema,
    else an existing folder means tumor-normal, else an error row.

    ``metadata``: (batch_id, submission_schema); ``folders``: (batch_id).
    """
    spark = clinical.sparkSession
    req = as_ids(spark, requested, "id").distinct()
    from_clin = (clinical.select(F.col(id_col).alias("id"),
                                 code_to_type(F.col("bioinfo_analysis_code")).alias("clin_type")).distinct())
    meta = metadata.select(F.col("batch_id").alias("id"),
                           literal_map(SCHEMA_TO_TYPE)[F.col("submission_schema")].alias("meta_type"),
                           F.col("submission_schema"))
    fold = folders.select(F.col("batch_id").alias("id")).distinct().withColumn("has_folder", F.lit(True))
    joined = req.join(from_clin, "id", "left").join(meta, "id", "left").join(fold, "id", "left")
    source = (F.when(F.col("clin_type").isNotNull(), "clinical")
              .when(F.col("submission_schema").isNotNull(), "metadata")
              .when(F.col("has_folder"), "folder"))
    atype = F.coalesce("clin_type", "meta_type",
                       F.when(F.col("submission_schema").isNull() & F.col("has_folder"), F.lit(TUMOR_NORMAL)))
    error = (F.when(F.col("clin_type").isNotNull(), None)
             .when(F.col("submission_schema").isNotNull() & F.col("meta_type").isNull(),
                   F.concat(F.lit("Invalid submissionSchema: "), F.col("submission_schema")))
             .when(atype.isNull(), F.concat(F.lit("Batch ID "), F.col("id"), F.lit(" does not exist"))))
    return joined.select("id", atype.alias("analysis_type"), source.alias("source"), error.alias("error"))


def type_conflicts(types: DataFrame, id_kind: str = "batch") -> DataFrame:
    """Identifiers with more than one type. For analysis ids the tumor-normal
    type is removed first (it can only come in through a batch id)."""
    t = types.where(F.col("analysis_type").isNotNull())
    if id_kind == "analysis":
        t = t.where(F.col("analysis_type") != TUMOR_NORMAL)
    return (t.groupBy("id").agg(F.countDistinct("analysis_type").alias("n_types"),
                                F.array_join(F.sort_array(F.collect_set("analysis_type")), ",").alias("types"))
            .where("n_types > 1"))


def shared_identifiers(batch_ids: DataFrame, analysis_ids: DataFrame) -> DataFrame:
    """Values used both as a batch id and as an analysis id."""
    a = batch_ids.select(F.col(batch_ids.columns[0]).alias("id"))
    b = analysis_ids.select(F.col(analysis_ids.columns[0]).alias("id"))
    return a.intersect(b)


def single_type_gate(types: DataFrame) -> DataFrame:
    """One row: number of distinct types over the whole request, and the gate."""
    return types.agg(F.countDistinct("analysis_type").alias("n_types")).select(
        "n_types", (F.col("n_types") <= 1).alias("single_type"))


def filter_by_type(ids: DataFrame, types: DataFrame, targets: list[str]) -> DataFrame:
    """Keep ids whose type is one of ``targets``."""
    keep = types.where(F.col("analysis_type").isin(targets)).select(F.col("id").alias("_k"))
    col = ids.columns[0]
    return ids.join(keep, ids[col] == keep["_k"], "left_semi")


def any_of_type(types: DataFrame, targets: list[str], by: list[str] | None = None) -> DataFrame:
    """Whether any identifier (per ``by`` group, or overall) has a target type."""
    flag = F.bool_or(F.coalesce(F.col("analysis_type").isin(targets), F.lit(False))).alias("any_match")
    return types.groupBy(*(by or [])).agg(flag)


def all_batches(clinical: DataFrame, configured: IdInput = None) -> DataFrame:
    """Distinct batches, numbered in sorted order; a configured list wins."""
    if configured is not None:
        base = as_ids(clinical.sparkSession, configured, "batch_id").distinct()
    else:
        base = clinical.select("batch_id").distinct()
    return global_row_number(base, ["batch_id"], name="position")


def merge_ids(a: DataFrame, b: DataFrame) -> DataFrame:
    """Set union of two id lists."""
    return (a.select(F.col(a.columns[0]).alias("id"))
            .union(b.select(F.col(b.columns[0]).alias("id"))).distinct())


def order_batches(ids: DataFrame) -> DataFrame:
    """De-duplicate and sort; names ending with ``somatic_normal`` go last."""
    col = ids.columns[0]
    base = ids.select(F.col(col).alias("batch_id")).distinct().withColumn(
        "_last", F.col("batch_id").endswith(SOMATIC_NORMAL_SUFFIX))
    return global_row_number(base, ["_last", "batch_id"], name="position").drop("_last")


def chunk(ids: DataFrame, n: int, order: str | None = None) -> DataFrame:
    """Assign consecutive chunks of ``n`` ids in sorted order (remainder last)."""
    col = order or ids.columns[0]
    base = ids.select(F.col(col).alias("id")).distinct()
    numbered = global_row_number(base, ["id"], name="_rn")
    return numbered.withColumn("chunk_no", F.floor((F.col("_rn") - 1) / n).cast("bigint")).drop("_rn")


def json_list(sorted_ids: Column) -> Column:
    """JSON text of a string array, as Python's json.dumps writes it."""
    quoted = F.transform(sorted_ids, lambda x: F.concat(F.lit('"'), x, F.lit('"')))
    return F.concat(F.lit("["), F.array_join(quoted, ", "), F.lit("]"))


def urlsafe_hash(text: Column, length: int = 14) -> Column:
    """First ``length`` chars of url-safe base64 (no padding) of SHA-256."""
    b64 = F.base64(F.unhex(F.sha2(text, 256)))
    return F.substring(F.regexp_replace(F.translate(b64, "+/", "-_"), "=+$", ""), 1, length)


def job_hash(ids: DataFrame, group: str, id_col: str = "id", length: int = 14) -> DataFrame:
    """Per group, the job hash of its sorted id list (the reference hashes an
    unordered set; sorting makes ours stable)."""
    return ids.groupBy(group).agg(
        F.count(id_col).alias("n_ids"),
        urlsafe_hash(json_list(F.sort_array(F.collect_list(id_col))), length).alias("job_hash"))


def arg_list(ids: DataFrame, group: str, id_col: str = "id") -> DataFrame:
    """Per group, the comma-joined sorted id list (command-line argument)."""
    return ids.groupBy(group).agg(F.array_join(F.sort_array(F.collect_list(id_col)), ",").alias("arg_list"))


def prerequisites(clinical: DataFrame, signs: DataFrame, ids: IdInput = None) -> DataFrame:
    """Violations before a germline run, one row per (rule, sequencing):

    * ``no_snv_url``: any row without an SNV file;
    * ``proband_no_cnv_url``: proband without a CNV file;
    * ``proband_no_sign``: proband without any clinical sign.
    URL columns may be strings or arrays; NULL and empty both count as missing.
    """
    base = clinical if ids is None else _semi(clinical, "analysis_id", ids)

    def missing(c: str) -> Column:
        dt = dict(base.dtypes)[c]
        if dt.startswith("array"):
            return empty_is_null(F.col(c))
        return F.coalesce(F.length(F.col(c)), F.lit(0)) == 0

    keys = ["analysis_id", "sequencing_id"]
    no_snv = base.where(missing("snv_url")).select(F.lit("no_snv_url").alias("rule"), *keys)
    no_cnv = base.where(F.col("is_proband") & missing("cnv_url")).select(
        F.lit("proband_no_cnv_url").alias("rule"), *keys)
    no_sign = (base.where("is_proband")
               .join(signs.select("sequencing_id"), "sequencing_id", "left_anti")
               .select(F.lit("proband_no_sign").alias("rule"), *keys))
    return no_snv.unionByName(no_cnv).unionByName(no_sign)
