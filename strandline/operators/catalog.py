"""File catalogue: object keys as a table.

Listing results are rows (``object_key``); path parameters, prefixes and file
attachment are column expressions and equi-joins over them, so matching any
number of files to any number of samples is a shuffle join, never a loop.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandline.operators._util import first_by

# Fixed values that must equal the reference's file-name conventions.
SNV_GERMLINE = ".norm.VEP.vcf.gz"
SNV_GERMLINE_LEGACY = ".hard-filtered.formatted.norm.VEP.vcf.gz"
SNV_SOMATIC_TUMOR_ONLY = ".dragen.WES_somatic-tumor_only.hard-filtered.norm.VEP.vcf.gz"
SNV_SOMATIC_TUMOR_NORMAL = ".vcf.gz"
CNV_GERMLINE = ".cnv.vcf.gz"
CNV_SOMATIC_TUMOR_ONLY = ".dragen.WES_somatic-tumor_only.cnv.vcf.gz"
PREFIX_STRIP = [SNV_GERMLINE_LEGACY, SNV_GERMLINE, ".case", ".snv", "variants."]
PIPELINE_FOLDER = "post_processing/output/ensemblvep/"
LANDING_ROOT = "raw/landing/franklin/"
STATUS_MARKER = "_FRANKLIN_STATUS_.txt"
ID_MARKER = "_FRANKLIN_ID_.txt"
SHARED_MARKER = "_FRANKLIN_IDS_.txt"
TASK_ROOT = "raw/landing/phenovar/"
TASK_STATUS_MARKER = "_PHENOVAR_STATUS_.txt"
TASK_ID_MARKER = "_PHENOVAR_TASK_ID_.txt"
TASK_RESULT = "phenovar_result.json"
GERMLINE_SCHEMA = "CQGC_Germline"
TUMOR_ONLY_SCHEMA = "CQGC_Exome_Tumeur_Seul"


def basename(key: Column) -> Column:
    return F.substring_index(key, "/", -1)


def path_param(key: Column, name: str) -> Column:
    """Value of the ``name=`` path segment; ``null`` text -> NULL; absent -> NULL
    (pair with :func:`has_path_param` to report the error)."""
    v = F.regexp_extract(key, rf"(?:^|/){name}=([^/=]*)", 1)
    return F.when(has_path_param(key, name), F.nullif(v, F.lit("null")))


def has_path_param(key: Column, name: str) -> Column:
    return key.rlike(rf"(?:^|/){name}=")


def file_prefix(key: Column) -> Column:
    """Basename with the known suffixes removed, in order (every occurrence)."""
    out = basename(key)
    for s in PREFIX_STRIP:
        out = F.replace(out, F.lit(s), F.lit(""))
    return out


def invalid_prefixes(keys: DataFrame, key_col: str = "object_key") -> DataFrame:
    """(object_key, error) of the VCF keys that have no prefix: nothing is left of their name without the suffixes."""
    vcf = F.col(key_col).endswith(SNV_GERMLINE) | F.col(key_col).endswith(SNV_GERMLINE_LEGACY)
    return keys.where(vcf & (F.length(file_prefix(F.col(key_col))) == 0)).select(
        F.col(key_col).alias("object_key"), F.concat(F.lit("Invalid VCF prefix: "), F.col(key_col)).alias("error"))


def discover(keys: DataFrame, suffix: str, source: str, folder: str | None = None,
             key_col: str = "object_key") -> DataFrame:
    """Keys with ``suffix`` (optionally under ``folder``), tagged with their
    bucket and prefix."""
    k = keys.where(F.col(key_col).endswith(suffix))
    if folder:
        k = k.where(F.col(key_col).startswith(folder))
    return k.select(F.col(key_col).alias("object_key"), F.lit(source).alias("bucket"),
                    file_prefix(F.col(key_col)).alias("prefix"))


def attach_files(clinical: DataFrame, keys: DataFrame, probands: DataFrame | None = None,
                 key_col: str = "object_key") -> DataFrame:
    """Best SNV file per clinical row (keyed by sequencing id):

    1. a pipeline file whose prefix is the analysis id;
    2. else, in the row's batch folder, a legacy file whose prefix is the
       family proband's aliquot;
    3. else the first legacy file (key order) that is alone in the folder or
       whose prefix is the row's aliquot or family id;
    otherwise an error row. ``probands``: (family_id, proband_aliquot_id).
    """
    place, batch, prefix = F.col(key_col), F.substring_index(F.col(key_col), "/", 1), file_prefix(F.col(key_col))
    piped = place.endswith(SNV_GERMLINE) & place.startswith(PIPELINE_FOLDER)
    legacy = place.endswith(SNV_GERMLINE_LEGACY) & place.contains("/")

    def spot(kind: str, folder: Column, name: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), folder.alias("folder"), name.alias("name"))

    none = F.lit("")
    # every file stands where rows may look for it; the first key of a spot is enough, a lone file is alone in its folder
    spots = keys.where(piped | legacy).select(F.col(key_col).alias("object_key"), F.explode(F.array_compact(F.array(
        F.when(piped, spot("pipeline", none, prefix)), F.when(legacy, spot("legacy", batch, prefix)),
        F.when(legacy, spot("lone", batch, none))))).alias("s"))
    first = (spots.groupBy("s.kind", "s.folder", "s.name").agg(F.min("object_key").alias("object_key"), F.count("*").alias("n"))
             .where("kind <> 'lone' OR n = 1").drop("n"))
    rows = clinical.select("sequencing_id", "analysis_id", "batch_id", "aliquot_id", "family_id")
    if probands is not None:
        rows = rows.join(probands, "family_id", "left")
    else:
        rows = rows.withColumn("proband_aliquot_id", F.lit(None).cast("string"))
    looks = F.array(*[F.struct(F.lit(rule).alias("rank"), spot(kind, folder, F.col(name) if name else none).alias("s")) for rule, kind, folder, name in (
        (1, "pipeline", none, "analysis_id"), (2, "legacy", F.col("batch_id"), "proband_aliquot_id"), (3, "lone", F.col("batch_id"), None),
        (3, "legacy", F.col("batch_id"), "aliquot_id"), (3, "legacy", F.col("batch_id"), "family_id"))])
    looked = rows.select("sequencing_id", F.explode(looks).alias("l")).select("sequencing_id", "l.rank", "l.s.*").where(
        "folder IS NOT NULL AND name IS NOT NULL")
    best = looked.join(first, ["kind", "folder", "name"]).groupBy("sequencing_id").agg(
        F.min(F.struct("rank", "object_key")).alias("_best"))
    out = rows.join(best, "sequencing_id", "left")
    return out.select("sequencing_id", "analysis_id", "aliquot_id",
                      F.col("_best.object_key").alias("vcf_key"), F.col("_best.rank").alias("rule"),
                      F.when(F.col("_best").isNull(),
                             F.concat(F.lit("No VCF to attach for aliquot_id "), F.col("aliquot_id")))
                      .alias("error"))


def s3_parts(url: Column) -> tuple[Column, Column, Column]:
    """(bucket, key, error) of an ``s3://``/``s3a://`` URL, optionally wrapped in
    ``WrappedArray(...)``."""
    u = F.trim(url)
    u = F.when(u.startswith("WrappedArray("), F.substring(u, F.lit(14), F.length(u) - 14)).otherwise(u)
    rest = (F.when(u.startswith("s3a://"), F.substring(u, 7, F.lit(1 << 30)))
            .when(u.startswith("s3://"), F.substring(u, 6, F.lit(1 << 30))))
    bucket = F.substring_index(rest, "/", 1)
    key = F.when(F.instr(rest, "/") > 0, F.substring(rest, F.instr(rest, "/") + 1, F.lit(1 << 30))) \
        .when(rest.isNotNull(), F.lit(""))
    error = F.when(rest.isNull(), F.concat(F.lit("Invalid S3 URL format: "), u))
    return bucket, key, error


def gzip_name(content: Column, name: Column) -> Column:
    """``name`` + ``.gz`` when the bytes start with the gzip magic number and
    the name does not already end with ``.gz``."""
    magic = F.substring(content, 1, 2) == F.unhex(F.lit("1F8B"))
    return F.when(magic & ~name.endswith(".gz"), F.concat(name, F.lit(".gz"))).otherwise(name)


def read_binary(spark, path: str, glob: str | None = None) -> DataFrame:
    r = spark.read.format("binaryFile")
    if glob:
        r = r.option("pathGlobFilter", glob)
    return r.load(path)


def file_names(spark, path: str, glob: str | None = None) -> DataFrame:
    """(path, file_name) of the files at ``path``: the names that their copies get, with ``.gz`` where the content is gzip and
    the name does not say so (:func:`gzip_name`). Files are read whole, one a row, and may have 2 GB at
    most; empty files have no row."""
    b = read_binary(spark, path, glob)
    return b.select("path", gzip_name(F.col("content"), basename(F.col("path"))).alias("file_name"))


def batch_has_snv(keys: DataFrame, suffix: str, batches: DataFrame | None = None,
                  key_col: str = "object_key") -> DataFrame:
    """Per batch folder, whether at least one key ends with ``suffix``."""
    k = keys.where(F.instr(F.col(key_col), "/") > 0).select(
        F.substring_index(F.col(key_col), "/", 1).alias("batch_id"),
        F.col(key_col).endswith(suffix).alias("_hit"))
    facts = k.groupBy("batch_id").agg(F.bool_or("_hit").alias("has_snv"))
    if batches is None:
        return facts
    return batches.join(facts, "batch_id", "left").select(
        "batch_id", F.coalesce("has_snv", F.lit(False)).alias("has_snv"))


def batch_cnv_valid(declared: DataFrame, suffix: str, file_col: str = "cnv_vcf") -> DataFrame:
    """Per batch, whether every declared (non-null) CNV file ends with ``suffix``."""
    ok = F.when(F.col(file_col).isNotNull(), F.col(file_col).endswith(suffix))
    return declared.groupBy("batch_id").agg(F.coalesce(F.bool_and(ok), F.lit(True)).alias("cnv_valid"))


def validate_batch(batches: DataFrame, metadata: DataFrame, keys: DataFrame, declared: DataFrame,
                   key_col: str = "object_key") -> DataFrame:
    """Violations of the per-type rule set, one row per (batch, rule).

    ``batches``: (batch_id, analysis_type); ``metadata``: (batch_id,
    submission_schema); ``declared``: (batch_id, cnv_vcf).
    """
    k = keys.where(F.instr(F.col(key_col), "/") > 0).select(
        F.substring_index(F.col(key_col), "/", 1).alias("batch_id"), F.col(key_col).alias("_k"))
    snv = k.groupBy("batch_id").agg(
        F.bool_or(F.col("_k").endswith(SNV_GERMLINE)).alias("snv_germline"),
        F.bool_or(F.col("_k").endswith(SNV_SOMATIC_TUMOR_ONLY)).alias("snv_tumor_only"),
        F.bool_or(F.col("_k").endswith(SNV_SOMATIC_TUMOR_NORMAL)).alias("snv_tumor_normal"))
    cnv = declared.groupBy("batch_id").agg(
        F.coalesce(F.bool_and(F.when(F.col("cnv_vcf").isNotNull(), F.col("cnv_vcf").endswith(CNV_GERMLINE))),
                   F.lit(True)).alias("cnv_germline"),
        F.coalesce(F.bool_and(F.when(F.col("cnv_vcf").isNotNull(),
                                     F.col("cnv_vcf").endswith(CNV_SOMATIC_TUMOR_ONLY))),
                   F.lit(True)).alias("cnv_tumor_only"))
    meta = metadata.select("batch_id", "submission_schema").withColumn("_has_meta", F.lit(True))
    f = (batches.join(meta, "batch_id", "left").join(snv, "batch_id", "left").join(cnv, "batch_id", "left")
         .na.fill(False, ["_has_meta", "snv_germline", "snv_tumor_only", "snv_tumor_normal"])
         .na.fill(True, ["cnv_germline", "cnv_tumor_only"]))
    t = F.col("analysis_type")
    germ = t == "germline"
    to = (t == "somatic_tumor_only") & F.col("_has_meta")
    tn = t == "somatic_tumor_normal"
    rules = F.array(
        F.when(germ & F.col("_has_meta") & (F.col("submission_schema") != GERMLINE_SCHEMA), "invalid_schema"),
        F.when(to & (F.col("submission_schema") != TUMOR_ONLY_SCHEMA), "invalid_schema"),
        F.when(germ & ~F.col("snv_germline"), "no_snv_vcf"),
        F.when(to & ~F.col("snv_tumor_only"), "no_snv_vcf"),
        F.when(tn & ~F.col("snv_tumor_normal"), "no_snv_vcf"),
        F.when(germ & ~F.col("cnv_germline"), "invalid_cnv_vcf"),
        F.when(to & ~F.col("cnv_tumor_only"), "invalid_cnv_vcf"),
        F.when(tn & F.col("_has_meta"), "metadata_present"),
    )
    return f.select("batch_id", "analysis_type", F.explode(rules).alias("rule")).where(F.col("rule").isNotNull())


# The fields of a batch's metadata, by group (the first group is an analysis itself).
METADATA_FIELDS: dict[str, list[str]] = {
    "": ["ldm", "ldmSampleId", "ldmSpecimenId", "specimenType", "sampleType", "ldmServiceRequestId", "labAliquotId", "analysisCode"],
    "patient": ["firstName", "lastName", "sex", "ramq", "birthDate", "mrn", "ep", "designFamily", "familyMember", "familyId", "status"],
    "files": ["cnv_calls_png", "cnv_tbi", "cnv_vcf", "coverage_by_gene_csv", "crai", "cram", "exomiser_html", "exomiser_json",
              "exomiser_variants_tsv", "hard_filtered_baf_bw", "hyper_exome_hg38_bed", "qc_metrics", "roh_bed", "seg_bw", "snv_tbi",
              "snv_vcf", "supplement", "sv_tbi", "sv_vcf"],
    "experiment": ["platform", "sequencerId", "runName", "runDate", "runAlias", "flowcellId", "isPairedEnd", "fragmentSize",
                   "experimentalStrategy", "captureKit", "baitDefinition"],
    "workflow": ["name", "version", "genomeBuild"],
}
METADATA_TYPES = {"isPairedEnd": "boolean", "fragmentSize": "bigint"}


def read_metadata(spark, path: str) -> DataFrame:
    """Batch metadata files -> one row per analysis: file, submission_schema, the fields of ``METADATA_FIELDS`` (``{group}_{field}``,
    NULL where a file lacks one or holds another kind of value), ``analysis`` (the whole analysis as a variant, for any further
    field, see :func:`metadata_field`) and ``error``. A file that is no JSON, has a key twice or holds no list of analyses is one
    row with its ``error``; an empty list gives no row. Nothing is inferred, so no file is read when this is called. A file is
    one JSON document and hence one record."""
    docs = spark.read.text(path, wholetext=True).select(
        F.col("_metadata.file_path").alias("file"), F.try_parse_json("value").alias("doc"))
    return flatten_metadata(docs)


def metadata_field(field: str, dtype: str = "string") -> Column:
    """A field of the ``analysis`` variant by its path (``files.cnv_vcf``)."""
    return F.try_variant_get("analysis", f"$.{field}", dtype)


def flatten_metadata(docs: DataFrame) -> DataFrame:
    """:func:`read_metadata` for documents already parsed: file, doc (variant, NULL where it is none)."""
    listed = F.try_variant_get("doc", "$.analyses", "array<variant>")
    error = F.when(F.col("doc").isNull(), "Invalid JSON").when(listed.isNull(), "No list of analyses")
    rows = docs.withColumn("error", error).withColumn("_all", F.when(F.col("error").isNull(), listed).otherwise(
        F.array(F.lit(None).cast("variant"))))
    a = rows.select("file", F.try_variant_get("doc", "$.submissionSchema", "string").alias("submission_schema"), "error",
                    F.explode("_all").alias("analysis"))
    cols = [metadata_field(f"{g}.{f}" if g else f, METADATA_TYPES.get(f, "string")).alias(f"{g}_{f}" if g else f)
            for g, fields in METADATA_FIELDS.items() for f in fields]
    return a.select("file", "submission_schema", *cols, "analysis", "error")


def pending_ids(keys: DataFrame, folder: str = ".etl-run/", key_col: str = "object_key") -> DataFrame:
    """Ids dropped in the inbox folder: ``.txt`` / ``.sequencing_id`` ->
    sequencing ids, ``.batch_id`` -> batch ids. Empty names are ignored."""
    name = F.when(F.col(key_col).startswith(folder), F.substring(F.col(key_col), len(folder) + 1, 1 << 30))
    kind = (F.when(name.endswith(".txt") | name.endswith(".sequencing_id"), "sequencing_id")
            .when(name.endswith(".batch_id"), "batch_id"))
    ident = F.regexp_replace(name, r"\.(txt|sequencing_id|batch_id)$", "")
    out = keys.select(kind.alias("kind"), ident.alias("id"))
    return out.where(F.col("kind").isNotNull() & (F.length("id") > 0))


def not_yet_done(ids: DataFrame, done: DataFrame) -> DataFrame:
    """Requested ids without a result."""
    return ids.join(done, ids.columns[0], "left_anti")


def _open_requests(open_analyses: DataFrame, status: DataFrame, request: str | None) -> DataFrame:
    """(analysis_id, _open): analyses of requests of which an analysis is open. Without a request column all analyses are
    one request, so the table has one row for all (NULL id) or none."""
    if request is None:
        return open_analyses.limit(1).select(F.lit(None).cast("string").alias("analysis_id"))
    of = status.select(F.col("analysis_id"), F.col(request).alias("_r")).distinct()
    late = of.join(open_analyses, "analysis_id", "left_semi").select("_r").distinct()
    held = of.join(late, of["_r"].eqNullSafe(late["_r"]), "left_semi").select("analysis_id")
    return held.unionByName(open_analyses).distinct()


def _of_finished_requests(keys: DataFrame, held: DataFrame, request: str | None) -> DataFrame:
    """Keys (object_key, analysis_id) whose request has no open analysis."""
    if request is None:  # one row or none
        any_open = held.agg(F.count(F.lit(1)).alias("n")).select("n").scalar()
        return keys.where(any_open == 0)
    h = held.select(F.col("analysis_id").alias("_h"))
    return keys.join(h, F.col("analysis_id") == F.col("_h"), "left_anti")


def cleanup_plan(keys: DataFrame, status: DataFrame, exchange: DataFrame | None = None, env: str = "prod",
                 key_col: str = "object_key", request: str | None = None) -> DataFrame:
    """(object_key, reason) of the keys to delete after a run; nothing is deleted here. Only listed keys are planned:

    * ``completed_status`` / ``completed_id``: the status marker and the id marker of a member whose status is COMPLETED;
    * ``shared_marker``: the shared marker of an analysis whose request is finished;
    * ``exchange_vcf``: the copies ``{env}/{analysis_id}/...`` in the listing of the exchange area, likewise.

    A request is finished when no analysis of it is open: none has a status that is not COMPLETED, be its marker listed or
    not, and no status marker without a known status is listed. ``request`` names the column of ``status`` that says which
    request an analysis belongs to; without it all analyses are one request.
    ``status``: (analysis_id, aliquot_id, status), a row per marker; aliquot_id is NULL where the key says ``null``.
    ``exchange``: the listing of the exchange bucket, a bucket of its own; the pipeline's output is never planned.
    """
    landing = keys.where(F.col(key_col).startswith(LANDING_ROOT)).select(
        F.col(key_col).alias("object_key"), path_param(F.col(key_col), "analysis_id").alias("analysis_id"),
        path_param(F.col(key_col), "aliquot_id").alias("aliquot_id"), basename(F.col(key_col)).alias("_name")).distinct()
    s = status.select(F.col("analysis_id").alias("_a"), F.col("aliquot_id").alias("_q"),
                      (F.col("status") == "COMPLETED").alias("_done"))
    member = landing.join(s, (F.col("analysis_id") == F.col("_a")) & F.col("aliquot_id").eqNullSafe(F.col("_q")), "left") \
        .withColumn("_done", F.coalesce("_done", F.lit(False)))
    is_status, is_id = F.col("_name") == STATUS_MARKER, F.col("_name") == ID_MARKER
    markers = member.where("_done").where(is_status | is_id).select(
        "object_key", F.when(is_status, "completed_status").otherwise("completed_id").alias("reason"))
    open_ = member.where(is_status & ~F.col("_done")).select("analysis_id").unionByName(
        status.where(~F.coalesce(F.col("status") == "COMPLETED", F.lit(False))).select("analysis_id")).distinct()
    held = _open_requests(open_, status, request)
    shared = _of_finished_requests(landing.where(F.col("_name") == SHARED_MARKER).select("object_key", "analysis_id"), held, request)
    out = markers.unionByName(shared.select("object_key", F.lit("shared_marker").alias("reason")))
    if exchange is not None:
        copies = exchange.where(F.col(key_col).startswith(f"{env}/") & F.col(key_col).endswith(SNV_GERMLINE)).select(
            F.col(key_col).alias("object_key"), F.split(F.col(key_col), "/").getItem(env.count("/") + 1).alias("analysis_id"))
        known = copies.join(status.select("analysis_id").distinct(), "analysis_id", "left_semi").select("object_key", "analysis_id")
        out = out.unionByName(_of_finished_requests(known, held, request)
                              .select("object_key", F.lit("exchange_vcf").alias("reason")))
    return out.distinct()


def cleanup_tasks(keys: DataFrame, status: DataFrame, exchange: DataFrame | None = None,
                  key_col: str = "object_key", request: str | None = None) -> DataFrame:
    """(object_key, reason) of the keys to delete for the service that works per analysis; nothing is deleted here.
    Only listed keys are planned:

    * ``finished_status`` / ``finished_task``: the status and the task marker of an analysis whose status is FAILURE,
      or SUCCESS with its result listed;
    * ``import_vcf``: every ``.vcf`` / ``.vcf.gz`` below ``{analysis_id}/`` in the listing of the import area, once every
      analysis of its request has the status SUCCESS or FAILURE: what a running one reads is never planned.

    ``status``: (analysis_id, status), one row per analysis of the request; ``request`` as in :func:`cleanup_plan`.
    """
    landing = keys.where(F.col(key_col).startswith(TASK_ROOT)).select(
        F.col(key_col).alias("object_key"), path_param(F.col(key_col), "analysis_id").alias("analysis_id"),
        basename(F.col(key_col)).alias("_name")).distinct()
    result = landing.where(F.col("_name") == TASK_RESULT).select("analysis_id").distinct()
    listed = landing.where(F.col("_name") == TASK_STATUS_MARKER).select("analysis_id").distinct()
    finished = status.where(F.col("status") == "FAILURE").select("analysis_id").unionByName(
        status.where(F.col("status") == "SUCCESS").select("analysis_id").join(result, "analysis_id", "left_semi"))
    finished = finished.join(listed, "analysis_id", "left_semi").distinct()
    out = landing.where(F.col("_name").isin(TASK_STATUS_MARKER, TASK_ID_MARKER)).join(
        finished, "analysis_id", "left_semi").select(
        "object_key", F.when(F.col("_name") == TASK_STATUS_MARKER, "finished_status").otherwise("finished_task")
        .alias("reason"))
    if exchange is not None:
        copies = exchange.where(F.col(key_col).endswith(".vcf") | F.col(key_col).endswith(".vcf.gz")).where(
            F.col(key_col).contains("/")).select(
            F.col(key_col).alias("object_key"), F.substring_index(F.col(key_col), "/", 1).alias("analysis_id"))
        known = copies.join(status.select("analysis_id").distinct(), "analysis_id", "left_semi").select("object_key", "analysis_id")
        open_ = status.where(~F.coalesce(F.col("status").isin("SUCCESS", "FAILURE"), F.lit(False))).select("analysis_id").distinct()
        out = out.unionByName(_of_finished_requests(known, _open_requests(open_, status, request), request)
                              .select("object_key", F.lit("import_vcf").alias("reason")))
    return out.distinct()


def latest_per_key(df: DataFrame, key: str, order: list[Column]) -> DataFrame:
    """Latest row per key by ``order`` columns (descending)."""
    return first_by(df, [key], order, descending=True)
