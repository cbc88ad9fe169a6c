"""Clean-up plans: members of different status, listed keys only, never the pipeline's output."""

from pyspark.sql import functions as F

from strandline.operators import catalog as cat

ROOT = "raw/landing/franklin/analysis_id="
TASK = "raw/landing/phenovar/analysis_id="


def _keys(spark, names):
    return spark.createDataFrame([(n,) for n in names], "object_key string")


def _plan(df):
    return {(r.object_key, r.reason) for r in df.collect()}


def test_cleanup_per_member(spark):
    st, ident, shared = cat.STATUS_MARKER, cat.ID_MARKER, cat.SHARED_MARKER
    keys = _keys(spark, [
        f"{ROOT}A1/aliquot_id=1/{st}", f"{ROOT}A1/aliquot_id=1/{ident}", f"{ROOT}A1/aliquot_id=2/{st}",
        f"{ROOT}A1/aliquot_id=2/{ident}", f"{ROOT}A1/{shared}",
        f"{ROOT}A2/aliquot_id=null/{st}", f"{ROOT}A2/{shared}", f"{ROOT}A3/{shared}",
        "post_processing/output/ensemblvep/variants.A2.snv.norm.VEP.vcf.gz"])
    status = spark.createDataFrame([("A1", "1", "COMPLETED"), ("A1", "2", "READY"), ("A2", None, "COMPLETED")],
                                   "analysis_id string, aliquot_id string, status string")
    area = _keys(spark, ["prod/A1/x.norm.VEP.vcf.gz", "prod/A2/x.norm.VEP.vcf.gz", "prod/A2/x.json",
                         "prod/A22/x.norm.VEP.vcf.gz", "test/A2/x.norm.VEP.vcf.gz"])
    own = {(f"{ROOT}A1/aliquot_id=1/{st}", "completed_status"), (f"{ROOT}A1/aliquot_id=1/{ident}", "completed_id"),
           (f"{ROOT}A2/aliquot_id=null/{st}", "completed_status")}
    assert _plan(cat.cleanup_plan(keys, status, area)) == own  # A1 is open, and with it the whole request
    alone = status.withColumn("of", F.col("analysis_id"))
    assert _plan(cat.cleanup_plan(keys, alone, area, request="of")) == own | {
        (f"{ROOT}A2/{shared}", "shared_marker"), (f"{ROOT}A3/{shared}", "shared_marker"), ("prod/A2/x.norm.VEP.vcf.gz", "exchange_vcf")}
    # open by its status, though its marker is not listed
    unlisted = spark.createDataFrame([("A2", None, "COMPLETED", "r"), ("A7", "1", "IN_PROGRESS", "r"), ("A1", "1", "COMPLETED", "q")],
                                     "analysis_id string, aliquot_id string, status string, of string")
    assert ("prod/A2/x.norm.VEP.vcf.gz", "exchange_vcf") not in _plan(cat.cleanup_plan(keys, unlisted, area, request="of"))
    done = spark.createDataFrame([("A1", "1", "COMPLETED"), ("A1", "2", "COMPLETED"), ("A2", None, "COMPLETED")],
                                 "analysis_id string, aliquot_id string, status string")
    assert {k for k, why in _plan(cat.cleanup_plan(keys, done, area)) if why in ("shared_marker", "exchange_vcf")} == {
        f"{ROOT}A1/{shared}", f"{ROOT}A2/{shared}", f"{ROOT}A3/{shared}", "prod/A1/x.norm.VEP.vcf.gz", "prod/A2/x.norm.VEP.vcf.gz"}


def test_cleanup_of_tasks(spark):
    names = [f"{TASK}{a}/{m}" for a in ("A1", "A2", "A3", "A4") for m in (cat.TASK_STATUS_MARKER, cat.TASK_ID_MARKER)]
    keys = _keys(spark, [*names, f"{TASK}A1/{cat.TASK_RESULT}", f"{TASK}A5/{cat.TASK_ID_MARKER}"])
    status = spark.createDataFrame([("A1", "SUCCESS"), ("A2", "SUCCESS"), ("A3", "FAILURE"), ("A4", "STARTED"),
                                    ("A5", "FAILURE")], "analysis_id string, status string")
    area = _keys(spark, ["A1/x.vcf", "A1/x.vcf.gz", "A1/x.json", "A9/x.vcf", "A1.vcf"])
    area = area.unionByName(_keys(spark, ["A4/in.vcf.gz"]))
    copies = {("A1/x.vcf", "import_vcf"), ("A1/x.vcf.gz", "import_vcf")}
    want = {
        (f"{TASK}A1/{cat.TASK_STATUS_MARKER}", "finished_status"), (f"{TASK}A1/{cat.TASK_ID_MARKER}", "finished_task"),
        (f"{TASK}A3/{cat.TASK_STATUS_MARKER}", "finished_status"), (f"{TASK}A3/{cat.TASK_ID_MARKER}", "finished_task"),
    }
    assert _plan(cat.cleanup_tasks(keys, status, area)) == want  # A4 is running: no copy of its request goes
    assert _plan(cat.cleanup_tasks(keys, status.withColumn("of", F.col("analysis_id")), area, request="of")) == want | copies
    over = status.withColumn("status", F.when(F.col("status") == "STARTED", "FAILURE").otherwise(F.col("status")))
    assert copies | {("A4/in.vcf.gz", "import_vcf")} <= _plan(cat.cleanup_tasks(keys, over, area))
