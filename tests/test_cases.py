"""Literal cases ported from the reference's own tests (see FIXTURES.md §1)."""

import hashlib
import json

import pytest
from pyspark.sql import functions as F

from strandline.operators import catalog as cat
from strandline.operators import cohort, manifest as man, pedigree as ped, releases as rel
from strandline.functions import human_size


def test_analysis_ids_by_sequencing_batch_both_and_none(spark):
    clinical = spark.createDataFrame([
        ("S1", "B1", "A1", "TNEBA"), ("S2", "B2", "A1", "TEBA"), ("S3", "B1", "A2", "GEBA"),
        ("S4", "B3", "A3", "GEBA"), ("S5", "B3", "A4", "GEBA")],
        "sequencing_id string, batch_id string, analysis_id string, bioinfo_analysis_code string")
    ids = lambda df: sorted(r[0] for r in df.collect())
    assert ids(cohort.analysis_ids(clinical, sequencing_ids=["S2"])) == ["A1"]
    assert ids(cohort.analysis_ids(clinical, batch_ids=["B1"])) == ["A1", "A2"]
    assert ids(cohort.analysis_ids(clinical, sequencing_ids=["S4"], batch_ids=["B1"])) == ["A1", "A2", "A3"]
    assert ids(cohort.analysis_ids(clinical, sequencing_ids=["nope"])) == []
    assert ids(cohort.batch_ids(clinical, "TEBA", analysis_ids=["A1"])) == ["B2"]


@pytest.mark.parametrize("n_items,size,expected", [
    (74, 15, [15, 15, 15, 15, 14]), (10, 5, [5, 5]), (0, 5, []), (1, 5, [1]), (3, 1, [1, 1, 1]), (7, 3, [3, 3, 1])])
def test_chunk_sizes(spark, n_items, size, expected):
    ids = spark.createDataFrame([(f"id{i:03d}",) for i in range(n_items)], "id string")
    rows = cohort.chunk(ids, size).groupBy("chunk_no").count().orderBy("chunk_no").collect()
    assert [r["count"] for r in rows] == expected


def test_order_batches_somatic_normal_last(spark):
    ids = spark.createDataFrame([("b_somatic_normal",), ("a",), ("c",), ("a",)], "id string")
    got = [r.batch_id for r in cohort.order_batches(ids).orderBy("position").collect()]
    assert got == ["a", "c", "b_somatic_normal"]


def test_job_hash_matches_python(spark):
    ids = spark.createDataFrame([("g", "SRA2"), ("g", "SRA1"), ("g", "SRA10")], "grp string, id string")
    got = cohort.job_hash(ids, "grp").first()["job_hash"]
    expected = hashlib.sha256(json.dumps(sorted(["SRA2", "SRA1", "SRA10"])).encode()).digest()
    import base64
    assert got == base64.urlsafe_b64encode(expected).decode().rstrip("=")[:14]


FAM = "analysis_id string, family_id string, aliquot_id string, sequencing_id string, is_proband boolean, " \
      "father_aliquot_id string, mother_aliquot_id string"


def test_supported_families_quatuor_and_lone_proband(spark):
    rows = [("A1", "F1", "1", "S1", True, "2", "3"), ("A1", "F1", "2", "S2", False, None, None),
            ("A1", "F1", "3", "S3", False, None, None), ("A1", "F1", "4", "S4", False, "2", "3"),
            ("A2", "F2", "5", "S5", True, None, None), ("A2", "F2", "6", "S6", False, None, None)]
    c = spark.createDataFrame(rows, FAM)
    kept = sorted((r.family_id, r.aliquot_id) for r in ped.supported_families(c).collect())
    assert kept == [("F1", "1"), ("F1", "2"), ("F1", "3")]
    assert [r.aliquot_id for r in ped.dropped_members(c).collect()] == ["4"]


def test_duo_parent_id_compared_as_string(spark):
    c = spark.createDataFrame([("A1", "F1", "5", "S5", True, None, 6), ("A1", "F1", "6", "S6", False, None, None)],
                              "analysis_id string, family_id string, aliquot_id string, sequencing_id string, "
                              "is_proband boolean, father_aliquot_id int, mother_aliquot_id int")
    assert sorted(r.aliquot_id for r in ped.supported_families(c).collect()) == ["5", "6"]


def test_coerce_parent_sex(spark):
    rows = [("A1", "1", "unknown", True, "2", "3"), ("A1", "2", "unknown", False, None, None),
            ("A1", "3", "unknown", False, None, None), ("A1", "4", "unknown", False, None, None),
            ("A2", "5", "Female", True, "6", None), ("A2", "6", "Female", False, None, None)]
    c = spark.createDataFrame(rows, "analysis_id string, aliquot_id string, gender string, is_proband boolean, "
                                    "father_aliquot_id string, mother_aliquot_id string")
    got = {r.aliquot_id: r.pedigree_sex for r in ped.coerce_parent_sex(c).collect()}
    assert got == {"1": "UNKNOWN_SEX", "2": "MALE", "3": "FEMALE", "4": "UNKNOWN_SEX", "5": "FEMALE", "6": "FEMALE"}


def test_earliest_onset_and_default(spark):
    s = spark.createDataFrame([("S1", "HP:1", "HP:0003584"), ("S1", "HP:2", "HP:0003577"), ("S2", "HP:3", None)],
                              "sequencing_id string, hpo_id string, age_at_onset string")
    got = {r.sequencing_id: r.onset for r in ped.earliest_onset(s).collect()}
    assert got == {"S1": "HP:0003577"}
    assert spark.range(1).select(ped.onset_or_default(F.lit(None).cast("string"))).first()[0] == "HP:0003674"


def test_name_parts(spark):
    df = spark.createDataFrame([("family - SRA1_2",), ("12 - SRA7",), ("12 - None",)], "n string")
    got = [(r[0], r[1]) for r in df.select(ped.name_aliquot(F.col("n")), ped.name_analysis(F.col("n"))).collect()]
    assert got == [(None, "SRA1"), ("12", "SRA7"), ("12", None)]


def test_file_prefix_and_path_param(spark):
    keys = spark.createDataFrame([
        ("BATCH_1/1.case.hard-filtered.formatted.norm.VEP.vcf.gz",),
        ("post_processing/output/ensemblvep/variants.A2.snv.norm.VEP.vcf.gz",),
        ("raw/landing/franklin/family_id=F1/aliquot_id=null/analysis_id=A9/x.txt",)], "object_key string")
    got = [r[0] for r in keys.select(cat.file_prefix(F.col("object_key"))).collect()]
    assert got[:2] == ["1", "A2"]
    r = keys.select(cat.path_param(F.col("object_key"), "family_id").alias("f"),
                    cat.path_param(F.col("object_key"), "aliquot_id").alias("a"),
                    cat.path_param(F.col("object_key"), "analysis_id").alias("n")).collect()[2]
    assert (r.f, r.a, r.n) == ("F1", None, "A9")


def test_invalid_prefixes(spark):
    keys = spark.createDataFrame([("B/.case.hard-filtered.formatted.norm.VEP.vcf.gz",), ("B/variants..snv.norm.VEP.vcf.gz",),
                                  ("B/1.case.hard-filtered.formatted.norm.VEP.vcf.gz",), ("B/.txt",), (None,)], "object_key string")
    got = {r.object_key: r.error for r in cat.invalid_prefixes(keys).collect()}
    assert got["B/.case.hard-filtered.formatted.norm.VEP.vcf.gz"] == "Invalid VCF prefix: B/.case.hard-filtered.formatted.norm.VEP.vcf.gz"
    assert "B/1.case.hard-filtered.formatted.norm.VEP.vcf.gz" not in got and "B/.txt" not in got


def test_attach_pipeline_file_beats_legacy(spark):
    clinical = spark.createDataFrame([("S1", "A2", "BAT1", "1", None)],
                                     "sequencing_id string, analysis_id string, batch_id string, aliquot_id string, "
                                     "family_id string")
    keys = spark.createDataFrame([("BAT1/1.case.hard-filtered.formatted.norm.VEP.vcf.gz",),
                                  ("post_processing/output/ensemblvep/variants.A2.snv.norm.VEP.vcf.gz",)],
                                 "object_key string")
    r = cat.attach_files(clinical, keys).first()
    assert r.vcf_key.startswith("post_processing/") and r.rule == 1


def test_dedup_samples_lenient_and_strict(spark):
    m = spark.createDataFrame([("F2", "3", "s3://b/x.vcf"), ("F1", "3", "s3://b/y.vcf"), ("F1", "4", "s3://b/z.vcf")],
                              "familyId string, sample string, vcf string")
    got = sorted((r.familyId, r.sample) for r in man.dedup_samples(m, "first").collect())
    assert got == [("F1", "3"), ("F1", "4")]
    with pytest.raises(Exception, match=r"Duplicate aliquot_ids: \['3'\]"):
        man.dedup_samples(m, "error").collect()


def test_first_s3_rewrites_only_first(spark):
    df = spark.createDataFrame([(["s3a://b/k/s3a://x"],)], "u array<string>")
    assert df.select(man.first_s3(F.col("u"))).first()[0] == "s3://b/k/s3a://x"


@pytest.mark.parametrize("release,prev,status", [("re_005", "re_003", "ok"), ("re_001", None, "none"),
                                                 ("rel_01", None, "invalid"), ("re_12", None, "invalid")])
def test_previous_release(spark, release, prev, status):
    p, s = rel.previous_release(F.lit(release))
    r = spark.range(1).select(p, s).first()
    assert (r[0], r[1]) == (prev, status)


@pytest.mark.parametrize("n,expected", [(5 * 2 ** 17, "0.62 MB"), (1048576 * 1500, "1.46 GB"), (0, "0.00 MB")])
def test_human_size(spark, n, expected):
    assert spark.range(1).select(human_size(F.lit(n))).first()[0] == expected
