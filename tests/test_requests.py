"""Request documents field by field, on the cases that the services' clients know."""

import gzip
import json

import pytest
from pyspark.sql import functions as F

from strandline.operators import catalog as cat
from strandline.operators import pedigree as ped

CLINICAL = ("analysis_id string, family_id string, aliquot_id string, sequencing_id string, is_proband boolean, father_aliquot_id string, "
            "mother_aliquot_id string, affected_status boolean, first_name string, birth_date string, gender string, snv_url string, cnv_url string")
ROWS = [
    ("A1", None, "1", "S1", True, None, None, True, "Jean", "2000-01-01", "Male", "s3a://b/d/1.vcf.gz", None),
    ("A2", "FM1", "2", "S2", True, "3", "4", True, "Jean", "2000-01-01", "Male", "WrappedArray(s3a://b/2.snv)", "s3://b/2.cnv.gz"),
    ("A2", "FM1", "3", "S3", False, None, None, False, "Jeannot", "1970-01-01", "Male", None, ""),
    ("A2", "FM1", "4", "S4", False, None, None, None, None, None, "Female", None, "None"),
    ("A3", None, "5", "S5", True, None, None, False, "Ann", "2001-02-03", "unknown", "gs://b/5.vcf", "http://x"),
]


@pytest.fixture(scope="module")
def tables(spark):
    signs = spark.createDataFrame([("S2", "HP:0000002", True, "HP:0003577", 1), ("S2", "HP:0000001", False, None, 2), ("S2", None, True, None, 3),
                                   ("S1", "HP:0000009", True, "HP:9", 1), ("S5", "HP:0000009", True, None, 1)],
                                  "sequencing_id string, hpo_id string, affected_status boolean, age_at_onset string, position int")
    return spark.createDataFrame(ROWS, CLINICAL), signs


def _sample(aliquot, case, key, name, born, sex):
    return {"assay_id": "assay", "sample_data": {
        "sample_name": f"{aliquot} - {case}", "name_in_vcf": aliquot, "aws_files": [{"key": key, "type": "VCF_SHORT"}],
        "tissue_type": "Whole Blood", "patient_details": {"name": name, "dob": born, "sex": sex}}}


def test_case_requests(spark, tables):
    clinical, signs = tables
    vcf = "post_processing/output/ensemblvep/variants.A2.snv.norm.VEP.vcf.gz"
    files = spark.createDataFrame([("S1", "B/1.vcf.gz"), ("S2", vcf), ("S3", vcf), ("S4", vcf), ("S5", "B/5.vcf.gz")], "sequencing_id string, vcf_key string")
    listing = spark.createDataFrame([(f"test/A2/{vcf}",), ("test/A1/B/1.vcf.gz",), ("prod/A3/B/5.vcf.gz",)], "object_key string")
    out = {r.case_id: r for r in ped.case_requests(clinical, signs, files, listing, "test", "bucket", "assay", "position").collect()}
    uploads = {"source": "AWS", "details": {"bucket": "bucket", "root_folder": "/"}}
    key = f"test/A2/{vcf}"
    assert json.loads(out["A2"].document) == {
        "upload_specs": uploads,
        "analyses": [_sample("2", "A2", key, "Jean", "2000-01-01", "Male"), _sample("3", "A2", key, "Jeannot", "1970-01-01", "Male"),
                     _sample("4", "A2", key, None, "None", "Female")],
        "family_analyses": [{"case_name": "family - A2", "family_samples": [
            {"sample_name": "2 - A2", "family_relation": "proband", "is_affected": True},
            {"sample_name": "3 - A2", "family_relation": "father", "is_affected": False},
            {"sample_name": "4 - A2", "family_relation": "mother", "is_affected": None}], "phenotypes": ["HP:0000002", "HP:0000001"]}],
        "family_analyses_creation_specs": {"create_family_single_analyses": "true"}}
    assert json.loads(out["A1"].document) == {"upload_specs": uploads, "analyses": [_sample("1", "A1", "test/A1/B/1.vcf.gz", "Jean", "2000-01-01", "Male")]}
    assert (out["A3"].document, out["A3"].request, out["A3"].error) == (None, None, "VCF not found: bucket/test/A3/B/5.vcf.gz")
    lost = {r.case_id: r.error for r in ped.case_requests(clinical, signs, files.where("sequencing_id <> 'S3'")).collect()}
    assert lost == {"A1": None, "A2": "No VCF to attach for aliquot_id 3", "A3": None}


def test_phenotype_requests(spark, tables):
    clinical, signs = tables
    names = spark.createDataFrame([("WrappedArray(s3a://b/2.snv)", "2.snv.gz")], "url string, file_name string")
    out = {r.analysis_id: r for r in ped.phenotype_requests(clinical, signs, "imports", names, "position").collect()}
    assert json.loads(out["A2"].document) == {
        "schema_version": "1.0.0",
        "patient_details": {"externalid": "S2", "sex": "M", "maternal_affected": False, "paternal_affected": False, "label": "", "cohort": "A2"},
        "phenotype_hpo_code_list": ["HP:0000002", "HP:0000001"], "phenotype_onset_hpo_code": "HP:0003577",
        "download_specifications": {"download_source": "s3_minio", "details": {"s3_bucket_name": "imports"}},
        "analysis_files": [{"filepath": "A2/2.cnv.gz", "filetype": "patient_called_cnv"}, {"filepath": "A2/2.snv.gz", "filetype": "patient_called_snv"}]}
    assert json.loads(out["A1"].document)["phenotype_onset_hpo_code"] == "HP:0003674"
    assert out["A3"].document is None and out["A3"].error == (
        "Failed to copy VCFs for analysis A3: Error processing CNV VCF for 5: Invalid S3 URL format: http://x; "
        "Error processing SNV VCF for 5: Invalid S3 URL format: gs://b/5.vcf")


def test_sign_lists(spark, tables):
    clinical, signs = tables

    def ids(**options):
        return {r.sequencing_id: r.hpo_ids for r in ped.sign_ids(signs, **options).collect()}

    assert ids() == {"S2": ["HP:0000001", "HP:0000002"], "S1": ["HP:0000009"], "S5": ["HP:0000009"]}
    assert ids(order="position")["S2"] == ["HP:0000002", "HP:0000001"] and ids(affected_only=True)["S2"] == ["HP:0000002"]
    assert ids(persons=clinical)["S3"] is None and ids(persons=clinical, absent="empty")["S3"] == []
    with pytest.raises(ValueError):
        ped.sign_ids(signs, absent="other")


def test_family_documents_leave_defaults_out(spark, tables):
    clinical, signs = tables
    out = {r.analysis_id: json.loads(r.document) for r in ped.pedigree_documents(clinical, signs.withColumn("name", F.lit("Label"))).collect()}
    assert out["A2"] == {"id": "A2", "proband": {
        "subject": {"id": "2", "sex": "MALE"}, "phenotypicFeatures": [{"type": {"id": "HP:0000002", "label": "Label"}}]},
        "pedigree": {"persons": [
            {"familyId": "A2", "individualId": "2", "paternalId": "3", "maternalId": "4", "sex": "MALE", "affectedStatus": "AFFECTED"},
            {"familyId": "A2", "individualId": "3", "sex": "MALE", "affectedStatus": "UNAFFECTED"},
            {"familyId": "A2", "individualId": "4", "sex": "FEMALE"}]}}
    assert out["A3"]["proband"]["subject"] == {"id": "5"}


def test_names_of_real_files(spark, tmp_path):
    (tmp_path / "a.vcf").write_bytes(gzip.compress(b"x"))
    (tmp_path / "b.vcf.gz").write_bytes(gzip.compress(b"x"))
    (tmp_path / "c.vcf").write_bytes(b"plain")
    (tmp_path / "d.vcf").write_bytes(b"\x1f")
    (tmp_path / "e.vcf").write_bytes(b"")
    got = [r.file_name for r in cat.file_names(spark, str(tmp_path)).collect()]
    assert sorted(got) == ["a.vcf.gz", "b.vcf.gz", "c.vcf", "d.vcf"]
