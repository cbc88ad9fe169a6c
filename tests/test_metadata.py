"""Batch metadata as variants, and files attached to rows by one join."""

import json
import random

from pyspark.sql import functions as F

from strandline.operators import catalog as cat


def test_files_of_all_kinds(spark, tmp_path):
    files = {
        "good": json.dumps({"submissionSchema": "S", "analyses": [
            {"ldmSampleId": "a", "patient": {"sex": "male"}, "experiment": {"isPairedEnd": True, "fragmentSize": 7}, "note": {"x": [1]}},
            {"ldmSampleId": 5, "patient": "none", "experiment": {"isPairedEnd": "perhaps", "fragmentSize": "many"}}]}, indent=2),
        "cut": '{"submissionSchema": "S", "analyses": [', "twice": '{"analyses": [], "analyses": []}',
        "other": '{"analyses": {"a": 1}}', "list": "[1]", "none": '{"submissionSchema": "S", "analyses": []}', "empty": ""}
    for name, text in files.items():
        (tmp_path / name).mkdir()
        (tmp_path / name / "metadata.json").write_text(text)
    rows = cat.read_metadata(spark, str(tmp_path / "*")).withColumn("x", cat.metadata_field("note.x[0]", "int")).collect()
    by = {}
    for r in rows:
        by.setdefault(r.file.split("/")[-2], []).append(r)
    a, b = sorted(by["good"], key=lambda r: r.ldmSampleId == "5")
    assert (a.ldmSampleId, a.patient_sex, a.patient_familyId, a.experiment_isPairedEnd, a.experiment_fragmentSize, a.x) == ("a", "male", None, True, 7, 1)
    assert (b.ldmSampleId, b.patient_sex, b.experiment_isPairedEnd, b.experiment_fragmentSize, b.x, b.error) == ("5", None, None, None, None, None)
    assert {n: [r.error for r in rs] for n, rs in by.items() if n != "good"} == {
        "cut": ["Invalid JSON"], "twice": ["Invalid JSON"], "other": ["No list of analyses"], "list": ["No list of analyses"],
        **({"empty": ["Invalid JSON"]} if "empty" in by else {})}


def test_attach_equals_the_rules(spark):
    rnd = random.Random(4)
    ids = [str(i) for i in range(12)]
    leg, pipe = cat.SNV_GERMLINE_LEGACY, cat.SNV_GERMLINE
    keys = [f"B{rnd.randrange(14)}/{rnd.choice(ids + ['F1', 'F2', 'F3'])}{rnd.choice(['', '.case'])}{leg}" for _ in range(40)] + [
        f"{cat.PIPELINE_FOLDER}/variants.A{i}.snv{pipe}".replace("//", "/") for i in range(3)] + ["x" + leg, "B1/readme.txt"]
    rows = [(f"S{i}", f"A{rnd.randrange(9)}", rnd.choice([None] + [f"B{b}" for b in range(16)]), rnd.choice(ids + [None]),
             rnd.choice([None, "F1", "F2", "F3"])) for i in range(120)]
    heads = {"F1": "3", "F2": "7"}
    clinical = spark.createDataFrame(rows, "sequencing_id string, analysis_id string, batch_id string, aliquot_id string, family_id string")
    listing = spark.createDataFrame([(k,) for k in keys], "object_key string")
    probands = spark.createDataFrame(list(heads.items()), "family_id string, proband_aliquot_id string")
    prefix = dict(listing.select("object_key", cat.file_prefix(F.col("object_key"))).collect())

    def best(row):
        _, analysis, batch, aliquot, family = row
        one = [k for k in keys if k.startswith(cat.PIPELINE_FOLDER) and k.endswith(pipe) and prefix[k] == analysis]
        folder = [k for k in keys if k.endswith(leg) and "/" in k and k.split("/")[0] == batch]
        two = [k for k in folder if prefix[k] == heads.get(family)]
        three = folder if len(folder) == 1 else [k for k in folder if prefix[k] in (aliquot, family)]
        return next(((n, min(c)) for n, c in ((1, one), (2, two), (3, three)) if c), (None, None))

    out = cat.attach_files(clinical, listing, probands)
    assert {r.sequencing_id: (r.rule, r.vcf_key) for r in out.collect()} == {r[0]: best(r) for r in rows}
    assert all((r.error is None) == (r.vcf_key is not None or r.aliquot_id is None) for r in out.collect())
