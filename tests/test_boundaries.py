"""Inputs beyond the fixtures: deep trees, long numbers, NULL keys, empty cohorts, trailing stanzas, empty fields."""

from pyspark.sql import functions as F

from strandline.operators import ranges, refdata, releases, tracks, variants
from strandline.sources import formats


def test_ancestors_of_a_deep_tree_with_two_parents_and_a_cycle(spark):
    n = 80
    rows = [(f"t{i}", [f"t{i - 1}"] + ([f"t{i - 2}"] if i > 1 else [])) for i in range(1, n)] + [("t0", [])]
    out = refdata.term_ancestors(spark.createDataFrame(rows, "id string, parents array<string>")).collect()
    assert len(out) == n * (n - 1) // 2
    far = {(r["term_id"], r["ancestor_id"]): r["distance"] for r in out}
    assert far["t79", "t0"] == 40 and far["t3", "t2"] == 1
    loop = spark.createDataFrame([("a", ["b"]), ("b", ["a"])], "id string, parents array<string>")
    assert refdata.term_ancestors(loop).count() == 4


def test_release_numbers_beyond_three_digits(spark):
    names = spark.createDataFrame([("clin_qa_variant_centric_re_999",), ("clin_qa_gene_centric_re_1000",),
                                   ("clin_qa_coverage_re_007",)], "index_name string")
    got = {r["current_release"]: r["next_release"] for r in releases.next_release(names).collect()}
    assert got == {"re_999": "re_1000", "re_1000": "re_1001", "re_007": "re_008"}


def test_components_of_a_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)], "src long, dst long")
    assert {r["component"] for r in ranges.connected_components(edges).collect()} == {0}


def test_document_hash_keeps_the_place_of_a_null(spark):
    df = spark.createDataFrame([("a", None, "b"), ("a", "b", None)], "x string, y string, z string")
    assert df.select(variants.document_hash(["x", "y", "z"]).alias("h")).distinct().count() == 2


def test_duplicate_clinical_rows_stay(spark):
    clinical = spark.createDataFrame([("a1", "s1", "GEBA", 1), ("a1", "s1", "GEBA", 2)],
                                     "analysis_id string, sequencing_id string, bioinfo_analysis_code string, n int")
    signs = spark.createDataFrame([("s1", "HP:1", "yes", "x")],
                                  "sequencing_id string, hpo_id string, affected_status string, age_at_onset string")
    assert variants.enrich_clinical(clinical, signs).count() == 2


def test_last_term_ends_before_type_definitions(spark, tmp_path):
    (tmp_path / "x.obo").write_text("format-version: 1.2\n\n[Term]\nid: A:1\nname: one\n\n[Term]\nid: A:2\nname: two\nis_a: A:1\n\n"
                                    "[Typedef]\nid: part_of\nis_a: other\nis_obsolete: true\n")
    got = {r["id"]: (r["parents"], r["is_obsolete"]) for r in formats.read_obo(spark, str(tmp_path / "x.obo")).collect()}
    assert got == {"A:1": ([], False), "A:2": (["A:1"], False)}


def test_fields_that_are_no_numbers_count_as_zero(spark):
    # white space separates these fields, so none between two others can be empty; the last ones may be missing
    fields = [str(i) for i in range(1, 13)]
    fields[1] = fields[9] = "."
    out = tracks.self_chain_gff(spark.createDataFrame([("\t".join(fields),)], "value string")).first()
    assert "score=0;" in out["attributes"] and "Target=7 1 11" in out["attributes"] and out["start"] == 6
    assert "normScore=0.00" in out["attributes"]


def test_subset_is_pruned_before_the_aggregate(spark):
    from strandline.plans.fixtures import Views

    v = Views(spark, "/root/testdata/sf0.001")
    wanted = v.clinical.select("analysis_id").limit(2)
    plan = variants.enrich_snv(v.occurrences, v.clinical, wanted)._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftSemi" in plan[plan.index("Aggregate"):]
    few = variants.tumor_frequencies(v.occurrences, v.clinical.where(F.col("bioinfo_analysis_code") == "TEBA"))
    assert few.where("tn_pf IS NOT NULL").count() == 0
    assert "Expand" not in few._jdf.queryExecution().optimizedPlan().toString().split("Aggregate")[0]
