"""How rows are dealt and sorted: plans of shared steps, files of a stream's slices."""

from types import SimpleNamespace

from pyspark.sql import functions as F

from __spark_entry__ import SMOKE_DIR, queries
from strandline import session
from strandline.operators import quality
from strandline.operators import variants as var
from strandline.plans import w_streams, w_variants

OCC = ("chromosome string, start long, reference string, alternate string, sequencing_id string, gq int, ad_alt int, filters string, "
       "zygosity string, order_key long, line_no int")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_best_score_alone_sorts_nothing(spark):
    rows = spark.createDataFrame([("c", 1, "A", "T", "s1", 0.5), ("c", 1, "A", "T", "s2", 0.5), ("c", 1, "A", "T", "s3", None)],
                                 "chromosome string, start long, reference string, alternate string, sequencing_id string, score double")
    best = var.max_score(rows)
    assert "SortAggregate" not in plan(best.select(*var.VARIANT_KEY, "max_score"))
    assert [tuple(r)[4:] for r in best.collect()] == [(0.5, "s2")]


def test_occurrences_are_dealt_once_for_their_clinical_columns(spark):
    occ = spark.createDataFrame([("c", 1, "A", "T", "s1", 9, 3, "PASS", "HET", 1, 1), ("c", 1, "A", "T", "s1", 8, 3, "PASS", "HOM", 1, 2)], OCC)
    clinical = spark.createDataFrame([("s1", "a", "b", "GEBA", True, "Male", True)], "sequencing_id string, analysis_id string, "
                                     "batch_id string, bioinfo_analysis_code string, is_proband boolean, gender string, affected_status boolean")
    out = var.enrich_snv(occ, clinical.hint("merge"))
    assert plan(out).split("Initial Plan")[-1].count("Exchange hashpartitioning") == 2
    assert [r["gq"] for r in out.collect()] == [9]


def test_larger_slices_have_more_files(spark, monkeypatch):
    v, df = SimpleNamespace(spark=spark), spark.range(400)
    monkeypatch.setattr(w_streams, "FILE_ROWS", 10)
    path, files = w_streams._sliced(v, df, F.col("id") % 4, 4, "test")
    assert files == 10 and spark.read.parquet(path).count() == 400 and len(spark.read.parquet(path).inputFiles()) == 40


CLINICAL = "sequencing_id string, analysis_id string, batch_id string, bioinfo_analysis_code string, is_proband boolean, gender string, affected_status boolean"


def exchanges(df):
    return plan(df).split("Initial Plan")[-1].count("Exchange hashpartitioning")


def cohort(spark):
    """Occurrences that come twice, fail the filter, or have no value; a sequencing without clinical row, one with two codes, one without."""
    occ = [("c", 1, "A", "T", "s1", 30, 3, "PASS", "HET", 1, 1), ("c", 1, "A", "T", "s1", 40, 3, "PASS", "HOM", 1, 2),
           ("c", 1, "A", "T", "s2", 30, 3, "PASS", "HET", 2, 1), ("c", 1, "A", "T", "s3", 30, 4, "PASS", None, 3, 1),
           ("c", 1, "A", "T", "s4", 30, 4, "PASS", "HOM", 4, 1), ("c", 1, "A", "*", "s2", 30, 3, "PASS", "HET", 5, 1),
           ("c", 2, "A", "T", "s2", None, 3, "PASS", "HET", 6, 1), ("c", 3, None, "T", "s9", 30, 3, "PASS", "HET", 7, 1),
           ("c", 4, None, "T", "s2", 30, 3, "PASS", "HET", 8, 1), ("c", 5, "A", "T", "s2", 30, 3, "LowQual", "HET", 9, 1)]
    codes = [("s1", "GEBA"), ("s2", "TEBA"), ("s3", None), ("s4", "TEBA"), ("s4", "TNEBA"), ("s5", "GEBA")]
    clinical = [(s, "a", f"b{i % 2}", code, True, "Male", True) for i, (s, code) in enumerate(codes)]
    return spark.createDataFrame(occ, OCC), spark.createDataFrame(clinical, CLINICAL)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_enriched_occurrences_are_counted_without_being_normalised_again(spark):
    occ, clinical = cohort(spark)
    snv = var.enrich_snv(occ, clinical)
    for count in (var.frequencies, var.tumor_frequencies, var.normalize_variants):
        assert rows(count(snv, clinical, enriched=True)) == rows(count(occ, clinical)) != []
    snv = snv.localCheckpoint()
    # one for the counts by variant and batch
    assert exchanges(var.normalize_variants(snv, clinical, enriched=True)) == 1


def test_frequencies_are_dealt_once_by_variant(spark):
    occ, clinical = cohort(spark)
    found = {r["analysis_code"]: (r["ac"], r["pc"], r["pn"], r["hom"]) for r in var.frequencies(occ, clinical).where("start = 1").collect()}
    assert found == {"all": (7, 5, 5, 3), "GEBA": (2, 1, 2, 1), "TEBA": (3, 2, 2, 1), "TNEBA": (2, 1, 1, 1)}
    freqs = var.frequencies(var.enrich_snv(occ, clinical).localCheckpoint(), clinical, enriched=True)
    again = freqs.groupBy(*var.VARIANT_KEY).agg(F.max("pf"))
    assert exchanges(again) == exchanges(freqs)


def test_documents_read_written_occurrences(spark, monkeypatch):
    cut = []
    monkeypatch.setattr(w_variants, "cut_lineage", lambda df: cut.append(df.columns) or session.cut_lineage(df))
    out = queries()["var_centric_variant"](spark, SMOKE_DIR)
    assert len(cut) == 3 and "lineitem" not in plan(out) and "customer" in plan(out)


def test_consequences_are_dealt_by_gene(spark):
    occ, _ = cohort(spark)
    genes = spark.createDataFrame([("G", "c", 0, 9), ("G", "c", 1, 3), ("H", "c", 2, 2)], "symbol string, chromosome string, start long, end long")
    cons = var.normalize_consequences(occ, genes.localCheckpoint(), 10)
    scores = spark.createDataFrame([("G", 1.0)], "symbol string, cadd double").localCheckpoint().hint("merge")
    assert exchanges(cons.join(scores, "symbol", "left")) == exchanges(cons) + 1
    assert [r for r in rows(cons.select("start", "symbol", "transcript")) if r[0] < 3] == [(1, "G", "G-T1"), (2, "G", "G-T1"), (2, "H", "H-T1")]


def test_coverage_is_dealt_by_gene(spark):
    coverage = spark.createDataFrame([("G", "s", 1, 1, 1), ("G", "s", 5, 1, 1), (None, "s", 1, 1, 1)],
                                     "symbol string, sample_id string, depth int, order_key long, line_no int")
    genes = spark.createDataFrame([("G", "c", 0, 9)], "symbol string, chromosome string, start long, end long").hint("merge")
    best = var.normalize_coverage(coverage)
    assert rows(best) == [("G", "s", 5, 1, 1), (None, "s", 1, 1, 1)]
    assert exchanges(var.coverage_by_gene_centric(best, genes)) == 2


def test_missing_keys_are_looked_up_among_distinct_ones(spark):
    a = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k int")
    b = spark.createDataFrame([(2,), (2,), (3,)], "k int")
    found = quality.included_in(a.localCheckpoint(), b.localCheckpoint().hint("merge"), ["k"])
    assert rows(found) == [(1,), (None,)]
    assert plan(found).split("Initial Plan")[-1].count("Aggregate(keys=[k") == 4
