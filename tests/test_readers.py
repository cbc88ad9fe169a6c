"""Readers on files as they come: repeated keys, short lines, bad numbers, brackets in text."""

import pytest
from pyspark.sql import functions as F

from strandline.operators import refdata, releases, variants
from strandline.session import scratch_dir
from strandline.sources import formats


def _text(spark, lines, name="in"):
    path = scratch_dir(spark, name)
    spark.createDataFrame([("\n".join(lines),)], "value string").coalesce(1).write.text(path)
    return path


def test_vcf_with_repeated_and_odd_info_keys(spark):
    path = _text(spark, ["##fileformat=VCFv4.2", "#CHROM\tPOS", "1\t5\t.\tA\tC,G\t.\tPASS\tDB;DB;AC=1,2;AC=9,9;;X=a=b",
                         "1\tx\t.\tA\tT\t.\tPASS\t.", "1\t7\trs1"])
    rows = formats.read_vcf(spark, path).orderBy("start", "allele").collect()
    assert [(r.start, r.allele) for r in rows] == [(None, 0), (5, 0), (5, 1)]
    assert rows[1].info == {"DB": None, "AC": "1,2", "X": "a=b"} and rows[0].info == {}
    one = formats.read_vcf(spark, path).select(formats.info_field("AC", "int", "A").alias("ac"), "allele", "start")
    assert sorted((r.allele, r.ac) for r in one.where("start = 5").collect()) == [(0, 1), (1, 2)]


def test_gff_with_repeated_attributes_and_short_lines(spark):
    path = _text(spark, ["##gff-version 3", "c\ts\tgene\t1\t9\t.\t+\t.\tID=a;Dbxref=x;ID=b; Name = n ", "c\ts\tgene\tone\t9", "c"])
    rows = {r.type or r.seqid: r for r in refdata.import_refseq_annotation(spark, path).where("start = 1 OR type IS NULL").collect()}
    assert (rows["gene"].feature_id, rows["gene"].attributes["Dbxref"], rows["c"].feature_id) == ("a", "x", None)
    assert formats.read_gff3(spark, path).where("start IS NULL").count() == 2


def test_obo_brackets_inside_text(spark):
    path = _text(spark, ["format-version: 1.2", "remark: see [Term] below", "", "[Term]", "id: A:1", "name: one",
                         'def: "a [Term] in text" [X:1]', "comment: [Typedef] too", "is_a: A:0 ! zero", "", "[Term]", "id: A:0", "name: zero", "",
                         "[Typedef]", "id: part_of", "name: part of", "", "[Term]", "id: A:2", "is_a: A:1", "is_obsolete: true"])
    rows = {r.id: r for r in formats.read_obo(spark, path).collect()}
    assert set(rows) == {"A:0", "A:1", "A:2"}
    assert rows["A:1"].parents == ["A:0"] and rows["A:0"].parents == [] and rows["A:0"].name == "zero"
    assert rows["A:2"].parents == ["A:1"] and rows["A:2"].is_obsolete
    first = _text(spark, ["[Term]", "id: B:1", "name: b"], "first")
    assert [r.id for r in formats.read_obo(spark, first).collect()] == ["B:1"]


def test_hash_headers_and_short_lines(spark):
    path = _text(spark, ["# Copyright", "# Gene\tMim\tNote", "g1\t100", "g2", "g3\t300\tx", "# trailing"])
    assert [tuple(r) for r in refdata.import_omim(spark, path).orderBy("Gene").collect()] == [
        ("g1", "100", None), ("g2", None, None), ("g3", "300", "x")]
    with pytest.raises(ValueError, match="header"):
        formats.read_hash_header_tsv(spark, _text(spark, ["a\tb"], "none"))


def test_numbers_that_are_none_are_null_and_told(spark):
    path = _text(spark, ["#chr\tpos(1-based)\tscore", "1\t5\t0.1;0.2", "1\t6\t0.5", "1\t7\t."])
    raw = refdata.import_dbnsfp_raw(spark, path)
    assert [r.score for r in refdata.import_dbnsfp(spark, path, ["score"]).orderBy("`position_1-based`").collect()] == [None, 0.5, None]
    assert [tuple(r) for r in refdata.typed_rejects(raw, ["score"], ["chr"]).collect()] == [("1", "score", "0.1;0.2")]
    gn = _text(spark, ["gene\tpLI\toe_lof", "g1\t0.9\tbad", "g2\tNA\t0.1"], "gnomad")
    assert [(r.pLI, r.oe_lof) for r in refdata.import_gnomad_constraint(spark, gn).orderBy("gene").collect()] == [(0.9, None), (None, 0.1)]


def test_hashes_and_release_numbers(spark):
    df = spark.createDataFrame([("a|b", "c"), ("a", "b|c"), (None, "a"), ("-", "a"), ("", "a")], "x string, y string")
    assert df.select(variants.document_hash(["x", "y"]).alias("h")).distinct().count() == 5
    prev, status = releases.previous_release(F.col("r"))
    rows = spark.createDataFrame([("re_1000",), ("re_1001",), ("re_002",), ("re_001",), ("re_0100",), ("re_12",)], "r string")
    assert [tuple(r) for r in rows.select("r", prev, status).collect()] == [
        ("re_1000", "re_998", "ok"), ("re_1001", "re_999", "ok"), ("re_002", "re_000", "ok"), ("re_001", None, "none"),
        ("re_0100", None, "invalid"), ("re_12", None, "invalid")]
