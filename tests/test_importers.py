"""Named importers over the format readers, on small rendered files."""

import os

import pytest
from pyspark.sql import functions as F

from strandline.operators import refdata as ref
from strandline.operators import typed_tables as tables
from strandline.session import scratch_dir


def _write(dir_, name, text):
    d = dir_.replace("file:", "")
    os.makedirs(d, exist_ok=True)
    with open(os.path.join(d, name), "w") as f:
        f.write(text)
    return os.path.join(d, name)


def test_import_ensembl_full_outer_join(spark):
    d = scratch_dir(spark, "ensembl")
    ena = _write(d, "ena.tsv", "gene_stable_id\ttranscript_stable_id\txref\nG1\tT1\tE1\nG1\tT1\tE0\nG2\tT2\tE2\n")
    ent = _write(d, "entrez.tsv", "gene_stable_id\ttranscript_stable_id\txref\nG1\tT1\t100\nG3\tT3\t300\n")
    gff = _write(d, "g.gff3", "##gff-version 3\n1\tens\tmRNA\t10\t20\t.\t+\t.\tID=transcript:T1;Name=x\n")
    rows = {r.transcript_stable_id: r for r in ref.import_ensembl(spark, {"ena": ena, "entrez": ent}, gff).collect()}
    assert sorted(rows) == ["T1", "T2", "T3"]
    assert rows["T1"].ena == ["E0", "E1"] and rows["T1"].entrez == ["100"] and rows["T1"].start == 10
    assert rows["T3"].ena is None and rows["T2"].entrez is None


def test_import_omim_header_from_last_hash_line(spark):
    d = scratch_dir(spark, "omim")
    p = _write(d, "genemap2.txt", "# Copyright\n# Generated\n# Chromosome\tGenomic Position Start\tMIM Number\n"
                                  "chr1\t100\t123\nchr2\t200\t456\n# trailing comment\n")
    rows = sorted((r["Chromosome"], r["MIM Number"]) for r in ref.import_omim(spark, p).collect())
    assert rows == [("chr1", "123"), ("chr2", "456")]


def test_import_human_genes_and_hpo(spark):
    d = scratch_dir(spark, "genes")
    p = _write(d, "gene_info", "#tax_id\tGeneID\tSymbol\tSynonyms\n9606\t1\tA1BG\tA1B|ABG\n9606\t2\tA2M\t-\n")
    rows = {r.Symbol: r for r in ref.import_human_genes(spark, p).collect()}
    assert rows["A1BG"].tax_id == "9606" and rows["A1BG"].synonym_list == ["A1B", "ABG"] and rows["A2M"].Synonyms is None
    h = _write(d, "g2p.tsv", "ncbi_gene_id\tgene_symbol\thpo_id\thpo_name\tfrequency\tdisease_id\n"
                             "1\tA1BG\tHP:1\tx\t-\tOMIM:1\n")
    r = ref.import_hpo_genes(spark, h).first()
    assert r.hpo_id == "HP:1" and r.frequency is None


def test_vcf_values_of_each_allele(spark):
    d = scratch_dir(spark, "alleles")
    p = _write(d, "a.vcf", "##fileformat=VCFv4.2\n#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\n"
                           "chr1\t10\t.\tA\tC,G\t.\tPASS\tAC=3,5;AF=0.1,0.2;AN=8\n"
                           "chr1\t20\t.\tA\tC,G\tx\tPASS\tAC=7;AF=.,0.5;AN=many\n"
                           "chr1\t30\t.\tA\tT\t1.5\t.\t.\nshort\n")
    rows = {(r.start, r.alternate): (r.ac, r.af, r.an) for r in ref.import_1000_genomes(spark, p).collect()}
    assert rows == {(10, "C"): (3, 0.1, 8), (10, "G"): (5, 0.2, 8), (20, "C"): (7, None, None),
                    (20, "G"): (None, 0.5, None), (30, "T"): (None, None, None)}
    rejects = {(r.start, r.alternate, r.field, r.value) for r in ref.vcf_rejects(spark, p, "1000_genomes").collect()}
    assert rejects == {(20, "C", "AN", "many"), (20, "G", "AN", "many")}


def test_dbsnp_contigs(spark):
    d = scratch_dir(spark, "dbsnp")
    contigs = ["NC_000001.11", "NC_000023.11", "NC_000024.10", "NC_012920.1", "NT_187361.1", "NC_000025.1"]
    p = _write(d, "a.vcf", "".join(f"{c}\t1\trs1\tA\tC\t.\t.\tRS=1\n" for c in contigs))
    assert sorted(r.chromosome for r in ref.import_dbsnp(spark, p).collect()) == [
        "NC_000025.1", "NT_187361.1", "chr1", "chrM", "chrX", "chrY"]


def test_spliceai_missing_scores(spark):
    d = scratch_dir(spark, "spliceai")
    p = _write(d, "a.vcf", "1\t1\t.\tA\tC\t.\t.\tSpliceAI=C|G1|.|0.5|0.1|0.2,C|G2\n")
    rows = {r.symbol: (r.ds_ag, r.ds_al) for r in ref.import_spliceai(spark, p).collect()}
    assert rows == {"G1": (None, 0.5), "G2": (None, None)}


def test_spliceai_kinds_and_positions(spark):
    d = scratch_dir(spark, "spliceai")
    p = _write(d, "a.vcf", "1\t1\t.\tA\tC,CT\t.\t.\tSpliceAI=C|G|0.1|0.2|0.3|0.4|-5|6|x|50,CT|G|0.9|0|0|0|1|2|3|4\n")
    rows = {r.alternate: r for r in ref.import_spliceai(spark, p).collect()}
    assert (rows["C"].kind, rows["C"].dp_ag, rows["C"].dp_al, rows["C"].dp_dg, rows["C"].dp_dl) == ("snv", -5, 6, None, 50)
    assert [r.alternate for r in ref.import_spliceai(spark, p, "indel").collect()] == ["CT"]
    assert [r.alternate for r in ref.import_spliceai(spark, p, "snv").collect()] == ["C"]
    with pytest.raises(ValueError):
        ref.import_spliceai(spark, p, "sv")


def test_typed_tables(spark):
    d = scratch_dir(spark, "typed")
    p = _write(d, "genemap2.txt", "# Copyright\n# " + "\t".join(h for h, _, _ in tables.TABLES["omim"]) + "\n"
               "chr1\t100\tx\t1p\t600001\tA1, B1\tname\tA1\t7\tE1\t{Some disease, type 2}, 100100 (3), Autosomal dominant, X-linked; ?Other (1); plain\n"
               "chr2\t200\n")
    omim = tables.import_table(spark, p, "omim")
    a, b = omim.orderBy("chromosome").collect()
    assert (a.start, a.end, a.omim_gene_id, a.symbols, b.symbols, b.omim_gene_id) == (100, None, 600001, ["A1", "B1"], None, None)
    assert [tuple(r) for r in tables.rejects(ref.import_omim(spark, p), "omim", ["Chromosome"]).collect()] == [("chr1", "end", "x")]
    got = {r.name: (r.omim_id, r.mapping_key, r.inheritance, r.flags) for r in tables.omim_phenotypes(omim).collect()}
    assert got == {"Some disease, type 2": (100100, 3, ["Autosomal dominant", "X-linked"], ["{"]), "Other": (None, 1, None, ["?"]),
                   "plain": (None, None, None, None)}
    with pytest.raises(ValueError, match="MIM Number"):
        tables.typed(spark.createDataFrame([("x",)], "Chromosome string"), "omim")


def test_external_references_and_frequencies(spark):
    df = spark.createDataFrame([(["MIM:1", "HGNC:HGNC:5", "MIM:2"], "3/4"), ([], "50%"), (None, "HP:0040281"), (["X:1"], "0/0")],
                               "refs array<string>, f string")
    rows = df.select(tables.reference_of(F.col("refs"), "MIM").alias("m"), tables.reference_of(F.col("refs"), "HGNC").alias("h"),
                     tables.frequency_share(F.col("f")).alias("s")).collect()
    assert [tuple(r) for r in rows] == [("1", "HGNC:5", 0.75), (None, None, 0.5), (None, None, None), (None, None, None)]
