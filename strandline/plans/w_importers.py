"""Witnesses of the named importers: each table is rendered as its publisher writes it and imported with its types."""

from __future__ import annotations

from pyspark.sql import functions as F

from strandline.operators import refdata as ref
from strandline.operators import typed_tables as tables
from strandline.plans.registry import witness
from strandline.plans.w_variants import DV, K
from strandline.session import scratch_dir
from strandline.sources import formats

VK = ref.VARIANT_KEY

# A value per INFO key or column, from the row's start and alternate or symbol; the same expressions in both dialects.
_MISSING = "start % {m} = 0"


def _info_number(i: int, number: str) -> str:
    return f"(start * {i + 3} + {'ascii(alternate)' if number == 'A' else 0}) % 997"


def _info_value(i: int, dtype: str, number: str) -> str:
    n = _info_number(i, number)
    return {"string": f"'s' || CAST({n} AS STRING)", "double": f"CAST({n} AS DOUBLE) / 1024"}.get(dtype, f"CAST({n} AS {dtype})")


def _vcf_witness(kind: str) -> None:
    specs = ref.VCF_SPECS[kind]
    values = ", ".join(f"CASE WHEN NOT {_MISSING.format(m=i + 5)} THEN {_info_value(i, t, n)} END AS \"{c}\""
                       for i, (_, c, t, n) in enumerate(specs)).replace("STRING", "VARCHAR")

    @witness(f"imp_{kind}", f"""
WITH {DV}
SELECT {K}, 'rs' || CAST(start AS VARCHAR) AS id, CASE WHEN start % 4 <> 0 THEN CAST(start % 100 AS DOUBLE) / 2 END AS qual, {values}
FROM (SELECT chromosome, CAST(start AS BIGINT) AS start, reference, alternate FROM v)
""")
    def _(v):
        alts = v.occurrences.where("alternate <> '*'").select(*VK).distinct()
        sites = alts.groupBy("chromosome", "start", "reference").agg(F.sort_array(F.collect_list("alternate")).alias("a"))
        keys = []
        for i, (k, _, t, n) in enumerate(specs):
            text = f"CAST({_info_value(i, t, n)} AS STRING)"
            each = f"array_join(transform(a, alternate -> {text}), ',')" if n == "A" else text
            keys.append(f"CASE WHEN NOT {_MISSING.format(m=i + 5)} THEN '{k}=' || {each} END")
        contig = "chromosome"
        if kind == "dbsnp":
            contig = "'NC_0000' || lpad(substr(chromosome, 4), 2, '0') || '.11'"
        rec = sites.selectExpr(f"{contig} AS chromosome", "start", "'rs' || CAST(start AS STRING) AS id", "reference",
                               "array_join(a, ',') AS alternates", "CASE WHEN start % 4 <> 0 THEN start % 100 / 2 END AS qual",
                               "'PASS' AS filter", f"coalesce(nullif(concat_ws(';', {', '.join(keys)}), ''), '.') AS info")
        path = scratch_dir(v.spark, kind)
        formats.write_vcf(rec, path)
        return getattr(ref, f"import_{kind}")(v.spark, path).drop("filters")


for _kind in ("1000_genomes", "clinvar", "dbsnp", "gnomad_joint", "gnomad_cnv", "gnomad_sv", "topmed"):
    _vcf_witness(_kind)


def _cell(i: int, dtype: str) -> tuple[str, str]:
    """(text as the file has it, SQL of the value it stands for) of column ``i``; one number in 13 is none."""
    if dtype == "string":
        return f"'c{i} ' || symbol", f"'c{i} ' || symbol"
    if dtype == "yes":
        return ("CASE start % 3 WHEN 0 THEN 'yes' WHEN 1 THEN 'N' END", "CASE start % 3 WHEN 0 THEN true WHEN 1 THEN false END")
    if dtype.startswith("list"):
        sep = dtype[4:]
        return (f"CASE WHEN start % {i + 2} <> 0 THEN symbol || '{sep} x' || CAST(start % 7 AS STRING) || '{sep}' END",
                f"CASE WHEN start % {i + 2} <> 0 THEN symbol || '+x' || CAST(start % 7 AS STRING) END")
    n = f"start * {i + 1} % 9973"
    return (f"CASE WHEN start % 13 = {i % 13} THEN 'n.a.' ELSE CAST({n} AS STRING) END",
            f"CASE WHEN start % 13 <> {i % 13} THEN CAST({n} AS {dtype}) END")


def _table_witness(kind: str, sep: str, null: str, first: str = "") -> None:
    columns = tables.TABLES[kind]
    numbers = [i for i, (_, _, t) in enumerate(columns) if t in ("int", "bigint")]
    values = ", ".join(f"{_cell(i, t)[1]} AS \"{c}\"" for i, (_, c, t) in enumerate(columns))
    bad = " + ".join(f"CASE WHEN start % 13 = {i % 13} THEN 1 ELSE 0 END" for i in numbers)

    @witness(f"imp_{kind}", f"SELECT {values}, CAST({bad} AS BIGINT) AS n_rejects FROM genes".replace("STRING", "VARCHAR"))
    def _(v):
        named = [F.expr(_cell(i, t)[0]).alias(first + h if i == 0 else h) for i, (h, _, t) in enumerate(columns)]
        path = scratch_dir(v.spark, kind)
        v.genes.select(*named).write.mode("overwrite").options(header=True, sep=sep, nullValue=null, comment="~").csv(path)
        out = tables.import_table(v.spark, path, kind)
        key, of = next((h, c) for h, c, t in columns if t == "string")
        found = tables.rejects(tables.READERS[kind](v.spark, path), kind, [key]).groupBy(F.col(f"`{key}`").alias(of)).agg(
            F.count(F.lit(1)).alias("n_rejects"))
        lists = {c: F.array_join(c, "+") for _, c, t in columns if t.startswith("list")}
        return out.withColumns(lists).join(found, of, "left").select(*[c for _, c, _ in columns], F.coalesce("n_rejects", F.lit(0)).alias("n_rejects"))


for _args in (("cosmic_genes", ",", ""), ("cosmic_mutations", "\t", ""), ("ddd", ",", ""), ("hpo_genes", "\t", "-"),
              ("human_genes", "\t", "-", "#"), ("omim", "\t", "", "# ")):
    _table_witness(*_args)


@witness("imp_ensembl", """
WITH e AS (SELECT 'ENSG' || symbol AS gene_stable_id, 'ENST' || symbol AS transcript_stable_id, 'X' || symbol AS ena FROM genes WHERE start % 2 = 0),
r AS (SELECT 'ENSG' || symbol AS gene_stable_id, 'ENST' || symbol AS transcript_stable_id, 'NM_' || symbol || ',NR_' || symbol AS refseq
      FROM genes WHERE start % 3 = 0)
SELECT gene_stable_id, transcript_stable_id, ena, refseq, CASE WHEN g.start % 5 <> 0 THEN g.chromosome END AS chromosome,
       CASE WHEN g.start % 5 <> 0 THEN CAST(g.start AS BIGINT) END AS start
FROM e FULL JOIN r USING (gene_stable_id, transcript_stable_id) LEFT JOIN genes g ON transcript_stable_id = 'ENST' || g.symbol
""")
def _(v):
    ids = [F.concat(F.lit("ENSG"), "symbol").alias("gene_stable_id"), F.concat(F.lit("ENST"), "symbol").alias("transcript_stable_id")]
    xrefs = {"ena": v.genes.where("start % 2 = 0").select(*ids, F.concat(F.lit("X"), "symbol").alias("xref")),
             "refseq": v.genes.where("start % 3 = 0").select(*ids, F.explode(F.array(
                 F.concat(F.lit("NR_"), "symbol"), F.concat(F.lit("NM_"), "symbol"), F.concat(F.lit("NM_"), "symbol"))).alias("xref"))}
    paths = {k: scratch_dir(v.spark, f"ensembl-{k}") for k in (*xrefs, "gff")}
    for k, df in xrefs.items():
        df.write.mode("overwrite").options(header=True, sep="\t").csv(paths[k])
    gff = v.genes.where("start % 5 <> 0").selectExpr(
        "chromosome AS seqid", "'e' AS source", "'mRNA' AS type", "start", "end", "NULL AS score", "'+' AS strand", "NULL AS phase",
        "'ID=transcript:ENST' || symbol AS attributes")
    formats.write_gff3(gff, paths["gff"])
    out = ref.import_ensembl(v.spark, {k: paths[k] for k in xrefs}, paths["gff"])
    return out.select("gene_stable_id", "transcript_stable_id", F.array_join("ena", ",").alias("ena"),
                      F.array_join("refseq", ",").alias("refseq"), "chromosome", "start")


@witness("imp_dbnsfp_raw", """
SELECT chromosome AS chr, CAST(start AS VARCHAR) AS position_1_based, symbol,
       CASE WHEN start % 7 <> 0 THEN CAST(start % 9 AS VARCHAR) || ';' || CAST(start % 5 AS VARCHAR) END AS scores FROM genes
""")
def _(v):
    path = scratch_dir(v.spark, "dbnsfp")
    v.genes.selectExpr("chromosome AS `#chr`", "start AS `pos(1-based)`", "symbol",
                       "CASE WHEN start % 7 <> 0 THEN CAST(start % 9 AS STRING) || ';' || CAST(start % 5 AS STRING) END AS scores") \
        .write.mode("overwrite").options(header=True, sep="\t", nullValue=".").csv(path)
    return ref.import_dbnsfp_raw(v.spark, path).select("chr", F.col("`position_1-based`").alias("position_1_based"), "symbol", "scores")
