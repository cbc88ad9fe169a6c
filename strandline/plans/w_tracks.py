"""Witnesses for genome-browser track conversion.

The raw source lines are rendered from ``genes`` / ``cnvs`` as tab-separated
text with the source format's column positions; the converters parse them
back. Field expressions are shared by both engines (``{end}`` is quoted per
dialect).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from strandline.operators import tracks as trk
from strandline.plans.registry import witness

LOC = "chromosome || ':' || CAST(start AS STRING) || '-' || CAST({end} AS STRING)"
GENE_DOSAGE = {
    1: "symbol", 2: "CAST(start AS STRING)", 3: "'p' || CAST(start % 36 AS STRING)",
    4: f"CASE WHEN start % 11 = 0 THEN 'tbd' ELSE {LOC} END", 5: "CAST({end} % 4 AS STRING)",
    6: "CASE WHEN {end} % 2 = 0 THEN 'Sufficient evidence' ELSE 'No evidence available' END",
    13: "'3'", 14: "'Dosage sensitivity unlikely'", 21: "'2024-01-01'", 22: "'MONDO:' || CAST(start AS STRING)",
    23: "''",
}
REGION_DOSAGE = {
    1: "'ISCA-' || symbol", 2: "'Region (' || symbol || '), del; dup'",
    3: "CASE WHEN start % 3 = 0 THEN '' ELSE 'q' || CAST(start % 20 AS STRING) END",
    4: f"CASE WHEN start % 13 = 0 THEN 'tbd' ELSE {LOC} END",
    5: "CASE WHEN {end} % 5 = 0 THEN '' ELSE CAST({end} % 3 AS STRING) END",
    6: "CASE WHEN {end} % 2 = 0 THEN 'Gene Associated with autosomal recessive phenotype' ELSE '' END",
    13: "CASE WHEN start % 2 = 0 THEN '1' ELSE '' END", 14: "'No evidence'", 21: "'2023-05-05'", 22: "''",
    23: "'MONDO:' || CAST({end} AS STRING)",
}
SELF_CHAIN = {
    1: "'0'", 2: "CAST(({end} - start) * 3 AS STRING)", 3: "chromosome", 4: "'1000'", 5: "CAST(start AS STRING)",
    6: "CAST({end} AS STRING)", 7: "chromosome", 8: "'1000'", 9: "CASE type WHEN 'DEL' THEN '-' ELSE '+' END",
    10: "CAST(start + 7 AS STRING)", 11: "CAST({end} + 7 AS STRING)", 12: "substr(cnv_id, 4)",
    13: "CAST(CAST({end} - start AS DOUBLE) / 4 AS STRING)",
}
SEGDUP = {
    2: "chromosome", 3: "CAST(start AS STRING)", 4: "CAST({end} AS STRING)", 5: "cnv_id",
    6: "CAST({end} - start AS STRING)", 7: "CASE type WHEN 'DEL' THEN '-' ELSE '+' END", 8: "chromosome",
    9: "CAST(start + 5 AS STRING)", 10: "CAST({end} + 5 AS STRING)", 19: "CAST({end} - start AS STRING)",
    23: "CAST({end} - start - 1 AS STRING)", 24: "'1'", 27: "CAST(CAST({end} - start AS DOUBLE) / 400 AS STRING)",
    28: "CAST(CAST({end} - start AS DOUBLE) / 500 AS STRING)", 29: "''",
}
REPEAT = {
    2: "CAST({end} - start AS STRING)", 3: "CAST(start % 300 AS STRING)", 4: "'0'", 5: "CAST({end} % 9 AS STRING)",
    6: "chromosome", 7: "CAST(start AS STRING)", 8: "CAST({end} AS STRING)",
    10: "CASE WHEN start % 2 = 0 THEN '+' ELSE '-' END", 11: "symbol",
    12: "CASE WHEN {end} % 3 = 0 THEN 'LINE' WHEN {end} % 3 = 1 THEN 'SINE' ELSE 'Simple_repeat' END",
    13: "'L1'", 17: "''",
}
TANDEM = {
    2: "chromosome", 3: "CAST(start AS STRING)", 4: "CAST({end} AS STRING)", 5: "'trf'",
    6: "CAST(({end} - start) % 50 + 1 AS STRING)", 7: "CAST(CAST({end} - start AS DOUBLE) / 2 AS STRING)",
    11: "CAST({end} % 1000 AS STRING)", 16: "CAST(CAST(start % 8 AS DOUBLE) / 4 AS STRING)", 17: "'ACGT'",
}


def _line(fields: dict[int, str], dialect: str) -> str:
    end = "`end`" if dialect == "spark" else '"end"'
    n = max(fields)
    cols = [fields.get(i, "''").format(end=end) for i in range(1, n + 1)]
    if dialect == "duck":
        cols = [c.replace("AS STRING", "AS VARCHAR") for c in cols]
    return "concat_ws(chr(9), " + ", ".join(cols) + ")"


def _f(fields: dict[int, str], i: int) -> str:
    return fields.get(i, "''").format(end='"end"').replace("AS STRING", "AS VARCHAR")


def _lines(df, fields, order: str | None = None, blanks: bool = False):
    """``blanks``: a table whose fields are separated by any white space, so none may be empty."""
    if blanks:
        fields = {i: "'.'" for i in range(1, max(fields) + 1)} | fields
    value = F.expr(_line(fields, "spark"))
    if blanks:
        value = F.when(F.col("start") % 40 == 0, F.concat(F.lit(" "), F.replace(value, F.lit("\t"), F.lit(" \t  ")), F.lit("\t "))).otherwise(value)
    cols = [value.alias("value")]
    if order:
        cols.append(F.expr(order).alias("line_no"))
    return df.select(*cols)


def _raw_sql(fields: dict[int, str], table: str, extra: str = "") -> str:
    cols = ", ".join(f"{_f(fields, i)} AS f{i}" for i in range(1, max(fields) + 1))
    return f"SELECT {cols}{extra}, {_line(fields, 'duck')} AS line FROM {table}"


LOC_PARSE = ("p AS (SELECT *, coalesce(string_split_regex(f4, '[:-]')[1], '') AS s, "
             "coalesce(string_split_regex(f4, '[:-]')[2], '') AS a, coalesce(string_split_regex(f4, '[:-]')[3], '') AS b "
             "FROM raw)")
VALID = "s <> '' AND regexp_matches(a, '^[0-9]+$') AND regexp_matches(b, '^[0-9]+$')"
GENE_ATTRS = ("'ID=' || f1 || '_' || f2 || ';Name=' || f1 || ';gene_id=' || f2 || ';cytoband=' || f3 || "
              "';haploinsufficiency_score=' || f5 || ';haploinsufficiency_description=' || replace(f6, ' ', '_') || "
              "';triplosensitivity_score=' || f13 || ';triplosensitivity_description=' || replace(f14, ' ', '_') || "
              "';date_last_evaluated=' || f21 || ';haploinsufficiency_disease_id=' || f22 || "
              "';triplosensitivity_disease_id=' || f23")
GENE_GFF = (f"g AS (SELECT s AS seqid, 'ClinGen' AS source, 'gene' AS type, CAST(a AS BIGINT) AS start, "
            f"CAST(b AS BIGINT) AS \"end\", '.' AS score, '.' AS strand, '.' AS phase, {GENE_ATTRS} AS attributes "
            f"FROM p WHERE {VALID})")


@witness("trk_gene_dosage", f"WITH raw AS ({_raw_sql(GENE_DOSAGE, 'genes')}), {LOC_PARSE}, {GENE_GFF} SELECT * FROM g")
def _(v):
    return trk.gene_dosage_gff(_lines(v.genes, GENE_DOSAGE))


def _opt(key: str, i: int, desc: bool = False) -> str:
    val = f"replace(f{i}, ' ', '_')" if desc else f"f{i}"
    return f"CASE WHEN f{i} <> '' THEN ';{key}=' || {val} ELSE '' END"


REGION_ATTRS = ("'ID=' || f1 || ';Name=' || regexp_replace(replace(f2, ' ', '_'), '[();,]', '', 'g') || ';isca_id=' || f1 || "
                + " || ".join([_opt("cytoband", 3), _opt("haploinsufficiency_score", 5),
                               _opt("haploinsufficiency_description", 6, True), _opt("triplosensitivity_score", 13),
                               _opt("triplosensitivity_description", 14, True), _opt("date_last_evaluated", 21),
                               _opt("haploinsufficiency_disease_id", 22), _opt("triplosensitivity_disease_id", 23)]))


@witness("trk_region_dosage", f"""
WITH raw AS ({_raw_sql(REGION_DOSAGE, 'genes')}), {LOC_PARSE}
SELECT s AS seqid, 'ClinGen' AS source, 'region' AS type, CAST(a AS BIGINT) AS start, CAST(b AS BIGINT) AS "end",
       '.' AS score, '.' AS strand, '.' AS phase, {REGION_ATTRS} AS attributes
FROM p WHERE {VALID}
""")
def _(v):
    return trk.region_dosage_gff(_lines(v.genes, REGION_DOSAGE))


@witness("trk_self_chain", """
SELECT chromosome AS seqid, 'UCSC_chainSelf' AS source, 'self_chain_alignment' AS type, CAST(start + 1 AS BIGINT) AS start,
       CAST("end" AS BIGINT) AS "end", CAST(("end" - start) * 3 AS VARCHAR) AS score, '.' AS strand, '.' AS phase,
       printf('ID=chainSelf_%s;score=%.0f;normScore=%.2f;Target=%s %d %d;target_strand=%s', substr(cnv_id, 4),
              CAST(("end" - start) * 3 AS DOUBLE), CAST("end" - start AS DOUBLE) / 4, chromosome,
              CAST(start + 8 AS BIGINT), CAST("end" + 7 AS BIGINT), CASE type WHEN 'DEL' THEN '-' ELSE '+' END) AS attributes
FROM cnvs
""")
def _(v):
    return trk.self_chain_gff(_lines(v.cnvs, SELF_CHAIN, blanks=True))


@witness("trk_segdup", """
SELECT chromosome AS seqid, 'UCSC_SuperDups' AS source, '' AS type, CAST(start + 1 AS BIGINT) AS start,
       CAST("end" AS BIGINT) AS "end", CAST("end" - start AS VARCHAR) AS score,
       CASE type WHEN 'DEL' THEN '-' ELSE '+' END AS strand, '.' AS phase,
       printf('ID=gsd_%d;Name=%s;Target=%s %d %d;frac_match=%.6f;frac_match_indel=%.6f;align_length=%d;match_bases=%d;mismatch_bases=%d',
              row_number() OVER (ORDER BY CAST(substr(cnv_id, 4) AS BIGINT)), cnv_id, chromosome, CAST(start + 6 AS BIGINT),
              CAST("end" + 5 AS BIGINT), CAST("end" - start AS DOUBLE) / 400, CAST("end" - start AS DOUBLE) / 500,
              CAST("end" - start AS BIGINT), CAST("end" - start - 1 AS BIGINT), CAST(1 AS BIGINT)) AS attributes
FROM cnvs
""")
def _(v):
    return trk.segdup_gff(_lines(v.cnvs, SEGDUP, "CAST(substr(cnv_id, 4) AS BIGINT)", blanks=True))


@witness("trk_repeat", """
SELECT chromosome AS seqid, 'RepeatMasker' AS source,
       CASE WHEN "end" % 3 = 0 THEN 'LINE' WHEN "end" % 3 = 1 THEN 'SINE' ELSE 'Simple_repeat' END AS type,
       CAST(start + 1 AS BIGINT) AS start, CAST("end" AS BIGINT) AS "end", CAST("end" - start AS VARCHAR) AS score,
       CASE WHEN start % 2 = 0 THEN '+' ELSE '-' END AS strand, '.' AS phase,
       printf('ID=rmsk_%d;Name=%s;rep_family=%s;milli_div=%d;milli_del=%d;milli_ins=%d',
              row_number() OVER (ORDER BY CAST(substr(symbol, 5) AS BIGINT)), symbol, 'L1', CAST(start % 300 AS BIGINT),
              CAST(0 AS BIGINT), CAST("end" % 9 AS BIGINT)) AS attributes
FROM genes
""")
def _(v):
    return trk.repeat_gff(_lines(v.genes, REPEAT, "CAST(substr(symbol, 5) AS BIGINT)", blanks=True))


@witness("trk_tandem", """
SELECT chromosome AS seqid, 'trf' AS source, '' AS type, CAST(start + 1 AS BIGINT) AS start, CAST("end" AS BIGINT) AS "end",
       CAST("end" % 1000 AS VARCHAR) AS score, '.' AS strand, '.' AS phase,
       printf('ID=trf_%d;period=%d;copy_num=%.1f;entropy=%.2f;consensus_sequence=%s',
              row_number() OVER (ORDER BY CAST(substr(symbol, 5) AS BIGINT)), CAST(("end" - start) % 50 + 1 AS BIGINT),
              CAST("end" - start AS DOUBLE) / 2, CAST(start % 8 AS DOUBLE) / 4, 'ACGT') AS attributes
FROM genes
""")
def _(v):
    return trk.tandem_gff(_lines(v.genes, TANDEM, "CAST(substr(symbol, 5) AS BIGINT)", blanks=True))


@witness("trk_escape", """
WITH s AS (SELECT page_id, array_to_string(list_transform(string_split(html, '%'),
             lambda x, i: CASE WHEN i = 1 THEN x WHEN regexp_matches(x, '^[0-9a-fA-F]{2}') THEN '%' || x
                               ELSE '%25' || x END), '') AS escaped FROM pages)
SELECT page_id, md5(escaped) AS escaped_md5, length(escaped) AS n_chars FROM s
""")
def _(v):
    e = trk.escape_percent(F.col("html"))
    return v.pages.select("page_id", F.md5(e).alias("escaped_md5"), F.length(e).cast("bigint").alias("n_chars"))


@witness("trk_sorted", f"""
WITH raw AS ({_raw_sql(GENE_DOSAGE, 'genes')}), {LOC_PARSE}, {GENE_GFF}
SELECT seqid, start, split_part(split_part(attributes, ';', 1), '=', 2) AS feature_id,
       row_number() OVER (ORDER BY seqid, start, "end", attributes) AS rank
FROM g
""")
def _(v):
    s = trk.sort_track(trk.gene_dosage_gff(_lines(v.genes, GENE_DOSAGE)))
    return s.select("seqid", "start", F.split_part(F.split_part("attributes", F.lit(";"), F.lit(1)), F.lit("="),
                                                   F.lit(2)).alias("feature_id"), "rank")


@witness("trk_rejected", f"""
WITH raw AS ({_raw_sql(GENE_DOSAGE, 'genes')}), {LOC_PARSE}
SELECT line AS value, 'WARNING: Skipping line with invalid location data: ' || line AS warning FROM p WHERE NOT ({VALID})
""")
def _(v):
    return trk.rejected_rows(_lines(v.genes, GENE_DOSAGE))
