"""Variant tables: normalisation, frequencies, enrichment, structural-variant
clusters and centric documents.

The variant key is (chromosome, start, reference, alternate). Aggregations
shuffle on that key with map-side partial aggregation; cohort sizes are
aggregated to one row per analysis code (a fixed, tiny set) before being
joined back. Documents have one row a variant or gene; what may be very long
(donors, a gene's variants) is a child table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandline.operators import ranges, sv_cells
from strandline.operators._util import literal_map
from strandline.operators.catalog import path_param
from strandline.session import cut_lineage
from strandline.sources.versions import BUCKETS, BucketedTable

VARIANT_KEY = ["chromosome", "start", "reference", "alternate"]
# Qualifying-occurrence thresholds of the frequency rule.
MIN_GQ = 20
MIN_AD_ALT = 3
SPANNING_DELETION = "*"
PASS = "PASS"
ALL_CODES = "all"
CONSEQUENCE_RANK = {"missense_variant": "1", "synonymous_variant": "2", "intron_variant": "3"}


def passes(filters: Column, dtype: str) -> Column:
    """``PASS`` in the filters (array or single string)."""
    if dtype.startswith("array"):
        return F.array_contains(filters, PASS)
    return filters == PASS


def qualifies(occ: DataFrame) -> Column:
    """Occurrence counts toward frequencies."""
    dt = dict(occ.dtypes)["filters"]
    return ((F.col("gq") >= MIN_GQ) & passes(F.col("filters"), dt) & (F.col("ad_alt") >= MIN_AD_ALT)
            & (F.col("alternate") != SPANNING_DELETION))


def alt_alleles(zygosity: Column) -> Column:
    return F.when(zygosity == "HOM", 2).when(zygosity == "HET", 1).otherwise(0)


def normalize_snv(occ: DataFrame,
                  tie_break: Sequence[str] = ("order_key", "line_no", "filters", "zygosity")) -> DataFrame:
    """Drop spanning deletions; one row per variant x sequencing, keeping the
    best genotype quality (ties by ``tie_break``, then the remaining columns).

    A hash aggregate of ``min(struct(-gq, tie-breaks..., payload))`` instead of a
    window: partial aggregation runs map-side before the shuffle and no
    partition has to be sorted, so a very frequent variant costs no more than
    any other key."""
    key = [*VARIANT_KEY, "sequencing_id"]
    rest = [c for c in occ.columns if c not in key and c != "gq" and c not in tie_break]
    best = F.min(F.struct((-F.col("gq")).alias("_neg_gq"), *[F.col(c) for c in tie_break],
                          *[F.col(c) for c in rest])).alias("_b")
    agg = occ.where(F.col("alternate") != SPANNING_DELETION).groupBy(*key).agg(best)
    return agg.select(*key, (-F.col("_b._neg_gq")).alias("gq"),
                      *[F.col(f"_b.{c}").alias(c) for c in [*tie_break, *rest]]).select(*occ.columns)


normalize_snv_somatic = normalize_snv


def normalize_cnv(cnvs: DataFrame, filter_col: str | None = "filters") -> DataFrame:
    """Typed CNV intervals with length, PASS only. A source without filters must say so (``filter_col=None``)."""
    c = cnvs
    if filter_col is not None:
        c = c.where(passes(F.col(filter_col), cnvs.schema[filter_col].dataType.simpleString()))
    return c.select("cnv_id", "sequencing_id", "chromosome", F.col("start").cast("bigint").alias("start"),
                    F.col("end").cast("bigint").alias("end"), "type",
                    (F.col("end") - F.col("start")).cast("bigint").alias("length"))


normalize_cnv_tumor_only = normalize_cnv


def with_clinical(occ: DataFrame, clinical: DataFrame, cols: Sequence[str] = ("analysis_id", "batch_id",
                                                                               "bioinfo_analysis_code")) -> DataFrame:
    return occ.join(clinical.select("sequencing_id", *cols), "sequencing_id")


def normalize_variants(occ: DataFrame, clinical: DataFrame, enriched: bool = False) -> DataFrame:
    """Distinct variants per batch with counts; allele counts only from
    qualifying occurrences. ``enriched``: ``occ`` is the result of ``enrich_snv`` for these clinical rows."""
    o = occ if enriched else with_clinical(normalize_snv(occ), clinical)
    q = qualifies(o)
    return o.groupBy(*VARIANT_KEY, "batch_id").agg(
        F.count("*").alias("n_occurrences"),
        F.count(F.when(q, 1)).alias("pc"),
        F.sum(F.when(q, alt_alleles(F.col("zygosity"))).otherwise(0)).cast("bigint").alias("ac"))


def cohort_sizes(clinical: DataFrame, code: str = "bioinfo_analysis_code") -> DataFrame:
    """Distinct sequencings per analysis code and overall (tiny: one row per code)."""
    return (clinical.groupBy(F.col(code).alias("analysis_code"))
            .agg(F.countDistinct("sequencing_id").alias("pn"))
            .unionByName(clinical.agg(F.countDistinct("sequencing_id").alias("pn"))
                         .select(F.lit(ALL_CODES).alias("analysis_code"), "pn")))


def frequencies(occ: DataFrame, clinical: DataFrame, enriched: bool = False) -> DataFrame:
    """Allele / participant frequencies per variant, by analysis code and
    overall, from qualifying occurrences only. ``enriched``: ``occ`` is the result of ``enrich_snv``
    for these clinical rows, so that nothing is normalised and joined again."""
    o = occ if enriched else with_clinical(normalize_snv(occ), clinical, ["bioinfo_analysis_code"])
    q = o.where(qualifies(o)).select(*VARIANT_KEY, "sequencing_id", "bioinfo_analysis_code",
                                     alt_alleles(F.col("zygosity")).alias("_alleles"),
                                     (F.col("zygosity") == "HOM").alias("_hom"))
    # input is one row per (variant, sequencing): participant count = row count
    by_code = q.groupBy(*VARIANT_KEY, F.col("bioinfo_analysis_code").alias("analysis_code")).agg(
        F.sum("_alleles").cast("bigint").alias("ac"), F.count("*").alias("pc"), F.count(F.when(F.col("_hom"), 1)).alias("hom"))
    # a variant's few codes meet in one row and are dealt once by variant; who groups by variant again need not deal them
    counts = ["ac", "pc", "hom"]
    met = by_code.groupBy(*VARIANT_KEY).agg(F.collect_list(F.struct("analysis_code", *counts)).alias("_codes"),
                                            *[F.sum(c).alias(c) for c in counts])
    agg = met.select(*VARIANT_KEY, F.inline(F.array_append("_codes", F.struct(F.lit(ALL_CODES).alias("analysis_code"), *counts))))
    sizes = cohort_sizes(clinical)
    out = agg.join(F.broadcast(sizes), "analysis_code")  # one row per code: bounded by the code enumeration
    return out.select(*VARIANT_KEY, "analysis_code", "ac", (F.col("pn") * 2).alias("an"),
                      (F.col("ac") / (F.col("pn") * 2)).alias("af"), "pc", "pn",
                      (F.col("pc") / F.col("pn")).alias("pf"), "hom")


def tumor_frequencies(occ: DataFrame, clinical: DataFrame, enriched: bool = False) -> DataFrame:
    """Per variant, participant counts split into tumor-only and tumor-normal; the frequency of an empty cohort is
    NULL. Germline rows are left out first, and rows are one per variant and sequencing, so plain counts suffice.
    ``enriched`` as in ``frequencies``."""
    in_tumor = F.col("bioinfo_analysis_code").isin("TEBA", "TNEBA")
    if enriched:
        o = occ.where(in_tumor)
    else:
        tumor = clinical.where(in_tumor)
        wanted = occ.join(tumor.select("sequencing_id").distinct(), "sequencing_id", "left_semi")
        o = with_clinical(normalize_snv(wanted), tumor, ["bioinfo_analysis_code"])
    q = o.where(qualifies(o))
    sizes = clinical.agg(
        F.countDistinct(F.when(F.col("bioinfo_analysis_code") == "TEBA", F.col("sequencing_id"))).alias("to_pn"),
        F.countDistinct(F.when(F.col("bioinfo_analysis_code") == "TNEBA", F.col("sequencing_id"))).alias("tn_pn"))
    agg = q.groupBy(*VARIANT_KEY).agg(
        F.count_if(F.col("bioinfo_analysis_code") == "TEBA").alias("to_pc"),
        F.count_if(F.col("bioinfo_analysis_code") == "TNEBA").alias("tn_pc"))
    agg = agg.where("to_pc > 0 OR tn_pc > 0")
    to_pn, tn_pn = sizes.select("to_pn").scalar(), sizes.select("tn_pn").scalar()  # one-row subqueries
    return agg.select(*VARIANT_KEY, "to_pc", to_pn.alias("to_pn"), F.try_divide("to_pc", to_pn).alias("to_pf"),
                      "tn_pc", tn_pn.alias("tn_pn"), F.try_divide("tn_pc", tn_pn).alias("tn_pf"))


def enrich_snv(occ: DataFrame, clinical: DataFrame, analysis_ids: DataFrame | None = None) -> DataFrame:
    """Normalised occurrences with clinical columns; optionally only the given
    analyses (semi joins, so that the other occurrences are left out before they are normalised)."""
    c = clinical
    if analysis_ids is not None:
        c = c.join(analysis_ids.select(F.col(analysis_ids.columns[0]).alias("analysis_id")), "analysis_id",
                   "left_semi")
        occ = occ.join(c.select("sequencing_id"), "sequencing_id", "left_semi")
    # dealt by sequencing once: for one row a variant and sequencing, and for the join
    o = normalize_snv(occ.repartition("sequencing_id"))
    return o.join(c.select("sequencing_id", "analysis_id", "batch_id", "bioinfo_analysis_code", "is_proband",
                           "gender", "affected_status"), "sequencing_id")


def variant_intervals(df: DataFrame) -> DataFrame:
    """SNV/indel as a closed interval over the reference allele."""
    return df.withColumn("end", F.col("start") + F.length("reference") - 1)


def gene_overlap(intervals: DataFrame, genes: DataFrame, bin_size: int | None = None) -> DataFrame:
    """Rows of ``intervals`` (chromosome, start, end, ...) paired with every gene
    whose closed interval overlaps (binned range join)."""
    g = genes.select(F.col("symbol"), F.col("chromosome"), F.col("start").alias("g_start"),
                     F.col("end").alias("g_end"), *[c for c in genes.columns
                                                    if c not in ("symbol", "chromosome", "start", "end")])
    return ranges.overlap_join(intervals, g, ["chromosome"], right_start="g_start", right_end="g_end",
                               bin_size=bin_size)


def distinct_variants(occ: DataFrame) -> DataFrame:
    return occ.where(F.col("alternate") != SPANNING_DELETION).select(*VARIANT_KEY).distinct()


def consequence_of(reference: Column, alternate: Column) -> Column:
    """Chosen consequence model over the alleles (the annotator is external)."""
    return (F.when((reference == "A") | (alternate == "A"), "missense_variant")
            .when((reference == "C") | (alternate == "C"), "synonymous_variant")
            .otherwise("intron_variant"))


def normalize_consequences(occ: DataFrame, genes: DataFrame, bin_size: int | None = None) -> DataFrame:
    """One row per variant x transcript consequence."""
    v = variant_intervals(distinct_variants(occ))
    pairs = gene_overlap(v, genes.select("symbol", "chromosome", "start", "end"), bin_size)
    # dealt by symbol, which also serves the joins and counts by gene; what follows from the pair is added afterwards
    once = pairs.select(*VARIANT_KEY, "symbol").repartition("symbol").distinct()
    return once.select("*", F.concat("symbol", F.lit("-T1")).alias("transcript"),
                       consequence_of(F.col("reference"), F.col("alternate")).alias("consequence"))


def normalize_coverage(coverage: DataFrame, key: Sequence[str] = ("symbol", "sample_id"),
                       order: Sequence[str] = ("depth", "order_key", "line_no")) -> DataFrame:
    """Coverage rows unique per gene x sample: the greatest by ``order``."""
    # dealt by the first part of the key (gene), as joins with the gene table need them; a pair has few rows to combine before
    best = coverage.repartition(key[0]).groupBy(*key).agg(F.max(F.struct(*order)).alias("_b"))
    return best.select(*key, *[F.col(f"_b.{c}").alias(c) for c in order])


#: Result files: columns of a table of each kind, and the ids that stand in its path only.
RESULT_SCHEMAS = {
    "exomiser": "chromosome string, start bigint, reference string, alternate string, symbol string, score double",
    "exomiser_cnv": "chromosome string, start bigint, `end` bigint, type string, symbol string, score double",
    "franklin": "chromosome string, start bigint, reference string, alternate string, score double, classification string",
}
RESULT_KEYS = ("batch_id", "analysis_id", "aliquot_id")


def read_results(spark, path: str, schema: str, keys: Sequence[str] = RESULT_KEYS) -> DataFrame:
    """Result files below a folder, TSV with a header (``.tsv``, ``.csv``) and JSON (``.json``, one document or one a line) in
    one table: the columns of ``schema``, and of the path of each file the ``name=value`` segments named by ``keys`` (NULL
    where a path has none). Values that are not of their type are NULL."""
    def files(pattern: str):
        return spark.read.schema(schema).option("recursiveFileLookup", "true").option("pathGlobFilter", pattern)

    where = F.url_decode(F.regexp_replace(F.col("_metadata.file_path"), r"\+", "%2B"))
    of_path = [path_param(where, k).alias(k) for k in keys]
    tables = files("*.{tsv,csv}").option("sep", "\t").option("header", True).csv(path)
    documents = files("*.json").json(path)
    return tables.select("*", *of_path).unionByName(documents.select("*", *of_path))


def normalize_exomiser(spark, path: str, kind: str = "exomiser") -> DataFrame:
    """Prioritised variants (``exomiser``) or copy-number variants (``exomiser_cnv``): one row for each, best score a key."""
    rows = read_results(spark, path, RESULT_SCHEMAS[kind])
    key = [c for c in rows.columns if c != "score"]
    return rows.groupBy(*key).agg(F.max("score").alias("score"))


def normalize_franklin(spark, path: str) -> DataFrame:
    """Scored variants of the service's JSON results; one row a variant, classification and aliquot."""
    return normalize_exomiser(spark, path, "franklin")


def scored_results(events: DataFrame, schema: str = "struct<k:int>") -> DataFrame:
    """Scored third-party results (JSON payloads) -> rows."""
    return events.select("*", F.from_json("props", schema).alias("_p")).select("*", "_p.*").drop("_p")


def flatten_resources(docs: DataFrame, schema: str, array_field: str) -> DataFrame:
    """Nested clinical resources (JSON text) -> flat rows, one per array element."""
    p = docs.select(F.from_json("json", schema).alias("r"))
    return p.select("r.*").select("*", F.explode_outer(array_field).alias("_e")).select(
        "*", "_e.*").drop("_e", array_field)


def enrich_clinical(clinical: DataFrame, signs: DataFrame) -> DataFrame:
    """Clinical rows, each as it is, with their signs as an array. Duplicate rows stay: reporting them is the
    quality check's task."""
    s = signs.groupBy("sequencing_id").agg(F.collect_list(F.struct(
        F.col("hpo_id").alias("id"), "affected_status", "age_at_onset")).alias("clinical_signs"))
    return clinical.join(s, "sequencing_id", "left")


def external_frequencies(variants: DataFrame, sources: dict[str, DataFrame]) -> DataFrame:
    """One struct column per public source, left-joined on the variant key."""
    out = variants
    for name, src in sources.items():
        vals = [c for c in src.columns if c not in VARIANT_KEY]
        s = src.select(*VARIANT_KEY, F.struct(*vals).alias(name))
        out = out.join(s, VARIANT_KEY, "left")
    return out


def max_score(scores: DataFrame, score: str = "score", who: str = "sequencing_id") -> DataFrame:
    """Per variant, the best score and whose it is (ties: greatest id)."""
    # two aggregates: who reads the score alone is spared the one over structs, which sorts all rows before the shuffle
    best = scores.groupBy(*VARIANT_KEY).agg(F.max(score).alias("max_score"), F.max(F.struct(score, who)).alias("_m"))
    return best.select(*VARIANT_KEY, "max_score", F.col(f"_m.{who}").alias("max_" + who))


def enrich_variants(variants: DataFrame, sources: dict[str, DataFrame], clinvar: DataFrame,
                    genes: DataFrame, scores: DataFrame, bin_size: int | None = None) -> DataFrame:
    """Distinct variants + external frequencies + clinvar + genes + max score."""
    v = external_frequencies(variants, sources)
    v = v.join(clinvar, VARIANT_KEY, "left")
    g = (gene_overlap(variant_intervals(variants), genes.select("symbol", "chromosome", "start", "end"), bin_size)
         .groupBy(*VARIANT_KEY).agg(F.count("*").alias("n_genes"), F.min("symbol").alias("first_symbol")))
    v = v.join(g, VARIANT_KEY, "left")
    return v.join(max_score(scores), VARIANT_KEY, "left")


def enrich_consequences(consequences: DataFrame, scores: DataFrame) -> DataFrame:
    """Consequences with per-gene prediction scores and ``picked`` = the most
    severe consequence of each variant (ties by symbol, transcript)."""
    c = consequences.join(scores, "symbol", "left")
    rank = literal_map(CONSEQUENCE_RANK)[F.col("consequence")].cast("int")
    w = Window.partitionBy(*VARIANT_KEY).orderBy(rank.asc_nulls_last(), F.col("symbol"), F.col("transcript"))
    return c.withColumn("picked", F.row_number().over(w) == 1)


#: Members of a site that one row holds as a list when pairs are made.
PAIR_BLOCK = 256


def sv_pairs(cnvs: DataFrame, min_overlap: float = 0.8, bin_size: int | None = None) -> DataFrame:
    """Unordered pairs (a < b) of CNVs on the same chromosome with the same
    type whose reciprocal overlap (half-open intervals) is >= ``min_overlap``.

    Intervals are compared once for each pair of distinct sites. CNVs at the
    same site are held in lists of about ``PAIR_BLOCK``, and pairs of lists are
    written out as pairs of CNVs, so a site shared by many samples costs no
    comparisons and is dealt over the tasks. Lists are sorted, so that pairs
    come in runs, of which columnar files keep little. The pairs themselves
    stay as many as they are: quadratic in the CNVs of a site."""
    site = sv_cells.SITE
    counted = cnvs.where((F.col("end") > F.col("start")) & F.col("cnv_id").isNotNull()).select("cnv_id", *site)
    sites = cut_lineage(counted.groupBy(*site).agg(F.ceil(F.count(F.lit(1)) / PAIR_BLOCK).alias("parts"))
                        .where(F.col("chromosome").isNotNull() & F.col("type").isNotNull()))
    part = F.pmod(F.xxhash64("cnv_id"), F.col("parts")).cast("int")
    lists = cut_lineage(counted.join(sites, site).groupBy(*site, part.alias("part")).agg(F.sort_array(F.collect_list("cnv_id")).alias("ids")))

    def side(tag: str, df: DataFrame) -> DataFrame:
        return df.select("chromosome", "type", *[F.col(c).alias(f"{tag}_{c}") for c in df.columns if c not in ("chromosome", "type")])

    la, lb = F.col("x_end") - F.col("x_start"), F.col("y_end") - F.col("y_start")
    slack = min_overlap - 1e-9
    near = ((F.struct("x_start", "x_end") <= F.struct("y_start", "y_end")) & (lb >= la * slack) & (la >= lb * slack)
            & (ranges.reciprocal_overlap(F.col("x_start"), F.col("x_end"), F.col("y_start"), F.col("y_end")) >= min_overlap))
    met = ranges.overlap_join(side("x", sites), side("y", sites), ["chromosome", "type"], left_start="x_start", left_end="x_end",
                              right_start="y_start", right_end="y_end", bin_size=bin_size, extra=near)
    same = (F.col("x_start") == F.col("y_start")) & (F.col("x_end") == F.col("y_end"))
    dealt = met.withColumn("x_part", F.explode(F.sequence(F.lit(0), F.col("x_parts").cast("int") - 1))).withColumn(
        "y_part", F.explode(F.sequence(F.when(same, F.col("x_part")).otherwise(0), F.col("y_parts").cast("int") - 1)))
    place = ["chromosome", "type", "{}_start", "{}_end", "{}_part"]
    for tag in ("x", "y"):
        dealt = dealt.join(side(tag, lists), [c.format(tag) for c in place])
    alike = same & (F.col("x_part") == F.col("y_part"))
    pairs = dealt.withColumn("alike", alike).withColumn("x", F.explode("x_ids")).withColumn("y", F.explode("y_ids")).where(
        (F.col("x") < F.col("y")) | (~F.col("alike") & (F.col("y") < F.col("x"))))
    first = F.col("x") < F.col("y")
    pick = lambda c, d: F.when(first, F.col(c)).otherwise(F.col(d))
    return pairs.select(pick("x", "y").alias("a_id"), "chromosome", "type", pick("x_start", "y_start").alias("a_start"),
                        pick("x_end", "y_end").alias("a_end"), pick("y", "x").alias("b_id"),
                        pick("y_start", "x_start").alias("b_start"), pick("y_end", "x_end").alias("b_end"))


def sv_clusters(cnvs: DataFrame, min_overlap: float = 0.8, bin_size: int | None = None) -> DataFrame:
    """(cnv_id, cluster_id): connected components of the reciprocal-overlap graph, from a sparse certificate of it (see
    ``sv_cells``), so near-identical intervals make no pairs. The cluster id is the smallest cnv id of the component."""
    return sv_cells.clusters(cnvs, min_overlap, bin_size)


def cluster_frequencies(cnvs: DataFrame, clusters: DataFrame, clinical: DataFrame) -> DataFrame:
    """Per cluster and cohort kind (germline / somatic), sample count and
    frequency among the sequencings of that kind."""
    kind = F.when(F.col("bioinfo_analysis_code") == "GEBA", "germline").otherwise("somatic")
    c = clinical.select("sequencing_id", kind.alias("kind"))
    sizes = c.groupBy("kind").agg(F.countDistinct("sequencing_id").alias("pn"))
    j = cnvs.join(clusters, "cnv_id").join(c, "sequencing_id")
    agg = j.groupBy("cluster_id", "type", "kind").agg(F.countDistinct("sequencing_id").alias("pc"))
    return agg.join(F.broadcast(sizes), "kind").select(
        "cluster_id", "type", "kind", "pc", "pn", (F.col("pc") / F.col("pn")).alias("pf"))


def parental_origin(cnvs: DataFrame, clinical: DataFrame, min_overlap: float = 0.8,
                    bin_size: int | None = None) -> DataFrame:
    """For every proband CNV: ``mother``, ``father``, ``both`` or ``none`` by a
    reciprocal-overlap match among the parents' CNVs (same chromosome, type)."""
    aliq = clinical.select("aliquot_id", F.col("sequencing_id").alias("parent_seq"))
    prob = clinical.where("is_proband").select("sequencing_id", "analysis_id", "father_aliquot_id",
                                               "mother_aliquot_id")
    parents = (prob.select("sequencing_id", F.lit("father").alias("role"), F.col("father_aliquot_id").alias("aliquot_id"))
               .unionByName(prob.select("sequencing_id", F.lit("mother").alias("role"),
                                        F.col("mother_aliquot_id").alias("aliquot_id")))
               .where(F.col("aliquot_id").isNotNull())
               .join(aliq, "aliquot_id").select(F.col("sequencing_id").alias("proband_seq"), "role", "parent_seq"))
    pc = cnvs.join(prob.select("sequencing_id"), "sequencing_id", "left_semi").select(
        F.col("cnv_id").alias("a_id"), F.col("sequencing_id").alias("proband_seq"), "chromosome", "type",
        F.col("start").alias("a_start"), F.col("end").alias("a_end"))
    parent_cnvs = cnvs.join(parents, cnvs["sequencing_id"] == parents["parent_seq"]).select(
        "proband_seq", "role", "chromosome", "type", F.col("start").alias("b_start"), F.col("end").alias("b_end"))
    la = F.col("a_end") - F.col("a_start")
    lb = F.col("b_end") - F.col("b_start")
    slack = min_overlap - 1e-9
    extra = ((la > 0) & (lb > 0) & (lb >= la * slack) & (la >= lb * slack)
             & (ranges.reciprocal_overlap(F.col("a_start"), F.col("a_end"), F.col("b_start"), F.col("b_end"))
                >= min_overlap))
    m = ranges.overlap_join(pc, parent_cnvs, ["proband_seq", "chromosome", "type"], left_start="a_start",
                            left_end="a_end", right_start="b_start", right_end="b_end", bin_size=bin_size,
                            extra=extra)
    hits = m.groupBy("a_id").agg(F.bool_or(F.col("role") == "mother").alias("_m"),
                                 F.bool_or(F.col("role") == "father").alias("_f"))
    origin = (F.when(F.col("_m") & F.col("_f"), "both").when(F.col("_m"), "mother")
              .when(F.col("_f"), "father").otherwise("none"))
    return pc.join(hits, "a_id", "left").select(F.col("a_id").alias("cnv_id"), "proband_seq", origin.alias("origin"))


def enrich_cnv(cnvs: DataFrame, genes: DataFrame, clusters: DataFrame, cluster_freq: DataFrame,
               origin: DataFrame, bin_size: int | None = None) -> DataFrame:
    """CNV + overlapping genes + cluster frequency + parental origin."""
    g = (gene_overlap(cnvs.select("cnv_id", "chromosome", "start", "end"),
                      genes.select("symbol", "chromosome", "start", "end"), bin_size)
         .groupBy("cnv_id").agg(F.count("*").alias("n_genes")))
    cf = cluster_freq.groupBy("cluster_id").agg(F.max("pf").alias("max_cluster_pf"))
    return (cnvs.join(g, "cnv_id", "left").join(clusters, "cnv_id", "left").join(cf, "cluster_id", "left")
            .join(origin.select("cnv_id", "origin"), "cnv_id", "left"))


def enrich_coverage(coverage: DataFrame, genes: DataFrame) -> DataFrame:
    """Coverage by gene joined to the gene table."""
    agg = coverage.groupBy("symbol").agg(F.count("*").alias("n_samples"),
                                         F.sum("depth").cast("bigint").alias("sum_depth"))
    return agg.join(genes.select("symbol", "chromosome", "start", "end"), "symbol")


def variant_donors(snv: DataFrame) -> DataFrame:
    """Child table of the variant documents: enriched occurrences (``enrich_snv``), one row per variant and sequencing."""
    return snv.select(*VARIANT_KEY, "sequencing_id", "analysis_id", "batch_id", "bioinfo_analysis_code", "is_proband",
                      "gender", "affected_status", "zygosity", "gq", "ad_alt", "filters")


def variant_centric(donors: DataFrame, freqs: DataFrame, tumor: DataFrame | None = None,
                    consequences: DataFrame | None = None, blocks: dict[str, DataFrame] | None = None) -> DataFrame:
    """Variant documents, one row per variant with a donor.

    ``n_donors``; ``frequency_RQDM`` and ``frequencies_by_analysis`` (one element per analysis code) from ``freqs``;
    ``freq_rqdm_tumor_only`` and ``freq_rqdm_tumor_normal`` from ``tumor``; ``consequences`` (one element per
    transcript at the place); and a struct per table of ``blocks`` (clinvar, cmc, external_frequencies,
    exomiser_max, franklin_max ...), each with one row per variant key. Blocks without a row are NULL."""
    docs = donors.groupBy(*VARIANT_KEY).agg(F.count(F.lit(1)).alias("n_donors"))
    fields = ["ac", "an", "af", "pc", "pn", "pf", "hom"]
    overall = F.col("analysis_code") == ALL_CODES
    docs = docs.join(freqs.groupBy(*VARIANT_KEY).agg(
        F.max(F.when(overall, F.struct(*fields))).alias("frequency_RQDM"),
        F.sort_array(F.collect_list(F.when(~overall, F.struct("analysis_code", *fields)))).alias(
            "frequencies_by_analysis")), VARIANT_KEY, "left")
    if tumor is not None:
        docs = docs.join(tumor.select(*VARIANT_KEY, F.struct("to_pc", "to_pn", "to_pf").alias("freq_rqdm_tumor_only"),
                                      F.struct("tn_pc", "tn_pn", "tn_pf").alias("freq_rqdm_tumor_normal")),
                         VARIANT_KEY, "left")
    if consequences is not None:
        rest = [c for c in consequences.columns if c not in VARIANT_KEY]
        docs = docs.join(consequences.groupBy(*VARIANT_KEY).agg(
            F.sort_array(F.collect_list(F.struct(*rest))).alias("consequences")), VARIANT_KEY, "left")
    for name, table in (blocks or {}).items():
        rest = [c for c in table.columns if c not in VARIANT_KEY]
        docs = docs.join(table.select(*VARIANT_KEY, F.struct(*rest).alias(name)), VARIANT_KEY, "left")
    return docs


def cnv_centric(enriched_cnv: DataFrame) -> DataFrame:
    return enriched_cnv.select("cnv_id", F.struct(*[c for c in enriched_cnv.columns if c != "cnv_id"]).alias("doc"))


def gene_variants(consequences: DataFrame) -> DataFrame:
    """Child table of the gene documents: one row per gene, variant and transcript."""
    return consequences.select("symbol", *VARIANT_KEY, "transcript", "consequence")


def gene_centric(genes: DataFrame, variants: DataFrame) -> DataFrame:
    """Gene documents, one row per gene, with the number of rows of its child table (``gene_variants``)."""
    n = variants.groupBy("symbol").agg(F.count(F.lit(1)).alias("n_variants"))
    return genes.join(n, "symbol", "left").withColumn("n_variants", F.coalesce("n_variants", F.lit(0)))


def coverage_by_gene_centric(coverage: DataFrame, genes: DataFrame) -> DataFrame:
    g = genes.select("symbol", "chromosome", "start", "end")
    return coverage.join(g, "symbol").select("symbol", "sample_id", F.struct("chromosome", "start", "end", "depth")
                                             .alias("doc"))


def gene_suggestions(genes: DataFrame) -> DataFrame:
    """Search strings per gene: the symbol (weight 5), its aliases (weight 4; the column ``aliases``, a list, where the table
    has it: each once, without the symbol itself) and its locus (weight 3)."""
    locus = F.concat("chromosome", F.lit(":"), F.col("start").cast("string"), F.lit("-"), F.col("end").cast("string"))
    s = F.array(F.struct(F.col("symbol").alias("text"), F.lit(5).alias("weight")),
                F.struct(locus.alias("text"), F.lit(3).alias("weight")))
    if "aliases" in genes.columns:
        own = F.array_distinct(F.filter("aliases", lambda a: (F.length(a) > 0) & (a != F.col("symbol"))))
        s = F.concat(s, F.transform(F.coalesce(own, F.array().cast("array<string>")), lambda a: F.struct(a.alias("text"), F.lit(4).alias("weight"))))
    return genes.select("symbol", F.inline(s))


def variant_suggestions(variants: DataFrame) -> DataFrame:
    """Search strings per variant: the hyphenated locus (weight 4) and the
    position (weight 2)."""
    locus = F.concat_ws("-", "chromosome", F.col("start").cast("string"), "reference", "alternate")
    pos = F.concat("chromosome", F.lit(":"), F.col("start").cast("string"))
    s = F.array(F.struct(locus.alias("text"), F.lit(4).alias("weight")),
                F.struct(pos.alias("text"), F.lit(2).alias("weight")))
    return variants.select(locus.alias("variant_id"), F.inline(s))


def document_hash(cols: Sequence[str]) -> Column:
    """Key hash used by the duplicate-document test. Each part goes in with its length before it, so no separator inside a
    value makes two keys alike; a NULL keeps its place as ``-``."""
    text = [F.col(c).cast("string") for c in cols]
    return F.sha1(F.concat(*[F.coalesce(F.concat(F.length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in text]))


def incremental_load(spark, path: str, new_rows: DataFrame, steps: str, key: str = "analysis_id",
                     buckets: int = BUCKETS) -> DataFrame:
    """``initial``: the new rows are the table. ``default``: replace the rows of the keys present in ``new_rows`` and keep
    every other row. The table is kept in buckets of the key; only buckets that hold one of these keys are read and
    written again (see ``BucketedTable``)."""
    table = BucketedTable(spark, path, key, buckets)
    if steps == "initial" or table.version() is None:
        table.create(new_rows)
    else:
        table.replace_keys(new_rows)
    return table.read()


# SURVEY §2.G names
normalize_clinical_resources = flatten_resources
enrich_snv_somatic = enrich_snv
sv_cluster = sv_clusters
load = incremental_load
