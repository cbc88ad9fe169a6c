"""The catalogue of table checks (22 blocking, 42 reported), as data, and the suites built from it.

Tables are given by name; a suite reads each as often as it has checks of
different kinds on it, so callers pass written tables, not plans. Column checks
of a table and of its nested blocks are answered by the profile that was observed
while it was written; of a table without one, by one aggregate for each block.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.operators import quality as qa
from strandline.operators.variants import MIN_AD_ALT, VARIANT_KEY, qualifies

# Check names, the tables they look at, and the keys that must be unique.
CONSEQUENCE_KEY = [*VARIANT_KEY, "symbol", "transcript"]
NO_DUPLICATES: dict[str, tuple[str, list[str]]] = {
    "no_dup_gnomad_joint": ("gnomad_joint", VARIANT_KEY),
    "no_dup_clinical": ("clinical", ["analysis_id", "sequencing_id", "bioinfo_analysis_code"]),
    "no_dup_nor_snv": ("normalized_snv", [*VARIANT_KEY, "sequencing_id"]),
    "no_dup_nor_snv_somatic": ("normalized_snv_somatic", [*VARIANT_KEY, "sequencing_id"]),
    "no_dup_nor_consequences": ("normalized_consequences", CONSEQUENCE_KEY),
    "no_dup_nor_variants": ("normalized_variants", [*VARIANT_KEY, "batch_id"]),
    "no_dup_snv": ("snv", [*VARIANT_KEY, "sequencing_id"]),
    "no_dup_snv_somatic": ("snv_somatic", [*VARIANT_KEY, "sequencing_id"]),
    "no_dup_consequences": ("consequences", CONSEQUENCE_KEY),
    "no_dup_variants": ("variants", VARIANT_KEY),
    "no_dup_variant_centric": ("variant_centric", VARIANT_KEY),
    "no_dup_cnv_centric": ("cnv_centric", ["cnv_id"]),
    "no_dup_coverage_by_gene": ("coverage_by_gene", ["symbol", "sample_id"]),
    "no_dup_nextflow_svclustering_germline": ("nextflow_svclustering_germline", ["cluster_id"]),
    "no_dup_nextflow_svclustering_somatic": ("nextflow_svclustering_somatic", ["cluster_id"]),
    "no_dup_nextflow_svclustering_parental_origin": ("nextflow_svclustering_parental_origin", ["cnv_id", "sequencing_id"]),
}
#: Variants of the left table that count (ad_alt) are in the right one.
INCLUDED: dict[str, tuple[str, str]] = {
    "same_list_nor_snv_nor_variants": ("normalized_snv", "normalized_variants"),
    "same_list_nor_snv_somatic_nor_variants": ("normalized_snv_somatic", "normalized_variants"),
    "same_list_snv_variants": ("snv", "variants"),
    "same_list_snv_somatic_variants": ("snv_somatic", "variants"),
}
SAME_SET: dict[str, tuple[str, str]] = {"same_list_variants_variant_centric": ("variants", "variant_centric")}

#: Blocks of the documents: check suffix -> (table, nested columns whose fields are looked at; none: the table itself).
BLOCKS: dict[str, tuple[str, tuple[str, ...]]] = {
    "variant_centric": ("variant_centric", ()),
    "variant_centric_cmc": ("variant_centric", ("cmc",)),
    "variant_centric_clinvar": ("variant_centric", ("clinvar",)),
    "variant_centric_consequences": ("variant_centric", ("consequences",)),
    "variant_centric_donors": ("variant_donors", ()),
    "variant_centric_exomax": ("variant_centric", ("exomiser_max",)),
    "variant_centric_extfreq": ("variant_centric", ("external_frequencies",)),
    "variant_centric_framax": ("variant_centric", ("franklin_max",)),
    "variant_centric_freqbyanal": ("variant_centric", ("frequencies_by_analysis",)),
    "variant_centric_freqrqdm": ("variant_centric", ("frequency_RQDM",)),
    "variant_centric_freqrqdmtumor": ("variant_centric", ("freq_rqdm_tumor_only", "freq_rqdm_tumor_normal")),
    "gene_centric": ("gene_centric", ()),
    "cnv_centric": ("cnv_centric", ()),
    "coverage_by_gene": ("coverage_by_gene", ()),
}
NO_NULL = ("variant_centric", "variant_centric_donors", "variant_centric_freqbyanal", "variant_centric_freqrqdm",
           "gene_centric", "cnv_centric", "coverage_by_gene")
DICTIONARIES = {"dictionary_cnv": ("cnv_centric", None), "dictionary_consequences": ("variant_centric", "consequences"),
                "dictionary_donors": ("variant_donors", None), "dictionary_snv": ("variant_centric", None)}


def _block(tables: dict[str, DataFrame], name: str) -> DataFrame:
    table, paths = BLOCKS[name]
    if not paths:
        return tables[table]
    return qa.nested(tables[table], paths[0]) if len(paths) == 1 else tables[table].select(*[f"{p}.*" for p in paths])


def qa_suite(tables: dict[str, DataFrame], must_have_rows: Sequence[str]) -> DataFrame:
    """The 22 blocking checks: (check_name, table_name, severity, n_violations)."""
    c = qa.CRITICAL
    checks = [qa.Check("non_empty_tables", "all", c, lambda: qa.non_empty({t: tables[t] for t in must_have_rows}))]
    checks += [qa.Check(name, t, c, lambda t=t, key=key: qa.no_duplicates(tables[t], key))
               for name, (t, key) in NO_DUPLICATES.items()]
    checks += [qa.Check(name, right, c, lambda left=left, right=right: qa.included_in(
        tables[left], tables[right], VARIANT_KEY, F.col("ad_alt") >= MIN_AD_ALT)) for name, (left, right) in INCLUDED.items()]
    checks += [qa.Check(name, right, c, lambda left=left, right=right: qa.same_set(
        tables[left], tables[right], VARIANT_KEY)) for name, (left, right) in SAME_SET.items()]
    return qa.run_suite(checks)


def qc_suite(tables: dict[str, DataFrame], no_null: dict[str, Sequence[str]], dictionaries: dict[str, dict[str, Sequence[str]]],
             not_only_null: dict[str, Sequence[str]] | None = None, not_same_value: dict[str, Sequence[str]] | None = None,
             profiles: dict[str, qa.Profile] | None = None) -> DataFrame:
    """The 42 reported checks. ``no_null`` white-lists columns, ``not_only_null`` and ``not_same_value`` black-list
    them, by block name (``BLOCKS``); ``dictionaries`` gives the values of each column by check name."""
    w = qa.NON_CRITICAL
    occ, freqs = tables["occurrences"], tables["frequencies"]
    checks = [
        qa.Check("filters_snv", "normalized_snv", w, lambda: qa.row_filter(tables["normalized_snv"], "alternate <> '*'")),
        qa.Check("filters_frequency_extra", "normalized_variants", w,
                 lambda: qa.should_not_have(freqs, occ, VARIANT_KEY, qualifies(occ))),
        qa.Check("filters_frequency_missed", "normalized_variants", w,
                 lambda: qa.should_have(freqs, occ, VARIANT_KEY, qualifies(occ))),
    ]
    for name, (table, path) in DICTIONARIES.items():
        checks.append(qa.Check(name, table, w, lambda name=name, table=table, path=path: qa.in_dictionary(
            qa.nested(tables[table], path) if path else tables[table], dictionaries[name])))
    out = qa.run_suite(checks)
    seen = []
    for block, (table, paths) in BLOCKS.items():
        profile = (profiles or {}).get(table)
        df = None if profile else _block(tables, block)
        names = profile.columns(paths or ("",)) if profile else df.columns
        columns = {f"only_null_{block}": ("only_null", _without(names, not_only_null, block)),
                   f"same_value_{block}": ("same_value", _without(names, not_same_value, block))}
        if block in NO_NULL:
            columns[f"no_null_{block}"] = ("no_null", list(no_null[block]))
        if profile:
            seen += [(name, table, w, profile.violations(kind, paths or ("",), cols)) for name, (kind, cols) in columns.items()]
        else:
            out = out.unionByName(qa.column_checks(df, columns).select(
                "check_name", F.lit(table).alias("table_name"), F.lit(w).alias("severity"), "n_violations"))
    if seen:
        out = out.unionByName(occ.sparkSession.createDataFrame(seen, out.schema))
    return out


def _without(names: Sequence[str], excluded: dict[str, Sequence[str]] | None, block: str) -> list[str]:
    return [c for c in names if c not in (excluded or {}).get(block, ())]
