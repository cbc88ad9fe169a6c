"""Release bookkeeping over index-name and run-log tables.

Index names ``clin_{env}{color}_{index}_re_NNN`` are parsed with column
expressions; "current release per index" is a grouped max, never a driver
loop over names.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandline.operators._util import first_by

# Fixed values that must equal the reference's naming.
RELEASE_PREFIX = "re_"
RELEASE_DIGITS = 3
COLORS = ["blue", "green"]
FAILED_STATES = ["failed", "upstream_failed"]
FINISHED_STATES = ["success", "failed"]
NAME_PATTERN = r"^clin_([a-z]+?)(blue|green)?_(.+)_re_(\d+)$"


def parse_index_name(name: Column) -> dict[str, Column]:
    """env, color, index and release number of an index name."""
    return {
        "env": F.regexp_extract(name, NAME_PATTERN, 1),
        "color": F.nullif(F.regexp_extract(name, NAME_PATTERN, 2), F.lit("")),
        "index_type": F.regexp_extract(name, NAME_PATTERN, 3),
        "release_no": F.element_at(F.split(name, "_"), -1).cast("int"),
    }


def release_id(n: Column) -> Column:
    """``re_`` and the number with at least three digits; longer numbers stay whole."""
    digits = n.cast("string")
    return F.concat(F.lit(RELEASE_PREFIX), F.lpad(digits, F.greatest(F.lit(RELEASE_DIGITS), F.length(digits)), F.lit("0")))


def duplicate_documents(df: DataFrame, hash_col: str = "hash") -> DataFrame:
    """Whether any document hash occurs at least twice (one row): the number of
    duplicated hashes and the smallest one (the terms aggregation of size 1)."""
    d = df.groupBy(hash_col).agg(F.count("*").alias("n")).where("n >= 2")
    return d.agg(F.count("*").alias("n_duplicated"), F.min(hash_col).alias("first_duplicate")).select(
        (F.col("n_duplicated") > 0).alias("has_duplicates"), "n_duplicated", "first_duplicate")


def current_release(names: DataFrame, name_col: str = "index_name", by: Sequence[str] = ("color", "index_type")) -> DataFrame:
    """Per index (and color), the current release number and the next id."""
    p = parse_index_name(F.col(name_col))
    parsed = names.select(*[p[c].alias(c) for c in by], p["release_no"].alias("release_no"))
    cur = parsed.groupBy(*by).agg(F.max("release_no").alias("current_no"))
    return cur.select(*by, release_id(F.col("current_no")).alias("current_release"),
                      release_id(F.col("current_no") + 1).alias("next_release"))


def next_release(names: DataFrame, explicit: str | None = None, **kw) -> DataFrame:
    """Next release id per index; an explicitly given id wins."""
    cur = current_release(names, **kw)
    if explicit:
        return cur.withColumn("next_release", F.lit(explicit))
    return cur


def previous_release(release: Column, n: int = 2) -> tuple[Column, Column]:
    """(previous id, status): status ``ok``, ``invalid`` (no id that :func:`release_id` makes: three digits, or more without
    a leading zero) or ``none`` (would be below zero)."""
    valid = release.rlike(r"^re_(\d{3}|[1-9]\d{3,8})$")
    num = F.when(valid, F.substring(release, 4, 9).cast("int") - n)
    status = F.when(~valid, "invalid").when(num < 0, "none").otherwise("ok")
    prev = F.when(valid & (num >= 0), release_id(num))
    return prev, status


def retention_plan(names: DataFrame, n: int = 2, name_col: str = "index_name") -> DataFrame:
    """Index names to delete: per (color, index), the release ``current - n``."""
    p = parse_index_name(F.col(name_col))
    parsed = names.select(name_col, p["color"].alias("color"), p["index_type"].alias("index_type"),
                          p["release_no"].alias("release_no"))
    cur = parsed.groupBy("color", "index_type").agg(F.max("release_no").alias("current_no"))
    j = parsed.join(cur, [parsed["index_type"] == cur["index_type"], parsed["color"].eqNullSafe(cur["color"])])
    return j.where(F.col("release_no") == F.col("current_no") - n).select(name_col).distinct()


def active_color(index_name: Column) -> Column:
    """blue / green by substring of the aliased index (blue tested first)."""
    return F.when(index_name.contains("blue"), "blue").when(index_name.contains("green"), "green")


def swap_aliases(aliases: DataFrame, new: DataFrame) -> DataFrame:
    """Alias table after the swap: every alias in ``new`` is removed from its
    holder and given to the new index; other aliases are untouched."""
    keep = aliases.join(new.select("alias"), "alias", "left_anti")
    return keep.unionByName(new.select("alias", "index_name"))


def last_run_failures(runs: DataFrame, tasks: DataFrame, dag_id: str = "etl") -> DataFrame:
    """Failed / upstream-failed task ids of the latest finished run of ``dag_id``
    (latest by start time; a distributed top-1)."""
    finished = runs.where((F.col("dag_id") == dag_id) & F.col("state").isin(FINISHED_STATES))
    last = finished.orderBy(F.col("start_date").desc(), F.col("run_id").desc()).limit(1).select("run_id")
    bad = tasks.where(F.col("state").isin(FAILED_STATES)).join(last, "run_id", "left_semi")
    return bad.select("run_id", "task_id").distinct()


def conflicting_runs(runs: DataFrame, dag_ids: Sequence[str]) -> DataFrame:
    """Runs currently running among the given DAG ids."""
    return runs.where(F.col("dag_id").isin(list(dag_ids)) & (F.col("state") == "running"))


def trigger_gate(pending: DataFrame, runs: DataFrame, dag_ids: Sequence[str]) -> DataFrame:
    """One row: trigger only with pending ids and no conflicting run."""
    n_pending = pending.agg(F.count("*").alias("n")).select("n").scalar()
    n_conflicts = conflicting_runs(runs, dag_ids).agg(F.count("*").alias("n")).select("n").scalar()
    return runs.sparkSession.range(1).select(((n_pending > 0) & (n_conflicts == 0)).alias("trigger"))


def latest_by(df: DataFrame, key: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Latest row per key by ``order`` columns (descending)."""
    return first_by(df, key, order, descending=True)
