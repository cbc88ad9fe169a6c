"""Table-level data-quality checks. Each check returns a violations DataFrame.

Column profiles (nulls, all-null, constant) are observed while a table is
written, or computed in ONE aggregate pass over it for all checked columns,
then unpivoted, instead of one job per column.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

CRITICAL = "critical"      # QA: blocks the run
NON_CRITICAL = "warning"   # QC: reported only


def non_empty(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per empty table (each table is probed with LIMIT 1)."""
    probes = [df.limit(1).agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("table_name"), "n")
              for name, df in tables.items()]
    out = probes[0]
    for p in probes[1:]:
        out = out.unionByName(p)
    return out.where("n = 0").select("table_name")


def no_duplicates(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return df.groupBy(*key).agg(F.count("*").alias("n_rows")).where("n_rows > 1")


def included_in(left: DataFrame, right: DataFrame, key: Sequence[str], where: Column | str | None = None) -> DataFrame:
    """Distinct ``left`` keys (optionally filtered) missing from ``right``."""
    l = left.where(where) if where is not None else left
    # both sides as distinct keys: fewer rows to deal, and both directions of ``same_set`` share them
    return l.select(*key).distinct().join(right.select(*key).distinct(), list(key), "left_anti")


def same_set(a: DataFrame, b: DataFrame, key: Sequence[str]) -> DataFrame:
    """Key differences in both directions, tagged with the side they are on."""
    return (included_in(a, b, key).withColumn("side", F.lit("left_only"))
            .unionByName(included_in(b, a, key).withColumn("side", F.lit("right_only"))))


def row_filter(df: DataFrame, predicate: Column | str) -> DataFrame:
    """Rows for which the expected predicate does not hold (NULL = violation)."""
    p = F.expr(predicate) if isinstance(predicate, str) else predicate
    return df.where(~F.coalesce(p, F.lit(False)))


def should_not_have(derived: DataFrame, base: DataFrame, key: Sequence[str], qualifies: Column) -> DataFrame:
    """Extra: keys present in ``derived`` although no ``base`` row qualifies."""
    flags = base.groupBy(*key).agg(F.bool_or(qualifies).alias("_q"))
    return (derived.select(*key).distinct().join(flags, list(key), "left")
            .where(~F.coalesce(F.col("_q"), F.lit(False))).drop("_q"))


def should_have(derived: DataFrame, base: DataFrame, key: Sequence[str], qualifies: Column) -> DataFrame:
    """Missed: keys with a qualifying ``base`` row but absent from ``derived``."""
    q = base.where(qualifies).select(*key).distinct()
    return q.join(derived.select(*key), list(key), "left_anti")


def _profile_columns(df: DataFrame, columns: Iterable[str] | None, exclude: Iterable[str] = ()) -> list[str]:
    cols = list(columns) if columns is not None else list(df.columns)
    ex = set(exclude)
    return [c for c in cols if c not in ex]


def _unpivot(row_df: DataFrame, names: list[str], value: str) -> DataFrame:
    return row_df.unpivot([], names, "column_name", value)


def no_null(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """White-listed columns that contain NULLs, with the NULL count (one pass)."""
    cols = _profile_columns(df, columns)
    agg = df.agg(*[F.count(F.when(F.col(f"`{c}`").isNull(), 1)).alias(c) for c in cols])
    return _unpivot(agg, cols, "n_null").where("n_null > 0")


def only_null(df: DataFrame, exclude: Iterable[str] = ()) -> DataFrame:
    """Columns (black-list excluded) that are NULL on every row (one pass)."""
    cols = _profile_columns(df, None, exclude)
    agg = df.agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in cols])
    return _unpivot(agg, cols, "n_values").where("n_values = 0").select("column_name")


def _comparable(df: DataFrame, c: str) -> Column:
    dt = df.schema[c].dataType
    if isinstance(dt, (T.MapType, T.StructType, T.ArrayType)):
        return F.to_json(F.col(f"`{c}`"))
    return F.col(f"`{c}`")


def same_value(df: DataFrame, exclude: Iterable[str] = ()) -> DataFrame:
    """Columns holding one single non-NULL value on every non-NULL row
    (min = max, NULLs ignored; exact, one pass)."""
    cols = _profile_columns(df, None, exclude)
    exprs = []
    for c in cols:
        v = _comparable(df, c)
        exprs.append(((F.min(v) == F.max(v)) & (F.count(v) > 0)).alias(c))
    agg = df.agg(*exprs)
    return _unpivot(agg, cols, "single").where("single").select("column_name")


def other_columns(df: DataFrame, exclude: Iterable[str]) -> list[str]:
    """Columns but those on the black list."""
    return _profile_columns(df, None, exclude)


def column_checks(df: DataFrame, checks: dict[str, tuple[str, Sequence[str]]]) -> DataFrame:
    """(check_name, n_violations) of several column checks by one aggregate over the table: name -> (``no_null``,
    ``only_null`` or ``same_value``, columns); n_violations counts columns, as the single checks do."""
    used = list(dict.fromkeys(c for _, columns in checks.values() for c in columns))
    at = {c: i for i, c in enumerate(used)}
    valued = {c for kind, columns in checks.values() if kind == "same_value" for c in columns}
    aggs = [F.count(F.lit(1)).alias("_rows")]
    for c, i in at.items():
        aggs.append(F.count(F.col(f"`{c}`")).alias(f"_n{i}"))
        if c in valued:
            v = _comparable(df, c)
            aggs.append(F.coalesce(F.min(v) == F.max(v), F.lit(False)).alias(f"_s{i}"))
    bad = {"no_null": lambda i: F.col(f"_n{i}") < F.col("_rows"), "only_null": lambda i: F.col(f"_n{i}") == 0,
           "same_value": lambda i: F.col(f"_s{i}")}
    rows = [F.struct(F.lit(name).alias("check_name"), sum((bad[kind](at[c]).cast("bigint") for c in columns),
                                                          F.lit(0).cast("bigint")).alias("n_violations"))
            for name, (kind, columns) in checks.items()]
    return df.agg(*aggs).select(F.inline(F.array(*rows)))


class Profile:
    """Counts of the columns of a table, and of the fields of its structs and arrays of structs, observed while it was
    written: per block (the table itself is ``""``) and column the rows, the values that are not NULL, and whether all are
    one value."""

    def __init__(self, metrics: dict[tuple[str, str], tuple[int, int, bool]]):
        self.metrics = metrics

    def columns(self, blocks: Sequence[str]) -> list[str]:
        return [c for b, c in self.metrics if b in blocks]

    def violations(self, kind: str, blocks: Sequence[str], columns: Sequence[str]) -> int:
        """Columns of the blocks that fail a ``no_null``, ``only_null`` or ``same_value`` check."""
        found = [m for (b, c), m in self.metrics.items() if b in blocks and c in columns]
        bad = {"no_null": lambda m: m[1] < m[0], "only_null": lambda m: m[1] == 0, "same_value": lambda m: m[2]}[kind]
        return sum(map(bad, found))


def _observed(schema: T.StructType) -> dict[tuple[str, str], tuple[Column, Column, Column, Column]]:
    """Aggregates of each column and nested field: rows, values, least and greatest."""
    out = {}
    for f in schema.fields:
        c = F.col(f"`{f.name}`")
        v = _ordered(c, f.dataType)
        out["", f.name] = F.count(F.lit(1)), F.count(c), F.min(v), F.max(v)
        inner = f.dataType.elementType if isinstance(f.dataType, T.ArrayType) else f.dataType
        if not isinstance(inner, T.StructType):
            continue
        for g in inner.fields:
            if inner is f.dataType:
                x = c.getField(g.name)
                y = _ordered(x, g.dataType)
                out[f.name, g.name] = F.count(F.lit(1)), F.count(x), F.min(y), F.max(y)
            else:
                there, values = _elements(c, g)
                n = [F.sum(F.coalesce(F.greatest(F.size(a), F.lit(0)), F.lit(0)).cast("bigint")) for a in (c, there)]
                out[f.name, g.name] = *n, F.min(F.array_min(values)), F.max(F.array_max(values))
    return out


def _elements(array: Column, field: T.StructField) -> tuple[Column, Column]:
    """The elements of an array of structs that have a value in the field, and these values."""
    there = F.filter(array, lambda e: e.getField(field.name).isNotNull())
    return there, F.transform(there, lambda e: _ordered(e.getField(field.name), field.dataType))


def _ordered(c: Column, kind: T.DataType) -> Column:
    """The value as something that can be compared: complex ones by their JSON text."""
    return F.to_json(c) if isinstance(kind, (T.ArrayType, T.StructType, T.MapType)) else c


def write_profiled(df: DataFrame, path: str) -> tuple[DataFrame, Profile]:
    """Write a table and observe its profile on the way: the checks of single columns need no scan of their own."""
    spark, wanted = df.sparkSession, _observed(df.schema)
    parts = [F.struct(n.alias("rows"), m.alias("values"), F.coalesce(lo == hi, F.lit(False)).alias("one")).alias(f"m{i}")
             for i, (n, m, lo, hi) in enumerate(wanted.values())]
    observation = Observation()
    df.observe(observation, *parts).write.mode("overwrite").parquet(path)
    got = observation.get
    metrics = {key: (got[f"m{i}"]["rows"] or 0, got[f"m{i}"]["values"] or 0, got[f"m{i}"]["one"]) for i, key in enumerate(wanted)}
    return spark.read.schema(df.schema).parquet(path), Profile(metrics)


def nested(df: DataFrame, path: str) -> DataFrame:
    """Position the checks inside a nested column: arrays are exploded, struct
    fields become top-level columns."""
    out = df
    for part in path.split("."):
        dt = out.schema[part].dataType
        if isinstance(dt, T.ArrayType):
            out = out.select(F.explode(F.col(part)).alias(part))
            dt = dt.elementType
        else:
            out = out.select(part)
        if isinstance(dt, T.StructType):
            out = out.select(f"{part}.*")
    return out


def in_dictionary(df: DataFrame, dictionaries: dict[str, Sequence[str]]) -> DataFrame:
    """Values outside their column's dictionary: (column, value, n_rows).
    Array columns are checked element by element. Dictionaries are literal
    (bounded) lists, checked inside the expression, so nothing is joined."""
    parts = []
    for c, values in dictionaries.items():
        dt = df.schema[c].dataType
        col = F.explode(F.col(c)) if isinstance(dt, T.ArrayType) else F.col(c)
        v = df.select(col.cast("string").alias("value"))
        bad = v.where(F.col("value").isNotNull() & ~F.col("value").isin(list(values)))
        parts.append(bad.groupBy("value").agg(F.count("*").alias("n_rows")).select(
            F.lit(c).alias("column_name"), "value", "n_rows"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@dataclass
class Check:
    name: str
    table: str
    severity: str
    run: Callable[[], DataFrame]
    tags: dict = field(default_factory=dict)


def run_suite(checks: Sequence[Check]) -> DataFrame:
    """All checks as one DataFrame: (check_name, table_name, severity, n_violations)."""
    parts = [c.run().agg(F.count(F.lit(1)).alias("n_violations"))
             .select(F.lit(c.name).alias("check_name"), F.lit(c.table).alias("table_name"),
                     F.lit(c.severity).alias("severity"), "n_violations") for c in checks]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
