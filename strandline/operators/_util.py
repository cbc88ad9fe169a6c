"""Small helpers shared by the operator modules."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strandline.session import cut_lineage


def as_ids(spark: SparkSession, ids: DataFrame | Iterable[str] | None, name: str = "id") -> DataFrame:
    """Requested identifiers as a one-column DataFrame (semi-join input).

    A DataFrame is used as-is (first column); a Python iterable is a user's
    literal request list; ``None`` means "nothing requested".
    """
    if isinstance(ids, DataFrame):
        return ids.select(F.col(ids.columns[0]).cast("string").alias(name))
    values = [] if ids is None else [str(i) for i in ids]
    schema = T.StructType([T.StructField(name, T.StringType(), True)])
    return spark.createDataFrame([(v,) for v in values], schema)


def literal_map(mapping: dict[str, str]) -> Column:
    """A constant map column: lookups stay inside codegen, no join needed."""
    items: list[Column] = []
    for k, v in mapping.items():
        items += [F.lit(k), F.lit(v)]
    return F.create_map(*items)


def empty_is_null(c: Column) -> Column:
    """pandas-style "missing": NULL array and empty array both count."""
    return F.coalesce(F.size(c), F.lit(0)) <= 0


def global_row_number(df: DataFrame, order: Sequence[Column | str], name: str = "rn",
                      partitions: int | None = None) -> DataFrame:
    """Dense 1-based numbering in a total order without a single-partition window.

    Rows are range-partitioned and sorted on the order keys; partition and row
    number are the two halves of the monotonic id, so the range shuffle is the
    only exchange. The sorted partitions are written out once (the range bounds
    are sampled per evaluation, so counts and rows must come from one); the
    running count of all earlier partitions is one small row a partition.
    Callers must give a total order (unique keys) for stable ids.
    """
    order_cols = [F.col(c) if isinstance(c, str) else c for c in order]
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = cut_lineage(df.repartitionByRange(n, *order_cols).sortWithinPartitions(*order_cols)
                         .withColumn("_place", F.monotonically_increasing_id()))
    part, row = F.shiftright("_place", 33), F.col("_place").bitwiseAND(F.lit((1 << 33) - 1))
    counts = placed.groupBy(part.alias("_pid")).agg((F.max(row) + 1).alias("_cnt"))
    before = F.sum("_cnt").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select(F.col("_pid"), F.coalesce(before, F.lit(0)).alias("_off"))
    return placed.join(F.broadcast(offsets), part == F.col("_pid")).withColumn(name, F.col("_off") + row + 1) \
        .drop("_place", "_pid", "_off")


def strict(df: DataFrame, bad: Column, message: Column) -> DataFrame:
    """Raise on the first row where ``bad`` holds; the column is consumed so
    Catalyst cannot prune the check."""
    return df.where(F.when(bad, F.raise_error(message)).otherwise(F.lit(True)))


def first_by(df: DataFrame, key: Sequence[str], order: Sequence[Column], descending: bool = False) -> DataFrame:
    """One row per ``key``: the smallest (or largest) by ``order``, ties broken by
    the remaining columns. A ``min``/``max`` of a struct is an aggregate with
    map-side partial aggregation, so a key holding a large share of the rows is
    combined before the shuffle instead of being sorted inside one task."""
    key = list(key)
    rest = [c for c in df.columns if c not in key]
    names = [f"_o{i}" for i in range(len(order))]
    packed = F.struct(*[o.alias(n) for o, n in zip(order, names)], *[F.col(c) for c in rest])
    agg = F.max(packed) if descending else F.min(packed)
    return df.groupBy(*key).agg(agg.alias("_first")).select(*key, *[F.col(f"_first.{c}").alias(c) for c in rest]) \
        .select(*df.columns)
