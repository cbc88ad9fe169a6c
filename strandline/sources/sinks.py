"""Sinks: sample sheets (headered CSV), JSON documents, partitioned Parquet."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_manifest(df: DataFrame, path: str) -> str:
    """Headered CSV sample sheet, no index column (one folder of part files)."""
    df.write.mode("overwrite").option("header", True).csv(path)
    return path


def read_manifest(spark, path: str, schema: str | None = None) -> DataFrame:
    r = spark.read.option("header", True)
    if schema:
        r = r.schema(schema)
    return r.csv(path)


def write_documents(df: DataFrame, path: str, release_col: str = "release") -> str:
    """One JSON document per row, partitioned by release."""
    df.write.mode("overwrite").partitionBy(release_col).json(path)
    return path


def overwrite_partitions(df: DataFrame, path: str, partition_col: str = "chromosome") -> str:
    """Replace only the partitions present in ``df`` (dynamic overwrite)."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(partition_col).parquet(path))
    return path
