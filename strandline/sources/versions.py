"""Versioned Parquet tables in buckets of a key.

A table is a folder with ``data/version=<v>/bucket=<b>`` and, for each version, a small table ``_versions/<v>`` that says in
which version's folder each bucket is. A version counts once the ``_SUCCESS`` file of its listing is there; the listing is
written last, so readers see a version whole or not at all. Replacing keys reads and writes only the buckets these keys
fall into; all other buckets stay the files they are. There is one writer at a time. Old versions stay readable until
``vacuum``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.session import cut_lineage

BUCKETS = 64


class BucketedTable:
    def __init__(self, spark: SparkSession, path: str, key: str, buckets: int = BUCKETS):
        self.spark, self.path, self.key, self.buckets = spark, path.rstrip("/"), key, buckets
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.path).getFileSystem(spark._jsc.hadoopConfiguration())

    def _names(self, folder: str) -> list[str]:
        at = self._path(folder)
        return [s.getPath().getName() for s in self._fs.listStatus(at)] if self._fs.exists(at) else []

    def versions(self) -> list[int]:
        done = [n for n in self._names(f"{self.path}/_versions") if n.isdigit()
                and self._fs.exists(self._path(f"{self.path}/_versions/{n}/_SUCCESS"))]
        return sorted(int(n) for n in done)

    def version(self) -> int | None:
        return next(reversed(self.versions()), None)

    def folders(self, version: int) -> dict[int, int]:
        """Version of the folder that holds each bucket (at most ``buckets`` rows)."""
        rows = self.spark.read.schema("bucket int, version int").parquet(f"{self.path}/_versions/{version}").collect()
        return {r["bucket"]: r["version"] for r in rows}

    def _bucket(self):
        return F.pmod(F.xxhash64(F.col(self.key)), F.lit(self.buckets)).cast("int")

    def _write(self, rows: DataFrame, version: int, kept: dict[int, int]) -> None:
        # a rebalance splits a bucket that one key makes large into several files
        placed = rows.withColumn("bucket", self._bucket()).hint("rebalance", "bucket")
        out = f"{self.path}/data/version={version}"
        placed.write.mode("overwrite").partitionBy("bucket").parquet(out)
        new = {int(n.removeprefix("bucket=")): version for n in self._names(out) if n.startswith("bucket=")}
        listing = sorted((kept | new).items())
        self.spark.createDataFrame(listing, "bucket int, version int").coalesce(1).write.mode("overwrite").parquet(
            f"{self.path}/_versions/{version}")

    def create(self, rows: DataFrame) -> None:
        rows.limit(0).write.mode("overwrite").parquet(f"{self.path}/_schema")  # what a table without rows is read from
        self._write(rows, (self.version() or 0) + 1, {})

    def replace_keys(self, rows: DataFrame) -> None:
        """The rows of every key in ``rows`` become these; a NULL key is a key like any other."""
        rows = cut_lineage(rows)  # read three times
        now = self.version()
        held = self.folders(now)
        touched = {r["bucket"] for r in rows.select(self._bucket().alias("bucket")).distinct().collect()}
        old = self._read(now, {b: v for b, v in held.items() if b in touched})
        names = rows.select(F.col(self.key).alias("_key")).distinct()
        if old is not None:
            kept = old.join(names, F.col(self.key).eqNullSafe(F.col("_key")), "left_anti")
            rows = kept.unionByName(rows)
        self._write(rows, now + 1, {b: v for b, v in held.items() if b not in touched})

    def _read(self, version: int, folders: dict[int, int]) -> DataFrame | None:
        if not folders:
            return None
        paths = [f"{self.path}/data/version={v}/bucket={b}" for b, v in sorted(folders.items())]
        return self.spark.read.parquet(*paths)

    def read(self, version: int | None = None) -> DataFrame:
        """The table as of a version (the last by default)."""
        version = self.version() if version is None else version
        if version is None:
            raise FileNotFoundError(f"{self.path} has no version")
        rows = self._read(version, self.folders(version))
        return self.spark.read.parquet(f"{self.path}/_schema") if rows is None else rows

    def vacuum(self, keep: int = 2) -> None:
        """Delete versions before the last ``keep``, and the bucket folders that only these use."""
        versions = self.versions()
        old, live = versions[:-keep], versions[-keep:]
        used = {(v, b) for k in live for b, v in self.folders(k).items()}
        for k in old:
            for b in {b for b, v in self.folders(k).items() if v == k and (v, b) not in used}:
                self._fs.delete(self._path(f"{self.path}/data/version={k}/bucket={b}"), True)
            self._fs.delete(self._path(f"{self.path}/_versions/{k}"), True)
