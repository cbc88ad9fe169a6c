"""Tables that micro-batches write: one folder a batch, compacted into base versions.

A sink writes each micro-batch to ``path/batch_id=<id>`` (a replayed batch replaces its own folder). Every so many
batches the folders before the running one, which the stream's checkpoint will not replay any more, are folded with the
last base into a new one, ``path/_base/upto=<id>``. A base counts once Spark's writer has put its ``_SUCCESS`` file there,
which is the atomic pointer: readers take the highest such base and the folders after it, so what they read depends
on the number of keys and not on how many batches ever ran. Folders that the base before already held are deleted, so
a reader that started on that one still finds its files.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Batches between two compactions.
EVERY = 8

Fold = Callable[[DataFrame], DataFrame]


def newest(key: Sequence[str]) -> Fold:
    """Fold of update-mode rows: the rows of the last batch that touched a key."""
    def fold(rows: DataFrame) -> DataFrame:
        others = [c for c in rows.columns if c not in key and c != "batch_id"]
        last = rows.groupBy(*key).agg(F.max(F.struct("batch_id", *others)).alias("_last"))
        return last.select(*key, *[F.col(f"_last.{c}").alias(c) for c in others], F.col("_last.batch_id").alias("batch_id"))
    return fold


def summed(key: Sequence[str]) -> Fold:
    """Fold of differences: their sums a key."""
    def fold(rows: DataFrame) -> DataFrame:
        others = [c for c in rows.columns if c not in key and c != "batch_id"]
        return rows.groupBy(*key).agg(*[F.sum(c).alias(c) for c in others], F.max("batch_id").alias("batch_id"))
    return fold


class BatchTable:
    def __init__(self, spark: SparkSession, path: str, fold: Fold | None = None, every: int = EVERY):
        self.spark, self.path, self.fold, self.every = spark, path.rstrip("/"), fold, every
        jvm = spark._jvm.org.apache.hadoop.fs
        self._at = lambda p: jvm.Path(p)
        self._fs = jvm.Path(self.path).getFileSystem(spark._jsc.hadoopConfiguration())

    def _numbers(self, folder: str, prefix: str, done: str | None = None) -> list[int]:
        """Numbers of the sub-folders ``prefix<number>``, only of those holding the file ``done`` if one is named."""
        if not self._fs.exists(self._at(folder)):
            return []
        names = [s.getPath().getName() for s in self._fs.listStatus(self._at(folder))]
        found = [int(n.removeprefix(prefix)) for n in names if n.startswith(prefix) and n.removeprefix(prefix).isdigit()]
        return sorted(n for n in found if done is None or self._fs.exists(self._at(f"{folder}/{prefix}{n}/{done}")))

    def bases(self) -> list[int]:
        return self._numbers(f"{self.path}/_base", "upto=", "_SUCCESS")

    def batches(self) -> list[int]:
        return self._numbers(self.path, "batch_id=", "_SUCCESS")

    def _parts(self, upto: int | None = None) -> tuple[DataFrame | None, list[int]]:
        """The last base and the batches after it (up to ``upto``) as one table with ``batch_id``; None if there is none."""
        base = self.bases()[-1:]
        new = [b for b in self.batches() if b > (base[0] if base else -1) and (upto is None or b <= upto)]
        parts = [self.spark.read.parquet(f"{self.path}/_base/upto={base[0]}")] if base else []
        if new:
            folders = [f"{self.path}/batch_id={b}" for b in new]
            parts.append(self.spark.read.option("basePath", self.path).parquet(*folders)
                         .withColumn("batch_id", F.col("batch_id").cast("long")))
        if len(parts) == 2:
            return parts[0].unionByName(parts[1]), new
        return (parts[0] if parts else None), new

    def write(self, batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{self.path}/batch_id={batch_id}")
        if self.fold is not None:
            self.compact(batch_id - 1)

    def compact(self, upto: int, least: int | None = None) -> None:
        """Fold the batches up to ``upto`` into a new base if there are at least ``least`` (by default ``every``)."""
        rows, new = self._parts(upto)
        if rows is None or self.fold is None or len(new) < (self.every if least is None else least):
            return
        before = self.bases()
        self.fold(rows).write.mode("overwrite").parquet(f"{self.path}/_base/upto={new[-1]}")
        for b in self.batches():
            if before and b <= before[-1]:
                self._fs.delete(self._at(f"{self.path}/batch_id={b}"), True)
        for old in before[:-1]:
            self._fs.delete(self._at(f"{self.path}/_base/upto={old}"), True)

    def read(self) -> DataFrame:
        """All rows; folded, with a fold."""
        rows, _ = self._parts()
        if rows is None:
            raise FileNotFoundError(f"no batch has been written to {self.path}")
        return rows if self.fold is None else self.fold(rows)
