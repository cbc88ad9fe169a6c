"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.session import scratch_dir

#: A word: a run of anything but space and TAB, LF, VT, FF, CR.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def quoted(name: str) -> Column:
    """A column by its exact name, dots and spaces included."""
    return F.col("`" + name.replace("`", "``") + "`")


def packed(df: DataFrame, name: str = "_row") -> Column:
    """All columns of a row as one struct, so that helper columns never clash with the caller's."""
    return F.struct(*[quoted(c) for c in df.columns]).alias(name)


def unpacked(df: DataFrame, columns: list[str], name: str = "_row") -> DataFrame:
    return df.select(*[F.col(name).getField(c).alias(c) for c in columns])


def id_bucket(doc_id: Column, n: int) -> Column:
    """crc32 of the decimal id, modulo ``n`` (NULL ids hash as the empty string)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % n


def rewritten(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage with a table in the shared folder; later plans then know its true size."""
    path = scratch_dir(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Bytes of an Arrow batch handed to Python, about: tasks hold a batch, its results and copies of both.
BATCH_BYTES = 8 << 20


def bounded_batches(spark: SparkSession) -> None:
    """Lower the session's Arrow batch size where it is larger, so that long texts do not add up in the workers."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = re.fullmatch(r"(\d+)b?", spark.conf.get(key))
    if now is None or int(now[1]) > BATCH_BYTES:
        spark.conf.set(key, str(BATCH_BYTES))


def strings(column: pa.Array) -> Iterator[str | None]:
    """Values of an Arrow string column one at a time: a batch is never doubled in memory."""
    for value in column:
        yield value.as_py()


def bounded_sample(rows: DataFrame, limit: int, seed: int = 3) -> DataFrame:
    """About 0.9 * limit rows, all if there are fewer: those whose hash of id and text is lowest. The margin keeps
    the number under the limit; whoever collects the rows cuts at it."""
    n = rows.count()
    unit = F.xxhash64("doc_id", "text", F.lit(seed)).cast("double") / 2.0**64 + 0.5
    return rows.where(unit < 0.9 * limit / n) if n > 0.9 * limit else rows
