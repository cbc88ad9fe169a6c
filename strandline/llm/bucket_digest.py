"""Document fingerprints: a quartile bucket digest of hashed byte triplets.

Every three adjacent bytes of a text are hashed into one of 256 buckets. The
digest holds, in hex, a length code (its logarithm), and for each bucket the
quartile of its count among all buckets (two bits). The difference of two
digests is the sum of bucket code distances (a jump over all four quartiles
counts double) and of the length distance, each bounded; likeness is 1 minus
its share of the largest possible difference.

Defined results: NULL is the empty text. Texts of under three bytes have no
triplet: all buckets are 0 and only the length code differs. Equal texts have
equal digests. Rows are ordered by doc_id, NULL first, rows of equal id by the
hash of their text and then the text; the last row is followed by the first, a
single row by itself. Extra columns are ignored. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strandline.llm.common import bounded_batches, rewritten

BUCKETS = 256
#: Weight of the length code's distance, and its bound.
LENGTH_WEIGHT, LENGTH_BOUND = 4, 64
#: Cost of a distance between two bucket codes.
CODE_COST = np.array([0, 1, 2, 6], dtype=np.int64)
LARGEST = int(CODE_COST[3]) * BUCKETS + LENGTH_BOUND
#: Bytes of a text that are hashed at once.
BLOCK = 1 << 20


def _mixer() -> np.ndarray:
    """A fixed permutation of the byte values, shuffled by a linear congruential rule."""
    out, x = np.arange(256, dtype=np.uint8), 1
    for i in range(255, 0, -1):
        x = (x * 1103515245 + 12345) & 0x7FFFFFFF
        j = (x >> 8) % (i + 1)
        out[i], out[j] = out[j], out[i]
    return out


_MIX = _mixer()


def triplet_counts(data: bytes) -> np.ndarray:
    counts = np.zeros(BUCKETS, dtype=np.int64)
    for at in range(0, max(0, len(data) - 2), BLOCK):
        b = np.frombuffer(data, dtype=np.uint8, offset=at, count=min(BLOCK + 2, len(data) - at))
        counts += np.bincount(_MIX[_MIX[_MIX[b[:-2]] ^ b[1:-1]] ^ b[2:]], minlength=BUCKETS)
    return counts


def digest(data: bytes) -> str:
    counts = triplet_counts(data)
    ranked = np.sort(counts)
    q1, q2, q3 = ranked[BUCKETS // 4 - 1], ranked[BUCKETS // 2 - 1], ranked[3 * BUCKETS // 4 - 1]
    codes = (counts > q1).astype(np.uint8) + (counts > q2) + (counts > q3)
    four = codes.reshape(-1, 4)
    body = (four[:, 0] | four[:, 1] << 2 | four[:, 2] << 4 | four[:, 3] << 6).astype(np.uint8)
    size = min(255, round(8 * float(np.log2(1 + len(data)))))
    return f"{size:02x}" + body.tobytes().hex()


def difference(a: str, b: str) -> int:
    """The bounded difference score of two digests, 0 to ``LARGEST``."""
    x, y = bytes.fromhex(a), bytes.fromhex(b)
    p, q = np.frombuffer(x, np.uint8, offset=1), np.frombuffer(y, np.uint8, offset=1)
    total = 0
    for shift in (0, 2, 4, 6):
        total += int(CODE_COST[np.abs((p >> shift & 3).astype(np.int64) - (q >> shift & 3))].sum())
    return total + min(LENGTH_BOUND, LENGTH_WEIGHT * abs(x[0] - y[0]))


def likeness(a: str, b: str) -> float:
    return 1.0 - difference(a, b) / LARGEST


# ---- Spark ----------------------------------------------------------------

def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fingerprint) of every whole text; no shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [digest((t.as_py() or "").encode("utf-8")) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.string())], names=["id", "fingerprint"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string")).mapInArrow(
        run, f"id {kind}, fingerprint string")


def edited_text(text: str, following: str) -> str:
    """The last floor(n/2) code points replaced by the first as many of the following text."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def _ranges(ids: DataFrame, n: int) -> list[int]:
    """At most n - 1 bounds that deal the ids out evenly; bounded by n, whatever the table's size."""
    row = ids.agg(F.percentile_approx("doc_id", [i / n for i in range(1, n)], 10_000).alias("b")).first()
    return sorted(set(row["b"] or []))


def edit_report(docs: DataFrame, ranges: int | None = None) -> DataFrame:
    """Contract columns of op6.

    Each document needs the next one's text. Rows are dealt out by fixed ranges of
    doc_id and sorted in them, so the next document is the next row of the stream.
    A range's first rows are found by a semi-join on its smallest id and sent to the
    range before as well; only those travel twice. Texts travel compressed.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    n = ranges or 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    bounds = _ranges(docs.select("doc_id"), n)
    # the range of an id, by bisection over the bounds: a balanced tree of comparisons
    def locate(lo: int, hi: int):
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(F.col("doc_id") > bounds[mid], locate(mid + 1, hi)).otherwise(locate(lo, mid))

    part = locate(0, len(bounds)) if len(bounds) <= 64 else F.size(
        F.filter(F.lit(bounds).cast("array<bigint>"), lambda b: b < F.col("doc_id")))
    part = F.when(F.col("doc_id").isNull(), F.lit(-1)).otherwise(part).cast("int")
    tie = F.xxhash64("text")
    # the first row of each range in use, and the range before it (the last, for the first)
    used = docs.select(part.alias("part"), "doc_id", tie.alias("tie")).groupBy("part") \
        .agg(F.min(F.struct("doc_id", "tie")).alias("first"))
    order = Window.orderBy("part")  # one row a range
    before = F.lag("part").over(order)
    heads = rewritten(used.select(
        F.coalesce(before, F.max("part").over(Window.partitionBy(F.lit(0)))).alias("to"), before.isNull().alias("wraps"),
        F.col("first.doc_id").alias("doc_id"), F.col("first.tie").alias("tie")), "digest-heads")

    def squeeze(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            texts, sums, sizes = [], [], []
            for text in batch.column(3):
                data = text.as_py().encode("utf-8")
                texts.append(pack.compress(data))
                sums.append(digest(data))
                sizes.append(len(text.as_py()))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(sizes, pa.int64()), pa.array(sums, pa.string()),
                 pa.array(texts, pa.binary())], names=["part", "doc_id", "tie", "n_chars", "fingerprint", "z"])

    slim = docs.select(part.alias("part"), "doc_id", tie.alias("tie"), "text").mapInArrow(
        squeeze, "part int, doc_id long, tie long, n_chars long, fingerprint string, z binary")
    own = slim.withColumn("head", F.lit(False))
    # equal (id, text) rows would each match a head: one of them is enough
    again = docs.join(heads.withColumnRenamed("doc_id", "h_id").withColumnRenamed("tie", "h_tie"),
                      F.col("doc_id").eqNullSafe(F.col("h_id")) & (tie == F.col("h_tie"))) \
        .select(F.col("to").alias("part"), "doc_id", tie.alias("tie"), "text").dropDuplicates(["part", "doc_id", "tie"]) \
        .mapInArrow(squeeze, "part int, doc_id long, tie long, n_chars long, fingerprint string, z binary") \
        .withColumn("head", F.lit(True))
    dealt = own.unionByName(again).repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "part") \
        .sortWithinPartitions("part", "head", F.col("doc_id").asc_nulls_first(), "tie", "z")

    def pair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        full = lambda z: unpack.decompress(z).decode("utf-8")
        held = None  # the row that waits for its successor

        def finish(row: dict, following: dict) -> tuple:
            edited = edited_text(full(row["z"]), full(following["z"])).encode("utf-8")
            sum_edited = digest(edited)
            return (row["doc_id"], row["n_chars"], hashlib.sha256(edited).hexdigest(), row["fingerprint"], sum_edited,
                    likeness(row["fingerprint"], sum_edited), likeness(row["fingerprint"], following["fingerprint"]))

        names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
        for batch in batches:
            done = []
            for values in zip(*batch.columns):
                row = {name: v.as_py() for name, v in zip(batch.schema.names, values)}
                if held is not None and held["part"] == row["part"] and not held["head"]:
                    done.append(finish(held, row))
                held = row
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*done), kinds)] if done else
                                             [pa.array([], k) for k in kinds], names=names)

    return dealt.mapInArrow(pair, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
                                  "edited_fingerprint string, near_edited double, near_next double")

