"""SimHash near-duplicates by multi-index hashing.

Fingerprints: XXH64 (seed 42) of every shingle of three words, A-Z in lower
case; a bit is set if it is set in over half the hashes.

Links: equal texts have equal fingerprints, so only distinct ones are compared.
A fingerprint has two segments of 32 bits. Two fingerprints within 2 bits of each other
agree on the low segment, or differ in at most one bit of the high segment. So
the table holds each fingerprint under both its segments, and is asked for the
exact low segment and for the ball of radius 1 around the high one; flipping
only zero bits finds each pair from one side. Matches are verified on all 64
bits.

A key with many fingerprints would make the square of their number in
candidates. Keys over ``CROWDED`` are therefore not paired at all: members get
one row for each choice of two of the other 32 bits to ignore (probes of a
flipped key, which have one bit left: each choice of one), and those that agree
on the rest are linked to the smallest of them. All of these are within 2 bits
of that one, and any linked pair meets in some choice, so the components are
the same with or without the limit; work stays linear in the key's size.

Defined results: NULL and wordless texts have fingerprint 0 and link like any
other. component_id is the smallest non-NULL doc_id reachable; a component of
NULL ids only has NULL. Repeated rows and ids keep their rows. Extra columns
are ignored by the report. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strandline.llm.common import bounded_batches, packed, quoted, rewritten, unpacked
from strandline.llm.components import connected_components

SHINGLE_WORDS = 3
MAX_BITS = 2
SEED = 42
#: Fingerprints under one table key beyond which its links are found by masks instead of pairs.
CROWDED = 64
#: Shingles hashed at once.
BLOCK = 1 << 15

_LOW = 0xFFFFFFFF


def simhash(text: str | None, shingle_words: int = SHINGLE_WORDS) -> int:
    """Unsigned 64-bit fingerprint of a whole text."""
    words = (text or "").encode("utf-8").lower().split()
    if not words:
        return 0
    n, h = max(1, len(words) - shingle_words + 1), xxhash.xxh64_intdigest
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, n, BLOCK):
        end = min(n, at + BLOCK)
        sums = np.array([h(b" ".join(words[i:i + shingle_words]), SEED) for i in range(at, end)], dtype="<u8")
        ones += np.unpackbits(sums.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view("<u8")[0])


def simhash_column(docs: DataFrame, text_col: str = "text", name: str = "_fp",
                   shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """``docs`` with the fingerprint as a signed long; map only."""
    bounded_batches(docs.sparkSession)
    columns = [c for c in docs.columns if c != name]
    schema = T.StructType([*docs.select(*[quoted(c) for c in columns]).schema, T.StructField(name, T.LongType())])
    at = columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = np.array([simhash(t.as_py(), shingle_words) for t in batch.column(at)], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(fp, pa.int64())], names=[*columns, name])

    return docs.select(*[quoted(c) for c in columns]).mapInArrow(run, schema)


def _segment(fp: Column, high: bool) -> Column:
    return F.shiftrightunsigned(fp, 32) if high else fp.bitwiseAND(F.lit(_LOW))


def _table(fps: DataFrame) -> DataFrame:
    """(side, key, other, fp): each fingerprint under its low (0) and its high (1) segment."""
    low, high = _segment(F.col("fp"), False), _segment(F.col("fp"), True)
    return fps.select("fp", F.explode(F.array(
        F.struct(F.lit(0).alias("side"), low.alias("key"), high.alias("other")),
        F.struct(F.lit(1).alias("side"), high.alias("key"), low.alias("other")))).alias("s")) \
        .select("s.side", "s.key", "s.other", "fp")


def _probes(fps: DataFrame) -> DataFrame:
    """(side, key, other, fp): the high segment with one of its zero bits set, to be looked up as side 1."""
    low, high = _segment(F.col("fp"), False), _segment(F.col("fp"), True)
    zeros = F.filter(F.array(*[F.lit(1 << i) for i in range(32)]), lambda b: high.bitwiseAND(b) == 0)
    return fps.select("fp", low.alias("other"), F.explode(F.transform(zeros, lambda b: high.bitwiseOR(b))).alias("key")) \
        .select(F.lit(1).alias("side"), "key", "other", "fp")


def _masked(rows: DataFrame, bits: int) -> DataFrame:
    """A row for each choice of ``bits`` of the other segment's 32 bits, with these cleared."""
    masks = F.array(*[F.lit(_LOW & ~sum(1 << b for b in c)) for c in combinations(range(32), bits)])
    return rows.withColumn("mask", F.explode(masks)).withColumn("rest", F.col("other").bitwiseAND(F.col("mask")))


def _crowded_links(table: DataFrame, probes: DataFrame) -> DataFrame:
    """Links (u, v) of the crowded keys, to the smallest table member that agrees outside a mask."""
    group = ["side", "key", "mask", "rest"]
    two = _masked(table, 2)
    hubs2 = two.groupBy(*group).agg(F.min("fp").alias("hub"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    one = _masked(table, 1).groupBy(*group).agg(F.min("fp").alias("hub"))
    inside = two.join(hubs2, group).select(F.col("fp").alias("u"), F.col("hub").alias("v"))
    asked = _masked(probes, 1).join(one, group).select(F.col("fp").alias("u"), F.col("hub").alias("v"))
    return inside.unionByName(asked).where("u <> v").distinct()


def fingerprint_links(fps: DataFrame, crowded: int = CROWDED) -> DataFrame:
    """Links (u, v) between distinct fingerprints (column fp) whose components are those of all pairs
    within MAX_BITS bits. ``crowded`` is at least 1."""
    table = _table(fps)
    keys = table.groupBy("side", "key").agg(F.count(F.lit(1)).alias("n"))
    # asked for: keys that the table has; most flipped segments are in no table
    asked = rewritten(_probes(fps).join(keys, ["side", "key"]), "simhash-probes")
    busy = rewritten(table.join(keys.where("n > 1"), ["side", "key"]), "simhash-table")
    few, many = F.col("n") <= crowded, F.col("n") > crowded
    near = F.bit_count(F.col("a.fp").bitwiseXOR(F.col("b.fp"))) <= MAX_BITS
    same = F.expr("a.side = b.side and a.key = b.key")
    inside = busy.where(few).alias("a").join(busy.where(few).alias("b"), same & (F.col("a.fp") < F.col("b.fp")) & near)
    members = table.join(asked.where(few).select("side", "key").distinct(), ["side", "key"], "left_semi")
    flipped = asked.where(few).alias("a").join(members.alias("b"), same & near)
    pairs = [x.select(F.col("a.fp").alias("u"), F.col("b.fp").alias("v")) for x in (inside, flipped)]
    crowd = _crowded_links(busy.where(many), asked.where(many))
    return pairs[0].unionByName(pairs[1]).unionByName(crowd).distinct()


def fingerprint_classes(fps: DataFrame, crowded: int = CROWDED) -> DataFrame:
    """(fp, root) of every distinct fingerprint that has a link; those without are their own class."""
    links = fingerprint_links(fps, crowded)
    return connected_components(links).select(F.col("node").alias("fp"), F.col("component").alias("root"))


def simhash_classes(docs: DataFrame, crowded: int = CROWDED) -> DataFrame:
    """(fp, component_id): every distinct fingerprint with its class's smallest document id."""
    rows = docs.groupBy("fp").agg(F.min("doc_id").alias("least"))
    rows = rewritten(rows, "simhash-fps")
    linked = fingerprint_classes(rows.select("fp"), crowded)
    rooted = rows.join(linked, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    # unlinked fingerprints, nearly all, are classes by themselves; a class may be large: its least is pre-aggregated
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return rooted.select("fp", "root").join(least, "root").select("fp", "component_id")


def simhash_report(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, crowded: int = CROWDED) -> DataFrame:
    """Contract columns of op5, one row per document."""
    marked = simhash_column(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), name="_fp",
                            shingle_words=shingle_words).select("doc_id", F.col("_fp").alias("fp"))
    marked = rewritten(marked, "simhash-docs")
    classes = simhash_classes(marked, crowded)
    return marked.join(classes, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                                             "component_id")


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: of each class of near-duplicates the document with the smallest id (of equal ids or NULL
    ids, the one with the smallest text hash) stays."""
    columns = docs.columns
    rows = docs.select(packed(docs), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"))
    marked = simhash_column(rows.select("doc_id", "text")).select(
        "doc_id", F.col("_fp").alias("fp"), F.xxhash64("text").alias("tie"))
    marked = rewritten(marked, "simhash-docs")
    first = marked.groupBy("fp").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "tie")).alias("first"))
    first = rewritten(first, "simhash-fps")
    linked = fingerprint_classes(first.select("fp"))
    kept = first.join(linked, "fp", "left").groupBy(F.coalesce("root", "fp").alias("root")) \
        .agg(F.min("first").alias("first")).select(F.col("first.doc_id").alias("k_id"), F.col("first.tie").alias("k_tie"))
    kept = rewritten(kept, "simhash-kept")
    tie = F.xxhash64("text")
    stay = rows.withColumn("tie", tie).join(
        kept, F.col("doc_id").eqNullSafe(F.col("k_id")) & (F.col("tie") == F.col("k_tie")), "left_semi")
    # copies with the same id and text are one document
    return unpacked(stay.dropDuplicates(["doc_id", "tie"]), columns)
