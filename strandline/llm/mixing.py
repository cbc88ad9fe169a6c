"""Mixing sources to target weights along a time-varying curriculum (DataFrame functions only).

Each source has a weight schedule over training time t in [0, 1], piecewise
linear between knots. Its integral is the source's weight: it fixes the
source's token target. The schedule's cumulative integral, scaled to the
target, is the source's cumulative token demand; a document whose copy starts
at cumulative token c is due at the time t at which the demand reaches c. The
mix is the copies, range-sorted by that time.

Defined results: a NULL or empty text has size 0; it takes no words and is due
with the tokens before it. NULL sources are one source, ranked last. NULL and
repeated ids are separate rows; rows that tie in id are ordered by size and
text hash. A source without words has target 0 and none of its rows are due.
An empty table gives an empty mix. Extra columns pass through ``mix``
unchanged, whatever their names.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandline.llm.common import WORD, packed, quoted

Schedule = Sequence[tuple[float, float]]

#: Knots (t, weight) by a source's rank modulo 3; the integrals are 3, 1 and 2.
CURRICULUM: tuple[Schedule, ...] = (((0.0, 4.0), (1.0, 2.0)), ((0.0, 0.5), (0.5, 0.75), (1.0, 2.0)),
                                    ((0.0, 2.0), (1.0, 2.0)))
CURRICULUM_SHARE = 1.5
MAX_REPEATS = 2.0
SEED = 20


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def integral(schedule: Schedule) -> float:
    return sum((b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(schedule, schedule[1:]))


def _segments(schedule: Schedule) -> Column:
    """The schedule as an array of segments with the integral up to their start, as a share of the whole."""
    total, done, out = integral(schedule), 0.0, []
    for (t0, w0), (t1, w1) in zip(schedule, schedule[1:]):
        out.append(F.struct(F.lit(t0).alias("t"), F.lit(w0 / total).alias("w"), F.lit(done / total).alias("before"),
                            F.lit((w1 - w0) / (t1 - t0) / total).alias("slope")))
        done += (t1 - t0) * (w0 + w1) / 2
    return F.array(*out)


def _due(segments: Column, share: Column) -> Column:
    """Inverse of the cumulative schedule: the time at which ``share`` of a source's demand is reached."""
    seg = F.element_at(F.filter(segments, lambda s: s["before"] <= share), -1)
    rest = share - seg["before"]
    root = F.sqrt(F.greatest(seg["w"] * seg["w"] + 2 * seg["slope"] * rest, F.lit(0.0)))
    return seg["t"] + F.coalesce(F.try_divide(2 * rest, seg["w"] + root), F.lit(0.0))


def _targets(sizes: DataFrame, curriculum: Sequence[Schedule], share: float, repeats: float) -> DataFrame:
    """(sk, source_size, target, segments), one row per source.

    With weights w, caps c = repeats * size and total T, the targets are
    min(l * w, c) for the l at which they sum to T. That sum is concave in l and
    lies below each of its extended linear pieces, so l is the largest solution
    over the pieces: two running sums by c / w, no loop. The windows run over
    one pre-aggregated row per source.
    """
    by_rank = Window.orderBy(F.col("src").asc_nulls_last())
    ranked = sizes.withColumn("kind", (F.row_number().over(by_rank) - 1) % len(curriculum))
    weight = F.element_at(F.array(*[F.lit(float(integral(s))) for s in curriculum]), F.col("kind") + 1)
    segments = F.element_at(F.array(*[_segments(s) for s in curriculum]), F.col("kind") + 1)
    ranked = ranked.select("sk", "source_size", weight.alias("w"), segments.alias("segments"),
                           (F.col("source_size") * repeats).alias("cap"))
    by_ratio = Window.orderBy(F.col("cap") / F.col("w"), "sk")
    whole = Window.partitionBy(F.lit(0))
    full = F.coalesce(F.sum("cap").over(by_ratio.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    open_w = F.sum("w").over(by_ratio.rowsBetween(0, Window.unboundedFollowing))
    level = (F.sum("source_size").over(whole) * share - full) / open_w
    return (ranked.withColumn("level", level).withColumn("level", F.max("level").over(whole))
            .select("sk", "source_size", "segments",
                    F.least(F.greatest(F.col("level"), F.lit(0.0)) * F.col("w"), F.col("cap")).alias("target")))


def mix_plan(docs: DataFrame, curriculum: Sequence[Schedule] = CURRICULUM, share: float = CURRICULUM_SHARE,
             repeats: float = MAX_REPEATS, seed: int = SEED, buckets: int | None = None, id_col: str = "doc_id",
             text_col: str = "text", source_col: str = "source") -> DataFrame:
    """One row per document: ``_row`` (its columns), size, source_size, target and ``copies``, an array of
    (epoch, words, due) in order.

    Documents of a source are ordered by a hash of their id. Their running
    token count is taken within hash ranges of each source (``buckets`` of
    them, growing with the shuffle partitions) plus the sum of the ranges
    before, so a hot source is spread over all tasks; the order, and with it
    the result, does not depend on the number of ranges.
    """
    spark = docs.sparkSession
    n = buckets or max(256, 4 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    src = quoted(source_col)
    h = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(quoted(id_col).cast("string"), F.lit(""))).cast("binary"))
    lead = F.conv(F.substring(h, 1, 8), 16, 10).cast("long")
    rows = docs.select(
        packed(docs), src.alias("src"), F.coalesce(F.concat(F.lit("="), src.cast("string")), F.lit("")).alias("sk"),
        quoted(id_col).alias("id"), word_count(quoted(text_col)).alias("size"), h.alias("h"),
        F.floor(lead * n / 2**32).cast("int").alias("bucket"),
        F.xxhash64(quoted(text_col)).alias("tie"))
    slim = rows.groupBy("sk", "src", "bucket").agg(F.sum("size").alias("n"))
    before = Window.partitionBy("sk").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    ranges = slim.select("sk", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    targets = _targets(slim.groupBy("sk", "src").agg(F.sum("n").alias("source_size")), curriculum, share, repeats)
    ranges = ranges.join(targets, "sk")
    within = Window.partitionBy("sk", "bucket").orderBy("h", "id", "size", "tie") \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = rows.join(ranges, ["sk", "bucket"]).withColumn(
        "start", F.col("offset") + F.sum("size").over(within) - F.col("size"))
    budget, size = F.round(F.col("target")).cast("long"), F.col("size")

    def copy(e: Column) -> Column:
        at = e * F.col("source_size") + F.col("start")
        words = F.greatest(F.least(budget - at, size), F.lit(0).cast("long"))
        return F.struct(e.cast("int").alias("epoch"), words.alias("words"),
                        _due(F.col("segments"), F.try_divide(at.cast("double"), F.col("target"))).alias("due"),
                        at.alias("at"))

    last = F.greatest(F.ceil(F.lit(float(repeats))).cast("long"), F.lit(1).cast("long")) - 1
    copies = F.filter(F.transform(F.sequence(F.lit(0).cast("long"), last), copy),
                      lambda c: (c["words"] > 0) | ((size == 0) & (c["epoch"] == 0) & (c["at"] < budget)))
    return placed.select("_row", "id", "size", "source_size", "target", copies.alias("copies"))


def mix(docs: DataFrame, text_col: str = "text", position_col: str | None = None, **options) -> DataFrame:
    """The mix in training order: one row per copy with the document's columns, texts whole. The copy at which a source's
    target is reached is taken if at least half of its words are within it, and left out else. ``position_col`` names a
    further column for the time at which a copy is due (0 to 1), by which a later reader can sort again."""
    plan = mix_plan(docs, text_col=text_col, **options)
    copies = plan.select("_row", "id", "size", F.explode("copies").alias("c")).where(2 * F.col("c.words") >= F.col("size")) \
        .repartitionByRange("c.due", "id", "c.epoch").sortWithinPartitions("c.due", "id", "c.epoch")
    extra = [F.col("c.due").alias(position_col)] if position_col else []
    return copies.select(*[F.col("_row").getField(c).alias(c) for c in docs.columns], *extra)


def mix_report(docs: DataFrame, **options) -> DataFrame:
    """Contract columns of op1, range-sorted by the time at which a document is first due (never due: last)."""
    plan = mix_plan(docs, **options)
    taken = F.aggregate("copies", F.lit(0).cast("long"), lambda a, c: a + c["words"])
    due = F.element_at(F.transform("copies", lambda c: c["due"]), 1)
    first = F.when(F.size("copies") > 0, due)
    return plan.select(F.col("id").alias("doc_id"), "size", "source_size", "target", taken.alias("taken"),
                       first.alias("due")) \
        .repartitionByRange(F.col("due").asc_nulls_last(), "doc_id") \
        .sortWithinPartitions(F.col("due").asc_nulls_last(), "doc_id").drop("due")


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the documents of the mix in training order, a repeated document as often as it is taken."""
    columns = docs.columns
    return mix(docs).select(*[quoted(c) for c in columns])

