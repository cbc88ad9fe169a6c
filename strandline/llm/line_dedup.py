"""Line de-duplication by keep bitmaps (DataFrame functions only).

A line's key is the line without white space at both ends, A-Z lower-cased. Of a key of at least ``MIN_CHARS`` code
points only the lines of its first document stay. Keys are hashed to 128 bits, the hashes are range-partitioned and
sorted with document and position as secondary order, and one streaming pass marks what is not a first occurrence.
What returns is a bitmap a document, as runs of kept lines, never text; texts meet their bitmap by id and text hash.

A key may hold a third of all lines. Keys frequent in a sample of the lines (at most ``4 * shuffle partitions`` keys,
so they may be broadcast) are not dealt by hash: their first document is a minimum with map-side combine, and their
lines are compared where they are. Which keys count as frequent changes the work, never a result.

Defined results: a NULL text is one empty line. Rows with equal doc_id are one document, whose lines stay in each row;
rows with a NULL doc_id are one document, after all others. Repeated rows get the same bitmap. Extra columns pass
through ``dedup_lines``. An empty table gives no rows. ``keep_bitmaps`` runs jobs when called: it writes the hashed
lines to the shared folder and counts a sample of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandline.llm.common import packed, rewritten

MIN_CHARS = 10
#: One line of so many is in the sample that shows frequent keys; a key is frequent from so many sample lines on.
SAMPLE, LEAST = 64, 8

WHITE = " \t\n\x0b\x0c\r"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_KEY, _ROW = ["h1", "h2"], ["doc_id", "t1", "t2"]


def lower_ascii(text: Column) -> Column:
    """A-Z lower-cased, all else kept; pure ASCII takes the short way."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, _UPPER, _LOWER))


def hashed(text: Column) -> tuple[Column, Column]:
    """128 bits of a string: two XXH64 of unlike seeds."""
    return F.xxhash64(text), F.xxhash64(F.lit(7), text)


def lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def row_key(doc_id: Column, text: Column) -> list[Column]:
    t1, t2 = hashed(text)
    return [doc_id.cast("long").alias("doc_id"), t1.alias("t1"), t2.alias("t2")]


def keyed_lines(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(doc_id, t1, t2, n, pos, h1, h2) of every line whose key counts."""
    text = F.coalesce(F.col("text"), F.lit(""))
    split = docs.select(*row_key(F.col("doc_id"), text), lines(text).alias("lines"))
    each = split.select(*_ROW, F.size("lines").alias("n"), F.posexplode("lines").alias("pos", "line"))
    each = each.select(*_ROW, "n", "pos", F.btrim("line", F.lit(WHITE)).alias("line")).where(F.length("line") >= min_chars)
    h1, h2 = hashed(F.col("key"))
    return each.select(*_ROW, "n", "pos", lower_ascii(F.col("line")).alias("key")) \
        .select(*_ROW, "n", "pos", h1.alias("h1"), h2.alias("h2"))


def frequent_keys(each: DataFrame) -> DataFrame:
    """Keys that hold at least a quarter of a shuffle partition's share of the sampled lines."""
    parts = int(each.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    few = each.where(F.pmod(F.xxhash64("t1", "pos", "doc_id"), F.lit(SAMPLE)) == 0)
    least = max(LEAST, few.count() // (4 * parts))
    return few.groupBy(*_KEY).count().where(F.col("count") >= least).select(*_KEY)


def repeats(each: DataFrame) -> DataFrame:
    """(doc_id, t1, t2, n, pos) of the lines that are not of their key's first document."""
    hot = rewritten(frequent_keys(each), "line-hot")
    first_hot = each.join(F.broadcast(hot), _KEY).groupBy(*_KEY).agg(F.min("doc_id").alias("first"))
    of_hot = each.join(F.broadcast(first_hot), _KEY)
    # range partitions of whole keys; the window's order is the secondary sort, its frame grows with the stream
    dealt = each.join(F.broadcast(hot), _KEY, "left_anti").repartitionByRange(*_KEY)
    before = Window.partitionBy(*_KEY).orderBy(F.col("doc_id").asc_nulls_last(), "pos") \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    streamed = dealt.withColumn("first", F.first("doc_id").over(before))
    gone = ~F.col("doc_id").eqNullSafe(F.col("first"))
    out = [*_ROW, "n", "pos"]
    return of_hot.where(gone).select(*out).unionByName(streamed.where(gone).select(*out))


def kept_runs(dropped: Column, n: Column) -> Column:
    """The keep bitmap as runs of set bits, array<struct<at,n>>, from the ascending positions that go."""
    runs = F.transform(F.concat(F.array(F.lit(-1)), dropped), lambda p, i: F.struct(
        (p + 1).alias("at"), (F.coalesce(F.get(dropped, i), n) - p - 1).cast("int").alias("n")))
    return F.filter(runs, lambda r: r["n"] > 0)


def keep_bitmaps(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(doc_id, t1, t2, n_dropped, keep): one row for each row key that loses lines; all others keep everything."""
    each = rewritten(keyed_lines(docs, min_chars), "line-keys")
    gone = repeats(each).groupBy(*_ROW).agg(F.sort_array(F.collect_set("pos")).alias("dropped"), F.max("n").alias("n"))
    return gone.select(*_ROW, F.size("dropped").cast("long").alias("n_dropped"),
                       kept_runs(F.col("dropped"), F.col("n")).alias("keep"))


def kept_text(text: Column, keep: Column) -> Column:
    """The lines whose bit is set, joined; the whole text where there is no bitmap."""
    some = F.flatten(F.transform(keep, lambda r: F.slice(lines(text), r["at"] + 1, r["n"])))
    return F.when(keep.isNull(), text).otherwise(F.array_join(some, "\n"))


def with_bitmaps(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(_row, text, n_dropped, keep) of every row of ``docs``; NULL texts read as empty."""
    text = F.coalesce(F.col("text"), F.lit(""))
    marked = docs.select(packed(docs), text.alias("text"), *row_key(F.col("doc_id"), text))
    maps = keep_bitmaps(docs, min_chars).select(*[F.col(c).alias(f"b_{c}") for c in _ROW], "n_dropped", "keep")
    same = (F.col("t1") == F.col("b_t1")) & (F.col("t2") == F.col("b_t2")) & F.col("doc_id").eqNullSafe(F.col("b_doc_id"))
    return marked.join(maps, same, "left").select("_row", "text", F.coalesce("n_dropped", F.lit(0)).cast("long")
                                                  .alias("n_dropped"), "keep")


def dedup_lines(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """``docs`` with repeated lines taken out of ``text``; all other columns as they are."""
    out = with_bitmaps(docs, min_chars).select("_row", kept_text(F.col("text"), F.col("keep")).alias("text"))
    return out.select(*[F.col("text") if c == "text" else F.col("_row").getField(c).alias(c) for c in docs.columns])


def line_report(docs: DataFrame) -> DataFrame:
    """Contract columns of op12, and the bitmap itself as ``keep_runs`` (NULL where every line stays)."""
    rows = with_bitmaps(docs.select("doc_id", "text"))
    n = F.size(lines(F.col("text"))).cast("long")
    runs = F.transform("keep", lambda r: F.concat_ws("+", r["at"], r["n"]))
    return rows.select(F.col("_row.doc_id").alias("doc_id"), n.alias("n_lines"), "n_dropped",
                       F.sha2(kept_text(F.col("text"), F.col("keep")), 256).alias("kept_sha256"),
                       F.array_join(runs, ",").alias("keep_runs"))
