"""Interval overlap joins and connected components, as DataFrame plans.

Overlap join: Catalyst would plan a theta join on ``a.start <= b.end AND
b.start <= a.end`` as a nested loop. Instead an interval belongs to the finest
of a ladder of bin widths of which it spans at most SPAN, so it covers few bins
of its level and of every coarser one, however long it is. A pair meets at the
coarser of its two levels: one equi-join on (keys, level, bin, side), where the
side says which of the two is at home on that level, so two passers-by never
meet. A pair is kept only in the bin holding ``max(a.start, b.start)``, which
both intervals cover, so each overlapping pair appears exactly once without a
global distinct. One small aggregate over both sides gives the ladder (a
histogram of lengths by powers of two): the finest width is about the 95th
percentile of the right side, and copies are made only on levels where the
other side has rows.

Heavy bins: a bin with more than HEAVY_ROWS rows of a side, as a sample shows,
is split into a grid: rows of a side are dealt to its parts by a hash of the row
and copied to the parts of the other side, so one join key never gets more than
its share. Which bins are split changes the work, never a result.

Connected components: edges near each other go to one task, which reduces them
to stars around its smallest nodes; only nodes that two tasks saw link their
roots, and these few links are reduced the same way until one task holds them.
Where that does not shrink the edges, alternating large-star / small-star rounds
take over. Every round is a table in the shared checkpoint folder, so a lost
executor replays one round, not all.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandline.session import cut_lineage


#: An interval spans at most SPAN widths of its level; widths grow by LEVEL_FACTOR; without statistics the ladder has
#: LEVELS and a last one whose bins hold an interval of any length.
SPAN, LEVEL_FACTOR, LEVELS, TOP_WIDTH = 4, 8, 10, 1 << 62
#: Rows of a side from which a bin is split, and the share of rows that is looked at to find such bins.
HEAVY_ROWS, HEAVY_SAMPLE = 100_000, 64
#: Edges that one task reduces to stars.
EDGES_A_TASK = 500_000


def _length(start: str, end: str) -> Column:
    return F.abs(F.col(end).cast("bigint") - F.col(start).cast("bigint")) + 1


class _Ladder:
    """Bin widths, and on which levels each side has rows (None: unknown, taken as all) and how many rows it has."""

    def __init__(self, widths: list[int], left: set[int] | None = None, right: set[int] | None = None,
                 rows: tuple[int, int] | None = None):
        self.widths, every = widths, set(range(len(widths)))
        self.left, self.right, self.rows = every if left is None else left, every if right is None else right, rows

    @classmethod
    def of(cls, left: DataFrame, left_length: Column, right: DataFrame, right_length: Column) -> _Ladder:
        """From one aggregate: a row for each side and power of two."""
        both = left.select(F.lit(0).alias("side"), left_length.alias("n")).unionByName(
            right.select(F.lit(1).alias("side"), right_length.alias("n"))).where("n IS NOT NULL")
        found = both.groupBy("side", F.floor(F.log2("n")).alias("power")).agg(
            F.count(F.lit(1)).alias("rows"), F.min("n").alias("least"), F.max("n").alias("most")).collect()
        found.sort(key=lambda r: r["most"])
        rows = tuple(sum(r["rows"] for r in found if r["side"] == side) for side in (0, 1))
        seen, finest = 0, 1
        for r in found:
            if r["side"] == 1 and seen < 0.95 * rows[1]:
                seen, finest = seen + r["rows"], r["most"]
        widths = [max(finest, 1)]
        while found and widths[-1] * SPAN < found[-1]["most"]:
            widths.append(min(widths[-1] * LEVEL_FACTOR, TOP_WIDTH))

        def level(n: int) -> int:
            return next((i for i, w in enumerate(widths) if n <= w * SPAN), len(widths) - 1)

        sides = [{i for r in found if r["side"] == side for i in range(level(r["least"]), level(r["most"]) + 1)}
                 for side in (0, 1)]
        return cls(widths, *sides, rows)


#: Sides of a join key: the left interval is on its own level (the right one on it or below), or only the right one is.
_LEFT_HOME, _RIGHT_HOME = 1, 2


def _binned(df: DataFrame, start: str, end: str, ladder: _Ladder, tag: str) -> DataFrame:
    """``df`` per bin and side, as columns ``_level<tag>``, ``_side<tag>`` and ``_bin<tag>``."""
    length, widths, left = _length(start, end), ladder.widths, tag == "_l"
    copies = []
    for i, w in enumerate(widths):
        bins = F.sequence(*[F.floor(F.col(x).cast("bigint") / w).cast("bigint") for x in (start, end)])
        at_or_below = length.isNotNull() if i == len(widths) - 1 else length <= w * SPAN
        below = length <= widths[i - 1] * SPAN if i else F.lit(False)
        copy = lambda when, side: copies.append(F.when(when, F.struct(
            F.lit(i).alias("level"), F.lit(side).alias("side"), bins.alias("bins"))))
        if left:
            if i in ladder.left:
                copy(at_or_below & ~below, _LEFT_HOME)
            if i in ladder.right and min(ladder.left, default=i) < i:
                copy(below, _RIGHT_HOME)
        else:
            if i in ladder.left:
                copy(at_or_below, _LEFT_HOME)
            if i in ladder.right and min(ladder.left, default=i) < i:
                copy(at_or_below & ~below, _RIGHT_HOME)
    if not copies:
        copies = [F.lit(None).cast("struct<level:int,side:int,bins:array<bigint>>")]
    if len(copies) == 1:
        one = df.withColumn("_b", copies[0]).where("_b IS NOT NULL")
    else:
        one = df.withColumn("_b", F.explode(F.array_compact(F.array(*copies))))
    return one.select(*df.columns, F.col("_b.level").alias(f"_level{tag}"), F.col("_b.side").alias(f"_side{tag}"),
                      F.explode("_b.bins").alias(f"_bin{tag}"))


def heavy_bins(binned: DataFrame, keys: Sequence[str], tag: str, rows: int) -> DataFrame:
    """(keys, _level, _side, _bin, _parts<tag>): bins that hold more than HEAVY_ROWS of the rows, counted on a sample; at
    most ``copies * rows / HEAVY_ROWS`` of them."""
    place = [f"_level{tag}", f"_side{tag}", f"_bin{tag}"]
    few = binned.where(F.pmod(_row_hash(binned, tag), F.lit(HEAVY_SAMPLE)) == 0)
    share = HEAVY_ROWS / HEAVY_SAMPLE
    n = few.groupBy(*keys, *place).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > share)
    return n.select(*keys, *[F.col(c).alias(c.removesuffix(tag)) for c in place],
                    F.ceil(F.col("n") / share).cast("int").alias(f"_parts{tag}"))


def _row_hash(binned: DataFrame, tag: str) -> Column:
    """A hash of the row's sortable columns; rows alike in all of them stay together."""
    simple = [c for c, kind in binned.dtypes if not kind.startswith(("map", "variant")) and not c.startswith("_")]
    return F.xxhash64(*simple, F.lit(tag))


def _split(binned: DataFrame, heavy: DataFrame, keys: Sequence[str], tag: str) -> DataFrame:
    """Adds ``_part_l`` and ``_part_r`` (0 outside of heavy bins): dealt over the own side's parts, copied over the other's."""
    own, other = ("_parts_l", "_parts_r") if tag == "_l" else ("_parts_r", "_parts_l")
    h = heavy.select(*[F.col(k).alias(f"_h{k}") for k in keys], *[F.col(c).alias(f"{c}_h") for c in ("_level", "_side", "_bin")],
                     "_parts_l", "_parts_r")
    same = F.lit(True)
    for k in keys:
        same = same & (F.col(k) == F.col(f"_h{k}"))
    for c in ("_level", "_side", "_bin"):
        same = same & (F.col(f"{c}{tag}") == F.col(f"{c}_h"))
    met = binned.join(F.broadcast(h), same, "left")
    dealt = F.coalesce(F.pmod(_row_hash(binned, tag), F.col(own)), F.lit(0)).cast("int")
    copies = F.sequence(F.lit(0), F.coalesce(F.col(other), F.lit(1)) - 1)
    mine, theirs = (f"_part_l{tag}", f"_part_r{tag}") if tag == "_l" else (f"_part_r{tag}", f"_part_l{tag}")
    return met.select(*binned.columns, dealt.alias(mine), F.explode(copies).alias(theirs))


def overlap_join(left: DataFrame, right: DataFrame, keys: Sequence[str], *,
                 left_start: str = "start", left_end: str = "end",
                 right_start: str = "start", right_end: str = "end",
                 bin_size: int | None = None, extra: Column | None = None,
                 how: str = "inner") -> DataFrame:
    """Pairs of rows whose closed intervals overlap and whose ``keys`` match.

    Columns of ``right`` must not clash with ``left`` (rename first). ``extra``
    is an optional residual predicate over both sides. ``bin_size`` is the
    finest bin width (near the usual interval length; any value gives the same
    pairs); with it no statistics are taken and no bins are split.
    ``how`` may be ``inner`` or ``left`` (left rows without a partner are kept
    once). Intervals with a NULL bound overlap nothing.
    """
    if bin_size is None:
        ladder = _Ladder.of(left, _length(left_start, left_end), right, _length(right_start, right_end))
    else:
        ladder = _Ladder([bin_size * LEVEL_FACTOR ** i for i in range(LEVELS)] + [TOP_WIDTH])
    rk = {k: f"_rk_{k}" for k in keys}
    renamed = right.select(*[F.col(c).alias(rk[c]) if c in rk else F.col(c) for c in right.columns])
    overlap = (F.col(left_start) <= F.col(right_end)) & (F.col(right_start) <= F.col(left_end))
    width = F.lit(ladder.widths[0]).cast("bigint")
    for i, w in enumerate(ladder.widths[1:], 1):
        width = F.when(F.col("_level_l") == i, F.lit(w).cast("bigint")).otherwise(width)
    home = F.floor(F.greatest(F.col(left_start), F.col(right_start)).cast("bigint") / width).cast("bigint") \
        == F.col("_bin_l")
    lb = _binned(left, left_start, left_end, ladder, "_l")
    rb = _binned(renamed, right_start, right_end, ladder, "_r")
    on = ["_bin"]
    if len(ladder.widths) > 1:
        on += ["_level", "_side"]
    # fewer rows than a bin needs to be heavy: none is
    if ladder.rows and max(ladder.rows) > HEAVY_ROWS:
        place = ["_level", "_side", "_bin"]
        hl = heavy_bins(lb, keys, "_l", ladder.rows[0])
        hr = heavy_bins(rb.withColumnsRenamed({v: k for k, v in rk.items()}), keys, "_r", ladder.rows[1])
        heavy = cut_lineage(hl.join(hr, [*keys, *place], "full").select(
            *keys, *place, *[F.coalesce(c, F.lit(1)).alias(c) for c in ("_parts_l", "_parts_r")]))
        if not heavy.isEmpty():
            lb = _split(lb, heavy, keys, "_l")
            rb = _split(rb, heavy.withColumnsRenamed(rk), list(rk.values()), "_r")
            on += ["_part_l", "_part_r"]
    cond = overlap & home
    for c in on:
        cond = (F.col(f"{c}_l") == F.col(f"{c}_r")) & cond
    for k in keys:
        cond = cond & (F.col(k) == F.col(rk[k]))
    if extra is not None:
        cond = cond & extra
    helpers = [f"{c}{t}" for c in ("_level", "_side", "_bin", "_part_l", "_part_r") for t in ("_l", "_r")]
    pairs = lb.join(rb, cond, "inner").drop(*helpers, *rk.values())
    if how == "inner":
        return pairs
    if how == "left":
        lonely = left.join(pairs.select(*left.columns), list(left.columns), "left_anti")
        return pairs.unionByName(lonely, allowMissingColumns=True)
    raise ValueError(how)


def reciprocal_overlap(a_start: Column, a_end: Column, b_start: Column, b_end: Column) -> Column:
    """min(overlap / len_a, overlap / len_b) for half-open [start, end)."""
    ov = F.least(a_end, b_end) - F.greatest(a_start, b_start)
    return F.least(ov / (a_end - a_start), ov / (b_end - b_start))


def _sym(e: DataFrame) -> DataFrame:
    """Both orientations of an undirected edge list (u, v), no self loops."""
    return e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v"))).where("u <> v")


def _large_star(e: DataFrame) -> DataFrame:
    s = _sym(e)
    m = s.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return s.join(m, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(e: DataFrame) -> DataFrame:
    s = _sym(e).where(F.col("v") <= F.col("u"))
    m = s.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    moved = s.join(m, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    hub = m.select("u", F.col("m").alias("v"))
    return moved.unionByName(hub).where("u <> v").distinct()


def _edge_state(e: DataFrame) -> tuple:
    """Edge count and hash sum: equal for equal edge sets, in any order."""
    return tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())


def _star_rounds(e: DataFrame) -> DataFrame:
    """(node, root) of every node of an edge list (u, v): alternating large-star / small-star rounds (Kiveris et al.,
    "Connected Components in MapReduce and Beyond", SoCC 2014), until edge count and hash sum stay the same."""
    e = cut_lineage(e.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct())
    state = _edge_state(e)
    while state[0]:
        e = cut_lineage(_small_star(_large_star(e)))
        before, state = state, _edge_state(e)
        if state == before:
            break
    return _sym(e).groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("root")).withColumnRenamed("u", "node")


def _task_stars(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(node, root) of the nodes of one task's edges, by union-find; the root is the smallest node reached there."""
    parent: dict = {}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for batch in batches:
        for u, v in zip(batch["u"].tolist(), batch["v"].tolist()):
            parent.setdefault(u, u)
            parent.setdefault(v, v)
            a, b = find(u), find(v)
            if a != b:
                parent[max(a, b)] = min(a, b)
    nodes = list(parent)
    yield pd.DataFrame({"node": nodes, "root": [find(x) for x in nodes]})


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst",
                         nodes: DataFrame | None = None, near: Sequence[str] = ()) -> DataFrame:
    """(node, component) where component is the smallest node id reachable.

    ``near`` names columns of ``edges`` that sort connected nodes close together (a place, for instance): then almost
    all links fall within a task, and what is left is one link for each border. Any order gives the same components.
    """
    kind = dict(edges.dtypes)[src]
    e = cut_lineage(edges.where(F.col(src) != F.col(dst)).select(
        F.col(src).alias("u"), F.col(dst).alias("v"), *[F.col(c).alias(f"near{i}") for i, c in enumerate(near)]))
    order, steps = [f"near{i}" for i in range(len(near))] + ["u", "v"], []
    while n := e.count():
        parts = -(-n // EDGES_A_TASK)
        dealt = e.coalesce(1) if parts == 1 else e.repartitionByRange(parts, *order)
        stars = cut_lineage(dealt.select("u", "v").mapInPandas(_task_stars, f"node {kind}, root {kind}"))
        if parts == 1:
            steps.append(stars)
            break
        # a node that several tasks saw links their roots
        least = cut_lineage(stars.groupBy("node").agg(F.min("root").alias("least")))
        steps.append(least.withColumnRenamed("least", "root"))
        e = cut_lineage(stars.join(least, "node").where("root <> least").select(
            F.col("root").alias("u"), F.col("least").alias("v")).distinct())
        order = ["u", "v"]
        if 2 * e.count() > n:
            steps.append(_star_rounds(e))
            break
    out = edges.select(F.col(src).alias("node"), F.col(dst).alias("component")).limit(0)
    if steps:
        out = steps[0].withColumnRenamed("root", "component")
        for step in steps[1:]:
            higher = step.select(F.col("node").alias("component"), F.col("root").alias("_higher"))
            out = out.join(higher, "component", "left").select("node", F.coalesce("_higher", "component").alias("component"))
    if nodes is not None:
        n = nodes.select(F.col(nodes.columns[0]).alias("node")).distinct()
        out = n.join(out, "node", "left").select("node", F.coalesce("component", "node").alias("component"))
    return out
