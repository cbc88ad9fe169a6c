"""Hard negatives by exact inner product in cover trees.

Anchors are the rows whose id is divisible by ``ANCHOR_EVERY``. An anchor's positives are the ``POSITIVES`` rows of its
label with the highest inner product; the negatives of a positive are the ``NEGATIVES`` best rows of other labels whose
product lies in a window of shares of the positive's.

Candidates get one more coordinate, sqrt(M^2 - |x|^2), that brings all to one norm M: with the anchor padded by 0, inner
product and distance in that space order alike. Rows are cut into blocks of at most ``TREE_ROWS`` (near rows together, a
crowded place into many blocks), and each block is a cover tree: a node's children are centres at least the level's
scale apart, every row goes to a centre within it, and the radius kept is the farthest row truly below the node. So a
node's products lie in <q, centre> +- |q| * radius. The descent opens nodes best first by upper bound, skips those wholly
outside the window or below the k-th found, and compares leaves' rows exactly, in integers. Bounds leave out no row that
counts: the result is exact, and trees only save work. On vectors without structure all radii are alike and nearly
every row is read; on clustered ones most nodes are skipped.

Trees are made once and written as rows of bounded size. Blocks of at most ``ANCHOR_BLOCK`` anchors meet groups of
``GROUP_TREES`` trees on a grid; a task carries each window's k-th best from tree to tree.

Defined results: rows with a NULL label, a NULL vector, or any NULL or non-finite component take no part, nor those
with a NULL id, nor vectors so long that their squared norm is no long (no score exists). Vectors meet only vectors of the
same length; empty ones score 0. Repeated rows and ids are rows of their own: each row is an anchor, positive or negative by
itself. Ties go to the smaller id. Extra columns are ignored. An empty table, or one without anchors, gives no rows.
``hard_negatives`` runs jobs when called: it writes rows, trees and positives to the shared folder.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandline.llm.common import rewritten

ANCHOR_EVERY, SHIFT_EVERY, LABELS = 100, 7, 10
POSITIVES, NEGATIVES = 5, 10
#: A negative's score is at least LOW and at most HIGH percent of the positive's.
LOW, HIGH = 30, 90
SCALE = 256
TREE_ROWS, LEAF_ROWS, ANCHOR_BLOCK, GROUP_TREES = 4096, 32, 8192, 8
#: Rows from which the centres that cut the table into blocks are drawn, and their number.
PIVOT_ROWS, PIVOTS = 4096, 64
#: Ratio of the scales of two levels.
SHRINK = 0.7
_ANY = (1 << 63) - 1


# ---- the tree of a block --------------------------------------------------

def exact(q: np.ndarray, x: np.ndarray, norm: float) -> np.ndarray:
    """Integer products of a vector with rows; through floats where ``norm`` shows that these are exact."""
    return (x @ q).astype(np.int64) if norm < 2.0**52 else x.astype(np.int64) @ q.astype(np.int64)


class CoverTree:
    """Rows in tree order; node i covers rows start[i]:stop[i], its centre is the row centre[i], its children are nodes
    child[i]:child[i] + n_child[i] (none: a leaf)."""

    def __init__(self, x: np.ndarray, nodes: dict[str, np.ndarray], order: np.ndarray):
        self.x, self.order = x, order  # rows as given; ``order`` lists them along the leaves
        self.__dict__.update(nodes)

    @classmethod
    def build(cls, x: np.ndarray, leaf: int = LEAF_ROWS) -> CoverTree:
        x = x.astype(np.float64)
        n = (x**2).sum(axis=1)
        y = np.column_stack([x, np.sqrt(np.maximum(n.max(initial=0.0) - n, 0.0))])
        centre, radius, child, n_child, rows = [0], [0.0], [0], [0], [np.arange(len(y))]
        away = np.sqrt(((y - y[:1]) ** 2).sum(axis=1))
        radius[0] = away.max(initial=0.0)
        todo, at = [(0, away)], 0
        while at < len(todo):
            node, away = todo[at]
            at += 1
            mine = rows[node]
            if len(mine) <= leaf or radius[node] == 0.0:
                continue
            # a greedy net: the node's own centre first, then the farthest row, until all lie within the next scale
            scale, near, home = SHRINK * radius[node], away.copy(), np.zeros(len(mine), dtype=np.int64)
            centres = [centre[node]]
            while (far := int(near.argmax())) >= 0 and near[far] > scale:
                d = np.sqrt(((y[mine] - y[mine[far]]) ** 2).sum(axis=1))
                closer = d < near
                closer[far] = True
                near[closer], home[closer] = d[closer], len(centres)
                near[far] = 0.0
                centres.append(int(mine[far]))
            child[node], n_child[node] = len(centre), len(centres)
            for k, c in enumerate(centres):
                inside = home == k
                centre.append(c)
                radius.append(float(near[inside].max(initial=0.0)))
                child.append(0)
                n_child.append(0)
                rows.append(mine[inside])
                todo.append((len(centre) - 1, near[inside]))
        start, stop, order, along = np.zeros(len(centre), int), np.zeros(len(centre), int), [], [(0, False)]
        count = 0
        while along:  # depth first, so that a node's rows are side by side
            node, done = along.pop()
            if done:
                stop[node] = count
                continue
            start[node] = count
            along.append((node, True))
            if n_child[node]:
                along += [(c, False) for c in range(child[node] + n_child[node] - 1, child[node] - 1, -1)]
            else:
                order.append(rows[node])
                count += len(rows[node])
        nodes = {"centre": np.array(centre), "radius": np.array(radius), "child": np.array(child),
                 "n_child": np.array(n_child), "start": start, "stop": stop}
        return cls(x, nodes, np.concatenate(order) if order else np.zeros(0, int))


class Windows:
    """The k first rows of each score window of one anchor, kept from tree to tree: by score, then smaller id."""

    def __init__(self, low: list[int], high: list[int], k: int):
        self.floor, self.high, self.k = np.array(low, dtype=np.int64), np.array(high, dtype=np.int64), k
        self.found: list[list[tuple[int, int]]] = [[] for _ in low]  # heaps of (score, -id), the worst on top

    def needs(self, least: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Of nodes with products between ``least`` and ``most``: those that some window may still take a row from."""
        return ((most[:, None] >= self.floor) & (least[:, None] <= self.high)).any(axis=1)

    def take(self, score: np.ndarray, ids: np.ndarray) -> None:
        for w, heap in enumerate(self.found):
            ok = np.flatnonzero((score >= self.floor[w]) & (score <= self.high[w]))
            if len(ok) > self.k:
                ok = ok[score[ok] >= np.partition(score[ok], -self.k)[-self.k]]
                ok = ok[np.lexsort((ids[ok], -score[ok]))[:self.k]]
            for entry in zip(score[ok].tolist(), (-ids[ok]).tolist()):
                if len(heap) < self.k:
                    heapq.heappush(heap, entry)
                elif entry > heap[0]:
                    heapq.heapreplace(heap, entry)
            if len(heap) == self.k:
                self.floor[w] = max(self.floor[w], heap[0][0])


def descend(tree: CoverTree, q: np.ndarray, norm: float, fits: np.ndarray, ids: np.ndarray, windows: Windows) -> int:
    """Fill the windows of anchor ``q`` from a tree; returns how many products it took. Inner nodes wait in a heap by
    their upper bound; the leaves below an opened node that a window needs are compared together."""
    length, taken = float(np.sqrt((q.astype(np.float64) ** 2).sum())), 0
    heap: list[tuple[float, float, int]] = [(-np.inf, -np.inf, 0)]
    while heap:
        most, least, node = heapq.heappop(heap)
        if not windows.needs(np.array([least]), np.array([-most]))[0]:
            continue
        leaves = np.array([node])
        if tree.n_child[node]:
            below = np.arange(tree.child[node], tree.child[node] + tree.n_child[node])
            mid = tree.x[tree.centre[below]] @ q
            # a little widened, so that rounding leaves out nothing
            reach = length * tree.radius[below] * (1 + 1e-9) + 1e-9 * np.abs(mid) + 1e-3
            taken += len(below)
            needed = windows.needs(mid - reach, mid + reach)
            inner = needed & (tree.n_child[below] > 0)
            for entry in zip((-mid - reach)[inner].tolist(), (mid - reach)[inner].tolist(), below[inner].tolist()):
                heapq.heappush(heap, entry)
            leaves = below[needed & ~inner]
        if len(leaves):
            size = tree.stop[leaves] - tree.start[leaves]
            at = np.repeat(tree.start[leaves] - np.cumsum(size) + size, size) + np.arange(size.sum())
            rows = tree.order[at]
            rows = rows[fits[rows]]
            taken += len(rows)
            windows.take(exact(q, tree.x[rows], norm), ids[rows])
    return taken


# ---- Spark ----------------------------------------------------------------

_TREE = ("dim int, tree string, ids array<long>, rids array<long>, labels array<long>, v array<int>, order array<int>, "
         "centre array<int>, radius array<double>, child array<int>, n_child array<int>, start array<int>, stop array<int>")
_NODES = ("centre", "radius", "child", "n_child", "start", "stop")
_FOUND = "anchor long, w int, score long, id long"


def whole(vector: Column) -> Column:
    """Components as floor(SCALE * x), of double x; NULL where the vector takes no part."""
    ok = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    c = F.transform(vector, lambda x: F.floor(F.lit(float(SCALE)) * x.cast("double")).cast("double"))
    norm = F.aggregate(c, F.lit(0.0), lambda a, x: a + x * x)
    # a NaN or infinite component casts to something wrong, but then ``ok`` is false
    return F.when(ok & (F.aggregate(vector, F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double") * SCALE**2) < 2.0**62)
                  & (norm < 2.0**62), F.transform(c, lambda x: x.cast("int")))


def flat(table: pa.Table | pa.RecordBatch, name: str) -> np.ndarray:
    column = table.column(name)
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False)


def prepared(rows: DataFrame) -> DataFrame:
    """(rid, id, label, dim, v) of the rows that take part, written once: ``rid`` tells repeated rows apart."""
    v = rows.select(F.col("id").cast("long").alias("id"), F.col("label").cast("long").alias("label"),
                    whole(F.col("vector")).alias("v"))
    kept = v.where("id IS NOT NULL AND label IS NOT NULL AND v IS NOT NULL")
    return rewritten(kept.select(F.monotonically_increasing_id().alias("rid"), "id", "label", F.size("v").alias("dim"), "v"),
                     "negatives-rows")


def pivots(rows: DataFrame) -> np.ndarray:
    """Up to PIVOTS rows far from each other, of a bounded sample of the vectors of the sample's first length."""
    few = rows.orderBy(F.xxhash64("rid"), "rid").limit(PIVOT_ROWS).select("v").collect()
    vectors = np.array([r["v"] for r in few if len(r["v"]) == len(few[0]["v"])], dtype=np.float64)
    chosen = vectors[:1]
    away = ((vectors - chosen[0]) ** 2).sum(axis=1) if len(vectors) else np.zeros(0)
    while len(chosen) < PIVOTS and away.max(initial=0.0) > 0:
        far = vectors[away.argmax()]
        chosen = np.vstack([chosen, far])
        away = np.minimum(away, ((vectors - far) ** 2).sum(axis=1))
    return chosen


def trees(rows: DataFrame) -> DataFrame:
    """One row for each cover tree of at most about TREE_ROWS rows, written once."""
    sent = rows.sparkSession.sparkContext.broadcast(pivots(rows))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = sent.value
        for batch in batches:
            cell = np.full(batch.num_rows, -1, dtype=np.int32)
            mine = np.flatnonzero(batch.column("dim").to_numpy() == p.shape[1]) if len(p) else np.zeros(0, int)
            if len(mine):
                x = flat(batch.take(pa.array(mine)), "v").reshape(len(mine), -1).astype(np.float64)
                cell[mine] = np.argmin((p**2).sum(axis=1) - 2 * x @ p.T, axis=1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell)], names=[*batch.schema.names, "cell"])

    placed = rewritten(rows.mapInArrow(place, "rid long, id long, label long, dim int, v array<int>, cell int"),
                       "negatives-cells")
    sizes = placed.groupBy("dim", "cell").agg(F.ceil(F.count(F.lit(1)) / TREE_ROWS).alias("parts"))
    cut = placed.join(sizes, ["dim", "cell"]).withColumn("part", F.pmod(F.xxhash64("rid"), F.col("parts")))

    def plant(key: tuple, table: pa.Table) -> pa.Table:
        dim = key[0].as_py()
        x = flat(table, "v").reshape(table.num_rows, dim)
        tree = CoverTree.build(x)
        one = {"dim": dim, "tree": "-".join(str(k.as_py()) for k in key), "ids": table.column("id").to_numpy(),
               "rids": table.column("rid").to_numpy(), "labels": table.column("label").to_numpy(), "v": x.ravel(),
               "order": tree.order} | {c: getattr(tree, c) for c in _NODES}
        kinds = {"radius": pa.float64(), "ids": pa.int64(), "rids": pa.int64(), "labels": pa.int64()}
        return pa.table({c: pa.array([v], pa.int32() if c == "dim" else pa.string()) if c in ("dim", "tree") else
                         pa.array([v.tolist()], pa.list_(kinds.get(c, pa.int32()))) for c, v in one.items()})

    return rewritten(cut.groupBy("dim", "cell", "part").applyInArrow(plant, _TREE), "negatives-trees")


def search(anchors: DataFrame, forest: DataFrame, k: int, same_label: bool) -> DataFrame:
    """(anchor, w, score, id, rank): for each anchor (rid, label, dim, v) and each of its ``windows`` (w, low, high) the k
    first other rows of the anchor's label, or of other labels, with a score in the window."""
    spark = anchors.sparkSession
    n_trees, n_anchors = forest.count(), anchors.count()
    slots = int(spark.conf.get("spark.sql.shuffle.partitions"))
    blocks = max(1, -(-n_anchors // ANCHOR_BLOCK))
    groups = max(1, -(-n_trees // GROUP_TREES), min(n_trees, slots // blocks))
    left = anchors.withColumn("block", F.pmod(F.xxhash64("rid"), F.lit(blocks)).cast("int")) \
        .withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    right = forest.withColumn("group", F.pmod(F.xxhash64("tree"), F.lit(groups)).cast("int")) \
        .withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def run(mine: pa.Table, wood: pa.Table) -> pa.Table:
        out: dict[str, list] = {"anchor": [], "w": [], "score": [], "id": []}
        mine_v, mine_windows = mine.column("v"), mine.column("windows")
        rids, labels, dims = (mine.column(c).to_pylist() for c in ("rid", "label", "dim"))
        open_windows = [[(w["w"], w["low"], w["high"]) for w in ws.as_py()] for ws in mine_windows]
        state = [Windows([w[1] for w in ws], [w[2] for w in ws], k) for ws in open_windows]
        for at in range(wood.num_rows):
            one = wood.slice(at, 1)
            dim = one.column("dim")[0].as_py()
            ids, tree_rids, tree_labels = (flat(one, c) for c in ("ids", "rids", "labels"))
            x = flat(one, "v").reshape(len(ids), dim).astype(np.float64)
            tree = CoverTree(x, {c: flat(one, c) for c in _NODES}, flat(one, "order"))
            longest = float(np.sqrt((x**2).sum(axis=1).max(initial=0.0)))
            of_label: dict[int, np.ndarray] = {}
            for i in range(len(rids)):
                if dims[i] != dim or not open_windows[i]:
                    continue
                if labels[i] not in of_label:
                    of_label[labels[i]] = (tree_labels == labels[i]) == same_label
                fits = of_label[labels[i]]
                if same_label:
                    fits = fits & (tree_rids != rids[i])
                q = np.array(mine_v[i].as_py(), dtype=np.float64)
                norm = longest * float(np.sqrt((q**2).sum()))
                descend(tree, q, norm, fits, ids, state[i])
        for i, ws in enumerate(open_windows):
            for (w, _, _), heap in zip(ws, state[i].found):
                for score, minus_id in heap:
                    for c, value in zip(out, (rids[i], w, score, -minus_id)):
                        out[c].append(value)
        return pa.table({c: pa.array(v, pa.int32() if c == "w" else pa.int64()) for c, v in out.items()})

    key = ["block", "group"]
    found = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(run, _FOUND)
    rank = F.row_number().over(Window.partitionBy("anchor", "w").orderBy(F.desc("score"), "id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k)


def hard_negatives(rows: DataFrame, anchor_every: int = ANCHOR_EVERY, n_positives: int = POSITIVES,
                   n_negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of a table (id, label, vector)."""
    rows = prepared(rows)
    forest = trees(rows)
    anchors = rows.where(F.col("id") % anchor_every == 0)
    everything = F.array(F.struct(F.lit(0).alias("w"), F.lit(-_ANY).alias("low"), F.lit(_ANY).alias("high")))
    positives = rewritten(search(anchors.withColumn("windows", everything), forest, n_positives, True), "negatives-positives")
    # low% * score <= 100% * negative <= high% * score, in whole numbers; decimals, as the products may pass a long
    p = F.col("score").cast("decimal(20,0)")
    ends = F.struct(F.col("rank").alias("w"), F.ceil(p * low / F.lit(100).cast("decimal(3,0)")).cast("long").alias("low"),
                    F.floor(p * high / F.lit(100).cast("decimal(3,0)")).cast("long").alias("high"))
    windows = positives.groupBy(F.col("anchor").alias("rid")).agg(F.sort_array(F.collect_list(ends)).alias("windows"))
    found = search(anchors.join(windows, "rid"), forest, n_negatives, False)
    named = positives.select("anchor", F.col("rank").alias("w"), F.col("id").alias("positive_id"),
                             F.col("score").alias("positive_score"))
    names = anchors.select(F.col("rid").alias("anchor"), F.col("id").alias("anchor_id"))
    return found.join(named, ["anchor", "w"]).join(names, "anchor").select(
        "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score",
        F.col("score").alias("negative_score"))


def negatives_report(embeddings: DataFrame) -> DataFrame:
    """Contract rows of op11: labels are shifted where the id is divisible by SHIFT_EVERY."""
    shifted = F.when(F.col("vec_id") % SHIFT_EVERY == 0, (F.col("label") + 1) % LABELS).otherwise(F.col("label"))
    return hard_negatives(embeddings.select(F.col("vec_id").alias("id"), shifted.alias("label"),
                                            F.col("embedding").alias("vector")))
