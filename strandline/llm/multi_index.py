"""Approximate nearest neighbours with an inverted multi-index.

Each vector is split into two halves; each half is quantised by its own k-means
codebook, and the pair of centroids is the vector's cell. A query visits the
centroid pairs in order of summed distance (a heap yields them one at a time)
until the visited cells hold enough rows; their entries are reranked by exact
distance. Every row is indexed; only the codebooks come from a sample.

How many rows are enough is measured, not guessed: a bounded set of queries is
compared with all rows in blocks, and the number is taken at which their recall
reaches ``TARGET_RECALL``. On data without structure this is a large share of
the table, on clustered data a small one.

Cells are laid end to end and cut into lanes of about ``LANE_ROWS`` rows: a
lane holds several small cells, and a cell that holds a third of the table
spans many lanes and is searched by many tasks. A lane meets the queries that
visit one of its cells and gives each its k nearest among the rows of these
cells; no pair leaves a lane else.

Defined results: vectors that are NULL, zero, or hold NULL, NaN or infinite
components, and rows with a NULL vec_id, take no part. There is no distance
between vectors of two lengths, so each length is an index of its own. A row
that repeats both vec_id and vector counts once; rows with one vec_id and
several vectors are several rows: each is a candidate of the others, and each
whose vec_id is a query's has its own k results. Ties go to the smaller
vec_id. Extra columns are ignored. An empty table, or one without queries,
gives no rows. Jobs run when ``search`` is called.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandline.llm.common import bounded_batches, rewritten
from strandline.operators._util import global_row_number

K = 10
QUERY_EVERY = 100
#: Rows from which the codebooks are fitted, at most.
TRAIN_ROWS = 20_000
#: Queries whose recall is measured, at most, and the recall to reach on them.
PROBE_QUERIES, TARGET_RECALL = 128, 0.96
#: Rows wanted in a cell, and the most centroids of a half.
CELL_ROWS, MAX_CENTROIDS = 128, 1024
LANE_ROWS = 512
#: Queries that meet a lane in one task, and rows of a brute-force block.
QUERY_BLOCK, BLOCK_ROWS = 4096, 256
SEED = 11

_FOUND = "query_id long, vec_id long, score double"


def usable(vector: Column) -> Column:
    ok = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(ok & F.exists(vector, lambda x: x != 0), F.lit(False))


def matrix(column: pa.Array | pa.ChunkedArray, dim: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim).astype(np.float64)


def nearest_centroids(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    out = np.empty(len(x), dtype=np.int64)
    norm = (centroids**2).sum(axis=1)
    for at in range(0, len(x), 4096):
        out[at:at + 4096] = np.argmin(norm - 2 * x[at:at + 4096] @ centroids.T, axis=1)
    return out


def fit_codebook(x: np.ndarray, k: int, seed: int, rounds: int = 12) -> np.ndarray:
    """Lloyd's k-means from distinct rows; a centroid that loses all rows keeps its place."""
    start = np.unique(x, axis=0)
    start = start[np.random.default_rng(seed).permutation(len(start))[:k]]
    for _ in range(rounds):
        cell = nearest_centroids(x, start)
        count = np.bincount(cell, minlength=len(start))
        total = np.zeros_like(start)
        np.add.at(total, cell, x)
        start = np.where(count[:, None] > 0, total / np.maximum(count, 1)[:, None], start)
    return start


def traverse(a: np.ndarray, b: np.ndarray) -> Iterator[tuple[int, int]]:
    """Pairs (i, j) by a[i] + b[j], smallest first, each once; O(log n) a pair."""
    by_a, by_b = np.argsort(a, kind="stable"), np.argsort(b, kind="stable")
    sa, sb = a[by_a].tolist(), b[by_b].tolist()
    heap = [(sa[0] + sb[0], 0, 0)]
    while heap:
        _, i, j = heapq.heappop(heap)
        yield int(by_a[i]), int(by_b[j])
        if j + 1 < len(sb):
            heapq.heappush(heap, (sa[i] + sb[j + 1], i, j + 1))
        if j == 0 and i + 1 < len(sa):
            heapq.heappush(heap, (sa[i + 1] + sb[0], i + 1, 0))


class Codebooks:
    """Two codebooks and the row count of every cell; at most 2 * MAX_CENTROIDS centroids and their pairs."""

    def __init__(self, first: np.ndarray, second: np.ndarray):
        self.first, self.second, self.counts = first, second, np.zeros(len(first) * len(second), dtype=np.int64)
        self.half, self.dim = first.shape[1], first.shape[1] + second.shape[1]

    def cells(self, x: np.ndarray) -> np.ndarray:
        return nearest_centroids(x[:, :self.half], self.first) * len(self.second) \
            + nearest_centroids(x[:, self.half:], self.second)

    def order(self, query: np.ndarray) -> Iterator[int]:
        a = ((self.first - query[:self.half]) ** 2).sum(axis=1)
        b = ((self.second - query[self.half:]) ** 2).sum(axis=1)
        for i, j in traverse(a, b):
            yield i * len(self.second) + j

    def close(self) -> None:
        """Lay the cells end to end, once their counts are known."""
        self.starts = np.cumsum(self.counts) - self.counts

    def lanes(self, cell: int) -> range:
        """The lanes that a non-empty cell spans."""
        start = int(self.starts[cell])
        return range(start // LANE_ROWS, (start + int(self.counts[cell]) - 1) // LANE_ROWS + 1)

    def lane_of(self, cell: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """The lane of each row: its cell's rows are spread over the cell's length by a hash of their id."""
        spread = (ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(20)).astype(np.int64)
        return (self.starts[cell] + spread % np.maximum(1, self.counts[cell])) // LANE_ROWS

    def visit(self, query: np.ndarray, rows: int) -> list[int]:
        """The cells that a query visits: non-empty ones until they hold ``rows`` rows."""
        out, seen = [], 0
        for cell in self.order(query):
            if seen >= rows:
                break
            if self.counts[cell]:
                out.append(cell)
                seen += int(self.counts[cell])
        return out


def top_rows(queries: np.ndarray, query_ids: np.ndarray, rows: np.ndarray, ids: np.ndarray, k: int,
             cell: np.ndarray | None = None, visited: list[list[int]] | None = None):
    """Per query the k nearest of a block of rows by (distance, id): (query index, row index, distance). Left out are
    the query itself and, if cells are given, rows of cells that the query does not visit."""
    by_id = np.argsort(ids, kind="stable")
    rows, ids = rows[by_id], ids[by_id]
    cell = None if cell is None else cell[by_id]
    found = []
    step = max(1, (1 << 21) // max(1, rows.size))
    for at in range(0, len(queries), step):
        d = np.sqrt(((queries[at:at + step, None, :] - rows[None, :, :]) ** 2).sum(axis=2))
        d[query_ids[at:at + step, None] == ids[None, :]] = np.inf
        if cell is not None:
            for i, cells in enumerate(visited[at:at + step]):
                d[i, ~np.isin(cell, cells)] = np.inf
        near = np.argsort(d, axis=1, kind="stable")[:, :k]
        q = np.repeat(np.arange(at, at + len(d)), near.shape[1])
        score = np.take_along_axis(d, near, axis=1).ravel()
        ok = np.isfinite(score)
        found.append((q[ok], by_id[near.ravel()[ok]], score[ok]))
    return tuple(np.concatenate(c) for c in zip(*found))


# ---- Spark ----------------------------------------------------------------

def best(found: DataFrame, k: int) -> DataFrame:
    """The k nearest of each query's findings; ranks are cut before the shuffle too."""
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k)


def brute_force(vectors: DataFrame, queries: list[tuple[int, list[float]]], dim: int, k: int) -> DataFrame:
    """Exact neighbours of a bounded list of queries, which is sent to all tasks."""
    sent = vectors.sparkSession.sparkContext.broadcast(
        (np.array([q[0] for q in queries]), np.array([q[1] for q in queries], dtype=np.float64)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        query_ids, q = sent.value
        for batch in batches:
            if not batch.num_rows:
                continue
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            x = matrix(batch.column(1), dim)
            for at in range(0, len(x), BLOCK_ROWS):
                i, j, score = top_rows(q, query_ids, x[at:at + BLOCK_ROWS], ids[at:at + BLOCK_ROWS], k)
                yield pa.RecordBatch.from_arrays([pa.array(query_ids[i]), pa.array(ids[at:at + BLOCK_ROWS][j]),
                                                  pa.array(score)], names=["query_id", "vec_id", "score"])

    return best(vectors.select("vec_id", "v").mapInArrow(run, _FOUND), k)


def prepared(embeddings: DataFrame) -> tuple[DataFrame, dict[int, int]]:
    """Usable vectors (vec_id, v, id), written once, and how many there are of each length. ``vec_id`` is the row's own number,
    in the order of the table's ids, and ``id`` its id in the table."""
    v = embeddings.where(F.col("vec_id").isNotNull() & usable(F.col("embedding"))) \
        .select(F.col("vec_id").cast("long").alias("id"), F.col("embedding").cast("array<double>").alias("v")).distinct()
    rows = global_row_number(v, [F.col("id"), F.xxhash64("v")], name="vec_id").select("vec_id", "v", "id")
    return rows, {r["dim"]: r["count"] for r in rows.groupBy(F.size("v").alias("dim")).count().collect()}  # a row a length


def build(vectors: DataFrame, dim: int, n: int, train_rows: int = TRAIN_ROWS) -> tuple[Codebooks, DataFrame]:
    """Codebooks from a bounded sample, and every vector with its cell, written once."""
    unit = F.xxhash64("vec_id", F.lit(SEED)).cast("double") / 2.0**64 + 0.5
    few = vectors.where(unit <= min(1.0, 0.95 * train_rows / n)).select("v").limit(train_rows).toArrow()
    sample = matrix(few.column(0), dim)
    sample = sample[np.lexsort(sample.T[::-1])]  # the same order whatever the tasks' order
    k = max(1, min(MAX_CENTROIDS, int(math.sqrt(n / CELL_ROWS))))
    half = max(1, dim // 2)
    books = Codebooks(fit_codebook(sample[:, :half], k, SEED),
                      fit_codebook(sample[:, half:], k, SEED + 1) if dim > 1 else np.zeros((1, 0)))
    sent = vectors.sparkSession.sparkContext.broadcast(books)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cell = sent.value.cells(matrix(batch.column(1), dim)) if batch.num_rows else np.array([], dtype=np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell, pa.int64())], names=[*batch.schema.names, "cell"])

    entries = rewritten(vectors.mapInArrow(place, "vec_id long, v array<double>, id long, cell long"), "ann-cells")
    for row in entries.groupBy("cell").count().collect():  # one row a cell, at most MAX_CENTROIDS squared
        books.counts[row["cell"]] = row["count"]
    return books, entries


def calibrated_rows(books: Codebooks, entries: DataFrame, queries: DataFrame, k: int = K,
                    target: float = TARGET_RECALL) -> int:
    """Rows that a query must visit for ``target`` recall, measured on at most PROBE_QUERIES queries."""
    few = queries.orderBy(F.xxhash64("vec_id", F.lit(SEED + 1)), "vec_id").limit(PROBE_QUERIES) \
        .select("vec_id", "v").collect()
    if not few:
        return 0
    exact = brute_force(entries, [(r["vec_id"], r["v"]) for r in few], books.dim, k)
    home = entries.select("vec_id", "cell").join(F.broadcast(exact.select("query_id", "vec_id")), "vec_id")
    needed = []
    cells: dict[int, list[int]] = {}
    for row in home.select("query_id", "cell").collect():  # at most PROBE_QUERIES * k rows
        cells.setdefault(row["query_id"], []).append(row["cell"])
    for r in few:
        wanted, seen = cells.get(r["vec_id"], []), 0
        left = set(wanted)
        for cell in books.order(np.array(r["v"], dtype=np.float64)) if left else ():
            # a cell is visited as long as the rows before it do not suffice
            needed += [seen + 1] * (wanted.count(cell) if cell in left else 0)
            left.discard(cell)
            seen += int(books.counts[cell])
            if not left:
                break
    if not needed:
        return 1
    needed.sort()
    return needed[min(len(needed) - 1, math.ceil(target * len(needed)) - 1)]


def search(embeddings: DataFrame, k: int = K, query_every: int = QUERY_EVERY, rows: int | None = None) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of every row whose id is divisible by ``query_every``."""
    bounded_batches(embeddings.sparkSession)
    vectors, lengths = prepared(embeddings)
    out = embeddings.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    for i, (dim, n) in enumerate(sorted(lengths.items())):
        found = search_length(vectors.where(F.size("v") == dim), dim, n, k, query_every, rows)
        out = out.unionByName(found) if i else found
    return out


def search_length(vectors: DataFrame, dim: int, n: int, k: int, query_every: int, rows: int | None) -> DataFrame:
    """:func:`search` among the ``n`` prepared vectors of one length."""
    spark = vectors.sparkSession
    books, entries = build(vectors, dim, n)
    queries = entries.where(F.col("id") % query_every == 0)
    enough = rows or max(k + 1, calibrated_rows(books, entries, queries, k))
    books.close()
    sent = spark.sparkContext.broadcast(books)

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = sent.value
        for batch in batches:
            if not batch.num_rows:
                continue
            for i, q in enumerate(matrix(batch.column(1), dim)):
                by_lane: dict[int, list[int]] = {}
                for cell in books.visit(q, enough):
                    for lane in books.lanes(cell):
                        by_lane.setdefault(lane, []).append(cell)
                m = len(by_lane)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(by_lane), pa.int64()), pa.array([batch.column(0)[i].as_py()] * m, pa.int64()),
                     pa.ListArray.from_arrays(np.arange(m + 1, dtype=np.int32) * dim, pa.array(np.tile(q, m))),
                     pa.array(list(by_lane.values()), pa.list_(pa.int64()))], names=["lane", "query_id", "q", "cells"])

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, cell = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 2))
            yield pa.RecordBatch.from_arrays([pa.array(sent.value.lane_of(cell, ids)), *batch.columns],
                                             names=["lane", "vec_id", "v", "cell"])

    probes = rewritten(queries.select("vec_id", "v").mapInArrow(
        visit, "lane long, query_id long, q array<double>, cells array<long>"), "ann-probes")
    dealt = entries.select("vec_id", "v", "cell").mapInArrow(deal, "lane long, vec_id long, v array<double>, cell long")
    # a lane that very many queries visit is searched in parts, its rows once in each
    parts = probes.groupBy("lane").agg(F.ceil(F.count(F.lit(1)) / QUERY_BLOCK).cast("int").alias("parts"))
    probes = probes.join(parts, "lane").withColumn("part", F.pmod(F.hash("query_id"), F.col("parts"))).drop("parts")
    dealt = dealt.join(parts, "lane").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts")

    def rerank(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return pa.table({"query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()),
                             "score": pa.array([], pa.float64())})
        query_ids, ids, cell = (t.column(c).to_numpy() for t, c in
                                ((left, "query_id"), (right, "vec_id"), (right, "cell")))
        i, j, score = top_rows(matrix(left.column("q"), dim), query_ids, matrix(right.column("v"), dim), ids, k,
                               cell, left.column("cells").to_pylist())
        return pa.table({"query_id": query_ids[i], "vec_id": ids[j], "score": score})

    key = ["lane", "part"]
    found = probes.groupBy(*key).cogroup(dealt.groupBy(*key)).applyInArrow(rerank, _FOUND)
    ids = entries.select(F.col("vec_id").alias("row"), "id")
    asked, near = ids.toDF("query_id", "_asked"), ids.toDF("vec_id", "_near")
    return best(found, k).join(asked, "query_id").join(near, "vec_id").select(
        F.col("_asked").alias("query_id"), "rank", F.col("_near").alias("vec_id"), "score")
