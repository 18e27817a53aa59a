"""Approximate nearest neighbours by an inverted multi-index.

Both halves of the vectors have a codebook of their own, fitted on a bounded sample; a vector's cell is
the pair of its halves' nearest centroids. A query visits cells by the sum of its halves' squared
distances to the centroids, lowest first: a heap holds the next pair of each row that has been begun.
It ends when the cells visited hold ``share`` of all different vectors, and all their entries are ranked
by exact distance.

Every row is indexed. Rows of the index (one centroid of the first half) are dealt out in pieces of
about PIECE_ROWS, and queries in blocks of about BLOCK_QUERIES, so a common vector or cell is spread
over tasks and none holds more. What the driver gets is bounded: the sample, K * K counts.

How large a share is needed depends on the data: independent random directions need about half for a
recall of 0.9, clustered vectors far less.

Cases: vectors that are null, zero, hold null or non-finite components, or have another length than
most (of equally common lengths the shorter counts) take no part, nor do rows with null ids; repeated
rows are candidates each; rows with equal query id and vector are one query, whose own row is the first of
them, so the others are found; one query id with several vectors is a query each, ranked apart; ties go to the smaller id; an empty table gives none; extra columns are left out.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from shopfloor.llm.text import saved

SAMPLE_ROWS = 8192
CENTROIDS = 64
ROWS_PER_CENTROID = 16
PIECE_ROWS, BLOCK_QUERIES = 16_384, 4_096
SHARE = 0.6
ROUNDS = 12


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id and vec of the rows that take part."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").alias("vec"))
    finite = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.where(F.col("vec_id").isNotNull() & finite & F.exists("vec", lambda x: x != 0))
    sizes = rows.groupBy(F.size("vec").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).collect()
    return rows.where(F.size("vec") == (sizes[0]["n"] if sizes else 0))


def fit(points: np.ndarray, k: int, seed: int) -> np.ndarray:
    """k-means of a bounded sample."""
    points = np.unique(points, axis=0)
    start = np.random.default_rng(seed).choice(len(points), min(k, len(points)), replace=False)
    centers = points[np.sort(start)].astype(np.float64)
    for _ in range(ROUNDS):
        near = squared(points, centers).argmin(1)
        for c in range(len(centers)):
            if (near == c).any():
                centers[c] = points[near == c].mean(0)
    return centers


def squared(points: np.ndarray, centers: np.ndarray) -> np.ndarray:
    """Squared distances, but for what is the same for all centers of a point."""
    return (centers**2).sum(1) - 2 * points @ centers.T


def matrix(column: pa.Array) -> np.ndarray:
    return np.array(column.flatten()).reshape(len(column), -1).astype(np.float64)


def halves(points: np.ndarray, books: tuple) -> tuple[np.ndarray, np.ndarray]:
    cut = books[0].shape[1]
    return squared(points[:, :cut], books[0]), squared(points[:, cut:], books[1])


def assigned(rows: DataFrame, books: tuple) -> DataFrame:
    def near(batches):
        for batch in batches:
            if batch.num_rows:
                a, b = halves(matrix(batch.column("vec")), books)
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(a.argmin(1), pa.int32()), pa.array(b.argmin(1), pa.int32())],
                    [*batch.schema.names, "i", "j"])

    kind = rows.schema["vec"].dataType.simpleString()
    return rows.withColumn("row", F.monotonically_increasing_id()).mapInArrow(
        near, f"vec_id long, vec {kind}, row long, i int, j int")


def visited(a: np.ndarray, b: np.ndarray, counts: np.ndarray, enough: float) -> np.ndarray:
    """Which cells a query visits, by its halves' distances to the centroids and the cells' counts."""
    first, second = np.argsort(a, kind="stable"), np.argsort(b, kind="stable")
    x, y, n = a[first].tolist(), b[second].tolist(), counts[first][:, second].tolist()
    out = np.zeros(counts.shape, bool)
    heap, found = [(x[0] + y[0], 0, 0)], 0
    chosen = []
    while heap and found < enough:
        _, i, j = heapq.heappop(heap)
        chosen.append((i, j))
        found += n[i][j]
        if j + 1 < len(y):
            heapq.heappush(heap, (x[i] + y[j + 1], i, j + 1))
        if j == 0 and i + 1 < len(x):
            heapq.heappush(heap, (x[i + 1] + y[0], i + 1, 0))
    at = np.array(chosen).reshape(-1, 2)
    out[first[at[:, 0]], second[at[:, 1]]] = True
    return out


def search(vectors: DataFrame, is_query: Column, k: int = 10, share: float = SHARE) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` nearest found of each row that is a query (``is_query``,
    on vec_id), among all other rows."""
    rows = usable(vectors)
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE_ROWS).select("vec").collect()
    if not sample:
        return rows.select(F.col("vec_id").alias("query_id"), F.lit(1).alias("rank"), "vec_id", F.lit(0.0).alias("score"))
    points = np.array([r["vec"] for r in sample], np.float64)
    cut, size = points.shape[1] // 2, max(1, min(CENTROIDS, len(points) // ROWS_PER_CENTROID))
    books = fit(points[:, :cut], size, 1), fit(points[:, cut:], size, 2)

    index = saved(assigned(rows, books))
    counts, in_row = np.zeros((len(books[0]), len(books[1])), np.int64), np.zeros(len(books[0]), np.int64)
    for r in index.groupBy("i", "j").agg(F.countDistinct(F.xxhash64("vec")).alias("n"), F.count(F.lit(1)).alias("all")).collect():
        counts[r["i"], r["j"]] = r["n"]
        in_row[r["i"]] += r["all"]
    pieces = np.maximum(1, -(-in_row // PIECE_ROWS))
    queries = saved(index.where(is_query).groupBy("vec_id", "vec").agg(F.min("row").alias("row")))
    blocks = max(1, -(-queries.count() // BLOCK_QUERIES))
    enough = share * counts.sum()

    kind = rows.schema["vec"].dataType.simpleString()
    names = ["i", "piece", "block", "query", "query_id", "vec", "cells"]

    def probe(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            a, b = halves(matrix(batch.column("vec")), books)
            block = batch.column("block").to_pylist()
            for q in range(batch.num_rows):
                cells = visited(a[q], b[q], counts, enough)
                to = [(i, p) for i in np.flatnonzero(cells.any(1)) for p in range(pieces[i])]
                n = len(to)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([i for i, _ in to], pa.int32()), pa.array([p for _, p in to], pa.int32()),
                     pa.array([block[q]] * n, pa.int32()), batch.column("row").take(pa.array([q] * n, pa.int32())), batch.column("vec_id").take(pa.array([q] * n, pa.int32())),
                     batch.column("vec").take(pa.array([q] * n, pa.int32())),
                     pa.array([np.packbits(cells[i]).tobytes() for i, _ in to], pa.binary())], names)

    block = F.pmod(F.xxhash64(F.lit("block"), "row"), F.lit(blocks)).cast("int")
    probes = queries.withColumn("block", block).mapInArrow(
        probe, f"i int, piece int, block int, query long, query_id long, vec {kind}, cells binary")
    of_row = F.element_at(F.array(*(F.lit(int(p)) for p in pieces)), F.col("i") + 1)
    entries = index.withColumn("piece", F.pmod(F.xxhash64("row"), of_row).cast("int")).withColumn(
        "block", F.explode(F.sequence(F.lit(0), F.lit(int(blocks - 1)))))
    key = ["i", "piece", "block"]

    def rank(left: pa.Table, right: pa.Table) -> pa.Table:
        out = [(), (), (), ()]
        if left.num_rows and right.num_rows:
            points, ids = matrix(left.column("vec").combine_chunks()), left.column("vec_id").to_numpy()
            second, own = left.column("j").to_numpy(), left.column("row").to_numpy()
            targets = matrix(right.column("vec").combine_chunks())
            owners, names = right.column("query").to_numpy(), right.column("query_id").to_numpy()
            found = []
            for q, cells in enumerate(right.column("cells").to_pylist()):
                here = np.unpackbits(np.frombuffer(cells, np.uint8))[second].astype(bool) & (own != owners[q])
                away = points[here] - targets[q]
                score = np.sqrt((away * away).sum(1))
                best = np.lexsort((ids[here], score))[:k]
                found.append((np.full(len(best), owners[q]), np.full(len(best), names[q]), ids[here][best], score[best]))
            out = [np.concatenate(x) for x in zip(*found, strict=True)]
        return pa.table([*(pa.array(x, pa.int64()) for x in out[:3]), pa.array(out[3], pa.float64())],
                        ["query", "query_id", "vec_id", "score"])

    near = entries.groupBy(*key).cogroup(probes.groupBy(*key)).applyInArrow(
        rank, "query long, query_id long, vec_id long, score double")
    order = Window.partitionBy("query").orderBy("score", "vec_id")
    return near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")
