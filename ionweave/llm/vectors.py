"""Nearest neighbours with an inverted multi-index.

The two halves of a vector are quantised apart, each with its own ``k`` centroids, so ``k * k`` cells come from
``2 * k`` centroids.  A query walks the pairs of centroids in the order of their summed distance, with a heap,
until the cells it has met hold enough vectors.  These, and no others, are ranked by exact distance in double precision.

Centroids are fitted on at most ``sample`` vectors, taken in the order of a hash.  Every vector is
indexed.  The driver holds the centroids and the counts of the cells, both bounded by ``k``.  Cells are
put together into tiles of about ``tile`` vectors; a larger cell is split over several.  Queries meet a tile in one
task; if very many do, the tile is copied for parts of them.  No pair of vectors is ever a row: a task returns the best
``top`` of each query.  Of equal vectors only the ``top + 1`` smallest ids can be among
the nearest, so copies beyond that are left out before anything is compared, without a loss.

Defined results: rows whose vector is null, zero, of another length than most, or holds null or non-finite
components take no part, nor do rows without an id; rows equal in id and vector count once; other rows with the same id are
candidates of their own, also for each other, and each is searched for by itself; ties
go to the smaller id; with fewer candidates than ``top`` all are returned.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SAMPLE = 20_000
TILE = 8_192
MOST_CENTROIDS = 1_024

Stage = Callable[[DataFrame], DataFrame]


@dataclass
class Index:
    """Centroids of both halves and the number of vectors in each cell."""

    left: np.ndarray
    right: np.ndarray
    counts: np.ndarray
    tile_of: np.ndarray  # tile of each cell
    parts: np.ndarray  # tasks over which a cell's vectors are split

    @property
    def half(self) -> int:
        return self.left.shape[1]


def valid_vectors(table: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``vec_id`` and ``vector`` (doubles) of the rows that take part, each id once."""
    v = F.col("vector")
    rows = table.select(
        F.col(f"`{id_col}`").cast("long").alias("vec_id"), F.col(f"`{vector_col}`").cast("array<double>").alias("vector")
    )
    fine = rows.where(
        F.col("vec_id").isNotNull()
        & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists(v, lambda x: x != 0)
    )
    return fine.select("vec_id", "vector").distinct().withColumn("row", F.monotonically_increasing_id())


def _usual_length(rows: DataFrame) -> int | None:
    found = rows.groupBy(F.size("vector").alias("d")).count().orderBy(F.desc("count"), "d").first()
    return found["d"] if found else None


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of ``a`` to all of ``b``, for centroids only."""
    return np.maximum((a * a).sum(1)[:, None] - 2 * a @ b.T + (b * b).sum(1)[None], 0)


def kmeans(points: np.ndarray, k: int, rounds: int = 12, seed: int = 3) -> np.ndarray:
    """At most ``k`` centroids; starts from ``k`` of the points."""
    points = np.unique(points, axis=0)
    draws = np.random.default_rng(seed)
    centres = points[draws.permutation(len(points))[: min(k, len(points))]].copy()
    for _ in range(rounds):
        near = np.concatenate([_distances(points[i : i + 4096], centres).argmin(1) for i in range(0, len(points), 4096)])
        sums = np.zeros_like(centres)
        np.add.at(sums, near, points)
        n = np.bincount(near, minlength=len(centres))
        centres[n > 0] = sums[n > 0] / n[n > 0, None]
    return centres


def _vectors(column: pa.Array, size: int) -> np.ndarray:
    """An array column of equal lengths as a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, size)


def _cells(index_left: np.ndarray, index_right: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    half = index_left.shape[1]
    a = _distances(vectors[:, :half], index_left).argmin(1)
    b = _distances(vectors[:, half:], index_right).argmin(1)
    return a * len(index_right) + b


def fit(rows: DataFrame, n: int, size: int, sample: int, per_cell: int) -> tuple[np.ndarray, np.ndarray]:
    """Centroids of the two halves, from a bounded sample."""
    picked = rows.orderBy(F.xxhash64(F.lit(11), "vec_id"), "vec_id").limit(sample).select("vector").toPandas()
    points = np.array(picked["vector"].tolist(), np.float64).reshape(-1, size)
    k = int(min(MOST_CENTROIDS, max(2, round((n / per_cell) ** 0.5))))
    return kmeans(points[:, : size // 2], k), kmeans(points[:, size // 2 :], k)


def _tiles(counts: np.ndarray, tile: int) -> tuple[np.ndarray, np.ndarray]:
    """Tile of each cell, so that neighbours share one, and the parts of cells above a tile's size."""
    tile_of, number, held = np.zeros(len(counts), np.int64), 0, 0
    for cell, n in enumerate(counts.tolist()):
        if held and held + n > tile:
            number, held = number + 1, 0
        tile_of[cell], held = number, held + n
    return tile_of, np.maximum(1, -(-counts // tile))


def walk(vector: np.ndarray, index: Index, enough: int) -> list[int]:
    """Cells in the order of the summed distance of their centroids, until they hold ``enough`` vectors."""
    half = index.half
    a = ((index.left - vector[:half]) ** 2).sum(1)
    b = ((index.right - vector[half:]) ** 2).sum(1)
    by_a, by_b = a.argsort(kind="stable"), b.argsort(kind="stable")
    a, b, width = a[by_a], b[by_b], len(index.right)
    heap, met, held, out = [(a[0] + b[0], 0, 0)], {(0, 0)}, 0, []
    while heap and held < enough:
        _, i, j = heapq.heappop(heap)
        cell = int(by_a[i]) * width + int(by_b[j])
        if index.counts[cell]:
            out.append(cell)
            held += int(index.counts[cell])
        for x, y in ((i + 1, j), (i, j + 1)):
            if x < len(a) and y < len(b) and (x, y) not in met:
                met.add((x, y))
                heapq.heappush(heap, (a[x] + b[y], x, y))
    return out


def nearest(
    table: DataFrame,
    is_query: Callable[[Column], Column],
    stage: Stage,
    top: int = 10,
    visit: int = 1024,
    share: float = 0.35,
    per_cell: int = 3,
    sample: int = SAMPLE,
    tile: int = TILE,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """``query_id``, ``rank`` from 1, ``vec_id``, ``score`` of the nearest that were found for each query.

    ``is_query`` says by id which rows are queries; all rows but the query's own are candidates.  A query visits
    cells until they hold ``visit`` vectors or ``share`` of all, whichever is more.  Runs at once;
    ``stage`` stores a table.
    """
    spark = table.sparkSession
    rows = stage(valid_vectors(table, id_col, vector_col))
    size = _usual_length(rows)
    kind = "query_id long, rank int, vec_id long, score double"
    if size is None:
        return spark.createDataFrame([], kind)
    rows = rows.where(F.size("vector") == size)
    copies = Window.partitionBy("vector").orderBy("vec_id")  # ids of equal vectors differ
    unique = stage(rows.drop("row").withColumn("_n", F.row_number().over(copies)).where(F.col("_n") <= top + 1).drop("_n"))
    n = unique.count()
    left, right = fit(unique, n, size, sample, per_cell)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = _cells(left, right, _vectors(batch.column(1), size))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cells, pa.int64())], ["vec_id", "vector", "cell"])

    indexed = stage(unique.mapInArrow(place, "vec_id long, vector array<double>, cell long"))
    counts = np.zeros(len(left) * len(right), np.int64)
    for r in indexed.groupBy("cell").count().collect():  # at most one row per cell
        counts[r["cell"]] = r["count"]
    index = spark.sparkContext.broadcast(Index(left, right, counts, *_tiles(counts, tile)))
    enough = max(visit, int(share * n), top + 1)

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = index.value
        for batch in batches:
            who, tiles, part, walked = [], [], [], []
            for i, vector in enumerate(_vectors(batch.column(2), size)):
                found: dict[tuple[int, int], list[int]] = {}
                for cell in walk(vector, own, enough):
                    for p in range(int(own.parts[cell])):
                        found.setdefault((int(own.tile_of[cell]), p), []).append(cell)
                for (t, p), cells in sorted(found.items()):
                    who.append(i)
                    tiles.append(t)
                    part.append(p)
                    walked.append(sorted(cells))
            taken = pa.array(who, pa.int64())
            lists = pa.array(walked, pa.list_(pa.int64()))
            columns = [*(c.take(taken) for c in batch.columns), pa.array(tiles, pa.int64()), pa.array(part, pa.int64()), lists]
            yield pa.RecordBatch.from_arrays(columns, ["query", "query_id", "q", "tile", "part", "cells"])

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = index.value
        for batch in batches:
            cells = batch.column(2).to_numpy()
            part = batch.column(0).to_numpy() % own.parts[cells]
            columns = [*batch.columns, pa.array(own.tile_of[cells]), pa.array(part)]
            yield pa.RecordBatch.from_arrays(columns, ["vec_id", "vector", "cell", "tile", "part"])

    queries = rows.where(is_query(F.col("vec_id"))).select("row", "vec_id", "vector")
    asks = "query long, query_id long, q array<double>, tile long, part long, cells array<long>"
    probes = stage(queries.mapInArrow(probe, asks))
    tiles = indexed.mapInArrow(put, "vec_id long, vector array<double>, cell long, tile long, part long")
    copies_of = probes.groupBy("tile", "part").agg(F.ceil(F.count("*") / tile).alias("copies"))
    spread = tiles.join(copies_of, ["tile", "part"]).withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)))
    of = copies_of.select(F.col("tile").alias("t"), F.col("part").alias("p"), F.col("copies").alias("of"))
    asked = probes.join(of, (F.col("tile") == F.col("t")) & (F.col("part") == F.col("p")))
    asked = asked.select("query", "query_id", "q", "cells", F.col("t").alias("tile"), F.col("p").alias("part"), F.pmod(F.xxhash64("query"), "of").alias("copy"))
    spread = spread.select("vec_id", "vector", "cell", "tile", "part", "copy")
    keys = ("tile", "part", "copy")

    def rank(own: pd.DataFrame, ask: pd.DataFrame) -> pd.DataFrame:
        if not len(own) or not len(ask):
            return pd.DataFrame({"query": [], "query_id": [], "vec_id": [], "score": []})
        cells, ids = own["cell"].to_numpy(np.int64), own["vec_id"].to_numpy(np.int64)
        order = np.lexsort((ids, cells))
        cells, ids, vectors = cells[order], ids[order], np.array(own["vector"].tolist(), np.float64)[order]
        out = []
        for row, query, q, walked in zip(ask["query"].tolist(), ask["query_id"].tolist(), ask["q"], ask["cells"], strict=True):
            starts, ends = (np.searchsorted(cells, np.asarray(walked), side) for side in ("left", "right"))
            at = np.concatenate([np.arange(a, b) for a, b in zip(starts, ends, strict=True)])  # rows of the walked cells only
            q = np.asarray(q, np.float64)
            score = np.sqrt(((vectors[at] - q) ** 2).sum(1))
            own_row = (ids[at] == query) & (vectors[at] == q).all(axis=1)
            at, score = at[~own_row], score[~own_row]
            best = np.lexsort((ids[at], score))[:top]
            out += [(row, query, int(ids[at[i]]), float(score[i])) for i in best]
        return pd.DataFrame(out, columns=["query", "query_id", "vec_id", "score"])

    found = spread.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInPandas(rank, "query long, query_id long, vec_id long, score double")
    best = Window.partitionBy("query").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top).select("query_id", "rank", "vec_id", "score")
