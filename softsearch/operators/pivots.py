"""Exact top-k search with bounds: cells around pivots, and only cells that can matter.

Rows of the searched table belong to the cell of their nearest pivot; of a cell are known its
size, the largest distance of a row from its pivot and the largest squared norm. A query first
searches the nearest cells that hold ``k`` rows together, which gives a lower bound of its k-th
similarity, and then the cells that may hold rows as similar as that: for a row x of a cell with
pivot p, radius r and largest squared norm s

    q.x <= q.p + |q| r    and    q.x <= (|q|^2 + s - max(0, |q - p| - r)^2) / 2,

the second by the triangle inequality. Both hold for vectors of any length.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from softsearch.config import cut_lineage
from softsearch.operators.fcm import to_matrix
from softsearch.operators.similarity import best_pairs, similarity_pairs, similarity_topk

#: rows per pivot aimed at
CELL_ROWS = 512
#: pivots at most: their vectors, and a row of distances to them per query, go to every task
MAX_PIVOTS = 4096
#: similarities are compared at 9 decimals, so a bound has to be exceeded by more than that
SLACK = 1e-8


#: rows whose distances to all pivots are held at a time
BLOCK = 512


def distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    squares = (x * x).sum(axis=1)[:, None] + (pivots * pivots).sum(axis=1)[None, :] - 2.0 * (x @ pivots.T)
    return np.sqrt(np.maximum(squares, 0.0))


def nearest_row(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """For each of ``x`` the number of its nearest pivot, block by block."""
    blocks = [distances(x[i : i + BLOCK], pivots).argmin(axis=1) for i in range(0, len(x), BLOCK)]
    return np.concatenate(blocks) if blocks else np.zeros(0, np.int64)


@dataclass(frozen=True)
class Cells:
    """Pivots and what is known of their cells."""

    pivots: np.ndarray
    size: np.ndarray
    radius: np.ndarray
    square: np.ndarray

    def nearest(self, x: np.ndarray, k: int) -> list[np.ndarray]:
        """For each query the nearest cells that hold ``k`` rows together."""
        order = np.argsort(distances(x, self.pivots), axis=1, kind="stable")
        enough = (np.cumsum(self.size[order], axis=1) < k).sum(axis=1) + 1
        return [np.sort(o[:n]) for o, n in zip(order, enough)]

    def nearest_pivot(self, x: np.ndarray) -> np.ndarray:
        return nearest_row(x, self.pivots)

    def possible(self, x: np.ndarray, floor: np.ndarray) -> np.ndarray:
        """Which cells may hold rows at least as similar as ``floor`` to each query."""
        squares = (x * x).sum(axis=1)[:, None]
        away = np.maximum(distances(x, self.pivots) - self.radius, 0.0)
        bound = np.minimum(x @ self.pivots.T + np.sqrt(squares) * self.radius, (squares + self.square - away * away) / 2)
        low = np.where(np.isnan(floor), -np.inf, floor)[:, None]
        return (bound + SLACK >= low) & (self.size > 0)

    def keys(self, df: DataFrame) -> DataFrame:
        """Rows of the searched side with the name of their cell in ``keys``."""
        nearest = self.nearest_pivot

        @F.arrow_udf(T.ArrayType(T.StringType()))
        def cell(vec: pa.Array) -> pa.Array:
            at = nearest(to_matrix(vec))
            names = pa.array(at).cast(pa.string())
            return pa.ListArray.from_arrays(pa.array(np.arange(len(at) + 1), pa.int32()), names)

        return df.withColumn("keys", cell("vec"))


def make_cells(rows: DataFrame, n_pivots: int | None = None) -> Cells | None:
    """Cells of ``rows(id, vec)``; None where there are no rows. The pivots are rows chosen by a
    hash of their id, one for ``CELL_ROWS`` rows and ``MAX_PIVOTS`` at most; all rows count for
    sizes and radii, summed in tasks."""
    n = rows.count()
    if n == 0:
        return None
    wanted = n_pivots or min(MAX_PIVOTS, -(-n // CELL_ROWS))
    chosen = rows.select(F.xxhash64("id").alias("h"), "id", "vec").orderBy("h", "id").limit(wanted).collect()
    pivots = np.unique(np.array([r.vec for r in chosen], dtype=np.float64), axis=0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size, radius, square = np.zeros(len(pivots), int), np.zeros(len(pivots)), np.zeros(len(pivots))
        for batch in batches:
            whole = to_matrix(batch.column(0))
            for start in range(0, len(whole), BLOCK):
                x = whole[start : start + BLOCK]
                d = distances(x, pivots)
                at = d.argmin(axis=1)
                size += np.bincount(at, minlength=len(pivots))
                np.maximum.at(radius, at, d[np.arange(len(x)), at])
                np.maximum.at(square, at, (x * x).sum(axis=1))
        at = np.flatnonzero(size)
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in (at, size[at], radius[at], square[at])], names=["cell", "n", "r", "s"])

    parts = rows.select("vec").mapInArrow(run, "cell long, n long, r double, s double")
    known = parts.groupBy("cell").agg(F.sum("n").alias("n"), F.max("r").alias("r"), F.max("s").alias("s")).collect()
    size, radius, square = (np.zeros(len(pivots)) for _ in range(3))
    for c in known:
        size[c.cell], radius[c.cell], square[c.cell] = c.n, c.r + SLACK, c.s
    return Cells(pivots, size, radius, square)


def _visits(left: DataFrame, cells: Cells, k: int) -> DataFrame:
    """The queries with the nearest cells that hold ``k`` rows, which they search first."""

    @F.arrow_udf(T.ArrayType(T.StringType()))
    def names(vec: pa.Array) -> pa.Array:
        x, found = to_matrix(vec), []
        for i in range(0, len(x), BLOCK):
            found += cells.nearest(x[i : i + BLOCK], k)
        return pa.array([[str(c) for c in row] for row in found], pa.list_(pa.string()))

    return left.withColumn("keys", names("vec")).select("id", "vec", "ord", "keys")


def bounded_pairs(left: DataFrame, right: DataFrame, k: int, cells: Cells | None = None, **join_options) -> DataFrame:
    """As ``similarity_pairs`` over all pairs, the columns ``keys`` of both sides not read. Both
    sides are read several times: give rows that are stored or cheap to compute.

    Which cells a query has to search is found inside the task that holds it, for a block of
    queries at a time, so it takes no memory and is not shuffled: where no bound helps, all
    pairs are compared, block by block."""
    left, right = left.select("id", "vec", "ord"), right.select("id", "vec", "ord")
    cells = cells or make_cells(right)
    options = {"prefer_small": "left", "unique_pairs": True, **join_options}
    if cells is None:
        none = F.array().cast("array<string>")
        return similarity_pairs(left.withColumn("keys", none), right.withColumn("keys", none), k, **options)
    filed = cells.keys(right).select("id", "vec", "ord", "keys")
    first = similarity_topk(_visits(left, cells, k), filed, k, **options)
    floors = first.where(F.col("rank") == k).select(F.col("left_id").alias("id"), F.col("similarity").alias("bound"))
    one = F.array(F.lit("")).alias("keys")
    bounded = cut_lineage(left.join(floors, "id", "left").select("id", "vec", "ord", one, "bound"))
    filed = filed.select("id", "vec", "ord", one, F.get("keys", F.lit(0)).cast("double").alias("bound"))
    return similarity_pairs(bounded, filed, k, cells=cells, **options)


def bounded_topk(left: DataFrame, right: DataFrame, k: int, cells: Cells | None = None, **join_options) -> DataFrame:
    """The pairs of ``bounded_pairs``, ranked."""
    return best_pairs(bounded_pairs(left, right, k, cells, **join_options), k, unique_pairs=True)
