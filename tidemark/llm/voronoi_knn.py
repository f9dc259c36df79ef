"""Exact top-k search by inner product, as a k-nearest-neighbour join over Voronoi cells in two steps.

A bounded number of vectors serve as pivots. Every vector belongs to the cell of its nearest pivot p, at a distance d
that is stored with it. A cell is summed up by its number of vectors, its largest d and its k + 1 smallest, and its
least and greatest length. First each query is solved exactly in one cell, the one whose pivot suits it best; its k-th
score there is a score that its k-th best of all cannot fall below. (A cell of fewer than k others gives none; then
<q, x> >= <q, p> - |q| d over all summaries does.) With |q - x| >= |q - p| - d, and the greatest length of a cell, each
cell gets a score that none of its vectors can exceed for that query. In the second step a query is replicated only to
other cells that can still hold one of its k best. Cells are cut into blocks and the queries of a cell into chunks, both
of bounded size, so one large cell is many tasks; each block is solved on its own with whole-number scores, and the
partial results of a query meet in one ranking.

Components become floor(scale * x). Sums are exact: 32-bit floats are used where no score can leave their whole
numbers, else 64-bit floats, else 64-bit integers.

Defined results: vectors that are null, empty, or hold a null or non-finite component take no part, as queries or
candidates. Shorter vectors count as padded with zeros. Equal scores go by smaller id, null ids last; repeated
rows are candidates each, and only a query's own row is left out. Null ids are never queries. An empty table gives
an empty result. Extra columns play no part.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cached_property
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import kept, pick

MOST_PIVOTS = 1_024       # they and the summaries are broadcast: some hundred bytes and one vector each
ROWS_PER_PIVOT = 2_000
BLOCK_ROWS = 20_000
CHUNK_QUERIES = 4_000
BOUND_QUERIES = 64         # queries whose bounds are computed at a time
_NO_ID = np.iinfo(np.int64).max


def quantized(vectors: DataFrame, scale: int, is_query: Column) -> DataFrame:
    """row, vec_id, is_query, n (components) and the whole-number components of vectors that take part."""
    usable = vectors.filter(F.coalesce(F.size("vector") > 0, F.lit(False))).filter(F.forall(
        "vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf"))))
    return usable.select(
        F.monotonically_increasing_id().alias("row"), F.col("vec_id").cast("long").alias("vec_id"),
        F.coalesce(is_query, F.lit(False)).alias("is_query"), F.size("vector").alias("n"),
        F.transform("vector", lambda x: F.floor(x.cast("double") * scale).cast("long")).alias("vector"))


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    out = np.zeros((len(lists), size), np.float64)
    lengths = np.diff(lists.offsets.to_numpy())
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    row = np.repeat(np.arange(len(lists)), lengths)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = flat
    return out


def _placed(rows: DataFrame, pivots, size: int) -> DataFrame:
    """Adds the cell, the distance to its pivot (rounded up) and the length of each vector."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = pivots.value
        for batch in batches:
            x = _matrix(batch.column("vector"), size)
            square = (x * x).sum(axis=1)
            apart = np.maximum(0, square[:, None] - 2 * x @ p.T + (p * p).sum(axis=1)[None, :])
            cell = apart.argmin(axis=1)
            # the chosen distance anew, without the cancellation of the expanded form
            d = np.sqrt(((x - p[cell]) ** 2).sum(axis=1))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("row", "vec_id", "is_query", "vector")), pa.array(cell.astype(np.int32)),
                 pa.array(d), pa.array(np.sqrt(square))],
                names=["row", "vec_id", "is_query", "vector", "cell", "d", "norm"])

    return rows.mapInArrow(work, "row long, vec_id long, is_query boolean, vector array<long>, cell int, d double, norm double")


def _best(score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k best of one query, by score and then id; ids are sorted, so ties stay in order."""
    if len(score) > k:
        edge = np.partition(score, len(score) - k)[len(score) - k]
        sure = np.flatnonzero(score > edge)
        tied = np.flatnonzero(score == edge)[:k - len(sure)]
        at = np.concatenate([sure, tied])
    else:
        at = np.arange(len(score))
    return at[np.lexsort((ids[at], -score[at]))]


class Cells(NamedTuple):
    """Summaries of the cells, a few numbers each."""

    close: np.ndarray    # the k + 1 smallest distances to the pivot, infinite where there are fewer
    far: np.ndarray
    shortest: np.ndarray
    longest: np.ndarray
    count: np.ndarray


def _summaries(placed: DataFrame, n: int, k: int) -> Cells:
    near = Window.partitionBy("cell").orderBy("d", "row")
    first = placed.withColumn("r", F.row_number().over(near)).filter(F.col("r") <= k + 1).select("cell", "r", "d").toArrow()
    cells = Cells(np.full((n, k + 1), np.inf), np.zeros(n), np.zeros(n), np.zeros(n), np.zeros(n, np.int64))
    cells.close[first.column("cell").to_numpy(), first.column("r").to_numpy() - 1] = first.column("d").to_numpy()
    sums = placed.groupBy("cell").agg(F.max("d").alias("far"), F.min("norm").alias("shortest"),
                                      F.max("norm").alias("longest"), F.count(F.lit(1)).alias("count")).toArrow()
    for name in Cells._fields[1:]:
        getattr(cells, name)[sums.column("cell").to_numpy()] = sums.column(name).to_numpy()
    return cells


def least_scores(q: np.ndarray, norm: np.ndarray, pivots: np.ndarray, cells: Cells, k: int) -> np.ndarray:
    """A score that the k-th best other vector of each query reaches at least, by the summaries alone."""
    floors = ((q @ pivots.T)[:, :, None] - norm[:, None, None] * cells.close[None, :, :]).reshape(len(q), -1)
    floors[~np.isfinite(floors)] = -np.inf
    place = min(k, floors.shape[1] - 1)  # one more than k - 1, for the query itself may be among them
    return -np.partition(-floors, place, axis=1)[:, place]


def greatest_scores(q: np.ndarray, norm: np.ndarray, pivots: np.ndarray, cells: Cells) -> np.ndarray:
    """A score that no vector of a cell exceeds, for each query and cell: the lower of two bounds."""
    at_pivot = q @ pivots.T
    square = norm[:, None] ** 2
    apart = np.sqrt(np.maximum(0, square - 2 * at_pivot + (pivots * pivots).sum(axis=1)[None, :]))
    nearest = np.maximum(0, apart - cells.far[None, :])
    # 2 <q, x> = |q|^2 + |x|^2 - |q - x|^2
    return np.minimum(at_pivot + norm[:, None] * cells.far[None, :],
                      (square + cells.longest[None, :] ** 2 - nearest ** 2) / 2)


class VoronoiJoin:
    """The steps of a search, each computed once: ``sent`` holds what the bounds could not rule out."""

    def __init__(self, table: DataFrame, is_query: Column, k: int = 20, scale: int = 64, vec_id: str = "vec_id",
                 vector: str = "embedding") -> None:
        spark = table.sparkSession
        self.k = k
        rows = kept(quantized(pick(table, vec_id=vec_id, vector=vector), scale, is_query), "vectors")
        total, size = rows.agg(F.count(F.lit(1)), F.max("n")).first()
        self.size = size or 1
        self.n_cells = max(1, min(MOST_PIVOTS, total // ROWS_PER_PIVOT))
        chosen = rows.orderBy(F.xxhash64("vec_id"), "row").limit(self.n_cells).select("vector").toArrow()
        self.pivots = spark.sparkContext.broadcast(
            _matrix(chosen.column("vector"), self.size) if total else np.zeros((1, self.size)))
        self.placed = kept(_placed(rows, self.pivots, self.size), "cells")
        cells = _summaries(self.placed, self.n_cells, k)
        self.cells = spark.sparkContext.broadcast(cells)
        self.blocks = np.maximum(1, -(-cells.count // BLOCK_ROWS))
        self.longest = float(cells.longest.max())
        self.slack = 1e-7 * (1 + self.longest ** 2)  # rounding of the bounds, far below it

    @cached_property
    def homes(self) -> DataFrame:
        """The queries, each with the one cell in which it is solved first."""
        pivots, cells, size, k = self.pivots, self.cells, self.size, self.k

        def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            count = cells.value.count
            fit = count > k if (count > k).any() else count > 0
            for batch in batches:
                at_pivot = _matrix(batch.column("vector"), size) @ pivots.value.T
                at_pivot[:, ~fit] = -np.inf
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c) for c in ("row", "vec_id", "vector", "norm")),
                     pa.array(at_pivot.argmax(axis=1).astype(np.int32)), pa.array(np.full(batch.num_rows, -np.inf))],
                    names=["row", "vec_id", "vector", "norm", "cell", "least"])

        return kept(self.placed.filter(F.col("is_query") & F.col("vec_id").isNotNull()).mapInArrow(
            choose, "row long, vec_id long, vector array<long>, norm double, cell int, least double"), "home-queries")

    @cached_property
    def at_home(self) -> DataFrame:
        """The best of each query in its own cell."""
        return kept(self._solved(self.homes.drop("norm")), "home-results")

    @cached_property
    def sent(self) -> DataFrame:
        """row, vec_id, vector, cell, least: queries at the other cells that can still hold one of their best."""
        pivots, cells, size, k, slack = self.pivots, self.cells, self.size, self.k, self.slack
        bounds = self._ranked(self.at_home).filter(F.col("rank") == k).select(
            F.col("row").alias("_row"), F.col("score").cast("double").alias("bound"))
        queries = self.homes.join(bounds, F.col("row") == F.col("_row"), "left")

        def replicate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            p, c = pivots.value, cells.value
            for whole in batches:
                for a in range(0, whole.num_rows, BOUND_QUERIES):
                    batch = whole.slice(a, BOUND_QUERIES)
                    q, norm = _matrix(batch.column("vector"), size), batch.column("norm").to_numpy()
                    least = batch.column("bound").to_numpy(zero_copy_only=False).astype(np.float64)
                    open_ = np.flatnonzero(np.isnan(least))
                    if len(open_):
                        least[open_] = least_scores(q[open_], norm[open_], p, c, k)
                    least = least - slack
                    fit = (greatest_scores(q, norm, p, c) + slack >= least[:, None]) & (c.count > 0)[None, :]
                    fit[np.arange(len(q)), batch.column("cell").to_numpy()] = False
                    who, cell = np.nonzero(fit)
                    yield pa.RecordBatch.from_arrays(
                        [*(batch.column(n).take(pa.array(who)) for n in ("row", "vec_id", "vector")),
                         pa.array(cell.astype(np.int32)), pa.array(least[who])],
                        names=["row", "vec_id", "vector", "cell", "least"])

        return kept(queries.select("row", "vec_id", "vector", "norm", "cell", "bound").mapInArrow(
            replicate, "row long, vec_id long, vector array<long>, cell int, least double"), "replicated-queries")

    def results(self) -> DataFrame:
        """query_id, rank, vec_id and score of the k best of each query."""
        partial = self.at_home.unionByName(self._solved(self.sent))
        return self._ranked(partial).filter(F.col("rank") <= self.k).select("query_id", "rank", "vec_id", "score")

    def _ranked(self, partial: DataFrame) -> DataFrame:
        rank = Window.partitionBy("row").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last())
        return partial.withColumn("rank", F.row_number().over(rank))

    def _solved(self, queries: DataFrame) -> DataFrame:
        """row, query_id, vec_id, score: the k best of each query in each block of the cells it was sent to."""
        wanted = np.zeros(self.n_cells, np.int64)
        for r in queries.groupBy("cell").count().collect():
            wanted[r["cell"]] = r["count"]
        chunks = np.maximum(1, -(-wanted // CHUNK_QUERIES))

        def per_cell(numbers: np.ndarray) -> Column:
            return F.get(F.lit(numbers.tolist()), F.col("cell"))

        def part(of: np.ndarray) -> Column:
            return F.pmod(F.xxhash64("row"), per_cell(of)).cast("int")

        asked = queries.withColumn("chunk", part(chunks)).withColumn(
            "block", F.explode(F.sequence(F.lit(0), (per_cell(self.blocks) - 1).cast("int"))))
        data = self.placed.select("row", "vec_id", "vector", "cell").withColumn("block", part(self.blocks)).withColumn(
            "chunk", F.explode(F.sequence(F.lit(0), (per_cell(chunks) - 1).cast("int"))))
        size, k = self.size, self.k
        bound = size * max(1.0, self.longest) ** 2
        kind = np.float32 if self.longest ** 2 < 1 << 24 else np.float64 if bound < 1 << 53 else np.int64

        def solve(left: pa.Table, right: pa.Table) -> pa.Table:
            out: list[list[np.ndarray]] = [[], [], [], []]
            if left.num_rows and right.num_rows:
                ids = right.column("vec_id").fill_null(int(_NO_ID)).to_numpy()
                order = np.argsort(ids, kind="stable")
                ids, own = ids[order], right.column("row").to_numpy()[order]
                x = _matrix(right.column("vector"), size)[order].astype(kind)
                q = _matrix(left.column("vector"), size).astype(kind)
                row, name = left.column("row").to_numpy(), left.column("vec_id").to_numpy()
                least = left.column("least").to_numpy()
                for a in range(0, len(q), 256):
                    scores = q[a:a + 256] @ x.T
                    for i, s in enumerate(scores, a):
                        fit = np.flatnonzero((s >= least[i]) & (own != row[i]))
                        best = fit[_best(s[fit], ids[fit], k)]
                        for o, v in zip(out, (np.full(len(best), row[i]), np.full(len(best), name[i]), ids[best],
                                              s[best].astype(np.int64)), strict=True):
                            o.append(v)
            row, name, ids, score = (np.concatenate(o) if o else np.zeros(0, np.int64) for o in out)
            return pa.table({"row": row, "query_id": name, "vec_id": pa.array(ids, mask=ids == _NO_ID), "score": score})

        keys = ["cell", "block", "chunk"]
        return asked.groupBy(*keys).cogroup(data.groupBy(*keys)).applyInArrow(
            solve, "row long, query_id long, vec_id long, score long")


def top_k(table: DataFrame, is_query: Column, k: int = 20, scale: int = 64, vec_id: str = "vec_id",
          vector: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id and score of the k best other rows for each query row."""
    return VoronoiJoin(table, is_query, k, scale, vec_id, vector).results()
