"""Nearest neighbours by inner product: stable projections, kd-trees, and a chi-square stopping test.

Largest inner product is made nearest distance: a vector x becomes (x, sqrt(M^2 - |x|^2)) with M the
largest norm, a query q becomes (q M / |q|, 0). Projected on a few Gaussian directions, the squared
distance of two points is their true one times a chi-square variable. A query therefore verifies
candidates in the order of their projected distances, and stops once the next one lies beyond the
chi-square quantile times its k-th best true distance: whatever is left is nearer only with the
stated chance.

Cells are half-space cuts of the projected space, dealt into blocks of about 8 * sqrt(rows); each
block has its own kd-tree. A query first searches one block of its own cell; the stopping test then
rules out whole cells before the second and last search.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from statistics import NormalDist

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from callsift.session import written


@dataclass(frozen=True)
class Shape:
    """``chance``: how surely one true neighbour is met before the search stops. The cells are cut
    on at most ``sample`` vectors; every vector is indexed."""

    k: int = 20
    directions: int = 8
    chance: float = 0.96
    leaf: int = 32
    sample: int = 20_000
    most_cells: int = 1024

    @property
    def quantile(self) -> float:
        """Of the chi-square distribution, by the Wilson-Hilferty formula."""
        m = self.directions
        z = NormalDist().inv_cdf(self.chance)
        return m * (1 - 2 / (9 * m) + z * (2 / (9 * m)) ** 0.5) ** 3


@dataclass(frozen=True)
class Space:
    """The projection, and the cells as boxes of it (``low``, ``high`` may be infinite)."""

    largest: float
    directions: np.ndarray  # (dimension + 1, m)
    low: np.ndarray
    high: np.ndarray

    def points(self, x: np.ndarray) -> np.ndarray:
        rest = np.sqrt(np.maximum(self.largest**2 - (x * x).sum(axis=1), 0))
        return x @ self.directions[:-1] + rest[:, None] * self.directions[-1]

    def query_points(self, q: np.ndarray) -> np.ndarray:
        return (q * (self.largest / np.sqrt((q * q).sum(axis=1)))[:, None]) @ self.directions[:-1]

    def cells_of(self, points: np.ndarray) -> np.ndarray:
        """Each point's cell: the boxes are half-open and cover everything once."""
        out = np.zeros(len(points), np.int64)
        for at in range(0, len(points), 256):
            p = points[at : at + 256, None, :]
            out[at : at + 256] = ((p >= self.low) & (p < self.high)).all(axis=2).argmax(axis=1)
        return out


def box_distance(point: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Squared distance of a point to each box."""
    gap = np.maximum(np.maximum(low - point, point - high), 0)
    return (gap * gap).sum(axis=-1)


def cut_cells(points: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """At most ``n`` boxes with about equally many of the points, cut at medians of the widest side."""
    m = points.shape[1]
    work = [(points, np.full(m, -np.inf), np.full(m, np.inf), n)]
    done = []
    while work:
        part, low, high, share = work.pop()
        spread = part.max(axis=0) - part.min(axis=0) if len(part) > 1 else np.zeros(m)
        axis = int(spread.argmax())
        cut = float(np.median(part[:, axis])) if len(part) else 0.0
        left = part[:, axis] < cut
        if share < 2 or not 0 < left.sum() < len(part):
            done.append((low, high))
            continue
        upper, lower = high.copy(), low.copy()
        upper[axis], lower[axis] = cut, cut
        work.append((part[left], low, upper, share // 2))
        work.append((part[~left], lower, high, share - share // 2))
    return np.array([d[0] for d in done]), np.array([d[1] for d in done])


class Tree:
    """A block's kd-tree over projected points: leaves with bounding boxes, rows in leaf order."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, space: Space, shape: Shape) -> None:
        points = space.points(x)
        work, leaves = [np.arange(len(ids))], []
        while work:
            rows = work.pop()
            p = points[rows]
            spread = p.max(axis=0) - p.min(axis=0)
            axis = int(spread.argmax())
            if len(rows) <= shape.leaf or spread[axis] == 0:
                leaves.append(rows)
                continue
            order = np.argsort(p[:, axis], kind="stable")
            work += [rows[order[: len(rows) // 2]], rows[order[len(rows) // 2 :]]]
        self.low = np.array([points[r].min(axis=0) for r in leaves])
        self.high = np.array([points[r].max(axis=0) for r in leaves])
        order = np.concatenate(leaves)
        self.ids, self.x = ids[order], x[order]
        ends = np.cumsum([len(r) for r in leaves])
        self.rows = np.full((len(leaves), max(map(len, leaves))), -1, np.int64)  # of each leaf
        for k, rows in enumerate(leaves):
            self.rows[k, : len(rows)] = np.arange(ends[k] - len(rows), ends[k])
        self.largest, self.shape = space.largest, shape

    def search(
        self, own: int, q: np.ndarray, point: np.ndarray, bound: float
    ) -> tuple[np.ndarray, np.ndarray, float]:
        """``(ids, scores, k-th squared distance)`` of the best candidates but ``own`` that lie
        within ``bound``, best first."""
        k, c = self.shape.k, self.shape.quantile
        scale = self.largest / np.sqrt((q * q).sum())
        away = box_distance(point, self.low, self.high)
        order = np.argsort(away, kind="stable")
        ids, scores = np.zeros(0, np.int64), np.zeros(0)
        at, step = 0, 8
        while at < len(order) and away[order[at]] <= c * bound:
            leaves = order[at : at + step]
            at, step = at + step, min(step * 2, 32)
            rows = self.rows[leaves].ravel()
            rows = rows[rows >= 0]
            found = (self.x[rows] * q).sum(axis=1)
            better = self.ids[rows] != own
            if len(ids) == k:
                better &= found >= scores[-1]
            if not better.any():
                continue
            ids = np.concatenate([ids, self.ids[rows[better]]])
            scores = np.concatenate([scores, found[better]])
            best = np.lexsort((ids, -scores))[:k]
            ids, scores = ids[best], scores[best]
            if len(ids) == k:
                bound = min(bound, max(2 * (self.largest**2 - scale * scores[-1]), 0.0))
        return ids, scores, bound if len(ids) == k else np.inf


def usable(vector: Column) -> Column:
    """Neither null nor zero, and of finite components."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(vector.isNotNull() & fine & F.exists(vector, lambda x: x != 0), F.lit(False))


def _search(rows: DataFrame, space: Space, shape: Shape, only_bound: bool) -> DataFrame:
    """Rows ``(cell, blk, query, id, v, bound)``, the candidates of a block before its queries, to
    the queries' bounds or their results. Queries stream past the tree of their block."""
    schema = "id long, bound double" if only_bound else "query_id long, vec_id long, score double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [part.split()[0] for part in schema.split(", ")]
        key, held, tree = None, [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            cell, blk, query, ids = (batch.column(k).to_numpy(zero_copy_only=False) for k in range(4))
            v = batch.column(4).flatten().to_numpy().reshape(batch.num_rows, -1)
            bound = batch.column(5).to_numpy(zero_copy_only=False)
            out: list[tuple] = []
            changed = (cell[1:] != cell[:-1]) | (blk[1:] != blk[:-1]) | (query[1:] != query[:-1])
            cuts = [0, *(np.flatnonzero(changed) + 1).tolist(), batch.num_rows]
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                if (cell[a], blk[a]) != key:
                    key, held, tree = (cell[a], blk[a]), [], None
                if not query[a]:
                    held.append((ids[a:b], v[a:b]))
                    continue
                if tree is None and held:
                    parts = zip(*held, strict=True)
                    tree, held = Tree(*map(np.concatenate, parts), space, shape), []
                points = space.query_points(v[a:b])
                for n in range(a, b):
                    if tree is None:
                        found, scores, kth = np.zeros(0, np.int64), np.zeros(0), np.inf
                    else:
                        found, scores, kth = tree.search(ids[n], v[n], points[n - a], bound[n])
                    if only_bound:
                        out.append((int(ids[n]), float(kth)))
                    else:
                        out += zip([int(ids[n])] * len(found), found.tolist(), scores.tolist(), strict=True)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out, strict=True)], names)

    return (
        rows.repartition("cell", "blk").sortWithinPartitions("cell", "blk", "query").mapInArrow(run, schema)
    )


def nearest(
    table: DataFrame, is_query: Column, shape: Shape = Shape(), key: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: each query's ``k`` nearest rows but itself, best first.

    ``is_query`` is a condition on the rows of ``table``. The score is the inner product of the
    given vectors in double precision; ties go to the smaller id. Vectors that are null, zero, of
    another length than most, or hold null or non-finite components take no part, nor do null ids.
    An id that stands several times counts once, with its smallest vector. With fewer candidates
    than ``k``, all are returned. Other columns are not read.
    """
    v = F.transform(F.col(vector), lambda x: x.cast("double"))
    rows = table.select(F.col(key).cast("long").alias("id"), v.alias("v"), is_query.alias("asks"))
    rows = rows.where(F.col("id").isNotNull() & usable(F.col("v")))
    sizes = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    if not sizes:
        none = table.sparkSession.createDataFrame([], "query_id long, vec_id long, score double, rank int")
        return none.select("query_id", "rank", "vec_id", "score")
    dimension = sizes[0]["d"]
    rows = rows.where(F.size("v") == dimension).groupBy("id").agg(
        F.min("v").alias("v"), F.coalesce(F.max("asks"), F.lit(False)).alias("asks")
    )
    rows = written(rows, "vectors")
    squares = F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)
    n, largest = rows.agg(F.count("*"), F.sqrt(F.max(squares))).first()

    directions = np.random.default_rng(11).normal(size=(dimension + 1, shape.directions))
    everywhere = np.full((1, shape.directions), np.inf)
    space = Space(largest * (1 + 1e-12), directions, -everywhere, everywhere)
    block_rows = int(np.ceil(8 * np.sqrt(n)))
    drawn = rows.select("id", "v").orderBy(F.xxhash64("id"), "id").limit(shape.sample).toPandas()
    cells = min(shape.most_cells, -(-n // block_rows))
    low, high = cut_cells(space.points(np.stack(drawn["v"].to_numpy())), cells)
    space = Space(space.largest, directions, low, high)

    @F.pandas_udf("long")
    def cell_of(vectors: pd.Series) -> pd.Series:
        return pd.Series(space.cells_of(space.points(np.stack(vectors.to_numpy()))))

    @F.pandas_udf("long")
    def home_of(vectors: pd.Series) -> pd.Series:
        return pd.Series(space.cells_of(space.query_points(np.stack(vectors.to_numpy()))))

    @F.pandas_udf("array<long>")
    def visited(vectors: pd.Series, bound: pd.Series) -> pd.Series:
        points = space.query_points(np.stack(vectors.to_numpy()))
        return pd.Series(
            [
                np.flatnonzero(box_distance(p, space.low, space.high) <= shape.quantile * b)
                for p, b in zip(points, bound, strict=True)
            ]
        )

    indexed = written(rows.withColumn("cell", cell_of("v")), "cells")
    counts = {r["cell"]: r["count"] for r in indexed.groupBy("cell").count().collect()}  # few cells
    blocks = F.array(*(F.lit(-(-counts.get(c, 0) // block_rows)) for c in range(len(low)))).cast("array<long>")
    of_cell = F.greatest(F.element_at(blocks, F.col("cell").cast("int") + 1), F.lit(1))
    own_block = F.pmod(F.xxhash64("id"), of_cell)
    stored = indexed.select(
        "cell", own_block.alias("blk"), F.lit(False).alias("query"), "id", "v", F.lit(0.0).alias("bound")
    )
    queries = indexed.where("asks").select("id", "v")
    far = F.lit(float("inf"))
    at_home = queries.withColumn("cell", home_of("v")).select(
        "cell", own_block.alias("blk"), F.lit(True).alias("query"), "id", "v", far.alias("bound")
    )
    bounds = written(_search(stored.unionByName(at_home), space, shape, True), "bounds")
    calls = queries.join(bounds, "id").withColumn("cell", F.explode(visited("v", "bound")))
    calls = calls.select(
        "cell",
        F.explode(F.sequence(F.lit(0).cast("long"), of_cell - 1)).alias("blk"),
        F.lit(True).alias("query"),
        "id",
        "v",
        "bound",
    )
    found = _search(stored.unionByName(calls), space, shape, False)

    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= shape.k)
    return ranked.select("query_id", "rank", "vec_id", "score")
