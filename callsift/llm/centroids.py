"""Centroid clustering: exact integer k-means, pruned by bounds over the centroids' history.

Lloyd's rounds in whole numbers: every vector goes to its nearest centroid, then each centroid
moves to the floor of its vectors' mean. A vector keeps an upper bound on the distance to its own
centroid and a lower bound for every other one, each with the round in which it was measured. The
positions of all rounds are kept, so a stored bound is loosened by the length of the *total*
displacement of its centroid since that round; this is never more than the sum of the moves of
the single rounds, which a bound loosened step by step would have to take. Only where bounds do
not decide, distances are measured again, exactly and in whole numbers.

Vectors are packed into blocks and written once, as a table bucketed by block. The bounds are a
second, small table with the same buckets, written anew each round, so a round joins the two
without a shuffle and what it shuffles are sums of the vectors that moved.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from callsift.session import fresh_path, remove

BLOCK_ROWS = 2048
BUCKET_ROWS = 1 << 16
LARGEST = 1 << 27  # of a whole-number component: squared distances of 64 such still fit 64 bits
SLACK = 1e-5  # relative, for bounds kept in single precision


@dataclass(frozen=True)
class Shape:
    """``scale`` times a component is floored to a whole number."""

    k: int = 8
    rounds: int = 10
    dimension: int = 64
    scale: int = 1024
    seed: str = "3"


def whole(vector: Column, shape: Shape) -> Column:
    return F.transform(vector, lambda x: F.floor(F.lit(float(shape.scale)) * x.cast("double")).cast("long"))


def usable(vector: Column, shape: Shape) -> Column:
    """Vectors of the dimension without null or non-finite components, and within ``LARGEST``."""
    limit = F.lit(float(LARGEST) / shape.scale)
    fine = F.forall(vector, lambda x: x.isNotNull() & (F.abs(x.cast("double")) < limit))
    return F.coalesce((F.size(vector) == shape.dimension) & fine, F.lit(False))


def squared(vectors: np.ndarray, centre: np.ndarray) -> np.ndarray:
    """Exact squared distances; both whole, below ``LARGEST``."""
    gap = vectors - centre
    if max(int(np.abs(gap).max(initial=0)), 1) ** 2 * gap.shape[-1] < 1 << 52:
        gap = gap.astype(np.float64)  # sums stay below 2^53, so they are exact
    return np.einsum("ij,ij->i", gap, gap).astype(np.int64)


class History:
    """The centroids of every round so far, and how far each has come since each round."""

    def __init__(self, first: np.ndarray) -> None:
        self.rounds = [first]

    @property
    def now(self) -> int:
        return len(self.rounds) - 1

    @property
    def centres(self) -> np.ndarray:
        return self.rounds[-1]

    def moved_since(self) -> np.ndarray:
        """By round and centroid: the norm of the whole displacement from then to now."""
        gaps = np.stack(self.rounds).astype(np.float64) - self.centres
        return np.sqrt((gaps**2).sum(axis=2)) * (1 + SLACK)


@dataclass
class Bounds:
    """Of the vectors of one block: own centroid, bounds, and the round each bound was measured in."""

    own: np.ndarray
    upper: np.ndarray
    upper_at: np.ndarray
    lower: np.ndarray
    lower_at: np.ndarray

    @classmethod
    def none(cls, n: int, k: int) -> Bounds:
        """Bounds that decide nothing."""
        return cls(
            np.zeros(n, np.int32), np.full(n, np.inf, np.float32), np.zeros(n, np.int16),
            np.zeros((n, k), np.float32), np.zeros((n, k), np.int16),
        )

    def packed(self) -> bytes:
        return b"".join(np.ascontiguousarray(a).tobytes() for a in vars(self).values())

    @classmethod
    def unpacked(cls, raw: bytes, n: int, k: int) -> Bounds:
        out, at = cls.none(n, k), 0
        for name, a in vars(out).items():
            setattr(out, name, np.frombuffer(raw, a.dtype, a.size, at).reshape(a.shape).copy())
            at += a.nbytes
        return out

    def reassign(self, vectors: np.ndarray, centres: np.ndarray, since: np.ndarray, now: int) -> int:
        """Move every vector to its nearest centroid (the smaller number on ties); how many distances
        had to be measured. Vectors whose bounds decide are not looked at."""
        k = len(centres)
        upper = self.upper + since[self.upper_at, self.own]
        lower = np.maximum(self.lower - since[self.lower_at, np.arange(k)], 0)
        rivals = np.where(np.arange(k) == self.own[:, None], np.inf, lower).min(axis=1)
        rows = np.flatnonzero(rivals <= upper * (1 + SLACK))
        measured = 0
        if len(rows):
            to_own = np.zeros(len(rows), np.int64)
            for j in range(k):  # first the distance to the own centroid: often it decides
                mine = np.flatnonzero(self.own[rows] == j)
                to_own[mine] = squared(vectors[rows[mine]], centres[j])
            measured += len(rows)
            self.upper[rows], self.upper_at[rows] = np.sqrt(to_own) * (1 + SLACK), now
            open_ = rivals[rows] <= self.upper[rows] * (1 + SLACK)
            rows, to_own = rows[open_], to_own[open_]
            best, own = to_own.copy(), self.own[rows].copy()
            old = own.copy()
            reach = self.upper[rows] * (1 + SLACK)
            for j in range(k):
                some = np.flatnonzero((old != j) & (lower[rows, j] <= reach))
                exact = squared(vectors[rows[some]], centres[j])
                measured += len(some)
                self.lower[rows[some], j] = np.sqrt(exact) * (1 - SLACK)
                self.lower_at[rows[some], j] = now
                nearer = (exact < best[some]) | ((exact == best[some]) & (j < own[some]))
                best[some[nearer]], own[some[nearer]] = exact[nearer], j
            self.lower[rows, old] = np.sqrt(to_own) * (1 - SLACK)
            self.lower_at[rows, old] = now
            self.own[rows] = own
            self.upper[rows] = np.sqrt(best) * (1 + SLACK)
        return measured


def _packed(rows: DataFrame) -> DataFrame:
    """``(block, ids, vectors)``: up to ``BLOCK_ROWS`` rows of a partition in one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 33
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(at, BLOCK_ROWS)
                flat = part.column(1).flatten().to_numpy(zero_copy_only=False).astype("<i4")
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([block], pa.int64()),
                        pa.array([part.column(0).to_pylist()], pa.list_(pa.int64())),
                        pa.array([flat.tobytes()], pa.binary()),
                    ],
                    ["block", "ids", "vectors"],
                )
                block += 1

    return rows.mapInArrow(run, "block long, ids array<long>, vectors binary")


class _Tables:
    """Tables bucketed by block in the shared folder; gone when the work is done."""

    def __init__(self, spark: SparkSession, buckets: int) -> None:
        self.spark, self.buckets, self.paths = spark, buckets, {}

    def write(self, df: DataFrame) -> tuple[str, DataFrame]:
        name, path = f"centroids_{uuid.uuid4().hex}", fresh_path(self.spark, "centroids")
        writer = df.write.bucketBy(self.buckets, "block").sortBy("block").format("parquet")
        writer.option("path", path).saveAsTable(name)
        self.paths[name] = path
        return name, self.spark.table(name)

    def drop(self, name: str) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        remove(self.spark, self.paths.pop(name))


def _vectors(raw: bytes, d: int) -> np.ndarray:
    return np.frombuffer(raw, "<i4").reshape(-1, d).astype(np.int64)


def _assigned(rows: DataFrame, history: History, d: int) -> DataFrame:
    """``(block, bounds, moved, measured)`` after one assignment; ``moved`` holds, by centroid, the
    change of the sums of its vectors' components and of their number."""
    centres, since, now = history.centres, history.moved_since(), history.now
    k = len(centres)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                v = _vectors(row["vectors"], d)
                raw = row.get("bounds")
                state = Bounds.none(len(v), k) if raw is None else Bounds.unpacked(raw, len(v), k)
                before = state.own.copy() if raw is not None else np.full(len(v), -1, np.int32)
                measured = state.reassign(v, centres, since, now)
                moved = np.zeros((k, d + 1), np.int64)
                for sign, side in ((1, state.own), (-1, before)):
                    for j in range(k):
                        some = v[(side == j) & (state.own != before)]
                        moved[j, :d] += sign * some.sum(axis=0)
                        moved[j, d] += sign * len(some)
                flat = moved.ravel().tolist() if moved.any() else None
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["block"]], pa.int64()),
                        pa.array([state.packed()], pa.binary()),
                        pa.array([flat], pa.list_(pa.int64())),
                        pa.array([measured], pa.int64()),
                    ],
                    ["block", "bounds", "moved", "measured"],
                )

    return rows.mapInArrow(run, "block long, bounds binary, moved array<long>, measured long")


def _distances(rows: DataFrame, centres: np.ndarray) -> DataFrame:
    """``(id, cluster, distance)`` of every vector to its own centroid."""
    k, d = centres.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                v = _vectors(row["vectors"], d)
                own = Bounds.unpacked(row["bounds"], len(v), k).own
                far = np.zeros(len(v), np.int64)
                for j in range(k):
                    far[own == j] = squared(v[own == j], centres[j])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row["ids"], pa.int64()), pa.array(own), pa.array(far)],
                    ["id", "cluster", "distance"],
                )

    return rows.mapInArrow(run, "id long, cluster int, distance long")


def moved_centres(centres: np.ndarray, sums: np.ndarray) -> np.ndarray:
    """Floors of the means; a centroid without vectors stays."""
    counts = sums[:, -1:]
    return np.where(counts > 0, sums[:, :-1] // np.maximum(counts, 1), centres)


def cluster(
    table: DataFrame,
    shape: Shape = Shape(),
    key: str = "vec_id",
    vector: str = "embedding",
    stats: list[dict] | None = None,
) -> DataFrame:
    """``(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256)`` per vector.

    The first centroids are the ``k`` vectors whose ``seed:id`` has the smallest sha256 (fewer
    vectors: fewer centroids); ties, as of rows with one id, go to the smaller vector. Vectors that
    are null, of another length, hold null or non-finite components, or reach ``LARGEST`` times
    1/``scale``, where squared distances would leave 64 bits, take no part. Repeated rows count as
    often as they stand; a null id is hashed as an empty one and given back as null. Empty
    clusters keep their centroid; an empty table gives no rows. Other columns are not read.

    Memory: a block of vectors per task; ``rounds * k`` centroids on the driver. ``stats`` receives
    for each round how many distances were measured and how many vectors there are.
    """
    spark = table.sparkSession
    v = F.col(vector)
    rows = table.where(usable(v, shape)).select(F.col(key).cast("long").alias("id"), whole(v, shape).alias("v"))
    n = rows.count()
    if not n:
        schema = (
            "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
        )
        return spark.createDataFrame([], schema).withColumnRenamed("vec_id", key)
    name = F.concat(F.lit(f"{shape.seed}:"), F.coalesce(F.col("id").cast("string"), F.lit("")))
    firsts = rows.select("v", F.sha2(name, 256).alias("h")).orderBy("h", "v").limit(shape.k).collect()
    history = History(np.array([r["v"] for r in firsts], np.int64))
    k, d = history.centres.shape

    buckets = -(-n // BUCKET_ROWS)
    tables = _Tables(spark, buckets)
    kept, vectors = tables.write(_packed(rows).repartition(buckets, "block"))
    sums = np.zeros((k, d + 1), np.int64)
    state, bounds = tables.write(_assigned(vectors.select("block", "vectors"), history, d))
    for turn in range(shape.rounds + 1):
        if stats is not None:
            stats.append({"measured": bounds.agg(F.sum("measured")).first()[0], "vectors": n})
        changes = bounds.select(F.posexplode("moved")).groupBy("pos").agg(F.sum("col").alias("by")).collect()
        for r in changes:  # at most k * (d + 1)
            sums.reshape(-1)[r["pos"]] += r["by"]
        if turn == shape.rounds or not changes and turn:
            break  # without a moved vector the centroids stay for good
        history.rounds.append(moved_centres(history.centres, sums))
        last = state
        joined = vectors.select("block", "vectors").join(bounds.select("block", "bounds").hint("merge"), "block")
        state, bounds = tables.write(_assigned(joined, history, d))
        tables.drop(last)
    joined = vectors.join(bounds.select("block", "bounds").hint("merge"), "block")
    path = fresh_path(spark, "clustered")
    _distances(joined, history.centres).write.parquet(path)
    tables.drop(state)
    tables.drop(kept)
    found = spark.read.schema("id long, cluster int, distance long").parquet(path)

    per = {r["cluster"]: r["s"] for r in found.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}
    texts = [",".join(map(str, c)) for c in history.centres.tolist()]
    known = spark.createDataFrame(
        [(j, per.get(j), sum(per.values()), texts[j]) for j in range(k)],
        "cluster int, cluster_inertia long, inertia long, centroid string",
    )
    return found.join(F.broadcast(known), "cluster").select(  # k rows
        F.col("id").alias(key),
        "cluster",
        "distance",
        "cluster_inertia",
        "inertia",
        F.sha2("centroid", 256).alias("centroid_sha256"),
    )
