"""K-means over TF-IDF rows, choice of k by silhouette, and cluster summaries.

Where a task can hold all rows, each start of a search is a task of its own (``held``). Of larger tables
all starts share their passes over the rows: the centres of every start, for one k or for many, stand in
one matrix, a task finds the nearest centre of each start for its rows, and Spark sums what the rows that
changed their centre add to and take from the centres. A start that has ended leaves its place in the
passes to the next one.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.core.broadcast import Broadcast
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callsift.operators.held import Held, Search
from callsift.operators.ranking import sample_n, top_k_per_group
from callsift.session import written

FALLBACK_K = 18
CENTRE_CELLS = 1 << 23  # numbers in the centres that share a pass: 64 MB
HELD_BYTES = 1 << 28  # of rows that every task may hold at once
HELD_BOUNDS = 4  # times CENTRE_CELLS: numbers a task keeps of a start, one for each row and centre
SEED_ROWS = 4096  # rows that first centres are drawn from
BLOCK_ROWS = 512
MERGED = 8  # blocks that a task assigns together
PART_ROWS = 1 << 14  # of a task in a pass; smaller tables have up to LEAST_PARTS tasks, a block each at least
LEAST_PARTS = 48
PIECE = 1 << 13  # numbers of the sums that tasks hand on together
CELLS = 1 << 22  # products a task holds at a time
CACHED = 1 << 16  # products of sparse rows that are added up at a time: half a megabyte stays in the cache
ROUNDING = 1e-6  # of the largest length: more than a distance is off by rounding


# --- rows as arrays -------------------------------------------------------------------------------


def _entries(df: DataFrame, col: str) -> tuple[Column, Column]:
    """Places and values of the entries of a vector or array column."""
    if isinstance(df.schema[col].dataType, VectorUDT):
        vec = F.unwrap_udt(col)
        dense = F.transform(vec["values"], lambda _, i: i)
        return F.coalesce(vec["indices"], dense), vec["values"]
    values = F.col(col).cast("array<double>")
    return F.transform(values, lambda _, i: i), values


@dataclass
class Rows:
    """Sparse rows: lengths, and places and values of all entries, one row after the other."""

    lengths: np.ndarray
    idx: np.ndarray
    val: np.ndarray

    @classmethod
    def of_lists(cls, idx: pa.Array, val: pa.Array) -> Rows:
        lengths = np.asarray(pc.fill_null(pc.list_value_length(idx), 0)).astype(np.int64)
        return cls(lengths, np.asarray(idx.flatten()).astype(np.int64), np.asarray(val.flatten()).astype(np.float64))

    @property
    def squares(self) -> np.ndarray:
        owner = np.repeat(np.arange(len(self.lengths)), self.lengths)
        return np.bincount(owner, weights=self.val**2, minlength=len(self.lengths))

    def parts(self, cells: int) -> Iterator[tuple[int, Rows]]:
        """Runs of rows with some ``cells`` entries, each with the number of its first row."""
        ends = np.cumsum(self.lengths)
        cuts = [0, *(np.flatnonzero(np.diff(ends // max(cells, 1))) + 1).tolist(), len(ends)]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            if a < b:
                x, y = int(ends[a] - self.lengths[a]), int(ends[b - 1])
                yield a, Rows(self.lengths[a:b], self.idx[x:y], self.val[x:y])

    def take(self, which: np.ndarray) -> Rows:
        """The rows of the given numbers."""
        lengths = self.lengths[which]
        ends = np.cumsum(lengths)
        shift = (np.cumsum(self.lengths)[which] - lengths) - (ends - lengths)
        entry = np.repeat(shift, lengths) + np.arange(lengths.sum())
        return Rows(lengths, self.idx[entry], self.val[entry])

    def dots(self, matrix: np.ndarray, alone: bool = False) -> np.ndarray:
        """Products with the columns of ``matrix``, which has a row per place. ``alone``: those of a row are to
        the last bit the same, whichever other rows there are."""
        n, width = len(self.lengths), matrix.shape[0]
        if len(self.val) == n * width and not alone:  # full rows
            return self.val.reshape(n, width) @ matrix
        out = np.zeros((n, matrix.shape[1]))
        starts = np.cumsum(self.lengths) - self.lengths
        if matrix.shape[1] == 1:
            some = np.flatnonzero(self.lengths)
            if len(some):
                out[some, 0] = np.add.reduceat(matrix[self.idx, 0] * self.val, starts[some])
            return out
        order = np.argsort(self.lengths, kind="stable")
        lengths, cuts = np.unique(self.lengths[order], return_index=True)
        for length, a, b in zip(lengths.tolist(), cuts.tolist(), [*cuts[1:].tolist(), n], strict=True):
            step = max(CACHED // max(matrix.shape[1] * length, 1), 1)
            for at in range(a, b, step) if length else ():  # rows of one length
                some = order[at : min(at + step, b)]
                entry = starts[some][:, None] + np.arange(length)
                out[some] = np.matmul(self.val[entry][:, None, :], matrix[self.idx[entry]])[:, 0]
        return out


# --- k-means --------------------------------------------------------------------------------------


@dataclass
class Start:
    """One search for ``k`` centres; ``centres`` has a row per centre, stored place by place."""

    k: int
    centres: np.ndarray
    sums: np.ndarray = field(default=None)
    counts: np.ndarray = field(default=None)
    drift: np.ndarray | None = None
    cost: float = np.inf
    rounds: int = 0
    done: bool = False

    def __post_init__(self) -> None:
        self.centres = np.asfortranarray(self.centres)
        self.sums, self.counts = np.zeros_like(self.centres), np.zeros(self.k)

    def step(self, tolerance: float, last: bool) -> None:
        """Move the centres, unless they stay: then they are those that ``cost`` was measured with."""
        self.rounds += 1
        full = self.counts > 0.5
        means = np.where(full[:, None], self.sums / np.maximum(self.counts, 1)[:, None], self.centres)
        self.drift = np.sqrt(((means - self.centres) ** 2).sum(axis=1))
        if last or self.drift.max(initial=0) <= tolerance:
            self.done = True
        else:
            self.centres = means


@dataclass
class Centres:
    """The centres of some starts side by side, a row of ``matrix`` per place; ``half`` are their squared lengths."""

    matrix: np.ndarray
    half: np.ndarray
    ks: list[int]
    alone: bool = False

    @classmethod
    def of(cls, starts: Sequence[np.ndarray], alone: bool = False) -> Centres:
        matrix = np.ascontiguousarray(np.concatenate([s.T for s in starts], axis=1))
        return cls(matrix, np.einsum("wc,wc->c", matrix, matrix), [len(s) for s in starts], alone)


def _owners(
    rows: Rows, centres: Centres, drifts: Sequence[np.ndarray] | None = None
) -> tuple[np.ndarray, np.ndarray, np.ndarray | None]:
    """Of each row and start the nearest centre, the first on ties, and the squared distance to it.

    With ``drifts``, what the centres have moved, also whether that centre was the nearest before for certain:
    no distance has changed by more than its centre moved."""
    width = centres.matrix.shape[1]
    alike = [(k, len(list(same))) for k, same in groupby(centres.ks)]  # starts of one k, side by side
    shape = len(rows.lengths), len(centres.ks)
    own, far = np.empty(shape, np.int64), np.empty(shape)
    sure = None if drifts is None else np.empty(shape, bool)
    squares = rows.squares
    slack = ROUNDING * np.sqrt(squares.max(initial=0) + centres.half.max(initial=0))
    for at, part in rows.parts(CELLS // max(width, 1)):
        gaps = centres.half - 2 * part.dots(centres.matrix, centres.alone)
        n = len(part.lengths)
        first = column = 0
        for k, m in alike:
            each = gaps[:, column : column + k * m].reshape(n, m, k)
            best = each.argmin(axis=2)
            own[at : at + n, first : first + m] = best
            far[at : at + n, first : first + m] = np.take_along_axis(each, best[:, :, None], axis=2)[:, :, 0]
            if drifts is not None:
                moved = np.stack(drifts[first : first + m])
                apart = np.sqrt(np.maximum(each + squares[at : at + n, None, None], 0))
                most = np.take_along_axis(apart, best[:, :, None], axis=2)[:, :, 0] + moved[np.arange(m), best]
                apart -= moved
                np.put_along_axis(apart, best[:, :, None], np.inf, axis=2)
                sure[at : at + n, first : first + m] = apart.min(axis=2) > most + slack
            first, column = first + m, column + k * m
    return own, np.maximum(far + squares[:, None], 0), sure


def packed(features: DataFrame, col: str = "features") -> DataFrame:
    """Rows as blocks ``(lengths, idx, val)`` of binary arrays, written once for all passes."""
    idx, val = _entries(features, col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(at, BLOCK_ROWS)
                rows = Rows.of_lists(part.column(0), part.column(1))
                blobs = [rows.lengths.astype("<i8"), rows.idx.astype("<i4"), rows.val.astype("<f8")]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([b.tobytes()], pa.binary()) for b in blobs], ["lengths", "idx", "val"]
                )

    n = features.count()
    parts = max(-(-n // PART_ROWS), min(LEAST_PARTS, -(-n // BLOCK_ROWS)), 1)
    spread = features.select(idx.alias("idx"), val.alias("val")).repartition(parts)
    return written(spread.mapInArrow(run, "lengths binary, idx binary, val binary"), "feature-blocks")


def _unpacked(batch: pa.RecordBatch) -> Iterator[Rows]:
    types = {"lengths": "<i8", "idx": "<i4", "val": "<f8"}
    for at in range(0, batch.num_rows, MERGED):
        part = batch.slice(at, MERGED)
        lengths, idx, val = (
            np.concatenate([np.frombuffer(b.as_buffer(), t) for b in part.column(c)]) for c, t in types.items()
        )
        yield Rows(lengths, idx.astype(np.int64), val)


def _members(rows: Rows, owners: np.ndarray, edges: np.ndarray, width: int) -> np.ndarray:
    """Of full rows and their centres by start: the sums of the rows of every centre of every start."""
    values, out = rows.val.reshape(-1, width), np.zeros((int(edges[-1]), width))
    step = max(CELLS // int(edges[-1]), 1)
    for at in range(0, len(values), step):
        some = owners[at : at + step] + edges[:-1]
        member = np.zeros((len(some), int(edges[-1])))
        np.put_along_axis(member, some, 1.0, axis=1)
        out += member.T @ values[at : at + step]
    return out


PIECES = "piece long, slots binary, adds binary"


def _piece(piece: int, slots: np.ndarray, adds: np.ndarray) -> pa.RecordBatch:
    """What is added in some slots of a piece."""
    blobs = [slots.astype("<u2"), adds.astype("<f8")]
    return pa.RecordBatch.from_arrays(
        [pa.array([piece], pa.int64()), *(pa.array([b.tobytes()], pa.binary()) for b in blobs)],
        ["piece", "slots", "adds"],
    )


class Sums:
    """Numbers added up by their places, below ``size``; those of one place are folded together from time to time."""

    def __init__(self, size: int) -> None:
        self.size, self.places, self.adds, self.held = size, [np.zeros(0, np.int64)], [np.zeros(0)], 0

    def add(self, places: np.ndarray, adds: np.ndarray) -> None:
        self.places.append(places)
        self.adds.append(adds)
        self.held += len(places)
        if self.held > CELLS:
            self.fold()

    def fold(self) -> tuple[np.ndarray, np.ndarray]:
        """The places in order and their sums."""
        places, adds = np.concatenate(self.places), np.concatenate(self.adds)
        if len(places) > self.size // 16:
            adds = np.bincount(places, adds, self.size)
            places = np.flatnonzero(adds)
            adds = adds[places]
        else:
            places, which = np.unique(places, return_inverse=True)
            adds = np.bincount(which, adds, len(places))
        self.places, self.adds, self.held = [places], [adds], 0
        return places, adds


def _summed(pieces: DataFrame) -> DataFrame:
    """Pieces ``(piece, slots, adds)`` of one long row of numbers, added up piece by piece.

    A task holds the pieces dealt to it, ``PIECE`` numbers each, and no more than a batch of what comes in. Zeros
    are left out.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for piece, slots, adds in zip(*(batch.column(c) for c in range(3)), strict=True):
                into = held.setdefault(piece.as_py(), np.zeros(PIECE))
                into[np.frombuffer(slots.as_buffer(), "<u2")] += np.frombuffer(adds.as_buffer(), "<f8")
        for piece, numbers in held.items():
            slots = np.flatnonzero(numbers)
            yield _piece(piece, slots, numbers[slots])

    parts = pieces.sparkSession.sparkContext.defaultParallelism
    return pieces.repartition(parts, "piece").mapInArrow(run, PIECES)


def _pass(
    blocks: DataFrame,
    starts: Sequence[Start],
    afresh: bool = False,
    before: Broadcast | None = None,
    places: Sequence[int | None] = (),
) -> Broadcast:
    """Assign all rows to the centres of all starts, and bring sums, counts and costs up to date.

    What the rows that changed their centre add and take is summed; ``afresh``, all rows are, which suits full
    rows. ``before`` holds the centres of the last pass and ``places`` the number of each start in it, none if it
    is new. Only rows whose centre may have been another one are compared with those. Returned are the centres
    of this pass, for the next one."""
    spark = blocks.sparkSession
    width = starts[0].centres.shape[1]
    edges = np.cumsum([0, *(s.k for s in starts)])
    total = int(edges[-1])
    cells = total * width
    places = [None] * len(starts) if afresh or before is None else list(places)
    drifts = None if before is None or afresh else [np.zeros(s.k) if s.drift is None else s.drift for s in starts]
    shared = spark.sparkContext.broadcast(
        Centres.of([s.centres for s in starts], not afresh)
    )  # at most CENTRE_CELLS numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = shared.value
        stay = [r for r, p in enumerate(places) if p is not None]
        last = [places[r] for r in stay]
        sums, counts, costs = Sums(cells + total + len(places)), np.zeros(total), np.zeros(len(places))
        full = np.zeros((total, width if afresh else 0))
        for batch in batches:
            for rows in _unpacked(batch):
                own, far, sure = _owners(rows, now, drifts)
                costs += far.sum(axis=0)
                if afresh and len(rows.val) == len(own) * width:
                    full += _members(rows, own, edges, width)
                    counts += np.bincount((own + edges[:-1]).ravel(), minlength=total)
                    continue
                for r in (r for r, p in enumerate(places) if p is None):
                    sums.add(rows.idx * total + np.repeat(edges[r] + own[:, r], rows.lengths), rows.val)
                    counts += np.bincount(edges[r] + own[:, r], minlength=total)
                if not stay:
                    continue
                maybe = np.flatnonzero(~sure[:, stay].all(axis=1))
                left = _owners(rows.take(maybe), before.value)[0][:, last]
                moved = left != own[np.ix_(maybe, stay)]
                for c, r in enumerate(stay):
                    which = maybe[moved[:, c]]
                    some = rows.take(which)
                    for sign, side in ((1, own[which, r]), (-1, left[moved[:, c], c])):
                        sums.add(some.idx * total + np.repeat(edges[r] + side, some.lengths), sign * some.val)
                        counts += sign * np.bincount(edges[r] + side, minlength=total)
        if full.any():
            sums.add(np.arange(cells), full.T.ravel())
        sums.add(np.arange(cells, cells + total + len(costs)), np.concatenate([counts, costs]))
        slots, adds = sums.fold()
        slots, adds = slots[adds != 0], adds[adds != 0]
        cuts = np.searchsorted(slots, np.arange(0, cells + total + len(costs) + PIECE, PIECE))
        for piece in np.flatnonzero(np.diff(cuts)).tolist():
            here = slice(cuts[piece], cuts[piece + 1])
            yield _piece(piece, slots[here] - piece * PIECE, adds[here])

    pieces = blocks.mapInArrow(run, PIECES)
    values = np.zeros(-(-(cells + total + len(starts)) // PIECE) * PIECE)
    for batch in _summed(pieces).toArrow().to_batches():  # at most as many numbers as the centres have
        for piece, slots, adds in zip(*batch.columns, strict=True):
            values[piece.as_py() * PIECE + np.frombuffer(slots.as_buffer(), "<u2").astype(np.int64)] = np.frombuffer(
                adds.as_buffer(), "<f8"
            )
    for r, (s, place, a, b) in enumerate(zip(starts, places, edges[:-1], edges[1:], strict=True)):
        if place is None:
            s.sums, s.counts = np.zeros_like(s.sums), np.zeros_like(s.counts)
        s.sums += values[:cells].reshape(width, total)[:, a:b].T
        s.counts += values[cells + a : cells + b]
        s.cost = float(values[cells + total + r])
    return shared


def _seeds(rows: Rows, width: int, k: int, seed: int) -> np.ndarray:
    """First centres by k-means++ among the rows; fewer rows than centres give fewer."""
    rng = np.random.default_rng(seed)
    ends, squares = np.cumsum(rows.lengths), rows.squares

    def dense(i: int) -> np.ndarray:
        out = np.zeros(width)
        here = slice(int(ends[i] - rows.lengths[i]), int(ends[i]))
        out[rows.idx[here]] = rows.val[here]
        return out

    centres = [dense(int(rng.integers(len(ends))))]
    gap = np.full(len(ends), np.inf)
    while len(centres) < min(k, len(ends)):
        c = centres[-1]
        gap = np.minimum(gap, np.maximum(squares + (c**2).sum() - 2 * rows.dots(c[:, None])[:, 0], 0))
        gap[gap < 1e-12] = 0
        total = gap.sum()
        pick = int(rng.choice(len(ends), p=gap / total)) if total > 0 else int(rng.integers(len(ends)))
        centres.append(dense(pick))
    return np.stack(centres)


@dataclass(frozen=True)
class Clustering:
    """Centres of one k, and the sum of squared distances to them."""

    centres: np.ndarray
    cost: float
    col: str = "features"

    def getK(self) -> int:  # noqa: N802
        return len(self.centres)

    def transform(self, df: DataFrame, out: str = "cluster_id") -> DataFrame:
        """Add the number of the nearest centre; runs in the row."""
        return with_clusters(df, [self], self.col, "_clusters").withColumn(out, F.col("_clusters")[0]).drop("_clusters")


def with_clusters(df: DataFrame, models: Sequence[Clustering], col: str, out: str) -> DataFrame:
    """Add the array of each row's nearest centres, one for each model."""
    shared = df.sparkSession.sparkContext.broadcast(Centres.of([m.centres for m in models]))
    idx, val = _entries(df, col)

    @F.arrow_udf("array<int>")
    def nearest(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for i, v in batches:
            own = _owners(Rows.of_lists(i, v), shared.value)[0].astype(np.int32)
            yield pa.ListArray.from_arrays(
                pa.array(np.arange(len(own) + 1) * own.shape[1], pa.int32()), pa.array(own.ravel())
            )

    return df.withColumn(out, nearest(idx, val))


@dataclass(frozen=True)
class Size:
    """Of a table of vectors: rows, entries, places, and whether all values are numbers of 32 bits."""

    rows: int
    entries: int
    width: int
    short: bool

    @property
    def full(self) -> bool:
        return self.entries == self.rows * self.width

    def held(self, k: int) -> bool:
        """Whether a task can hold all rows and what it keeps of a start of ``k`` centres."""
        each = (4 if self.short else 8) + (0 if self.full else 2 if self.width <= 1 << 16 else 4)
        small = self.entries * each + self.rows * 4 <= HELD_BYTES
        return small and 0 < self.width * k <= CENTRE_CELLS and self.rows * k <= HELD_BOUNDS * CENTRE_CELLS


def _size(features: DataFrame, col: str) -> Size:
    idx, val = _entries(features, col)
    width = F.size(val)
    if isinstance(features.schema[col].dataType, VectorUDT):
        width = F.coalesce(F.unwrap_udt(col)["size"], width)
    short = F.forall(val, lambda v: v.eqNullSafe(v.cast("float").cast("double")))
    n, total, most, every = features.agg(
        F.count("*"), F.sum(F.greatest(F.size(val), F.lit(0))), F.max(width), F.bool_and(short)
    ).first()
    return Size(n, total or 0, most or 0, every is not False)


def _collected(features: DataFrame, size: Size, col: str) -> Held:
    """All rows on the driver: at most ``HELD_BYTES``."""
    idx, val = _entries(features, col)
    types = {"lengths": "<i4", "idx": "<u2" if size.width <= 1 << 16 else "<i4", "val": "<f4" if size.short else "<f8"}
    names = ["val"] if size.full else list(types)  # in full rows the places are those from the first to the last

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = Rows.of_lists(batch.column(0), batch.column(1))
            blobs = [getattr(rows, c).astype(types[c]).tobytes() for c in names]
            yield pa.RecordBatch.from_arrays([pa.array([b], pa.binary()) for b in blobs], names)

    spread = features.select((val if size.full else idx).alias("idx"), val.alias("val"))
    table = spread.mapInArrow(run, ", ".join(f"{c} binary" for c in names)).toArrow()
    found = {c: np.concatenate([np.frombuffer(b.as_buffer(), types[c]) for b in table.column(c)]) for c in names}
    if size.full:
        return Held.of_full(found["val"].reshape(-1, size.width))
    return Held.of(found["lengths"].astype(np.int64), found["idx"], found["val"], size.width)


def kmeans_all(
    features: DataFrame,
    ks: Sequence[int],
    n_init: int = 10,
    seed: int = 42,
    max_iter: int = 300,
    col: str = "features",
    tolerance: float = 1e-4,
) -> dict[int, Clustering]:
    """Euclidean k-means for every k, the cheapest of ``n_init`` starts each; all starts share passes.

    A start ends when no centre moves by more than ``tolerance``, or after ``max_iter`` rounds. First
    centres are drawn by k-means++ from the ``SEED_ROWS`` rows of smallest hash; every round is over
    all rows. Tables up to ``HELD_BYTES`` are sent to the tasks, and each start is a task of its own. Of
    larger ones all starts share passes: where most rows are full, sums are taken afresh in every round;
    starts whose centres together have up to ``CENTRE_CELLS`` numbers share a pass, and where there are
    more, the next start comes in as soon as others have ended. Rows are read once before the passes.
    """
    idx, val = _entries(features, col)
    entries = features.select(idx.alias("i"), val.alias("v"))
    sample = entries.orderBy(F.xxhash64("i", "v"), "i", "v").limit(SEED_ROWS).toArrow().combine_chunks()
    rows = Rows.of_lists(*(sample.column(c).combine_chunks() for c in ("i", "v")))
    if not len(rows.lengths):
        raise ValueError("no rows to cluster")
    size = _size(features, col)
    width = size.width
    if size.held(max(ks, default=0)):
        return _kmeans_held(features, size, rows, ks, n_init, seed, max_iter, col, tolerance)
    afresh = bool(rows.lengths.mean() > width / 2)
    blocks = packed(features, col)
    best: dict[int, tuple[float, int, np.ndarray]] = {}
    todo = [(k, i) for k in ks for i in range(n_init)]
    active: list[tuple[int, int, Start]] = []
    places: list[int | None] = []
    shared = None
    while todo or active:
        while todo and (not active or (sum(s.k for *_, s in active) + todo[0][0]) * width <= CENTRE_CELLS):
            k, i = todo.pop(0)
            first = _seeds(rows, width, k, seed + i)
            active.append((k, i, Start(len(first), first)))
            places.append(None)
        now = _pass(blocks, [s for *_, s in active], afresh, shared, places)
        if shared is not None:
            shared.destroy()  # its file as well: there are as many as rounds
        shared = now
        for k, i, s in active:
            s.step(tolerance, s.rounds + 1 >= max_iter)
            if s.done and (k not in best or (s.cost, i) < best[k][:2]):
                best[k] = s.cost, i, s.centres
        places = [at for at, (*_, s) in enumerate(active) if not s.done]
        active = [active[at] for at in places]
    shared.destroy()
    return {k: Clustering(np.ascontiguousarray(centres), cost, col) for k, (cost, _, centres) in best.items()}


def _kmeans_held(
    features: DataFrame,
    size: Size,
    sample: Rows,
    ks: Sequence[int],
    n_init: int,
    seed: int,
    max_iter: int,
    col: str,
    tolerance: float,
) -> dict[int, Clustering]:
    """``kmeans_all`` of a table that a task can hold. Of a start come back its cost and the labels that its centres
    are the means of; centres are made of the labels of the cheapest start of each k."""
    spark = features.sparkSession
    held = _collected(features, size, col)
    todo = [(k, i) for k in sorted(ks, reverse=True) for i in range(n_init)]  # the longest first
    shared = spark.sparkContext.broadcast((held, sample))  # at most HELD_BYTES and SEED_ROWS rows
    label = "<u1" if max(ks) <= 1 << 8 else "<i4"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, sample = shared.value
        for batch in batches:
            for at in batch.column(0).to_pylist():
                k, i = todo[at]
                found = Search(held, _seeds(sample, held.width, k, seed + i)).run(tolerance, max_iter)
                # centres of no row are not the means of any
                alone = np.arange(found.k) if found.before is None else np.setdiff1d(np.arange(found.k), found.before)
                blobs = [
                    None if found.before is None else found.before.astype(label).tobytes(),
                    alone.astype("<i4").tobytes(),
                    found.centres[alone].astype("<f8").tobytes(),
                ]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([at], pa.int64()), pa.array([found.cost]), *(pa.array([b], pa.binary()) for b in blobs)],
                    ["start", "cost", "labels", "alone", "centres"],
                )

    starts = spark.range(0, len(todo), 1, len(todo))
    ended = written(starts.mapInArrow(run, "start long, cost double, labels binary, alone binary, centres binary"), "starts")
    best: dict[int, tuple[float, int]] = {}
    for start, cost in sorted(tuple(r) for r in ended.select("start", "cost").collect()):
        k, _ = todo[start]
        if k not in best or (cost, start) < best[k]:
            best[k] = cost, start
    found = {}
    for r in ended.where(F.col("start").isin([s for _, s in best.values()])).toLocalIterator():
        k, _ = todo[r["start"]]
        alone = np.frombuffer(r["alone"], "<i4")
        part = np.frombuffer(r["centres"], "<f8").reshape(-1, held.width)
        centres = np.zeros((min(k, len(sample.lengths)), held.width))
        centres[alone] = part
        if r["labels"] is not None:
            centres = held.means(np.frombuffer(r["labels"], label), centres)
        found[k] = Clustering(centres, r["cost"], col)
    shared.destroy()
    return {k: found[k] for k in ks}


def kmeans_best(
    features: DataFrame,
    k: int,
    n_init: int = 10,
    seed: int = 42,
    max_iter: int = 300,
    col: str = "features",
) -> Clustering:
    """Euclidean k-means, the cheapest of ``n_init`` starts."""
    return kmeans_all(features, [k], n_init, seed, max_iter, col)[k]


# --- silhouette -----------------------------------------------------------------------------------


def _silhouettes(sample: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows ``(key, label, silhouette)`` for every place in the array ``_labels`` of a sample's rows
    ``(key, _labels, _i, _v)``: label and score are arrays as well.

    The sample's entries are broadcast; each task takes the distances of its rows to all of the
    sample once and adds them up for the clusters of every labelling at the same time.
    """
    rows = sample.select("_labels", "_i", "_v").toArrow()  # a sample: bounded by its caller
    labels = np.array(rows["_labels"].to_pylist(), np.int64).reshape(rows.num_rows, -1)
    every = [np.unique(labels[:, j], return_inverse=True) for j in range(labels.shape[1])]
    lists = [rows[c].combine_chunks() for c in ("_i", "_v")]
    known = Rows.of_lists(*[c if isinstance(c, pa.Array) else c.chunk(0) for c in lists])
    entry_row = np.repeat(np.arange(len(known.lengths)), known.lengths)
    by_col = np.argsort(known.idx, kind="stable")
    shared = sample.sparkSession.sparkContext.broadcast(
        (known.idx[by_col], entry_row[by_col], known.val[by_col], known.squares, every)
    )

    def distances(rows: Rows) -> np.ndarray:
        """Of rows given by their non-zero entries to every row of the sample."""
        cols, rows_of, vals, norm, _ = shared.value
        n, m = len(rows.lengths), len(norm)
        row = np.repeat(np.arange(n), rows.lengths)
        lo, hi = np.searchsorted(cols, rows.idx, "left"), np.searchsorted(cols, rows.idx, "right")
        hits = hi - lo
        entry = np.repeat(lo - (np.cumsum(hits) - hits), hits) + np.arange(hits.sum())
        place = np.repeat(row, hits) * m + rows_of[entry]
        products = np.repeat(rows.val, hits) * vals[entry]
        dots = np.bincount(place, weights=products, minlength=n * m)
        squared = rows.squares[:, None] + norm - 2 * dots.reshape(n, m)
        return np.sqrt(np.where(squared < 1e-13, 0.0, squared))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        every = shared.value[-1]
        member = [np.eye(len(names))[codes] for names, codes in every]
        edges = np.cumsum([0, *(m.shape[1] for m in member)])
        member = np.concatenate(member, axis=1)
        sizes = member.sum(axis=0)
        for batch in batches:
            n = batch.num_rows
            rows = Rows.of_lists(batch.column(len(key)), batch.column(len(key) + 1))
            labels = np.asarray(batch.column(len(key) + 2).flatten()).reshape(n, -1)
            scores = np.zeros((n, len(every)))
            ends = np.cumsum(rows.lengths)
            for at in range(0, n, 64):
                to = min(at + 64, n)
                x, y = int(ends[at] - rows.lengths[at]), int(ends[to - 1])
                sums = distances(Rows(rows.lengths[at:to], rows.idx[x:y], rows.val[x:y])) @ member
                line = np.arange(to - at)
                for j, (names, _) in enumerate(every):
                    if len(names) < 2:
                        continue
                    size = sizes[edges[j] : edges[j + 1]]
                    own = np.searchsorted(names, labels[at:to, j])
                    mine = sums[:, edges[j] : edges[j + 1]]
                    inside = mine[line, own] / np.maximum(size[own] - 1, 1)
                    means = mine / size
                    means[line, own] = np.inf
                    outside = means.min(axis=1)
                    top = np.maximum(inside, outside)
                    fine = (size[own] > 1) & (top > 0)
                    scores[at:to, j] = np.where(fine, (outside - inside) / np.where(fine, top, 1), 0.0)
            offsets = pa.array(np.arange(n + 1) * len(every), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[: len(key)],
                    batch.column(len(key) + 2),
                    pa.ListArray.from_arrays(offsets, pa.array(scores.ravel())),
                ],
                [*key, "label", "silhouette"],
            )

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in sample.select(*key).schema)
    spread = sample.select(*key, "_i", "_v", "_labels").repartition(sample.sparkSession.sparkContext.defaultParallelism)
    return spread.mapInArrow(score, f"{fields}, label array<long>, silhouette array<double>")


def silhouette(
    labelled: DataFrame,
    key: Sequence[str],
    label: str = "cluster_id",
    col: str = "features",
    sample_size: int = 5000,
    seed: int = 42,
    sampled: bool = False,
) -> DataFrame:
    """Rows ``(key, label, silhouette)`` of an exact Euclidean silhouette over a sample.

    The sample, at most ``sample_size`` rows, is what the measure is defined on. Its non-zero
    entries are broadcast; each task sums the distances of its rows to every cluster and emits one
    row per input row, so no pair of rows leaves a task. ``sampled`` says that the rows are already
    such a sample.
    """
    picked = labelled.select(*key, label, col)
    if not sampled:
        picked = sample_n(picked, key, sample_size, seed)
    idx, val = _entries(picked, col)
    sample = picked.select(*key, F.array(F.col(label).cast("long")).alias("_labels"), idx.alias("_i"), val.alias("_v"))
    scored = _silhouettes(sample, key)
    return scored.select(*key, F.col("label")[0].alias("label"), F.col("silhouette")[0].alias("silhouette"))


@dataclass(frozen=True)
class Choice:
    """The best k (none if every k gave one cluster), its score, all scores, and all clusterings."""

    k: int | None
    score: float
    scores: dict[int, float | None]
    models: dict[int, Clustering]


def choose_k(
    features: DataFrame,
    key: Sequence[str],
    k_min: int = 10,
    k_max: int = 28,
    n_init: int = 10,
    seed: int = 42,
    sample_size: int = 5000,
    max_iter: int = 300,
) -> Choice:
    """k with the highest mean silhouette (smaller k on ties); one-cluster results have no score.

    All k share the passes of their fits. The sample is labelled by all of them at once, and the
    distances between its rows are taken once for all k. The clusterings are returned so that the
    best need not be fitted again.
    """
    ks = list(range(k_min, k_max + 1))
    sample = written(sample_n(features.select(*key, "features"), key, sample_size, seed))
    models = kmeans_all(features, ks, n_init, seed, max_iter)
    idx, val = _entries(sample, "features")
    labelled = with_clusters(sample, [models[k] for k in ks], "features", "_own").select(
        *key, F.transform("_own", lambda c: c.cast("long")).alias("_labels"), idx.alias("_i"), val.alias("_v")
    )
    labelled = written(labelled, "labelled-sample")
    several = labelled.agg(*[F.count_distinct(F.col("_labels")[j]) for j in range(len(ks))]).first()
    scored = _silhouettes(labelled, key)
    means = scored.agg(*[F.avg(F.col("silhouette")[j]) for j in range(len(ks))]).first()
    scores = {k: means[j] if several[j] > 1 else None for j, k in enumerate(ks)}
    found = {k: s for k, s in scores.items() if s is not None}
    best = max(found, key=lambda k: (found[k], -k)) if found else None
    return Choice(best, found.get(best, -1.0), scores, models)


def cluster_sizes(assigned: DataFrame, cluster: str = "cluster_id") -> DataFrame:
    return assigned.groupBy(cluster).agg(F.count("*").alias("size"))


def head_per_cluster(
    assigned: DataFrame, order: Sequence[str], n: int = 10, cluster: str = "cluster_id"
) -> DataFrame:
    """First ``n`` members of each cluster in corpus order."""
    return top_k_per_group(assigned, [cluster], list(order), n, rank="rank")


def cluster_summary(
    assigned: DataFrame,
    top_terms: DataFrame,
    order: Sequence[str],
    n_examples: int = 10,
    cluster: str = "cluster_id",
) -> DataFrame:
    """``(cluster_id, size, top_terms[], examples[])``; both arrays are short by construction."""
    examples = (
        head_per_cluster(assigned, order, n_examples, cluster)
        .groupBy(cluster)
        .agg(F.array_sort(F.collect_list(F.struct("rank", "utterance"))).alias("_ex"))
    )
    terms = top_terms.groupBy(cluster).agg(
        F.array_sort(F.collect_list(F.struct("rank", "term"))).alias("_terms")
    )
    return (
        cluster_sizes(assigned, cluster)
        .join(terms, cluster, "left")
        .join(examples, cluster, "left")
        .select(
            cluster,
            "size",
            F.coalesce(
                F.transform("_terms", lambda t: t["term"]), F.array().cast("array<string>")
            ).alias("top_terms"),
            F.coalesce(
                F.transform("_ex", lambda e: e["utterance"]), F.array().cast("array<string>")
            ).alias("examples"),
        )
    )
