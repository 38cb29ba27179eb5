import hashlib
import math

import numpy as np
import pytest

from callsift.llm import centroids
from callsift.llm.centroids import Bounds, History, Shape

SCHEMA = "vec_id long, embedding array<double>, cluster string, id string, block int"


def brute(rows, shape):
    kept = []
    for i, v in rows:
        if v is None or len(v) != shape.dimension or any(x is None or not math.isfinite(x) for x in v):
            continue
        kept.append((i, [math.floor(shape.scale * x) for x in v]))
    name = lambda i: hashlib.sha256(f"{shape.seed}:{'' if i is None else i}".encode()).hexdigest()
    centres = [v for _, v in sorted(kept, key=lambda r: (name(r[0]), r[1]))[: shape.k]]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    nearest = lambda: [min((far(v, c), j) for j, c in enumerate(centres)) for _, v in kept]
    for _ in range(shape.rounds):
        own = nearest()
        for j in range(len(centres)):
            some = [v for (_, v), (_, k) in zip(kept, own, strict=True) if k == j]
            if some:
                centres[j] = [sum(x) // len(some) for x in zip(*some, strict=True)]
    own = nearest()
    inertia = [sum(d for d, k in own if k == j) for j in range(len(centres))]
    texts = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    return sorted(
        [(i, j, d, inertia[j], sum(inertia), texts[j]) for (i, _), (d, j) in zip(kept, own, strict=True)],
        key=str,
    )


def found(spark, rows, shape, **options):
    table = spark.createDataFrame([(i, v, "a", "b", 1) for i, v in rows], SCHEMA).repartition(3)
    got = centroids.cluster(table, shape, **options)
    columns = ("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
    return sorted((tuple(r[c] for c in columns) for r in got.collect()), key=str)


def clouds(seed, n, d, groups=5):
    rng = np.random.default_rng(seed)
    middle = rng.normal(size=(groups, d)) * 2
    return [(i, (middle[i % groups] + rng.normal(size=d) * 0.8).tolist()) for i in range(n)]


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_plain_rounds(spark, seed):
    shape, stats = Shape(k=4, rounds=6, dimension=5, scale=64), []
    rows = clouds(seed, 400, 5)
    assert found(spark, rows, shape, stats=stats) == brute(rows, shape)
    assert stats[-1]["measured"] < 4 * 400


def test_odd_vectors_ties_and_repeated_rows(spark):
    shape = Shape(k=3, rounds=4, dimension=2, scale=4)
    rows = [
        (1, None), (2, [1.0]), (3, [1.0, None]), (4, [float("nan"), 1.0]), (5, [float("inf"), 1.0]), (6, [1e9, 0.0]),
        (None, [0.5, 0.5]), (7, [0.0, 0.0]), (7, [0.0, 0.0]), (7, [3.0, -3.0]), (8, [-1.1, 1.1]), (9, [0.0, 2.0]),
        (10, [2.0, 0.0]), (11, [1.0, 1.0]), (12, [-0.1, -0.1]),
    ]
    inside = [r for r in rows if r[0] != 6]  # beyond LARGEST: takes no part
    assert found(spark, rows, shape) == brute(inside, shape)


def test_few_vectors_and_none(spark):
    shape = Shape(k=8, rounds=3, dimension=2)
    rows = [(1, [0.25, 0.5]), (2, [1.0, -1.0])]
    assert found(spark, rows, shape) == brute(rows, shape)
    assert found(spark, [], shape) == []
    same = [(i, [1.5, 2.5]) for i in range(20)]  # all centroids alike: the first takes all
    assert found(spark, same, shape) == brute(same, shape)


def test_bounds_hold_in_every_round():
    rng = np.random.default_rng(5)
    v = rng.integers(-2000, 2000, (300, 6))
    history = History(v[:5].copy())
    state = Bounds.none(len(v), 5)
    for _ in range(12):
        since, now = history.moved_since(), history.now
        state.reassign(v, history.centres, since, now)
        far = np.sqrt(((v[:, None, :] - history.centres) ** 2).sum(axis=2))
        assert (state.own == far.argmin(axis=1)).all()
        rows = np.arange(len(v))
        assert (state.upper + since[state.upper_at, state.own] >= far[rows, state.own] * (1 - 1e-9)).all()
        loose = state.lower - since[state.lower_at, np.arange(5)]
        assert (loose <= far * (1 + 1e-9)).all()
        sums = np.zeros((5, 7), np.int64)
        for j in range(5):
            sums[j] = [*v[state.own == j].sum(axis=0), (state.own == j).sum()]
        history.rounds.append(centroids.moved_centres(history.centres, sums))
        state = Bounds.unpacked(state.packed(), len(v), 5)


def test_total_displacement_is_no_more_than_the_sum_of_the_moves():
    history = History(np.array([[0, 0]]))
    for p in ([10, 0], [0, 0], [10, 0], [0, 1]):
        history.rounds.append(np.array([p]))
    steps = [np.linalg.norm(b - a) for a, b in zip(history.rounds[:-1], history.rounds[1:], strict=True)]
    assert history.moved_since()[0, 0] == pytest.approx(1, rel=1e-4) and sum(steps) > 40


def test_far_vectors_are_measured_exactly():
    v = np.array([[(1 << 27) - 1] * 64, [0] * 64])
    centre = np.full(64, -(1 << 27) + 1)
    want = [sum((int(x) - int(c)) ** 2 for x, c in zip(r, centre, strict=True)) for r in v]
    assert centroids.squared(v, centre).tolist() == want
