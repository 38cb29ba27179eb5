import math

import numpy as np
from pyspark.sql import functions as F

from callsift.llm import neighbours
from callsift.llm.neighbours import Shape

SCHEMA = "vec_id long, embedding array<double>, score string"


def brute(rows, k):
    kept = {}
    for i, v, _ in rows:
        if i is None or v is None or len(v) != 8 or any(x is None or not math.isfinite(x) for x in v):
            continue
        if any(v):
            kept[i] = min(kept.get(i, v), v)
    ids = sorted(kept)
    x = np.array([kept[i] for i in ids])
    out = {}
    for i in ids:
        if i % 20 == 0:
            s = x @ np.array(kept[i])
            best = sorted((-round(float(v), 9), j) for v, j in zip(s, ids, strict=True) if j != i)
            out[i] = [(j, -v) for v, j in best[:k]]
    return out


def compare(spark, rows, k):
    table = spark.createDataFrame(rows, SCHEMA)
    got = neighbours.nearest(table, F.col("vec_id") % 20 == 0, Shape(k=k)).collect()
    want = brute(rows, k)
    found = {}
    for r in sorted(got, key=lambda r: (r["query_id"], r["rank"])):
        found.setdefault(r["query_id"], []).append((r["vec_id"], round(r["score"], 9)))
    assert set(found) == {i for i, near in want.items() if near}
    hits = total = 0
    for i, near in want.items():
        assert len(found.get(i, [])) == len(near)
        assert found.get(i, []) == sorted(found.get(i, []), key=lambda p: (-p[1], p[0]))
        hits += len({j for j, _ in near} & {j for j, _ in found.get(i, [])})
        total += len(near)
    return hits / max(total, 1)


def test_recall_with_copies_and_odd_rows(spark):
    rng = np.random.default_rng(5)
    centers = rng.normal(size=(6, 8)) * 2
    x = centers[rng.integers(0, 6, 1500)] + rng.normal(size=(1500, 8)) * 0.7
    x[500:900] = x[500]  # a large group of copies
    rows = [(k, x[k].tolist(), "s") for k in range(1500)]
    rows += [(2000, None, None), (2020, [0.0] * 8, None), (2040, [1.0, None] + [1.0] * 6, None)]
    rows += [(2060, [float("nan")] * 8, None), (2080, [float("inf")] * 8, None), (2100, [1.0] * 3, None)]
    rows += [(2120, [], None), (None, [1.0] * 8, None), (40, x[40].tolist(), "s"), (60, [9.0] * 8, "again")]
    assert compare(spark, rows, 10) >= 0.9


def test_fewer_candidates_than_k(spark):
    rows = [(k, [float(k + 1)] * 8, "s") for k in range(5)]
    assert compare(spark, rows, 20) == 1
    assert compare(spark, rows[:1], 20) == 0  # nothing to find, nothing found


def test_empty(spark):
    table = spark.createDataFrame([], SCHEMA)
    assert neighbours.nearest(table, F.col("vec_id") % 20 == 0).count() == 0
