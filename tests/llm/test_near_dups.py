import math
import random
import re

import numpy as np

from callsift.llm import near_dups
from callsift.llm.near_dups import Shape
from callsift.session import written


def shingles(text, width):
    words = [w for w in re.split("[ \t-\r]+", text or "") if w]
    words = ["".join(c.lower() if c.isascii() else c for c in w) for w in words]
    if not words:
        return frozenset()
    width = min(width, len(words))
    return frozenset(tuple(words[i : i + width]) for i in range(len(words) - width + 1))


def brute(rows, width, percent):
    sets = [(i, shingles(t, width)) for i, t in rows]
    ids = sorted({i for i, _ in sets})
    up = {i: i for i in ids}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for n, (i, a) in enumerate(sets):
        for j, b in sets[:n]:
            both = len(a & b)
            if a and b and 100 * both >= percent * (len(a) + len(b) - both):
                x, y = root(i), root(j)
                up[max(x, y)] = min(x, y)
    return {i: (len(s), root(i)) for i, s in sets}


def planted(rng):
    vocabulary = [f"w{k}" for k in range(400)]
    rows, n = [], 0

    def add(words):
        nonlocal n
        rows.append((n, " ".join(words)))
        n += 1

    passage = rng.choices(vocabulary, k=40)
    for _ in range(12):
        text = rng.choices(vocabulary, k=rng.randint(30, 120))
        for _ in range(rng.randint(1, 8)):  # copies at every distance around the threshold
            changed = list(text)
            for _ in range(rng.randint(0, 12)):
                changed[rng.randrange(len(changed))] = rng.choice(vocabulary)
            add(changed)
    for _ in range(20):
        add(passage + rng.choices(vocabulary, k=rng.randint(5, 60)))
    chain = rng.choices(vocabulary, k=100)
    for step in range(10):  # each is near its neighbours alone
        chain = list(chain)
        for k in range(4):
            chain[(step * 17 + k * 23) % 100] = f"x{step}{k}"
        add(chain)
    for _ in range(60):
        add(text)
    for odd in ("", "   \t\n", "one", "one", "One", "a b", "a  B", "é É", "é É"):
        rows.append((n, odd))
        n += 1
    rows.append((n, None))
    rows.append((0, rows[0][1]))
    return rows


def check(spark, rows, shape):
    table = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, kept string")
    got = near_dups.near_duplicates(table, shape).collect()
    want = brute(rows, shape.words, shape.percent)
    assert sorted(r["doc_id"] for r in got) == sorted(i for i, _ in rows)
    for r in got:
        assert (r["n_shingles"], r["component_id"]) == want[r["doc_id"]], r
        assert r["kept"] == (r["doc_id"] == r["component_id"])


def test_components_equal_brute_force(spark):
    check(spark, planted(random.Random(1)), Shape(words=2))


def test_small_blocks_lose_nothing(spark):
    check(spark, planted(random.Random(2)), Shape(words=2, block=4))


def test_null_ids_and_empty(spark):
    rows = [(None, "a b c d e f"), (7, "a b c d e f"), (None, "x y z"), (None, None)]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r["doc_id"], r["component_id"], r["kept"]) for r in near_dups.near_duplicates(table).collect()), key=str)
    assert got == sorted([(None, 7, False), (7, 7, True), (None, None, True), (None, None, True)], key=str)
    assert near_dups.near_duplicates(table.limit(0)).count() == 0


def test_no_task_holds_more_than_two_blocks(spark, monkeypatch):
    rng = random.Random(4)
    passage = rng.choices([f"w{k}" for k in range(400)], k=80)
    texts = [" ".join(passage + [f"x{k}y{j}" for j in range(12)]) for k in range(240)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    shape = Shape(words=2, block=16)
    nodes = near_dups.sketched(docs, shape, "doc_id", "text").withColumnRenamed("doc_id", "id")
    rows = nodes.selectExpr("id", "explode(bands) as key", "odd", "sampled", "n_shingles as size")
    counts = rows.groupBy("key").count().withColumnRenamed("count", "n")
    members = rows.join(counts.where("n > 1"), "key").select("key", "n", "id", "odd", "sampled", "size")
    met, kind = [], type(docs)
    run = kind.mapInArrow
    monkeypatch.setattr(kind, "mapInArrow", lambda df, *a, **b: met.append(df) or run(df, *a, **b))
    for label in ("id", "if(id % 3 > 0, -1, id)"):
        labelled = written(members.selectExpr("*", f"{label} as label"))
        assert labelled.agg({"n": "max"}).first()[0] > 100
        met.clear()
        pairs = near_dups.crossing_pairs(labelled, nodes.select("id", "bands"), shape)
        got = sorted(map(tuple, pairs.collect()))
        one_block = near_dups.crossing_pairs(labelled, nodes.select("id", "bands"), Shape(words=2, block=10**6))
        assert got == sorted(map(tuple, one_block.collect())) and len(got) > 1000
        task = met[0].columns[: met[0].columns.index("id")]
        assert met[0].groupBy(*task).count().agg({"count": "max"}).first()[0] <= 4 * shape.block


def two_sets(rng, size, similarity):
    both = math.ceil(2 * size * similarity / (1 + similarity))
    pool = np.unique(rng.integers(0, 2**64, 2 * size + 10, np.uint64))
    pool = rng.permutation(pool)
    return np.sort(pool[:size]), np.sort(np.concatenate([pool[:both], pool[size : 2 * size - both]]))


def test_sketch_keeps_what_is_similar_and_drops_the_rest():
    rng = np.random.default_rng(1)
    shape = Shape()
    for size in (10, 60, 300, 700, 2000, 20_000):
        for similarity, wanted in ((0.8, True), (0.9, True), (0.65, False)):
            kept = 0
            for _ in range(30):
                pair = two_sets(rng, size, similarity)
                odd, sampled = zip(*(near_dups.odd_sketch(x, shape) for x in pair), strict=True)
                odd = np.frombuffer(b"".join(odd), np.uint64).reshape(2, -1)
                both = near_dups.Sketches(odd, np.array(sampled), np.array([size, size]), shape)
                kept += bool(both.distance(0, np.array([1]))[0] < near_dups.FAR)
            assert kept == 30 if wanted else size < 60 or kept <= 1


def test_spanning_forest_joins_what_is_near():
    rng = np.random.default_rng(3)
    odd = rng.integers(0, 2**64, (30, 32), np.uint64, endpoint=False)
    odd[10:20] = odd[3]
    odd[12, 0] ^= np.uint64(255)
    members = near_dups.Sketches(odd, np.full(30, 400), np.full(30, 450), Shape())
    edges = near_dups.spanning_forest(np.arange(30), members)
    assert len(edges) == 10 and {i for e in edges for i in e[:2]} == {3, *range(10, 20)}
