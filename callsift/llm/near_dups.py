"""MinHash near-duplicates, verified by odd sketches and then on the full shingle sets.

1. In the row: a text's shingle set, band keys over its MinHash samples, and an odd sketch: a bitmap
   in which every sample flips one bit, so that equal samples of two documents cancel in the XOR of
   their bitmaps and its population count tells how many differ. The sketch folds one-permutation
   samples, the least hash of each of many bins: they cost one pass, and small sets are their own
   samples.
2. Texts with equal sets are one class, whose smallest id stands for it from here on.
3. Within a band bucket no pairs are listed. A minimum spanning forest over the sketch distances
   links what looks alike with at most one edge per member; large buckets are dealt into blocks.
4. Edges are confirmed on the full sets in three rounds: the nearest edge of every document, then
   the best edge between any two components, then every pair of a bucket that still lies in two
   components. What is in one component already needs no further pair.
5. Components come from alternating large-star and small-star steps on written edge tables.

With the default shape a pair of similarity 0.8 misses all its bands with a chance of 3e-6, and its
sketch lies beyond the limit, over four standard deviations from what such a pair shows, with one below
1e-5; pairs below a similarity of about 0.75 lie beyond it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callsift.llm.common import give_back, numbered, utf8, words
from callsift.session import written

_U = np.uint64


@dataclass(frozen=True)
class Shape:
    """``percent``: documents are linked when 100 * intersection >= percent * union. Two blocks
    of about ``block`` rows of a bucket meet in one task; ``sigmas`` is the slack of the sketch's verdict."""

    words: int = 5
    percent: int = 80
    bands: int = 32
    rows: int = 5
    bins: int = 4096
    bits: int = 2048
    sigmas: float = 4.0
    block: int = 1024

    @property
    def samples(self) -> int:
        return self.bands * self.rows

    def most_bits(self, in_samples: np.ndarray, in_sets: np.ndarray) -> np.ndarray:
        """The largest population count of pairs at the threshold, from the sums of both documents'
        numbers of sketched samples and of shingles."""
        similar = self.percent / 100
        union = in_sets / (1 + similar)

        def filled(n: np.ndarray) -> np.ndarray:
            return self.bins * -np.expm1(n * np.log1p(-1 / self.bins))

        bins = in_samples * filled(union) / np.maximum(2 * filled(in_sets / 2), 1e-9)
        apart = np.maximum(in_samples - 2 * similar * bins, 0)
        unseen = np.clip(1 - bins / np.maximum(union, 1), 0, 1)
        from_samples = 4 * bins * similar * (1 - similar) * unseen
        one, two = (1 - 2 / self.bits) ** apart, (1 - 4 / self.bits) ** apart
        from_bits = self.bits / 4 * (1 - one * one + (self.bits - 1) * (two - one * one))
        spread = np.sqrt(from_samples * one * one + np.maximum(from_bits, 0))
        return self.bits / 2 * (1 - one) + self.sigmas * spread + 2


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def shingle_hashes(raw: bytes, width: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles; of the whole sequence if it is shorter;
    none without words. A-Z are lower-cased."""
    ids, distinct = numbered(words(raw.lower()))
    if not len(ids):
        return np.zeros(0, _U)
    of_word = np.array([xxhash.xxh3_64_intdigest(w) for w in distinct], _U)[ids]
    width = min(width, len(ids))
    n = len(ids) - width + 1
    total = np.full(n, width, _U)
    for k in range(width):
        total = _mixed(total * _U(0x9E3779B97F4A7C15) + of_word[k : k + n])
    return np.unique(total)


@lru_cache(maxsize=4)
def _factors(shape: Shape) -> tuple[np.ndarray, np.ndarray]:
    draw = np.random.default_rng(1).integers(0, 2**63, (2, shape.samples), np.uint64)
    return draw[0] << _U(1) | _U(1), draw[1]


def band_keys(hashes: np.ndarray, shape: Shape) -> np.ndarray:
    """Of a set that is not empty."""
    times, plus = _factors(shape)
    least = np.full(shape.samples, np.iinfo(np.uint64).max, _U)
    for at in range(0, len(hashes), 1024):
        answers = np.multiply.outer(hashes[at : at + 1024], times)
        answers += plus
        np.minimum(least, answers.min(axis=0), out=least)
    key = _mixed(np.arange(1, shape.bands + 1, dtype=_U))
    for column in least.reshape(shape.bands, shape.rows).T:
        key = _mixed(key * _U(0x9E3779B97F4A7C15) + column)
    return key.view(np.int64)


def odd_sketch(hashes: np.ndarray, shape: Shape) -> tuple[bytes, int]:
    """The parity bitmap of a set's one-permutation samples, and their number. ``hashes`` are sorted,
    so a bin's least one is its first."""
    bins = hashes // _U(2**64 // shape.bins)
    first = np.concatenate([[True], bins[1:] != bins[:-1]])
    flipped = (_mixed(hashes[first] ^ _U(0x5851F42D4C957F2D)) % _U(shape.bits)).astype(np.int64)
    odd = np.packbits((np.bincount(flipped, minlength=shape.bits) & 1).astype(np.uint8))
    return odd.tobytes(), len(flipped)


def sketched(docs: DataFrame, shape: Shape, doc_id: str, text: str) -> DataFrame:
    """``doc_id, n_shingles, hi, lo, bands, odd, sampled``; all but the first two are null for an
    empty set."""

    @F.pandas_udf("n_shingles long, hi long, lo long, bands array<long>, odd binary, sampled long")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for t in batch:
                hashes = shingle_hashes(utf8(t), shape.words)
                if len(hashes):
                    digest = xxhash.xxh3_128_digest(hashes.tobytes())
                    hi, lo = np.frombuffer(digest, np.int64).tolist()
                    odd, sampled = odd_sketch(hashes, shape)
                    rows.append((len(hashes), hi, lo, band_keys(hashes, shape), odd, sampled))
                else:
                    rows.append((0, None, None, None, None, None))
            names = ["n_shingles", "hi", "lo", "bands", "odd", "sampled"]
            out = pd.DataFrame(rows, columns=names)
            yield out.astype({"hi": "Int64", "lo": "Int64", "sampled": "Int64"})
        give_back()

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), run(F.col(text)).alias("_s")).select(
        "doc_id", "_s.*"
    )


def by_bucket(batches: Iterator[pa.RecordBatch], n_keys: int) -> Iterator[list[np.ndarray]]:
    """Runs of equal values in the first ``n_keys`` columns of sorted rows, as numpy columns."""
    held: list[list[np.ndarray]] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [
            np.frombuffer(b"".join(c.to_pylist()), _U).reshape(batch.num_rows, -1)
            if pa.types.is_binary(c.type)
            else c.flatten().to_numpy().reshape(batch.num_rows, -1)
            if pa.types.is_list(c.type)
            else c.to_numpy(zero_copy_only=False)
            for c in batch.columns
        ]
        changed = np.zeros(batch.num_rows - 1, bool)
        for c in columns[:n_keys]:
            changed |= c[1:] != c[:-1]
        cuts = [0, *(np.flatnonzero(changed) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            part = [c[a:b] for c in columns]
            if held and any(held[-1][k][-1] != part[k][0] for k in range(n_keys)):
                yield [np.concatenate(c) for c in zip(*held, strict=True)] if held[1:] else held[0]
                held = []
            held.append(part)
    if held:
        yield [np.concatenate(c) for c in zip(*held, strict=True)]


@dataclass(frozen=True)
class Sketches:
    """Members of a bucket: odd sketches, numbers of samples and of shingles."""

    odd: np.ndarray
    sampled: np.ndarray
    size: np.ndarray
    shape: Shape

    def distance(self, one: int, many: np.ndarray) -> np.ndarray:
        """Of a member to others, in millionths of their samples; above a million where they cannot
        be linked."""
        apart = np.bitwise_count(self.odd[many] ^ self.odd[one]).sum(axis=-1, dtype=np.int64)
        total, sizes = self.sampled[many] + self.sampled[one], self.size[many] + self.size[one]
        least = np.minimum(self.size[many], self.size[one])
        fits = 100 * least >= self.shape.percent * (sizes - least)  # no smaller set can be so similar
        fits &= apart <= self.shape.most_bits(total, sizes)
        return np.where(fits, apart * 1_000_000 // total, FAR)


FAR = 1 << 40


def spanning_forest(ids: np.ndarray, members: Sketches) -> list[tuple[int, int, int]]:
    """Edges ``(smaller id, larger id, distance)`` of a minimum spanning forest over the members that
    may be linked; Prim's algorithm, in memory proportional to the members."""
    left = np.arange(1, len(ids))
    near, via = members.distance(0, left), np.zeros(len(left), np.int64)
    out = []
    while len(left):
        k = int(near.argmin())
        new, w = int(left[k]), int(near[k])
        a, b = int(ids[via[k]]), int(ids[new])
        if w < FAR and a != b:
            out.append((min(a, b), max(a, b), w))
        left, near, via = np.delete(left, k), np.delete(near, k), np.delete(via, k)
        other = members.distance(new, left)
        via[other < near] = new
        near = np.minimum(near, other)
    return out


def forest_edges(members: DataFrame, shape: Shape) -> DataFrame:
    """``members (key, n, id, odd, sampled, size)`` to distinct edges ``(a, b, bits)``; bounded by the
    members."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple[int, int, int]] = []
        for _, _, ids, odd, sampled, size in by_bucket(batches, 2):
            if len(ids) > 1:
                rows += spanning_forest(ids, Sketches(odd, sampled, size, shape))
            if len(rows) > 20_000:
                yield _edges(rows)
                rows = []
        if rows:
            yield _edges(rows)
        give_back()

    blocks = F.ceil(F.col("n") / shape.block)
    dealt = members.withColumn("blk", F.pmod(F.xxhash64("id", "key"), blocks))
    return (
        dealt.select("key", "blk", "id", "odd", "sampled", "size")
        .repartition("key", "blk")
        .sortWithinPartitions("key", "blk")
        .mapInArrow(run, "a long, b long, bits long")
        .groupBy("a", "b")
        .agg(F.min("bits").alias("bits"))
    )


def _edges(rows: list[tuple[int, int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], ["a", "b", "bits"]
    )


def crossing_pairs(members: DataFrame, bands: DataFrame, shape: Shape) -> DataFrame:
    """All pairs of a bucket that may be linked and have different labels, as distinct ``(a, b)``.

    ``members`` with their ``label``, and the ``bands`` of each id: a pair that shares several buckets
    comes from the first of them alone. The rows of a bucket of more than ``block`` are dealt into
    blocks, those of its most frequent label into blocks of their own. A task meets two blocks, or one
    with itself; two blocks of the most frequent label need not meet.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, one, two, ids, odd, sampled, size, label, of_two, keys in by_bucket(batches, 3):
            sketches = Sketches(odd, sampled, size, shape)
            rows: list[tuple[int, int, int]] = []
            for k in range(len(ids)):
                others = np.flatnonzero((label != label[k]) & (ids > ids[k]))
                if one[0] != two[0]:  # pairs inside a block come from its meeting with itself
                    others = others[of_two[others] != of_two[k]]
                if len(others):
                    others = others[sketches.distance(k, others) < FAR]
                    first = (keys[others] == keys[k]).argmax(axis=1)
                    others = others[keys[k][first] == key[0]]
                    rows += [(int(ids[k]), int(j), 0) for j in ids[others]]
                if len(rows) > 20_000:
                    yield _edges(rows)
                    rows = []
            if rows:
                yield _edges(rows)
        give_back()

    spread = (
        members.groupBy("key")
        .agg(F.min("label").alias("_low"), F.max("label").alias("_high"))
        .where(F.col("_low") != F.col("_high"))
        .select("key")
    )
    mixed = members.join(written(spread, "mixed"), "key").join(bands, "id")
    large = written(mixed.where(F.col("n") > shape.block), "large")
    common = (
        large.groupBy("key", "label")
        .count()
        .groupBy("key")
        .agg(
            F.max_by("label", "count").alias("_common"),
            F.max("count").alias("_alike"),
            F.sum("count").alias("_all"),
        )
    )
    told = large.join(written(common, "common"), "key")
    # Blocks of other labels are numbered below ``n_other``, those of the most frequent one from there.
    n_other = F.ceil((F.col("_all") - F.col("_alike")) / shape.block)
    n_alike = F.ceil(F.col("_alike") / shape.block)
    at = F.xxhash64("id", "key")
    own = F.when(F.col("label") == F.col("_common"), n_other + F.pmod(at, n_alike)).otherwise(F.pmod(at, n_other))
    told = told.withColumns({"_own": own, "_other": n_other, "_blocks": n_other + n_alike})
    below = F.transform(
        F.sequence(F.lit(0).cast("long"), F.least(F.col("_own"), F.col("_other") - 1)),
        lambda i: F.struct(i.alias("one"), F.col("_own").alias("two"), (i != F.col("_own")).alias("of_two")),
    )
    above = F.transform(
        F.sequence(F.col("_own") + 1, F.col("_blocks") - 1),
        lambda j: F.struct(F.col("_own").alias("one"), j.alias("two"), F.lit(False).alias("of_two")),
    )
    meetings = F.when(F.col("_own") < F.col("_other"), F.concat(below, above)).otherwise(below)
    dealt = told.withColumn("_m", F.explode(meetings))
    sketch = ("id", "odd", "sampled", "size")
    zero = F.lit(0).cast("long")
    whole = mixed.where(F.col("n") <= shape.block).select(
        "key", zero.alias("one"), zero.alias("two"), *sketch, "label", F.lit(False).alias("of_two"), "bands"
    )
    rows = whole.unionByName(
        dealt.select("key", "_m.one", "_m.two", *sketch, "label", "_m.of_two", "bands")
    )
    pairs = (
        rows.repartition("key", "one", "two")
        .sortWithinPartitions("key", "one", "two")
        .mapInArrow(run, "a long, b long, bits long")
    )
    return pairs.select("a", "b").distinct()


def confirmed(edges: DataFrame, texts: DataFrame, shape: Shape) -> DataFrame:
    """``(a, b, ok)``: each edge tested on the full sets of ``texts (id, text)``."""

    @F.pandas_udf("boolean")
    def linked(left: pd.Series, right: pd.Series) -> pd.Series:
        out, last, of_last = [], None, None
        for x, y in zip(left, right, strict=True):
            if y != last:  # rows of one right side stand together
                last, of_last = y, shingle_hashes(utf8(y), shape.words)
            of_x = shingle_hashes(utf8(x), shape.words)
            both = len(np.intersect1d(of_x, of_last, assume_unique=True))
            out.append(100 * both >= shape.percent * (len(of_x) + len(of_last) - both))
        give_back()
        return pd.Series(out, dtype=bool)

    left = texts.select(F.col("id").alias("a"), F.col("text").alias("_x"))
    right = texts.select(F.col("id").alias("b"), F.col("text").alias("_y"))
    return edges.select("a", "b").join(left, "a").join(right, "b").select(
        "a", "b", linked("_x", "_y").alias("ok")
    )


def components(edges: DataFrame) -> DataFrame:
    """``(id, label)`` for the ids of ``edges (a, b)``: the smallest id reachable.

    Each step reads and writes an edge table; no node's neighbours are gathered. The steps keep what
    is connected so, hence a forest of stars around smallest ids is the result.
    """

    def down(pairs: DataFrame) -> DataFrame:
        return pairs.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))

    def is_stars(pairs: DataFrame) -> bool:
        rows, ends = pairs.agg(F.count("*"), F.count_distinct("a")).first()
        tops = pairs.select(F.col("b").alias("a"))
        return rows == ends and pairs.join(tops, "a", "left_semi").isEmpty()

    now = written(down(edges).distinct(), "edges")
    while not is_stars(now):
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.where("b > a").join(written(least, "least"), "a")
        now = written(down(large.select(F.col("b").alias("a"), F.col("m").alias("b"))), "large-star")
        least = now.groupBy("a").agg(F.min("b").alias("m"))
        small = now.join(written(least, "least"), "a")
        to_least = small.select("a", F.col("m").alias("b")).unionByName(
            small.select(F.col("b").alias("a"), F.col("m").alias("b"))
        )
        now = written(down(to_least).distinct(), "small-star")
    roots = now.select(F.col("b").alias("id")).distinct().withColumn("label", F.col("id"))
    return now.select(F.col("a").alias("id"), F.col("b").alias("label")).unionByName(roots)


def merged(labels: DataFrame, edges: DataFrame) -> DataFrame:
    """Labels after further ``edges (a, b)``: components of the labels they join."""
    across = _labelled(_labelled(edges, labels, "a", "la"), labels, "b", "lb").where("la != lb")
    across = written(across.select(F.col("la").alias("a"), F.col("lb").alias("b")), "across")
    if across.isEmpty():
        return labels
    joined = written(components(across), "joined")
    alone = joined.join(labels.select("id"), "id", "left_anti")
    moved = _labelled(labels, joined, "label", "_to")
    return written(moved.select("id", F.col("_to").alias("label")).unionByName(alone), "labels")


def _labelled(df: DataFrame, labels: DataFrame, column: str, out: str) -> DataFrame:
    """``df`` with the label of its id; an id without one is its own label."""
    side = labels.select(F.col("id").alias(column), F.col("label").alias(out))
    return df.join(side, column, "left").withColumn(out, F.coalesce(out, column))


def near_duplicates(
    docs: DataFrame, shape: Shape = Shape(), doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)`` for every row of ``docs``.

    ``component_id`` is the smallest doc_id reachable over links, ``kept`` tells whether it is the
    row's own. A null, empty or wordless text has no shingles and is linked with nothing. Repeated
    rows are copies of each other and each of them gets the same result. Rows with a null id can
    take part in no component: their component is their copies' (or null) and they are kept only
    when that is null. Other columns are not read.
    """
    nodes = written(sketched(docs, shape, doc_id, text), "sketches")
    classes = (
        nodes.where("n_shingles > 0")
        .groupBy("hi", "lo")
        .agg(F.min("doc_id").alias("rep"), F.count("*").alias("_n"))
        .where("_n > 1")
        .drop("_n")
    )
    known = nodes.drop("bands", "odd").join(written(classes, "classes"), ["hi", "lo"], "left")
    known = written(
        known.select("doc_id", "n_shingles", F.coalesce("rep", "doc_id").alias("rep")), "known"
    )
    heads = known.where("n_shingles > 0 and doc_id = rep").select("doc_id").distinct()
    heads = nodes.where("n_shingles > 0 and doc_id is not null").join(heads, "doc_id", "left_semi")
    heads = written(
        heads.select(F.col("doc_id").alias("id"), "bands", "odd", "sampled", F.col("n_shingles").alias("size")),
        "heads",
    )

    if heads.count() > heads.select("id").distinct().count():  # repeated rows
        heads = written(heads.dropDuplicates(["id", "odd"]), "heads")
    rows = heads.select("id", F.explode("bands").alias("key"))
    shared = rows.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    members = rows.join(written(shared, "buckets"), "key").join(heads.drop("bands"), "id")
    members = written(members.select("key", "n", "id", "odd", "sampled", "size"), "members")
    tree = written(forest_edges(members, shape), "forest")

    # The texts of all that any round may compare: shuffled once, then read from their own table.
    seen = tree.select(F.explode(F.array("a", "b")).alias("id")).unionByName(
        members.where(F.col("n") > shape.block).select("id")
    )
    source = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text"))
    texts = written(source.join(written(seen.distinct(), "seen"), "id", "left_semi"), "texts")

    best = (
        tree.select(F.col("a").alias("id"), F.col("b").alias("to"), "bits")
        .unionByName(tree.select(F.col("b").alias("id"), F.col("a").alias("to"), "bits"))
        .groupBy("id")
        .agg(F.min(F.struct("bits", "to")).alias("_e"))
        .select(F.least("id", "_e.to").alias("a"), F.greatest("id", "_e.to").alias("b"))
        .distinct()
    )
    tested = written(confirmed(best, texts, shape), "tested")
    labels = written(components(tested.where("ok")), "labels")

    across = _labelled(_labelled(tree, labels, "a", "la"), labels, "b", "lb").where("la != lb")
    across = across.join(tested.select("a", "b"), ["a", "b"], "left_anti")
    between = (
        across.groupBy(F.least("la", "lb").alias("x"), F.greatest("la", "lb").alias("y"))
        .agg(F.min(F.struct("bits", "a", "b")).alias("_e"))
        .select("_e.a", "_e.b")
    )
    more = written(confirmed(between, texts, shape), "tested")
    tested = tested.unionByName(more)
    labels = merged(labels, more.where("ok").select("a", "b"))

    rest = crossing_pairs(_labelled(members, labels, "id", "label"), heads.select("id", "bands"), shape)
    rest = written(rest.join(tested.select("a", "b"), ["a", "b"], "left_anti"), "rest")
    last = written(confirmed(rest, texts, shape), "tested")
    labels = merged(labels, last.where("ok").select("a", "b"))

    found = _labelled(known, labels, "rep", "component_id")
    return found.select(
        "doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept")
    )
