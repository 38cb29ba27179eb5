"""Language-model scoring: an interpolated modified Kneser-Ney n-gram model, counted in Spark.

Words and n-grams are named by 64-bit hashes. What the model holds lies in tables of sorted hash
arrays in the shared folder: a table is cut into shards by the first bits of the hash, a shard is
one Arrow file, and a worker maps the shards it asks into memory, so that their pages are read on
demand and shared by all workers of a machine. A word's number is the place of its hash in the
vocabulary table; n-grams are hashes of word numbers.

    p_n(w | c) = max(count(c w) - D(count(c w)), 0) / count(c .) + gamma(c) p_{n-1}(w | c without its first word)

with counts of the text for the highest order and numbers of different preceding words below it;
p_0 is 1 / (V + 1), the one for unknown words. D has three values per order, from the counts of
counts. A text is read after ``order - 1`` start marks and ends with one end token.

Each pass over the texts counts inside a task first; Spark then sums by hash, with one shuffle per
table. All orders below the highest are summed from the table above them.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from callsift.session import fresh_path

SLICE = 4 << 20  # characters looked up at a time
SHARD_ROWS = 1 << 21  # expected rows of a shard
COMBINED = 3 << 20  # counts that a task keeps before it hands them on
MAPPED = 4096  # shards a worker keeps mapped
CHARS_PER_TOKEN = 6  # for the number of shards alone
END = b"\n"  # no word has white space, so this is the end token's alone
SPACE = re.compile(r"[ \t-\r]")
ONE, LOW = np.uint64(1), np.uint64(0xFFFFFFFF)
FALLBACK = (0.5, 1.0, 1.5)


# --- hashes ---------------------------------------------------------------------------------------


def mix(x: np.ndarray) -> np.ndarray:
    """A reversible scramble of 64 bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def unmix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(31)) ^ (x >> np.uint64(62))
    x = x * np.uint64(pow(0x94D049BB133111EB, -1, 1 << 64))
    x = x ^ (x >> np.uint64(27)) ^ (x >> np.uint64(54))
    x = x * np.uint64(pow(0xBF58476D1CE4E5B9, -1, 1 << 64))
    return x ^ (x >> np.uint64(30)) ^ (x >> np.uint64(60))


def gram_key(words: Sequence[np.ndarray]) -> np.ndarray:
    """The hash of n-grams given by their word numbers, one array per place. One and two words have
    a hash of their own each; longer n-grams share one by the chance of 64 bits."""
    packed = [w.astype(np.uint64) for w in words]
    pairs = [(a << np.uint64(32)) | b for a, b in zip(packed[::2], packed[1::2], strict=False)]
    pairs += packed[len(pairs) * 2 :]
    key = mix(pairs[0])
    for p in pairs[1:]:
        key = mix(key + p * np.uint64(0x9E3779B97F4A7C15) + ONE)
    return key


def merged(key: np.ndarray, sums: list[np.ndarray], firsts: list[np.ndarray]) -> tuple:
    """Sorted distinct keys, the sums of ``sums`` and the first of ``firsts`` for each."""
    if not len(key):
        return key, sums, firsts
    order = np.argsort(key, kind="stable")
    key = key[order]
    at = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    return key[at], [np.add.reduceat(s[order], at) for s in sums], [f[order][at] for f in firsts]


# --- tables of sorted hash arrays -----------------------------------------------------------------


@lru_cache(maxsize=MAPPED)
def shard_columns(path: str) -> dict[str, np.ndarray]:
    """A shard's arrays: mapped where the folder is mounted, else read whole, as shards are small."""
    system, name = fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path.removeprefix("file:"))
    source = pa.memory_map(name) if isinstance(system, fs.LocalFileSystem) else system.open_input_file(name)
    batch = pa.ipc.open_file(source).get_batch(0)
    return {n: c.to_numpy() for n, c in zip(batch.schema.names, batch.columns, strict=True)}


def write_shard(path: str, columns: dict[str, np.ndarray]) -> None:
    """Whole or not at all: a task that is run twice writes the same file."""
    system, name = fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path.removeprefix("file:"))
    system.create_dir(name.rsplit("/", 1)[0])
    part = f"{name}.{uuid.uuid4().hex}"
    batch = pa.RecordBatch.from_arrays([pa.array(c) for c in columns.values()], list(columns))
    with system.open_output_stream(part) as out, pa.ipc.new_file(out, batch.schema) as file:
        file.write_batch(batch)
    system.move(part, name)


def narrowed(values: np.ndarray) -> np.ndarray:
    """Counts in the smallest type that holds them."""
    return values.astype(np.min_scalar_type(int(values.max(initial=0)))) if values.dtype == np.int64 else values


@dataclass(frozen=True)
class Table:
    """Where a table lies: ``2^bits`` shards, of which those without rows have no file."""

    path: str
    bits: int
    sizes: dict[int, int]
    starts: dict[int, int]  # rows in the shards before

    def shard(self, k: int) -> str:
        return f"{self.path}/{k:08d}.arrow"

    def lookup(self, keys: np.ndarray, columns: Sequence[str]) -> tuple[np.ndarray, list[np.ndarray]]:
        """Of sorted distinct keys: each one's place in the table, -1 if it has none, and its values
        there, else 0."""
        place = np.full(len(keys), -1, np.int64)
        values = [np.zeros(len(keys)) for _ in columns]
        shards = (keys >> np.uint64(64 - self.bits)).astype(np.int64)
        at = np.flatnonzero(np.concatenate([[True], shards[1:] != shards[:-1]])) if len(keys) else []
        for a, b in zip(at, [*at[1:], len(keys)], strict=True):
            k = int(shards[a])
            if k not in self.sizes:
                continue
            arrays = shard_columns(self.shard(k))
            where = np.minimum(np.searchsorted(arrays["key"], keys[a:b]), self.sizes[k] - 1)
            hit = arrays["key"][where] == keys[a:b]
            place[a:b][hit] = self.starts[k] + where[hit]
            for value, name in zip(values, columns, strict=True):
                value[a:b][hit] = arrays[name][where[hit]]
        return place, values


def store(counts: DataFrame, bits: int, sums: Sequence[str], others: Sequence[str] = ()) -> tuple[Table, list[int]]:
    """Write ``(key, sums..., others...)`` as a table, and give the total of the first sum and how
    many rows have it 1, 2, 3 and 4. Every task handles whole shards, one after the other."""
    path, columns = fresh_path(counts.sparkSession, "hash-arrays"), [*sums, *others]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[pa.RecordBatch] = []
        shard = None

        def flush() -> pa.RecordBatch:
            rows = pa.Table.from_batches(kept)
            key = rows.column("key").to_numpy().view(np.uint64)
            arrays = {c: rows.column(c).to_numpy() for c in columns}
            write_shard(f"{path}/{shard:08d}.arrow", {"key": key} | {c: narrowed(a) for c, a in arrays.items()})
            first = arrays[columns[0]]
            stats = [int(first.sum()), *(int((first == i).sum()) for i in (1, 2, 3, 4))]
            return pa.RecordBatch.from_pydict({"shard": [shard], "n": [len(key)], "stats": [stats]})

        for batch in batches:
            number = batch.column("shard").to_numpy()
            cuts = np.flatnonzero(number[1:] != number[:-1]) + 1
            for a, b in zip([0, *cuts], [*cuts, len(number)], strict=True):
                if a == b:
                    continue
                if kept and shard != number[a]:
                    yield flush()
                    kept = []
                shard = int(number[a])
                kept.append(batch.slice(a, b - a))
        if kept:
            yield flush()

    # a task for each shard; what is summed next needs no second shuffle
    spread = counts.repartition(1 << bits, "shard")
    summed = spread.groupBy("shard", "key").agg(
        *[F.sum(c).alias(c) for c in sums], *[F.first(c).alias(c) for c in others]
    )
    ordered = summed.sortWithinPartitions("shard", "key")
    rows = ordered.mapInArrow(run, "shard long, n long, stats array<long>").collect()  # a row a shard
    sizes = {r["shard"]: r["n"] for r in sorted(rows, key=lambda r: r["shard"])}
    starts = dict(zip(sizes, np.cumsum([0, *sizes.values()])[:-1].tolist(), strict=True))
    totals = np.array([r["stats"] for r in rows], np.int64).reshape(-1, 5).sum(axis=0).tolist()
    return Table(path, bits, sizes, starts), totals


def counted(key: np.ndarray, bits: int, named: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
    shard = (key >> np.uint64(64 - bits)).astype(np.int64)
    columns = {"shard": shard, "key": key.view(np.int64)} | named
    for at in range(0, len(key), 1 << 16):
        yield pa.RecordBatch.from_arrays([pa.array(c[at : at + (1 << 16)]) for c in columns.values()], list(columns))


# --- texts ----------------------------------------------------------------------------------------


def slices(texts: pa.Array) -> Iterator[list[tuple[int, str, bool, bool]]]:
    """Pieces ``(row, text, first, last)`` of some ``SLICE`` characters together; a longer text is
    parted at white space."""
    here, size = [], 0
    for row, text in enumerate(texts.to_pylist()):
        text, at = text or "", 0
        while True:
            end = len(text)
            if end - at > SLICE and (gap := SPACE.search(text, at + SLICE)):
                end = gap.start()
            here.append((row, text[at:end] if at or end < len(text) else text, at == 0, end == len(text)))
            size += end - at + 1
            if size >= SLICE:
                yield here
                here, size = [], 0
            if end == len(text):
                break
            at = end
    if here:
        yield here


def word_hash(word: bytes) -> int:
    from xxhash import xxh3_64_intdigest

    return xxh3_64_intdigest(word)


def words_of(pieces: list[tuple[int, str, bool, bool]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The hashes of the distinct words, each word's number among them, and the words of each piece."""
    parts = pc.ascii_split_whitespace(pc.ascii_lower(pa.array([p[1] for p in pieces], pa.large_string())))
    flat = parts.flatten().dictionary_encode()
    names = flat.dictionary.cast(pa.large_binary()).to_pylist()
    number = flat.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    owner = np.repeat(np.arange(len(pieces)), np.diff(parts.offsets.to_numpy()))
    if b"" in names:  # white space at an end
        full = number != names.index(b"")
        number, owner = number[full], owner[full]
    hashes = np.fromiter(map(word_hash, names), np.uint64, len(names))
    return hashes, number, np.bincount(owner, minlength=len(pieces))


@dataclass
class Stream:
    """Word numbers of pieces, each after the ``order - 1`` before it; ``at`` are the places of tokens."""

    ids: np.ndarray
    at: np.ndarray
    row: np.ndarray

    def places(self, back: int) -> np.ndarray:
        """The word numbers ``back`` before each token."""
        return self.ids[self.at - back]

    def gram(self, n: int, skip: int = 0) -> list[np.ndarray]:
        """The ``n`` words that end ``skip`` before each token."""
        return [self.places(skip + i) for i in range(n - 1, -1, -1)]


class Reader:
    """Turns the pieces of a batch into streams, over a vocabulary table."""

    def __init__(self, vocabulary: Table, n_words: int, order: int) -> None:
        self.vocabulary, self.back = vocabulary, order - 1
        self.start, self.unknown = n_words, n_words + 1
        end = np.array([word_hash(END)], np.uint64)
        place, (count,) = vocabulary.lookup(end, ["c"])
        self.end, self.end_count = (int(place[0]), count[0]) if place[0] >= 0 else (self.unknown, 0.0)
        self.before = np.zeros(0, np.int64)

    def stream(self, pieces: list[tuple[int, str, bool, bool]]) -> tuple[Stream, np.ndarray]:
        """The stream, and how often each of its tokens stands in the texts that were learnt."""
        hashes, number, lengths = words_of(pieces)
        order = np.argsort(hashes)
        place, (count,) = self.vocabulary.lookup(hashes[order], ["c"])
        ids, counts = np.empty(len(order), np.int64), np.empty(len(order))
        ids[order], counts[order] = np.where(place < 0, self.unknown, place), count
        last = np.array([p[3] for p in pieces])
        whole = lengths + last + self.back
        first = np.cumsum(whole) - whole
        out = np.full(int(whole.sum()), self.start, np.int64)
        token = np.ones(len(out), bool)
        for i in range(self.back):
            token[first + i] = False
        ends = (first + whole - 1)[last]
        out[ends] = self.end
        word = token.copy()
        word[ends] = False
        out[word] = ids[number]
        tokens = np.flatnonzero(token)
        known = np.full(len(out), self.end_count)
        known[word] = counts[number]
        if self.back:
            if not pieces[0][2]:
                out[: self.back] = self.before
            self.before = out[-self.back :].copy()  # of use if the next slice goes on with this row
        rows = np.repeat(np.array([p[0] for p in pieces]), lengths + last)
        return Stream(out, tokens, rows), known[tokens]


# --- the model ------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Model:
    order: int
    vocabulary: Table
    tokens: int  # N
    words: int  # V
    grams: tuple[Table, ...]  # by length less one
    contexts: tuple[Table | None, ...]  # of the same; none for the empty context
    discounts: tuple[tuple[float, float, float], ...]
    empty: tuple[float, float]  # count and gamma of the empty context


def discounts(counts: Sequence[int]) -> tuple[float, float, float]:
    """Of counts 1, 2 and 3 or more, from the numbers of n-grams that stand 1, 2, 3 and 4 times; fixed
    ones where a number is 0 or a discount would leave its range, as in very small texts."""
    n1, n2, n3, n4 = counts
    if not min(n1, n2, n3):
        return FALLBACK
    y = n1 / (n1 + 2 * n2)
    found = 1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3
    return found if all(0 < d <= i for i, d in enumerate(found, 1)) else FALLBACK


def _packed(words: Sequence[np.ndarray]) -> dict[str, np.ndarray]:
    """Columns that give the words of n-grams back; two words follow from their hash."""
    if len(words) < 3:
        return {}
    return {f"w{i}": w.astype(np.int64) for i, w in enumerate(words)}


def _unpacked(arrays: dict[str, np.ndarray], n: int) -> list[np.ndarray]:
    if n > 2:
        return [arrays[f"w{i}"].astype(np.int64) for i in range(n)]
    pair = unmix(arrays["key"])
    return [pair] if n == 1 else [pair >> np.uint64(32), pair & LOW]


def _schema(values: Sequence[str]) -> str:
    return ", ".join(f"{c} long" for c in ["shard", "key", *values])


def _count_words(texts: DataFrame, bits: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, c = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        end = np.array([word_hash(END)], np.uint64)
        for batch in batches:
            for pieces in slices(batch.column(0)):
                hashes, number, _ = words_of(pieces)
                ends = np.array([sum(p[3] for p in pieces)])
                key = np.concatenate([key, hashes, end])
                c = np.concatenate([c, np.bincount(number, minlength=len(hashes)), ends])
                key, (c,), _ = merged(key, [c], [])
                key, c = key[c > 0], c[c > 0]
                if len(key) > COMBINED:
                    yield from counted(key, bits, {"c": c})
                    key, c = key[:0], c[:0]
        yield from counted(key, bits, {"c": c})

    return texts.mapInArrow(run, _schema(["c"]))


def _count_grams(texts: DataFrame, vocabulary: Table, n_words: int, order: int, bits: int) -> DataFrame:
    names = list(_packed([np.zeros(0)] * order))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(vocabulary, n_words, order)
        kept: list[tuple] = []
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            if not kept:
                return
            parts = [np.concatenate(p) for p in zip(*kept, strict=True)]
            key, (c,), words = merged(parts[0], [parts[1]], parts[2:])
            yield from counted(key, bits, {"c": c} | dict(zip(names, words, strict=True)))

        for batch in batches:
            for pieces in slices(batch.column(0)):
                words = reader.stream(pieces)[0].gram(order)
                key = gram_key(words)
                key, (c,), firsts = merged(key, [np.ones(len(key), np.int64)], list(_packed(words).values()))
                kept.append((key, c, *firsts))
                size += len(key)
                if size > COMBINED:
                    yield from flush()
                    kept, size = [], 0
        yield from flush()

    return texts.mapInArrow(run, _schema(["c", *names]))


def from_shards(spark: SparkSession, table: Table, give, values: Sequence[str]) -> DataFrame:
    """Rows that ``give`` makes of the arrays of each shard; a task reads one shard after the other."""
    shards = spark.createDataFrame([(k,) for k in table.sizes], "k long").repartition(max(len(table.sizes), 1), "k")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in batch.column(0).to_pylist():
                yield from give(shard_columns(table.shard(k)))

    return shards.mapInArrow(run, _schema(values))


def _contexts(spark: SparkSession, table: Table, n: int, bits: int) -> DataFrame:
    """What follows each context: the sum of the counts, and how many are 1, 2, and more."""

    def give(arrays: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
        c = arrays["c"].astype(np.int64)
        parts = [c, *((x).astype(np.int64) for x in (c == 1, c == 2, c > 2))]
        key, sums, _ = merged(gram_key(_unpacked(arrays, n)[:-1]), parts, [])
        yield from counted(key, bits, dict(zip(("total", "n1", "n2", "n3"), sums, strict=True)))

    return from_shards(spark, table, give, ["total", "n1", "n2", "n3"])


def _shorter(spark: SparkSession, table: Table, n: int, bits: int) -> DataFrame:
    """The n-grams without their first word, counted by the different words there."""
    names = list(_packed([np.zeros(0)] * (n - 1)))

    def give(arrays: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
        words = _unpacked(arrays, n)[1:]
        key = gram_key(words)
        key, (c,), firsts = merged(key, [np.ones(len(key), np.int64)], list(_packed(words).values()))
        yield from counted(key, bits, {"c": c} | dict(zip(names, firsts, strict=True)))

    return from_shards(spark, table, give, ["c", *names])


def fit(docs: DataFrame, order: int = 3, text: str = "text") -> Model:
    """Count all texts of ``docs``; a null text is an empty one, which has an end token alone.

    Words are runs without the characters 0x20 and 0x09-0x0D, with A-Z in lower case, of any length.
    Nothing is pruned, so the tables grow with the texts, and so does the number of their shards,
    which keeps each shard near ``SHARD_ROWS`` rows. Repeated rows count as often as they stand. An
    empty table gives a model for which every word is unknown. More than 2^32 - 2 different words
    are an error. The driver sees a row per shard.
    """
    assert order >= 2, order
    spark = docs.sparkSession
    texts = docs.select(F.col(text).cast("string").alias("text"))
    chars = texts.agg(F.sum(F.length("text"))).first()[0] or 0
    bits = max(int(np.ceil(np.log2(max(chars / CHARS_PER_TOKEN / SHARD_ROWS, 1)))), 1)
    fewer = max(bits - 2, 1)  # for tables of words
    vocabulary, (tokens, *_) = store(_count_words(texts, fewer), fewer, ["c"])
    n_words = sum(vocabulary.sizes.values())
    if n_words > (1 << 32) - 3:
        raise ValueError("more than 2^32 - 2 different words")
    extra = list(_packed([np.zeros(0)] * order))
    table, stats = store(_count_grams(texts, vocabulary, n_words, order, bits), bits, ["c"], extra)
    grams, contexts, taken = [table], [], [discounts(stats[1:])]
    for n in range(order, 1, -1):
        size = bits if n > 2 else fewer
        follows = _contexts(spark, grams[0], n, size)
        contexts.insert(0, store(_with_gamma(follows, taken[0]), size, ["total", "gamma"])[0])
        extra = list(_packed([np.zeros(0)] * (n - 1)))
        table, stats = store(_shorter(spark, grams[0], n, size), size, ["c"], extra)
        grams.insert(0, table)
        taken.insert(0, discounts(stats[1:]))
    total, n1, n2, *_ = stats
    n3 = sum(table.sizes.values()) - n1 - n2
    gamma = float(np.dot(taken[0], (n1, n2, n3)) / total) if total else 0.0
    return Model(
        order, vocabulary, tokens, n_words, tuple(grams), (None, *contexts), tuple(taken), (float(total), gamma)
    )


def _with_gamma(follows: DataFrame, d: tuple[float, float, float]) -> DataFrame:
    """The mass that discounts take, still to be divided by the total; both are sums."""
    mass = sum(F.lit(x) * F.col(f"n{i}") for i, x in enumerate(d, 1))
    return follows.select("shard", "key", "total", mass.alias("gamma"))


def _asked(table: Table, key: np.ndarray, columns: Sequence[str]) -> list[np.ndarray]:
    distinct, at = np.unique(key, return_inverse=True)
    return [v[at] for v in table.lookup(distinct, columns)[1]]


def probabilities(model: Model, stream: Stream) -> np.ndarray:
    """Of each token after those before it."""
    p = np.full(len(stream.at), 1 / (model.words + 1))
    for n in range(1, model.order + 1):
        (c,) = _asked(model.grams[n - 1], gram_key(stream.gram(n)), ["c"])
        if n == 1:
            total, mass = model.empty[0], model.empty[0] * model.empty[1]
            total, mass = np.full(len(p), total), np.full(len(p), mass)
        else:
            total, mass = _asked(model.contexts[n - 1], gram_key(stream.gram(n - 1, 1)), ["total", "gamma"])
        less = np.array([0, *model.discounts[n - 1]])[np.minimum(c, 3).astype(np.int64)]
        seen = total > 0
        p = np.where(seen, (c - less + mass * p) / np.where(seen, total, 1), p)
    return p


SCORES = "struct<n_tokens: bigint, n_known: bigint, base_score: double, score: double>"


def with_scores(docs: DataFrame, model: Model, text: str = "text", out: str = "lm") -> DataFrame:
    """Every row with a struct of its whole text's scores; runs in the row.

    ``n_tokens`` counts words and the end token, ``n_known`` those that were learnt. ``score`` is the
    model's log10 probability of the text; ``base_score`` the one of single words, by counts with 0.1
    added to each. A null text is an empty one. Equal texts have equal scores up to the order of
    summing. A column named like ``out`` is replaced; others are kept. Memory: a batch of texts and
    the lookups of ``SLICE`` characters; longer texts are parted.
    """
    below = model.tokens + 0.1 * (model.words + 1)

    @F.arrow_udf(SCORES)
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        reader = Reader(model.vocabulary, model.words, model.order)
        for texts in batches:
            sums = np.zeros((4, len(texts)))
            for pieces in slices(texts):
                stream, counts = reader.stream(pieces)
                logs = np.log10(probabilities(model, stream)), np.log10((counts + 0.1) / below)
                for k, w in enumerate((np.ones(len(counts)), counts > 0, logs[1], logs[0])):
                    sums[k] += np.bincount(stream.row, weights=w, minlength=len(texts))
            columns = [pa.array(s.astype(np.int64)) for s in sums[:2]] + [pa.array(s) for s in sums[2:]]
            yield pa.StructArray.from_arrays(columns, ["n_tokens", "n_known", "base_score", "score"])

    return docs.withColumn(out, score(F.col(text).cast("string")))
