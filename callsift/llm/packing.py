"""Packing: token streams cut into fixed-size sequences by dynamic programming.

The documents of a partition are one stream in their order. A cut may stand at a document's end, at
a sentence's end, or, where sentences run long, on a grid inside them; each kind has its penalty. A
sequence is padded to the full size unless its length is a power of two. The least sum of padding
and penalties follows from

    best[j] = penalty[j] + open_cost + min(size - pos[j] + min over pos[i] >= pos[j] - size of (best[i] + pos[i]),
                                           min over pos[i] = pos[j] - 2^k of best[i])

whose inner minimum over a sliding window is held by a monotone queue, so a block takes linear time.
"""

from __future__ import annotations

import os
from collections import deque
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame

from callsift.llm.common import give_back

END_ID = 2
CACHED_BYTES = 48 << 20  # of known chunks that a worker keeps
ENTRY_BYTES = 240  # of one of them
LONGEST_CACHED = 64
SLICE = 2 << 20  # bytes of text encoded at a time


@dataclass(frozen=True)
class Costs:
    """In tokens of padding. ``block`` tokens are cut at a time; what is left of a block's last two
    sequences goes to the next block. Powers of two below ``shortest`` count as padded: so short a
    sequence is not worth its opening."""

    size: int = 4096
    sentence: float = 4.0
    inside: float = 24.0
    open_cost: float = 16.0
    grid: int = 256
    shortest: int = 64
    block: int = 1 << 18


def _strings(array: pa.Array) -> list[str]:
    return array.to_numpy(zero_copy_only=False).tolist()


class WordEncoder:
    """Ids of a word-end BPE tokenizer file, found once per distinct word.

    The tokenizer drops white space and never joins what it parts, so a text's ids are the ids of
    its chunks between ASCII white space. Chunks of Latin letters, with a mark or without, are words
    as they stand; other chunks of Latin characters are cut into words by the tokenizer's own pattern.
    New words are encoded together; any other chunk, and one that may hold a special token
    (``<|...``), goes through the tokenizer as it is.
    """

    PLAIN = regex.compile("[\x21-\x7e\xa1-įı-ſ]+")
    WORD = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")

    def __init__(self, path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.whole = Tokenizer.from_file(path)
        self.words = Tokenizer.from_file(path)
        self.words.normalizer = normalizers.Sequence([])
        self.words.pre_tokenizer = pre_tokenizers.Sequence(
            [
                pre_tokenizers.WhitespaceSplit(),
                pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False),
            ]
        )
        vocabulary = self.whole.get_vocab()
        n = max(vocabulary.values()) + 1
        self.ends_word, self.ends_sentence = np.zeros(n, bool), np.zeros(n, bool)
        for token, i in vocabulary.items():
            self.ends_word[i] = token.endswith("</w>")
            self.ends_sentence[i] = token.endswith((".</w>", "!</w>", "?</w>"))
        self.of_chunk: dict[str, bytes] = {}
        self.marks = self._learn(list(".,;:"))

    def _words(self, chunk: str) -> list[str] | None:
        """The words of a chunk as the tokenizer parts it; None if it has to see the chunk itself."""
        if "<|" in chunk or not self.PLAIN.fullmatch(chunk):
            return None
        return self.WORD.findall(chunk.lower())

    def _learn(self, words: list[str]) -> dict[str, bytes]:
        """The ids of each word as little-endian 32-bit numbers."""
        out: dict[str, bytes] = {}
        for at in range(0, len(words), 5000):
            some = words[at : at + 5000]
            (coded,) = self.words.encode_batch_fast([" ".join(some)], add_special_tokens=False)
            ids = np.array(coded.ids, "<u4")
            ends = np.flatnonzero(self.ends_word[ids]) + 1
            assert len(ends) == len(some), "a word's last token alone ends a word"
            raw, first = ids.tobytes(), 0
            for w, end in zip(some, (4 * ends).tolist(), strict=True):
                out[w] = raw[first:end]
                first = end
        return out

    def _of_words(self, words: list[str]) -> list[bytes]:
        """The ids of words, found once for each."""
        learnt = self._learn(list(dict.fromkeys(words)))
        return [learnt[w] for w in words]

    def _odd(self, chunks: list[str]) -> list[bytes]:
        """The ids of chunks that are not plain words."""
        cut = [self._words(c) for c in chunks]
        each = iter(self._of_words([w for ws in cut if ws for w in ws]))
        return [
            np.array(self.whole.encode(c, add_special_tokens=False).ids, "<u4").tobytes()
            if ws is None
            else b"".join([next(each) for _ in ws])
            for c, ws in zip(chunks, cut, strict=True)
        ]

    def _learn_chunks(self, chunks: pa.Array) -> list[bytes]:
        """The ids of distinct chunks. Plain words, also with a mark after them, are told apart for all
        chunks at once; a plain word's ids do not depend on its case."""
        body = pc.utf8_rtrim(chunks, ".,;:")
        marks = np.asarray(pc.binary_length(chunks)) - np.asarray(pc.binary_length(body))
        latin = pc.match_substring_regex(body, f"^{self.PLAIN.pattern}$")
        plain = pc.and_(latin, pc.utf8_is_alpha(body)).to_numpy(zero_copy_only=False) & (marks <= 1)
        out: list[bytes] = [b""] * len(chunks)
        at = np.flatnonzero(plain)
        words = _strings(pc.utf8_lower(body.take(pa.array(at))))
        for k, ids in zip(at.tolist(), self._of_words(words), strict=True):
            out[k] = ids
        marked = np.flatnonzero(plain & (marks == 1))
        for k, mark in zip(marked.tolist(), _strings(pc.utf8_slice_codeunits(chunks.take(pa.array(marked)), -1)), strict=True):
            out[k] += self.marks[mark]
        odd = np.flatnonzero(~plain & (np.asarray(pc.binary_length(chunks)) > 0))
        for k, ids in zip(odd.tolist(), self._odd(_strings(chunks.take(pa.array(odd)))), strict=True):
            out[k] = ids
        return out

    def _of_chunks(self, chunks: pa.Array) -> list[bytes]:
        """The ids of distinct chunks, from what the worker keeps or learnt."""
        names = _strings(chunks)
        found = list(map(self.of_chunk.get, names))
        lost = [k for k, ids in enumerate(found) if ids is None]
        if lost:
            learnt = self._learn_chunks(chunks.take(pa.array(lost, pa.int64())))
            for k, ids in zip(lost, learnt, strict=True):
                found[k] = ids
            if len(self.of_chunk) * ENTRY_BYTES > CACHED_BYTES:  # a full cache starts anew
                self.of_chunk.clear()
            for k, ids in zip(lost, learnt, strict=True):
                if len(names[k]) <= LONGEST_CACHED:
                    self.of_chunk[names[k]] = ids
        return found

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        """The ids of each text."""
        parts = pc.ascii_split_whitespace(texts)
        flat = parts.flatten().dictionary_encode()
        pool = self._of_chunks(flat.dictionary)
        all_ids = np.frombuffer(b"".join(pool), "<u4")
        length = np.fromiter(map(len, pool), np.int64, len(pool)) // 4
        first = np.cumsum(length) - length
        at = flat.indices.to_numpy(zero_copy_only=False)
        here = length[at]
        ends = np.cumsum(here)
        ids = all_ids[np.arange(ends[-1] if len(ends) else 0) + np.repeat(first[at] - ends + here, here)]
        cuts = np.concatenate([[0], ends])[parts.offsets.to_numpy() - parts.offsets[0].as_py()].tolist()
        return [ids[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


@lru_cache(maxsize=2)
def encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


def cut_positions(pos: np.ndarray, penalty: np.ndarray, costs: Costs) -> list[int]:
    """Indices into ``pos`` (ascending, from 0 to the end, no gap above ``size``) of the best cuts."""
    n, size = len(pos), costs.size
    exact: list[list[int] | None] = [None] * n
    length = costs.shortest
    while length <= size:
        at = np.searchsorted(pos, pos - length)
        for j in np.flatnonzero(pos[at] == pos - length).tolist():
            if exact[j] is None:
                exact[j] = []
            exact[j].append(int(at[j]))
        length *= 2
    places, fees = pos.tolist(), (penalty + costs.open_cost).tolist()
    best, came = [0.0] * n, [0] * n
    queue = deque([0])
    for j in range(1, n):
        here = places[j]
        while here - places[queue[0]] > size:
            queue.popleft()
        i = queue[0]
        least = best[i] + places[i] + size - here
        for k in exact[j] or ():
            if best[k] < least:
                least, i = best[k], k
        least += fees[j]
        best[j], came[j] = least, i
        key = least + here
        while queue and best[queue[-1]] + places[queue[-1]] >= key:
            queue.pop()
        queue.append(j)
    cuts, j = [n - 1], n - 1
    while j:
        j = came[j]
        cuts.append(j)
    return cuts[::-1]


def candidates(
    ids: np.ndarray, doc_ends: np.ndarray, ends_sentence: np.ndarray, costs: Costs
) -> tuple[np.ndarray, np.ndarray]:
    """Places where a cut may stand, and the penalty of each."""
    sentences = np.flatnonzero(ends_sentence[ids]) + 1
    firm = np.union1d(np.union1d(sentences, doc_ends), [0, len(ids)])
    gaps = np.diff(firm)
    long = np.flatnonzero(gaps > costs.grid)
    inner = [np.arange(firm[k] + costs.grid, firm[k + 1], costs.grid) for k in long]
    pos = np.union1d(firm, np.concatenate(inner)) if inner else firm
    penalty = np.full(len(pos), costs.inside)
    penalty[np.searchsorted(pos, sentences)] = costs.sentence
    penalty[np.searchsorted(pos, doc_ends)] = 0.0
    penalty[0] = penalty[-1] = 0.0
    return pos.astype(np.int64), penalty


class Stream:
    """The documents of one partition, handed in order; gives the pieces of finished sequences."""

    def __init__(self, ends_sentence: np.ndarray, costs: Costs, first_sequence: int) -> None:
        self.ends_sentence, self.costs, self.sequence = ends_sentence, costs, first_sequence
        self.ids: list[np.ndarray] = []
        self.docs: list[tuple[int | None, int, int, int]] = []  # id, whole length, start, length here
        self.n = 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.ids.append(ids)
        self.docs.append((doc_id, len(ids), 0, len(ids)))
        self.n += len(ids)

    def pieces(self, last: bool = False) -> list[tuple]:
        """Empty until a block is full; after it the pieces of all but its last two sequences."""
        if self.n < (1 if last else self.costs.block):
            return []
        ids = np.concatenate(self.ids)
        ends = np.cumsum([d[3] for d in self.docs])
        doc_ends = ends if self.docs[-1][2] + self.docs[-1][3] == self.docs[-1][1] else ends[:-1]
        pos, penalty = candidates(ids, doc_ends, self.ends_sentence, self.costs)
        cuts = pos[cut_positions(pos, penalty, self.costs)]
        if not last:
            cuts = cuts[: max(len(cuts) - 2, 1)]
        starts = ends - np.array([d[3] for d in self.docs])
        out = []
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            k = int(np.searchsorted(ends, a, side="right"))
            at = a
            while at < b:
                doc_id, whole, start, _ = self.docs[k]
                to = min(b, int(ends[k]))
                tokens = ids[at:to].astype("<u4").tobytes()
                begin = start + at - int(starts[k])
                out.append((doc_id, begin, to - at, tokens, whole, self.sequence, at - a))
                at, k = to, k + 1
            self.sequence += 1
        done = int(cuts[-1])
        k = int(np.searchsorted(ends, done, side="right"))
        self.ids = [ids[done:].copy()]
        rest = self.docs[k:]
        if rest:
            doc_id, whole, start, here = rest[0]
            gone = done - int(starts[k])
            rest[0] = (doc_id, whole, start + gone, here - gone)
        self.docs, self.n = rest, len(ids) - done
        return out


SCHEMA = (
    "doc_id long, start long, length long, tokens binary, doc_tokens long, sequence_id long, "
    "offset long"
)


def pack(
    docs: DataFrame,
    tokenizer: str,
    costs: Costs = Costs(),
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row per piece: where it lies in its document and in its sequence, and its ids.

    ``tokens`` holds the ids as little-endian unsigned 32-bit numbers. A document is its text's ids
    and the end id 2; a null or empty text has the end id alone. Every row of ``docs`` is packed,
    repeated rows and null ids included; other columns are not read. A partition is one stream, so
    nothing is shuffled, one sequence per partition may be left short, and a rerun of a task over
    the same rows gives the same pieces. Memory: a batch of texts and a block of tokens.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "start", "length", "tokens", "doc_tokens", "sequence_id", "offset"]
        types = [pa.int64()] * 3 + [pa.binary()] + [pa.int64()] * 3
        code = encoder(tokenizer)
        stream = Stream(code.ends_sentence, costs, TaskContext.get().partitionId() << 33)
        end = np.array([END_ID], np.uint32)

        def table(rows: list[tuple]) -> pa.RecordBatch:
            columns = zip(*rows, strict=True)
            arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
            return pa.RecordBatch.from_arrays(arrays, names)

        for batch in batches:
            keys = batch.column(0).to_pylist()
            texts = pc.fill_null(batch.column(1), "")
            size = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False)) // SLICE
            for part in np.split(np.arange(len(keys)), np.flatnonzero(np.diff(size)) + 1):
                if not len(part):
                    continue
                at = int(part[0])
                for k, ids in enumerate(code.encode(texts.slice(at, len(part)))):
                    stream.add(keys[at + k], np.concatenate([ids, end]))
                    if stream.n >= costs.block and (rows := stream.pieces()):
                        yield table(rows)
        if rows := stream.pieces(last=True):
            yield table(rows)
        give_back()

    rows = docs.select(docs[doc_id].cast("long"), docs[text].cast("string"))
    return rows.mapInArrow(run, SCHEMA)
