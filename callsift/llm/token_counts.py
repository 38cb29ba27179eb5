"""Token counts: how many word pieces greedy longest match gives, without building the pieces.

A trie of the vocabulary has a failure link at every node, to where the search stands after the
longest pieces of what was read are taken off, and the number of pieces taken off on the way. A
word is then counted in one pass over its bytes, in time linear in its length.
"""

from __future__ import annotations

import json
import re
from collections import deque
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callsift.llm.common import free_name

WORD = re.compile(r"\w+|[^\w\s]")
CACHED = 500_000
LONGEST_CACHED = 64


class PieceCounter:
    """``start`` pieces begin a word, ``inner`` pieces go on with it. A word that they cannot spell
    counts as one unknown piece."""

    def __init__(self, start: Iterable[bytes], inner: Iterable[bytes]) -> None:
        edges: list[dict[int, int]] = [{}, {}]  # 0: the start of a word, 1: inside it
        is_piece = [False, False]
        for root, pieces in ((0, start), (1, inner)):
            for piece in pieces:
                node = root
                for byte in piece:
                    if byte not in edges[node]:
                        edges[node][byte] = len(edges)
                        edges.append({})
                        is_piece.append(False)
                    node = edges[node][byte]
                is_piece[node] = is_piece[node] or bool(piece)
        fail, popped = [-1] * len(edges), [0] * len(edges)
        queue = deque([0, 1])
        while queue:
            node = queue.popleft()
            for byte, child in edges[node].items():
                if is_piece[child]:
                    fail[child], popped[child] = 1, 1
                else:
                    at, count = fail[node], popped[node]
                    while at >= 0 and byte not in edges[at]:
                        count += popped[at]
                        at = fail[at]
                    if at >= 0:
                        fail[child], popped[child] = edges[at][byte], count
                queue.append(child)
        self.fail, self.popped = np.array(fail), np.array(popped)
        keys = [(node << 8 | byte, to) for node, out in enumerate(edges) for byte, to in out.items()]
        table = np.array(sorted(keys) or [(-1, 0)], np.int64)
        self.keys, self.to = table[:, 0].copy(), table[:, 1].copy()

    def _next(self, node: np.ndarray, byte: np.ndarray) -> np.ndarray:
        key = node << 8 | byte
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.to[at], -1)

    def count(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Pieces of each word, and whether it is unknown. All words advance together."""
        length = np.array([len(w) for w in words], np.int64)
        order = np.argsort(-length, kind="stable")
        flat = np.frombuffer(b"".join(words), np.uint8)
        first = (np.cumsum(length) - length)[order]
        length = length[order]
        node, pieces = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        lost = np.zeros(len(words), bool)
        for step in range(int(length[0]) if len(words) else 0):
            live = np.flatnonzero(~lost[: np.searchsorted(-length, -step, side="left")])
            byte = flat[first[live] + step].astype(np.int64)
            while len(live):
                to = self._next(node[live], byte)
                found = to >= 0
                node[live[found]] = to[found]
                live, byte = live[~found], byte[~found]
                dead = self.fail[node[live]] < 0
                lost[live[dead]] = True
                live, byte = live[~dead], byte[~dead]
                pieces[live] += self.popped[node[live]]
                node[live] = self.fail[node[live]]
        live = np.flatnonzero(~lost & (length > 0))
        while len(live := live[node[live] != 1]):
            dead = self.fail[node[live]] < 0
            lost[live[dead]] = True
            live = live[~dead]
            pieces[live] += self.popped[node[live]]
            node[live] = self.fail[node[live]]
        pieces[lost] = 1
        back = np.empty(len(words), np.int64)
        back[order] = np.arange(len(words))
        return pieces[back], lost[back]


def byte_alphabet() -> dict[str, int]:
    """The printable characters that stand for bytes in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


@lru_cache(maxsize=2)
def counter_of(path: str) -> PieceCounter:
    """Pieces of a byte-level tokenizer file: those after a space start words, the others go on."""
    with open(path, encoding="utf-8") as file:
        vocabulary = json.load(file)["model"]["vocab"]
    alphabet = byte_alphabet()
    space = next(c for c, b in alphabet.items() if b == 32)
    known = [t for t in vocabulary if all(c in alphabet for c in t)]
    start = [bytes(alphabet[c] for c in t[1:]) for t in known if t[0] == space]
    inner = [bytes(alphabet[c] for c in t) for t in known if t[0] != space]
    return PieceCounter(start, inner)


_CHUNKS: dict[tuple[str, str], tuple[int, int, int]] = {}


def count_texts(texts: pa.Array, path: str) -> np.ndarray:
    """``(words, pieces, unknown words)`` of each text; distinct chunks between spaces are counted once."""
    parts = pc.ascii_split_whitespace(texts)
    flat = parts.flatten().dictionary_encode()
    chunks = flat.dictionary.to_pylist()
    if len(_CHUNKS) > CACHED:
        _CHUNKS.clear()
    values = [_CHUNKS.get((path, c)) for c in chunks]
    new = [k for k, v in enumerate(values) if v is None]
    words_of = [WORD.findall(chunks[k]) for k in new]
    distinct = list({w for ws in words_of for w in ws})
    pieces, lost = counter_of(path).count([w.encode("utf-8", "surrogatepass") for w in distinct])
    of_word = dict(zip(distinct, zip(pieces.tolist(), lost.tolist(), strict=True), strict=True))
    for k, ws in zip(new, words_of, strict=True):
        each = [of_word[w] for w in ws]
        values[k] = (len(ws), sum(p for p, _ in each), sum(u for _, u in each))
        if len(chunks[k]) <= LONGEST_CACHED:
            _CHUNKS[path, chunks[k]] = values[k]
    table = np.array(values or [(0, 0, 0)], np.int64)
    at = flat.indices.to_numpy(zero_copy_only=False)
    offsets = parts.offsets.to_numpy() - parts.offsets[0].as_py()
    sums = np.concatenate([np.zeros((1, 3), np.int64), np.cumsum(table[at], axis=0)])
    return sums[offsets[1:]] - sums[offsets[:-1]]


def with_counts(docs: DataFrame, vocabulary: str, text: str = "text") -> DataFrame:
    """Every row with ``n_words, n_tokens, n_unknown`` of its whole text; runs in the row.

    A word is a run of word characters or one other character that is no white space; case counts.
    An unknown word counts as one token. Null, empty and blank texts have zeros. Equal texts count
    alike; columns of these names are replaced, others are left as they are.
    """

    @F.pandas_udf("n_words long, n_tokens long, n_unknown long")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [
                count_texts(pa.array(part.fillna("").tolist(), pa.large_string()).cast(pa.string()), vocabulary)
                for part in _slices(batch)
            ]
            yield pd.DataFrame(
                np.concatenate(found or [np.zeros((0, 3), np.int64)]), columns=["n_words", "n_tokens", "n_unknown"]
            )

    free = free_name(docs, "_t")
    counted = docs.withColumn(free, run(F.col(text)))
    return counted.withColumns({c: F.col(free)[c] for c in ("n_words", "n_tokens", "n_unknown")}).drop(free)


def _slices(batch: pd.Series, characters: int = 8 << 20) -> Iterator[pd.Series]:
    size = batch.str.len().fillna(0).cumsum() // characters
    for _, part in batch.groupby(size.to_numpy(), sort=True):
        yield part
