"""SentencePiece encoding and decoding: the segmentation of highest total score, by batched Viterbi.

A text's spaces become the mark U+2581 and a mark is put before it. No piece runs from a word into
the next mark, so words are segmented apart, each distinct one once. Words of equal length advance
together: hashes of their substrings probe the sorted hashes of the pieces, what is found is
compared character by character, and each place keeps the best way to reach it.
"""

from __future__ import annotations

import re
from array import array
from collections import defaultdict
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_type
from pyspark.sql.types import StructType

from callsift.llm.common import free_name, give_back

MARK = "▁"
WORD = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")
BASE = np.uint64(0x9E3779B97F4A7C15)
CACHED_BYTES = 48 << 20  # of known words that a worker keeps before it starts anew
ENTRY_BYTES = 240  # of a known word besides its characters and ids
LONGEST_CACHED = 64
LIKELY_SHIFT = np.uint64(44)
CELLS = 1 << 16  # places segmented at a time
SLICE = 1 << 19  # characters encoded at a time


def code_points(words: list[str]) -> np.ndarray:
    """Of words of one length, a row each."""
    joined = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
    return joined.reshape(len(words), -1)


class Pieces:
    def __init__(self, path: str) -> None:
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        names = [model.id_to_piece(i) for i in range(model.vocab_size())]
        plain = [
            i
            for i in range(len(names))
            if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))
        ]
        if any(re.search(f"[^{MARK}]{MARK}", names[i]) for i in plain):
            raise ValueError("a piece runs over a word's end")
        self.byte_id = np.full(256, model.unk_id(), np.int64)
        for i in range(len(names)):
            if model.is_byte(i):
                self.byte_id[int(names[i][3:5], 16)] = i
        self.bytes_of = [n.replace(MARK, " ").encode() for n in names]
        for i, n in enumerate(names):
            if model.is_byte(i):
                self.bytes_of[i] = bytes([int(n[3:5], 16)])
            elif model.is_control(i):
                self.bytes_of[i] = b""
        self.score = np.array([model.get_score(i) for i in range(len(names))], np.float64)
        self.unknown = float(self.score[plain].min()) - 10 if plain else -10.0
        self.longest = max((len(names[i]) for i in plain), default=1)
        keys = []
        self.codes = np.zeros((len(names), self.longest), np.uint32)
        for i in plain:
            codes = code_points([names[i]])[0]
            self.codes[i, : len(codes)] = codes
            keys.append((int(self.hashes(codes[None, :])[0, -1]), i))
        keys.sort()
        self.keys = np.array([k for k, _ in keys] or [0], np.uint64)
        self.ids = np.array([i for _, i in keys] or [-1], np.int64)
        self.powers = np.cumprod(np.concatenate([[np.uint64(1)], np.full(self.longest, BASE)]))
        self.likely = np.zeros(1 << 20, bool)  # by the first bits of a key: most others need no probe
        self.likely[self.keys >> LIKELY_SHIFT] = True
        self.known: dict[str, bytes] = {}
        self.held = 0

    @staticmethod
    def hashes(codes: np.ndarray) -> np.ndarray:
        """Of each prefix of each row, the empty one first."""
        out = np.zeros((codes.shape[0], codes.shape[1] + 1), np.uint64)
        for k in range(codes.shape[1]):
            out[:, k + 1] = out[:, k] * BASE + codes[:, k] + np.uint64(1)
        return out

    def matches(self, codes: np.ndarray, first: int, stop: int) -> tuple[np.ndarray, ...]:
        """Pieces that end after one of the places ``first`` to ``stop - 1``: rows, ends, sizes, ids."""
        low = max(first + 1 - self.longest, 0)
        prefix = self.hashes(codes[:, low:stop])
        found = []
        for size in range(1, min(self.longest, stop) + 1):
            lowest = max(first + 1, size)
            if lowest > stop:
                continue
            a, b = lowest - low, stop + 1 - low
            hashed = prefix[:, a:b] - prefix[:, a - size : b - size] * self.powers[size]
            row, k = np.nonzero(self.likely[hashed >> LIKELY_SHIFT])
            hashed, end = hashed[row, k], k + lowest
            at = np.minimum(np.searchsorted(self.keys, hashed), len(self.keys) - 1)
            hit = np.flatnonzero((self.keys[at] == hashed) & (self.ids[at] >= 0))
            row, end, ids = row[hit], end[hit], self.ids[at[hit]]
            same = np.ones(len(ids), bool)
            for i in range(size):
                same &= self.codes[ids, i] == codes[row, end - size + i]
            if size < self.longest:
                same &= self.codes[ids, size] == 0
            found.append((row[same], end[same], np.full(same.sum(), size), ids[same]))
        return tuple(np.concatenate(x) for x in zip(*found, strict=True))

    def segment(self, words: list[str]) -> list[bytes]:
        """The ids of words of one length as little-endian 32-bit numbers; of equally good ways the
        one whose last piece is longest.

        Places are worked off in windows of ``CELLS`` cells in all; of a place, only the piece that
        ends there and its size are kept, five bytes.
        """
        codes = code_points(words)
        n, length = codes.shape
        most = min(self.longest, length)
        via = np.full((n, length + 1), -1, np.int32)
        sizes = np.ones((n, length + 1), np.uint8)
        step = max(CELLS // n, 1)
        forward = self._forward_few if n * 16 <= length else self._forward
        best = np.full((n, most), -np.inf)  # of the last places, the latest at the end
        best[:, -1] = 0
        for first in range(0, length, step):
            stop = min(first + step, length)
            best = forward(self.matches(codes, first, stop), first, stop, best, via, sizes)
        return self._back_all(words, via, sizes) if length <= LONGEST_CACHED else [
            self._back(word, via[r], sizes[r]) for r, word in enumerate(words)
        ]

    def _forward(self, found, first: int, stop: int, last: np.ndarray, via: np.ndarray, sizes: np.ndarray):
        """All rows advance together by one place after the other."""
        row, end, size, ids = found
        n, most = last.shape
        piece = np.full((n, stop - first, most), -1, np.int32)  # by end and size, longest first
        score = np.full((n, stop - first, most), -np.inf)
        piece[row, end - first - 1, most - size] = ids
        score[row, end - first - 1, most - size] = self.score[ids]
        score[:, :, most - 1][piece[:, :, most - 1] < 0] = self.unknown
        best = np.concatenate([last, np.empty((n, stop - first))], axis=1)
        rows = np.arange(n)
        for k in range(stop - first):
            ways = best[:, k : k + most] + score[:, k]
            way = ways.argmax(axis=1)  # the first, so the longest piece
            best[:, most + k] = ways[rows, way]
            via[:, first + 1 + k] = piece[rows, k, way]
            sizes[:, first + 1 + k] = most - way
        return best[:, -most:]

    def _forward_few(self, found, first: int, stop: int, last: np.ndarray, via: np.ndarray, sizes: np.ndarray):
        """The same for few long words, by the pieces that are there."""
        row, end, size, ids = found
        n, most = last.shape
        out = np.empty_like(last)
        for r in range(n):
            mine = np.flatnonzero(row == r)
            mine = mine[np.lexsort((-size[mine], end[mine]))]
            cuts = np.searchsorted(end[mine], np.arange(first + 1, stop + 2)).tolist()
            sizes_, ids_ = size[mine].tolist(), ids[mine].tolist()
            scores = self.score[ids[mine]].tolist()
            best = last[r].tolist()
            here_via, here_size = [-1] * (stop - first), [1] * (stop - first)
            for k in range(stop - first):
                top, single = -np.inf, False
                for at in range(cuts[k], cuts[k + 1]):
                    way = best[-sizes_[at]] + scores[at]
                    single = single or sizes_[at] == 1
                    if way > top:
                        top, here_via[k], here_size[k] = way, ids_[at], sizes_[at]
                if not single and best[-1] + self.unknown > top:
                    top, here_via[k], here_size[k] = best[-1] + self.unknown, -1, 1
                best.append(top)
                if len(best) > 4 * most + 4096:
                    del best[: -most]
            via[r, first + 1 : stop + 1], sizes[r, first + 1 : stop + 1] = here_via, here_size
            out[r] = best[-most:]
        return out

    def _back_all(self, words: list[str], via: np.ndarray, sizes: np.ndarray) -> list[bytes]:
        """All words go back together by one piece after the other."""
        rows, end = np.arange(len(words)), np.full(len(words), len(words[0]))
        steps = []
        while end.any():
            steps.append(np.where(end > 0, via[rows, end], -2))
            end = np.where(end > 0, end - sizes[rows, end], 0)
        ids = np.stack(steps[::-1], axis=1)
        raw = ids[ids != -2].astype("<u4").tobytes()
        cuts = [0, *(4 * np.cumsum((ids != -2).sum(axis=1))).tolist()]
        out = [raw[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        for r in np.flatnonzero((ids == -1).any(axis=1)).tolist():  # characters without a piece
            out[r] = self._back(words[r], via[r], sizes[r])
        return out

    def _back(self, word: str, via: np.ndarray, sizes: np.ndarray) -> bytes:
        ids, end = array("I"), len(word)
        via, sizes = array("i", via.tobytes()), bytes(sizes)
        while end:
            i = via[end]
            if i >= 0:
                ids.append(i)
            else:
                raw = word[end - 1].encode("utf-8", "surrogatepass")
                ids.extend(self.byte_id[list(raw)].tolist()[::-1])
            end -= sizes[end]
        ids.reverse()
        return ids.tobytes()

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        parts = [WORD.findall(MARK + t.replace(" ", MARK)) if t else [] for t in texts]
        if self.held > CACHED_BYTES:
            self.known.clear()
            self.held = 0
        new: dict[int, list[str]] = defaultdict(list)
        for w in {w for ws in parts for w in ws}:
            if w not in self.known:
                new[len(w)].append(w)
        here: dict[str, bytes] = {}
        for length, ws in new.items():
            step = max(CELLS // length, 1)
            for at in range(0, len(ws), step):
                some = ws[at : at + step]
                here.update(zip(some, self.segment(some), strict=True))
        self.known.update(here)
        ids = [np.frombuffer(b"".join(map(self.known.__getitem__, ws)), "<u4") for ws in parts]
        for w, found in here.items():
            if len(w) > LONGEST_CACHED:
                del self.known[w]
            else:
                self.held += ENTRY_BYTES + 2 * len(w) + len(found)
        return ids

    def decode(self, ids: np.ndarray) -> str:
        """The text of the ids, without the space put before it."""
        raw = b"".join(map(self.bytes_of.__getitem__, ids.tolist()))
        return raw.removeprefix(b" ").decode("utf-8", "replace")


@lru_cache(maxsize=2)
def pieces_of(path: str) -> Pieces:
    return Pieces(path)


def _mapped(df: DataFrame, source: str, weight: int, new: dict[str, pa.DataType], give: Callable) -> DataFrame:
    """Every row with the columns that ``give`` makes of ``source``, some ``SLICE`` characters at a time;
    ``weight`` is the bytes of a character. Columns of the same names are replaced."""
    kept = [c for c in df.columns if c not in new]
    rows = df.select(F.col(f"`{source}`").alias(free_name(df, "_source")), *[F.col(f"`{c}`") for c in kept])
    schema = StructType([f for f in df.schema if f.name in kept])
    for name, kind in new.items():
        schema = schema.add(name, from_arrow_type(kind))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = pc.fill_null(
                pc.binary_length(batch.column(0)) if weight == 1 else pc.list_value_length(batch.column(0)), 0
            )
            part = np.cumsum(lengths.to_numpy(zero_copy_only=False)) * weight // SLICE
            cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                some = batch.slice(a, b - a)
                arrays = [pa.array(v, t) for v, t in zip(give(some.column(0)), new.values(), strict=True)]
                yield pa.RecordBatch.from_arrays([*some.columns[1:], *arrays], [*kept, *new])
        give_back()

    return rows.mapInArrow(run, schema)


def with_ids(
    docs: DataFrame, model: str, text: str = "text", out: str = "ids", decoded: str | None = None
) -> DataFrame:
    """Every row with the piece ids of its whole text, and, in a column ``decoded``, the text they give
    back; runs in the row.

    Null and empty texts have no ids. A character that no piece has is given as its UTF-8 bytes.
    Equal texts are encoded alike. Columns named like the new ones are replaced. Memory: a batch of
    texts, the ids of ``SLICE`` characters, some 70 bytes a character of the longest word without
    white space, and a bounded cache of words.
    """
    new = {out: pa.list_(pa.int32())} | ({decoded: pa.string()} if decoded else {})

    def give(texts: pa.Array) -> list[list]:
        code = pieces_of(model)
        ids = code.encode([t or "" for t in texts.to_pylist()])
        return [[x.astype(np.int32) for x in ids], *([[code.decode(x) for x in ids]] if decoded else [])]

    return _mapped(docs.withColumn(text, F.col(f"`{text}`").cast("string")), text, 1, new, give)


def with_text(docs: DataFrame, model: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """Every row with the text of its ids; null ids give an empty text. Decoding an encoded text
    gives it back, with U+2581 as a space. A column named like ``out`` is replaced."""

    def give(rows: pa.Array) -> list[list]:
        code = pieces_of(model)
        return [["" if x is None else code.decode(np.asarray(x, np.int64)) for x in rows.to_pylist()]]

    return _mapped(docs, ids, 4, {out: pa.string()}, give)
