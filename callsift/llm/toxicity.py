"""Toxicity by compression distance: two zstandard dictionaries, one trained on toxic and one on
ordinary text.

Both continue the same base, trained on ordinary text, so that what all texts share compresses
alike. A window that comes out shorter with the toxic dictionary resembles toxic text; how many
windows gain how many bytes is calibrated to a probability. As a label says only that a document is
toxic somewhere, the toxic dictionary is trained again, on the parts of toxic documents that gain
most with a dictionary of other toxic documents.
"""

from __future__ import annotations

import random
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import zstandard as zs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callsift.llm.common import fit_logistic, kept_apart, labelled_sample, prior_log_odds, sigmoid, utf8
from callsift.session import written

HEADER = 600  # a trained dictionary starts with at most so many bytes of ids and entropy tables
AT_ONCE = 1 << 15  # windows compressed together
GAINS = (1, 2, 3, 4)  # bytes a window must gain to count


@dataclass(frozen=True)
class Shape:
    window: int = 64
    stride: int = 40
    base_bytes: int = 110_000
    own_bytes: int = 6_000
    rounds: int = 3
    best_per_doc: int = 5
    part: int = 32
    segment: int = 20
    penalty: float = 0.01


def windows(raw: bytes, shape: Shape, start: int = 0, most: int | None = None) -> list[bytes]:
    """Overlapping windows that cover the whole text; an empty text is one blank."""
    if not raw:
        return [b" "]
    last = max(len(raw) - shape.window + shape.stride, 1)
    stop = last if most is None else min(last, start + most * shape.stride)
    return [raw[i : i + shape.window] for i in range(start, stop, shape.stride)]


def compressor(content: bytes) -> zs.ZstdCompressor:
    parameters = zs.ZstdCompressionParameters(
        window_log=18, hash_log=17, chain_log=17, search_log=4, min_match=4, target_length=8,
        strategy=zs.STRATEGY_LAZY2, write_content_size=0, write_dict_id=0,
    )
    dictionary = zs.ZstdCompressionDict(content, dict_type=zs.DICT_TYPE_RAWCONTENT)
    dictionary.precompute_compress(compression_params=parameters)
    return zs.ZstdCompressor(compression_params=parameters, dict_data=dictionary)


def lengths(by: zs.ZstdCompressor, parts: list[bytes]) -> np.ndarray:
    out = by.multi_compress_to_buffer(parts, threads=1)
    return np.fromiter((len(out[k]) for k in range(len(out))), np.int64, len(out))


def trained(samples: Sequence[bytes], size: int, segment: int) -> bytes:
    """The content of a dictionary trained on the samples; the samples themselves if they are too
    few to train on."""
    try:
        whole = zs.train_dictionary(size, list(samples), k=segment, d=6).as_bytes()
    except zs.ZstdError:
        return b"".join(samples)[-size:]
    return whole[HEADER:]


@dataclass(frozen=True)
class Model:
    shape: Shape
    base: bytes
    ordinary: bytes
    toxic: bytes
    center: np.ndarray
    spread: np.ndarray
    weights: np.ndarray
    offset: float

    def compressors(self) -> tuple[zs.ZstdCompressor, zs.ZstdCompressor]:
        return compressor(self.ordinary + self.base), compressor(self.toxic + self.base)

    def probability(self, features: np.ndarray) -> float:
        return float(sigmoid((features - self.center) / self.spread @ self.weights + self.offset))


def features(gains: Iterator[np.ndarray]) -> np.ndarray:
    """Shares of windows by gain, the mean gain and the mean of positive gains, and the length."""
    n, total, above = 0, 0, 0
    counts = np.zeros(len(GAINS))
    for g in gains:
        n, total, above = n + len(g), total + g.sum(), above + np.maximum(g, 0).sum()
        counts += [(g >= k).sum() for k in GAINS]
    shares = np.array([*counts, total, above]) / n
    return np.concatenate([shares, np.log1p(counts), [np.log1p(n)]])


def gains_of(raw: bytes, shape: Shape, pair: tuple) -> Iterator[np.ndarray]:
    for start in range(0, max(len(raw), 1), AT_ONCE * shape.stride):
        parts = windows(raw, shape, start, AT_ONCE)
        if parts:
            yield lengths(pair[0], parts) - lengths(pair[1], parts)


def narrowed(window: bytes, pair: tuple, shape: Shape) -> bytes:
    """The part of a window that gains most, so that the dictionary takes up little around it."""
    parts = [window[i : i + shape.part] for i in range(0, max(len(window) - shape.part, 0) + 1, 4)]
    return parts[int((lengths(pair[0], parts) - lengths(pair[1], parts)).argmax())]


def best_parts(raw: bytes, pair: tuple, shape: Shape) -> list[bytes]:
    """The parts of a whole text that gain most."""
    gain = np.concatenate(list(gains_of(raw, shape, pair)))
    top = np.argsort(-gain, kind="stable")[: shape.best_per_doc]
    return [narrowed(windows(raw, shape, int(k) * shape.stride, 1)[0], pair, shape) for k in top if gain[k] > 0]


def searched(sample: DataFrame, halves: dict[int, tuple[int, ...]], contents: list[tuple], shape: Shape) -> list[list[bytes]]:
    """The best parts of the texts of each half, by the contents of its pair of dictionaries."""

    @F.pandas_udf("array<struct<half:int,part:binary>>")
    def best(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        pairs = [(compressor(a), compressor(b)) for a, b in contents]
        for ids, texts in batches:
            yield pd.Series(
                [
                    [
                        {"half": h, "part": part}
                        for h in halves.get(key, ())
                        for part in best_parts(utf8(text), pairs[h], shape)
                    ]
                    for key, text in zip(ids, texts, strict=True)
                ]
            )

    rows = sample.where("y = 1").select("doc_id", F.posexplode(best("doc_id", "text"))).collect()
    found = sorted((r["doc_id"], r["pos"], r["col"]["half"], bytes(r["col"]["part"])) for r in rows)
    return [[part for _, _, h, part in found if h == half] for half in (0, 1)]


def whole_features(sample: DataFrame, ids: set[int], contents: tuple, shape: Shape) -> tuple[np.ndarray, np.ndarray]:
    """Features over all windows of the sampled rows with these ids, and their labels."""

    @F.pandas_udf("array<double>")
    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        pair = compressor(contents[0]), compressor(contents[1])
        for keys, texts in batches:
            yield pd.Series(
                [
                    features(gains_of(utf8(text), shape, pair)) if key in ids else None
                    for key, text in zip(keys, texts, strict=True)
                ]
            )

    rows = sample.select("doc_id", "y", run("doc_id", "text").alias("x")).collect()
    known = sorted((r["doc_id"], r["y"], r["x"]) for r in rows if r["x"] is not None)
    return np.array([x for *_, x in known]), np.array([y for _, y, _ in known])


def fit(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "toxic",
    per_class: int = 3000,
    windows_per_doc: int = 100,
    shape: Shape = Shape(),
) -> Model | float:
    """A model fitted on a bounded sample of ``per_class`` labelled rows of each class. Where a class
    has no row, the prior probability instead. The result is calibrated to the classes' share among
    all labels.

    The first dictionaries are trained on at most ``windows_per_doc`` windows of each row, some 40 MB
    by default, which come to the driver. What toxic rows share is then searched in their whole texts,
    and the features that calibrate are those of whole texts, as in scoring: both are passes of Spark.
    """

    @F.pandas_udf("array<binary>")
    def cut(ids: pd.Series, texts: pd.Series) -> pd.Series:
        out = []
        for key, text in zip(ids, texts, strict=True):
            parts = windows(utf8(text), shape)
            if len(parts) > windows_per_doc:
                parts = random.Random(int(key)).sample(parts, windows_per_doc)
            out.append(parts)
        return pd.Series(out)

    sample = written(labelled_sample(docs, labels, label, per_class), "labelled")
    rows = sample.select("doc_id", "y", cut("doc_id", "text").alias("parts")).collect()
    known = sorted((r["doc_id"], r["y"], [bytes(w) for w in r["parts"]]) for r in rows)
    prior = prior_log_odds(labels, label)
    if len({y for _, y, _ in known}) < 2:
        return float(sigmoid(prior))
    fitted, apart = kept_apart({key: y for key, y, _ in known})
    plain = [w for key, y, ws in known if key in fitted and not y for w in ws]
    random.Random(1).shuffle(plain)
    base = trained(plain, shape.base_bytes, 48)
    ordinary = trained(plain[::2], shape.own_bytes, 32)
    toxic_ids = sorted({key for key, y, _ in known if y and key in fitted})
    halves = {key: (k % 2,) if len(toxic_ids) > 1 else (0, 1) for k, key in enumerate(toxic_ids)}
    chosen = [[w for key, _, ws in known if half in halves.get(key, ()) for w in ws] for half in (0, 1)]
    against = ordinary + base
    for _ in range(shape.rounds):
        own = [trained(c, shape.own_bytes, shape.segment) + base for c in chosen]
        # A document is searched with the other half's dictionary: what gains is what they share.
        found = searched(sample, halves, [(against, own[1]), (against, own[0])], shape)
        chosen = [new or c for new, c in zip(found, chosen, strict=True)]
    toxic = trained(chosen[0] + chosen[1], shape.own_bytes, shape.segment)
    x, y = whole_features(sample, apart, (against, toxic + base), shape)
    center, spread = x.mean(axis=0), x.std(axis=0) + 1e-6
    weights, offset = fit_logistic((x - center) / spread, y, shape.penalty)
    return Model(shape, base, ordinary, toxic, center, spread, weights, offset + prior)


def with_score(
    docs: DataFrame, model: Model | float, text: str = "text", out: str = "score"
) -> DataFrame:
    """Every row with the probability that it is toxic, from its whole text; runs in the row.

    Null and empty texts are scored as one blank. Equal texts score alike. A column named like
    ``out`` is replaced, other columns are left as they are.
    """
    if isinstance(model, float):
        return docs.withColumn(out, F.lit(model))

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        pair = model.compressors()
        for batch in batches:
            yield pd.Series(
                [model.probability(features(gains_of(utf8(t), model.shape, pair))) for t in batch],
                dtype="float64",
            )

    return docs.withColumn(out, score(F.col(text)))
