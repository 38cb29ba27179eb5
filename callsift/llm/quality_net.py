"""Quality classifier: a byte-level convolutional network written in numpy.

A text is its UTF-8 bytes. Filters of ``width`` bytes slide over all of them; the largest answer of
each filter in each chunk is kept, chunks overlap by half and cover the whole text. A linear layer
turns a chunk's answers into a logit, and a document's probability comes from the mean over its
chunks. As the input is one-hot, a filter is a table of one weight per byte and place.
"""

from __future__ import annotations

import random
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callsift.llm.common import (
    fit_logistic,
    give_back,
    kept_apart,
    labelled_sample,
    prior_log_odds,
    sigmoid,
    utf8,
)
from callsift.session import written


@dataclass(frozen=True)
class Shape:
    """``half`` bytes are half a chunk; ``block`` bytes are convolved at a time."""

    width: int = 6
    filters: int = 16
    half: int = 256
    block: int = 8192


@dataclass(frozen=True)
class Net:
    shape: Shape
    tables: np.ndarray  # (width, 256, filters)
    bias: np.ndarray
    out: np.ndarray
    shift: float
    scale: float  # logit of a document = scale * mean chunk logit + offset
    offset: float

    def chunk_maxima(self, raw: bytes) -> np.ndarray:
        """Largest answer of each filter in each half-overlapping chunk of the whole text."""
        s = self.shape
        data = np.frombuffer(raw.ljust(s.width, b"\0"), np.uint8)
        n = len(data) - s.width + 1
        cells = []
        for at in range(0, n, s.block):  # block is a multiple of half
            m = min(s.block, n - at)
            z = self.tables[0][data[at : at + m]]
            for k in range(1, s.width):
                z += self.tables[k][data[at + k : at + k + m]]
            cells.append(np.maximum.reduceat(z, np.arange(0, m, s.half), axis=0))
        cell = np.concatenate(cells)
        return np.maximum(cell[:-1], cell[1:]) if len(cell) > 1 else cell

    def chunk_logits(self, raw: bytes) -> np.ndarray:
        return np.maximum(self.chunk_maxima(raw) + self.bias, 0) @ self.out + self.shift

    def probability(self, text: str | None) -> float:
        logit = self.scale * float(self.chunk_logits(utf8(text)).mean()) + self.offset
        return float(sigmoid(logit))


def chunks_of(raw: bytes, key: int, half: int, most: int) -> list[bytes]:
    """At most ``most`` of a text's chunks, drawn by ``key``."""
    starts = list(range(0, max(len(raw) - half, 1), half))
    if len(starts) > most:
        starts = random.Random(key).sample(starts, most)
    return [raw[s : s + 2 * half] for s in starts]


def train(
    chunks: list[bytes], y: np.ndarray, shape: Shape, epochs: int, seed: int = 1, batch: int = 64
) -> Net:
    """Adam on the cross-entropy of chunk logits; a filter's gradient falls on its best place only."""
    rng = np.random.default_rng(seed)
    half = shape.half
    size = 2 * half
    data = np.zeros((len(chunks), size), np.uint8)
    length = np.zeros(len(chunks), np.int64)
    for k, c in enumerate(chunks):
        data[k, : len(c)] = np.frombuffer(c, np.uint8)
        length[k] = max(len(c), shape.width)
    places = size - shape.width + 1
    params = [
        rng.normal(0, 0.3, (shape.width, 256, shape.filters)).astype(np.float32),
        np.zeros(shape.filters, np.float32),
        rng.normal(0, 0.3, shape.filters).astype(np.float32),
        np.zeros(1, np.float32),
    ]
    first = [np.zeros_like(p) for p in params]
    second = [np.zeros_like(p) for p in params]
    column, step = np.arange(shape.filters), 0
    for epoch in range(epochs):
        rate = 0.02 * 0.5 ** (epoch // 2)
        order = rng.permutation(len(chunks))
        for at in range(0, len(order), batch):
            rows = order[at : at + batch]
            x = data[rows]
            z = params[0][0][x[:, :places]]
            for k in range(1, shape.width):
                z += params[0][k][x[:, k : k + places]]
            seen = length[rows].copy()  # a quarter is cut short, as short texts are to be judged too
            seen[::4] = np.minimum(seen[::4], rng.integers(2 * shape.width, half, len(seen[::4])))
            outside = np.arange(places)[None, :] > (seen - shape.width)[:, None]
            z[outside] = -1e30
            best = z.argmax(axis=1)
            top = np.take_along_axis(z, best[:, None, :], axis=1)[:, 0, :]
            h = np.maximum(top + params[1], 0)
            error = ((sigmoid(h @ params[2] + params[3]) - y[rows]) / len(rows)).astype(np.float32)
            back = error[:, None] * params[2] * (h > 0)
            tables = np.zeros_like(params[0])
            for k in range(shape.width):
                byte = np.take_along_axis(x, best + k, axis=1)
                np.add.at(tables[k], (byte, column[None, :]), back)
            slopes = [
                tables + 1e-5 * params[0],
                back.sum(axis=0),
                h.T @ error + 1e-4 * params[2],
                error.sum(keepdims=True),
            ]
            step += 1
            for p, g, m, v in zip(params, slopes, first, second, strict=True):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return Net(shape, params[0], params[1], params[2], float(params[3][0]), 1.0, 0.0)


def fit(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "quality",
    per_class: int = 3000,
    chunks_per_doc: int = 4,
    epochs: int = 6,
    shape: Shape = Shape(),
) -> Net | float:
    """A network fitted on a bounded sample of ``per_class`` labelled rows of each class. Where a
    class has no row, the prior probability instead.

    It is trained on ``chunks_per_doc`` chunks of each row, which the driver sees, 12 MB by default. A
    document's mean chunk logit over its whole text, as in scoring, is calibrated in a second pass of
    Spark, on a quarter of the documents kept out of the training, to the classes' share among all
    labels that a fit may read.
    """
    half = shape.half

    @F.pandas_udf("array<binary>")
    def cut(ids: pd.Series, texts: pd.Series) -> pd.Series:
        return pd.Series(
            [chunks_of(utf8(t), int(k), half, chunks_per_doc) for k, t in zip(ids, texts, strict=True)]
        )

    sample = written(labelled_sample(docs, labels, label, per_class), "labelled")
    rows = sample.select("doc_id", "y", cut("doc_id", "text").alias("chunks")).collect()
    rows.sort(key=lambda r: (r["doc_id"], r["y"], [bytes(c) for c in r["chunks"]]))
    prior = prior_log_odds(labels, label)
    if len({r["y"] for r in rows}) < 2:
        return float(sigmoid(prior))
    ids, apart = kept_apart({r["doc_id"]: r["y"] for r in rows})
    fitted = [r for r in rows if r["doc_id"] in ids]
    chunks = [bytes(c) for r in fitted for c in r["chunks"]]
    net = train(chunks, np.array([r["y"] for r in fitted for _ in r["chunks"]]), shape, epochs)

    @F.pandas_udf("double")
    def mean_logit(ids: pd.Series, texts: pd.Series) -> pd.Series:
        means = [
            float(net.chunk_logits(utf8(t)).mean()) if k in apart else None
            for k, t in zip(ids, texts, strict=True)
        ]
        return pd.Series(means, dtype="float64")

    rows = sample.select("doc_id", "y", mean_logit("doc_id", "text").alias("x")).collect()
    known = sorted((r["doc_id"], r["y"], r["x"]) for r in rows if r["doc_id"] in apart)
    means, y = np.array([[x] for *_, x in known]), np.array([y for _, y, _ in known])
    scale, offset = fit_logistic(means, y, penalty=1e-4)
    return Net(
        shape, net.tables, net.bias, net.out, net.shift, float(scale[0]), offset + prior
    )


def with_score(
    docs: DataFrame, model: Net | float, text: str = "text", out: str = "score"
) -> DataFrame:
    """Every row with the probability of label 1, from its whole text; runs in the row.

    Null and empty texts are scored as one zero-filled chunk. Equal texts score alike. A column
    named like ``out`` is replaced, other columns are left as they are.
    """
    if isinstance(model, float):
        return docs.withColumn(out, F.lit(model))

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([model.probability(t) for t in batch], dtype="float64")
        give_back()

    return docs.withColumn(out, score(F.col(text)))
