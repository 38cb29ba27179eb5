"""What several operators share: tables, the held-out rule, and word cutting."""

from __future__ import annotations

import contextlib
import ctypes

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with lines after it until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def give_back() -> None:
    """Hand freed memory back to the system: a worker lives on for the stages that follow."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def held_out(doc_id: Column | str) -> Column:
    """True for the rows that no fit may read: crc32 of the id's text is 2 modulo 4; a null id is not held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def utf8(text: str | None) -> bytes:
    """A null text is an empty one."""
    return b"" if text is None else text.encode("utf-8", "surrogatepass")


def words(raw: bytes) -> list[bytes]:
    """Runs without the characters 0x20 and 0x09-0x0D."""
    return raw.split()


def numbered(parts: list[bytes]) -> tuple[np.ndarray, list[bytes]]:
    """Each part's number in order of first sight, and the parts by number."""
    seen: dict[bytes, int] = {}
    ids = [seen.setdefault(p, len(seen)) for p in parts]
    return np.array(ids, dtype=np.int64), list(seen)


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, per_class: int
) -> DataFrame:
    """At most ``per_class`` labelled rows of each class (0 and 1) that a fit may read, as ``(text, y)``.

    Rows are chosen by a hash of their id, so a rerun takes the same ones. Held-out rows, null ids
    and other labels are left out; an id labelled twice counts once, with its larger label. Only ids
    and labels are ranked, and at most ``2 * per_class`` of them are joined to the texts.
    """
    known = (
        labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull())
        .where(~held_out("doc_id"))
        .groupBy("doc_id")
        .agg(F.max(label).cast("int").alias("y"))
        .withColumn("_at", F.xxhash64("doc_id"))
    )
    drawn = [
        known.where(F.col("y") == y).orderBy("_at", "doc_id").limit(per_class) for y in (0, 1)
    ]
    chosen = F.broadcast(drawn[0].unionByName(drawn[1]))  # bounded by per_class
    texts = docs.select("doc_id", "text").where(F.col("text").isNotNull())
    return texts.join(chosen, "doc_id").select("doc_id", "text", "y")


def kept_apart(classes: dict[int, int]) -> tuple[set[int], set[int]]:
    """Ids to train on and, a quarter, to calibrate on; all ids for both where one would lack a class."""
    ids = sorted(classes)
    parts = {i for k, i in enumerate(ids) if k % 4}, set(ids[::4])
    if min(len({classes[i] for i in part}) for part in parts) < 2:
        return set(ids), set(ids)
    return parts


def prior_log_odds(labels: DataFrame, label: str) -> float:
    """Log-odds of label 1 among all labels a fit may read, each class counted once more than seen."""
    row = (
        labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out("doc_id"))
        .agg(F.sum(label).alias("ones"), F.count("*").alias("n"))
        .first()
    )
    ones = row["ones"] or 0
    return float(np.log((ones + 1) / (row["n"] - ones + 1)))


def sigmoid(x: np.ndarray | float) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def fit_logistic(
    x: np.ndarray, y: np.ndarray, penalty: float = 1e-2, steps: int = 50
) -> tuple[np.ndarray, float]:
    """Weights and bias by Newton's method; both classes weigh alike, the penalty spares the bias."""
    a = np.column_stack([x, np.ones(len(x))])
    weight = np.where(y == 1, 0.5 / max((y == 1).sum(), 1), 0.5 / max((y == 0).sum(), 1))
    ridge = np.diag([penalty] * x.shape[1] + [1e-9])
    theta = np.zeros(a.shape[1])
    for _ in range(steps):
        p = sigmoid(a @ theta)
        slope = a.T @ (weight * (p - y)) + ridge @ theta
        curve = (a * (weight * p * (1 - p))[:, None]).T @ a + ridge
        step = np.linalg.solve(curve, slope)
        theta -= step
        if np.abs(step).max() < 1e-8:
            break
    return theta[:-1], float(theta[-1])
