"""URL filter: rules by host and path, and a character model for urls that no rule fits.

Two smoothed variable-order Markov models count the urls that rules accept and reject, all of them,
in Spark. A url is judged by the difference of its log-likelihoods per character, against a
threshold calibrated on ruled urls kept out of the counts.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from callsift.llm import language_model as lm
from callsift.session import written

ALLOW, BLOCK = "allow", "block"
COUNTED = 1 << 20  # grams that a task counts before it hands them on
SLICE = 20_000  # urls looked up at a time


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


def rule(verdict: str, text: str) -> Rule:
    """``rule("block", "example.com/en/")``."""
    host, slash, path = text.partition("/")
    return Rule(verdict, host, slash + path)


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without one."""
    found = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    lowered = F.translate(found, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.coalesce(lowered, F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def first_rule(host: Column, path: Column, rules: Sequence[Rule], value) -> Column:
    """``value`` of the longest rule that fits; null without one. Of rules of equal length the first counts."""
    out = F.lit(None).cast("string")
    for r in sorted(reversed(rules), key=lambda r: len(r.name)):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        out = F.when(fits, F.lit(value(r))).otherwise(out)
    return out


class MarkovModel:
    """Character model of variable order: each order is blended with the next lower one in
    proportion to how much was seen in its context (Witten-Bell), down to the uniform one."""

    def __init__(self, texts: Sequence[str], order: int) -> None:
        self.order = order
        self.pairs: Counter[str] = Counter()  # context and character
        for t in texts:
            padded = "\x02" * order + t + "\x03"
            for k in range(order, len(padded)):
                for m in range(order + 1):
                    self.pairs[padded[k - m : k + 1]] += 1
        self.seen: Counter[str] = Counter()
        self.kinds: Counter[str] = Counter()
        for gram, n in self.pairs.items():
            self.seen[gram[:-1]] += n
            self.kinds[gram[:-1]] += 1
        self.log: dict[str, float] = {}

    def log_probability(self, gram: str) -> float:
        """Of a gram's last character after the characters before it."""
        if gram not in self.log:
            if len(self.log) > 500_000:
                self.log.clear()
            p = 1 / 1024
            for m in range(len(gram)):
                part = gram[len(gram) - 1 - m :]
                n, kinds = self.seen[part[:-1]], self.kinds[part[:-1]]
                if n:
                    p = (self.pairs[part] + kinds * p) / (n + kinds)
            self.log[gram] = float(np.log(p))
        return self.log[gram]


@dataclass(frozen=True)
class UrlModel:
    accepted: MarkovModel
    rejected: MarkovModel
    threshold: float

    def difference(self, url: str | None) -> float:
        """Log-likelihood under the accepted minus the rejected model, per character; the end counts."""
        order = self.accepted.order
        padded = "\x02" * order + (url or "") + "\x03"
        grams = [padded[k - order : k + 1] for k in range(order, len(padded))]
        yes, no = self.accepted.log_probability, self.rejected.log_probability
        return sum(yes(g) - no(g) for g in grams) / len(grams)


def fit_model(accepted: list[str], rejected: list[str], order: int = 4) -> UrlModel:
    """Trained on four fifths; the threshold makes the fewest errors, each class weighing alike, on
    the rest, and lies between two differences seen there."""
    parts = [(sorted(x)[::5], [u for k, u in enumerate(sorted(x)) if k % 5]) for x in (accepted, rejected)]
    parts = [(held or rest, rest or held) for held, rest in parts]
    model = UrlModel(MarkovModel(parts[0][1], order), MarkovModel(parts[1][1], order), 0.0)
    scored = [(model.difference(u), 1 / len(parts[0][0]), 0.0) for u in parts[0][0]]
    scored += [(model.difference(u), 0.0, 1 / len(parts[1][0])) for u in parts[1][0]]
    scored.sort()
    values = np.array([s for s, *_ in scored])
    wrong = np.cumsum([0.0] + [a - r for _, a, r in scored]) + 1.0  # blocking the first k
    edges = np.concatenate([[values[0] - 1], (values[1:] + values[:-1]) / 2, [values[-1] + 1]])
    best = np.flatnonzero(wrong <= wrong.min() + 1e-12)
    middle = best[np.abs(edges[best]).argmin()]  # of equally good ones the nearest to no difference
    return UrlModel(model.accepted, model.rejected, float(edges[middle]))


# --- models counted in Spark --------------------------------------------------------------------

CLASSES = (ALLOW, BLOCK)
SHARD_GRAMS = 1 << 21  # expected rows of a shard


def grams_of(url: str | None, order: int) -> list[str]:
    """Each character, and the end, after the ``order`` characters before it."""
    padded = "\x02" * order + (url or "") + "\x03"
    return [padded[k - order : k + 1] for k in range(order, len(padded))]


def _hashes(grams: Sequence[str]) -> np.ndarray:
    raw = (lm.word_hash(g.encode("utf-8", "surrogatepass")) for g in grams)
    return np.fromiter(raw, np.uint64, len(grams))


def _count_grams(known: DataFrame, order: int, bits: int) -> DataFrame:
    """Grams of every length up to ``order + 1`` by hash, with the hash of their context, and how often
    each stands in urls of each verdict."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: tuple[Counter[str], Counter[str]] = Counter(), Counter()

        def flush() -> Iterator[pa.RecordBatch]:
            names = list(counts[0] | counts[1])
            columns = {f"n{k}": np.array([c[g] for g in names], np.int64) for k, c in enumerate(counts)}
            context = _hashes([g[:-1] for g in names]).view(np.int64)
            yield from lm.counted(_hashes(names), bits, columns | {"context": context})
            for c in counts:
                c.clear()

        for batch in batches:
            for url, verdict in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                own = counts[CLASSES.index(verdict)]
                for gram in grams_of(url, order):
                    own.update([gram[m:] for m in range(order + 1)])
                if len(counts[0]) + len(counts[1]) > COUNTED:
                    yield from flush()
        yield from flush()

    return known.select("_u", "_v").mapInArrow(run, "shard long, key long, n0 long, n1 long, context long")


def _count_contexts(spark: SparkSession, grams: lm.Table, bits: int) -> DataFrame:
    """What follows each context in urls of each verdict: how many characters, and how many kinds."""

    def give(arrays: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
        n = [arrays[f"n{k}"].astype(np.int64) for k in (0, 1)]
        sums = [n[0], n[1], (n[0] > 0).astype(np.int64), (n[1] > 0).astype(np.int64)]
        key, sums, _ = lm.merged(arrays["context"].view(np.uint64), sums, [])
        yield from lm.counted(key, bits, dict(zip(("seen0", "seen1", "kinds0", "kinds1"), sums, strict=True)))

    return lm.from_shards(spark, grams, give, ["seen0", "seen1", "kinds0", "kinds1"])


@dataclass(frozen=True)
class SpreadModel:
    """Both models as tables of sorted hash arrays; a worker maps what it looks up."""

    order: int
    grams: lm.Table
    contexts: lm.Table

    def _found(self, table: lm.Table, names: list[str], columns: list[str]) -> list[np.ndarray]:
        distinct, at = np.unique(_hashes(names), return_inverse=True)
        return [v[at] for v in table.lookup(distinct, columns)[1]]

    def gains(self, grams: list[str]) -> np.ndarray:
        """Of distinct grams the log-probability of the last character under the accepted model less
        that under the rejected one; each order is blended with the next lower one (Witten-Bell)."""
        p = np.full((2, len(grams)), 1 / 1024)
        for m in range(self.order + 1):
            parts = [g[len(g) - 1 - m :] for g in grams]
            n = self._found(self.grams, parts, ["n0", "n1"])
            of = self._found(self.contexts, [g[:-1] for g in parts], ["seen0", "seen1", "kinds0", "kinds1"])
            for k in (0, 1):
                seen, kinds = of[k], of[2 + k]
                p[k] = np.where(seen > 0, (n[k] + kinds * p[k]) / np.maximum(seen + kinds, 1), p[k])
        return np.log(p[0]) - np.log(p[1])

    def differences(self, urls: Sequence[str | None]) -> list[float]:
        """Per character; the end counts."""
        grams = [grams_of(u, self.order) for u in urls]
        distinct = list(dict.fromkeys(g for gs in grams for g in gs))
        gain = dict(zip(distinct, self.gains(distinct).tolist(), strict=True))
        return [sum(map(gain.__getitem__, gs)) / len(gs) for gs in grams]


def with_difference(rows: DataFrame, model: SpreadModel, url: str, out: str) -> DataFrame:
    """Every row with the difference of its url; runs in the row, ``SLICE`` urls at a time."""

    @F.arrow_udf("double")
    def difference(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            urls, found = batch.to_pylist(), []
            for at in range(0, len(urls), SLICE):
                found += model.differences(urls[at : at + SLICE])
            yield pa.array(found, pa.float64())

    return rows.withColumn(out, difference(F.col(url)))


def fit_spread(known: DataFrame, order: int) -> SpreadModel:
    """Count all urls ``(_u, _v)``; the tables and the number of their shards grow with them."""
    spark = known.sparkSession
    chars = known.agg(F.sum(F.length("_u") + 1)).first()[0] or 0
    bits = max(int(np.ceil(np.log2(max(chars * (order + 1) / 8 / SHARD_GRAMS, 1)))), 1)
    grams, _ = lm.store(_count_grams(known, order, bits), bits, ["n0", "n1"], ["context"])
    contexts, _ = lm.store(_count_contexts(spark, grams, bits), bits, ["seen0", "seen1", "kinds0", "kinds1"])
    return SpreadModel(order, grams, contexts)


def best_threshold(scored: Sequence[tuple[float, bool]]) -> float:
    """Of differences and whether each url is accepted: the one with the fewest errors, each class
    weighing alike, between two differences seen, and nearest to none of equally good ones."""
    accepted = sum(ok for _, ok in scored)
    weight = {True: 1 / max(accepted, 1), False: 1 / max(len(scored) - accepted, 1)}
    scored = sorted(scored)
    values = np.array([s for s, _ in scored])
    wrong = np.cumsum([0.0] + [weight[ok] if ok else -weight[ok] for _, ok in scored]) + 1.0  # blocking the first k
    edges = np.concatenate([[values[0] - 1], (values[1:] + values[:-1]) / 2, [values[-1] + 1]])
    best = np.flatnonzero(wrong <= wrong.min() + 1e-12)
    return float(edges[best[np.abs(edges[best]).argmin()]])


def spread_threshold(scored: DataFrame) -> float:
    """``best_threshold`` of all rows ``(_d, _ok)``: differences, and whether the url is accepted.

    Equal differences are one row with counts. They are dealt by ranges and written; a row's errors
    are those of the ranges before and of the rows before it in its range, in whole numbers.
    """
    counts = scored.groupBy("_d").agg(F.count_if("_ok").alias("_a"), F.count_if(~F.col("_ok")).alias("_r"))
    ranged = written(counts.repartitionByRange("_d").withColumn("_range", F.spark_partition_id()), "differences")
    sums = [F.sum(c).alias(c) for c in ("_a", "_r")]
    accepted, rejected, least = ranged.agg(*sums, F.min("_d")).first()
    # errors by blocking up to a row, times both class sizes: accepted ones blocked less rejected ones blocked
    weigh = [F.lit(n).cast("decimal(18,0)") for n in (rejected, accepted)]
    wrong = F.col("_a").cast("decimal(18,0)") * weigh[0] - F.col("_r").cast("decimal(18,0)") * weigh[1]
    ranged = ranged.select("_range", "_d", wrong.alias("_w"))
    ranges = ranged.groupBy("_range").agg(F.sum("_w").alias("_s"), F.min("_d").alias("_first"))
    in_order = Window.orderBy("_range")  # a row per range
    ranges = ranges.select(
        "_range", (F.sum("_s").over(in_order) - F.col("_s")).alias("_before"), F.lead("_first").over(in_order).alias("_after")
    )
    inside = Window.partitionBy("_range").orderBy("_d")
    here = ranged.join(F.broadcast(ranges), "_range").select(
        "_d",
        (F.col("_before") + F.sum("_w").over(inside)).alias("_w"),
        F.coalesce(F.lead("_d").over(inside), "_after").alias("_next"),
    )
    edge = F.coalesce((F.col("_d") + F.col("_next")) / 2, F.col("_d") + 1).alias("_edge")
    found = here.select("_w", edge).agg(F.min(F.struct("_w", F.abs("_edge").alias("_size"), "_edge"))).first()[0]
    return min((found["_w"], found["_size"], found["_edge"]), (0, abs(least - 1), least - 1))[2]


def judge(
    pages: DataFrame,
    rules: Sequence[Rule],
    url: str = "url",
    order: int = 4,
) -> DataFrame:
    """Every row of ``pages`` with ``host, path, rule, verdict, difference``; columns of these names
    are replaced.

    The models count all distinct ruled urls but every fifth by hash, in Spark; the threshold is
    set on all of those left out, so each ruled url has its part in one of the two. With rules
    of one verdict only, or no url that they fit, unruled urls get the difference 0 and are allowed;
    a verdict all of whose urls are left out is learnt from them. A null url is judged like an empty
    one: host and path are empty, no rule fits, and the models see its end alone. Equal urls are
    judged alike; any other column may be null.
    """
    made = ("host", "path", "rule", "verdict", "difference")
    host, path = host_of(F.col(url)), path_of(F.col(url))
    ruled = pages.select(
        *(F.col(f"`{c}`") for c in pages.columns if c not in made),
        host.alias("host"),
        path.alias("path"),
    )
    ruled = ruled.withColumn("rule", first_rule(F.col("host"), F.col("path"), rules, lambda r: r.name))
    by_rule = first_rule(F.col("host"), F.col("path"), rules, lambda r: r.verdict)
    known = ruled.where(F.col("rule").isNotNull()).select(F.col(url).alias("_u"), by_rule.alias("_v"))
    held = F.pmod(F.xxhash64("_u"), F.lit(5)) == 0
    known = written(known.distinct().withColumn("_held", held), "ruled-urls")
    counts = {(r["_v"], r["_held"]): r["count"] for r in known.groupBy("_v", "_held").count().collect()}
    if all(any((v, h) in counts for h in (True, False)) for v in CLASSES):
        alone = [v for v in CLASSES if (v, False) not in counts]
        model = fit_spread(known.where(~F.col("_held") | F.col("_v").isin(alone)), order)
        aside = reduce(Column.__or__, [(F.col("_v") == v) & (F.col("_held") == ((v, True) in counts)) for v in CLASSES])
        apart = with_difference(known.where(aside), model, "_u", "_d").select("_d", (F.col("_v") == ALLOW).alias("_ok"))
        scored, threshold = with_difference(ruled, model, url, "difference"), spread_threshold(apart)
    else:
        scored, threshold = ruled.withColumn("difference", F.lit(0.0)), 0.0
    by_model = F.when(F.col("difference") >= threshold, F.lit(ALLOW)).otherwise(F.lit(BLOCK))
    return scored.withColumn("verdict", F.coalesce(by_rule, by_model))
