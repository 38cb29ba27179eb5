"""Counts, statistics and quality reports. Every group-by combines before its shuffle."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from callsift.functions import lexicons as lex
from callsift.functions.text import SLOT_NAMES, _col, is_question, pair_key
from callsift.session import written

METADATA_COLUMNS = ("domain", "topic", "industry", "category", "accent", "language")
TEXT_LIKE = r"text|transcript|dialog|utterance"


def _histogram(df: DataFrame, values: Mapping[str, Column]) -> DataFrame:
    """``(measure, value, n)``: counts per distinct value, so that exact quantiles are taken over
    distinct values and never over all rows in one task."""
    pairs = F.array(
        *[
            F.struct(F.lit(k).alias("measure"), v.cast("long").alias("value"))
            for k, v in values.items()
        ]
    )
    return (
        df.select(F.inline(pairs))
        .where(F.col("value").isNotNull())
        .groupBy("measure", "value")
        .agg(F.count("*").alias("n"))
    )


def _quantile(q: float) -> Column:
    return F.expr(f"percentile(value, {q}D, n)")


def exact_quantiles(hist: DataFrame, wanted: Mapping[str, float]) -> DataFrame:
    """``(measure, name...)`` of a table ``(measure, value, n)``: exact quantiles, linear between ranks.

    Values are sorted by ranges and written; the counts of the ranges before, and those before a
    value in its range, say which ranks a value covers, and the ranks asked for are picked out. So
    columns of any number of different values are spread over tasks.
    """
    ordered = hist.repartitionByRange("measure", "value").withColumn("_part", F.spark_partition_id())
    ordered = written(ordered, "by-value")
    parts = ordered.groupBy("measure", "_part").agg(F.sum("n").alias("_c"))
    whole = Window.partitionBy("measure")  # a row per range
    before = F.sum("_c").over(whole.orderBy("_part")) - F.col("_c")
    parts = parts.select("measure", "_part", before.alias("_before"), F.sum("_c").over(whole).alias("_total"))
    in_part = F.sum("n").over(Window.partitionBy("measure", "_part").orderBy("value")) - F.col("n")
    ranks = ordered.join(parts, ["measure", "_part"]).withColumn("_lo", F.col("_before") + in_part)

    def at(rank: Column) -> Column:
        here = (F.col("_lo") <= rank) & (rank < F.col("_lo") + F.col("n"))
        return F.max(F.when(here, F.col("value").cast("double")))

    places = {name: (F.col("_total") - 1) * F.lit(q) for name, q in wanted.items()}
    ends = ranks.groupBy("measure").agg(
        F.max("_total").alias("_total"),
        *[at(F.floor(p)).alias(f"_{name}_lo") for name, p in places.items()],
        *[at(F.ceil(p)).alias(f"_{name}_hi") for name, p in places.items()],
    )
    between = {name: p - F.floor(p) for name, p in places.items()}
    return ends.select(
        "measure",
        *[
            (F.col(f"_{name}_lo") + (F.col(f"_{name}_hi") - F.col(f"_{name}_lo")) * part).alias(name)
            for name, part in between.items()
        ],
    )


def describe(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """count, mean, sample deviation, min, quartiles and max per integer column, ids included."""
    hist = written(_histogram(df, {c: F.col(c) for c in cols}), "histogram")
    n, v = F.col("n").cast("double"), F.col("value").cast("double")
    total, s1, s2 = F.sum("n"), F.sum(n * v), F.sum(n * v * v)
    moments = hist.groupBy("measure").agg(
        total.alias("count"),
        (s1 / total).alias("mean"),
        F.when(
            total > 1, F.sqrt(F.greatest(F.lit(0.0), (s2 - s1 * s1 / total) / (total - 1)))
        ).alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    )
    quartiles = exact_quantiles(hist, {"p25": 0.25, "p50": 0.5, "p75": 0.75})
    return moments.join(quartiles, "measure").select(
        "measure", "count", "mean", "std", "min", "p25", "p50", "p75", "max"
    )


def customer_text_rate(df: DataFrame) -> DataFrame:
    has = F.length(F.coalesce("customer_text", F.lit(""))) > 0
    return df.agg(F.avg(has.cast("double")).alias("customer_text_rate"))


def length_stats(df: DataFrame, texts: Mapping[str, Column]) -> DataFrame:
    """mean, median and exact p90 of the character length; a null text counts as length 0."""
    hist = _histogram(df, {k: F.length(F.coalesce(v, F.lit(""))) for k, v in texts.items()})
    return hist.groupBy("measure").agg(
        (F.sum(F.col("n") * F.col("value")) / F.sum("n")).alias("mean"),
        _quantile(0.5).alias("median"),
        _quantile(0.9).alias("p90"),
    )


def top_values(df: DataFrame, col: str, n: int = 10) -> DataFrame:
    """Most frequent values with null as a value; ties by value."""
    return (
        df.groupBy(F.col(col).alias("value"))
        .agg(F.count("*").alias("count"))
        .orderBy(F.desc("count"), F.col("value").asc_nulls_first())
        .limit(n)
    )


def keep_counters(df: DataFrame, kept: Column) -> DataFrame:
    """checked, kept and skipped rows in one pass."""
    hit = F.coalesce(kept, F.lit(False)).cast("long")
    return df.agg(
        F.count("*").alias("checked"),
        F.coalesce(F.sum(hit), F.lit(0)).alias("kept"),
        F.coalesce(F.sum(1 - hit), F.lit(0)).alias("skipped"),
    )


def count_per_intent(df: DataFrame) -> DataFrame:
    return df.groupBy("intent_id").agg(F.count("utterance").alias("count"))


def question_ratio(df: DataFrame, by: Sequence[str] = ("intent_id",)) -> DataFrame:
    return df.groupBy(*by).agg(
        F.round(F.avg(is_question("utterance").cast("double")), 3).alias("question_ratio")
    )


def placeholder_audit(df: DataFrame) -> DataFrame:
    """Rows with a leftover ``[...]`` and rows with a known ``{slot}``."""
    slots = "|".join(s.lower() for s in SLOT_NAMES)
    return df.agg(
        F.sum(F.rlike("utterance", F.lit(r"\[.+\]")).cast("long")).alias("square_left"),
        F.sum(
            F.rlike(F.lower("utterance"), F.lit(r"\{(" + slots + r")\}")).cast("long")
        ).alias("slots_found"),
    )


def leaked_pairs(train: DataFrame, dev: DataFrame) -> DataFrame:
    """Pair keys that are on both sides. Each side is made distinct before the keys meet, so a
    pair with many copies does not skew the join."""
    a = train.select(pair_key("intent_id", "utterance").alias("key")).distinct()
    b = dev.select(pair_key("intent_id", "utterance").alias("key")).distinct()
    return a.join(b, "key", "left_semi")


def below_minimum(df: DataFrame, n: int = lex.MIN_PER_INTENT) -> DataFrame:
    return count_per_intent(df).where(F.col("count") < n)


def before_after(base: DataFrame, result: DataFrame, targets: Mapping[str, int]) -> DataFrame:
    """Rows before, rows after and the target per target intent."""
    from callsift.functions.rules import targets_needing_rows

    wanted = base.sparkSession.range(1).select(F.inline(targets_needing_rows(targets)))
    names = list(targets)

    def counts(df: DataFrame, out: str) -> DataFrame:
        return count_per_intent(df.where(F.col("intent_id").isin(names))).withColumnRenamed(
            "count", out
        )

    return (
        wanted.join(counts(base, "before"), "intent_id", "left")
        .join(counts(result, "after"), "intent_id", "left")
        .select(
            "intent_id",
            F.coalesce("before", F.lit(0)).alias("before"),
            F.coalesce("after", F.lit(0)).alias("after"),
            "target",
        )
    )


def classification_report(
    predictions: DataFrame, label: str = "label", prediction: str = "prediction"
) -> DataFrame:
    """precision, recall, f1 and support per class, then accuracy and both averages.

    One pass gives the (label, prediction) counts; the rest works on that small table. A ratio
    with an empty denominator is 0.
    """
    cells = predictions.groupBy(
        F.col(label).alias("l"), F.col(prediction).alias("p")
    ).agg(F.count("*").alias("n"))
    hit = F.when(F.col("l") == F.col("p"), F.col("n")).otherwise(0)
    both = cells.select(
        F.inline(
            F.array(
                F.struct(
                    F.col("l").alias("class"),
                    F.col("n").alias("support"),
                    F.lit(0).cast("long").alias("predicted"),
                    hit.alias("tp"),
                ),
                F.struct(
                    F.col("p").alias("class"),
                    F.lit(0).cast("long").alias("support"),
                    F.col("n").alias("predicted"),
                    F.lit(0).cast("long").alias("tp"),
                ),
            )
        )
    )
    per_class = both.groupBy("class").agg(
        F.sum("support").alias("support"),
        F.sum("predicted").alias("predicted"),
        F.sum("tp").alias("tp"),
    )
    ratio = lambda a, b: F.when(b > 0, a / b).otherwise(F.lit(0.0))
    scored = (
        per_class.withColumn("precision", ratio(F.col("tp"), F.col("predicted")))
        .withColumn("recall", ratio(F.col("tp"), F.col("support")))
        .withColumn("f1", ratio(2 * F.col("tp"), F.col("support") + F.col("predicted")))
    )
    total = F.sum("support")

    def average(name: str, mean) -> DataFrame:
        return scored.agg(
            *[mean(c).alias(c) for c in ("precision", "recall", "f1")], total.alias("support")
        ).select(F.lit(name).alias("class"), "precision", "recall", "f1", "support")

    accuracy = scored.agg((F.sum("tp") / total).alias("a"), total.alias("support")).select(
        F.lit("accuracy").alias("class"),
        F.lit(None).cast("double").alias("precision"),
        F.lit(None).cast("double").alias("recall"),
        F.round("a", 4).alias("f1"),
        "support",
    )
    rounded = lambda df: df.select(
        "class", *[F.round(c, 3).alias(c) for c in ("precision", "recall", "f1")], "support"
    )
    return (
        rounded(scored)
        .unionByName(accuracy)
        .unionByName(rounded(average("macro avg", F.avg)))
        .unionByName(
            rounded(average("weighted avg", lambda c: F.sum(F.col(c) * F.col("support")) / total))
        )
    )


def column_profile(df: DataFrame, metadata: Iterable[str] = METADATA_COLUMNS) -> DataFrame:
    """One row per column: is it metadata, does its name look like text, non-null count, and the
    shortest and longest value. One pass over the data."""
    import re

    metadata = tuple(metadata)
    aggs = []
    for n, c in enumerate(df.columns):
        size = F.length(F.col(f"`{c}`").cast("string"))
        aggs += [
            F.count(F.col(f"`{c}`")).alias(f"_n{n}"),
            F.min(size).cast("long").alias(f"_lo{n}"),
            F.max(size).cast("long").alias(f"_hi{n}"),
        ]
    rows = F.array(
        *[
            F.struct(
                F.lit(c).alias("column"),
                F.lit(c in metadata).alias("is_metadata"),
                F.lit(bool(re.search(TEXT_LIKE, c, re.I))).alias("is_text_like"),
                F.col(f"_n{n}").alias("non_null"),
                F.col(f"_lo{n}").alias("min_length"),
                F.col(f"_hi{n}").alias("max_length"),
            )
            for n, c in enumerate(df.columns)
        ]
    )
    return df.agg(*aggs).select(F.inline(rows))


def distinct_values(df: DataFrame) -> DataFrame:
    """``(column, distinct_values)``: different non-null values of each column, told apart by a digest,
    so that long texts are not shuffled."""
    values = [
        F.struct(F.lit(c).alias("column"), F.unhex(F.sha2(F.col(f"`{c}`").cast("string"), 256)).alias("value"))
        for c in df.columns
    ]
    found = df.select(F.inline(F.array(*values))).distinct()
    return found.groupBy("column").agg(F.count("value").alias("distinct_values"))


def text_preview(df: DataFrame, order: Sequence[str], width: int = 1000) -> DataFrame:
    """``(column, text)``: the first row's text in the first column whose name looks like text, cut."""
    import re

    named = next((c for c in df.columns if re.search(TEXT_LIKE, c, re.I)), None)
    if named is None:
        return df.sparkSession.createDataFrame([], "column string, text string")
    first = df.orderBy(*order).limit(1)
    return first.select(
        F.lit(named).alias("column"), F.substring(F.col(f"`{named}`").cast("string"), 1, width).alias("text")
    )


def preview_rows(df: DataFrame, order: Sequence[str], n: int = 3, width: int = 250) -> DataFrame:
    """First rows with every value as text cut at ``width``."""
    from callsift.operators.ranking import first_rows

    text = [F.col(f"`{c}`").cast("string") for c in df.columns]
    return first_rows(df, order, n).select(
        *[
            F.when(F.length(t) > width, F.concat(F.substring(t, 1, width), F.lit(" ...")))
            .otherwise(t)
            .alias(c)
            for t, c in zip(text, df.columns)
        ]
    )
