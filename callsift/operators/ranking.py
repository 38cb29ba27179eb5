"""First-of-group, top-k, sampling and split operators.

Each one is exact and none sends a whole hot group to one task: rows are reduced per map task
first, by the group limit Spark plans in front of the shuffle of a ``row_number() <= k``, and,
where k rows per map task would still be many, once more per salt.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from callsift.functions.text import _col
from callsift.session import written

SALTS = 256
HOT_COPIES = 100_000  # keys of more rows than that, and than rows / HOT_KEYS, meet them by a broadcast
HOT_KEYS = 10_000
RANGE_BITS = 10  # rows of one archive are counted by ranges of so many bits of their number
HASH_DIGITS = 4  # leading sha-256 hex digits that name a bucket: 65,536 buckets, in hash order


def _task_salt(salts: int) -> Column:
    """A number that is the same for all rows of a map task.

    Ranking inside (group, task salt) still cuts a group to k rows per map task before the
    shuffle, and the shuffle then spreads the group over ``salts`` tasks. A top-k of top-ks does
    not depend on how rows are salted.
    """
    return F.pmod(F.spark_partition_id(), F.lit(salts))


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """First row of each key by ``order`` (unique). One shuffle, one row per key and map task."""
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_place", place).where(F.col("_place") == 1).drop("_place")


def top_k_per_group(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column | str],
    k: int,
    rank: str | None = None,
    salts: int = SALTS,
) -> DataFrame:
    """First ``k`` rows of each group; ``order`` must be a total order.

    A group is cut to k rows per map task, then per salt, then as a whole. The last task of a
    group sees at most ``salts * k`` rows, whatever the size of the group.
    """
    cols = [_col(o) for o in order]
    name = rank or "_rank"
    small = df
    if salts > 1:
        inner = Window.partitionBy(*keys, "_salt").orderBy(*cols)
        small = (
            df.withColumn("_salt", _task_salt(salts))
            .withColumn("_pre", F.row_number().over(inner))
            .where(F.col("_pre") <= k)
            .drop("_salt", "_pre")
        )
    out = small.withColumn(
        name, F.row_number().over(Window.partitionBy(*keys).orderBy(*cols)).cast("long")
    ).where(F.col(name) <= k)
    return out if rank else out.drop(name)


def first_rows(df: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    """First ``n`` rows by ``order`` (unique column names); the same way for any ``n``.

    ``df`` is evaluated once and written. Rows are counted by all of ``order`` but the last digits
    of its last column, where that is a whole number; the range in which the n-th row lies is the
    cut, a literal that the second read of the written table filters by. So about ``n`` rows, and a
    range's, are put in order, and no row is joined.
    """
    return first_written_rows(written(df, "first-rows"), order, n)


def first_written_rows(rows: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    """``first_rows`` of a table that is written already."""
    if n < 1:
        return rows.limit(0)
    *lead, last = order
    fine = rows.schema[last].dataType.typeName() in ("byte", "short", "integer", "long")
    ranges = F.shiftright(last, RANGE_BITS) if fine else F.col(last)
    counts = rows.groupBy(*lead, ranges.alias(last)).agg(F.count("*").alias("_c"))
    first = counts.orderBy(*order).limit(n)  # each range has a row, so the n-th row is in these
    before = F.sum("_c").over(Window.orderBy(*order)) - F.col("_c")
    cut = first.withColumn("_before", before).where(F.col("_before") < n).orderBy(*[F.desc(c) for c in order]).first()
    if cut is None:
        return rows
    place = [*lead, ranges]
    return rows.where(_not_after(place, [cut[c] for c in order])).orderBy(*order).limit(n)


def _not_after(cols: Sequence[Column | str], values: Sequence) -> Column:
    """True where ``cols`` stand not after ``values``; null is first, as in a sort."""
    col, value = _col(cols[0]), values[0]
    if value is None:
        before, same = F.lit(False), col.isNull()
    else:
        before, same = col.isNull() | (col < F.lit(value)), col == F.lit(value)
    rest = _not_after(cols[1:], values[1:]) if len(cols) > 1 else F.lit(True)
    return F.coalesce(before | (same & rest), F.lit(False))


def numbered(df: DataFrame, order: Sequence[str], out: str = "idx") -> DataFrame:
    """Rows with their place, from 0, in ``order`` (column names); rows alike in it get neighbouring
    places.

    Rows are sorted by ranges and written once; a row's place is its place in its range plus the
    rows of the ranges before, of which there are as many as shuffle partitions. No task sees more
    than a range, and the driver sees nothing.
    """
    ordered = df.repartitionByRange(*order).sortWithinPartitions(*order)
    ordered = written(ordered.withColumn("_place", F.monotonically_increasing_id()), "ordered")
    part = F.shiftright("_place", 33)
    ranges = ordered.groupBy(part.alias("_range")).agg(F.count("*").alias("_c"), F.min("_place").alias("_range_first"))
    before = F.sum("_c").over(Window.orderBy("_range")) - F.col("_c")
    ranges = ranges.select("_range", "_range_first", before.alias("_range_before"))
    return (
        ordered.withColumn("_range", part)
        .join(F.broadcast(ranges), "_range")  # a row per range
        .withColumn(out, F.col("_range_before") + F.col("_place") - F.col("_range_first"))
        .drop("_range", "_place", "_range_first", "_range_before")
    )


def _hash_key(key: Sequence[str], seed: int) -> Column:
    return F.sha2(F.concat_ws("|", F.lit(str(seed)), *[F.col(c).cast("string") for c in key]), 256)


def _bucket(hash_col: str) -> Column:
    return F.substring(hash_col, 1, HASH_DIGITS)


def sample_n(df: DataFrame, key: Sequence[str], n: int, seed: int = 42) -> DataFrame:
    """Exactly ``min(n, rows)`` rows, repeatable: the ``n`` smallest seeded hashes of a unique key.

    A histogram over hash buckets (at most 65,536 rows) gives the bucket where the n-th hash lies;
    only rows up to that bucket, about ``n`` of them, are then ordered.
    """
    hashed = df.withColumn("_h", _hash_key(key, seed)).withColumn("_b", _bucket("_h"))
    counts = df.select(_bucket_of(key, seed).alias("_b")).groupBy("_b").agg(F.count("*").alias("_c"))
    running = counts.withColumn("_cum", F.sum("_c").over(Window.orderBy("_b")))
    cut = running.agg(
        F.coalesce(F.min(F.when(F.col("_cum") >= n, F.col("_b"))), F.max("_b")).alias("_cut")
    )
    return (
        hashed.where(F.col("_b") <= cut.scalar())
        .orderBy("_h", *key)
        .limit(n)
        .drop("_h", "_b")
    )


def _bucket_of(key: Sequence[str], seed: int) -> Column:
    return F.substring(_hash_key(key, seed), 1, HASH_DIGITS)


def dev_quota(df: DataFrame, label: str, share: float) -> DataFrame:
    """Rows per class that go to the dev side: ceil(share * n) in all, by largest remainder."""
    counts = df.groupBy(label).agg(F.count("*").alias("_n"))
    everything = Window.partitionBy()
    total = F.sum("_n").over(everything)
    parts = (
        counts.withColumn("_total", total)
        .withColumn("_n_dev", F.ceil(F.col("_total") * F.lit(share)))
        .withColumn(
            "_num", F.col("_n").cast("decimal(18,0)") * F.col("_n_dev").cast("decimal(18,0)")
        )
        .withColumn("_floor", F.expr("_num div cast(_total AS decimal(18,0))"))
        .withColumn("_rem", F.col("_num") % F.col("_total").cast("decimal(18,0)"))
    )
    extra = F.col("_n_dev") - F.sum("_floor").over(everything)
    by_remainder = F.row_number().over(Window.orderBy(F.desc("_rem"), F.col(label)))
    return parts.select(
        label,
        F.col("_n"),
        (F.col("_floor") + F.when(by_remainder <= extra, 1).otherwise(0)).alias("_quota"),
    )


def stratified_split(
    df: DataFrame,
    label: str,
    key: Sequence[str],
    share: float = 0.2,
    seed: int = 42,
    strict: bool = True,
) -> DataFrame:
    """Add ``split`` (train/dev): in each class the quota's smallest seeded hashes go to dev.

    Rows alike in label and key are one row with a count: copies meet nowhere. A class is never
    ranked as a whole either. Its distinct keys are spread over hash buckets; counts per (class,
    bucket) say how many rows come before a bucket, and the counts in a bucket how many come before
    a key. That settles for each key how many of its rows go to dev: all, none, or, for one key of
    a class at most, some; those are the first of its rows by their other columns. Rows are written
    once and get their split by a join: keys of many copies, of which there are few, by a broadcast.

    ``strict`` fails on a class of one row, which cannot be on both sides.
    """
    rows = written(df, "to-split")
    quota = dev_quota(rows, label, share)
    if strict:
        alone = F.raise_error(F.concat(F.lit("class with one row: "), F.col(label))).cast("boolean")
        quota = quota.where(F.when(F.col("_n") < 2, alone).otherwise(True))  # a filter is never pruned
    same = list(dict.fromkeys([label, *key]))
    keys = rows.groupBy(*same).agg(F.count("*").alias("_c"))
    keys = written(keys.withColumn("_h", _hash_key(key, seed)).withColumn("_b", _bucket("_h")), "split-keys")
    running = Window.partitionBy(label).orderBy("_b")
    buckets = (
        keys.groupBy(label, "_b")
        .agg(F.sum("_c").alias("_s"))
        .withColumn("_before", F.sum("_s").over(running) - F.col("_s"))
        .select(label, "_b", "_before")
    )
    places = _meet(buckets, quota.select(label, "_quota"), [label])
    in_bucket = F.sum("_c").over(Window.partitionBy(label, "_b").orderBy("_h", *same)) - F.col("_c")
    left = F.col("_quota") - F.col("_before") - in_bucket
    dealt = _meet(keys, places, [label, "_b"]).withColumn("_dev", F.greatest(F.lit(0), F.least(left, F.col("_c"))))
    dealt = written(dealt.select(*same, "_c", "_dev"), "split-shares")

    is_dev = F.when(F.col("_dev") == F.col("_c"), "dev").when(F.col("_dev") == 0, "train").alias("split")
    settled = (F.col("_dev") == 0) | (F.col("_dev") == F.col("_c"))
    several = F.col("_c") > max(HOT_COPIES, rows.count() // HOT_KEYS)  # so at most HOT_KEYS keys
    few = dealt.where(settled & ~several).select(*same, is_dev)
    many = dealt.where(settled & several).select(*same, is_dev)
    split_up = dealt.where(~settled).select(*same, "_dev")  # one key a class at most
    columns = [F.col(f"`{c}`") for c in df.columns]
    out = _meet(rows, few, same).select(*columns, "split")
    if not many.isEmpty():
        out = out.unionByName(_meet(rows, F.broadcast(many), same).select(*columns, "split"))
    if not split_up.isEmpty():
        others = [c for c in df.columns if c not in same]
        part = numbered(_meet(rows, F.broadcast(split_up), same), [*same, *others], "_at")
        first = part.groupBy(*same).agg(F.min("_at").alias("_first"))
        chosen = F.when(F.col("_at") - F.col("_first") < F.col("_dev"), "dev").otherwise("train").alias("split")
        out = out.unionByName(_meet(part, F.broadcast(first), same).select(*columns, chosen))
    return out


def _meet(rows: DataFrame, keys: DataFrame, same: Sequence[str]) -> DataFrame:
    """Rows with the columns of their key; null equals null."""
    renamed = keys.select(*[F.col(c).alias(f"_k{n}") if c in same else c for n, c in enumerate(keys.columns)])
    at = {c: f"_k{n}" for n, c in enumerate(keys.columns) if c in same}
    equal = [F.col(f"`{c}`").eqNullSafe(F.col(at[c])) for c in same]
    return rows.join(renamed, equal).drop(*at.values())


def shortest_sentences(sentences: Column | str, k: int = 20) -> Column:
    """The ``k`` shortest sentences of a call in length order, when it has more than ``k``.

    Works on the array inside the row: no shuffle.
    """
    arr = _col(sentences)
    keyed = F.transform(
        arr, lambda s, i: F.struct(F.length(s).alias("n"), i.alias("i"), s.alias("s"))
    )
    shortest = F.transform(F.slice(F.array_sort(keyed), 1, k), lambda x: x["s"])
    return F.when(F.size(arr) > k, shortest).otherwise(arr)
