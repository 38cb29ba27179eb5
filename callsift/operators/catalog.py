"""Intent catalog: cluster rows to curated entries, scaffolds, checks and training exports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callsift.functions.rules import suggest_intent
from callsift.functions.text import (
    drop_blanks,
    intent_key,
    normalize_slots,
    slugify,
    strip,
    take_examples,
)

HANDOFF_DESTINATION = "human_agent"
GOLD_FIELDS = ("gold_answer", "source_refs", "policy_notes")
HANDOFF_FIELDS = ("handoff_reason", "handoff_destination")
OVERRIDE_SCHEMA = (
    "cluster_id int, intent_id string, suggested_intent string, answerable boolean, "
    "handoff_reason string, has_answerable boolean, has_reason boolean, row long"
)


def suggest_names(clusters: DataFrame) -> DataFrame:
    """``(cluster_id, suggested_intent)`` from the clusters' top terms."""
    return clusters.select("cluster_id", suggest_intent("top_terms").alias("suggested_intent"))


def join_suggestions(clusters: DataFrame, suggestions: DataFrame) -> DataFrame:
    """Clusters with their suggestion; a cluster without one is an error."""
    missing = F.raise_error(
        F.concat(F.lit("no suggestion for cluster "), F.col("cluster_id").cast("string"))
    ).cast("boolean")
    # in a filter, so that it fails even where nothing reads the column
    return clusters.join(suggestions, "cluster_id", "left").where(
        F.when(F.col("suggested_intent").isNull(), missing).otherwise(True)
    )


def last_overrides(overrides: DataFrame) -> DataFrame:
    """One override per cluster: the last in file order."""
    cols = [c for c in overrides.columns if c not in ("cluster_id", "row")]
    return (
        overrides.groupBy("cluster_id")
        .agg(F.max_by(F.struct(*cols), "row").alias("_o"))
        .select("cluster_id", *[F.col(f"_o.{c}").alias(f"o_{c}") for c in cols])
    )


def apply_overrides(drafts: DataFrame, overrides: DataFrame) -> DataFrame:
    """Field-wise overlay. Names count only when non-empty; the flag and the reason count whenever
    the field is present, even when it is empty."""
    joined = drafts.join(last_overrides(overrides), "cluster_id", "left")
    named = F.nullif("o_intent_id", F.lit(""))
    return joined.select(
        "cluster_id",
        F.when(named.isNotNull(), slugify(named)).otherwise(F.col("intent_id")).alias("intent_id"),
        F.coalesce(F.nullif("o_suggested_intent", F.lit("")), "suggested_intent").alias(
            "suggested_intent"
        ),
        "size",
        "top_terms",
        "examples",
        F.when(F.col("o_has_answerable"), F.coalesce("o_answerable", F.lit(False)))
        .otherwise(F.col("answerable"))
        .alias("answerable"),
        F.when(F.col("o_has_reason"), F.col("o_handoff_reason"))
        .otherwise(F.col("handoff_reason"))
        .alias("handoff_reason"),
    )


def draft_catalog(clusters: DataFrame, suggestions: DataFrame) -> DataFrame:
    """The catalog before overrides: every intent answerable, up to 15 examples."""
    return join_suggestions(clusters, suggestions).select(
        "cluster_id",
        intent_key("suggested_intent", "cluster_id").alias("intent_id"),
        "suggested_intent",
        "size",
        "top_terms",
        take_examples(drop_blanks(F.transform("examples", strip)), 15).alias("examples"),
        F.lit(True).alias("answerable"),
        F.lit("").alias("handoff_reason"),
    )


def catalog_entries(drafts: DataFrame) -> DataFrame:
    return drafts.select(
        "intent_id",
        "cluster_id",
        F.col("suggested_intent").alias("intent_name"),
        "size",
        "answerable",
        "handoff_reason",
        "top_terms",
        "examples",
    )


def split_answerable(catalog: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(answerable, handoff); a missing flag counts as answerable."""
    flag = F.coalesce(F.col("answerable"), F.lit(True))
    return catalog.where(flag), catalog.where(~flag)


def explode_examples(catalog: DataFrame, n: int = 3) -> DataFrame:
    """One row per example, first ``n``; an intent without examples gives one row with ''."""
    return catalog.withColumn(
        "sample_question", F.explode_outer(take_examples("examples", n))
    ).withColumn("sample_question", F.coalesce("sample_question", F.lit("")))


def gold_todo(catalog: DataFrame) -> DataFrame:
    answerable, _ = split_answerable(catalog)
    return explode_examples(answerable).select(
        "intent_id",
        "intent_name",
        "cluster_id",
        "sample_question",
        *[F.lit("").alias(f) for f in GOLD_FIELDS],
    )


def handoff_list(catalog: DataFrame) -> DataFrame:
    _, handoff = split_answerable(catalog)
    return explode_examples(handoff).select(
        "intent_id",
        "intent_name",
        "cluster_id",
        "sample_question",
        F.coalesce("handoff_reason", F.lit("")).alias("handoff_reason"),
        F.lit(HANDOFF_DESTINATION).alias("handoff_destination"),
    )


def ids_outside(rows: DataFrame, allowed: DataFrame) -> DataFrame:
    """Distinct ids of ``rows`` that ``allowed`` lacks; empty when it is a subset."""
    return rows.select("intent_id").distinct().join(
        allowed.select("intent_id").distinct(), "intent_id", "left_anti"
    )


def validate_catalog(catalog: DataFrame, gold: DataFrame, handoff: DataFrame) -> DataFrame:
    """``(check, ok, bad_rows)``: required columns, and ids on the right side of the catalog.

    An empty handoff table passes when its columns are there.
    """
    answerable, routed = split_answerable(catalog)

    def columns(name: str, df: DataFrame, needed: tuple[str, ...]) -> DataFrame:
        missing = [c for c in needed if c not in df.columns]
        return catalog.sparkSession.range(1).select(
            F.lit(name).alias("check"), F.lit(len(missing)).cast("long").alias("bad_rows")
        )

    def subset(name: str, rows: DataFrame, allowed: DataFrame) -> DataFrame:
        return ids_outside(rows, allowed).agg(F.count("*").alias("bad_rows")).select(
            F.lit(name).alias("check"), "bad_rows"
        )

    parts = [
        columns("gold_columns", gold, GOLD_FIELDS),
        columns("handoff_columns", handoff, HANDOFF_FIELDS),
        subset("gold_ids_answerable", gold, answerable),
        subset("handoff_ids_not_answerable", handoff, routed),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select("check", (F.col("bad_rows") == 0).alias("ok"), "bad_rows")


def catalog_counts(catalog: DataFrame) -> DataFrame:
    """Entries, distinct answerable ids, distinct handoff ids. An id with entries of both kinds
    counts on both sides."""
    flag = F.coalesce(F.col("answerable"), F.lit(True))
    return catalog.agg(
        F.count("*").alias("entries"),
        F.count_distinct(F.when(flag, F.col("intent_id"))).alias("answerable_ids"),
        F.count_distinct(F.when(~flag, F.col("intent_id"))).alias("handoff_ids"),
    )


def training_rows(catalog: DataFrame, n: int = 25) -> DataFrame:
    """``(intent_id, intent_name, utterance)`` of the answerable entries; blanks stay."""
    answerable, _ = split_answerable(catalog)
    return answerable.select(
        "intent_id",
        F.col("intent_name"),
        "cluster_id",
        F.posexplode(take_examples("examples", n)),
    ).select(
        "intent_id",
        "intent_name",
        "cluster_id",
        F.col("pos").cast("long").alias("pos"),
        normalize_slots("col").alias("utterance"),
    )


def training_pack(catalog: DataFrame, n: int = 25) -> DataFrame:
    """One pack per catalog entry (ids may repeat), blank samples dropped."""
    answerable, _ = split_answerable(catalog)
    return answerable.select(
        "intent_id",
        "cluster_id",
        F.col("intent_name").alias("name"),
        drop_blanks(F.transform(take_examples("examples", n), normalize_slots)).alias("samples"),
    )


def handoff_routes(catalog: DataFrame) -> DataFrame:
    _, handoff = split_answerable(catalog)
    return handoff.select(
        "intent_id",
        "cluster_id",
        F.col("intent_name").alias("name"),
        F.coalesce("handoff_reason", F.lit("")).alias("reason"),
    )


def gold_filled(gold: DataFrame) -> DataFrame:
    """FAQ evaluation rows: gold answers that are not blank, fields stripped."""
    filled = gold.fillna("", subset=[c for c, t in gold.dtypes if t == "string"])
    return filled.where(strip("gold_answer") != "").select(
        "intent_id",
        strip("sample_question").alias("question"),
        *[strip(f).alias(f) for f in GOLD_FIELDS],
    )
