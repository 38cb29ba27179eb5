"""Utterances: sentence explode, labelling by rules, balancing and top-up of labelled rows."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from callsift.functions import lexicons as lex
from callsift.functions.rules import (
    Rules,
    customer_like,
    matches_any,
    seed_match,
    strict_match,
    targets_needing_rows,
    topup_match,
)
from callsift.functions.text import (
    first_nonempty,
    is_question,
    min_words,
    normalize_slots,
    pair_key,
    sentences,
    strip,
    truncate,
)
from callsift.operators.ranking import first_per_key, numbered, shortest_sentences, top_k_per_group
from callsift.operators.shaping import computed_once
from callsift.session import written

ORDER = ("source_zip", "ord", "pos")


def explode_sentences(calls: DataFrame, text: Column, lo: int, hi: int) -> DataFrame:
    """One row ``(source_zip, ord, pos, utterance)`` per kept sentence; a narrow transformation."""
    return calls.select("source_zip", "ord", F.posexplode(sentences(text, lo, hi))).select(
        "source_zip", "ord", F.col("pos").cast("long").alias("pos"), F.col("col").alias("utterance")
    )


def candidate_sentences(
    calls: DataFrame,
    first_person: Iterable[str] = lex.FIRST_PERSON,
    domain_terms: Iterable[str] = lex.BANK_TERMS,
    per_call: int = 20,
) -> DataFrame:
    """Discovery candidates: all customer sentences, or the shortest customer-like ones of a call
    that has no customer text. All of it happens inside the call's row."""
    own = F.coalesce(strip("customer_text"), F.lit(""))
    whole = F.coalesce(strip("full_text"), F.lit(""))
    likely = F.filter(
        sentences(whole, 5, 400), lambda s: customer_like(s, first_person, domain_terms)
    )
    texts = calls.select(
        "source_zip",
        "ord",
        (own != "").alias("_own"),
        own.alias("_text"),
        F.when(own == "", likely).alias("_likely"),
    )
    picked = F.when(F.col("_own"), sentences("_text", 5, 400)).otherwise(
        shortest_sentences("_likely", per_call)
    )
    return texts.select("source_zip", "ord", F.posexplode(picked)).select(
        "source_zip", "ord", F.col("pos").cast("long").alias("pos"), F.col("col").alias("utterance")
    )


def dedup_corpus(utterances: DataFrame, order: Sequence[str] = ORDER) -> DataFrame:
    """Utterances of three or more words, first of each exact text."""
    return first_per_key(utterances.where(min_words("utterance", 3)), ["utterance"], order)


def dedup_pairs(df: DataFrame, order: Sequence[str], intent: str = "intent_id") -> DataFrame:
    """First row per intent and case-folded utterance."""
    keyed = df.withColumn("_key", pair_key(intent, "utterance"))
    return first_per_key(keyed, ["_key"], order).drop("_key")


def harvest_seeds(
    calls: DataFrame, rules: Rules = lex.SEED_RULES, lo: int = 5, hi: int = 300
) -> DataFrame:
    """Label each sentence of the preferred text by its first matching rule, then de-duplicate."""
    text = F.coalesce(first_nonempty("customer_text", "full_text"), F.lit(""))
    labelled = (
        explode_sentences(calls, text, lo, hi)
        .withColumn("intent_id", seed_match("utterance", rules))
        .where(F.col("intent_id").isNotNull())
        .withColumn("utterance", truncate("utterance", 500))
    )
    return dedup_pairs(labelled, ORDER)


def clean_seeds(
    seeds: DataFrame, order: Sequence[str], strict_rules: Rules = lex.STRICT_RULES
) -> DataFrame:
    """Normalize slots, keep three or more words that pass the intent's strict pattern, dedup."""
    kept = (
        computed_once(seeds, {"utterance": normalize_slots("utterance")})
        .where(F.coalesce(F.col("intent_id"), F.lit("")) != "")
        .where(min_words("utterance", 3))
        .where(strict_match("intent_id", "utterance", strict_rules))
    )
    # normalized text has no outer white space, so the pair key equals plain case folding
    return dedup_pairs(kept, order)


def quota_mix(
    base: DataFrame,
    seeds: DataFrame,
    max_rows: int = lex.MAX_PER_INTENT,
    min_rows: int = lex.MIN_PER_INTENT,
    question_share: float = lex.QUESTION_SHARE,
) -> DataFrame:
    """Mix base rows and cleaned seeds per intent under a cap with a question quota.

    ``base`` and ``seeds`` have ``(intent_id, utterance, row)`` where ``row`` is the input order,
    of any orderable type.
    Per intent: room = max_rows - distinct base texts. With room left, up to the missing questions
    of the quota are taken first, then statements into what room is left. Base rows come first,
    then questions, then statements, cut at ``max_rows``; when fewer than ``min_rows`` are kept,
    unused seeds fill up to ``min_rows`` in seed order.

    No decision looks past the first ``max_rows`` base texts, questions or statements of an intent,
    so those are cut out first and all later windows see small groups.
    """
    base_set = first_per_key(
        base.select("intent_id", normalize_slots("utterance").alias("utterance"), "row"),
        ["intent_id", "utterance"],
        ["row"],
    )
    counters = base_set.groupBy("intent_id").agg(
        F.count("*").alias("_n_base"),
        F.sum(is_question("utterance").cast("long")).alias("_q_base"),
    )
    base_top = top_k_per_group(base_set, ["intent_id"], ["row"], max_rows, rank="_base")

    asked = seeds.select(
        "intent_id", "utterance", "row", is_question("utterance").alias("_is_q")
    )
    seed_top = top_k_per_group(asked, ["intent_id", "_is_q"], ["row"], max_rows, rank="_r")
    n_questions = F.max(F.when(F.col("_is_q"), F.col("_r")).otherwise(0)).over(
        Window.partitionBy("intent_id")
    )
    quota = int(question_share * max_rows)
    staged_seeds = (
        seed_top.withColumn("_n_q", n_questions)
        .join(counters, "intent_id", "left")
        .withColumn("_room", F.greatest(F.lit(0), max_rows - F.coalesce("_n_base", F.lit(0))))
        .withColumn(
            "_q_take",
            F.least(
                F.col("_n_q"), F.greatest(F.lit(0), quota - F.coalesce("_q_base", F.lit(0)))
            ),
        )
        .withColumn(
            "_stage",
            F.when((F.col("_room") > 0) & F.col("_is_q") & (F.col("_r") <= F.col("_q_take")), 1)
            .when(
                (F.col("_room") > 0)
                & ~F.col("_is_q")
                & (F.col("_r") <= F.col("_room") - F.col("_q_take")),
                2,
            )
            .otherwise(3),
        )
        .select("intent_id", "utterance", "_stage", F.lit(0).cast("long").alias("_base"), "row")
    )
    both = base_top.select(
        "intent_id",
        "utterance",
        F.lit(0).alias("_stage"),
        "_base",
        F.lit(None).cast(seeds.schema["row"].dataType).alias("row"),
    ).unionByName(staged_seeds)
    order = ["_stage", "_base", "row"]
    in_order = Window.partitionBy("intent_id").orderBy(*order)
    return (
        first_per_key(both, ["intent_id", "utterance"], order)
        .withColumn("_rank", F.row_number().over(in_order).cast("long"))
        .where(
            ((F.col("_stage") < 3) & (F.col("_rank") <= max_rows))
            | ((F.col("_stage") == 3) & (F.col("_rank") <= min_rows))
        )
        .select("intent_id", "utterance", F.col("_rank").alias("rank"))
    )


def display_names(base: DataFrame) -> DataFrame:
    """Last name seen per intent in row order."""
    return base.groupBy("intent_id").agg(F.max_by("intent_name", "row").alias("intent_name"))


def with_display_name(df: DataFrame, names: DataFrame) -> DataFrame:
    """Attach the display name; an intent without one shows its id."""
    return df.join(names, "intent_id", "left").withColumn(
        "intent_name", F.coalesce("intent_name", "intent_id")
    )


def intents_in_need(base: DataFrame, targets: Mapping[str, int]) -> DataFrame:
    """Targets with their present count, where it is under the target."""
    counts = (
        base.where(F.col("intent_id").isin(list(targets)))
        .groupBy("intent_id")
        .agg(F.count("utterance").alias("before"))
    )
    wanted = base.sparkSession.range(1).select(
        F.inline(targets_needing_rows(targets))
    )
    return (
        wanted.join(counts, "intent_id", "left")
        .withColumn("before", F.coalesce("before", F.lit(0)))
        .where(F.col("before") < F.col("target"))
        .withColumn("need", F.col("target") - F.col("before"))
    )


def not_in_base(
    candidates: DataFrame, base: DataFrame, base_is_bounded: bool = False
) -> DataFrame:
    """Drop candidates whose intent and case-folded text are in ``base``.

    ``base_is_bounded`` says that the caller has a bound on the base rows, so they may be broadcast.
    Otherwise a skewed candidate side is left to adaptive execution, which splits it.
    """
    present = base.select("intent_id", strip(F.lower("utterance")).alias("_low")).distinct()
    keyed = candidates.withColumn("_low", F.lower("utterance"))
    if base_is_bounded:
        present = F.broadcast(present)
    kept = keyed.join(present, ["intent_id", "_low"], "left_anti")
    return kept.select(*[F.col(f"`{c}`") for c in candidates.columns])


def topup_rows(
    base: DataFrame,
    calls: DataFrame,
    rules: Rules = lex.TOPUP_RULES,
    targets: Mapping[str, int] = lex.TOPUP_TARGETS,
    agent_openings: Iterable[str] = lex.AGENT_OPENINGS,
    sentences_of: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """First new matching sentences, in scan order, up to what each target intent misses.

    "Stop once satisfied" is a rank cut after known rows and repeats are gone, so the order of
    work does not matter and each intent's cut is made per map task first.
    """
    need = F.broadcast(intents_in_need(base, targets).select("intent_id", "need"))  # <= targets
    text = F.coalesce(first_nonempty("customer_text", "full_text"), F.lit(""))
    found = sentences_of(calls) if sentences_of else explode_sentences(calls, text, 5, 300)
    hits = (
        computed_once(found, {"utterance": normalize_slots("utterance")})
        .where(matches_any("utterance", rules))
        .withColumn("_hits", topup_match("utterance", rules, agent_openings))
        .where(F.size("_hits") > 0)
        .select(*ORDER, "utterance", F.explode("_hits").alias("intent_id"))
        .join(need, "intent_id")
    )
    # a needy intent has fewer base rows than its target, so this side is small by definition
    known = base.join(need, "intent_id", "left_semi")
    fresh = dedup_pairs(not_in_base(hits, known, base_is_bounded=True), ORDER)
    most = max(targets.values(), default=0)
    return (
        top_k_per_group(fresh, ["intent_id"], list(ORDER), most, rank="rank")
        .where(F.col("rank") <= F.col("need"))
        .select("intent_id", "utterance", "rank")
    )


def append_and_cap(
    base: DataFrame, adds: DataFrame, max_rows: int = lex.MAX_PER_INTENT
) -> DataFrame:
    """Base rows, then added rows; first of each pair, ``max_rows`` per intent.

    ``row`` of the result orders the rows of an intent. With nothing to add the base stays as it
    is, duplicates included; this looks at ``adds``, so hand in a written table. ``row`` of the base
    may be anything that orders.
    """
    kept = ["intent_id", "intent_name", "utterance"]
    if adds.isEmpty():
        return base.select(*kept, "row")
    own = base.schema["row"].dataType
    added = adds.select(
        "intent_id",
        F.col("intent_id").alias("intent_name"),
        "utterance",
        F.lit(1).alias("_part"),
        F.lit(None).cast(own).alias("_own"),
        F.col("rank").alias("_added"),
    )
    both = base.select(
        *kept,
        F.lit(0).alias("_part"),
        F.col("row").alias("_own"),
        F.lit(None).cast(adds.schema["rank"].dataType).alias("_added"),
    ).unionByName(added)
    order = ["_part", "intent_id", "_own", "_added"]
    capped = top_k_per_group(
        dedup_pairs(both, order), ["intent_id"], order, max_rows, rank="_place"
    )
    return capped.select(*kept, F.col("_place").alias("row"))


def whitelist(df: DataFrame, intents: Iterable[str] = lex.ANSWERABLE_INTENTS) -> DataFrame:
    return df.where(F.col("intent_id").isin(list(intents)))


def cap_per_intent(
    df: DataFrame, order: Sequence[str], max_rows: int = lex.MAX_PER_INTENT
) -> DataFrame:
    return top_k_per_group(df, ["intent_id"], list(order), max_rows)


def clean_rows(df: DataFrame) -> DataFrame:
    """Drop null intents and utterances, strip both, keep utterances longer than two characters."""
    return (
        df.dropna(subset=["intent_id", "utterance"])
        .withColumn("intent_id", strip("intent_id"))
        .withColumn("utterance", strip("utterance"))
        .where(F.length("utterance") > 2)
    )


def pack(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """One row per intent: ``samples[]`` in order and the name of the first.

    A pack holds whatever rows an intent has, so an intent is one row here; where that may be too
    many, ``pack_parts`` cuts it into rows of bounded size.
    """
    place = F.struct(*order)
    return (
        df.groupBy("intent_id")
        .agg(
            F.min_by("intent_name", place).alias("name"),
            F.array_sort(F.collect_list(F.struct(place.alias("_place"), "utterance"))).alias("_rows"),
        )
        .select("intent_id", "name", F.transform("_rows", lambda s: s["utterance"]).alias("samples"))
    )


PART_SAMPLES = 10_000


def pack_parts(df: DataFrame, order: Sequence[str], max_samples: int = PART_SAMPLES) -> DataFrame:
    """Packs of bounded size: ``(intent_id, name, part, samples[])``, parts of an intent in order.

    Rows get their place by ranges and prefix sums, so an intent of any size is spread over tasks,
    and a row holds at most ``max_samples`` utterances. ``name`` is the one of the intent's first row.
    """
    placed = numbered(df.select("intent_id", "intent_name", "utterance", *order), ["intent_id", *order], "_at")
    placed = written(placed, "placed")
    first = placed.groupBy("intent_id").agg(
        F.min("_at").alias("_first"), F.min_by("intent_name", "_at").alias("name")
    )
    parts = placed.join(first, "intent_id").withColumn(
        "part", F.floor((F.col("_at") - F.col("_first")) / max_samples)
    )
    return (
        parts.groupBy("intent_id", "part")
        .agg(
            F.first("name").alias("name"),
            F.array_sort(F.collect_list(F.struct("_at", "utterance"))).alias("_rows"),
        )
        .select(
            "intent_id", "name", "part", F.transform("_rows", lambda s: s["utterance"]).alias("samples")
        )
    )
