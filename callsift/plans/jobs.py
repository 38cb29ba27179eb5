"""The stages of the workflow as Spark jobs.

Each job takes tables and rules and returns tables; nothing is written unless a sink is called, and
no job overwrites what it reads. ``(source_zip, ord, pos)`` carries "first seen" order throughout.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from callsift.functions import lexicons as lex
from callsift.functions.rules import Rules, dev_sample_predicate, exact_bucket
from callsift.functions.text import has_word, prefer_customer, truncate
from callsift.operators import calls as call_ops
from callsift.operators import catalog as cat
from callsift.operators import clusters as clu
from callsift.operators import reports as rep
from callsift.operators import terms as term_ops
from callsift.operators import utterances as utt
from callsift.operators.classify import train_intent_classifier
from callsift.operators.ranking import first_rows, first_written_rows, sample_n, stratified_split
from callsift.operators.shaping import computed_once
from callsift.session import written
from callsift.sources import sinks
from callsift.sources.archives import scan_zip_json
from callsift.sources.records import decode_json, decode_tagged, raw_calls, raw_texts, rejects_of

# --- fixed values: sizes of the samples and limits the stages use --------------------------------

DEV_ROWS = 1000
BUCKET_ROWS = 5000
SAMPLE_CHARS = 50_000
CALL_SAMPLE = 1000
SPOT_CHECK = 200
MIN_CORPUS = 50


def call_order(df: DataFrame) -> list[str]:
    """What orders calls: archives of one base name differ in their path, where it is known."""
    return [c for c in ("source_zip", "path", "ord") if c in df.columns]



def read_raw(spark: SparkSession, glob: str) -> tuple[DataFrame, DataFrame]:
    """Archives to (decoded records, rejects)."""
    return decode_json(scan_zip_json(spark, glob))


@dataclass(frozen=True)
class Parsed:
    """What one reading of archives gives; ``counts`` has the members checked, good and rejected."""

    rows: DataFrame
    rejects: DataFrame
    counts: dict[str, int]


def parse_archives(
    spark: SparkSession, glob: str, extract: Callable[..., DataFrame] = raw_calls
) -> Parsed:
    """Archives to the rows that ``extract`` makes of their records, the rejects, and counters.

    Members are unzipped and parsed once: all go into one table, written with a folder for good ones
    and one for rejects, and that table is counted.
    """
    tagged = decode_tagged(scan_zip_json(spark, glob))
    status = F.when(F.col("reason").isNull(), "good").otherwise("reject")
    table = written(extract(tagged, "reason", "error").withColumn("status", status), "parsed", ["status"])
    good = table.where("status = 'good'").drop("status", "reason", "error")
    rejects = rejects_of(table.where("status = 'reject'"), ("source_zip", "path", "ord", "file_name", "error"))
    found = {r["status"]: r["count"] for r in table.groupBy("status").count().collect()}
    counts = {"good": found.get("good", 0), "rejected": found.get("reject", 0)}
    return Parsed(good, rejects, {"checked": sum(counts.values())} | counts)


def profile_source(
    df: DataFrame, order: Sequence[str], metadata: Iterable[str] = rep.METADATA_COLUMNS
) -> dict[str, DataFrame]:
    """Column profile, first rows, the first text, and the 15 most common values of each metadata column."""
    present = [c for c in metadata if c in df.columns]
    return {
        "columns": rep.column_profile(df, metadata),
        "preview": rep.preview_rows(df, order),
        "distinct": rep.distinct_values(df),
        "text_preview": rep.text_preview(df, order),
        **{f"top_{c}": rep.top_values(df, c, 15) for c in present if c not in ("accent", "language")},
    }


def dev_sample(texts: DataFrame, n: int = DEV_ROWS, **rules) -> DataFrame:
    """First ``n`` records that hit a keyword or a metadata word, with their text cut."""
    kept = texts.where(F.col("text") != "").where(
        dev_sample_predicate("text", "domain", "topic", **rules)
    )
    return first_rows(kept.withColumn("text", truncate("text", SAMPLE_CHARS)), call_order(kept), n)


def dev_sample_outputs(texts: DataFrame, n: int = DEV_ROWS, **rules) -> dict[str, DataFrame]:
    """The sample, written once, and its ten most common domains and topics."""
    sample = written(dev_sample(texts, n, **rules), "dev-sample")  # n rows
    return {
        "sample": sample,
        "top_domain": rep.top_values(sample, "domain", 10),
        "top_topic": rep.top_values(sample, "topic", 10),
    }


def extract_bucket(
    texts: DataFrame, label: str = lex.BUCKET_LABEL, n: int = BUCKET_ROWS
) -> DataFrame:
    """First ``n`` records of one exact bucket, with their text cut."""
    return extract_bucket_outputs(texts, label, n)["rows"]


def extract_bucket_outputs(
    texts: DataFrame, label: str = lex.BUCKET_LABEL, n: int = BUCKET_ROWS
) -> dict[str, DataFrame]:
    """The bucket's first rows, a preview and raw samples of them, what was kept and skipped, and the
    five most common domains and topics.

    The bucket is written once. Records without text are skipped; counted are those that stand
    before the last row kept, or all where there are fewer than ``n`` rows.
    """
    order = call_order(texts)
    bucket = texts.where(exact_bucket("domain", "topic", "file_name", label))
    bucket = written(bucket.withColumn("text", truncate("text", sinks.RAW_SAMPLE_CHARS)), "bucket")
    found = written(first_written_rows(bucket.where(F.col("text") != ""), order, n), "bucket-rows")  # n rows
    rows = found.withColumn("text", truncate("text", SAMPLE_CHARS)).withColumnRenamed("file_name", "source_file")
    place = F.struct(*order)
    end = found.agg(F.count("*").alias("kept"), F.max(place).alias("last"))
    empty = bucket.where(F.coalesce(F.col("text") == "", F.lit(True))).select(place.alias("place"))
    counters = empty.join(F.broadcast(end)).agg(  # one row
        F.count_if((F.col("kept") < n) | (F.col("place") < F.col("last"))).alias("skipped")
    )
    return {
        "rows": rows,
        "preview": rows.orderBy(*order).limit(sinks.PREVIEW_ROWS),
        "samples": sinks.raw_samples(found, order),
        "counters": end.select("kept").join(F.broadcast(counters)),
        "top_domain": rep.top_values(rows, "domain", 5),
        "top_topic": rep.top_values(rows, "topic", 5),
    }


def build_subset(
    calls: DataFrame,
    keywords: Iterable[str] = lex.BUILD_KEYWORDS,
    customer: Iterable[str] = lex.CUSTOMER_ALIASES,
    agent: Iterable[str] = lex.AGENT_ALIASES,
) -> DataFrame:
    """Records with turns to the domain's calls: texts per role, keyword filter, first per hash."""
    texts = call_ops.with_call_texts(calls, customer, agent)
    return call_ops.first_by_hash(call_ops.keyword_calls(texts, keywords), call_order(texts))


def build_subset_outputs(
    calls: DataFrame,
    keywords: Iterable[str] = lex.BUILD_KEYWORDS,
    customer: Iterable[str] = lex.CUSTOMER_ALIASES,
    agent: Iterable[str] = lex.AGENT_ALIASES,
) -> dict[str, DataFrame]:
    """The domain's calls, a sample of them, the counters, and the ten archives with most calls.

    Texts are made and tested once: all calls go into one table, in a folder each for those with and
    without a domain word, and the latter without their texts.
    """
    texts = call_ops.with_call_texts(calls, customer, agent, keep_blank=True)
    preferred = prefer_customer("customer_text", "full_text")
    hit = F.coalesce((F.col("full_text") != "") & has_word(preferred, keywords), F.lit(False))
    tagged = computed_once(texts, {"hit": hit})
    hollow = {c: F.when(F.col("hit"), F.col(c)) for c in ("customer_text", "agent_text", "full_text")}
    table = written(tagged.withColumns(hollow), "tested", ["hit"])
    matched = table.where("hit").drop("hit")
    kept = written(call_ops.first_by_hash(matched, call_order(matched)), "calls")
    counters = table.agg(F.count("*").alias("checked"), F.count_if("hit").alias("matched"))
    return {
        "calls": kept,
        "sample": call_sample(kept),
        "counters": counters.join(F.broadcast(kept.agg(F.count("*").alias("kept")))),  # one row each
        "top_archives": rep.top_values(kept, "source_zip", 10),
    }


def subset_counters(
    calls: DataFrame, keywords: Iterable[str] = lex.BUILD_KEYWORDS, **aliases
) -> DataFrame:
    """Records checked, records that pass the keyword filter, and distinct calls kept."""
    return build_subset_outputs(calls, keywords, **aliases)["counters"]


def call_sample(calls: DataFrame, n: int = CALL_SAMPLE, seed: int = 42) -> DataFrame:
    return sample_n(calls, call_order(calls), n, seed)


def eda_report(
    calls: DataFrame, n_terms: int = 50, stops: Iterable[str] = lex.ENGLISH_STOPS, min_df: int = 5
) -> dict[str, DataFrame]:
    """Turn counts, share with customer text, lengths, top terms and a spot-check sample."""
    preferred = calls.withColumn("text", prefer_customer("customer_text", "full_text"))
    return {
        "turns": rep.describe(calls, ["n_turns", "n_customer_turns"]),
        "customer_text_rate": rep.customer_text_rate(calls),
        "lengths": rep.length_stats(
            calls, {c: F.col(c) for c in ("customer_text", "full_text")}
        ),
        "top_terms": term_ops.top_terms(preferred, "text", n_terms, stops, min_df),
        "spot_check": sample_n(preferred, call_order(preferred), SPOT_CHECK).select("text"),
    }


def refine_subset(calls: DataFrame, **rules) -> DataFrame:
    return call_ops.refine_calls(calls, **rules).select(
        "source_zip", "ord", "file_name", "customer_text", "full_text"
    )


def refined_lengths(refined: DataFrame) -> DataFrame:
    return rep.length_stats(
        refined, {"text": F.coalesce("customer_text", "full_text")}
    ).select("median", "p90")


def discover_intents(
    refined: DataFrame,
    k_min: int = 10,
    k_max: int = 28,
    n_init: int = 10,
    max_iter: int = 300,
    min_df: int = 5,
    max_df: float = 0.6,
    max_features: int = 50_000,
    seed: int = 42,
    sample_size: int = 5000,
    stops: Iterable[str] = lex.DISCOVERY_STOPS,
    candidates: Mapping[str, Iterable[str]] | None = None,
) -> dict[str, DataFrame] | None:
    """Cluster the calls' utterances and name the clusters; None below 50 utterances.

    The corpus and its features are written to the shared folder: every fit reads them from there,
    and a lost executor costs one read and not the work before it.
    """
    corpus = written(
        utt.dedup_corpus(utt.candidate_sentences(refined, **(candidates or {})))
    )
    if corpus.limit(MIN_CORPUS).count() < MIN_CORPUS:
        return None
    model = term_ops.fit_tfidf(corpus, "utterance", stops, min_df, max_df, max_features)
    features = model.transform(corpus)
    choice = clu.choose_k(features, utt.ORDER, k_min, k_max, n_init, seed, sample_size, max_iter)
    best = choice.models.get(choice.k)
    if best is None:
        best = clu.kmeans_best(features, clu.FALLBACK_K, n_init, seed, max_iter)
    assigned = written(best.transform(features), "assigned")
    top = term_ops.cluster_top_terms(assigned, model, 12)
    summary = written(clu.cluster_summary(assigned, top, utt.ORDER))  # one row per cluster
    spark = refined.sparkSession
    return {
        "assigned": assigned.select(*utt.ORDER, "utterance", "cluster_id"),
        "clusters": summary,
        "suggestions": cat.suggest_names(summary),
        "choice": spark.createDataFrame([(best.getK(), float(choice.score))], "k int, silhouette double"),
        "scores": spark.createDataFrame(list(choice.scores.items()), "k int, silhouette double"),
    }


def curate_catalog(clusters: DataFrame, suggestions: DataFrame, overrides: DataFrame) -> DataFrame:
    """Clusters with suggested names and overrides to catalog entries, larger clusters first."""
    entries = cat.catalog_entries(
        cat.apply_overrides(cat.draft_catalog(clusters, suggestions), overrides)
    )
    return entries.orderBy(F.desc("size"), "cluster_id")


def gold_scaffold(catalog: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(gold answers to write, handoff list)."""
    return cat.gold_todo(catalog), cat.handoff_list(catalog)


validate_catalog = cat.validate_catalog


def export_training(catalog: DataFrame) -> dict[str, DataFrame]:
    return {
        "utterances": cat.training_rows(catalog),
        "pack": cat.training_pack(catalog),
        "handoff": cat.handoff_routes(catalog),
    }


harvest_seeds = utt.harvest_seeds


def in_rows(df: DataFrame) -> DataFrame:
    """Utterances with the column ``row`` that orders them: their own, or the ``rank`` or the places that
    an earlier stage gave them."""
    if "row" in df.columns:
        return df
    if "rank" in df.columns:
        return df.withColumnRenamed("rank", "row")
    places = [c for c in utt.ORDER if c in df.columns]
    if not places:
        raise ValueError("no column orders these rows: read them with tables.with_row")
    return df.withColumn("row", F.struct(*places))


def merge_seeds(
    base: DataFrame, seeds: DataFrame, strict_rules: Rules = lex.STRICT_RULES, **limits
) -> DataFrame:
    """Base rows ``(intent_id, intent_name, utterance, row)`` and harvested seeds to the mixed set
    ``(intent_id, intent_name, utterance, rank)``."""
    base = in_rows(base)
    order = [c for c in (*utt.ORDER, "row") if c in seeds.columns]
    cleaned = utt.clean_seeds(seeds, order, strict_rules).withColumn("row", F.struct(*order))
    mixed = utt.quota_mix(base, cleaned, **limits)
    return utt.with_display_name(mixed, utt.display_names(base))


def top_up(
    base: DataFrame,
    calls: DataFrame,
    rules: Rules = lex.TOPUP_RULES,
    targets: Mapping[str, int] = lex.TOPUP_TARGETS,
    max_rows: int = lex.MAX_PER_INTENT,
    **options,
) -> DataFrame:
    """Base plus the missing rows of the target intents, capped.

    The added rows, fewer than the targets' sum, are found by one pass over the calls and written
    to the shared folder, as they decide whether the base is touched at all.
    """
    base = in_rows(base)
    adds = written(utt.topup_rows(base, calls, rules, targets, **options))
    return utt.append_and_cap(base, adds, max_rows)


def build_eval_sets(
    utterances: DataFrame, key: Sequence[str], share: float = 0.2, seed: int = 42
) -> DataFrame:
    """Cleaned rows with their ``split``."""
    return stratified_split(utt.clean_rows(utterances), "intent_id", key, share, seed)


def enforce_whitelist(
    utterances: DataFrame,
    order: Sequence[str] = ("intent_id", "row"),
    intents: Iterable[str] = lex.ANSWERABLE_INTENTS,
    max_rows: int = lex.MAX_PER_INTENT,
    min_rows: int = lex.MIN_PER_INTENT,
) -> dict[str, DataFrame]:
    """Whitelisted, de-duplicated and capped rows, the intents below the minimum, and new splits.

    The kept rows, at most ``max_rows`` an intent, are written once; everything else reads them there.
    """
    kept = written(
        utt.cap_per_intent(
            utt.dedup_pairs(utt.whitelist(utterances, intents), list(order)), order, max_rows
        ),
        "kept",
    )
    return {
        "utterances": kept,
        "below_minimum": rep.below_minimum(kept, min_rows),
        "splits": build_eval_sets(kept, ["intent_id", "utterance"]),
    }


def quality_report(splits: DataFrame) -> dict[str, DataFrame]:
    """Counts and question mix per intent and split, leftover placeholders, and leaked pairs."""
    train, dev = (splits.where(F.col("split") == s) for s in ("train", "dev"))
    return {
        "counts": splits.groupBy("split", "intent_id").agg(F.count("*").alias("count")),
        "question_ratio": rep.question_ratio(splits, ["split", "intent_id"]),
        "placeholders": rep.placeholder_audit(splits),
        "leakage": rep.leaked_pairs(train, dev),
    }


def baseline_classifier(splits: DataFrame, **options) -> dict[str, DataFrame]:
    """Train on the train rows, predict the dev rows, and report."""
    train, dev = (splits.where(F.col("split") == s) for s in ("train", "dev"))
    predictions = train_intent_classifier(train, **options).predict(dev)
    return {
        "predictions": predictions,
        "report": rep.classification_report(predictions, "intent_id", "prediction"),
    }


def subset_from_archives(spark: SparkSession, glob: str, **rules) -> tuple[DataFrame, DataFrame]:
    """(domain calls, rejects) straight from archives, which are read once."""
    parsed = parse_archives(spark, glob)
    return build_subset(parsed.rows, **rules), parsed.rejects


def texts_from_archives(spark: SparkSession, glob: str) -> tuple[DataFrame, DataFrame]:
    """(records with their plain text, rejects); the archives are read once."""
    parsed = parse_archives(spark, glob, raw_texts)
    return parsed.rows, parsed.rejects
