"""Adapters from the given tables to the engine's shapes, and the rule sets that hit their text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from callsift.functions.rules import seed_match
from callsift.functions.text import sentences
from callsift.operators.calls import turns_by_call
from callsift.operators.shaping import computed_once
from callsift.sources.tables import read_parquet
from checks import sql as q

DOMAIN_WORDS = ("that", "with", "from")
UNWANTED_WORDS = ("worthless", "thth")
CUSTOMER = ("user", "customer")
AGENT = ("agent", "assistant")
SEEDS = (
    ("that", r"\bthat\b"),
    ("with", r"\b(with|from)\b"),
    ("for", r"\bfor\b"),
    ("past", r"\b(was|are)\b"),
    ("der", r"\b(die|der)\b"),
    ("les", r"\b(les|des)\b"),
    ("que", r"\bque\b"),
    ("ach", r"\bach\b"),
)
STRICT = (
    ("that", r"\bthat\b.*\b(the|of|in)\b"),
    ("with", r"\b(with|from)\s+(the|a|this)\b|\bof\b"),
    ("der", r"\b(die|der)\b"),
)
TOPUPS = (
    ("ach", r"\b(ach|auf|mit)\b"),
    ("que", r"\bque\b"),
    ("rare", r"\b(worthless|hein|erat)\b"),
    ("dated", r"\{date\}\s+(the|die|les)\b"),
)
TARGETS = {"ach": 50, "que": 40, "rare": 30, "dated": 25}
AGENT_OPENINGS = ("the ", "die ", "les ")
WHITELIST = ("that", "with", "for", "der", "les", "ach")
FIRST_PERSON = ("he", "was", "la")
DOMAIN_TERMS = ("that", "ist", "pour")


# A session may set into how many partitions the given tables are dealt: as files of one row group
# they would else be read by one task. Unset, as on a cluster, tables are read as they lie.
READ_PARTITIONS = "callsift.checks.readPartitions"


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    rows = read_parquet(spark, f"{sf}/{name}.parquet")
    parts = spark.conf.get(READ_PARTITIONS, None)
    return rows.repartition(int(parts)) if parts else rows


def documents(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents")


def turns(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "conversations").select(
        F.concat(F.lit("z"), (F.col("conv_id") % 8).cast("string")).alias("source_zip"),
        F.col("conv_id").alias("ord"),
        F.concat(F.col("conv_id").cast("string"), F.lit(".json")).alias("file_name"),
        F.col("turn").alias("pos"),
        F.col("role").alias("speaker"),
        "text",
    )


def turn_calls(spark: SparkSession, sf: str) -> DataFrame:
    """Conversations as calls with their ordered turns."""
    grouped = turns_by_call(turns(spark, sf), ["source_zip", "ord", "file_name"])
    return grouped.withColumn("domain", F.lit(None).cast("string")).withColumn(
        "topic", F.lit(None).cast("string")
    )


def calls(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as calls without speakers."""
    return documents(spark, sf).select(
        F.col("source").alias("source_zip"),
        F.col("doc_id").alias("ord"),
        F.col("doc_id").cast("string").alias("file_name"),
        F.col("lang").alias("domain"),
        F.col("source").alias("topic"),
        F.lit(None).cast("string").alias("customer_text"),
        F.col("text").alias("full_text"),
    )


def half_calls(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as calls, every second one with its text on the customer side."""
    even = F.col("ord") % 2 == 0
    return calls(spark, sf).withColumn("customer_text", F.when(even, F.col("full_text")))


def blobs(spark: SparkSession, sf: str) -> DataFrame:
    """One prefixed transcript per conversation."""
    line = F.concat(
        F.when(F.col("speaker") == "user", F.lit("Customer: ")).otherwise(F.lit("Agent - ")), "text"
    )
    lined = turns(spark, sf).withColumn("text", line)
    return turns_by_call(lined, ["source_zip", "ord", "file_name"]).select(
        "source_zip",
        "ord",
        "file_name",
        F.lit(None).cast("string").alias("customer_text"),
        F.array_join(F.transform("turns", lambda t: t["text"]), "\n").alias("full_text"),
    )


def utterances(spark: SparkSession, sf: str) -> DataFrame:
    """Labelled sentences with questions and slot markers added by rule:
    ``(source_zip, ord, pos, intent_id, utterance)``."""
    split = calls(spark, sf).select("source_zip", "ord", F.posexplode(sentences("full_text", 5, 300)))
    split = split.withColumn("pos", F.col("pos").cast("long"))
    kept = computed_once(split, {"intent_id": seed_match("col", SEEDS)}).where(F.col("intent_id").isNotNull())
    place = F.col("ord") + F.col("pos")
    asked = F.when(
        place % 3 == 0, F.concat(F.substring("col", F.lit(1), F.length("col") - 1), F.lit("?"))
    ).otherwise(F.col("col"))
    marked = F.when(place % 5 == 0, F.concat(F.lit("[DATE] "), asked)).otherwise(asked)
    return kept.select("source_zip", "ord", "pos", "intent_id", marked.alias("utterance"))


def part(shares: Sequence[str]) -> Column:
    """A share of the rows by a hash of their place, as ``checks.sql.part``; the others play the other side."""
    place = F.concat_ws("|", "source_zip", F.col("ord").cast("string"), F.col("pos").cast("string"))
    return F.substring(F.sha2(place, 256), 1, len(shares[0])).isin(*shares)


def base_utterances(spark: SparkSession, sf: str) -> DataFrame:
    """A share of the labelled utterances, from all documents and places, as existing rows, and names
    for most intents."""
    u = utterances(spark, sf).where(part(q.BASE_SHARE))
    return u.select(
        "intent_id",
        F.concat(F.lit("name_"), "intent_id").alias("intent_name"),
        "utterance",
        F.struct("source_zip", "ord", "pos").alias("row"),
    )


def labelled_clusters(spark: SparkSession, sf: str) -> DataFrame:
    """Sentences with a fixed cluster: the number of the document's source."""
    return calls(spark, sf).select(
        "source_zip",
        "ord",
        F.regexp_extract("source_zip", r"(\d+)$", 1).cast("int").alias("cluster_id"),
        F.posexplode(sentences("full_text", 5, 400)),
    ).select(
        "source_zip",
        "ord",
        F.col("pos").cast("long").alias("pos"),
        "cluster_id",
        F.col("col").alias("utterance"),
    )
