"""Stage tables: parquet, CSV and JSON lines, with explicit schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from callsift.operators.ranking import numbered

CALL_SCHEMA = (
    "source_zip string, file_name string, domain string, topic string, n_turns long, "
    "n_customer_turns long, customer_text string, agent_text string, full_text string, hash string"
)
UTTERANCE_SCHEMA = "intent_id string, intent_name string, utterance string"
SEED_SCHEMA = "intent_id string, utterance string"
GOLD_SCHEMA = (
    "intent_id string, intent_name string, cluster_id int, sample_question string, "
    "gold_answer string, source_refs string, policy_notes string"
)
HANDOFF_SCHEMA = (
    "intent_id string, intent_name string, cluster_id int, sample_question string, "
    "handoff_reason string, handoff_destination string"
)
CATALOG_SCHEMA = (
    "intent_id string, cluster_id int, intent_name string, size long, answerable boolean, "
    "handoff_reason string, top_terms array<string>, examples array<string>"
)
PACK_SCHEMA = "intent_id string, name string, samples array<string>"
FAQ_SCHEMA = (
    "intent_id string, question string, gold_answer string, source_refs string, "
    "policy_notes string"
)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Headered CSV; quoted cells may hold line breaks and doubled quotes."""
    return spark.read.csv(path, schema=schema, header=True, multiLine=True, escape='"', quote='"')


def with_row(df: DataFrame, out: str = "row") -> DataFrame:
    """Rows just read from files with their place: by file name, then as they stand in the file."""
    placed = df.select(
        "*", F.col("_metadata.file_path").alias("_file"), F.monotonically_increasing_id().alias("_seen")
    )
    return numbered(placed, ["_file", "_seen"], out).drop("_file", "_seen")


def read_jsonl(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).json(path)


def read_json_array(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A file that holds one JSON array of objects, as small hand-kept files do."""
    return spark.read.schema(schema).json(path, multiLine=True)

