"""Rule files: speaker aliases, keyword lists and override tables (YAML or JSON).

Rule files are hand-kept and small. Spark reads them, from any file system, and their size is checked
before they become literals of a plan.
"""

from __future__ import annotations

import hashlib
import json
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from callsift.operators.catalog import OVERRIDE_SCHEMA

MAX_RULE_BYTES = 4 << 20


def rule_text(path: str) -> str:
    """The text of a rule file on any file system that Spark reads; a folder holds one file. Rules come
    to the driver and go out in plans, so a file above ``MAX_RULE_BYTES`` is an error."""
    spark = SparkSession.active()
    files = spark.read.format("binaryFile").load(path).select("path", "length").collect()  # the listing
    if len(files) != 1:
        raise ValueError(f"{len(files)} files at {path}, one rule file expected")
    if files[0]["length"] > MAX_RULE_BYTES:
        raise ValueError(f"{files[0]['length']} bytes of rules at {path}; at most {MAX_RULE_BYTES} are allowed")
    row = spark.read.text(path, wholetext=True).first()
    return row["value"] if row else ""


def load_rule_file(path: str) -> Any:
    text = rule_text(path)
    if path.endswith((".yaml", ".yml")):
        try:
            import yaml
        except ImportError as missing:
            raise RuntimeError("YAML rule files need PyYAML; use JSON instead") from missing
        return yaml.safe_load(text) or {}
    return json.loads(text)


def rule_version(path: str) -> str:
    """A digest of the rule file, to be kept with what was made by it."""
    return hashlib.sha256(rule_text(path).encode()).hexdigest()


def load_aliases(path: str) -> tuple[list[str], list[str]]:
    """(customer, agent) aliases, lower-cased."""
    loaded = load_rule_file(path)
    return tuple([str(a).lower() for a in loaded.get(side, [])] for side in ("customer", "agent"))


def load_keywords(path: str) -> list[str]:
    return [str(k) for k in load_rule_file(path).get("include", [])]


def overrides_table(spark: SparkSession, items: list[dict]) -> DataFrame:
    """Override entries as rows; ``has_*`` tells a present field from a missing one."""
    rows = [
        (
            int(item["cluster_id"]),
            item.get("intent_id"),
            item.get("suggested_intent"),
            bool(item["answerable"]) if "answerable" in item else None,
            item.get("handoff_reason"),
            "answerable" in item,
            "handoff_reason" in item,
            n,
        )
        for n, item in enumerate(items)
    ]
    return spark.createDataFrame(rows, OVERRIDE_SCHEMA)


def load_overrides(spark: SparkSession, path: str) -> DataFrame:
    return overrides_table(spark, load_rule_file(path).get("clusters", []))
