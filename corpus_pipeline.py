"""The corpus pipeline: quality rules, quality classifier, near-duplicates, packing.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; all but the last return the
columns of ``docs``. Between stages the documents are written as parquet and read again.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from callsift.llm import near_dups, packing, quality_net, quality_rules
from callsift.llm.common import free_name, table
from callsift.session import written

MIN_QUALITY = 0.5


def apply_quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go, null and empty texts among them; repeated rows are judged
    alike, and long texts whole."""
    return quality_rules.keep(docs)


def apply_quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below ``MIN_QUALITY`` go. The network learns from the stage's own input and
    is calibrated to the labels of the documents in it; without labels of both kinds all score alike.
    Null and empty texts are scored as an empty one, long texts whole; repeated rows score alike."""
    model = quality_net.fit(docs, labels_of(spark, docs, sf_dir))
    score = free_name(docs, "_score")
    scored = quality_net.with_score(docs, model, out=score)
    return scored.where(F.col(score) >= MIN_QUALITY).select(docs.columns)


def labels_of(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "labels").join(docs.select("doc_id"), "doc_id", "left_semi")


def apply_near_dups(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays: the one with the smallest id, once if it is repeated. Rows
    with a null id stay, and so do texts without words, which are like none."""
    found = written(near_dups.near_duplicates(docs), "near-dups")
    copies = written(found.where(~F.col("kept")).select("doc_id").distinct(), "copies")
    left = docs.join(copies, "doc_id", "left_anti").select(docs.columns)
    repeated = found.where("doc_id is not null").groupBy("doc_id").count().where("count > 1")
    if repeated.isEmpty():
        return left
    return left.where("doc_id is not null").dropDuplicates(["doc_id"]).unionByName(
        left.where("doc_id is null")
    )


def apply_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents in sequences of 4096 tokens; a null or empty text has its end token alone."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality_rules", apply_quality_rules),
    ("quality_classifier", apply_quality_classifier),
    ("near_dups", apply_near_dups),
    ("packing", apply_packing),
]
#: The classifier and the packing are not expressible in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
