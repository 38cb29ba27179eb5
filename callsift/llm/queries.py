"""The registered queries of the text operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from callsift.llm import (
    centroids,
    language_model,
    licenses,
    merkle,
    near_dups,
    neighbours,
    oracles,
    packing,
    pieces,
    quality_net,
    quality_rules,
    token_counts,
    toxicity,
    urls,
)
from callsift.llm.common import held_out, table


def op6_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    judged = quality_rules.judge(table(spark, sf, "documents"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept",
    )

URL_RULES = (
    urls.rule("allow", "com/"),
    urls.rule("block", "example.com/en/"),
    urls.rule("allow", "www.example.com/en/"),
    urls.rule("block", "net/es/"),
    urls.rule("block", "net/fr/"),
)


def op1_packing(spark: SparkSession, sf: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return pieces.select(
        "doc_id", "start", "length", F.crc32("tokens").alias("ids_crc32"), "doc_tokens",
        "sequence_id", "offset",
    )


def _scored(scored: DataFrame, threshold: float) -> DataFrame:
    return scored.select(
        "doc_id",
        held_out("doc_id").alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def op2_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    model = toxicity.fit(docs, table(spark, sf, "labels"))
    return _scored(toxicity.with_score(docs.select("doc_id", "text"), model), 0.3)


def op3_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return token_counts.with_counts(docs, public_tokenizers.path("byte_bpe_50k.json")).drop("text")


def op4_license_scans(spark: SparkSession, sf: str) -> DataFrame:
    found = licenses.find(table(spark, sf, "documents"))
    return found.withColumns({c: F.round(c, 4) for c in ("probability", "overlap")})


def op5_quality_classifier(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    model = quality_net.fit(docs, table(spark, sf, "labels"))
    return _scored(quality_net.with_score(docs.select("doc_id", "text"), model), 0.7)


def op7_url_filters(spark: SparkSession, sf: str) -> DataFrame:
    judged = urls.judge(table(spark, sf, "pages").select("page_id", "url"), URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op8_sentencepiece(spark: SparkSession, sf: str) -> DataFrame:
    model = public_tokenizers.path("piece_bpe_32k.model")
    docs = table(spark, sf, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    coded = pieces.with_ids(docs, model, decoded="decoded")
    marked = F.regexp_replace("text", pieces.MARK, " ")
    return coded.select(
        "doc_id", F.size("ids").alias("n_pieces"), "ids", (F.col("decoded") == marked).alias("round_trip")
    )


def op9_nearest_neighbours(spark: SparkSession, sf: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf, "embeddings"), F.col("vec_id") % 20 == 0)


def op10_near_dups(spark: SparkSession, sf: str) -> DataFrame:
    return near_dups.near_duplicates(table(spark, sf, "documents"), near_dups.Shape(words=2))


def op11_language_model(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 10 == 0, F.lit(False))
    model = language_model.fit(docs.where(~out), order=2)
    scored = language_model.with_scores(docs, model)
    return scored.select(
        "doc_id", out.alias("held_out"), "lm.n_tokens", "lm.n_known",
        F.lit(model.tokens).cast("long").alias("train_tokens"), "lm.base_score", "lm.score",
    )


def op12_merkle_manifest(spark: SparkSession, sf: str) -> DataFrame:
    tampered = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0, F.lit(False))
    one_more = F.when(tampered, F.try_add("n_chars", F.lit(1))).otherwise(F.col("n_chars"))
    proofs = merkle.manifest(table(spark, sf, "documents"), claimed={"n_chars": one_more})
    return proofs.select(
        "doc_id", "leaf", "subroot", "root", F.sha2("siblings", 256).alias("proof_sha256"),
        "folded_root", "verified",
    )


def op13_centroid_clustering(spark: SparkSession, sf: str) -> DataFrame:
    return centroids.cluster(table(spark, sf, "embeddings"))


QUERIES: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {
    "op1_packing": (op1_packing, None),
    "op2_toxicity": (op2_toxicity, None),
    "op3_token_counts": (op3_token_counts, None),
    "op4_license_scans": (op4_license_scans, None),
    "op5_quality_classifier": (op5_quality_classifier, None),
    "op6_quality_rules": (op6_quality_rules, oracles.quality_rules()),
    "op7_url_filters": (op7_url_filters, None),
    "op8_sentencepiece": (op8_sentencepiece, None),
    "op9_nearest_neighbours": (op9_nearest_neighbours, None),
    "op10_near_dups": (op10_near_dups, oracles.near_dups()),
    "op11_language_model": (op11_language_model, None),
    "op12_merkle_manifest": (op12_merkle_manifest, oracles.merkle_manifest()),
    "op13_centroid_clustering": (op13_centroid_clustering, oracles.centroid_clustering()),
}


def register(query: Callable) -> None:
    for name, (run, sql) in QUERIES.items():
        query(name, sql)(run)
