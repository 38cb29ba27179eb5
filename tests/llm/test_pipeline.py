from pyspark.sql import functions as F

import corpus_pipeline
from callsift.llm import near_dups, quality_net, quality_rules
from callsift.session import written

SF = "/root/testdata/sf0.001"


def test_stages_chain(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        left = written(stage(spark, docs, SF), name)
        assert left.columns == columns
        ids = {r["doc_id"] for r in left.select("doc_id").collect()}
        if name == "quality_rules":
            want = {r["doc_id"] for r in quality_rules.judge(docs).where("kept").collect()}
        elif name == "quality_classifier":
            model = quality_net.fit(docs, corpus_pipeline.labels_of(spark, docs, SF))
            rows = docs.select("doc_id", "text").collect()
            scores = {r["doc_id"]: model if isinstance(model, float) else model.probability(r["text"]) for r in rows}
            want = {i for i, score in scores.items() if score >= corpus_pipeline.MIN_QUALITY}
        else:
            found = near_dups.near_duplicates(docs).collect()
            want = {r["doc_id"] for r in found if r["kept"]}
            assert all(r["component_id"] in want for r in found)
        assert ids == want
        docs = left
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    whole = pieces.groupBy("doc_id").agg(F.sum("length").alias("n"), F.max("doc_tokens").alias("m")).collect()
    assert {r["doc_id"] for r in whole} == {r["doc_id"] for r in docs.select("doc_id").collect()}
    assert all(r["n"] == r["m"] for r in whole)


def test_repeated_and_null_rows(spark):
    text = "the cat of the house was in that garden and it is on the roof with " * 6 + "end"
    rows = [(1, text, "en", "s", 1), (1, text, "en", "s", 1), (2, text, None, None, None), (None, text, "en", "s", 1),
            (3, None, "en", "s", 1), (None, None, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    left = corpus_pipeline.apply_near_dups(spark, docs, SF)
    assert sorted((r["doc_id"] or 0) for r in left.collect()) == [0, 0, 1, 3]
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), SF).count() == 0


def test_stages_keep_clashing_columns(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    clashing = docs.withColumns({c: F.col("doc_id") for c in ("_score", "_d", "_p", "_t", "kept", "score")})
    for _, stage in corpus_pipeline.STAGES[:-1]:
        left = stage(spark, clashing, SF)
        assert left.columns == clashing.columns
        assert left.where("_score <> doc_id or _d <> doc_id or _p <> doc_id or kept <> doc_id").isEmpty()
