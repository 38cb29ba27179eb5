import pytest

from callsift.operators import catalog as cat
from callsift.plans import jobs
from callsift.sources.rules import overrides_table

CLUSTERS = "cluster_id int, size long, top_terms array<string>, examples array<string>"


@pytest.fixture(scope="module")
def catalog(spark):
    rows = [
        (1, 10, ["lost", "card"], [f"example {i} [DATE]" for i in range(20)]),
        (2, 30, ["hello", "there"], []),
        (3, 20, ["fee"], [" ", "why a fee | charge"]),
        (4, 5, [], ["x"]),
    ]
    clusters = spark.createDataFrame(rows, CLUSTERS)
    overrides = [
        {"cluster_id": 2, "intent_id": "Small Talk!", "suggested_intent": "__noise", "answerable": False},
        {"cluster_id": 3, "intent_id": "", "answerable": False, "handoff_reason": "first"},
        {"cluster_id": 3, "suggested_intent": "fees", "handoff_reason": ""},
        {"cluster_id": 99, "answerable": False},
    ]
    return jobs.curate_catalog(clusters, cat.suggest_names(clusters), overrides_table(spark, overrides))


def test_overrides(catalog):
    rows = catalog.collect()
    assert [r.cluster_id for r in rows] == [2, 3, 1, 4]
    got = {r.cluster_id: (r.intent_id, r.intent_name, r.answerable, r.handoff_reason) for r in rows}
    assert got == {
        1: ("card_lost_or_stolen__c1", "card_lost_or_stolen", True, ""),
        2: ("small_talk", "__noise", False, ""),
        3: ("fees_or_overdraft__c3", "fees", True, ""),  # the last entry wins as a whole
        4: ("misc__c4", "misc", True, ""),
    }
    assert len(rows[2].examples) == 15 and rows[1].examples == ["why a fee | charge"]


def test_missing_suggestion_is_an_error(spark):
    clusters = spark.createDataFrame([(1, 1, ["a"], ["b"])], CLUSTERS)
    none = spark.createDataFrame([], "cluster_id int, suggested_intent string")
    with pytest.raises(Exception, match="no suggestion for cluster 1"):
        cat.join_suggestions(clusters, none).count()


def test_scaffold_and_checks(catalog):
    gold, handoff = jobs.gold_scaffold(catalog)
    assert gold.where("cluster_id = 1").count() == 3
    assert [r.sample_question for r in handoff.collect()] == [""]
    checks = {r.check: (r.ok, r.bad_rows) for r in jobs.validate_catalog(catalog, gold, handoff).collect()}
    assert all(ok for ok, _ in checks.values())
    wrong = jobs.validate_catalog(catalog, gold.drop("source_refs"), handoff.unionByName(
        handoff.withColumn("intent_id", cat.F.lit("fees_or_overdraft__c3"))))
    bad = {r.check: r.bad_rows for r in wrong.collect() if not r.ok}
    assert bad == {"gold_columns": 1, "handoff_ids_not_answerable": 1}
    counts = cat.catalog_counts(catalog).first()
    assert (counts.entries, counts.answerable_ids, counts.handoff_ids) == (4, 3, 1)


def test_exports(catalog):
    out = jobs.export_training(catalog)
    first = out["utterances"].where("cluster_id = 1 AND pos = 0").first()
    assert first.utterance == "example 0 {date}"
    packs = {r.cluster_id: r.samples for r in out["pack"].collect()}
    assert packs[4] == ["x"] and len(packs[1]) == 15 and 2 not in packs
    assert [(r.intent_id, r.reason) for r in out["handoff"].collect()] == [("small_talk", "")]
