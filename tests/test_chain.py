"""All stages one after the other, each reading the files that the one before wrote."""

import json
import random
import zipfile

from pyspark.sql import functions as F

from callsift.plans import jobs
from callsift.sources import sinks, tables
from callsift.sources.rules import overrides_table

TOPICS = {
    "my card was lost or stolen": "card",
    "i want a wire transfer with zelle": "wire",
    "what is the mortgage rate of my loan": "loan",
    "how do i update my address and email": "profile",
    "is there a branch near me in [LOCATION]": "branch",
}


def archives(folder):
    rng = random.Random(3)
    for z in range(3):
        with zipfile.ZipFile(folder / f"part{z}.zip", "w", zipfile.ZIP_DEFLATED) as out:
            for i in range(60):
                said = rng.choice(list(TOPICS))
                turns = [
                    {"speaker": "customer", "text": f"{said} number {z * 60 + i}, please help me now?"},
                    {"speaker": "agent", "text": "let me look at your bank account."},
                    {"speaker": "customer", "text": f"i need my bank account for {said} today."},
                ]
                out.writestr(f"{i}.json", json.dumps({"domain": "Banking", "turns": turns}))
            out.writestr("bad.json", "{")


def test_stages_chain_through_files(spark, tmp_path):
    (tmp_path / "in").mkdir()
    archives(tmp_path / "in")
    at = lambda name: str(tmp_path / name)

    parsed = jobs.parse_archives(spark, at("in/*.zip"))
    assert parsed.counts == {"checked": 183, "good": 180, "rejected": 3} and parsed.rejects.count() == 3
    out = jobs.build_subset_outputs(parsed.rows)
    sinks.write_parquet(out["calls"], at("calls"))
    assert out["counters"].first().asDict() == {"checked": 180, "matched": 180, "kept": 180}

    calls = tables.read_parquet(spark, at("calls"))
    assert jobs.eda_report(calls)["top_terms"].count() > 10
    sinks.write_parquet(jobs.refine_subset(calls), at("refined"))

    refined = tables.read_parquet(spark, at("refined"))
    found = jobs.discover_intents(refined, k_min=4, k_max=5, n_init=2, max_iter=20, max_df=0.9)
    for name in ("clusters", "suggestions"):
        sinks.write_parquet(found[name], at(name))
    overrides = overrides_table(spark, [{"cluster_id": c, "answerable": c > 0} for c in range(5)])
    clusters, suggestions = (tables.read_parquet(spark, at(n)) for n in ("clusters", "suggestions"))
    sinks.write_jsonl(jobs.curate_catalog(clusters, suggestions, overrides), at("catalog"))

    catalog = tables.read_jsonl(spark, at("catalog"), tables.CATALOG_SCHEMA)
    gold, handoff = jobs.gold_scaffold(catalog)
    sinks.write_csv(gold, at("gold"))
    entries = [d.select("cluster_id").distinct().count() for d in (gold, handoff, catalog)]
    assert entries[0] + entries[1] == entries[2]
    assert jobs.validate_catalog(catalog, tables.read_csv(spark, at("gold"), tables.GOLD_SCHEMA), handoff)
    training = jobs.export_training(catalog)
    sinks.write_csv(training["utterances"].coalesce(1), at("training"))
    sinks.write_pack(training["pack"], at("pack"))

    sinks.write_jsonl(jobs.harvest_seeds(refined), at("seeds"))
    seeds = tables.read_jsonl(
        spark, at("seeds"), "source_zip string, ord long, pos long, intent_id string, utterance string"
    )
    base = tables.with_row(tables.read_csv(spark, at("training"), tables.UTTERANCE_SCHEMA))
    assert base.agg(F.min("row"), F.max("row")).first() == (0, base.count() - 1)
    sinks.write_parquet(jobs.merge_seeds(base, seeds), at("merged"))

    merged = tables.read_parquet(spark, at("merged"))  # ordered by its rank
    sinks.write_parquet(jobs.top_up(merged, refined), at("topped"))
    topped = tables.read_parquet(spark, at("topped"))
    before = {r.intent_id: r["count"] for r in merged.groupBy("intent_id").count().collect()}
    after = {r.intent_id: r["count"] for r in topped.groupBy("intent_id").count().collect()}
    assert after["profile_or_contact_update"] >= 20 > before.get("profile_or_contact_update", 0)
    assert all(after[i] >= n for i, n in before.items())

    sinks.write_pack_parts(
        tables.read_parquet(spark, at("topped")).transform(lambda d: jobs.utt.pack_parts(d, ["row"], 10)), at("packs")
    )
    manifest = tables.read_jsonl(spark, at("packs/manifest"), "intent_id string, parts long, samples long")
    assert {r.intent_id: r.samples for r in manifest.collect()} == after

    sets = jobs.enforce_whitelist(topped, min_rows=5)
    for name in ("utterances", "splits"):
        sinks.write_parquet(sets[name], at(name))
    splits = tables.read_parquet(spark, at("splits"))
    assert {r.split for r in splits.select("split").distinct().collect()} == {"train", "dev"}
    assert splits.count() == tables.read_parquet(spark, at("utterances")).count()
    assert jobs.quality_report(splits)["leakage"].count() == 0
    report = {r["class"]: r for r in jobs.baseline_classifier(splits, max_iter=30)["report"].collect()}
    assert report["accuracy"].f1 > 0.7
