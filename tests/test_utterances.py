"""Balancing and top-up against plain loops."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from callsift.operators import utterances as ut
from callsift.plans import jobs


def loop_mix(base, seeds, top=150, low=50, quota=45):
    """base, seeds: lists of (intent, text) in order; returns intent -> kept texts in order."""
    kept = defaultdict(list)
    for intent, u in base:
        if u not in kept[intent]:
            kept[intent].append(u)
    by_intent = defaultdict(list)
    for intent, u in seeds:
        by_intent[intent].append(u)
    for intent, us in by_intent.items():
        have = kept[intent]
        room = top - len(have)
        if room <= 0:
            continue
        asked, said = [u for u in us if u.endswith("?")], [u for u in us if not u.endswith("?")]
        missing = quota - sum(u.endswith("?") for u in have)
        take = asked[: max(0, min(len(asked), missing))]
        take += said[: max(0, room - len(take))]
        for u in take:
            if u not in have:
                have.append(u)
    out = {}
    for intent, have in kept.items():
        final = have[:top]
        if len(final) < low:
            spare = [u for u in by_intent[intent] if u not in final]
            final = final + spare[: low - len(final)]
        if final:
            out[intent] = final
    return out


def make_cases():
    rng = random.Random(11)
    base, seeds = [], []
    # intent: base statements, base questions, seed statements, seed questions, overlap
    shapes = {
        "plain": (20, 5, 300, 100, 10),
        "full": (150, 20, 50, 50, 5),
        "over": (180, 30, 40, 40, 0),
        "few_statements": (3, 0, 10, 200, 2),
        "floor": (2, 1, 5, 60, 1),
        "no_base": (0, 0, 400, 5, 0),
        "no_seeds": (12, 3, 0, 0, 0),
        "questions_full": (10, 60, 200, 200, 20),
        "edge": (149, 0, 10, 60, 3),
    }
    for intent, (bs, bq, ss, sq, overlap) in shapes.items():
        b = [f"{intent} base {i}" for i in range(bs)] + [f"{intent} base q {i}?" for i in range(bq)]
        s = [f"{intent} seed {i}" for i in range(ss)] + [f"{intent} seed q {i}?" for i in range(sq)]
        s += b[:overlap]
        rng.shuffle(b)
        rng.shuffle(s)
        base += [(intent, u) for u in b]
        seeds += [(intent, u) for u in s]
    return base, seeds


def test_quota_mix_equals_a_loop(spark):
    base, seeds = make_cases()
    b = spark.createDataFrame([(i, u, n) for n, (i, u) in enumerate(base)], "intent_id string, utterance string, row long")
    s = spark.createDataFrame([(i, u, n) for n, (i, u) in enumerate(seeds)], "intent_id string, utterance string, row long")
    got = defaultdict(list)
    for r in ut.quota_mix(b.repartition(5), s.repartition(5)).orderBy("intent_id", "rank").collect():
        got[r.intent_id].append(r.utterance)
    assert dict(got) == loop_mix(base, seeds)


def test_merge_names_and_strict_rules(spark):
    base = spark.createDataFrame(
        [("close_account", "Old", "I moved", 0), ("close_account", "New", "I moved too", 1)],
        "intent_id string, intent_name string, utterance string, row long",
    )
    seeds = spark.createDataFrame(
        [("close_account", "close the account [DATE]", 0), ("close_account", "CLOSE the account {date}", 1),
         ("close_account", "close it", 2), ("close_account", "please stop this now", 3),
         ("unknown", "any three words", 4), ("", "any three words", 5), (None, "any three words", 6)],
        "intent_id string, utterance string, row long",
    )
    got = {(r.intent_id, r.intent_name, r.utterance) for r in jobs.merge_seeds(base, seeds).collect()}
    assert got == {
        ("close_account", "New", "I moved"), ("close_account", "New", "I moved too"),
        ("close_account", "New", "close the account {date}"), ("unknown", "unknown", "any three words"),
    }


def loop_topup(base, sentences, patterns, targets, top=150):
    import re

    counts = defaultdict(int)
    for i, _, _ in base:
        counts[i] += 1
    need = {i: t - counts[i] for i, t in targets.items() if counts[i] < t}
    seen = defaultdict(set)
    for i, _, u in base:
        seen[i].add(u.strip().lower())
    adds = []
    for u in sentences:
        for i in need:
            low = u.lower()
            if need[i] > 0 and re.search(patterns[i], u, re.I) and low not in seen[i] and not low.startswith("let me "):
                adds.append((i, i, u))
                seen[i].add(low)
                need[i] -= 1
    if not adds:
        return list(base)
    out, keys, size = [], set(), defaultdict(int)
    for i, n, u in [*base, *adds]:
        key = (i, u.lower().strip())
        if key not in keys and size[i] < top:
            out.append((i, n, u))
            size[i] += 1
        keys.add(key)
    return out


@pytest.mark.parametrize("fill", [3, 60])
def test_top_up_equals_a_loop(spark, fill):
    rng = random.Random(5)
    patterns = {"a": r"\balpha\b", "b": r"\b(beta|alpha)\b", "c": r"\bgamma\b"}
    targets = {"a": 10, "b": 25, "c": 5}
    words = ["alpha", "Alpha", "beta", "gamma", "delta", "let me"]
    sentences = [f"{rng.choice(words)} {rng.choice(words)} {rng.randint(0, 25)}" for _ in range(300)]
    base = [("a", "A", f"alpha base {i}") for i in range(min(fill, 6))]
    base += [("b", "B", f"beta base {i}") for i in range(fill)] + [("b", "B", "BETA base 0"), ("d", "D", "other")]
    base += [("c", "C", f"gamma {i}") for i in range(fill)]
    b = spark.createDataFrame([(*r, n) for n, r in enumerate(base)], "intent_id string, intent_name string, utterance string, row long")
    calls = spark.createDataFrame([(f"z{n // 100}", n, 0, s) for n, s in enumerate(sentences)], "source_zip string, ord long, pos long, utterance string")
    got = jobs.top_up(b, calls.repartition(6), list(patterns.items()), targets, agent_openings=["let me "],
                      sentences_of=lambda c: c)
    want = loop_topup(base, sentences, patterns, targets)
    assert sorted(tuple(r) for r in got.select("intent_id", "intent_name", "utterance").collect()) == sorted(want)
    order = [r.utterance for r in got.where("intent_id = 'b'").orderBy("row").collect()]
    assert order == [u for i, _, u in want if i == "b"]


def test_top_up_with_nothing_to_do_keeps_the_base(spark):
    base = spark.createDataFrame([("a", "A", "same", 0), ("a", "A", "SAME", 1)], "intent_id string, intent_name string, utterance string, row long")
    calls = spark.createDataFrame([("z", 0, 0, "alpha one")], "source_zip string, ord long, pos long, utterance string")
    got = jobs.top_up(base, calls, [("a", r"\balpha\b")], {"a": 2}, sentences_of=lambda c: c)
    assert [r.utterance for r in got.orderBy("row").collect()] == ["same", "SAME"]


def test_whitelist_cap_and_minimum(spark):
    rows = [("keep", f"u {i}", i) for i in range(160)] + [("few", f"x {i}", i) for i in range(49)]
    rows += [("keep", "U 0", 999), ("drop", "y", 1)]
    df = spark.createDataFrame(rows, "intent_id string, utterance string, row long")
    out = jobs.enforce_whitelist(df, ["row"], ["keep", "few"])
    counts = {r.intent_id: r["count"] for r in out["utterances"].groupBy("intent_id").count().collect()}
    assert counts == {"keep": 150, "few": 49}
    assert [r.intent_id for r in out["below_minimum"].collect()] == ["few"]
    splits = out["splits"].collect()
    assert len(splits) == 199 and sum(r.split == "dev" for r in splits) == 40
    report = jobs.quality_report(out["splits"])
    assert report["leakage"].count() == 0


def test_planted_leak_is_found(spark):
    rows = [("a", "One more ", "train"), ("a", "one more", "dev"), ("b", "one more", "dev")]
    df = spark.createDataFrame(rows, "intent_id string, utterance string, split string")
    assert [r.key for r in jobs.quality_report(df)["leakage"].collect()] == ["a||one more"]


def test_pack_holds_all_rows_of_an_intent(spark):
    rows = [("a", "A" if i == 0 else "B", f"u{i}", i) for i in range(400)][::-1]
    df = spark.createDataFrame(rows, "intent_id string, intent_name string, utterance string, row long")
    got = ut.pack(df, ["row"]).first()
    assert got.name == "A" and got.samples == [f"u{i}" for i in range(400)]


def test_candidates_prefer_customer_text(spark):
    full = " ".join(f"My line number {'x' * (i % 9)} {i}." for i in range(30)) + " Nothing here."
    rows = [("z", 0, None, full), ("z", 1, "Short one. I pay.", full), ("z", 2, " ", "Hello there. Is it open?")]
    df = spark.createDataFrame(rows, "source_zip string, ord long, customer_text string, full_text string")
    got = defaultdict(list)
    for r in ut.candidate_sentences(df).orderBy("ord", "pos").collect():
        got[r.ord].append(r.utterance)
    lines = [f"My line number {'x' * (i % 9)} {i}." for i in range(30)]
    assert got[0] == sorted(lines, key=len)[:20]
    assert got[1] == ["Short one.", "I pay."]
    assert got[2] == ["Is it open?"]
    assert ut.dedup_corpus(ut.candidate_sentences(df)).where(F.col("utterance") == "I pay.").count() == 0


@pytest.mark.parametrize("bounded", [True, False])
def test_not_in_base_with_hot_copies(spark, bounded):
    rows = [("a", "Same line" if n % 3 else f"line {n}", n) for n in range(300)] + [("b", "same line", 999)]
    df = spark.createDataFrame(rows, "intent_id string, utterance string, row long").repartition(8)
    base = spark.createDataFrame([("a", " same LINE"), ("a", "line 3"), ("a", "LINE 3")], "intent_id string, utterance string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = ut.not_in_base(df, base, base_is_bounded=bounded)
        assert got.columns == df.columns
        want = {n for i, u, n in rows if (i, u.lower()) not in {("a", "same line"), ("a", "line 3")}}
        kept = [r.row for r in got.collect()]
        assert len(kept) == len(want) and set(kept) == want
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_whitelist_outputs_read_the_kept_rows_once_written(spark):
    rows = [("z", k, 0, "ab"[k % 2], f"utterance number {k // 2}") for k in range(60)]
    df = spark.createDataFrame(rows, "source_zip string, ord long, pos long, intent_id string, utterance string")
    out = jobs.enforce_whitelist(df, ("source_zip", "ord", "pos"), ("a", "b"), max_rows=20, min_rows=25)
    assert sorted(r["ord"] for r in out["utterances"].collect()) == list(range(40))
    assert {tuple(r) for r in out["below_minimum"].collect()} == {("a", 20), ("b", 20)}
    for part in out.values():  # neither the source nor its de-duplication stands in a later plan
        plan = part._jdf.queryExecution().optimizedPlan().toString()
        assert "LogicalRDD" not in plan and "_key" not in plan, plan


def test_labels_of_the_checks_are_computed_once(spark):
    from checks import views

    plan = views.utterances(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    filters = [line for line in plan.splitlines() if line.strip(" +-:").startswith("Filter")]
    assert filters and not any("RLIKE" in line for line in filters)
