"""Term weights, silhouette, clustering, classifier and report numbers against brute force."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from callsift.operators import clusters as clu
from callsift.operators import reports as rep
from callsift.operators import terms as ops
from callsift.operators.classify import train_intent_classifier
from callsift.operators.held import Held, Search
from callsift.plans import jobs

WORDS = "card lost balance wire fee loan login password open close the a my account atm pin".split()


def corpus(n=120, seed=1):
    rng = random.Random(seed)
    return [" ".join(rng.choice(WORDS) for _ in range(rng.randint(1, 9))) for _ in range(n)]


def brute_terms(t, stops):
    toks = [w for w in re.findall(r"\w\w+", t.lower()) if w not in stops]
    return toks + [f"{a} {b}" for a, b in zip(toks, toks[1:])]


def test_term_stats_and_tfidf(spark):
    docs = corpus()
    df = spark.createDataFrame(list(enumerate(docs)), "id long, text string").repartition(5)
    stops = ("the", "my")
    bags = [Counter(brute_terms(t, stops)) for t in docs]
    cf, dfq = Counter(), Counter()
    for b in bags:
        cf.update(b)
        dfq.update(b.keys())
    got = {r.term: (r.cf, r.df) for r in ops.term_stats(ops.with_terms(df, "text", stops)).collect()}
    assert got == {t: (cf[t], dfq[t]) for t in cf}

    vocab = [t for t in cf if dfq[t] >= 3 and dfq[t] <= 0.5 * len(docs)]
    vocab = sorted(vocab, key=lambda t: (-cf[t], t))[:40]
    model = ops.fit_tfidf(df, "text", stops, 3, 0.5, 40)
    assert sorted(model.vocab) == sorted(vocab)
    long = ops.weights_long(model.transform(df), model, ["id"]).collect()
    weights = {(r.id, r.term): r.weight for r in long}
    want = {}
    for i, b in enumerate(bags):
        row = {t: n * (math.log((1 + len(docs)) / (1 + dfq[t])) + 1) for t, n in b.items() if t in vocab}
        norm = math.sqrt(sum(w * w for w in row.values()))
        want.update({(i, t): w / norm for t, w in row.items()})
    assert weights.keys() == want.keys()
    assert all(abs(weights[k] - want[k]) < 1e-12 for k in want)


@pytest.mark.parametrize("n", [1, 7, 40, 1500, 5000, 9000])
def test_most_frequent_cuts_ties_by_term(spark, n):
    rng = np.random.default_rng(4)
    counts = {f"{rng.choice(['a', 'bb', 'same prefix '])}{k}": int(rng.integers(1, 6)) for k in range(8000)}
    stats = spark.createDataFrame(list(counts.items()), "term string, cf long").repartition(5)
    want = sorted(counts, key=lambda t: (-counts[t], t))[:n]
    assert sorted(r.term for r in ops.most_frequent(stats, n).collect()) == sorted(want)


def test_tfidf_refuses_an_empty_vocabulary(spark):
    df = spark.createDataFrame([(0, "one two three")], "id long, text string")
    with pytest.raises(ValueError, match="empty vocabulary"):
        ops.fit_tfidf(df, "text", min_df=2)


@pytest.mark.parametrize("sparse", [True, False])
def test_silhouette(spark, sparse):
    rng = np.random.default_rng(2)
    points = rng.random((60, 6)) * (rng.random((60, 6)) < 0.6)
    labels = [int(x) for x in rng.integers(0, 3, 59)] + [7]
    make = (lambda p: Vectors.sparse(6, [(int(i), float(p[i])) for i in np.nonzero(p)[0]])) if sparse else (
        lambda p: Vectors.dense(p.tolist()))
    df = spark.createDataFrame([(i, labels[i], make(p)) for i, p in enumerate(points)], ["id", "cluster_id", "features"])
    got = {r.id: r.silhouette for r in clu.silhouette(df, ["id"]).collect()}
    dist = np.sqrt(((points[:, None] - points[None]) ** 2).sum(-1))
    for i in range(60):
        same = [j for j in range(60) if labels[j] == labels[i] and j != i]
        if not same:
            assert got[i] == 0
            continue
        a = dist[i, same].mean()
        b = min(dist[i, [j for j in range(60) if labels[j] == c]].mean() for c in set(labels) - {labels[i]})
        assert abs(got[i] - (b - a) / max(a, b)) < 1e-6


def test_discovery_finds_planted_groups(spark):
    rng = random.Random(4)
    topics = [["card", "lost", "stolen"], ["wire", "transfer", "zelle"], ["loan", "mortgage", "rate"]]
    rows = []
    for n in range(150):
        t = topics[n % 3]
        rows.append(("z", n, f"my {' '.join(rng.choice(t) for _ in range(4))} number {n}.", None))
    df = spark.createDataFrame(rows, "source_zip string, ord long, customer_text string, full_text string")
    out = jobs.discover_intents(df, k_min=2, k_max=4, n_init=2, max_iter=5, max_df=0.9)
    assert out["choice"].first().k in (3, 4)
    clusters = out["clusters"].collect()
    assert sum(r["size"] for r in clusters) == 150
    assert all(len(r.examples) <= 10 and len(r.top_terms) <= 12 for r in clusters)
    names = {r.suggested_intent for r in out["suggestions"].collect()}
    assert {"card_lost_or_stolen", "money_transfer_wire_ach_zelle", "loan_or_mortgage_info"} <= names
    assert jobs.discover_intents(df.limit(10), k_min=2, k_max=2) is None


def test_classifier_beats_the_majority(spark):
    rng = random.Random(9)
    topics = {"card": ["card", "lost", "stolen"], "wire": ["wire", "transfer", "zelle"], "loan": ["loan", "rate"]}
    rows = []
    for n in range(180):
        intent = list(topics)[n % 3]
        words = [rng.choice(topics[intent]) for _ in range(3)] + [rng.choice(["my", "please", "now", "today"])]
        rows.append((intent, " ".join(words), "dev" if n % 5 == 0 else "train"))
    df = spark.createDataFrame(rows, "intent_id string, utterance string, split string")
    out = jobs.baseline_classifier(df, max_iter=10)
    assert out["predictions"].columns == [*df.columns, "prediction"]
    report = {r["class"]: r for r in out["report"].collect()}
    assert report["accuracy"].f1 > 0.9 and report["accuracy"].support == 36
    assert train_intent_classifier(df, max_iter=2).labels.labels == ["card", "loan", "wire"]


def test_classification_report(spark):
    pairs = [("a", "a")] * 5 + [("a", "b")] * 2 + [("b", "b")] * 3 + [("c", "a")] + [("b", "never_true")]
    df = spark.createDataFrame(pairs, "label string, prediction string")
    got = {r["class"]: r for r in rep.classification_report(df).collect()}
    assert (got["a"].precision, got["a"].recall, got["a"].support) == (round(5 / 6, 3), round(5 / 7, 3), 7)
    assert (got["c"].precision, got["c"].recall, got["c"].f1) == (0, 0, 0)
    assert (got["never_true"].support, got["never_true"].precision) == (0, 0)
    assert got["accuracy"].f1 == round(8 / 12, 4)
    assert got["macro avg"].recall == round((5 / 7 + 3 / 4) / 4, 3)


def test_statistics(spark):
    rng = random.Random(6)
    values = [rng.randint(0, 30) for _ in range(501)]
    texts = [None if n % 7 == 0 else "x" * v for n, v in enumerate(values)]
    df = spark.createDataFrame(list(zip(values, texts)), "v int, t string")
    d = rep.describe(df, ["v"]).first()
    assert (d["count"], d.min, d.max) == (501, min(values), max(values))
    assert abs(d["std"] - np.std(values, ddof=1)) < 1e-9
    assert (d.p25, d.p50, d.p75) == tuple(np.percentile(values, [25, 50, 75]))
    ls = rep.length_stats(df, {"t": F.col("t")}).first()
    lengths = [len(t or "") for t in texts]
    assert (ls.median, ls.p90) == tuple(np.percentile(lengths, [50, 90]))
    audit = rep.placeholder_audit(spark.createDataFrame([("a [X] {date}",), ("{DATE}",), ("[]",)], "utterance string")).first()
    assert (audit.square_left, audit.slots_found) == (1, 2)


@pytest.mark.parametrize("full", [True, False])
def test_a_pass_sums_every_start_afresh_or_by_changes(spark, full, monkeypatch):
    monkeypatch.setattr(clu, "PIECE", 16)  # several pieces
    rng = np.random.default_rng(6)
    points = rng.normal(size=(700, 5)) * (1 if full else rng.random((700, 5)) < 0.4)
    make = (lambda p: Vectors.dense(p.tolist())) if full else (lambda p: Vectors.sparse(5, list(enumerate(p.tolist()))))
    blocks = clu.packed(spark.createDataFrame([(make(p),) for p in points], ["features"]))
    starts = [clu.Start(k, points[rng.integers(0, 700, k)].copy()) for k in (2, 3, 3)]
    for _ in range(3):
        centres = [s.centres for s in starts]
        clu._pass(blocks, starts, afresh=full)
        for s, c in zip(starts, centres, strict=True):
            gaps = ((points[:, None] - c) ** 2).sum(-1)
            own = gaps.argmin(axis=1)
            assert np.allclose(s.sums, [points[own == j].sum(axis=0) for j in range(len(c))])
            assert s.counts.tolist() == np.bincount(own, minlength=len(c)).tolist()
            assert abs(s.cost - gaps.min(axis=1).sum()) < 1e-6
            s.step(0.0, False)


def test_starts_share_passes_and_end_one_by_one(spark, monkeypatch):
    rng = np.random.default_rng(11)
    points = rng.normal(size=(150, 6)) * (rng.random((150, 6)) < 0.45)
    df = spark.createDataFrame([(Vectors.sparse(6, [(i, v) for i, v in enumerate(p) if v]),) for p in points.tolist()], ["features"])
    monkeypatch.setattr(clu, "CENTRE_CELLS", 6 * 5)  # room for two starts
    seen = []
    whole = clu._pass

    def spied(blocks, starts, *rest):
        kept = whole(blocks, starts, *rest)
        seen.append(list(starts))
        for s in starts:
            gaps = ((points[:, None] - s.centres) ** 2).sum(-1)
            own = gaps.argmin(axis=1)
            assert s.counts.tolist() == np.bincount(own, minlength=s.k).tolist()
            assert np.allclose(s.sums, [points[own == j].sum(axis=0) for j in range(s.k)])
            assert abs(s.cost - gaps.min(axis=1).sum()) < 1e-6
        return kept

    monkeypatch.setattr(clu, "_pass", spied)
    found = clu.kmeans_all(df, [2, 3], n_init=2, seed=5)
    turns = [({id(s) for s in a}, {id(s) for s in b}) for a, b in zip(seen, seen[1:], strict=False)]
    assert any(a & b and b - a for a, b in turns)  # one came in while another went on
    for k, model in found.items():
        own = ((points[:, None] - model.centres) ** 2).sum(-1).argmin(axis=1)
        means = np.array([points[own == j].mean(axis=0) for j in range(k)])
        assert np.abs(means - model.centres).max() <= 1e-4


def lloyd(points, centres, tolerance, max_iter):
    """Rounds, centres, cost and labels of plain k-means."""
    for rounds in range(1, max_iter + 1):
        gaps = ((points[:, None] - centres) ** 2).sum(-1)
        own = gaps.argmin(axis=1)
        means = np.array([points[own == j].mean(axis=0) if (own == j).any() else c for j, c in enumerate(centres)])
        if rounds == max_iter or np.sqrt(((means - centres) ** 2).sum(axis=1)).max() <= tolerance:
            return rounds, centres, gaps.min(axis=1).sum(), own
        centres = means


@pytest.mark.parametrize("kind", ["sparse", "full", "mixed", "short", "signed"])
def test_bounded_rounds_are_plain_rounds(kind):
    rng = np.random.default_rng(8)
    points = rng.normal(size=(3000, 9)) if kind in ("full", "mixed", "signed") else rng.random((3000, 9))
    if kind != "full":
        points *= rng.random(points.shape) < 0.4
        points[:40] = 0  # rows of no entry
    if kind == "mixed":
        points[500:900] = rng.normal(size=(400, 9))
    if kind == "short":
        points = points.astype(np.float32).astype(np.float64)
    places = [np.flatnonzero(p) for p in points]
    entries = np.array([len(p) for p in places]), np.concatenate(places), np.concatenate([p[p != 0] for p in points])
    held = Held.of(*entries, 9)
    assert (held.val.dtype == np.float32) == (kind == "short") and len(held) == 3000
    assert len(held.full) == sum(len(p) == 9 for p in places)
    order = np.argsort([9 if len(p) == 9 else len(p) for p in places], kind="stable")  # of the held rows
    for k, max_iter in ((1, 50), (2, 50), (7, 50), (7, 6), (7, 1), (12, 300)):
        first = points[order][rng.choice(np.arange(100, 3000), k, replace=False)] + rng.normal(size=(k, 9)) * 0.01
        if k == 12:
            first[5] = 1e3  # a centre that no row is near
        rounds, centres, cost, own = lloyd(points[order], first, 1e-4, max_iter)
        found = Search(held, first).run(1e-4, max_iter)
        assert found.rounds == rounds
        assert np.allclose(found.centres, centres, atol=1e-9) and abs(found.cost - cost) < 1e-6 * cost
        assert found.own.tolist() == own.tolist()
        if rounds > 1:
            assert np.allclose(held.means(found.before, found.centres), centres, atol=1e-9)


def test_small_tables_are_searched_without_passes(spark, monkeypatch):
    rng = np.random.default_rng(21)
    points = rng.random((700, 8)) * (rng.random((700, 8)) < 0.5)
    df = spark.createDataFrame([(Vectors.sparse(8, [(i, v) for i, v in enumerate(p) if v]),) for p in points.tolist()], ["features"])
    with monkeypatch.context() as m:
        m.setattr(clu, "HELD_BYTES", 0)
        passed = clu.kmeans_all(df, [2, 5], n_init=3)
    monkeypatch.delattr(clu, "_pass")  # a pass a round is what took too long
    found = clu.kmeans_all(df, [2, 5], n_init=3)
    for k, model in found.items():
        assert abs(model.cost - passed[k].cost) < 1e-6
        assert np.allclose(model.centres, passed[k].centres, atol=1e-6)
        gaps = ((points[:, None] - model.centres) ** 2).sum(-1)
        assert abs(gaps.min(axis=1).sum() - model.cost) < 1e-6
        means = [points[gaps.argmin(axis=1) == j].mean(axis=0) for j in range(k)]
        assert np.abs(np.array(means) - model.centres).max() <= 1e-4
    few = clu.kmeans_all(df.limit(3), [5], n_init=1)[5]
    assert few.getK() == 3 and few.cost < 1e-9


def test_full_rows_are_scored_without_passes(spark, monkeypatch):
    monkeypatch.delattr(clu, "_pass")
    rng = np.random.default_rng(33)
    middle = rng.normal(size=(4, 6)) * 5
    points = middle[rng.integers(0, 4, 600)] + rng.normal(size=(600, 6))
    df = spark.createDataFrame([(i, Vectors.dense(p)) for i, p in enumerate(points.tolist())], ["id", "features"])
    found = clu.choose_k(df, ["id"], k_min=2, k_max=6, n_init=3)
    assert found.k == 4 and list(found.scores) == [2, 3, 4, 5, 6]
    for model in found.models.values():
        gaps = ((points[:, None] - model.centres) ** 2).sum(-1)
        means = [points[gaps.argmin(axis=1) == j].mean(axis=0) for j in range(model.getK())]
        assert np.abs(np.array(means) - model.centres).max() <= 1e-4
        assert abs(gaps.min(axis=1).sum() - model.cost) < 1e-6
