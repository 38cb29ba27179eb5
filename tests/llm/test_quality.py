import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from callsift.llm import common, quality_net, quality_rules, toxicity
from callsift.llm.quality_rules import CLASSES, COMMON_WORDS

ODD = [
    None, "", "\n\n", " \t\r\x0b\x0c\n", "a b", "x\x85y\xa0z\x1c w", "a a a a a a a a a a a a a a a a a a a a a a a a",
    "#*$%&|<> ok\nok\n\nok\nno", "É é 日本 👍🏽\nÉ é 日本 👍🏽", "one two three four five six seven eight nine " * 3,
]


def base(text):
    text = text or ""
    words = [w for w in re.split("[\x20\x09-\x0d]+", text) if w]
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    uses = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if uses[w] > 1 for k in range(8)}
    lines = [x for x in text.split("\n") if re.search("[^\x20\x09-\x0d]", x)]
    repeat = len(covered)
    return (
        len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), repeat,
        len(words) < 20 or 100 * repeat > 30 * len(words),
    )


def test_base_counts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").limit(300)
    rows = [(-k, t, None, "mine") for k, t in enumerate(ODD, 1)] + [(-1, None, "xx", None)]
    docs = docs.select("doc_id", "text", "lang", F.lit("mine").alias("kept"))
    docs = docs.unionByName(spark.createDataFrame(rows, "doc_id long, text string, lang string, kept string"))
    want = Counter((r["doc_id"], *base(r["text"])) for r in docs.collect())
    got = quality_rules.judge(docs).collect()
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert Counter((r["doc_id"], *(r[n] for n in names)) for r in got) == want
    assert not any(r["kept"] for r in got if r["base_failed"])
    kept = {r["doc_id"] for r in quality_rules.keep(docs.drop("kept")).collect()}
    assert kept == {r["doc_id"] for r in got if r["kept"]}
    assert quality_rules.judge(docs.limit(0)).count() == 0


def test_verdict_keeps_prose_and_rejects_junk(spark):
    sf = "/root/testdata/sf0.01"
    judged = quality_rules.judge(spark.read.parquet(f"{sf}/documents.parquet"))
    rows = judged.join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("not base_failed").collect()
    good = [r["kept"] for r in rows if r["quality"] == 1]
    bad = [r["kept"] for r in rows if r["quality"] == 0]
    assert sum(good) >= 0.98 * len(good) and sum(bad) <= 0.35 * len(bad)


def test_js_distance():
    p, q = np.array([[3.0, 1.0], [0.0, 0.0], [0.0, 5.0]]), np.array([0.75, 0.25])
    got = quality_rules.js_distance(p, q)
    m = (np.array([0, 1]) + q) / 2
    far = np.sqrt((np.log2(1 / m[1]) + (q * np.log2(q / m)).sum()) / 2)
    assert got == pytest.approx([0, 0, far])
    assert len(CLASSES) == 8 and all(len(set(w)) == len(w) for w in COMMON_WORDS.values())


def areas(scores, labels):
    pairs = [(s > t) + 0.5 * (s == t) for s, y in zip(scores, labels, strict=True) if y for t, z in zip(scores, labels, strict=True) if not z]
    return sum(pairs) / len(pairs)


def test_convolution_is_the_sum_over_the_window():
    rng = np.random.default_rng(0)
    shape = quality_net.Shape(width=3, filters=2, half=4, block=8)
    net = quality_net.Net(shape, rng.normal(size=(3, 256, 2)), np.zeros(2), np.ones(2), 0.0, 1.0, 0.0)
    for n in (0, 1, 3, 7, 8, 9, 30):
        raw = bytes(rng.integers(0, 256, n).tolist())
        data = raw.ljust(3, b"\0")
        z = np.array([[sum(net.tables[k, data[i + k], f] for k in range(3)) for f in range(2)] for i in range(len(data) - 2)])
        cells = [z[i : i + 4].max(axis=0) for i in range(0, len(z), 4)]
        want = [np.maximum(a, b) for a, b in zip(cells, cells[1:], strict=False)] or cells
        assert net.chunk_maxima(raw) == pytest.approx(np.array(want))


def scored(spark, module, label, **options):
    sf = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    docs = spark.read.parquet(f"{sf}/documents.parquet").join(labels.select("doc_id"), "doc_id", "left_semi")
    model = module.fit(docs, labels, **options)
    apart = docs.join(labels, "doc_id").where(common.held_out("doc_id"))
    rows = module.with_score(apart.orderBy(F.xxhash64("doc_id")).limit(500), model).collect()
    assert all(zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2 for r in rows)
    return areas([r["score"] for r in rows], [r[label] for r in rows])


def test_quality_net_on_held_out_rows(spark):
    assert scored(spark, quality_net, "quality", per_class=400, epochs=4) > 0.95


def test_toxicity_on_held_out_rows(spark):
    assert scored(spark, toxicity, "toxic") > 0.75  # 329 toxic rows in four languages to learn from


@pytest.mark.parametrize("module, label", [(quality_net, "quality"), (toxicity, "toxic")])
def test_scores_of_odd_rows(spark, module, label):
    rng = random.Random(1)
    words = "the of and in that with was for on are".split()
    texts = [" ".join(rng.choices(words, k=60)) + (" $$$ %%% idiot" * 5 if k % 2 else "") for k in range(40)]
    docs = spark.createDataFrame([(k, t, 5) for k, t in enumerate(texts)], "doc_id long, text string, score int")
    labels = spark.createDataFrame([(k, k % 2) for k in range(40)] + [(None, 1), (3, None)], f"doc_id long, {label} int")
    model = module.fit(docs, labels)
    odd = [(k, t, 0) for k, t in enumerate([None, "", " ", "é" * 5000, "x y " * 30_000])] + [(None, "a b", 1), (None, "a b", 1)]
    rows = module.with_score(spark.createDataFrame(odd, "doc_id long, text string, score int"), model).collect()
    assert len(rows) == len(odd) and all(0 <= r["score"] <= 1 for r in rows)
    assert rows[0]["score"] == rows[1]["score"] and rows[-1]["score"] == rows[-2]["score"]
    assert module.with_score(docs.limit(0), model).count() == 0
    prior = module.fit(docs, labels.where(F.col(label) == 1))
    assert isinstance(prior, float) and 0.5 < prior < 1


@pytest.mark.parametrize("module, label", [(quality_net, "quality"), (toxicity, "toxic")])
def test_calibration_reads_whole_texts(spark, monkeypatch, module, label):
    rng = random.Random(2)
    words = "the of and in that with was for on are".split()
    texts = [" ".join(rng.choices(words, k=4000)) + (" $$$ %%% idiot" * 9 if k % 2 else "") for k in range(16)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(16)], f"doc_id long, {label} int")
    seen, fit = [], module.fit_logistic
    monkeypatch.setattr(module, "fit_logistic", lambda x, *a, **b: seen.append(x) or fit(x, *a, **b))
    model = module.fit(docs, labels)
    read = [k for k in range(16) if zlib.crc32(str(k).encode()) % 4 != 2]
    apart = read[::4] if len({k % 2 for k in read[::4]}) == 2 else read
    if module is quality_net:
        want = [[model.chunk_logits(common.utf8(texts[k])).mean()] for k in apart]
        assert seen[0] == pytest.approx(np.array(want), rel=1e-4)
    else:
        pair = model.compressors()
        want = np.array([toxicity.features(toxicity.gains_of(common.utf8(texts[k]), model.shape, pair)) for k in apart])
        assert seen[0] * model.spread + model.center == pytest.approx(want)


POLISH = "w i na z do nie się jest to że o jak po co tak za od ale czy ich przez tylko".split()
RARE = "dom miasto rzeka człowiek droga praca szkoła woda ziemia noc dzień chleb okno drzewo ogród pole".split()


def polish(seed, n=300):
    rng = random.Random(seed)
    return " ".join(rng.choice(POLISH if rng.random() < 0.45 else RARE) + rng.choice(["", "", "", ",", "."]) for _ in range(n))


def test_a_fifth_language_has_a_reference_of_its_own(spark):
    english = [
        " ".join(random.Random(k).choices("the of and to in a is that house garden river small old".split(), k=90))
        for k in range(60)
    ]
    junk = " ".join("".join(random.Random(9).choices("qxzvk", k=7)) + str(i) for i in range(120))
    rows = [(k, polish(k), "pl") for k in range(60)] + [(100 + k, t, "en") for k, t in enumerate(english)]
    rows += [(500, junk, "pl"), (501, None, "pl"), (502, "", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    kept = {r["doc_id"] for r in quality_rules.judge(docs).where("kept").collect()}
    assert kept == {r["doc_id"] for r in quality_rules.keep(docs).collect()}
    assert set(range(60)) <= kept and not {500, 501, 502} & kept
    words = quality_rules.stated_words(docs, COMMON_WORDS)
    assert set(words) == {"pl"} and len(words["pl"]) == 20
    few = docs.where("doc_id < 20 or doc_id >= 100")  # too few documents for a reference
    assert quality_rules.stated_words(few, COMMON_WORDS) == {}


def test_columns_of_the_rules_own_names_are_kept(spark):
    text = "the cat of the house was in that garden and it is on the roof with " * 3
    docs = spark.createDataFrame(
        [(1, text, "en", 7, 8, 9)], "doc_id long, text string, lang string, _d int, _p int, kept int"
    )
    row = quality_rules.judge(docs).first()
    assert (row["_d"], row["_p"], row["lang"]) == (7, 8, "en") and isinstance(row["kept"], bool)
