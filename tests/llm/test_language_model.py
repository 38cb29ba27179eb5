import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from callsift.llm import language_model as lm

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def tokens(text):
    return WORD.findall((text or "").translate(LOWER)) + ["</s>"]


class Brute:
    """The same model by plain dictionaries."""

    def __init__(self, texts, order):
        self.order, self.counts, self.discounts = order, [None] * (order + 1), [None] * (order + 1)
        every = [tokens(t) for t in texts]
        self.single = Counter(w for ws in every for w in ws)
        self.n, self.v = sum(self.single.values()), len(self.single)
        top = Counter()
        for ws in every:
            ws = ["<s>"] * (order - 1) + ws
            top.update(tuple(ws[i : i + order]) for i in range(len(ws) - order + 1))
        self.counts[order] = top
        for n in range(order - 1, 0, -1):
            self.counts[n] = Counter(g[1:] for g in self.counts[n + 1])
        self.after = [None] * (order + 1)
        for n in range(1, order + 1):
            of = Counter(self.counts[n].values())
            self.discounts[n] = lm.discounts([of[1], of[2], of[3], of[4]])
            self.after[n] = defaultdict(list)
            for g, c in self.counts[n].items():
                self.after[n][g[:-1]].append(c)

    def p(self, context, word, n=None):
        n = self.order if n is None else n
        if n == 0:
            return 1 / (self.v + 1)
        context = tuple(context[len(context) - n + 1 :]) if n > 1 else ()
        lower = self.p(context[1:], word, n - 1)
        follows = self.after[n].get(context)
        if not follows:
            return lower
        d = (0, *self.discounts[n])
        c = self.counts[n][(*context, word)]
        mass = sum(d[min(x, 3)] for x in follows)
        return (c - d[min(c, 3)] + mass * lower) / sum(follows)

    def scores(self, text):
        ws = tokens(text)
        whole = ["<s>"] * (self.order - 1) + ws
        score = sum(
            math.log10(self.p(whole[i : i + self.order - 1], w)) for i, w in enumerate(ws)
        )
        base = sum(math.log10((self.single[w] + 0.1) / (self.n + 0.1 * (self.v + 1))) for w in ws)
        return len(ws), sum(self.single[w] > 0 for w in ws), base, score


def texts_of(seed, n, words, longest=60):
    rng = np.random.default_rng(seed)
    names = [f"w{i}" for i in range(words)]
    odds = 1 / np.arange(1, words + 1)
    return [
        " ".join(rng.choice(names, rng.integers(0, longest), p=odds / odds.sum())) for _ in range(n)
    ]


TEXTS = [
    None, "", "   ", " A b\tC\nd\x0be ", "same words same words", "same words same words", "ÄÖ ä\xa0b x y",
    "\x1c \x1f", *texts_of(1, 150, 40),
]


def found(spark, learnt, asked, order):
    train = spark.createDataFrame([(t,) for t in learnt], "text string").repartition(3)
    model = lm.fit(train, order)
    docs = spark.createDataFrame(list(enumerate(asked)), "doc_id long, text string").withColumn("lm_", F.lit(1))
    rows = lm.with_scores(docs, model).orderBy("doc_id").collect()
    assert [r["lm_"] for r in rows] == [1] * len(asked)
    return model, [tuple(r["lm"]) for r in rows]


@pytest.mark.parametrize("order", [2, 3, 4])
def test_equals_plain_counting(spark, monkeypatch, order):
    monkeypatch.setattr(lm, "SHARD_ROWS", 200)  # some shards
    asked = TEXTS + texts_of(2, 40, 60)
    model, got = found(spark, TEXTS, asked, order)
    brute = Brute(TEXTS, order)
    assert (model.tokens, model.words) == (brute.n, brute.v)
    assert sum(model.grams[-1].sizes.values()) == len(brute.counts[order])
    for text, g in zip(asked, got, strict=True):
        want = brute.scores(text)
        assert g[:2] == want[:2], text
        assert g[2:] == pytest.approx(want[2:], rel=1e-9), text


def test_probabilities_sum_to_one():
    brute = Brute(TEXTS, 3)
    for context in (("<s>", "<s>"), ("w1", "w2"), ("nowhere", "w3"), ("a", "b")):
        total = sum(brute.p(context, w) for w in brute.single) + brute.p(context, "<unknown>")
        assert total == pytest.approx(1, rel=1e-9)


def test_nothing_learnt_and_nothing_asked(spark):
    model, got = found(spark, [], ["a b", None], 2)
    assert (model.tokens, model.words) == (0, 0)
    assert got == [(3, 0, 0.0, 0.0), (1, 0, 0.0, 0.0)]
    assert found(spark, ["a"], [], 2)[1] == []


def test_long_texts_are_parted_and_nothing_is_lost(spark, monkeypatch):
    text = " ".join(texts_of(3, 60, 80))
    brute = Brute([text, "w1 w2"], 3)
    here = lm.slices
    monkeypatch.setattr(lm, "SLICE", 500)
    pieces = [p for s in here(lm.pa.array([text, None, "x" * 2000 + " y"])) for p in s]
    assert "".join(p[1] for p in pieces if p[0] == 0) == text and len(pieces) > 5
    assert [p[1] for p in pieces if p[0] == 2] == ["x" * 2000, " y"]
    model, _ = found(spark, [text, "w1 w2"], [], 3)
    reader, total = lm.Reader(model.vocabulary, model.words, 3), 0.0
    for piece in here(lm.pa.array([text])):
        total += np.log10(lm.probabilities(model, reader.stream(piece)[0])).sum()
    assert total == pytest.approx(brute.scores(text)[3], rel=1e-9)


def test_tables_grow_with_the_texts(spark):
    few = lm.fit(spark.createDataFrame([(t,) for t in texts_of(4, 50, 300)], "text string"), 2)
    many = lm.fit(spark.createDataFrame([(t,) for t in texts_of(4, 400, 300)], "text string"), 2)
    assert sum(many.grams[1].sizes.values()) > 2 * sum(few.grams[1].sizes.values())


def test_learnt_texts_are_likelier_than_by_single_words(spark):
    learnt = ["the cat sat on the mat", "the dog sat on the rug"] * 20
    _, got = found(spark, learnt, ["the cat sat on the rug", "rug the on sat cat the"], 3)
    assert got[0][3] > got[0][2] and got[0][3] > got[1][3] + 2


def test_scramble_is_reversible():
    x = np.random.default_rng(0).integers(0, 1 << 63, 1000).astype(np.uint64) * np.uint64(2)
    assert (lm.unmix(lm.mix(x)) == x).all()
