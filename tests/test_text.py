import random
import re

import pytest
from pyspark.sql import functions as F

from callsift.functions import lexicons as lex
from callsift.functions import rules, text

ALPHABET = ["I'll", "card", "lost", "Lost", "wire", "é", "çard", "card,", "[DATE]", "{location}", "in",
            "licensed", ".", "?", "!", "\n", "  ", "\t", "bill", "pay", "auto-pay", "pin_", "pin",
            "open", "a", "account", "address", "change", "my", " ", "x", "ACH", "naïve", "log-in"]


def random_texts(n=400, seed=7):
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        glue = rng.choice([" ", " ", "  ", ""])
        out.append(glue.join(rng.choice(ALPHABET) for _ in range(rng.randint(1, 14))))
    return out


@pytest.fixture(scope="module")
def texts(spark):
    rows = [(i, t) for i, t in enumerate(random_texts())]
    return rows, spark.createDataFrame(rows, "i int, t string").cache()


def column(df, expr):
    return [r[0] for r in df.orderBy("i").select(expr).collect()]


@pytest.mark.parametrize("table", ["SEED_RULES", "STRICT_RULES", "TOPUP_RULES"])
def test_rule_patterns_agree_with_plain_regex(texts, table):
    rows, df = texts
    rule_list = getattr(lex, table)
    got = column(df, F.array(*[text.matches("t", p) for _, p in rule_list]))
    guard = column(df, rules.matches_any("t", rule_list))
    for (_, t), flags, any_flag in zip(rows, got, guard):
        want = [bool(re.search(p, t, re.I)) for _, p in rule_list]
        assert flags == want, t
        assert any_flag == any(want), t


def test_whole_words_agree_with_plain_regex(texts):
    rows, df = texts
    for words in (lex.BUILD_KEYWORDS, lex.REFINE_NEGATIVE, lex.FIRST_PERSON, lex.CONFIG_KEYWORDS):
        pattern = re.compile(r"\b(" + "|".join(words) + r")\b", re.I)
        assert column(df, text.has_word("t", words)) == [bool(pattern.search(t)) for _, t in rows]


def test_seed_match_takes_the_first_rule(texts):
    rows, df = texts
    want = [next((n for n, p in lex.SEED_RULES if re.search(p, t, re.I)), None) for _, t in rows]
    assert column(df, rules.seed_match("t")) == want


def test_brace_then_boundary_needs_a_word_character(spark):
    df = spark.createDataFrame([(0, "in {location}."), (1, "in {location}x"), (2, "licensed in {location}")], "i int, t string")
    hits = column(df, rules.topup_match("t"))
    assert [len(h) for h in hits] == [0, 1, 1]


def test_agent_openings_match_nothing(spark):
    df = spark.createDataFrame([(0, "Let me check the branch"), (1, "Which branch")], "i int, t string")
    assert [len(h) for h in column(df, rules.topup_match("t"))] == [0, 1]


def test_sentences(texts):
    rows, df = texts
    for lo, hi in ((5, 400), (5, 20)):
        got = column(df, text.sentences("t", lo, hi))
        for (_, t), parts in zip(rows, got):
            want = [p.strip() for p in re.split(r"(?<=[.?!])\s+|\n+", t)]
            assert parts == [p for p in want if lo <= len(p) <= hi], t


def test_strip_drops_every_unicode_space(spark):
    samples = [" a b　", "\x1c\x85 x ", " ", "", "\nx\t", "​y"]
    df = spark.createDataFrame(list(enumerate(samples)), "i int, t string")
    assert column(df, text.strip("t")) == [s.strip() for s in samples]


def test_clean_text(spark):
    samples = ["a\r\n\r\n\r\nb", " x\t\xa0 y ", "a\n\n\n\nb\n", "\r", None]
    df = spark.createDataFrame(list(enumerate(samples)), "i int, t string")

    def want(s):
        s = re.sub(r"\n{3,}", "\n\n", s.replace("\r", "\n"))
        return re.sub(r"[ \t\xa0]+", " ", s).strip()

    assert column(df, text.clean_text("t")) == [None if s is None else want(s) for s in samples]


def test_normalize_slots(spark):
    samples = ["[Person_Name]  calls on [DATE]", "[ORGANIZATION] stays [person_age]", None, " [time][Money_Amount] "]
    df = spark.createDataFrame(list(enumerate(samples)), "i int, t string")
    assert column(df, text.normalize_slots("t")) == [
        "{person_name} calls on {date}", "[ORGANIZATION] stays [person_age]", "", "{time}{money_amount}",
    ]


def test_small_text_functions(spark):
    df = spark.createDataFrame(
        [(0, "", "b", " A  b! ", "x | y | "), (1, None, None, "___", " | "), (2, "a", "b", "Éa", "one")],
        "i int, a string, b string, s string, p string",
    )
    assert column(df, text.first_nonempty("a", "b")) == ["b", None, "a"]
    assert column(df, text.slugify("s")) == ["a_b", "misc", "a"]
    assert column(df, text.split_packed("p", " | ")) == [["x", "y"], [], ["one"]]
    assert column(df, text.intent_key("s", "i")) == ["a_b__c0", "misc__c1", "a__c2"]
    assert column(df, text.min_words("s", 2)) == [True, False, False]


def test_terms(spark):
    df = spark.createDataFrame([(0, "Don't the okay card a éa"), (1, "")], "i int, t string")
    assert column(df, text.tokens("t")) == [["don", "the", "okay", "card", "éa"], []]
    kept = text.remove_stops(text.tokens("t"), lex.DISCOVERY_STOPS)
    two = df.select("i", text.ngrams(kept).alias("x"))
    # stop words go first, so a bigram spans the gap
    assert column(two, F.col("x")) == [["card", "éa", "card éa"], []]


def test_stop_list_is_the_default_english_list(spark):
    from pyspark.ml.feature import StopWordsRemover

    assert set(StopWordsRemover.loadDefaultStopWords("english")) == set(lex.ENGLISH_STOPS)


def test_suggest_intent(spark):
    rows = [(0, ["block", "x"]), (1, ["fee", "charge"]), (2, ["got", "let just"]), (3, []), (4, ["one"]),
            (5, ["a", "b", "c", "d", "e", "lock"])]
    df = spark.createDataFrame(rows, "i int, t array<string>")
    assert column(df, rules.suggest_intent("t")) == [
        "card_lost_or_stolen", "card_charge_dispute_or_fraud", "got_let just", "misc", "one", "a_b",
    ]


def test_speaker_class(spark):
    names = ["Customer", "customer support", "Prepaid rep", "assistant", "", None, " AGENT ", "repatient"]
    df = spark.createDataFrame(list(enumerate(names)), "i int, t string")
    assert column(df, rules.speaker_class("t")) == [True, True, False, None, None, None, False, True]


def test_exact_bucket_and_dev_predicate(spark):
    df = spark.createDataFrame(
        [(0, " Medicare_inbound  (USA- USA)", None, "f"), (1, None, "x", "a/Medicare_inbound (USA- USA)/1"),
         (2, "bank of x", None, "f"), (3, None, None, "f")],
        "i int, d string, t string, f string",
    )
    assert column(df, rules.exact_bucket("d", "t", "f", lex.BUCKET_LABEL)) == [True, True, False, False]
    assert column(df, rules.dev_sample_predicate(F.lit("hello"), "d", "t")) == [False, False, True, False]
