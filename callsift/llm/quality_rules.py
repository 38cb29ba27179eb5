"""Quality rules: word and line counts, and how far a text's histograms lie from its language's.

One pass over the texts makes narrow counts per document: characters by class and, per language,
how often each of its common words stands. The references are sums of the counts' shares over all
documents of a language; a document is then held against the nearest reference by the
Jensen-Shannon distance of both histograms.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callsift.llm.common import give_back, numbered, utf8, words
from callsift.operators.ranking import top_k_per_group
from callsift.session import written

#: Frequent words of each language; a histogram has a bin for each and one for all other words.
COMMON_WORDS: Mapping[str, tuple[str, ...]] = {
    "en": tuple("the of and to in a is that for with was on are as at by be from this or".split()),
    "de": tuple("der die und in den von zu das mit sich des auf für ist im dem nicht ein eine".split()),
    "fr": tuple("de la le et les des en un du une que est pour qui dans par sur pas au".split()),
    "es": tuple("de la que el en y a los se del las un por con no una su para es lo".split()),
}
VOWELS, CONSONANTS = b"aeiou", b"bcdfghjklmnpqrstvwxyz"
SPACE, STOPS = b"\t\n\x0b\x0c\r ", b".,;:!?'\"()-"
CLASSES = ("vowel", "consonant", "upper", "digit", "space", "stop", "symbol", "beyond_ascii")
SYMBOLS = b"#*$%&|<>"
WINDOW = 8


@dataclass(frozen=True)
class Limits:
    """Verdict limits. A histogram of fewer than ``min_chars`` characters or ``min_words`` words is
    too thin to be judged and passes."""

    min_words_base: int = 20
    max_repeat_percent: int = 30
    min_chars: int = 200
    min_words: int = 50
    max_char_distance: float = 0.24
    max_word_distance: float = 0.29


def _class_table() -> np.ndarray:
    table = np.full(129, CLASSES.index("symbol"), np.int64)
    for name, members in (
        ("vowel", VOWELS),
        ("consonant", CONSONANTS),
        ("upper", bytes(range(65, 91))),
        ("digit", bytes(range(48, 58))),
        ("space", SPACE),
        ("stop", STOPS),
        ("beyond_ascii", bytes([128])),
    ):
        table[list(members)] = CLASSES.index(name)
    return table


CLASS_OF = _class_table()
_SYMBOL_CODES = np.frombuffer(SYMBOLS, np.uint8)
_MIX = (np.random.default_rng(7).integers(1, 2**63, WINDOW, np.uint64) << np.uint64(1)) | np.uint64(1)


def repeat_words(ids: np.ndarray, width: int = WINDOW) -> int:
    """Words that stand in a ``width``-word window found twice or more, the first one included."""
    n = len(ids) - width + 1
    if n < 2:
        return 0
    spread = (ids.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    spread ^= spread >> np.uint64(29)
    mixed = np.zeros(n, np.uint64)
    for k in range(width):
        mixed += spread[k : k + n] * _MIX[k]
    ordered = np.sort(mixed)
    if not (ordered[1:] == ordered[:-1]).any():  # equal windows have equal sums
        return 0
    rank, size = ids, 1
    while size < width:  # exact ranks of windows of 2, 4, 8 words
        step = min(size, width - size)
        pair = rank[: len(rank) - step] * (int(rank.max()) + 1) + rank[step:]
        rank, size = np.unique(pair, return_inverse=True)[1], size + step
    again = np.flatnonzero(np.bincount(rank)[rank] > 1)
    edge = np.zeros(len(ids) + 1, np.int64)
    np.add.at(edge, again, 1)
    np.add.at(edge, again + width, -1)
    return int((np.cumsum(edge)[:-1] > 0).sum())


def counts_of(text: str | None, bins: Sequence[Mapping[bytes, int]]) -> tuple:
    """``(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, char histogram, word histograms)``."""
    raw = utf8(text)
    parts = words(raw)
    ids, distinct = numbered(parts)
    codes = np.frombuffer((text or "").encode("utf-32-le", "surrogatepass"), np.uint32)
    each = np.bincount(np.minimum(codes, 128), minlength=129)
    chars = np.bincount(CLASS_OF, weights=each, minlength=len(CLASSES)).astype(np.int64)
    lines = Counter(line for line in raw.split(b"\n") if line.split())
    uses = np.bincount(ids, minlength=len(distinct)) if len(ids) else np.zeros(0, np.int64)
    of_word: Counter[bytes] = Counter()
    for k, word in enumerate(distinct):
        of_word[word.lower()] += int(uses[k])
    by_lang = [np.array([of_word[w] for w in lang], np.int64) for lang in bins]
    by_lang = [np.append(h, len(parts) - h.sum()) for h in by_lang]
    return (
        len(parts),
        len(codes) - int(chars[CLASSES.index("space")]),
        int(each[_SYMBOL_CODES].sum()),
        sum(lines.values()) - len(lines),
        repeat_words(ids),
        chars,
        np.concatenate(by_lang),
    )


def stated_words(
    docs: DataFrame,
    common: Mapping[str, Sequence[str]],
    text: str = "text",
    lang: str = "lang",
    n: int = 20,
    min_docs: int = 50,
    most: int = 100,
) -> dict[str, tuple[str, ...]]:
    """The ``n`` most frequent words of every other language that at least ``min_docs`` documents
    state, at most of the ``most`` languages with most documents; counted in Spark over all of
    those documents. With such a list a language has a reference of its own."""
    others = docs.select(F.col(f"`{lang}`").alias("lang"), F.col(f"`{text}`").alias("text")).where(
        F.col("lang").isNotNull() & ~F.col("lang").isin(*common)
    )
    sizes = others.groupBy("lang").agg(F.count("*").alias("docs")).where(F.col("docs") >= min_docs)
    names = [r["lang"] for r in sizes.orderBy(F.desc("docs"), "lang").limit(most).collect()]
    if not names:
        return {}
    lowered = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    each = others.where(F.col("lang").isin(names)).select(
        "lang", F.explode(F.split(lowered, r"[\x20\x09-\x0D]+")).alias("word")
    )
    counts = each.where("word <> ''").groupBy("lang", "word").agg(F.count("*").alias("c"))
    best = top_k_per_group(counts, ["lang"], [F.desc("c"), F.col("word")], n, rank="rank")
    rows = best.orderBy("lang", "rank").collect()  # n words of each language
    return {name: tuple(r["word"] for r in rows if r["lang"] == name) for name in names}


def profile(
    docs: DataFrame, common: Mapping[str, Sequence[str]] = COMMON_WORDS, text: str = "text"
) -> DataFrame:
    """``docs`` without its text, with one struct ``_p`` of counts per row; runs in the row."""
    bins = [{w.encode(): k for k, w in enumerate(common[lang])} for lang in sorted(common)]

    @F.pandas_udf(
        "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
        "chars array<long>, common array<long>"
    )
    def measure(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "chars", "common"]
        for batch in batches:
            yield pd.DataFrame([counts_of(t, bins) for t in batch], columns=names)
        give_back()

    return docs.withColumn("_p", measure(F.col(text)))


def base_failed(limits: Limits):
    p = F.col("_p")
    return (p["n_words"] < limits.min_words_base) | (
        100 * p["n_repeat_words"] > limits.max_repeat_percent * p["n_words"]
    )


def fit_references(
    profiled: DataFrame, common: Mapping[str, Sequence[str]], limits: Limits, lang: str = "lang"
) -> dict[str, tuple[np.ndarray, np.ndarray]]:
    """Per stated language the sums of all its documents' histograms, each in thousandths of itself.

    Documents that fail the base rules, or are too thin to be judged, have no part. One row per
    stated language comes to the driver. A language without documents has no reference.
    """
    p, names = F.col("_p"), sorted(common)
    ends = np.cumsum([0, *(len(common[n]) + 1 for n in names)])
    n_chars = F.aggregate(p["chars"], F.lit(0).cast("long"), lambda a, x: a + x)
    whole = (
        profiled.where(F.col(lang).isin(names) & ~base_failed(limits))
        .where((n_chars >= limits.min_chars) & (p["n_words"] >= limits.min_words))
        .select(
            F.col(lang).alias("_lang"),
            F.transform(p["chars"], lambda x: F.floor(1000 * x / n_chars)).alias("_c"),
            F.transform(p["common"], lambda x: F.floor(1000 * x / p["n_words"])).alias("_w"),
        )
    )
    sums = [F.sum(F.col("_c")[k]).alias(f"c{k}") for k in range(len(CLASSES))]
    sums += [F.sum(F.col("_w")[int(k)]).alias(f"w{k}") for k in range(ends[-1])]
    out = {}
    for row in whole.groupBy("_lang").agg(*sums).collect():
        at = names.index(row["_lang"])
        chars = np.array([row[f"c{k}"] for k in range(len(CLASSES))], float)
        common_words = np.array([row[f"w{k}"] for k in range(ends[at], ends[at + 1])], float)
        if chars.sum() and common_words.sum():
            out[row["_lang"]] = (chars / chars.sum(), common_words / common_words.sum())
    return out


def js_distance(counts: np.ndarray, reference: np.ndarray) -> np.ndarray:
    """Square root of the Jensen-Shannon divergence (base 2) of each row of counts to the reference;
    0 for a row without counts."""
    total = counts.sum(axis=1, keepdims=True)
    p = counts / np.maximum(total, 1)
    m = (p + reference) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        left = np.where(p > 0, p * np.log2(p / m), 0).sum(axis=1)
        right = np.where(reference > 0, reference * np.log2(reference / m), 0).sum(axis=1)
    return np.where(total[:, 0] > 0, np.sqrt(np.maximum(left + right, 0) / 2), 0.0)


def with_distances(
    profiled: DataFrame,
    references: Mapping[str, tuple[np.ndarray, np.ndarray]],
    common: Mapping[str, Sequence[str]] = COMMON_WORDS,
) -> DataFrame:
    """Profiled rows with a struct ``_d``: both distances to the nearest reference, and its language.
    The references are a few hundred numbers."""
    names = sorted(common)
    ends = np.cumsum([0, *(len(common[n]) + 1 for n in names)])

    @F.pandas_udf("char_distance double, word_distance double, nearest_lang string")
    def distances(chars: pd.Series, common_counts: pd.Series) -> pd.DataFrame:
        n = len(chars)
        c = np.array(chars.tolist(), float).reshape(n, -1)
        w = np.array(common_counts.tolist(), float).reshape(n, -1)
        best = np.full((n, 2), 0.0)
        sums, lang_of = np.full(n, np.inf), np.full(n, None, object)
        for k, name in enumerate(names):
            if name in references:
                dc = js_distance(c, references[name][0])
                dw = js_distance(w[:, ends[k] : ends[k + 1]], references[name][1])
                nearer = dc + dw < sums
                best[nearer] = np.stack([dc, dw], axis=1)[nearer]
                sums, lang_of[nearer] = np.minimum(sums, dc + dw), name
        return pd.DataFrame(
            {"char_distance": best[:, 0], "word_distance": best[:, 1], "nearest_lang": lang_of}
        )

    return profiled.withColumn("_d", distances(F.col("_p")["chars"], F.col("_p")["common"]))


def passes(limits: Limits):
    """The verdict on rows of ``with_distances``."""
    p, d = F.col("_p"), F.col("_d")
    n_chars = F.aggregate(p["chars"], F.lit(0).cast("long"), lambda a, x: a + x)
    far = ((n_chars >= limits.min_chars) & (d["char_distance"] > limits.max_char_distance)) | (
        (p["n_words"] >= limits.min_words) & (d["word_distance"] > limits.max_word_distance)
    )
    return ~base_failed(limits) & ~far


def keep(
    docs: DataFrame,
    common: Mapping[str, Sequence[str]] = COMMON_WORDS,
    limits: Limits = Limits(),
    text: str = "text",
    lang: str = "lang",
) -> DataFrame:
    """The rows of ``docs`` that pass, as they are: one pass for the references, one for the verdicts,
    and no text is shuffled. One function gives the whole verdict, so that a text is counted once.
    Languages, nulls, empty and repeated rows are taken as in ``judge``."""
    common = {**common, **stated_words(docs, common, text, lang)}
    counted = written(profile(docs.select(lang, text), common, text).select(lang, "_p"), "profile")
    references = fit_references(counted, common, limits, lang)
    bins = [{w.encode(): k for k, w in enumerate(common[name])} for name in sorted(common)]
    ends = np.cumsum([0, *(len(b) + 1 for b in bins)])

    @F.pandas_udf("boolean")
    def verdict(texts: pd.Series) -> pd.Series:
        rows = [counts_of(t, bins) for t in texts]
        n, repeated = (np.array([r[k] for r in rows], np.int64) for k in (0, 4))
        chars = np.array([r[5] for r in rows], float).reshape(len(rows), -1)
        words_of = np.array([r[6] for r in rows], float).reshape(len(rows), -1)
        best, pair = np.full(len(rows), np.inf), np.zeros((len(rows), 2))
        for k, name in enumerate(sorted(common)):
            if name in references:
                dc = js_distance(chars, references[name][0])
                dw = js_distance(words_of[:, ends[k] : ends[k + 1]], references[name][1])
                nearer = dc + dw < best
                pair[nearer] = np.stack([dc, dw], axis=1)[nearer]
                best = np.minimum(best, dc + dw)
        failed = (n < limits.min_words_base) | (100 * repeated > limits.max_repeat_percent * n)
        far = (chars.sum(axis=1) >= limits.min_chars) & (pair[:, 0] > limits.max_char_distance)
        far |= (n >= limits.min_words) & (pair[:, 1] > limits.max_word_distance)
        return pd.Series(~failed & ~far, dtype=bool)

    return docs.where(verdict(F.col(text)))


def judge(
    docs: DataFrame,
    common: Mapping[str, Sequence[str]] = COMMON_WORDS,
    limits: Limits = Limits(),
    text: str = "text",
    lang: str = "lang",
) -> DataFrame:
    """Counts, distances and the verdict of every row, beside the row's other columns but the text.

    Adds ``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    char_distance, word_distance, nearest_lang, kept``; columns of these names are replaced.
    ``lang`` only tells which documents make which reference: a text is held against the nearest
    one, so a null or wrong language changes no verdict. Languages beyond those of ``common`` get their
    words and reference from their own documents, where there are enough (``stated_words``); prose of a
    language that has neither is far from all references, and is rejected. A null or empty text has no words and
    fails the base rules. Repeated rows are judged alike. Without any reference both distances are
    0. The counts are written once to the shared folder, as the references need them all first.
    """
    made = (
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        "char_distance", "word_distance", "nearest_lang", "kept",
    )
    kept_columns = [c for c in docs.columns if c != text and c not in made]
    common = {**common, **stated_words(docs, common, text, lang)}
    own = {c: f"own_{n}" for n, c in enumerate(kept_columns)}  # so that no column is named like one made here
    renamed = docs.select(F.col(f"`{text}`").alias("text"), *[F.col(f"`{c}`").alias(o) for c, o in own.items()])
    stated = own.get(lang) or "own_lang"
    if lang not in own:
        renamed = renamed.withColumn(stated, docs[lang])
    profiled = written(profile(renamed, common).drop("text"), "profile")
    references = fit_references(profiled, common, limits, stated)
    p = F.col("_p")
    d = F.col("_d")
    return with_distances(profiled, references, common).select(
        *(F.col(o).alias(c) for c, o in own.items()),
        *(p[c].alias(c) for c in made[:5]),
        base_failed(limits).alias("base_failed"),
        *(d[c].alias(c) for c in ("char_distance", "word_distance", "nearest_lang")),
        passes(limits).alias("kept"),
    )
