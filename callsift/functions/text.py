"""Text columns. Everything here stays in the JVM and is a plain projection (no shuffle)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Character classes shared by every pattern. They are spelled out because the regex shorthands
# for "word" and "space" differ between engines on accented text.
WORD = r"[\p{L}\p{N}_]"
SPACE = r"[\t-\r\x1c-\x1f \x85\p{Z}]"
STRIP_CHARS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    + "".join(chr(c) for c in range(0x2000, 0x200B))
    + "\u2028\u2029\u202f\u205f\u3000"
)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    """Drop any Unicode white space at both ends (Spark's own trim drops blanks only)."""
    return F.btrim(_col(c), F.lit(STRIP_CHARS))


def first_nonempty(*cols: Column | str) -> Column:
    """First value that is neither null nor the empty string."""
    return F.coalesce(*[F.nullif(_col(c), F.lit("")) for c in cols])


def empty_to_null(c: Column | str) -> Column:
    return F.nullif(_col(c), F.lit(""))


def prefer_customer(customer_text: Column | str, full_text: Column | str) -> Column:
    """Customer text when there is any, else the whole call."""
    return F.coalesce(empty_to_null(customer_text), _col(full_text))


def truncate(c: Column | str, n: int) -> Column:
    return F.substring(_col(c), 1, n)


def clean_text(c: Column | str) -> Column:
    """CR to LF, three or more LF to two, blank/tab/NBSP runs to one blank, strip."""
    out = F.replace(_col(c), F.lit("\r"), F.lit("\n"))
    out = F.regexp_replace(out, r"\n{3,}", "\n\n")
    out = F.regexp_replace(out, r"[ \t\xa0]+", " ")
    return strip(out)


def squash_spaces(c: Column | str) -> Column:
    """Strip, and turn each run of white space into one blank."""
    return F.regexp_replace(strip(c), SPACE + "+", " ")


def normalize_label(c: Column | str) -> Column:
    return F.coalesce(squash_spaces(c), F.lit(""))


# The slot markers that become lower-case braces.
SLOT_NAMES = (
    "PERSON_NAME",
    "LOCATION",
    "PHONE_NUMBER",
    "EMAIL_ADDRESS",
    "MONEY_AMOUNT",
    "DATE",
    "TIME",
    "OCCUPATION",
)


def normalize_slots(c: Column | str) -> Column:
    """``[DATE]`` -> ``{date}`` for the known slots, then squash white space; null becomes ''."""
    text = F.coalesce(strip(c), F.lit(""))
    slotted = text
    for name in SLOT_NAMES:
        slotted = F.regexp_replace(slotted, rf"(?i)\[{name}\]", "{" + name.lower() + "}")
    text = F.when(F.contains(text, F.lit("[")), slotted).otherwise(text)
    return F.regexp_replace(text, SPACE + "+", " ")


def slugify(c: Column | str) -> Column:
    slug = F.regexp_replace(F.lower(strip(c)), "[^a-z0-9]+", "_")
    return F.coalesce(F.nullif(F.btrim(slug, F.lit("_")), F.lit("")), F.lit("misc"))


def intent_key(suggested: Column | str, cluster_id: Column | str) -> Column:
    return F.concat(slugify(suggested), F.lit("__c"), _col(cluster_id).cast("string"))


def pair_key(intent: Column | str, utterance: Column | str) -> Column:
    """Key for duplicates and leakage: intent and case-folded utterance."""
    return F.concat(_col(intent), F.lit("||"), strip(F.lower(_col(utterance))))


def content_hash(c: Column | str) -> Column:
    return F.sha2(_col(c), 256)


def is_question(c: Column | str) -> Column:
    return F.endswith(strip(c), F.lit("?"))


def min_words(c: Column | str, n: int) -> Column:
    """At least ``n`` white-space separated tokens: a search, so the text is not split."""
    other = "[^" + SPACE[1:]
    gap = SPACE + "+"
    return F.rlike(_col(c), F.lit(gap.join([other + "+"] * (n - 1) + [other])))


def sentences(c: Column | str, lo: int, hi: int) -> Column:
    """Array of stripped sentences of ``lo..hi`` characters.

    A sentence ends at white space after ``.``, ``?`` or ``!``, or at a line break.
    """
    parts = F.split(_col(c), r"(?<=[.?!])" + SPACE + r"+|\n+", -1)
    return F.filter(F.transform(parts, strip), lambda s: F.length(s).between(lo, hi))


def split_packed(c: Column | str, sep: str) -> Column:
    """Unpack a delimiter-packed cell into an array; blanks are dropped."""
    literal = "".join("\\" + ch if not ch.isalnum() and ch != " " else ch for ch in sep)
    return F.filter(F.transform(F.split(_col(c), literal, -1), strip), lambda s: s != "")


def take_examples(arr: Column | str, n: int) -> Column:
    return F.slice(_col(arr), 1, n)


def drop_blanks(arr: Column | str) -> Column:
    return F.filter(_col(arr), lambda s: s != "")


# --- word tests -------------------------------------------------------------------------------


def portable(pattern: str) -> str:
    r"""Spell out ``\b`` and ``\s`` of a rule pattern with Unicode classes.

    After a letter or a closing group ``\b`` closes a word; at a start it opens one; after any
    other literal (a brace) it needs a word character to follow.
    """
    out = []
    i = 0
    while i < len(pattern):
        token = pattern[i : i + 2]
        if token == r"\b":
            before = pattern[i - 1] if i else ""
            if before.isalnum() or (before and before in ")?"):
                out.append(f"(?!{WORD})")
            elif before == "}":
                out.append(f"(?={WORD})")
            else:
                out.append(f"(?<!{WORD})")
            i += 2
        elif token == r"\s":
            inside_class = pattern.rfind("[", 0, i) > pattern.rfind("]", 0, i)
            out.append(SPACE[1:-1] if inside_class else SPACE)
            i += 2
        else:
            out.append(pattern[i])
            i += 1
    return "".join(out)


def alternatives(pattern: str) -> list[str]:
    """The parts of a pattern between its outermost ``|``."""
    parts, depth, in_class, start, i = [], 0, False, 0, 0
    while i < len(pattern):
        ch = pattern[i]
        if ch == "\\":
            i += 2
            continue
        if in_class:
            in_class = ch != "]"
        elif ch == "[":
            in_class = True
        elif ch in "()":
            depth += 1 if ch == "(" else -1
        elif ch == "|" and depth == 0:
            parts.append(pattern[start:i])
            start = i + 1
        i += 1
    return [*parts, pattern[start:]]


def any_pattern(patterns: Iterable[str]) -> str:
    """One pattern that matches where any of them does.

    A word boundary that all of them start with is tested once per position, not per rule.
    """
    alts = [a for p in patterns for a in alternatives(p)]
    if all(a.startswith(r"\b") for a in alts):
        return portable(r"\b(?:" + "|".join(a[2:] for a in alts) + ")")
    return "|".join(portable(a) for a in alts)


def whole_word_pattern(phrases: Iterable[str]) -> str:
    """Pattern that finds any phrase as a whole word in lower-cased text."""
    return portable(r"\b(?:" + "|".join(phrases) + r")\b")


def matches(c: Column | str, pattern: str) -> Column:
    """Case-insensitive search for a rule pattern."""
    return F.rlike(F.lower(_col(c)), F.lit(portable(pattern)))


def has_word(c: Column | str, phrases: Iterable[str]) -> Column:
    """Case-insensitive whole-word test for any of the phrases."""
    return F.rlike(F.lower(_col(c)), F.lit(whole_word_pattern([p.lower() for p in phrases])))


# --- terms ------------------------------------------------------------------------------------


def tokens(c: Column | str) -> Column:
    """Lower-case runs of two or more word characters."""
    return F.regexp_extract_all(F.lower(_col(c)), F.lit(WORD + "{2,}"), F.lit(0))


def remove_stops(arr: Column | str, stops: Iterable[str]) -> Column:
    words = sorted(set(stops))
    return F.filter(_col(arr), lambda t: ~t.isin(words)) if words else _col(arr)


def bigrams(arr: Column | str) -> Column:
    a = _col(arr)
    shifted = F.slice(a, F.lit(2), F.size(a))
    return F.array_compact(F.zip_with(a, shifted, lambda x, y: F.concat(x, F.lit(" "), y)))


def ngrams(arr: Column | str, n_max: int = 2) -> Column:
    """Unigrams, followed by bigrams when ``n_max`` is 2."""
    if n_max == 1:
        return _col(arr)
    return F.concat(_col(arr), bigrams(arr))
