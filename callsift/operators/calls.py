"""Calls: turns to role texts, re-segmenting, domain filter and de-duplication of calls."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callsift.functions import lexicons as lex
from callsift.functions.rules import pos_and_not_neg, speaker_class
from callsift.functions.text import (
    SPACE,
    _col,
    clean_text,
    content_hash,
    empty_to_null,
    has_word,
    prefer_customer,
    strip,
)
from callsift.operators.ranking import first_per_key
from callsift.operators.shaping import computed_once

TRANSCRIPT_LINES = 5000


def split_transcript(text: Column | str, cap: int = TRANSCRIPT_LINES) -> Column:
    """One speaker-less turn per non-empty cleaned line, the first ``cap`` of them."""
    lines = F.filter(
        F.transform(F.split(_col(text), "\n", -1), clean_text), lambda line: line != ""
    )
    return F.transform(
        F.slice(lines, 1, cap),
        lambda line, i: F.struct(
            i.cast("long").alias("pos"), F.lit("").alias("speaker"), line.alias("text")
        ),
    )


def mark_speakers(
    turns: Column | str,
    customer: Iterable[str] = lex.CUSTOMER_ALIASES,
    agent: Iterable[str] = lex.AGENT_ALIASES,
) -> Column:
    """Add the speaker class to an array of ``(pos, speaker, text)``."""
    return F.transform(
        _col(turns),
        lambda t: F.struct(
            t["pos"].alias("pos"),
            t["speaker"].alias("speaker"),
            t["text"].alias("text"),
            speaker_class(t["speaker"], customer, agent).alias("is_customer"),
        ),
    )


def turns_by_call(turns: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows ``(keys, pos, speaker, text)`` to one row per call with its ordered ``turns``.

    Texts are cleaned and blank turns dropped, as for turns read from a record. A call is one output cell, so its turns meet in one task by definition; the turns of different
    calls never do.
    """
    spoken = turns.where(strip("text") != "").withColumn("text", clean_text("text"))
    return spoken.groupBy(*keys).agg(
        F.array_sort(F.collect_list(F.struct("pos", "speaker", "text"))).alias("turns")
    )


def role_text(turns: Column | str, customer: bool) -> Column:
    """Cleaned newline-join of one class's turns; unknown speakers are in neither class."""
    picked = F.filter(
        _col(turns), lambda t: F.coalesce(t["is_customer"] == F.lit(customer), F.lit(False))
    )
    return clean_text(F.array_join(F.transform(picked, lambda t: t["text"]), "\n"))


def full_text(turns: Column | str) -> Column:
    return clean_text(F.array_join(F.transform(_col(turns), lambda t: t["text"]), "\n"))


def with_call_texts(
    calls: DataFrame,
    customer: Iterable[str] = lex.CUSTOMER_ALIASES,
    agent: Iterable[str] = lex.AGENT_ALIASES,
    keep_blank: bool = False,
) -> DataFrame:
    """From ``turns`` to turn counts and the three texts; calls without text are dropped, if they are not
    to be kept."""
    marked = computed_once(calls, {"turns": mark_speakers("turns", customer, agent)})
    is_customer = F.filter("turns", lambda t: F.coalesce(t["is_customer"], F.lit(False)))
    texts = computed_once(
        marked,
        {
            "n_turns": F.size("turns").cast("long"),
            "n_customer_turns": F.size(is_customer).cast("long"),
            "customer_text": role_text("turns", True),
            "agent_text": role_text("turns", False),
            "full_text": full_text("turns"),
        },
    ).drop("turns")
    return texts if keep_blank else texts.where(F.col("full_text") != "")


def keyword_calls(calls: DataFrame, keywords: Iterable[str] = lex.BUILD_KEYWORDS) -> DataFrame:
    """Calls whose preferred text has a domain word."""
    return calls.where(has_word(prefer_customer("customer_text", "full_text"), keywords))


def first_by_hash(calls: DataFrame, order: Sequence[str] = ("source_zip", "ord")) -> DataFrame:
    """First call per content hash of the preferred text.

    Apply it after the keyword filter, as the kept row depends on the order of the two.
    """
    hashed = calls.withColumn("hash", content_hash(prefer_customer("customer_text", "full_text")))
    return first_per_key(hashed, ["hash"], order)


# --- re-segmenting of single-blob transcripts -------------------------------------------------


def _prefix_pattern(roles: Iterable[str]) -> str:
    return r"(?i)(?:^|\n)" + SPACE + r"*(" + "|".join(roles) + r")" + SPACE + r"*[:\-]" + SPACE + "*"


def prefixed_segments(text: Column | str, roles: Iterable[str] = lex.PREFIX_ROLES) -> Column:
    """Array of ``(role, text)`` for every "Role:" line prefix; text before the first is dropped."""
    pattern = _prefix_pattern(roles)
    names = F.regexp_extract_all(_col(text), F.lit(pattern), F.lit(1))
    parts = F.split(_col(text), pattern, -1)
    bodies = F.slice(parts, F.lit(2), F.size(parts))
    return F.zip_with(
        names,
        bodies,
        lambda n, b: F.struct(F.lower(n).alias("role"), strip(b).alias("text")),
    )


def resegment_by_prefix(
    text: Column | str,
    roles: Iterable[str] = lex.PREFIX_ROLES,
    customer_roles: Iterable[str] = lex.PREFIX_CUSTOMER_ROLES,
) -> Column:
    """Struct ``(customer_text, agent_text)`` of a prefixed blob; both empty without a prefix."""
    segments = prefixed_segments(text, roles)
    is_customer = "|".join(customer_roles)

    def side(customer: bool) -> Column:
        hit = F.filter(
            segments,
            lambda s: F.rlike(s["role"], F.lit(is_customer))
            if customer
            else ~F.rlike(s["role"], F.lit(is_customer)),
        )
        return strip(F.array_join(F.transform(hit, lambda s: s["text"]), "\n"))

    return F.struct(side(True).alias("customer_text"), side(False).alias("agent_text"))


def refine_calls(
    calls: DataFrame,
    positive: Iterable[str] = lex.REFINE_POSITIVE,
    negative: Iterable[str] = lex.REFINE_NEGATIVE,
) -> DataFrame:
    """Strict domain filter on the preferred text, re-segmented where there is no customer text."""
    texts = calls.withColumn("customer_text", F.coalesce(strip("customer_text"), F.lit("")))
    texts = texts.withColumn("full_text", F.coalesce(strip("full_text"), F.lit("")))
    prefixed = F.rlike("full_text", F.lit(_prefix_pattern(lex.PREFIX_ROLES)))
    found = F.when(
        (F.col("customer_text") == "") & prefixed, resegment_by_prefix("full_text")["customer_text"]
    ).otherwise(F.col("customer_text"))
    shaped = computed_once(
        texts, {"customer_text": empty_to_null(found), "full_text": empty_to_null("full_text")}
    )
    preferred = F.coalesce("customer_text", "full_text")
    return shaped.where(preferred.isNotNull()).where(
        pos_and_not_neg(preferred, positive, negative)
    )
