"""Rule tables as columns. Rules are small ordered lists, so they become literal patterns that the
JVM compiles once per task; no rule join and no per-row pattern is needed."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from callsift.functions import lexicons as lex
from callsift.functions.text import _col, any_pattern, has_word, matches, normalize_label

Rules = Sequence[tuple[str, str]]  # (intent, pattern)


def dev_sample_predicate(
    text: Column | str,
    domain: Column | str,
    topic: Column | str,
    keywords: Iterable[str] = lex.DEV_KEYWORDS,
    metadata_words: Iterable[str] = lex.METADATA_WORDS,
) -> Column:
    """Keyword in the text, or a metadata word anywhere in domain or topic."""
    anywhere = "|".join(metadata_words)
    return (
        has_word(text, keywords)
        | F.coalesce(F.rlike(F.lower(_col(domain)), F.lit(anywhere)), F.lit(False))
        | F.coalesce(F.rlike(F.lower(_col(topic)), F.lit(anywhere)), F.lit(False))
    )


def pos_and_not_neg(
    text: Column | str,
    positive: Iterable[str] = lex.REFINE_POSITIVE,
    negative: Iterable[str] = lex.REFINE_NEGATIVE,
) -> Column:
    return has_word(text, positive) & ~has_word(text, negative)


def exact_bucket(
    domain: Column | str, topic: Column | str, file_name: Column | str, label: str
) -> Column:
    """Normalized domain or topic equals the label, or the file name holds it."""
    return (
        (normalize_label(domain) == label)
        | (normalize_label(topic) == label)
        | F.contains(_col(file_name), F.lit(label))
    )


def customer_like(
    sentence: Column | str,
    first_person: Iterable[str] = lex.FIRST_PERSON,
    domain_terms: Iterable[str] = lex.BANK_TERMS,
) -> Column:
    """First-person word, domain term, or a question."""
    return (
        has_word(sentence, first_person)
        | has_word(sentence, domain_terms)
        | F.endswith(_col(sentence), F.lit("?"))
    )


def matches_any(c: Column | str, rules: Rules) -> Column:
    """Some rule matches. Cheaper than the rules one by one, so it guards them."""
    return F.rlike(F.lower(_col(c)), F.lit(any_pattern(p for _, p in rules)))


def seed_match(sentence: Column | str, rules: Rules = lex.SEED_RULES) -> Column:
    """Intent of the first rule that matches, else null."""
    out = F
    for intent, pattern in rules:
        out = out.when(matches(sentence, pattern), F.lit(intent))
    return F.when(matches_any(sentence, rules), out)


def strict_match(
    intent: Column | str, utterance: Column | str, rules: Rules = lex.STRICT_RULES
) -> Column:
    """The intent's own tighter pattern matches; an intent without a pattern passes."""
    out = F
    for name, pattern in rules:
        out = out.when(_col(intent) == name, matches(utterance, pattern))
    return out.otherwise(F.lit(True))


def topup_match(
    sentence: Column | str,
    rules: Rules = lex.TOPUP_RULES,
    agent_openings: Iterable[str] = lex.AGENT_OPENINGS,
) -> Column:
    """Array of every intent whose pattern matches; empty for agent-like openings."""
    hits = F.array_compact(
        F.array(*[F.when(matches(sentence, pattern), F.lit(intent)) for intent, pattern in rules])
    )
    low = F.lower(_col(sentence))
    agent_like = F.lit(False)
    for opening in agent_openings:
        agent_like = agent_like | F.startswith(low, F.lit(opening))
    return F.when(agent_like, F.array().cast("array<string>")).otherwise(hits)


def suggest_intent(
    terms: Column | str, rules: Sequence[tuple[str, str]] = lex.SUGGEST_RULES
) -> Column:
    """Name for a cluster from its first five terms, else the first two terms joined by ``_``."""
    arr = _col(terms)
    joined = F.lower(F.array_join(F.slice(arr, 1, 5), " "))
    out = F
    for pattern, name in rules:
        out = out.when(F.rlike(joined, F.lit(pattern)), F.lit(name))
    fallback = F.nullif(F.array_join(F.slice(arr, 1, 2), "_"), F.lit(""))
    return out.otherwise(F.coalesce(fallback, F.lit("misc")))


def speaker_class(
    speaker: Column | str,
    customer: Iterable[str] = lex.CUSTOMER_ALIASES,
    agent: Iterable[str] = lex.AGENT_ALIASES,
) -> Column:
    """True = customer, False = agent, null = unknown.

    Exact aliases win over contained ones, and customer wins over agent at either level.
    """
    from callsift.functions.text import strip

    raw = _col(speaker)
    low = F.lower(strip(raw))
    cust = [a.lower() for a in customer]
    agt = [a.lower() for a in agent]

    def contains_any(words):
        hit = F.lit(False)
        for w in words:
            hit = hit | F.contains(low, F.lit(w))
        return hit

    return (
        F.when(raw.isNull() | (raw == ""), F.lit(None).cast("boolean"))
        .when(low.isin(cust), F.lit(True))
        .when(low.isin(agt), F.lit(False))
        .when(contains_any(cust), F.lit(True))
        .when(contains_any(agt), F.lit(False))
    )


def targets_needing_rows(targets: Mapping[str, int]) -> Column:
    """Array of ``(intent_id, target)`` structs, for use as an exploded literal."""
    return F.array(
        *[
            F.struct(F.lit(k).alias("intent_id"), F.lit(int(v)).cast("long").alias("target"))
            for k, v in targets.items()
        ]
    )
