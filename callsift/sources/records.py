"""Raw JSON records with guessed keys: lenient decode, metadata, plain text and turns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callsift.functions.text import _col, clean_text, strip
from callsift.operators.calls import split_transcript
from callsift.operators.shaping import computed_once

# --- fixed values: the keys a record may use, in order of preference ----------------------------

DOMAIN_KEYS = ("domain", "industry", "category")
TOPIC_KEYS = ("topic", "subtopic")
TRANSCRIPT_KEYS = ("transcript", "text")
TURN_KEYS = ("turns", "dialog", "dialogue", "utterances")
PLAIN_LIST_KEYS = ("dialog", "dialogue", "turns", "utterances")
SPEAKER_KEYS = ("speaker", "role", "spk")
TEXT_KEYS = ("text", "utterance", "content")
LOOSE_TEXT_LENGTHS = (5, 20_000)


def decode_tagged(members: DataFrame) -> DataFrame:
    """Every member with ``rec``, a map of top-level key to variant, and ``reason``: null for a good
    record, else why it is rejected.

    Rejected: unreadable members, broken JSON, anything that is not a non-empty object. The map
    keeps document order, and repeated keys, of which the last one counts.
    """
    # In an array before an object that only its own text's digest names: anything after the record
    # breaks the array, adds to it, or closes it before that object.
    whole = F.expr(
        """from_json(concat('[', raw, ',{"', sha2(raw, 256), '":1}]'), 'array<map<string,variant>>',
        map('allowSingleQuotes', 'false', 'maxStringLen', '2147483647'))"""
    )
    is_object = F.rlike("raw", F.lit(r"\A[ \t\r\n]*\{"))
    closed = lambda a: F.map_contains_key(F.get(a, F.lit(1)), F.sha2("raw", 256))
    only = F.transform(
        F.array(whole), lambda a: F.when((F.size(a) == 2) & closed(a), F.get(a, F.lit(0)))
    )
    parsed = computed_once(members, {"rec": F.get(F.when(is_object, only), F.lit(0))})
    ok = F.coalesce(F.col("rec").isNotNull() & (F.size("rec") > 0), F.lit(False))
    why = F.coalesce(*([F.col("error")] if "error" in members.columns else []), F.lit("bad json"))
    return parsed.withColumn("reason", F.when(~ok, why))


def decode_json(members: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(good, rejects)`` as ``decode_tagged`` tells them apart, as two lazy tables."""
    tagged = decode_tagged(members)
    good = tagged.where(F.col("reason").isNull()).drop("reason")
    return good, rejects_of(tagged, members.columns)


def rejects_of(tagged: DataFrame, columns: Sequence[str]) -> DataFrame:
    rejected = tagged.where(F.col("reason").isNotNull())
    return rejected.select(*[c for c in columns if c in tagged.columns and c != "raw"], "reason")


def field(rec: Column | str, key: str) -> Column:
    """Variant under a top-level key, the last one when the key is repeated."""
    return F.try_element_at(
        F.map_values(F.map_filter(_col(rec), lambda k, _: k == key)), F.lit(-1)
    )


def _kind(v: Column) -> Column:
    return F.schema_of_variant(v)


def _string(v: Column) -> Column:
    """The text of a string variant; null for any other kind."""
    return F.when(_kind(v) == "STRING", v.cast("string"))


def _truthy(v: Column) -> Column:
    """The value as text unless it is empty, zero, false or missing."""
    kind, text = _kind(v), v.cast("string")
    return (
        F.when(kind == "STRING", F.nullif(text, F.lit("")))
        .when(kind == "VOID", F.lit(None).cast("string"))
        .when(kind == "BOOLEAN", F.nullif(text, F.lit("false")))
        .when(kind.rlike("^(ARRAY|OBJECT)"), F.when(~text.isin("[]", "{}"), text))
        .otherwise(F.when(~text.rlike(r"^-?0+(\.0+)?(E.*)?$"), text))
    )


def with_fields(good: DataFrame) -> DataFrame:
    """Pull every key that is looked at out of ``rec`` once, as a variant column ``_key``."""
    keys = dict.fromkeys((*DOMAIN_KEYS, *TOPIC_KEYS, *TRANSCRIPT_KEYS, *TURN_KEYS))
    return good.select("*", *[field("rec", k).alias(f"_{k}") for k in keys])


def first_field(keys: Sequence[str]) -> Column:
    """First key with a non-empty value, as text; needs ``with_fields``."""
    return F.coalesce(*[_truthy(F.col(f"_{k}")) for k in keys])


def _as_list(v: Column) -> Column:
    return F.when(
        F.startswith(_kind(v), F.lit("ARRAY")), F.try_variant_get(v, "$", "array<variant>")
    )


def _item(v: Column, key: str) -> Column:
    return F.try_variant_get(v, f"$.{key}", "variant")


def _is_object(v: Column) -> Column:
    return F.startswith(_kind(v), F.lit("OBJECT"))


def extract_plain_text(fields: DataFrame, out: str = "text") -> DataFrame:
    """Add the record's text without speakers; needs ``with_fields``.

    A transcript string wins even when empty; then the first list that yields any text; then every
    top-level string of 5 to 20,000 characters in document order.
    """
    pieces = [
        F.flatten(
            F.transform(
                _as_list(F.col(f"_{key}")),
                lambda item: F.when(
                    _is_object(item),
                    F.array_compact(F.array(*[_string(_item(item, k)) for k in TEXT_KEYS])),
                ).otherwise(F.array_compact(F.array(_string(item)))),
            )
        ).alias(f"_parts_{key}")
        for key in PLAIN_LIST_KEYS
    ]
    direct = [_string(F.col(f"_{k}")) for k in TRANSCRIPT_KEYS]
    lists = [
        F.when(F.size(f"_parts_{k}") > 0, F.array_join(f"_parts_{k}", "\n"))
        for k in PLAIN_LIST_KEYS
    ]
    lo, hi = LOOSE_TEXT_LENGTHS
    loose = F.filter(
        F.transform(F.map_values("rec"), _string),
        lambda s: s.isNotNull() & F.length(s).between(lo, hi),
    )
    return (
        fields.select("*", *pieces)
        .withColumn(out, F.coalesce(*direct, *lists, F.array_join(loose, "\n")))
        .drop(*[f"_parts_{k}" for k in PLAIN_LIST_KEYS])
    )


def _turn(item: Column) -> Column:
    """``(speaker, text)`` of an unpacked list item; null when it has no text.

    The first non-empty text key decides, and it must hold a string.
    """
    who = F.coalesce(*[_truthy(item[k]) for k in SPEAKER_KEYS], F.lit(""))
    said = F
    for key in TEXT_KEYS:
        said = said.when(_truthy(item[key]).isNotNull(), _string(item[key]))
    text = F.coalesce(item["bare"], said)
    return F.when(
        strip(text) != "", F.struct(who.alias("speaker"), clean_text(text).alias("text"))
    )


def extract_turns(fields: DataFrame, out: str = "turns") -> DataFrame:
    """Add the ordered array of ``(pos, speaker, text)``; needs ``with_fields``.

    The first key that holds a list ends the search, even when it yields no turn; without turns a
    transcript string is split into lines.
    """
    chosen = F.coalesce(*[_as_list(F.col(f"_{k}")) for k in TURN_KEYS])
    unpacked = F.transform(
        F.col("_list"),
        lambda item: F.struct(
            _string(item).alias("bare"),
            *[_item(item, k).alias(k) for k in (*SPEAKER_KEYS, *TEXT_KEYS)],
        ),
    )
    numbered = F.transform(
        "_found",
        lambda t, i: F.struct(
            i.cast("long").alias("pos"), t["speaker"].alias("speaker"), t["text"].alias("text")
        ),
    )
    transcript = F
    for key in TRANSCRIPT_KEYS:
        text = _string(F.col(f"_{key}"))
        transcript = transcript.when(strip(text) != "", text)
    empty = F.array().cast("array<struct<pos:bigint,speaker:string,text:string>>")
    return (
        fields.withColumn("_list", chosen)
        .withColumn("_items", unpacked)
        .withColumn("_found", F.array_compact(F.transform("_items", _turn)))
        .withColumn(
            out,
            F.when(F.size("_found") > 0, numbered).otherwise(
                F.coalesce(split_transcript(transcript), empty)
            ),
        )
        .drop("_list", "_items", "_found")
    )


def _place(df: DataFrame) -> list[str]:
    """The columns that order records: archives of one base name differ in their path."""
    return [c for c in ("source_zip", "path", "ord") if c in df.columns]


def raw_calls(good: DataFrame, *kept: str) -> DataFrame:
    """Decoded records to ``(source_zip, path, ord, file_name, domain, topic, turns)``; the
    path only where the records have one. ``kept`` names further columns to keep."""
    return extract_turns(with_fields(good)).select(
        *_place(good),
        *kept,
        "file_name",
        first_field(DOMAIN_KEYS).alias("domain"),
        first_field(TOPIC_KEYS).alias("topic"),
        "turns",
    )


def raw_texts(good: DataFrame, *kept: str) -> DataFrame:
    """Decoded records to ``(source_zip, path, ord, file_name, domain, topic, text)``; the
    path only where the records have one. ``kept`` names further columns to keep."""
    return extract_plain_text(with_fields(good)).select(
        *_place(good),
        *kept,
        "file_name",
        first_field(DOMAIN_KEYS).alias("domain"),
        first_field(TOPIC_KEYS).alias("topic"),
        "text",
    )
