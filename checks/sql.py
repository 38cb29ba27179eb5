"""SQL pieces for the oracles, written apart from the engine's own expressions.

Whole-word tests consume a neighbour instead of looking around, stripping is a regex, sentences are
cut at a marker line break.
"""

from __future__ import annotations

from collections.abc import Sequence

W = r"\p{L}\p{N}_"
S = r"[\t-\r\x1c-\x1f \x85\p{Z}]"


def quoted(words: Sequence[str]) -> str:
    return "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in words) + "]"


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^{S}+|{S}+$', '', 'g')"


def squash(x: str) -> str:
    return f"regexp_replace({strip(x)}, '{S}+', ' ', 'g')"


def clean(x: str) -> str:
    nl = f"replace({x}, chr(13), chr(10))"
    two = rf"regexp_replace({nl}, '\n{{3,}}', chr(10) || chr(10), 'g')"
    return strip(rf"regexp_replace({two}, '[ \t\x{{A0}}]+', ' ', 'g')")


def word(x: str, phrases: Sequence[str]) -> str:
    alt = "|".join(p.lower().replace("'", "''") for p in phrases)
    return f"regexp_matches(lower({x}), '(^|[^{W}])({alt})([^{W}]|$)')"


def sentence_list(x: str, lo: int, hi: int) -> str:
    marked = rf"regexp_replace({x}, '([.?!]){S}+', '\1' || chr(10), 'g')"
    parts = f"list_transform(string_split({marked}, chr(10)), lambda x: {strip('x')})"
    return f"list_filter({parts}, lambda x: length(x) BETWEEN {lo} AND {hi})"


def case(x: str, rules: Sequence[tuple[str, Sequence[str]]]) -> str:
    whens = " ".join(f"WHEN {word(x, words)} THEN '{name}'" for name, words in rules)
    return f"CASE {whens} END"


SEED_WORDS = (
    ("that", ("that",)),
    ("with", ("with", "from")),
    ("for", ("for",)),
    ("past", ("was", "are")),
    ("der", ("die", "der")),
    ("les", ("les", "des")),
    ("que", ("que",)),
    ("ach", ("ach",)),
)

SLOTS = "PERSON_NAME|LOCATION|PHONE_NUMBER|EMAIL_ADDRESS|MONEY_AMOUNT|DATE|TIME|OCCUPATION"


def slots(x: str) -> str:
    """Only the markers the views add occur in the data: DATE."""
    return squash(rf"regexp_replace({x}, '\[DATE\]', '{{date}}', 'gi')")


def pair(intent: str, x: str) -> str:
    return f"({intent} || '||' || {strip(f'lower({x})')})"


CALLS = """calls AS (
  SELECT source AS source_zip, doc_id AS ord, CAST(doc_id AS VARCHAR) AS file_name, lang AS domain,
         source AS topic, CAST(NULL AS VARCHAR) AS customer_text, text AS full_text
  FROM documents)"""

HALF_CALLS = """half_calls AS (
  SELECT * REPLACE (CASE WHEN ord % 2 = 0 THEN full_text END AS customer_text) FROM calls)"""

TURNS = f"""turns AS (
  SELECT 'z' || CAST(conv_id % 8 AS VARCHAR) AS source_zip, conv_id AS ord,
         CAST(conv_id AS VARCHAR) || '.json' AS file_name, turn AS pos, role AS speaker, {clean('text')} AS text,
         CASE WHEN role = 'user' THEN true WHEN role = 'assistant' THEN false END AS is_customer
  FROM conversations WHERE {strip('text')} <> '')"""

TURN_CALLS = f"""turn_calls AS (
  SELECT * FROM (
    SELECT source_zip, ord, file_name, count(*) AS n_turns,
           count(*) FILTER (is_customer) AS n_customer_turns,
           {clean("coalesce(string_agg(text, chr(10) ORDER BY pos) FILTER (is_customer), '')")} AS customer_text,
           {clean("coalesce(string_agg(text, chr(10) ORDER BY pos) FILTER (NOT is_customer), '')")} AS agent_text,
           {clean("string_agg(text, chr(10) ORDER BY pos)")} AS full_text
    FROM turns GROUP BY ALL)
  WHERE full_text <> '')"""

BLOBS = r"""blobs AS (
  SELECT source_zip, ord, file_name,
         string_agg(CASE WHEN speaker = 'user' THEN 'Customer: ' ELSE 'Agent - ' END || text,
                    chr(10) ORDER BY pos) AS full_text,
         trim(string_agg(text, chr(10) ORDER BY pos) FILTER (speaker = 'user')) AS customer_side,
         trim(string_agg(text, chr(10) ORDER BY pos) FILTER (speaker <> 'user')) AS agent_side
  FROM turns GROUP BY ALL)"""


def sents(source: str, text: str, lo: int, hi: int, extra: str = "", name: str = "sents") -> str:
    """CTE of exploded sentences with their place among the kept ones."""
    cols = "source_zip, ord" + (", " + extra if extra else "")
    names = "source_zip, ord" + (", " + extra.split(" AS ")[-1] if extra else "")
    return f"""{name} AS (
  SELECT {names}, unnest(range(len(a))) AS pos, unnest(a) AS utterance
  FROM (SELECT {cols}, {sentence_list(text, lo, hi)} AS a FROM {source}))"""


UTT = f"""{CALLS},
{sents('calls', 'full_text', 5, 300)},
seeded AS (SELECT *, {case('utterance', SEED_WORDS)} AS intent_id FROM sents),
asked AS (
  SELECT * REPLACE (CASE WHEN (ord + pos) % 3 = 0 THEN left(utterance, length(utterance) - 1) || '?'
                         ELSE utterance END AS utterance)
  FROM seeded WHERE intent_id IS NOT NULL),
utt AS (
  SELECT * REPLACE (CASE WHEN (ord + pos) % 5 = 0 THEN '[DATE] ' || utterance ELSE utterance END
                    AS utterance) FROM asked)"""


def part(shares: Sequence[str]) -> str:
    """A share of the rows by a hash of their place: those whose first hex digits are among the shares."""
    digits = f"substr(sha256(source_zip || '|' || CAST(ord AS VARCHAR) || '|' || CAST(pos AS VARCHAR)), 1, {len(shares[0])})"
    return f"{digits} IN ({', '.join(repr(x) for x in shares)})"


# a sixteenth of the utterances stand for existing rows
BASE_SHARE = ("0",)
BASE = f"""base AS (
  SELECT intent_id, 'name_' || intent_id AS intent_name, utterance, source_zip, ord, pos
  FROM utt WHERE {part(BASE_SHARE)})"""
# a sixty-fourth of them for a base whose target intents miss rows
SMALL_SHARE = ("00", "01", "02", "03")

CLUSTERED = sents(
    "calls",
    "full_text",
    5,
    400,
    extra="CAST(regexp_extract(source_zip, '([0-9]+)$', 1) AS INTEGER) AS cluster_id",
    name="clustered",
)
