"""Text functions and predicates over whole columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from callsift.functions import lexicons as lex
from callsift.functions import rules, text
from callsift.operators.calls import split_transcript
from checks import sql as q
from checks import views as v
from checks.registry import query


@query(
    "first_nonempty",
    """SELECT doc_id, coalesce(nullif(CASE WHEN lang = 'en' THEN '' ELSE lang END, ''), source)
       AS domain FROM documents""",
)
def _(spark, sf):
    lang = F.when(F.col("lang") == "en", F.lit("")).otherwise(F.col("lang"))
    return v.documents(spark, sf).select(
        "doc_id", text.first_nonempty(lang, "source").alias("domain")
    )


@query(
    "split_transcript",
    f"""WITH l AS (SELECT doc_id, list_filter(list_transform(string_split(text, chr(10)),
               lambda x: {q.clean('x')}), lambda x: x <> '')[1:5000] AS a FROM documents)
        SELECT doc_id, unnest(range(len(a))) AS pos, unnest(a) AS line FROM l""",
)
def _(spark, sf):
    return (
        v.documents(spark, sf)
        .select("doc_id", F.inline(split_transcript("text")))
        .select("doc_id", "pos", F.col("text").alias("line"))
    )


@query(
    "speaker_class",
    """SELECT conv_id, turn, CASE role WHEN 'user' THEN true WHEN 'assistant' THEN false END
       AS is_customer FROM conversations""",
)
def _(spark, sf):
    return v.table(spark, sf, "conversations").select(
        "conv_id", "turn", rules.speaker_class("role", v.CUSTOMER, v.AGENT).alias("is_customer")
    )


@query(
    "clean_text",
    f"SELECT doc_id, length(c) AS n, sha256(c) AS digest FROM (SELECT doc_id, {q.clean('text')} AS c "
    "FROM documents)",
)
def _(spark, sf):
    c = text.clean_text("text")
    return v.documents(spark, sf).select(
        "doc_id", F.length(c).cast("long").alias("n"), F.sha2(c, 256).alias("digest")
    )


@query(
    "empty_to_null",
    "SELECT doc_id, nullif(CASE WHEN lang = 'de' THEN '' ELSE text END, '') AS text FROM documents",
)
def _(spark, sf):
    t = F.when(F.col("lang") == "de", F.lit("")).otherwise(F.col("text"))
    return v.documents(spark, sf).select("doc_id", text.empty_to_null(t).alias("text"))


@query("truncate", "SELECT doc_id, substr(text, 1, 500) AS text FROM documents")
def _(spark, sf):
    return v.documents(spark, sf).select("doc_id", text.truncate("text", 500).alias("text"))


@query(
    "sentences",
    f"WITH {q.CALLS}, {q.sents('calls', 'full_text', 5, 400)} "
    "SELECT ord, pos, utterance FROM sents",
)
def _(spark, sf):
    return v.calls(spark, sf).select(
        "ord", F.posexplode(text.sentences("full_text", 5, 400))
    ).select("ord", F.col("pos").cast("long").alias("pos"), F.col("col").alias("utterance"))


@query(
    "sentences_of_turns",
    f"""SELECT conv_id, turn, unnest(range(len(a))) AS pos, unnest(a) AS utterance FROM (
        SELECT conv_id, turn, {q.sentence_list('text', 5, 300)} AS a FROM conversations)""",
)
def _(spark, sf):
    return (
        v.table(spark, sf, "conversations")
        .select("conv_id", "turn", F.posexplode(text.sentences("text", 5, 300)))
        .select(
            "conv_id", "turn", F.col("pos").cast("long").alias("pos"), F.col("col").alias("utterance")
        )
    )


@query(
    "normalize_slots",
    f"WITH {q.UTT} SELECT ord, pos, {q.slots('utterance')} AS utterance FROM utt",
)
def _(spark, sf):
    return v.utterances(spark, sf).select(
        "ord", "pos", text.normalize_slots("utterance").alias("utterance")
    )


_SLUG = "trim(regexp_replace(lower({}), '[^a-z0-9]+', '_', 'g'), '_')"


@query(
    "slugify",
    f"""SELECT doc_id, coalesce(nullif({_SLUG.format(q.strip("text"))}, ''), 'misc')
        AS slug FROM documents""",
)
def _(spark, sf):
    return v.documents(spark, sf).select(
        "doc_id", text.slugify("text").alias("slug")
    )


@query(
    "intent_key",
    f"""SELECT doc_id, coalesce(nullif({_SLUG.format(q.strip("source || ' ' || lang"))}, ''), 'misc')
        || '__c' || CAST(doc_id % 25 AS VARCHAR) AS intent_id FROM documents""",
)
def _(spark, sf):
    return v.documents(spark, sf).select(
        "doc_id",
        text.intent_key(F.concat("source", F.lit(" "), "lang"), F.col("doc_id") % 25).alias(
            "intent_id"
        ),
    )


def _suggest_sql() -> str:
    whens = " ".join(f"WHEN regexp_matches(t, '{p}') THEN '{n}'" for p, n in lex.SUGGEST_RULES)
    return f"""WITH a AS (SELECT doc_id, list_distinct(regexp_extract_all(lower(text),
                 '[{q.W}]{{2,}}')) AS raw, regexp_extract_all(lower(text), '[{q.W}]{{2,}}') AS w
               FROM documents),
        b AS (SELECT doc_id, array_to_string(w[1:5], ' ') AS t, array_to_string(w[1:2], '_') AS two
              FROM a)
        SELECT doc_id, CASE {whens} ELSE coalesce(nullif(two, ''), 'misc') END AS suggested
        FROM b"""


@query("suggest_intent", _suggest_sql())
def _(spark, sf):
    words = v.documents(spark, sf).select("doc_id", text.tokens("text").alias("words"))
    return words.select("doc_id", rules.suggest_intent("words").alias("suggested"))


@query(
    "split_packed",
    f"""SELECT doc_id, CAST(len(a) AS BIGINT) AS n, array_to_string(a, chr(166)) AS cells FROM (
        SELECT doc_id, list_filter(list_transform(string_split(text, ','), lambda x: {q.strip('x')}),
                                   lambda x: x <> '') AS a FROM documents)""",
)
def _(spark, sf):
    a = v.documents(spark, sf).select("doc_id", text.split_packed("text", ",").alias("a"))
    return a.select(
        "doc_id", F.size("a").cast("long").alias("n"), F.array_join("a", "¦").alias("cells")
    )


@query(
    "take_examples",
    f"""SELECT doc_id, array_to_string({q.sentence_list('text', 5, 400)}[1:15], chr(10)) AS examples
        FROM documents""",
)
def _(spark, sf):
    return v.documents(spark, sf).select(
        "doc_id",
        F.array_join(text.take_examples(text.sentences("text", 5, 400), 15), "\n").alias("examples"),
    )


@query(
    "drop_blank_samples",
    f"""SELECT doc_id, array_to_string(list_filter(list_transform(string_split(text, chr(10)),
        lambda x: {q.squash('x')}), lambda x: x <> '')[1:25], chr(10)) AS samples FROM documents""",
)
def _(spark, sf):
    lines = F.transform(F.split("text", "\n", -1), text.normalize_slots)
    return v.documents(spark, sf).select(
        "doc_id", F.array_join(F.slice(text.drop_blanks(lines), 1, 25), "\n").alias("samples")
    )


@query(
    "is_question",
    f"WITH {q.UTT} SELECT ord, pos, suffix({q.strip('utterance')}, '?') AS is_question FROM utt",
)
def _(spark, sf):
    return v.utterances(spark, sf).select(
        "ord", "pos", text.is_question("utterance").alias("is_question")
    )


@query(
    "pair_key",
    f"WITH {q.UTT} SELECT ord, pos, {q.pair('intent_id', 'utterance')} AS key FROM utt",
)
def _(spark, sf):
    return v.utterances(spark, sf).select(
        "ord", "pos", text.pair_key("intent_id", "utterance").alias("key")
    )


@query("content_hash", "SELECT doc_id, sha256(text) AS hash FROM documents")
def _(spark, sf):
    return v.documents(spark, sf).select("doc_id", text.content_hash("text").alias("hash"))


@query(
    "normalize_label",
    f"SELECT doc_id, coalesce({q.squash('text')}, '') AS label FROM documents",
)
def _(spark, sf):
    return v.documents(spark, sf).select("doc_id", text.normalize_label("text").alias("label"))


# --- predicates -------------------------------------------------------------------------------


@query(
    "has_keyword",
    f"SELECT doc_id FROM documents WHERE {q.word('text', v.DOMAIN_WORDS)}",
)
def _(spark, sf):
    return v.documents(spark, sf).where(text.has_word("text", v.DOMAIN_WORDS)).select("doc_id")


@query(
    "has_banking_keyword",
    f"""SELECT doc_id AS id, 'document' AS kind FROM documents
        WHERE {q.word('text', lex.BUILD_KEYWORDS)}
        UNION ALL SELECT conv_id * 1000 + turn, 'turn' FROM conversations
        WHERE {q.word('text', lex.BUILD_KEYWORDS)}""",
)
def _(spark, sf):
    docs = v.documents(spark, sf).select(F.col("doc_id").alias("id"), "text", F.lit("document"))
    said = v.table(spark, sf, "conversations").select(
        F.col("conv_id") * 1000 + F.col("turn"), "text", F.lit("turn")
    )
    both = docs.union(said).toDF("id", "text", "kind")
    return both.where(text.has_word("text", lex.BUILD_KEYWORDS)).select("id", "kind")


@query(
    "dev_sample_predicate",
    f"""SELECT doc_id FROM documents WHERE {q.word('text', v.DOMAIN_WORDS)}
        OR regexp_matches(lower(lang), 'es|xx') OR regexp_matches(lower(source), 'es|xx')""",
)
def _(spark, sf):
    return v.documents(spark, sf).where(
        rules.dev_sample_predicate("text", "lang", "source", v.DOMAIN_WORDS, ("es", "xx"))
    ).select("doc_id")


@query(
    "pos_and_not_neg",
    f"""SELECT doc_id FROM documents WHERE {q.word('text', v.DOMAIN_WORDS)}
        AND NOT {q.word('text', v.UNWANTED_WORDS)}""",
)
def _(spark, sf):
    return v.documents(spark, sf).where(
        rules.pos_and_not_neg("text", v.DOMAIN_WORDS, v.UNWANTED_WORDS)
    ).select("doc_id")


@query(
    "exact_bucket",
    """SELECT doc_id FROM documents WHERE lang = 'de' OR doc_id % 7 = 0""",
)
def _(spark, sf):
    bucket = F.when(F.col("doc_id") % 7 == 0, F.lit("bucket-de/")).otherwise(F.lit("other/"))
    name = F.concat(bucket, F.col("doc_id").cast("string"))
    return v.documents(spark, sf).where(
        rules.exact_bucket(F.concat(F.lit(" "), "lang", F.lit("\t")), "source", name, "de")
    ).select("doc_id")


@query(
    "config_keyword_filter",
    f"""SELECT conv_id, turn FROM conversations
        WHERE {q.word('text', ('THE', 'die der', 'les des', 'ach'))}""",
)
def _(spark, sf):
    return v.table(spark, sf, "conversations").where(
        text.has_word("text", ["THE", "die der", "les des", "ach"])
    ).select("conv_id", "turn")


@query(
    "customer_like",
    f"""WITH {q.UTT} SELECT ord, pos FROM utt WHERE {q.word('utterance', v.FIRST_PERSON)}
        OR {q.word('utterance', v.DOMAIN_TERMS)} OR suffix(utterance, '?')""",
)
def _(spark, sf):
    return v.utterances(spark, sf).where(
        rules.customer_like("utterance", v.FIRST_PERSON, v.DOMAIN_TERMS)
    ).select("ord", "pos")


@query(
    "min_words",
    f"""WITH {q.UTT} SELECT ord, pos FROM utt
        WHERE len(list_filter(regexp_split_to_array(utterance, '{q.S}+'), lambda x: x <> '')) >= 3""",
)
def _(spark, sf):
    return v.utterances(spark, sf).where(text.min_words("utterance", 3)).select("ord", "pos")


@query(
    "seed_match",
    f"""WITH {q.CALLS}, {q.sents('calls', 'full_text', 5, 300)}
        SELECT * FROM (SELECT ord, pos, {q.case('utterance', q.SEED_WORDS)} AS intent_id FROM sents)
        WHERE intent_id IS NOT NULL""",
)
def _(spark, sf):
    found = v.calls(spark, sf).select("ord", F.posexplode(text.sentences("full_text", 5, 300)))
    return (
        found.select(
            "ord", F.col("pos").cast("long").alias("pos"), rules.seed_match("col", v.SEEDS).alias("intent_id")
        ).where(F.col("intent_id").isNotNull())
    )


_N = f"[^{q.W}]"
STRICT_SQL = f"""CASE intent_id
  WHEN 'that' THEN regexp_matches(lower(utterance), '(^|{_N})that{_N}(.*{_N})?(the|of|in)({_N}|$)')
  WHEN 'with' THEN regexp_matches(lower(utterance), '(^|{_N})(with|from){q.S}+(the|a|this)({_N}|$)')
                OR regexp_matches(lower(utterance), '(^|{_N})of({_N}|$)')
  WHEN 'der' THEN regexp_matches(lower(utterance), '(^|{_N})(die|der)({_N}|$)')
  ELSE true END"""


@query(
    "strict_match",
    f"WITH {q.UTT} SELECT ord, pos, intent_id FROM utt WHERE {STRICT_SQL}",
)
def _(spark, sf):
    return v.utterances(spark, sf).where(
        rules.strict_match("intent_id", "utterance", v.STRICT)
    ).select("ord", "pos", "intent_id")


TOPUP_SQL = f"""list_filter([
  CASE WHEN {q.word('utterance', ('ach', 'auf', 'mit'))} THEN 'ach' END,
  CASE WHEN {q.word('utterance', ('que',))} THEN 'que' END,
  CASE WHEN {q.word('utterance', ('worthless', 'hein', 'erat'))} THEN 'rare' END,
  CASE WHEN regexp_matches(lower(utterance), '\\{{date\\}}{q.S}+(the|die|les)({_N}|$)') THEN 'dated' END
  ], lambda x: x IS NOT NULL)"""
AGENT_SQL = "NOT regexp_matches(lower(utterance), '^(the|die|les) ')"


@query(
    "topup_match",
    f"""WITH {q.UTT}, n AS (SELECT * REPLACE ({q.slots('utterance')} AS utterance) FROM utt)
        SELECT ord, pos, unnest({TOPUP_SQL}) AS target FROM n WHERE {AGENT_SQL}""",
)
def _(spark, sf):
    normalized = v.utterances(spark, sf).withColumn("utterance", text.normalize_slots("utterance"))
    return normalized.select(
        "ord",
        "pos",
        F.explode(rules.topup_match("utterance", v.TOPUPS, v.AGENT_OPENINGS)).alias("target"),
    )


@query(
    "placeholder_audit",
    f"""WITH {q.UTT}, n AS (SELECT CASE WHEN pos % 2 = 0 THEN {q.slots('utterance')} ELSE utterance END
        AS u FROM utt)
        SELECT count(*) FILTER (regexp_matches(u, '\\[.+\\]')) AS square_left,
               count(*) FILTER (regexp_matches(lower(u), '\\{{({q.SLOTS.lower()})\\}}')) AS slots_found
        FROM n""",
)
def _(spark, sf):
    from callsift.operators.reports import placeholder_audit

    half = F.when(F.col("pos") % 2 == 0, text.normalize_slots("utterance")).otherwise(
        F.col("utterance")
    )
    return placeholder_audit(v.utterances(spark, sf).withColumn("utterance", half))
