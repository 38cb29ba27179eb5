"""Calls: role texts, re-segmenting, filters and first-seen rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from callsift.functions.text import prefer_customer
from callsift.operators import calls as ops
from callsift.operators.ranking import first_rows, sample_n
from callsift.operators.utterances import candidate_sentences, dedup_corpus
from callsift.plans import jobs
from checks import sql as q
from checks import views as v
from checks.registry import query


def _texts(spark, sf):
    return ops.with_call_texts(v.turn_calls(spark, sf), v.CUSTOMER, v.AGENT)


TEXTS = f"{q.TURNS}, {q.TURN_CALLS}"


@query(
    "role_text",
    f"""WITH {TEXTS} SELECT ord, n_turns, n_customer_turns, customer_text, agent_text
        FROM turn_calls""",
)
def _(spark, sf):
    return _texts(spark, sf).select(
        "ord", "n_turns", "n_customer_turns", "customer_text", "agent_text"
    )


@query("full_text", f"WITH {TEXTS} SELECT ord, full_text FROM turn_calls")
def _(spark, sf):
    return _texts(spark, sf).select("ord", "full_text")


@query(
    "prefer_customer",
    f"""WITH {TEXTS} SELECT ord, CASE WHEN customer_text <> '' THEN customer_text ELSE full_text END
        AS text FROM turn_calls""",
)
def _(spark, sf):
    return _texts(spark, sf).select("ord", prefer_customer("customer_text", "full_text").alias("text"))


@query(
    "resegment_by_prefix",
    f"""WITH {q.TURNS}, {q.BLOBS} SELECT ord, coalesce(customer_side, '') AS customer_text,
        coalesce(agent_side, '') AS agent_text FROM blobs""",
)
def _(spark, sf):
    return v.blobs(spark, sf).select("ord", ops.resegment_by_prefix("full_text").alias("s")).select(
        "ord", "s.customer_text", "s.agent_text"
    )


PREFERRED = "CASE WHEN customer_text <> '' THEN customer_text ELSE full_text END"
SUBSET = f"""{TEXTS},
kept AS (SELECT *, sha256({PREFERRED}) AS hash FROM turn_calls
         WHERE {q.word(PREFERRED, v.DOMAIN_WORDS)}),
subset AS (SELECT * FROM kept QUALIFY row_number() OVER (PARTITION BY hash ORDER BY source_zip, ord) = 1)"""


def subset(spark, sf):
    return jobs.build_subset(v.turn_calls(spark, sf), v.DOMAIN_WORDS, v.CUSTOMER, v.AGENT)


@query(
    "call_subset",
    f"""WITH {SUBSET} SELECT source_zip, file_name, CAST(NULL AS VARCHAR) AS domain,
        CAST(NULL AS VARCHAR) AS topic, n_turns, n_customer_turns, customer_text, agent_text,
        full_text, hash FROM subset""",
)
def call_subset(spark, sf):
    return subset(spark, sf).drop("ord")


@query(
    "subset_counters",
    f"""WITH {SUBSET} SELECT (SELECT count(DISTINCT conv_id) FROM conversations) AS checked,
        (SELECT count(*) FROM kept) AS matched, (SELECT count(*) FROM subset) AS kept""",
)
def _(spark, sf):
    return jobs.subset_counters(
        v.turn_calls(spark, sf), v.DOMAIN_WORDS, customer=v.CUSTOMER, agent=v.AGENT
    )


FIRST = f"""{q.CALLS}, hit AS (SELECT *, sha256(full_text) AS hash FROM calls
   WHERE {q.word('full_text', v.DOMAIN_WORDS)})"""


@query(
    "first_by_hash",
    f"""WITH {FIRST} SELECT source_zip, ord, hash FROM hit
        QUALIFY row_number() OVER (PARTITION BY hash ORDER BY source_zip, ord) = 1""",
)
def _(spark, sf):
    kept = ops.keyword_calls(v.calls(spark, sf), v.DOMAIN_WORDS)
    return ops.first_by_hash(kept).select("source_zip", "ord", "hash")


REFINED = f"""{q.TURNS}, {q.BLOBS}, {q.CALLS}, {q.HALF_CALLS},
mixed AS (
  SELECT source_zip, ord, file_name, customer_side AS own, full_text FROM blobs
  UNION ALL SELECT source_zip, ord, file_name, customer_text, full_text FROM half_calls),
stripped AS (SELECT * REPLACE (nullif({q.strip('own')}, '') AS own, {q.strip('full_text')} AS full_text)
             FROM mixed),
refined AS (
  SELECT source_zip, ord, file_name, own AS customer_text, nullif(full_text, '') AS full_text
  FROM stripped WHERE coalesce(own, full_text) <> ''
  AND {q.word('coalesce(own, full_text)', v.DOMAIN_WORDS)}
  AND NOT {q.word('coalesce(own, full_text)', v.UNWANTED_WORDS)})"""


def refined(spark, sf):
    mixed = v.blobs(spark, sf).unionByName(
        v.half_calls(spark, sf).drop("domain", "topic")
    )
    return jobs.refine_subset(mixed, positive=v.DOMAIN_WORDS, negative=v.UNWANTED_WORDS)


@query("refine_subset", f"WITH {REFINED} SELECT * FROM refined")
def _(spark, sf):
    return refined(spark, sf)


@query(
    "refined_lengths",
    f"""WITH {REFINED} SELECT quantile_cont(n, 0.5) AS median, quantile_cont(n, 0.9) AS p90
        FROM (SELECT length(coalesce(customer_text, full_text)) AS n FROM refined)""",
)
def _(spark, sf):
    return jobs.refined_lengths(refined(spark, sf))


CANDIDATES = f"""{q.CALLS}, {q.HALF_CALLS},
listed AS (
  SELECT source_zip, ord, customer_text IS NOT NULL AS own,
         {q.sentence_list(q.strip('full_text'), 5, 400)} AS a FROM half_calls),
likely AS (
  SELECT source_zip, ord, own, CASE WHEN own THEN a ELSE list_filter(a, lambda x:
     {q.word('x', v.FIRST_PERSON)} OR {q.word('x', v.DOMAIN_TERMS)} OR suffix(x, '?')) END AS a
  FROM listed),
flat AS (SELECT source_zip, ord, own, len(a) AS n, unnest(range(len(a))) AS i, unnest(a) AS utterance
         FROM likely),
placed AS (SELECT *, row_number() OVER (PARTITION BY source_zip, ord ORDER BY length(utterance), i)
           AS short_place FROM flat),
candidates AS (
  SELECT source_zip, ord, CASE WHEN NOT own AND n > 20 THEN short_place - 1 ELSE i END AS pos, utterance
  FROM placed WHERE own OR n <= 20 OR short_place <= 20)"""


def candidates(spark, sf):
    return candidate_sentences(v.half_calls(spark, sf), v.FIRST_PERSON, v.DOMAIN_TERMS)


@query(
    "shortest_per_call",
    f"WITH {CANDIDATES} SELECT source_zip, ord, pos, utterance FROM candidates",
)
def _(spark, sf):
    return candidates(spark, sf)


@query(
    "dedup_corpus",
    f"""WITH {CANDIDATES} SELECT source_zip, ord, pos, utterance FROM candidates
        WHERE len(list_filter(regexp_split_to_array(utterance, '{q.S}+'), lambda x: x <> '')) >= 3
        QUALIFY row_number() OVER (PARTITION BY utterance ORDER BY source_zip, ord, pos) = 1""",
)
def _(spark, sf):
    return dedup_corpus(candidates(spark, sf))


@query(
    "first_n",
    f"""SELECT source AS source_zip, doc_id AS ord, substr(text, 1, 50000) AS text FROM documents
        WHERE {q.word('text', v.DOMAIN_WORDS)} ORDER BY source, doc_id LIMIT 1000""",
)
def _(spark, sf):
    hits = v.calls(spark, sf).select("source_zip", "ord", F.col("full_text").alias("text"))
    from callsift.functions.text import has_word, truncate

    return first_rows(hits.where(has_word("text", v.DOMAIN_WORDS)), ["source_zip", "ord"], 1000).withColumn(
        "text", truncate("text", 50_000)
    )


@query(
    "sample_n",
    """SELECT source AS source_zip, doc_id AS ord FROM documents
       ORDER BY sha256('42|' || source || '|' || CAST(doc_id AS VARCHAR)) LIMIT 200""",
)
def _(spark, sf):
    return sample_n(v.calls(spark, sf).select("source_zip", "ord"), ["source_zip", "ord"], 200)


@query(
    "preview_sink",
    """SELECT source AS source_zip, doc_id AS ord, lang AS domain FROM documents
       ORDER BY source, doc_id LIMIT 200""",
)
def _(spark, sf):
    from callsift.sources.sinks import preview

    return preview(v.calls(spark, sf).select("source_zip", "ord", "domain"), ["source_zip", "ord"])


@query(
    "raw_samples",
    """SELECT 'sample_' || lpad(CAST(row_number() OVER (ORDER BY source, doc_id) AS VARCHAR), 4, '0')
       || '__' || CAST(doc_id AS VARCHAR) AS sample, substr(text, 1, 100000) AS text FROM documents
       ORDER BY source, doc_id LIMIT 50""",
)
def _(spark, sf):
    from callsift.sources.sinks import raw_samples

    named = v.calls(spark, sf).select(
        "source_zip",
        "ord",
        F.concat(F.lit("in/"), "file_name", F.lit(".json")).alias("file_name"),
        F.col("full_text").alias("text"),
    )
    return raw_samples(named, ["source_zip", "ord"])
