"""Counts, statistics, set tests and reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from callsift.functions.text import has_word
from callsift.operators import reports as rep
from callsift.operators.catalog import ids_outside
from callsift.operators.utterances import not_in_base
from checks import sql as q
from checks import views as v
from checks.q_calls import TEXTS, _texts
from checks.registry import query

_STATS = """SELECT '{c}' AS measure, count(*) AS count, round(avg({c}), 6) AS mean,
  round(stddev_samp({c}), 6) AS std, CAST(min({c}) AS BIGINT) AS min, quantile_cont({c}, 0.25) AS p25,
  quantile_cont({c}, 0.5) AS p50, quantile_cont({c}, 0.75) AS p75, CAST(max({c}) AS BIGINT) AS max
  FROM turn_calls"""


@query(
    "describe",
    f"WITH {TEXTS} {_STATS.format(c='n_turns')} UNION ALL {_STATS.format(c='n_customer_turns')}",
)
def _(spark, sf):
    return (
        rep.describe(_texts(spark, sf), ["n_turns", "n_customer_turns"])
        .withColumn("mean", F.round("mean", 6))
        .withColumn("std", F.round("std", 6))
    )


@query(
    "customer_text_rate",
    f"""WITH {TEXTS} SELECT round(avg(CASE WHEN customer_text <> '' THEN 1.0::DOUBLE ELSE 0 END), 9)
        AS customer_text_rate FROM turn_calls""",
)
def _(spark, sf):
    return rep.customer_text_rate(_texts(spark, sf)).select(
        F.round("customer_text_rate", 9).alias("customer_text_rate")
    )


_LEN = """SELECT '{c}' AS measure, round(avg(length(coalesce({c}, ''))), 6) AS mean,
  quantile_cont(length(coalesce({c}, '')), 0.5) AS median,
  quantile_cont(length(coalesce({c}, '')), 0.9) AS p90 FROM half_calls"""


@query(
    "length_stats",
    f"""WITH {q.CALLS}, {q.HALF_CALLS} {_LEN.format(c='customer_text')}
        UNION ALL {_LEN.format(c='full_text')}""",
)
def _(spark, sf):
    texts = {c: F.col(c) for c in ("customer_text", "full_text")}
    return rep.length_stats(v.half_calls(spark, sf), texts).withColumn("mean", F.round("mean", 6))


@query(
    "top_values",
    """SELECT CASE WHEN lang = 'es' THEN NULL ELSE lang || '/' || source END AS value, count(*) AS count
       FROM documents GROUP BY 1 ORDER BY 2 DESC, 1 NULLS FIRST LIMIT 10""",
)
def _(spark, sf):
    tagged = v.documents(spark, sf).select(
        F.when(F.col("lang") != "es", F.concat("lang", F.lit("/"), "source")).alias("tag")
    )
    return rep.top_values(tagged, "tag", 10)


@query(
    "keep_counters",
    f"""SELECT count(*) AS checked, count(*) FILTER (hit) AS kept, count(*) FILTER (NOT hit) AS skipped
        FROM (SELECT {q.word('text', v.DOMAIN_WORDS)} AS hit FROM documents)""",
)
def _(spark, sf):
    return rep.keep_counters(v.documents(spark, sf), has_word("text", v.DOMAIN_WORDS))


@query(
    "count_per_intent",
    f"WITH {q.UTT} SELECT intent_id, count(utterance) AS count FROM utt GROUP BY intent_id",
)
def _(spark, sf):
    return rep.count_per_intent(v.utterances(spark, sf))


@query(
    "question_ratio",
    f"""WITH {q.UTT} SELECT intent_id, round(avg(CASE WHEN suffix({q.strip('utterance')}, '?')
        THEN 1.0::DOUBLE ELSE 0 END), 3) AS question_ratio FROM utt GROUP BY intent_id""",
)
def _(spark, sf):
    return rep.question_ratio(v.utterances(spark, sf))


@query(
    "min_check",
    f"""WITH {q.UTT} SELECT intent_id, count(*) AS count FROM utt GROUP BY intent_id
        HAVING count(*) < 1000""",
)
def _(spark, sf):
    return rep.below_minimum(v.utterances(spark, sf), 1000)


@query(
    "before_after",
    f"""WITH {q.UTT}, t AS (SELECT * FROM (VALUES ('ach', 50), ('que', 40), ('rare', 30), ('dated', 25))
          AS x(intent_id, target))
        SELECT t.intent_id, count(u.utterance) FILTER (u.ord % 2 = 0) AS before,
               count(u.utterance) AS after, CAST(max(target) AS BIGINT) AS target
        FROM t LEFT JOIN utt u USING (intent_id) GROUP BY t.intent_id""",
)
def _(spark, sf):
    u = v.utterances(spark, sf)
    return rep.before_after(u.where(F.col("ord") % 2 == 0), u, v.TARGETS)


@query(
    "column_profile",
    """SELECT 'conv_id' AS "column", false AS is_metadata, false AS is_text_like, count(conv_id) AS non_null,
         min(length(CAST(conv_id AS VARCHAR))) AS min_length, max(length(CAST(conv_id AS VARCHAR))) AS max_length
         FROM conversations
       UNION ALL SELECT 'turn', false, false, count(turn), min(length(CAST(turn AS VARCHAR))),
         max(length(CAST(turn AS VARCHAR))) FROM conversations
       UNION ALL SELECT 'topic', true, false, count(role), min(length(role)), max(length(role)) FROM conversations
       UNION ALL SELECT 'text', false, true, count(text), min(length(text)), max(length(text))
         FROM conversations""",
)
def _(spark, sf):
    return rep.column_profile(
        v.table(spark, sf, "conversations").withColumnRenamed("role", "topic")
    )


@query(
    "describe_ids",
    """SELECT 'vec_id' AS measure, count(vec_id) AS count, avg(vec_id) AS mean, stddev_samp(vec_id) AS std,
       min(vec_id) AS min, quantile_cont(vec_id, 0.25) AS p25, quantile_cont(vec_id, 0.5) AS p50,
       quantile_cont(vec_id, 0.75) AS p75, max(vec_id) AS max FROM embeddings""",
)
def _(spark, sf):
    return rep.describe(v.table(spark, sf, "embeddings"), ["vec_id"])


@query(
    "preview_rows",
    """SELECT CAST(conv_id AS VARCHAR) AS conv_id, CAST(turn AS VARCHAR) AS turn, role,
       CASE WHEN length(text) > 250 THEN substr(text, 1, 250) || ' ...' ELSE text END AS text
       FROM conversations ORDER BY conversations.conv_id, conversations.turn LIMIT 3""",
)
def _(spark, sf):
    return rep.preview_rows(v.table(spark, sf, "conversations"), ["conv_id", "turn"])


# --- joins and set tests ------------------------------------------------------------------------


@query(
    "leaked_pairs",
    f"""WITH {q.UTT} SELECT {q.pair('intent_id', 'utterance')} AS key FROM utt WHERE ord % 2 = 0
        INTERSECT SELECT {q.pair('intent_id', 'utterance')} FROM utt WHERE ord % 2 = 1""",
)
def _(spark, sf):
    u = v.utterances(spark, sf)
    return rep.leaked_pairs(u.where(F.col("ord") % 2 == 0), u.where(F.col("ord") % 2 == 1))


@query(
    "leaked_benchmark_lines",
    f"""WITH b AS (SELECT DISTINCT unnest({q.sentence_list('text', 5, 400)}) AS u FROM benchmark),
             d AS (SELECT DISTINCT unnest({q.sentence_list('text', 5, 400)}) AS u FROM documents)
        SELECT DISTINCT 'line||' || {q.strip('lower(u)')} AS key FROM b
        INTERSECT SELECT DISTINCT 'line||' || {q.strip('lower(u)')} FROM d""",
)
def _(spark, sf):
    from callsift.functions.text import sentences

    def lines(df):
        return df.select(
            F.lit("line").alias("intent_id"), F.explode(sentences("text", 5, 400)).alias("utterance")
        )

    return rep.leaked_pairs(
        lines(v.documents(spark, sf)), lines(v.table(spark, sf, "benchmark"))
    )


@query(
    "not_in_base",
    f"""WITH {q.UTT}, {q.BASE} SELECT u.ord, u.pos, u.intent_id FROM utt u WHERE NOT EXISTS (
        SELECT 1 FROM base b WHERE b.intent_id = u.intent_id
        AND {q.strip('lower(b.utterance)')} = lower(u.utterance))""",
)
def _(spark, sf):
    return not_in_base(v.utterances(spark, sf), v.base_utterances(spark, sf)).select(
        "ord", "pos", "intent_id"
    )


@query(
    "subset_test",
    f"""WITH {q.UTT} SELECT DISTINCT intent_id FROM utt
        EXCEPT SELECT DISTINCT intent_id FROM utt WHERE ord % 50 = 0 AND pos < 3""",
)
def _(spark, sf):
    u = v.utterances(spark, sf)
    return ids_outside(u, u.where((F.col("ord") % 50 == 0) & (F.col("pos") < 3)))


_PREDICTED = """p AS (
  SELECT d.doc_id, CASE WHEN l.quality = 1 THEN 'good' WHEN l.toxic = 1 THEN 'toxic' ELSE 'poor' END AS label,
         CASE WHEN d.lang = 'xx' THEN 'never' WHEN d.n_chars > 1500 THEN 'good' WHEN d.lang = 'en' THEN 'poor'
              ELSE 'unseen' END AS prediction
  FROM documents d JOIN labels l USING (doc_id))"""


@query(
    "classification_report",
    f"""WITH {_PREDICTED},
    c AS (SELECT DISTINCT label AS class FROM p UNION SELECT DISTINCT prediction FROM p),
    s AS (SELECT class, (SELECT count(*) FROM p WHERE label = class) AS support,
                 (SELECT count(*) FROM p WHERE prediction = class) AS predicted,
                 (SELECT count(*) FROM p WHERE prediction = class AND label = class) AS tp FROM c),
    r AS (SELECT class, support, tp,
                 CASE WHEN predicted > 0 THEN tp / predicted ELSE 0 END AS precision,
                 CASE WHEN support > 0 THEN tp / support ELSE 0 END AS recall,
                 CASE WHEN support + predicted > 0 THEN 2 * tp / (support + predicted) ELSE 0 END AS f1 FROM s)
    SELECT class, round(precision, 3) AS precision, round(recall, 3) AS recall, round(f1, 3) AS f1, support FROM r
    UNION ALL SELECT 'accuracy', NULL, NULL, round(sum(tp) / sum(support), 4), CAST(sum(support) AS BIGINT) FROM r
    UNION ALL SELECT 'macro avg', round(avg(precision), 3), round(avg(recall), 3), round(avg(f1), 3),
              CAST(sum(support) AS BIGINT) FROM r
    UNION ALL SELECT 'weighted avg', round(sum(precision * support) / sum(support), 3),
              round(sum(recall * support) / sum(support), 3), round(sum(f1 * support) / sum(support), 3),
              CAST(sum(support) AS BIGINT) FROM r""",
)
def _(spark, sf):
    docs = v.table(spark, sf, "documents").select("doc_id", "lang", "n_chars")
    truth = docs.join(v.table(spark, sf, "labels"), "doc_id")
    label = (
        F.when(F.col("quality") == 1, "good").when(F.col("toxic") == 1, "toxic").otherwise("poor")
    )
    guess = (
        F.when(F.col("n_chars") > 1500, "good")
        .when(F.col("lang") == "en", "poor")
        .otherwise("unseen")
    )
    return rep.classification_report(truth.select(label.alias("label"), guess.alias("prediction")))
