"""Catalog: clusters of a fixed assignment, suggestions, overrides, scaffolds, checks, exports."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from callsift.operators import catalog as ops
from callsift.operators import clusters as clu
from callsift.operators.ranking import top_k_per_group
from callsift.functions.text import tokens
from callsift.plans import jobs
from callsift.sources import sinks, tables
from callsift.sources.rules import overrides_table
from callsift.session import written, fresh_path
from checks import sql as q
from checks import views as v
from checks.q_terms import toks
from checks.registry import query

OVERRIDES = [
    {"cluster_id": 3, "suggested_intent": "Profile Update!", "intent_id": "Profile Update!", "answerable": True,
     "handoff_reason": ""},
    {"cluster_id": 5, "suggested_intent": "small_talk", "intent_id": "noise small-talk", "answerable": False,
     "handoff_reason": "Not a task."},
    {"cluster_id": 7, "answerable": False},
    {"cluster_id": 9, "intent_id": "", "suggested_intent": "", "handoff_reason": None},
    {"cluster_id": 11, "suggested_intent": "first", "answerable": True},
    {"cluster_id": 11, "suggested_intent": "second", "intent_id": "noise small-talk", "answerable": False},
    {"cluster_id": 13, "answerable": None, "handoff_reason": "unset"},
]


def _sql_overrides() -> str:
    def lit(x):
        return "NULL" if x is None else str(x).lower() if isinstance(x, bool) else f"'{x}'"

    rows = ", ".join(
        f"({o['cluster_id']}, {lit(o.get('intent_id'))}, {lit(o.get('suggested_intent'))}, "
        f"{lit(o.get('answerable'))}, {lit(o.get('handoff_reason'))}, {lit('answerable' in o)}, "
        f"{lit('handoff_reason' in o)}, {n})"
        for n, o in enumerate(OVERRIDES)
    )
    return f"""ov AS (SELECT * FROM (VALUES {rows}) AS x(cluster_id, o_id, o_name, o_flag, o_reason, has_flag,
      has_reason, row) QUALIFY row_number() OVER (PARTITION BY cluster_id ORDER BY row DESC) = 1)"""


_SLUG = "coalesce(nullif(trim(regexp_replace(lower(trim({})), '[^a-z0-9]+', '_', 'g'), '_'), ''), 'misc')"
SUGGEST = """CASE WHEN regexp_matches(t5, 'heit|keit') THEN 'german_nouns' WHEN regexp_matches(t5, 'la.*que')
  THEN 'french' WHEN regexp_matches(t5, 'der|die') THEN 'german' ELSE coalesce(nullif(t2, ''), 'misc') END"""
SUGGEST_RULES = (("heit|keit", "german_nouns"), ("la.*que", "french"), ("der|die", "german"))

# term lists are long words by frequency, so that clusters differ
CLUSTERS = f"""{q.CALLS}, {q.CLUSTERED},
words AS (SELECT cluster_id, unnest({toks('utterance')}) AS term FROM clustered),
word_counts AS (SELECT cluster_id, term, count(*) AS n FROM words WHERE length(term) > 5 GROUP BY ALL),
best AS (SELECT *, row_number() OVER (PARTITION BY cluster_id ORDER BY n DESC, term) AS rank FROM word_counts
         QUALIFY rank <= 12),
terms AS (SELECT cluster_id, list(term ORDER BY rank) AS top_terms FROM best GROUP BY 1),
heads AS (SELECT *, row_number() OVER (PARTITION BY cluster_id ORDER BY source_zip, ord, pos) AS rank
          FROM clustered QUALIFY rank <= 10),
examples AS (SELECT cluster_id, list(utterance ORDER BY rank) AS examples FROM heads GROUP BY 1),
clusters AS (
  SELECT s.cluster_id, s.size, t.top_terms, CASE WHEN s.cluster_id = 17 THEN [] ELSE e.examples END AS examples
  FROM (SELECT cluster_id, count(*) AS size FROM clustered GROUP BY 1) s
  JOIN terms t USING (cluster_id) JOIN examples e USING (cluster_id)),
suggested AS (SELECT cluster_id, {SUGGEST} AS suggested_intent FROM (SELECT cluster_id,
    array_to_string(top_terms[1:5], ' ') AS t5, array_to_string(top_terms[1:2], '_') AS t2 FROM clusters))"""

CATALOG = f"""{CLUSTERS}, {_sql_overrides()},
drafts AS (SELECT c.*, suggested_intent, {_SLUG.format('suggested_intent')} || '__c' ||
             CAST(cluster_id AS VARCHAR) AS intent_id
           FROM clusters c JOIN suggested USING (cluster_id)),
catalog AS (
  SELECT CASE WHEN o_id <> '' THEN {_SLUG.format('o_id')} ELSE intent_id END AS intent_id, cluster_id,
         CASE WHEN o_name <> '' THEN o_name ELSE suggested_intent END AS intent_name, size,
         CASE WHEN has_flag THEN coalesce(o_flag, false) ELSE true END AS answerable,
         CASE WHEN has_reason THEN o_reason ELSE '' END AS handoff_reason, top_terms, examples
  FROM drafts LEFT JOIN ov USING (cluster_id))"""


def clusters(spark, sf):
    rows = v.labelled_clusters(spark, sf)
    words = (
        rows.select("cluster_id", F.explode(tokens("utterance")).alias("term"))
        .where(F.length("term") > 5)
        .groupBy("cluster_id", "term")
        .agg(F.count("*").alias("n"))
    )
    top = top_k_per_group(words, ["cluster_id"], [F.desc("n"), F.col("term")], 12, rank="rank")
    summary = clu.cluster_summary(rows, top, ["source_zip", "ord", "pos"])
    none = F.array().cast("array<string>")
    shown = F.when(F.col("cluster_id") == 17, none).otherwise(F.col("examples"))
    return written(summary.withColumn("examples", shown))  # one row per cluster


def suggestions(cl):
    from callsift.functions.rules import suggest_intent

    return cl.select("cluster_id", suggest_intent("top_terms", SUGGEST_RULES).alias("suggested_intent"))


def catalog(spark, sf):
    cl = clusters(spark, sf)
    return jobs.curate_catalog(cl, suggestions(cl), overrides_table(spark, OVERRIDES))


def joined(df, *cols):
    for c in cols:
        df = df.withColumn(c, F.array_join(c, "\n"))
    return df


_JOIN = "array_to_string({c}, chr(10)) AS {c}"


@query(
    "cluster_summary",
    f"WITH {CLUSTERS} SELECT cluster_id, size, {_JOIN.format(c='top_terms')}, {_JOIN.format(c='examples')} FROM clusters",
)
def _(spark, sf):
    return joined(clusters(spark, sf), "top_terms", "examples")


@query(
    "join_suggestions",
    f"WITH {CLUSTERS} SELECT cluster_id, size, suggested_intent FROM clusters JOIN suggested USING (cluster_id)",
)
def _(spark, sf):
    cl = clusters(spark, sf)
    return ops.join_suggestions(cl, suggestions(cl)).select("cluster_id", "size", "suggested_intent")


@query(
    "curate_catalog",
    f"""WITH {CATALOG} SELECT intent_id, cluster_id, intent_name, size, answerable, handoff_reason,
        {_JOIN.format(c='top_terms')}, {_JOIN.format(c='examples')} FROM catalog""",
)
def _(spark, sf):
    return joined(catalog(spark, sf), "top_terms", "examples")


@query(
    "stable_sort",
    f"""WITH {CATALOG} SELECT row_number() OVER (ORDER BY size DESC, cluster_id) AS place, cluster_id
        FROM catalog""",
)
def _(spark, sf):
    # the place in the written order; a catalog has one row per cluster
    order = Window.orderBy(F.desc("size"), "cluster_id")
    return catalog(spark, sf).select(
        F.row_number().over(order).cast("long").alias("place"), "cluster_id"
    )


@query(
    "split_answerable",
    f"WITH {CATALOG} SELECT cluster_id, CASE WHEN answerable THEN 'bot' ELSE 'human' END AS route FROM catalog",
)
def _(spark, sf):
    bot, human = ops.split_answerable(catalog(spark, sf))
    return bot.select("cluster_id", F.lit("bot").alias("route")).unionByName(
        human.select("cluster_id", F.lit("human").alias("route"))
    )


EXAMPLES = f"""{CATALOG}, ex AS (SELECT *, unnest(CASE WHEN len(examples) = 0 THEN [''] ELSE examples[1:3] END)
   AS sample_question FROM catalog)"""


@query(
    "explode_examples",
    f"WITH {EXAMPLES} SELECT cluster_id, sample_question FROM ex",
)
def _(spark, sf):
    return ops.explode_examples(catalog(spark, sf)).select("cluster_id", "sample_question")


GOLD = """SELECT intent_id, intent_name, cluster_id, sample_question, '' AS gold_answer, '' AS source_refs,
  '' AS policy_notes FROM ex WHERE answerable"""
HANDOFF = """SELECT intent_id, intent_name, cluster_id, sample_question, coalesce(handoff_reason, '')
  AS handoff_reason, 'human_agent' AS handoff_destination FROM ex WHERE NOT answerable"""


@query("gold_todo", f"WITH {EXAMPLES} {GOLD}")
def _(spark, sf):
    return jobs.gold_scaffold(catalog(spark, sf))[0]


@query("handoff_list", f"WITH {EXAMPLES} {HANDOFF}")
def _(spark, sf):
    return jobs.gold_scaffold(catalog(spark, sf))[1]


@query(
    "validate_catalog",
    f"""WITH {EXAMPLES}, gold AS ({GOLD}), handoff AS ({HANDOFF})
    SELECT 'gold_columns' AS "check", true AS ok, 0::BIGINT AS bad_rows
    UNION ALL SELECT 'handoff_columns', false, 1
    UNION ALL SELECT 'gold_ids_answerable', count(*) = 0, count(*) FROM (SELECT intent_id FROM gold UNION
      SELECT intent_id FROM handoff WHERE cluster_id = 5 EXCEPT SELECT intent_id FROM catalog WHERE answerable)
    UNION ALL SELECT 'handoff_ids_not_answerable', count(*) = 0, count(*) FROM (SELECT intent_id FROM handoff
      EXCEPT SELECT intent_id FROM catalog WHERE NOT answerable)""",
)
def _(spark, sf):
    cat = catalog(spark, sf)
    gold, handoff = jobs.gold_scaffold(cat)
    wrong = handoff.where(F.col("cluster_id") == 5).select(
        "intent_id",
        "intent_name",
        "cluster_id",
        "sample_question",
        *[F.lit("").alias(f) for f in ops.GOLD_FIELDS],
    )
    return jobs.validate_catalog(
        cat, gold.unionByName(wrong), handoff.drop("handoff_destination")
    )


@query(
    "catalog_counts",
    f"""WITH {CATALOG} SELECT count(*) AS entries, count(DISTINCT intent_id) FILTER (answerable) AS answerable_ids,
        count(DISTINCT intent_id) FILTER (NOT answerable) AS handoff_ids FROM catalog""",
)
def _(spark, sf):
    return ops.catalog_counts(catalog(spark, sf))


@query(
    "training_rows",
    f"""WITH {CATALOG} SELECT intent_id, intent_name, cluster_id, unnest(range(len(examples))) AS pos,
        {q.squash('unnest(examples)')} AS utterance FROM catalog WHERE answerable""",
)
def _(spark, sf):
    return jobs.export_training(catalog(spark, sf))["utterances"]


@query(
    "training_pack",
    f"""WITH {CATALOG} SELECT intent_id, cluster_id, intent_name AS name, array_to_string(list_filter(
        list_transform(examples, lambda x: {q.squash('x')}), lambda x: x <> ''), chr(10)) AS samples
        FROM catalog WHERE answerable""",
)
def _(spark, sf):
    path = fresh_path(spark, "pack")
    sinks.write_pack(jobs.export_training(catalog(spark, sf))["pack"], path)
    packs = tables.read_jsonl(
        spark, path, "intent_id string, cluster_id int, name string, samples array<string>"
    )
    return joined(packs, "samples")


@query(
    "handoff_routes",
    f"""WITH {CATALOG} SELECT intent_id, cluster_id, intent_name AS name, coalesce(handoff_reason, '') AS reason
        FROM catalog WHERE NOT answerable""",
)
def _(spark, sf):
    path = fresh_path(spark, "routes")
    sinks.write_jsonl(jobs.export_training(catalog(spark, sf))["handoff"], path)
    return tables.read_jsonl(
        spark, path, "intent_id string, cluster_id int, name string, reason string"
    )


@query(
    "gold_filled",
    f"""WITH {EXAMPLES}, answered AS (SELECT intent_id, sample_question, CASE cluster_id % 4 WHEN 0 THEN NULL
          WHEN 1 THEN '  ' ELSE ' answer ' || CAST(cluster_id AS VARCHAR) || chr(10) END AS gold_answer
        FROM ex WHERE answerable)
        SELECT intent_id, {q.strip('sample_question')} AS question, {q.strip('gold_answer')} AS gold_answer,
               'kb' AS source_refs, '' AS policy_notes FROM answered WHERE {q.strip('gold_answer')} <> ''""",
)
def _(spark, sf):
    k = F.col("cluster_id") % 4
    gold = (
        jobs.gold_scaffold(catalog(spark, sf))[0]
        .withColumn(
            "gold_answer",
            F.when(k == 1, F.lit("  ")).when(
                k > 1, F.concat(F.lit(" answer "), F.col("cluster_id").cast("string"), F.lit("\n"))
            ),
        )
        .withColumn("source_refs", F.lit(" kb"))
        .withColumn("policy_notes", F.lit(None).cast("string"))
    )
    return ops.gold_filled(gold)
