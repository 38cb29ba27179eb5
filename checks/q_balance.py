"""Labelled utterances: harvest, mix, top-up, caps, splits."""

from __future__ import annotations

from pyspark.sql import functions as F

from callsift.operators import reports as rep
from callsift.operators import utterances as ops
from callsift.operators.ranking import stratified_split
from callsift.plans import jobs
from callsift.session import fresh_path, written
from callsift.sources import sinks, tables
from checks import sql as q
from checks import views as v
from checks.q_text import AGENT_SQL, STRICT_SQL, TOPUP_SQL
from checks.registry import query

ORDER = "source_zip, ord, pos"
FIRSTS = f"""firsts AS (SELECT * FROM utt
  QUALIFY row_number() OVER (PARTITION BY {q.pair('intent_id', 'utterance')} ORDER BY {ORDER}) = 1)"""


@query("dedup_pairs", f"WITH {q.UTT}, {FIRSTS} SELECT {ORDER}, intent_id, utterance FROM firsts")
def _(spark, sf):
    return ops.dedup_pairs(v.utterances(spark, sf), ops.ORDER)


@query(
    "harvest_seeds",
    f"""WITH {q.UTT} SELECT {ORDER}, intent_id, utterance FROM seeded WHERE intent_id IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY intent_id, lower(utterance) ORDER BY {ORDER}) = 1""",
)
def _(spark, sf):
    return jobs.harvest_seeds(v.calls(spark, sf), v.SEEDS)


@query(
    "cap_per_group",
    f"""WITH {q.UTT} SELECT {ORDER}, intent_id FROM utt
        QUALIFY row_number() OVER (PARTITION BY intent_id ORDER BY {ORDER}) <= 150""",
)
def _(spark, sf):
    return ops.cap_per_intent(v.utterances(spark, sf), ops.ORDER).drop("utterance")


@query(
    "whitelist",
    f"WITH {q.UTT} SELECT {ORDER}, intent_id FROM utt WHERE intent_id IN {tuple(v.WHITELIST)}",
)
def _(spark, sf):
    return ops.whitelist(v.utterances(spark, sf), v.WHITELIST).drop("utterance")


@query(
    "clean_rows",
    f"""WITH {q.UTT}, m AS (SELECT ord, pos, CASE WHEN ord % 5 <> 1 THEN ' ' || intent_id END AS intent_id,
          CASE pos % 4 WHEN 1 THEN NULL WHEN 2 THEN '  ab ' ELSE utterance || chr(9) END AS utterance FROM utt)
        SELECT ord, pos, {q.strip('intent_id')} AS intent_id, {q.strip('utterance')} AS utterance FROM m
        WHERE intent_id IS NOT NULL AND utterance IS NOT NULL AND length({q.strip('utterance')}) > 2""",
)
def _(spark, sf):
    k = F.col("pos") % 4
    messy = v.utterances(spark, sf).select(
        "ord",
        "pos",
        F.when(F.col("ord") % 5 != 1, F.concat(F.lit(" "), "intent_id")).alias("intent_id"),
        F.when(k == 2, F.lit("  ab "))
        .when(k != 1, F.concat("utterance", F.lit("\t")))
        .alias("utterance"),
    )
    return ops.clean_rows(messy)


CLEANED = f"""norm AS (SELECT source_zip, ord, pos, intent_id, {q.slots('utterance')} AS utterance FROM utt),
cleaned AS (
  SELECT *, suffix(utterance, '?') AS is_q FROM norm
  WHERE len(list_filter(regexp_split_to_array(utterance, '{q.S}+'), lambda x: x <> '')) >= 3
  AND {STRICT_SQL}
  QUALIFY row_number() OVER (PARTITION BY intent_id, lower(utterance) ORDER BY {ORDER}) = 1)"""


@query(
    "clean_seeds",
    f"WITH {q.UTT}, {CLEANED} SELECT {ORDER}, intent_id, utterance FROM cleaned",
)
def _(spark, sf):
    return ops.clean_seeds(v.utterances(spark, sf), ops.ORDER, v.STRICT)


MIXED = f"""{q.UTT}, {q.BASE}, {CLEANED},
base_set AS (SELECT intent_id, {q.slots('utterance')} AS utterance, min((source_zip, ord, pos)) AS at_row
             FROM base GROUP BY 1, 2),
counters AS (SELECT intent_id, count(*) AS nb, count(*) FILTER (suffix(utterance, '?')) AS qb
             FROM base_set GROUP BY 1),
ranked AS (SELECT c.*, row_number() OVER (PARTITION BY intent_id, is_q ORDER BY {ORDER}) AS r,
                  count(*) FILTER (is_q) OVER (PARTITION BY intent_id) AS nq FROM cleaned c),
staged AS (
  SELECT r.*, greatest(0, 150 - coalesce(nb, 0)) AS room,
         least(nq, greatest(0, 45 - coalesce(qb, 0))) AS q_take FROM ranked r LEFT JOIN counters USING (intent_id)),
pool AS (
  SELECT intent_id, utterance, 0 AS stage, at_row FROM base_set
  UNION ALL
  SELECT intent_id, utterance, CASE WHEN room > 0 AND is_q AND r <= q_take THEN 1
         WHEN room > 0 AND NOT is_q AND r <= room - q_take THEN 2 ELSE 3 END, (source_zip, ord, pos) FROM staged),
single AS (SELECT * FROM pool QUALIFY row_number() OVER (PARTITION BY intent_id, utterance
           ORDER BY stage, at_row) = 1),
placed AS (SELECT *, row_number() OVER (PARTITION BY intent_id ORDER BY stage, at_row) AS rank FROM single),
mixed AS (SELECT intent_id, utterance, rank FROM placed
          WHERE (stage < 3 AND rank <= 150) OR (stage = 3 AND rank <= 50))"""


@query("quota_mix", f"WITH {MIXED} SELECT * FROM mixed")
def _(spark, sf):
    seeds = ops.clean_seeds(v.utterances(spark, sf), ops.ORDER, v.STRICT)
    return ops.quota_mix(
        v.base_utterances(spark, sf), seeds.withColumn("row", F.struct(*ops.ORDER))
    )


# fewer names than intents: an intent without one shows its id
NAMED = f"""{MIXED},
named AS (SELECT m.*, coalesce(n, m.intent_id) AS intent_name FROM mixed m LEFT JOIN
  (SELECT DISTINCT intent_id, intent_name AS n FROM base) USING (intent_id))"""


def merged(spark, sf):
    base = written(v.base_utterances(spark, sf))  # a written table between stages
    return jobs.merge_seeds(base, v.utterances(spark, sf), v.STRICT)


@query("merge_seeds", f"WITH {NAMED} SELECT intent_id, intent_name, utterance, rank FROM named")
def _(spark, sf):
    return merged(spark, sf)


@query(
    "merged_pack",
    f"""WITH {NAMED} SELECT intent_id, any_value(intent_name) AS name,
        string_agg(utterance, chr(10) ORDER BY rank) AS samples FROM named GROUP BY intent_id""",
)
def _(spark, sf):
    packs = ops.pack(merged(spark, sf), ["rank"])
    return packs.withColumn("samples", F.array_join("samples", "\n"))


@query(
    "pack_parts",
    f"""WITH {q.UTT}, placed AS (SELECT *, row_number() OVER (PARTITION BY intent_id ORDER BY {ORDER}) - 1 AS r,
          first_value(utterance) OVER (PARTITION BY intent_id ORDER BY {ORDER}) AS name FROM utt)
        SELECT intent_id, name, r // 100 AS part, string_agg(utterance, chr(10) ORDER BY r) AS samples
        FROM placed GROUP BY ALL""",
)
def _(spark, sf):
    path = fresh_path(spark, "packs")
    rows = v.utterances(spark, sf).withColumn("intent_name", F.col("utterance"))  # the first row's name counts
    sinks.write_pack_parts(ops.pack_parts(rows, ops.ORDER, max_samples=100), path)
    packs = tables.read_jsonl(
        spark, f"{path}/packs", "intent_id string, name string, part long, samples array<string>"
    )
    return packs.withColumn("samples", F.array_join("samples", "\n"))


@query(
    "display_names",
    f"""WITH {q.UTT} SELECT intent_id, max_by('name_' || intent_id || '_' || CAST(ord AS VARCHAR),
        (source_zip, ord, pos)) AS intent_name FROM utt GROUP BY intent_id""",
)
def _(spark, sf):
    several = v.utterances(spark, sf).select(
        "intent_id",
        F.concat(F.lit("name_"), "intent_id", F.lit("_"), F.col("ord").cast("string")).alias("intent_name"),
        "utterance",
        F.struct("source_zip", "ord", "pos").alias("row"),
    )
    return ops.display_names(several)


# --- top-up ----------------------------------------------------------------------------------------

_TARGETS = "(VALUES ('ach', 50), ('que', 40), ('rare', 30), ('dated', 25)) AS x(intent_id, target)"
# a small base, so that every target intent misses some rows
SMALL_BASE = f"""small AS (SELECT intent_id, 'name_' || intent_id AS intent_name, {q.slots('utterance')} AS utterance,
    row_number() OVER (ORDER BY {ORDER}) AS row FROM utt WHERE {q.part(q.SMALL_SHARE)})"""
ADDS = f"""{q.UTT}, {SMALL_BASE},
need AS (SELECT x.intent_id, target - count(s.utterance) AS need FROM {_TARGETS}
         LEFT JOIN small s ON s.intent_id = x.intent_id GROUP BY x.intent_id, target HAVING target > count(s.utterance)),
scan AS (SELECT source_zip, ord, pos, {q.slots('utterance')} AS utterance FROM utt),
hits AS (SELECT {ORDER}, utterance, unnest({TOPUP_SQL}) AS intent_id FROM scan WHERE {AGENT_SQL}),
fresh AS (SELECT h.* FROM hits h JOIN need USING (intent_id)
  WHERE NOT EXISTS (SELECT 1 FROM small s WHERE s.intent_id = h.intent_id AND lower(s.utterance) = lower(h.utterance))
  QUALIFY row_number() OVER (PARTITION BY h.intent_id, lower(h.utterance) ORDER BY {ORDER}) = 1),
adds AS (SELECT intent_id, utterance, row_number() OVER (PARTITION BY intent_id ORDER BY {ORDER}) AS rank
         FROM fresh QUALIFY rank <= (SELECT need FROM need n WHERE n.intent_id = fresh.intent_id))"""


def small_base(spark, sf):
    return numbered_base(v.utterances(spark, sf).where(v.part(q.SMALL_SHARE)))


def numbered_base(kept):
    from pyspark.sql.window import Window

    from callsift.functions.text import normalize_slots

    rows = kept.select(
        "intent_id",
        F.concat(F.lit("name_"), "intent_id").alias("intent_name"),
        normalize_slots("utterance").alias("utterance"),
        F.struct("source_zip", "ord", "pos").alias("at"),
    )
    place = F.row_number().over(Window.partitionBy("intent_id").orderBy("at")).cast("long")
    return written(rows.withColumn("row", place))  # a written table between stages


def scanned(calls):
    """The labelled utterances stand in for the calls' sentences."""
    return calls.select("source_zip", "ord", "pos", "utterance")


@query("topup_rows", f"WITH {ADDS} SELECT * FROM adds")
def _(spark, sf):
    return ops.topup_rows(
        small_base(spark, sf),
        v.utterances(spark, sf),
        v.TOPUPS,
        v.TARGETS,
        v.AGENT_OPENINGS,
        sentences_of=scanned,
    )


TOPPED = f"""{ADDS},
both_parts AS (SELECT intent_id, intent_name, utterance, 0 AS part, row FROM small
         UNION ALL SELECT intent_id, intent_id, utterance, 1, rank FROM adds),
topped AS (SELECT *, row_number() OVER (PARTITION BY intent_id ORDER BY part, row) AS place FROM (
  SELECT * FROM both_parts QUALIFY row_number() OVER (PARTITION BY {q.pair('intent_id', 'utterance')}
  ORDER BY part, row) = 1) QUALIFY place <= 150)"""


def topped(spark, sf, base=None):
    return jobs.top_up(
        base or small_base(spark, sf),
        v.utterances(spark, sf),
        v.TOPUPS,
        v.TARGETS,
        agent_openings=v.AGENT_OPENINGS,
        sentences_of=scanned,
    )


@query("top_up", f"WITH {TOPPED} SELECT intent_id, intent_name, utterance, place AS row FROM topped")
def _(spark, sf):
    return topped(spark, sf)


@query(
    "top_up_counts",
    f"""WITH {TOPPED} SELECT x.intent_id, CAST(target AS BIGINT) AS target,
        (SELECT count(*) FROM small s WHERE s.intent_id = x.intent_id) AS before,
        (SELECT count(*) FROM topped t WHERE t.intent_id = x.intent_id) AS after FROM {_TARGETS}""",
)
def _(spark, sf):
    base = small_base(spark, sf)
    return rep.before_after(base, topped(spark, sf, base), v.TARGETS)


@query(
    "append_without_adds",
    f"""WITH {q.UTT} SELECT intent_id, 'name_' || intent_id AS intent_name, {q.slots('utterance')} AS utterance,
        row_number() OVER (PARTITION BY intent_id ORDER BY {ORDER}) AS row FROM utt""",
)
def _(spark, sf):
    base = numbered_base(v.utterances(spark, sf))
    nothing = base.where(F.lit(False)).select("intent_id", "utterance", F.col("row").alias("rank"))
    return ops.append_and_cap(base, nothing)


# --- whitelist and splits ----------------------------------------------------------------------------

SPLIT = """counts AS (SELECT intent_id, count(*) AS n FROM {t} GROUP BY 1),
totals AS (SELECT sum(n) AS total, CAST(ceil(sum(n) * 0.2::DOUBLE) AS BIGINT) AS n_dev FROM counts),
shares AS (SELECT intent_id, n, CAST((n * n_dev) // total AS BIGINT) AS base_quota, (n * n_dev) % total AS rem, n_dev
           FROM counts, totals),
quotas AS (SELECT intent_id, base_quota + CASE WHEN row_number() OVER (ORDER BY rem DESC, intent_id)
           <= n_dev - sum(base_quota) OVER () THEN 1 ELSE 0 END AS quota FROM shares),
hashed AS (SELECT *, row_number() OVER (PARTITION BY intent_id ORDER BY sha256({h}), {o}) AS hr FROM {t}),
splits AS (SELECT h.*, CASE WHEN hr <= quota THEN 'dev' ELSE 'train' END AS split
           FROM hashed h JOIN quotas USING (intent_id))"""


def split_sql(t: str) -> str:
    return SPLIT.format(
        t=t, h="'42|' || intent_id || '|' || utterance", o="intent_id, utterance"
    )


@query(
    "stratified_split",
    f"""WITH {q.UTT}, {FIRSTS}, {split_sql('firsts')} SELECT intent_id, utterance, split FROM splits""",
)
def _(spark, sf):
    rows = ops.dedup_pairs(v.utterances(spark, sf), ops.ORDER).select("intent_id", "utterance")
    return stratified_split(rows, "intent_id", ["intent_id", "utterance"])


KEPT = f"""{q.UTT}, white AS (SELECT * FROM utt WHERE intent_id IN {tuple(v.WHITELIST)}
   QUALIFY row_number() OVER (PARTITION BY {q.pair('intent_id', 'utterance')} ORDER BY {ORDER}) = 1),
kept AS (SELECT source_zip, ord, pos, intent_id, utterance FROM white
   QUALIFY row_number() OVER (PARTITION BY intent_id ORDER BY {ORDER}) <= 150)"""


def enforced(spark, sf):
    return jobs.enforce_whitelist(v.utterances(spark, sf), ops.ORDER, v.WHITELIST)


@query("enforce_whitelist", f"WITH {KEPT} SELECT {ORDER}, intent_id, utterance FROM kept")
def _(spark, sf):
    return enforced(spark, sf)["utterances"]


@query(
    "whitelist_below_minimum",
    f"WITH {KEPT} SELECT intent_id, count(*) AS count FROM kept GROUP BY 1 HAVING count(*) < 50",
)
def _(spark, sf):
    return enforced(spark, sf)["below_minimum"]


EVAL = f"""{KEPT}, trimmed AS (SELECT * REPLACE ({q.strip('utterance')} AS utterance) FROM kept
   WHERE length({q.strip('utterance')}) > 2), {split_sql('trimmed')}"""


@query(
    "build_eval_sets",
    f"WITH {EVAL} SELECT {ORDER}, intent_id, utterance, split FROM splits",
)
def eval_sets(spark, sf):
    return enforced(spark, sf)["splits"]


def report(spark, sf):
    return jobs.quality_report(eval_sets(spark, sf))


@query(
    "quality_counts",
    f"WITH {EVAL} SELECT split, intent_id, count(*) AS count FROM splits GROUP BY ALL",
)
def _(spark, sf):
    return report(spark, sf)["counts"]


@query(
    "quality_question_ratio",
    f"""WITH {EVAL} SELECT split, intent_id, round(avg(CASE WHEN suffix(utterance, '?') THEN 1.0::DOUBLE
        ELSE 0 END), 3) AS question_ratio FROM splits GROUP BY ALL""",
)
def _(spark, sf):
    return report(spark, sf)["question_ratio"]


@query(
    "quality_placeholders",
    f"""WITH {EVAL} SELECT count(*) FILTER (regexp_matches(utterance, '\\[.+\\]')) AS square_left,
        count(*) FILTER (contains(utterance, '{{date}}')) AS slots_found FROM splits""",
)
def _(spark, sf):
    return report(spark, sf)["placeholders"]


@query(
    "quality_leakage",
    f"""WITH {EVAL} SELECT {q.pair('intent_id', 'utterance')} AS key FROM splits WHERE split = 'train'
        INTERSECT SELECT {q.pair('intent_id', 'utterance')} FROM splits WHERE split = 'dev'""",
)
def _(spark, sf):
    return report(spark, sf)["leakage"]


def classified(spark, sf):
    """Splits are written once, as between the stages of a real run."""
    return jobs.baseline_classifier(written(eval_sets(spark, sf)))


# Another library's classifier cannot be recomputed in SQL; what must hold of any is compared: every dev row
# has one prediction, a trained intent; the report counts the dev rows and beats the commonest intent.
@query(
    "baseline_classifier",
    f"""WITH {EVAL}, dev AS (SELECT intent_id AS class, count(*) AS support FROM splits WHERE split = 'dev' GROUP BY 1)
        SELECT class, support, true AS in_range, NULL::BOOLEAN AS beats_commonest FROM dev UNION ALL
        SELECT 'accuracy', sum(support)::BIGINT, true, true FROM dev""",
)
def _(spark, sf):
    out = classified(spark, sf)
    report = out["report"].where(~F.col("class").isin("macro avg", "weighted avg"))
    commonest = out["predictions"].groupBy("intent_id").count().agg(F.max("count").alias("most"))
    scores = [F.col(c).between(0, 1) for c in ("precision", "recall", "f1")]
    is_total = F.col("class") == "accuracy"
    return report.crossJoin(F.broadcast(commonest)).select(  # one row
        "class",
        F.col("support").cast("long").alias("support"),
        F.when(is_total, F.col("f1").between(0, 1)).otherwise(scores[0] & scores[1] & scores[2]).alias("in_range"),
        F.when(is_total, F.col("f1") > F.col("most") / F.col("support")).alias("beats_commonest"),
    )


@query(
    "predict_intents",
    f"""WITH {EVAL} SELECT {ORDER}, intent_id, true AS is_trained FROM splits WHERE split = 'dev'""",
)
def _(spark, sf):
    splits = written(eval_sets(spark, sf))
    predicted = jobs.baseline_classifier(splits)["predictions"]
    trained = splits.where("split = 'train'").select(F.col("intent_id").alias("prediction")).distinct()
    known = predicted.join(trained.withColumn("is_trained", F.lit(True)), "prediction", "left")
    return known.select(*ops.ORDER, "intent_id", F.coalesce("is_trained", F.lit(False)).alias("is_trained"))
