"""Tokens, term statistics, TF-IDF and clustering."""

from __future__ import annotations

from pyspark.sql import functions as F

from callsift.functions import lexicons as lex
from callsift.functions import text
from callsift.operators import clusters as clu
from callsift.operators import terms as ops
from callsift.operators.ranking import top_k_per_group
from callsift.session import written
from checks import sql as q
from checks import views as v
from checks.registry import query



def toks(x: str) -> str:
    return f"regexp_extract_all(lower({x}), '[{q.W}]{{2,}}')"


def kept_tokens(x: str, stops) -> str:
    return f"list_filter({toks(x)}, lambda t: NOT list_contains({q.quoted(stops)}, t))"


def term_ctes(source: str, key: str, x: str, stops) -> str:
    """terms(key, term), one row per occurrence of a unigram or bigram."""
    return f"""toks AS (SELECT {key}, {kept_tokens(x, stops)} AS w FROM {source}),
terms AS (
  SELECT {key}, unnest(w) AS term FROM toks
  UNION ALL
  SELECT {key}, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM toks
  WHERE len(w) > 1),
tf AS (SELECT {key}, term, count(*) AS tf FROM terms GROUP BY {key}, term),
stats AS (SELECT term, CAST(sum(tf) AS BIGINT) AS cf, count(*) AS df FROM tf GROUP BY term)"""


@query(
    "tokens",
    f"""SELECT doc_id, CAST(len(w) AS BIGINT) AS n, sha256(array_to_string(w, ' ')) AS digest
        FROM (SELECT doc_id, {toks('text')} AS w FROM documents)""",
)
def _(spark, sf):
    w = v.documents(spark, sf).select("doc_id", text.tokens("text").alias("w"))
    return w.select(
        "doc_id", F.size("w").cast("long").alias("n"), F.sha2(F.array_join("w", " "), 256).alias("digest")
    )


@query(
    "remove_stops",
    f"""SELECT doc_id, sha256(array_to_string({kept_tokens('text', lex.DISCOVERY_STOPS)}, ' ')) AS digest
        FROM documents""",
)
def _(spark, sf):
    w = text.remove_stops(text.tokens("text"), lex.DISCOVERY_STOPS)
    return v.documents(spark, sf).select("doc_id", F.sha2(F.array_join(w, " "), 256).alias("digest"))


@query(
    "ngrams",
    f"""SELECT doc_id, sha256(array_to_string(list_concat(w, list_transform(range(1, len(w)),
          lambda i: w[i] || ' ' || w[i + 1])), '|')) AS digest
        FROM (SELECT doc_id, {toks('text')} AS w FROM documents)""",
)
def _(spark, sf):
    w = v.documents(spark, sf).select("doc_id", text.tokens("text").alias("w"))
    return w.select("doc_id", F.sha2(F.array_join(text.ngrams("w"), "|"), 256).alias("digest"))


@query(
    "term_stats",
    f"WITH {term_ctes('documents', 'doc_id', 'text', lex.ENGLISH_STOPS)} SELECT * FROM stats",
)
def _(spark, sf):
    docs = ops.with_terms(v.documents(spark, sf).select("text"), "text", lex.ENGLISH_STOPS)
    return ops.term_stats(docs)


@query(
    "doc_freq_filter",
    f"""WITH {term_ctes('documents', 'doc_id', 'text', lex.DISCOVERY_STOPS)}
        SELECT * FROM stats WHERE df >= 5 AND df <= 0.6::DOUBLE * (SELECT count(*) FROM documents)
        ORDER BY cf DESC, term LIMIT 3000""",
)
def _(spark, sf):
    docs = v.documents(spark, sf).select("text")
    n_docs = docs.agg(F.count("*")).scalar()
    stats = ops.term_stats(ops.with_terms(docs, "text", lex.DISCOVERY_STOPS))
    return ops.vocabulary(stats, n_docs, 5, 0.6, 3000)


@query(
    "top_terms",
    f"""WITH {term_ctes('documents', 'doc_id', 'text', lex.ENGLISH_STOPS)}
        SELECT term, cf AS count FROM stats WHERE df >= 5 ORDER BY cf DESC, term LIMIT 50""",
)
def _(spark, sf):
    return ops.top_terms(v.documents(spark, sf), "text", 50, lex.ENGLISH_STOPS)


UNIQUE_TURNS = "SELECT conv_id * 1000 + turn AS id, text FROM conversations"
TFIDF = f"""src AS ({UNIQUE_TURNS}),
{term_ctes('src', 'id', 'text', lex.DISCOVERY_STOPS)},
vocab AS (SELECT term, ln((1 + n) / (1 + df)::DOUBLE) + 1 AS idf
          FROM stats, (SELECT count(*)::DOUBLE AS n FROM src) WHERE df >= 5 AND df <= 0.6::DOUBLE * n
          ORDER BY cf DESC, term LIMIT 4000),
raw AS (SELECT id, term, tf * idf AS w FROM tf JOIN vocab USING (term)),
weights AS (SELECT id, term, w / sqrt(sum(w * w) OVER (PARTITION BY id)) AS weight FROM raw)"""


def turn_texts(spark, sf):
    return v.table(spark, sf, "conversations").select(
        (F.col("conv_id") * 1000 + F.col("turn")).alias("id"), "conv_id", "text"
    )


def turn_model(spark, sf):
    return ops.fit_tfidf(turn_texts(spark, sf), "text", lex.DISCOVERY_STOPS, 5, 0.6, 4000)


@query("tfidf", f"WITH {TFIDF} SELECT id, term, round(weight, 6) AS weight FROM weights")
def _(spark, sf):
    model = turn_model(spark, sf)
    long = ops.weights_long(model.transform(turn_texts(spark, sf)), model, ["id"])
    return long.withColumn("weight", F.round("weight", 6))


TOP = f"""{TFIDF},
assigned AS (SELECT id, CAST((id // 1000) % 7 AS INTEGER) AS cluster_id FROM src),
sizes AS (SELECT cluster_id, count(*) AS size FROM assigned GROUP BY 1),
means AS (SELECT cluster_id, term, sum(weight) / any_value(size) AS mean_weight
          FROM weights JOIN assigned USING (id) JOIN sizes USING (cluster_id) GROUP BY cluster_id, term),
top AS (SELECT *, row_number() OVER (PARTITION BY cluster_id ORDER BY round(mean_weight, 9) DESC, term) AS rank
        FROM means QUALIFY rank <= 12)"""


@query(
    "cluster_top_terms",
    f"WITH {TOP} SELECT cluster_id, term, rank, round(mean_weight, 6) AS mean_weight FROM top",
)
def _(spark, sf):
    model = turn_model(spark, sf)
    assigned = model.transform(turn_texts(spark, sf)).withColumn(
        "cluster_id", (F.col("conv_id") % 7).cast("int")
    )
    top = ops.cluster_top_terms(assigned, model)
    return top.withColumn("mean_weight", F.round("mean_weight", 6))


@query(
    "top_k_terms",
    f"""WITH {q.CALLS}, {q.CLUSTERED}, t AS (SELECT cluster_id, unnest({toks('utterance')}) AS term
          FROM clustered), n AS (SELECT cluster_id, term, count(*) AS n FROM t GROUP BY ALL)
        SELECT cluster_id, term, n, row_number() OVER (PARTITION BY cluster_id ORDER BY n DESC, term) AS rank
        FROM n QUALIFY rank <= 12""",
)
def _(spark, sf):
    words = v.labelled_clusters(spark, sf).select(
        "cluster_id", F.explode(text.tokens("utterance")).alias("term")
    )
    counts = words.groupBy("cluster_id", "term").agg(F.count("*").alias("n"))
    return top_k_per_group(
        counts, ["cluster_id"], [F.desc("n"), F.col("term")], 12, rank="rank"
    )


@query(
    "head_per_cluster",
    f"""WITH {q.CALLS}, {q.CLUSTERED} SELECT cluster_id, ord, pos, utterance,
        row_number() OVER (PARTITION BY cluster_id ORDER BY source_zip, ord, pos) AS rank FROM clustered
        QUALIFY rank <= 10""",
)
def _(spark, sf):
    return clu.head_per_cluster(
        v.labelled_clusters(spark, sf), ["source_zip", "ord", "pos"], 10
    ).select("cluster_id", "ord", "pos", "utterance", "rank")


@query(
    "silhouette",
    """WITH s AS (SELECT * FROM embeddings ORDER BY sha256('42|' || vec_id) LIMIT 5000),
        p AS (SELECT a.vec_id, a.label, b.label AS other, b.vec_id AS bid,
          sqrt(list_sum(list_transform(list_zip(a.embedding, b.embedding),
               lambda z: (z[1]::DOUBLE - z[2]::DOUBLE) * (z[1]::DOUBLE - z[2]::DOUBLE)))) AS d
        FROM s a, s b),
        m AS (SELECT vec_id, label, other, sum(d) AS s, count(*) AS n FROM p GROUP BY ALL),
        ab AS (SELECT vec_id, label, max(CASE WHEN other = label THEN s / greatest(n - 1, 1) END) AS a,
                      max(CASE WHEN other = label THEN n END) AS own,
                      min(CASE WHEN other <> label THEN s / n END) AS b FROM m GROUP BY vec_id, label)
        SELECT vec_id, CAST(label AS BIGINT) AS label,
               round(CASE WHEN own = 1 THEN 0 ELSE (b - a) / greatest(a, b) END, 5) AS silhouette FROM ab""",
)
def _(spark, sf):
    e = v.table(spark, sf, "embeddings")
    scored = clu.silhouette(e, ["vec_id"], label="label", col="embedding")
    return scored.withColumn("silhouette", F.round("silhouette", 5))


def vectors(spark, sf):
    from pyspark.ml.functions import array_to_vector

    return v.table(spark, sf, "embeddings").select(
        "vec_id", "embedding", array_to_vector(F.col("embedding").cast("array<double>")).alias("features")
    )


def distances(embedding, model):
    """Squared distances to all centres, by Spark's own functions."""
    values = F.col(embedding).cast("array<double>")

    def to(centre):
        gaps = F.zip_with(values, F.array(*map(F.lit, centre)), lambda x, y: (x - y) * (x - y))
        return F.aggregate(gaps, F.lit(0.0), lambda a, x: a + x)

    return F.array(*[to(c) for c in model.centres.tolist()])


# Which clusters are found depends on the starts; what must hold of any result is compared: every row is with
# its nearest centre, and no centre is off the mean of its rows.
@query("kmeans", "SELECT vec_id, true AS is_nearest, true AS centre_is_mean FROM embeddings")
def _(spark, sf):
    model = clu.kmeans_best(vectors(spark, sf), k=10)
    rows = written(model.transform(vectors(spark, sf)).withColumn("far", distances("embedding", model)))
    places = rows.select("cluster_id", F.posexplode(F.col("embedding").cast("array<double>")))
    means = places.groupBy("cluster_id", "pos").agg(F.avg("col").alias("mean"))
    centre = F.array(*[F.array(*map(F.lit, c)) for c in model.centres.tolist()])
    off = means.groupBy("cluster_id").agg(
        F.sum(F.pow(F.col("mean") - centre[F.col("cluster_id")][F.col("pos")], 2)).alias("off")
    )
    return rows.join(off, "cluster_id").select(
        "vec_id",
        (F.col("far")[F.col("cluster_id")] <= F.array_min("far") + 1e-9).alias("is_nearest"),
        (F.col("off") <= 1e-8).alias("centre_is_mean"),  # the tolerance, squared
    )


@query(
    "choose_k",
    """SELECT k::INT AS k, true AS is_scored, true AS is_beaten, 1::BIGINT AS n_chosen FROM range(10, 29) AS t(k)""",
)
def _(spark, sf):
    found = clu.choose_k(vectors(spark, sf), ["vec_id"])
    rows = [(k, s is not None and -1 <= s <= 1, s <= found.scores[found.k], k == found.k) for k, s in found.scores.items()]
    table = spark.createDataFrame(rows, "k int, is_scored boolean, is_beaten boolean, chosen boolean")
    n = table.agg(F.count_if("chosen").alias("n_chosen"))
    return table.drop("chosen").crossJoin(n)
