"""Raw records, archives and table round trips, on data that Spark derives from the tables."""

from __future__ import annotations

import io
import zipfile

import pandas as pd
from pyspark.sql import functions as F

from callsift.plans import jobs
from callsift.session import fresh_path
from callsift.sources import records as rec
from callsift.sources import sinks, tables
from callsift.sources.archives import scan_zip_json
from checks import sql as q
from checks import views as v
from checks.registry import query


def raw_records(spark, sf):
    """Each conversation as one JSON record, in one of four shapes by ``conv_id % 4``."""
    calls = v.turns(spark, sf).groupBy("source_zip", "ord", "file_name").agg(
        F.array_sort(F.collect_list(F.struct("pos", "speaker", "text"))).alias("t")
    )
    kind = F.col("ord") % 4
    said = F.transform("t", lambda t: F.struct(t["speaker"].alias("speaker"), t["text"].alias("text")))
    keyed = F.transform(
        "t", lambda t: F.struct(t["speaker"].alias("role"), t["text"].alias("utterance"))
    )
    plain = F.transform("t", lambda t: t["text"])
    record = F.struct(
        F.when(kind < 2, F.lit("")).otherwise(F.lit("chat")).alias("domain"),
        F.when(kind < 2, F.concat(F.lit("kind"), kind.cast("string"))).alias("industry"),
        F.when(kind == 0, said).alias("turns"),
        F.when(kind == 1, keyed).alias("dialog"),
        F.when(kind == 2, F.array_join(plain, "\n")).alias("transcript"),
        F.when(kind == 3, plain).alias("utterances"),
    )
    # every ninth record is cut off in the middle, so that it cannot be parsed
    whole = F.to_json(record)
    broken = F.substring(whole, F.lit(1), (F.length(whole) / 2).cast("int"))
    return calls.select(
        "source_zip",
        "ord",
        "file_name",
        F.when(F.col("ord") % 9 == 4, broken).otherwise(whole).alias("raw"),
        F.lit(None).cast("string").alias("error"),
    )


GOOD = f"""{q.TURNS.replace(q.clean('text') + ' AS text', 'text')},
good AS (SELECT * FROM turns WHERE ord % 9 <> 4)"""


@query(
    "decode_json",
    f"""WITH {GOOD} SELECT DISTINCT ord, ord % 9 <> 4 AS good FROM turns""",
)
def _(spark, sf):
    good, bad = rec.decode_json(raw_records(spark, sf))
    return good.select("ord", F.lit(True).alias("good")).unionByName(
        bad.select("ord", F.lit(False).alias("good"))
    )


@query(
    "record_metadata",
    f"""WITH {GOOD} SELECT DISTINCT ord, CASE WHEN ord % 4 < 2 THEN 'kind' || CAST(ord % 4 AS VARCHAR)
        ELSE 'chat' END AS domain, CAST(NULL AS VARCHAR) AS topic FROM good""",
)
def _(spark, sf):
    good, _bad = rec.decode_json(raw_records(spark, sf))
    return rec.raw_calls(good).select("ord", "domain", "topic")


@query(
    "plain_text",
    f"""WITH {GOOD} SELECT ord, string_agg(text, chr(10) ORDER BY pos) AS text FROM good GROUP BY ord""",
)
def _(spark, sf):
    good, _bad = rec.decode_json(raw_records(spark, sf))
    return rec.raw_texts(good).select("ord", "text")


TURN_ROWS = f"""{GOOD},
kept AS (SELECT ord, ord % 4 AS kind, pos, CASE WHEN ord % 4 < 2 THEN speaker ELSE '' END AS speaker,
                text FROM good),
listed AS (SELECT ord, row_number() OVER (PARTITION BY ord ORDER BY pos) - 1 AS pos, speaker,
                  {q.clean('text')} AS text FROM kept WHERE kind <> 2 AND {q.strip('text')} <> ''),
cut AS (SELECT ord, list_filter(list_transform(string_split(string_agg(text, chr(10) ORDER BY pos),
          chr(10)), lambda x: {q.clean('x')}), lambda x: x <> '')[1:5000] AS a
        FROM kept WHERE kind = 2 GROUP BY ord),
record_turns AS (
  SELECT * FROM listed
  UNION ALL SELECT ord, unnest(range(len(a))), '', unnest(a) FROM cut)"""


@query("extract_turns", f"WITH {TURN_ROWS} SELECT ord, pos, speaker, text FROM record_turns")
def _(spark, sf):
    good, _bad = rec.decode_json(raw_records(spark, sf))
    return rec.raw_calls(good).select("ord", F.inline("turns"))


def write_archives(spark, sf) -> str:
    """Zip the records, at most 64 per archive, into a fresh folder; returns its glob."""
    out = fresh_path(spark, "archives")
    records = raw_records(spark, sf).withColumn("bucket", F.floor(F.col("ord") / 64))
    grouped = records.groupBy("bucket").agg(
        F.array_sort(F.collect_list(F.struct("ord", "file_name", "raw"))).alias("members")
    )

    def save(batches):
        from pyarrow import fs

        for batch in batches:
            for bucket, members in zip(batch["bucket"], batch["members"]):
                packed = io.BytesIO()
                with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as z:
                    z.writestr("notes.txt", "not a record")
                    for m in members:
                        z.writestr(m["file_name"], m["raw"])
                target = f"{out}/part-{bucket:06d}.zip"
                if "://" in target:
                    system, inner = fs.FileSystem.from_uri(target)
                else:
                    system, inner = fs.LocalFileSystem(), target.removeprefix("file:")
                system.create_dir(inner.rsplit("/", 1)[0], recursive=True)
                with system.open_output_stream(inner) as handle:
                    handle.write(packed.getvalue())
                yield pd.DataFrame({"bucket": [bucket], "members": [len(members)]})

    grouped.mapInPandas(save, "bucket long, members long").agg(F.sum("members")).collect()
    return f"{out}/*.zip"


@query(
    "scan_zip_json",
    """WITH c AS (SELECT DISTINCT conv_id FROM conversations)
       SELECT 'part-' || lpad(CAST(conv_id // 64 AS VARCHAR), 6, '0') || '.zip' AS source_zip,
              row_number() OVER (PARTITION BY conv_id // 64 ORDER BY conv_id) AS ord,
              CAST(conv_id AS VARCHAR) || '.json' AS file_name, true AS readable FROM c""",
)
def _(spark, sf):
    members = scan_zip_json(spark, write_archives(spark, sf), chunk_bytes=16 << 10)
    return members.select("source_zip", "ord", "file_name", F.col("raw").isNotNull().alias("readable"))


@query(
    "subset_from_archives",
    f"""WITH {TURN_ROWS},
    marked AS (SELECT *, CASE speaker WHEN 'user' THEN true WHEN 'assistant' THEN false END AS is_customer
               FROM record_turns),
    texts AS (
      SELECT ord, 'part-' || lpad(CAST(ord // 64 AS VARCHAR), 6, '0') || '.zip' AS source_zip,
             count(*) AS n_turns, count(*) FILTER (is_customer) AS n_customer_turns,
             {q.clean("coalesce(string_agg(text, chr(10) ORDER BY pos) FILTER (is_customer), '')")} AS customer_text,
             {q.clean("string_agg(text, chr(10) ORDER BY pos)")} AS full_text
      FROM marked GROUP BY ord),
    preferred AS (SELECT *, CASE WHEN customer_text <> '' THEN customer_text ELSE full_text END AS t FROM texts)
    SELECT source_zip, CAST(ord AS VARCHAR) || '.json' AS file_name, n_turns, n_customer_turns,
           sha256(t) AS hash FROM preferred WHERE {q.word('t', v.DOMAIN_WORDS)}
    QUALIFY row_number() OVER (PARTITION BY sha256(t) ORDER BY source_zip, ord) = 1""",
)
def _(spark, sf):
    kept, _rejects = jobs.subset_from_archives(
        spark,
        write_archives(spark, sf),
        keywords=v.DOMAIN_WORDS,
        customer=v.CUSTOMER,
        agent=v.AGENT,
    )
    return kept.select("source_zip", "file_name", "n_turns", "n_customer_turns", "hash")


@query(
    "dev_sample",
    f"""WITH {GOOD}, t AS (SELECT ord, 'part-' || lpad(CAST(ord // 64 AS VARCHAR), 6, '0') || '.zip'
           AS source_zip, string_agg(text, chr(10) ORDER BY pos) AS text FROM good GROUP BY ord)
        SELECT source_zip, CASE WHEN ord % 4 < 2 THEN 'kind' || CAST(ord % 4 AS VARCHAR) ELSE 'chat' END
          AS domain, substr(text, 1, 50000) AS text FROM t
        WHERE text <> '' AND ({q.word('text', v.DOMAIN_WORDS)} OR ord % 4 = 1)
        ORDER BY source_zip, ord LIMIT 1000""",
)
def _(spark, sf):
    texts, _rejects = jobs.texts_from_archives(spark, write_archives(spark, sf))
    return jobs.dev_sample(
        texts, keywords=v.DOMAIN_WORDS, metadata_words=("kind1", "xx")
    ).select("source_zip", "domain", "text")


@query(
    "extract_bucket",
    """SELECT source AS source_zip, CAST(doc_id AS VARCHAR) AS source_file, lang AS domain, source AS topic,
       substr(text, 1, 50000) AS text FROM documents WHERE lang = 'de' AND text <> ''
       ORDER BY source, doc_id LIMIT 5000""",
)
def _(spark, sf):
    texts = v.calls(spark, sf).withColumnRenamed("full_text", "text").drop("customer_text")
    return jobs.extract_bucket(texts, label="de").drop("ord")


# --- round trips --------------------------------------------------------------------------------

CALL_ROWS = """SELECT doc_id, text, lang, source FROM documents"""


@query("parquet_round_trip", CALL_ROWS)
def _(spark, sf):
    path = fresh_path(spark, "parquet")
    sinks.write_parquet(v.documents(spark, sf).select("doc_id", "text", "lang", "source"), path)
    return tables.read_parquet(spark, path)


@query("csv_round_trip", CALL_ROWS)
def _(spark, sf):
    path = fresh_path(spark, "csv")
    sinks.write_csv(v.documents(spark, sf).select("doc_id", "text", "lang", "source"), path)
    return tables.read_csv(spark, path, "doc_id long, text string, lang string, source string")


@query("jsonl_round_trip", CALL_ROWS)
def _(spark, sf):
    path = fresh_path(spark, "jsonl")
    sinks.write_jsonl(v.documents(spark, sf).select("doc_id", "text", "lang", "source"), path)
    return tables.read_jsonl(spark, path, "doc_id long, text string, lang string, source string")
