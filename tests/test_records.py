import json
import random
import zipfile

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from callsift.plans import jobs
from callsift.sources import archives
from callsift.sources import records as rec
from callsift.sources import rules as rule_files
from callsift.sources.archives import scan_zip_json


def members(spark, raws):
    rows = [("z.zip", i, f"{i}.json", r, None) for i, r in enumerate(raws)]
    return spark.createDataFrame(rows, "source_zip string, ord long, file_name string, raw string, error string")


def test_decode_rejects(spark):
    raws = ['{"a":1}', "[1]", "[]", "{}", "null", "oops", '{"a":1} x', '{"a":1} {"b":2}', '{"a":1,}', "{'a':1}",
            '{"a":NaN}', None, '{"a":1}]', '{"a":1}] garbage {', '{"a":1}, {"b":2}', '{"a":1},', '{"a":1}]}']
    good, bad = rec.decode_json(members(spark, raws))
    assert sorted(r.ord for r in good.select("ord").collect()) == [0, 10]
    assert bad.count() == len(raws) - 2


def test_decode_keeps_very_long_strings(spark):
    raw = spark.range(1).select(
        F.lit(0).alias("ord"), F.concat(F.lit('{"a":"'), F.repeat(F.lit("x"), 25_000_000), F.lit('"}')).alias("raw")
    )
    good, bad = rec.decode_json(raw)
    assert good.count() == 1 and bad.count() == 0


def test_paths_keep_equal_base_names_apart(spark, tmp_path):
    for year in ("2024", "2025"):
        (tmp_path / year).mkdir()
        with zipfile.ZipFile(tmp_path / year / "a.zip", "w") as z:
            for n in range(3):
                z.writestr(f"{n}.json", json.dumps({"text": f"bank call {year} {n}", "domain": "bank"}))
    good, rejects = jobs.read_raw(spark, f"{tmp_path}/*/*.zip")
    texts = rec.raw_texts(good)
    assert rejects.count() == 0
    assert texts.select(*jobs.call_order(texts)).distinct().count() == 6
    assert jobs.dev_sample(texts, 3).count() == 3


def test_unknown_schemes_fail():
    assert archives.arrow_uri("s3a://b/k.zip") == "s3://b/k.zip"
    for path in ("dbfs:/x.zip", "wasbs://c@a/x.zip"):
        with pytest.raises(ValueError, match="random access"):
            archives.arrow_uri(path)


def test_turn_shapes(spark):
    raws = [
        {"domain": "", "industry": "Bank", "turns": [{"speaker": "A", "text": " hi\t you "}, "bare", {"role": 0, "content": "zz"},
                                                     {"text": "  "}, {"text": 5, "content": "q"}, {"text": "", "utterance": "u"}]},
        {"turns": [], "dialog": [{"text": "never read"}]},
        {"turns": [], "transcript": "l1\r\n\n l2 \xa0 x\n"},
        {"turns": "not a list", "utterances": ["one", " ", 3], "topic": "t", "subtopic": "s"},
        {"transcript": " ", "text": "only"},
        {"text": "\n".join(f"line {i}" for i in range(5005))},
    ]
    good, _ = rec.decode_json(members(spark, [json.dumps(r) for r in raws]))
    rows = {r.ord: r for r in rec.raw_calls(good).collect()}
    turns = {o: [(t.speaker, t.text) for t in r.turns] for o, r in rows.items()}
    assert turns[0] == [("A", "hi you"), ("", "bare"), ("", "zz"), ("", "u")]
    assert rows[0].domain == "Bank"
    assert turns[1] == []
    assert turns[2] == [("", "l1"), ("", "l2 x")]
    assert turns[3] == [("", "one")] and rows[3].topic == "t"
    assert turns[4] == [("", "only")]
    assert len(turns[5]) == 5000 and [t.pos for t in rows[5].turns][:3] == [0, 1, 2]


def test_plain_text_order(spark):
    raws = [
        '{"transcript": "", "text": "x", "dialog": ["y"]}',
        '{"text": 3, "dialog": [{"text": "a", "content": "b"}, {"text": 1}], "turns": ["c"]}',
        '{"dialog": [], "turns": [{"x": 1}], "utterances": ["u", {"utterance": "v"}]}',
        '{"zeta": "last one", "alpha": "first", "n": 12345, "s": "four"}',
        '{"a": "short", "a": "replaced"}',
    ]
    good, _ = rec.decode_json(members(spark, raws))
    got = {r.ord: r.text for r in rec.raw_texts(good).collect()}
    assert got[0] == ""
    assert got[1] == "a\nb"
    assert got[2] == "u\nv"
    assert got[3] == "last one\nfirst"


def archive(path, entries):
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for name, data in entries:
            z.writestr(name, data)


def test_archives_are_read_in_runs(spark, tmp_path):
    big = [(f"d/{i}.json", json.dumps({"turns": [{"speaker": "customer", "text": f"my card {i}"}]})) for i in range(40)]
    archive(tmp_path / "a & b.zip", [*big, ("notes.txt", "x"), ("bad.json", "{"), ("latin.json", b'{"text": "caf\xe9 bank"}')])
    archive(tmp_path / "c.zip", [("same.json", big[3][1])])
    (tmp_path / "broken.zip").write_bytes(b"not a zip")
    found = scan_zip_json(spark, f"{tmp_path}/*.zip", chunk_bytes=200).collect()
    by_zip = {}
    for r in found:
        by_zip.setdefault(r.source_zip, []).append(r)
    assert len(by_zip["a & b.zip"]) == 42 and len({r.ord for r in by_zip["a & b.zip"]}) == 42
    assert by_zip["broken.zip"][0].error and by_zip["broken.zip"][0].raw is None
    assert [r.raw for r in found if r.file_name == "latin.json"] == ['{"text": "caf bank"}']

    calls, rejects = jobs.subset_from_archives(spark, f"{tmp_path}/*.zip")
    kept = calls.select("source_zip", "file_name", "customer_text").collect()
    assert len(kept) == 41  # c.zip repeats a call of the first archive
    assert {r.source_zip for r in kept} == {"a & b.zip"}
    assert sorted(r.reason for r in rejects.select("reason").collect())[-1] == "bad json"
    assert rejects.count() == 2


def test_dev_sample_and_bucket_keep_archive_order(spark):
    rows = [(f"z{i % 3}", i, f"{i}.json", None, "Medicare_inbound (USA- USA)" if i % 2 else "x", f"bank {i} " * 3) for i in range(30)]
    texts = spark.createDataFrame(rows, "source_zip string, ord long, file_name string, domain string, topic string, text string")
    want = sorted((r[0], r[1]) for r in rows)[:7]
    assert [(r.source_zip, r.ord) for r in jobs.dev_sample(texts, 7).collect()] == want
    odd = sorted((r[0], r[1]) for r in rows if r[1] % 2)[:5]
    assert [(r.source_zip, r.ord) for r in jobs.extract_bucket(texts, n=5).collect()] == odd


def test_rule_files(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"customer": ["User"], "agent": ["REP"]}')
    assert rule_files.load_aliases(str(tmp_path / "a.json")) == (["user"], ["rep"])
    (tmp_path / "k.yaml").write_text("include:\n  - ATM\n  - late fee\n")
    assert rule_files.load_keywords(str(tmp_path / "k.yaml")) == ["ATM", "late fee"]
    (tmp_path / "o.yaml").write_text("clusters:\n  - cluster_id: 3\n    answerable: false\n")
    row = rule_files.load_overrides(spark, str(tmp_path / "o.yaml")).first()
    assert row.cluster_id == 3 and row.has_answerable and not row.has_reason and row.answerable is False


def test_preview_sink(spark, tmp_path):
    from callsift.sources.sinks import write_preview

    rows = [("z", i, f"in/{'n' * 70}{i}.json", f"text {i}") for i in range(60)]
    df = spark.createDataFrame(rows, "source_zip string, ord long, file_name string, text string")
    write_preview(df, ["source_zip", "ord"], str(tmp_path / "out"))
    samples = spark.read.text(str(tmp_path / "out" / "samples"))
    assert samples.count() == 50
    names = {r.sample for r in samples.select("sample").collect()}
    assert "sample_0001__" + "n" * 60 in names
    assert spark.read.csv(str(tmp_path / "out" / "preview"), header=True).count() == 60


def test_round_trip_keeps_quotes_and_line_breaks(spark, tmp_path):
    from callsift.sources import sinks, tables

    rows = [("a", "n", 'he said "x", \n then | left '), ("b", None, ""), ("c", "n", " lead")]
    df = spark.createDataFrame(rows, tables.UTTERANCE_SCHEMA)
    sinks.write_csv(df, str(tmp_path / "csv"))
    back = tables.read_csv(spark, str(tmp_path / "csv"), tables.UTTERANCE_SCHEMA)
    assert sorted(map(tuple, back.collect()), key=str)[0] == rows[0]
    sinks.write_jsonl(df, str(tmp_path / "jsonl"))
    again = tables.read_jsonl(spark, str(tmp_path / "jsonl"), tables.UTTERANCE_SCHEMA)
    assert sorted(map(tuple, again.collect()), key=str) == sorted(rows, key=str)
    (tmp_path / "array.json").write_text('[{"intent_id": "a", "utterance": "u"},\n {"intent_id": "b"}]')
    assert tables.read_json_array(spark, str(tmp_path / "array.json"), tables.SEED_SCHEMA).count() == 2


def test_members_are_read_by_their_place(spark, tmp_path, monkeypatch):
    rng = random.Random(1)
    want = {}
    with zipfile.ZipFile(tmp_path / "kinds.zip", "w") as z:
        for n, kind in enumerate([zipfile.ZIP_STORED, zipfile.ZIP_DEFLATED, zipfile.ZIP_BZIP2, zipfile.ZIP_LZMA] * 3):
            want[f"é/{n}.json"] = "".join(rng.choice("ab ") for _ in range(n * 50))
            z.writestr(f"é/{n}.json", want[f"é/{n}.json"], compress_type=kind)
    raw = bytearray((tmp_path / "kinds.zip").read_bytes())
    at = raw.index(want["é/8.json"].encode())  # stored as it is
    raw[at] ^= 1
    (tmp_path / "kinds.zip").write_bytes(bytes(raw))
    rows = {r.file_name: r for r in scan_zip_json(spark, f"{tmp_path}/*.zip", chunk_bytes=60).collect()}
    assert rows.keys() == want.keys()
    for n, (name, text) in enumerate(want.items()):
        if n % 4 == 3 or n == 8:  # a kind that is not read; a broken member
            assert rows[name].raw is None and rows[name].error
        else:
            assert rows[name].raw == text and rows[name].error is None


def test_the_directory_is_read_once(spark, tmp_path):
    archive(tmp_path / "a.zip", [(f"{i}.json", "{}") for i in range(50)])
    (run,) = list(archives._runs(1 << 20)([pa.RecordBatch.from_pydict({"path": [str(tmp_path / "a.zip")]})]))
    with open(tmp_path / "a.zip", "r+b") as handle:  # members are found without it from here on
        size = (tmp_path / "a.zip").stat().st_size
        handle.truncate(size - 22)
    (batch,) = list(archives._read_runs()([run]))
    assert batch.column("raw").to_pylist() == ["{}"] * 50
