from pyspark.sql import functions as F

from callsift.llm import licenses

KNOWN = {
    "Licensed under CC BY-NC 4.0.": "cc_by_nc",
    "This work is licensed under the GNU General Public License, version 3.": "gpl",
    "Licensed under the Apache License, Version 2.0.": "apache",
    "Released under the MIT License.": "mit",
    "All rights reserved.": "proprietary",
}


def test_finds_every_notice_and_nothing_else(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    filler = "that was the reason of it and from this " * 9
    odd = [
        (-1, None), (-2, ""), (-3, "\n\n ;;\n"), (-4, "é ü 日本"),
        (-5, filler + "Released under the MIT License. " + filler),
        (-6, "RELEASED UNDER THE MIT LICENSE"), (-6, "RELEASED UNDER THE MIT LICENSE"),
        (None, "All rights reserved."), (-7, "the MIT student released a paper under the bridge"),
        (-8, ("lorem ipsum " * 400) + "\nLicensed under the Apache License, Version 2.0."),
    ]
    docs = docs.unionByName(spark.createDataFrame(odd, "doc_id long, text string"))
    model = licenses.fit(docs)
    got = {(r["doc_id"], r["line"], r["family"]) for r in licenses.scan(docs, model).collect() if r["confirmed"]}
    want = {(-5, 0, "mit"), (-6, 0, "mit"), (None, 0, "proprietary"), (-8, 1, "apache")}
    for r in docs.collect():
        for n, line in enumerate((r["text"] or "").split("\n")):
            if line in KNOWN:
                want.add((r["doc_id"], n, KNOWN[line]))
    assert len(want) > 30
    assert got == want


def test_windows_cover_long_lines(spark):
    shape = licenses.Shape(window=6, stride=4)
    rows = [(n, " ".join(f"w{k}" for k in range(n)), 5) for n in range(0, 30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, line int")
    seen = {}
    for r in licenses.paragraphs(docs, shape).collect():
        assert len(r["words"]) <= 6 and r["words"][0] == f"w{r['start']}"
        seen.setdefault(r["doc_id"], set()).update(r["words"])
    assert {n: len(ws) for n, ws in seen.items()} == {n: n for n in range(1, 30)}


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    model = licenses.fit(docs)
    assert licenses.scan(docs, model).count() == 0


PROBES = {
    "Dual-licensed under the MIT License or the Apache License": {"mit", "apache"},
    "You can choose between the Mozilla Public License and the GNU Lesser General Public License.": {"mpl", "lgpl"},
    "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
    "General Public License as published by the Free Software Foundation": {"lgpl"},
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED': {"mit"},
    "The above copyright notice and this permission notice shall be included in all copies or substantial portions "
    "of the Software.": {"mit"},
    "Unless required by applicable law or agreed to in writing, software distributed under the License is "
    'distributed on an "AS IS" BASIS': {"apache"},
    "The GNU General Public License is a free, copyleft license for software and other kinds of works.": {"gpl"},
}
PHRASES = ("We publish all of this subject to {}", "Contributions are accepted under {} only", "{} governs the use of these files")


def corpus(spark):
    return spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")


def test_several_families_a_line_and_siblings_apart(spark):
    model = licenses.fit(corpus(spark))
    docs = spark.createDataFrame(list(enumerate(PROBES)), "doc_id long, text string")
    got = {}
    for r in licenses.scan(docs, model).where("confirmed").collect():
        got.setdefault(r["doc_id"], set()).add(r["family"])
    assert {t: got.get(k, set()) for k, t in enumerate(PROBES)} == PROBES


def test_recall_of_sentences_that_no_fit_has_seen(spark):
    model = licenses.fit(corpus(spark))
    asked = [(f, p.format(n)) for f, names in licenses.NAMES.items() for n in names for p in PHRASES]
    docs = spark.createDataFrame([(k, t) for k, (_, t) in enumerate(asked)], "doc_id long, text string")
    found = {(r["doc_id"], r["family"]) for r in licenses.scan(docs, model).collect()}
    hits = sum((k, f) in found for k, (f, _) in enumerate(asked))
    assert hits >= 0.9 * len(asked)


def test_paragraphs_of_all_documents_make_the_unknown_class(spark):
    ids = [r["id"] for r in spark.range(1500).orderBy(F.xxhash64("id"), "id").collect()]
    rows = [(i, "We saw the apache cross the valley" if k >= 1000 else "We saw the river below us") for k, i in enumerate(ids)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert licenses.scan(docs, licenses.fit(docs)).count() <= licenses.Shape().error * len(rows)


def test_lines_of_the_last_documents_in_hash_order_are_unknown_too(spark):
    ids = [r["id"] for r in spark.range(1500).orderBy(F.xxhash64("id"), "id").collect()]
    rows = [(i, "Software license news of the week" if k >= 1000 else "We saw the river below us") for k, i in enumerate(ids)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert licenses.scan(docs, licenses.fit(docs)).count() <= licenses.Shape().error * len(rows)


def test_survives_lost_executors(spark, monkeypatch):
    """What executors hold is dropped before the training rows, the thresholds and the scan read it."""
    rows = [(k, f"We saw the apache cross river {k}\n{list(KNOWN)[k % len(KNOWN)]}") for k in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")

    def found(lost):
        def losing(step):
            def run(*args):
                lost()
                return step(*args)

            return run

        with monkeypatch.context() as m:
            for name in ("_training", "_thresholds", "_found"):
                m.setattr(licenses, name, losing(getattr(licenses, name)))
            result = licenses.find(docs)
        lost()
        return {(r["doc_id"], r["line"], r["family"]) for r in result.collect() if r["confirmed"]}

    def lose():
        for blocks in list(spark.sparkContext._jsc.getPersistentRDDs().values()):
            blocks.unpersist(True)

    whole = found(lambda: None)
    assert whole == {(k, 1, list(KNOWN.values())[k % len(KNOWN)]) for k in range(40)}
    assert found(lose) == whole
