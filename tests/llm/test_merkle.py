import hashlib

import pytest
from pyspark.sql import functions as F

from callsift.llm import merkle

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, rank int, tree string, digest string"


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    doc_id, source, lang, n_chars, text = row
    field = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    return sha(*map(field, (doc_id, source, lang, n_chars, text)))


def levels(row):
    out = [row]
    while len(out[-1]) > 1:
        out.append([sha(*out[-1][i : i + 2]) for i in range(0, len(out[-1]), 2)])
    return out


def way(tree, i):
    """Siblings of leaf i, and on which side they stand."""
    out = []
    for row in tree[:-1]:
        k = i ^ 1
        out.append((row[k], k < i) if k < len(row) else None)
        i //= 2
    return out


def climb(digest, path):
    for step in path:
        if step is None:
            digest = sha(digest)
        else:
            digest = sha(step[0], digest) if step[1] else sha(digest, step[0])
    return digest


def brute(rows, tampered):
    by_lang = {}
    for r in rows:
        by_lang.setdefault(r[2], []).append(r)
    names = sorted(by_lang, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for lang in names:
        by_lang[lang].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[lang] = levels([leaf(r) for r in by_lang[lang]])
    top = levels([trees[n][-1][0] for n in names])
    out = []
    for t, lang in enumerate(names):
        for i, r in enumerate(by_lang[lang]):
            path = way(trees[lang], i) + way(top, t)
            claimed = r[:3] + (r[3] + 1,) + r[4:] if tampered(r) and r[3] is not None else r
            folded = climb(leaf(claimed), path)
            out.append(
                (
                    r[0], leaf(r), trees[lang][-1][0], top[-1][0], sha(*[s[0] for s in path if s]), folded,
                    folded == top[-1][0],
                )
            )
    return sorted(out, key=str)


def found(spark, rows):
    docs = spark.createDataFrame([(*r, 1, "x", "y") for r in rows], SCHEMA).repartition(3)
    bad = F.coalesce(F.col("doc_id") % 3 == 0, F.lit(False))
    got = merkle.manifest(docs, claimed={"n_chars": F.when(bad, F.col("n_chars") + 1).otherwise(F.col("n_chars"))})
    got = got.withColumn("proof", F.sha2("siblings", 256))
    return sorted(
        map(tuple, got.select("doc_id", "leaf", "subroot", "root", "proof", "folded_root", "verified").collect()),
        key=str,
    )


def tampered(row):
    return row[0] is not None and row[0] % 3 == 0


def table(sizes):
    rows = []
    for lang, n in sizes.items():
        rows += [(7 * i + len(rows), f"s{i % 3}", lang, 10 * i, f"text {i} é") for i in range(n)]
    return rows


def test_blocks_of_any_band_give_the_tree(monkeypatch):
    for band in (1, 2, 3):
        monkeypatch.setattr(merkle, "BAND", band)
        for n in (1, 2, 3, 5, 8, 9, 27):
            row = [sha(str(i)) for i in range(n)]
            tree = levels(row)
            paths, tops, size = [""] * n, row, 1 << band
            span = 1
            while True:
                blocks = [merkle.Block(a, len(tops), tops[a : a + size]) for a in range(0, len(tops), size)]
                sides = [blocks[(i // span) // size].path(i // span) for i in range(n)]
                paths = [p + s for p, (s, _) in zip(paths, sides, strict=True)]
                whole = len(tops) <= size
                tops, span = [b.top for b in blocks], span * size
                if whole:
                    break
            assert tops == tree[-1]
            assert paths == ["".join(s[0] for s in way(tree, i) if s) for i in range(n)]


@pytest.mark.parametrize("n", [1, 2, 1023, 1024, 1025, 2049])
def test_trees_of_several_bands(spark, n):
    rows = table({"en": n, "de": 3})
    assert found(spark, rows) == brute(rows, tampered)


def test_nulls_empty_long_and_repeated_rows(spark):
    rows = [
        (1, None, None, None, None), (1, "", "", 0, ""), (None, "s", "en", 3, "a"), (None, "s", "en", 3, "a"),
        (3, "s", "en", None, "b" * 300_000), (3, "s", "en", 5, "c"), (3, "s", "en", 5, "c"), (9, "12:x", "-", 1, "-"),
    ]
    assert found(spark, rows) == brute(rows, tampered)
    assert len({leaf(r) for r in rows[:2]}) == 2


def test_one_row_and_no_rows(spark):
    rows = [(5, "s", "en", 1, "t")]
    assert found(spark, rows) == brute(rows, tampered)
    assert found(spark, rows)[0][4] == sha()
    assert found(spark, []) == []


def test_a_change_of_any_field_is_found(spark):
    docs = spark.createDataFrame(table({"en": 20, "fr": 4}), "doc_id long, source string, lang string, n_chars long, text string")
    for column in ("source", "text"):
        got = merkle.manifest(docs, claimed={column: F.when(F.col("doc_id") == 7, F.lit("!")).otherwise(F.col(column))})
        assert {r["doc_id"] for r in got.where("not verified").collect()} == {7}
        assert got.where("verified and folded_root <> root").isEmpty()
