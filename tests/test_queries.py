"""Registered queries against their SQL at the smallest scale. All of them with CALLSIFT_ALL=1."""

import math
import os

import pytest

from checks import registry

registry.load_all()
SF = "/root/testdata/sf0.001"
SOME = (
    "call_subset first_by_hash refine_subset dedup_corpus first_n sample_n extract_turns plain_text "
    "subset_from_archives sentences has_banking_keyword harvest_seeds merge_seeds top_up_counts "
    "build_eval_sets leaked_pairs length_stats top_values classification_report term_stats tfidf "
    "cluster_top_terms curate_catalog training_pack silhouette"
).split()
NAMES = sorted(registry.ORACLES) if os.environ.get("CALLSIFT_ALL") else SOME


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    if not os.path.isdir(SF):
        pytest.skip("no test data")
    con = duckdb.connect()
    for t in ("documents", "conversations", "labels", "benchmark", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def cell(x):
        if isinstance(x, bool) or x is None or isinstance(x, str):
            return repr(x)
        return "nan" if isinstance(x, float) and math.isnan(x) else repr(round(float(x), 9) + 0.0)

    return sorted(tuple(cell(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, duck, name):
    df = registry.QUERIES[name](spark, SF)
    want = duck.execute(registry.ORACLES[name])
    columns = [d[0] for d in want.description]
    assert sorted(df.columns) == sorted(columns)
    assert normal(df.columns, df.collect()) == normal(columns, want.fetchall())


def test_every_query_has_a_plan_name():
    assert set(registry.ORACLES) <= set(registry.QUERIES)
    assert len(registry.QUERIES) > 90
