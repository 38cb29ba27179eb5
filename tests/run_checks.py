"""Compare registered queries with their SQL on one scale: python tests/run_checks.py SF [names]."""

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def frame_rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    def norm(x):
        if isinstance(x, float):
            return "nan" if math.isnan(x) else repr(round(x, 9) + 0.0)
        if hasattr(x, "as_tuple"):
            return repr(round(float(x), 9) + 0.0)
        return repr(x)
    return sorted(tuple(norm(r[i]) for i in order) for r in rows)


def main():
    import duckdb
    from pyspark.sql import SparkSession

    sf, names = sys.argv[1], sys.argv[2:]
    from checks import registry

    registry.load_all()
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = duckdb.connect()
    for t in ("documents", "conversations", "labels", "benchmark", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    bad = 0
    for name, fn in registry.QUERIES.items():
        if names and not any(n == name or (n.endswith("*") and name.startswith(n[:-1])) for n in names):
            continue
        t0 = time.time()
        try:
            df = fn(spark, sf)
            rows = [tuple(r) for r in df.collect()]
            t1 = time.time()
            if name not in registry.ORACLES:
                print(f"{name:34s} rows={len(rows)} {t1-t0:.2f}s (no sql)", flush=True)
                continue
            res = con.execute(registry.ORACLES[name])
            cols = [d[0] for d in res.description]
            want = res.fetchall()
            types = [str(d[1]) for d in res.description]
            a, b = frame_rows(df.columns, rows), frame_rows(cols, want)
            ok = sorted(df.columns) == sorted(cols) and a == b
            bad += not ok
            print(f"{name:34s} {'ok ' if ok else 'BAD'} rows={len(rows)}/{len(want)} {t1-t0:.2f}s sql {time.time()-t1:.2f}s", flush=True)
            if not ok:
                print("  cols", sorted(df.columns), sorted(cols))
                diff = [x for x in a if x not in set(b)][:2], [x for x in b if x not in set(a)][:2]
                print("  spark only", str(diff[0])[:600]); print("  sql only  ", str(diff[1])[:600])
            sd = dict(df.dtypes)
            tm = dict(zip(cols, types))
            odd = {c: (sd[c], tm.get(c)) for c in sd if {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN"}.get(sd[c]) != tm.get(c)}
            if odd:
                print("  types", odd)
        except Exception as e:
            bad += 1
            print(f"{name:34s} ERROR {type(e).__name__}: {str(e)[:1500]}", flush=True)
    print("bad:", bad)


if __name__ == "__main__":
    main()
