"""Run registered queries in Spark and their SQL oracles in DuckDB and compare.

Usage: ``python -m tests.oracle_compare /root/testdata/sf0.01 [name ...]``

Comparison: same column-name set, same row count, and equal multisets of rows
after normalising (columns sorted by name, floats rounded to 9 places, NaN and
NULL unified, arrays turned into tuples).
"""

from __future__ import annotations

import math
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        if math.isinf(v):
            return v
        return round(v, 9) + 0.0
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if hasattr(v, "tolist"):
        return _norm(v.tolist())
    if isinstance(v, bool):
        return int(v)
    return v


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda r: tuple((x is None, str(x)) for x in r))


def compare(spark, con, sf_dir: str, name: str, query, sql: str) -> dict:
    t0 = time.time()
    sdf = query(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    res = con.execute(sql)
    d_cols = [c[0] for c in res.description]
    d_rows = res.fetchall()
    t2 = time.time()
    out = {
        "name": name,
        "spark_rows": len(s_rows),
        "duck_rows": len(d_rows),
        "spark_sec": round(t1 - t0, 2),
        "duck_sec": round(t2 - t1, 2),
    }
    if sorted(s_cols) != sorted(d_cols):
        out["ok"] = False
        out["why"] = f"columns differ: spark={sorted(s_cols)} duck={sorted(d_cols)}"
        return out
    a, b = _rows(s_cols, s_rows), _rows(d_cols, d_rows)
    if a == b:
        out["ok"] = True
        return out
    out["ok"] = False
    diff_a = [r for r in a if r not in set(b)][:3]
    diff_b = [r for r in b if r not in set(a)][:3]
    out["why"] = f"values differ; spark-only {diff_a!r:.600} duck-only {diff_b!r:.600}"
    return out


def main(argv: list[str]) -> int:
    sys.path.insert(0, ".")
    from __spark_entry__ import oracle_sql, queries
    from textlab.session import local_session

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:]
    spark = local_session()
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    qs, os_ = queries(), oracle_sql()
    bad = 0
    for name in names or sorted(qs):
        if name not in os_:
            sdf = qs[name](spark, sf_dir)
            print(f"ROWS-ONLY {name}: {sdf.count()} rows, columns {sdf.columns}")
            continue
        r = compare(spark, con, sf_dir, name, qs[name], os_[name])
        bad += not r["ok"]
        print(("OK  " if r["ok"] else "BAD ") + str(r), flush=True)
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main(sys.argv[1:]))
