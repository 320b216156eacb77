"""Run registered queries in Spark and DuckDB and compare rows: python tests/oracle_check.py DIR [NAME...]"""

import math
import sys
import time
from decimal import Decimal
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def cell(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return ""
    if isinstance(v, (float, Decimal)):
        return f"{float(v):.9g}"
    return str(v)


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(tuple(cell(r[i]) for i in order) for r in data)


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def compare(spark, con, sf_dir, name, query, sql):
    """None when equal, else what differs; with the row count."""
    df = query(spark, sf_dir)
    got_columns, got = rows(df.columns, [tuple(r) for r in df.collect()])
    result = con.execute(sql)
    want_columns, want = rows([d[0] for d in result.description], result.fetchall())
    if got_columns != want_columns:
        return f"columns {got_columns} != {want_columns}", len(got)
    if got != want:
        pairs = [(g, w) for g, w in zip(got, want) if g != w][:2]
        return f"{len(got)} rows against {len(want)}; first: {pairs}", len(got)
    return None, len(got)


def main():
    from tests.conftest import make_session

    import __spark_entry__ as entry

    sf_dir, *names = sys.argv[1:]
    spark, con, sql = make_session(), connect(sf_dir), entry.oracle_sql()
    bad = 0
    for name, query in entry.queries().items():
        if name not in sql or (names and name not in names):
            continue
        began = time.time()
        try:
            problem, n = compare(spark, con, sf_dir, name, query, sql[name])
        except Exception as e:
            problem, n = f"{type(e).__name__}: {str(e)[:1500]}", 0
        bad += problem is not None
        print(f"{name:28} {n:8} {time.time() - began:6.1f}s {problem or 'equal'}", flush=True)
    print("different:", bad)


if __name__ == "__main__":
    main()
