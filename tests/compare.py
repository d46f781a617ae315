"""Spark result against the SQL counterpart, row for row.

Run as a script: ``python -m tests.compare [sf_dir] [query ...]``.
"""

from __future__ import annotations

import datetime as dt
import math
import sys
import time
from collections import Counter
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _cell(v):
    if isinstance(v, bool) or v is None:
        return v
    if isinstance(v, Decimal):
        v = float(v)
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.10g}")
    if isinstance(v, int):
        return float(v) if abs(v) < 2**53 else v
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    return str(v)


_KINDS = {
    "string": "VARCHAR",
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
    "timestamp": "TIMESTAMP",
}


def mismatch(df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None when columns, types and the multiset of rows agree."""
    cursor = con.execute(sql)
    expected_types = {d[0]: str(d[1]) for d in cursor.description}
    expected_rows = cursor.fetchall()
    names = sorted(df.columns)
    if names != sorted(expected_types):
        return f"columns {sorted(set(names) ^ set(expected_types))}"
    types = {f.name: _KINDS.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema}
    bad_types = {n: (types[n], expected_types[n]) for n in names if types[n] != expected_types[n]}
    if bad_types:
        return f"types {bad_types}"
    order = [list(expected_types).index(n) for n in names]
    want = Counter(tuple(_cell(r[i]) for i in order) for r in expected_rows)
    got = Counter(tuple(_cell(r[n]) for n in names) for r in df.collect())
    if want != got:
        only_spark = list((got - want).items())[:3]
        only_sql = list((want - got).items())[:3]
        counts = f"rows {sum(got.values())} vs {sum(want.values())}; {names}"
        return f"{counts}\n  spark {only_spark}\n  sql   {only_sql}"
    return None


def main() -> int:
    import __spark_entry__ as entry
    from medloom.session import build_session

    args = sys.argv[1:]
    sf_dir = args.pop(0) if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    spark = build_session(
        "compare",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.driver.memory": "8g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    bad = 0
    sqls = entry.oracle_sql()
    for name, run in entry.queries().items():
        if args and name not in args:
            continue
        start, rows = time.time(), -1
        try:
            df = run(spark, sf_dir)
            rows = con.execute(f"SELECT count(*) FROM ({sqls[name]})").fetchone()[0] if name in sqls else df.count()
            problem = mismatch(df, con, sqls[name]) if name in sqls else None
        except Exception as e:
            problem = f"{type(e).__name__}: {str(e)[:600]}"
        bad += bool(problem) and name in sqls
        print(f"{'ok ' if not problem else 'BAD'} {name:32s} {time.time() - start:6.2f}s {rows:8d} {problem or ''}", flush=True)
    print("failed:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(main())
