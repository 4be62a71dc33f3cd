"""Run queries and their SQL side by side: ``python tests/compare.py [sf] [name...]``."""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
DATA = "/root/testdata"


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for f in sorted(os.listdir(f"{DATA}/{sf}")):
        name, path = f.removesuffix(".parquet"), f"{DATA}/{sf}/{f}"
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{path}{'/*.parquet' if os.path.isdir(path) else ''}'")
    return con


def _cell(x):
    if isinstance(x, float):
        return "nan" if math.isnan(x) else round(x, 6) + 0.0
    return x


def rows(names, data):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(repr(_cell(r[i])) for i in order) for r in data))


def compare(spark, con, sf: str, name: str, fn, sql: str | None) -> str:
    """'' if equal, else what differs."""
    df = fn(spark, f"{DATA}/{sf}")
    got = rows(df.columns, [tuple(r) for r in df.collect()])
    if sql is None:
        return ""
    rel = con.sql(sql)
    want = rows(rel.columns, rel.fetchall())
    if sorted(df.columns) != sorted(rel.columns):
        return f"columns {df.columns} against {rel.columns}"
    if got != want:
        a, b = set(got), set(want)
        return f"{len(got)} rows against {len(want)}; only here {list(a - b)[:2]}; only in SQL {list(b - a)[:2]}"
    return ""


def main() -> int:
    import __spark_entry__ as entry
    from phrasemill.plans.session import build_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "sf0.001"
    queries, sql = entry.queries(), entry.oracle_sql()
    spark = build_session("compare", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "12g", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = connect(sf), 0
    for name in sys.argv[2:] or queries:
        t = time.time()
        try:
            said = compare(spark, con, sf, name, queries[name], sql.get(name))
        except Exception as e:  # noqa: BLE001
            said = f"{type(e).__name__}: {str(e)[:600]}"
        bad += bool(said)
        print(f"{name}: {'FAIL ' + said if said else 'ok' if name in sql else 'ran'} ({time.time() - t:.1f} s)", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main())
