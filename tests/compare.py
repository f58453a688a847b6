"""Run registered queries beside their oracle SQL and report differences.

    python -m tests.compare [sf_dir] [name ...]
"""

from __future__ import annotations

import datetime as dt
import math
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def oracle_connection(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _value(v):
    if isinstance(v, bool) or v is None or isinstance(v, str):
        return v
    if isinstance(v, dt.datetime):
        return v.isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(v)
    if isinstance(v, (list, tuple)):
        return tuple(_value(x) for x in v)
    if isinstance(v, (int,)):
        return float(v)
    return float(v) if hasattr(v, "__float__") else str(v)


def _rows(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_value(r[i]) for i in order) for r in rows]
    return sorted(out, key=repr)


def compare(spark, con, query, sql, sf_dir) -> str | None:
    """None when equal, else what differs."""
    df = query(spark, sf_dir)
    got = df.collect()
    cur = con.execute(sql)
    want_columns = [c[0] for c in cur.description]
    want = cur.fetchall()
    if sorted(df.columns) != sorted(want_columns):
        return f"columns {sorted(df.columns)} != {sorted(want_columns)}"
    a, b = _rows(got, df.columns), _rows(want, want_columns)
    if len(a) != len(b):
        return f"{len(a)} rows != {len(b)}"
    diff = [(x, y) for x, y in zip(a, b) if x != y]
    if diff:
        return f"{len(diff)} of {len(a)} rows differ, first:\n  {sorted(df.columns)}\n  {diff[0][0]}\n  {diff[0][1]}"
    return None


def main() -> int:
    import __spark_entry__ as entry
    from suturestar.session import build_session

    args = sys.argv[1:]
    sf_dir = args.pop(0) if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    spark = build_session(
        "compare", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = oracle_connection(sf_dir)
    queries, oracle = entry.queries(), entry.oracle_sql()
    names = args or list(queries)
    bad = 0
    for name in names:
        start = time.time()
        try:
            if name in oracle:
                problem = compare(spark, con, queries[name], oracle[name], sf_dir)
            else:
                n = len(queries[name](spark, sf_dir).collect())
                problem = None if n else "no rows"
        except Exception as e:  # noqa: BLE001 - reported per query
            problem = f"{type(e).__name__}: {str(e)[:1500]}"
        bad += problem is not None
        print(f"{'ok ' if problem is None else 'BAD'} {time.time() - start:6.2f}s {name} {problem or ''}", flush=True)
    print(f"{len(names) - bad} of {len(names)} agree")
    return bad


if __name__ == "__main__":
    sys.exit(main())
