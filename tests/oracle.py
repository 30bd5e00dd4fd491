"""Compares queries with their SQL in DuckDB: `python tests/oracle.py SF_DIR [NAME...]`."""

from __future__ import annotations

import decimal
import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for p in sorted(Path(sf_dir).glob("*.parquet")):
        db.execute(f"create view {p.stem} as select * from read_parquet('{p}{'/*.parquet' if p.is_dir() else ''}')")
    return db


def plain(value):
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.9g}")
    if isinstance(value, (list, tuple)):
        return tuple(plain(x) for x in value)
    if hasattr(value, "asDict"):
        value = value.asDict()
    if isinstance(value, dict):
        return tuple((k, plain(v)) for k, v in sorted(value.items()))
    return value


def bag(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(r[i]) for i in order) for r in rows)


def differences(spark, db, sf_dir: str, name: str, query, sql: str) -> str:
    """Empty where both give the same columns and rows."""
    df = query(spark, sf_dir)
    result = db.execute(sql)
    columns = [d[0] for d in result.description]
    if sorted(df.columns) != sorted(columns):
        return f"{name}: columns {sorted(df.columns)} and {sorted(columns)}"
    ours, theirs = bag(df.columns, df.collect()), bag(columns, result.fetchall())
    if ours == theirs:
        return ""
    a, b = ours - theirs, theirs - ours
    return f"{name}: {ours.total()} and {theirs.total()} rows; only ours {a.total()} {list(a)[:3]}; only SQL {b.total()} {list(b)[:3]}"


if __name__ == "__main__":
    import __spark_entry__ as entry
    from lexframe.session import local_session

    spark, db = local_session(), connect(sys.argv[1])
    queries, sql = entry.queries(), entry.oracle_sql()
    bad = 0
    for name in sys.argv[2:] or queries:
        began = time.time()
        if name in sql:
            try:
                said = differences(spark, db, sys.argv[1], name, queries[name], sql[name]) or "same"
            except Exception as e:  # the other queries are still of interest
                said = f"{type(e).__name__}: {str(e)[:600]}"
        else:
            said = f"{queries[name](spark, sys.argv[1]).count()} rows, no SQL"
        bad += said[:4] != "same" and "no SQL" not in said
        print(f"{name} {time.time() - began:.1f} s: {said}", flush=True)
    sys.exit(bad > 0)
