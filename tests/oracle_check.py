"""Run named queries on Spark and their SQL on DuckDB and compare rows as multisets, exactly."""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


SQL_TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


def database(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _value(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    return str(v)


def _multiset(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], Counter(tuple(_value(r[i]) for i in order) for r in rows)


def compare(con, df, sql: str) -> list[str]:
    """Differences between a Spark result and the SQL's; empty when equal."""
    result = con.execute(sql)
    expected = _multiset([d[0] for d in result.description], result.fetchall())
    actual = _multiset(df.columns, [tuple(r) for r in df.collect()])
    if expected[0] != actual[0]:
        return [f"columns {actual[0]} != {expected[0]}"]
    types = {d[0]: str(d[1]) for d in result.description}
    unlike = {c: (t, types[c]) for c, t in df.dtypes if SQL_TYPES.get(t, t) != types[c]}
    if unlike:
        return [f"types {unlike}"]
    extra, lost = actual[1] - expected[1], expected[1] - actual[1]
    if not extra and not lost:
        return []
    return [
        f"{sum(actual[1].values())} rows, expected {sum(expected[1].values())}",
        f"only in Spark ({sum(extra.values())}): {list(extra)[:3]}",
        f"only in SQL ({sum(lost.values())}): {list(lost)[:3]}",
    ]


def main(sf_dir: str, names: list[str]) -> int:
    from __spark_entry__ import oracle_sql, queries
    from kerbside.session import build_session

    spark = build_session("oracle-check", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con, sql, failed = database(sf_dir), oracle_sql(), 0
    for name, run in queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            df = run(spark, sf_dir)
            problems = compare(con, df, sql[name]) if name in sql else [] if df.count() else ["no rows"]
        except Exception as e:  # report and go on with the other queries
            problems = [f"{type(e).__name__}: {str(e)[:1500]}"]
        spark.catalog.clearCache()
        failed += bool(problems)
        print(f"{'FAIL' if problems else 'ok  '} {name:28s} {time.time() - start:6.2f}s {'' if name in sql else '(rows only)'}", flush=True)
        for p in problems:
            print("     ", p, flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
