"""Run queries against their check SQL: `python -m tests.compare [sf_dir] [name …]`."""

from __future__ import annotations

import sys
import time
import traceback

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def check_engine(sf_dir: str):
    import duckdb

    engine = duckdb.connect()
    for name in TABLES:
        engine.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return engine


def normal(value):
    """Comparable form of one value."""
    import datetime as dt
    import decimal
    import math

    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "NULL"
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, (int, float, decimal.Decimal)):
        return repr(float(value) + 0.0)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat(timespec="microseconds")
    return str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(tuple(normal(row[i]) for i in order) for row in rows)


def difference(spark_df, engine, sql: str) -> str | None:
    """None when both sides agree, else what differs."""
    left = rows_of(spark_df.columns, spark_df.collect())
    answer = engine.sql(sql)
    right = rows_of(answer.columns, answer.fetchall())
    if left[0] != right[0]:
        return f"columns {left[0]} != {right[0]}"
    if len(left[1]) != len(right[1]):
        return f"{len(left[1])} rows != {len(right[1])}"
    wrong = [(a, b) for a, b in zip(left[1], right[1]) if a != b]
    if wrong:
        return f"{len(wrong)} rows differ, first:\n  {left[0]}\n  {wrong[0][0]}\n  {wrong[0][1]}"
    return None


def main(sf_dir: str, names: list[str]) -> int:
    from tests.conftest import make_session

    import __spark_entry__ as entry

    spark, engine = make_session(), check_engine(sf_dir)
    queries, texts = entry.queries(), entry.oracle_sql()
    bad = 0
    for name in names or queries:
        start = time.time()
        try:
            if name in texts:
                found = difference(queries[name](spark, sf_dir), engine, texts[name])
            else:
                found = f"no SQL, {queries[name](spark, sf_dir).count()} rows"
        except Exception:
            found = traceback.format_exc(limit=1)[-1500:]
        bad += bool(found) and name in texts
        print(f"{name:28s} {time.time() - start:6.2f}s {'ok' if found is None else found}", flush=True)
    print(f"{bad} differ; without SQL: {sorted(set(queries) - set(texts))}; stray: {sorted(set(texts) - set(queries))}")
    return bad


if __name__ == "__main__":
    args = sys.argv[1:]
    sys.exit(bool(main(args[0] if args else "/root/testdata/sf0.01", args[1:])))
