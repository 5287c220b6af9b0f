"""Run registered queries on Spark and their SQL on DuckDB and compare values.

    python tests/compare.py [--sf DIR] [name prefix ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import glob
import math
import os
import sys
import time
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def _plain(value):
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(float(f"{value:.12g}") + 0.0)
    if isinstance(value, bool) or value is None:
        return str(value)
    if isinstance(value, int):
        return repr(float(value)) if abs(value) < 1 << 53 else str(value)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    return str(value)


def normalised(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def duck(folder: str):
    import duckdb

    con = duckdb.connect()
    for path in sorted(glob.glob(f"{folder}/*.parquet")):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def compare(spark, con, folder: str, name: str, job, sql: str | None) -> str:
    """'' when equal, otherwise what differs."""
    df = job(spark, folder)
    rows = df.collect()
    if sql is None:
        return "" if rows else "no rows"
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    if sorted(names) != sorted(df.columns):
        return f"columns differ: {sorted(set(names) ^ set(df.columns))}"
    expected = normalised(names, cur.fetchall())
    actual = normalised(df.columns, rows)
    if expected == actual:
        return ""
    only_spark = list((actual - expected).items())[:2]
    only_sql = list((expected - actual).items())[:2]
    return (f"{sum(actual.values())} vs {sum(expected.values())} rows; columns "
            f"{sorted(names)}; only spark {only_spark}; only sql {only_sql}")


def main(argv: list[str]) -> int:
    import __spark_entry__ as e
    from tradewind import session

    folder = "/root/testdata/sf0.01"
    if argv[:1] == ["--sf"]:
        folder, argv = argv[1], argv[2:]
    spark = session.create(master="local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
        "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    session.use_local_folder(spark)
    con, bad = duck(folder), 0
    jobs, sql = e.queries(), e.oracle_sql()
    for name, job in jobs.items():
        if argv and not any(name.startswith(a) for a in argv):
            continue
        start = time.time()
        try:
            problem = compare(spark, con, folder, name, job, sql.get(name))
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        bad += bool(problem)
        mark = "ok  " if not problem else "FAIL"
        print(f"{mark} {name} {time.time() - start:.2f}s {'' if name in sql else '(rows only)'}"
              f"{problem}", flush=True)
    print(f"{bad} failed")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
