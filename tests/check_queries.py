"""Run registered queries against their SQL counterparts in DuckDB and report differences.

    python tests/check_queries.py [folder] [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from catalog.inputs import TABLES  # noqa: E402


def connect(folder: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def comparable(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(
        (tuple(comparable(row[i]) for i in order) for row in rows),
        key=lambda r: tuple((v is not None, str(type(v)), v if v is not None else 0) for v in r),
    )


def compare(spark, con, build, sql: str | None, folder: str) -> str:
    df = build(spark, folder)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if sql is None:
        return f"rows only: {len(got)}"
    relation = con.execute(sql)
    names = [d[0] for d in relation.description]
    want = rows_of(names, relation.fetchall())
    if sorted(names) != sorted(df.columns):
        return f"COLUMNS {sorted(set(names) ^ set(df.columns))}"
    if got == want:
        return f"ok {len(got)}"
    head = [(g, w) for g, w in zip(got, want) if g != w][:2]
    return f"DIFFER rows {len(got)} vs {len(want)} {sorted(names)} {head}"


def session(cores: str = "8"):
    from pyspark.sql import SparkSession

    return (
        SparkSession.builder.master(f"local[{cores}]")
        .config("spark.sql.shuffle.partitions", cores)
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


if __name__ == "__main__":
    import __spark_entry__ as e

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    wanted = sys.argv[2:]
    spark = session()
    spark.sparkContext.setLogLevel("OFF")
    con = connect(folder)
    oracles = e.oracle_sql()
    for name, build in e.queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            result = compare(spark, con, build, oracles.get(name), folder)
        except Exception as error:  # noqa: BLE001
            result = f"ERROR {type(error).__name__} {str(error)[:700]}"
        print(f"{name:26s} {time.time() - start:6.2f}s {result}"[:1500], flush=True)
