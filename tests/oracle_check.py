"""Compare registered queries with their SQL: python tests/oracle_check.py [sf] [name...]."""

from __future__ import annotations

import math
import os
import sys
import time
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str):
    con = duckdb.connect()
    for table in TABLES:
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return con


def _cell(value):
    if value is None:
        return None
    if isinstance(value, bool):
        return int(value)
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return float(f"{value:.9g}")
    return value


def rows_of_spark(frame):
    columns = sorted(frame.columns)
    return columns, Counter(tuple(_cell(row[c]) for c in columns) for row in frame.collect())


def rows_of_sql(con, sql):
    relation = con.sql(sql)
    names = list(relation.columns)
    columns = sorted(names)
    at = [names.index(c) for c in columns]
    return columns, Counter(tuple(_cell(row[i]) for i in at) for row in relation.fetchall())


def compare(spark, con, folder, name, plan, sql):
    columns, ours = rows_of_spark(plan(spark, folder))
    expected_columns, expected = rows_of_sql(con, sql)
    assert columns == expected_columns, f"{name}: {columns} != {expected_columns}"
    missing, extra = expected - ours, ours - expected
    assert not missing and not extra, (
        f"{name}: {sum(ours.values())} rows, expected {sum(expected.values())}; columns {columns}; "
        f"missing {list(missing.items())[:2]}; unexpected {list(extra.items())[:2]}"
    )
    return sum(ours.values())


def main(argv: list[str]) -> int:
    from pyspark.sql import SparkSession

    import __spark_entry__ as contract

    folder = f"/root/testdata/{argv[0] if argv else 'sf0.01'}"
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, sqls, failed = connect(folder), contract.oracle_sql(), []
    for name, plan in contract.queries().items():
        if name not in sqls or (argv[1:] and name not in argv[1:]):
            continue
        started = time.time()
        try:
            n = compare(spark, con, folder, name, plan, sqls[name])
            print(f"ok   {name:28s} {n:7d} rows {time.time() - started:6.2f}s", flush=True)
        except Exception as error:  # noqa: BLE001
            failed.append(name)
            print(f"FAIL {name}: {type(error).__name__} {str(error)[:900]}", flush=True)
    print(f"{len(failed)} failed: {failed}")
    return bool(failed)


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
