"""Run queries and their SQL counterparts side by side.

``python -m checks.compare [sf] [query …]`` prints one line per query.
"""

from __future__ import annotations

import math
import sys
import time

import duckdb
from pyspark.sql import SparkSession

from checks.catalog import ORACLES, QUERIES

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def session(cpus: str = "8", partitions: str = "8") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", partitions)
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"create view {table} as select * from '{sf_dir}/{table}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.12g}")
    return value


def _sorted(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    picked = [tuple(_plain(r[i]) for i in order) for r in rows]
    return [names[i] for i in order], sorted(picked, key=repr)


def compare(spark: SparkSession, con, name: str, sf_dir: str) -> tuple[bool, str]:
    df = QUERIES[name](spark, sf_dir)
    got_names, got = _sorted(df.columns, [tuple(r) for r in df.collect()])
    if name not in ORACLES:
        return bool(got), f"{len(got)} rows, no oracle"
    result = con.execute(ORACLES[name])
    want_names, want = _sorted([d[0] for d in result.description], result.fetchall())
    if got_names != want_names:
        return False, f"columns {got_names} != {want_names}"
    if got != want:
        missing = [r for r in want if r not in set(got)][:2]
        extra = [r for r in got if r not in set(want)][:2]
        return False, f"{len(got)} vs {len(want)} rows; only SQL {missing}; only Spark {extra}"
    return bool(got), f"{len(got)} rows"


def main() -> int:
    args = sys.argv[1:]
    sf = args[0] if args else "0.01"
    sf_dir = f"/root/testdata/sf{sf}"
    spark, con = session(), duck(sf_dir)
    failed = 0
    for name in args[1:] or QUERIES:
        started = time.perf_counter()
        try:
            ok, note = compare(spark, con, name, sf_dir)
        except Exception as ex:  # noqa: BLE001
            ok, note = False, f"{type(ex).__name__}: {str(ex)[:1500]}"
        failed += not ok
        print(f"{'ok  ' if ok else 'FAIL'} {name:28s} {time.perf_counter() - started:6.2f}s {note[:2500]}", flush=True)
    print("failed:", failed)
    return failed


if __name__ == "__main__":
    sys.exit(main())
