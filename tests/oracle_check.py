"""Run registered queries against their SQL counterparts: ``python tests/oracle_check.py [sf] [name ...]``."""

from __future__ import annotations

import os
import sys
import time
from decimal import Decimal

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "pages", "benchmark", "labels",
)


def canonical(value):
    """One text per value that both engines agree on."""
    if value is None:
        return "null"
    if isinstance(value, float):
        return f"{value:.6f}".replace("-0.000000", "0.000000")
    if isinstance(value, Decimal):
        return f"decimal {value}"
    return str(value)


def rows_of(records, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(canonical(r[i]) for i in order) for r in records)


def compare(spark, connection, name, queries, oracles, sf):
    df = queries[name](spark, sf)
    got = rows_of([tuple(r) for r in df.collect()], df.columns)
    if name not in oracles:
        return None, f"{len(got)} rows (no SQL)"
    cursor = connection.execute(oracles[name])
    columns = [d[0] for d in cursor.description]
    want = rows_of(cursor.fetchall(), columns)
    if sorted(columns) != sorted(df.columns):
        return False, f"columns {sorted(df.columns)} against {sorted(columns)}"
    if got != want:
        missing = [r for r in want if r not in set(got)][:3]
        extra = [r for r in got if r not in set(want)][:3]
        return False, f"{len(got)} rows against {len(want)}; missing {missing}; extra {extra}"
    return True, f"{len(got)} rows"


def connect(sf):
    connection = duckdb.connect()
    for t in TABLES:
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return connection


def main(argv):
    import __spark_entry__ as contract
    from pyspark.sql import SparkSession

    sf = f"/root/testdata/sf{argv[0] if argv else '0.01'}"
    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC").config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(sf)
    queries, oracles = contract.queries(), contract.oracle_sql()
    names = argv[1:] or list(queries)
    bad = []
    for name in names:
        begun = time.time()
        try:
            ok, note = compare(spark, connection, name, queries, oracles, sf)
        except Exception as exc:  # noqa: BLE001
            ok, note = False, f"{type(exc).__name__}: {str(exc)[:600]}"
        if ok is False:
            bad.append(name)
        label = {True: "ok  ", False: "FAIL", None: "rows"}[ok]
        print(f"{label} {name} {time.time() - begun:.2f}s {note}", flush=True)
    print(f"{len(names) - len(bad)} of {len(names)} good; failing: {bad}")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
