"""Run registered queries against their SQL twins, value by value.

    python tests/check_oracles.py [sf_dir] [query ...]
"""

from __future__ import annotations

import math
import os
import sys
import time
from datetime import date, datetime
from decimal import Decimal

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

import duckdb  # noqa: E402

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _value(v):
    if isinstance(v, bool) or v is None:
        return v
    if isinstance(v, Decimal):
        return float(v)
    if isinstance(v, float):
        return "nan" if math.isnan(v) else v + 0.0
    if isinstance(v, (datetime, date)):
        return v.isoformat()
    return v


def _rows(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_value(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda r: tuple((v is None, str(type(v)), str(v)) for v in r))


def compare(spark_df, con, sql: str) -> str | None:
    """None if both hold the same rows, else the first difference."""
    left = _rows(spark_df.columns, spark_df.collect())
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    right = _rows(names, cursor.fetchall())
    if sorted(spark_df.columns) != sorted(names):
        return f"columns {sorted(set(spark_df.columns) ^ set(names))}"
    if len(left) != len(right):
        return f"rows {len(left)} against {len(right)}"
    columns = sorted(names)
    wrong = [(a, b) for a, b in zip(left, right) if a != b]
    if wrong:
        a, b = wrong[0]
        diff = [(c, x, y) for c, x, y in zip(columns, a, b) if x != y or type(x) is not type(y)]
        return f"{len(wrong)} of {len(left)} rows differ, first {diff}"
    kinds = [
        (c, type(x).__name__, type(y).__name__)
        for a, b in zip(left[:1], right[:1])
        for c, x, y in zip(columns, a, b)
        if type(x) is not type(y)
    ]
    return f"types {kinds}" if kinds else None


def main() -> int:
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    args = sys.argv[1:]
    sf_dir = args[0] if args else "/root/testdata/sf0.01"
    wanted = set(args[1:])
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, sqls, bad = duck(sf_dir), entry.oracle_sql(), 0
    for name, query in entry.queries().items():
        if wanted and name not in wanted:
            continue
        begin = time.time()
        try:
            df = query(spark, sf_dir)
            if name in sqls:
                found = compare(df, con, sqls[name])
            else:
                found = None if df.count() else "no rows"
        except Exception as error:  # noqa: BLE001
            found = f"failed: {str(error)[:800]}"
        bad += found is not None
        verdict = "ok" if found is None else found
        print(f"{name:26s} {time.time() - begin:6.2f}s {verdict}", flush=True)
    print("failures:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(main())
