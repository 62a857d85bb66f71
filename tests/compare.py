"""Run registered queries in Spark and their SQL twins in DuckDB and compare the results exactly.

    python tests/compare.py /root/testdata/sf0.01 [name or prefix ...]
"""

from __future__ import annotations

import datetime as dt
import os
import re
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

TYPE_NAMES = {
    "BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string", "BOOLEAN": "boolean",
    "DATE": "date", "TIMESTAMP": "timestamp_ntz", "FLOAT": "float", "HUGEINT": "hugeint",
}


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def _plain(value):
    if isinstance(value, float):
        return repr(value + 0.0)
    if isinstance(value, (dt.date, dt.datetime)):
        return str(value)
    return repr(value)


def _rows(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_plain(r[i]) for i in order) for r in rows)


def compare(spark, con, folder: str, query, tables_type) -> list[str]:
    """Differences between the two engines; empty when they agree."""
    df = query.run(tables_type(spark, folder))
    got = df.collect()
    if query.sql is None:
        return [] if got else ["no rows"]
    cursor = con.execute(query.sql)
    names = [d[0] for d in cursor.description]
    types = {d[0]: TYPE_NAMES.get(str(d[1]), str(d[1])) for d in cursor.description}
    want = cursor.fetchall()
    problems = []
    if sorted(df.columns) != sorted(names):
        return [f"columns {sorted(df.columns)} against {sorted(names)}"]
    for c, kind in df.dtypes:
        if types[c] != kind:
            problems.append(f"type of {c}: {kind} against {types[c]}")
    if len(got) != len(want):
        problems.append(f"rows: {len(got)} against {len(want)}")
    a, b = _rows(got, df.columns), _rows(want, names)
    if a != b:
        left, right = sorted(set(a) - set(b))[:3], sorted(set(b) - set(a))[:3]
        problems.append(f"values of {sorted(names)}\n    spark {left}\n    sql   {right}")
    if not got:
        problems.append("both empty")
    return problems


def session():
    from pyspark.sql import SparkSession

    spark = (
        SparkSession.builder.master(os.environ.get("TEST_MASTER", "local[8]"))
        .config("spark.sql.shuffle.partitions", "8").config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC").config("spark.driver.memory", "8g")
        .config("spark.ui.showConsoleProgress", "false").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def main(argv: list[str]) -> int:
    from tallyframe.catalog import REGISTRY, Tables

    folder, wanted = argv[0], argv[1:]
    spark, con, bad = session(), duck(folder), 0
    for name, q in REGISTRY.items():
        if wanted and not any(re.match(f"{w}(_|$)", name) or name.startswith(w) for w in wanted):
            continue
        began = time.time()
        try:
            problems = compare(spark, con, folder, q, Tables)
        except Exception as error:  # noqa: BLE001
            problems = [f"{type(error).__name__}: {str(error)[:700]}"]
        took = time.time() - began
        mark = "ok  " if not problems else "FAIL"
        bad += bool(problems)
        print(f"{mark} {name} {took:.1f}s{'' if q.sql else ' (rows only)'}", flush=True)
        for p in problems:
            print("   ", p, flush=True)
    print("failed:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(min(1, main(sys.argv[1:])))
