"""Side-by-side comparison of a query and its SQL. Usage: python -m tests.oracle [folder] [query ...]"""

from __future__ import annotations

import math
import os
import sys
import time

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def database(folder: str):
    import duckdb

    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _value(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(v + 0.0) if v != 0 else "0.0"
    if isinstance(v, list):
        return [_value(x) for x in v]
    return str(v)


def _kind(name: str) -> str:
    name = name.lower()
    return {
        "integer": "int", "int": "int", "bigint": "bigint", "double": "double", "float": "float", "varchar": "string",
        "string": "string", "boolean": "boolean",
    }.get(name, name)


def spark_result(df):
    order = sorted(df.columns)
    kinds = {f.name: _kind(f.dataType.simpleString()) for f in df.schema}
    rows = [tuple(_value(r[c]) for c in order) for r in df.select(*[f"`{c}`" for c in order]).collect()]
    return order, [kinds[c] for c in order], sorted(map(str, rows))


def sql_result(con, sql: str):
    described = con.execute(f"DESCRIBE {sql}").fetchall()
    kinds = {d[0]: _kind(d[1]) for d in described}
    cur = con.execute(sql)
    names = [d[0] for d in described]
    order = sorted(names)
    at = [names.index(c) for c in order]
    rows = [tuple(_value(r[i]) for i in at) for r in cur.fetchall()]
    return order, [kinds[c] for c in order], sorted(map(str, rows))


def compare(spark, con, name, folder):
    """None if both sides agree, else a message."""
    from cohortframe.catalog import ORACLES, QUERIES

    got = spark_result(QUERIES[name](spark, folder))
    want = sql_result(con, ORACLES[name])
    if got[0] != want[0]:
        return f"columns {got[0]} != {want[0]}"
    if got[1] != want[1]:
        return f"types {list(zip(got[0], got[1], want[1]))}"
    if len(got[2]) != len(want[2]):
        return f"rows {len(got[2])} != {len(want[2])}"
    bad = [(a, b) for a, b in zip(got[2], want[2]) if a != b]
    return f"{len(bad)} of {len(got[2])} rows differ, first {bad[0]}" if bad else None


def session():
    from pyspark.sql import SparkSession

    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


if __name__ == "__main__":
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    from cohortframe.catalog import ORACLES, QUERIES

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark, con = session(), database(folder)
    failed = 0
    for name in names:
        start = time.time()
        try:
            if name in ORACLES:
                message = compare(spark, con, name, folder)
            else:
                message = None if QUERIES[name](spark, folder).count() else "no rows"
        except Exception as e:  # noqa: BLE001
            message = f"{type(e).__name__}: {str(e)[:900]}"
        failed += message is not None
        label = "ok" if message is None else "FAIL"
        print(f"{label:5}{'' if name in ORACLES else '(rows) '}{name} {time.time() - start:.2f}s {message or ''}", flush=True)
    print(f"{len(names) - failed}/{len(names)} agree")
