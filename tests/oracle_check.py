"""Run registered queries next to their SQL and compare the rows.

``python tests/oracle_check.py [sf_dir] [query ...]``
"""

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


EXACT = bool(os.environ.get("EXACT"))


def connect(folder):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def _value(value):
    if isinstance(value, bool):
        return value
    if isinstance(value, (int, float)):
        value = float(value)
        if EXACT:
            return repr(value)
        return "nan" if math.isnan(value) else round(value, 9) + 0.0
    if value is not None and type(value).__name__ == "Decimal":
        return round(float(value), 9)
    return value


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    named = [columns[i] for i in order]
    values = [tuple(_value(row[i]) for i in order) for row in rows]
    return named, sorted(values, key=lambda row: tuple((v is None, str(type(v)), v) if v is not None else (True, "", 0) for v in row))


def compare(df, con, statement):
    """None if equal, else a text that says what differs."""
    got_columns, got = canonical(df.columns, [tuple(row) for row in df.collect()])
    found = con.execute(statement)
    want_columns, want = canonical([d[0] for d in found.description], found.fetchall())
    if got_columns != want_columns:
        return f"columns {got_columns} != {want_columns}"
    if len(got) != len(want):
        return f"{len(got)} rows, SQL has {len(want)}"
    for g, w in zip(got, want):
        if g != w:
            differing = [(n, a, b) for n, a, b in zip(got_columns, g, w) if a != b]
            count = sum(1 for a, b in zip(got, want) if a != b)
            return f"{count} rows differ, first in {differing[:4]}: {g}"
    return None


if __name__ == "__main__":
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC").config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    sql = entry.oracle_sql()
    bad = 0
    for name, build in entry.queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            if name in sql:
                problem = compare(build(spark, folder), con, sql[name])
                state = "ok" if problem is None else problem
            else:
                state = f"rows only: {len(build(spark, folder).collect())}"
        except Exception as error:  # noqa: BLE001
            state = f"ERROR {type(error).__name__}: {str(error)[:600]}"
        bad += not (state == "ok" or state.startswith("rows only"))
        print(f"{name:28s} {time.time() - start:6.2f}s  {state}", flush=True)
    print("failures:", bad, "missing queries:", sorted(set(sql) - set(entry.queries())))
    sys.exit(bool(bad))
