"""Run catalogue queries beside their SQL twins.

    python tests/compare.py FOLDER [name ...]
"""

import decimal
import glob
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def connect(folder):
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def plain(value):
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9)
    return value


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda k: names[k])
    return sorted(repr([plain(r[k]) for k in order]) for r in rows)


def compare(spark, con, folder, name, build, sql):
    """Returns (problem or None, rows, Spark seconds, SQL seconds)."""
    start = time.time()
    df = build(spark, folder)
    got = rows_of(df.columns, df.collect())
    spark_time = time.time() - start
    start = time.time()
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    want = rows_of(names, cursor.fetchall())
    sql_time = time.time() - start
    problem = None
    if sorted(names) != sorted(df.columns):
        problem = f"columns {sorted(df.columns)} != {sorted(names)}"
    elif len(got) != len(want):
        problem = f"rows {len(got)} != {len(want)}"
    elif got != want:
        differing = [(a, b) for a, b in zip(got, want) if a != b]
        problem = f"{len(differing)} rows differ, first: {differing[0]}"
    return problem, len(got), spark_time, sql_time


def main():
    import __spark_entry__ as contract
    from pyspark.sql import SparkSession

    folder, *wanted = sys.argv[1:]
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    con = connect(folder)
    bad = 0
    for name, build in contract.queries().items():
        if wanted and name not in wanted:
            continue
        try:
            problem, n, a, b = compare(spark, con, folder, name, build, contract.oracle_sql()[name])
        except Exception as failure:
            problem, n, a, b = f"{type(failure).__name__}: {str(failure)[:600]}", 0, 0, 0
        bad += problem is not None
        print(f"RESULT {'ok ' if problem is None else 'BAD'} {name} rows={n} spark={a:.2f}s sql={b:.2f}s {problem or ''}", flush=True)
    print("RESULT", "all equal" if not bad else f"{bad} differ")


if __name__ == "__main__":
    main()
