"""Run named queries on Spark and their SQL on DuckDB and compare.

    python tests/compare.py /root/testdata/sf0.01 [name prefix ...]
"""

from __future__ import annotations

import glob
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def connect(folder):
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    if value is None:
        return "NULL"
    return repr(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(plain(r[i]) for i in order) for r in rows)


def spark_kinds(df):
    return {f.name: f.dataType.simpleString() for f in df.schema.fields}


SAME = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
    "boolean": "BOOLEAN", "float": "FLOAT",
}


def compare(df, connection, sql):
    """Empty text if equal, else what differs."""
    got = df.collect()
    relation = connection.execute(sql)
    names = [d[0] for d in relation.description]
    kinds = {d[0]: str(d[1]) for d in relation.description}
    want = relation.fetchall()
    left = rows_of(df.columns, got)
    right = rows_of(names, want)
    if left[0] != right[0]:
        return f"columns {left[0]} / {right[0]}"
    for name, kind in spark_kinds(df).items():
        if SAME.get(kind, kind) != kinds[name]:
            return f"type of {name}: {kind} / {kinds[name]}"
    if left[1] != right[1]:
        extra = [r for r in left[1] if r not in set(right[1])][:2]
        lacking = [r for r in right[1] if r not in set(left[1])][:2]
        return f"rows {len(left[1])} / {len(right[1])}: {str(extra)[:400]} / {str(lacking)[:400]}"
    return "" if left[1] else "EMPTY"


def main(folder, prefixes):
    from pyspark.sql import SparkSession

    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    from samesense.catalog import QUERIES, SQL

    connection = connect(folder)
    bad = 0
    for name, run in QUERIES.items():
        if prefixes and not any(name.startswith(p) for p in prefixes):
            continue
        start = time.time()
        try:
            df = run(spark, folder)
            if name in SQL:
                problem = compare(df, connection, SQL[name])
            else:
                problem = f"no sql, {df.count()} rows"
        except Exception as error:
            problem = f"{type(error).__name__} {str(error)[:700]}"
        bad += bool(problem) and not problem.startswith("no sql")
        print(f"{name:34s} {time.time() - start:6.1f}s {problem or 'ok'}", flush=True)
    print("problems:", bad)


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2:])
