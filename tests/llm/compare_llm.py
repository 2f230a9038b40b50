"""As ``tests/compare.py``, for the queries of ``llm``: python tests/llm/compare_llm.py FOLDER PREFIX..."""

import os
import sys
import time

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path[:0] = [os.path.dirname(HERE), os.path.dirname(os.path.dirname(HERE))]

from compare import compare, connect  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402

import __spark_entry__  # noqa: E402


def main(folder, prefixes):
    shared = os.environ.get("SHARED", "/tmp/samesense-shared")
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.checkpoint.dir", shared)
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(folder)
    sql = __spark_entry__.oracle_sql()
    for name, run in __spark_entry__.queries().items():
        if not any(name.startswith(p) for p in prefixes):
            continue
        start = time.time()
        df = run(spark, folder)
        problem = compare(df, connection, sql[name]) if name in sql else f"no sql, {df.count()} rows"
        print(f"{name:34s} {time.time() - start:6.1f}s {problem or 'ok'}", flush=True)


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2:])
