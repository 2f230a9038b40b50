"""Filters as data: every key is found, few others are, and the plan stays small."""

import time

from pyspark.sql import functions as F

from samesense.llm import bloom


def test_a_million_keys_plan_and_run_in_seconds(spark):
    keys = spark.range(0, 2_000_000, 2).select(F.xxhash64("id").alias("key"))
    start = time.time()
    level = bloom.build(keys, 1_000_000, 0.01, 1, 32 << 20)
    rows = spark.range(2_000_000)
    held = rows.where(bloom.admits(F.xxhash64("id"), level))
    assert time.time() - start < 30
    odd, even = (held.where(f"id % 2 = {side}").count() for side in (1, 0))
    assert even == 1_000_000 and odd < 20_000
    assert len(held._jdf.queryExecution().toString()) < 20_000


def test_split_keeps_every_row_once(spark):
    rows = spark.range(5000).select(F.when(F.col("id") % 7 > 0, F.col("id")).alias("id"))
    keys = spark.range(0, 5000, 5).select(F.xxhash64("id").alias("key"))
    likely, other = bloom.split(rows, F.xxhash64("id"), keys, 1000)
    assert likely.count() + other.count() == 5000
    assert other.where("id % 5 = 0").count() == 0


def test_words_bound_for_lambdas(spark):
    levels = [bloom.build(spark.range(n).select(F.col("id").alias("key")), n, 0.01, s, 1 << 20) for s, n in ((1, 100), (2, 50))]
    both = lambda words: F.filter(
        "ids", lambda x: bloom.admits(x, levels[0], words[0]) & bloom.admits(x, levels[1], words[1])
    )
    rows = spark.range(3).select(F.sequence(F.lit(0).cast("bigint"), F.lit(199).cast("bigint")).alias("ids"))
    found = bloom.with_words(rows, "found", levels, both)
    for row in found.collect():
        assert set(range(50)) <= set(row["found"]) and len(row["found"]) < 60
    # one projection: no row carries the words
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.split("scalar-subquery")[0].count("Project [") == 1, plan
    assert bloom.with_words(rows, "found", [], lambda words: F.lit(len(words))).first()["found"] == 0


def test_too_many_keys_for_the_bound(spark):
    keys = spark.range(10_000).select(F.col("id").alias("key"))
    try:
        bloom.build(keys, 10_000, 0.01, 1, 1000)
        raise AssertionError("no error")
    except ValueError:
        pass
    shrunk = bloom.build(keys, 10_000, 0.01, 1, 1000, shrink=True)
    assert shrunk.size == 125
    assert keys.where(bloom.admits(F.col("key"), shrunk)).count() == 10_000
