from pyspark.sql import functions as F

from samesense import skew
from samesense.skew import hot_keys, lookup, meet, positions


def test_lookup_with_hot_and_null_keys(spark):
    rows = spark.range(900).select(
        F.col("id").alias("row_id"),
        F.when(F.col("id") % 3 == 0, F.lit("hot"))
        .when(F.col("id") % 3 == 1, F.lit(None))
        .otherwise(F.concat(F.lit("k"), F.col("id").cast("string")))
        .alias("key"),
    )
    keyed = rows.where("key is not null").groupBy("key").agg(F.max("row_id").alias("top"))
    hot = hot_keys(rows, ["key"], hot_rows=20)
    assert {r.key for r in hot.collect()} == {"hot", None}
    for how in ("left", "inner"):
        plain = rows.join(keyed, "key", how)
        salted = lookup(rows, keyed, ["key"], ["row_id"], how, hot_rows=20)
        assert sorted(map(tuple, salted.select("row_id", "key", "top").collect()), key=str) == sorted(
            map(tuple, plain.select("row_id", "key", "top").collect()), key=str
        )


def test_positions_equal_row_number(spark):
    rows = spark.range(1000).select(
        (F.col("id") * F.col("id") + 5).alias("at"),
        F.when(F.col("id") % 7 > 0, F.col("id") % 7).alias("g"),
    )
    want = rows.selectExpr("at", "g", "row_number() over (partition by g order by at) as pos")
    for slice_rows in (1000, 77, 3):
        got = positions(rows, "at", ["g"], slice_rows=slice_rows)
        assert sorted(map(str, got.select("at", "g", "pos").collect())) == sorted(
            map(str, want.collect())
        )
    assert positions(rows.where("at < 0"), "at").count() == 0


def test_slices_follow_the_rows_not_the_ids(spark):
    """Ids as read from files: long gaps between splits. No slice may hold a whole split."""
    rows = spark.range(4000).select(
        F.shiftleft(F.floor(F.col("id") / 2000), 33).bitwiseOR(F.col("id") % 2000).alias("at")
    )
    got = positions(rows, "at", slice_rows=100)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "_slice" in plan
    want = rows.selectExpr("at", "row_number() over (order by at) as pos")
    assert got.exceptAll(want).count() == 0 and got.count() == 4000
    sizes = skew.sliced(rows, "at", 100).groupBy("_slice").count()
    assert sizes.count() >= 30 and sizes.agg(F.max("count")).first()[0] <= 250


def test_salts_follow_the_size_of_the_key(spark, monkeypatch):
    monkeypatch.setattr(skew, "SALT_ROWS", 50)
    rows = spark.range(900).select(F.when(F.col("id") < 600, F.lit(1)).otherwise(F.col("id")).alias("key"))
    assert [tuple(r) for r in hot_keys(rows, ["key"], hot_rows=20).collect()] == [(1, 12)]


def test_lookup_by_counts_of_the_caller(spark):
    rows = spark.range(900).select(F.col("id"), F.when(F.col("id") < 600, F.lit(1)).otherwise(F.col("id")).alias("key"))
    keyed = rows.groupBy("key").agg(F.max("id").alias("top"), F.count(F.lit(1)).alias("n"))
    got = lookup(rows, keyed, ["key"], ["id"], hot_rows=20, counted="n")
    want = rows.join(keyed.drop("n"), "key")
    assert sorted(map(tuple, got.select("id", "key", "top").collect())) == sorted(
        map(tuple, want.select("id", "key", "top").collect())
    )


def test_meet_with_keys_hot_on_either_side(spark, monkeypatch):
    monkeypatch.setattr(skew, "SALT_ROWS", 20)
    left = spark.range(200).select(F.col("id").alias("a"), F.when(F.col("id") < 90, F.lit(1)).otherwise(F.col("id") % 9).alias("key"))
    right = spark.range(200).select(F.col("id").alias("b"), F.when(F.col("id") < 70, F.lit(2)).when(F.col("id") < 110, F.lit(1)).otherwise(F.col("id") % 11).alias("key"))
    got = meet(left, right, ["key"], ["a"], ["b"], hot_rows=30)
    want = left.join(right, "key").select("key", "a", "b")
    assert got.select("key", "a", "b").exceptAll(want).count() == 0 and got.count() == want.count()
