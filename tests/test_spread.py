"""Tables of one file are dealt over the tasks where the work per row is heavy."""

from pyspark.sql import functions as F

from samesense.catalog import similarity
from samesense.plans import dedup
from samesense.storage import spread


def filled(df):
    """Tasks that have rows."""
    return df.select(F.spark_partition_id().alias("p")).distinct().count()


def test_splits_without_rows_do_not_count(spark, tmp_path):
    """A file of one row group fills one of its splits; a task is asked for per so many rows at most."""
    path = str(tmp_path / "one")
    spark.range(3000).coalesce(1).select("id", F.md5(F.col("id").cast("string")).alias("x")).write.parquet(path)
    spark.conf.set("spark.sql.files.openCostInBytes", 1000)
    spark.conf.set("spark.sql.files.maxPartitionBytes", 10_000)
    try:
        one = spark.read.parquet(path)
        assert one.rdd.getNumPartitions() >= 4 and filled(one) == 1
        for least, tasks in ((100, 4), (1000, 3), (1501, 1), (5000, 1)):
            dealt = spread(one, least)
            assert filled(dealt) == tasks and dealt.count() == 3000
        assert filled(spread(one.where("id < 0"), 10)) == 0
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_a_run_on_a_small_file_uses_the_tasks(spark, tmp_path, monkeypatch):
    spark.range(400).coalesce(1).select(
        F.col("id").alias("p_partkey"), F.concat(F.lit("n"), F.col("id") % 50).alias("p_name"), F.lit("type").alias("p_type"),
        F.lit("brand").alias("p_brand"), (F.col("id") % 50).cast("int").alias("p_size"),
    ).write.parquet(f"{tmp_path}/part.parquet")
    seen = []
    whole = dedup.deduplicate

    def recorded(df, *args, **options):
        seen.append(filled(df))
        return whole(df, *args, **options)

    monkeypatch.setattr(dedup, "deduplicate", recorded)
    monkeypatch.setattr(similarity, "TASK_ROWS", 100)
    assert similarity.pi1_given(spark, str(tmp_path)).count() == 400
    assert seen == [4]
