"""What a run with models leaves behind, and how it takes failures and copies."""

import json
import os

import pytest
from pyspark.sql import functions as F

from samesense import deduplicate, deduplicate_incremental, detect_duplicates
from samesense.operators.model import PerWorker, answered
from samesense.plans.dedup import write_all
from samesense.sources.sample import sample_attributes
from samesense.storage import checkpoint_folder


def listed(prompt):
    return [s.split("Name: ")[1].split(" | ")[0] for s in prompt.splitlines() if "Name: " in s]


def all_alike(prompts, **_):
    return [
        json.dumps({"duplicates": [{"attribute_name": n, "is_duplicate": True, "duplicate_group_id": "g"} for n in listed(p)]})
        for p in prompts
    ]


def refuses_bad(prompts, **_):
    if any("bad" in p for p in prompts):
        raise RuntimeError("refused")
    return all_alike(prompts)


def first_listed(prompts, **_):
    return [json.dumps({"best_attribute": listed(p)[0]}) for p in prompts]


def rows_of(spark, rows):
    return spark.createDataFrame(rows, "row_id bigint, cluster_id int, attribute_name string, attribute_definition string")


ROWS = [
    (0, 0, "a", "x"), (1, 0, "b", "y"), (2, 0, "a", "z"),
    (3, 1, "bad one", "x"), (4, 1, "bad two", "y"),
    (5, 2, "copy", "same"), (6, 2, "copy", "same"),
    (7, 3, "alone", "x"),
]


def test_copies_alone_are_judged(spark):
    got = {r.row_id: r for r in detect_duplicates(rows_of(spark, ROWS), judge=all_alike).collect()}
    assert got[5].is_duplicate and got[6].is_duplicate and got[5].duplicate_group_id == "cluster_2_group1"
    assert not got[7].is_duplicate and got[7].keep


def test_a_failed_prompt_costs_its_own_block_only(spark):
    got = {r.row_id: r for r in detect_duplicates(rows_of(spark, ROWS), judge=refuses_bad).collect()}
    assert [got[i].is_duplicate for i in (0, 1, 2, 3, 4, 5, 6)] == [True] * 3 + [False] * 2 + [True] * 2


def test_same_name_rows_can_go_on_the_model_path(spark):
    out = detect_duplicates(rows_of(spark, ROWS), judge=all_alike, drop_same_name=True)
    kept = {r.row_id for r in out.where("keep").collect()}
    assert len(kept & {0, 1, 2}) == 1 and kept & {5, 6} == {5} and 7 in kept


def test_page_size_is_packing_only(spark):
    rows = sample_attributes(spark, 60).withColumn("cluster_id", (F.col("row_id") / 20).cast("int"))
    results = [
        sorted(map(str, detect_duplicates(rows, judge=all_alike, page_rows=n).select("row_id", "duplicate_group_id", "keep").collect()))
        for n in (200, 7)
    ]
    assert results[0] == results[1]


def make_model():
    made = []

    def model(prompts, **_):
        made.append(1)
        return [f"{len(made)}" for _ in prompts]

    return model


def test_a_model_is_built_where_it_is_used(spark):
    prompts = spark.range(40).select(F.col("id").cast("string").alias("prompt")).repartition(1)
    got = answered(prompts, PerWorker(make_model), "built", partitions=1, batch_prompts=10)
    assert {r.response for r in got.collect()} == {"1", "2", "3", "4"}


@pytest.fixture(scope="module")
def run(spark):
    return deduplicate(sample_attributes(spark, 30), None, refuses_bad, first_listed, max_clusters=3)


def test_artefacts_are_handed_out(run):
    assert run.replies.where("response IS NULL").count() == run.summary.first()["failed_prompts"] == 0
    names = {n for r in run.records.collect() for n in r["attributes"]}
    assert names == {r["attribute_name"] for r in run.result.collect()}
    assert run.best.where("best_attribute IS NULL").count() == 0
    assert run.choices.where("context LIKE 'best_attribute_%'").count() == run.choices.count() > 0


def test_everything_is_written(run, spark, tmp_path):
    folder = str(tmp_path / "out")
    for _ in range(2):  # the second time replaces the run, but not the plain files
        write_all(run, f"{folder}/{_}", "run1", "sample", config={"max_clusters": "3"})
    read = spark.read.parquet(f"{folder}/0/runs")
    assert read.count() == 30 and spark.read.parquet(f"{folder}/0/embeddings").count() == 30
    assert spark.read.json(f"{folder}/0/clustering_results").first()["n_clusters"] == 3
    assert spark.read.json(f"{folder}/0/duplicates").count() == run.records.count()
    assert spark.read.parquet(f"{folder}/0/detect_replies").where("context LIKE 'detect_%'").count() == run.replies.count()
    assert spark.read.json(f"{folder}/0/run_metadata").first()["stats"]["total_attributes"] == 30


def fails_on_old(texts):
    raise RuntimeError("an old row was embedded again")


def make_failing():
    return fails_on_old


def test_stored_vectors_are_used_again(run, spark):
    vectors = run.blocks.rows.select("row_id", "embedding")
    again = deduplicate(sample_attributes(spark, 30), make_failing, max_clusters=3, vectors=vectors, threshold=0.9)
    assert again.result.count() == 30
    batch = sample_attributes(spark, 5).withColumn("attribute_name", F.concat(F.lit("new "), "attribute_name"))
    more = deduplicate_incremental(run.result, batch, vectors=vectors, max_clusters=3, threshold=0.9)
    assert more.result.where("source = 'new'").count() == 5


def stored_tables(spark):
    folder = f"{checkpoint_folder(spark).removeprefix('file:')}/samesense"
    return set(os.listdir(folder)) if os.path.isdir(folder) else set()


def test_nothing_but_what_is_handed_out_stays(spark):
    before = stored_tables(spark)
    done = deduplicate(sample_attributes(spark, 30), None, all_alike, first_listed, max_clusters=3)
    left = {name.rsplit("-", 1)[0] for name in stored_tables(spark) - before}
    assert left <= {"result", "clustered", "replies", "best", "all-choices"}, left
    # all of it can still be read
    assert done.result.count() == 30 and done.blocks.rows.count() == 30 and done.metrics().count() == 1
    assert done.records.count() == done.replies.count() and done.best.count() > 0 and done.choices.count() > 0
    before = stored_tables(spark)
    deduplicate(sample_attributes(spark, 30), max_clusters=3).result.count()
    assert {name.rsplit("-", 1)[0] for name in stored_tables(spark) - before} <= {"result", "clustered", "best"}
