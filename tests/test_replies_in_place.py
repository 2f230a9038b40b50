"""Replies that are read where they are given say the same as replies that are written."""

import json

from pyspark.sql import functions as F

from samesense.operators import prompts as P
from samesense.plans import dedup


def odd_judge(prompts, **_):
    """Groups by last letter, with names that are made up, of another page, or without an id."""
    replies = []
    for prompt in prompts:
        names = [s.split("Name: ", 1)[1].split(" | ", 1)[0] for s in prompt.splitlines() if ". Name: " in s]
        items = [{"attribute_name": n, "is_duplicate": True, "duplicate_group_id": n[-1]} for n in names if n[-1] in "123"]
        items += [{"attribute_name": "made up", "is_duplicate": True, "duplicate_group_id": "1"}]
        # none of these is on a page with a name that ends in 7
        if any(n.endswith("7") for n in names):
            items += [{"attribute_name": n, "is_duplicate": True, "duplicate_group_id": "far"} for n in ("name 4", "name 5")]
            items += [{"attribute_name": "name 8", "is_duplicate": True, "duplicate_group_id": [1]}]
            items += [{"attribute_name": "name 9", "is_duplicate": True, "duplicate_group_id": [1]}]
        replies.append("said" if "broken" in prompt else json.dumps({"duplicates": items}))
    return replies


def rows_of(spark):
    # names of the second cluster repeat those of the first, and rows repeat
    ids = spark.range(90).select(F.col("id").alias("row_id"), (F.col("id") % 2).cast("int").alias("cluster_id"))
    number = F.floor(F.col("row_id") / 2) % 31
    return ids.select(
        "row_id",
        "cluster_id",
        F.when(F.col("row_id") != 7, F.concat(F.lit("name "), number.cast("string"))).alias("attribute_name"),
        F.when(number != 6, F.concat(F.lit("about "), (number % 5).cast("string"))).alias("attribute_definition"),
    )


def test_same_as_written(spark, monkeypatch):
    rows = rows_of(spark)
    written = dedup.detect_duplicates(rows, odd_judge, page_rows=6, hand_out=True)
    monkeypatch.setattr(P, "TASK_LINES", 6)
    found = dedup.detect_duplicates(rows, odd_judge, page_rows=6)
    columns = sorted(written.columns)
    order = lambda df: sorted(map(repr, df.select(*columns).collect()))
    assert order(found) == order(written)
    assert found.where("duplicate_group_id is not null").count() > 20


def test_no_prompt_is_written(spark, monkeypatch):
    stored = []
    for module in (dedup, dedup.V, P):
        write = module.store
        monkeypatch.setattr(module, "store", lambda df, label, write=write: stored.append((label, df.columns)) or write(df, label))
    monkeypatch.setattr(P, "TASK_LINES", 6)
    monkeypatch.setattr(dedup, "answered", None)
    dedup.detect_duplicates(rows_of(spark), odd_judge, page_rows=6).collect()
    assert stored and not any({"prompt", "response", "listing"} & set(columns) for _, columns in stored)
