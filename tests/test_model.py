"""Model calls, prompt pages and the choice of survivors."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from samesense.operators import embed as E
from samesense.operators import model as M
from samesense.operators import prompts as P
from samesense.operators import survivors as S


def fails_on_three(prompts, **_):
    if "3" in prompts:
        raise RuntimeError("bad prompt")
    return [p * 2 for p in prompts]


def echo(prompts, **options):
    return [json.dumps(options, sort_keys=True)] * len(prompts)


def too_few(prompts, **_):
    return []


def test_errors_are_recorded_or_raised(spark):
    prompts = spark.range(8).select(F.col("id").cast("string").alias("prompt"))
    out = {r.prompt: r for r in M.infer(prompts, fails_on_three, on_error="record").collect()}
    assert out["3"].response is None and out["3"].attempts == 3 and "bad prompt" in out["3"].error
    assert all(r.response == p * 2 and r.error is None for p, r in out.items() if p != "3")
    with pytest.raises(Exception, match="bad prompt"):
        M.infer(prompts, fails_on_three).collect()
    with pytest.raises(Exception, match="replies to"):
        M.infer(prompts, too_few).collect()
    with pytest.raises(ValueError):
        M.infer(prompts, echo, on_error="ignore")


def test_options_reach_the_model(spark):
    prompts = spark.createDataFrame([("x",)], "prompt string")
    row = M.infer(prompts, echo, temperature=0.7).first()
    assert json.loads(row.response) == {"max_tokens": 2048, "repeat_penalty": 1.2, "temperature": 0.7}


def test_batches_are_bounded():
    prompts = ["a" * 40] * 10
    parts = list(M._batches(prompts, 4, 1000))
    assert [p.stop - p.start for p in parts] == [4, 4, 2]
    assert [p.stop - p.start for p in M._batches(prompts, 100, 25)] == [2] * 5
    assert [p.stop - p.start for p in M._batches(["a" * 4000, "b"], 8, 10)] == [1, 1]


@pytest.mark.parametrize("rows", [9, 10, 11, 23])
def test_every_two_rows_share_a_page(spark, rows):
    df = spark.range(rows).select(
        F.col("id").alias("row_id"),
        F.lit(1).alias("cluster_id"),
        F.format_string("n%02d", "id").alias("attribute_name"),
        F.lit("d").alias("attribute_definition"),
    )
    pages = P.listings(df, page_rows=10).collect()
    assert all(p.n_rows <= 10 for p in pages)
    assert {p.pages for p in pages} == {len(pages)}
    together = set()
    for page in pages:
        names = [line.split("Name: ")[1].split(" | ")[0] for line in page.listing.split("\n")]
        together |= {(a, b) for a in names for b in names if a < b}
    assert len(together) == rows * (rows - 1) // 2


def last_listed(prompts, **_):
    names = [[s.split("Name: ")[1].split(" | ")[0] for s in p.splitlines() if "Name: " in s] for p in prompts]
    return [json.dumps({"best_attribute": n[-1]}) for n in names]


def test_large_groups_are_decided_in_rounds(spark):
    rows = spark.range(30).select(
        F.col("id").alias("row_id"),
        F.format_string("n%02d", "id").alias("attribute_name"),
        F.lit("d").alias("attribute_definition"),
    )
    members = rows.select(
        F.when(F.col("row_id") < 25, "big").otherwise("small").alias("group_id"),
        "attribute_name",
        F.col("row_id").alias("seq"),
    )
    best = S.model_best(members, rows, last_listed, page_rows=4).collect()
    assert {r.group_id: r.best_attribute for r in best} == {"big": "n24", "small": "n29"}


def test_existing_rows_win_by_round_then_order(spark):
    rows = spark.createDataFrame(
        [
            (0, "a", "long definition", "new", "1"),
            (1, "b", "d", "existing", "x"),
            (2, "c", "d", "existing", "3"),
            (3, "e", "d", "existing", "2"),
            (4, "f", "d", "existing", "2"),
            (5, "g", "d", "new", "1"),
        ],
        "row_id bigint, attribute_name string, attribute_definition string, source string, first_seen_in_round string",
    )
    members = rows.select(
        F.when(F.col("row_id") < 5, "g1").otherwise("g2").alias("group_id"), "attribute_name", F.col("row_id").alias("seq")
    )
    assert [tuple(r) for r in S.existing_best(members, rows).collect()] == [("g1", "e")]
    assert {r.group_id: r.best_attribute for r in S.rule_best(members, rows).collect()} == {"g1": "a", "g2": "g"}


def test_batches_of_texts_are_as_wide_as_the_budget():
    texts = ["a" * 40] * 50 + ["b" * 4_000_000] + ["c" * 400] * 20 + [None, ""]
    parts = list(E.token_batches(texts, 16, 400, 512))
    assert sorted(np.concatenate(parts).tolist()) == list(range(len(texts)))
    for part in parts:
        sizes = [min(max(1, len(texts[i] or "") // 4), 512) for i in part]
        assert len(part) <= 16 and (len(part) == 1 or max(sizes) * len(part) <= 400)
    # the long text does not widen the short ones
    assert [i for part in parts if 50 in part for i in part] == [50]


def longest_seen():
    return lambda texts: [[max(len(t) for t in texts), len(texts), len(t)] for t in texts]


def test_embedding_keeps_rows_apart(spark):
    rows = [(i, "x" * (4 * (i % 7) + 4)) for i in range(100)] + [(100, "y" * 100_000)]
    df = spark.createDataFrame(rows, "id int, text string").repartition(3)
    got = {r.id: r.embedding for r in E.embed(df, longest_seen, batch_tokens=64).collect()}
    for i, text in rows:
        widest, together, own = got[i]
        assert own == len(text)
        assert together == 1 if i == 100 else widest // 4 * together <= 64
    cut = {r.id: r.embedding for r in E.embed(df, longest_seen, truncate=True, max_tokens=10).collect()}
    assert cut[100][2] == 40 and cut[3][2] == 16
