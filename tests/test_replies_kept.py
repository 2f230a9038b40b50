"""Replies kept by content: nothing is asked twice, also after a run that was stopped."""

import os

import pytest
from pyspark.sql import functions as F

from samesense import deduplicate
from samesense.operators import model as M
from samesense.storage import store


class Counting:
    """A model that notes every prompt it is asked in a file, and stops at some."""

    def __init__(self, notes, stops=""):
        self.notes, self.stops = notes, stops

    def __call__(self, prompts, max_tokens, **_):
        out = []
        for prompt in prompts:
            with open(self.notes, "a") as notes:
                notes.write(f"{prompt}\n")
            if self.stops and prompt.startswith(self.stops):
                raise RuntimeError("stopped")
            out.append(f"{prompt}/{max_tokens}")
        return out

    def asked(self):
        if not os.path.exists(self.notes):
            return []
        with open(self.notes) as notes:
            return notes.read().splitlines()


@pytest.fixture
def prompts(spark):
    rows = spark.range(60).select("id", F.concat(F.lit("p"), (F.col("id") % 20).cast("string")).alias("prompt"))
    return store(rows, "prompts")


def test_equal_prompts_are_asked_once(prompts, tmp_path):
    model = Counting(str(tmp_path / "notes"))
    folder = str(tmp_path / "kept")
    for _ in range(2):
        got = M.answered_once(prompts, model, folder).collect()
        assert len(got) == 60 and all(r.response == f"{r.prompt}/2048" and r.error is None for r in got)
        assert sorted(model.asked()) == sorted(f"p{i}" for i in range(20))
    # other parameters and another model are other questions
    M.answered_once(prompts, model, folder, max_tokens=5)
    M.answered_once(prompts, model, folder, model="second")
    assert len(model.asked()) == 60


def test_a_stopped_run_goes_on(prompts, tmp_path):
    folder, notes = str(tmp_path / "kept"), str(tmp_path / "notes")
    options = {"group_prompts": 5, "attempts": 1, "batch_prompts": 1, "partitions": 1}
    with pytest.raises(Exception, match="stopped"):
        M.answered_once(prompts, Counting(notes, "p17"), folder, **options)
    kept = {r.key for r in M.known_replies(prompts.sparkSession, folder).collect()} if os.path.exists(folder) else set()
    before = Counting(notes).asked()
    got = M.answered_once(prompts, Counting(notes), folder, **options).collect()
    assert {r.prompt: r.response for r in got} == {f"p{i}": f"p{i}/2048" for i in range(20)}
    again = Counting(notes).asked()[len(before) :]
    # what was committed is not asked again; at most one group is
    assert len(again) == 20 - len(kept) and len(set(again)) == len(again)
    assert len(set(before)) - len(kept) <= 10


def test_failed_prompts_are_asked_again(prompts, tmp_path):
    folder, notes = str(tmp_path / "kept"), str(tmp_path / "notes")
    got = M.answered_once(prompts, Counting(notes, "p17"), folder, on_error="record", attempts=2).collect()
    assert {r.prompt for r in got if r.error} == {"p17"} and all((r.response is None) == (r.prompt == "p17") for r in got)
    before = len(Counting(notes).asked())
    got = M.answered_once(prompts, Counting(notes), folder).collect()
    assert all(r.error is None for r in got)
    assert Counting(notes).asked()[before:] == ["p17"]


def test_edges(spark, tmp_path):
    model = Counting(str(tmp_path / "notes"))
    empty = spark.createDataFrame([], "prompt string")
    assert M.answered_once(empty, model, str(tmp_path / "none")).count() == 0
    odd = store(spark.createDataFrame([("", 1, "x"), ("+", 2, "x"), ("", 3, "x")], "prompt string, id int, response_ string"), "odd")
    got = M.answered_once(odd, model, str(tmp_path / "odd")).collect()
    assert sorted((r.id, r.response) for r in got) == [(1, "/2048"), (2, "+/2048"), (3, "/2048")]


def names_first(prompts, **_):
    return ['{"duplicates": [], "best_attribute": null}'] * len(prompts)


class CountingJudge(Counting):
    def __call__(self, prompts, **options):
        super().__call__([p.replace("\n", " ")[-200:] for p in prompts], 0)
        return names_first(prompts)


def test_a_run_again_asks_nothing(spark, tmp_path):
    rows = spark.range(40).select(
        F.col("id").alias("row_id"),
        F.concat(F.lit("name"), "id").alias("attribute_name"),
        F.concat(F.lit("what "), F.col("id") % 7).alias("attribute_definition"),
    )
    centers = spark.createDataFrame([(0, [1.0] + [0.0] * 63), (1, [0.0] * 63 + [1.0])], "cluster_id int, center array<double>")
    judge = CountingJudge(str(tmp_path / "notes"))
    first = deduplicate(rows, None, judge, centers=centers, replies=str(tmp_path / "kept"))
    asked = len(judge.asked())
    assert asked >= 1 and first.replies.count() >= 1
    again = deduplicate(rows, None, judge, centers=centers, replies=str(tmp_path / "kept"))
    assert len(judge.asked()) == asked and again.replies.count() == first.replies.count()
