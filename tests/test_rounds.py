"""Rounds over an index of survivors against runs over the union."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from samesense import deduplicate, deduplicate_incremental
from samesense.plans.rounds import Rounds

TEXTS = "row_id bigint, attribute_name string, attribute_definition string"


def batches(seed):
    rng = np.random.default_rng(seed)
    words = [f"word{i}" for i in range(12)]
    base = [" ".join(rng.choice(words, 5)) for _ in range(12)]
    out = []
    for _ in range(3):
        rows = []
        for i in range(24):
            text = base[rng.integers(len(base))]
            if rng.random() < 0.5:
                text += f" {rng.choice(words)}"
            rows.append((i, f"name{rng.integers(6)}", text if rng.random() < 0.95 else None))
        out.append(rows)
    return out


def facts(rows):
    """What rows say; their ids differ, as a run over the union numbers new rows after the survivors."""
    return sorted((r.attribute_name, r.attribute_definition or "", r.first_seen_in_round) for r in rows)


@pytest.mark.parametrize("seed", [1])
def test_rounds_equal_runs_over_the_union(spark, seed):
    rng = np.random.default_rng(seed)
    centers = spark.createDataFrame([(i, [float(x) for x in rng.random(64)]) for i in range(3)], "cluster_id int, center array<double>")
    rounds, result = Rounds(spark, centers, threshold=0.9), None
    options = {"centers": centers, "threshold": 0.9, "drop_same_name": True}
    for number, rows in enumerate(batches(seed), 1):
        batch = spark.createDataFrame(rows, TEXTS)
        judged = rounds.add(batch).collect()
        if result is None:
            result = deduplicate(batch, **options).result
        else:
            result = deduplicate_incremental(result, batch, round_number=number, **options).result
        want = result.collect()
        assert facts(rounds.survivors.collect()) == facts([r for r in want if not r.should_remove])
        assert facts([r for r in judged if r.should_remove]) == facts([r for r in want if r.should_remove])
        assert facts([r for r in judged if r.is_duplicate]) == facts([r for r in want if r.is_duplicate])
        assert all(r.source == "new" or r.is_duplicate for r in judged)
    assert rounds.survivors.count() < 3 * 24


def test_an_empty_batch_and_a_zero_vector(spark):
    rows = [(0, 1, "a", "x", [1.0, 0.0]), (1, 1, "b", "x", [0.0, 0.0]), (2, 1, "c", "y", [1.0, 0.0]), (3, 1, "d", "y", [0.0, 0.0])]
    kind = "row_id bigint, cluster_id int, attribute_name string, attribute_definition string, embedding array<double>"
    rounds = Rounds(spark, threshold=0.9)
    assert rounds.add_embedded(spark.createDataFrame([], kind)).count() == 0
    got = {r.row_id: (r.is_duplicate, r.should_remove) for r in rounds.add_embedded(spark.createDataFrame(rows, kind)).collect()}
    assert got == {0: (True, False), 1: (False, False), 2: (True, True), 3: (False, False)}
    again = rounds.add_embedded(spark.createDataFrame(rows[:1], kind)).collect()
    assert sorted((r.row_id, r.source, r.should_remove) for r in again) == [(0, "existing", False), (4, "new", True)]
    assert {r.duplicate_group_id for r in again} == {"cluster_1_group0"}
    with pytest.raises(ValueError):
        rounds.add(spark.createDataFrame([(1, "a", "b")], TEXTS))
    assert rounds.survivors.where(F.col("row_id") == 0).count() == 1
