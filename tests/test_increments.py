"""Groups that grow round by round against groups of all rows at once."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from samesense.operators import increments as I
from samesense.operators.similar import similar_groups


def rows_of(spark, seed, n, blocks=3, dims=6):
    rng = np.random.default_rng(seed)
    centers = rng.normal(size=(n // 6, dims))
    rows = []
    for i in rng.permutation(n):
        kind = rng.random()
        v = centers[rng.integers(len(centers))] + 0.25 * rng.normal(size=dims)
        if kind < 0.2:
            v = centers[rng.integers(3)]  # copies
        rows.append((int(i), int(rng.integers(blocks)), [float(x) for x in v] if kind < 0.97 else [0.0] * dims))
    return spark.createDataFrame(rows, "row_id bigint, block int, v array<double>"), rng


def labels(df):
    return {r.row_id: r.root for r in df.collect()}


@pytest.mark.parametrize("seed,rounds", [(1, 4), (2, 3)])
def test_any_rounds_equal_one_run(spark, monkeypatch, seed, rounds):
    monkeypatch.setattr(I, "CELL_ROWS", 8)
    df, rng = rows_of(spark, seed, 160)
    part = F.pmod(F.xxhash64("row_id", F.lit(seed)), F.lit(rounds))
    index = I.GroupIndex(spark, 0.9)
    for done in range(rounds):
        changed = index.add(df.where(part == done), "block", "v")
        assert changed.columns == ["old", "root"]
        assert labels(index.groups()) == labels(similar_groups(df.where(part <= done), "block", "v", 0.9))


def test_work_follows_the_batch(spark, monkeypatch):
    """A batch in one corner of one block is not compared with the rest."""
    monkeypatch.setattr(I, "CELL_ROWS", 16)
    rng = np.random.default_rng(5)
    centers = np.eye(12)
    rows = [(i, i % 4, [float(x) for x in centers[i % 12] + 0.02 * rng.normal(size=12)]) for i in range(480)]
    old = spark.createDataFrame(rows, "row_id bigint, block int, v array<double>")
    index = I.GroupIndex(spark, 0.95)
    index.add(old, "block", "v")
    batch = spark.createDataFrame([(1000, 1, rows[13][2]), (1001, 9, rows[0][2])], old.schema)
    changed = {r.old: r.root for r in index.add(batch, "block", "v").collect()}
    assert index.compared <= 130
    assert changed == {1000: labels(index.groups())[13]}
    assert labels(index.groups()) == labels(similar_groups(old.unionByName(batch), "block", "v", 0.95))


def test_a_bridge_merges_old_groups(spark):
    at = lambda degrees: [float(np.cos(np.radians(degrees))), float(np.sin(np.radians(degrees)))]
    frame = lambda rows: spark.createDataFrame(rows, "row_id bigint, block int, v array<double>")
    index = I.GroupIndex(spark, float(np.cos(np.radians(10))))
    index.add(frame([(5, 1, at(0)), (6, 1, at(8)), (7, 1, at(24)), (8, 1, at(30)), (9, 2, at(15))]), "block", "v")
    assert labels(index.groups()) == {5: 5, 6: 5, 7: 7, 8: 7}
    changed = index.add(frame([(3, 1, at(16))]), "block", "v")
    assert {r.old: r.root for r in changed.collect()} == {5: 3, 7: 3}
    assert labels(index.groups()) == {3: 3, 5: 3, 6: 3, 7: 3, 8: 3}
    assert index.add(frame([(50, 2, at(80))]), "block", "v").count() == 0


def test_empty_batches(spark):
    index = I.GroupIndex(spark, 0.9)
    empty = spark.createDataFrame([], "row_id bigint, block int, v array<double>")
    assert index.add(empty, "block", "v").count() == 0
    assert index.groups().count() == 0
    index.add(spark.createDataFrame([(1, 1, [1.0, 0.0]), (2, 1, [1.0, 0.0])], empty.schema), "block", "v")
    assert labels(index.groups()) == {1: 1, 2: 1}
    assert index.add(empty, "block", "v").count() == 0
    assert labels(index.groups()) == {1: 1, 2: 1}
