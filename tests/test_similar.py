"""Similar groups against brute force, and components against a plain union-find."""

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from samesense.operators import similar
from samesense.operators.components import components
from samesense.operators.similar import large_block_edges, pairs_in_cells, place_in_cells, similar_groups
from samesense.storage import store


def roots_of(nodes, edges):
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in edges:
        x, y = find(a), find(b)
        if x != y:
            parent[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}


def brute_force(ids, blocks, vectors, threshold):
    unit = vectors / np.linalg.norm(vectors, axis=1)[:, None]
    near = (unit @ unit.T >= threshold) & (blocks[:, None] == blocks[None, :])
    np.fill_diagonal(near, False)
    a, b = np.nonzero(near)
    roots = roots_of(ids.tolist(), zip(ids[a].tolist(), ids[b].tolist()))
    touched = set(ids[a].tolist())
    return {n: r for n, r in roots.items() if n in touched}


def make(spark, n, centers, spread, seed, blocks=2, copies=10, dims=12):
    rng = np.random.default_rng(seed)
    points = rng.normal(size=(centers, dims))
    vectors = points[rng.integers(0, centers, n)] + spread * rng.normal(size=(n, dims))
    vectors[:copies] = vectors[0]
    block = rng.integers(0, blocks, n)
    block[:copies] = 0
    ids = rng.permutation(n * 3)[:n].astype(np.int64)
    rows = [
        (int(i), int(b), [float(x) for x in v]) for i, b, v in zip(ids, block, vectors)
    ]
    df = spark.createDataFrame(rows, "row_id bigint, block_id int, v array<double>")
    return df, ids, block, vectors


@pytest.mark.parametrize(
    ("centers", "spread", "threshold"),
    [(40, 0.15, 0.97), (5, 0.05, 0.99), (200, 0.3, 0.9), (1, 0.02, 0.999), (300, 1.0, 0.6)],
)
def test_groups_equal_brute_force(spark, centers, spread, threshold):
    df, ids, block, vectors = make(spark, 500, centers, spread, centers)
    want = brute_force(ids, block, vectors, threshold)
    for tile_rows in (1024, 40):
        got = similar_groups(df, "block_id", "v", threshold, tile_rows=tile_rows)
        assert {r.row_id: r.root for r in got.collect()} == want


def test_cells_are_cut_again(spark):
    df, ids, block, vectors = make(spark, 600, 60, 0.2, 3, blocks=1)
    want = brute_force(ids, block, vectors, 0.95)
    unit = similar.fold_copies(df, "block_id", "v").select(
        F.col("block").cast("string").alias("block"), F.lit(600).cast("bigint").alias("size"), "row_id", "unit"
    )
    edges = large_block_edges(unit, 0.95, tile_rows=4, cell_tiles=1, max_levels=3)
    found = {r.node: r.root for r in components(edges, "row_id", "root").collect()}
    lone_copies = set(ids[:10].tolist())
    assert {n: r for n, r in want.items() if n not in lone_copies} == {
        n: r for n, r in found.items() if n not in lone_copies
    }


def test_one_value_may_fill_a_third_of_the_table(spark):
    df, ids, block, vectors = make(spark, 300, 20, 0.2, 9, blocks=1, copies=100)
    got = similar_groups(df, "block_id", "v", 0.97, tile_rows=16)
    assert {r.row_id: r.root for r in got.collect()} == brute_force(ids, block, vectors, 0.97)


def test_zero_vectors_and_lone_rows_have_no_group(spark):
    df = spark.createDataFrame(
        [(1, 1, [0.0, 0.0]), (2, 1, [0.0, 0.0]), (3, 1, [1.0, 0.0]), (4, 2, [1.0, 0.0]), (5, None, [1.0, 0.0])],
        "row_id bigint, block_id int, v array<double>",
    )
    assert similar_groups(df, "block_id", "v", 0.5).collect() == []


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 30), st.integers(0, 30)), min_size=1, max_size=40))
def test_components_equal_union_find(spark, pairs):
    edges = spark.createDataFrame(pairs, "a bigint, b bigint")
    got = {r.node: r.root for r in components(edges, "a", "b").collect()}
    kept = [(a, b) for a, b in pairs if a != b]
    assert got == roots_of({n for e in kept for n in e}, kept)


def test_components_of_a_long_path(spark):
    edges = spark.range(300).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    shuffled = edges.select(
        ((F.col("a") * 7919) % 1009).alias("a"), ((F.col("b") * 7919) % 1009).alias("b")
    )
    got = components(shuffled, "a", "b").collect()
    assert len(got) == 301
    assert len({r.root for r in got}) == 1


def test_blocks_without_structure_stay_uncut(spark):
    """Random unit vectors, some with a twin: placing copies no vector and is bounded, groups are exact."""
    rng = np.random.default_rng(6)
    points = rng.standard_normal((1500, 48))
    points[1450:] = points[:50] + 0.01 * rng.standard_normal((50, 48))
    points /= np.linalg.norm(points, axis=1)[:, None]
    rows = spark.createDataFrame(
        [("b", 1500, i, [float(x) for x in p]) for i, p in enumerate(points)],
        "block string, size bigint, row_id bigint, unit array<double>",
    )
    placed = place_in_cells(rows, 0.9, tile_rows=64, max_visits=4)
    assert "unit" not in placed.columns and placed.count() <= 1500 * 5
    found = {(r.node, r.root) for r in components(large_block_edges(rows, 0.9, tile_rows=64), "row_id", "root").collect()}
    assert found == {(i, i) for i in range(50)} | {(1450 + i, i) for i in range(50)}


@pytest.mark.parametrize(("spread", "max_visits", "unit_rows"), [(0.15, 32, 16), (0.15, 32, 4096), (0.02, 32, 16), (1.0, 2, 32)])
def test_pairs_in_cells_are_counted_not_listed(spark, monkeypatch, spread, max_visits, unit_rows):
    """Each similar pair once, of cells that share rows, of half-radius rows and of slices left uncut; ids may repeat."""
    rng = np.random.default_rng(8)
    points = rng.normal(size=(12, 10))[rng.integers(0, 12, 300)] + spread * rng.normal(size=(300, 10))
    points /= np.linalg.norm(points, axis=1)[:, None]
    ids = np.arange(300) // 2 * (np.arange(300) % 3 > 0) + 1000 * (np.arange(300) % 3 == 0) * np.arange(300)
    rows = spark.createDataFrame(
        [(7, 300, i, int(k), [float(x) for x in p]) for i, (k, p) in enumerate(zip(ids, points))],
        "block int, size bigint, row_id bigint, id bigint, unit array<double>",
    ).localCheckpoint()
    # slices of 100 rows: some may find that cutting does not pay where others do not
    placed = store(place_in_cells(rows, 0.9, tile_rows=8, slice_rows=100, max_visits=max_visits), "placed")
    written = []
    monkeypatch.setattr(similar, "store", lambda df, label: written.append(df.count()) or store(df, label))
    got = pairs_in_cells(placed, rows.drop("size"), 0.9, unit_rows).collect()
    near = (points @ points.T >= 0.9) & (ids[:, None] < ids[None, :])
    assert [(r.block, r.n) for r in got] == [(7, int(near.sum()))]
    assert max(written) <= placed.count()


def test_small_tiles_do_not_multiply_the_copies(spark, monkeypatch):
    """A block without structure is cut at sixteen rows, yet its vectors are not copied once per sixteen rows."""
    df, ids, block, vectors = make(spark, 700, 1, 1.0, 11, blocks=1, copies=1, dims=48)
    grouped = []
    tiles = similar._met_tiles

    def met(counted, tile_rows, *carried):
        grouped.append((counted.count(), tile_rows))
        return tiles(counted, tile_rows, *carried)

    monkeypatch.setattr(similar, "_met_tiles", met)
    got = similar_groups(df, "block_id", "v", 0.55, tile_rows=16)
    assert {r.row_id: r.root for r in got.collect()} == brute_force(ids, block, vectors, 0.55)
    assert sum(rows * -(-700 // tile) for rows, tile in grouped) <= 2 * 700
    # units of bounded size give the same
    unit = similar.fold_copies(df, "block_id", "v").select(
        F.col("block").cast("string").alias("block"), F.lit(700).cast("bigint").alias("size"), "row_id", "unit"
    )
    for unit_rows in (64, 4096):
        edges = large_block_edges(unit, 0.55, tile_rows=16, unit_rows=unit_rows)
        found = {r.node: r.root for r in components(edges, "row_id", "root").collect()}
        assert found == brute_force(ids, block, vectors, 0.55)


def test_copies_of_a_large_block_grow_with_its_rows(spark, monkeypatch):
    """However many tiles its rows would fill, a row of a block without structure is copied sixteen times at most."""
    df, ids, block, vectors = make(spark, 700, 1, 1.0, 11, blocks=1, copies=1, dims=48)
    unit = similar.fold_copies(df, "block_id", "v").select(
        F.col("block").cast("string").alias("block"), F.lit(700).cast("bigint").alias("size"), "row_id", "unit"
    )
    dealt = []
    tiles = similar._met_tiles

    def met(*args):
        units = tiles(*args)
        dealt.append(units.count().agg(F.sum("count")).first()[0] or 0)
        return units

    monkeypatch.setattr(similar, "_met_tiles", met)
    edges = large_block_edges(unit, 0.55, tile_rows=4, unit_rows=8)
    found = {r.node: r.root for r in components(edges, "row_id", "root").collect()}
    assert found == brute_force(ids, block, vectors, 0.55)
    assert sum(dealt) <= 700 * 16


@pytest.mark.parametrize(
    ("rows", "spread", "threshold"), [(1500, 1.0, 0.6), (1500, 0.05, 0.99), (9000, 0.3, 0.9), (1500, 0.2, -0.5), (40, 0.1, 0.97)]
)
def test_linked_rows_equal_brute_force(rows, spread, threshold):
    """Within a tile and across two, sparse and dense; exact ties count, vectors that are not finite link nothing."""
    rng = np.random.default_rng(rows)
    vectors = rng.normal(size=(20, 10))[rng.integers(0, 20, rows)] + spread * rng.normal(size=(rows, 10))
    vectors /= np.linalg.norm(vectors, axis=1)[:, None]
    vectors[:20] = 0.0
    vectors[np.arange(20), np.arange(20) % 10] = 1.0
    vectors[[5, 30]] = np.nan
    near = vectors @ vectors.T >= threshold
    everywhere, half = np.arange(rows), rows // 2
    for left, right, same in ((everywhere, everywhere, True), (everywhere[:half], everywhere[half:], False)):
        edges = np.zeros((rows, rows), bool)
        edges[np.ix_(left, right)] = near[np.ix_(left, right)]
        np.fill_diagonal(edges, True)
        assert np.array_equal(similar._linked(vectors, left, right, same, threshold), similar._local_groups(everywhere, edges | edges.T)[1])
    if threshold > 0:
        angle = np.array([[1.0, 0.0], [threshold, np.sqrt(1 - threshold**2)]])
        tie = similar._linked(angle, np.arange(2), np.arange(2), True, threshold)
        assert tie.tolist() == [0, 0 if (angle @ angle.T)[0, 1] >= threshold else 1]
