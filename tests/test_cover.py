"""Pages that cover a block: pairs above the threshold share one, and pages follow the rows."""

from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from samesense.operators import cover
from samesense.operators import prompts as P


def rows_of(spark, blocks):
    rows, i = [], 0
    for block, vectors in blocks.items():
        for v in vectors:
            rows.append((block, i, None if v is None else [float(x) for x in v]))
            i += 1
    return rows, spark.createDataFrame(rows, "cluster_id int, row_id bigint, v array<double>")


def clustered(rng, n, per, dims, spread):
    centers = rng.normal(size=(-(-n // per), dims))
    return (np.repeat(centers, per, axis=0) + spread * rng.normal(size=(len(centers) * per, dims)))[:n]


def checked(spark, blocks, threshold, page_rows):
    rows, df = rows_of(spark, blocks)
    got = cover.covering_pages(df, "v", threshold, page_rows).collect()
    pages = {}
    for r in got:
        pages.setdefault((r.cluster_id, r.page), []).append(r.row_id)
    assert all(len(set(p)) == len(p) <= page_rows for p in pages.values())
    assert {r.row_id for r in got} == {i for _, i, _ in rows}
    where = {}
    for key, members in pages.items():
        for i in members:
            where.setdefault(i, set()).add(key)
    for block in blocks:
        own = [(i, np.array(v) / np.linalg.norm(v)) for b, i, v in rows if b == block and v is not None and np.linalg.norm(v) > 0]
        for (i, x), (j, y) in combinations(own, 2):
            if x @ y >= threshold + 1e-9:
                assert where[i] & where[j], (block, i, j, x @ y)
        numbers = sorted(p for b, p in pages if b == block)
        assert numbers == list(range(len(numbers)))
    return {block: len({p for b, p in pages if b == block}) for block in blocks}


def test_pairs_above_the_threshold_share_a_page(spark):
    rng = np.random.default_rng(1)
    blocks = {
        1: clustered(rng, 300, 5, 8, 0.1),
        2: rng.normal(size=(9, 8)),
        3: [*clustered(rng, 60, 30, 8, 0.05), None, [0.0] * 8, None],
        # a long chain: one group far larger than a page, which cells can cut
        4: [(np.cos(a), np.sin(a)) + (0.0,) * 6 for a in np.linspace(0, 3.0, 400)],
        5: [[1.0] + [0.0] * 7],
    }
    count = checked(spark, blocks, 0.95, 20)
    assert count[2] == count[5] == 1
    assert count[1] <= 2 * 300 / 10 and count[4] < 400 * 399 / 2 / 100


def test_what_cannot_be_cut_is_shown_in_half_pages(spark):
    rng = np.random.default_rng(2)
    same = np.ones(6) + 0.001 * rng.normal(size=(45, 6))
    assert checked(spark, {1: same}, 0.9, 10) == {1: 36}


@pytest.mark.parametrize("n", [200, 400, 800])
def test_pages_grow_with_the_rows(spark, n):
    rng = np.random.default_rng(3)
    count = checked(spark, {1: clustered(rng, n, 4, 12, 0.05)}, 0.9, 20)
    # a page of 20 takes groups that start in its first ten rows
    assert n / 20 <= count[1] <= n / 10 + 1


def test_listings_take_covering_pages(spark):
    rng = np.random.default_rng(4)
    vectors = clustered(rng, 120, 3, 8, 0.02)
    rows = [(1, i, f"name{i}", f"def{i % 50}", [float(x) for x in v]) for i, v in enumerate(vectors)]
    rows += [(1, 500, "name0", "def0", rows[0][4]), (2, 600, "a", None, rows[0][4]), (2, 601, "b", "x", None)]
    df = spark.createDataFrame(rows, "cluster_id int, row_id bigint, attribute_name string, attribute_definition string, v array<double>")
    listed = {(r.cluster_id, r.page): r for r in P.listings(df, 12, "v", 0.95).collect()}
    one = [r for (c, _), r in listed.items() if c == 1]
    assert all(r.pages == len(one) for r in one) and listed[2, 0].pages == 1
    assert sum(r.n_lines for r in one) == 120 and sum(r.n_rows for r in one) == 121
    assert max(r.n_lines for r in one) <= 12 and len(one) <= 21
    assert "| Rows: 2" in next(r.listing for r in one if "name0" in r.attributes)
    # the same prompts from every pair: far more pages
    assert P.listings(df, 12).where(F.col("cluster_id") == 1).count() == 20 * 19 / 2


def test_pages_of_every_pair_are_not_written(spark, monkeypatch):
    """Every two rows of a cluster share a page; what is stored grows with the rows, not with the pages."""
    rows = [(c, 1000 * c + i, f"n{i % 7}", f"d{i}") for c, n in ((1, 203), (2, 6), (3, 7), (4, 1)) for i in range(n)]
    rows += [(1, 9000, "n0", "d0")]
    df = spark.createDataFrame(rows, "cluster_id int, row_id bigint, attribute_name string, attribute_definition string")
    monkeypatch.setattr(P, "TILE_LINES", 12)
    kept = P.store
    written = []

    def store(df, label):
        done = kept(df, label)
        written.append(done.select(F.explode("own")).count() if "own" in done.columns else done.count())
        return done

    monkeypatch.setattr(P, "store", store)
    pages = P.listings(df, 6).collect()
    assert max(written) <= 217
    count = {c: [p for p in pages if p.cluster_id == c] for c in (1, 2, 3, 4)}
    assert {c: len(p) for c, p in count.items()} == {1: 68 * 67 / 2, 2: 1, 3: 3, 4: 1}
    assert all(p.pages == len(count[p.cluster_id]) and p.n_lines == len(p.listing.splitlines()) <= 6 for p in pages)
    assert len({(p.cluster_id, p.page) for p in pages}) == len(pages)
    seen = set()
    for p in count[1]:
        at = [int(line.split(".")[0]) for line in p.listing.splitlines()]
        assert at == sorted(at) and p.n_rows == p.n_lines + (1 in at)
        seen |= {(x, y) for x in at for y in at if x < y}
    assert len(seen) == 203 * 202 / 2


def test_halves_grow_with_the_rows_and_meet_on_every_page(spark):
    """What cannot be cut: no table of pages is written, and tiles of halves meet as the listed pages do."""
    rng = np.random.default_rng(5)
    blocks = {1: rng.normal(size=(150, 24)), 2: np.ones(6).repeat(4).reshape(1, 24) + 0.001 * rng.normal(size=(45, 24)), 3: rng.normal(size=(4, 24))}
    count = checked(spark, blocks, 0.2, 10)
    rows, df = rows_of(spark, blocks)
    unit = {i: np.array(v) / np.linalg.norm(v) for _, i, v in rows}
    paged, halved = cover.cover(df, "v", 0.2, 10)
    paged = paged.localCheckpoint()
    assert paged.count() + halved.count() <= 2 * len(rows) < cover.half_pages(halved).count()
    assert count[2] == 36
    vectors = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in unit.items()], "row_id bigint, unit array<double>")
    pages = {}
    for r in cover.half_pages(halved).collect():
        pages.setdefault((r.cluster_id, r.page), []).append(r.row_id)
    for room in (10, 9):
        want = {}
        for members in pages.values():
            for i in members:
                found = any(i != j and unit[i] @ unit[j] >= 0.2 for j in members)
                seen, fits = want.get(i, (False, True))
                want[i] = (seen or found, fits and len(members) <= room)
        for tile_rows in (20, 4096):
            met = cover.meet_halves(halved, vectors, 10, tile_rows).applyInArrow(
                cover.judge_halves(0.2, room), "row_id bigint, cluster_id int, found boolean, fits boolean"
            )
            got = met.groupBy("row_id").agg(F.max("found").alias("f"), F.min("fits").alias("t")).collect()
            assert {r.row_id: (r.f, r.t) for r in got} == want
