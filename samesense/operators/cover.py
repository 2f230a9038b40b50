"""Pages that cover a block: rows that are alike share a page, and pages grow with the rows.

A block that fits a page is one page. Of a larger one, rows whose vectors have a cosine of at
least ``threshold`` must share a page; rows below it need not. Two such rows are in the same
connected group of similar rows, so whole groups are packed into pages. A group larger than
a page is cut around anchors: a row goes to the cell of its nearest anchor, and also to
every cell whose border is within the radius of the threshold (the bisector rule of
``similar``), cells that are still too large are cut again, and cells are packed like groups.

What cannot be cut, since its rows are nearly all alike, is shown as pairs of half pages: there
the pairs themselves are as many as the square of the rows, so they are numbered and not
written, and who needs their rows meets them in tiles (``meet_halves``). All other rows are on one page,
or on as many as borders they lie at.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from samesense.functions.vectors import normalised
from samesense.operators.similar import MAX_LEVELS, MEET_ROWS, UNCUT, UNIT_ROWS, place_in_cells, similar_groups
from samesense.skew import lookup, positions
from samesense.storage import store

# Foreign cells a row visits on average before its group is taken as uncuttable.
MAX_VISITS = 3


def half_pages(halved: DataFrame) -> DataFrame:
    """Rows of the pages of every two halves of a unit: ``cluster_id, row_id, page``, made where they are read.

    ``halved``: ``half`` of the ``halves`` of the unit, and ``base``, the number of its first page.
    """
    own, halves = F.col("half"), F.col("halves")
    partners = F.filter(F.sequence(F.lit(0).cast("bigint"), halves - 1), lambda o: o != own)

    def number(o):
        low, high = F.least(own, o), F.greatest(own, o)
        return F.col("base") + F.floor(low * (halves * 2 - low - 1) / 2) + high - low - 1

    pages = F.when(halves == 1, F.array("base")).otherwise(F.transform(partners, number))
    return halved.select("cluster_id", "row_id", F.explode(pages).alias("page"))


def meet_halves(halved: DataFrame, vectors: DataFrame, page_rows: int, tile_rows: int = UNIT_ROWS):
    """Rows of the halves of a unit, grouped by the two tiles of halves that meet: ``a, b, side``.

    Each page, two halves of a unit, is in exactly one group; a half alone in its unit is in one too.
    A row is copied once per tile it meets, not once per page. ``vectors``: ``row_id`` and what is carried along.
    """
    per_tile = max(1, tile_rows // max(1, page_rows // 2))
    tile, tiles = F.expr(f"half div {per_tile}"), F.expr(f"(halves - 1) div {per_tile} + 1")
    others = F.explode(F.sequence(F.lit(0).cast("bigint"), tiles - 1)).alias("other")
    dealt = halved.join(vectors, "row_id").withColumn("tile", tile).select("*", others)
    return dealt.withColumns(
        {
            "a": F.least("tile", "other"),
            "b": F.greatest("tile", "other"),
            "side": F.when(F.col("tile") > F.col("other"), 1).otherwise(0),
        }
    ).drop("tile", "other").groupBy("cluster_id", "unit_id", "a", "b")


def judge_halves(threshold: float, page_rows: int):
    """For ``meet_halves``: whether each row is on a page with an alike one, and its pages fit.

    ``vectors`` carry ``unit``. Two rows of a group share a page: one half has all others of its unit for partners.
    """

    def run(unit: pa.Table) -> pa.Table:
        ids, half, side = (unit[c].to_numpy() for c in ("row_id", "half", "side"))
        vectors = np.stack(unit["unit"].to_numpy())
        alone = unit["a"][0] == unit["b"][0]
        left, right = [np.arange(len(ids))] * 2 if alone else [np.flatnonzero(side == v) for v in (0, 1)]
        repeated = alone or len(np.unique(ids)) < len(ids)
        found = np.zeros(len(ids), bool)
        for low in range(0, len(left), MEET_ROWS):
            part = left[low : low + MEET_ROWS]
            near = vectors[part] @ vectors[right].T >= threshold
            if repeated:
                near &= ids[part][:, None] != ids[right][None, :]
            found[part] |= near.any(axis=1)
            found[right] |= near.any(axis=0)
        # the longest page of a row: its half and the longest of those it meets here
        _, place, rows = np.unique(half, return_inverse=True, return_counts=True)
        fits = np.ones(len(ids), bool)
        for own, other in ((left, right), (right, left)):
            if len(own) and len(other):
                met = np.zeros(len(rows), np.int64)
                met[place[other]] = rows[place[other]]
                longest, second = met.argmax(), 0
                if len(met) > 1:
                    second = np.delete(met, longest).max()
                longest_met = np.where(place[own] == longest, second, met[longest])
                fits[own] &= rows[place[own]] + longest_met <= page_rows
        return pa.table({"row_id": unit["row_id"], "cluster_id": unit["cluster_id"], "found": pa.array(found), "fits": pa.array(fits)})

    return run


def _cut(large: DataFrame, threshold: float, page_rows: int) -> tuple[DataFrame, DataFrame | None]:
    """Groups larger than a page as cells that fit one, and what stays too large.

    ``large``: ``block, size, row_id, unit``, where ``block`` names the group. Both results are rows
    ``unit_id, row_id`` with the name of their cell.
    """
    fitting = whole = None
    add = lambda a, b: b if a is None else a.unionByName(b)
    for level in range(MAX_LEVELS):
        placed = store(place_in_cells(large, threshold, max(1, page_rows // 2), max_visits=MAX_VISITS), "page-cells")
        counts = placed.groupBy("block", "cell").agg(
            F.count(F.lit(1)).alias("n"), F.max("role").alias("worst"), F.max("size").alias("size")
        )
        # a slice that found no cells makes its whole group uncut
        uncut = counts.groupBy("block").agg((F.max("worst") == UNCUT).alias("uncut"))
        cells = store(counts.join(uncut, "block").drop("worst"), "page-cell-sizes")
        sized = lookup(placed.drop("size"), cells, ["block", "cell"], ["row_id"], "inner")
        name = F.concat_ws("/", "block", "cell")
        fits = sized.where((F.col("n") <= page_rows) & ~F.col("uncut")).select(name.alias("unit_id"), "row_id")
        fitting = add(fitting, fits)
        wide = (F.col("n") > page_rows) & ~F.col("uncut")
        again = wide & (F.col("n") * 2 <= F.col("size")) if level < MAX_LEVELS - 1 else F.lit(False)
        # a home row is there once; visitors of an uncut group are not needed
        whole = add(whole, sized.where(F.col("uncut") & (F.col("role") != 2)).select(F.col("block").alias("unit_id"), "row_id"))
        whole = add(whole, sized.where(wide & ~again).select(name.alias("unit_id"), "row_id"))
        left = cells.where(again)
        if left.isEmpty():
            break
        vectors = large.select("block", "row_id", "unit")
        large = store(
            sized.where(again).join(vectors, ["block", "row_id"]).select(
                name.alias("block"), F.col("n").alias("size"), "row_id", "unit"
            ),
            "page-recut",
        )
    return fitting, whole.distinct()


def covering_pages(rows: DataFrame, vector: str, threshold: float, page_rows: int) -> DataFrame:
    """Pages of the rows of all blocks: ``cluster_id, row_id, page``, pages numbered from 0.

    ``rows``: ``cluster_id, row_id`` and the vector; a row without one (null or zero) is like no other.
    Any two rows of a block that fits a page share it, and any two of a larger block whose cosine
    is at least ``threshold``.
    """
    paged, halved = cover(rows, vector, threshold, page_rows)
    return paged if halved is None else paged.unionByName(half_pages(halved))


def cover(rows: DataFrame, vector: str, threshold: float, page_rows: int) -> tuple[DataFrame, DataFrame | None]:
    """``covering_pages`` in two tables that grow with the rows.

    ``cluster_id, row_id, page`` for rows on pages of their own; and for what cannot be cut the halves of which
    every two are a page, ``cluster_id, unit_id, row_id, half, halves, base`` (``half_pages`` lists these pages).
    """
    rows = store(rows.select("cluster_id", "row_id", F.col(vector).alias("v")), "to-cover")
    sizes = rows.groupBy("cluster_id").agg(F.count(F.lit(1)).alias("n"))
    sized = store(lookup(rows, sizes, ["cluster_id"], ["row_id"], "inner"), "sized-blocks")
    first = F.lit(0).cast("bigint")
    small = sized.where(F.col("n") <= page_rows).select("cluster_id", "row_id", first.alias("page"))
    large = sized.where(F.col("n") > page_rows).drop("n")
    if large.isEmpty():
        return small, None
    found = store(similar_groups(large, "cluster_id", "v", threshold), "alike")
    grouped = store(
        large.join(found, "row_id", "left").withColumn("root", F.coalesce("root", "row_id")), "grouped"
    )
    counts = grouped.groupBy("root").agg(F.count(F.lit(1)).alias("n"))
    grouped = store(lookup(grouped, counts, ["root"], ["row_id"], "inner"), "sized-groups")
    members = grouped.where(F.col("n") <= page_rows).select(
        "cluster_id", F.col("root").cast("string").alias("unit_id"), "row_id"
    )
    huge = grouped.where(F.col("n") > page_rows)
    stuck = None
    if not huge.isEmpty():
        units = store(
            huge.select(F.col("root").cast("string").alias("block"), F.col("n").alias("size"), "row_id", normalised(F.col("v")).alias("unit")),
            "huge-groups",
        )
        of = large.select("cluster_id", "row_id")
        cells, stuck = _cut(units, threshold, page_rows)
        members = members.unionByName(cells.join(of, "row_id").select(*members.columns))
        stuck = store(stuck.join(of, "row_id").select(*members.columns), "uncut-cells")
    members = store(members, "page-units")
    # units in some fixed order, one after the other; a page takes those that start in its half
    half = max(1, page_rows // 2)
    unit_sizes = members.groupBy("cluster_id", "unit_id").agg(F.count(F.lit(1)).alias("n"))
    order = F.struct(F.xxhash64("unit_id").alias("h"), "unit_id")
    spans = store(
        unit_sizes.where(F.col("n") <= half).withColumn("by", order), "units-to-pack"
    )
    starts = _running_totals(spans)
    packed = starts.select("cluster_id", "unit_id", F.concat(F.lit("p"), F.expr(f"start div {half}").cast("string")).alias("page_id"))
    alone = unit_sizes.where(F.col("n") > half).select("cluster_id", "unit_id", F.concat(F.lit("u"), "unit_id").alias("page_id"))
    paged = lookup(members, packed.unionByName(alone), ["cluster_id", "unit_id"], ["row_id"], "inner")
    paged = paged.select("cluster_id", "row_id", "page_id")
    paged = store(paged.distinct(), "pages")
    pages = paged.select("cluster_id", "page_id").distinct().withColumn(
        "by", F.struct(F.xxhash64("page_id").alias("h"), "page_id")
    )
    numbers = store(positions(store(pages, "page-names"), "by", ["cluster_id"], "number"), "page-numbers").select(
        "cluster_id", "page_id", (F.col("number") - 1).alias("page")
    )
    shown = lookup(paged, numbers, ["cluster_id", "page_id"], ["row_id"], "inner")
    plain = small.unionByName(shown.select("cluster_id", "row_id", "page"))
    if stuck is None or stuck.isEmpty():
        return plain, None
    # pages of every two halves come after the others of their block, unit by unit
    halves = F.when(F.col("rows") <= page_rows, 1).otherwise(F.ceil(F.col("rows") / F.lit(half))).cast("bigint")
    units = stuck.groupBy("cluster_id", "unit_id").agg(F.count(F.lit(1)).alias("rows")).withColumn("halves", halves)
    pairs = F.greatest(F.lit(1).cast("bigint"), F.expr("halves * (halves - 1) div 2"))
    units = _running_totals(store(units.select("*", pairs.alias("n"), order.alias("by")), "units-in-halves"))
    before = numbers.groupBy("cluster_id").agg(F.count(F.lit(1)).alias("before"))
    base = F.col("start") + F.coalesce("before", F.lit(0))
    units = units.join(before, "cluster_id", "left").select("cluster_id", "unit_id", "halves", base.alias("base"))
    numbered = positions(stuck, "row_id", ["cluster_id", "unit_id"])
    placed = lookup(numbered, store(units, "unit-pages"), ["cluster_id", "unit_id"], ["row_id"], "inner")
    at = F.when(F.col("halves") == 1, 0).otherwise(F.floor((F.col("pos") - 1) / F.lit(half))).cast("bigint")
    halved = placed.select("cluster_id", "unit_id", "row_id", at.alias("half"), "halves", "base")
    return plain, store(halved, "halves")


def _running_totals(units: DataFrame) -> DataFrame:
    """``units`` with ``start``: rows of the units before it in its cluster, in the order ``by``.

    Units are numbered first, so that only slices of them, not all of a cluster, meet in a window.
    """
    numbered = positions(units, "by", ["cluster_id"], "at")
    cut = store(numbered.withColumn("slice", F.expr("at div 100000")), "numbered-units")
    before = Window.partitionBy("cluster_id").orderBy("slice")
    totals = cut.groupBy("cluster_id", "slice").agg(F.sum("n").alias("all")).withColumn(
        "base", F.sum("all").over(before) - F.col("all")
    )
    inside = Window.partitionBy("cluster_id", "slice").orderBy("at")
    summed = cut.withColumn("so_far", F.sum("n").over(inside) - F.col("n"))
    return summed.join(totals.select("cluster_id", "slice", "base"), ["cluster_id", "slice"]).withColumn(
        "start", F.col("base") + F.col("so_far")
    )
