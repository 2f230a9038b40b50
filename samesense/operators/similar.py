"""Exact "same meaning" groups inside blocks, without listing pairs.

Two rows of a block belong together when the cosine of their vectors is at least
``threshold``; a group is everything connected that way. What is built is not the pairs
but a thin set of edges with the same connected components:

1. Equal vectors are folded into one representative by a plain aggregate, so a value
   that a third of all rows share costs one row from here on.
2. Blocks of at most ``tile_rows`` representatives are compared inside one task each,
   many blocks to a task, and their groups are final.
3. A larger block is cut into cells around anchor rows. Unit vectors with cosine >= t lie
   within ``radius = sqrt(2 - 2t)`` of each other, so a row only has to visit a foreign
   cell if the plane half-way between the two anchors is no further than that (the
   bisector rule of the published MapReduce metric-space joins). Anchors closer than
   ``radius`` to an earlier anchor are dropped. Rows within half a radius of their anchor
   are all alike by the triangle inequality: one edge to the anchor each, and they are
   never compared with each other. What is left is compared in tiles of bounded size.
   Cells hold ids; vectors join them once, after it is known what each plan would copy. A
   block without structure, in which rows visit most cells, is compared tile by tile uncut.

No step samples, cuts off or approximates; anchors only decide who meets whom.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from samesense.functions.vectors import normalised
from samesense.operators.components import components
from samesense.skew import lookup
from samesense.storage import store

TILE_ROWS = 1024
PACK_ROWS = 4096
# Rows of a side that meet in one task, and of these at a time.
UNIT_ROWS = 4096
MEET_ROWS = 1024
# A large block has this many tiles, until a tile has so many bytes of vectors: rows are copied once per tile they meet.
UNIT_SPLIT = 16
UNIT_BYTES = 32 << 20
# Rows of both sides whose products are taken at a time, and pairs that are then compared in double precision.
SIEVE_ROWS = 512
SIEVE_WIDTH = 4096
VERIFY_PAIRS = 1 << 16
# Cosines this close to the threshold are worked out again, by a product of matrices.
CLOSE = 1e-12
# Compared pairs that cost as much as one more copy of a vector.
COPY_PAIRS = 8192
SLICE_ROWS = 20_000
MAX_ANCHORS = 512
# A cell with more tiles than this is cut again, at most so many times.
CELL_TILES = 32
MAX_LEVELS = 5
# Foreign cells a row of a slice visits on average before its block is left uncut.
MAX_VISITS = 32
UNCUT = 3
PLACE_ROWS = 4096
# Slack for rounding in the distance bounds; it only lets a few more rows visit.
SLACK = 1e-6

EDGE = "row_id bigint, root bigint"


def _matrix(column: pa.ChunkedArray, rows: int) -> np.ndarray:
    flat = pa.chunked_array([c.flatten() for c in column.chunks], type=pa.float64())
    return flat.to_numpy().reshape(rows, -1)


def _local_groups(ids: np.ndarray, near: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lowest id of the component of each row of a symmetric boolean matrix."""
    order = np.argsort(ids)
    label = ids.copy()
    while True:
        lowest = np.minimum(
            label, np.where(near, label[None, :], np.iinfo(np.int64).max).min(axis=1)
        )
        # a row also takes the label of the row it is labelled with
        lowest = lowest[order[np.searchsorted(ids, lowest, sorter=order)]]
        if np.array_equal(lowest, label):
            return ids, label
        label = lowest


def _edges_within(ids, vectors, threshold):
    """Spanning edges of the rows of one block."""
    near = vectors @ vectors.T >= threshold
    np.fill_diagonal(near, False)
    touched = np.flatnonzero(near.any(axis=1))
    if touched.size == 0:
        return ids[:0], ids[:0]
    return _local_groups(ids[touched], near[np.ix_(touched, touched)])


def _table(parts: list[tuple[np.ndarray, np.ndarray]]) -> pa.Table:
    rows = np.concatenate([p[0] for p in parts]) if parts else np.empty(0, np.int64)
    roots = np.concatenate([p[1] for p in parts]) if parts else np.empty(0, np.int64)
    return pa.table({"row_id": pa.array(rows, pa.int64()), "root": pa.array(roots, pa.int64())})


def _radius(threshold: float) -> float:
    return math.sqrt(max(0.0, 2.0 - 2.0 * threshold))


def _compare_packs(threshold: float):
    def run(pack: pa.Table) -> pa.Table:
        pack = pack.sort_by([("block", "ascending"), ("row_id", "ascending")])
        ids = pack["row_id"].to_numpy()
        vectors = _matrix(pack["unit"], pack.num_rows)
        block = pack["block"].to_numpy(zero_copy_only=False)
        starts = np.flatnonzero(np.r_[True, block[1:] != block[:-1]])
        ends = np.r_[starts[1:], pack.num_rows]
        parts = []
        for low, high in zip(starts, ends):
            if high - low > 1:
                part = _edges_within(ids[low:high], vectors[low:high], threshold)
                if part[0].size:
                    parts.append(part)
        return _table(parts)

    return run


def _joined(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``root`` after the trees of the rows ``a`` and ``b`` are one; every row points at its lowest row."""
    while True:
        a, b = root[a], root[b]
        apart = a != b
        if not apart.any():
            return root
        a, b = a[apart], b[apart]
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        above = root[root]
        while not np.array_equal(above, root):
            root, above = above, above[above]


def _alike(vectors: np.ndarray, a: np.ndarray, b: np.ndarray, threshold: float) -> np.ndarray:
    """Which pairs of rows have a cosine of at least ``threshold``, as a product of matrices gives it."""
    cosine = np.einsum("ij,ij->i", vectors[a], vectors[b])
    alike = cosine >= threshold
    # sums in another order differ in the last digits
    doubt = np.flatnonzero(np.abs(cosine - threshold) < CLOSE)
    for low in range(0, len(doubt), MEET_ROWS):
        part = doubt[low : low + MEET_ROWS]
        rows, at_row = np.unique(a[part], return_inverse=True)
        others, at_other = np.unique(b[part], return_inverse=True)
        alike[part] = (vectors[rows] @ vectors[others].T >= threshold)[at_row, at_other]
    return alike


def _linked(vectors: np.ndarray, left: np.ndarray, right: np.ndarray, same: bool, threshold: float) -> np.ndarray:
    """For each row the lowest row of its component, where similar rows of two sides are linked.

    Rows are taken in the order of their distance to the middle: two similar ones differ by no more than
    the radius in it. Of the others, floats rule out most pairs; those they leave open, and that are not
    connected yet, are compared in double precision.
    """
    root = np.arange(len(vectors))
    # a vector that is not finite is like no other
    finite = np.isfinite(vectors).all(axis=1)
    left, right = left[finite[left]], right[finite[right]]
    if not len(left) or not len(right):
        return root
    middle = vectors[right].mean(axis=0)
    far = [np.linalg.norm(vectors[side] - middle, axis=1) for side in (left, right)]
    order = [np.argsort(distance, kind="stable") for distance in far]
    (far_left, far_right), (left, right) = ([x[o] for x, o in zip(pair, order)] for pair in (far, (left, right)))
    ours, theirs = vectors[left].astype(np.float32), vectors[right].astype(np.float32)
    rounding = np.finfo(np.float32).eps * (vectors.shape[1] + 4)
    reach = _radius(threshold) + SLACK
    for low in range(0, len(left), SIEVE_ROWS):
        part = left[low : low + SIEVE_ROWS]
        begin = low if same else int(np.searchsorted(far_right, far_left[low] - reach))
        end = int(np.searchsorted(far_right, far_left[low : low + SIEVE_ROWS][-1] + reach, "right"))
        for start in range(begin, end, SIEVE_WIDTH):
            others = right[start : min(start + SIEVE_WIDTH, end)]
            first = root[part[0]]
            if (root[part] == first).all() and (root[others] == first).all():
                continue
            cosine = ours[low : low + SIEVE_ROWS] @ theirs[start : start + len(others)].T
            if same and start == low:
                np.fill_diagonal(cosine[:, : len(part)], -2.0)
            near = cosine >= threshold - rounding
            if np.count_nonzero(near) > VERIFY_PAIRS:
                # each row is linked with the one most like it first; that connects most of the others
                for axis, rows, found in ((1, part, others), (0, others, part)):
                    best = cosine.max(axis=axis) >= threshold + rounding
                    root = _joined(root, rows[best], found[cosine.argmax(axis=axis)[best]])
                near &= root[part][:, None] != root[others][None, :]
            at, to = np.nonzero(near)
            a, b = part[at], others[to]
            sure = cosine[at, to] >= threshold + rounding
            root = _joined(root, a[sure], b[sure])
            a, b = a[~sure], b[~sure]
            while len(a):
                apart = root[a] != root[b]
                a, b = a[apart], b[apart]
                alike = _alike(vectors, a[:VERIFY_PAIRS], b[:VERIFY_PAIRS], threshold)
                root = _joined(root, a[:VERIFY_PAIRS][alike], b[:VERIFY_PAIRS][alike])
                a, b = a[VERIFY_PAIRS:], b[VERIFY_PAIRS:]
    return root


def _sides(unit: pa.Table) -> tuple[bool, list[np.ndarray]]:
    """Whether a unit is one tile that meets itself, and the places of the rows of its sides."""
    if unit["kind"][0].as_py() == "00" and unit["a"][0] == unit["b"][0]:
        return True, [np.arange(unit.num_rows)] * 2
    # of two different tiles only pairs across; rows of one tile meet elsewhere
    side = unit["side"].to_numpy()
    return False, [np.flatnonzero(side == value) for value in (0, 1)]


def _compare_units(threshold: float):
    def run(unit: pa.Table) -> pa.Table:
        if unit.num_rows < 2:
            return _table([])
        ids = unit["row_id"].to_numpy()
        same_tile, (left, right) = _sides(unit)
        root = _linked(_matrix(unit["unit"], unit.num_rows), left, right, same_tile, threshold)
        least = ids.copy()
        np.minimum.at(least, root, ids)
        touched = np.bincount(root, minlength=len(root))[root] > 1
        return _table([(ids[touched], least[root[touched]])])

    return run


def _count_units(threshold: float):
    def run(unit: pa.Table) -> pa.Table:
        ids = unit["id"].to_numpy()
        vectors = _matrix(unit["unit"], unit.num_rows)
        same_tile, (left, right) = _sides(unit)
        # a pair is two rows of different ids
        repeated = len(np.unique(ids)) < len(ids)
        n = 0
        for low in range(0, len(left), MEET_ROWS):
            part = left[low : low + MEET_ROWS]
            near = vectors[part] @ vectors[right].T >= threshold
            if same_tile:
                near &= right[None, :] > part[:, None]
            if repeated:
                near &= ids[part][:, None] != ids[right][None, :]
            n += int(np.count_nonzero(near))
        return pa.table({"block": unit["block"].slice(0, 1), "n": pa.array([n], pa.int64())})

    return run


def _place(radius: float, max_visits: int):
    """Home cell and visited cells of the rows of one slice of a large block."""

    def run(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        n = rows.num_rows
        ids = rows["row_id"].to_numpy()
        if n == 0 or anchors.num_rows == 0:
            return _placed(rows, ids, np.zeros(n, np.int64), np.zeros(n, np.int32), ids, np.arange(n))
        anchors = anchors.sort_by([("row_id", "ascending")])
        points = _matrix(anchors["unit"], anchors.num_rows)
        kept: list[int] = []
        for i in range(len(points)):
            if not kept or (
                np.linalg.norm(points[kept] - points[i], axis=1).min() > radius
            ):
                kept.append(i)
        points = points[kept]
        anchor_ids = anchors["row_id"].to_numpy()[kept]
        gaps = np.linalg.norm(points[:, None, :] - points[None, :, :], axis=2)
        parts, visits = [], 0
        for low in range(0, n, PLACE_ROWS):
            vectors = _matrix(rows.slice(low, PLACE_ROWS)["unit"], min(PLACE_ROWS, n - low))
            squared = np.maximum(0.0, 2.0 - 2.0 * (vectors @ points.T))
            home = squared.argmin(axis=1)
            own = squared[np.arange(len(home)), home]
            with np.errstate(divide="ignore", invalid="ignore"):
                plane = (squared - own[:, None]) / (2.0 * gaps[home])
            # each pair across two cells meets in the one with the higher anchor number
            later = np.arange(len(points))[None, :] > home[:, None]
            row, cell = np.nonzero(later & (plane <= radius + SLACK))
            core = np.sqrt(own) <= radius / 2.0 - SLACK
            visits += row.size
            if visits > max_visits * n:
                # cutting does not pay here: say so, in one row per row
                return _placed(rows, ids, np.zeros(n, np.int64), np.full(n, UNCUT, np.int32), ids, np.arange(n))
            # role 0: home, to be compared; 1: home, within half a radius; 2: visitor
            role = np.r_[core.astype(np.int32), np.full(row.size, 2, np.int32)]
            parts.append((np.r_[home, cell], role, low + np.r_[np.arange(len(home)), row]))
        cells, role, take = (np.concatenate([part[i] for part in parts]) for i in range(3))
        return _placed(rows, ids[take], cells.astype(np.int64), role, anchor_ids[cells], take)

    return run


def _placed(rows, ids, cell, role, anchor, take) -> pa.Table:
    index = pa.array(take)
    return pa.table(
        {
            "block": rows["block"].take(index),
            "size": rows["size"].take(index),
            "row_id": pa.array(ids, pa.int64()),
            "cell": pa.array(cell, pa.int64()),
            "role": pa.array(role, pa.int32()),
            "anchor": pa.array(anchor, pa.int64()),
        }
    )


def place_in_cells(
    large: DataFrame,
    threshold: float,
    tile_rows: int = TILE_ROWS,
    slice_rows: int = SLICE_ROWS,
    max_anchors: int = MAX_ANCHORS,
    max_visits: int = MAX_VISITS,
) -> DataFrame:
    """Candidate cells of the rows of large blocks: who may have to meet whom.

    ``large``: ``block, size, row_id, unit`` with the size of the block. The result holds
    ids: one home row per input row and one row per foreign cell it visits. A slice whose
    rows would visit more than ``max_visits`` cells on average has role ``UNCUT`` instead.
    """
    radius = _radius(threshold)
    slices = F.ceil(F.col("size") / F.lit(slice_rows)).cast("int")
    wanted = F.least(F.lit(max_anchors), F.lit(16) + F.ceil(F.col("size") / F.lit(tile_rows)))
    # a stable draw: the hash of the id falls in the lowest wanted/size share
    draw = F.pmod(F.xxhash64("row_id", F.lit("anchor")), F.lit(1_000_000_007))
    # aliases give the anchors column ids of their own next to the rows they came from
    anchors = large.where(draw < wanted / F.col("size") * F.lit(1_000_000_007)).select(
        F.col("block").alias("block"),
        F.explode(F.sequence(F.lit(0), slices - 1)).alias("slice"),
        F.col("row_id").alias("row_id"),
        F.col("unit").alias("unit"),
    )
    rows = large.select(
        "block",
        F.pmod(F.xxhash64("row_id", F.lit("slice")), slices).cast("int").alias("slice"),
        "size",
        "row_id",
        "unit",
    )
    block_type = large.schema["block"].dataType.simpleString()
    return (
        rows.groupBy("block", "slice")
        .cogroup(anchors.groupBy("block", "slice"))
        .applyInArrow(
            _place(radius, max_visits),
            f"block {block_type}, size bigint, row_id bigint, cell bigint, role int, anchor bigint",
        )
    )


def _tiles(rows: Column, tile_rows: int, most_rows: int) -> Column:
    """Tiles of so many rows: ``tile_rows`` each, or if that makes more than ``UNIT_SPLIT``, larger ones up to ``most_rows``."""
    return F.ceil(rows / F.least(F.lit(max(tile_rows, most_rows)), F.greatest(F.lit(tile_rows), F.ceil(rows / F.lit(UNIT_SPLIT)))))


def _met_tiles(
    counted: DataFrame, tile_rows: int, carried: Sequence[str] = ("row_id", "unit"), most_rows: int = 0
):
    """The rows placed in cells, grouped by the two tiles that meet.

    ``counted`` carries ``n0, n1, n2``, the rows of each role in the cell.
    """
    t0, t1, t2 = [_tiles(F.col(f"n{role}"), tile_rows, most_rows).cast("int") for role in (0, 1, 2)]
    own = F.when(F.col("role") == 0, t0).when(F.col("role") == 1, t1).otherwise(t2)
    tile = F.pmod(F.xxhash64("row_id", F.lit("tile")), own).cast("int")

    def upto(count):
        return F.when(count > 0, F.sequence(F.lit(0), count - 1)).otherwise(
            F.array().cast("array<int>")
        )

    def meets(kind: str, others, mine_first: bool):
        """Units in which a row of tile ``_tile`` meets each tile of another kind."""
        return F.transform(
            upto(others),
            lambda o: F.struct(
                F.lit(kind).alias("kind"),
                (F.col("_tile") if mine_first else o).alias("a"),
                (o if mine_first else F.col("_tile")).alias("b"),
                F.lit(0 if mine_first else 1).alias("side"),
            ),
        )

    # rows left to compare meet each other, the half-radius rows and the visitors;
    # visitors meet both kinds of home rows; half-radius rows never meet each other
    plain = F.transform(
        upto(t0),
        lambda o: F.struct(
            F.lit("00").alias("kind"),
            F.least(F.col("_tile"), o).alias("a"),
            F.greatest(F.col("_tile"), o).alias("b"),
            F.when(F.col("_tile") > o, 1).otherwise(0).alias("side"),
        ),
    )
    units = (
        F.when(
            F.col("role") == 0,
            F.concat(plain, meets("01", t1, True), meets("02", t2, True)),
        )
        .when(F.col("role") == 1, F.concat(meets("01", t0, False), meets("12", t2, True)))
        .otherwise(F.concat(meets("02", t0, False), meets("12", t1, False)))
    )
    return (
        counted.withColumn("_tile", tile)
        .select("block", "cell", *carried, F.explode_outer(units).alias("u"))
        .where("u is not null")
        .select("block", "cell", "u.*", *carried)
        .groupBy("block", "cell", "kind", "a", "b")
    )


def compare_cells(counted: DataFrame, threshold: float, tile_rows: int = UNIT_ROWS, most_rows: int = 0) -> DataFrame:
    """Edges of the rows placed in cells, compared tile against tile (see ``_met_tiles``)."""
    return _met_tiles(counted, tile_rows, ("row_id", "unit"), most_rows).applyInArrow(_compare_units(threshold), EDGE)


def _by_role() -> list[Column]:
    return [F.count_if(F.col("role") == role).alias(f"n{role}") for role in (0, 1, 2)]


def pairs_in_cells(
    placed: DataFrame, vectors: DataFrame, threshold: float, unit_rows: int = UNIT_ROWS
) -> DataFrame:
    """How many similar pairs of a block share a cell, each counted once: ``block, n``.

    ``placed``: the stored result of ``place_in_cells``; ``vectors``: ``block, row_id, id, unit``, where
    ``row_id`` is unique and a pair is two rows of different ``id``. No pair is listed: tiles
    of the rows of a cell meet and hand on one number. Of two rows one is at home in the cell where
    they are to meet, so visitors are not counted with each other; rows within half a radius of
    their anchor are counted by their number. A block with a slice left uncut is one cell.
    """
    uncut = placed.where(F.col("role") == UNCUT).select("block").distinct().withColumn("uncut", F.lit(True))
    marked = placed.select("block", "cell", "row_id", "role").join(F.broadcast(uncut), "block", "left")
    whole = F.col("uncut").isNotNull()
    cells = store(
        marked.where(~whole | (F.col("role") != 2)).select(
            "block",
            F.when(whole, F.lit(0)).otherwise(F.col("cell")).cast("bigint").alias("cell"),
            "row_id",
            F.when(whole, F.lit(0)).otherwise(F.col("role")).cast("int").alias("role"),
        ),
        "cells",
    )
    counts = store(cells.groupBy("block", "cell").agg(*_by_role()), "cell-sizes")
    counted = lookup(cells, counts, ["block", "cell"], ["row_id"], "inner").join(vectors, ["block", "row_id"])
    met = _met_tiles(counted, unit_rows, ("id", "unit"))
    block_type = vectors.schema["block"].dataType.simpleString()
    found = met.applyInArrow(_count_units(threshold), f"block {block_type}, n bigint")
    # all alike by the triangle inequality
    by_id = cells.where("role = 1").join(vectors.select("block", "row_id", "id"), ["block", "row_id"])
    by_id = by_id.groupBy("block", "cell", "id").agg(F.count(F.lit(1)).alias("c"))
    pairs = lambda n: F.expr(f"{n} * ({n} - 1) div 2")
    alike = by_id.groupBy("block", "cell").agg(F.sum("c").alias("c"), F.sum(pairs("c")).alias("same"))
    found = found.unionByName(alike.select("block", (pairs("c") - F.col("same")).alias("n")))
    return found.groupBy("block").agg(F.sum("n").alias("n"))


def large_block_edges(
    large: DataFrame,
    threshold: float,
    tile_rows: int = TILE_ROWS,
    cell_tiles: int = CELL_TILES,
    max_levels: int = MAX_LEVELS,
    unit_rows: int = UNIT_ROWS,
) -> DataFrame:
    """Edges of large blocks, which are cut into cells again and again.

    Who goes where is worked out with ids alone and counted. A block whose cells would cost more
    copies of vectors and compared pairs than its tiles is compared tile by tile, uncut. A cell that
    still holds more than ``cell_tiles`` tiles of ``tile_rows`` to compare becomes a block of its own as long as
    that halves the block. What is compared meets in tiles of at least ``unit_rows``, however
    small the blocks are that are cut: vectors are copied once per tile they meet. Tiles of large blocks
    hold more rows, up to ``UNIT_BYTES``.
    """
    edges = None
    unit_rows = max(unit_rows, tile_rows)
    first = large.select(F.size("unit")).first()
    most_rows = UNIT_BYTES // (8 * max(1, first[0])) if first else 0
    for level in range(max_levels):
        placed = store(place_in_cells(large, threshold, tile_rows), "placed")
        counts = store(
            placed.groupBy("block", "cell").agg(*_by_role(), F.max("role").alias("worst"), F.max("size").alias("size")),
            "cells",
        )
        tiles = [_tiles(F.col(f"n{role}"), unit_rows, most_rows) for role in (0, 1, 2)]
        copies = F.col("n0") * (tiles[0] + tiles[1] + tiles[2]) + F.col("n1") * (tiles[0] + tiles[2])
        copies = copies + F.col("n2") * (tiles[0] + tiles[1])
        pairs = F.col("n0") * (F.col("n0") / 2 + F.col("n1") + F.col("n2")) + F.col("n1") * F.col("n2")
        # per block: what its cells would copy and compare, against its tiles uncut
        size = F.max("size")
        whole = size * _tiles(size, unit_rows, most_rows) + size * size / (2 * COPY_PAIRS)
        uncut = counts.groupBy("block").agg(
            ((F.max("worst") == UNCUT) | (F.sum(copies + pairs / COPY_PAIRS) >= whole)).alias("uncut")
        )
        rows = F.col("n0") + F.col("n1") + F.col("n2")
        again = (F.col("n0") + F.col("n2") > cell_tiles * tile_rows) & (rows * 2 <= F.col("size"))
        again = ~F.col("uncut") & again if level < max_levels - 1 else F.lit(False)
        cells = counts.join(uncut, "block").select(
            "block", "cell", "n0", "n1", "n2", "uncut", again.alias("again"), rows.alias("rows")
        )
        cells = store(cells, "cells")
        total = placed.count()
        sized = lookup(placed.drop("size"), cells, ["block", "cell"], ["row_id"], "inner", known_rows=total)
        # vectors come in here, once, when it is known who goes where
        known = large.select(F.col("block"), F.col("row_id"), F.col("size"), F.col("unit"))
        whole = (
            sized.where("uncut and role <> 2")
            .join(known, ["block", "row_id"])
            .select(
                "block",
                F.lit(0).cast("bigint").alias("cell"),
                "row_id",
                F.lit(0).alias("role"),
                "unit",
                F.col("size").alias("n0"),
                F.lit(0).cast("bigint").alias("n1"),
                F.lit(0).cast("bigint").alias("n2"),
            )
        )
        cut = sized.where("not uncut").join(known.drop("size"), ["block", "row_id"])
        here = cut.where("not again").select(*whole.columns).unionByName(whole)
        alike = sized.where("role = 1 and row_id <> anchor").select(
            "row_id", F.col("anchor").alias("root")
        )
        found = alike.unionByName(compare_cells(here, threshold, unit_rows, most_rows))
        edges = found if edges is None else edges.unionByName(found)
        if cells.where("again").isEmpty():
            return edges
        large = store(
            cut.where("again").select(
                F.concat_ws("/", "block", "cell").alias("block"), F.col("rows").alias("size"), "row_id", "unit"
            ),
            "recut",
        )
    return edges


def fold_copies(df: DataFrame, block: str, vector: str, row_id: str = "row_id") -> DataFrame:
    """One representative (lowest id) per distinct vector of a block, with its copies."""
    return (
        df.select(
            F.col(block).alias("block"),
            F.col(row_id).alias("row_id"),
            normalised(F.col(vector)).alias("unit"),
        )
        .where("unit is not null and block is not null")
        .groupBy("block", "unit")
        .agg(F.min("row_id").alias("row_id"), F.count(F.lit(1)).alias("copies"))
    )


def similar_groups(
    df: DataFrame,
    block: str,
    vector: str,
    threshold: float,
    row_id: str = "row_id",
    tile_rows: int = TILE_ROWS,
    pack_rows: int = PACK_ROWS,
) -> DataFrame:
    """Rows that have at least one similar row in their block, with their group.

    Result: ``row_id, root``; ``root`` is the lowest row id of the group.
    """
    folded = store(fold_copies(df, block, vector, row_id), "folded")
    sizes = folded.groupBy("block").agg(F.count(F.lit(1)).alias("size"))
    totals = sizes.agg(
        F.coalesce(F.sum(F.when(F.col("size") <= tile_rows, F.col("size"))), F.lit(0)).alias("s"),
        F.coalesce(F.sum(F.when(F.col("size") > tile_rows, F.col("size"))), F.lit(0)).alias("l"),
    ).first()
    units = folded.select("block", "row_id", "unit")
    large_sizes = sizes.where(F.col("size") > tile_rows)
    small = units
    if totals["l"]:
        total = totals["s"] + totals["l"]
        flagged = lookup(units, large_sizes, ["block"], ["row_id"], known_rows=total)
        small = flagged.where("size is null").drop("size")
    packs = max(1, math.ceil(totals["s"] / pack_rows))
    found = (
        small.withColumn("pack", F.pmod(F.xxhash64("block"), F.lit(packs)))
        .groupBy("pack")
        .applyInArrow(_compare_packs(threshold), EDGE)
    )
    if totals["l"]:
        large = flagged.where("size is not null").withColumn("block", F.col("block").cast("string"))
        edges = store(large_block_edges(store(large, "large"), threshold, tile_rows), "alike")
        found = found.unionByName(
            components(edges, "row_id", "root").select(F.col("node").alias("row_id"), "root")
        )
    keyed = (
        folded.join(found.withColumnRenamed("row_id", "_rep"), F.col("row_id") == F.col("_rep"), "left")
        .withColumn("root", F.coalesce("root", F.when(F.col("copies") > 1, F.col("row_id"))))
        .where("root is not null")
        .select(
            "block",
            F.xxhash64("unit").alias("_h1"),
            F.xxhash64(F.lit("second"), "unit").alias("_h2"),
            "root",
        )
    )
    rows = df.select(
        F.col(block).alias("block"),
        F.col(row_id).alias("row_id"),
        normalised(F.col(vector)).alias("unit"),
    ).select(
        "row_id",
        "block",
        F.xxhash64("unit").alias("_h1"),
        F.xxhash64(F.lit("second"), "unit").alias("_h2"),
    )
    return lookup(rows, keyed, ["block", "_h1", "_h2"], ["row_id"], "inner").select("row_id", "root")
