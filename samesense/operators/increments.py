"""Groups of similar rows that grow round by round, without comparing old rows again.

The index of a set of rows holds, per block, anchors with the radius of their cell, the distinct
vectors with the cell they live in, and which row stands for a vector. A batch of new rows asks
the anchors which cells it can reach (a row with a cosine of at least ``threshold`` lies within
``r`` of it, so only cells whose anchor is nearer than their radius plus ``r``), and is
compared with the rows of those cells alone. New edges merge old groups: what is written is
which root another one has become, never the labels of rows that did not change.

Blocks are spread over ``SHARDS`` folders, and a batch reads those its blocks are in. The result of any
order of batches equals ``similar_groups`` over all rows (``tests/test_increments.py``).
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from samesense.functions.vectors import normalised
from samesense.operators.blocks import _matrix
from samesense.operators.components import components
from samesense.operators.similar import SLACK, TILE_ROWS, fold_copies, similar_groups
from samesense.skew import lookup
from samesense.storage import fresh_path, store

SHARDS = 64
# Rows of a block that share a cell, about.
CELL_ROWS = 512
# New rows of a block that are placed by one task.
SLICE_ROWS = 20_000

ANCHOR = "block string, cell string, unit array<double>, radius double"
ENTRY = "shard int, block string, cell string, row_id bigint, unit array<double>"


def _shard(block):
    return F.pmod(F.xxhash64(block), F.lit(SHARDS)).cast("int")


def _place(reach: float):
    """Home cell of each new row, and the cells it can reach, with the distance to the anchor."""

    def run(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        n, k = rows.num_rows, anchors.num_rows
        out = {"block": [], "row_id": [], "cell": [], "distance": [], "home": []}
        if n and k:
            anchors = anchors.sort_by([("cell", "ascending")])
            points, radius = _matrix(anchors["unit"], k), anchors["radius"].to_numpy()
            vectors = _matrix(rows["unit"], n)
            far = np.sqrt(np.maximum(0.0, 2.0 - 2.0 * (vectors @ points.T)))
            home = far.argmin(axis=1)
            reached = far <= radius[None, :] + reach + SLACK
            reached[np.arange(n), home] = True
            row, cell = np.nonzero(reached)
            out = {
                "block": rows["block"].take(pa.array(row)),
                "row_id": rows["row_id"].take(pa.array(row)),
                "cell": anchors["cell"].take(pa.array(cell)),
                "distance": far[row, cell],
                "home": cell == home[row],
            }
        kinds = {"block": pa.string(), "row_id": pa.int64(), "cell": pa.string(), "distance": pa.float64(), "home": pa.bool_()}
        return pa.table({c: v if isinstance(v, pa.ChunkedArray) else pa.array(v, kinds[c]) for c, v in out.items()})

    return run


def _compare(threshold: float):
    """Links of new rows to the old rows of a tile of a cell."""

    def run(new: pa.Table, old: pa.Table) -> pa.Table:
        u = v = np.empty(0, np.int64)
        if new.num_rows and old.num_rows:
            near = _matrix(new["unit"], new.num_rows) @ _matrix(old["unit"], old.num_rows).T >= threshold
            a, b = np.nonzero(near)
            u, v = new["row_id"].to_numpy()[a], old["row_id"].to_numpy()[b]
        return pa.table({"u": pa.array(u, pa.int64()), "v": pa.array(v, pa.int64())})

    return run


@dataclass
class GroupIndex:
    """Rows seen so far: anchors, distinct vectors by cell, copies, and merged roots.

    ``merged`` names the root of every vector whose root is another row; ``gone`` are rows that
    later batches are not compared with; ``compared`` counts the comparisons of the last batch
    with old rows.
    """

    spark: SparkSession
    threshold: float
    anchors: DataFrame | None = None
    folder: str = ""
    batches: int = 0
    copies: DataFrame | None = None
    merged: DataFrame | None = None
    gone: DataFrame | None = None
    compared: int = 0

    @property
    def radius(self) -> float:
        return math.sqrt(max(0.0, 2.0 - 2.0 * self.threshold))

    def entries(self, shards: list[int] | None = None) -> DataFrame | None:
        """Distinct vectors with their block and cell, of some shards only if they are named."""
        if not self.batches:
            return None
        # only batches that were kept in full
        paths = [f"{self.folder}/batch={i}" for i in range(self.batches)]
        held = self.spark.read.schema(ENTRY).option("basePath", self.folder).parquet(*paths)
        if shards is not None:
            held = held.where(F.col("shard").isin(shards))
        if self.gone is not None:
            held = held.join(self.gone, "row_id", "left_anti")
        return held

    def _drawn(self, new: DataFrame) -> DataFrame:
        """Anchors for the new rows' cells: one in ``CELL_ROWS`` by a hash of the id, at least one a block."""
        draw = F.pmod(F.xxhash64("row_id", F.lit("anchor")), F.lit(1_000_000_007))
        lucky = new.where(draw < 1_000_000_007 // CELL_ROWS).select("block", "row_id", "unit")
        least = new.groupBy("block").agg(F.min_by(F.struct("row_id", "unit"), draw).alias("r"))
        if self.anchors is not None:
            least = least.join(self.anchors.select("block").distinct(), "block", "left_anti")
        drawn = lucky.unionByName(least.select("block", "r.*")).dropDuplicates(["block", "row_id"])
        return drawn.select("block", F.col("row_id").cast("string").alias("cell"), "unit", F.lit(0.0).alias("radius"))

    def _placed(self, new: DataFrame, anchors: DataFrame) -> DataFrame:
        sizes = new.groupBy("block").agg(F.ceil(F.count(F.lit(1)) / F.lit(SLICE_ROWS)).cast("int").alias("slices"))
        dealt = lookup(new, sizes, ["block"], ["row_id"], "inner").withColumn(
            "slice", F.pmod(F.xxhash64("row_id", F.lit("slice")), F.col("slices")).cast("int")
        )
        asked = anchors.join(sizes, "block").withColumn("slice", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)))
        return (
            dealt.select("block", "slice", "row_id", "unit")
            .groupBy("block", "slice")
            .cogroup(asked.select("block", "slice", "cell", "unit", "radius").groupBy("block", "slice"))
            .applyInArrow(_place(self.radius), "block string, row_id bigint, cell string, distance double, home boolean")
        )

    def links_of(self, new: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
        """Links of new distinct vectors ``block, row_id, unit``: among them, and to old rows.

        Returns the links ``u, v`` (rows, not roots), the places of the new rows, and the anchors.
        """
        drawn = self._drawn(new)
        anchors = store(drawn if self.anchors is None else self.anchors.unionByName(drawn), "anchors")
        placed = store(self._placed(new, anchors), "reached-cells")
        among = similar_groups(new, "block", "unit", self.threshold).where("row_id <> root").select(
            F.col("row_id").alias("u"), F.col("root").alias("v")
        )
        shards = [r[0] for r in new.select(_shard("block")).distinct().collect()]
        old = self.entries(shards)
        if old is None:
            return store(among, "links"), placed, anchors
        asking = store(placed.select("block", "cell", "row_id").join(new.select("row_id", "unit"), "row_id"), "asking")
        reached = asking.groupBy("block", "cell").agg(F.ceil(F.count(F.lit(1)) / F.lit(TILE_ROWS)).cast("int").alias("a"))
        old = old.select("block", "cell", "row_id", "unit").join(reached.select("block", "cell"), ["block", "cell"], "left_semi")
        old = store(old, "reached")
        held = old.groupBy("block", "cell").agg(
            F.ceil(F.count(F.lit(1)) / F.lit(TILE_ROWS)).cast("int").alias("b"), F.count(F.lit(1)).alias("rows")
        )
        tiles = store(reached.join(held, ["block", "cell"]), "tiles")

        def dealt(rows: DataFrame, own: str, other: str) -> DataFrame:
            tile = F.pmod(F.xxhash64("row_id", F.lit("tile")), F.col(own)).cast("int")
            every = F.explode(F.sequence(F.lit(0), F.col(other) - 1))
            cut = lookup(rows, tiles, ["block", "cell"], ["row_id"], "inner")
            return cut.withColumn("own", tile).withColumn("met", every).select(
                "block", "cell", F.col("own").alias(own), F.col("met").alias(other), "row_id", "unit"
            )

        keys = ["block", "cell", "a", "b"]
        met = dealt(asking, "a", "b").groupBy(*keys).cogroup(dealt(old, "b", "a").groupBy(*keys))
        across = met.applyInArrow(_compare(self.threshold), "u bigint, v bigint")
        counts = asking.groupBy("block", "cell").agg(F.count(F.lit(1)).alias("n")).join(held, ["block", "cell"])
        self.compared = counts.agg(F.coalesce(F.sum(F.col("n") * F.col("rows")), F.lit(0))).first()[0]
        return store(among.unionByName(across).distinct(), "links"), placed, anchors

    def keep(self, new: DataFrame, placed: DataFrame, anchors: DataFrame) -> None:
        """Put new distinct vectors in their home cells, and widen the cells to hold them."""
        homes = placed.where("home").select("block", "row_id", "cell", "distance").join(new.select("row_id", "unit"), "row_id")
        homes = store(homes, "homes")
        self.folder = self.folder or fresh_path(self.spark, "index")
        rows = homes.select(_shard("block").alias("shard"), "block", "cell", "row_id", "unit")
        rows.repartition("shard").write.mode("overwrite").partitionBy("shard").parquet(f"{self.folder}/batch={self.batches}")
        self.batches += 1
        wider = homes.groupBy("block", "cell").agg(F.max("distance").alias("wide"))
        self.anchors = store(
            anchors.join(wider, ["block", "cell"], "left").select(
                "block", "cell", "unit", F.greatest("radius", F.coalesce("wide", F.lit(0.0))).alias("radius")
            ),
            "anchors",
        )

    def add(self, df: DataFrame, block: str, vector: str, row_id: str = "row_id") -> DataFrame:
        """Add a batch; returns ``old, root``: roots, and new rows, that have become another root."""
        plain = df.select(F.col(block).cast("string").alias("block"), F.col(row_id).alias("row_id"), F.col(vector).alias("v"))
        new = store(fold_copies(plain, "block", "v"), "batch")
        links, placed, anchors = self.links_of(new)
        if self.merged is not None:
            # an old row stands for its root
            now = self.merged.select(F.col("node").alias("v"), F.col("root").alias("now"))
            links = store(lookup(links, now, ["v"], ["u"]).select("u", F.coalesce("now", "v").alias("v")), "links-to-roots")
        roots = components(links, "u", "v").where("node <> root")
        changed = store(roots.select(F.col("node").alias("old"), "root"), "changed")
        if self.merged is None:
            merged = changed.select(F.col("old").alias("node"), "root")
        else:
            moved = lookup(
                self.merged.withColumnRenamed("root", "was"), changed.select(F.col("old").alias("was"), "root"), ["was"], ["node"]
            )
            merged = moved.select("node", F.coalesce("root", "was").alias("root")).unionByName(
                changed.select(F.col("old").alias("node"), "root")
            )
        self.merged = store(merged, "merged")
        unit = F.xxhash64("unit")
        known = plain.join(new.select(F.col("row_id").alias("row_id")), "row_id", "left_anti")
        if not known.isEmpty():
            self._count_copies(known, new, unit)
        self.keep(new, placed, anchors)
        return changed

    def _count_copies(self, copied: DataFrame, new: DataFrame, unit) -> None:
        """Remember which row stands for each other row with the same vector."""
        second = F.xxhash64(F.lit("second"), "unit")
        stands = new.select("block", unit.alias("h1"), second.alias("h2"), F.col("row_id").alias("rep"))
        rows = copied.select("block", "row_id", normalised(F.col("v")).alias("unit")).where("unit is not null")
        rows = rows.select("block", "row_id", unit.alias("h1"), second.alias("h2"))
        found = lookup(rows, stands, ["block", "h1", "h2"], ["row_id"], "inner").select("row_id", "rep")
        self.copies = store(found if self.copies is None else self.copies.unionByName(found), "copies")

    def groups(self) -> DataFrame:
        """All rows with at least one similar row: ``row_id, root``, as ``similar_groups`` gives them."""
        none = self.spark.createDataFrame([], "node bigint, root bigint")
        merged = none if self.merged is None else self.merged
        roots = merged.unionByName(merged.select(F.col("root").alias("node"), "root").distinct())
        if self.copies is None:
            return roots.select(F.col("node").alias("row_id"), "root")
        # a row with copies is in a group also where nothing else is alike
        alone = self.copies.select(F.col("rep").alias("node")).distinct().join(roots, "node", "left_anti")
        roots = store(roots.unionByName(alone.select("node", F.col("node").alias("root"))), "roots")
        copies = lookup(self.copies, roots.withColumnRenamed("node", "rep"), ["rep"], ["row_id"], "inner")
        return roots.select(F.col("node").alias("row_id"), "root").unionByName(copies.select("row_id", "root"))
