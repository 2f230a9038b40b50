"""Rounds whose work follows the new rows: survivors stay in an index, batches come to it.

``deduplicate_incremental`` judges the union of survivors and batch anew. Here the survivors' vectors lie
in a ``GroupIndex`` around given centers, and a batch is compared with the cells it reaches only.
The verdicts are those of a run over the union that keeps one row per group
(``drop_same_name=True``): then no two survivors are alike, so what a batch changes are its own rows and
the survivors they are linked to. A round returns just these; every other survivor stays as it is.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from samesense.functions.text import group_key
from samesense.functions.vectors import normalised
from samesense.operators import blocks as B
from samesense.operators import embed as E
from samesense.operators import rows as R
from samesense.operators import survivors as S
from samesense.operators.components import components
from samesense.operators.increments import GroupIndex
from samesense.operators.similar import fold_copies
from samesense.plans.dedup import THRESHOLD
from samesense.skew import lookup
from samesense.storage import store

KEPT = ["row_id", "attribute_name", "attribute_definition", "first_seen_in_round", "cluster_id"]


class Rounds:
    """Survivors so far, and the index of their vectors."""

    def __init__(
        self,
        spark: SparkSession,
        centers: DataFrame | None = None,
        make_encoder: Callable[[], E.Encoder] | None = None,
        threshold: float = THRESHOLD,
    ):
        self.centers, self.make_encoder = centers, make_encoder
        self.index = GroupIndex(spark, threshold)
        self.survivors: DataFrame | None = None
        self.next_id = 0
        self.round = 0

    def add(self, batch: DataFrame) -> DataFrame:
        """Judge a batch ``row_id, attribute_name, attribute_definition``; see ``add_embedded``."""
        if self.centers is None:
            raise ValueError("a batch without clusters needs centers")
        text = E.with_text(batch)
        made = E.embed_hashed(text) if self.make_encoder is None else E.embed(text, self.make_encoder)
        made = store(made.drop("text"), "embedded")
        near = B.assign_nearest(made, self.centers, "embedding").select("row_id", "cluster_id")
        return self.add_embedded(made.join(near, "row_id"))

    def add_embedded(self, batch: DataFrame) -> DataFrame:
        """Judge a batch that carries ``embedding`` and ``cluster_id``.

        Returns the batch's rows and the survivors that they changed, with ``source``, ``is_duplicate``,
        ``duplicate_group_id`` and ``should_remove``. New ids follow those given before, as in
        ``combine``; groups are named after their cluster and lowest row.
        """
        self.round += 1
        low, high = batch.agg(F.min("row_id"), F.max("row_id")).first()
        shift = self.next_id - (low or 0)
        batch = store(
            batch.withColumn("row_id", F.col("row_id") + shift).withColumn("first_seen_in_round", F.lit(self.round)), "batch"
        )
        self.next_id = self.next_id if high is None else high + shift + 1
        plain = batch.select("row_id", F.col("cluster_id").cast("string").alias("block"), F.col("embedding").alias("v"))
        new = store(fold_copies(plain, "block", "v"), "distinct")
        links, placed, anchors = self.index.links_of(new)
        roots = store(components(links, "u", "v"), "roots")
        stands = self._stands(plain, new)
        # copies of a vector are a group, also where nothing else is alike
        alone = new.where("copies > 1").select(F.col("row_id").alias("node")).join(roots, "node", "left_anti")
        rooted = store(roots.unionByName(alone.select("node", F.col("node").alias("root"))), "rooted")
        copies = lookup(stands, rooted.withColumnRenamed("node", "rep"), ["rep"], ["row_id"], "inner").select("row_id", "root")
        old = rooted.select(F.col("node").alias("row_id"), "root").join(batch.select("row_id"), "row_id", "left_anti")
        members = store(copies.unionByName(old), "members")
        rows = R.tag(batch.select(*KEPT), R.NEW, self.round)
        if self.survivors is not None:
            touched = self.survivors.join(old.select("row_id"), "row_id", "left_semi")
            rows = rows.unionByName(R.tag(touched, R.EXISTING, R.FIRST_ROUND))
        judged = store(self._judged(rows, members), "judged")
        self._settle(judged, stands, new, placed, anchors)
        return judged

    def _stands(self, plain: DataFrame, new: DataFrame) -> DataFrame:
        """``row_id, rep``: which row's vector stands for each row of the batch; none for a zero vector."""
        marks = [F.xxhash64("unit").alias("h1"), F.xxhash64(F.lit("second"), "unit").alias("h2")]
        reps = new.select("block", *marks, F.col("row_id").alias("rep"))
        unit = plain.select("row_id", "block", normalised(F.col("v")).alias("unit")).where("unit is not null")
        return store(lookup(unit.select("row_id", "block", *marks), reps, ["block", "h1", "h2"], ["row_id"], "inner").select("row_id", "rep"), "stands")

    def _judged(self, rows: DataFrame, members: DataFrame) -> DataFrame:
        grouped = rows.join(members, "row_id")
        age, seen = S.age_of(grouped)
        is_old = age == 0
        rank = F.struct(
            age.alias("age"), F.when(is_old, seen).alias("seen"), F.when(~is_old, S.rule_rank(grouped)).alias("rule"), "row_id"
        )
        best = grouped.groupBy("root").agg(F.min_by("row_id", rank).alias("stays"))
        marked = lookup(members, best, ["root"], ["row_id"], "inner")
        joined = rows.join(marked, "row_id", "left")
        name = group_key(F.col("cluster_id"), F.concat(F.lit("group"), F.col("root").cast("string")))
        return joined.select(
            *KEPT,
            "source",
            F.col("root").isNotNull().alias("is_duplicate"),
            F.when(F.col("root").isNotNull(), name).alias("duplicate_group_id"),
            F.coalesce(F.col("stays") != F.col("row_id"), F.lit(False)).alias("should_remove"),
        )

    def _settle(self, judged: DataFrame, stands: DataFrame, new: DataFrame, placed: DataFrame, anchors: DataFrame) -> None:
        """The batch's survivors join the index and the old losers leave it.

        Of equal vectors one row stays at most, so a vector is kept under that row's id.
        """
        stays = store(judged.where((F.col("source") == R.NEW) & ~F.col("should_remove")), "stays")
        owners = store(stays.select("row_id").join(stands, "row_id"), "owners")
        vectors = new.withColumnRenamed("row_id", "rep").join(owners, "rep").select("block", "row_id", "unit")
        homes = placed.withColumnRenamed("row_id", "rep").join(owners, "rep").drop("rep")
        self.index.keep(store(vectors, "vectors"), store(homes, "homes"), anchors)
        gone = judged.where((F.col("source") == R.EXISTING) & F.col("should_remove")).select("row_id")
        self.index.gone = store(gone if self.index.gone is None else self.index.gone.unionByName(gone), "gone")
        added = stays.select(*KEPT)
        if self.survivors is not None:
            added = self.survivors.join(gone, "row_id", "left_anti").unionByName(added)
        self.survivors = store(added, "survivors")
