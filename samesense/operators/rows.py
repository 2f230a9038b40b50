"""Filters, tags, unions and attaches on the row table.

The row table has ``row_id bigint, attribute_name string, attribute_definition string``
and whatever columns the user carries along.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from samesense.skew import lookup, meet

# Provenance tags and round numbers.
EXISTING = "existing"
NEW = "new"
FIRST_ROUND = 1
SECOND_ROUND = 2


def tag(df: DataFrame, source: str, seen: int) -> DataFrame:
    """Set ``source``; set ``first_seen_in_round`` unless an old row already carries one.

    A round that is no number reads null and counts as the latest.
    """
    carried = F.lit(seen).cast("int")
    if source == EXISTING and "first_seen_in_round" in df.columns:
        carried = F.col("first_seen_in_round").cast("string").try_cast("double").cast("int")
    return df.withColumn("source", F.lit(source)).withColumn("first_seen_in_round", carried)


def reset_verdicts(df: DataFrame) -> DataFrame:
    """Verdict columns as they are before any judgement."""
    return df.withColumns(
        {
            "is_duplicate": F.lit(False),
            "duplicate_group_id": F.lit(None).cast("string"),
            "should_remove": F.lit(False),
        }
    )


def removal_flag(df: DataFrame, keep_round: bool = True) -> DataFrame:
    """Turn ``keep`` into ``should_remove``."""
    out = df.withColumn("should_remove", ~F.col("keep")).drop("keep")
    return out if keep_round else out.drop("first_seen_in_round")


def survivors_of(df: DataFrame) -> DataFrame:
    """Rows an earlier run did not mark for removal."""
    return df.where(~F.col("should_remove"))


def flagged(df: DataFrame) -> DataFrame:
    return df.where("is_duplicate")


def existing_rows(df: DataFrame) -> DataFrame:
    return df.where(F.col("source") == EXISTING)


def earliest_existing(df: DataFrame, group: str) -> DataFrame:
    """Existing rows of the earliest round of their group."""
    old = existing_rows(df).withColumn(
        "_round", F.col("first_seen_in_round").cast("string").try_cast("double")
    )
    first = old.groupBy(group).agg(F.min("_round").alias("_first"))
    return (
        lookup(old, first, [group], ["row_id"], "inner")
        .where("_round = _first")
        .drop("_round", "_first")
    )


def in_shared_clusters(df: DataFrame, cluster: str = "cluster_id") -> DataFrame:
    """Rows of clusters with at least two rows."""
    shared = df.groupBy(cluster).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").drop("_n")
    return lookup(df, shared, [cluster], ["row_id"], "inner")


def combine(previous: DataFrame, new: DataFrame) -> DataFrame:
    """Earlier survivors, then the new batch, matched by column name, with unique ids.

    New ids start after the highest earlier id, so the order "old rows first" holds and
    neither side is renumbered or moved.
    """
    after = F.coalesce(previous.agg(F.max("row_id")).scalar(), F.lit(-1)) + F.lit(1)
    low = F.coalesce(new.agg(F.min("row_id")).scalar(), F.lit(0))
    shifted = new.withColumn("row_id", (F.col("row_id") - low + after).cast("bigint"))
    return previous.unionByName(shifted, allowMissingColumns=True)


def attach(df: DataFrame, extra: DataFrame, how: str = "left") -> DataFrame:
    """Attach columns that belong to the same rows, by ``row_id``."""
    return df.join(extra, "row_id", how)


def rows_named(df: DataFrame, groups: DataFrame) -> DataFrame:
    """Rows whose name is in a group's list of names (``group_id, names array<string>``)."""
    members = groups.select("group_id", F.explode("names").alias("attribute_name")).distinct()
    return meet(df, members, ["attribute_name"], ["row_id"], ["group_id"])


def last_per_key(df: DataFrame, key: list[str], order: str, value: list[str]) -> DataFrame:
    """The latest row of each key: later writes win."""
    latest = F.max_by(F.struct(*value), F.col(order))
    return df.groupBy(*key).agg(latest.alias("_v")).select(*key, "_v.*")


def cluster_order(df: DataFrame, cluster: str = "cluster_id") -> DataFrame:
    """Clusters with the row they first appear in."""
    return df.groupBy(cluster).agg(F.min("row_id").alias("first_row"))
