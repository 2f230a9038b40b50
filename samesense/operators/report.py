"""Figures about a run."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def run_summary(result: DataFrame, cluster: str = "cluster_id") -> DataFrame:
    """The six run figures and the share of duplicates, in one aggregate."""
    removed = F.count_if(F.col("should_remove"))
    total = F.count(F.lit(1))
    clusters = F.count_distinct(cluster) if cluster in result.columns else F.lit(0)
    group = F.when(F.col("is_duplicate"), F.col("duplicate_group_id"))
    flagged = F.count_if(F.col("is_duplicate"))
    return result.agg(
        total.alias("total_attributes"),
        flagged.alias("duplicates_found"),
        (total - removed).alias("attributes_to_keep"),
        removed.alias("attributes_to_remove"),
        clusters.cast("bigint").alias("clusters"),
        F.count_distinct(group).alias("duplicate_groups"),
        F.when(total > 0, flagged * F.lit(100.0) / total).alias("duplicate_percentage"),
    )
