"""Which row, or name, of a group stays."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from samesense.functions.replies import best_name
from samesense.operators.model import Generate, answered
from samesense.operators.prompts import PAGE_ROWS, best_prompts
from samesense.skew import lookup


def age_of(df: DataFrame) -> tuple[Column, Column]:
    """(0 for an existing row else 1, round with unknown rounds last)."""
    old = F.lit(1)
    if "source" in df.columns:
        old = F.when(F.col("source") == "existing", 0).otherwise(1)
    seen = F.lit(float("inf"))
    if "first_seen_in_round" in df.columns:
        number = F.col("first_seen_in_round").cast("string").try_cast("double")
        seen = F.coalesce(number, F.lit(float("inf")))
    return old, seen


def existing_rank(df: DataFrame) -> Column:
    """Existing rows first, then the earliest round, then row order; the least wins."""
    old, seen = age_of(df)
    seen = F.when(old == 0, seen).otherwise(F.lit(float("inf")))
    return F.struct(old.alias("age"), seen.alias("seen"), F.col("row_id").alias("at"))


def rule_rank(df: DataFrame) -> Column:
    """Longest definition, then shortest name, then row order; the least wins."""
    return F.struct(
        (-F.length(F.coalesce("attribute_definition", F.lit("")))).alias("definition"),
        F.length(F.coalesce("attribute_name", F.lit(""))).alias("name"),
        F.col("row_id").alias("at"),
    )


def best_names(members: DataFrame, rows: DataFrame, rank: Column) -> DataFrame:
    """Best name of each group by a rank over its rows: ``group_id, best_attribute``.

    Rows are first reduced to the best row of each name, then names to the best of each
    group; both are map-side aggregates, so neither a frequent name nor a large group
    ends up in one task.
    """
    per_name = rows.groupBy("attribute_name").agg(F.min(rank).alias("rank"))
    named = members.select("group_id", "attribute_name").distinct()
    tied = lookup(named, per_name, ["attribute_name"], ["group_id"], "inner")
    return tied.groupBy("group_id").agg(
        F.min_by("attribute_name", "rank").alias("best_attribute"),
        F.min("rank").alias("rank"),
    )


def existing_best(members: DataFrame, rows: DataFrame) -> DataFrame:
    """Groups with an existing row and the name of the one that stays."""
    best = best_names(members, rows, existing_rank(rows))
    return best.where("rank.age = 0").drop("rank")


def rule_best(members: DataFrame, rows: DataFrame) -> DataFrame:
    return best_names(members, rows, rule_rank(rows)).drop("rank")


def chosen_best(answers: DataFrame) -> DataFrame:
    """Name picked by each reply, else the first name shown: ``group_id, page, ...``."""
    return answers.select(
        "group_id",
        "page",
        "pages",
        F.coalesce(best_name(F.col("response"), F.col("names")), F.get("names", F.lit(0))).alias(
            "best_attribute"
        ),
    )


def model_best(
    members: DataFrame,
    rows: DataFrame,
    generate: Generate,
    incremental: bool = False,
    page_rows: int = PAGE_ROWS,
    **options,
) -> DataFrame:
    """Best name of each group picked by a model: ``group_id, best_attribute``.

    A group that fills several pages is decided in rounds: the winners of its pages meet
    on the next page. An unusable or failed reply leaves the first name of the group.
    """
    return model_choices(members, rows, generate, incremental, page_rows, **options)[0]


def model_choices(
    members: DataFrame,
    rows: DataFrame,
    generate: Generate,
    incremental: bool = False,
    page_rows: int = PAGE_ROWS,
    folder: str | None = None,
    **options,
) -> tuple[DataFrame, DataFrame]:
    """``model_best`` and the replies of all rounds, which are kept in ``folder`` if it is given."""
    decided = replies = None
    options = {"on_error": "record", **options}
    while True:
        prompts = best_prompts(members, rows, incremental, page_rows)
        said = answered(prompts, generate, "choices", folder, **options)
        replies = said if replies is None else replies.unionByName(said)
        picks = chosen_best(said)
        final = picks.where("pages = 1").select("group_id", "best_attribute")
        decided = final if decided is None else decided.unionByName(final)
        open_ = picks.where("pages > 1").select(
            "group_id", F.col("best_attribute").alias("attribute_name")
        )
        if open_.isEmpty():
            return decided, replies
        members = lookup(
            members, open_.distinct(), ["group_id", "attribute_name"], ["seq"], "inner"
        )
        # from now on one line per name, or a name with many definitions would never fit
        rows = rows.join(
            rows.groupBy("attribute_name").agg(F.min("row_id").alias("row_id")),
            ["attribute_name", "row_id"],
            "left_semi",
        )


def losing_names(members: DataFrame, best: DataFrame) -> DataFrame:
    """Names that lose in at least one of their groups."""
    return (
        lookup(members, best, ["group_id"], ["attribute_name"], "inner")
        .where("attribute_name <> best_attribute")
        .select("attribute_name")
        .distinct()
    )


def mark_losers(rows: DataFrame, losers: DataFrame) -> DataFrame:
    """Set ``keep``: false for every row of a losing name."""
    marked = lookup(rows, losers.withColumn("_lost", F.lit(True)), ["attribute_name"], ["row_id"])
    return marked.withColumn("keep", F.col("_lost").isNull()).drop("_lost")


def best_records(members: DataFrame, best: DataFrame) -> DataFrame:
    """Member rows with the best name of their group, for the record of a run."""
    return lookup(members, best, ["group_id"], ["attribute_name"], "inner")
