"""Prompt tables: what a judge and a chooser are shown.

A prompt lists at most ``page_rows`` rows, so no task ever holds a whole large block. A
block that needs more is covered by pages (``cover``): rows whose vectors are alike are still
shown together, and the number of prompts grows with the rows. Without vectors a block is cut
into half pages and every two half pages share a prompt, a prompt per pair of half pages.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from samesense.functions.text import group_label
from samesense.operators.cover import covering_pages
from samesense.skew import lookup, meet, positions
from samesense.storage import store

PAGE_ROWS = 200
# Lines of half pages that meet others together, and lines of the pages that are made in one task.
TILE_LINES = 640
TASK_LINES = 400_000


def distinct_rows(df: DataFrame) -> DataFrame:
    """Rows of a cluster with equal name and definition shown once, at their first row.

    A value that fills a third of the table takes one line, which states the number of its
    ``copies``; they are judged like any other rows.
    """
    return df.groupBy("cluster_id", "attribute_name", "attribute_definition").agg(
        F.min("row_id").alias("row_id"), F.count(F.lit(1)).alias("copies")
    )


# The labels of a listing's line, and the prefixes of the contexts.
NAME, DEFINITION = "Name: ", " | Definition: "
DETECT_CONTEXT, BEST_CONTEXT = "detect_duplicates_cluster_", "best_attribute_"


def _line(number: Column) -> Column:
    return F.concat(
        number.cast("string"),
        F.lit(". " + NAME),
        F.coalesce("attribute_name", F.lit("nan")),
        F.lit(DEFINITION),
        F.coalesce("attribute_definition", F.lit("nan")),
        F.when(F.col("copies") > 1, F.concat(F.lit(" | Rows: "), F.col("copies").cast("string"))).otherwise(""),
    )


def _half_pages(shown: DataFrame, page_rows: int) -> DataFrame:
    """Lines of each half page, one row each; a cluster that fits a page is one row. Grows with the rows."""
    half = max(1, page_rows // 2)
    large = F.col("n") > page_rows
    at = F.when(large, F.floor((F.col("pos") - 1) / F.lit(half))).otherwise(0).cast("bigint")
    halves = F.when(large, F.ceil(F.col("n") / F.lit(half))).otherwise(1).cast("bigint")
    line = F.struct("pos", _line(F.col("pos")).alias("line"), "attribute_name")
    return shown.groupBy("cluster_id", halves.alias("halves"), at.alias("half")).agg(
        F.sort_array(F.collect_list(line)).alias("_lines"), F.sum("copies").alias("n_rows")
    )


def _paired(halves: DataFrame, page_rows: int) -> tuple[DataFrame, int]:
    """Every two half pages of a cluster as a page: ``cluster_id, page, pages, n_rows, _lines``; and their number.

    ``halves`` is a stored table. Half pages go to tiles and every two tiles meet; the pages of two tiles are made
    one after the other where they are read. Pages are as many as the square of the half
    pages, but none is written or shuffled here, only tiles once per tile they meet.
    """
    pages = F.expr("halves * (halves - 1) div 2")
    per_tile = max(1, TILE_LINES // max(1, page_rows // 2))
    tiles = store(
        halves.groupBy("cluster_id", "halves", F.expr(f"half div {per_tile}").alias("tile")).agg(
            F.collect_list(F.struct("half", "n_rows", "_lines")).alias("own")
        ),
        "tiles-of-halves",
    )
    last = F.expr(f"(halves - 1) div {per_tile}")
    met = tiles.select("cluster_id", "halves", F.col("own").alias("_left"), F.col("tile").alias("a"), F.explode(F.sequence("tile", last)).alias("b"))
    met = met.join(tiles.select("cluster_id", F.col("tile").alias("b"), F.col("own").alias("_right")), ["cluster_id", "b"])
    total = halves.where("half = 0").agg(F.sum(pages)).first()[0] or 0
    slots = halves.sparkSession.sparkContext.defaultParallelism
    if total > (task_pages := _task_pages(page_rows)):
        met = met.repartition(max(slots, -(-total // task_pages)), "cluster_id", "a", "b")
    one = met.select("cluster_id", "halves", "_right", F.explode("_left").alias("x"))
    later = F.filter("_right", lambda y: y["half"] > F.col("x.half"))
    two = one.select("cluster_id", "halves", "x", F.explode(later).alias("y"))
    paged = two.select(
        "cluster_id",
        (F.col("x.half") * F.col("halves") + F.col("y.half")).alias("page"),
        pages.alias("pages"),
        (F.col("x.n_rows") + F.col("y.n_rows")).alias("n_rows"),
        (F.size("x._lines") + F.size("y._lines")).cast("bigint").alias("n_lines"),
        F.concat("x._lines", "y._lines").alias("_lines"),
    )
    return paged, total


def _task_pages(page_rows: int) -> int:
    return max(1, TASK_LINES // max(1, page_rows))


def listings(
    df: DataFrame, page_rows: int = PAGE_ROWS, vector: str | None = None, threshold: float | None = None
) -> DataFrame:
    """Numbered listing of each cluster: ``cluster_id, page, pages, n_rows, n_lines, attributes, listing``.

    ``n_rows`` counts copies, ``n_lines`` does not; ``attributes`` are the names in order. Without a
    ``vector`` every two rows of a cluster share a page; with it those whose cosine is at least
    ``threshold``, and the number of pages follows the number of rows.
    """
    return listed_pages(df, page_rows, vector, threshold)[0]


def listed_pages(
    df: DataFrame, page_rows: int = PAGE_ROWS, vector: str | None = None, threshold: float | None = None
) -> tuple[DataFrame, bool]:
    """``listings``, and whether they are pairs of half pages beyond what one task makes.

    Those grow with the square of a cluster and should be used up where they are made, not written.
    """
    many = False
    lines = store(distinct_rows(df), "lines")
    shown = positions(lines, "row_id", ["cluster_id"])
    if vector is None or threshold is None:
        sizes = lines.groupBy("cluster_id").agg(F.count(F.lit(1)).alias("n"))
        sized = lookup(shown, sizes, ["cluster_id"], ["row_id"], "inner")
        halves = store(_half_pages(sized, page_rows), "half-pages")
        first, one = F.lit(0).cast("bigint"), F.lit(1).cast("bigint")
        whole = halves.where("halves = 1").select(
            "cluster_id",
            first.alias("page"),
            one.alias("pages"),
            "n_rows",
            F.size("_lines").cast("bigint").alias("n_lines"),
            "_lines",
        )
        paired, total = _paired(halves.where("halves > 1"), page_rows)
        many = total > _task_pages(page_rows)
        paged = whole.unionByName(paired)
    else:
        vectors = lines.select("cluster_id", "row_id").join(df.select("row_id", vector), "row_id")
        paged = shown.join(covering_pages(vectors, vector, threshold, page_rows), ["cluster_id", "row_id"])
        paged = store(paged, "paged-lines")
        pages = paged.groupBy("cluster_id").agg(F.count_distinct("page").alias("pages"))
        paged = lookup(paged, pages, ["cluster_id"], ["row_id"], "inner")
        line = F.struct("pos", _line(F.col("pos")).alias("line"), "attribute_name")
        paged = (
            paged.groupBy("cluster_id", "page", "pages")
            .agg(F.sort_array(F.collect_list(line)).alias("_lines"), F.sum("copies").alias("n_rows"))
            .withColumn("n_lines", F.size("_lines").cast("bigint"))
        )
    listed = paged.select(
        "cluster_id",
        "page",
        "pages",
        "n_rows",
        "n_lines",
        F.array_distinct("_lines.attribute_name").alias("attributes"),
        F.concat_ws("\n", F.col("_lines.line")).alias("listing"),
    )
    return listed, many


DETECT_HEAD = (
    "Below is a numbered list of data attributes, each with a name and a definition. "
    "Find the attributes that stand for the same thing, even where their names or "
    "wording differ.\n\n"
)
DETECT_TAIL = (
    "\n\nAnswer with one JSON object and nothing else: a key \"duplicates\" holding a list "
    "with one entry per attribute, each entry with \"attribute_name\", \"is_duplicate\" "
    "(true or false) and, only when true, \"duplicate_group_id\". Attributes that mean the "
    "same share an id; number the ids group1, group2 and so on."
)


def detect_prompts(listed: DataFrame) -> DataFrame:
    """Prompt per listing that asks which rows mean the same."""
    return listed.withColumn(
        "prompt", F.concat(F.lit(DETECT_HEAD), F.col("listing"), F.lit(DETECT_TAIL))
    ).withColumn(
        "context",
        F.concat(F.lit(DETECT_CONTEXT), F.col("cluster_id").cast("string")),
    )


BEST_HEAD = (
    "The data attributes below were found to mean the same. Choose the one to keep: "
    "prefer a clear name in a common style, a full and exact definition, and usual "
    "practice in the field.\n"
)
BEST_OLD = "Attributes marked [EXISTING] are in use; prefer them unless a new one is far better.\n"
BEST_TAIL = (
    "\n\nAnswer with one JSON object and nothing else, with the keys \"best_attribute\" "
    "(one of the names above) and \"reasoning\"."
)


def best_prompts(
    members: DataFrame, rows: DataFrame, incremental: bool = False, page_rows: int = PAGE_ROWS
) -> DataFrame:
    """Prompt per page of a group: ``group_id, page, pages, names, context, prompt``.

    ``members``: ``group_id, attribute_name, seq``. Equal rows are shown once.
    """
    columns = ["attribute_name", "attribute_definition"]
    existing = F.lit(False)
    if "source" in rows.columns:
        existing = F.coalesce(F.col("source") == "existing", F.lit(False))
    texts = (
        rows.withColumn("existing", existing)
        .groupBy(*columns, "existing")
        .agg(F.min("row_id").alias("row_id"))
    )
    names = members.groupBy("group_id", "attribute_name").agg(F.min("seq").alias("seq"))
    tied = meet(store(texts, "texts"), store(names, "names"), ["attribute_name"], ["row_id"], ["group_id"])
    shown = positions(store(tied, "lines"), "row_id", ["group_id"])
    sizes = shown.groupBy("group_id").agg(F.count(F.lit(1)).alias("n"))
    sized = lookup(shown, sizes, ["group_id"], ["row_id"], "inner")
    # one winner per page goes on, so pages need not overlap
    paged = sized.withColumn("page", F.floor((F.col("pos") - 1) / F.lit(page_rows))).withColumn(
        "pages", F.ceil(F.col("n") / F.lit(page_rows))
    )
    line = F.concat(
        F.lit(NAME),
        F.col("attribute_name"),
        F.when(F.col("existing"), F.lit(" | [EXISTING]")).otherwise(F.lit("")),
        F.lit(DEFINITION),
        F.coalesce("attribute_definition", F.lit("nan")),
    )
    listed = F.sort_array(
        F.collect_list(F.struct("pos", line.alias("line"), "seq", "attribute_name"))
    )
    by_seq = F.sort_array(
        F.transform("_l", lambda e: F.struct(e["seq"].alias("s"), e["attribute_name"].alias("a")))
    )
    return (
        paged.groupBy("group_id", "page", "pages")
        .agg(listed.alias("_l"))
        .select(
            "group_id",
            "page",
            "pages",
            F.array_distinct(F.transform(by_seq, lambda e: e["a"])).alias("names"),
            F.concat(F.lit(BEST_CONTEXT), group_label(F.array_distinct("_l.attribute_name"))).alias("context"),
            F.concat(
                F.lit(BEST_HEAD + (BEST_OLD if incremental else "") + "\n"),
                F.concat_ws("\n", F.col("_l.line")),
                F.lit(BEST_TAIL),
            ).alias("prompt"),
        )
    )
