"""From parsed replies to verdicts on rows, by name."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from samesense.functions.replies import read_replies
from samesense.functions.text import group_key
from samesense.operators.components import components
from samesense.operators.prompts import PAGE_ROWS
from samesense.operators.rows import cluster_order
from samesense.skew import lookup, positions
from samesense.storage import store


def verdict_items(replies: DataFrame) -> DataFrame:
    """One row per valid item of each reply: ``cluster_id, page, pos, ...``.

    The outer explode keeps Spark from adding a "has items" filter, which it would push
    below everything and so read each reply twice.
    """
    kept = [c for c in ("cluster_id", "page", "pages") if c in replies.columns]
    return (
        read_replies(replies)
        .select(*kept, F.posexplode_outer("items").alias("pos", "item"))
        .where("pos is not null")
        .select(*kept, "pos", "item.*")
    )


def verdict_records(replies: DataFrame, names: str = "attributes") -> DataFrame:
    """Record per reply: ``attributes, duplicates, duplicate_groups``.

    All of it comes from one row, the reply and the names it was asked about, so nothing
    is grouped. Without a valid item every listed row counts as no duplicate.
    """
    default = F.transform(
        names,
        lambda n: F.struct(
            n.alias("attribute_name"),
            F.lit(False).alias("is_duplicate"),
            F.lit(None).cast("string").alias("duplicate_group_id"),
        ),
    )
    read = read_replies(replies)
    items = F.when(F.size("items") > 0, F.col("items")).otherwise(default)
    read = read.withColumn("duplicates", items)
    flagged = F.filter("duplicates", lambda i: i["is_duplicate"])
    groups = F.transform(
        F.array_distinct(F.transform(flagged, lambda i: i["duplicate_group_id"])),
        lambda g: F.struct(
            g.alias("key"),
            F.transform(
                F.filter(flagged, lambda i: i["duplicate_group_id"] == g),
                lambda i: i["attribute_name"],
            ).alias("value"),
        ),
    )
    return read.withColumn("duplicate_groups", F.map_from_entries(groups)).drop(
        "items", "rung", "response"
    )


def flagged_items(items: DataFrame, rows: DataFrame) -> DataFrame:
    """Items that name a duplicate, with the id of their group and their place in time.

    Names no row carries are dropped here, so a name a model made up can neither fill a
    group nor win it.
    """
    known = rows.select("attribute_name").distinct()
    order = cluster_order(rows)
    found = lookup(
        items.where("is_duplicate"), known, ["attribute_name"], ["cluster_id", "pos"], "left_semi"
    )
    placed = lookup(found, order, ["cluster_id"], ["attribute_name", "pos"], "inner")
    page = F.col("page") if "page" in items.columns else F.lit(0).cast("bigint")
    copies = F.col("copies") if "copies" in items.columns else F.lit(1).cast("bigint")
    return placed.select(
        "attribute_name",
        "cluster_id",
        group_key(F.col("cluster_id"), F.col("duplicate_group_id")).alias("group_id"),
        F.struct("first_row", page.alias("page"), "pos").alias("seq"),
        copies.alias("copies"),
    )


def merge_pages(items: DataFrame, rows: DataFrame) -> DataFrame:
    """Join up the groups of a cluster, on however many pages it was shown.

    A page numbers its groups on its own, and a row may be shown on several. Groups that
    share a name are one group; the groups of a cluster are numbered by their first row.
    Each name comes once, with its number of rows in the cluster as ``copies``.
    """
    nodes = _nodes(rows)
    # a name with many definitions is mentioned once per page and reply
    flagged = items.where("is_duplicate").select("cluster_id", "page", "duplicate_group_id", "attribute_name").distinct()
    flagged = store(
        flagged.join(nodes, ["cluster_id", "attribute_name"]).select("cluster_id", "page", "duplicate_group_id", "node"),
        "flagged",
    )
    return _numbered(nodes, flagged, _to_hubs(flagged))


def linked_names(replies: DataFrame) -> DataFrame:
    """What the replies say, each thing once, however many pages say it.

    ``cluster_id, attribute_name, hub, page, duplicate_group_id``. The names of a group of a reply are tied to a
    ``hub``, the least of them that its page shows, and the page is forgotten; a group of which its
    page shows no name keeps its page and id, and has no hub. Made of one row, the reply, so it is reduced where
    the reply was given. A group without an id holds nothing together.
    """
    flagged = F.filter("items", lambda i: i["is_duplicate"] & i["attribute_name"].isNotNull())
    gids = F.array_distinct(F.transform("_flagged", lambda i: i["duplicate_group_id"]))

    def of(gid):
        mine = F.filter("_flagged", lambda i: i["duplicate_group_id"].eqNullSafe(gid))
        names = F.array_distinct(F.transform(mine, lambda i: i["attribute_name"]))
        return F.struct(gid.alias("gid"), names.alias("names"), F.array_min(F.array_intersect(names, "attributes")).alias("hub"))

    read = read_replies(replies).select("cluster_id", "page", "attributes", flagged.alias("_flagged"))
    groups = read.select("cluster_id", "page", F.explode(F.transform(gids, of)).alias("g"))
    names = groups.select("cluster_id", "page", "g.gid", "g.hub", F.explode("g.names").alias("attribute_name"))
    loose = F.col("gid").isNotNull() & F.col("hub").isNull()
    return names.select(
        "cluster_id",
        "attribute_name",
        F.when(F.col("gid").isNull(), F.col("attribute_name")).otherwise(F.col("hub")).alias("hub"),
        F.when(loose, F.col("page")).alias("page"),
        F.when(loose, F.col("gid")).alias("duplicate_group_id"),
    ).distinct()


def merge_links(linked: DataFrame, rows: DataFrame) -> DataFrame:
    """``merge_pages`` from the stored result of ``linked_names``."""
    nodes = _nodes(rows)
    known = store(lookup(linked, nodes.drop("copies"), ["cluster_id", "attribute_name"], ["hub", "page"], "inner"), "flagged")
    hubs = nodes.select("cluster_id", F.col("attribute_name").alias("hub"), F.col("node").alias("to"))
    tied = lookup(known.where("hub is not null"), hubs, ["cluster_id", "hub"], ["node"], "inner")
    edges = tied.select("node", F.col("to").alias("hub")).unionByName(
        _to_hubs(known.where("hub is null").drop("hub")).select("node", "hub")
    )
    return _numbered(nodes, known, edges)


def _nodes(rows: DataFrame) -> DataFrame:
    return store(
        rows.groupBy("cluster_id", "attribute_name").agg(
            F.min("row_id").alias("node"), F.count(F.lit(1)).alias("copies")
        ),
        "names",
    )


def _to_hubs(flagged: DataFrame) -> DataFrame:
    group = ["cluster_id", "page", "duplicate_group_id"]
    hub = flagged.groupBy(*group).agg(F.min("node").alias("hub"))
    return lookup(flagged, hub, group, ["node"], "inner")


def _numbered(nodes: DataFrame, flagged: DataFrame, edges: DataFrame) -> DataFrame:
    """Items of the groups that the ``edges`` hold together, of the ``flagged`` names."""
    roots = components(edges, "node", "hub")
    # a name alone in its group is its own root
    rooted = flagged.select("node").distinct().join(roots, "node", "left").select(
        "node", F.coalesce("root", "node").alias("root")
    )
    tied = store(nodes.join(rooted, "node"), "tied")
    heads = tied.where("node = root").select("cluster_id", "root")
    numbered = positions(heads, "root", ["cluster_id"], "number").drop("cluster_id")
    return lookup(tied, numbered, ["root"], ["node"], "inner").select(
        "cluster_id",
        F.lit(0).cast("bigint").alias("page"),
        F.lit(1).cast("bigint").alias("pages"),
        F.col("node").alias("pos"),
        "attribute_name",
        F.lit(True).alias("is_duplicate"),
        F.concat(F.lit("group"), F.col("number").cast("string")).alias("duplicate_group_id"),
        "copies",
    )


def name_verdicts(flags: DataFrame) -> DataFrame:
    """The verdict that stands for each name: the last one given."""
    return flags.groupBy("attribute_name").agg(
        F.max_by("group_id", "seq").alias("duplicate_group_id")
    )


def apply_by_name(rows: DataFrame, verdicts: DataFrame) -> DataFrame:
    """Give every row of a name the verdict on that name."""
    joined = lookup(
        rows.drop("is_duplicate", "duplicate_group_id"), verdicts, ["attribute_name"], ["row_id"]
    )
    return joined.withColumn("is_duplicate", F.col("duplicate_group_id").isNotNull())


def group_members(flags: DataFrame) -> DataFrame:
    """Members of each group in the order given, one row per mention, with its ``copies``."""
    return flags.select("group_id", "attribute_name", "seq", "copies")


def names_per_group(members: DataFrame, page_rows: int = PAGE_ROWS) -> DataFrame:
    """Names of each group as lists, in the order of the number ``seq``.

    A list holds at most ``page_rows`` names; a larger group has several, by ``page``.
    """
    placed = positions(members, "seq", ["group_id"])
    page = F.floor((F.col("pos") - 1) / F.lit(page_rows)).alias("page")
    listed = F.sort_array(F.collect_list(F.struct("pos", "attribute_name")))
    return (
        placed.groupBy("group_id", page)
        .agg(listed.alias("_l"))
        .select("group_id", "page", F.col("_l.attribute_name").alias("names"))
    )


def shared_groups(members: DataFrame) -> DataFrame:
    """Members of groups with at least two of them; copies of a row count."""
    mentions = F.sum("copies") if "copies" in members.columns else F.count(F.lit(1))
    sizes = members.groupBy("group_id").agg(mentions.alias("_n")).where("_n > 1")
    members = members.drop("copies")
    return lookup(members, sizes.drop("_n"), ["group_id"], ["attribute_name"], "inner")
