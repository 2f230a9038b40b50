"""Read a model's free-text reply with column expressions.

The ladder: take the most likely JSON text, parse it strictly, else look for a whole
``{"duplicates": [...]}`` object, else collect groups from prose, bullets or sections.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from samesense.functions.convert import strict_json

# Fences and patterns of the replies to be understood. ``(?d)`` lets only
# a newline end a line; character classes are spelt out over Unicode.
JSON_FENCE = "```json"
FENCE = "```"
SPACE = r"[\s\x1c-\x1f\x85\p{Z}]"
WORD_CHARS = r"[\p{L}\p{N}_]"
WHOLE_OBJECT = (
    rf'(?s)\{{{SPACE}*"duplicates"{SPACE}*:{SPACE}*\[.*?\]{SPACE}*\}}'
)
PROSE_GROUP = r"(?id)group(\p{Nd}+)[^\p{L}\p{N}_].*?:([^\n]+)"
BULLET = (
    rf"(?i)- ({WORD_CHARS}+),{SPACE}*({WORD_CHARS}+)(?:,{SPACE}*({WORD_CHARS}+))?"
    rf"{SPACE}*\(group(\p{{Nd}}+)\)"
)
SECTION_BREAK = rf"\n{SPACE}*\n"
SECTION_NAME = "[a-zA-Z_]+"
GROUP = "group"

ITEMS = "array<struct<attribute_name:string,is_duplicate:boolean,duplicate_group_id:string>>"


def _strip(text: Column) -> Column:
    return F.regexp_replace(text, rf"^{SPACE}+|{SPACE}+\z", "")


def _part(text: Column, fence: str, index: int) -> Column:
    return F.get(F.split(text, fence, -1), F.lit(index))


def candidate(reply: Column) -> Column:
    """The piece of a reply most likely to be JSON.

    Chosen by what the reply contains, not by whether the piece parses: a reply with a
    JSON fence that never closes is taken whole.
    """
    block = _part(reply, JSON_FENCE, 1)
    first = F.locate("{", reply)
    last = F.length(reply) - F.length(F.substring_index(reply, "}", -1))
    braces = reply.contains("{") & reply.contains("}") & (last > first)
    return (
        F.when(
            reply.contains(JSON_FENCE),
            F.when(block.contains(FENCE), _strip(_part(block, FENCE, 0))).otherwise(reply),
        )
        .when(reply.contains(FENCE), _strip(_part(reply, FENCE, 1)))
        .when(braces, F.substring(reply, first, last - first + F.lit(1)))
        .otherwise(reply)
    )


def embedded_json(reply: Column) -> Column:
    """The first whole ``duplicates`` object in the text that parses."""
    found = F.transform(F.regexp_extract_all(reply, F.lit(WHOLE_OBJECT), F.lit(0)), strict_json)
    return F.get(F.filter(found, lambda v: v.isNotNull()), F.lit(0))


def prose_groups(reply: Column) -> Column:
    """``group1 (...): a, b`` lines: array of ``(gid, names)``."""
    ids = F.regexp_extract_all(reply, F.lit(PROSE_GROUP), F.lit(1))
    tails = F.regexp_extract_all(reply, F.lit(PROSE_GROUP), F.lit(2))
    entries = F.zip_with(
        ids,
        tails,
        lambda gid, tail: F.struct(
            F.concat(F.lit(GROUP), gid).alias("gid"),
            F.regexp_extract_all(tail, F.lit(f"{WORD_CHARS}+"), F.lit(0)).alias("names"),
        ),
    )
    return F.filter(entries, lambda e: F.size(e["names"]) > 0)


def bullet_groups(reply: Column) -> Column:
    """``- a, b, c (group1)`` lines: array of ``(gid, names)``."""
    parts = [F.regexp_extract_all(reply, F.lit(BULLET), F.lit(i)) for i in (1, 2, 3, 4)]
    zipped = F.arrays_zip(*[p.alias(n) for p, n in zip(parts, ("a", "b", "c", "g"))])
    return F.transform(
        zipped,
        lambda z: F.struct(
            F.concat(F.lit(GROUP), z["g"]).alias("gid"),
            F.filter(F.array(z["a"], z["b"], z["c"]), lambda n: n != "").alias("names"),
        ),
    )


def section_groups(reply: Column) -> Column:
    """Paragraphs that speak of duplicates and a group: array of ``(gid, names)``."""
    sections = F.filter(
        F.split(reply, SECTION_BREAK, -1),
        lambda s: F.lower(s).contains("duplicate") & F.lower(s).contains("group"),
    )
    names = F.filter(
        F.transform(
            sections, lambda s: F.regexp_extract_all(s, F.lit(SECTION_NAME), F.lit(0))
        ),
        lambda n: F.size(n) >= 2,
    )
    return F.transform(
        names,
        lambda n, i: F.struct(
            F.concat(F.lit(GROUP), (i + F.lit(1)).cast("string")).alias("gid"), n.alias("names")
        ),
    )


def group_items(entries: Column) -> Column:
    """Verdict items of ``(gid, names)`` entries; groups in the order first seen."""
    gids = F.array_distinct(F.transform(entries, lambda e: e["gid"]))
    per_group = F.transform(
        gids,
        lambda g: F.transform(
            F.flatten(
                F.transform(F.filter(entries, lambda e: e["gid"] == g), lambda e: e["names"])
            ),
            lambda n: F.struct(
                n.alias("attribute_name"),
                F.lit(True).alias("is_duplicate"),
                g.alias("duplicate_group_id"),
            ),
        ),
    )
    return F.flatten(per_group)


def _id_text(value: Column) -> Column:
    """A group id as text; null, true and false read ``None``, ``True`` and ``False``."""
    kind = F.schema_of_variant(value)
    plain = F.try_variant_get(value, "$", "string")
    return (
        F.when(kind == "VOID", F.lit("None"))
        .when(kind == "BOOLEAN", F.initcap(plain))
        .otherwise(plain)
    )


def valid_items(parsed: Column) -> Column:
    """Well-formed items of a parsed reply; empty if it is not of the asked-for shape.

    An item needs a name key, a truth value that is a JSON boolean (not the text "true"),
    and, if true, a group id key, which may hold null. A name that is not text can match
    no row and reads null.
    """

    def is_true(item):
        return F.coalesce(F.try_variant_get(item["is_duplicate"], "$", "boolean"), F.lit(False))

    def valid(item):
        return (
            item["attribute_name"].isNotNull()
            & (F.coalesce(F.schema_of_variant(item["is_duplicate"]), F.lit("")) == "BOOLEAN")
            & (~is_true(item) | item["duplicate_group_id"].isNotNull())
        )

    def shape(item):
        name = item["attribute_name"]
        return F.struct(
            F.when(
                F.schema_of_variant(name) == "STRING", F.try_variant_get(name, "$", "string")
            ).alias("attribute_name"),
            is_true(item).alias("is_duplicate"),
            _id_text(item["duplicate_group_id"]).alias("duplicate_group_id"),
        )

    # all keys in one pass; an item that is no object is null
    listed = F.try_variant_get(
        parsed, "$.duplicates", "array<struct<attribute_name:variant,is_duplicate:variant,duplicate_group_id:variant>>"
    )
    return F.coalesce(
        F.transform(F.filter(listed, valid), shape), F.array().cast(ITEMS)
    )


def read_replies(df: DataFrame, reply: str = "response") -> DataFrame:
    """Add ``items`` (the valid verdict items) and ``rung`` (which step found them)."""
    text = F.col(reply)
    steps = df.withColumn("_strict", strict_json(candidate(text)))
    steps = steps.withColumn(
        "_parsed", F.when(F.col("_strict").isNotNull(), F.col("_strict")).otherwise(embedded_json(text))
    )
    steps = steps.withColumn(
        "_entries",
        F.when(F.col("_parsed").isNull(), F.concat(prose_groups(text), bullet_groups(text))),
    )
    steps = steps.withColumn(
        "_sections",
        F.when(F.col("_parsed").isNull() & (F.size(F.coalesce("_entries", F.array().cast("array<struct<gid:string,names:array<string>>>"))) == 0), section_groups(text)),
    )
    none = F.array().cast(ITEMS)
    items = F.when(F.col("_parsed").isNotNull(), valid_items(F.col("_parsed"))).when(
        F.size("_entries") > 0, group_items(F.col("_entries"))
    ).otherwise(group_items(F.col("_sections")))
    rung = (
        F.when(F.col("_strict").isNotNull(), F.lit("json"))
        .when(F.col("_parsed").isNotNull(), F.lit("embedded"))
        .when(F.size("_entries") > 0, F.lit("lines"))
        .when(F.size("_sections") > 0, F.lit("sections"))
        .otherwise(F.lit("none"))
    )
    return (
        steps.withColumn("items", F.coalesce(items, none).cast(ITEMS))
        .withColumn("rung", rung)
        .drop("_strict", "_parsed", "_entries", "_sections")
    )


def best_name(reply: Column, names: Column) -> Column:
    """The name a reply picks, null unless it is text and one of ``names``."""
    picked = F.try_variant_get(strict_json(candidate(reply)), "$.best_attribute", "variant")
    name = F.when(
        F.schema_of_variant(picked) == "STRING", F.try_variant_get(picked, "$", "string")
    )
    return F.when(F.array_contains(names, name), name)
