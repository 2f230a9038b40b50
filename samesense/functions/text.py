"""Scalar columns: embedding text, ids, names, estimates and chat messages."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The label of a missing cell, the id prefix and the length limits.
MISSING = "nan"
GROUP_PREFIX = "cluster_"
CONTEXT_LENGTH = 100
LABEL_LENGTH = 50
CHARS_PER_TOKEN = 4


def embedding_text(name: Column, definition: Column) -> Column:
    """``name: definition``; a missing cell reads ``nan``."""
    return F.concat(
        F.coalesce(name, F.lit(MISSING)), F.lit(": "), F.coalesce(definition, F.lit(MISSING))
    )


def group_key(cluster: Column, group: Column) -> Column:
    """Id of a group that is unique over all clusters."""
    return F.concat(F.lit(GROUP_PREFIX), cluster.cast("string"), F.lit("_"), group)


def context_name(context: Column) -> Column:
    """A context label that is safe in a file name."""
    return F.substring(F.regexp_replace(context, "[^A-Za-z0-9_.-]", "_"), 1, CONTEXT_LENGTH)


def group_label(names: Column) -> Column:
    """Sorted names of a group joined to a short label."""
    return F.substring(F.concat_ws("_", F.sort_array(names)), 1, LABEL_LENGTH)


def token_estimate(text: Column) -> Column:
    """Rough token count: four characters to a token, rounded down."""
    return F.floor(F.length(text) / F.lit(CHARS_PER_TOKEN)).cast("bigint")


def to_number(value: Column) -> Column:
    """Number in ``value``, null where it does not hold one."""
    return value.try_cast("double")


def strip_fence(reply: Column) -> Column:
    """Drop backquotes and the letters j, s, o, n from both ends of a reply."""
    return F.btrim(reply, F.lit("`json"))


def response_format(prompt: Column, schema: Column) -> Column:
    """The reply format to ask for: a given schema, else JSON if the prompt names it."""
    return (
        F.when(schema.isNotNull(), F.lit("json_schema"))
        .when(prompt.rlike(r"(?i)\bJSON\b"), F.lit("json_object"))
        .otherwise(F.lit("text"))
    )


def chat_messages(prompt: Column, system: Column) -> Column:
    """Messages of one request: the system turn, if there is one, then the user turn."""
    user = F.struct(F.lit("user").alias("role"), prompt.alias("content"))
    lead = F.struct(F.lit("system").alias("role"), system.alias("content"))
    has_system = system.isNotNull() & (system != "")
    return F.when(has_system, F.array(lead, user)).otherwise(F.array(user))
