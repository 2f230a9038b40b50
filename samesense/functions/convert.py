"""Conversions between rows, JSON text, maps, lists and arrays."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from samesense.skew import let

SENTINEL = "end of text"


def strict_json(text: Column) -> Column:
    """The value of a JSON text, null if it is anything else.

    The parser stops after the first value, so the text is put in a list before a marker:
    only a single complete value leaves a list of exactly two with the marker last.
    """
    wrapped = F.try_parse_json(F.concat(F.lit("["), text, F.lit(f', "{SENTINEL}"]')))
    listed = F.try_variant_get(wrapped, "$", "array<variant>")
    return let(
        listed,
        lambda two: F.when(
            (F.size(two) == 2)
            & (
                F.coalesce(
                    F.try_variant_get(F.get(two, F.lit(1)), "$", "string"), F.lit("")
                )
                == SENTINEL
            ),
            F.get(two, F.lit(0)),
        ),
    )


def rows_to_json(df: DataFrame, keep: Sequence[str] = (), name: str = "record") -> DataFrame:
    """Each row as one JSON record."""
    return df.select(*keep, F.to_json(F.struct(*df.columns)).alias(name))


def json_to_rows(df: DataFrame, text: str, schema: str, name: str = "item") -> DataFrame:
    """One row per element of a JSON list; a single object counts as a list of one.

    Text that does not parse stays one row with ``item`` null and the text in ``raw``.
    """
    parsed = strict_json(F.col(text))
    as_list = F.when(
        F.schema_of_variant(parsed).startswith("ARRAY"),
        F.try_variant_get(parsed, "$", f"array<{schema}>"),
    ).when(
        F.schema_of_variant(parsed).startswith("OBJECT"),
        F.array(F.try_variant_get(parsed, "$", schema)),
    )
    rest = [c for c in df.columns if c != text]
    return df.withColumn("_list", as_list).select(
        *rest,
        F.explode_outer("_list").alias(name),
        F.when(F.col("_list").isNull(), F.col(text)).alias("raw"),
    )


def map_to_rows(df: DataFrame, mapping: str, keep: Sequence[str] = ()) -> DataFrame:
    """One row per key of a map column."""
    return df.select(*keep, F.explode(mapping).alias("key", "value"))


def map_to_list(mapping: Column) -> Column:
    """The values of a map."""
    return F.map_values(mapping)


def list_to_map(items: Column) -> Column:
    """List to ``{position: item}``, positions from 0."""
    size = F.size(items)
    keys = F.when(size > 0, F.sequence(F.lit(0), size - 1)).otherwise(
        F.array().cast("array<int>")
    )
    return F.map_from_arrays(keys, items)


def list_to_rows(df: DataFrame, items: str, keep: Sequence[str] = ()) -> DataFrame:
    """One row per element of a list column with its position."""
    return df.select(*keep, F.posexplode(items).alias("index", "item"))


def row_to_list(columns: Sequence[str]) -> Column:
    """The values of a row as a list of strings."""
    return F.array(*[F.col(c).cast("string") for c in columns])


def row_to_vector(columns: Sequence[str]) -> Column:
    """Numeric columns of a row as one dense vector."""
    return F.array(*[F.col(c).cast("double") for c in columns])


def value_to_json(value: Column) -> Column:
    """A nested value as JSON text."""
    return F.to_json(value)
