"""Vectors as array columns, and the offline word-hash encoder."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from samesense.skew import let

DIMENSIONS = 64
WORD = r"[\p{L}\p{N}]+"


def dot(left: Column, right: Column) -> Column:
    return F.aggregate(
        F.zip_with(left, right, lambda a, b: a.cast("double") * b.cast("double")),
        F.lit(0.0),
        lambda total, x: total + x,
    )


def norm(vector: Column) -> Column:
    return F.sqrt(
        F.aggregate(
            vector, F.lit(0.0), lambda total, x: total + x.cast("double") * x.cast("double")
        )
    )


def normalised(vector: Column) -> Column:
    """Unit vector in double precision; null for a zero vector.

    Adding 0.0 turns a negative zero into a plain one, so equal vectors hash alike.
    """
    return let(
        norm(vector),
        lambda size: F.when(
            size > 0, F.transform(vector, lambda x: x.cast("double") / size + F.lit(0.0))
        ),
    )


def words(text: Column) -> Column:
    """Lower-case runs of letters and digits."""
    return F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))


def word_bucket(word: Column, dimensions: int) -> Column:
    """Stable bucket of a word: the first 32 bits of its MD5, modulo the dimensions."""
    head = F.conv(F.substring(F.md5(word), 1, 8), 16, 10).cast("bigint")
    return (head % F.lit(dimensions)).cast("int")


def word_counts(text: Column, dimensions: int = DIMENSIONS) -> Column:
    """Number of words per bucket, as a dense array.

    Everything happens inside the row, so no shuffle and no exploded words. Each bucket
    number is added once to the sorted list; a bucket's count is then the distance
    between the starts of two neighbouring runs, less one.
    """
    tagged = F.sort_array(
        F.concat(
            F.transform(words(text), lambda w: word_bucket(w, dimensions)),
            F.sequence(F.lit(0), F.lit(dimensions - 1)),
        )
    )

    def runs(sorted_buckets: Column) -> Column:
        size = F.size(sorted_buckets)
        starts = F.filter(
            F.sequence(F.lit(0), size - 1),
            lambda i: (i == 0)
            | (F.get(sorted_buckets, i) != F.get(sorted_buckets, i - F.lit(1))),
        )
        return let(
            starts,
            lambda s: F.transform(
                s,
                lambda start, j: (
                    F.coalesce(F.get(s, j + F.lit(1)), size) - start - F.lit(1)
                ),
            ),
        )

    return let(tagged, runs)


def hashed_words(text: Column, dimensions: int = DIMENSIONS) -> Column:
    """L2-normalised bag of hashed words; the zero vector for a text without words."""
    counts = word_counts(text, dimensions)
    return let(
        counts,
        lambda c: let(
            F.greatest(norm(c), F.lit(1e-9)),
            lambda size: F.transform(c, lambda x: (x.cast("double") / size).cast("float")),
        ),
    )
