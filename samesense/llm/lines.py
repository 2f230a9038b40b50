"""Line dedup by winnowing: repeated lines are deleted where they come later.

The lines of a document that hold a word are hashed. Of every ``WINDOW`` lines in a row the one with
the smallest hash (of equal ones the last) is a fingerprint, so any ``WINDOW`` lines that two places
share hold the same fingerprint in both. Lines of at least ``LEAST_WORDS`` words are fingerprints
too, whatever their neighbours. A fingerprint's owner is its first place, by document id and line.
Every later place is matched with the owner and extended both ways as far as the next
fingerprint must have come: there the owner is the first place of the fingerprint together with
the line after or before it, since the longer context may have come first somewhere else.

So any two lines in a row that an earlier place holds are deleted, and any single line of
``LEAST_WORDS`` words or more; a shorter line that repeats alone goes only where it is a window's
minimum in both places. With ``least_words=1`` every line is a fingerprint, and each line that an
earlier place holds is deleted (``op7_single_line_dedup``).

All steps are column functions. Fingerprints carry the hashes of the lines around them, so
documents themselves are never joined with each other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from samesense.llm import bloom
from samesense.llm.words import SPACE, WORD, fresh, let, whole
from samesense.skew import lookup
from samesense.storage import store

WINDOW = 2
# Lines of so many words are fingerprints wherever they stand.
LEAST_WORDS = 5


def _raw_lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def worded_lines(text: Column) -> Column:
    """The lines with a word, in order."""
    return F.filter(_raw_lines(text), lambda line: line.rlike(WORD))


def winnow(hashes: Column, window: int = WINDOW) -> Column:
    """Places of the minima of every ``window`` hashes in a row, of equal ones the last."""
    last = F.greatest(F.size(hashes) - window, F.lit(0))
    least = F.transform(
        F.sequence(F.lit(0), last),
        lambda j: F.array_min(
            F.transform(F.slice(hashes, j + 1, F.lit(window)), lambda g, i: F.struct(g.alias("g"), (-(i + j)).alias("i")))
        ),
    )
    return F.when(F.size(hashes) > 0, F.array_distinct(F.transform(least, lambda x: -x["i"]))).otherwise(
        F.array().cast("array<int>")
    )


def long_lines(lines: Column, least_words: int) -> Column:
    """Places of the lines with at least so many words."""
    long = f"(?:{WORD}{SPACE}){{{least_words - 1}}}{WORD}"
    return F.filter(F.transform(lines, lambda line, i: F.when(line.rlike(long), i)), lambda i: i.isNotNull())


def fingerprints(docs: DataFrame, least_words: int = LEAST_WORDS) -> DataFrame:
    """``k1, k2, owner_id, text`` rows as fingerprints with their place and the lines next to them.

    A line is known by two 64-bit hashes: ``l0, l1``, those before it ``p0, p1``, those after ``n0, n1``.
    """

    def chosen(lines: Column) -> Column:
        if least_words <= 1:
            return F.when(F.size(lines) > 0, F.sequence(F.lit(0), F.size(lines) - 1)).otherwise(F.array().cast("array<int>"))
        minima = let(F.transform(lines, lambda line: F.md5(line)), lambda hashes: winnow(hashes))
        return F.array_distinct(F.concat(minima, long_lines(lines, least_words)))

    made = let(
        worded_lines(F.col("text")),
        lambda lines: F.struct(
            F.transform(lines, lambda line: F.xxhash64(line)).alias("h0"),
            F.transform(lines, lambda line: F.xxhash64(F.lit(4), line)).alias("h1"),
            chosen(lines).alias("at"),
        ),
    )
    rows = docs.select("k1", "k2", "owner_id", made.alias("made"))
    placed = rows.select("k1", "k2", "owner_id", "made.h0", "made.h1", F.explode("made.at").alias("line"))
    near = {side + str(i): F.when(F.col("line") + step >= 0, F.get(f"h{i}", F.col("line") + step))
            for side, step in (("l", 0), ("p", -1), ("n", 1)) for i in (0, 1)}
    return placed.select(
        *[value.alias(name) for name, value in near.items()],
        F.struct(F.col("owner_id").isNull().alias("no_id"), "owner_id", "k1", "k2", "line").alias("place"),
    )


def _later(prints: DataFrame, keys: list[str], first: str) -> DataFrame:
    """``prints`` whose ``keys`` are in several places, with the first of them."""
    owners = store(
        prints.groupBy(*keys).agg(F.min("place").alias(first), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"),
        "line-owners",
    )
    # a frequent line owns a large share of the rows: hot ones are split
    return lookup(prints, owners, keys, ["place"], "inner")


def repeated(prints: DataFrame) -> DataFrame:
    """Runs to delete: ``k1, k2, low, high``, counting lines with a word, end exclusive."""
    prints = store(prints, "line-prints")
    line = ["l0", "l1"]
    again = store(_later(prints, line, "first"), "repeated-lines")
    runs = None
    for extended, keys, low, high in ((None, [], 0, 1), ("n0", ["n0", "n1"], 0, 2), ("p0", ["p0", "p1"], -1, 1)):
        met = again
        if extended:
            met = _later(again.drop("first").where(F.col(extended).isNotNull()), line + keys, "first")
        found = met.where("place <> first").select(
            F.col("place.k1").alias("k1"),
            F.col("place.k2").alias("k2"),
            (F.col("place.line") + low).alias("low"),
            (F.col("place.line") + high).alias("high"),
        )
        runs = found if runs is None else runs.unionByName(found)
    return runs


def _delete(text: Column, runs: Column) -> Column:
    """Struct of the text without the runs' lines, and how many those are."""

    def rebuild(lines: Column) -> Column:
        worded = F.filter(
            F.transform(lines, lambda line, i: F.when(line.rlike(WORD), i)), lambda i: i.isNotNull()
        )
        gone = let(
            worded,
            lambda at: F.array_distinct(
                F.flatten(F.transform(runs, lambda r: F.slice(at, r["low"] + 1, r["high"] - r["low"])))
            ),
        )
        return let(
            gone,
            lambda gone: F.struct(
                F.array_join(
                    F.transform(
                        F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), gone), lambda i: F.get(lines, i)
                    ),
                    "\n",
                ).alias("text"),
                F.size(gone).cast("bigint").alias("deleted"),
            ),
        )

    return let(_raw_lines(text), rebuild)


def dedup_lines(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least_words: int = LEAST_WORDS
) -> tuple[DataFrame, str]:
    """``docs`` with repeated lines deleted from the text, and a column of how many lines went.

    Documents are ordered by id (null last), then by a hash of the text. Lines are compared
    whole; lines without a word are left where they are and do not interrupt a run. A null
    text stays null and an empty one empty. Rows with equal id and text count as one place
    and get the same result; an empty table gives an empty table. Other columns stay.
    """
    count, k1, k2 = fresh(docs, "n_deleted"), fresh(docs, "_k1"), fresh(docs, "_k2")
    body = whole(text)
    hashed = lambda seed: F.xxhash64(F.lit(seed), F.col(doc_id), body)
    keyed = docs.withColumn(k1, hashed(1)).withColumn(k2, hashed(2))
    plain = keyed.select(F.col(k1).alias("k1"), F.col(k2).alias("k2"), F.col(doc_id).alias("owner_id"), body.alias("text"))
    runs = store(
        repeated(fingerprints(plain, least_words))
        .groupBy("k1", "k2")
        .agg(F.collect_set(F.struct("low", "high")).alias("runs")),
        "line-runs",
    )
    none = F.lit(0).cast("bigint").alias(count)
    n = runs.count()
    if not n:
        return docs.select("*", none), count
    keys = runs.select(F.xxhash64("k1", "k2").alias("key"))
    likely, other = bloom.split(keyed, F.xxhash64(k1, k2), keys, n)
    held = fresh(keyed, "runs")
    runs = runs.select(F.col("k1").alias(k1), F.col("k2").alias(k2), F.col("runs").alias(held))
    joined = likely.join(runs, [k1, k2], "left").withColumn(held, F.when(F.col(held).isNotNull(), _delete(body, F.col(held))))
    changed = joined.select(
        *[F.coalesce(F.col(held)["text"], F.col(c)).alias(c) if c == text else F.col(c) for c in docs.columns],
        F.coalesce(F.col(held)["deleted"], F.lit(0)).alias(count),
    )
    return changed.unionByName(other.select(*docs.columns, none)), count
