"""Quality rules: a threshold table compiled into one Spark projection.

Every measure is a built-in expression over the row's own text, so a table of any
size is one scan without a shuffle, and a very long text costs time in proportion.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from samesense.llm.words import SPACE, WORD, fresh, let, whole, word_list

# Fixed value: the characters that count as symbols.
SYMBOLS = "[#*$%&|<>]"

# Frequent function words of the four languages of the tables.
STOP_WORDS = [
    *"the of and to in a is that for with on was it as be by at from this are or an have not which".split(),
    *"de la que el en y los se del las un por con no una su para es al lo como".split(),
    *"le et les des du une est pour qui dans par plus pas au sur ne".split(),
    *"der die und den von zu das mit sich auf für ist im dem nicht ein eine als auch".split(),
]


def stop_words() -> list[str]:
    """The stop words as they stand inside and at the start of a sentence."""
    return sorted({form for word in STOP_WORDS for form in (word, word.capitalize())})


@dataclass(frozen=True)
class Rule:
    """``low <= part / whole <= high``; a ratio over nothing passes."""

    name: str
    part: str
    whole: str
    low: float = 0.0
    high: float = float("inf")


# The production table. The limits leave wide room on the side of clean prose.
RULES = (
    Rule("word_length", "word_chars", "n_words", low=2.0, high=12.0),
    Rule("symbols", "n_symbols", "n_words", high=0.1),
    Rule("stop_words", "n_stop_words", "n_words", low=0.03),
    Rule("repeated_lines", "n_dup_lines", "n_lines", high=0.5),
)
MIN_WORDS = 20
MAX_REPEATED_PERCENT = 30
REPEAT_WINDOW = 8


def _covered(windows: Column, width: int) -> Column:
    """Words inside a window whose hash occurs more than once in the array."""

    def total(at: Column) -> Column:
        last = F.size(at) - 1
        steps = F.transform(
            at, lambda x, i: F.when(i < last, F.least(F.get(at, i + 1) - x, F.lit(width))).otherwise(width)
        )
        return F.aggregate(steps, F.lit(0).cast("bigint"), lambda total, step: total + step)

    def repeated(ordered: Column) -> Column:
        same = lambda i, j: F.coalesce(F.get(ordered, i)["h"] == F.get(ordered, j)["h"], F.lit(False))
        places = F.filter(
            F.transform(
                ordered,
                lambda x, i: F.when(same(i, i + 1) | ((i > 0) & same(i, i - 1)), x["i"]),
            ),
            lambda i: i.isNotNull(),
        )
        return let(F.sort_array(places), total)

    pairs = F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0).cast("bigint")).otherwise(
        let(F.sort_array(pairs), repeated)
    )


def measures(text: Column) -> Column:
    """Struct of all counts of one text (null: the empty text)."""
    text = whole(text)

    def of_words(words: Column) -> Column:
        n = F.size(words)
        windows = F.when(
            n >= REPEAT_WINDOW,
            F.transform(
                F.sequence(F.lit(1), n - (REPEAT_WINDOW - 1)),
                lambda i: F.xxhash64(F.slice(words, i, F.lit(REPEAT_WINDOW))),
            ),
        ).otherwise(F.array().cast("array<bigint>"))
        lines = F.filter(F.split(text, "\n", -1), lambda line: line.rlike(WORD))
        return F.struct(
            n.cast("bigint").alias("n_words"),
            F.length(F.regexp_replace(text, SPACE, "")).cast("bigint").alias("word_chars"),
            (F.length(text) - F.length(F.regexp_replace(text, SYMBOLS, ""))).cast("bigint").alias("n_symbols"),
            let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("bigint").alias("n_dup_lines"),
            let(windows, lambda x: _covered(x, REPEAT_WINDOW)).cast("bigint").alias("n_repeat_words"),
            F.size(F.filter(words, lambda w: w.isin(stop_words()))).cast("bigint").alias("n_stop_words"),
            F.size(lines).cast("bigint").alias("n_lines"),
        )

    return let(word_list(text), of_words)


def verdict(counts: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """The counts with ``base_failed``, the names of the ``failed`` rules, and ``kept``."""

    def outside(rule: Rule) -> Column:
        ratio = F.try_divide(counts[rule.part], counts[rule.whole])
        out = F.lit(False)
        if rule.low > 0:
            out = out | (ratio < rule.low)
        if rule.high < float("inf"):
            out = out | (ratio > rule.high)
        return F.coalesce(out, F.lit(False))

    base = (counts["n_words"] < MIN_WORDS) | (
        100 * counts["n_repeat_words"] > MAX_REPEATED_PERCENT * counts["n_words"]
    )
    failed = F.filter(
        F.array(*[F.when(outside(rule), F.lit(rule.name)) for rule in rules]), lambda x: x.isNotNull()
    )
    kept = ~reduce(lambda a, b: a | b, [outside(rule) for rule in rules], base)
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_stop_words", "n_lines")
    return F.struct(
        *[counts[name].alias(name) for name in names],
        base.alias("base_failed"),
        failed.alias("failed"),
        kept.alias("kept"),
    )


def judge(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> tuple[DataFrame, str]:
    """``docs`` with one struct column of counts and verdict, and that column's name.

    The name is chosen so that no column of ``docs`` clashes. A null or empty text has no
    words, fails the base rule and is not kept; an empty table gives an empty table;
    repeated rows get the same verdict each. Window repeats are found by 64-bit hashes.
    """
    name = fresh(docs, "quality")
    return docs.withColumn(name, let(measures(F.col(text)), lambda counts: verdict(counts, rules))), name


def keep(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows of ``docs`` that pass, with their own columns."""
    judged, name = judge(docs, text, rules)
    return judged.where(F.col(name)["kept"]).drop(name)
