"""URL filters: rules and lists judged through a Bloom filter cascade.

Level 1 encodes the listed keys, level 2 the keys of the corpus that level 1 admits
wrongly, level 3 the listed keys that level 2 admits wrongly, and so on until a level
admits nothing wrongly. Over the corpus's complete key universe the answer is then
exact, and judging a table is a projection: no join and no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from samesense.llm import bloom
from samesense.llm.words import LOWER, UPPER, fresh, let
from samesense.storage import discard, store

MAX_LEVELS = 64


def contains(key: Column, levels: list[bloom.Level], words: list[Column] | None = None) -> Column:
    """Exact membership of a key of the universe the cascade was built for.

    Inside a lambda the levels' ``words`` come from ``bloom.with_words``.
    """
    found = F.lit(bool(len(levels) % 2))
    for number in range(len(levels) - 1, -1, -1):
        # a key beyond the last level that admits it belongs to that level's own side
        beyond = found if number < len(levels) - 1 else F.lit(number % 2 == 0)
        found = F.when(bloom.admits(key, levels[number], None if words is None else words[number]), beyond).otherwise(F.lit(number % 2 == 1))
    return found


def cascade(listed: DataFrame, universe: DataFrame, max_bytes: int = 64 << 20) -> list[bloom.Level]:
    """Filter levels that tell ``listed`` keys from all other keys of ``universe``.

    Both have a column ``key``; listed keys outside the universe are never asked for and
    are left out. The first level's rate is the ratio of the two sides, so that the false
    positives it leaves are about as many as the listed keys: total size grows with the
    list and with the logarithm of the universe only. Nulls are no keys. No listed key:
    no level, and nothing is found.
    """
    keys = store(
        universe.select("key", F.lit(0).alias("side"))
        .unionByName(listed.select("key", F.lit(1).alias("side")))
        .where("key IS NOT NULL")
        .groupBy("key")
        .agg(F.max("side").alias("side"), F.min("side").alias("asked"))
        .where("asked = 0")
        .select("key", "side"),
        "url-keys",
    )
    count = {row["side"]: row["n"] for row in keys.groupBy("side").agg(F.count("*").alias("n")).collect()}
    levels: list[bloom.Level] = []
    inside, outside = count.get(1, 0), count.get(0, 0)
    side, left = 1, keys.where("side = 1")
    while inside:
        if len(levels) == MAX_LEVELS:
            raise RuntimeError("the cascade does not end; keys collide in every hash")
        rate = min(0.5, inside / (1.4 * outside)) if not levels and outside else 0.5
        level = bloom.build(left, inside, rate, len(levels), max_bytes)
        levels.append(level)
        # the other side's keys that every level so far admits
        side = 1 - side
        left = keys.where(F.col("side") == side)
        for earlier in levels:
            left = left.where(bloom.admits(F.col("key"), earlier))
        inside = left.count()
    discard(keys)
    return levels


def host_and_path(url: Column) -> Column:
    """Struct of ``host`` (A-Z lower-cased) and ``path``; both empty without ``://``."""
    begin = F.coalesce(F.instr(url, "://"), F.lit(0))
    after = F.when(begin > 0, F.substr(url, begin + 3)).otherwise("")
    return let(
        F.regexp_extract(after, r"^([^?#]*)", 1),
        lambda rest: let(
            F.regexp_extract(rest, r"^([^/]*)", 1),
            lambda host: F.struct(
                F.translate(host, UPPER, LOWER).alias("host"),
                F.substr(rest, F.length(host) + 1).alias("path"),
            ),
        ),
    )


def candidate_keys(host: Column, path: Column, lengths: list[int]) -> Column:
    """Every rule key that could fit: host suffixes by path prefixes of the listed lengths."""
    labels = F.split(host, r"\.", -1)
    suffixes = F.transform(
        labels, lambda _, i: F.array_join(F.slice(labels, i + 1, F.size(labels)), ".")
    )
    starts = F.filter(F.lit(lengths).cast("array<int>"), lambda n: n <= F.length(path))
    return F.flatten(
        F.transform(
            suffixes,
            lambda suffix: F.transform(
                starts, lambda n: F.concat(suffix, F.substr(path, F.lit(1), n))
            ),
        )
    )


def split_rules(rules: DataFrame) -> DataFrame:
    """``rule, verdict`` as ``key, blocked, n``: the host part lower-cased, the path's length.

    A rule without a slash fits every path of its host. A rule listed both ways blocks.
    """
    host = F.translate(F.regexp_extract("rule", r"^([^/]*)", 1), UPPER, LOWER)
    path = F.substr(F.col("rule"), F.length(host) + 1)
    return (
        rules.where("rule IS NOT NULL")
        .select(F.concat(host, path).alias("key"), F.length(path).alias("n"), (F.col("verdict") == "block").alias("blocked"))
        .groupBy("key", "n")
        .agg(F.max("blocked").alias("blocked"))
    )


def judge_urls(
    pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow", max_bytes: int = 64 << 20
) -> tuple[DataFrame, str]:
    """``pages`` with a struct ``host, path, rule, verdict``, and the struct's name.

    The longest fitting rule decides (of equally long ones that with the longer host);
    without one, a URL gets ``default``. A null URL and one without ``://`` have an empty
    host and path, which no rule fits. Two cascades are built: listed keys over all keys
    of the corpus, and blocking keys over the listed ones. Repeated rows are judged each;
    an empty table or list gives no rule anywhere.
    """
    listed = split_rules(rules)
    lengths = sorted(row["n"] for row in listed.select("n").distinct().collect())
    name = fresh(pages, "judged")
    split = pages.withColumn(name, host_and_path(F.col(url)))
    keys = candidate_keys(F.col(name)["host"], F.col(name)["path"], lengths)
    universe = split.where(F.col(name)["host"] != "").select(F.explode(keys).alias("key")).distinct()
    known = cascade(listed.select("key"), universe, max_bytes)
    blocking = cascade(listed.where("blocked").select("key"), listed.select("key"), max_bytes)

    def decide(hits: Column, words: list[Column]) -> Column:
        best = F.array_max(
            F.transform(
                hits,
                lambda key: F.struct(F.length(key).alias("n"), F.length(F.substring_index(key, "/", 1)).alias("h"), key.alias("key")),
            )
        )
        return let(
            best["key"],
            lambda key: F.struct(
                F.col(name)["host"].alias("host"),
                F.col(name)["path"].alias("path"),
                key.alias("rule"),
                F.when(key.isNull(), default)
                .when(contains(key, blocking, words), "block")
                .otherwise("allow")
                .alias("verdict"),
            ),
        )

    def judged(words: list[Column]) -> Column:
        hits = F.filter(keys, lambda key: contains(key, known, words[: len(known)]))
        hits = F.when(F.col(name)["host"] != "", hits).otherwise(F.array().cast("array<string>"))
        return let(hits, lambda found: decide(found, words[len(known) :]))

    return bloom.with_words(split, name, [*known, *blocking], judged), name
