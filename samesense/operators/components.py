"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from samesense.skew import lookup
from samesense.storage import discard, store


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("u", "v").unionByName(
        edges.select(F.col("v").alias("u"), F.col("u").alias("v"))
    )


def _lowest(both: DataFrame) -> DataFrame:
    """Lowest of a node and its neighbours; a map-side aggregate, so hubs are no problem."""
    return both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))


def _large_star(edges: DataFrame, n: int) -> DataFrame:
    """Hang every higher neighbour of a node on the node's lowest neighbour."""
    both = _both_ways(edges)
    joined = lookup(
        both.where("v > u"), _lowest(both), ["u"], ["v"], "inner", known_rows=n
    )
    return joined.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _small_star(edges: DataFrame, n: int) -> DataFrame:
    """Hang a node and its lower neighbours on the lowest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    lowest = down.groupBy("u").agg(F.min("v").alias("m"))
    joined = lookup(down, lowest, ["u"], ["v"], "inner", known_rows=n)
    return (
        joined.select(F.col("v").alias("u"), F.col("m").alias("v"))
        .unionByName(lowest.select("u", F.col("m").alias("v")))
        .where("u <> v")
        .distinct()
    )


def _fingerprint(edges: DataFrame) -> tuple:
    return tuple(
        edges.agg(
            F.count(F.lit(1)),
            F.bit_xor(F.xxhash64("u", "v")),
            F.bit_xor(F.xxhash64("v", "u", F.lit(1))),
        ).first()
    )


def components(edges: DataFrame, left: str, right: str, max_rounds: int = 60) -> DataFrame:
    """Nodes of the graph with the lowest node of their component: ``node, root``.

    Alternates the published large-star and small-star steps until the edges no longer
    change; each round works on all edges in parallel and is written to the shared
    checkpoint folder. The number of rounds grows with the logarithm of the longest
    path. Nodes without an edge are not in the result.
    """
    current = store(
        edges.select(F.col(left).alias("u"), F.col(right).alias("v")).where("u <> v").distinct(),
        "edges",
    )
    before = _fingerprint(current)
    for _ in range(max_rounds):
        if before[0] == 0:
            break
        last, current = current, store(
            _small_star(_large_star(current, before[0]), before[0]), "edges"
        )
        after = _fingerprint(current)
        discard(last)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = current.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return current.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
