"""Source divergence audit: how far apart the word use of sources is, by a K-squared quadtree.

Per language the counts form a matrix, one row per source and one column per kept term, with
rows and columns numbered from the most frequent on, so that empty cells lie together. The
matrix is cut into tiles of ``ROWS`` by ``COLUMNS`` cells. Two tiles that lie in the same
columns are one task's work: each becomes a K-squared quadtree (K = 2: a node has a bit per
quadrant, an all-zero quadrant has no node), and both trees are walked together. Where both
quadrants are empty, every pair of rows differs by the same smoothed zero in each column, so
the quadrant is priced by its width; leaves with a count are compared one by one. Tiles that
are empty for both rows are priced the same way without being visited.

All arithmetic is in whole numbers. Terms are counted in tasks by bounded tables before
anything is shuffled.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from samesense.llm.words import PART_BYTES, parts
from samesense.skew import positions
from samesense.storage import store

# Documents of its language that a term must occur in.
LEAST_DOCS = 30
# Added to each count, and the whole that shares are parts of.
SMOOTH = 5
SCALE = 1_000_000_000
TOP = 50
# Cells of a tile; two tiles of rows are compared in a task at a time.
ROWS = 64
COLUMNS = 1024
# Entries of a task's counting tables before they are handed on.
TABLE_ENTRIES = 400_000
# Every byte outside a term becomes a blank: ASCII other than letters. Bytes of other characters stay.
_TERMS = bytes(b if b >= 0x80 else b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 else 32 for b in range(256))
_BETWEEN = bytes(b for b in range(256) if _TERMS[b] == 32)


def terms_of(data: bytes, size: int = PART_BYTES) -> Iterator[list[bytes]]:
    """The terms of a text in UTF-8, a bounded part of the text at a time."""
    for part in parts(data, _BETWEEN, size):
        yield part.translate(_TERMS).split()


def count_terms(docs: DataFrame) -> DataFrame:
    """Partial counts ``lang, source, term, n, docs``; each group also has a row with a null term."""

    def flush(tables: dict) -> Iterator[pa.RecordBatch]:
        for (lang, source), (total, seen) in tables.items():
            terms = pa.array([None, *total], pa.binary()).cast(pa.string())
            rows = len(terms)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([lang] * rows, pa.string()),
                    pa.array([source] * rows, pa.string()),
                    terms,
                    pa.array([0, *total.values()], pa.int64()),
                    pa.array([0, *(seen[t] for t in total)], pa.int64()),
                ],
                ["lang", "source", "term", "n", "docs"],
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables: dict[tuple[str, str], tuple[Counter, Counter]] = {}
        entries = 0
        for batch in batches:
            langs, sources = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for i, (lang, source) in enumerate(zip(langs, sources, strict=True)):
                total, seen = tables.setdefault((lang, source), (Counter(), Counter()))
                before, own = len(total), set()
                for terms in terms_of(batch.column(2)[i].as_buffer().to_pybytes()):
                    total.update(terms)
                    own.update(terms)
                seen.update(own)
                entries += len(total) - before
                if entries > TABLE_ENTRIES:
                    yield from flush(tables)
                    tables, entries = {}, 0
        yield from flush(tables)

    empty = lambda name: F.coalesce(F.col(name), F.lit(""))
    plain = docs.select(
        empty("lang").alias("lang"), empty("source").alias("source"), empty("text").cast("binary").alias("text")
    )
    return plain.mapInArrow(run, "lang string, source string, term string, n bigint, docs bigint")


def share(n: Column, whole: Column) -> Column:
    """``1 + floor(SCALE * (n + SMOOTH) / whole)``, exact at any count."""
    top = F.lit(SCALE).cast("decimal(10,0)") * (n + SMOOTH).cast("decimal(20,0)")
    return F.lit(1).cast("bigint") + F.call_function("div", top, whole.cast("decimal(20,0)"))


def shares(n: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """As ``share``, by long division in base 1000, so that no step leaves 64 bits."""
    found, rest = np.divmod(n + SMOOTH, whole)
    for _ in range(3):
        more, rest = np.divmod(rest * 1000, whole)
        found = found * 1000 + more
    return found + 1


class Quadtree:
    """K-squared quadtree over the cells of a tile.

    ``nodes[l]`` holds the codes of the non-empty blocks of ``2^l`` by ``2^l`` cells, row and
    column bits interleaved; ``child[l][node, quadrant]`` is the number of the quadrant's node
    one level down, or -1 where all its cells are zero. Level 0 are the cells.
    """

    def __init__(self, rows: np.ndarray, columns: np.ndarray, height: int):
        code = np.zeros(len(rows), "int64")
        for bit in range(height):
            code |= ((columns >> bit) & 1) << (2 * bit) | ((rows >> bit) & 1) << (2 * bit + 1)
        self.order = np.argsort(code)
        self.nodes = [code[self.order]]
        self.child: list[np.ndarray] = [np.empty((0, 4), "int64")]
        for _ in range(height):
            below = self.nodes[-1]
            own = np.unique(below >> 2)
            child = np.full((len(own), 4), -1, "int64")
            child[np.searchsorted(own, below >> 2), below & 3] = np.arange(len(below))
            self.nodes.append(own)
            self.child.append(child)

    def root(self) -> int:
        return 0 if len(self.nodes[-1]) else -1

    def down(self, level: int, node: np.ndarray, quadrant: np.ndarray) -> np.ndarray:
        """Nodes of the quadrants one level down; -1 stays -1."""
        if not len(self.child[level]):
            return np.full(len(node), -1, "int64")
        return np.where(node >= 0, self.child[level][np.maximum(node, 0), quadrant], -1)


def price_tiles(
    one: tuple[np.ndarray, np.ndarray, np.ndarray],
    two: tuple[np.ndarray, np.ndarray, np.ndarray],
    whole_one: np.ndarray,
    whole_two: np.ndarray,
    width: int,
    same: bool,
) -> tuple[np.ndarray, int]:
    """Sum over ``width`` columns of the share differences of every row of ``one`` and of ``two``.

    Tiles are ``rows, columns, counts``; ``whole_*`` are the rows' denominators. With ``same``
    both are one tile, and only pairs above the diagonal are filled. Also returns the number
    of leaves that were compared.
    """
    n, m = len(whole_one), len(whole_two)
    height = max(1, int(max(n, m, width) - 1).bit_length())
    a = Quadtree(one[0], one[1], height)
    b = a if same else Quadtree(two[0], two[1], height)
    zero_one = shares(np.zeros(n, "int64"), whole_one) if width else np.zeros(n, "int64")
    zero_two = shares(np.zeros(m, "int64"), whole_two) if width else np.zeros(m, "int64")
    value_one = shares(one[2][a.order], whole_one[one[0][a.order]])
    value_two = value_one if same else shares(two[2][b.order], whole_two[two[0][b.order]])
    total = np.zeros((n, m), "int64")
    empty = np.zeros((n, m), "int64")
    # a frontier entry: a node of each tree, their row blocks, and their common column block
    walk = [np.array([x], "int64") for x in (a.root(), b.root(), 0, 0, 0)]

    def price_empty(level: int, walk: list[np.ndarray]) -> list[np.ndarray]:
        """Add the widths of the blocks that are zero on both sides, and go on with the others."""
        bare = (walk[0] < 0) & (walk[1] < 0)
        if bare.any():
            rows, others, column = (part[bare] for part in walk[2:])
            size = 1 << level
            wide = np.zeros((-(-n // size), -(-m // size)), "int64")
            np.add.at(wide, (rows, others), np.minimum(size, width - column * size))
            empty[:] += np.repeat(np.repeat(wide, size, axis=0)[:n], size, axis=1)[:, :m]
        return [part[~bare] for part in walk]

    if not width:
        return total, 0
    walk = price_empty(height, walk)
    for level in range(height, 0, -1):
        parts = []
        for upper in range(2):
            for lower in range(2):
                for column in range(2):
                    parts.append(
                        [
                            a.down(level, walk[0], np.full(len(walk[0]), 2 * upper + column)),
                            b.down(level, walk[1], np.full(len(walk[1]), 2 * lower + column)),
                            2 * walk[2] + upper,
                            2 * walk[3] + lower,
                            2 * walk[4] + column,
                        ]
                    )
        walk = [np.concatenate([part[i] for part in parts]) for i in range(5)]
        size = 1 << (level - 1)
        inside = (walk[2] * size < n) & (walk[3] * size < m) & (walk[4] * size < width)
        if same:
            inside &= walk[2] <= walk[3]
        walk = price_empty(level - 1, [part[inside] for part in walk])
    x, y = (np.where(node >= 0, value[node] if len(value) else 0, zero[row]) for node, value, zero, row in (
        (walk[0], value_one, zero_one, walk[2]), (walk[1], value_two, zero_two, walk[3])))
    np.add.at(total, (walk[2], walk[3]), np.abs(x - y))
    total += empty * np.abs(zero_one[:, None] - zero_two[None, :])
    return (np.triu(total, 1) if same else total), len(walk[0])


def _comparer(tile_rows: int, tile_columns: int):
    def compare(unit: pa.Table) -> pa.Table:
        """Differences of the row pairs of two tiles: ``lang, one, two, value, width``."""
        first = {name: unit[name][0].as_py() for name in ("lang", "strip", "a", "b", "kept")}
        row, column, n, whole = (unit[name].to_numpy() for name in ("row", "col", "n", "whole"))
        width = max(0, min(tile_columns, first["kept"] - first["strip"] * tile_columns))
        same = first["a"] == first["b"]

        def tile(number):
            own = row // tile_rows == number
            heads, cells = own & (column < 0), own & (column >= 0)
            denominators = np.ones(int(heads.sum()), "int64")
            denominators[row[heads] % tile_rows] = whole[heads]
            return denominators, (row[cells] % tile_rows, column[cells] - first["strip"] * tile_columns, n[cells])

        whole_one, one = tile(first["a"])
        whole_two, two = (whole_one, one) if same else tile(first["b"])
        total, _ = price_tiles(one, two, whole_one, whole_two, width, same)
        i, j = np.triu_indices(len(whole_one), 1) if same else np.indices(total.shape).reshape(2, -1)
        return pa.table(
            {
                "lang": pa.array([first["lang"]] * len(i), pa.string()),
                "one": pa.array(i + first["a"] * tile_rows, pa.int64()),
                "two": pa.array(j + first["b"] * tile_rows, pa.int64()),
                "value": pa.array(total[i, j], pa.int64()),
                "width": pa.array(np.full(len(i), width), pa.int64()),
            }
        )

    return compare


def pair_values(groups: DataFrame, cells: DataFrame) -> DataFrame:
    """Value of each pair of sources of a language: ``lang, one, two, value``, row numbers, one < two.

    ``groups``: ``lang, row, whole, kept, tiles``; ``cells``: ``lang, kept, tiles, row, col, n``.
    """
    tile, strip = F.expr(f"row div {ROWS}"), F.expr(f"col div {COLUMNS}")
    placed = cells.select("lang", "kept", "tiles", strip.alias("strip"), tile.alias("tile"), "row", "col", "n")
    # a strip is visited by every two tiles of which one has a count there; the first by all
    every = groups.select("lang", "kept", "tiles", F.lit(0).cast("bigint").alias("strip"), tile.alias("tile"))
    used = placed.select(*every.columns).unionByName(every).distinct()
    meets = lambda: F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("tiles") - 1))
    units = (
        used.withColumn("other", meets())
        .select("lang", "kept", "strip", F.least("tile", "other").alias("a"), F.greatest("tile", "other").alias("b"))
        .distinct()
    )
    heads = units.withColumn("tile", F.explode(F.array_distinct(F.array("a", "b")))).join(
        groups.select("lang", "row", "whole", tile.alias("tile")), ["lang", "tile"]
    )
    none = lambda value: F.lit(value).cast("bigint")
    columns = ["lang", "kept", "strip", "a", "b", "row"]
    rows = heads.select(*columns, none(-1).alias("col"), none(0).alias("n"), "whole")
    counted = (
        placed.withColumn("other", meets())
        .withColumn("a", F.least("tile", "other"))
        .withColumn("b", F.greatest("tile", "other"))
        .select(*columns, "col", "n", none(1).alias("whole"))
    )
    met = (
        rows.unionByName(counted)
        .groupBy("lang", "strip", "a", "b")
        .applyInArrow(_comparer(ROWS, COLUMNS), "lang string, one bigint, two bigint, value bigint, width bigint")
        .groupBy("lang", "one", "two")
        .agg(F.sum("value").alias("value"), F.sum("width").alias("width"))
    )
    zero = lambda side: share(F.lit(0).cast("bigint"), F.col(f"whole_{side}"))
    for side in ("one", "two"):
        named = groups.select("lang", F.col("row").alias(side), F.col("whole").alias(f"whole_{side}"), *(["kept"] if side == "one" else []))
        met = met.join(named, ["lang", side])
    unseen = (F.col("kept") - F.col("width")) * F.abs(zero("one") - zero("two"))
    return met.select(
        "lang", "one", "two", (F.col("value") + F.when(F.col("kept") > 0, unseen).otherwise(F.lit(0))).alias("value")
    )


def audit(docs: DataFrame, least_docs: int = LEAST_DOCS, top: int = TOP) -> DataFrame:
    """Divergence of the sources of each language: ``lang, source, part, item, value, rank``.

    Part ``pair`` ranks the other sources of the language by the sum of share differences
    over all kept terms, part ``term`` the terms a source uses more than its language does,
    ``top`` at most. Reads ``text, lang, source``; nulls are empty texts, and a null language
    or source is the empty name. A source without a kept term is a group like any other; a
    language without kept terms has pairs of value 0. Equal values are ranked by the item's
    bytes. Repeated rows count each, other columns are not read, an empty table: no row.
    """
    counted = count_terms(docs.select("text", "lang", "source"))
    counts = store(
        counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")), "term-counts"
    )
    cells = counts.where("term IS NOT NULL")
    kept = store(
        cells.groupBy("lang", "term")
        .agg(F.sum("docs").alias("docs"), F.sum("n").alias("lang_n"))
        .where(F.col("docs") >= least_docs)
        .select("lang", "term", "lang_n", F.struct((-F.col("docs")).alias("docs"), F.col("term").alias("t")).alias("by")),
        "kept-terms",
    )
    columns = positions(kept, "by", ["lang"], "col").select("lang", "term", "lang_n", (F.col("col") - 1).alias("col"))
    held = store(cells.select("lang", "source", "term", "n").join(columns, ["lang", "term"]), "kept-cells")
    # one row per language and per group from here on: no more than there are sources
    langs = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("kept"), F.sum("lang_n").alias("lang_whole"))
    sizes = held.groupBy("lang", "source").agg(F.sum("n").alias("size"))
    size = F.coalesce("size", F.lit(0).cast("bigint"))
    groups = store(
        counts.where("term IS NULL")
        .select("lang", "source")
        .join(sizes, ["lang", "source"], "left")
        .join(langs, "lang", "left")
        .select(
            "lang",
            "source",
            F.coalesce("kept", F.lit(0).cast("bigint")).alias("kept"),
            (size + SMOOTH * F.coalesce("kept", F.lit(0).cast("bigint"))).alias("whole"),
            (F.col("lang_whole") + SMOOTH * F.col("kept")).alias("lang_whole"),
            F.struct((-size).alias("size"), F.col("source").alias("s")).alias("by"),
        ),
        "groups",
    )
    tiles = groups.groupBy("lang").agg(F.ceil(F.count(F.lit(1)) / ROWS).alias("tiles"))
    numbered = store(
        positions(groups, "by", ["lang"], "row")
        .join(tiles, "lang")
        .select("lang", "source", "kept", "tiles", F.greatest("whole", F.lit(1)).alias("whole"), "lang_whole", (F.col("row") - 1).alias("row")),
        "numbered-groups",
    )
    placed = store(held.join(numbered, ["lang", "source"]), "placed-cells")
    pairs = store(pair_values(numbered, placed), "pairs")
    for side in ("one", "two"):
        pairs = pairs.join(numbered.select("lang", F.col("row").alias(side), F.col("source").alias(f"source_{side}")), ["lang", side])
    both = pairs.select("lang", F.col("source_one").alias("source"), F.col("source_two").alias("item"), "value").unionByName(
        pairs.select("lang", F.col("source_two").alias("source"), F.col("source_one").alias("item"), "value")
    )
    order = [F.col("value").desc(), F.col("item")]
    ranked = both.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "source").orderBy(*order)))
    above = (
        placed.where("n > 0")
        .select(
            "lang",
            "source",
            F.col("term").alias("item"),
            (share(F.col("n"), F.col("whole")) - share(F.col("lang_n"), F.col("lang_whole"))).alias("value"),
        )
        .where("value > 0")
    )
    # the best of each part of a group first, so that no task sorts a whole group
    part = F.pmod(F.xxhash64("item"), F.lit(64))
    few = above.withColumn("part", part).withColumn(
        "rank", F.row_number().over(Window.partitionBy("lang", "source", "part").orderBy(*order))
    )
    best = (
        few.where(F.col("rank") <= top)
        .drop("part", "rank")
        .withColumn("rank", F.row_number().over(Window.partitionBy("lang", "source").orderBy(*order)))
        .where(F.col("rank") <= top)
    )
    done = lambda rows, name: rows.select("lang", "source", F.lit(name).alias("part"), "item", "value", "rank")
    return done(ranked, "pair").unionByName(done(best, "term"))
