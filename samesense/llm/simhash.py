"""SimHash near-duplicates through an inverted index of byte positions.

A fingerprint has eight bytes. If two differ in at most four bits, at least four bytes
agree at their positions: that is the guaranteed minimum of matches. One posting list
per single byte would hold 1/256 of all fingerprints, and tallying over such lists is
quadratic; so a list is kept per set of four positions and their bytes, of which there are
2^32 per set. A pair reaches the minimum exactly if it shares such a list. Inside the lists
pairs are tallied, those below the minimum dropped, and the rest verified bit by bit.

Equal fingerprints are folded before the index, so groups of copies cost one entry. Lists
hand on links that span their connected fingerprints, never all pairs.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructType

from samesense.llm import bloom
from samesense.llm.batches import append
from samesense.llm.words import fresh
from samesense.operators.components import components
from samesense.skew import lookup
from samesense.storage import store

SEED = 42
SHINGLE = 4
DISTANCE = 4
BYTES = 8
LEAST_BYTES = BYTES - DISTANCE
# A longer list is cut into tiles, and tiles are compared two by two in different tasks.
TILE = 4096
FILTER_BYTES = 32 << 20
# Fingerprints that one task indexes.
TASK_PRINTS = 20_000


def shingle_hashes(text: str, shingle: int = SHINGLE) -> np.ndarray:
    """XXH64 of each shingle of the lower-cased words; of the whole sequence if it is shorter."""
    # of bytes, both touch ASCII only: letters A to Z, and the six white-space characters
    words = text.encode().lower().split()
    joined = b" ".join(words)
    if not words:
        return np.zeros(0, "uint64")
    if len(words) <= shingle:
        return np.array([xxhash.xxh64_intdigest(joined, SEED)], "uint64")
    ends = np.cumsum(np.fromiter(map(len, words), "int64", len(words)) + 1) - 1
    starts = [0, *(ends[: len(words) - shingle] + 1).tolist()]
    digest = xxhash.xxh64_intdigest
    return np.fromiter(
        (digest(joined[a:b], SEED) for a, b in zip(starts, ends[shingle - 1 :].tolist(), strict=True)),
        "uint64",
        len(starts),
    )


def fingerprint(hashes: np.ndarray) -> int:
    """A bit is 1 if it is set in over half the hashes; no hash gives zero."""
    if not len(hashes):
        return 0
    ones = np.zeros(64, "int64")
    for low in range(0, len(hashes), 1 << 16):
        part = hashes[low : low + (1 << 16)].astype("<u8").view("uint8").reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype="int64")
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def add_fingerprint(docs: DataFrame, text: str = "text") -> tuple[DataFrame, str]:
    """``docs`` with the fingerprint of each text as a signed 64-bit number, and the column's name."""
    name = fresh(docs, "fingerprint")

    def start():
        def work(texts):
            found = np.array([fingerprint(shingle_hashes(t)) for t in texts], "uint64")
            return pa.array(found.view("int64"))

        return work

    return append(docs, text, name, LongType(), start), name


def _masks(least: int = LEAST_BYTES) -> list[int]:
    """For each set of ``least`` byte positions the mask of their bits, as signed numbers."""
    masks = [sum(0xFF << 8 * p for p in chosen) for chosen in combinations(range(BYTES), least)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def index(prints: DataFrame) -> DataFrame:
    """``fp`` rows as postings ``list, bytes, fp``: which positions, and their bytes in place."""
    held = F.array(*[F.col("fp").bitwiseAND(F.lit(mask)) for mask in _masks()])
    return prints.select("fp", F.posexplode(held).alias("list", "bytes"))


def _linked(one: Column, two: Column) -> Column:
    """Tally the bytes two fingerprints share, then verify their bits."""
    differing = one.bitwiseXOR(two)
    tally = sum((F.when(differing.bitwiseAND(F.lit(mask)) == 0, 1).otherwise(0) for mask in _masks(1)), F.lit(0))
    return (tally >= LEAST_BYTES) & (F.bit_count(differing) <= DISTANCE)


def spanning_links(prints: np.ndarray) -> list[tuple[int, int]]:
    """Links that connect what is linked among distinct fingerprints of one posting list.

    Fingerprints reached from one another leave the rest at once, so a dense group costs
    about one comparison each, whatever its number of pairs.
    """
    links = []
    rest = prints.view("uint64")
    while len(rest):
        reached, rest = [rest[0]], rest[1:]
        while reached and len(rest):
            one = reached.pop()
            differing = rest ^ one
            shared = (differing.view("uint8").reshape(-1, BYTES) == 0).sum(axis=1)
            near = (shared >= LEAST_BYTES) & (np.bitwise_count(differing) <= DISTANCE)
            if near.any():
                found = rest[near]
                links.extend((int(one), int(other)) for other in found)
                reached.extend(found)
                rest = rest[~near]
    return links


def _links_of_lists(postings: DataFrame) -> DataFrame:
    """Spanning links of posting lists; rows come sorted, list after list, in bounded batches."""

    def run(batches):
        def flush(parts):
            links = spanning_links(np.unique(np.concatenate(parts)))
            u = np.array([a for a, _ in links], "uint64").view("int64")
            v = np.array([b for _, b in links], "uint64").view("int64")
            return pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], ["u", "v"])

        held, last = [], None
        for batch in batches:
            keys = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(4)]
            prints = batch.column(4).to_numpy(zero_copy_only=False)
            if not len(prints):
                continue
            change = np.zeros(len(prints) - 1, bool)
            for key in keys:
                change |= key[1:] != key[:-1]
            cuts = [0, *(np.flatnonzero(change) + 1).tolist(), len(prints)]
            for low, high in zip(cuts, cuts[1:], strict=False):
                key = tuple(int(k[low]) for k in keys)
                if key != last and held:
                    yield flush(held)
                    held = []
                last = key
                held.append(prints[low:high])
        if held:
            yield flush(held)

    keys = ["list", "bytes", "low", "high"]
    kind = StructType().add("u", LongType()).add("v", LongType())
    dealt = postings.select(*keys, "fp").repartition(*keys).sortWithinPartitions(*keys)
    return dealt.mapInArrow(run, kind)


def links(prints: DataFrame, tile: int = TILE) -> DataFrame:
    """Links ``u, v`` between distinct ``fp`` rows that connect all pairs within the distance."""
    # a fingerprint is few bytes and many postings: dealt out by number, not by bytes
    postings = index(prints.repartition(max(1, -(-prints.count() // TASK_PRINTS))))
    lists = store(
        postings.groupBy("list", "bytes")
        .agg(F.count(F.lit(1)).alias("n"), F.min("fp").alias("u"), F.max("fp").alias("v"))
        .where("n > 1"),
        "posting-lists",
    )
    # a list of two is its smallest and largest entry
    pairs = lists.where("n = 2").where(_linked(F.col("u"), F.col("v"))).select("u", "v")
    longer = lists.where("n > 2").select("list", "bytes", "n")
    n = longer.count()
    if not n:
        return pairs.distinct()
    # only postings that may be in such a list are shuffled; the join decides
    key = F.xxhash64("list", "bytes")
    level = bloom.build(longer.select(key.alias("key")), n, 0.01, 2, FILTER_BYTES, shrink=True)
    rows = postings.where(bloom.admits(key, level)).join(longer, ["list", "bytes"])
    tiles = F.ceil(F.col("n") / tile).cast("int")
    own = F.pmod(F.xxhash64("fp"), tiles).cast("int")
    # each tile meets every tile, itself included
    rows = (
        rows.withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), tiles - 1)))
        .withColumn("low", F.least("own", "other"))
        .withColumn("high", F.greatest("own", "other"))
    )
    return pairs.unionByName(_links_of_lists(rows)).distinct()


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``doc_id, fingerprint, component_id``.

    The component is the smallest id that can be reached over links; a document without
    links has its own. A null or empty text and one of blanks have fingerprint zero, and
    are linked like any other. Repeated rows come back each; a null id stays null, counts
    last for the smallest, and alone gives a null component. An empty table: no row.
    """
    return component_rows(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")))


def component_rows(docs: DataFrame) -> DataFrame:
    """As ``near_duplicates``, over columns ``doc_id, text`` and any further ones, without the text."""
    marked, name = add_fingerprint(docs)
    rows = store(marked.withColumnRenamed(name, "fp").drop("text"), "fingerprints")
    prints = store(rows.groupBy("fp").agg(F.min("doc_id").alias("first")), "prints")
    roots = components(links(prints.select("fp")), "u", "v")
    rooted = prints.join(roots, F.col("fp") == F.col("node"), "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")
    )
    smallest = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    placed = store(rooted.join(smallest, "root").select("fp", "component_id"), "placed")
    return lookup(rows, placed, ["fp"], [c for c in rows.columns if c != "fp"]).select(
        *[c for c in rows.columns if c != "fp"],
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one row of each group of near duplicates: that with the smallest id.

    A null id counts last; among equal ids the smallest text hash decides, and of rows equal
    in both one stays. Texts of groups of one, which is most, are not shuffled.
    """
    one, two = fresh(docs, "_text1"), fresh(docs, "_text2")
    body = F.coalesce(F.col(text), F.lit(""))
    keyed = docs.withColumn(one, F.xxhash64(F.col(doc_id), body)).withColumn(two, F.xxhash64(F.lit(3), body))
    narrow = keyed.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.col(one).alias("k1"), F.col(two).alias("k2"))
    # a group is known by its component id, or where all its ids are null by its fingerprint
    group = F.coalesce(F.col("component_id").cast("string"), F.concat(F.lit("f"), "fingerprint"))
    members = store(component_rows(narrow).withColumn("group", group), "members")
    rank = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "k1", "k2")
    best = (
        members.groupBy("group")
        .agg(F.min(rank).alias("best"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .select("group", F.col("best.k1").alias("b1"), F.col("best.k2").alias("b2"))
    )
    crowded = lookup(members.select("group", "k1", "k2"), best, ["group"], ["k1"], "inner")
    keys = store(crowded.select("k1", "k2", F.expr("k1 = b1 AND k2 = b2").alias("stays")).distinct(), "crowded")
    n = keys.count()
    if not n:
        return docs
    likely, other = bloom.split(keyed, F.xxhash64(one, two), keys.select(F.xxhash64("k1", "k2").alias("key")), n)
    flag = fresh(keyed, "_stays")
    named = keys.select(F.col("k1").alias(one), F.col("k2").alias(two), F.col("stays").alias(flag))
    chosen = likely.join(named, [one, two], "left")
    stays = chosen.where(F.col(flag)).dropDuplicates([one, two])
    return (
        stays.select(*docs.columns)
        .unionByName(chosen.where(F.col(flag).isNull()).select(*docs.columns))
        .unionByName(other.select(*docs.columns))
    )
