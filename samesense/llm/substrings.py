"""Substring dedup by recompression: long repeats across documents are removed.

A row of words is rewritten in rounds. First runs of one word get a name, then in each
round every symbol is put on one of two sides by its name, and a left symbol followed by a
right one becomes a pair with a name of its own. Names are hashes of what they stand for, so
they are the same everywhere, and equal substrings are rewritten alike but for the symbols
at their ends: only those can depend on words outside. For a window of words the symbols
that cannot are known, so equal windows hold the same interior symbols.

Each window is marked with a long one of its interior symbols. Spark counts in
which documents each symbol is a mark; a window whose symbol marks windows of one document
only is no repeat. The windows that are left are compared by hashes of all their words, first
whole chunks of them and then one by one.
"""

from __future__ import annotations

import gc
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructType

from samesense.llm import bloom
from samesense.llm.batches import slices
from samesense.llm.words import fresh, whole
from samesense.skew import lookup
from samesense.storage import discard, store

WINDOW = 13
ROUNDS = 5
# Rounds whose symbols are too short to be marks.
SHORT_ROUNDS = 1
TABLE_ENTRIES = 400_000
# 32 megabytes, whatever the number of symbols.
FILTER_BITS = 28

_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))


class WordNames(dict):
    """Name of each word: a 64-bit hash."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= TABLE_ENTRIES:
            self.clear()
        name = self[word] = xxhash.xxh64_intdigest(word)
        return name


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _A
    x = (x ^ (x >> np.uint64(29))) * _B
    return x ^ (x >> np.uint64(32))


def name_runs(names: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs of an equal symbol as one symbol each; and for every old place its new place."""
    begins = np.ones(len(names), bool)
    begins[1:] = names[1:] != names[:-1]
    at = np.flatnonzero(begins)
    length = np.diff(at, append=len(names)).astype("uint64")
    first = names[at]
    return np.where(length > 1, _mix(first * _C + length), first), np.cumsum(begins) - 1


def name_pairs(names: np.ndarray, number: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs of a left and a right symbol as one; the new places, and which symbols are left."""
    # names are well mixed already, so the top bit of a product by an odd number is a fair side
    left = names * np.uint64(int(_B) * (2 * number + 1) % 2**64) > np.uint64(2**63 - 1)
    heads = np.flatnonzero(left[:-1] & ~left[1:])
    renamed = names.copy()
    renamed[heads] = _mix(names[heads] * _C + names[heads + 1] * _A)
    stays = np.ones(len(names), bool)
    stays[heads + 1] = False
    return renamed[stays], np.cumsum(stays) - 1, left


def window_marks(words: np.ndarray, width: int = WINDOW, rounds: int = ROUNDS) -> np.ndarray:
    """A symbol for every window of ``width`` words that depends on the window's words alone."""
    n = len(words) - width + 1
    if n <= 0:
        return np.zeros(0, "uint64")
    names, place = name_runs(words)
    begins = np.append(np.flatnonzero(np.append(True, place[1:] != place[:-1])), len(words))
    # a window does not see where the runs at its ends begin and end
    low, high = place[:n] + 1, place[width - 1 :]
    marks, held = words[:n].copy(), np.ones(n, "int64")
    for number in range(rounds):
        names, place, left = name_pairs(names, number)
        begins = begins[np.append(np.flatnonzero(np.append(True, place[1:] != place[:-1])), len(place))]
        # the first symbol may be the right half of a pair unless it is a left one; the last
        # may be the left half unless it is a right one; an empty range stays empty
        low = np.append(place, place[-1] + 1).take(low + ~np.append(left, True).take(low))
        last = np.maximum(high - 1, 0)
        high = place.take(last) + ~left.take(last)
        if number < SHORT_ROUNDS:
            continue
        # of the first two interior symbols the longer one, if no earlier round had a longer
        size = np.append(np.diff(begins), 0)
        second = np.minimum(low + 1, np.maximum(high - 1, low))
        first_size, second_size = size.take(low), size.take(second)
        chosen = np.where(second_size > first_size, second, low)
        longest = np.maximum(first_size, second_size)
        better = np.flatnonzero((low < high) & (longest >= held))
        held[better] = longest[better]
        marks[better] = names.take(chosen[better])
    return marks


def window_hashes(words: np.ndarray, width: int = WINDOW) -> np.ndarray:
    """A 64-bit polynomial hash of the words of every window, by joining halves of powers of two."""
    n = len(words) - width + 1
    if n <= 0:
        return np.zeros(0, "uint64")
    found, covered = None, 0
    power, size = words, 1
    while True:
        factor = np.uint64(pow(int(_A), size, 2**64))
        if width & size:
            # what is covered so far stands before the next ``size`` words
            count = len(words) - covered - size + 1
            found = power if found is None else found[:count] * factor + power[covered : covered + count]
            covered += size
        if covered == width:
            return _mix(found[:n])
        power = power[:-size] * factor + power[size:]
        size *= 2


def split_words(text: bytes) -> list[bytes]:
    """Words of a UTF-8 text: what stands between the six ASCII white-space characters."""
    return text.split()


def _named(texts: list[bytes], names: WordNames) -> tuple[np.ndarray, np.ndarray]:
    """Word names of several texts in one row, and where each text begins and the last ends."""
    words = [split_words(text) for text in texts]
    ends = np.cumsum([0, *map(len, words)])
    flat = np.fromiter(map(names.__getitem__, chain.from_iterable(words)), "uint64", int(ends[-1]))
    return flat, ends


def _windows(ends: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the windows that lie inside one text, and the number of that text."""
    counts = np.maximum(np.diff(ends) - width + 1, 0)
    owner = np.repeat(np.arange(len(counts)), counts)
    inside = np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts)
    return ends[owner] + inside, owner


def symbols(docs: DataFrame) -> DataFrame:
    """``name, low, high``: marks of windows with the smallest and largest document id seen.

    One row per symbol and slice of a task's texts, so a symbol that is everywhere is
    counted before it is shuffled.
    """
    kind = StructType().add("name", LongType()).add("low", LongType()).add("high", LongType())

    def run(batches):
        names = WordNames()
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for start, end in slices(batch.column(1)):
                words, ends = _named(batch.column(1)[start:end].to_pylist(), names)
                at, owner = _windows(ends, WINDOW)
                if not len(at):
                    continue
                marks, seen = window_marks(words)[at], ids[start:end][owner]
                new = np.ones(len(at), bool)
                new[1:] = (marks[1:] != marks[:-1]) | (owner[1:] != owner[:-1])
                marks, seen = marks[new], seen[new]
                order = np.argsort(marks, kind="stable")
                marks, seen = marks[order], seen[order]
                first = np.flatnonzero(np.append(True, marks[1:] != marks[:-1]))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(marks[first].view("int64")),
                        pa.array(np.minimum.reduceat(seen, first)),
                        pa.array(np.maximum.reduceat(seen, first)),
                    ],
                    ["name", "low", "high"],
                )

    return docs.select("doc_id", F.col("text").cast("binary").alias("text")).mapInArrow(run, kind)


def candidate_chunks(docs: DataFrame, allowed) -> DataFrame:
    """``doc_id, print, at, hashes, chunk``: consecutive windows whose marks the bitmap admits.

    A chunk ends where candidates end, and where the mark changes to one of a fixed quarter
    of all symbols; so where documents agree for long, their chunks do too. ``chunk`` is a
    hash of all its windows.
    """
    kind = StructType().add("doc_id", LongType()).add("print", IntegerType()).add("at", IntegerType())
    kind = kind.add("hashes", ArrayType(LongType(), False)).add("chunk", LongType())

    def run(batches):
        names, filter_words = WordNames(), allowed.value
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            prints = batch.column(1).to_numpy(zero_copy_only=False)
            for start, end in slices(batch.column(2)):
                words, ends = _named(batch.column(2)[start:end].to_pylist(), names)
                at, owner = _windows(ends, WINDOW)
                if not len(at):
                    continue
                marks = window_marks(words)[at]
                keep = bloom.in_bitmap(marks, filter_words)
                at, owner, marks = at[keep], owner[keep], marks[keep]
                if not len(at):
                    continue
                hashes = window_hashes(words)[at]
                begins = np.ones(len(at), bool)
                begins[1:] = (at[1:] != at[:-1] + 1) | (owner[1:] != owner[:-1])
                begins[1:] |= (marks[1:] != marks[:-1]) & ((_mix(marks[1:]) & np.uint64(3)) == 0)
                first = np.flatnonzero(begins)
                bounds = np.append(first, len(at))
                # a sum of hashes mixed with their place in the chunk
                place = (np.arange(len(at)) - np.repeat(first, np.diff(bounds))).astype("uint64")
                chunk = _mix(np.add.reduceat(_mix(hashes + place * _B), first))
                head = owner[first]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(ids[start:end][head]),
                        pa.array(prints[start:end][head]),
                        pa.array((at[first] - ends[head]).astype("int32")),
                        pa.ListArray.from_arrays(pa.array(bounds.astype("int32")), pa.array(hashes.view("int64"))),
                        pa.array(chunk.view("int64")),
                    ],
                    ["doc_id", "print", "at", "hashes", "chunk"],
                )

    return docs.select("doc_id", "print", F.col("text").cast("binary").alias("text")).mapInArrow(run, kind)


def settled(df: DataFrame, label: str, *done: DataFrame) -> DataFrame:
    """``store``, then let Spark's cleaner delete the shuffle files behind the written table.

    The cleaner acts on plans that nothing refers to any more, on either side of the bridge.
    ``done`` are stored tables that are not needed from here on.
    """
    stored = store(df, label)
    for table in done:
        discard(table)
    gc.collect()
    stored.sparkSession.sparkContext._jvm.System.gc()
    return stored


def _firsts(rows: DataFrame, key: str) -> DataFrame:
    """Keys that occur in documents of different ids, with the smallest id and the count."""
    return (
        rows.groupBy(key)
        .agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"), F.count(F.lit(1)).alias("n"))
        .where("first < last")
        .select(key, "first", "n")
    )


def repeated_windows(docs: DataFrame) -> DataFrame:
    """``doc_id, print, runs``: windows whose words also begin in a document with a smaller id.

    ``docs`` has ``doc_id`` (not null), ``print`` (a hash of the text) and ``text``. ``runs``
    are structs ``at, n`` of consecutive window starts. Chunks are compared first. One that
    an earlier document has too is repeated as a whole, and has no window that the earlier
    one lacks; only the windows of all other chunks are then compared one by one.
    """
    spark = docs.sparkSession
    shared = settled(
        symbols(docs).groupBy("name").agg(F.min("low").alias("low"), F.max("high").alias("high")).where("low < high").select("name"),
        "shared-symbols",
    )
    allowed = spark.sparkContext.broadcast(bloom.bitmap(shared.select(F.col("name").alias("key")), FILTER_BITS))
    chunks = settled(candidate_chunks(docs, allowed), "chunks", shared)
    earlier = settled(_firsts(chunks, "chunk"), "first-chunks")
    whole_chunk = F.coalesce(F.col("doc_id") > F.col("first"), F.lit(False))
    judged = settled(
        lookup(chunks, earlier, ["chunk"], ["doc_id", "at"], counted="n").select(
            "doc_id",
            "print",
            "at",
            F.size("hashes").alias("n"),
            F.when(~whole_chunk, F.col("hashes")).alias("hashes"),
        ),
        "judged-chunks",
        chunks,
        earlier,
    )
    each = judged.where("hashes IS NOT NULL").select(
        "doc_id", "print", F.posexplode("hashes").alias("i", "hash"), "at"
    ).select("doc_id", "print", "hash", (F.col("at") + F.col("i")).alias("at"))
    earlier = settled(_firsts(each, "hash"), "first-windows")
    n = judged.agg(F.sum(F.size("hashes"))).first()[0] or 0
    single = lookup(each, earlier, ["hash"], ["doc_id", "at"], "inner", known_rows=n, counted="n").where("doc_id > first")
    runs = judged.where("hashes IS NULL").select("doc_id", "print", "at", "n").unionByName(
        single.select("doc_id", "print", "at", F.lit(1).alias("n"))
    )
    return settled(
        runs.groupBy("doc_id", "print").agg(F.collect_list(F.struct("at", "n")).alias("runs")), "runs", judged, earlier
    )


KEPT = StructType().add("n_words", LongType()).add("n_removed", LongType()).add("kept", "string")


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> tuple[DataFrame, str]:
    """``docs`` with a struct ``n_words, n_removed, kept``, and the struct's name.

    A word goes if a window of ``WINDOW`` words covers it that also starts in a document with
    a smaller id; windows are judged on the input. Kept words are joined by one space. A null
    id is neither smaller nor larger than another: such rows lose nothing and take nothing.
    Rows with the same id lose nothing to each other, so repeated rows come out alike. A null,
    empty or blank text has no words and an empty result; an empty table gives an empty table.
    """
    name, key = fresh(docs, "repeats"), fresh(docs, "_print")
    keyed = docs.withColumn(key, F.hash(whole(text)))
    plain = keyed.where(F.col(doc_id).isNotNull()).select(
        F.col(doc_id).cast("bigint").alias("doc_id"), F.col(key).alias("print"), whole(text).alias("text")
    )
    runs, of_id, of_print = fresh(keyed, "_runs"), fresh(keyed, "_of_id"), fresh(keyed, "_of_print")
    gone = repeated_windows(plain).select(
        F.col("doc_id").alias(of_id), F.col("print").alias(of_print), F.col("runs").alias(runs)
    )
    joined = keyed.join(gone, (F.col(doc_id) == F.col(of_id)) & (F.col(key) == F.col(of_print)), "left")
    place = joined.columns.index(runs), joined.columns.index(text)
    kind = StructType([*docs.schema.fields]).add(name, KEPT)
    columns = [joined.columns.index(c) for c in docs.columns]
    labels = [*docs.columns, name]

    def run(batches):
        for batch in batches:
            for low, high in slices(batch.column(place[1])):
                part = batch.slice(low, high - low)
                rows = [_kept((t or "").encode(), s) for t, s in zip(part.column(place[1]).to_pylist(), part.column(place[0]), strict=True)]
                made = pa.StructArray.from_arrays(
                    [pa.array([r[i] for r in rows], t) for i, t in enumerate([pa.int64(), pa.int64(), pa.string()])],
                    ["n_words", "n_removed", "kept"],
                )
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in columns), made], labels)

    return joined.mapInArrow(run, kind), name


def _kept(text: bytes, runs) -> tuple[int, int, str]:
    words = split_words(text)
    if not runs.is_valid:
        return len(words), 0, b" ".join(words).decode()
    at, n = (field.to_numpy(zero_copy_only=False) for field in runs.values.flatten())
    change = np.zeros(len(words) + 1, "int64")
    np.add.at(change, at, 1)
    np.add.at(change, at + n + (WINDOW - 1), -1)
    stays = np.cumsum(change[:-1]) == 0
    kept = [w for w, s in zip(words, stays.tolist(), strict=True) if s]
    return len(words), len(words) - len(kept), b" ".join(kept).decode()
