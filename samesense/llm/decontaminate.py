"""Benchmark decontamination by spaced-seed hashing.

A seed is a fixed mask over consecutive words; words at its gaps are ignored. Test and
training texts are hashed under every mask; equal hashes are hits. Words count as equal
whatever their case and punctuation. Around each hit the texts are laid side by side and
their equal words counted, so a passage is found although words in it were replaced. With
the masks below, any ``WINDOW`` words (or a whole item of 8 words or more, if it is shorter)
of which at least four in five agree hold a hit. An item of fewer words is hashed whole: of five to
seven words one may differ, so there is a mask per place of the gap; of one to four none may.

Training texts are not shuffled. A filter of bounded size over the test hashes goes to the
tasks; what it admits is cut out of the text as a region with room for verification, and
regions are joined with the test hashes and words.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructType

from samesense.llm import bloom
from samesense.llm.batches import append
from samesense.llm.words import fresh
from samesense.skew import lookup
from samesense.storage import store

# Found by search over all masks of five words and a span of up to nine,
# so that every pattern of replaced words within the tolerance leaves one of them whole.
MASKS = ("11111", "111011", "11001011")
WINDOW = 16
AGREE = 0.8
# Shorter items are hashed whole.
SHORT = 8
# Two megabytes, whatever the number of test texts.
FILTER_BITS = 24
TABLE_ENTRIES = 400_000
PUNCTUATION = re.compile(r"[\W_]+")

SEEDS = ArrayType(StructType().add("seed", LongType(), False).add("at", IntegerType(), False), False)
REGION = (
    StructType()
    .add("start", IntegerType(), False)
    .add("words", ArrayType(LongType(), False), False)
    .add("seeds", SEEDS, False)
)


def tolerated(n: int, agree: float = AGREE) -> int:
    """Words that may differ in a window of ``n``."""
    return int((1 - agree) * n + 1e-9)


class WordNames(dict):
    """A 64-bit hash of each word, without case and punctuation."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= TABLE_ENTRIES:
            self.clear()
        name = self[word] = xxhash.xxh64_intdigest(plain_word(word.decode()))
        return name


def plain_word(word: str) -> str:
    lowered = word.lower()
    return lowered if lowered.isalnum() else PUNCTUATION.sub("", lowered)


def word_hashes(text: str, names: WordNames) -> np.ndarray:
    # of bytes, ``split`` takes the six ASCII white-space characters
    words = text.encode().split()
    return np.fromiter(map(names.__getitem__, words), "uint64", len(words))


def short_masks(n: int) -> dict[int, str]:
    """Masks over a whole item of ``n`` words, by number: one per word that may differ, or the full one."""
    if tolerated(n):
        return {SHORT * n + gap: "1" * gap + "0" + "1" * (n - gap - 1) for gap in range(n)}
    return {SHORT * n: "1" * n}


def seed_hashes(words: np.ndarray, lengths: tuple[int, ...] = ()) -> tuple[np.ndarray, np.ndarray]:
    """Hash and place of every seed of a row of word hashes, under all masks.

    ``lengths`` are the short items' numbers of words, whose own masks are used too.
    """
    hashes, places = [], []
    masks = dict(enumerate(MASKS))
    for length in lengths:
        masks |= short_masks(length)
    for number, mask in masks.items():
        n = len(words) - len(mask) + 1
        if n <= 0:
            continue
        mixed = np.full(n, 0x9E3779B97F4A7C15 * (number + 1) % 2**64, "uint64")
        for offset in (i for i, bit in enumerate(mask) if bit == "1"):
            mixed = (mixed ^ words[offset : offset + n]) * np.uint64(0x9FB21C651E98DF25)
            mixed ^= mixed >> np.uint64(29)
        hashes.append(mixed)
        places.append(np.arange(n, dtype="int32"))
    if not hashes:
        return np.zeros(0, "uint64"), np.zeros(0, "int32")
    return np.concatenate(hashes), np.concatenate(places)


def _lists(rows: list[np.ndarray], kind) -> pa.Array:
    ends = np.cumsum([0, *map(len, rows)])
    return pa.ListArray.from_arrays(pa.array(ends, "int32"), pa.array(np.concatenate([*rows, np.zeros(0, kind)]).astype(kind)))


def item_seeds(items: DataFrame) -> DataFrame:
    """``item_id, words, seeds`` of each test text, words and seeds as signed hashes."""
    kind = StructType().add("words", ArrayType(LongType(), False)).add("seeds", SEEDS)

    def start():
        names = WordNames()

        def work(texts):
            words = [word_hashes(t, names) for t in texts]
            seeds = [seed_hashes(w, (len(w),) if 0 < len(w) < SHORT else ()) for w in words]
            return pa.StructArray.from_arrays([_lists([w.view("int64") for w in words], "int64"), _seed_lists(seeds)], ["words", "seeds"])

        return work

    made = append(items, "text", "made", kind, start)
    return made.select("item_id", "made.words", "made.seeds")


def _seed_lists(seeds: list[tuple[np.ndarray, np.ndarray]]) -> pa.Array:
    ends = np.cumsum([0, *(len(h) for h, _ in seeds)])
    values = pa.StructArray.from_arrays(
        [
            pa.array(np.concatenate([*(h for h, _ in seeds), np.zeros(0, "uint64")]).view("int64")),
            pa.array(np.concatenate([*(p for _, p in seeds), np.zeros(0, "int32")]).astype("int32")),
        ],
        ["seed", "at"],
    )
    return pa.ListArray.from_arrays(pa.array(ends, "int32"), values)


def regions(words: np.ndarray, admitted: np.ndarray, reach: int) -> list[tuple[int, int]]:
    """Word ranges with ``reach`` words of room around admitted places; overlapping ones joined."""
    if not len(admitted):
        return []
    places = np.unique(admitted)
    cuts = np.flatnonzero(np.diff(places) > 2 * reach) + 1
    return [
        (max(0, int(part[0]) - reach), min(len(words), int(part[-1]) + reach))
        for part in np.split(places, cuts)
    ]


def training_regions(docs: DataFrame, text: str, filter_words, reach: int, lengths: tuple[int, ...]) -> tuple[DataFrame, str]:
    """``docs`` without the text, one row per region that the filter admits.

    ``lengths`` are the numbers of words of the short items there are.
    """
    name = fresh(docs, "regions")

    def start():
        allowed, names = filter_words.value, WordNames()

        def found(text):
            words = word_hashes(text, names)
            hashes, places = seed_hashes(words, lengths)
            keep = bloom.in_bitmap(hashes, allowed)
            hashes, places = hashes[keep], places[keep]
            out = []
            for low, high in regions(words, places, reach):
                inside = (places >= low) & (places < high)
                out.append((low, words[low:high].view("int64"), (hashes[inside], places[inside] - low)))
            return out

        def work(texts):
            rows = [found(t) for t in texts]
            flat = [r for row in rows for r in row]
            values = pa.StructArray.from_arrays(
                [
                    pa.array([r[0] for r in flat], "int32"),
                    _lists([r[1] for r in flat], "int64"),
                    _seed_lists([r[2] for r in flat]),
                ],
                ["start", "words", "seeds"],
            )
            return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, rows)]), "int32"), values)

        return work

    made = append(docs, text, name, ArrayType(REGION, False), start).drop(text)
    return made.withColumn(name, F.explode(name)), name


def best_overlap(region: np.ndarray, item: np.ndarray, shift: int, window: int = WINDOW, agree: float = AGREE):
    """Of a region laid over an item at ``shift``: the words covered by windows that agree.

    Returns start and end in the region and the number of equal words there, or None. A
    window has ``window`` words of the item, or all of it if it is shorter.
    """
    size = min(window, len(item))
    low, high = max(0, shift), min(len(region), shift + len(item))
    if size == 0 or high - low < size:
        return None
    equal = (region[low:high] == item[low - shift : high - shift]).astype("int64")
    total = np.concatenate([[0], np.cumsum(equal)])
    good = np.flatnonzero(total[size:] - total[:-size] >= size - tolerated(size, agree))
    if not len(good):
        return None
    first, last = int(good[0]), int(good[-1]) + size
    # replaced words at the very ends are not part of the passage
    inside = np.flatnonzero(equal[first:last])
    first, last = first + int(inside[0]), first + int(inside[-1]) + 1
    return low + first, low + last, int(total[last] - total[first])


def _verified(pairs: DataFrame, keys: list[str]) -> DataFrame:
    kind = StructType([pairs.schema[k] for k in keys])
    kind = kind.add("start", LongType()).add("end", LongType()).add("equal", LongType())

    def run(batches):
        for batch in batches:
            shifts = batch.column("shift").to_pylist()
            starts = batch.column("start").to_pylist()
            left, right = batch.column("words"), batch.column("item_words")
            rows, spans = [], []
            for i, shift in enumerate(shifts):
                found = best_overlap(
                    left[i].values.to_numpy(zero_copy_only=False), right[i].values.to_numpy(zero_copy_only=False), shift
                )
                if found:
                    rows.append(i)
                    spans.append((starts[i] + found[0], starts[i] + found[1], found[2]))
            kept = [pc.take(batch.column(k), pa.array(rows, "int64")) for k in keys]
            made = [pa.array([s[j] for s in spans], "int64") for j in range(3)]
            yield pa.RecordBatch.from_arrays([*kept, *made], [*keys, "start", "end", "equal"])

    return pairs.select(*keys, "start", "words", "item_words", "shift").mapInArrow(run, kind)


def contaminated(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """One row per document and test item that overlap: ``doc_id, item_id, start, end, equal``.

    ``start`` and ``end`` count words of the document, ``equal`` the equal words between;
    of several places in a document the first of those with most equal words. ``WINDOW``
    words in a row, or a whole shorter item, must agree in four words of five. Null and empty
    texts overlap with nothing; an item of fewer than five words is found only as it is. An
    empty table on either side gives no row. Rows repeated, or sharing an id, give one row per id and
    item; null ids stay null. Whole texts are searched.
    """
    docs = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    items = items.select(F.col(item_id).alias("item_id"), F.col(item_text).alias("text"))
    spark = docs.sparkSession
    test = store(item_seeds(items), "test-items")
    seeds = store(
        test.select(F.xxhash64("words").alias("item"), "item_id", F.explode("seeds").alias("s"))
        .select(F.col("s.seed").alias("seed"), F.col("s.at").alias("item_at"), "item_id", "item")
        .distinct(),
        "test-seeds",
    )
    allowed = spark.sparkContext.broadcast(bloom.bitmap(seeds.select(F.col("seed").alias("key")), FILTER_BITS))
    longest = max(len(mask) for mask in MASKS)
    # at most SHORT - 1 numbers; without short items their masks cost nothing
    short = test.select(F.size("words").alias("n")).where(F.col("n").between(1, SHORT - 1)).distinct().collect()
    cut, name = training_regions(docs, "text", allowed, WINDOW + longest, tuple(sorted(row["n"] for row in short)))
    found = store(
        cut.select("doc_id", F.xxhash64("doc_id", f"{name}.words", f"{name}.start").alias("region"), f"{name}.*"), "regions"
    )
    # a seed or an item may own a large share of the hits: both joins split hot keys
    placed = found.select("doc_id", "region", F.explode("seeds").alias("s")).select(
        "doc_id", "region", F.col("s.seed").alias("seed"), F.col("s.at").alias("at")
    )
    hits = store(
        lookup(placed, seeds, ["seed"], ["region", "at"], "inner")
        .select("doc_id", "region", "item_id", "item", (F.col("at") - F.col("item_at")).alias("shift"))
        .distinct(),
        "hits",
    )
    words = test.select(F.xxhash64("words").alias("item"), F.col("words").alias("item_words")).dropDuplicates(["item"])
    pairs = lookup(hits, words, ["item"], ["region", "shift"], "inner").join(
        found.select("region", "start", "words").dropDuplicates(["region"]), "region"
    )
    checked = _verified(pairs, ["doc_id", "item_id"])
    return (
        checked.groupBy("doc_id", "item_id")
        .agg(F.max(F.struct("equal", (-F.col("start")).alias("first"), "end")).alias("best"))
        .select("doc_id", "item_id", (-F.col("best.first")).alias("start"), F.col("best.end").alias("end"), F.col("best.equal").alias("equal"))
    )


def keep_clean(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """``docs`` without the rows whose text overlaps with a test item.

    Rows go by their text's hash, so of rows that share an id only those go that overlap.
    """
    one, two = fresh(docs, "_text1"), fresh(docs, "_text2")
    body = F.coalesce(F.col(text), F.lit(""))
    keyed = docs.withColumn(one, F.xxhash64(body)).withColumn(two, F.xxhash64(F.lit(3), body))
    marked = keyed.select(F.struct(one, two).alias("id"), F.col(text).alias("text"))
    found = contaminated(marked, items, "id", "text", item_id, item_text)
    gone = store(found.select(F.col(f"doc_id.{one}").alias(one), F.col(f"doc_id.{two}").alias(two)).distinct(), "contaminated")
    return bloom.without(keyed, [one, two], gone, gone.count()).select(*docs.columns)
