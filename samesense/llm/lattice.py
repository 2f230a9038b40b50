"""Language-model scores: the marginal probability of a text over all its subword segmentations.

The pieces are those of an existing vocabulary file, each as its bytes, and the 256 single bytes.
A piece's weight is what training documents say about it: how often it occurs when their
words are segmented by that file's own tokenizer, smoothed by the file's order of pieces. A
text is a row of words and an end; each word, with a marker before it, may be spelled by
any row of pieces. Its probability is the sum over all spellings, by a forward recursion over
byte positions in log space. As no piece crosses the start of a marked word, the lattice
of a text is the chain of those of its words, and its score their sum: each distinct
word of the corpus is scored once.

Words meet their counts and scores through blocks (``exchange``): a task ships the distinct words
of a few megabytes of text, never a word per occurrence.
"""

from __future__ import annotations

import math
from array import array
from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, BooleanType, DoubleType, LongType, StringType, StructType

from samesense.llm import exchange
from samesense.llm.words import fresh, parts
from samesense.storage import store

MARK = "▁"
# Added to each word's count in the base score.
BASE_SMOOTH = 0.1
# Text of the documents in a part of a block, and written bytes that are read at a time.
PART_BYTES = 1 << 20
GROUP_BYTES = 1 << 20
# Weight of the vocabulary's own order, in occurrences per piece.
PRIOR = 0.1

SCORES = (
    StructType()
    .add("n_tokens", LongType())
    .add("n_known", LongType())
    .add("train_tokens", LongType())
    .add("base_score", DoubleType())
    .add("score", DoubleType())
)


def training(doc_id: str = "doc_id", folds: int = 10) -> Column:
    """True for the ids that are learned from: all but the first of ``folds``, and null ids."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % folds != 0, F.lit(True))


def word_counts(data: bytes) -> Counter:
    """Words of a text, ASCII letters lower-cased, a bounded part at a time."""
    found: Counter = Counter()
    for part in parts(data):
        found.update(part.lower().split())
    return found


def packed(values: np.ndarray) -> bytes:
    """Whole numbers from 0 on: how many bytes each needs, their lowest bytes, the next ones, and so on.

    Apart, the higher bytes compress well.
    """
    if not len(values):
        return b""
    width = max(1, (int(values.max()).bit_length() + 7) // 8)
    return bytes([width]) + values.astype("<i8").view("uint8").reshape(-1, 8).T[:width].tobytes()


def unpacked(data: bytes) -> np.ndarray:
    if not data:
        return np.zeros(0, "int64")
    found = np.zeros(((len(data) - 1) // data[0], 8), "uint8")
    found[:, : data[0]] = np.frombuffer(data, "uint8", offset=1).reshape(data[0], -1).T
    return found.view("<i8").ravel()


class Lattice:
    """Pieces as bytes with log weights, and the forward recursion over them."""

    def __init__(self, weights: list[tuple[bytes, float]]):
        self.weight: dict[bytes, float] = {}
        for piece, weight in weights:
            known = self.weight.get(piece)
            # a character and its byte piece spell the same: their weights add up
            self.weight[piece] = weight if known is None else float(np.logaddexp(known, weight))
        self.starts = {piece[:n] for piece in self.weight for n in range(1, len(piece) + 1)}

    def log_probability(self, data: bytes) -> float:
        """Natural log of the sum over all segmentations of ``data`` into pieces."""
        n = len(data)
        arriving: list[list[float] | None] = [None] * (n + 1)
        here = 0.0
        weight, starts = self.weight, self.starts
        for at in range(n + 1):
            terms = arriving[at]
            if terms is not None:
                arriving[at] = None
                most = max(terms)
                here = terms[0] if len(terms) == 1 else most + math.log(sum([math.exp(t - most) for t in terms]))
            elif at:
                continue
            end = at + 1
            while end <= n and (piece := data[at:end]) in starts:
                found = weight.get(piece)
                if found is not None:
                    if arriving[end] is None:
                        arriving[end] = [here + found]
                    else:
                        arriving[end].append(here + found)
                end += 1
        return here


def vocabulary(model: str) -> list[tuple[int, bytes, float]]:
    """Number, bytes and order weight of the pieces that spell text; byte pieces come last in order."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=model)
    size = sp.get_piece_size()
    listed = []
    for i in range(size):
        if sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i):
            continue
        piece = sp.id_to_piece(i)
        if sp.is_byte(i):
            listed.append((i, bytes([int(piece[1:-1], 16)]), 1 / (1 + size)))
        else:
            # the file's score is minus the place in its order
            listed.append((i, piece.encode(), 1 / (1 + abs(sp.get_score(i)))))
    return listed


def piece_counts(words: DataFrame, model: str) -> DataFrame:
    """``piece, n``: occurrences of each piece in rows ``word, c``, each word segmented once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=model)
        total = np.zeros(sp.get_piece_size(), "int64")
        for batch in batches:
            times = batch.column(1).to_numpy()
            for word, n in zip(batch.column(0).to_pylist(), times, strict=True):
                np.add.at(total, sp.encode(word), n)
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64()), pa.array(total[found])], ["piece", "n"])

    return words.select("word", "c").mapInArrow(run, "piece bigint, n bigint").groupBy("piece").agg(F.sum("n").alias("n"))


def learned_weights(words: DataFrame, ends: int, model: str) -> tuple[list[tuple[bytes, float]], float]:
    """Log weights of all pieces and of the end, from words with training counts.

    What comes to the driver is a number per piece of the vocabulary.
    """
    counts = {row["piece"]: row["n"] for row in piece_counts(words.where("c > 0"), model).collect()}
    pieces = vocabulary(model)
    order = sum(prior for *_, prior in pieces) + 1.0
    mass = PRIOR * (len(pieces) + 1)
    whole = sum(counts.values()) + ends + mass
    log = lambda n, prior: math.log((n + mass * prior / order) / whole)
    return [(piece, log(counts.get(i, 0), prior)) for i, piece, prior in pieces], log(ends, 1.0)


def scored_words(words: DataFrame, weights: list[tuple[bytes, float]]) -> DataFrame:
    """``word, c`` rows with ``lp``: the word's log probability, from its marker on."""
    shared = words.sparkSession.sparkContext.broadcast(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = None
        for batch in batches:
            lattice = lattice or Lattice(shared.value)
            found = [lattice.log_probability((MARK + word).encode()) for word in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.float64())], ["word", "c", "lp"])

    return words.select("word", "c").mapInArrow(run, "word string, c bigint, lp double")


def score(
    docs: DataFrame, learn: Column, model: str, text: str = "text"
) -> tuple[DataFrame, str]:
    """``docs`` without the text, with a struct of counts and scores, and the struct's name.

    Rows for which ``learn`` is true are the training rows. ``base_score`` is the smoothed
    unigram score of words and end, ``score`` the lattice's, both in log10. A null or empty
    text is an end alone. Without a training row every count is zero and the vocabulary's order
    decides alone. Repeated rows are learned from and scored each; an empty table gives an
    empty table; a name clash is avoided. Any length of text or word is taken whole.
    """
    name, flag = fresh(docs, "scores"), fresh(docs, "_learn")
    row_kind = StructType([f for f in docs.schema.fields if f.name != text])
    per_doc = StructType().add("n_words", LongType()).add("word", BinaryType()).add("times", BinaryType())
    per_key = StructType().add("word", StringType()).add("seen", LongType())
    flagged = docs.withColumn(flag, learn)

    def start():
        def work(batch, texts):
            number: dict[bytes, int] = {}
            seen = array("q")
            own, times, lengths = [], [], []
            learned = batch.column(flag).to_pylist()
            for data, counted in zip(texts, learned, strict=True):
                found = word_counts(data)
                places = [number.setdefault(word, len(number)) for word in found]
                seen.extend(repeat(0, len(number) - len(seen)))
                if counted:
                    for place, n in zip(places, found.values(), strict=True):
                        seen[place] += n
                counts = np.fromiter(found.values(), "int64", len(found))
                own.append(packed(np.array(places, "int64")))
                times.append(packed(counts))
                lengths.append(int(counts.sum()))
            listed = lambda values: pa.array(values, pa.binary())
            return (
                {"n_words": pa.array(lengths, pa.int64()), "word": listed(own), "times": listed(times)},
                {"word": pa.array(list(number), pa.binary()).cast(pa.string()), "seen": pa.array(np.frombuffer(seen, "int64"))},
                {"ends": pa.array([sum(learned)], pa.int64())},
            )

        return work

    blocks = exchange.write_blocks(flagged, text, start, per_doc, per_key, StructType().add("ends", LongType()), "word-blocks", group_bytes=GROUP_BYTES, part_bytes=PART_BYTES)
    words = store(exchange.keys_of(blocks).groupBy("word").agg(F.sum("seen").alias("c")), "words")
    ends = blocks.agg(F.coalesce(F.sum("ends"), F.lit(0))).first()[0]
    total, distinct = words.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count_if(F.col("c") > 0)).first()
    total, distinct = total + ends, distinct + (ends > 0)
    weights, end_weight = learned_weights(words, ends, model)
    table = store(scored_words(words, weights), "scored-words")
    answers = exchange.looked_up(blocks, table, "word", ["c", "lp"])
    below = total + BASE_SMOOTH * (distinct + 1)
    base_of = lambda n: np.log10((n + BASE_SMOOTH) / below)

    def work(docs, found):
        rows = len(docs)
        c, lp = found.get("c", np.zeros(0, "int64")), found.get("lp", np.zeros(0))
        lists = [unpacked(data) for data in docs.field("word").to_pylist()]
        at = np.repeat(np.arange(rows), [len(x) for x in lists])
        word, times = np.concatenate(lists), np.concatenate([unpacked(data) for data in docs.field("times").to_pylist()])
        add = lambda values: np.bincount(at, values * times, rows) if len(at) else np.zeros(rows)
        words = docs.field("n_words").to_numpy()
        known = add((c[word] > 0).astype("float64")).astype("int64")
        return {
            "n_tokens": pa.array(words + 1),
            "n_known": pa.array(known + int(ends > 0)),
            "train_tokens": pa.array(np.full(rows, total, "int64")),
            "base_score": pa.array(add(base_of(c[word])) + base_of(np.int64(ends))),
            "score": pa.array((add(lp[word]) + end_weight) / math.log(10)),
        }

    flags = StructType([*row_kind.fields]).add(flag, BooleanType())
    return exchange.finish_parts(blocks, answers, flags, name, SCORES, work).drop(flag), name
