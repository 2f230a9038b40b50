"""Quality classifier: attention-based multiple-instance learning over passages.

A document is a bag of passages; only the bag has a label. Every passage of the whole text
is encoded, a gated attention layer weighs the passages, and the weighted representation is
scored. Weights of the encoder, the gate and the score are learned together from document
labels. Fitting takes a bounded sample of labelled rows; scoring reads every row once.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, FloatType, IntegerType, StructType

from samesense.llm.batches import append
from samesense.llm.words import WORD, fresh

# The documented bound of the sample that the model is fitted on.
SAMPLE_ROWS = 8000
PASSAGE_WORDS = 128
BUCKETS = 64
HIDDEN = 24
GATE = 12
EPOCHS = 30
BATCH = 128
RATE = 4e-3
DECAY = 1e-4
THRESHOLD = 0.3
TABLE_ENTRIES = 400_000

WORDS = re.compile(WORD)
SHAPES = (str.isupper, str.isalpha, str.isdigit, lambda w: w[-1] in ".,;:!?", lambda w: not w[0].isalnum(), lambda w: not w[-1].isalnum() and w[-1] not in ".,;:")
SIZE = BUCKETS + len(SHAPES) + 5


class WordTable(dict):
    """Hash, bucket, shapes and length of each word, packed in one number."""

    def __missing__(self, word: str) -> int:
        if len(self) >= TABLE_ENTRIES:
            self.clear()
        digest = zlib.crc32(word.encode())
        flags = sum(1 << i for i, shape in enumerate(SHAPES) if shape(word))
        code = digest | flags << 32 | min(len(word), 63) << 48
        self[word] = code
        return code


def encode(text: str, table: WordTable) -> np.ndarray:
    """One row of features per passage; an empty text is one passage of zeros."""
    words = WORDS.findall(text)
    n = len(words)
    if not n:
        return np.zeros((1, SIZE), "float32")
    codes = np.fromiter((table[w] for w in words), "int64", n)
    digest = codes & 0xFFFFFFFF
    passage = np.arange(n) // PASSAGE_WORDS
    count = int(passage[-1]) + 1
    size = np.bincount(passage, minlength=count).astype("float64")
    share = lambda values: np.bincount(passage, values, minlength=count) / size
    buckets = np.bincount(passage * BUCKETS + digest % BUCKETS, minlength=count * BUCKETS).reshape(count, BUCKETS)
    again = np.zeros(n)
    again[1:] = digest[1:] == digest[:-1]
    # words at which four words begin that stood earlier in the document
    seen = np.zeros(n)
    if n > 4:
        mixed = digest.astype("uint64")
        grams = mixed[:-3].copy()
        for shift in range(1, 4):
            grams = grams * np.uint64(0x9E3779B97F4A7C15) + mixed[shift : n - 3 + shift]
        first = np.unique(grams, return_index=True)[1]
        seen[: n - 3] = 1
        seen[first] = 0
    distinct = np.unique(passage << 32 | digest) >> 32
    columns = [share((codes >> 32 + i & 1).astype("float64")) for i in range(len(SHAPES))]
    columns += [
        share((codes >> 48).astype("float64")) / 10,
        share(again),
        share(seen),
        np.bincount(distinct, minlength=count) / size,
        np.log1p(size) / 5,
    ]
    return np.concatenate([np.sqrt(buckets / size[:, None]), np.stack(columns, 1)], 1).astype("float32")


@dataclass
class Model:
    """Learned weights, or with none a constant score."""

    constant: float
    weights: dict[str, np.ndarray] | None = None

    def score(self, bags: list[np.ndarray]) -> np.ndarray:
        if self.weights is None:
            return np.full(len(bags), self.constant)
        starts = np.cumsum([0, *map(len, bags)])[:-1]
        return _forward(self.weights, np.concatenate(bags), starts)["p"].astype("float64")


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _forward(w, x, starts):
    """Encode passages, weigh them by gated attention, and score the weighted sums."""
    bag = np.repeat(np.arange(len(starts)), np.diff([*starts, len(x)]))
    x = (x - w["mean"]) / w["scale"]
    h = np.maximum(x @ w["encode"] + w["encode0"], 0)
    t, s = np.tanh(h @ w["tanh"]), _sigmoid(h @ w["gate"])
    e = (t * s) @ w["attend"]
    e = np.exp(e - np.maximum.reduceat(e, starts)[bag])
    a = e / np.add.reduceat(e, starts)[bag]
    z = np.add.reduceat(a[:, None] * h, starts)
    return {"bag": bag, "x": x, "h": h, "t": t, "s": s, "a": a, "z": z, "p": _sigmoid(z @ w["score"] + w["score0"])}


def _gradients(w, x, starts, y):
    f = _forward(w, x, starts)
    bag, h, t, s, a = f["bag"], f["h"], f["t"], f["s"], f["a"]
    d = (f["p"] - y) / len(y)
    dz = d[:, None] * w["score"]
    da = (h * dz[bag]).sum(1)
    de = a * (da - np.add.reduceat(a * da, starts)[bag])
    dg = de[:, None] * w["attend"]
    dt, ds = dg * s * (1 - t * t), dg * t * s * (1 - s)
    dh = (a[:, None] * dz[bag] + dt @ w["tanh"].T + ds @ w["gate"].T) * (h > 0)
    return {
        "score": f["z"].T @ d,
        "score0": d.sum(),
        "attend": (t * s).T @ de,
        "tanh": h.T @ dt,
        "gate": h.T @ ds,
        "encode": f["x"].T @ dh,
        "encode0": dh.sum(0),
    }


def learn(bags: list[np.ndarray], labels: np.ndarray, seed: int = 7) -> Model:
    """Fit by Adam over shuffled batches of documents; the same input gives the same model."""
    n, ones = len(bags), int(labels.sum())
    constant = (ones + 1) / (n + 2)
    if ones == 0 or ones == n:
        return Model(constant)
    rng = np.random.default_rng(seed)
    everything = np.concatenate(bags)
    normal = lambda *shape: (rng.standard_normal(shape) / np.sqrt(shape[0])).astype("float32")
    w = {
        "mean": everything.mean(0),
        "scale": everything.std(0) + 1e-3,
        "encode": normal(SIZE, HIDDEN),
        "encode0": np.zeros(HIDDEN, "float32"),
        "tanh": normal(HIDDEN, GATE),
        "gate": normal(HIDDEN, GATE),
        "attend": normal(GATE),
        "score": normal(HIDDEN),
        "score0": np.float32(np.log(ones / (n - ones))),
    }
    learned = [k for k in w if k not in ("mean", "scale")]
    first, second = {k: 0.0 for k in learned}, {k: 0.0 for k in learned}
    step = 0
    for _ in range(EPOCHS):
        order = rng.permutation(n)
        for low in range(0, n, BATCH):
            chosen = order[low : low + BATCH]
            x = np.concatenate([bags[i] for i in chosen])
            starts = np.cumsum([0, *(len(bags[i]) for i in chosen)])[:-1]
            step += 1
            for k, g in _gradients(w, x, starts, labels[chosen]).items():
                g = g + DECAY * w[k]
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                w[k] = w[k] - RATE * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    return Model(constant, w)


def held_out(doc_id: str):
    """True for the fifth of ids that no label is learned from; false for a null id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, rows: int = SAMPLE_ROWS) -> DataFrame:
    """At most ``rows`` documents ``doc_id, text, label``, chosen by a hash of the id.

    Only ids outside the held-out fifth; an id with both labels is left out, and of texts
    that share an id one is taken.
    """
    chosen = (
        labels.where(~held_out("doc_id") & F.col(label).isin(0, 1) & F.col("doc_id").isNotNull())
        .groupBy("doc_id")
        .agg(F.min(label).alias("label"), F.max(label).alias("_other"))
        .where("label = _other")
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(rows)
        .select("doc_id", "label")
    )
    # at most ``rows`` narrow rows: safe to send everywhere, so that texts are not shuffled
    return (
        docs.select("doc_id", "text")
        .join(F.broadcast(chosen), "doc_id")
        .groupBy("doc_id", "label")
        .agg(F.min_by(F.coalesce("text", F.lit("")), F.xxhash64("text")).alias("text"))
    )


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", rows: int = SAMPLE_ROWS) -> Model:
    """Passages are encoded in tasks; the driver gets the features of the bounded sample."""
    kind = StructType().add("n", IntegerType()).add("values", ArrayType(FloatType(), False))

    def start():
        table = WordTable()

        def work(texts):
            bags = [encode(t, table) for t in texts]
            ends = np.cumsum([0, *(bag.size for bag in bags)])
            values = pa.ListArray.from_arrays(pa.array(ends, "int32"), pa.array(np.concatenate([b.ravel() for b in bags])))
            return pa.StructArray.from_arrays([pa.array([len(b) for b in bags], "int32"), values], ["n", "values"])

        return work

    sample = append(labelled_sample(docs, labels, label, rows), "text", "bag", kind, start)
    found = sample.select("doc_id", "label", "bag.n", "bag.values").orderBy("doc_id").toArrow()
    bags = [
        np.asarray(v.values.to_numpy(zero_copy_only=False), "float32").reshape(n, SIZE)
        for chunk in found.to_batches()
        for n, v in zip(chunk["n"].to_pylist(), chunk["values"], strict=True)
    ]
    return learn(bags, np.array(found["label"].to_pylist(), "float32"))


def score(docs: DataFrame, model: Model, text: str = "text") -> tuple[DataFrame, str]:
    """``docs`` with a score from 0 to 1 of every whole text, and that column's name.

    Only the text is looked at. A null or empty text is scored as a bag of one empty passage;
    repeated rows score alike; a model fitted without both labels gives a constant.
    """
    name = fresh(docs, "score")

    def start():
        table = WordTable()

        def work(texts):
            return pa.array(model.score([encode(t, table) for t in texts]), pa.float64()) if texts else pa.array([], pa.float64())

        return work

    return append(docs, text, name, DoubleType(), start), name
