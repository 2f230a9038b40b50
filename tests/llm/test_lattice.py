"""Language-model scores against plain counts and a sum over all segmentations."""

import math
import random
import re
import zlib
from collections import Counter
from decimal import Decimal
from functools import cache

import pytest
import sentencepiece

from edge import DOCS, edge_docs, empty_docs
from samesense.llm import lattice
from samesense.llm.queries import tokenizer_model

MODEL = tokenizer_model()
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


def learned(doc_id):
    return doc_id is None or zlib.crc32(str(doc_id).encode()) % 10 != 0


def segmentations(data, pieces):
    if not data:
        return 1.0
    return sum(p * segmentations(data[n:], pieces) for n in range(1, len(data) + 1) for p in [pieces.get(data[:n])] if p)


def plain_scores(rows):
    count, ends = Counter(), 0
    for i, text in rows:
        if learned(i):
            count.update(WORD.findall(lower(text)))
            ends += 1
    total, distinct = sum(count.values()) + ends, len(count) + (ends > 0)
    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    seen = Counter()
    for word, n in count.items():
        for i in sp.encode(word):
            seen[i] += n
    listed = lattice.vocabulary(MODEL)
    order = sum(x for *_, x in listed) + 1
    mass = lattice.PRIOR * (len(listed) + 1)
    whole = sum(seen.values()) + ends + mass
    pieces = Counter()
    for i, data, x in listed:
        pieces[data] += (seen[i] + mass * x / order) / whole
    end = (ends + mass / order) / whole
    longest = max(map(len, pieces))
    # decimals do not run out of exponents
    pieces = {piece: Decimal(x) for piece, x in pieces.items()}

    @cache
    def probability(data):
        alpha = [Decimal(1)]
        for j in range(1, len(data) + 1):
            alpha.append(sum(alpha[i] * pieces.get(data[i:j], 0) for i in range(max(0, j - longest), j)))
        return float(alpha[-1].log10())

    out = []
    base = lambda c: math.log10((c + 0.1) / (total + 0.1 * (distinct + 1)))
    for i, text in rows:
        words = WORD.findall(lower(text))
        out.append(
            (
                i, len(words) + 1, sum(count[w] > 0 for w in words) + (ends > 0), total,
                sum(base(count[w]) for w in words) + base(ends),
                sum(probability(("▁" + w).encode()) for w in words) + math.log10(end),
            )
        )
    return out


def close(got, want):
    assert len(got) == len(want)
    for g, w in zip(got, want, strict=True):
        assert g[:4] == w[:4]
        assert math.isclose(g[4], w[4], rel_tol=1e-9) and math.isclose(g[5], w[5], rel_tol=1e-9), (g, w)


def key(row):
    return (row[0] is None, row[0] or 0, row[1], row[4])


@pytest.mark.parametrize("rows_per_block", [4096, 3])
def test_equals_plain_version(spark, monkeypatch, rows_per_block):
    monkeypatch.setattr(lattice.exchange, "BLOCK_ROWS", rows_per_block)
    rng = random.Random(3)
    words = ["The", "cat", "Größe", "naïve", "日本", "😀", "x" * 20, "a.b,c", "<s>", "▁", "the", " ", "tokenization", "éé", "zq9"]
    rows = [(i, " \n".join(rng.choices(words, k=rng.randrange(0, 12)))) for i in range(120)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    got, name = lattice.score(docs, lattice.training(), MODEL)
    close(sorted(((r["doc_id"], *r[name]) for r in got.collect()), key=key), sorted(plain_scores(rows), key=key))


def test_a_block_is_read_in_parts(spark, monkeypatch):
    """No row of the written blocks holds all documents or keys of a block, and each is read alone."""
    import glob

    import pyarrow.parquet as pq

    written = []
    store = lattice.exchange.store
    monkeypatch.setattr(lattice.exchange, "store", lambda *a, **b: written.append(store(*a, **b)) or written[-1])
    monkeypatch.setattr(lattice.exchange, "PART_KEYS", 8, raising=False)
    monkeypatch.setattr(lattice, "PART_BYTES", 200, raising=False)
    monkeypatch.setattr(lattice, "GROUP_BYTES", 100, raising=False)
    rng = random.Random(5)
    rows = [(i, " ".join(f"w{rng.randrange(400)}" for _ in range(rng.randrange(30)))) for i in range(40)]
    # more keys than documents, and a text larger than a part
    rows.append((40, " ".join(f"v{i}" for i in range(300))))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(1)
    got, name = lattice.score(docs, lattice.training(), MODEL)
    blocks = written[0]
    found = blocks.selectExpr("block", "size(keys) AS n").collect()
    assert len({r["block"] for r in found}) == 1 and len(found) > 40
    assert max(r["n"] for r in found) <= 8
    places = sorted(r["place"] for r in lattice.exchange.keys_of(blocks).collect())
    assert places == list(range(len(places)))
    (file,) = glob.glob(f"{blocks._stored_at.removeprefix('file:')}/*.parquet")
    assert pq.ParquetFile(file).num_row_groups == len(found)
    close(sorted(((r["doc_id"], *r[name]) for r in got.collect()), key=key), sorted(plain_scores(rows), key=key))


def test_packed_numbers_come_back():
    for values in ([], [0], [255, 0, 256], [1 << 40, 7], list(range(70_000))):
        assert lattice.unpacked(lattice.packed(lattice.np.array(values, "int64"))).tolist() == values


def test_edge_rows(spark):
    docs = edge_docs(spark).withColumnRenamed("quality", "scores").withColumnRenamed("pieces", "_learn")
    got, name = lattice.score(docs, lattice.training(), MODEL)
    assert name != "scores" and got.columns == [c for c in docs.columns if c != "text"] + [name]
    found = sorted(((r["doc_id"], *r[name]) for r in got.collect()), key=key)
    close(found, sorted(plain_scores(DOCS), key=key))


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(1, "some words"), (2, None)], "doc_id bigint, text string")
    got, name = lattice.score(docs, lattice.F.lit(False), MODEL)
    for row in got.collect():
        assert row[name]["n_known"] == 0 and row[name]["train_tokens"] == 0
        assert row[name]["base_score"] == 0 and row[name]["score"] < 0
    assert lattice.score(empty_docs(spark), lattice.training(), MODEL)[0].count() == 0


def test_forward_recursion_sums_all_segmentations():
    rng = random.Random(2)
    for _ in range(50):
        pieces = {bytes([b]): rng.random() / 9 for b in b"abc"}
        for _ in range(6):
            pieces[bytes(rng.choices(b"abc", k=rng.randrange(2, 5)))] = rng.random() / 9
        model = lattice.Lattice([(p, math.log(x)) for p, x in pieces.items()])
        data = bytes(rng.choices(b"abc", k=rng.randrange(1, 14)))
        assert math.isclose(model.log_probability(data), math.log(segmentations(data, pieces)), rel_tol=1e-12)
    # far below the smallest double
    assert model.log_probability(b"abc" * 3000) < -5000


def test_weights_are_a_distribution(spark):
    words = spark.createDataFrame([("the", 5), ("größe", 2), ("held", 0)], "word string, c bigint")
    weights, end = lattice.learned_weights(words, 3, MODEL)
    assert math.isclose(sum(math.exp(w) for _, w in weights) + math.exp(end), 1.0, rel_tol=1e-9)
    assert dict(weights)["▁the".encode()] > dict(weights)["▁held".encode()]


def test_training_texts_score_higher(spark):
    """Held-out texts in the language of the training texts score above shuffled letters."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    strange = docs.selectExpr("doc_id + 100000000 AS doc_id", "reverse(text) AS text").where(~lattice.training())
    got, name = lattice.score(docs.unionByName(strange), lattice.training(), MODEL)
    per_token = lattice.F.avg(lattice.F.col(f"{name}.score") / lattice.F.col(f"{name}.n_tokens"))
    held = got.where(~lattice.training()).groupBy((lattice.F.col("doc_id") >= 100000000).alias("strange")).agg(per_token.alias("s"))
    by = {r["strange"]: r["s"] for r in held.collect()}
    assert by[False] > by[True] + 2
