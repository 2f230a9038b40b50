"""Encoding and decoding against the library on whole texts."""

import hashlib
import random

import pytest
import sentencepiece

from edge import edge_docs, empty_docs
from samesense.llm import pieces
from samesense.llm.queries import QUERIES, tokenizer_model


def library():
    return sentencepiece.SentencePieceProcessor(model_file=tokenizer_model())


def random_texts(n):
    rng = random.Random(5)
    alphabet = "ab  e\n\tThé▁ñ中\U0001f600.,<0x0A></s>\r  in ing tion"
    return [(100 + i, "".join(rng.choice(alphabet) for _ in range(rng.randrange(1, 200)))) for i in range(n)]


def test_model_suits_the_method():
    assert pieces.crossing_pieces(tokenizer_model()) == []


def test_other_models_are_refused(spark, monkeypatch):
    monkeypatch.setattr(pieces, "crossing_pieces", lambda model: ["a▁b"])
    with pytest.raises(ValueError, match="a▁b"):
        pieces.encode(edge_docs(spark), tokenizer_model())


def test_equals_library_on_whole_texts(spark):
    docs = edge_docs(spark, random_texts(300))
    encoded, name = pieces.encode(docs, tokenizer_model())
    assert encoded.columns[:-1] == docs.columns
    sp = library()
    for row in encoded.collect():
        ids = sp.encode(row["text"] or "")
        assert list(row[name]["ids"]) == ids, row["text"]
        assert row[name]["decoded"] == sp.decode(ids)


def test_small_table_gives_the_same(spark):
    table = pieces.ChunkTable(tokenizer_model(), entries=3)
    words = [f"▁w{i % 7}" for i in range(50)]
    big = pieces.ChunkTable(tokenizer_model())
    for i in range(0, 50, 5):
        assert table.look_up(words[i : i + 5]) == big.look_up(words[i : i + 5])


def test_empty_table(spark):
    encoded, _ = pieces.encode(empty_docs(spark), tokenizer_model())
    assert encoded.count() == 0


def test_query_over_whole_table(spark):
    folder = "/root/testdata/sf0.001"
    got = {r["doc_id"]: r for r in QUERIES["op10_sentencepiece"](spark, folder).collect()}
    sp = library()
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    docs = spark.read.parquet(f"{folder}/documents.parquet").collect()
    assert len(got) == len(docs)
    for row in docs:
        ids = sp.encode(row["text"] or "")
        mine = got[row["doc_id"]]
        assert (mine["n_tokens"], mine["ids_sha256"], mine["decoded_sha256"]) == (
            len(ids), sha(",".join(map(str, ids))), sha(sp.decode(ids)),
        )
