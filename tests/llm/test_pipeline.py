"""The pipeline's stages against plain versions of each."""

import sentencepiece

import corpus_pipeline
from edge import edge_docs
from samesense.llm.queries import tokenizer_model
from test_decontaminate import plain as plain_overlaps
from test_lines import plain_dedup
from test_quality import plain_quality
from test_simhash import plain_fingerprint, plain_roots

FOLDER = "/root/testdata/sf0.001"


def plain_stages(rows, items):
    """Documents ``(id, text)`` after each of the first four stages."""
    rows = [r for r in rows if plain_quality(r[1])["kept"]]
    yield rows
    rows = [(i, t) for (i, _), t in zip(rows, plain_dedup(rows), strict=True)]
    yield rows
    prints = [plain_fingerprint(t) for _, t in rows]
    roots = plain_roots(prints)
    first = {}
    for (i, _), p in zip(rows, prints, strict=True):
        first[roots[p]] = min(first.get(roots[p], i), i)
    rows = [(i, t) for (i, t), p in zip(rows, prints, strict=True) if first[roots[p]] == i]
    yield rows
    found = {i for i, *_ in plain_overlaps(rows, items)}
    yield [r for r in rows if str(r[0]) not in found]


def test_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    items = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").select("item_id", "text").collect()]
    columns = docs.columns
    want = plain_stages([tuple(r) for r in docs.select("doc_id", "text").collect()], items)
    sizes = [docs.count()]
    for (name, stage), rows in zip(corpus_pipeline.STAGES, want, strict=False):
        docs = corpus_pipeline.store(stage(spark, docs, FOLDER), name)
        assert docs.columns == columns
        assert sorted(tuple(r) for r in docs.select("doc_id", "text").collect()) == sorted(rows), name
        assert docs.where("n_chars <> length(text)").count() == 0
        sizes.append(len(rows))
    assert sizes == sorted(sizes, reverse=True) and sizes[1] < sizes[0] and sizes[4] < sizes[3]
    sp = sentencepiece.SentencePieceProcessor(model_file=tokenizer_model())
    last = {r["doc_id"]: r for r in corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER).collect()}
    assert len(last) == sizes[4]
    for i, text in rows:
        assert last[i]["n_tokens"] == len(sp.encode(text)) and last[i]["round_trip"]


def test_edge_rows_pass_through(spark):
    docs = edge_docs(spark).selectExpr("doc_id", "text", "'en' lang", "'s' source", "CAST(length(text) AS bigint) n_chars", "words", "spans")
    for _, stage in corpus_pipeline.STAGES[1:]:
        docs = corpus_pipeline.store(stage(spark, docs, FOLDER), "edge")
        assert docs.count() >= 5
    # the one text that holds the white-space marker itself decodes to blanks
    assert [r["doc_id"] for r in docs.where("NOT round_trip").collect()] == [8]


def test_empty_table(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").where("doc_id < 0")
    for _, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.store(stage(spark, docs, FOLDER), "empty")
    assert docs.count() == 0
