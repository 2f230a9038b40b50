"""Cross-tokenizer alignment against whole texts and plain loops."""

import hashlib
import json
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from edge import DOCS, edge_docs, empty_docs
from samesense.llm import alignment
from samesense.llm.queries import tokenizer_file, tokenizer_model

FILES = (tokenizer_file("byte_bpe_50k.json"), tokenizer_model())


TOKENIZER = Tokenizer.from_file(FILES[0])
TOKENIZER.encode_special_tokens = True


def whole_a(text):
    """Ids of the byte-level file by its own library."""
    return TOKENIZER.encode(" " + text, add_special_tokens=False).ids


def plain_tokens(pair, text):
    """Byte ranges and ids of both tokenizers over the whole text, or None."""
    if not text:
        return None
    data = (" " + text).encode()
    ids = [whole_a(text), pair.b.encode(text)]
    if any(b"".join(table[i] for i in x) != data for x, table in zip(ids, (pair.bytes_a, pair.bytes_b), strict=True)):
        return None
    out = []
    for x, table in zip(ids, (pair.bytes_a, pair.bytes_b), strict=True):
        at, spans = 0, []
        for i in x:
            spans.append((at, at + len(table[i]), i))
            at += len(table[i])
        out.append(spans)
    return out


def plain_links(a, b):
    return [(x[2], y[2]) for x in a for y in b if x[0] < y[1] and y[0] < x[1]]


def plain_align(texts):
    pair = alignment.Pair(*FILES)
    tokens = [plain_tokens(pair, t) for t in texts]
    links = [plain_links(*t) if t else [] for t in tokens]
    count = Counter(link for found in links for link in found)
    best = defaultdict(int)
    for (_, b), n in count.items():
        best[b] = max(best[b], n)
    rows = []
    for t, found in zip(tokens, links, strict=True):
        if t is None:
            rows.append((0, 0, 0, 0, 0, 0, "", 0))
            continue
        cuts = sorted({x[1] for x in t[0]} & {x[1] for x in t[1]})
        shown, inside = [], 0
        for low, high in zip([0, *cuts], cuts, strict=False):
            sides = [[str(x[2]) for x in side if low <= x[0] < high] for side in t]
            shown.append("|".join(",".join(side) for side in sides))
            inside += len(sides[0]) * len(sides[1])
        rows.append(
            (
                len(t[0]), len(t[1]), len(cuts), len(found), sum(count[x] == best[x[1]] for x in found),
                sum(count[x] for x in found), hashlib.sha256(";".join(shown).encode()).hexdigest(), inside,
            )
        )
    return rows


def odd_text(rng):
    parts = [
        " ", "  ", "   ", "\n", "\n\n", "\t", "\r\n", " ", "　", "\x1c", " ", "word", "The", "don't", "'s", "naïve", "Größe",
        "12345", "3.14", "...", "-", "é", "é", "日本語", "😀", "👨‍👩‍👧", "<s>", "</s>", "<|endoftext|>", "<unk>", "<0x0A>", "a" * 30, "x_y", "@", "▁",
    ]
    weights = [8, 3, 1, 3, 1, 1, 1, 1, 1, 0.3, 0.3, 8, 6, 2, 2, 2, 2, 2, 2, 2, 2, 2, 1, 2, 2, 1, 1, 1, 1, 1, 1, 1, 1, 1, 0.1]
    return "".join(rng.choices(parts, weights, k=rng.randrange(1, 40)))


@pytest.mark.parametrize("lookup_pairs", [alignment.LOOKUP_PAIRS, 0])
def test_equals_plain_loops(spark, lookup_pairs):
    rng = random.Random(7)
    rows = [(i, odd_text(rng)) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    got, name = alignment.align(docs, *FILES, lookup_pairs=lookup_pairs)
    found = {r["doc_id"]: tuple(r[name]) for r in got.collect()}
    want = plain_align([t for _, t in rows])
    assert found == {i: w for (i, _), w in zip(rows, want, strict=True)}
    # most texts have tokens, and some groups hold several tokens of either side
    assert sum(1 for w in want if w[6]) > 300 and any(w[7] > w[3] for w in want)


def test_edge_rows(spark):
    docs = edge_docs(spark).withColumnRenamed("quality", "aligned")
    got, name = alignment.align(docs, *FILES)
    assert name != "aligned" and got.columns == [c for c in docs.columns if c != "text"] + [name]
    small = [d for d in DOCS if d[0] != 5]
    rows = got.collect()
    assert len(rows) == len(DOCS)
    by_id = {r["doc_id"]: r for r in rows if r["doc_id"] is not None}
    for i, text in small:
        if i is not None:
            assert (by_id[i][name]["n_a"] == 0) == (not text or "▁" in text)
            assert by_id[i]["aligned"] == "clash"
    assert by_id[5][name]["n_groups"] > 50_000
    assert sorted(r[name]["n_a"] for r in rows if r["doc_id"] is None)[0] == 0


def test_empty_table(spark):
    assert alignment.align(empty_docs(spark), *FILES)[0].count() == 0


def test_blocks_are_whole_texts():
    """Ids of the blocks, one after the other, are those of both libraries for the whole text."""
    blocks, rng = alignment.Blocks(*FILES), random.Random(1)
    for _ in range(4000):
        # a text with the marker itself is not spelled, so its blocks do not matter
        text = odd_text(rng).replace("▁", "_")
        chunks = alignment.CHUNK.findall(" " + text)
        assert "".join(chunks) == " " + text
        a = [i for ids in blocks.pair.ids_a(chunks) for i in ids]
        assert a == whole_a(text), text
        b = [i for ids in blocks.pair.ids_b(chunks) for i in ids]
        assert b == blocks.pair.b.encode(text), text


def test_thinned_tables_change_nothing(monkeypatch):
    rng = random.Random(2)
    texts = [odd_text(rng) for _ in range(60)]
    shown = []
    for size in (150_000, 40, 0):
        monkeypatch.setattr(alignment, "TABLE_ENTRIES", size)
        blocks, seen = alignment.Blocks(*FILES), []
        for low in range(0, 60, 5):
            blocks.thin_out()
            assert size < 100 or len(blocks.names) > 60 or low < 30
            found = blocks.documents(texts[low : low + 5])
            for own in found:
                blocks.links[own, 2] += 1
                pairs = np.concatenate([blocks.linked[blocks.links[i, 0] : blocks.links[i, 0] + blocks.links[i, 1]] for i in own.tolist()] or [np.zeros((0, 2), int)])
                seen.append((b";".join(blocks.shown[i] for i in own), blocks.figures[own].sum(axis=0).tolist(), sorted(map(tuple, pairs.tolist()))))
        shown.append(seen)
    assert shown[0] == shown[1] == shown[2]


def test_other_byte_files_go_through_their_library(tmp_path):
    """Entries that are not numbered by their merges: the same ids as the library's."""
    with open(FILES[0], encoding="utf-8") as file:
        listed = json.load(file)
    listed["model"]["merges"] = listed["model"]["merges"][:1000] + listed["model"]["merges"][1001:]
    path = tmp_path / "other.json"
    path.write_text(json.dumps(listed), encoding="utf-8")
    encode, spelled = alignment.byte_encoder(str(path))
    other = Tokenizer.from_file(str(path))
    other.encode_special_tokens = True
    rng = random.Random(6)
    for _ in range(200):
        text = " " + odd_text(rng)
        ids = encode(text)
        assert ids == other.encode(text, add_special_tokens=False).ids
        assert b"".join(spelled[i] for i in ids) == text.encode()


@pytest.mark.parametrize("expand", [1, 7, 1 << 20])
def test_products_equal_dense_ones(expand):
    rng = np.random.default_rng(1)
    for _ in range(30):
        n, k, m = rng.integers(1, 12, 3)
        dense = [rng.integers(0, 3, (n, k)) * (rng.random((n, k)) < 0.4), rng.integers(0, 3, (k, m)) * (rng.random((k, m)) < 0.4)]
        sparse = []
        for matrix in dense:
            rows, columns = np.nonzero(matrix)
            starts = np.concatenate([[0], np.cumsum(np.bincount(rows, minlength=len(matrix)))])
            sparse.append(alignment.Csr(starts, columns, matrix[rows, columns]))
        want = dense[0] @ dense[1]
        got = np.zeros_like(want)
        for row, column, value in alignment.product(*sparse, expand):
            assert len({*zip(row.tolist(), column.tolist(), strict=True)}) == len(row)
            got[row, column] += value
        assert (got == want).all()
        flipped = alignment.transposed(sparse[0], int(k))
        assert flipped.starts[-1] == sparse[0].starts[-1]


def test_links_share_bytes_and_groups():
    a, b = np.array([2, 3, 1, 4]), np.array([1, 4, 1, 2, 2])
    found = [tuple(x) for part in alignment.overlap_links(a, b) for x in zip(*(y.tolist() for y in part), strict=True)]
    assert found == [(0, 0, 1), (0, 1, 1), (1, 1, 3), (2, 2, 1), (3, 3, 2), (3, 4, 2)]
    group_a, group_b = alignment.groups_of(a, b)
    assert group_a.tolist() == [0, 0, 1, 2] and group_b.tolist() == [0, 0, 1, 2, 2]
    left, right = alignment.group_links(group_a, group_b)
    linked = [(x, y) for part in alignment.product(left, right) for x, y in zip(part[0].tolist(), part[1].tolist(), strict=True)]
    assert linked == [(0, 0), (0, 1), (1, 0), (1, 1), (2, 2), (3, 3), (3, 4)]
    assert alignment.product_sizes(left, right).tolist() == [2, 2, 1, 2]


def test_blocks_are_read_one_by_one(spark):
    """A row of a block fills a row group, and a worker's tables do not outlive the tasks that need them."""
    import glob

    import pyarrow.parquet as pq
    from pyspark.sql.types import ArrayType, IntegerType, LongType, StructType

    from samesense.llm import alignment, exchange

    def start():
        def work(batch, texts):
            numbers = pa.array(range(len(texts)), pa.int64())
            ints = pa.ListArray.from_arrays(pa.array([0, 5000], pa.int32()), pa.array(range(5000), pa.int32()))
            return {"n": numbers}, {"pair": numbers}, {"places": ints}

        return work

    import pyarrow as pa

    long = lambda name: StructType().add(name, LongType())
    docs = spark.range(6).coalesce(1).selectExpr("id AS doc_id", "'some text' AS text")
    places = StructType().add("places", ArrayType(IntegerType(), False))
    blocks = exchange.write_blocks(docs, "text", start, long("n"), long("pair"), places, "blocks", 9, 1000)
    (file,) = glob.glob(f"{blocks._stored_at.removeprefix('file:')}/*.parquet")
    assert blocks.count() == 6 and pq.ParquetFile(file).num_row_groups == 6
    alignment._WORKER[("a", "b")] = None
    alignment.give_back(tables=True)
    assert not alignment._WORKER
