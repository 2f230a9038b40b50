"""Line dedup against a plain loop over lines."""

import hashlib
import random
import re

from edge import edge_docs, empty_docs
from samesense.llm import lines
from samesense.llm.queries import QUERIES

HAS_WORD = re.compile(r"[^\x20\x09-\x0D]")
WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def plain_dedup(rows, least_words=5):
    """Texts of ``(id, text)`` rows without repeated lines; ids distinct."""
    docs = []
    for doc, text in rows:
        parts = (text or "").split("\n")
        worded = [i for i, line in enumerate(parts) if HAS_WORD.search(line)]
        docs.append((doc, parts, worded, [parts[i] for i in worded]))
    seen, pairs, gone = set(), set(), [set() for _ in docs]
    for d in sorted(range(len(docs)), key=lambda d: (docs[d][0] is None, docs[d][0])):
        row = docs[d][3]
        hashes = [hashlib.md5(line.encode()).hexdigest() for line in row]
        chosen = {i for i, line in enumerate(row) if len(WORDS.findall(line)) >= least_words}
        for j in range(max(1, len(row) - 1) if row else 0):
            chosen.add(min(range(j, min(j + 2, len(row))), key=lambda i: (hashes[i], -i)))
        for i, line in enumerate(row):
            if i in chosen:
                if line in seen:
                    gone[d].add(docs[d][2][i])
                seen.add(line)
            if i + 1 < len(row):
                if (line, row[i + 1]) in pairs:
                    gone[d].update(docs[d][2][i : i + 2])
                pairs.add((line, row[i + 1]))
    return [
        "\n".join(line for i, line in enumerate(parts) if i not in gone[d]) if rows[d][1] is not None else None
        for d, (_, parts, _, _) in enumerate(docs)
    ]


def cases():
    rng = random.Random(2)
    shared = [[f"shared {r} {i}" for i in range(rng.randrange(2, 9))] for r in range(8)]
    rows = []
    for d in range(80):
        body = []
        for _ in range(rng.randrange(0, 6)):
            body += rng.choice([rng.choice(shared), [f"own {rng.random()}"], ["", "  "], ["often"], ["same"] * rng.randrange(1, 6)])
        rows.append((1000 + d, "\n".join(body)))
    return rows


def test_equals_plain_loop(spark):
    docs = edge_docs(spark, cases()).where("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    shortened, count = lines.dedup_lines(docs)
    got = {r["doc_id"]: r["text"] for r in shortened.collect()}
    want = dict(zip([i for i, _ in rows], plain_dedup(rows), strict=True))
    assert got == want
    assert sum(w != t for (_, t), w in zip(rows, want.values(), strict=True)) > 30
    assert shortened.columns == [*docs.columns, count]


def test_edge_rows_and_repeats(spark):
    text = "one line\ntwo line\nthree line"
    more = [(300, text), (300, text), (301, text), (None, text)]
    shortened, count = lines.dedup_lines(edge_docs(spark, more))
    rows = shortened.collect()
    assert sorted((str(r["doc_id"]), r["text"], r[count]) for r in rows if r["doc_id"] in (300, 301)) == [
        ("300", text, 0), ("300", text, 0), ("301", "", 3),
    ]
    assert len(rows) == 19 and [r["text"] for r in rows if r["doc_id"] == 2] == [None]
    assert [r[count] for r in rows if r["doc_id"] is None] .count(3) == 1


def test_any_run_of_two_lines_is_found(spark):
    """Two short lines in a row that an earlier document has go, both of them."""
    rows = []
    for d in range(60):
        run = [f"run {d} {i}" for i in range(lines.WINDOW)]
        rows += [(2 * d, "\n".join([f"a{d}", *run, f"b{d}"])), (2 * d + 1, "\n".join([f"c{d}", *run, f"d{d}"]))]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    shortened, count = lines.dedup_lines(docs)
    assert all(r[count] == 2 * (r["doc_id"] % 2) for r in shortened.collect())


def test_first_place_of_a_longer_run(spark):
    """The first place of a line is alone, a later one holds a run that a third repeats."""
    rng = random.Random(8)
    rows, want = [], {}
    for d in range(0, 120, 3):
        x, y, z = (f"{w} {rng.random()}" for w in ("one", "two", "three"))
        texts = [rng.choice([[x], [y], [z]]), [x, y, z], [x, y, z]]
        rows += [(d + k, "\n".join([f"a{d + k}", *t, f"b{d + k}"])) for k, t in enumerate(texts)]
        want[d + 2] = f"a{d + 2}\nb{d + 2}"
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    shortened, _ = lines.dedup_lines(docs)
    assert {r["doc_id"]: r["text"] for r in shortened.collect() if r["doc_id"] % 3 == 2} == want


def test_lone_lines_are_deleted(spark):
    """A line of two, of five and of fifty words, each shared alone between unlike neighbours."""
    long, five = (" ".join(f"word{i}" for i in range(n)) for n in (50, 5))
    rows = [(d, "\n".join([f"a{d}", "shared line", f"b{d}", "", long, f"c{d}", f" {five} ", f"d{d}"])) for d in range(40)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    for least, most in ((lines.LEAST_WORDS, 2), (1, 3)):
        shortened, count = lines.dedup_lines(docs, least_words=least)
        got = {r["doc_id"]: (r["text"], r[count]) for r in shortened.collect()}
        assert got[0] == (rows[0][1], 0)
        for d in range(1, 40):
            assert most <= got[d][1] <= 3 and long not in got[d][0] and five not in got[d][0]
            assert got[d][0].replace("shared line\n", "") == f"a{d}\nb{d}\n\nc{d}\nd{d}"
    # the query too: no line with a word is left twice
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    seen, want = set(), {}
    for doc, text in docs:
        repeats = 0
        kept = []
        for line in (text or "").split("\n"):
            if HAS_WORD.search(line) and line in seen:
                repeats += 1
            else:
                kept.append(line)
                seen.add(line)
        want[doc] = (repeats, hashlib.sha256("\n".join(kept).encode()).hexdigest())
    got = {r["doc_id"]: (r["n_deleted"], r["kept_sha256"]) for r in QUERIES["op7_single_line_dedup"](spark, folder).collect()}
    assert got == want and sum(n for n, _ in want.values()) > 100


def test_empty_table(spark):
    assert lines.dedup_lines(empty_docs(spark))[0].count() == 0


def test_no_python(spark):
    plan = QUERIES["op7_line_dedup"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
