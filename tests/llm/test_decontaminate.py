"""Benchmark overlaps against every diagonal of every pair of texts."""

import itertools
import random
import re
from collections import Counter

import numpy as np
import pytest

from edge import LONG, edge_docs, empty_docs
from samesense.llm import decontaminate
from samesense.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words_of(text):
    return [re.sub(r"[\W_]+", "", w.lower()) for w in WORD.findall(text or "")]


def plain(docs, items):
    """Best overlap per document id and item id, looking at all diagonals."""
    best = {}
    for (doc, text), (item, question) in itertools.product(docs, items):
        a, b = words_of(text), words_of(question)
        if not b:
            continue
        known = {w: i for i, w in enumerate(b)}
        if not known.keys() & set(a):
            continue
        places = {}
        for j, w in enumerate(b):
            places.setdefault(w, []).append(j)
        diagonals = Counter(i - j for i, w in enumerate(a) for j in places.get(w, ()))
        for shift, n in diagonals.items():
            size = min(16, len(b))
            if n < size - int(0.2 * size + 1e-9):
                continue
            low, high = max(0, shift), min(len(a), shift + len(b))
            equal = [a[i] == b[i - shift] for i in range(low, high)]
            good = [i for i in range(len(equal) - size + 1) if sum(equal[i : i + size]) >= size - int(0.2 * size + 1e-9)]
            if not good:
                continue
            inside = [i for i in range(good[0], good[-1] + size) if equal[i]]
            found = (sum(equal[inside[0] : inside[-1] + 1]), -(low + inside[0]), low + inside[-1] + 1)
            best[doc, item] = max(best.get((doc, item), found), found)
    return sorted((str(d), str(i), -f, e, n) for (d, i), (n, f, e) in best.items())


def got(df):
    return sorted((str(r["doc_id"]), str(r["item_id"]), r["start"], r["end"], r["equal"]) for r in df.collect())


def changed(words, rate, rng):
    return " ".join(f"other{rng.random()}" if rng.random() < rate else w for w in words.split())


def cases():
    rng = random.Random(8)
    items = [(i, " ".join(f"q{rng.randrange(300)}" for _ in range(n))) for i, n in enumerate([*range(1, 9), *(rng.randrange(3, 60) for _ in range(22))])]
    items += [(30, None), (31, ""), (32, "four words are few"), (33, items[5][1]), (5, items[5][1]), (None, items[6][1])]
    docs = []
    for i in range(120):
        question = items[rng.randrange(30)][1]
        filler = " ".join(f"q{rng.randrange(300)}" for _ in range(rng.randrange(0, 80)))
        docs.append((1000 + i, f"{filler} {changed(question, rng.choice([0, 0.1, 0.2, 0.3]), rng)} {filler}"))
    docs += [(1500 + i, items[i][1].upper().replace(" ", ", ")) for i in range(5)]
    docs += [(2000, items[7][1] + "\n" + LONG + "\n" + items[7][1]), (2001, items[8][1][:40])]
    return docs, items


def test_equals_plain_search(spark):
    more, items = cases()
    docs = edge_docs(spark, more)
    table = spark.createDataFrame([(*i, 1, 2) for i in items], "item_id bigint, text string, seeds int, words int")
    want = plain([(r["doc_id"], r["text"]) for r in docs.collect()], items)
    assert len(want) > 60
    assert got(decontaminate.contaminated(docs, table)) == want
    # short items too, those of five words or more also with a word replaced
    words = {str(i): len((t or "").split()) for i, t in items}
    assert {words[r[1]] for r in want} >= set(range(1, 9))
    assert any(words[r[1]] in (5, 6, 7) and r[4] < words[r[1]] for r in want)


@pytest.mark.parametrize("n", range(8, 17))
def test_masks_leave_no_gap(n):
    masks = [[i for i, bit in enumerate(m) if bit == "1"] for m in decontaminate.MASKS]
    for replaced in itertools.combinations(range(n), decontaminate.tolerated(n)):
        assert any(
            all(start + place not in replaced for place in mask)
            for mask in masks
            for start in range(n - mask[-1])
        )


@pytest.mark.parametrize("n", range(1, 8))
def test_short_masks_leave_no_gap(n):
    masks = decontaminate.short_masks(n)
    assert len(masks) == (n if n >= 5 else 1)
    for replaced in itertools.combinations(range(n), decontaminate.tolerated(n)):
        assert any(all(bit == "0" for i, bit in enumerate(mask) if i in replaced) for mask in masks.values())


def test_empty_tables(spark):
    docs, nothing = edge_docs(spark), empty_docs(spark).withColumnRenamed("doc_id", "item_id")
    items = spark.createDataFrame([(1, "one two three four five six")], "item_id bigint, text string")
    assert decontaminate.contaminated(docs, nothing).count() == 0
    assert decontaminate.contaminated(empty_docs(spark), items).count() == 0


def test_query_over_whole_table(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    items = spark.read.parquet(f"{folder}/benchmark.parquet").select("item_id", "text").collect()
    want = plain(docs, items)
    assert want and got(QUERIES["op5_decontamination"](spark, folder)) == want


def test_regions_join_up():
    words = np.zeros(100, "uint64")
    assert decontaminate.regions(words, np.array([10, 12, 90]), 5) == [(5, 17), (85, 95)]
