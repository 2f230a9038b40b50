"""Substring dedup against a dictionary of all windows, and the naming rounds' promise."""

import random

import numpy as np

from edge import edge_docs, empty_docs
from samesense.llm import bloom, substrings


def plain(rows, width=13):
    """``(n_words, n_removed, kept)`` per row of ``(id, text)``."""
    words = [[w.decode() for w in (t or "").encode().split()] for _, t in rows]
    first = {}
    for (doc, _), w in zip(rows, words, strict=True):
        for i in range(len(w) - width + 1 if doc is not None else 0):
            key = tuple(w[i : i + width])
            first[key] = min(first.get(key, doc), doc)
    out = []
    for (doc, _), w in zip(rows, words, strict=True):
        gone = {
            j
            for i in range(len(w) - width + 1 if doc is not None else 0)
            if first[tuple(w[i : i + width])] < doc
            for j in range(i, i + width)
        }
        out.append((str(doc), len(w), len(gone), " ".join(x for j, x in enumerate(w) if j not in gone)))
    return sorted(out)


def cases():
    rng = random.Random(4)
    vocabulary = [f"v{i}" for i in range(40)] + ["\x1c", "a b", "\u0085"]
    passages = [[rng.choice(vocabulary) for _ in range(rng.randrange(10, 90))] for _ in range(12)]
    rows = []
    for d in range(150):
        body = []
        for _ in range(rng.randrange(0, 5)):
            body += rng.choice([
                rng.choice(passages),
                [rng.choice(vocabulary) for _ in range(rng.randrange(1, 40))],
                ["again"] * rng.randrange(1, 40),
                ["x", "y"] * rng.randrange(1, 20),
            ])
        rows.append((1000 + d, rng.choice([" ", "\n", " \t "]).join(body)))
    return rows


def got(docs):
    done, name = substrings.remove_repeats(docs)
    assert done.columns == [*docs.columns, name]
    return sorted((str(r["doc_id"]), *r[name]) for r in done.collect())


def test_equals_dictionary_of_windows(spark):
    docs = edge_docs(spark, [*cases(), (1000, "again " * 30), (1001, None)])
    want = plain([(r["doc_id"], r["text"]) for r in docs.collect()])
    assert sum(r[2] > 0 for r in want) > 60
    assert got(docs) == want


def test_full_filter_changes_nothing(spark, monkeypatch):
    """With a filter that admits everything the result is the same: it only saves work."""
    monkeypatch.setattr(bloom, "bitmap", lambda hashes, bits: np.full(1 << 10, 2**64 - 1, "uint64"))
    docs = edge_docs(spark, cases())
    assert got(docs) == plain([(r["doc_id"], r["text"]) for r in docs.collect()])


def test_empty_table(spark):
    assert substrings.remove_repeats(empty_docs(spark))[0].count() == 0


def test_marks_depend_on_the_window_alone():
    """The same window gets the same mark whatever stands around it."""
    rng = np.random.default_rng(1)
    for size in (2, 5, 1000):
        for _ in range(200):
            window = rng.integers(0, size, 13).astype("uint64")
            marks = set()
            for _ in range(6):
                left, right = (rng.integers(0, size, rng.integers(0, 30)).astype("uint64") for _ in range(2))
                words = substrings._mix(np.concatenate([left, window, right]) + np.uint64(1))
                marks.add(int(substrings.window_marks(words)[len(left)]))
            assert len(marks) == 1


def test_marks_say_more_than_a_word():
    """On words with little repetition most marks stand for several words."""
    words = substrings._mix(np.random.default_rng(2).integers(0, 5000, 20_000).astype("uint64"))
    marks = substrings.window_marks(words)
    assert np.isin(marks, words).mean() < 0.05
