"""Source divergence against a plain count."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from edge import edge_docs, empty_docs
from samesense.llm import divergence

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def plain_audit(rows, least, top):
    """``rows``: text, lang, source."""
    docs, count, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        groups[lang].add(source)
        terms = TERM.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
        docs[lang].update(set(terms))
        count[lang, source].update(terms)
    out = set()
    for lang, sources in groups.items():
        kept = [t for t, n in docs[lang].items() if n >= least]
        total = {s: sum(count[lang, s][t] for t in kept) for s in sources}
        p = lambda n, whole: 1 + 10**9 * (n + 5) // (whole + 5 * len(kept))
        share = {s: {t: p(count[lang, s][t], total[s]) for t in kept} for s in sources}
        for s in sources:
            pairs = [(o, sum(abs(share[s][t] - share[o][t]) for t in kept)) for o in sources if o != s]
            terms = []
            for t in kept:
                q = p(sum(count[lang, o][t] for o in sources), sum(total.values()))
                if count[lang, s][t] and share[s][t] > q:
                    terms.append((t, share[s][t] - q))
            for part, items, most in (("pair", pairs, None), ("term", terms, top)):
                items.sort(key=lambda x: (-x[1], x[0].encode()))
                out |= {(lang, s, part, item, value, rank) for rank, (item, value) in enumerate(items[:most], 1)}
    return out


def random_rows(rng, n, sources, terms):
    rows = []
    for _ in range(n):
        lang = rng.choice(["en", "de", None])
        source = rng.choice([*[f"s{rng.randrange(sources)}"] * 9, None, "é", "z"])
        words = [f"{chr(97 + w % 26)}{chr(97 + w // 26 % 26)}ö{chr(0x4E00 + w)}" for w in (int(rng.paretovariate(0.7)) % terms for _ in range(30))]
        rows.append((rng.choice([" ", "\n", "1"]).join(words).title() if rng.random() < 0.9 else None, lang, source))
    return rows


@pytest.mark.parametrize("tile", [(4, 16), (64, 1024)])
def test_equals_plain_count(spark, monkeypatch, tile):
    monkeypatch.setattr(divergence, "ROWS", tile[0])
    monkeypatch.setattr(divergence, "COLUMNS", tile[1])
    monkeypatch.setattr(divergence, "TABLE_ENTRIES", 100)
    rows = random_rows(random.Random(5), 500, 11, 90)
    docs = spark.createDataFrame(rows, "text string, lang string, source string").repartition(3)
    got = divergence.audit(docs, least_docs=3, top=5)
    assert {tuple(r) for r in got.collect()} == plain_audit(rows, 3, 5)


def test_edge_rows(spark):
    docs = edge_docs(spark).selectExpr("*", "if(doc_id % 3 = 0, null, if(doc_id = 5, '', 'en')) lang", "if(doc_id % 2 = 0, null, 'a') source")
    rows = [tuple(r) for r in docs.select("text", "lang", "source").collect()]
    for least in (1, 2, 30):
        got = divergence.audit(docs, least_docs=least)
        want = plain_audit(rows, least, 50)
        assert {tuple(r) for r in got.collect()} == want
    # no kept term anywhere: pairs of value 0 only
    assert want and {r[2] for r in want} == {"pair"} and {r[4] for r in want} == {0}


def test_empty_table(spark):
    assert divergence.audit(empty_docs(spark).selectExpr("*", "text lang", "text source")).count() == 0


def test_trees_skip_what_is_empty():
    rng = np.random.default_rng(3)
    for n, m, width, filled in ((64, 64, 1024, 300), (5, 64, 1000, 40), (1, 2, 7, 0), (3, 3, 1, 2)):
        def tile(rows):
            cells = rng.choice(rows * width, min(filled, rows * width), replace=False)
            return cells // width, cells % width, rng.integers(1, 10**6, len(cells))

        one, two = tile(n), tile(m)
        whole = rng.integers(10**3, 10**12, n), rng.integers(10**3, 10**12, m)
        dense = []
        for (rows, columns, counts), of in ((one, whole[0]), (two, whole[1])):
            full = np.zeros((len(of), width), "int64")
            full[rows, columns] = counts
            dense.append([[1 + 10**9 * (int(c) + 5) // int(w) for c in row] for row, w in zip(full, of, strict=True)])
        want = [[sum(abs(x - y) for x, y in zip(a, b, strict=True)) for b in dense[1]] for a in dense[0]]
        got, leaves = divergence.price_tiles(one, two, *whole, width, False)
        assert got.tolist() == want
        assert leaves <= filled * (n + m) and leaves < n * m * width or width == 1
        if n == m:
            same, _ = divergence.price_tiles(one, one, whole[0], whole[0], width, True)
            for i in range(n):
                for j in range(n):
                    assert same[i, j] == (sum(abs(x - y) for x, y in zip(dense[0][i], dense[0][j], strict=True)) if i < j else 0)


def test_shares_are_exact_beyond_64_bits(spark):
    cases = [(0, 1), (10**12, 10**13 + 7), (9 * 10**14, 9 * 10**14 + 3), (3, 7)]
    n, whole = (np.array(x, "int64") for x in zip(*cases, strict=True))
    want = [1 + 10**9 * (a + 5) // b for a, b in cases]
    assert divergence.shares(n, whole).tolist() == want
    df = spark.createDataFrame(cases, "n bigint, w bigint")
    assert [r[0] for r in df.select(divergence.share(df["n"], df["w"])).collect()] == want


def test_long_texts_are_cut_between_terms():
    text = ("Größe und Maß, one\x00two " * 40 + "x" * 500 + "É").encode()
    found = [t.decode() for part in divergence.terms_of(text, 64) for t in part]
    assert found == TERM.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text.decode()))
