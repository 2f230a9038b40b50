"""SimHash groups against all pairs."""

import random
import re

import numpy as np
import pytest
import xxhash

from edge import edge_docs, empty_docs
from samesense.llm import simhash
from samesense.llm.queries import QUERIES
from samesense.operators.components import components


def plain_fingerprint(text):
    text = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_roots(prints):
    """Component label of each distinct fingerprint, by all pairs."""
    prints = np.array(sorted(set(prints)), "uint64")
    label = list(range(len(prints)))

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for i, one in enumerate(prints):
        for j in np.flatnonzero(np.bitwise_count(prints[i + 1 :] ^ one) <= 4):
            label[find(i)] = find(i + 1 + int(j))
    return {int(p): find(i) for i, p in enumerate(prints)}


def plain_groups(rows):
    prints = [plain_fingerprint(text) for _, text in rows]
    roots = plain_roots(prints)
    smallest = {}
    for (doc, _), p in zip(rows, prints, strict=True):
        if doc is not None:
            smallest[roots[p]] = min(smallest.get(roots[p], doc), doc)
    return sorted(
        (str(doc), f"{p:016x}", str(smallest.get(roots[p]))) for (doc, _), p in zip(rows, prints, strict=True)
    )


def got(df):
    return sorted((str(r["doc_id"]), r["fingerprint"], str(r["component_id"])) for r in df.collect())


def test_edge_rows(spark):
    base = " ".join(f"near{i}" for i in range(400))
    near = [(50 + i, base + f" tail{i}") for i in range(30)]
    docs = edge_docs(spark, near)
    want = plain_groups([(r["doc_id"], r["text"]) for r in docs.collect()])
    assert got(simhash.near_duplicates(docs)) == want


def test_empty_table(spark):
    assert simhash.near_duplicates(empty_docs(spark)).count() == 0


@pytest.mark.parametrize("tile", [4, 4096])
def test_links_connect_as_all_pairs_do(spark, tile):
    rng = random.Random(3)
    prints = [rng.getrandbits(64) for _ in range(300)]
    for _ in range(1500):
        value = rng.choice(prints[-400:])
        for _ in range(rng.randrange(1, 5)):
            value ^= 1 << rng.randrange(64)
        prints.append(value)
    signed = sorted({p - (1 << 64) if p >> 63 else p for p in prints})
    table = spark.createDataFrame([(p,) for p in signed], "fp bigint")
    found = {r["node"]: r["root"] for r in components(simhash.links(table, tile), "u", "v").collect()}
    want = plain_roots(prints)
    groups = {}
    for p in prints:
        s = p - (1 << 64) if p >> 63 else p
        groups.setdefault(want[p], set()).add(found.get(s, s))
    assert all(len(g) == 1 for g in groups.values())
    assert len({next(iter(g)) for g in groups.values()}) == len(groups)


def test_query_over_whole_table(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    assert got(QUERIES["op2_simhash"](spark, folder)) == plain_groups(docs)
