"""Quality rules against plain counting."""

import re

from edge import edge_docs, empty_docs
from samesense.llm import quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_quality(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [line for line in text.split("\n") if WORD.search(line)]
    places = {}
    for i in range(len(words) - 7):
        places.setdefault(tuple(words[i : i + 8]), []).append(i)
    covered = {j for at in places.values() if len(at) > 1 for i in at for j in range(i, i + 8)}
    stop = set(quality.stop_words())
    n = len(words)
    found = {
        "n_words": n,
        "word_chars": sum(map(len, words)),
        "n_symbols": sum(c in "#*$%&|<>" for c in text),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(covered),
    }
    found["base_failed"] = n < 20 or 100 * len(covered) > 30 * n
    found["kept"] = not (
        found["base_failed"]
        or not 2 <= found["word_chars"] / n <= 12
        or found["n_symbols"] / n > 0.1
        or sum(w in stop for w in words) / n < 0.03
        or (lines and found["n_dup_lines"] / len(lines) > 0.5)
    )
    return found


MORE = [
    (200, "the of and " * 30),
    (201, "The quick brown fox and the lazy dog of the house " + " ".join(f"w{i}" for i in range(60))),
    (202, " ".join(f"the w{i}###" for i in range(40))),
    (203, "same line of the text\n" * 10),
    (204, "a b c d e f g h i j k l m n o p q r s t\n\n \na b c d e f g h x y z"),
    (205, "<<>>|&"),
    (206, " ".join(f"the w{i}" for i in range(40)) + "\nx\nx\n"),
]


def test_equals_plain_counting(spark):
    docs = edge_docs(spark, MORE)
    judged, name = quality.judge(docs)
    assert name == "quality_" and judged.columns == [*docs.columns, name]
    kept = 0
    for row in judged.collect():
        want = plain_quality(row["text"])
        assert {k: row[name][k] for k in want} == want, (row["doc_id"], str(row["text"])[:60])
        kept += want["kept"]
    assert kept >= 2


def test_keep_returns_own_columns(spark):
    docs = edge_docs(spark, MORE)
    assert quality.keep(docs).columns == docs.columns


def test_empty_table(spark):
    assert quality.judge(empty_docs(spark))[0].count() == 0
