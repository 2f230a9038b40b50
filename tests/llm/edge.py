"""Rows that every operator must take: nulls, empty and long texts, ties, repeats, odd names."""

LONG = " ".join(f"word{i % 977} of the line\n" if i % 9 == 0 else f"word{i % 977}" for i in range(60_000))
PASSAGE = " ".join(f"passage{i}" for i in range(60))

DOCS = [
    (1, "The cat sat on the mat and the dog saw it from the door of the house.\n\nA line."),
    (2, None),
    (3, ""),
    (4, " \t\n \r\n"),
    (5, LONG),
    (6, "x" * 5000),
    (7, "alpha beta"),
    (7, "alpha beta"),
    (None, "a row without an id and of the usual kind"),
    (None, None),
    (8, "Ünïcödé ▁ marks ▁▁ and  spaces   here\u0085   end \U0001f600 \x1c \x00 x"),
    (9, f"before {PASSAGE} after"),
    (10, f"other {PASSAGE} words"),
    (11, "do do do do do do do do do do do do do do do do do do do do do do do do do do"),
    (12, "do do do do do do do do do do do do do do do do"),
]


def edge_docs(spark, more=()):
    """The rows above and ``more``, with extra columns whose names could clash."""
    rows = [(i, t, "clash", 1, 2, 3) for i, t in [*DOCS, *more]]
    return spark.createDataFrame(
        rows, "doc_id bigint, text string, quality string, pieces int, spans int, words int"
    ).repartition(3)


def empty_docs(spark):
    return spark.createDataFrame([], "doc_id bigint, text string")
