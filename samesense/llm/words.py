"""What the text operators share: the word pattern and small column helpers."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: the white space that separates words; anything else is part of a word.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
# The letters that ASCII lower-casing touches.
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it in ``body``."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def whole(text: Column | str) -> Column:
    """A text, with null as the empty text."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def word_list(text: Column) -> Column:
    return F.array_remove(F.split(text, SPACE, -1), "")


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have yet."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


PART_BYTES = 1 << 20
# The bytes that end a word.
BLANKS = b" \t\n\x0b\x0c\r"


def parts(data: bytes, ends: bytes = BLANKS, size: int = PART_BYTES) -> Iterator[bytes]:
    """A text in UTF-8 in parts of about ``size`` bytes, cut only at bytes among ``ends``."""
    low = 0
    while low < len(data):
        high = min(low + size, len(data))
        while high < len(data) and data[high] not in ends:
            high += 1
        yield data[low:high]
        low = high
