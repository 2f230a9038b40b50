"""SentencePiece encoding and decoding with a distinct-chunk table.

No piece of the vocabulary has a white-space marker after another character, so no merge
crosses the start of a marked word: a text is the row of its marked words, and its ids
are their ids one after the other. A model with such a piece is refused. Distinct marked words
are segmented once per table; a text's ids and its decoded form are put together by position.

The table lives in the task, and is emptied when it is full, so a word is segmented once per task, or
again after that; not once for the whole corpus. One table for the corpus, joined back by position
through a shuffle, does not fit the limits; see the README for measured figures.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructType

from samesense.llm.batches import append
from samesense.llm.words import fresh

MARK = "▁"
TABLE_ENTRIES = 200_000
KIND = StructType().add("ids", ArrayType(IntegerType(), False)).add("decoded", StringType())


def crossing_pieces(model: str) -> list[str]:
    """Pieces that would cross a marked word's start; empty for a model this method fits."""
    import sentencepiece

    processor = sentencepiece.SentencePieceProcessor(model_file=model)
    pieces = (processor.id_to_piece(i) for i in range(processor.get_piece_size()))
    return [piece for piece in pieces if MARK in piece.lstrip(MARK)]


class ChunkTable:
    """Ids and decoded text of each distinct marked word, segmented on first sight."""

    def __init__(self, model: str, entries: int = TABLE_ENTRIES):
        import sentencepiece

        self.processor = sentencepiece.SentencePieceProcessor(model_file=model)
        self.entries = entries
        self.known: dict[str, tuple[bytes, str]] = {}

    def segment(self, chunk: str) -> tuple[bytes, str]:
        # the library puts a marker before what it encodes, and takes one off when it decodes
        rest = chunk[1:]
        ids = self.processor.encode(rest) if rest else [self.processor.piece_to_id(MARK)]
        return np.array(ids, "int32").tobytes(), " " + self.processor.decode(ids)

    def look_up(self, chunks: list[str]) -> list[tuple[bytes, str]]:
        known = self.known
        missing = set(chunks).difference(known)
        if len(known) + len(missing) > self.entries:
            known = self.known = {}
            missing = set(chunks)
        for chunk in missing:
            known[chunk] = self.segment(chunk)
        return [known[chunk] for chunk in chunks]


def encode(docs: DataFrame, model: str, text: str = "text") -> tuple[DataFrame, str]:
    """``docs`` with a struct ``ids, decoded``, and the struct's name.

    Ids are those of the library for the whole text, without begin and end ids; ``decoded``
    is what it decodes them to. A null or empty text has no ids and decodes to the empty
    text. Nothing but the row's own text is looked at: repeated rows get equal results, an
    empty table an empty table, and a name clash is avoided.
    """
    if crossing := crossing_pieces(model):
        raise ValueError(f"{len(crossing)} pieces cross the start of a word, as {crossing[0]!r}; this method does not fit")
    name = fresh(docs, "pieces")
    marked = re.compile(f"{MARK}+[^{MARK}]*")

    def start():
        table = ChunkTable(model)

        def work(texts):
            ids, decoded, offsets = [], [], [0]
            for value in texts:
                found = table.look_up(marked.findall(MARK + value.replace(" ", MARK))) if value else []
                row = b"".join([entry[0] for entry in found])
                ids.append(row)
                offsets.append(offsets[-1] + len(row) // 4)
                decoded.append("".join([entry[1] for entry in found])[1:])
            values = pa.array(np.frombuffer(b"".join(ids), "int32"))
            return pa.StructArray.from_arrays(
                [pa.ListArray.from_arrays(pa.array(offsets, "int32"), values), pa.array(decoded, pa.string())],
                ["ids", "decoded"],
            )

        return work

    return append(docs, text, name, KIND, start), name
