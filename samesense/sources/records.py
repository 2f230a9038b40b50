"""Files whose records cross line ends, read in splits like any other file.

A line end inside quotes does not end a record, and whether a split begins inside quotes depends
on all that stands before it. Two passes over the lines settle that. The first counts, per
split, the lines with an odd number of quotes; a prefix scan over these counts, one number per
split, tells which splits begin inside a record and where it began. In the second every
split cuts its own lines into records. Only the pieces of records that cross a split,
two per split at most, are shuffled and put together.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PIECE = "row_id bigint, record string, piece_of bigint, at bigint"


@dataclass(frozen=True)
class Split:
    """What the prefix scan knows of a split: its place, how it begins, and whose record it goes on with."""

    rank: int
    opened: bool
    goes_on: int


def _lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path, lineSep="\n").select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), "value"
    )


def _segments(batch: pa.RecordBatch) -> Iterator[tuple[tuple[str, int], pa.Array]]:
    """Runs of lines of one split."""
    start = batch.column(1).to_numpy()
    file = batch.column(0)
    if not batch.num_rows:
        return
    change = start[1:] != start[:-1]
    if batch.num_rows > 1:
        change = change | pc.not_equal(file.slice(1), file.slice(0, batch.num_rows - 1)).to_numpy(zero_copy_only=False)
    cuts = [0, *(np.flatnonzero(change) + 1).tolist(), batch.num_rows]
    for low, high in zip(cuts, cuts[1:], strict=False):
        yield (file[low].as_py(), int(start[low])), batch.column(2).slice(low, high - low)


def _odd(values: pa.Array) -> np.ndarray:
    return pc.count_substring(values, '"').to_numpy(zero_copy_only=False) % 2 == 1


def quote_scan(spark: SparkSession, path: str) -> dict[tuple[str, int], Split] | None:
    """How each split of the files begins; None if a file ends inside quotes.

    One row per split comes to the driver, which has listed the splits to plan the scan anyway.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple[str, int], int] = {}
        for batch in batches:
            for place, values in _segments(batch):
                found[place] = found.get(place, 0) + int(_odd(values).sum())
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([p[0] for p in found], pa.string()),
                pa.array([p[1] for p in found], pa.int64()),
                pa.array(list(found.values()), pa.int64()),
            ],
            ["file", "start", "odd"],
        )

    scanned = _lines(spark, path).mapInArrow(run, "file string, start bigint, odd bigint").collect()
    splits: dict[tuple[str, int], Split] = {}
    file, opened, began = None, False, -1
    for rank, row in enumerate(sorted(scanned, key=lambda r: (r["file"], r["start"]))):
        if row["file"] != file:
            if opened:
                return None
            file, began = row["file"], -1
        splits[row["file"], row["start"]] = Split(rank, opened, began)
        ends_open = opened != (row["odd"] % 2 == 1)
        if ends_open and (not opened or row["odd"]):
            began = rank
        opened = ends_open
    return None if opened else splits


def csv_records(spark: SparkSession, path: str) -> DataFrame | None:
    """Records of CSV files in file order, without their headers: ``row_id, record``.

    A record is the text from its first line to the line that closes its last quote; empty lines
    between records are none. The id is the rank of the split a record begins in, and its number there.
    None if a file ends inside quotes, so that its line ends cannot be told apart.
    """
    splits = quote_scan(spark, path)
    if splits is None:
        return None
    shared = spark.sparkContext.broadcast(splits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        place = split = None
        held: list[str] = []
        number = first = 0
        opened = head = False

        def made(rows: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True)) if rows else [[], [], [], []]
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["row_id", "record", "piece_of", "at"])

        def left() -> list[tuple]:
            """What the end of a split leaves open."""
            if not opened or not held:
                return []
            text = "\n".join(held)
            return [(None, text, split.goes_on, split.rank)] if head else [(split.rank << 33 | first, text, split.rank, split.rank)]

        for batch in batches:
            rows: list[tuple] = []
            for where, values in _segments(batch):
                if where != place:
                    rows += left()
                    place, split = where, known[where]
                    # the header is the first record of its file
                    number, held = -1 if where[1] == 0 else 0, []
                    opened = head = split.opened
                lines = values.to_pylist()
                low = 0

                def alone(upto: int) -> None:
                    nonlocal number
                    for line in lines[low:upto]:
                        line = line.removesuffix("\r")
                        if line:
                            if number >= 0:
                                rows.append((split.rank << 33 | number, line, None, None))
                            number += 1

                for i in np.flatnonzero(_odd(values)).tolist():
                    if opened:
                        held += lines[low : i + 1]
                        text = "\n".join(held).removesuffix("\r")
                        if head:
                            rows.append((None, text, split.goes_on, split.rank))
                        elif first >= 0:
                            rows.append((split.rank << 33 | first, text, None, None))
                        opened = head = False
                        held = []
                    else:
                        alone(i)
                        held, opened, first = [lines[i]], True, number
                        number += 1
                    low = i + 1
                if opened:
                    held += lines[low:]
                else:
                    alone(len(lines))
            yield made(rows)
        yield made(left())

    pieces = _lines(spark, path).mapInArrow(run, PIECE)
    whole = pieces.where("piece_of IS NULL").select("row_id", "record")
    crossing = (
        pieces.where("piece_of IS NOT NULL")
        .groupBy("piece_of")
        .agg(F.max("row_id").alias("row_id"), F.sort_array(F.collect_list(F.struct("at", "record"))).alias("parts"))
        # a header that crosses a split has a negative number
        .where("row_id >= 0")
        .select("row_id", F.array_join("parts.record", "\n").alias("record"))
    )
    return whole.unionByName(crossing)
