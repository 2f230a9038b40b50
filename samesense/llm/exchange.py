"""Look up the keys of texts in a corpus-wide table, without a row per occurrence.

Texts are taken in blocks of some megabytes. A block becomes one row: what its documents
need (numbers that point into the block's list of distinct keys), and that list. Only the
distinct keys of a block are exploded, joined and counted; the answers come back as one array
per block. A key stands in a block once, so no key has more rows than there are blocks.
Blocks are a written table, so a task that runs again reads the same blocks.

A large block is written in parts, rows of some hundred kilobytes that hold a share of its documents and of its
keys. Its answers then come back as rows, and a task holds the answers of one block and one part at a time, however
many blocks it is dealt.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StructType

from samesense.llm.batches import slices
from samesense.storage import store

# Larger blocks have fewer distinct keys in all, and cost a task more memory.
BLOCK_BYTES = 16 << 20
BLOCK_ROWS = 16_384
# Distinct keys that a part of a block holds.
PART_KEYS = 16_384

# Per block: columns per document, columns per distinct key, and other values of the block.
Made = tuple[dict[str, pa.Array], dict[str, pa.Array], dict[str, pa.Array]]


def _one_list(values: pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def _struct(columns: dict[str, pa.Array]) -> pa.StructArray:
    return pa.StructArray.from_arrays(list(columns.values()), list(columns))


def _message(documents: pa.StructArray) -> bytes:
    """Documents as one value, which costs the JVM no work per document."""
    batch = pa.RecordBatch.from_struct_array(documents)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as stream:
        stream.write_batch(batch)
    return sink.getvalue().to_pybytes()


def write_blocks(
    docs: DataFrame,
    text: str,
    start: Callable[[], Callable[[pa.RecordBatch, list[bytes]], Made]],
    per_doc: StructType,
    per_key: StructType,
    per_block: StructType,
    label: str,
    block_bytes: int = BLOCK_BYTES,
    group_bytes: int | None = None,
    part_bytes: int | None = None,
) -> DataFrame:
    """Written rows ``block, docs, keys`` and the block's own values.

    ``docs`` are arrays of structs of the other columns of ``docs`` under ``row``, and those that
    the work adds. ``start()`` runs once per task; its function takes a batch and its texts in
    UTF-8 (null: empty). A reader holds a row group at a time; with ``group_bytes`` one ends
    after the row that fills it, and not after a hundred. With ``part_bytes`` a block is several rows, each with
    documents of that much text, as an Arrow message, and some of the keys, and ``first``, the place of the
    first of them; the block's own values stand in one row and are null in the others.
    """
    others = [f for f in docs.schema.fields if f.name != text]
    row_kind = StructType(others)
    docs_kind = StructType([*per_doc.fields]).add("row", row_kind) if others else per_doc
    docs_kind = ArrayType(docs_kind) if part_bytes is None else BinaryType()
    kind = StructType().add("block", LongType()).add("docs", docs_kind).add("keys", ArrayType(per_key))
    if part_bytes is not None:
        kind = kind.add("first", LongType())
    kind = StructType([*kind.fields, *per_block.fields])
    plain = docs.select(F.coalesce(text, F.lit("")).cast("binary").alias(text), *[F.col(f"`{f.name}`") for f in others])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = start()
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            for low, high in slices(batch.column(0), BLOCK_ROWS, block_bytes):
                part = batch.slice(low, high - low)
                doc, key, own = work(part, part.column(0).to_pylist())
                if others:
                    doc["row"] = _struct({f.name: part.column(i + 1) for i, f in enumerate(others)})
                block, listed, keys = pa.array([number], pa.int64()), _struct(doc), _struct(key)
                number += 1
                if part_bytes is None:
                    yield pa.RecordBatch.from_arrays([block, _one_list(listed), _one_list(keys), *own.values()], [*kind.names[:3], *own])
                    continue
                shares = list(slices(part.column(0), BLOCK_ROWS, part_bytes))
                shares += [(0, 0)] * (-(-len(keys) // PART_KEYS) - len(shares))
                step = -(-len(keys) // len(shares))
                for i, (begin, end) in enumerate(shares):
                    message = _message(listed.slice(begin, end - begin)) if end > begin else None
                    share = [pa.array([message], pa.binary()), _one_list(keys.slice(i * step, step))]
                    values = [v if i == 0 else pa.nulls(1, v.type) for v in own.values()]
                    yield pa.RecordBatch.from_arrays([block, *share, pa.array([i * step], pa.int64()), *values], [*kind.names[:4], *own])

    options = {} if group_bytes is None else {"parquet.block.size": str(group_bytes), "parquet.page.size.row.check.min": "1"}
    return store(plain.mapInArrow(run, kind), label, **options)


def keys_of(blocks: DataFrame) -> DataFrame:
    """One row per block and distinct key: ``block, place`` and the key's columns."""
    if "first" not in blocks.columns:
        return blocks.select("block", F.posexplode("keys").alias("place", "key")).select("block", "place", "key.*")
    place = (F.col("first") + F.col("at")).cast("int").alias("place")
    return blocks.select("block", "first", F.posexplode("keys").alias("at", "key")).select("block", place, "key.*")


def looked_up(blocks: DataFrame, table: DataFrame, key: str, values: list[str]) -> DataFrame:
    """One row per block and distinct key: ``block, place`` and ``values`` of the table, which has all keys."""
    return keys_of(blocks).select("block", "place", key).join(table, key).select("block", "place", *values)


def answered(blocks: DataFrame, table: DataFrame, key: str, values: list[Column]) -> DataFrame:
    """``blocks`` without keys, and ``found``: ``place`` and ``values`` of the table, an array of each.

    The arrays are made by one aggregate, row by row, so they are in the same order; plain arrays take
    half the room of an array of structs.
    """
    asked = keys_of(blocks).select("block", "place", key)
    lists = [F.collect_list(value).alias(f"found_{i}") for i, value in enumerate((F.col("place"), *values))]
    return blocks.drop("keys").join(asked.join(table, key).groupBy("block").agg(*lists), "block", "left")


def finish(
    answers: DataFrame, row_kind: StructType, name: str, kind: StructType, work: Callable[[dict, list], dict[str, pa.Array]]
) -> DataFrame:
    """One row per document again: its columns, and a struct ``name`` that ``work`` makes.

    ``work`` takes a block's columns and, as arrays in the order of the keys, the values found; no keys, or
    blocks that were not ``answered``, no values.
    """
    schema = StructType([*row_kind.fields]).add(name, kind)
    columns = [c for c in answers.columns if not c.startswith("found_")]
    lists = [c for c in answers.columns if c.startswith("found_")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                block = {c: batch.column(c)[i] for c in columns}
                held = [batch.column(c)[i].values for c in lists]
                found = []
                if held and held[0] is not None:
                    order = pa.compute.sort_indices(held[0])
                    found = [values.take(order) for values in held[1:]]
                docs = block["docs"].values
                made = work({**block, "docs": docs}, found)
                rows = docs.field("row") if row_kind.fields else None
                yield pa.RecordBatch.from_arrays(
                    [*([rows.field(f.name) for f in row_kind.fields] if rows is not None else []), _struct(made)], schema.names
                )

    return answers.mapInArrow(run, schema)


def finish_parts(
    blocks: DataFrame, answers: DataFrame, row_kind: StructType, name: str, kind: StructType, work: Callable[[pa.StructArray, dict], dict[str, pa.Array]]
) -> DataFrame:
    """``finish`` for blocks in parts and answers as ``looked_up``.

    ``work`` takes the documents of a part, and by name the values found for the block's keys, in the order of
    the keys; no keys, no values. Of each block, a task reads the answers first.
    """
    schema = StructType([*row_kind.fields]).add(name, kind)
    values = answers.columns[2:]
    # a whole number in one column is sorted without comparing rows
    asked = answers.select(F.shiftleft("block", 1).alias("at"), *answers.columns[1:])
    parts = blocks.where("docs IS NOT NULL").select((F.shiftleft("block", 1) + 1).alias("at"), "docs")
    both = asked.unionByName(parts, allowMissingColumns=True).repartition(F.shiftright("at", 1)).sortWithinPartitions("at")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held, found = None, [], {}
        for batch in batches:
            at = batch.column("at").to_numpy()
            cuts = [0, *(np.flatnonzero(at[1:] != at[:-1]) + 1).tolist(), len(at)]
            for low, high in zip(cuts[:-1], cuts[1:], strict=True):
                if low == high:
                    continue
                rows = batch.slice(low, high - low)
                if at[low] >> 1 != block:
                    block, held, found = at[low] >> 1, [], {}
                if at[low] & 1 == 0:
                    held.append([rows.column(c).to_numpy().copy() for c in ("place", *values)])
                    continue
                if held:
                    place, *listed = (np.concatenate(x) for x in zip(*held, strict=True))
                    order = np.empty(len(place), "int64")
                    order[place] = np.arange(len(place))
                    found, held = {c: x[order] for c, x in zip(values, listed, strict=True)}, []
                for message in rows.column("docs"):
                    docs = pa.ipc.open_stream(message.as_buffer()).read_all().to_struct_array().combine_chunks()
                    kept = [docs.field("row").field(f.name) for f in row_kind.fields]
                    yield pa.RecordBatch.from_arrays([*kept, _struct(work(docs, found))], schema.names)

    return both.mapInArrow(run, schema)
