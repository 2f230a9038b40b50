"""Cross-tokenizer alignment by products of token-byte incidence matrices.

Tokenizer A is byte-level, B a piece model. Each spells the same bytes, a blank and the text. A
token-byte incidence matrix has a row per token and a column per byte; in compressed rows
(``Csr``) it is the token's byte range. Gustavson's row-wise product A times B transposed has an
entry wherever two tokens overlap, whose value is the number of bytes they share. Byte offsets
where tokens of both end cut the text into groups; the product of the two token-group
matrices links all tokens of a group.

Neither tokenizer joins anything across the blank that begins a word, but for some runs of
white space, so both matrices are block-diagonal: each distinct block (``CHUNK``) is tokenized
and multiplied once, and a document is the row of its blocks. A document with a block that a
tokenizer does not spell byte by byte is aligned whole. How often two ids are linked in the
corpus is looked up by blocks of documents (``exchange``).
"""

from __future__ import annotations

import ctypes
import hashlib
import json
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructType

from samesense.llm import exchange
from samesense.llm.words import fresh
from samesense.storage import store

MARK = "▁"
# A block begins at a run of blanks. After other white space, and before more than one blank or a
# blank before white space, the byte tokenizer may join over the boundary, so the block goes on.
CHUNK = re.compile(r" +[^ ]*(?:(?<=\s)(?! \S) +[^ ]*)*")
# Entries and bytes of a worker's table of blocks before it is thinned out to the half used most.
TABLE_ENTRIES = 75_000
TABLE_BYTES = 16 << 20
# Texts that share a list of linked ids. A worker holds the blocks of that much text beside its table.
TEXT_BYTES = 1 << 20
# Blocks that are read at a time, in written bytes.
GROUP_BYTES = 1 << 20
# Texts whose blocks are looked up, and blocks that are aligned, at a time.
SLICE_CHARACTERS = 1 << 20
LEARN = 20_000
# Fixed value: how a byte-level vocabulary of this kind cuts a text before it is merged.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# Pairs of ids that are sent to the tasks as a whole: 64 MB.
LOOKUP_PAIRS = 4 << 20
# Entries of a product that are expanded at a time.
EXPAND = 1 << 20

ALIGNED = (
    StructType()
    .add("n_a", LongType())
    .add("n_b", LongType())
    .add("n_groups", LongType())
    .add("n_links", LongType())
    .add("n_best", LongType())
    .add("count_sum", LongType())
    .add("groups_sha256", StringType())
    .add("n_group_links", LongType())
)


@dataclass(frozen=True)
class Csr:
    """Sparse rows: the columns of row ``r`` are ``columns[starts[r]:starts[r + 1]]``."""

    starts: np.ndarray
    columns: np.ndarray
    values: np.ndarray

    def row_sizes(self) -> np.ndarray:
        return np.diff(self.starts)


def ranges(lengths: np.ndarray) -> Csr:
    """Incidence of consecutive ranges: row ``r`` holds the next ``lengths[r]`` columns."""
    starts = np.concatenate([[0], np.cumsum(lengths)])
    return Csr(starts, np.arange(starts[-1]), np.ones(starts[-1], "int64"))


def one_each(columns: np.ndarray) -> Csr:
    """Incidence with one column per row."""
    return Csr(np.arange(len(columns) + 1), columns, np.ones(len(columns), "int64"))


def transposed(matrix: Csr, columns: int) -> Csr:
    order = np.argsort(matrix.columns, kind="stable")
    rows = np.repeat(np.arange(len(matrix.starts) - 1), matrix.row_sizes())
    starts = np.concatenate([[0], np.cumsum(np.bincount(matrix.columns, minlength=columns))])
    return Csr(starts, rows[order], matrix.values[order])


def product_sizes(left: Csr, right: Csr) -> np.ndarray:
    """Entries that each row of the product is made of, before equal columns are added up."""
    sizes = np.concatenate([[0], np.cumsum(right.row_sizes()[left.columns])])
    return sizes[left.starts[1:]] - sizes[left.starts[:-1]]


def product(left: Csr, right: Csr, expand: int = EXPAND) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Gustavson's row-wise product, some rows at a time: row, column and value of its entries.

    Row ``r`` is the sum of the rows of ``right`` named by the columns of row ``r`` of ``left``.
    Rows are taken until they expand to ``expand`` entries; entries come in order.
    """
    ends = np.cumsum(product_sizes(left, right))
    rows, low = len(left.starts) - 1, 0
    while low < rows:
        done = ends[low - 1] if low else 0
        high = min(max(int(np.searchsorted(ends, done + expand, "right")), low + 1), rows)
        inner = left.columns[left.starts[low] : left.starts[high]]
        weight = left.values[left.starts[low] : left.starts[high]]
        sizes = right.starts[inner + 1] - right.starts[inner]
        total = int(sizes.sum())
        # place of every expanded entry in the right matrix
        take = np.arange(total) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(right.starts[inner], sizes)
        row = np.repeat(np.repeat(np.arange(low, high), left.row_sizes()[low:high]), sizes)
        column, value = right.columns[take], np.repeat(weight, sizes) * right.values[take]
        # accumulate entries of the same row and column
        order = np.lexsort((column, row)) if np.any((row[1:] == row[:-1]) & (column[1:] < column[:-1])) else slice(None)
        row, column, value = row[order], column[order], value[order]
        first = np.flatnonzero(np.concatenate([[True], (row[1:] != row[:-1]) | (column[1:] != column[:-1])])) if total else np.zeros(0, int)
        yield row[first], column[first], np.add.reduceat(value, first) if total else value
        low = high


def overlap_links(a: np.ndarray, b: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Pairs of tokens, by number, whose byte ranges overlap, and the bytes they share.

    ``a`` and ``b`` are the tokens' lengths in bytes, of the same total.
    """
    return product(ranges(a), transposed(ranges(b), int(b.sum())))


def groups_of(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the group of each token of A and of B."""
    ends_a, ends_b = np.cumsum(a), np.cumsum(b)
    cuts = np.intersect1d(ends_a, ends_b, assume_unique=True)
    return np.searchsorted(cuts, ends_a), np.searchsorted(cuts, ends_b)


def group_links(group_a: np.ndarray, group_b: np.ndarray) -> tuple[Csr, Csr]:
    """The two factors whose product links all tokens of a group."""
    return one_each(group_a), transposed(one_each(group_b), int(max(group_a[-1], group_b[-1])) + 1)


def byte_of_character() -> dict[str, int]:
    """What the characters of a byte-level vocabulary stand for.

    Bytes that print stand for themselves; the others, in order, for the characters from 256 on.
    """
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    found = {chr(b): b for b in plain}
    for i, b in enumerate(sorted(set(range(256)) - set(plain))):
        found[chr(256 + i)] = b
    return found


def byte_encoder(byte_file: str) -> tuple[Callable[[str], list[int]], list[bytes]]:
    """The byte-level tokenizer of a file as a function of a text, and the bytes of its entries.

    Where entries are numbered in the order of their merges, as ranks, ``tiktoken`` gives the same ids
    several times faster; other files are read by ``tokenizers``. Strings of special tokens inside a
    text are plain text for both.
    """
    import tiktoken
    from tokenizers import Tokenizer

    with open(byte_file, encoding="utf-8") as file:
        listed = json.load(file)
    special = {entry["content"] for entry in listed["added_tokens"]}
    vocabulary = listed["model"]["vocab"]
    byte = byte_of_character()
    plain = {piece: i for piece, i in vocabulary.items() if piece not in special}
    known = {**{entry["content"]: entry["id"] for entry in listed["added_tokens"]}, **vocabulary}
    spelled = [b""] * (max(known.values()) + 1)
    for piece, i in known.items():
        spelled[i] = piece.encode() if piece in special else bytes(byte[c] for c in piece)
    merges = ("".join(m if isinstance(m, list) else m.split(" ")) for m in listed["model"]["merges"])
    ranked = all(plain.get(piece) == 256 + i for i, piece in enumerate(merges))
    cut = listed["pre_tokenizer"] or {}
    if ranked and cut.get("type") == "ByteLevel" and cut.get("use_regex") and not cut.get("add_prefix_space") and not listed["normalizer"]:
        ranks = {spelled[i]: i for i in plain.values()}
        encoding = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        return encoding.encode_ordinary, spelled
    tokenizer = Tokenizer.from_file(byte_file)
    tokenizer.encode_special_tokens = True
    return lambda text: tokenizer.encode(text, add_special_tokens=False).ids, spelled


class Pair:
    """The two tokenizers, with the bytes of every entry."""

    def __init__(self, byte_file: str, piece_file: str):
        import sentencepiece

        self.encode_a, self.bytes_a = byte_encoder(byte_file)
        self.b = sentencepiece.SentencePieceProcessor(model_file=piece_file)
        pieces = (self.b.id_to_piece(i) for i in range(self.b.get_piece_size()))
        self.bytes_b = [
            bytes([int(p[3:-1], 16)]) if self.b.is_byte(i) else p.replace(MARK, " ").encode() for i, p in enumerate(pieces)
        ]
        self.blank = self.b.piece_to_id(MARK)

    def ids_a(self, texts: list[str]) -> list[list[int]]:
        return list(map(self.encode_a, texts))

    def ids_b(self, texts: list[str]) -> list[list[int]]:
        """Of texts that begin with the blank the library adds itself; a blank alone is its piece."""
        found = self.b.encode([t[1:] for t in texts], num_threads=1)
        return [ids if ids or len(t) > 1 else [self.blank] for ids, t in zip(found, texts, strict=True)]

    def spelled(self, data: bytes, a: list[int], b: list[int]) -> bool:
        return b"".join([self.bytes_a[i] for i in a]) == data == b"".join([self.bytes_b[i] for i in b])


def shown_groups(a: np.ndarray, b: np.ndarray, group_a: np.ndarray, group_b: np.ndarray) -> tuple[bytes, np.ndarray]:
    """Groups as ``a1,a2|b1;a3|b2,b3;``, and where each begins; every group has tokens of both."""
    order = np.argsort(np.concatenate([2 * group_a, 2 * group_b + 1]), kind="stable")
    side = np.concatenate([2 * group_a, 2 * group_b + 1])[order]
    numbers = list(map(str, np.concatenate([a, b])[order].tolist()))
    following = np.concatenate([side[1:], [-1]])
    ends = np.where(following == side, ",", np.where(following == side + 1, "|", ";"))
    # the side after A's own is B's of the same group; the next group's A is an even number
    ends[(side % 2 == 1) & (following != side)] = ";"
    text = "".join([x for pair in zip(numbers, ends.tolist(), strict=True) for x in pair]).encode()
    sizes = np.fromiter(map(len, numbers), "int64", len(numbers)) + 1
    starts = np.concatenate([[0], np.cumsum(sizes)])
    heads = np.flatnonzero(np.concatenate([[True], side[1:] // 2 != side[:-1] // 2]))
    return text, np.concatenate([starts[heads], [len(text)]])


def _gathered(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Places of consecutive ranges, one range after the other."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - sizes, sizes) + np.repeat(starts, sizes)


class Blocks:
    """Alignments of distinct blocks, numbered as they come, and what a document sums up of them."""

    def __init__(self, byte_file: str, piece_file: str):
        self.pair = Pair(byte_file, piece_file)
        self.lengths_a = np.array([len(x) for x in self.pair.bytes_a])
        self.lengths_b = np.array([len(x) for x in self.pair.bytes_b])
        self.number: dict[str, int] = {}
        self.names: list[str] = []
        self.shown: list[bytes] = []
        # per block: whether it is spelled, A tokens, B tokens, groups, links, group links
        self.figures = np.zeros((0, 6), "int64")
        # per block: first of its links, how many, and in how many documents' blocks it was used
        self.links = np.zeros((0, 3), "int64")
        # links of all blocks: ids of both tokens, and how often
        self.linked = np.zeros((0, 2), "int64")
        self.bytes = 0

    def thin_out(self) -> None:
        """Once the table is full, keep the half that was used most, and of that what was used again."""
        if len(self.names) <= TABLE_ENTRIES and self.bytes <= TABLE_BYTES:
            return
        most = np.argsort(-self.links[:, 2], kind="stable")[: TABLE_ENTRIES // 2]
        kept = self._again(most)
        sizes = self.links[kept, 1]
        take = _gathered(self.links[kept, 0], sizes)
        self.linked = self.linked[take]
        self.figures = self.figures[kept]
        self.links = np.stack([np.cumsum(sizes) - sizes, sizes, self.links[kept, 2]], axis=1)
        self.shown = [self.shown[i] for i in kept.tolist()]
        self.names = [self.names[i] for i in kept.tolist()]
        self.number = {name: i for i, name in enumerate(self.names)}
        self.bytes = sum(map(len, self.shown))

    def _again(self, most: np.ndarray) -> np.ndarray:
        used = np.sort(most[self.links[most, 2] > 1])
        # whole documents have a number for the moment only
        return used[np.array([bool(self.names[i]) for i in used.tolist()], bool)] if len(used) else used

    def learn(self, texts: list[str], known: bool = True) -> int:
        """Align texts, each a blank and more, under new numbers; returns the first."""
        first, n = len(self.shown), len(texts)
        ids_a, ids_b = self.pair.ids_a(texts), self.pair.ids_b(texts)
        good = [self.pair.spelled(t.encode(), a, b) for t, a, b in zip(texts, ids_a, ids_b, strict=True)]
        figures, links = np.zeros((n, 6), "int64"), np.zeros((n, 3), "int64")
        links[:, 0] = len(self.linked)
        shown = [b""] * n
        places = np.flatnonzero(good)
        if len(places):
            # all of them are one block-diagonal pair of matrices
            own_a, own_b = ([ids[i] for i in places.tolist()] for ids in (ids_a, ids_b))
            counts_a, counts_b = (np.fromiter(map(len, own), "int64", len(own)) for own in (own_a, own_b))
            a = np.fromiter(chain.from_iterable(own_a), "int64", int(counts_a.sum()))
            b = np.fromiter(chain.from_iterable(own_b), "int64", int(counts_b.sum()))
            in_a, in_b = np.repeat(places, counts_a), np.repeat(places, counts_b)
            lengths_a, lengths_b = self.lengths_a[a], self.lengths_b[b]
            group_a, group_b = groups_of(lengths_a, lengths_b)
            heads = np.flatnonzero(np.concatenate([[True], group_a[1:] != group_a[:-1]]))
            figures[places, 0] = 1
            figures[places, 1], figures[places, 2] = counts_a, counts_b
            figures[:, 3] = np.bincount(in_a[heads], minlength=n)
            np.add.at(figures[:, 5], in_a, product_sizes(*group_links(group_a, group_b)))
            found = [(in_a[row], a[row] << 32 | b[column]) for row, column, _ in overlap_links(lengths_a, lengths_b)]
            block, pair = (np.concatenate([part[i] for part in found]) for i in range(2))
            figures[:, 4] = np.bincount(block, minlength=n)
            # equal links of a block once
            order = np.lexsort((pair, block))
            block, pair = block[order], pair[order]
            cuts = np.flatnonzero(np.concatenate([[True], (block[1:] != block[:-1]) | (pair[1:] != pair[:-1])]))
            often = np.diff(np.concatenate([cuts, [len(pair)]]))
            links[:, 1] = np.bincount(block[cuts], minlength=n)
            links[:, 0] = len(self.linked) + np.cumsum(links[:, 1]) - links[:, 1]
            self.linked = np.concatenate([self.linked, np.stack([pair[cuts], often], axis=1)])
            text, starts = shown_groups(a, b, group_a, group_b)
            ends = starts[np.cumsum(figures[places, 3])].tolist()
            begin = 0
            for place, end in zip(places.tolist(), ends, strict=True):
                shown[place] = text[begin : end - 1]
                begin = end
        self.figures, self.links = np.concatenate([self.figures, figures]), np.concatenate([self.links, links])
        self.shown.extend(shown)
        self.names.extend(texts if known else [""] * n)
        self.bytes += sum(map(len, texts)) + sum(map(len, shown))
        return first

    def documents(self, texts: list[str]) -> list[np.ndarray]:
        """Numbers of the blocks each text consists of, in order; none if it has no tokens."""
        number, out, low = self.number, [], 0
        while low < len(texts):
            high, size = low, 0
            while high < len(texts) and (high == low or size + len(texts[high]) <= SLICE_CHARACTERS):
                size += len(texts[high])
                high += 1
            rows = [CHUNK.findall(" " + text) if text else [] for text in texts[low:high]]
            missing = [c for c in dict.fromkeys(chain.from_iterable(rows)) if c not in number]
            for begin in range(0, len(missing), LEARN):
                part = missing[begin : begin + LEARN]
                first = self.learn(part)
                number.update(zip(part, range(first, first + len(part)), strict=True))
            for text, row in zip(texts[low:high], rows, strict=True):
                found = np.fromiter(map(number.__getitem__, row), "int32", len(row))
                if not self.figures[found, 0].all():
                    # a block is not spelled: look at the text as a whole
                    whole = self.learn([" " + text], known=False)
                    found = np.array([whole][: self.figures[whole, 0]], "int32")
                out.append(found)
            low = high
        return out


_WORKER: dict[tuple[str, str], Blocks] = {}


def worker_blocks(byte_file: str, piece_file: str) -> Blocks:
    """The table of this Python worker; it outlives a task, and is thinned out when full."""
    key = (byte_file, piece_file)
    if key not in _WORKER:
        _WORKER[key] = Blocks(byte_file, piece_file)
    return _WORKER[key]


def give_back(tables: bool = False) -> None:
    """Return what this Python worker has freed to the system, with ``tables`` its tables of blocks too."""
    if tables:
        _WORKER.clear()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def align(
    docs: DataFrame, byte_file: str, piece_file: str, text: str = "text", lookup_pairs: int = LOOKUP_PAIRS
) -> tuple[DataFrame, str]:
    """``docs`` without the text, with a struct of the alignment's figures, and the struct's name.

    The counted pairs of ids are sent to the tasks if they are at most ``lookup_pairs``, sixteen bytes
    each; more of them are joined with the blocks' keys. The results are the same.

    ``n_links`` counts overlapping tokens, ``n_best`` those whose pair of ids is linked as often in
    the corpus as any pair of its B id, ``count_sum`` how often their pairs are linked, summed;
    ``groups_sha256`` hashes the groups, ``n_group_links`` counts the links inside groups. A null or
    empty text, and one that a tokenizer does not spell byte by byte, has zeros and an empty
    hash. Repeated rows count each; an empty table gives an empty table; a name clash is
    avoided. Any length of text is taken whole.
    """
    name = fresh(docs, "aligned")
    row_kind = StructType([f for f in docs.schema.fields if f.name != text])
    ints = ArrayType(IntegerType(), False)
    per_doc = StructType()
    for figure in ("n_a", "n_b", "n_groups", "n_links", "n_group_links"):
        per_doc = per_doc.add(figure, LongType())
    per_doc = per_doc.add("groups_sha256", StringType()).add("own", ints).add("times", ints)
    per_key = StructType().add("pair", LongType()).add("n", LongType())
    # blocks of the documents as rows of links: start of each, place of the pair, how often
    per_block = StructType().add("starts", ints).add("places", ints).add("often", ints)

    def start():
        blocks = worker_blocks(byte_file, piece_file)

        def work(batch, texts):
            blocks.thin_out()
            give_back()
            documents = blocks.documents([data.decode() for data in texts])
            hashes = [
                hashlib.sha256(b";".join([blocks.shown[i] for i in own])).hexdigest() if len(own) else ""
                for own in map(np.ndarray.tolist, documents)
            ]
            at = np.repeat(np.arange(len(documents)), [len(d) for d in documents])
            every = np.concatenate(documents)
            sums = []
            for figure in range(1, 6):
                total = np.zeros(len(documents), "int64")
                np.add.at(total, at, blocks.figures[every, figure])
                sums.append(total)
            counted = [np.unique(d, return_counts=True) for d in documents]
            used, place = np.unique(np.concatenate([c[0] for c in counted]), return_inverse=True)
            times = np.concatenate([c[1] for c in counted])
            offsets = pa.array(np.concatenate([[0], np.cumsum([len(c[0]) for c in counted])]), pa.int32())
            lists = [pa.ListArray.from_arrays(offsets, pa.array(x, pa.int32())) for x in (place, times)]
            blocks.links[used, 2] += 1
            sizes = blocks.links[used, 1]
            linked = blocks.linked[_gathered(blocks.links[used, 0], sizes)]
            often, starts = linked[:, 1], np.concatenate([[0], np.cumsum(sizes)])
            pairs, places = np.unique(linked[:, 0], return_inverse=True)
            in_block = np.zeros(len(used), "int64")
            np.add.at(in_block, place, times)
            n = np.zeros(len(pairs), "int64")
            np.add.at(n, places, often * np.repeat(in_block, sizes))
            whole = lambda x: pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), pa.array(x, pa.int32()))
            per_doc = dict(zip(("n_a", "n_b", "n_groups", "n_links", "n_group_links"), map(pa.array, sums), strict=True))
            return (
                {**per_doc, "groups_sha256": pa.array(hashes, pa.string()), "own": lists[0], "times": lists[1]},
                {"pair": pa.array(pairs, pa.int64()), "n": pa.array(n)},
                {"starts": whole(starts), "places": whole(places), "often": whole(often)},
            )

        return work

    blocks = exchange.write_blocks(docs, text, start, per_doc, per_key, per_block, "aligned-blocks", TEXT_BYTES, GROUP_BYTES)
    pairs = store(exchange.keys_of(blocks).groupBy("pair").agg(F.sum("n").alias("n")), "id-pairs")
    b = F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF))
    best = pairs.groupBy(b.alias("b")).agg(F.max("n").alias("most"))
    table = store(pairs.withColumn("b", b).join(best, "b").select("pair", F.col("n").alias("total"), (F.col("n") == F.col("most")).alias("best")), "pair-counts")
    few = pairs.count() <= lookup_pairs
    if few:
        # pairs in order, and their totals with the mark of the best in the lowest bit
        known = table.select("pair", (2 * F.col("total") + F.col("best").cast("bigint")).alias("marked")).toArrow()
        order = np.argsort(known["pair"].to_numpy())
        shared = docs.sparkSession.sparkContext.broadcast((known["pair"].to_numpy()[order], known["marked"].to_numpy()[order]))
        answers = blocks
    else:
        answers = exchange.answered(blocks, table, "pair", [F.col("total"), F.col("best")])

    def work(block, found):
        if _WORKER:
            # another task of this worker left them
            give_back(tables=True)
        if few and len(block["keys"].values):
            listed, marked = shared.value
            mine = marked[np.searchsorted(listed, block["keys"].values.field("pair").to_numpy())]
            found = [pa.array(mine >> 1), pa.array(mine & 1)]
        docs = block["docs"]
        rows = len(docs)
        starts, places, often = (block[c].values.to_numpy() for c in ("starts", "places", "often"))
        own, times = docs.field("own").flatten().to_numpy(), docs.field("times").flatten().to_numpy().astype("int64")
        at = np.repeat(np.arange(rows), np.diff(docs.field("own").offsets.to_numpy()))
        made = {f: docs.field(f) for f in ("n_a", "n_b", "n_groups", "n_links")}
        for figure, place in (("n_best", 1), ("count_sum", 0)):
            total = np.zeros(rows, "int64")
            if found:
                value = found[place].to_numpy(zero_copy_only=False).astype("int64")
                summed = np.concatenate([[0], np.cumsum(often * value[places])])
                np.add.at(total, at, (summed[starts[1:]] - summed[starts[:-1]])[own] * times)
            made[figure] = pa.array(total)
        made["groups_sha256"], made["n_group_links"] = docs.field("groups_sha256"), docs.field("n_group_links")
        return made

    return exchange.finish(answers, row_kind, name, ALIGNED, work), name
