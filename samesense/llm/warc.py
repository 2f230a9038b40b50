"""WARC archives: written by Spark, and read back by verifying the chain of boundaries.

A record's header states its length, so every record names its successor's offset. A
reader that splits files at the magic line finds candidates, some of which stand inside
a payload. From the start of a file the chain of successors reaches exactly the records;
candidates that it passes over are payload.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from samesense.llm import bloom
from samesense.skew import lookup
from samesense.storage import discard, fresh_path, store

# Fixed values of the format.
MAGIC = "WARC/1.1\r\n"
END = "\r\n\r\n"
MAX_ROUNDS = 64
FILTER_BYTES = 32 << 20
# The profile of a record that repeats a payload, and a time that says nothing.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"


def base32_sha1(payload: Column) -> Column:
    """Bare upper-case base32 SHA-1: four groups of 40 bits, eight digits each."""
    digits = F.sha1(payload)
    groups = [
        F.lpad(F.conv(F.substring(digits, 1 + 10 * i, 10), 16, 32), 8, "0") for i in range(4)
    ]
    return F.translate(
        F.concat(*groups), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
    )


def revisits(pages: DataFrame, page_id: str, payload: str, least_bytes: int = 0) -> DataFrame:
    """``pages`` as ``_id, _uri..., _payload`` rows with ``_digest, _bytes, _first``.

    ``_first`` is the smallest id among rows with the same payload, for payloads of at
    least ``least_bytes``. Only payloads that occur more than once take part in the join.
    """
    data = F.encode(F.coalesce(F.col(payload), F.lit("")), "UTF-8")
    rows = pages.withColumn("_bytes", F.octet_length(data).cast("bigint")).withColumn("_digest", base32_sha1(data))
    shared = store(
        rows.where(F.col("_bytes") >= least_bytes)
        .groupBy("_digest", "_bytes")
        .agg(F.min(page_id).alias("_first"), F.count(F.lit(1)).alias("_n"))
        .where("_n > 1")
        .select("_digest", "_bytes", "_first", F.lit(True).alias("_shared")),
        "payloads",
    )
    alone = {"_first": F.lit(None).cast(rows.schema[page_id].dataType), "_shared": F.lit(False)}
    n = shared.count()
    if not n:
        return rows.withColumns(alone)
    # pages that the filter of shared digests does not admit are written without a shuffle
    key = F.xxhash64("_digest")
    level = bloom.build(shared.select(key.alias("key")), n, 0.001, 3, FILTER_BYTES, shrink=True)
    likely = lookup(rows.where(bloom.admits(key, level)), shared, ["_digest", "_bytes"], [page_id, "_digest"])
    other = rows.where(~bloom.admits(key, level)).withColumns(alone)
    return likely.select(*other.columns).unionByName(other)


def write_archive(
    pages: DataFrame, path: str, page_id: str = "page_id", url: str = "url", payload: str = "html", least_bytes: int = 0, date: str = DATE
) -> None:
    """One record per page; files are as many as the result has partitions.

    ``date`` is the time of capture that every record states, in UTC; it is given and not taken from
    the clock, so that a run again writes the same bytes.

    A null payload is empty; a null id or URL leaves its header value empty. Of pages with
    equal payloads those with the smallest id are responses, the others revisits without a
    block; so rows repeated with the smallest id are all responses.
    """
    pages = pages.select(
        F.col(page_id).alias("_id"), F.col(url).cast("string").alias("_uri"), F.col(payload).alias("_payload")
    )
    rows = revisits(pages, "_id", "_payload", least_bytes)
    again = F.coalesce(F.col("_shared"), F.lit(False)) & ~F.col("_first").eqNullSafe(F.col("_id"))
    # a line end inside a URL must not end its header
    uri = F.regexp_replace(F.regexp_replace(F.coalesce("_uri", F.lit("")), "\r", "%0D"), "\n", "%0A")
    name = lambda column: F.concat(F.lit("<urn:page:"), F.coalesce(F.col(column).cast("string"), F.lit("")), F.lit(">"))
    lines = [
        (F.lit("WARC-Type: "), F.when(again, "revisit").otherwise("response")),
        (F.lit("WARC-Record-ID: "), name("_id")),
        (F.lit("WARC-Date: "), F.lit(date)),
        (F.lit("WARC-Profile: "), F.when(again, PROFILE)),
        (F.lit("WARC-Target-URI: "), uri),
        (F.lit("WARC-Payload-Digest: sha1:"), F.col("_digest")),
        (F.lit("WARC-Payload-Length: "), F.col("_bytes").cast("string")),
        (F.lit("WARC-Refers-To: "), F.when(again, name("_first"))),
        (F.lit("Content-Type: "), F.lit("text/html; charset=utf-8")),
        (F.lit("Content-Length: "), F.when(again, "0").otherwise(F.col("_bytes").cast("string"))),
    ]
    header = F.concat(*[F.coalesce(F.concat(label, value, F.lit("\r\n")), F.lit("")) for label, value in lines])
    block = F.when(again, "").otherwise(F.coalesce(F.col("_payload"), F.lit("")))
    record = F.concat(F.lit(MAGIC), header, F.lit("\r\n"), block)
    rows.select(record.alias("value")).write.option("lineSep", END).text(path)


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """What stands between magic lines: ``file, block, number, piece``; number orders a block."""
    return (
        spark.read.option("lineSep", MAGIC)
        .text(path)
        .select(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("number"),
            F.col("value").cast("binary").alias("piece"),
        )
    )


def _field(header: Column, name: str) -> Column:
    found = F.regexp_extract(header, rf"(?:^|\r\n){name}: ([^\r]*)", 1)
    return F.nullif(found, F.lit(""))


def candidates(spark: SparkSession, path: str) -> DataFrame:
    """Every place of the magic line: its offset, header fields, successor and payload digest.

    Offsets are sums of lengths: inside a block of the file by a window over that block's
    candidates, before it by the block totals. Payloads stay in the scanning task.
    """
    text = F.col("piece").cast("string")
    header = F.substring_index(text, END, 1)
    head_bytes = F.octet_length(header)
    rows = (
        _pieces(spark, path)
        .withColumn("size", F.octet_length("piece").cast("bigint"))
        .withColumn("header", F.when(head_bytes < F.octet_length("piece"), header))
        .withColumn("head", F.octet_length("header").cast("bigint") + len(END))
        .withColumn("length", F.expr("try_cast(regexp_extract(header, '(?:^|\\\\r\\\\n)Content-Length: ([0-9]+)(?:\\\\r|$)', 1) AS bigint)"))
        .withColumn("whole", F.coalesce(F.col("size") == F.col("head") + F.col("length") + len(END), F.lit(False)))
        .withColumn("block_digest", F.when(F.col("whole"), base32_sha1(F.expr("substring(piece, int(head) + 1, int(length))"))))
        .withColumn("content", F.xxhash64("piece"))
        .drop("piece")
    )
    before = Window.partitionBy("file", "block").orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    step = F.col("size") + len(MAGIC)
    inside = rows.withColumn("at", F.coalesce(F.sum(step).over(before), F.lit(0).cast("bigint")))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    bases = (
        rows.groupBy("file", "block")
        .agg(F.sum(step).alias("bytes"))
        .select("file", "block", F.coalesce(F.sum("bytes").over(earlier), F.lit(0).cast("bigint")).alias("base"))
    )
    # the first piece of a file stands before its first magic line and is no candidate
    return (
        inside.join(bases, ["file", "block"])
        .withColumn("start", F.col("base") + F.col("at") - len(MAGIC))
        .where("start >= 0")
        .withColumn("next", F.col("start") + len(MAGIC) + F.col("head") + F.col("length") + len(END))
        .drop("number", "at", "base")
    )


def _runs(found: DataFrame) -> DataFrame:
    """Candidates with ``run``: the offset where their run of direct successors begins."""
    order = Window.partitionBy("file", "block").orderBy("start")
    linked = F.coalesce(F.lag("next").over(order) == F.col("start"), F.lit(False))
    begins = found.withColumn("_begin", F.when(~linked, F.col("start")))
    return begins.withColumn("run", F.last("_begin", ignorenulls=True).over(order)).drop("_begin")


def reachable(found: DataFrame) -> DataFrame:
    """Of all candidates those that the chain from the start of their file reaches.

    Tasks first join candidates whose successor is the next one in their block to runs; all
    of a run leads to one exit. Pointer jumping then works on runs alone: in round ``k``
    each known run also reaches the run ``2^k`` exits on, and pointers are squared.
    """
    runs = store(
        found.groupBy("file", "run").agg(F.max_by("next", "start").alias("exit")), "warc-runs"
    )
    entries = found.select("file", F.col("start").alias("exit"), F.col("run").alias("to"))
    jumps = store(
        runs.where("exit IS NOT NULL").join(entries, ["file", "exit"]).select("file", "run", "to", F.col("exit").alias("entry")),
        "warc-jumps",
    )
    reached = store(runs.where("run = 0").select("file", "run", F.lit(0).cast("bigint").alias("entry")), "warc-reached")
    discard(runs)
    for _ in range(MAX_ROUNDS):
        if jumps.isEmpty():
            break
        onward = reached.select("file", "run").join(jumps, ["file", "run"]).select("file", F.col("to").alias("run"), "entry")
        # a chain enters each run once, so rows of a run are equal
        more = store(reached.unionByName(onward).dropDuplicates(["file", "run"]), "warc-reached")
        second = jumps.select("file", F.col("run").alias("to"), F.col("to").alias("_to"), F.col("entry").alias("_entry"))
        squared = store(
            jumps.join(second, ["file", "to"]).select("file", "run", F.col("_to").alias("to"), F.col("_entry").alias("entry")),
            "warc-jumps",
        )
        discard(reached)
        discard(jumps)
        reached, jumps = more, squared
    else:
        raise RuntimeError(f"chains did not end in {MAX_ROUNDS} rounds")
    return found.join(reached.select("file", "run", "entry"), ["file", "run"]).where("start >= entry").drop("entry")


def _payload_digests(spark: SparkSession, path: str, found: DataFrame, broken: DataFrame) -> DataFrame:
    """Digests of payloads that hold the magic line: ``file, start, joined_digest``.

    ``broken`` are reached records cut into pieces. Their pieces are the record's own and
    those of unreached candidates up to the next record; only these are read again.
    """
    order = Window.partitionBy("file").orderBy("start")
    files = broken.select("file").distinct()
    owners = broken.select("file", "start", F.col("next").alias("until"), F.col("head").alias("skip"), F.col("length").alias("take"))
    parts = (
        found.join(files, "file", "left_semi")
        .join(owners, ["file", "start"], "left")
        .withColumn("owner", F.last(F.when(F.col("until").isNotNull(), F.col("start")), ignorenulls=True).over(order))
        .withColumn("end", F.last("until", ignorenulls=True).over(order))
        .where("start < end")
    )
    wanted = parts.select("size", "content").distinct()
    texts = (
        _pieces(spark, path)
        .select("piece", F.octet_length("piece").cast("bigint").alias("size"), F.xxhash64("piece").alias("content"))
        .join(wanted, ["size", "content"], "left_semi")
        .dropDuplicates(["size", "content"])
    )
    joined = (
        parts.join(texts, ["size", "content"])
        .groupBy("file", F.col("owner").alias("start"))
        .agg(
            F.max("skip").alias("skip"),
            F.max("take").alias("take"),
            F.array_sort(F.collect_list(F.struct(F.col("start").alias("at"), "piece"))).alias("all"),
        )
    )
    whole = F.aggregate(
        F.slice("all", 2, F.size("all")),
        F.get("all", F.lit(0))["piece"],
        lambda data, x: F.concat(data, F.lit(MAGIC).cast("binary"), x["piece"]),
    )
    return joined.withColumn("data", whole).select(
        "file", "start", base32_sha1(F.expr("substring(data, int(skip) + 1, int(take))")).alias("joined_digest")
    )


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """Records of all files: ``file, start, record_type, record_id, uri, refers_to, payload_bytes,
    payload_digest, block_bytes, block_digest``.

    ``payload_*`` are the header's statement about the full payload; ``block_digest`` is
    worked out from the bytes. A response whose bytes do not match raises an error. Files
    without a record give no row.
    """
    found = store(_runs(candidates(spark, path)), "warc-candidates")
    records = reachable(found)
    broken = records.where("NOT whole")
    if not broken.isEmpty():
        joined = _payload_digests(spark, path, found, broken)
        records = records.join(joined, ["file", "start"], "left").withColumn(
            "block_digest", F.coalesce("block_digest", "joined_digest")
        )
    header = F.col("header")
    stated = F.regexp_extract(header, r"(?:^|\r\n)WARC-Payload-Digest: sha1:([A-Z2-7]*)", 1)
    kind = _field(header, "WARC-Type")
    checked = F.when(
        (kind == "response") & ~F.col("block_digest").eqNullSafe(stated),
        F.raise_error(F.concat(F.lit("damaged record at "), F.col("start").cast("string"), F.lit(" of "), F.col("file"))),
    ).otherwise(stated)
    return records.select(
        "file",
        "start",
        kind.alias("record_type"),
        F.nullif(F.regexp_extract(header, r"(?:^|\r\n)WARC-Record-ID: <urn:page:([^>]*)>", 1), F.lit("")).alias("record_id"),
        _field(header, "WARC-Target-URI").alias("uri"),
        F.nullif(F.regexp_extract(header, r"(?:^|\r\n)WARC-Refers-To: <urn:page:([^>]*)>", 1), F.lit("")).alias("refers_to"),
        _field(header, "WARC-Payload-Length").cast("bigint").alias("payload_bytes"),
        checked.alias("payload_digest"),
        F.col("length").alias("block_bytes"),
        "block_digest",
    )


def round_trip(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Write ``pages(page_id, url, html)`` to an archive in the shared folder and read it back."""
    spark = pages.sparkSession
    path = fresh_path(spark, "warc")
    write_archive(pages, path, least_bytes=least_bytes)
    return read_archive(spark, path)
