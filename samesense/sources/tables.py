"""Reading and writing the tables of a run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from samesense.sources.records import csv_records
from samesense.storage import discard, exists, store

# Folders that an updated table is spread over.
BUCKETS = 64
# Records that one task writes.
FILE_ROWS = 100_000

# The types of the columns a run writes; every other column is text.
KNOWN_TYPES = {
    "row_id": "bigint",
    "cluster_id": "int",
    "first_seen_in_round": "int",
    "is_duplicate": "boolean",
    "should_remove": "boolean",
    "keep": "boolean",
}


def _typed(raw: DataFrame, *kept: str) -> DataFrame:
    """Empty cells as nulls, and the columns a run writes in their types."""
    cell = lambda c: F.nullif(F.col(f"`{c}`"), F.lit("")).cast(KNOWN_TYPES.get(c, "string")).alias(c)
    return raw.select(*kept, *[cell(c) for c in raw.columns if c not in kept])


def read_csv(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """CSV with a header; columns come by name, empty cells are null.

    ``multi_line`` allows line breaks inside quotes, at the price of one task per file. Cells
    with line breaks would be cut without it, so it is on; turn it off for files that have
    none, which Spark then splits. ``read_csv_in_splits`` reads large files of either kind.
    """
    raw = spark.read.csv(
        path, header=True, inferSchema=False, quote='"', escape='"', multiLine=multi_line
    )
    return _typed(raw)


def read_csv_in_splits(spark: SparkSession, path: str) -> DataFrame | None:
    """As ``read_csv``, with ``row_id`` in file order, and many tasks per file.

    Line breaks inside quotes are found by a scan over the files' quotes. That takes quotes to
    stand around cells, or doubled inside them; None if a file ends inside quotes. Line ends inside
    cells stay as they are.
    """
    records = csv_records(spark, path)
    if records is None:
        return None
    names = spark.read.csv(path, header=True, quote='"', escape='"', multiLine=True).columns
    kind = ", ".join("`" + c.replace("`", "``") + "` string" for c in names)
    cells = F.from_csv("record", kind, {"quote": '"', "escape": '"', "multiLine": "true"})
    parsed = records.select(F.col("row_id").alias("_row"), cells.alias("_cells"))
    columns = [F.col(f"_cells.`{c}`").alias(c) for c in names if c != "row_id"]
    return _typed(parsed.select(F.col("_row").alias("row_id"), *columns), "row_id")


def with_row_ids(df: DataFrame) -> DataFrame:
    """Give rows a ``row_id`` in file order and fix it by writing the table once.

    The id of a row is its position inside its input split, offset by the rank of the
    split (file name, then offset). An id that is worked out anew in each job could
    differ from job to job, hence the stored table.
    """
    columns = df.columns
    tagged = df.select(
        *columns,
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_start"),
        F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("_at"),
    )
    tagged = store(tagged, "numbered")
    # one row per input split, so this ranking is a small one
    order = (
        tagged.select("_file", "_start")
        .distinct()
        .withColumn("_rank", F.rank().over(Window.orderBy("_file", "_start")) - 1)
    )
    return tagged.join(order, ["_file", "_start"]).select(
        F.shiftleft(F.col("_rank").cast("bigint"), 33).bitwiseOR(F.col("_at")).alias("row_id"), *columns
    )


def read_attributes(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """A data dictionary: ``row_id, attribute_name, attribute_definition`` and the rest.

    With ``multi_line`` cells may hold line breaks, and files are read in splits all the same; only
    files whose quotes do not match are read whole, one task each.
    """
    rows = read_csv_in_splits(spark, path) if multi_line else None
    raw = read_csv(spark, path, multi_line) if rows is None else rows
    missing = {"attribute_name", "attribute_definition"} - set(raw.columns)
    if missing:
        raise ValueError(f"missing columns: {sorted(missing)}")
    return with_row_ids(raw) if rows is None else rows


def read_json(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """JSON documents, one per file (list or object)."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.json(path, multiLine=True)


def read_json_lines(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    return spark.read.schema(schema).json(path)


def read_text(spark: SparkSession, path: str) -> DataFrame:
    """Each file as one value."""
    return spark.read.text(path, wholetext=True)


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """CSV with a header in each part; text is written as it is, blanks at its ends too."""
    df.write.mode(mode).csv(
        path,
        header=True,
        quote='"',
        escape='"',
        emptyValue="",
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
    )


def append_csv(df: DataFrame, path: str) -> None:
    write_csv(df, path, "append")


def write_json(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """JSON lines; null fields are written too."""
    df.write.mode(mode).option("ignoreNullFields", "false").json(path)


def append_json(df: DataFrame, path: str) -> None:
    """Add records to a JSON list."""
    write_json(df, path, "append")


def write_text(df: DataFrame, path: str, column: str = "value", mode: str = "errorifexists") -> None:
    df.select(F.col(column).alias("value")).write.mode(mode).text(path)


def append_text(df: DataFrame, path: str, column: str = "value") -> None:
    write_text(df, path, column, "append")


def write_parquet(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).parquet(path)


def merge_keys(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Update a keyed table: new keys are added, the new value of an old key wins."""
    if sorted(old.columns) != sorted(new.columns):
        raise ValueError("only tables with the same columns can be merged")
    rest = [c for c in old.columns if c != key]
    both = old.withColumn("_seq", F.lit(0)).unionByName(new.withColumn("_seq", F.lit(1)))
    newest = F.max_by(F.struct(*rest), F.col("_seq"))
    return both.groupBy(key).agg(newest.alias("_v")).select(key, "_v.*")


def upsert(new: DataFrame, path: str, key: str, buckets: int = BUCKETS) -> int:
    """Update a keyed table at ``path``: new keys are added, the new value of an old key wins.

    The table is spread over folders by the hash of the key. Only folders that hold a key of
    ``new`` are read, merged and replaced; files of all others stay as they are. Returns the number of
    folders replaced. The number of ``buckets`` is fixed by the first write. Of a key that ``new`` holds
    several times some row wins; a null key is a key like any other.
    """
    spark = new.sparkSession
    if exists(spark, path):
        held = spark.read.parquet(path)
        sizes = held.select("_buckets").limit(1).collect()
        buckets = sizes[0][0] if sizes else buckets
    else:
        held = None
    placed = store(
        new.withColumn("_bucket", F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")).withColumn("_buckets", F.lit(buckets)), "updates"
    )
    touched = [row[0] for row in placed.select("_bucket").distinct().collect()]
    if held is None:
        merged = placed.groupBy(key).agg(F.max_by(F.struct(*[c for c in placed.columns if c != key]), F.lit(0)).alias("_v"))
        merged = merged.select(key, "_v.*")
    else:
        if sorted(held.columns) != sorted(placed.columns):
            raise ValueError("only tables with the same columns can be merged")
        merged = merge_keys(held.where(F.col("_bucket").isin(touched)), placed, key)
    # written apart first: a table cannot be replaced while it is read
    merged = store(merged, "merged")
    merged.repartition("_bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
        "_bucket"
    ).parquet(path)
    for table in (placed, merged):
        discard(table)
    return len(touched)


def read_upserted(spark: SparkSession, path: str) -> DataFrame:
    """A table that ``upsert`` wrote, without its marks."""
    return spark.read.parquet(path).drop("_bucket", "_buckets")


def merge_maps(old, new):
    """Update a map column by another one: the value of ``new`` wins."""
    kept = F.map_filter(old, lambda k, _: ~F.map_contains_key(new, k))
    return F.map_concat(kept, new)


def write_embeddings(df: DataFrame, path: str, vector: str = "embedding") -> None:
    """Vectors with the id of their row."""
    write_parquet(df.select("row_id", vector), path)


def write_blocks(rows: DataFrame, sizes: DataFrame, metrics: DataFrame, folder: str) -> None:
    """Rows with cluster, cluster sizes, and the figures of the fit."""
    write_csv(rows, f"{folder}/attributes_with_clusters")
    write_csv(sizes, f"{folder}/cluster_statistics")
    write_json(metrics, f"{folder}/clustering_results")


def write_verdicts(records: DataFrame, best: DataFrame, folder: str) -> None:
    """Verdicts by cluster and the best names by group.

    The records are counted and dealt out by ranges of clusters, ``FILE_ROWS`` to a task: a cluster is one
    file, or as many as its own records ask for, whatever the number of tasks before.
    """
    records = store(records, "records")
    tasks = max(1, -(-records.count() // FILE_ROWS))
    # a large cluster is cut inside, by its texts
    dealt = records.repartitionByRange(tasks, "cluster_id", F.xxhash64(F.to_json(F.struct(*records.columns))))
    dealt.write.partitionBy("cluster_id").option("ignoreNullFields", "false").json(f"{folder}/duplicates")
    discard(records)
    write_json(best, f"{folder}/best_attributes")


def write_run(result: DataFrame, run_id: str, folder: str) -> None:
    """Keep the result of a run under its id and replace the latest result.

    A run written again replaces its own rows; other runs stay.
    """
    result.withColumn("run_id", F.lit(run_id)).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic"
    ).partitionBy("run_id").parquet(f"{folder}/runs")
    write_csv(result, f"{folder}/latest_deduplication_results", "overwrite")


def run_metadata(
    summary: DataFrame,
    run_id: str,
    input_file: str,
    incremental: bool,
    previous_results: str | None,
    config: dict[str, str],
    seconds: float,
) -> DataFrame:
    """One row that describes a run."""
    pairs = [item for pair in config.items() for item in pair]
    return summary.select(
        F.lit(run_id).alias("run_id"),
        F.lit(input_file).alias("input_file"),
        F.lit(incremental).alias("incremental"),
        F.lit(previous_results).cast("string").alias("previous_results"),
        F.create_map(*[F.lit(str(p)) for p in pairs]).alias("config")
        if pairs
        else F.create_map().cast("map<string,string>").alias("config"),
        F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss").alias("timestamp"),
        F.struct(*summary.columns).alias("stats"),
        F.lit(float(seconds)).alias("processing_time_seconds"),
    )


def write_metadata(metadata: DataFrame, folder: str) -> None:
    """Run metadata and its figures alone."""
    write_json(metadata, f"{folder}/run_metadata")
    write_json(metadata.select("stats.*"), f"{folder}/deduplication_summary")
