"""Sources and sinks: each query writes a given table and reads it back."""

from __future__ import annotations

from pyspark.sql import functions as F

from samesense.catalog.base import CENTERS, DICT, JUDGED, dictionary, judged, query, table, vectors
from samesense.operators import blocks as B
from samesense.operators import rows as R
from samesense.operators.model import reply_archive
from samesense.operators.report import run_summary
from samesense.operators.verdicts import verdict_records
from samesense.sources import tables as S
from samesense.storage import fresh_path

DOCS = "SELECT lang || '_' || doc_id AS attribute_name, text AS attribute_definition FROM documents"


def _docs(spark, sf):
    return table(spark, sf, "documents").select(
        F.concat_ws("_", "lang", "doc_id").alias("attribute_name"),
        F.col("text").alias("attribute_definition"),
    )


@query("io1_read_attributes", DOCS)
def io1(spark, sf):
    path = fresh_path(spark, "attributes")
    S.write_csv(_docs(spark, sf), path)
    return S.read_attributes(spark, path).drop("row_id")


@query("io1_row_ids", "SELECT count(*) AS n_rows, count(*) AS n_ids, true AS in_order FROM part")
def io1_ids(spark, sf):
    """Row ids are unique and follow the order of the file."""
    path = fresh_path(spark, "ordered")
    wide = dictionary(spark, sf).withColumn("key", F.col("row_id"))
    S.write_csv(wide.drop("row_id").repartitionByRange(4, "key").sortWithinPartitions("key"), path)
    read = S.read_attributes(spark, path, multi_line=False).withColumn("key", F.col("key").cast("bigint"))
    by_id = F.expr("lag(key) over (partition by row_id >> 33 order by row_id)")
    return read.withColumn("_before", by_id).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_distinct("row_id").alias("n_ids"),
        F.bool_and(F.col("_before").isNull() | (F.col("_before") < F.col("key"))).alias("in_order"),
    )


EVENTS = "SELECT event_id, event_type, value, props FROM events"


@query("io2_read_json", EVENTS)
def io2(spark, sf):
    path = fresh_path(spark, "events")
    columns = table(spark, sf, "events").select("event_id", "event_type", "value", "props")
    # documents of up to 1000 records each, one to a file, over several lines
    record = F.to_json(F.struct(*columns.columns), {"ignoreNullFields": "false"})
    documents = columns.groupBy(F.expr("event_id div 1000")).agg(F.collect_list(record).alias("all"))
    value = F.concat(F.lit("[\n"), F.array_join("all", ",\n"), F.lit("\n]"))
    documents.select(value.alias("value")).write.option("maxRecordsPerFile", 1).text(path)
    return S.read_json(spark, path, columns.schema)


@query(
    "io3_read_whole_text",
    "SELECT CAST(sum(length(text) + 1) AS BIGINT) AS n_chars FROM conversations",
)
def io3(spark, sf):
    path = fresh_path(spark, "talk")
    S.write_text(table(spark, sf, "conversations"), path, "text")
    return S.read_text(spark, path).agg(F.sum(F.length("value")).alias("n_chars"))


@query("io4_write_csv", f"WITH {JUDGED} SELECT row_id, attribute_name, attribute_definition, is_duplicate, duplicate_group_id, should_remove, source FROM judged")
def io4(spark, sf):
    path = fresh_path(spark, "result")
    columns = ["row_id", "attribute_name", "attribute_definition", "is_duplicate", "duplicate_group_id", "should_remove", "source"]
    S.write_csv(judged(spark, sf).select(*columns), path)
    return S.read_csv(spark, path)


@query("io5_write_json", "SELECT conv_id, turn, role, text FROM conversations")
def io5(spark, sf):
    path = fresh_path(spark, "json")
    talk = table(spark, sf, "conversations")
    S.write_json(talk, path)
    return S.read_json_lines(spark, path, talk.schema)


@query("io6_write_text", "SELECT p_name AS value FROM part")
def io6(spark, sf):
    path = fresh_path(spark, "text")
    S.write_text(table(spark, sf, "part"), path, "p_name")
    return spark.read.text(path)


@query("io7_append_csv", f"WITH {DICT} SELECT attribute_name, attribute_definition FROM dict")
def io7(spark, sf):
    path = fresh_path(spark, "appended")
    rows = dictionary(spark, sf)
    columns = ["attribute_name", "attribute_definition"]
    S.append_csv(rows.where("cluster_id <= 25").select(*columns), path)
    S.append_csv(rows.where("cluster_id > 25").select(*columns), path)
    return S.read_csv(spark, path)


@query("io8_append_json", "SELECT doc_id, quality, toxic FROM labels")
def io8(spark, sf):
    path = fresh_path(spark, "list")
    labels = table(spark, sf, "labels")
    S.append_json(labels.where("quality = 1"), path)
    S.append_json(labels.where("quality <> 1"), path)
    return S.read_json_lines(spark, path, labels.schema)


MERGED = """SELECT p_partkey, CASE WHEN p_size > 20 THEN 'new ' || p_name ELSE p_brand END AS value
       FROM part WHERE p_size <= 30 OR p_size > 20"""


def _old_and_new(spark, sf):
    part = table(spark, sf, "part")
    old = part.where("p_size <= 30").select("p_partkey", F.col("p_brand").alias("value"))
    new = part.where("p_size > 20").select(
        "p_partkey", F.concat(F.lit("new "), "p_name").alias("value")
    )
    return old, new


@query("io9_merge_keys", MERGED)
def io9(spark, sf):
    return S.merge_keys(*_old_and_new(spark, sf), "p_partkey")


@query("io9_upsert", MERGED)
def io9_upsert(spark, sf):
    """The same into a stored table, of which only folders with changed keys are replaced."""
    path = fresh_path(spark, "upserted")
    for rows in _old_and_new(spark, sf):
        S.upsert(rows, path, "p_partkey")
    return S.read_upserted(spark, path)


@query(
    "io9_merge_maps",
    """SELECT p_partkey, p_type AS a, CASE WHEN p_size > 25 THEN p_name ELSE p_brand END AS b,
              CASE WHEN p_size > 25 THEN p_brand END AS c FROM part""",
)
def io9_maps(spark, sf):
    old = F.create_map(F.lit("a"), "p_type", F.lit("b"), "p_brand")
    new = F.when(
        F.col("p_size") > 25, F.create_map(F.lit("b"), "p_name", F.lit("c"), "p_brand")
    ).otherwise(F.create_map().cast("map<string,string>"))
    merged = table(spark, sf, "part").select("p_partkey", S.merge_maps(old, new).alias("m"))
    return merged.select(
        "p_partkey", *[F.try_element_at("m", F.lit(k)).alias(k) for k in ("a", "b", "c")]
    )


@query("io10_append_text", "SELECT p_name AS value FROM part UNION ALL SELECT p_brand FROM part")
def io10(spark, sf):
    path = fresh_path(spark, "log")
    part = table(spark, sf, "part")
    S.append_text(part, path, "p_name")
    S.append_text(part, path, "p_brand")
    return spark.read.text(path)


@query("io11_write_parquet", "SELECT event_id, event_type, value FROM events")
def io11(spark, sf):
    path = fresh_path(spark, "parquet")
    S.write_parquet(table(spark, sf, "events").select("event_id", "event_type", "value"), path)
    return spark.read.parquet(path)


@query(
    "io12_write_embeddings",
    "SELECT vec_id AS row_id, generate_subscripts(embedding, 1) - 1 AS dim, round(CAST(unnest(embedding) AS DOUBLE), 6) + 0.0 AS x FROM embeddings",
)
def io12(spark, sf):
    path = fresh_path(spark, "vectors")
    S.write_embeddings(vectors(spark, sf), path)
    values = spark.read.parquet(path).select("row_id", F.posexplode("embedding").alias("dim", "x"))
    return values.select(
        "row_id", F.col("dim").cast("bigint").alias("dim"), (F.round(F.col("x").cast("double"), 6) + 0.0).alias("x")
    )


@query(
    "io13_write_blocks",
    """SELECT label AS cluster_id, count(*) AS size, count(*) AS listed,
              CAST((SELECT count(DISTINCT label) FROM embeddings) AS BIGINT) AS n_clusters
       FROM embeddings GROUP BY label""",
)
def io13(spark, sf):
    folder = fresh_path(spark, "blocks")
    rows = vectors(spark, sf).select("row_id", "cluster_id")
    figures = rows.agg(F.count_distinct("cluster_id").alias("n_clusters"))
    S.write_blocks(rows, B.cluster_sizes(rows, 10), figures, folder)
    sizes = S.read_csv(spark, f"{folder}/cluster_statistics")
    listed = S.read_csv(spark, f"{folder}/attributes_with_clusters").groupBy("cluster_id").agg(
        F.count(F.lit(1)).alias("listed")
    )
    read = S.read_json_lines(spark, f"{folder}/clustering_results", figures.schema)
    return sizes.join(listed, "cluster_id").select(
        "cluster_id", F.col("size").cast("bigint").alias("size"), "listed",
        read.scalar().alias("n_clusters"),
    )


@query(
    "io14_write_verdicts",
    f"WITH {DICT} SELECT cluster_id, count(*) AS flagged, count(DISTINCT attribute_name) AS names FROM dict GROUP BY cluster_id",
)
def io14(spark, sf):
    folder = fresh_path(spark, "verdicts")
    rows = dictionary(spark, sf)
    reply = F.concat(
        F.lit('{"duplicates": [{"attribute_name": "'),
        "attribute_name",
        F.lit('", "is_duplicate": true, "duplicate_group_id": "group1"}]}'),
    )
    replies = rows.select(
        "cluster_id", F.array("attribute_name").alias("attributes"), reply.alias("response")
    )
    records = verdict_records(replies)
    best = rows.groupBy(F.col("cluster_id").cast("string").alias("group_id")).agg(
        F.min("attribute_name").alias("best_attribute")
    )
    S.write_verdicts(records, best, folder)
    read = S.read_json_lines(spark, f"{folder}/duplicates", records.schema)
    item = F.col("duplicates")[0]
    return read.where(item["is_duplicate"]).groupBy("cluster_id").agg(
        F.count(F.lit(1)).alias("flagged"), F.count_distinct(item["attribute_name"]).alias("names")
    )


@query(
    "io15_write_replies",
    f"WITH {DICT} SELECT regexp_replace('detect ' || attribute_definition, '[^A-Za-z0-9_.-]', '_', 'g') AS context, attribute_name AS response FROM dict",
)
def io15(spark, sf):
    path = fresh_path(spark, "archive")
    replies = dictionary(spark, sf).select(
        F.concat(F.lit("detect "), "attribute_definition").alias("context"),
        F.col("attribute_name").alias("response"),
    )
    S.write_parquet(reply_archive(replies), path)
    return spark.read.parquet(path).where("ts is not null").select("context", "response")


@query(
    "io16_write_run",
    f"""WITH {JUDGED} SELECT run_id, count(*) AS n_rows, count(*) FILTER (should_remove) AS removed
        FROM judged CROSS JOIN (VALUES ('first'), ('second'), ('latest')) r(run_id)
        WHERE run_id <> 'first' OR source = 'existing' GROUP BY run_id""",
)
def io16(spark, sf):
    folder = fresh_path(spark, "runs")
    rows = judged(spark, sf)
    S.write_run(rows, "first", folder)
    S.write_run(R.existing_rows(rows), "first", folder)  # again: replaces the rows of that run
    S.write_run(rows, "second", folder)
    runs = spark.read.parquet(f"{folder}/runs").select("run_id", "should_remove")
    latest = S.read_csv(spark, f"{folder}/latest_deduplication_results").select(
        F.lit("latest").alias("run_id"), "should_remove"
    )
    return runs.unionByName(latest).groupBy("run_id").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if("should_remove").alias("removed")
    )


@query(
    "io17_write_metadata",
    f"""WITH {JUDGED} SELECT 'run1' AS run_id, false AS incremental, count(*) AS total_attributes,
        count(*) FILTER (is_duplicate) AS duplicates_found, count(*) FILTER (should_remove) AS attributes_to_remove FROM judged""",
)
def io17(spark, sf):
    folder = fresh_path(spark, "metadata")
    data = S.run_metadata(
        run_summary(judged(spark, sf)), "run1", "part", False, None, {"max_clusters": "20"}, 1.0
    )
    S.write_metadata(data, folder)
    read = S.read_json_lines(spark, f"{folder}/run_metadata", data.schema)
    return read.select(
        "run_id",
        "incremental",
        "stats.total_attributes",
        "stats.duplicates_found",
        "stats.attributes_to_remove",
    )
