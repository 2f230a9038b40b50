"""Projections, conversions, filters, joins by id, windows, unions and aggregates."""

from __future__ import annotations

from pyspark.sql import functions as F

from samesense.catalog.base import DICT, JUDGED, dictionary, judged, query, table
from samesense.functions import convert as C
from samesense.functions import text as T
from samesense.operators import rows as R
from samesense.operators import verdicts as V
from samesense.operators.report import run_summary
from samesense.skew import positions


@query(
    "sc1_embedding_text",
    f"WITH {DICT} SELECT row_id, coalesce(attribute_name, 'nan') || ': ' || coalesce(nullif(attribute_definition, ''), 'nan') AS text FROM (SELECT row_id, attribute_name, CASE WHEN row_id % 4 <> 0 THEN attribute_definition END AS attribute_definition FROM dict)",
)
def sc1(spark, sf):
    gap = F.when(F.col("row_id") % 4 != 0, F.col("attribute_definition"))
    return dictionary(spark, sf).select(
        "row_id", T.embedding_text(F.col("attribute_name"), gap).alias("text")
    )


@query(
    "sc2_tag",
    f"WITH {DICT} SELECT row_id, CASE WHEN row_id % 2 = 0 THEN 'existing' ELSE 'new' END AS source, CAST(CASE WHEN row_id % 2 = 0 THEN cluster_id ELSE 2 END AS INTEGER) AS first_seen_in_round FROM dict",
)
def sc2(spark, sf):
    rows = dictionary(spark, sf).withColumn("first_seen_in_round", F.col("cluster_id"))
    old = R.tag(rows.where("row_id % 2 = 0"), R.EXISTING, R.FIRST_ROUND)
    new = R.tag(rows.where("row_id % 2 <> 0"), R.NEW, R.SECOND_ROUND)
    return old.unionByName(new).select("row_id", "source", "first_seen_in_round")


@query(
    "sc3_reset_verdicts",
    f"WITH {JUDGED} SELECT row_id, false AS is_duplicate, CAST(NULL AS VARCHAR) AS duplicate_group_id, false AS should_remove FROM judged",
)
def sc3(spark, sf):
    return R.reset_verdicts(judged(spark, sf)).select(
        "row_id", "is_duplicate", "duplicate_group_id", "should_remove"
    )


@query("sc4_removal_flag", f"WITH {DICT} SELECT row_id, row_id % 3 = 0 AS should_remove FROM dict")
def sc4(spark, sf):
    kept = dictionary(spark, sf).select(
        "row_id", (F.col("row_id") % 3 != 0).alias("keep"), F.lit(1).alias("first_seen_in_round")
    )
    return R.removal_flag(kept, keep_round=False)


@query(
    "sc5_group_key",
    f"WITH {DICT} SELECT row_id, 'cluster_' || cluster_id || '_' || attribute_name AS group_id FROM dict",
)
def sc5(spark, sf):
    return dictionary(spark, sf).select(
        "row_id", T.group_key(F.col("cluster_id"), F.col("attribute_name")).alias("group_id")
    )


@query(
    "sc6_context_name",
    "SELECT doc_id, substr(regexp_replace(text, '[^A-Za-z0-9_.-]', '_', 'g'), 1, 100) AS context, substr(least(lang, source) || '_' || greatest(lang, source), 1, 50) AS label FROM documents",
)
def sc6(spark, sf):
    return table(spark, sf, "documents").select(
        "doc_id",
        T.context_name(F.col("text")).alias("context"),
        T.group_label(F.array("source", "lang")).alias("label"),
    )


@query("sc7_token_estimate", "SELECT doc_id, CAST(length(text) // 4 AS BIGINT) AS tokens FROM documents")
def sc7(spark, sf):
    return table(spark, sf, "documents").select("doc_id", T.token_estimate(F.col("text")).alias("tokens"))


@query(
    "sc8_to_number",
    f"WITH {JUDGED} SELECT row_id, TRY_CAST(first_seen_in_round AS DOUBLE) AS number FROM judged",
)
def sc8(spark, sf):
    return judged(spark, sf).select("row_id", T.to_number(F.col("first_seen_in_round")).alias("number"))


@query(
    "sc9_strip_fence",
    "SELECT p_partkey, trim('```json' || p_name || '```', '`json') AS body FROM part",
)
def sc9(spark, sf):
    return table(spark, sf, "part").select(
        "p_partkey",
        T.strip_fence(F.concat(F.lit("```json"), "p_name", F.lit("```"))).alias("body"),
    )


@query(
    "sc10_response_format",
    """SELECT conv_id, turn, CASE WHEN turn % 5 = 0 THEN 'json_schema'
         WHEN regexp_matches(text || CASE WHEN turn % 3 = 0 THEN ' as Json.' ELSE ' jsons' END, '(?i)\\bJSON\\b') THEN 'json_object'
         ELSE 'text' END AS format FROM conversations""",
)
def sc10(spark, sf):
    prompt = F.concat(
        "text", F.when(F.col("turn") % 3 == 0, F.lit(" as Json.")).otherwise(F.lit(" jsons"))
    )
    schema = F.when(F.col("turn") % 5 == 0, F.lit("{}"))
    return table(spark, sf, "conversations").select(
        "conv_id", "turn", T.response_format(prompt, schema).alias("format")
    )


@query(
    "sc11_chat_messages",
    """SELECT conv_id, turn, CAST(CASE WHEN role = 'user' THEN 1 ELSE 2 END AS BIGINT) AS n_messages,
              CASE WHEN role = 'user' THEN 'user' ELSE 'system' END AS first_role, text AS last_content FROM conversations""",
)
def sc11(spark, sf):
    system = F.when(F.col("role") != "user", F.lit("Be brief."))
    talk = table(spark, sf, "conversations").withColumn(
        "messages", T.chat_messages(F.col("text"), system)
    )
    return talk.select(
        "conv_id",
        "turn",
        F.size("messages").cast("bigint").alias("n_messages"),
        F.col("messages")[0]["role"].alias("first_role"),
        F.element_at("messages", -1)["content"].alias("last_content"),
    )


@query(
    "fc1_rows_to_json",
    "SELECT p_partkey, p_name AS name, CAST(p_size AS BIGINT) AS size FROM part",
)
def fc1(spark, sf):
    part = table(spark, sf, "part").select("p_partkey", "p_name", "p_size")
    record = F.col("record")
    return C.rows_to_json(part, ["p_partkey"]).select(
        "p_partkey",
        F.get_json_object(record, "$.p_name").alias("name"),
        F.get_json_object(record, "$.p_size").cast("bigint").alias("size"),
    )


@query(
    "fc2_json_to_rows",
    """SELECT event_id, CASE WHEN event_id % 3 <> 2 THEN CAST(json_extract(props, '$.k') AS BIGINT) END AS k,
              CASE WHEN event_id % 3 = 2 THEN props || '!{' END AS raw
       FROM events UNION ALL
       SELECT event_id, CAST(NULL AS BIGINT), NULL FROM events WHERE event_id % 3 = 1""",
)
def fc2(spark, sf):
    key = F.col("event_id") % 3
    text = (
        F.when(key == 0, F.col("props"))
        .when(key == 1, F.concat(F.lit("["), "props", F.lit(", {}]")))
        .otherwise(F.concat("props", F.lit("!{")))
    )
    rows = table(spark, sf, "events").select("event_id", text.alias("text"))
    return C.json_to_rows(rows, "text", "struct<k:bigint>").select("event_id", "item.k", "raw")


@query(
    "fc3_map_to_rows",
    """SELECT p_partkey, 'name' AS key, p_name AS value, CAST(2 AS BIGINT) AS n FROM part
       UNION ALL SELECT p_partkey, 'brand', p_brand, 2 FROM part""",
)
def fc3(spark, sf):
    mapped = table(spark, sf, "part").select(
        "p_partkey", F.create_map(F.lit("name"), "p_name", F.lit("brand"), "p_brand").alias("m")
    )
    sized = mapped.withColumn("n", F.size(C.map_to_list(F.col("m"))).cast("bigint"))
    return C.map_to_rows(sized, "m", ["p_partkey", "n"])


@query(
    "fc4_list_to_rows",
    """SELECT p_partkey, CAST(i - 1 AS BIGINT) AS index, w[i] AS item, w[i] AS by_key
       FROM (SELECT p_partkey, string_split(p_name, ' ') AS w FROM part), generate_series(1, len(w)) g(i)""",
)
def fc4(spark, sf):
    words = table(spark, sf, "part").select("p_partkey", F.split("p_name", " ").alias("w"))
    mapped = words.withColumn("m", C.list_to_map(F.col("w")))
    rows = C.list_to_rows(mapped, "w", ["p_partkey", "m"])
    return rows.select(
        "p_partkey",
        F.col("index").cast("bigint").alias("index"),
        "item",
        F.try_element_at("m", F.col("index")).alias("by_key"),
    )


@query(
    "fc5_row_to_list",
    "SELECT p_partkey, p_name || '|' || p_brand || '|' || CAST(p_size AS VARCHAR) AS listed FROM part",
)
def fc5(spark, sf):
    values = C.row_to_list(["p_name", "p_brand", "p_size"])
    return table(spark, sf, "part").select("p_partkey", F.array_join(values, "|").alias("listed"))


@query(
    "fc6_row_to_vector",
    "SELECT p_partkey, CAST(p_size AS DOUBLE) AS first, p_retailprice AS second, CAST(2 AS BIGINT) AS dims FROM part",
)
def fc6(spark, sf):
    rows = table(spark, sf, "part").select("p_partkey", C.row_to_vector(["p_size", "p_retailprice"]).alias("v"))
    return rows.select(
        "p_partkey", F.col("v")[0].alias("first"), F.col("v")[1].alias("second"), F.size("v").cast("bigint").alias("dims")
    )


@query(
    "fc7_value_to_json",
    """SELECT p_partkey, '{"name":"' || p_name || '","tags":["' || p_brand || '","' || p_type || '"]}' AS json FROM part""",
)
def fc7(spark, sf):
    nested = F.struct(F.col("p_name").alias("name"), F.array("p_brand", "p_type").alias("tags"))
    return table(spark, sf, "part").select("p_partkey", C.value_to_json(nested).alias("json"))


@query("fi1_survivors", f"WITH {JUDGED} SELECT row_id, attribute_name FROM judged WHERE NOT should_remove")
def fi1(spark, sf):
    return R.survivors_of(judged(spark, sf)).select("row_id", "attribute_name")


@query(
    "fi2_rows_by_cluster",
    f"WITH {DICT} SELECT cluster_id, count(*) AS n_rows, min(row_id) AS first_row, max(row_id) AS last_row FROM dict GROUP BY cluster_id",
)
def fi2(spark, sf):
    return dictionary(spark, sf).groupBy("cluster_id").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.min("row_id").alias("first_row"),
        F.max("row_id").alias("last_row"),
    )


@query(
    "fi3_shared_clusters",
    """WITH d AS (SELECT p_partkey AS row_id, CAST(p_partkey % 40 + p_size * 100 AS INTEGER) AS cluster_id FROM part)
       SELECT row_id, cluster_id FROM d WHERE cluster_id IN (SELECT cluster_id FROM d GROUP BY 1 HAVING count(*) > 1)""",
)
def fi3(spark, sf):
    rows = table(spark, sf, "part").select(
        F.col("p_partkey").alias("row_id"),
        (F.col("p_partkey") % 40 + F.col("p_size") * 100).cast("int").alias("cluster_id"),
    )
    return R.in_shared_clusters(rows).select("row_id", "cluster_id")


@query(
    "fi4_shared_groups",
    f"""WITH {DICT}, m AS (SELECT attribute_name || '/' || attribute_definition AS group_id, attribute_name, row_id AS seq FROM dict)
        SELECT * FROM m WHERE group_id IN (SELECT group_id FROM m GROUP BY 1 HAVING count(*) > 1)""",
)
def fi4(spark, sf):
    members = dictionary(spark, sf).select(
        F.concat_ws("/", "attribute_name", "attribute_definition").alias("group_id"),
        "attribute_name",
        F.col("row_id").alias("seq"),
    )
    return V.shared_groups(members).select("group_id", "attribute_name", "seq")


@query("fi5_flagged", f"WITH {JUDGED} SELECT row_id, duplicate_group_id FROM judged WHERE is_duplicate")
def fi5(spark, sf):
    return R.flagged(judged(spark, sf)).select("row_id", "duplicate_group_id")


@query(
    "fi6_earliest_existing",
    f"""WITH {JUDGED}, e AS (SELECT *, TRY_CAST(first_seen_in_round AS DOUBLE) AS r FROM judged WHERE source = 'existing')
        SELECT row_id, attribute_name FROM (SELECT *, min(r) OVER (PARTITION BY attribute_name) AS m FROM e) WHERE r = m""",
)
def fi6(spark, sf):
    return R.earliest_existing(judged(spark, sf), "attribute_name").select("row_id", "attribute_name")


@query(
    "jo1_attach",
    f"WITH {DICT} SELECT d.row_id, d.attribute_name, l.quality FROM dict d LEFT JOIN labels l ON l.doc_id = d.row_id",
)
def jo1(spark, sf):
    labels = table(spark, sf, "labels").select(F.col("doc_id").alias("row_id"), "quality")
    return R.attach(dictionary(spark, sf), labels).select("row_id", "attribute_name", "quality")


@query(
    "jo3_rows_named",
    f"""WITH {DICT}, g AS (SELECT DISTINCT p_type AS group_id, p_name AS attribute_name FROM part)
        SELECT d.row_id, d.attribute_name, g.group_id FROM dict d JOIN g USING (attribute_name)""",
)
def jo3(spark, sf):
    groups = table(spark, sf, "part").select(
        F.col("p_type").alias("group_id"), F.array("p_name").alias("names")
    )
    return R.rows_named(dictionary(spark, sf), groups).select("row_id", "attribute_name", "group_id")


@query("ag1_count", "SELECT count(*) AS n_rows FROM lineitem")
def ag1(spark, sf):
    return table(spark, sf, "lineitem").agg(F.count(F.lit(1)).alias("n_rows"))


@query(
    "ag2_conditional_counts",
    f"WITH {JUDGED} SELECT cluster_id, count(*) FILTER (is_duplicate) AS duplicates, count(*) FILTER (should_remove) AS removed, count(*) FILTER (NOT should_remove) AS kept FROM judged GROUP BY cluster_id",
)
def ag2(spark, sf):
    return judged(spark, sf).groupBy("cluster_id").agg(
        F.count_if("is_duplicate").alias("duplicates"),
        F.count_if("should_remove").alias("removed"),
        F.count_if(~F.col("should_remove")).alias("kept"),
    )


@query(
    "ag3_distinct_counts",
    f"WITH {JUDGED} SELECT count(DISTINCT cluster_id) AS clusters, count(DISTINCT duplicate_group_id) FILTER (is_duplicate) AS duplicate_groups FROM judged",
)
def ag3(spark, sf):
    group = F.when(F.col("is_duplicate"), F.col("duplicate_group_id"))
    return judged(spark, sf).agg(
        F.count_distinct("cluster_id").alias("clusters"),
        F.count_distinct(group).alias("duplicate_groups"),
    )


@query(
    "ag4_earliest_round",
    f"WITH {JUDGED} SELECT attribute_name, min(TRY_CAST(first_seen_in_round AS DOUBLE)) AS earliest FROM judged GROUP BY attribute_name",
)
def ag4(spark, sf):
    return judged(spark, sf).groupBy("attribute_name").agg(
        F.min(T.to_number(F.col("first_seen_in_round"))).alias("earliest")
    )


@query(
    "ag5_names_per_group",
    """WITH m AS (SELECT o_orderkey, o_custkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS pos FROM orders)
       SELECT CAST(o_custkey AS VARCHAR) AS group_id, CAST(pos // 4 AS BIGINT) AS page,
              string_agg(CAST(o_orderkey AS VARCHAR), '|' ORDER BY o_orderkey) AS names FROM m GROUP BY ALL""",
)
def ag5(spark, sf):
    members = table(spark, sf, "orders").select(
        F.col("o_custkey").cast("string").alias("group_id"),
        F.col("o_orderkey").alias("seq"),
        F.col("o_orderkey").cast("string").alias("attribute_name"),
    )
    return V.names_per_group(members, 4).select(
        "group_id", "page", F.array_join("names", "|").alias("names")
    )


@query(
    "ag6_run_summary",
    f"""WITH {JUDGED} SELECT count(*) AS total_attributes, count(*) FILTER (is_duplicate) AS duplicates_found,
        count(*) FILTER (NOT should_remove) AS attributes_to_keep, count(*) FILTER (should_remove) AS attributes_to_remove,
        count(DISTINCT cluster_id) AS clusters, count(DISTINCT duplicate_group_id) FILTER (is_duplicate) AS duplicate_groups,
        round(100.0 * count(*) FILTER (is_duplicate) / count(*), 6) AS duplicate_percentage FROM judged""",
)
def ag6(spark, sf):
    return run_summary(judged(spark, sf)).withColumn(
        "duplicate_percentage", F.round("duplicate_percentage", 6)
    )


@query(
    "wi1_cluster_order",
    f"WITH {DICT} SELECT cluster_id, min(row_id) AS first_row FROM dict GROUP BY cluster_id ORDER BY first_row",
)
def wi1(spark, sf):
    return R.cluster_order(dictionary(spark, sf)).orderBy("first_row")


@query(
    "wi2_first_per_group",
    f"WITH {DICT} SELECT attribute_name, arg_min(attribute_definition, row_id) AS attribute_definition, min(row_id) AS row_id FROM dict GROUP BY attribute_name",
)
def wi2(spark, sf):
    return dictionary(spark, sf).groupBy("attribute_name").agg(
        F.min_by("attribute_definition", "row_id").alias("attribute_definition"),
        F.min("row_id").alias("row_id"),
    )


@query(
    "wi3_last_per_key",
    f"WITH {DICT} SELECT attribute_name, arg_max(attribute_definition, row_id) AS attribute_definition, arg_max(cluster_id, row_id) AS cluster_id FROM dict GROUP BY attribute_name",
)
def wi3(spark, sf):
    return R.last_per_key(
        dictionary(spark, sf), ["attribute_name"], "row_id", ["attribute_definition", "cluster_id"]
    )


@query(
    "wi4_position",
    f"WITH {DICT} SELECT row_id, cluster_id, row_number() OVER (PARTITION BY cluster_id ORDER BY row_id) AS pos FROM dict",
)
def wi4(spark, sf):
    return positions(dictionary(spark, sf), "row_id", ["cluster_id"]).select(
        "row_id", "cluster_id", "pos"
    )


@query(
    "wi4_position_in_table",
    "SELECT event_id, row_number() OVER (ORDER BY event_id) AS pos FROM events",
)
def wi4_table(spark, sf):
    return positions(table(spark, sf, "events").select("event_id"), "event_id")


@query(
    "st1_combine",
    f"""WITH {JUDGED}, o AS (SELECT row_id, attribute_name, source FROM judged WHERE row_id % 2 = 0),
        n AS (SELECT row_id, attribute_name FROM judged WHERE row_id % 2 <> 0)
        SELECT row_id, attribute_name, source FROM o UNION ALL
        SELECT row_id - (SELECT min(row_id) FROM n) + (SELECT max(row_id) + 1 FROM o), attribute_name, NULL FROM n""",
)
def st1(spark, sf):
    rows = judged(spark, sf)
    old = rows.where("row_id % 2 = 0").select("row_id", "attribute_name", "source")
    new = rows.where("row_id % 2 <> 0").select("row_id", "attribute_name")
    return R.combine(old, new)


@query("st2_distinct", f"WITH {DICT} SELECT DISTINCT cluster_id, attribute_name FROM dict")
def st2(spark, sf):
    return dictionary(spark, sf).select("cluster_id", "attribute_name").distinct()
