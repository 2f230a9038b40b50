"""Registry of the named queries and the tables they start from."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from samesense.storage import spread

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query and, where there is one, the SQL with the same result."""

    def add(function: Query) -> Query:
        QUERIES[name] = function
        if sql is not None:
            SQL[name] = sql
        return function

    return add


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def spread_table(spark: SparkSession, folder: str, name: str, *columns: str) -> DataFrame:
    """Columns of a table for work that is heavy per row."""
    return spread(table(spark, folder, name).select(*columns))


def dictionary(spark: SparkSession, folder: str) -> DataFrame:
    """``part`` as a data dictionary with repeated names."""
    return table(spark, folder, "part").select(
        F.col("p_partkey").alias("row_id"),
        F.col("p_name").alias("attribute_name"),
        F.concat("p_type", F.lit(" "), "p_brand").alias("attribute_definition"),
        F.col("p_size").cast("int").alias("cluster_id"),
    )


DICT = """dict AS (
  SELECT p_partkey AS row_id, p_name AS attribute_name,
         p_type || ' ' || p_brand AS attribute_definition,
         CAST(p_size AS INTEGER) AS cluster_id
  FROM part)"""


def judged(spark: SparkSession, folder: str) -> DataFrame:
    """The dictionary with made-up verdicts and provenance."""
    key = F.col("row_id")
    return dictionary(spark, folder).select(
        "*",
        (key % 3 == 0).alias("is_duplicate"),
        F.when(key % 3 == 0, F.concat(F.lit("cluster_"), (key % 50).cast("string"), F.lit("_group1"))).alias(
            "duplicate_group_id"
        ),
        ((key % 3 == 0) & (key % 2 == 0)).alias("should_remove"),
        F.when(key % 5 == 0, "existing").otherwise("new").alias("source"),
        F.when(key % 7 == 0, F.lit("?"))
        .otherwise((F.lit(1) + key % 4).cast("string"))
        .alias("first_seen_in_round"),
    )


JUDGED = DICT + """, judged AS (
  SELECT *, row_id % 3 = 0 AS is_duplicate,
         CASE WHEN row_id % 3 = 0 THEN 'cluster_' || (row_id % 50) || '_group1' END AS duplicate_group_id,
         row_id % 3 = 0 AND row_id % 2 = 0 AS should_remove,
         CASE WHEN row_id % 5 = 0 THEN 'existing' ELSE 'new' END AS source,
         CASE WHEN row_id % 7 = 0 THEN '?' ELSE CAST(1 + row_id % 4 AS VARCHAR) END AS first_seen_in_round
  FROM dict)"""


def vectors(spark: SparkSession, folder: str) -> DataFrame:
    """``embeddings`` with its label as cluster."""
    return table(spark, folder, "embeddings").select(
        F.col("vec_id").alias("row_id"), "embedding", F.col("label").alias("cluster_id")
    )


CENTERS = """dims AS (
  SELECT label AS cluster_id, generate_subscripts(embedding, 1) AS dim,
         CAST(unnest(embedding) AS DOUBLE) AS x FROM embeddings),
centers AS (
  SELECT cluster_id, list(m ORDER BY dim) AS center
  FROM (SELECT cluster_id, dim, avg(x) AS m FROM dims GROUP BY ALL) GROUP BY cluster_id),
vecs AS (
  SELECT vec_id AS row_id, label AS cluster_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings)"""

def hashed_sql(source: str, row_id: str, text: str, keep: str) -> str:
    """CTE ``hashed(row_id, keep..., v)``: the word-hash vectors of a text column."""
    return f"""words AS (
  SELECT {row_id} AS row_id, unnest(regexp_extract_all(lower({text}), '[\\p{{L}}\\p{{N}}]+')) AS w
  FROM {source}),
buckets AS (
  SELECT row_id, CAST('0x' || substr(md5(w), 1, 8) AS BIGINT) % 64 AS dim, count(*) AS n
  FROM words GROUP BY ALL),
dense AS (
  SELECT t.{row_id} AS row_id, d.dim, coalesce(b.n, 0) AS n
  FROM {source} t CROSS JOIN (SELECT unnest(range(64)) AS dim) d
  LEFT JOIN buckets b ON b.row_id = t.{row_id} AND b.dim = d.dim),
counted AS (SELECT row_id, list(n ORDER BY dim) AS counts FROM dense GROUP BY row_id),
hashed AS (
  SELECT t.*, list_transform(c.counts, lambda x: CAST(x / greatest(sqrt(list_sum(list_transform(c.counts, lambda y: y * y))), 1e-9) AS FLOAT)) AS v
  FROM (SELECT {row_id} AS row_id{keep} FROM {source}) t JOIN counted c USING (row_id))"""


def groups_sql(vectors: str, block: str, threshold: float) -> str:
    """CTE ``groups(row_id, root)``: connected similar rows of a block."""
    return f"""distinct_vectors AS (
  SELECT {block} AS block, CAST(v AS DOUBLE[]) AS v, min(row_id) AS rep, count(*) AS copies
  FROM {vectors} WHERE list_sum(list_transform(CAST(v AS DOUBLE[]), lambda x: x * x)) > 0 GROUP BY ALL),
pairs AS (
  SELECT a.rep AS a, b.rep AS b FROM distinct_vectors a JOIN distinct_vectors b
  ON a.block = b.block AND a.rep <> b.rep AND list_cosine_similarity(a.v, b.v) >= {threshold}),
reach(node, root) AS (
  SELECT a, least(a, b) FROM pairs
  UNION SELECT p.b, r.root FROM reach r JOIN pairs p ON p.a = r.node),
roots AS (SELECT node, min(root) AS root FROM reach GROUP BY node),
groups AS (
  SELECT t.row_id, coalesce(r.root, d.rep) AS root
  FROM {vectors} t JOIN distinct_vectors d ON d.block = t.{block} AND d.v = CAST(t.v AS DOUBLE[])
  LEFT JOIN roots r ON r.node = d.rep WHERE r.root IS NOT NULL OR d.copies > 1)"""
