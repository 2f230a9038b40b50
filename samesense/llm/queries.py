"""Named queries of the operators over the supplied tables, with SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from samesense.llm import alignment, classifier, decontaminate, divergence, lattice, lines, pieces, quality, secrets, simhash, substrings, urls, warc

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


def _texts(values: list[str]) -> str:
    return ", ".join("'" + value.replace("'", "''") + "'" for value in values)


def quality_sql(source: str) -> str:
    """CTE ``judged``: the rows of ``source(doc_id, text)`` numbered, with counts and verdict."""
    tests = []
    for rule in quality.RULES:
        if rule.low > 0:
            tests.append(f"coalesce({rule.part} / nullif({rule.whole}, 0) < {rule.low}, false)")
        if rule.high < float("inf"):
            tests.append(f"coalesce({rule.part} / nullif({rule.whole}, 0) > {rule.high}, false)")
    return rf"""numbered AS (
  SELECT *, row_number() OVER () AS r, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM {source}),
shown AS (
  SELECT r, i, list_slice(w, i, i + 7) AS g
  FROM (SELECT r, w, unnest(range(1, len(w) - 6)) AS i FROM numbered WHERE len(w) >= 8)),
again AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM shown) WHERE n > 1),
spans AS (SELECT r, sum(least(8, coalesce(nxt - i, 8)))::BIGINT AS n_repeat_words
  FROM (SELECT r, i, lead(i) OVER (PARTITION BY r ORDER BY i) AS nxt FROM again) GROUP BY r),
counted AS (
  SELECT n.* EXCLUDE (w, t, r), len(w)::BIGINT AS n_words,
         length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
         (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         len(list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')))::BIGINT AS n_lines,
         n_lines - len(list_distinct(list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]'))))::BIGINT AS n_dup_lines,
         coalesce(s.n_repeat_words, 0) AS n_repeat_words,
         len(list_filter(w, lambda x: list_contains([{_texts(quality.stop_words())}], x)))::BIGINT AS n_stop_words
  FROM numbered n LEFT JOIN spans s USING (r)),
judged AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
         NOT (base_failed OR {' OR '.join(tests)}) AS kept FROM counted)"""


@query(
    "op3_quality_rules",
    f"""WITH {quality_sql('documents')}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept FROM judged""",
)
def quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    judged, name = quality.judge(docs)
    return judged.select("doc_id", f"{name}.*").drop("n_stop_words", "n_lines", "failed")


# The rules of the contract.
URL_RULES = [
    ("org/", "allow"),
    ("example.org/es/", "block"),
    ("example.org/en/1", "block"),
    ("com/fr/", "allow"),
    ("com/de/", "block"),
]


@query(
    "op4_url_filters",
    f"""WITH rules(rule, verdict) AS (VALUES {', '.join(f"('{r}', '{v}')" for r, v in URL_RULES)}),
rests AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN regexp_extract(substr(url, instr(url, '://') + 3), '^([^?#]*)', 1) ELSE '' END AS rest
  FROM pages),
split AS (
  SELECT page_id, translate(regexp_extract(rest, '^([^/]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         substr(rest, length(regexp_extract(rest, '^([^/]*)', 1)) + 1) AS path
  FROM rests),
distinct_urls AS (SELECT DISTINCT host, path FROM split),
fits AS (
  SELECT host, path, max_by(rule, length(rule)) AS rule, max_by(verdict, length(rule)) AS verdict
  FROM distinct_urls, rules
  WHERE ('.' || host) LIKE ('%.' || split_part(rule, '/', 1)) AND host <> '' AND starts_with(path, substr(rule, instr(rule, '/')))
  GROUP BY ALL)
SELECT page_id, s.host, s.path, f.rule, coalesce(f.verdict, 'allow') AS verdict
FROM split s LEFT JOIN fits f ON f.host = s.host AND f.path = s.path""",
)
def url_filters(spark: SparkSession, folder: str) -> DataFrame:
    listed = [F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict")) for rule, verdict in URL_RULES]
    rules = spark.range(1).select(F.inline(F.array(*listed)))
    pages = table(spark, folder, "pages").select("page_id", "url")
    judged, name = urls.judge_urls(pages, rules)
    return judged.select("page_id", f"{name}.*")


_DIGITS = "translate(lpad(to_base(('0x' || substr(h, {0}, 10))::BIGINT, 32), 8, '0'), '0123456789ABCDEFGHIJKLMNOPQRSTUV', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567')"


@query(
    "op1_warc",
    f"""WITH hashed AS (
  SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages),
digests AS (
  SELECT page_id, payload_bytes, {' || '.join(_DIGITS.format(1 + 10 * i) for i in range(4))} AS payload_digest FROM hashed),
firsts AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM digests)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN first = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN first <> page_id THEN first END AS refers_to
FROM firsts""",
)
def warc_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    records = warc.round_trip(table(spark, folder, "pages").select("page_id", "url", "html"))
    return records.select(
        F.col("record_id").cast("bigint").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.col("refers_to").cast("bigint").alias("refers_to"),
    )


def _joined(spans: Column) -> Column:
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")),
        ),
        ",",
    )


@query("op6_secret_scans")
def secret_scans(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found, name = secrets.scan(docs)
    base = [rule.kind for rule in secrets.BASE]
    count = lambda kind: F.size(F.filter(name, lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")
    return found.select(
        "doc_id",
        *[count(kind) for kind in base],
        F.sha2(_joined(F.filter(name, lambda s: s["kind"].isin(base))), 256).alias("base_sha256"),
        _joined(F.col(name)).alias("spans"),
    )


def tokenizer_model() -> str:
    """Where the installed vocabulary file lies; nothing of it is kept in the repository."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


@query("op10_sentencepiece")
def sentencepiece_ids(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    encoded, name = pieces.encode(docs, tokenizer_model())
    return encoded.select(
        "doc_id",
        F.size(f"{name}.ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(f"{name}.ids", ","), 256).alias("ids_sha256"),
        F.sha2(f"{name}.decoded", 256).alias("decoded_sha256"),
    )


@query("op2_simhash")
def simhash_groups(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, folder, "documents"))


@query("op5_decontamination")
def decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def lines_sql(source: str) -> str:
    """CTEs ``shortened(r, text, n_lines, n_deleted)`` and ``numbered_lines``: ``source(doc_id, text)`` without repeated runs."""
    return rf"""numbered_lines AS (SELECT *, row_number() OVER () AS r, string_split(coalesce(text, ''), chr(10)) AS parts FROM {source}),
raw_lines AS (SELECT r, doc_id, unnest(parts) AS line, generate_subscripts(parts, 1) AS raw_no FROM numbered_lines),
worded AS (
  SELECT *, row_number() OVER (PARTITION BY r ORDER BY raw_no) - 1 AS i
  FROM raw_lines WHERE regexp_matches(line, '[^ 	-
]')),
around AS (
  SELECT r, doc_id, i, line, md5(line) AS h, lag(md5(line)) OVER o AS before, lead(md5(line)) OVER o AS after, lead(line) OVER o AS next
  FROM worded WINDOW o AS (PARTITION BY r ORDER BY i)),
prints AS (
  SELECT * FROM around
  WHERE h <= before OR h < after OR (before IS NULL AND after IS NULL) OR regexp_matches(line, '([^\x20\x09-\x0D]+[\x20\x09-\x0D]+){{4}}[^\x20\x09-\x0D]')),
runs AS (
  SELECT r, i AS low, i + 1 AS high FROM (SELECT *, row_number() OVER (PARTITION BY line ORDER BY doc_id, r, i) AS k FROM prints) WHERE k > 1
  UNION ALL
  SELECT r, i, i + 2 FROM (SELECT *, row_number() OVER (PARTITION BY line, next ORDER BY doc_id, r, i) AS k FROM around WHERE next IS NOT NULL) WHERE k > 1),
gone AS (SELECT DISTINCT w.r, w.raw_no FROM runs u JOIN worded w ON w.r = u.r AND w.i >= u.low AND w.i < u.high),
kept_lines AS (
  SELECT l.r, coalesce(string_agg(l.line, chr(10) ORDER BY l.raw_no) FILTER (WHERE g.r IS NULL), '') AS text, count(g.r) AS n_deleted
  FROM raw_lines l LEFT JOIN gone g ON g.r = l.r AND g.raw_no = l.raw_no GROUP BY l.r),
shortened AS (
  SELECT n.* EXCLUDE (text, parts), CASE WHEN n.text IS NOT NULL THEN k.text END AS text, n_deleted
  FROM numbered_lines n JOIN kept_lines k USING (r))"""


@query(
    "op7_line_dedup",
    f"WITH {lines_sql('documents')} SELECT doc_id, n_deleted, sha256(coalesce(text, '')) AS kept_sha256 FROM shortened",
)
def line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return _shortened(spark, folder, lines.LEAST_WORDS)


def _shortened(spark: SparkSession, folder: str, least_words: int) -> DataFrame:
    shortened, count = lines.dedup_lines(table(spark, folder, "documents").select("doc_id", "text"), least_words=least_words)
    return shortened.select(
        "doc_id", F.col(count).alias("n_deleted"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256")
    )


@query(
    "op7_single_line_dedup",
    r"""WITH numbered AS (SELECT doc_id, row_number() OVER () AS r, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents),
raw_lines AS (SELECT r, doc_id, unnest(parts) AS line, generate_subscripts(parts, 1) AS raw_no FROM numbered),
again AS (
  SELECT r, raw_no FROM raw_lines WHERE regexp_matches(line, '[^\x20\x09-\x0D]')
  QUALIFY row_number() OVER (PARTITION BY line ORDER BY doc_id, r, raw_no) > 1)
SELECT l.doc_id, count(a.r) AS n_deleted,
       sha256(coalesce(string_agg(l.line, chr(10) ORDER BY l.raw_no) FILTER (WHERE a.r IS NULL), '')) AS kept_sha256
FROM raw_lines l LEFT JOIN again a ON a.r = l.r AND a.raw_no = l.raw_no GROUP BY l.r, l.doc_id""",
)
def single_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Every repeated line goes, also one that repeats alone."""
    return _shortened(spark, folder, 1)


@query("op8_quality_classifier")
def quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    model = classifier.fit(docs, table(spark, folder, "labels").select("doc_id", "quality"))
    scored, name = classifier.score(docs, model)
    return scored.select(
        "doc_id",
        classifier.held_out("doc_id").alias("held_out"),
        F.col(name).alias("score"),
        (F.col(name) >= classifier.THRESHOLD).cast("int").alias("predicted"),
    )


@query(
    "op9_substring_dedup",
    r"""WITH src AS (
  SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
windows AS (
  SELECT r, doc_id, i, md5(array_to_string(list_slice(w, i, i + 12), ' ')) AS g
  FROM (SELECT *, unnest(range(1, len(w) - 11)) AS i FROM src WHERE len(w) >= 13)),
again AS (
  SELECT r, i FROM (SELECT r, i, doc_id, min(doc_id) OVER (PARTITION BY g) AS first FROM windows) WHERE first < doc_id),
gone AS (SELECT DISTINCT r, unnest(range(i, i + 13)) AS i FROM again),
words AS (SELECT r, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM src),
kept AS (
  SELECT k.r, string_agg(word, ' ' ORDER BY k.i) FILTER (WHERE g.r IS NULL) AS text, count(g.r) AS n_removed
  FROM words k LEFT JOIN gone g ON g.r = k.r AND g.i = k.i GROUP BY k.r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
FROM src LEFT JOIN kept USING (r)""",
)
def substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs, name = substrings.remove_repeats(table(spark, folder, "documents").select("doc_id", "text"))
    return docs.select("doc_id", f"{name}.n_words", f"{name}.n_removed", F.sha2(f"{name}.kept", 256).alias("kept_sha256"))


@query(
    "op11_source_divergence",
    r"""WITH src AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
found AS (SELECT r, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM src),
kept AS (SELECT lang, term, count(*) AS n FROM found GROUP BY lang, term HAVING count(DISTINCT r) >= 30),
sizes AS (SELECT lang, count(*) AS v, sum(n)::BIGINT AS n FROM kept GROUP BY lang),
groups AS (SELECT DISTINCT lang, source FROM src),
counted AS (SELECT f.lang, f.source, f.term, count(*) AS n FROM found f JOIN kept k ON k.lang = f.lang AND k.term = f.term GROUP BY ALL),
totals AS (SELECT lang, source, sum(n)::BIGINT AS n FROM counted GROUP BY ALL),
dense AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
         (1 + 1000000000::HUGEINT * (coalesce(c.n, 0) + 5) // (coalesce(t.n, 0) + 5 * s.v))::BIGINT AS p,
         (1 + 1000000000::HUGEINT * (k.n + 5) // (s.n + 5 * s.v))::BIGINT AS q
  FROM groups g JOIN kept k ON k.lang = g.lang JOIN sizes s ON s.lang = g.lang
  LEFT JOIN totals t ON t.lang = g.lang AND t.source = g.source
  LEFT JOIN counted c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
sums AS (
  SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
  FROM dense a JOIN dense b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(s.value, 0)::BIGINT AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source)
SELECT lang, source, 'pair' AS part, item, value,
       row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item)::INTEGER AS rank FROM pairs
UNION ALL
SELECT * FROM (
  SELECT lang, source, 'term' AS part, term AS item, p - q AS value,
         row_number() OVER (PARTITION BY lang, source ORDER BY p - q DESC, term)::INTEGER AS rank
  FROM dense WHERE n > 0 AND p > q) WHERE rank <= 50""",
)
def source_divergence(spark: SparkSession, folder: str) -> DataFrame:
    return divergence.audit(table(spark, folder, "documents"))


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op12_tokenizer_alignment")
def tokenizer_alignment(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    aligned, name = alignment.align(docs, tokenizer_file("byte_bpe_50k.json"), tokenizer_model())
    return aligned.select("doc_id", f"{name}.*")


@query("op13_lm_scoring")
def lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    scored, name = lattice.score(docs, lattice.training(), tokenizer_model())
    return scored.select("doc_id", (~lattice.training()).alias("held_out"), f"{name}.*")
