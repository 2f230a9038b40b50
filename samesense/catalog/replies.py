"""Prompts, model calls, replies, verdicts by name and survivors."""

from __future__ import annotations

from pyspark.sql import functions as F

from samesense.catalog.base import DICT, JUDGED, dictionary, judged, query, spread_table, table
from samesense.functions import replies as P
from samesense.functions.convert import strict_json
from samesense.operators import model as M
from samesense.operators import prompts as Q
from samesense.operators import rows as R
from samesense.operators import survivors as S
from samesense.operators import verdicts as V
from samesense.plans import dedup
from samesense.storage import fresh_path, spread, store

# One reply per part, in turn: fenced, plain fence, bare object, doubled fence, prose,
# bullets, sections, noise; the object's second item is valid, null-named or invalid.
OBJECT = (
    '{"duplicates": [{"attribute_name": "#a", "is_duplicate": true, "duplicate_group_id": #g}, '
    '{"attribute_name": "#b", "is_duplicate": #t, "duplicate_group_id": "group1"}, '
    '{"attribute_name": "#c", "is_duplicate": #f}]}'
)
FORMS = [
    "Sure.\n```json\n" + OBJECT + "\n```\nDone.",
    "```\n" + OBJECT + "\n```",
    "The answer is " + OBJECT + " I think.",
    "Well:\n```json\n```json\n" + OBJECT + "\n```\n```\n",
    "I see groups.\ngroup1 (names): #a, #b\nGroup2 (brand): #c\n",
    "List:\n- #a, #b (group1)\n- #a, #b, #c (Group7)\n",
    "Intro\n\nThese duplicate names form a group: #a and #b\n\nThe end",
    "The id must be unique for each set. {not json} #a",
]
PARTS = "p(row_id, a, b, c, g, t, f, form) AS (SELECT p_partkey, replace(p_name, ' ', '_'), lower(p_type), lower(replace(p_brand, '#', '')), CASE p_partkey % 5 WHEN 0 THEN 'null' WHEN 1 THEN '7' WHEN 2 THEN 'true' ELSE '\"group1\"' END, CASE WHEN p_partkey % 3 = 0 THEN '\"true\"' ELSE 'true' END, CASE WHEN p_partkey % 7 = 0 THEN 'true' ELSE 'false' END, p_partkey % 8 FROM part)"


def _sql_text(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


REPLIES = (
    "WITH " + PARTS + ", raw AS (SELECT *, CASE form "
    + " ".join(f"WHEN {i} THEN {_sql_text(form)}" for i, form in enumerate(FORMS))
    + " END AS template FROM p), replies AS (SELECT row_id, form, replace(replace(replace(replace(replace(replace(template,"
    " '#a', a), '#b', b), '#c', c), '#g', g), '#t', t), '#f', f) AS r FROM raw)"
)
CANDIDATES = REPLIES + """, candidates AS (SELECT row_id, form, r, CASE
  WHEN contains(r, '```json') THEN CASE WHEN contains(string_split(r, '```json')[2], '```')
       THEN trim(string_split(string_split(r, '```json')[2], '```')[1], e' \\n\\t\\r') ELSE r END
  WHEN contains(r, '```') THEN trim(string_split(r, '```')[2], e' \\n\\t\\r')
  WHEN contains(r, '{') AND contains(r, '}') AND length(r) - strpos(reverse(r), '}') + 1 > strpos(r, '{')
  THEN substr(r, strpos(r, '{'), length(r) - strpos(reverse(r), '}') + 2 - strpos(r, '{'))
  ELSE r END AS candidate FROM replies)"""
PARSED = CANDIDATES + """, strict AS (SELECT *, CASE WHEN candidate <> '' AND json_valid(candidate) THEN candidate END AS j1,
    list_filter(regexp_extract_all(r, '(?s)\\{\\s*"duplicates"\\s*:\\s*\\[.*?\\]\\s*\\}'), lambda x: json_valid(x))[1] AS j2 FROM candidates),
parsed AS (SELECT *, coalesce(j1, j2) AS j FROM strict)"""
ITEMS = PARSED + """, listed AS (
  SELECT row_id, CAST(json_extract(j, '$.duplicates') AS JSON[]) AS l FROM parsed WHERE j IS NOT NULL),
json_items AS (SELECT row_id, generate_subscripts(l, 1) AS idx, unnest(l) AS i FROM listed),
valid AS (SELECT row_id, idx, i FROM json_items WHERE json_exists(i, '$.attribute_name')
  AND json_type(json_extract(i, '$.is_duplicate')) = 'BOOLEAN'
  AND (json_extract_string(i, '$.is_duplicate') = 'false' OR json_exists(i, '$.duplicate_group_id'))),
from_json AS (SELECT row_id, row_number() OVER (PARTITION BY row_id ORDER BY idx) - 1 AS pos,
    json_extract_string(i, '$.attribute_name') AS attribute_name,
    json_extract_string(i, '$.is_duplicate') = 'true' AS is_duplicate,
    CASE json_type(json_extract(i, '$.duplicate_group_id')) WHEN 'NULL' THEN 'None'
      WHEN 'BOOLEAN' THEN CASE json_extract_string(i, '$.duplicate_group_id') WHEN 'true' THEN 'True' ELSE 'False' END
      ELSE json_extract_string(i, '$.duplicate_group_id') END AS duplicate_group_id FROM valid),
prose AS (SELECT row_id, 1 AS kind, generate_subscripts(ids, 1) AS idx, 'group' || unnest(ids) AS gid,
    regexp_extract_all(unnest(tails), '[\\p{L}\\p{N}_]+') AS names FROM (
    SELECT row_id, regexp_extract_all(r, '(?i)group(\\d+)[^\\w].*?:([^\\n]+)', 1) AS ids,
           regexp_extract_all(r, '(?i)group(\\d+)[^\\w].*?:([^\\n]+)', 2) AS tails FROM parsed WHERE j IS NULL)),
bullets AS (SELECT row_id, 2 AS kind, generate_subscripts(g, 1) AS idx, 'group' || unnest(g) AS gid,
    [unnest(a), unnest(b), unnest(c)] AS names FROM (SELECT row_id,
      regexp_extract_all(r, p, 1) AS a, regexp_extract_all(r, p, 2) AS b, regexp_extract_all(r, p, 3) AS c, regexp_extract_all(r, p, 4) AS g
      FROM parsed, (SELECT '(?i)- (\\w+),\\s*(\\w+)(?:,\\s*(\\w+))?\\s*\\(group(\\d+)\\)' AS p) WHERE j IS NULL)),
entries AS (SELECT row_id, kind, idx, gid, list_filter(names, lambda n: n <> '') AS names FROM (SELECT * FROM prose UNION ALL SELECT * FROM bullets) WHERE len(list_filter(names, lambda n: n <> '')) > 0),
sections AS (SELECT row_id, 3 AS kind, idx, 'group' || row_number() OVER (PARTITION BY row_id ORDER BY idx) AS gid, names FROM (
    SELECT row_id, idx, regexp_extract_all(s, '[a-zA-Z_]+') AS names FROM (
      SELECT row_id, generate_subscripts(ss, 1) AS idx, unnest(ss) AS s FROM (
        SELECT row_id, regexp_split_to_array(r, '\\n\\s*\\n') AS ss FROM parsed
        WHERE j IS NULL AND row_id NOT IN (SELECT row_id FROM entries)))
    WHERE contains(lower(s), 'duplicate') AND contains(lower(s), 'group')) WHERE len(names) >= 2),
every AS (SELECT * FROM entries UNION ALL SELECT * FROM sections),
first_seen AS (SELECT row_id, gid, min(kind * 1000 + idx) AS seen FROM every GROUP BY ALL),
words AS (SELECT row_id, gid, kind * 1000 + idx AS idx, generate_subscripts(names, 1) AS w, unnest(names) AS name FROM every),
from_text AS (SELECT row_id, row_number() OVER (PARTITION BY row_id ORDER BY seen, words.idx, w) - 1 AS pos, name AS attribute_name,
    true AS is_duplicate, gid AS duplicate_group_id FROM words JOIN first_seen USING (row_id, gid)),
items AS (SELECT * FROM from_json UNION ALL SELECT * FROM from_text)"""


def sample_replies(spark, sf):
    """One reply per part, its shape given by the part's key."""
    key = F.col("p_partkey")
    form = F.element_at(F.array(*[F.lit(f) for f in FORMS]), (key % 8 + 1).cast("int"))
    fills = {
        "#a": F.replace("p_name", F.lit(" "), F.lit("_")),
        "#b": F.lower("p_type"),
        "#c": F.lower(F.replace("p_brand", F.lit("#"), F.lit(""))),
        "#g": F.when(key % 5 == 0, "null").when(key % 5 == 1, "7").when(key % 5 == 2, "true").otherwise('"group1"'),
        "#t": F.when(key % 3 == 0, '"true"').otherwise("true"),
        "#f": F.when(key % 7 == 0, "true").otherwise("false"),
    }
    for mark, value in fills.items():
        form = F.replace(form, F.lit(mark), value)
    part = spread_table(spark, sf, "part", "p_partkey", "p_name", "p_type", "p_brand")
    return part.select(
        key.alias("row_id"), key.alias("cluster_id"), form.alias("response")
    )


@query("pa1_candidate", CANDIDATES + " SELECT row_id, candidate FROM candidates")
def pa1(spark, sf):
    return sample_replies(spark, sf).select("row_id", P.candidate(F.col("response")).alias("candidate"))


@query("pa2_strict_json", PARSED + " SELECT row_id, j1 IS NOT NULL AS parses FROM parsed")
def pa2(spark, sf):
    value = strict_json(P.candidate(F.col("response")))
    return sample_replies(spark, sf).select("row_id", value.isNotNull().alias("parses"))


@query("pa3_embedded_json", PARSED + " SELECT row_id, form, j2 IS NOT NULL AS found FROM parsed")
def pa3(spark, sf):
    found = P.embedded_json(F.col("response")).isNotNull()
    return sample_replies(spark, sf).select("row_id", (F.col("row_id") % 8).alias("form"), found.alias("found"))


def _entries(spark, sf, column):
    reply = F.col("response")
    no_json = strict_json(P.candidate(reply)).isNull() & P.embedded_json(reply).isNull()
    rows = sample_replies(spark, sf).where(no_json)
    return rows.select("row_id", F.posexplode(column).alias("idx", "e")).select(
        "row_id", (F.col("idx") + 1).cast("bigint").alias("idx"), "e.gid", F.array_join("e.names", "|").alias("names")
    )


@query("pa4_prose_groups", ITEMS + " SELECT row_id, idx, gid, array_to_string(names, '|') AS names FROM entries WHERE kind = 1")
def pa4(spark, sf):
    return _entries(spark, sf, P.prose_groups(F.col("response")))


@query("pa5_bullet_groups", ITEMS + " SELECT row_id, idx, gid, array_to_string(names, '|') AS names FROM entries WHERE kind = 2")
def pa5(spark, sf):
    return _entries(spark, sf, P.bullet_groups(F.col("response")))


@query(
    "pa6_section_groups",
    ITEMS + " SELECT row_id, row_number() OVER (PARTITION BY row_id ORDER BY idx) AS idx, gid, array_to_string(names, '|') AS names FROM sections",
)
def pa6(spark, sf):
    return _entries(spark, sf, P.section_groups(F.col("response")))


@query(
    "pa7_items_from_text",
    ITEMS + " SELECT row_id, pos, attribute_name, duplicate_group_id FROM from_text",
)
def pa7(spark, sf):
    read = P.read_replies(sample_replies(spark, sf)).where("rung in ('lines', 'sections')")
    return read.select("row_id", F.posexplode_outer("items").alias("pos", "i")).where("pos is not null").select(
        "row_id", F.col("pos").cast("bigint").alias("pos"), "i.attribute_name", "i.duplicate_group_id"
    )


@query("pa8_valid_items", ITEMS + " SELECT row_id AS cluster_id, pos, attribute_name, is_duplicate, duplicate_group_id FROM items")
def pa8(spark, sf):
    return V.verdict_items(sample_replies(spark, sf)).withColumn("pos", F.col("pos").cast("bigint"))


@query(
    "pa8_rungs",
    ITEMS + """ SELECT row_id, CASE WHEN j1 IS NOT NULL THEN 'json' WHEN j2 IS NOT NULL THEN 'embedded'
        WHEN row_id IN (SELECT row_id FROM entries) THEN 'lines' WHEN row_id IN (SELECT row_id FROM sections) THEN 'sections' ELSE 'none' END AS rung FROM parsed""",
)
def pa8_rungs(spark, sf):
    return P.read_replies(sample_replies(spark, sf)).select("row_id", "rung")


@query(
    "pa9_verdict_records",
    ITEMS + """, n AS (SELECT row_id, count(*) AS c FROM items GROUP BY row_id),
    g AS (SELECT row_id, duplicate_group_id, string_agg(attribute_name, ',' ORDER BY pos) AS names, min(pos) AS p FROM items WHERE is_duplicate GROUP BY ALL)
    SELECT r.row_id AS cluster_id, coalesce(n.c, 2) AS n_items,
      coalesce((SELECT string_agg(duplicate_group_id || ':' || names, ';' ORDER BY p) FROM g WHERE g.row_id = r.row_id), '') AS groups
    FROM replies r LEFT JOIN n USING (row_id)""",
)
def pa9(spark, sf):
    replies = sample_replies(spark, sf).withColumn("attributes", F.array(F.lit("x"), F.lit("y")))
    records = V.verdict_records(replies)
    groups = F.transform(
        F.map_entries("duplicate_groups"),
        lambda e: F.concat(e["key"], F.lit(":"), F.array_join(e["value"], ",")),
    )
    return records.select(
        "cluster_id",
        F.size("duplicates").cast("bigint").alias("n_items"),
        F.array_join(groups, ";").alias("groups"),
    )


BEST = (
    "b AS (SELECT p_partkey AS row_id, CASE p_partkey % 4 WHEN 0 THEN '```json\n{\"best_attribute\": \"' || p_name || '\", \"reasoning\": \"x\"}\n```'"
    " WHEN 1 THEN 'I pick {\"best_attribute\": \"' || p_brand || '\"}' WHEN 2 THEN '{\"best_attribute\": 5}' ELSE p_name END AS response, p_name, p_type FROM part)"
)


def best_replies(spark, sf):
    key = F.col("p_partkey") % 4
    reply = (
        F.when(key == 0, F.concat(F.lit('```json\n{"best_attribute": "'), "p_name", F.lit('", "reasoning": "x"}\n```')))
        .when(key == 1, F.concat(F.lit('I pick {"best_attribute": "'), "p_brand", F.lit('"}')))
        .when(key == 2, F.lit('{"best_attribute": 5}'))
        .otherwise(F.col("p_name"))
    )
    return table(spark, sf, "part").select(
        F.col("p_partkey").alias("row_id"), reply.alias("response"), F.array("p_type", "p_name").alias("names")
    )


@query("pa10_best_name", f"WITH {BEST} SELECT row_id, CASE WHEN row_id % 4 = 0 THEN p_name END AS best FROM b")
def pa10(spark, sf):
    return best_replies(spark, sf).select("row_id", P.best_name(F.col("response"), F.col("names")).alias("best"))


@query("sv3_chosen_best", f"WITH {BEST} SELECT CAST(row_id AS VARCHAR) AS group_id, CASE WHEN row_id % 4 = 0 THEN p_name ELSE p_type END AS best_attribute FROM b")
def sv3(spark, sf):
    answers = best_replies(spark, sf).select(
        F.col("row_id").cast("string").alias("group_id"), F.lit(0).alias("page"), F.lit(1).alias("pages"), "response", "names"
    )
    return S.chosen_best(answers).select("group_id", "best_attribute")


LISTING = f"""WITH {DICT}, shown AS (
  SELECT cluster_id, attribute_name, attribute_definition, min(row_id) AS row_id, count(*) AS copies FROM dict GROUP BY ALL),
numbered AS (SELECT *, row_number() OVER (PARTITION BY cluster_id ORDER BY row_id) AS pos FROM shown),
sized AS (SELECT *, count(*) OVER (PARTITION BY cluster_id) AS n FROM numbered),
halved AS (SELECT *, CAST(ceil(n / {Q.PAGE_ROWS // 2}) AS BIGINT) AS halves, (pos - 1) // {Q.PAGE_ROWS // 2} AS own FROM sized),
paged AS (SELECT *, unnest(CASE WHEN n <= {Q.PAGE_ROWS} THEN [0::BIGINT]
    ELSE [least(own, o) * halves + greatest(own, o) FOR o IN range(halves) IF o <> own] END) AS page FROM halved),
listing AS (SELECT cluster_id, page, CAST(sum(copies) AS BIGINT) AS n_rows,
  string_agg(pos || '. Name: ' || attribute_name || ' | Definition: ' || attribute_definition
    || CASE WHEN copies > 1 THEN ' | Rows: ' || copies ELSE '' END, chr(10) ORDER BY pos) AS listing
  FROM paged GROUP BY cluster_id, page)"""


@query("du1_listings", LISTING + " SELECT cluster_id, page, n_rows, listing FROM listing")
def du1(spark, sf):
    return Q.listings(dictionary(spark, sf)).select("cluster_id", "page", "n_rows", "listing")


@query(
    "du1_pages",
    f"""WITH {DICT}, shown AS (SELECT cluster_id, attribute_name, attribute_definition FROM dict GROUP BY ALL),
    sizes AS (SELECT cluster_id, count(*) AS n FROM shown GROUP BY cluster_id)
    SELECT cluster_id, CAST(CASE WHEN n <= 10 THEN 1 ELSE ceil(n / 5) * (ceil(n / 5) - 1) / 2 END AS BIGINT) AS n_pages,
           CAST(CASE WHEN n <= 10 THEN n ELSE n * (ceil(n / 5) - 1) END AS BIGINT) AS n_lines FROM sizes""",
)
def du1_pages(spark, sf):
    """Clusters larger than a page: every two half pages share a prompt."""
    return Q.listings(dictionary(spark, sf), 10).groupBy("cluster_id").agg(
        F.count(F.lit(1)).alias("n_pages"), F.sum("n_lines").alias("n_lines")
    )


@query(
    "du2_detect_prompts",
    LISTING + f" SELECT cluster_id, page, 'detect_duplicates_cluster_' || cluster_id AS context, {_sql_text(Q.DETECT_HEAD)} || listing || {_sql_text(Q.DETECT_TAIL)} AS prompt FROM listing",
)
def du2(spark, sf):
    return Q.detect_prompts(Q.listings(dictionary(spark, sf))).select("cluster_id", "page", "context", "prompt")


def count_letters(prompts, max_tokens, **_):
    """A model that answers with the length of its prompt and its token limit."""
    return [f"{len(p)}/{max_tokens}" for p in prompts]


def dislikes_promo(prompts, **_):
    if any("PROMO" in p for p in prompts):
        raise ValueError("no promo")
    return [p.lower() for p in prompts]


@query("du3_infer", "SELECT doc_id, length(text) || '/100' AS response, CAST(1 AS INTEGER) AS attempts FROM documents")
def du3(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return M.infer(docs, count_letters, "text", max_tokens=100).select("doc_id", "response", "attempts")


def replies_with(prompts, **_):
    return [f"re: {p}" for p in prompts]


@query(
    "du3_answered_once",
    """SELECT conv_id, turn, 're: ' || coalesce(text, '') AS response, (SELECT count(DISTINCT coalesce(text, '')) FROM conversations) AS asked
       FROM conversations""",
)
def du3_once(spark, sf):
    """Every turn answered by a model that is asked each text once; a second run asks nothing."""
    folder = fresh_path(spark, "kept-replies")
    turns = store(table(spark, sf, "conversations").select("conv_id", "turn", F.coalesce("text", F.lit("")).alias("prompt")), "turns")
    M.answered_once(turns, replies_with, folder)
    again = M.answered_once(turns, replies_with, folder)
    asked = spark.read.parquet(folder).agg(F.count(F.lit(1)).alias("asked")).scalar()
    return again.select("conv_id", "turn", "response", asked.alias("asked"))


@query(
    "du4_retry",
    f"WITH {DICT} SELECT row_id, CASE WHEN NOT contains(attribute_definition, 'PROMO') THEN lower(attribute_definition) END AS response, contains(attribute_definition, 'PROMO') AS failed, contains(attribute_definition, 'PROMO') AS used_all FROM dict",
)
def du4(spark, sf):
    out = M.infer(dictionary(spark, sf), dislikes_promo, "attribute_definition", on_error="record")
    return out.select(
        "row_id", "response", F.col("error").isNotNull().alias("failed"), (F.col("attempts") == M.ATTEMPTS).alias("used_all")
    )


# Verdicts: each part answers for itself and for a second name, some of them made up.
VERDICTS = f"""WITH {DICT}, replies AS (
  SELECT row_id, attribute_name AS a, split_part(attribute_name, ' ', 1) || CASE WHEN row_id % 6 = 0 THEN ' dream' ELSE ' widget' END AS b FROM dict),
items AS (
  SELECT row_id, 0 AS pos, a AS attribute_name, true AS is_duplicate, 'group' || row_id % 3 AS g FROM replies
  UNION ALL SELECT row_id, 1, b, row_id % 4 <> 0, CASE WHEN row_id % 4 <> 0 THEN CASE WHEN row_id % 5 = 0 THEN 'None' ELSE 'group' || row_id % 3 END END FROM replies),
flags AS (SELECT attribute_name, 'cluster_' || row_id || '_' || g AS group_id, row_id * 10 + pos AS seq FROM items
  WHERE is_duplicate AND attribute_name IN (SELECT attribute_name FROM dict)),
shared AS (SELECT * FROM flags WHERE group_id IN (SELECT group_id FROM flags GROUP BY 1 HAVING count(*) > 1)),
verdicts AS (SELECT attribute_name, arg_max(group_id, seq) AS duplicate_group_id FROM flags GROUP BY attribute_name)"""


def own_rows(spark, sf):
    return dictionary(spark, sf).withColumn("cluster_id", F.col("row_id"))


def own_items(spark, sf):
    key = F.col("row_id")
    second = F.concat(
        F.split("attribute_name", " ")[0], F.when(key % 6 == 0, F.lit(" dream")).otherwise(F.lit(" widget"))
    )
    flag = (key % 4 != 0).cast("string")
    gid = F.when(key % 5 == 0, F.lit("null")).otherwise(F.concat(F.lit('"group'), (key % 3).cast("string"), F.lit('"')))
    replies = spread(own_rows(spark, sf)).select(
        "cluster_id",
        F.concat(
            F.lit('```json\n{"duplicates": [{"attribute_name": "'),
            "attribute_name",
            F.lit('", "is_duplicate": true, "duplicate_group_id": "group'),
            (key % 3).cast("string"),
            F.lit('"}, {"attribute_name": "'),
            second,
            F.lit('", "is_duplicate": '),
            flag,
            F.lit(', "duplicate_group_id": '),
            gid,
            F.lit("}]}\n```"),
        ).alias("response"),
    )
    return store(V.verdict_items(replies), "items")


@query(
    "jo2_apply_by_name",
    VERDICTS + " SELECT row_id, duplicate_group_id, duplicate_group_id IS NOT NULL AS is_duplicate FROM dict LEFT JOIN verdicts USING (attribute_name)",
)
def jo2(spark, sf):
    rows = own_rows(spark, sf)
    flags = V.flagged_items(own_items(spark, sf), rows)
    return V.apply_by_name(rows, V.name_verdicts(flags)).select("row_id", "duplicate_group_id", "is_duplicate")


RULE = """, ranked AS (SELECT s.group_id, d.*, row_number() OVER (PARTITION BY s.group_id ORDER BY {order}) AS place
  FROM (SELECT DISTINCT group_id, attribute_name FROM shared) s JOIN dict d USING (attribute_name)),
best AS (SELECT group_id, attribute_name AS best_attribute FROM ranked WHERE place = 1)"""
BY_RULE = VERDICTS + RULE.format(order="length(attribute_definition) DESC, length(attribute_name), row_id")


def shared_members(spark, sf, rows):
    return store(V.shared_groups(V.group_members(V.flagged_items(own_items(spark, sf), rows))), "members")


@query("sv4_rule_best", BY_RULE + " SELECT group_id, best_attribute FROM best")
def sv4(spark, sf):
    rows = own_rows(spark, sf)
    return S.rule_best(shared_members(spark, sf, rows), rows)


@query(
    "sv1_existing_best",
    f"""WITH {JUDGED}, g AS (SELECT DISTINCT 'g' || cluster_id % 40 AS group_id, attribute_name FROM judged),
    ranked AS (SELECT g.group_id, j.*, row_number() OVER (PARTITION BY g.group_id ORDER BY
      coalesce(TRY_CAST(first_seen_in_round AS DOUBLE), 1e300), row_id) AS place
      FROM g JOIN judged j USING (attribute_name) WHERE source = 'existing')
    SELECT group_id, attribute_name AS best_attribute FROM ranked WHERE place = 1""",
)
def sv1(spark, sf):
    rows = judged(spark, sf)
    members = rows.select(
        F.concat(F.lit("g"), (F.col("cluster_id") % 40).cast("string")).alias("group_id"),
        "attribute_name",
        F.col("row_id").alias("seq"),
    )
    return S.existing_best(members, rows)


BEST_PROMPT = f"""WITH {JUDGED}, names AS (SELECT DISTINCT attribute_name || '' AS attribute_name, 'g' || length(attribute_name) AS group_id FROM judged),
texts AS (SELECT attribute_name, attribute_definition, source = 'existing' AS old, min(row_id) AS row_id FROM judged GROUP BY ALL),
lines AS (SELECT group_id, row_id, 'Name: ' || attribute_name || CASE WHEN old THEN ' | [EXISTING]' ELSE '' END || ' | Definition: ' || attribute_definition AS line
  FROM texts JOIN names USING (attribute_name)),
placed AS (SELECT *, (row_number() OVER (PARTITION BY group_id ORDER BY row_id) - 1) // {Q.PAGE_ROWS} AS page FROM lines)
SELECT group_id, page, {_sql_text(Q.BEST_HEAD + Q.BEST_OLD + chr(10))} || string_agg(line, chr(10) ORDER BY row_id) || {_sql_text(Q.BEST_TAIL)} AS prompt
FROM placed GROUP BY group_id, page"""


@query("sv2_best_prompts", BEST_PROMPT)
def sv2(spark, sf):
    rows = judged(spark, sf)
    members = rows.select(
        F.concat(F.lit("g"), F.length("attribute_name").cast("string")).alias("group_id"),
        "attribute_name",
        F.col("row_id").alias("seq"),
    )
    return Q.best_prompts(members, rows, incremental=True).select("group_id", "page", "prompt")


@query(
    "sv5_mark_losers",
    BY_RULE + """ SELECT row_id, attribute_name NOT IN (
        SELECT s.attribute_name FROM shared s JOIN best b USING (group_id) WHERE s.attribute_name <> b.best_attribute) AS keep FROM dict""",
)
def sv5(spark, sf):
    rows = own_rows(spark, sf)
    members = shared_members(spark, sf, rows)
    return S.mark_losers(rows, S.losing_names(members, S.rule_best(members, rows))).select("row_id", "keep")


@query(
    "sv5_best_records",
    BY_RULE + " SELECT group_id, shared.attribute_name, best_attribute FROM shared JOIN best USING (group_id)",
)
def sv5_records(spark, sf):
    rows = own_rows(spark, sf)
    members = shared_members(spark, sf, rows)
    return S.best_records(members, S.rule_best(members, rows)).select("group_id", "attribute_name", "best_attribute")


@query(
    "pi3_verdicts_by_name",
    BY_RULE + """ SELECT row_id, duplicate_group_id IS NOT NULL AS is_duplicate, duplicate_group_id, attribute_name IN (
        SELECT s.attribute_name FROM shared s JOIN best b USING (group_id) WHERE s.attribute_name <> b.best_attribute) AS should_remove
        FROM dict LEFT JOIN verdicts USING (attribute_name)""",
)
def pi3_names(spark, sf):
    found = dedup.verdicts_from_items(own_items(spark, sf), own_rows(spark, sf))
    return R.removal_flag(found).select("row_id", "is_duplicate", "duplicate_group_id", "should_remove")


def same_first_word(prompts, **_):
    """A judge that takes names with the same first word for duplicates."""
    replies = []
    for prompt in prompts:
        lines = [s.split("Name: ", 1)[1] for s in prompt.splitlines() if ". Name: " in s]
        names = list(dict.fromkeys(s.split(" | ", 1)[0] for s in lines))
        firsts = [n.split(" ", 1)[0] for n in names]
        items = [
            f'{{"attribute_name": "{n}", "is_duplicate": true, "duplicate_group_id": "{w}"}}'
            for n, w in zip(names, firsts)
            if firsts.count(w) > 1
        ]
        replies.append('Here: {"duplicates": [' + ", ".join(items) + "]}")
    return replies


# Names of a cluster with the same first word are one group; groups are numbered by first row.
BY_MODEL = f"""WITH {DICT}, names AS (
  SELECT cluster_id, attribute_name, split_part(attribute_name, ' ', 1) AS w, min(node) AS node, max(copies) > 1 AS again
  FROM (SELECT cluster_id, attribute_name, attribute_definition, min(row_id) AS node, count(*) AS copies FROM {{rows}} GROUP BY ALL)
  GROUP BY ALL),
big AS (SELECT cluster_id, w, min(node) AS root FROM names GROUP BY cluster_id, w HAVING {{enough}}),
numbered AS (SELECT *, row_number() OVER (PARTITION BY cluster_id ORDER BY root) AS number FROM big),
flags AS (SELECT n.*, 'cluster_' || n.cluster_id || '_group' || number AS group_id, f.first_row FROM names n
  JOIN numbered USING (cluster_id, w)
  JOIN (SELECT cluster_id, min(row_id) AS first_row FROM {{rows}} GROUP BY 1) f ON f.cluster_id = n.cluster_id),
verdicts AS (SELECT attribute_name, arg_max(group_id, (first_row, node)) AS duplicate_group_id FROM flags GROUP BY 1),
ranked AS (SELECT g.group_id, d.attribute_name, row_number() OVER (PARTITION BY g.group_id ORDER BY {{order}}) AS place
  FROM flags g JOIN {{rows}} d USING (attribute_name)),
losers AS (SELECT f.attribute_name FROM flags f JOIN ranked r ON r.group_id = f.group_id AND place = 1 WHERE f.attribute_name <> r.attribute_name)
SELECT row_id, duplicate_group_id, attribute_name IN (SELECT attribute_name FROM losers) AS should_remove FROM {{rows}} LEFT JOIN verdicts USING (attribute_name)"""
BY_RULE_ORDER = "length(d.attribute_definition) DESC, length(d.attribute_name), d.row_id"
TWO_NAMES = "count(*) > 1"


def by_model(spark, rows, **options):
    found = dedup.detect_duplicates(rows, **{"judge": same_first_word, **options})
    return R.removal_flag(found).select("row_id", "duplicate_group_id", "should_remove")


@query("pi3_detect_by_model", BY_MODEL.format(rows="dict", enough=TWO_NAMES, order=BY_RULE_ORDER))
def pi3_model(spark, sf):
    """Prompts, a model, its replies, verdicts by name and the rule for survivors."""
    return by_model(spark, dictionary(spark, sf))


@query("pi3_detect_by_model_pages", BY_MODEL.format(rows="dict", enough=TWO_NAMES, order=BY_RULE_ORDER))
def pi3_model_pages(spark, sf):
    """The same when every cluster takes several pages."""
    return by_model(spark, dictionary(spark, sf), page_rows=20)


def last_shown(prompts, **_):
    """A chooser that takes the last name listed."""
    names = [[s.split("Name: ", 1)[1].split(" | ")[0] for s in p.splitlines() if "Name: " in s] for p in prompts]
    return ['{"best_attribute": "' + n[-1] + '"}' for n in names]


@query(
    "sv3_model_best_pages",
    f"""WITH {DICT} SELECT 'g' || length(attribute_name) % 7 AS group_id, count(DISTINCT attribute_name) AS n_names, true AS is_member
        FROM dict GROUP BY 1""",
)
def sv3_pages(spark, sf):
    """Groups over many pages: one winner each, and it is a name of its group."""
    rows = dictionary(spark, sf)
    group = F.concat(F.lit("g"), (F.length("attribute_name") % 7).cast("string")).alias("group_id")
    members = rows.select(group, "attribute_name", F.col("row_id").alias("seq"))
    best = S.model_best(members, rows, last_shown, page_rows=50)
    named = members.groupBy("group_id").agg(F.count_distinct("attribute_name").alias("n_names"))
    own = members.select("group_id", "attribute_name").distinct()
    won = best.join(own, (own["group_id"] == best["group_id"]) & (own["attribute_name"] == best["best_attribute"]), "left").select(
        best["group_id"], own["attribute_name"].isNotNull().alias("is_member")
    )
    return named.join(won, "group_id")


def flags_copies(prompts, **_):
    """A judge that takes names with the same first word, and rows listed as copies, for duplicates."""
    replies = []
    for prompt in prompts:
        lines = [s.split("Name: ", 1)[1] for s in prompt.splitlines() if ". Name: " in s]
        names = list(dict.fromkeys(s.split(" | ", 1)[0] for s in lines))
        firsts = [n.split(" ", 1)[0] for n in names]
        again = {s.split(" | ", 1)[0] for s in lines if " | Rows: " in s}
        items = [
            f'{{"attribute_name": "{n}", "is_duplicate": true, "duplicate_group_id": "{w}"}}'
            for n, w in zip(names, firsts)
            if firsts.count(w) > 1 or n in again
        ]
        replies.append('{"duplicates": [' + ", ".join(items) + "]}")
    return replies


TWICE = """(SELECT row_id, attribute_name, attribute_definition, row_id // 2 AS cluster_id FROM dict
  UNION ALL SELECT row_id + 1000000000, attribute_name, attribute_definition, row_id // 2 FROM dict WHERE row_id % 3 = 0)"""


@query(
    "pi3_detect_copies_by_model",
    BY_MODEL.format(rows=TWICE, enough="count(*) > 1 OR bool_or(again)", order=BY_RULE_ORDER),
)
def pi3_copies(spark, sf):
    """Clusters of very few rows, a third of them there twice: copies alone are a group too."""
    rows = dictionary(spark, sf).withColumn("cluster_id", F.expr("row_id div 2"))
    copies = rows.where("row_id % 3 = 0").withColumn("row_id", F.col("row_id") + 1000000000)
    return by_model(spark, rows.unionByName(copies), judge=flags_copies)
