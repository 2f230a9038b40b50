"""One case per step of the reply ladder, and the odd cases."""

import json

import pytest
from pyspark.sql import functions as F

from samesense.functions.replies import best_name, read_replies

OBJECT = (
    '{"duplicates": [{"attribute_name": "a", "is_duplicate": true, "duplicate_group_id": "group1"}, '
    '{"attribute_name": "b", "is_duplicate": true, "duplicate_group_id": "group1"}, '
    '{"attribute_name": "c", "is_duplicate": false}]}'
)
ALL = [("a", "group1"), ("b", "group1"), ("c", None)]

CASES = [
    ("fenced", f"Sure:\n```json\n{OBJECT}\n```\nbye", "json", ALL),
    ("plain fence", f"```\n{OBJECT}\n```", "json", ALL),
    ("bare object in prose", f"text {OBJECT} text", "json", ALL),
    ("doubled fence", f"```json\n```json\n{OBJECT}\n```\n```", "embedded", ALL),
    ("fence without end", f"```json\n{OBJECT}", "embedded", ALL),
    ("first object that parses", '{"duplicates": [oops]} and ' + OBJECT, "embedded", ALL),
    ("prose", "group1 (names): a, b\ngroup2 x: c", "lines", [("a", "group1"), ("b", "group1"), ("c", "group2")]),
    ("prose in other letters", "GROUP1 (x): größe, 大小", "lines", [("größe", "group1"), ("大小", "group1")]),
    ("bullets", "- a, b, c (group1)\n- d,e (Group2)", "lines",
     [("a", "group1"), ("b", "group1"), ("c", "group1"), ("d", "group2"), ("e", "group2")]),
    ("sections", "intro\n\nduplicate group: a b\n\nend", "sections",
     [("duplicate", "group1"), ("group", "group1"), ("a", "group1"), ("b", "group1")]),
    ("noise", "The id must be unique for each set.", "none", []),
    ("nothing", "", "none", []),
    ("null id", '{"duplicates": [{"attribute_name": "a", "is_duplicate": true, "duplicate_group_id": null}]}', "json", [("a", "None")]),
    ("number and truth ids",
     '{"duplicates": [{"attribute_name": "a", "is_duplicate": true, "duplicate_group_id": 3},'
     ' {"attribute_name": "b", "is_duplicate": true, "duplicate_group_id": true}]}', "json", [("a", "3"), ("b", "True")]),
    ("truth value as text", '{"duplicates": [{"attribute_name": "a", "is_duplicate": "true", "duplicate_group_id": "g"}]}', "json", []),
    ("no id key", '{"duplicates": [{"attribute_name": "a", "is_duplicate": true}]}', "json", []),
    ("no name key", '{"duplicates": [{"is_duplicate": false}, 7, "x", null]}', "json", []),
    ("name that is no text", '{"duplicates": [{"attribute_name": 5, "is_duplicate": true, "duplicate_group_id": "g"}]}', "json", [(None, "g")]),
    ("other shape", "[1, 2]", "json", []),
    ("duplicates is no list", '{"duplicates": {"a": 1}}', "json", []),
    ("text after the value", '```\n{"duplicates": []} x\n```', "embedded", []),
    ("two values", '```\n{"a": 1}, {"b": 2}\n```', "none", []),
]


def test_ladder(spark):
    rows = [(name, text) for name, text, _, _ in CASES]
    read = read_replies(spark.createDataFrame(rows, "name string, response string")).collect()
    got = {r["name"]: r for r in read}
    for name, _, rung, items in CASES:
        found = [(i.attribute_name, i.duplicate_group_id) for i in got[name]["items"]]
        assert (got[name]["rung"], found) == (rung, items), name


def test_groups_keep_the_order_they_are_first_seen(spark):
    reply = "group2 (n): a\n- x, y (group1)\n- z, a (group2)"
    row = read_replies(spark.createDataFrame([(reply,)], "response string")).first()
    pairs = [(i.attribute_name, i.duplicate_group_id) for i in row["items"]]
    assert pairs == [("a", "group2"), ("z", "group2"), ("a", "group2"), ("x", "group1"), ("y", "group1")]


@pytest.mark.parametrize(
    ("reply", "want"),
    [
        ('{"best_attribute": "b", "reasoning": "r"}', "b"),
        ('```json\n{"best_attribute": "a"}\n```', "a"),
        ('{"best_attribute": "z"}', None),
        ('{"best_attribute": 1}', None),
        ('{"other": "a"}', None),
        ("a", None),
        (json.dumps("a"), None),
        (None, None),
    ],
)
def test_best_name(spark, reply, want):
    df = spark.createDataFrame([(reply,)], "r string")
    names = F.array(F.lit("a"), F.lit("b"))
    assert df.select(best_name(F.col("r"), names).alias("b")).first().b == want
