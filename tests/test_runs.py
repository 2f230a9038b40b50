"""Whole runs: a stored run replayed, and both kinds of run on the made-up dictionary."""

import json

import pytest
from pyspark.sql import functions as F

from samesense import deduplicate, deduplicate_incremental, detect_duplicates, prepare_previous
from samesense.operators.report import run_summary
from samesense.operators.rows import removal_flag
from samesense.plans.dedup import THRESHOLD
from samesense.sources.sample import SYNONYMS, sample_attributes

# Clusters of a stored run over the 100 rows, in row order.
CLUSTERS = (
    "9 9 9 5 5 5 8 8 8 0 0 0 9 2 2 2 2 2 9 9 3 9 3 3 9 3 3 6 6 6 6 3 3 6 3 3 4 7 7 7 "
    "7 4 7 1 7 4 4 7 7 1 7 4 7 1 7 1 4 1 4 4 7 4 7 1 7 7 4 1 1 1 1 4 7 1 7 1 4 7 1 1 "
    "7 4 7 1 7 1 4 1 1 1 7 4 7 4 4 4 4 1 7 7"
)
# The duplicate groups of that run, first name kept.
STORED_GROUPS = {
    "cluster_5_group1": ["transaction_amount", "payment_value", "monetary_sum"],
    "cluster_0_group1": ["timestamp", "event_time", "transaction_datetime"],
    "cluster_6_group1": ["age", "years_old", "customer_age"],
}


def first_words(prompt):
    """Names listed in a prompt."""
    return [
        line.split("Name: ", 1)[1].split(" | ", 1)[0]
        for line in prompt.splitlines()
        if "Name: " in line
    ]


def by_synonym(prompts, **_):
    """A judge that knows the synonym triples."""
    names = [name for name, _ in SYNONYMS]
    replies = []
    for prompt in prompts:
        items = []
        shown = first_words(prompt)
        for name in shown:
            triple = names.index(name) // 3 if name in names else None
            alike = [n for n in shown if n in names and names.index(n) // 3 == triple]
            if triple is not None and len(alike) > 1:
                items.append(
                    {
                        "attribute_name": name,
                        "is_duplicate": True,
                        "duplicate_group_id": f"group{triple}",
                    }
                )
            else:
                items.append({"attribute_name": name, "is_duplicate": False})
        replies.append("Here it is:\n```json\n" + json.dumps({"duplicates": items}) + "\n```")
    return replies


def last_name(prompts, **_):
    return [json.dumps({"best_attribute": first_words(p)[-1]}) for p in prompts]


def stored_judge(prompts, **_):
    member = {n: "group1" for names in STORED_GROUPS.values() for n in names}
    replies = []
    for prompt in prompts:
        items = [
            {"attribute_name": n, "is_duplicate": n in member, "duplicate_group_id": member.get(n)}
            for n in first_words(prompt)
        ]
        replies.append(json.dumps({"duplicates": items}))
    return replies


def test_stored_run_is_reproduced(spark):
    numbers = [int(c) for c in CLUSTERS.split()]
    assert len(numbers) == 100
    pairs = F.create_map(*[F.lit(x) for i, c in enumerate(numbers) for x in (i, c)])
    rows = sample_attributes(spark, 100).withColumn(
        "cluster_id", F.element_at(pairs, F.col("row_id").cast("int"))
    )
    out = removal_flag(detect_duplicates(rows, judge=stored_judge, survivor=lambda p, **_: ["?"] * len(p)))
    got = {r["attribute_name"]: r for r in out.collect()}
    assert len(got) == 100
    for group, names in STORED_GROUPS.items():
        for i, name in enumerate(names):
            assert got[name]["duplicate_group_id"] == group
            assert got[name]["should_remove"] == (i > 0)
    figures = run_summary(out).first()
    assert (
        figures.total_attributes,
        figures.duplicates_found,
        figures.attributes_to_remove,
        figures.attributes_to_keep,
        figures.duplicate_percentage,
    ) == (100, 9, 6, 94, 9.0)


@pytest.mark.parametrize("page_rows", [200, 6])
def test_model_run_finds_all_triples(spark, page_rows):
    rows = sample_attributes(spark, 60).withColumn("cluster_id", (F.col("row_id") / 36).cast("int"))
    out = detect_duplicates(rows, judge=by_synonym, survivor=last_name, page_rows=page_rows)
    got = {r["attribute_name"]: r for r in out.collect()}
    assert len(got) == 60
    for i in range(0, 36, 3):
        triple = [got[SYNONYMS[j][0]] for j in range(i, i + 3)]
        assert len({r["duplicate_group_id"] for r in triple}) == 1
        assert [r["keep"] for r in triple] == [False, False, True]
    assert sum(r["is_duplicate"] for r in got.values()) == 36
    assert len({r["duplicate_group_id"] for r in got.values() if r["is_duplicate"]}) == 12


def test_similarity_run(spark):
    base = sample_attributes(spark, 40)
    copies = base.where("row_id < 5").withColumns(
        {
            "row_id": F.col("row_id") + 100,
            "attribute_name": F.concat(F.lit("the "), "attribute_name"),
            "attribute_definition": F.concat(F.lit("the "), "attribute_definition"),
        }
    )
    run = deduplicate(base.unionByName(copies), max_clusters=3, starts=2, threshold=0.75)
    out = run.result.collect()
    assert len(out) == 45
    figures = run.summary.first()
    assert figures.total_attributes == 45
    assert figures.duplicates_found == sum(r["is_duplicate"] for r in out)
    groups = {}
    for r in out:
        if r["is_duplicate"]:
            groups.setdefault(r["duplicate_group_id"], []).append(r)
    assert groups
    for members in groups.values():
        assert len(members) > 1
        assert len({m["attribute_name"] for m in members if not m["should_remove"]}) == 1
    assert not any(r["should_remove"] for r in out if not r["is_duplicate"])
    metrics = run.metrics().first()
    assert metrics.n_clusters == 3
    assert -1 <= metrics.silhouette_score <= 1
    assert metrics.inertia > 0


def test_incremental_run_prefers_old_rows(spark):
    old = sample_attributes(spark, 40).withColumns(
        {"should_remove": F.col("row_id") % 3 == 1, "is_duplicate": F.lit(True)}
    )
    batch = sample_attributes(spark, 40).withColumn(
        "attribute_name", F.concat(F.lit("new "), "attribute_name")
    )
    run = deduplicate_incremental(
        old.where("row_id < 36"), batch.where("row_id < 36"), max_clusters=4, starts=1, threshold=0.8
    )
    rows = run.result.collect()
    assert len(rows) == 24 + 36
    assert len({r["row_id"] for r in rows}) == 60
    assert {r["first_seen_in_round"] for r in rows if r["source"] == "new"} == {2}
    by_group = {}
    for r in rows:
        if r["duplicate_group_id"]:
            by_group.setdefault(r["duplicate_group_id"], []).append(r)
    mixed = [g for g in by_group.values() if any(r["source"] == "existing" for r in g)]
    assert mixed
    for group in mixed:
        kept = [r for r in group if not r["should_remove"]]
        assert all(r["source"] == "existing" for r in kept)


def test_previous_layouts(spark):
    rows = sample_attributes(spark, 4).withColumns(
        {"should_remove": F.lit(False), "keep": F.col("row_id") > 1, "is_duplicate": F.lit(True)}
    )
    assert prepare_previous(rows, "latest").count() == 4
    kept = prepare_previous(rows, "run")
    assert sorted(r.row_id for r in kept.collect()) == [2, 3]
    assert "keep" not in kept.columns and "is_duplicate" not in kept.columns
    with pytest.raises(ValueError):
        prepare_previous(rows, "other")
    with pytest.raises(ValueError):
        deduplicate(sample_attributes(spark, 4), incremental=True, threshold=THRESHOLD)
