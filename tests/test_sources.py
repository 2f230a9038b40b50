import glob
import os

import pytest
from pyspark.sql import functions as F

from samesense.sources import tables as S
from samesense.sources.sample import SYNONYMS, sample_attributes
from samesense.storage import checkpoint_folder, store


def test_attributes_keep_file_order_and_quoting(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text(
        'attribute_name,attribute_definition,owner\n'
        'first,"one, two",x\nsecond,"line\nbreak ""quoted""",\nthird,,y\nNA,"",z\n',
        encoding="utf-8",
    )
    rows = S.read_attributes(spark, str(path)).orderBy("row_id").collect()
    assert [tuple(r) for r in rows] == [
        (0, "first", "one, two", "x"),
        (1, "second", 'line\nbreak "quoted"', None),
        (2, "third", None, "y"),
        (3, "NA", None, "z"),
    ]


def test_attributes_need_their_columns(spark, tmp_path):
    path = tmp_path / "b.csv"
    path.write_text("name,definition\na,b\n")
    with pytest.raises(ValueError, match="attribute_name"):
        S.read_attributes(spark, str(path))


def test_ids_follow_file_names(spark, tmp_path):
    for name in ("b", "a"):
        (tmp_path / f"{name}.csv").write_text(
            "attribute_name,attribute_definition\n" + "".join(f"{name}{i},d\n" for i in range(3))
        )
    rows = S.read_attributes(spark, str(tmp_path)).orderBy("row_id").collect()
    assert [r.attribute_name for r in rows] == ["a0", "a1", "a2", "b0", "b1", "b2"]


def test_results_come_back_with_their_types(spark, tmp_path):
    path = str(tmp_path / "r")
    rows = spark.createDataFrame(
        [(1, "a", True, None), (2, ' b "c"\nd ', False, "g")],
        "row_id bigint, attribute_name string, is_duplicate boolean, duplicate_group_id string",
    )
    S.write_csv(rows, path)
    assert sorted(map(tuple, S.read_csv(spark, path).collect())) == sorted(map(tuple, rows.collect()))


def test_json_documents_and_text(spark, tmp_path):
    (tmp_path / "d.json").write_text('[\n {"a": 1},\n {"a": 2}\n]')
    assert sorted(r.a for r in S.read_json(spark, str(tmp_path / "d.json"), "a int").collect()) == [1, 2]
    (tmp_path / "t.txt").write_text("one\ntwo\n")
    assert S.read_text(spark, str(tmp_path / "t.txt")).first().value == "one\ntwo\n"


def test_merge(spark):
    old = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    new = spark.createDataFrame([("b", None), ("c", 4)], "k string, v int")
    got = {r.k: r.v for r in S.merge_keys(old, new, "k").collect()}
    assert got == {"a": 1, "b": None, "c": 4}
    with pytest.raises(ValueError):
        S.merge_keys(old, new.withColumnRenamed("v", "w"), "k")


def test_an_update_replaces_only_the_folders_of_its_keys(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = lambda pairs: spark.createDataFrame(pairs, "k string, v int")
    files = lambda: {f for f in glob.glob(f"{path}/*/*.parquet")}
    read = lambda: {r.k: r.v for r in S.read_upserted(spark, path).collect()}
    assert S.upsert(rows([(f"k{i}", i) for i in range(40)] + [(None, 7)]), path, "k", buckets=8) == 8
    before = files()
    want = {f"k{i}": i for i in range(40)} | {None: 7}
    assert read() == want and len(before) == 8
    # another number of buckets later on changes nothing
    assert S.upsert(rows([("k3", None)]), path, "k", buckets=5) == 1
    assert read() == want | {"k3": None} and len(files() & before) == 7
    assert S.upsert(rows([("new", 1), (None, 8)]), path, "k") <= 2
    assert read() == want | {"k3": None, "new": 1, None: 8} and len(files() & before) >= 5
    assert S.upsert(rows([]), path, "k") == 0
    with pytest.raises(ValueError):
        S.upsert(rows([("a", 1)]).withColumnRenamed("v", "w"), path, "k")


@pytest.mark.parametrize("n", [0, 5, 36, 50])
def test_sample(spark, n):
    rows = sample_attributes(spark, n).orderBy("row_id").collect()
    assert [r.row_id for r in rows] == list(range(n))
    assert [r.attribute_name for r in rows[:36]] == [s[0] for s in SYNONYMS[:n]]
    if n > 36:
        assert rows[36].attribute_definition == "Definition for attribute_0"


def test_stored_tables_live_in_the_checkpoint_folder(spark):
    folder = checkpoint_folder(spark)
    before = set(glob.glob(f"{folder.removeprefix('file:')}/samesense/*"))
    stored = store(spark.range(3).withColumn("x", F.lit(1)), "t")
    assert stored.count() == 3
    assert len(set(glob.glob(f"{folder.removeprefix('file:')}/samesense/*")) - before) == 1
    assert os.path.isdir(folder.removeprefix("file:"))
