"""CSV files with line breaks in cells, read in splits."""

import csv
import random

import pytest

from samesense.sources import tables as S


def written(path, rows, end="\r\n"):
    with open(path, "w", encoding="utf-8", newline="") as file:
        writer = csv.writer(file, lineterminator=end)
        writer.writerow(["attribute_name", "attribute_definition", "owner", "odd name"])
        writer.writerows(rows)


def cases(seed, n):
    rng = random.Random(seed)
    cells = ["a", 'say ""', "x\ny", "\n", 'q"q', "ünï", "a,b", "", "\r\nz", '"', "long " * 40, 'two\nlines "here"\n\nand, more']
    return [[f"name{i}", *rng.choices(cells, k=3)] for i in range(n)]


@pytest.mark.parametrize("size", [37, 200, 5000])
@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_records_of_small_splits(spark, tmp_path, size, end):
    rows = {name: cases(seed, 60) for seed, name in enumerate(("b", "a"))}
    for name, own in rows.items():
        written(tmp_path / f"{name}.csv", own, end)
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        read = S.read_attributes(spark, str(tmp_path))
        assert read.columns == ["row_id", "attribute_name", "attribute_definition", "owner", "odd name"]
        got = read.orderBy("row_id").collect()
    finally:
        for key, value in old.items():
            spark.conf.set(key, value)
    want = [tuple(c or None for c in row) for name in ("a", "b") for row in rows[name]]
    assert [tuple(r)[1:] for r in got] == want
    assert len({r.row_id for r in got}) == len(want)


def test_as_spark_reads_whole_files(spark, tmp_path):
    written(tmp_path / "x.csv", cases(5, 300))
    # whole files come with every line end inside a cell as one character; splits keep them
    plain = lambda cells: str([c and c.replace("\r\n", "\n") for c in cells])
    whole = sorted(plain(r) for r in S.read_csv(spark, str(tmp_path)).collect())
    split = sorted(plain(r[1:]) for r in S.read_csv_in_splits(spark, str(tmp_path)).collect())
    assert whole == split


def test_unmatched_quotes_are_read_whole(spark, tmp_path):
    (tmp_path / "x.csv").write_text('attribute_name,attribute_definition\na,5" wide\nb,c\n')
    assert S.read_csv_in_splits(spark, str(tmp_path)) is None
    assert S.read_attributes(spark, str(tmp_path)).count() >= 1


def test_header_only_and_blank_lines(spark, tmp_path):
    (tmp_path / "x.csv").write_text("attribute_name,attribute_definition\n")
    assert S.read_attributes(spark, str(tmp_path)).count() == 0
    (tmp_path / "x.csv").write_text('\n"attribute_name",attribute_definition\n\n\na,b\n\nc\n')
    got = [tuple(r) for r in S.read_attributes(spark, str(tmp_path)).orderBy("row_id").collect()]
    assert got == [(0, "a", "b"), (1, "c", None)]
