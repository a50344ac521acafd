"""Report, warehouse and per-file sinks."""

import csv
import uuid

import pytest
from pyspark.sql import functions as F

from evenkeel.session import scratch_path
from evenkeel.sinks import (
    append_to_table,
    create_database,
    read_report_csv,
    write_converted,
    write_per_file,
    write_report_csv,
)
from evenkeel.sources import csv_by_header, read_csv_inferred, read_parquet

NAMES = ["reconciliation_type", "key_1", "column_name", "source_value", "target_value"]
LINES = [
    ("MISSING_IN_TARGET", "1", None, None, None),
    ("VALUE_MISMATCH", 'say "hi"', "a,b", "line\nbreak", ""),
    ("VALUE_MISMATCH", "#5", "\\", "c\r\nd", "'"),
    ("VALUE_MISMATCH", "", "x", " padded ", "\\\""),
]


def test_report_csv_is_read_back_by_python(spark, tmp_path):
    path = tmp_path / "report"
    lines = spark.createDataFrame(LINES, ", ".join(f"{name} string" for name in NAMES))
    write_report_csv(lines.repartition(3), str(path))
    got = []
    for part in sorted(path.glob("part-*.csv")):
        with part.open(newline="", encoding="utf-8") as file:
            header, *rows = csv.reader(file)
        assert header == NAMES
        got += rows
    assert sorted(got) == sorted([cell or "" for cell in line] for line in LINES)
    back = {tuple(row) for row in read_report_csv(spark, str(path), NAMES).collect()}
    assert back == {tuple(cell or None for cell in line) for line in LINES}
    with pytest.raises(Exception, match="ALREADY_EXISTS|already exists"):
        write_report_csv(lines, str(path))


def test_warehouse_append(spark):
    database = f"db_{uuid.uuid4().hex}"
    create_database(spark, database)
    create_database(spark, database)
    rows = spark.createDataFrame([(1, "a")], "id int, name string")
    append_to_table(rows, database, "sales")
    append_to_table(rows.select("name", "id"), database, "sales", rebalance=False)
    table = spark.table(f"{database}.sales")
    assert [tuple(row) for row in table.collect()] == [(1, "a"), (1, "a")]
    with pytest.raises(Exception, match="format|provider"):
        append_to_table(rows, database, "sales", table_format="orc")


def test_per_file_output(spark, tmp_path):
    for name, text in (("a", "id,v\n1,x\n"), ("b c", "w\n2\n3\n")):
        (tmp_path / f"{name}.csv").write_text(text)
    for kind in ("parquet", "csv"):
        out = str(tmp_path / kind)
        write_per_file(csv_by_header(spark, f"{tmp_path}/*.csv"), out, kind)
        read = spark.read.option("header", True).format(kind)
        assert [tuple(r) for r in read.load(f"{out}/sheet_name=a").selectExpr("string(id)", "v").collect()] == [
            ("1", "x")
        ]
        other = read.load(f"{out}/sheet_name=b c")
        assert other.columns == ["w"]
        assert other.count() == 2


def test_per_file_output_refuses_a_shared_sheet_name(spark, tmp_path):
    for end in "xy":
        (tmp_path / f"{'n' * 31}{end}.csv").write_text("id\n1\n")
    write_per_file(csv_by_header(spark, f"{tmp_path}/*.csv"), str(tmp_path / "whole"))
    groups = csv_by_header(spark, f"{tmp_path}/*.csv", tag_length=31)
    with pytest.raises(ValueError, match="share the sheet name"):
        write_per_file(groups, str(tmp_path / "out"), tag_length=31)
    assert not (tmp_path / "out").exists()


def test_convert(spark, tmp_path):
    (tmp_path / "in.csv").write_text("id,v\n1,x\n2,\n")
    write_converted(read_csv_inferred(spark, str(tmp_path / "in.csv")), str(tmp_path / "out"))
    got = read_parquet(spark, str(tmp_path / "out"))
    assert got.dtypes == [("id", "int"), ("v", "string")]
    assert read_parquet(spark, str(tmp_path / "out"), partitions=5).rdd.getNumPartitions() == 5
    assert got.select(F.sum("id")).first()[0] == 3


def test_scratch_is_in_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    paths = {scratch_path(spark, "x") for _ in range(2)}
    assert len(paths) == 2
    assert all(path.startswith(shared) for path in paths)
