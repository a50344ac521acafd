"""The command-line jobs end to end."""

import csv
import sqlite3
import uuid

import pytest

from evenkeel.jobs import combine_csvs, load_csvs, reconcile
from evenkeel.operators import DuplicateKeyError


@pytest.fixture
def files(tmp_path):
    source = tmp_path / "source.csv"
    source.write_text("﻿id;amount;note\n1;10.5;a\n2;20;b\n3;30;\n", encoding="utf-8")
    db = sqlite3.connect(tmp_path / "target.db")
    db.execute("CREATE TABLE target_table (id INTEGER PRIMARY KEY, amount, note TEXT, own)")
    db.executemany(
        "INSERT INTO target_table VALUES (?, ?, ?, ?)",
        [(1, 10.5, " a ", 1), (2, 21, "b", 1), (4, 40, "d", 2)],
    )
    db.commit()
    db.close()
    return tmp_path


def report(folder):
    rows = []
    for part in sorted(folder.glob("part-*.csv")):
        with part.open(newline="", encoding="utf-8") as file:
            header, *lines = csv.reader(file)
        rows += lines
    return [header, *rows]


def run(spark, files, *flags):
    out = files / uuid.uuid4().hex
    common = ["--source-file", str(files / "source.csv"), "--delimiter", ";", "--key-columns", "id"]
    summary = reconcile.main([*common, "--report-file", str(out), *flags], spark)
    return summary, report(out) if out.exists() else None


def test_sqlite_job(spark, files, capsys):
    target = ["--sqlite-db", str(files / "target.db"), "--table", "target_table"]
    summary, lines = run(spark, files, *target, "--debug")
    assert list(summary.values()) == [3, 3, 1, 1, 1]
    assert lines == [
        ["reconciliation_type", "key_1", "column_name", "source_value", "target_value"],
        ["MISSING_IN_TARGET", "3", "", "", ""],
        ["EXTRA_IN_TARGET", "4", "", "", ""],
        ["VALUE_MISMATCH", "2", "amount", "20", "21"],
    ]
    printed = capsys.readouterr().out
    assert "value_mismatches: 1" in printed and "Physical Plan" in printed
    assert run(spark, files, *target, "--compare-columns", "note")[0]["value_mismatches"] == 0
    out = ["--report-file", str(files / "again")]
    run(spark, files, *target, *out)
    with pytest.raises(FileExistsError, match="already exists"):
        run(spark, files, *target, *out, "--keep-report")
    assert run(spark, files, *target, *out)[0]["value_mismatches"] == 1  # replaced
    assert run(spark, files, *target, "--compare-columns", "")[0]["value_mismatches"] == 1
    assert run(spark, files, *target, "--where", "own = 1")[0]["extra_in_target"] == 0
    with pytest.raises(ValueError, match="lacks compare"):
        (files / "source.csv").write_text("id;gone\n1;x\n")
        run(spark, files, *target, "--compare-columns", "gone")


def test_sqlite_job_reports_repeated_keys(spark, files):
    (files / "source.csv").write_text("id;note\n1;x\n 1;y\n")
    with pytest.raises(DuplicateKeyError, match="source"):
        run(spark, files, "--sqlite-db", str(files / "target.db"), "--table", "target_table")


def test_jdbc_job_loads_and_agrees(spark, files, monkeypatch):
    url = f"jdbc:derby:memory:job{uuid.uuid4().hex};create=true"
    spark.createDataFrame([(9, 1.0, "z")], "ID int, AMOUNT double, NOTE string").write.jdbc(url, "loaded")
    monkeypatch.setenv("SECRET_FOR_THE_TEST", "")
    flags = ["--jdbc-url", url, "--table", "loaded", "--target-label", "oracle"]
    flags += ["--compare-columns", "amount,note", "--partition-column", "id", "--partitions", "2"]
    summary, lines = run(spark, files, *flags, "--load-target", "--truncate-target")
    assert summary["oracle_rows"] == 3
    assert summary["missing_in_oracle"] == summary["extra_in_oracle"] == 0
    assert lines[0][-1] == "oracle_value"
    assert [line[2:] for line in lines[1:]] == [["amount", "20", "20.0"], ["amount", "30", "30.0"]]
    assert run(spark, files, *flags, "--where", "id < 3")[0]["missing_in_oracle"] == 1


def test_job_flags_that_do_not_fit(spark, files):
    for flags in (
        ["--table", "t"],
        ["--table", "t", "--sqlite-db", "x", "--jdbc-url", "y"],
        ["--table", "t", "--sqlite-db", "x", "--load-target"],
    ):
        with pytest.raises(SystemExit):
            run(spark, files, *flags)


def test_sqlite_job_reads_keys_and_compared_columns_alone(spark, files):
    for compare, columns in ((None, {"id", "amount", "note"}), ("note", {"id", "note"})):
        flags = ["--source-file", str(files / "source.csv"), "--delimiter", ";", "--key-columns", "id", "--table", "target_table"]
        flags += ["--sqlite-db", str(files / "target.db")] + (["--compare-columns", compare] if compare else [])
        scanned = reconcile.plan(spark, reconcile.parser().parse_args(flags))._target.columns
        assert set(scanned) == columns


def test_jdbc_job_reads_in_parallel(spark, files):
    url = f"jdbc:derby:memory:job{uuid.uuid4().hex};create=true"
    rows = [(i, f"k{i}", float(i)) for i in range(40)]
    spark.createDataFrame(rows, "ID int, NAME string, AMOUNT double").write.option("createTableColumnTypes", "NAME VARCHAR(20)").jdbc(url, "t")
    (files / "named.csv").write_text("id;name;amount\n" + "".join(f"{i};k{i};{float(i)}\n" for i in range(40)))

    def target(*flags):
        common = ["--source-file", str(files / "named.csv"), "--delimiter", ";", "--jdbc-url", url, "--table", "t"]
        return reconcile.plan(spark, reconcile.parser().parse_args([*common, *flags]))._target

    assert target("--key-columns", "id", "--partitions", "4").rdd.getNumPartitions() == 4
    with pytest.raises(ValueError, match="--predicate"):
        target("--key-columns", "name")
    assert target("--key-columns", "name", "--single-read").rdd.getNumPartitions() == 1
    halves = target("--key-columns", "name", "--predicate", "ID < 20", "--predicate", "ID >= 20")
    assert halves.rdd.getNumPartitions() == 2 and halves.count() == 40


def test_jobs_size_their_shuffles(spark, files):
    setting = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    target = ["--sqlite-db", str(files / "target.db"), "--table", "target_table"]
    try:
        run(spark, files, *target, "--input-bytes", str(1 << 40))
        assert spark.conf.get(setting) == str(-(-(1 << 40) // (200 << 20)))
        run(spark, files, *target)
        assert spark.conf.get(setting) == "200"
    finally:
        spark.conf.unset(setting)


def test_staged_lines_are_deleted(spark, files):
    from pathlib import Path

    shared = Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file:"))
    before = set(shared.glob("evenkeel-*"))
    target = ["--sqlite-db", str(files / "target.db"), "--table", "target_table"]
    run(spark, files, *target)
    (files / "source.csv").write_text("id;note\n1;x\n 1;y\n")
    with pytest.raises(DuplicateKeyError):
        run(spark, files, *target)
    assert set(shared.glob("evenkeel-*")) == before


def test_load_csvs_job(spark, tmp_path):
    for i in range(3):
        (tmp_path / f"{i}.csv").write_text(f"id,name,amount,category\n{i},a,1.5,x\nbad,b,1,y\n{i}\n")
    database = f"db_{uuid.uuid4().hex}"
    for extra in ([], ["--partitions", "2"]):
        schema = "id INT, name STRING, amount DOUBLE, category STRING"
        flags = ["--database", database, "--table", "sales_csv", "--schema", schema]
        load_csvs.main(["--csv", f"{tmp_path}/*.csv", *flags, *extra], spark)
    table = spark.table(f"{database}.sales_csv")
    assert sorted(row.id for row in table.collect()) == [0, 0, 1, 1, 2, 2]
    assert table.dtypes == [("id", "int"), ("name", "string"), ("amount", "double"), ("category", "string")]


def test_combine_csvs_job(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id\n1\n")
    (tmp_path / "b.csv").write_text("v,id\nx,2\n")
    out = str(tmp_path / "out")
    combine_csvs.main(["--csv", f"{tmp_path}/*.csv", "--output", out], spark)
    got = spark.read.option("mergeSchema", True).parquet(out)
    assert {(r.sheet_name, r.id, r.v) for r in got.collect()} == {("a", 1, None), ("b", 2, "x")}
