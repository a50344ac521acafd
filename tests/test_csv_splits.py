"""Split reads of quoted CSV files, against Python's csv module."""

import csv
import io
import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from evenkeel.plans import reconcile
from evenkeel.sources import combine_csv, csv_by_header, read_csv_inferred, read_csv_strict
from evenkeel.sources import csv_splits
from evenkeel.sources.csv import ORDINAL
from evenkeel.sinks import read_report_csv, write_per_file


@pytest.fixture
def split_at(spark):
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.files.minPartitionNum")
    before = {name: spark.conf.get(name, None) for name in names}

    def at(size):
        spark.conf.set(names[0], str(size))
        spark.conf.set(names[1], "0")

    yield at
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def python_rows(text):
    rows = [row for row in csv.reader(io.StringIO(text.removeprefix("﻿"), newline="")) if row]
    return [tuple(cell.strip() for cell in row) for row in rows[1:]]


def made(seed, n=400):
    """Rows with line breaks, doubled quotes, delimiters and stray quotes in cells."""
    rng = random.Random(seed)
    cell = lambda: "".join(rng.choice(['a', 'bc', ' ', ',', '""', "\n", "\r\n", "é", "'"]) for _ in range(rng.randrange(8)))
    lines = []
    for i in range(n):
        plain = rng.random() < 0.4
        cells = [str(i), rng.choice(["x", '5" pipe', 'a"b"c', " y "]) if plain else f'"{cell()}"', f'"{cell()}"' if rng.random() < 0.5 else "z"]
        lines.append(",".join(cells) + rng.choice(["\n", "\r\n", "\n\n"]))
    return "id,v,w\n" + "".join(lines)


@pytest.mark.parametrize("size", [40, 150, 1000, 100_000])
@pytest.mark.parametrize("seed", range(2))
def test_any_split_size_gives_pythons_rows_in_order(spark, tmp_path, split_at, size, seed, monkeypatch):
    text = ("﻿" if seed else "") + made(seed, 60 if size < 1000 else 400)
    (tmp_path / "in.csv").write_bytes(text.encode())
    split_at(size)
    if seed:
        monkeypatch.setattr(csv_splits, "KEPT", 6)  # most pieces are read again
    df = read_csv_strict(spark, str(tmp_path / "in.csv"), split=True, ordinal=True)
    if size < 100_000:
        assert df.rdd.getNumPartitions() > 3
    rows = df.orderBy(ORDINAL).drop(ORDINAL).collect()
    assert [tuple(row) for row in rows] == python_rows(text)


def test_a_record_longer_than_many_splits(spark, tmp_path, split_at):
    text = 'id,v\n1,"' + "line\n" * 3000 + '"\n2,b\n3,"' + 'x""\n' * 500 + '"\n'
    (tmp_path / "in.csv").write_text(text)
    split_at(512)
    df = read_csv_strict(spark, str(tmp_path / "in.csv"), split=True)
    assert sorted(tuple(row) for row in df.collect()) == sorted(python_rows(text))


def test_open_cells_and_headers(spark, tmp_path, split_at):
    (tmp_path / "a.csv").write_text("id,v\n" + "1,a\n" * 2000 + '2,"open\n' + "3,c\n" * 2000)
    split_at(4096)
    with pytest.raises(PySparkException, match="ends inside a quoted cell"):
        read_csv_strict(spark, str(tmp_path / "a.csv"), split=True).collect()
    (tmp_path / "b.csv").write_text('"i\nd","v,w"\n' + '1,"x\ny"\n' * 1000)
    df = read_csv_strict(spark, str(tmp_path / "b.csv"), split=True)
    assert df.columns == ["i\nd", "v,w"] and df.count() == 1000
    (tmp_path / "b2.csv").write_text('v,id\n1,2\n')
    with pytest.raises(PySparkException, match="header differs"):
        read_csv_strict(spark, str(tmp_path / "b*.csv"), split=True).collect()
    (tmp_path / "c.csv").write_text("\n" * 10_000 + "id,v\n1,a\n")
    with pytest.raises(ValueError, match="blank lines alone"):
        read_csv_strict(spark, str(tmp_path / "c.csv"), split=True).collect()


def test_inferred_split_types_equal_the_whole_files(spark, tmp_path, split_at):
    cells = ["7,1.5,2020-01-02,2020-01-02 03:04:05,true,\"a\nb\"", "-3,2,2021-11-30,2021-01-01 00:00:00,false,c", "9999999999,,,,,"]
    (tmp_path / "in.csv").write_text("i,d,day,time,flag,text\n" + "\n".join(cells * 300) + "\n")
    whole = read_csv_inferred(spark, str(tmp_path / "in.csv"))
    split_at(2048)
    parts = read_csv_inferred(spark, str(tmp_path / "in.csv"), split=True)
    assert parts.dtypes == whole.dtypes and parts.rdd.getNumPartitions() > 3
    assert sorted(parts.collect(), key=str) == sorted(whole.collect(), key=str)
    assert {t for _, t in read_csv_inferred(spark, str(tmp_path / "in.csv"), infer=False, split=True).dtypes} == {"string"}


def test_ten_thousand_small_files(spark, tmp_path, split_at):
    folder = tmp_path / "many"
    folder.mkdir()
    for i in range(10_000):
        header, row = ("id,v", f'{i},"a\n{i}"') if i % 4 else ("w,id", f"0.5,{i}")
        (folder / f"f{i:05}.csv").write_text(f"{header}\n{row}\n")
    split_at("128m")
    tables = csv_by_header(spark, str(folder))
    assert [t.columns for t in tables] == [["sheet_name", "file_path", "id", "v"], ["sheet_name", "file_path", "w", "id"]]
    assert tables.files.count() == 10_000
    got = [t.agg(F.count("*"), F.countDistinct("sheet_name"), F.sum("id")).first() for t in tables]
    ids = [sum(i for i in range(10_000) if bool(i % 4) == (k == 0)) for k in (0, 1)]
    assert [tuple(g) for g in got] == [(7500, 7500, ids[0]), (2500, 2500, ids[1])]
    assert tables[0].where("sheet_name = 'f00007'").first().v == "a\n7"


def test_shared_sheet_names_are_found(spark, tmp_path):
    for folder in ("a", "b"):
        (tmp_path / folder).mkdir()
        (tmp_path / folder / "same.csv").write_text(f"id,{folder}\n1,2\n")
    with pytest.raises(ValueError, match="share the sheet name 'same'"):
        write_per_file(csv_by_header(spark, f"{tmp_path}/*/*.csv"), str(tmp_path / "out"))
    with pytest.raises(ValueError, match="share the sheet name 'same'"):
        write_per_file(list(csv_by_header(spark, f"{tmp_path}/*/*.csv")), str(tmp_path / "out"))


def test_report_in_input_order(spark, tmp_path, split_at):
    """Missing rows and mismatches as in the source file, extra rows as in the target's."""
    rng = random.Random(1)
    keys = [f"k{i}" for i in range(600)]
    rng.shuffle(keys)
    source = [(k, rng.choice("ab\n"), rng.choice("cd")) for k in keys[:500]]
    target = [(k, rng.choice("ab\n"), rng.choice("cd")) for k in rng.sample(keys[60:], 480)]
    for name, rows in (("s", source), ("t", target)):
        with open(tmp_path / f"{name}.csv", "w", newline="") as out:
            csv.writer(out).writerows([("id", "v", "w"), *rows])
    split_at(700)
    sides = [read_csv_strict(spark, str(tmp_path / f"{n}.csv"), split=True, ordinal=True) for n in "st"]
    result = reconcile(*sides, "id", source_order=ORDINAL, target_order=ORDINAL)
    left, right = ({k: (v.strip(), w) for k, v, w in rows} for rows in (source, target))
    lines = [("MISSING_IN_TARGET", k, None, None, None) for k in left if k not in right]
    lines += [("EXTRA_IN_TARGET", k, None, None, None) for k in right if k not in left]
    for k, cells in left.items():
        if k in right:
            lines += [("VALUE_MISMATCH", k, c, a, b) for c, a, b in zip("vw", cells, right[k], strict=True) if a != b]
    assert [tuple(row) for row in result.report(ordered="input").collect()] == lines
    assert sorted(map(str, result.report().collect())) == sorted(map(str, result.report(ordered=True).collect()))
    counts = result.write(str(tmp_path / "report"), ordered="input")
    assert counts["missing_in_target"] == sum(line[0].startswith("MISSING") for line in lines)
    parts = sorted((tmp_path / "report").glob("*.csv"))
    written = [row for part in parts for row in list(csv.reader(part.open(newline="")))[1:]]
    assert [tuple(row[:3]) for row in written] == [(a, b, c or "") for a, b, c, *_ in lines]
    assert read_report_csv(spark, str(tmp_path / "report"), result.report().columns).count() == len(lines)
    with pytest.raises(ValueError, match="source_order"):
        reconcile(*sides, "id", "v").report(ordered="input")
