"""CSV readers at their edges."""

import csv
import io
import re

import pytest
from py4j.protocol import Py4JError
from pyspark.errors import PySparkException

from evenkeel.sources import (
    combine_csv,
    csv_by_header,
    read_csv_dropping_bad,
    read_csv_inferred,
    read_csv_strict,
    read_csv_typed,
)
from evenkeel.sources.csv import DOUBLED

SALES = "id INT, name STRING, amount DOUBLE, category STRING"


@pytest.fixture
def put(tmp_path):
    def write(text, name="in.csv"):
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(text.encode() if isinstance(text, str) else text)
        return str(path)

    return write


def python_rows(text, delimiter=","):
    reader = csv.reader(io.StringIO(text.removeprefix("﻿"), newline=""), delimiter=delimiter)
    rows = [row for row in reader if row]
    return [name.strip() for name in rows[0]], sorted(tuple(c.strip() for c in r) for r in rows[1:])


SAME_AS_PYTHON = {
    "plain": "id,v\n1,a\n2,b\n",
    "bom": "﻿id,v\n1,a\n",
    "windows lines": "id,v\r\n1,a\r\n2,b\r\n",
    "no last line break": "id,v\n1,a",
    "blank lines": "id,v\n\n1,a\n\n\n2,b\n",
    "doubled quotes": 'id,v\n1,"say ""hi"""\n2,""""\n',
    "line break in quotes": 'id,v\n1,"a\nb"\n2,"c\r\nd"\n',
    "delimiter in quotes": 'id,v\n1,"a,b"\n',
    "quoted header": '"id","the ""v"""\n1,a\n',
    "blanks": 'id,v\n1,\n2,""\n3,"  "\n',
    "padding": "id,v\n 1 ,\ta \n2,\u00a0b\u3000\n",
    "padded header": " id , v\n1,a\n",
    "quote inside a cell": 'id,v\n1,5" pipe\n2,a"b"c\n',
    "backslashes": 'id,v\n1,a\\\n2,"b\\"\n3,"\\n"\n',
    "hash and null words": "id,v\n1,#x\n2,null\n3,NULL\n4,NaN\n",
    "dots and backticks in names": "id,v.w,x`y\n1,a,b\n",
    "one column": "id\n1\n2\n",
    "header only": "id,v\n",
    "a line of white space": "id\n1\n  \n2\n",
}


SAME_AS_PYTHON |= {
    "stray quotes": 'id,a,b\n0,5" x,"p\n0q,r,s,t",6" y\n',
    "line ends of both kinds": "id,v\r\n1,a\n2,b\r\n",
}
REFUSED = {
    "carriage returns end all lines": "id,v\r1,a\r2,b\r",
    "return before an empty cell": "id,v,w\n0,a\r,\n",
    "lone carriage return": "id,v\n0,a\rb0,c\n",
    "quoted carriage return": 'id,v\n0,"a\rb0"\n',
    "text behind a quote": 'id,v\n1,"ab"c\n',
}
NOT_ONE_LINE_ROWS = ("line break in quotes", "stray quotes", "a line of white space")


def longer(text):
    """The same rows over and over, so that an 8 kB split cuts the file."""
    first = re.search("\r\n|\n|\r", text).end()
    return text[:first] + text[first:] * (1 + 30_000 // max(1, len(text) - first)) if len(text) > first else text


@pytest.fixture(params=["one split", "many splits"])
def splits(spark, request):
    default = spark.conf.get("spark.sql.files.maxPartitionBytes")
    if request.param == "many splits":
        spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    yield
    spark.conf.set("spark.sql.files.maxPartitionBytes", default)


@pytest.mark.parametrize("case", SAME_AS_PYTHON)
def test_strict_source_equals_python(spark, put, case, splits):
    text = SAME_AS_PYTHON[case]
    if case != "no last line break":
        text = longer(text)
    names, rows = python_rows(text)
    rows = sorted(row[: len(names)] for row in rows)  # surplus cells are ignored
    path = put(text)
    df = read_csv_strict(spark, path)
    assert df.columns == names
    assert sorted(tuple(row) for row in df.collect()) == rows
    some = read_csv_strict(spark, path, columns=names[:1])
    assert sorted(tuple(row) for row in some.collect()) == sorted(row[:1] for row in rows)
    parts = read_csv_strict(spark, path, split=True)
    assert parts.columns == names
    assert sorted(tuple(row) for row in parts.collect()) == rows
    if case not in NOT_ONE_LINE_ROWS:
        lines = read_csv_strict(spark, path, multi_line=False)
        assert lines.columns == names
        assert sorted(tuple(row) for row in lines.collect()) == rows


@pytest.mark.parametrize("case", REFUSED)
def test_strict_source_refuses_what_it_cannot_tell(spark, put, case, splits):
    path = put(longer(REFUSED[case]))
    for columns in (None, ["id"]):
        with pytest.raises((PySparkException, Py4JError, ValueError)):
            read_csv_strict(spark, path, columns=columns).collect()
        with pytest.raises((PySparkException, Py4JError, ValueError)):
            read_csv_strict(spark, path, columns=columns, split=True).collect()
    if case != "carriage returns end all lines":
        with pytest.raises((PySparkException, Py4JError)):
            read_csv_inferred(spark, path).collect()


def test_one_line_rows_refuse_open_cells_and_follow_carriage_returns(spark, put, splits):
    for case in ("line break in quotes", "stray quotes"):
        for columns in (None, ["id"]):
            with pytest.raises((PySparkException, Py4JError)):
                read_csv_strict(spark, put(longer(SAME_AS_PYTHON[case])), columns=columns, multi_line=False).collect()
    for case in ("quoted carriage return", "text behind a quote"):
        with pytest.raises((PySparkException, Py4JError)):
            read_csv_strict(spark, put(longer(REFUSED[case])), multi_line=False).collect()
    text = longer(REFUSED["lone carriage return"])
    got = read_csv_strict(spark, put(text), multi_line=False).collect()
    assert sorted(tuple(row) for row in got) == python_rows(text)[1]


def test_one_line_rows_are_split(spark, put):
    path = put("id,v\n" + "".join(f'{i},"x{i}"\n' for i in range(3000)))
    default = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    try:
        df = read_csv_strict(spark, path, multi_line=False)
        assert df.rdd.getNumPartitions() > 1 and df.distinct().count() == 3000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", default)


def test_names_that_differ_in_case_are_refused(spark, put):
    with pytest.raises(ValueError, match="letter case"):
        read_csv_strict(spark, put("id,v,V\n1,2,3\n"))


def test_escapes_of_typed_files(spark, put):
    path = put('column1,column2\n"a\\"b",1\n"c""d",2\n')
    schema = "column1 STRING, column2 INT"
    for read in (read_csv_typed, read_csv_dropping_bad):
        assert read(spark, path, schema).where("column2 = 1").first().column1 == 'a"b'
        assert read(spark, path, schema, escape=DOUBLED).where("column2 = 2").first().column1 == 'c"d'


@pytest.mark.parametrize("delimiter", [";", "|", "\t", "^", "||"])
def test_strict_source_delimiters(spark, put, delimiter):
    text = f'id{delimiter}v\n1{delimiter}"a{delimiter}b"\n2{delimiter}c,d\n'
    df = read_csv_strict(spark, put(text), delimiter)
    assert sorted(tuple(row) for row in df.collect()) == [("1", f"a{delimiter}b"), ("2", "c,d")]


def test_strict_source_bad_files(spark, put):
    with pytest.raises(ValueError, match="no header"):
        read_csv_strict(spark, put("", "empty.csv"))
    with pytest.raises(ValueError, match="repeats"):
        read_csv_strict(spark, put("id,v, id\n1,2,3\n", "twice.csv"))
    with pytest.raises(ValueError, match="lacks"):
        read_csv_strict(spark, put("id,v\n1,2\n", "lacks.csv"), columns=["id", "w"])
    with pytest.raises(PySparkException, match="PATH_NOT_FOUND"):
        read_csv_strict(spark, "/nowhere/at/all.csv")


@pytest.mark.parametrize("multi_line", [False, True])
def test_strict_source_short_and_long_rows(spark, put, multi_line):
    short = put("id,v,w\n1,a,x\n2,b\n", "short.csv")
    for query in (
        lambda df: df.collect(),
        lambda df: df.count(),
        lambda df: df.select("id").collect(),
        lambda df: df.where("id = '1'").count(),
    ):
        with pytest.raises(PySparkException, match="too short.*2,b"):
            query(read_csv_strict(spark, short, multi_line=multi_line))
    # only the columns in use must be there
    used = read_csv_strict(spark, short, columns=["v", "id"], multi_line=multi_line)
    assert sorted(tuple(row) for row in used.collect()) == [("a", "1"), ("b", "2")]
    long = put('id,v\n1,a,x\n2,,\n3,"q,",z\n4,b\n', "long.csv")
    df = read_csv_strict(spark, long, multi_line=multi_line)
    assert sorted(tuple(row) for row in df.collect()) == [("1", "a"), ("2", ""), ("3", "q,"), ("4", "b")]
    assert df.count() == 4
    quoted = put('id,v,w\n1,"a,b,c"\n', "quoted.csv")
    with pytest.raises(PySparkException, match="too short"):
        read_csv_strict(spark, quoted, multi_line=multi_line).collect()


def test_strict_source_names_blank_columns(spark, put):
    df = read_csv_strict(spark, put("id,v,\n1,a,\n2,b,c\n"))
    assert df.columns == ["id", "v", "_c2"]
    assert df.count() == 2


def test_strict_source_many_files_need_one_header(spark, put):
    put("id,v\n1,a\n", "many/1.csv")
    folder = put("id,v\n2,b\n", "many/2.csv").rsplit("/", 1)[0]
    assert read_csv_strict(spark, folder).count() == 2
    put("v,id\nc,3\n", "many/3.csv")
    with pytest.raises(Py4JError, match="CSV header"):
        read_csv_strict(spark, folder).collect()


def test_bad_rows_are_dropped_whatever_is_read(spark, put):
    text = "id,name,amount,category\n1,a,1.5,x\nbad,b,2.5,y\n3,c,zz,z\n4,d\n5,e,1,f,g\n6,,,\n"
    df = read_csv_dropping_bad(spark, put(text), SALES)
    assert df.count() == 2
    assert sorted(tuple(row) for row in df.collect()) == [(1, "a", 1.5, "x"), (6, None, None, None)]
    assert len(df.select("name").collect()) == 2
    assert len(df.select("id").collect()) == 2
    assert df.selectExpr("count(*) AS n", "count(id) AS ids").first() == (2, 2)
    assert df.where("amount > 1").count() == 1
    assert df.groupBy("category").count().count() == 2


def test_typed_load(spark, put):
    path = put("column1,column2,column3\na,1,1.5\nb,x,2\n")
    schema = "column1 STRING, column2 INT, column3 DOUBLE"
    df = read_csv_typed(spark, path, schema)
    assert [tuple(r) for r in df.collect()] == [("a", 1, 1.5), ("b", None, 2.0)]
    assert read_csv_typed(spark, path, schema, partitions=3).rdd.getNumPartitions() == 3
    swapped = put("column2,column1,column3\n1,a,1.5\n", "swapped.csv")
    with pytest.raises(Py4JError, match="CSV header"):
        read_csv_typed(spark, swapped, schema).collect()
    by_position = read_csv_typed(spark, swapped, schema, check_header=False).collect()
    assert [tuple(r) for r in by_position] == [("1", None, 1.5)]


def test_inferred(spark, put):
    df = read_csv_inferred(spark, put('a,b,c\n1,1.5,"x\ny"\n2,2,z\n'))
    assert dict(df.dtypes) == {"a": "int", "b": "double", "c": "string"}
    assert df.count() == 2


def test_combine_files_of_different_headers(spark, put):
    put("id,v\n1,a\n2,b\n", "all/first + file.csv")
    put("﻿id,v\nx,c\n", "all/second.csv.csv")
    put("w,id\n0.5,7\n", "all/" + "long" * 10 + ".csv")
    glob = put("id,v\n9,d\n", "all/third.csv").rsplit("/", 1)[0] + "/*.csv"
    df = combine_csv(spark, glob)
    assert df.columns[:2] == ["sheet_name", "file_path"]
    got = {(r.sheet_name, r.id, r.v, r.w) for r in df.collect()}
    assert got == {
        ("first + file", "1", "a", None),
        ("first + file", "2", "b", None),
        ("second", "x", "c", None),
        ("long" * 10, "7", None, 0.5),
        ("third", "9", "d", None),
    }
    assert {r.sheet_name for r in combine_csv(spark, glob, tag_length=5).collect()} == {"first", "secon", "longl", "third"}
    assert len(csv_by_header(spark, glob)) == 2
    with pytest.raises(Py4JError, match="CSV header"):
        combine_csv(spark, glob, infer=False, same_header=True).collect()


def test_combine_widens_numbers(spark, put):
    put("id,v\n1,1\n", "n/a.csv")
    folder = put("v,id\n1.5,2\n", "n/b.csv").rsplit("/", 1)[0]
    assert {(r.id, r.v) for r in combine_csv(spark, folder).collect()} == {(1, 1.0), (2, 1.5)}
