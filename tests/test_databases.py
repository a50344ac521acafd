"""SQLite and JDBC ends; JDBC runs on a database inside the Spark process."""

import sqlite3
import uuid
from decimal import Decimal

import pytest
from py4j.protocol import Py4JError
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from evenkeel.operators import DuplicateKeyError
from evenkeel.plans import reconcile
from evenkeel.sinks import LoadError, load_exactly_once, load_target
from evenkeel.sources import jdbc_table, sqlite_table

VALUES = [
    (1, "a", 1.5, None),
    (2, " b ", 1e16, b"x"),
    (3, "", 0.1, 7),
    (4, None, -2.5, "7.0"),
]


@pytest.fixture
def database(tmp_path):
    def make(*statements, rows=(), name="t.db"):
        path = tmp_path / name
        db = sqlite3.connect(path)
        for statement in statements:
            db.execute(statement)
        db.executemany("INSERT INTO t VALUES (?, ?, ?, ?)", rows)
        db.commit()
        db.close()
        return str(path)

    return make


def python_texts(rows):
    return sorted(tuple(None if cell is None else str(cell) for cell in row) for row in rows)


def test_sqlite_values_keep_pythons_text(spark, database):
    path = database("CREATE TABLE t (id INTEGER PRIMARY KEY, v TEXT, x REAL, any)", rows=VALUES)
    df = sqlite_table(spark, path, "t")
    assert df.columns == ["id", "v", "x", "any"]
    assert sorted(tuple(row) for row in df.collect()) == python_texts(VALUES)
    assert df.count() == 4
    assert sqlite_table(spark, "file:" + path, "t", columns=["x"]).columns == ["x"]


def test_sqlite_where_is_sqlites_own(spark, database):
    path = database("CREATE TABLE t (id INTEGER PRIMARY KEY, v TEXT, x REAL, any)", rows=VALUES)
    df = sqlite_table(spark, path, "t", where="typeof(any) = 'blob' OR id = 1 -- comment")
    assert sorted(row.id for row in df.collect()) == ["1", "2"]
    with pytest.raises(Exception, match="sqlite3"):
        sqlite_table(spark, path, "t", where="1); DELETE FROM t; --").collect()
    assert sqlite_table(spark, path, "t").count() == 4


def test_sqlite_ranges_follow_the_rowids(spark, database):
    ids = [*range(1000), *range(10**9, 10**9 + 1000), 2**62]
    path = database(
        "CREATE TABLE t (id INTEGER PRIMARY KEY, v, x, rowid)", rows=[(i, i, i, i) for i in ids]
    )
    df = sqlite_table(spark, path, "t", ranges=8)
    assert df.rdd.getNumPartitions() == 8
    assert sorted(int(row.id) for row in df.collect()) == ids
    sizes = df.rdd.glom().map(len).collect()
    assert max(sizes) <= 600
    assert sqlite_table(spark, path, "t", ranges=5000).count() == len(ids)


def test_sqlite_tables_without_rowid_views_and_empty(spark, database):
    path = database(
        "CREATE TABLE t (id INTEGER, v, x, any, PRIMARY KEY (id)) WITHOUT ROWID",
        "CREATE VIEW seen AS SELECT id, v FROM t",
        "CREATE TABLE none (id INTEGER)",
        'CREATE TABLE "odd ""name" ("a b" TEXT, "select" TEXT)',
        """INSERT INTO "odd ""name" VALUES ('1', '2')""",
        rows=VALUES,
    )
    assert sqlite_table(spark, path, "t", ranges=4).count() == 4
    assert sqlite_table(spark, path, "seen").count() == 4
    assert sqlite_table(spark, path, "none").count() == 0
    assert tuple(sqlite_table(spark, path, 'odd "name').first()) == ("1", "2")
    with pytest.raises(ValueError, match="not found"):
        sqlite_table(spark, path, "nope")
    with pytest.raises(ValueError, match="lacks"):
        sqlite_table(spark, path, "t", columns=["w"])
    with pytest.raises(FileNotFoundError):
        sqlite_table(spark, path + ".missing", "t")
    with pytest.raises(ValueError, match="mounted"):
        sqlite_table(spark, "hdfs://host/t.db", "t")


def test_sqlite_many_files(spark, database, tmp_path):
    for i in range(3):
        database("CREATE TABLE t (id, v, x, any)", rows=[(i, "a", 1, 1)], name=f"{i}.db")
    assert sqlite_table(spark, str(tmp_path / "*.db"), "t").count() == 3


def test_sqlite_target_reconciles(spark, database):
    path = database("CREATE TABLE t (id INTEGER PRIMARY KEY, v TEXT, x REAL, any)", rows=VALUES)
    source = spark.createDataFrame(
        [("1", "a", "1.5", ""), ("2", "b", "1e+16", "b'x'"), ("3", "", "0.10", "7"), ("5", "", "", "")],
        "id string, v string, x string, any string",
    )
    got = {tuple(row) for row in reconcile(source, sqlite_table(spark, path, "t"), "id").report().collect()}
    assert got == {
        ("VALUE_MISMATCH", "3", "x", "0.10", "0.1"),
        ("MISSING_IN_TARGET", "5", None, None, None),
        ("EXTRA_IN_TARGET", "4", None, None, None),
    }


@pytest.fixture
def url():
    return f"jdbc:derby:memory:db{uuid.uuid4().hex};create=true"


def make_table(spark, url, name="target_table"):
    empty = spark.createDataFrame([], "ID int, AMOUNT decimal(10,2), NOTE string")
    empty.write.option("createTableColumnTypes", "NOTE VARCHAR(50)").jdbc(url, name)
    return name


def source_rows(spark):
    return spark.createDataFrame(
        [(" 1 ", "10.50", "x"), ("2", "", " y "), ("3", "7", "")], "ID string, AMOUNT string, NOTE string"
    )


def test_jdbc_load_appends_keys_and_cells(spark, url):
    name = make_table(spark, url)
    load_target(source_rows(spark), url, name, "ID", "AMOUNT,NOTE")
    got = sorted(tuple(row) for row in jdbc_table(spark, url, name).collect())
    assert got == [(1, Decimal("10.50"), "x"), (2, None, "y"), (3, Decimal("7.00"), "")]
    more = spark.createDataFrame([("4", "1", "z")], "ID string, AMOUNT string, NOTE string")
    load_target(more, url, name, ["ID"])
    assert jdbc_table(spark, url, name).count() == 4
    with pytest.raises(ValueError, match="lacks"):
        load_target(more.withColumnRenamed("NOTE", "other"), url, name, ["ID"])


def test_jdbc_load_truncates_even_for_no_rows(spark, url):
    name = make_table(spark, url)
    load_target(source_rows(spark), url, name, "ID")
    load_target(source_rows(spark).where("ID = '3'"), url, name, "ID", truncate=True)
    assert [row.ID for row in jdbc_table(spark, url, name).collect()] == [3]
    load_target(source_rows(spark).where("false"), url, name, "ID", truncate=True)
    assert jdbc_table(spark, url, name).count() == 0
    assert jdbc_table(spark, url, name).schema["AMOUNT"].dataType.simpleString() == "decimal(10,2)"


def test_jdbc_load_refuses_repeated_keys_first(spark, url):
    name = make_table(spark, url)
    load_target(source_rows(spark), url, name, "ID")
    twice = source_rows(spark).unionAll(source_rows(spark))
    with pytest.raises(DuplicateKeyError, match="source"):
        load_target(twice, url, name, "ID", truncate=True)
    assert jdbc_table(spark, url, name).count() == 3


def test_jdbc_load_notices_rows_inserted_twice(spark, url, monkeypatch):
    name = make_table(spark, url)
    write = DataFrameWriter.jdbc

    def write_again(self, *args, **options):
        write(self, *args, **options)
        write(self, *args, **{**options, "mode": "append"})

    monkeypatch.setattr(DataFrameWriter, "jdbc", write_again)
    with pytest.raises(LoadError, match="6 rows after the load, not 3"):
        load_target(source_rows(spark), url, name, "ID")
    with pytest.raises(LoadError, match="6 rows after the load, not 3"):
        load_target(source_rows(spark), url, name, "ID", truncate=True)


def test_jdbc_reads_in_parallel_and_pushes_down(spark, url):
    spark.range(1000).selectExpr("CAST(id AS INT) AS id", "id % 7 AS v", "id AS w").write.jdbc(url, "many")
    df = jdbc_table(spark, url, "many", ["ID", "V"], "v = 3", "id", partitions=4)
    assert df.columns == ["ID", "V"]
    assert df.rdd.getNumPartitions() == 4
    assert df.count() == 143
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [*IsNotNull(v), *EqualTo(v,3)]" in plan
    assert "w" not in plan.split("ReadSchema:")[1]
    halves = ['"id" < 500', '"id" >= 500']
    assert jdbc_table(spark, url, "many", predicates=halves).rdd.getNumPartitions() == 2
    assert jdbc_table(spark, url, "many", predicates=halves).count() == 1000
    spark.range(0).selectExpr("id").write.jdbc(url, "nothing")
    assert jdbc_table(spark, url, "nothing", partition_column="id").count() == 0


def test_jdbc_reconcile_by_decimal_style(spark, url):
    name = make_table(spark, url)
    source = source_rows(spark)
    load_target(source, url, name, "ID")
    target = jdbc_table(spark, url, name)

    def differing(**options):
        return {tuple(row)[1:] for row in reconcile(source, target, "ID", **options).report().collect()}

    assert differing() == {("3", "AMOUNT", "7", "7.00")}
    assert differing(decimals="stripped") == {("1", "AMOUNT", "10.50", "10.5")}
    assert differing(compare=["NOTE"]) == set()


def test_jdbc_table_must_exist(spark, url):
    with pytest.raises(Py4JError):
        jdbc_table(spark, url, "nope")


@pytest.mark.parametrize("url", ["jdbc:mariadb://h/db", "jdbc:sqlite:f.db", "jdbc:h2:mem:x", "jdbc:snowflake://h", "jdbc:redshift://h/db"])
def test_truncate_is_refused_where_spark_would_drop_the_table(spark, url):
    rows = spark.createDataFrame([("1",)], "id string")
    # No such database is there: nothing connects before the refusal.
    with pytest.raises(ValueError, match="no TRUNCATE"):
        load_target(rows, url, "t", "id", truncate=True)


def staging_tables(spark, url):
    tables = "(SELECT TABLENAME FROM SYS.SYSTABLES WHERE TABLENAME LIKE 'EVENKEEL_LOAD_%') staged"
    return spark.read.jdbc(url, tables).count()


def test_staged_load_appends_and_replaces(spark, url):
    name = make_table(spark, url)
    assert load_exactly_once(source_rows(spark).repartition(3), url, name, "ID", "AMOUNT,NOTE") == 3
    got = sorted(tuple(row) for row in jdbc_table(spark, url, name).collect())
    assert got == [(1, Decimal("10.50"), "x"), (2, None, "y"), (3, Decimal("7.00"), "")]
    more = spark.createDataFrame([("4", "1", "z")], "ID string, AMOUNT string, NOTE string")
    load_exactly_once(more, url, name, ["ID"], connections=1)
    assert jdbc_table(spark, url, name).count() == 4
    load_exactly_once(more, url, name, ["ID"], truncate=True)
    assert [row.ID for row in jdbc_table(spark, url, name).collect()] == [4]
    load_exactly_once(more.where("false"), url, name, ["ID"], truncate=True)
    assert jdbc_table(spark, url, name).count() == 0
    assert staging_tables(spark, url) == 0
    with pytest.raises(ValueError, match="lacks"):
        load_exactly_once(more.withColumnRenamed("NOTE", "other"), url, name, ["ID"])
    with pytest.raises(DuplicateKeyError, match="source"):
        load_exactly_once(more.unionAll(more), url, name, ["ID"])


@pytest.mark.parametrize("again", ["load_part >= 0", "load_part = 1", "load_part % 2 = 0"])
def test_staged_load_of_tasks_that_commit_and_run_again(spark, url, monkeypatch, again):
    """A task whose end the driver did not hear of is run again; both attempts have committed."""
    name = make_table(spark, url)
    rows = spark.range(500).selectExpr("CAST(id AS STRING) AS ID", "CAST(id AS STRING) AS AMOUNT", "'n' AS NOTE").repartition(4)
    write = DataFrameWriter.jdbc

    def write_again(self, *args, **options):
        write(self, *args, **options)
        write(self._df.where(again).write, *args, **options)

    monkeypatch.setattr(DataFrameWriter, "jdbc", write_again)
    for truncate in (False, True):
        assert load_exactly_once(rows, url, name, "ID", truncate=truncate) == 500
        assert sorted(row.ID for row in jdbc_table(spark, url, name).collect()) == list(range(500))


def test_staged_load_that_lacks_rows_changes_nothing(spark, url, monkeypatch):
    name = make_table(spark, url)
    load_exactly_once(source_rows(spark), url, name, "ID")
    write = DataFrameWriter.jdbc
    monkeypatch.setattr(DataFrameWriter, "jdbc", lambda self, *a, **k: write(self._df.where("ID <> '2'").write, *a, **k))
    with pytest.raises(LoadError, match="2 rows were staged"):
        load_exactly_once(source_rows(spark), url, name, "ID", truncate=True)
    assert jdbc_table(spark, url, name).count() == 3
    assert staging_tables(spark, url) == 0


def test_staged_load_after_a_failed_task(spark, url):
    """A task fails in the middle: nothing of the target changes, and the next load is whole."""
    name = make_table(spark, url)
    load_exactly_once(source_rows(spark), url, name, "ID")
    failing = source_rows(spark).withColumn("NOTE", F.when(F.col("ID") == "3", F.repeat(F.lit("x"), 60)).otherwise(F.col("NOTE")))
    with pytest.raises(Exception, match="truncation|22001"):
        load_exactly_once(failing, url, name, "ID", truncate=True)
    assert jdbc_table(spark, url, name).where("NOTE = 'x'").count() == 1
    assert jdbc_table(spark, url, name).count() == 3 and staging_tables(spark, url) == 0
    load_exactly_once(source_rows(spark), url, name, "ID", truncate=True)
    assert jdbc_table(spark, url, name).count() == 3
