"""Queries the driver checks and times; see README.md for what each one covers."""

from __future__ import annotations

import functools
import os
import sqlite3
import uuid
from collections.abc import Callable, Iterator
from contextlib import closing

from pyspark import TaskContext
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evenkeel.functions import canonical_text
from evenkeel.functions.names import SHEET_NAME_LENGTH
from evenkeel.functions.text import WHITE_SPACE
from evenkeel.operators import duplicate_keys as repeated_keys
from evenkeel.plans import Reconciliation, reconcile, reconcile_by_digest
from evenkeel.session import allow_local_scratch, scratch_path
from evenkeel.sinks import (
    append_to_table,
    create_database,
    load_exactly_once,
    read_report_csv,
    write_converted,
    write_per_file,
)
from evenkeel.sources.csv import DOUBLED
from evenkeel.sources import (
    combine_csv,
    csv_by_header,
    jdbc_table,
    read_csv_dropping_bad,
    read_csv_inferred,
    read_csv_strict,
    read_csv_typed,
    read_parquet,
    sqlite_table,
)

# ---------------------------------------------------------------------------
# Tables to reconcile
#
# The source is a whole table as it is. The target is the whole table with
# differences put in, in SQL that both engines run. The remainders only spread
# the differences over the keys; they limit neither side.
# ---------------------------------------------------------------------------

ORDERS_TARGET = """
    SELECT o_orderkey, o_custkey, o_orderstatus,
           CASE WHEN o_orderkey % 50 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice,
           o_orderdate,
           CASE WHEN o_orderkey % 100 = 0 THEN NULL
                WHEN o_orderkey % 7 = 0 THEN '  ' || o_orderpriority
                ELSE o_orderpriority END AS o_orderpriority
    FROM orders WHERE o_orderkey % 97 <> 0
    UNION ALL
    SELECT o_orderkey + 1000000000, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
           o_orderpriority
    FROM orders WHERE o_orderkey % 89 = 0
"""

EVENTS_TARGET = """
    SELECT event_id, ts, user_id, event_type,
           CASE WHEN event_id % 50 = 0 THEN value + 1 ELSE value END AS value, props
    FROM events WHERE event_id % 97 <> 0
    UNION ALL
    SELECT event_id, ts, user_id + 1000000000, event_type, value, props
    FROM events WHERE event_id % 89 = 0
"""

# A target without one source column and with a column of its own.
NARROW_TARGET = f"""
    SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
           o_orderkey % 3 AS own_column
    FROM ({ORDERS_TARGET}) t
"""

ORDERS_KEY = ["o_orderkey"]
ORDERS_COMPARE = ["o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
EVENTS_KEY = ["user_id", "ts"]
EVENTS_COMPARE = ["event_id", "event_type", "value", "props"]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_parquet(spark, f"{sf_dir}/{name}.parquet")


def _derived(table: DataFrame, name: str, sql: str) -> DataFrame:
    """``sql`` over the table ``name``, without leaving a view behind."""
    return table.sparkSession.sql(sql.replace(f"FROM {name} ", "FROM {given} "), given=table)


def _orders(spark: SparkSession, sf_dir: str, **options) -> Reconciliation:
    source = _table(spark, sf_dir, "orders")
    target = _derived(source, "orders", options.pop("target", ORDERS_TARGET))
    return reconcile(source, target, ORDERS_KEY, **options)


# ---------------------------------------------------------------------------
# Reconciliation queries
# ---------------------------------------------------------------------------


def recon_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _orders(spark, sf_dir).report()


def recon_report_keys_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _orders(spark, sf_dir, unique_check="keys_first").report()


def recon_report_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = _table(spark, sf_dir, "orders")
    return reconcile_by_digest(source, _derived(source, "orders", ORDERS_TARGET), ORDERS_KEY).report()


def recon_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _orders(spark, sf_dir).missing()


def recon_extra(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _orders(spark, sf_dir).extra()


def recon_mismatches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _orders(spark, sf_dir, compare=ORDERS_COMPARE).mismatches()


def recon_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _orders(spark, sf_dir).summary()


def recon_where_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _orders(spark, sf_dir, where="o_orderstatus = 'F'").report()


def recon_default_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _orders(spark, sf_dir, target=NARROW_TARGET).report()


def recon_keys_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _orders(spark, sf_dir, compare=[]).report()


def recon_oracle_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _orders(spark, sf_dir, compare=ORDERS_COMPARE, target_label="oracle").report()


def recon_composite_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = _table(spark, sf_dir, "events")
    target = _derived(source, "events", EVENTS_TARGET)
    return reconcile(source, target, EVENTS_KEY, EVENTS_COMPARE).report()


def duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_keys(_table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


def canonical_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = [_table(spark, sf_dir, name) for name in ("orders", "events")]
    return _as_text(tables[0]).unionAll(_as_text(tables[1]))


def _as_text(df: DataFrame) -> DataFrame:
    return df.select(
        *[canonical_text(field.name, field.dataType).alias(f"text_{i}") for i, field in enumerate(df.schema.fields)]
    )


def report_sink_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    result = _orders(spark, sf_dir)
    path = scratch_path(spark, "report")
    result.write(path)
    return read_report_csv(spark, path, result.report().columns)


# ---------------------------------------------------------------------------
# Sources and sinks. Each writes the whole table in the format to read first.
# ---------------------------------------------------------------------------


def _written_csv(df: DataFrame, folder: str, name: str = "rows") -> str:
    path = f"{folder}/{name}"
    df.write.csv(path, header=True, escape='"')
    return path


def csv_strict_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _table(spark, sf_dir, "orders")
    as_text = orders.selectExpr(*[f"CAST({name} AS STRING) AS {name}" for name in orders.columns])
    return read_csv_strict(spark, _written_csv(as_text, scratch_path(spark, "csv")))


def csv_strict_quoted_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    documents = documents.selectExpr(*[f"CAST({name} AS STRING) AS {name}" for name in documents.columns])
    return read_csv_strict(spark, _written_csv(documents, scratch_path(spark, "csv")))


def csv_split_quoted_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in quoted cells with line breaks, read in several tasks a file."""
    documents = _table(spark, sf_dir, "documents")
    documents = documents.selectExpr(*[f"CAST({name} AS STRING) AS {name}" for name in documents.columns])
    return read_csv_strict(spark, _written_csv(documents, scratch_path(spark, "csv")), split=True)


def csv_recon(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _table(spark, sf_dir, "orders")
    as_text = orders.selectExpr(*[f"CAST({name} AS STRING) AS {name}" for name in orders.columns])
    source = read_csv_strict(spark, _written_csv(as_text, scratch_path(spark, "csv")), trim=False)
    target = _derived(orders, "orders", ORDERS_TARGET)
    return reconcile(source, target, ORDERS_KEY, ORDERS_COMPARE).report()


def parquet_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_parquet(spark, f"{sf_dir}/lineitem.parquet")


def parquet_load_repartitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_parquet(spark, f"{sf_dir}/lineitem.parquet", partitions=100)


def csv_typed_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = _table(spark, sf_dir, "customer")
    path = _written_csv(customer, scratch_path(spark, "csv"))
    return read_csv_typed(spark, path, customer.schema, escape=DOUBLED)


def csv_glob_drop_bad(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = _table(spark, sf_dir, "customer")
    folder = scratch_path(spark, "csv")
    _written_csv(customer, folder, "good")
    # The same rows cut short, with a surplus cell, and with text for a number.
    _written_csv(customer.drop("c_mktsegment"), folder, "short")
    _written_csv(customer.selectExpr("*", "c_name AS surplus"), folder, "long")
    _written_csv(
        customer.selectExpr("c_custkey", "c_name", "c_nationkey", "c_name AS c_acctbal", "c_mktsegment"),
        folder,
        "mistyped",
    )
    return read_csv_dropping_bad(spark, f"{folder}/*/*.csv", customer.schema, check_header=False, escape=DOUBLED)


# Names of more than 31 characters, so that cut tags are shared by all files of a table.
TAGGED = {name: f"{name}_rows_of_the_combined_csv_files" for name in ("nation", "region", "supplier")}


def _tagged_csvs(spark: SparkSession, sf_dir: str) -> str:
    """Folder of CSV files named after the tables they come from."""
    folder = scratch_path(spark, "csv")
    hadoop = spark._jvm.org.apache.hadoop.fs
    for name, stem in TAGGED.items():
        path = hadoop.Path(_written_csv(_table(spark, sf_dir, name), folder, f"parts/{name}"))
        files = path.getFileSystem(spark._jsc.hadoopConfiguration())
        files.mkdirs(hadoop.Path(f"{folder}/named"))
        for i, part in enumerate(files.globStatus(hadoop.Path(path, "*.csv"))):
            files.rename(part.getPath(), hadoop.Path(f"{folder}/named/{stem}_{i:05}.csv"))
    return f"{folder}/named/*.csv"


def csv_combine_tagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    combined = combine_csv(spark, _tagged_csvs(spark, sf_dir)).drop("file_path")
    # How many part files there are is Spark's choice; their numbers are not compared.
    return combined.withColumn("sheet_name", F.regexp_replace("sheet_name", "_[0-9]{5}$", ""))


def csv_combine_cut_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return combine_csv(spark, _tagged_csvs(spark, sf_dir), tag_length=SHEET_NAME_LENGTH).drop("file_path")


def csv_per_file_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    output = scratch_path(spark, "sheets")
    write_per_file(csv_by_header(spark, _tagged_csvs(spark, sf_dir)), output)
    written = spark.read.option("mergeSchema", True).parquet(output)
    return written.withColumn("sheet_name", F.regexp_replace("sheet_name", "_[0-9]{5}$", ""))


def recon_oracle_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text keys and prices against numbers as Oracle's columns come: without a size, and with a scale."""
    orders = _table(spark, sf_dir, "orders")
    source = orders.selectExpr(
        "CAST(o_orderkey AS STRING) AS o_orderkey",
        "CAST(o_custkey AS STRING) AS o_custkey",
        "o_orderstatus",
        "CAST(o_totalprice AS STRING) AS o_totalprice",
        "o_orderdate",
        "o_orderpriority",
    )
    target = _derived(orders, "orders", ORDERS_TARGET).selectExpr(
        "CAST(o_orderkey AS DECIMAL(38, 10)) AS o_orderkey",
        "CAST(o_custkey AS DECIMAL(10, 0)) AS o_custkey",
        "o_orderstatus",
        "CAST(o_totalprice AS DECIMAL(15, 2)) AS o_totalprice",
        "o_orderdate",
        "o_orderpriority",
    )
    return reconcile(source, target, ORDERS_KEY, target_label="oracle", decimals="oracle").report()


def csv_convert(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = _table(spark, sf_dir, "part")
    path = scratch_path(spark, "parquet")
    write_converted(read_csv_inferred(spark, _written_csv(part, scratch_path(spark, "csv"))), path)
    return read_parquet(spark, path)


def warehouse_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    database = f"evenkeel_{uuid.uuid4().hex}"
    create_database(spark, database, scratch_path(spark, "warehouse"))
    for _ in range(2):
        append_to_table(_table(spark, sf_dir, "supplier"), database, "supplier")
    return spark.table(f"{database}.supplier")


def db_load_and_recon(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Supplier loaded into a database and reconciled with it.

    Without ``spark.evenkeel.jdbc.url`` the database is one in the memory of the
    Spark process, which only a local session can share with its tasks.
    """
    in_memory = f"jdbc:derby:memory:evenkeel{uuid.uuid4().hex};create=true"
    url = spark.conf.get("spark.evenkeel.jdbc.url", in_memory)
    name = f"supplier_{uuid.uuid4().hex[:12]}"
    supplier = _table(spark, sf_dir, "supplier")
    typed = supplier.write.option("createTableColumnTypes", "s_name VARCHAR(200)")
    typed.mode("overwrite").jdbc(url, name)  # rows that the load must clear away
    load_exactly_once(supplier, url, name, "s_suppkey", truncate=True)
    target = jdbc_table(spark, url, name, supplier.columns, partition_column="s_suppkey", partitions=8)
    return reconcile(supplier, target, "s_suppkey").summary()


def sqlite_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Supplier in SQLite files, one per partition, read back as one table.

    SQLite needs ``spark.checkpoint.dir`` to be a mounted file system.
    """
    supplier = _table(spark, sf_dir, "supplier")
    folder = scratch_path(spark, "sqlite").removeprefix("file:")
    names = supplier.columns
    kinds = {T.LongType(): "INTEGER", T.IntegerType(): "INTEGER", T.DoubleType(): "REAL"}
    columns = ", ".join(f"{f.name} {kinds.get(f.dataType, 'TEXT')}" for f in supplier.schema.fields)

    def write_file(rows: Iterator[Row]) -> None:
        os.makedirs(folder, exist_ok=True)
        final = f"{folder}/part-{TaskContext.get().partitionId():05}.db"
        attempt = f"{folder}/attempt-{uuid.uuid4().hex}"
        with closing(sqlite3.connect(attempt)) as db:
            db.execute(f"CREATE TABLE supplier ({columns})")
            db.executemany(f"INSERT INTO supplier VALUES ({', '.join('?' * len(names))})", rows)
            db.commit()
        os.replace(attempt, final)  # a task that runs again puts the same rows here

    supplier.foreachPartition(write_file)
    return sqlite_table(spark, f"{folder}/part-*.db", "supplier", ranges=4)


# ---------------------------------------------------------------------------
# The same results in DuckDB's SQL
# ---------------------------------------------------------------------------

BLANKS = WHITE_SPACE  # DuckDB's trim, too, must be told what to strip


def _sql_text(value: str) -> str:
    return f"coalesce(CAST({value} AS VARCHAR), '')"


def _sql_trimmed(value: str) -> str:
    return f"coalesce(trim({value}, '{BLANKS}'), '')"


def _sql_time(value: str) -> str:
    seconds = "%Y-%m-%d %H:%M:%S"
    return (
        f"coalesce(CASE WHEN microsecond({value}) % 1000000 <> 0"
        f" THEN strftime({value}, '{seconds}.%f') ELSE strftime({value}, '{seconds}') END, '')"
    )


ORDERS_TEXT = {
    "o_custkey": _sql_text("o_custkey"),
    "o_orderstatus": _sql_trimmed("o_orderstatus"),
    "o_totalprice": _sql_text("o_totalprice"),
    "o_orderdate": _sql_time("o_orderdate"),
    "o_orderpriority": _sql_trimmed("o_orderpriority"),
}
EVENTS_TEXT = {
    "event_id": _sql_text("event_id"),
    "event_type": _sql_trimmed("event_type"),
    "value": _sql_text("value"),
    "props": _sql_trimmed("props"),
}


def _sql_side(table: str, keys: list[str], texts: dict[str, str]) -> str:
    columns = [f"{key} AS key_{i}" for i, key in enumerate(keys, 1)]
    columns += [f"{text} AS {name}" for name, text in texts.items()]
    return f"SELECT {', '.join(columns)} FROM {table} rows_of_side"


def _sql_pair(source: str, target: str, keys: list[str], texts: dict[str, str], absent=()) -> str:
    target_texts = {name: "''" if name in absent else text for name, text in texts.items()}
    return (
        f"WITH s AS ({_sql_side(source, keys, texts)}),"
        f" t AS ({_sql_side(f'({target})', keys, target_texts)}) "
    )


def _sql_cells(n_keys: int, names: list[str], label: str) -> list[str]:
    shown = ", ".join(f"s.key_{i}" for i in range(1, n_keys + 1))
    using = ", ".join(f"key_{i}" for i in range(1, n_keys + 1))
    return [
        f"SELECT 'VALUE_MISMATCH' AS reconciliation_type, {shown}, '{name}' AS column_name,"
        f" s.{name} AS source_value, t.{name} AS {label}_value"
        f" FROM s JOIN t USING ({using}) WHERE s.{name} <> t.{name}"
        for name in names
    ]


def _sql_one_sided(n_keys: int, label: str) -> list[str]:
    using = ", ".join(f"key_{i}" for i in range(1, n_keys + 1))
    return [
        f"SELECT '{kind}_IN_{label.upper()}' AS reconciliation_type, {using},"
        f" CAST(NULL AS VARCHAR) AS column_name, CAST(NULL AS VARCHAR) AS source_value,"
        f" CAST(NULL AS VARCHAR) AS {label}_value FROM {left} ANTI JOIN {right} USING ({using})"
        for kind, left, right in (("MISSING", "s", "t"), ("EXTRA", "t", "s"))
    ]


def _sql_report(pair: str, n_keys: int, names: list[str], label: str = "target") -> str:
    return pair + " UNION ALL ".join(
        [*_sql_one_sided(n_keys, label), *_sql_cells(n_keys, names, label)]
    )


ORDER_KEY_TEXT = [_sql_text("o_orderkey")]


def core_oracle_sql() -> dict[str, str]:
    orders = _sql_pair("orders", ORDERS_TARGET, ORDER_KEY_TEXT, ORDERS_TEXT)
    filtered = f"SELECT * FROM ({ORDERS_TARGET}) t WHERE o_orderstatus = 'F'"
    events_key = [_sql_text("user_id"), _sql_time("ts")]
    report = _sql_report(orders, 1, ORDERS_COMPARE)
    differs = " OR ".join(f"s.{name} <> t.{name}" for name in ORDERS_COMPARE)
    part_columns = "CAST(p_partkey AS INTEGER) AS p_partkey, p_name, p_brand, p_type, p_size, p_retailprice"
    combined_columns = {
        "nation": "n_nationkey, n_name, n_regionkey, NULL AS r_regionkey, NULL AS r_name,"
        " NULL AS s_suppkey, NULL AS s_name, NULL AS s_nationkey, NULL AS s_acctbal",
        "region": "NULL, NULL, NULL, r_regionkey, r_name, NULL, NULL, NULL, NULL",
        "supplier": "NULL, NULL, NULL, NULL, NULL, CAST(s_suppkey AS INTEGER), s_name, s_nationkey,"
        " s_acctbal",
    }
    quoted_documents = f"""
        SELECT {_sql_text("doc_id")} AS doc_id, {_sql_trimmed("text")} AS text,
               {_sql_trimmed("lang")} AS lang, {_sql_trimmed("source")} AS source,
               {_sql_text("n_chars")} AS n_chars
        FROM documents
    """
    return {
        "recon_report": report,
        "recon_report_keys_first": report,
        "recon_report_digest": report,
        "recon_missing": orders + "SELECT key_1 FROM s ANTI JOIN t USING (key_1)",
        "recon_extra": orders + "SELECT key_1 FROM t ANTI JOIN s USING (key_1)",
        "recon_mismatches": orders + " UNION ALL ".join(_sql_cells(1, ORDERS_COMPARE, "target")),
        "recon_summary": orders
        + f"""
            SELECT (SELECT count(*) FROM s) AS source_rows, (SELECT count(*) FROM t) AS target_rows,
                   (SELECT count(*) FROM s ANTI JOIN t USING (key_1)) AS missing_in_target,
                   (SELECT count(*) FROM t ANTI JOIN s USING (key_1)) AS extra_in_target,
                   (SELECT count(*) FROM s JOIN t USING (key_1) WHERE {differs}) AS value_mismatches
        """,
        "recon_where_target": _sql_report(
            _sql_pair("orders", filtered, ORDER_KEY_TEXT, ORDERS_TEXT), 1, ORDERS_COMPARE
        ),
        "recon_default_columns": _sql_report(
            _sql_pair("orders", NARROW_TARGET, ORDER_KEY_TEXT, ORDERS_TEXT, ["o_orderpriority"]),
            1,
            ORDERS_COMPARE,
        ),
        "recon_keys_only": _sql_report(orders, 1, []),
        "recon_oracle_label": _sql_report(orders, 1, ORDERS_COMPARE, "oracle"),
        "recon_composite_key": _sql_report(
            _sql_pair("events", EVENTS_TARGET, events_key, EVENTS_TEXT), 2, EVENTS_COMPARE
        ),
        "duplicate_keys": f"""
            SELECT {_sql_text("l_orderkey")} AS key_1, {_sql_text("l_linenumber")} AS key_2,
                   count(*) AS n
            FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1
        """,
        "canonical_texts": f"""
            SELECT {_sql_text("o_orderkey")} AS text_0, {_sql_text("o_custkey")} AS text_1,
                   {_sql_trimmed("o_orderstatus")} AS text_2, {_sql_text("o_totalprice")} AS text_3,
                   {_sql_time("o_orderdate")} AS text_4, {_sql_trimmed("o_orderpriority")} AS text_5
            FROM orders
            UNION ALL
            SELECT {_sql_text("event_id")}, {_sql_time("ts")}, {_sql_text("user_id")}, {_sql_trimmed("event_type")},
                   {_sql_text("value")}, {_sql_trimmed("props")}
            FROM events
        """,
        "report_sink_roundtrip": f"""
            SELECT reconciliation_type, key_1, column_name,
                   nullif(source_value, '') AS source_value, nullif(target_value, '') AS target_value
            FROM ({report}) lines
        """,
        "csv_strict_source": f"""
            SELECT {_sql_text("o_orderkey")} AS o_orderkey, {_sql_text("o_custkey")} AS o_custkey,
                   o_orderstatus, {_sql_text("o_totalprice")} AS o_totalprice,
                   {_sql_text("o_orderdate")} AS o_orderdate, o_orderpriority
            FROM orders
        """,
        "csv_strict_quoted_lines": quoted_documents,
        "csv_split_quoted_lines": quoted_documents,
        "csv_recon": report,
        "parquet_load": "SELECT * FROM lineitem",
        "parquet_load_repartitioned": "SELECT * FROM lineitem",
        "csv_typed_load": "SELECT * FROM customer",
        "csv_glob_drop_bad": "SELECT * FROM customer",
        "csv_combine_tagged": " UNION ALL ".join(
            f"SELECT '{TAGGED[name]}' AS sheet_name, {columns} FROM {name}" for name, columns in combined_columns.items()
        ),
        "csv_combine_cut_tags": " UNION ALL ".join(
            f"SELECT '{TAGGED[name][:SHEET_NAME_LENGTH]}' AS sheet_name, {columns} FROM {name}"
            for name, columns in combined_columns.items()
        ),
        "csv_per_file_output": " UNION ALL ".join(
            f"SELECT '{TAGGED[name]}' AS sheet_name, {columns} FROM {name}" for name, columns in combined_columns.items()
        ),
        "recon_oracle_numbers": _sql_report(orders, 1, ORDERS_COMPARE, "oracle"),
        "csv_convert": f"SELECT {part_columns} FROM part",
        "warehouse_append": "SELECT * FROM supplier UNION ALL SELECT * FROM supplier",
        "db_load_and_recon": """
            SELECT count(*) AS source_rows, count(*) AS target_rows, CAST(0 AS BIGINT) AS missing_in_target,
                   CAST(0 AS BIGINT) AS extra_in_target, CAST(0 AS BIGINT) AS value_mismatches
            FROM supplier
        """,
        "sqlite_source": """
            SELECT CAST(s_suppkey AS VARCHAR) AS s_suppkey, s_name,
                   CAST(s_nationkey AS VARCHAR) AS s_nationkey, CAST(s_acctbal AS VARCHAR) AS s_acctbal
            FROM supplier
        """,
    }


def core_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        query.__name__: query
        for query in (
            recon_report,
            recon_report_keys_first,
            recon_report_digest,
            recon_missing,
            recon_extra,
            recon_mismatches,
            recon_summary,
            recon_where_target,
            recon_default_columns,
            recon_keys_only,
            recon_composite_key,
            recon_oracle_label,
            duplicate_keys,
            canonical_texts,
            csv_strict_source,
            csv_strict_quoted_lines,
            csv_split_quoted_lines,
            csv_recon,
            parquet_load,
            parquet_load_repartitioned,
            csv_typed_load,
            csv_glob_drop_bad,
            csv_combine_tagged,
            csv_combine_cut_tags,
            recon_oracle_numbers,
            csv_per_file_output,
            csv_convert,
            warehouse_append,
            db_load_and_recon,
            sqlite_source,
            report_sink_roundtrip,
        )
    }


# ---------------------------------------------------------------------------
# The training-data operators, where their subpackage and pipeline are present
# ---------------------------------------------------------------------------


def _training_data() -> tuple[dict, dict]:
    try:
        import corpus_pipeline
        from evenkeel.llm import registry
    except ModuleNotFoundError as error:
        if (error.name or "").startswith(("corpus_pipeline", "evenkeel.llm")):
            return {}, {}
        raise
    found = {**registry.QUERIES, "pipeline": corpus_pipeline.run}
    sql = {**registry.ORACLE_SQL, "pipeline": corpus_pipeline.ORACLE_SQL}
    return found, {name: text for name, text in sql.items() if text}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _with_scratch(query) for name, query in {**core_queries(), **_training_data()[0]}.items()}


def _with_scratch(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """The query, which a local session may run without a shared folder."""

    @functools.wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        allow_local_scratch(spark)
        return query(spark, sf_dir)

    return run


def oracle_sql() -> dict[str, str]:
    return {**core_oracle_sql(), **_training_data()[1]}


def entry(spark: SparkSession) -> DataFrame:
    return recon_report(spark, "/root/testdata/sf0.001")
