"""Many CSV files as one table, each row tagged by its file."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evenkeel.functions.names import column, sheet_name
from evenkeel.session import scratch_path
from evenkeel.sources.csv import DOUBLED, checked_record, inferred_schema, parsed_record, read_csv_inferred
from evenkeel.sources.csv_splits import BOM, records_and_headers

SHEET = "sheet_name"
FILE = "file_path"


class CsvTables(list):
    """Tables, one per header, with ``files``: (file, header, sheet_name) of every file."""

    files: DataFrame | None = None


def csv_by_header(
    spark: SparkSession,
    path: str | list[str],
    delimiter: str = ",",
    infer: bool = True,
    same_header: bool = False,
    tag_length: int | None = None,
) -> CsvTables:
    """One table per distinct header among the files, with their own columns.

    Each has ``sheet_name`` (the file's base name without ``.csv``, cut to
    ``tag_length`` if that is given) and ``file_path`` in front. With ``infer`` column types come from
    a pass over the data, otherwise all columns are text. Large files are read in several
    tasks. ``same_header=True`` leaves out the pass that looks for headers and reads each
    file in one task; a file that differs is then an error.

    Headers come from the pass that finds out where records end, and files are told apart
    by Spark joins: the driver sees the distinct headers, not the files. Where headers
    differ, the records are stored by header first, so each table is read by itself.
    """
    tables = CsvTables()
    if same_header:
        tables.append(_read_group(spark, path, delimiter, infer, tag_length))
        return tables
    records, found = records_and_headers(spark, path, delimiter)
    header = F.ltrim(F.rtrim("record", F.lit("\r")), F.lit(BOM)).alias("header_line")
    files = scratch_path(spark, "files")
    found.select("file", header, _sheet(tag_length).alias(SHEET)).write.parquet(files)
    tables.files = spark.read.parquet(files)
    headers = [row.header_line for row in tables.files.select("header_line").distinct().orderBy("header_line").collect()]
    rows = records.where("NOT header")
    if len(headers) > 1:
        numbered = spark.createDataFrame(list(enumerate(headers)), "header_number int, header_line string")
        of_file = tables.files.join(F.broadcast(numbered), "header_line").select("file", "header_number")
        routed = scratch_path(spark, "routed")
        rows.join(of_file, "file").write.partitionBy("header_number").parquet(routed)
        rows = spark.read.schema(f"{_sql_schema(rows)}, header_number int").parquet(routed)
    for number, line in enumerate(headers):
        own = rows.where(F.col("header_number") == number) if len(headers) > 1 else rows
        tables.append(_typed_group(own, line, delimiter, infer, tag_length))
    return tables


def _sql_schema(df: DataFrame) -> str:
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema.fields)


def _sheet(tag_length: int | None) -> Column:
    return sheet_name(F.element_at(F.split("file", "/"), -1), tag_length)


def _typed_group(rows: DataFrame, header: str, delimiter: str, infer: bool, tag_length: int | None) -> DataFrame:
    """Records of files with one header, parsed and typed, behind their tag and file."""
    spark = rows.sparkSession
    names = _names_of(spark, header, delimiter)
    record = checked_record(rows, delimiter)
    schema = inferred_schema(record, len(names), delimiter) if infer else T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(len(names))])
    cells = parsed_record(F.col("record"), schema, delimiter)
    df = record.select(_sheet(tag_length).alias(SHEET), F.col("file").alias(FILE), cells.alias("cells"))
    return df.select(SHEET, FILE, *[F.col(f"cells.c{i}").alias(name) for i, name in enumerate(names)])


def _names_of(spark: SparkSession, header: str, delimiter: str) -> list[str]:
    """Column names as Spark's own reader makes them: blanks by place, repeats numbered."""
    found = spark.read.option("header", True).option("sep", delimiter).option("escape", DOUBLED)
    one = spark.createDataFrame([(header,)], "value string")
    lines = getattr(one._jdf, "as")(spark._jvm.org.apache.spark.sql.Encoders.STRING())
    return [name for name in found._jreader.csv(lines).columns()]


def combine_csv(
    spark: SparkSession,
    path: str | list[str],
    delimiter: str = ",",
    infer: bool = True,
    same_header: bool = False,
    tag_length: int | None = None,
) -> DataFrame:
    """All files of ``path`` in one table; columns a file lacks are NULL.

    A column that is typed differently in files with different headers becomes
    text, unless all its types are numbers. See ``csv_by_header`` for the rest.
    """
    groups = csv_by_header(spark, path, delimiter, infer, same_header, tag_length)
    if not groups:
        raise ValueError(f"no CSV with a header row at {path}")
    types: dict[str, set[T.DataType]] = {}
    for group in groups:
        for field in group.schema.fields:
            types.setdefault(field.name, set()).add(field.dataType)
    as_text = {
        name
        for name, kinds in types.items()
        if len(kinds) > 1 and not all(isinstance(kind, T.NumericType) for kind in kinds)
    }
    aligned = [
        group.withColumns({name: column(name).cast("string") for name in as_text & set(group.columns)})
        for group in groups
    ]
    return reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), aligned)


def _read_group(
    spark: SparkSession, path: str | list[str], delimiter: str, infer: bool, tag_length: int | None
) -> DataFrame:
    df = read_csv_inferred(spark, path, delimiter, infer)
    return df.select(
        sheet_name(F.col("_metadata.file_name"), tag_length).alias(SHEET),
        F.col("_metadata.file_path").alias(FILE),
        *[column(name) for name in df.columns],
    )
