"""CSV readers that agree with Python's ``csv`` module where it matters."""

from __future__ import annotations

import json
import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evenkeel.functions.names import column
from evenkeel.functions.text import canonical_text
from evenkeel.sources.csv_splits import cell_pattern, csv_records

CORRUPT = "_corrupt_record"
# Place of a row among all: a struct of file, start and line.
ORDINAL = "_csv_ordinal"

# No text holds it, so a reader with this delimiter gives whole lines.
NO_DELIMITER = "\u0001"

# How a quote is written inside a quoted cell.
DOUBLED = '"'
BACKSLASH = "\\"


def read_csv_strict(
    spark: SparkSession,
    path: str | list[str],
    delimiter: str = ",",
    columns: Sequence[str] | None = None,
    multi_line: bool = True,
    trim: bool = True,
    split: bool = False,
    ordinal: bool = False,
) -> DataFrame:
    """CSV with a header as text columns; bad files and rows are errors.

    Header names are stripped and must be unique; all files of ``path`` must have
    the same header. Quotes are doubled inside quoted cells. A row that ends
    before the last of ``columns`` (all, by default) fails the query; surplus
    cells are ignored. With ``trim`` every cell is stripped and a blank is ``""``;
    without it cells stay raw and blanks are NULL, which ``reconcile`` treats alike.

    Every file is read alike, whatever its size. By default cells may hold line
    breaks, which makes one task per file. ``split=True`` reads such files in as many tasks
    as they have splits, in two passes, and needs Python workers. ``ordinal`` adds, with
    ``split``, the column ``ORDINAL``: file, start of the split and line there, which put
    rows in the order of their files. ``multi_line=False`` splits files at their
    line ends; a line that ends inside a quoted cell is then an error. So are, in both
    modes, text behind a closing quote and a carriage return without a line feed where
    it cannot be told from a row end: in a quoted cell, and by default in any cell.
    """
    raw_names = csv_header(spark, path, delimiter)
    names = clean_header(raw_names)
    wanted = list(dict.fromkeys(columns)) if columns is not None else names
    absent = [name for name in wanted if name not in names]
    if absent:
        raise ValueError(f"CSV header lacks columns: {absent}")

    fields = [T.StructField(raw or name, T.StringType()) for raw, name in zip(raw_names, names, strict=True)]
    schema = T.StructType([*fields, T.StructField(CORRUPT, T.StringType())])
    if ordinal and not split:
        raise ValueError("only split reads number their rows")
    if split:
        records = csv_records(spark, path, delimiter)
        df = _parsed_records(_checked_headers(records, names, delimiter), schema, delimiter).toDF(*names, CORRUPT, ORDINAL)
    elif multi_line:
        df = (
            csv_reader(spark, delimiter, multi_line)
            # Told, not detected: a file may end its lines in both ways.
            .option("lineSep", "\n")
            .schema(schema)
            # A blank header cell has no name to check against.
            .option("enforceSchema", not all(raw_names))
            .csv(path)
            .toDF(*names, CORRUPT)
            .where(_no_lone_return(names))
            .withColumns({name: F.rtrim(column(name), F.lit("\r")) for name in names})
        )
    else:
        df = _parsed_lines(spark, path, delimiter, schema).toDF(*names, CORRUPT)
    if wanted:
        needed = 1 + max(names.index(name) for name in wanted)
        df = df.where(_long_enough(names, needed, delimiter))
    kept = [column(ORDINAL)] if ordinal else []
    if not trim:
        return df.select(*[column(name) for name in wanted], *kept)
    return df.select(*[canonical_text(name, T.StringType()).alias(name) for name in wanted], *kept)


def read_csv_typed(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType | str,
    delimiter: str = ",",
    partitions: int | None = None,
    check_header: bool = True,
    escape: str = BACKSLASH,
) -> DataFrame:
    """CSV with a header under an explicit schema; unreadable cells become NULL.

    ``escape`` stands before a quote inside a quoted cell; ``DOUBLED`` for a second
    quote. With ``check_header`` a file whose header does not follow the schema is an
    error; without it columns are taken by position.
    """
    df = (
        csv_reader(spark, delimiter, multi_line=False, escape=escape, strict=False)
        .schema(schema)
        .option("enforceSchema", not check_header)
        .csv(path)
    )
    return df if partitions is None else df.repartition(partitions)


def read_csv_dropping_bad(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType | str,
    delimiter: str = ",",
    partitions: int | None = None,
    check_header: bool = True,
    escape: str = BACKSLASH,
) -> DataFrame:
    """Typed CSV without its bad rows: short, long or not of the column types.

    ``escape`` as in ``read_csv_typed``.

    Spark's own DROPMALFORMED only looks at the columns a query happens to read,
    so counts differ from query to query. Here every row is checked whole.
    """
    parsed = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
    names = parsed.fieldNames()
    df = (
        csv_reader(spark, delimiter, multi_line=False, escape=escape, strict=False)
        .schema(T.StructType([*parsed.fields, T.StructField(CORRUPT, T.StringType())]))
        .option("enforceSchema", not check_header)
        .csv(path)
    )
    # The branch for bad rows is always false; it names all columns so that no
    # query can prune them away from the parser.
    all_cells = F.concat_ws(",", *[column(name).cast("string") for name in names])
    good = F.when(F.col(CORRUPT).isNull(), F.lit(True)).otherwise(F.length(all_cells) < 0)
    df = df.where(good).select(*[column(name) for name in names])
    return df if partitions is None else df.repartition(partitions)


def read_csv_inferred(
    spark: SparkSession, path: str | list[str], delimiter: str = ",", infer: bool = True, split: bool = False
) -> DataFrame:
    """CSV with a header; ``infer`` finds column types by a pass over the data.

    Cells may hold line breaks, so each file is one task, whatever its size; with ``split``
    it is as many as it has splits, and one more pass finds where records end. Text behind a
    closing quote and carriage returns without a line feed are errors. A file must end
    all its lines alike, without ``split``.
    """
    if split:
        names = clean_header(csv_header(spark, path, delimiter))
        records = checked_record(_checked_headers(csv_records(spark, path, delimiter), names, delimiter), delimiter)
        places = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(len(names))])
        schema = inferred_schema(records, len(names), delimiter) if infer else places
        cells = records.select(parsed_record(F.col("record"), schema, delimiter).alias("cells"))
        return cells.select(*[F.col(f"cells.c{i}").alias(name) for i, name in enumerate(names)])
    df = (
        csv_reader(spark, delimiter, multi_line=True)
        .option("inferSchema", infer)
        .option("enforceSchema", False)
        .csv(path)
    )
    texts = [field.name for field in df.schema.fields if isinstance(field.dataType, T.StringType)]
    return df.where(_no_lone_return(texts, corrupt=None)) if texts else df


def csv_header(spark: SparkSession, path: str | list[str], delimiter: str = ",") -> list[str]:
    """Raw header names; a blank header cell is ``""``."""
    reader = csv_reader(spark, delimiter, multi_line=True).option("lineSep", "\n")
    first = reader.option("header", False).csv(path).head(1)
    if not first:
        raise ValueError(f"CSV has no header row: {path}")
    names = [name or "" for name in first[0]]
    return [names[0].removeprefix("\ufeff"), *names[1:]]


def clean_header(raw_names: Sequence[str]) -> list[str]:
    """Stripped header names; a blank one is named by its position, like ``_c2``."""
    names = [raw.strip() or f"_c{i}" for i, raw in enumerate(raw_names)]
    if any("\r" in name for name in names):
        raise ValueError("CSV header holds a carriage return without a line feed")
    repeated = sorted({name for name in names if names.count(name) > 1})
    if repeated:
        raise ValueError(f"CSV header repeats columns: {repeated}")
    folded = [name.lower() for name in names]
    alike = sorted({name for name in names if folded.count(name.lower()) > 1})
    if alike:
        raise ValueError(f"CSV header has columns that differ in letter case only: {alike}")
    if taken := sorted({CORRUPT, ORDINAL} & set(names)):
        raise ValueError(f"CSV header may not use the name {taken[0]}")
    return names


def csv_reader(
    spark: SparkSession, delimiter: str, multi_line: bool, escape: str = DOUBLED, strict: bool = True
):
    reader = (
        spark.read.option("header", True)
        .option("sep", delimiter)
        .option("escape", escape)
        .option("multiLine", multi_line)
        .option("columnNameOfCorruptRecord", CORRUPT)
    )
    # With doubled quotes a single one inside a quoted cell has no meaning.
    return reader.option("unescapedQuoteHandling", "RAISE_ERROR") if strict else reader


def _failing(fails: Column, *shown: Column) -> Column:
    """Filter that fails the query where ``fails`` holds."""
    message = F.concat_ws(" ", *shown)
    return F.when(fails, F.raise_error(message).cast("boolean")).otherwise(F.lit(True))


def _no_lone_return(names: Sequence[str], corrupt: str | None = CORRUPT) -> Column:
    """Filter that fails on a carriage return without a line feed: a row end, or part of a cell.

    The last cell of a row may end in one, which belongs to the line's end.
    """
    present = F.concat_ws(",", *[column(name) for name in names])
    cells = F.concat_ws(",", *[F.coalesce(column(name), F.lit("")) for name in names])
    if corrupt is not None:
        cells = F.when(F.col(corrupt).isNull(), cells).otherwise(present)  # a short row ends sooner
    shown = F.lit("CSV cell holds a carriage return without a line feed:")
    return _failing(F.contains(present, F.lit("\r")) & cells.rlike("\r(?!\n|\\z)"), shown, cells)


def _parsed_lines(spark: SparkSession, path: str | list[str], delimiter: str, schema: T.StructType) -> DataFrame:
    """Rows of one line each, read line by line; a line that ends inside a quoted cell fails."""
    reader = spark.read.option("sep", NO_DELIMITER).option("quote", "")
    first = reader.option("header", False).csv(path).head(1)
    header = (first[0][0] if first else "").removeprefix("\ufeff")
    lines = (
        reader.option("header", True)
        .option("enforceSchema", not header)
        .schema(T.StructType([T.StructField(header or "line", T.StringType())]))
        .csv(path)
        .toDF("line")
    )
    sep = re.escape(delimiter)
    cell = f'(?:"[^"]*+(?:""[^"]*+)*+"\\s*+|(?!")(?:(?!{sep}).)*+)'
    whole = F.col("line").rlike(f"^{cell}(?:{sep}{cell})*+$")
    options = {"sep": delimiter, "escape": DOUBLED, "columnNameOfCorruptRecord": CORRUPT}
    shown = F.lit("CSV line ends inside a quoted cell, or has text behind one:")
    checked = lines.where(_failing(~whole, shown, F.col("line")))
    # Positions for names, which need no quoting then.
    by_place = T.StructType([T.StructField(f"c{i}", f.dataType) for i, f in enumerate(schema.fields[:-1])] + [schema.fields[-1]])
    return checked.select(F.from_csv("line", by_place.simpleString()[7:-1].replace(":", " "), options).alias("row")).select("row.*")


def _checked_headers(records: DataFrame, names: Sequence[str], delimiter: str) -> DataFrame:
    """``csv_records`` without their headers; one that does not follow ``names`` fails the query."""
    cells = ", ".join(f"c{i} STRING" for i in range(len(names) + 1))
    header = F.ltrim(F.rtrim("record", F.lit("\r")), F.lit("\ufeff"))
    found = F.from_csv(header, cells, {"sep": delimiter, "escape": DOUBLED, "mode": "PERMISSIVE"})
    # A blank name is its place; the cell behind the last must not be there.
    given = [
        F.when(F.trim(F.coalesce(found[f"c{i}"], F.lit(""))) == "", F.lit(f"_c{i}")).otherwise(F.trim(found[f"c{i}"])) for i in range(len(names))
    ]
    same = (F.array(*given) == F.array(*map(F.lit, names))) & found[f"c{len(names)}"].isNull()
    shown = F.concat_ws(" ", F.lit("CSV header differs:"), "record", F.lit("in"), "file")
    failure = F.raise_error(shown).cast("boolean")
    return records.where(F.when(~F.col("header"), True).when(same, False).otherwise(failure))


def checked_record(records: DataFrame, delimiter: str) -> DataFrame:
    """``csv_records`` with records as a parser takes them; open cells and lone returns fail."""
    record = F.regexp_replace("record", "\r\\z", "")
    sep, cell = re.escape(delimiter), cell_pattern(delimiter)
    whole = F.col("record").rlike(f"^{cell}(?:{sep}{cell})*+\\z")
    lone = F.contains("record", F.lit("\r")) & F.col("record").rlike("\r(?!\n)")
    shown = F.lit("CSV record ends inside a quoted cell, or has text behind one:")
    return (
        records.withColumn("record", record)
        .where(_failing(~whole, shown, F.col("record")))
        .where(_failing(lone, F.lit("CSV cell holds a carriage return without a line feed:"), F.col("record")))
    )


def parsed_record(record: Column, schema: T.StructType, delimiter: str) -> Column:
    """Struct of a record's cells; ``schema`` has names that need no quoting."""
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema.fields)
    return F.from_csv(record, fields, {"sep": delimiter, "escape": DOUBLED, "columnNameOfCorruptRecord": CORRUPT, "lineSep": "\n"})


def inferred_schema(records: DataFrame, n: int, delimiter: str) -> T.StructType:
    """Types of the ``n`` cells ``c0 ..`` of ``records`` (record), as Spark's reader infers them."""
    spark = records.sparkSession
    # The schema's own record tells Spark how many cells there are.
    first = spark.createDataFrame([(delimiter.join(f"c{i}" for i in range(n)),)], "record string")
    texts = getattr(first.unionAll(records.select("record"))._jdf, "as")(spark._jvm.org.apache.spark.sql.Encoders.STRING())
    reader = csv_reader(spark, delimiter, multi_line=True).option("inferSchema", True)
    return T.StructType.fromJson(json.loads(reader._jreader.csv(texts).schema().json()))


def _parsed_records(records: DataFrame, schema: T.StructType, delimiter: str) -> DataFrame:
    """Columns of ``schema``, by position, and the ordinal of ``csv_records`` without headers."""
    by_place = T.StructType([T.StructField(f"c{i}", f.dataType) for i, f in enumerate(schema.fields[:-1])] + [schema.fields[-1]])
    row = parsed_record(F.col("record"), by_place, delimiter)
    return checked_record(records, delimiter).select(row.alias("row"), F.struct("file", "start", "line").alias(ORDINAL)).select("row.*", ORDINAL)


def _long_enough(names: Sequence[str], needed: int, delimiter: str) -> Column:
    """Filter that fails the query on a row with fewer than ``needed`` cells."""
    sep = re.escape(delimiter)
    cell = f'(?:"[^"]*+(?:""[^"]*+)*+")?(?:(?!{sep}).)*+'
    cells = F.regexp_count(F.col(CORRUPT), F.lit(f"(?s)(?:^|{sep}){cell}"))
    # Naming all columns keeps the parser from pruning any, without which it
    # would not see that a row is short.
    too_short = F.col(CORRUPT).isNotNull() & (cells < needed)
    return _failing(too_short, F.lit("CSV row is too short:"), F.col(CORRUPT), *[column(n) for n in names])
