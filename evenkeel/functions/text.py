"""Canonical text: the one form in which keys and cells are compared.

The rule is "what Python's ``str(value).strip()`` prints, with NULL as the blank
string". The rules are Spark SQL expressions, so they stay inside whole-stage
codegen and need no Python worker.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evenkeel.functions.names import quoted

# Every code point Python's str.isspace() accepts.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

DECIMAL_STYLES = ("plain", "stripped", "float", "oracle")

# How Spark reads a NUMBER column of Oracle that has no declared size.
ORACLE_ANY = (38, 10)


def canonical_text(name: str, data_type: T.DataType, decimals: str = "plain") -> Column:
    """Comparable text of the named column; never NULL.

    ``decimals`` picks the text of decimals that have a scale: ``plain`` keeps it
    (``10.50``), ``stripped`` drops trailing zeros (``10.5``, ``10``) and ``float``
    prints floating point numbers (``10.5``, ``10.0``), as database clients that
    hand such columns out as floats would. ``oracle`` follows Oracle's Python clients
    column by column: one with a declared scale prints floats, and one without
    a declared size, which Spark reads as ``decimal(38,10)``, prints integral values
    without a point and others as floats.
    """
    return F.expr(text_sql(quoted(name), data_type, decimals))


def text_sql(value: str, data_type: T.DataType, decimals: str = "plain") -> str:
    """SQL of the canonical text of a SQL value."""
    if decimals not in DECIMAL_STYLES:
        raise ValueError(f"decimals must be one of {DECIMAL_STYLES}, not {decimals!r}")
    return f"coalesce({_nullable_text(value, data_type, decimals)}, '')"


def quick_text(value: str, data_type: T.DataType, decimals: str = "plain") -> tuple[str, str]:
    """Cheaper SQL for the text of a SQL value, and the test of where it holds.

    Strings keep the white space around them, so equal quick texts mean equal
    canonical texts where both tests hold, but not the other way round.
    """
    if isinstance(data_type, T.StringType):
        return f"coalesce(CAST({value} AS STRING), '')", "true"
    as_double = isinstance(data_type, T.DecimalType) and _printed_as_float(data_type, decimals)
    if isinstance(data_type, T.DoubleType) or as_double:
        number = f"CAST({value} AS DOUBLE)"
        printed_alike = f"abs({number}) >= 1e-3 AND abs({number}) < 1e7 OR {number} = 0"
        return f"coalesce(CAST({number} AS STRING), '')", f"coalesce({printed_alike}, true)"
    return text_sql(value, data_type, decimals), "true"


def _printed_as_float(data_type: T.DecimalType, decimals: str) -> bool:
    if data_type.scale == 0 or decimals not in ("float", "oracle"):
        return False
    return decimals == "float" or (data_type.precision, data_type.scale) != ORACLE_ANY


def _nullable_text(value: str, data_type: T.DataType, decimals: str) -> str:
    if isinstance(data_type, (T.StringType, T.CharType, T.VarcharType)):
        return _stripped(f"CAST({value} AS STRING)")  # the cast drops any collation
    if isinstance(data_type, (T.IntegralType, T.DateType, T.NullType)):
        return f"CAST({value} AS STRING)"
    if isinstance(data_type, T.DoubleType):
        return _double_text(value)
    if isinstance(data_type, T.FloatType):
        # by way of text, so that 0.1 does not become 0.10000000149011612
        return _double_text(f"CAST(CAST({value} AS STRING) AS DOUBLE)")
    if isinstance(data_type, T.DecimalType):
        plain = f"CAST({value} AS STRING)"
        if decimals == "plain" or data_type.scale == 0:
            return plain
        if _printed_as_float(data_type, decimals):
            return _double_text(f"CAST({value} AS DOUBLE)")
        if decimals == "oracle":
            number = _double_text(f"CAST({value} AS DOUBLE)")
            return f"CASE WHEN {value} % 1 = 0 THEN CAST(CAST({value} AS DECIMAL(38, 0)) AS STRING) ELSE {number} END"
        return f"rtrim('.', rtrim('0', {plain}))"
    if isinstance(data_type, T.BooleanType):
        return f"CASE {value} WHEN true THEN 'True' WHEN false THEN 'False' END"
    if isinstance(data_type, (T.TimestampType, T.TimestampNTZType)):
        # The cast cuts a fraction's trailing zeros; a whole one has six digits. The year
        # may have more than four.
        time = f"CAST({value} AS STRING)"
        whole = f"substring_index({time}, '.', 1)"
        fraction = f"rpad(substring_index({time}, '.', -1), 6, '0')"
        return f"CASE WHEN contains({time}, '.') THEN concat({whole}, '.', {fraction}) ELSE {time} END"
    raise TypeError(f"cannot compare values of type {data_type.simpleString()}")


def _stripped(text: str) -> str:
    """Trim all Unicode white space; plain TRIM knows only U+0020.

    Texts that start and end with visible ASCII skip the slower search.
    """
    visible = " AND ".join(
        f"substr({text}, {position}, 1) > ' ' AND substr({text}, {position}, 1) <= '~'"
        for position in (1, -1)
    )
    return f"CASE WHEN {visible} THEN {text} ELSE trim(BOTH '{WHITE_SPACE}' FROM {text}) END"


def _double_text(value: str) -> str:
    """Python's ``repr`` of a float, from the JVM's text of the same number.

    The JVM writes ``1.2345678E7`` outside [1e-3, 1e7); Python goes on in plain
    digits down to 1e-4 and up to 1e16 and writes exponents as ``e-05`` / ``e+16``.
    Beyond these the JVM up to version 18 may write more digits than needed: a text of
    fewer stands if it reads as the same number.
    """
    jvm = f"CAST({value} AS STRING)"
    size = f"abs({value})"
    # The cast goes through the JVM's text, and 17 digits before the point and 21
    # after it hold every number between 1e-4 and 1e16 as printed there.
    unpadded = f"rtrim('0', CAST(CAST({value} AS DECIMAL(38, 21)) AS STRING))"
    plain = f"regexp_replace({unpadded}, '[.]$', '.0')"
    digits = f"length(substring_index({jvm}, 'E', 1)) - CAST({value} < 0 AS INT) - 1"
    of_length = lambda n: f"format_string(concat('%.', greatest({n} - 1, 0), 'E'), {value})"
    tries = [(f"{digits} > {n} AND ", of_length(n)) for n in (15, 16)] + [("", of_length(f"{digits} - 1"))]
    shorter = " ".join(f"WHEN {longer}CAST({text} AS DOUBLE) = {value} THEN {text}" for longer, text in tries)
    # 1.50E+17 becomes 1.5e+17: the exponent has a sign and at least two digits already
    scientific = f"regexp_replace(CASE {shorter} ELSE {of_length(digits)} END, '[.]?0*E', 'e')"
    return (
        f"CASE WHEN {value} IS NULL THEN NULL"
        f" WHEN {size} >= 1e-3 AND {size} < 1e7 OR {value} = 0 THEN {jvm}"
        f" WHEN {size} >= 1e-4 AND {size} < 1e16 THEN {plain}"
        f" WHEN isnan({value}) THEN 'nan'"
        f" WHEN {value} = double('infinity') THEN 'inf'"
        f" WHEN {value} = double('-infinity') THEN '-inf'"
        f" ELSE {scientific} END"
    )
