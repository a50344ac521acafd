"""Canonical text against Python's own ``str(value).strip()``."""

import datetime as dt
import random
import struct
from decimal import Decimal

import pytest
from pyspark.sql import types as T

from evenkeel.functions import canonical_text, parse_list
from evenkeel.functions.text import WHITE_SPACE


def texts(spark, values, data_type, **options):
    df = spark.createDataFrame(
        [(i, v) for i, v in enumerate(values)],
        T.StructType([T.StructField("i", T.LongType()), T.StructField("v v`", data_type)]),
    )
    rows = df.select("i", canonical_text("v v`", data_type, **options).alias("t")).collect()
    return [row.t for row in sorted(rows)]


def python_text(value):
    return "" if value is None else str(value).strip()


def test_white_space_is_pythons():
    assert sorted(WHITE_SPACE) == [chr(c) for c in range(0x110000) if chr(c).isspace()]


def test_strings(spark):
    values = [None, "", " ", WHITE_SPACE, "a", "  a b\t", " x　", "x\ny\n", "​z", "'\\"]
    values += [f"{c}in{c}" for c in WHITE_SPACE]
    assert texts(spark, values, T.StringType()) == [python_text(v) for v in values]


def test_integers_and_booleans(spark):
    for data_type, values in (
        (T.LongType(), [None, 0, -1, 2**63 - 1]),
        (T.ByteType(), [None, 7, -7]),
        (T.BooleanType(), [None, True, False]),
    ):
        assert texts(spark, values, data_type) == [python_text(v) for v in values]


def test_doubles_print_like_python(spark):
    rng = random.Random(7)
    values = [None, 0.0, -0.0, 1e16, 1e-5, 1.5e-5, 1e-4, 12345678.0, 123456789.25, 1e15, 1e100, -1e-7]
    values += [float("nan"), float("inf"), float("-inf"), 1e300, 1.5e-300, 9999999.999, 0.001, 1e7]
    values += [rng.choice((-1, 1)) * 10 ** rng.uniform(-4, 16) for _ in range(20000)]
    values += [round(rng.uniform(0, 1e9), rng.randint(0, 6)) for _ in range(20000)]
    assert texts(spark, values, T.DoubleType()) == [python_text(v) for v in values]


def test_floats_keep_their_short_text(spark):
    values = [None, 0.1, 1.5, 16777216.0, 1e-5]
    assert texts(spark, values, T.FloatType()) == ["", "0.1", "1.5", "16777216.0", "1e-05"]


def test_any_bit_pattern_names_the_same_double(spark):
    rng = random.Random(8)
    values = [struct.unpack("d", struct.pack("Q", rng.getrandbits(64)))[0] for _ in range(60000)]
    got = texts(spark, values, T.DoubleType())
    assert all(float(text) == value or value != value for text, value in zip(got, values, strict=True))
    # Up to Java 18 the JVM's own digits may round to a neighbour of the nearest text of 16 digits.
    equal = sum(text == python_text(value) for text, value in zip(got, values, strict=True))
    assert equal >= len(values) - 12


def test_few_digits_at_all_exponents(spark):
    rng = random.Random(9)
    values = [rng.choice((-1, 1)) * float(f"{rng.randint(1, 10**9)}e{rng.randint(-330, 298)}") for _ in range(20000)]
    values += [float(f"1e{n}") for n in range(-323, 309)] + [5e-324 * n for n in range(1, 500)]
    assert texts(spark, values, T.DoubleType()) == [python_text(v) for v in values]


def test_times(spark):
    stamps = [None, dt.datetime(2024, 2, 29), dt.datetime(1999, 12, 31, 23, 59, 59, 120000)]
    stamps += [dt.datetime(2024, 1, 1, 0, 0, 0, 1), dt.datetime(1900, 1, 1, 12, 30)]
    assert texts(spark, stamps, T.TimestampNTZType()) == [python_text(v) for v in stamps]
    assert texts(spark, stamps[:4], T.TimestampType()) == [python_text(v) for v in stamps[:4]]
    days = [None, dt.date(2024, 2, 29), dt.date(1970, 1, 1)]
    assert texts(spark, days, T.DateType()) == [python_text(v) for v in days]


def test_decimals(spark):
    values = [None, Decimal("10.50"), Decimal("10.00"), Decimal("-0.25"), Decimal("100.00")]
    money = T.DecimalType(10, 2)
    assert texts(spark, values, money) == ["", "10.50", "10.00", "-0.25", "100.00"]
    assert texts(spark, values, money, decimals="stripped") == ["", "10.5", "10", "-0.25", "100"]
    assert texts(spark, values, money, decimals="float") == ["", "10.5", "10.0", "-0.25", "100.0"]
    whole = [Decimal(100), Decimal(0)]
    for style in ("plain", "stripped", "float"):
        assert texts(spark, whole, T.DecimalType(20, 0), decimals=style) == ["100", "0"]


@pytest.mark.parametrize(
    "data_type",
    [T.BinaryType(), T.ArrayType(T.FloatType()), T.MapType(T.StringType(), T.StringType())],
)
def test_types_without_a_text_are_refused(data_type):
    with pytest.raises(TypeError):
        canonical_text("v", data_type)


def test_parse_list():
    assert parse_list(" a, b ,,c ") == ["a", "b", "c"]
    assert parse_list(["a", "b"]) == ["a", "b"]
    assert parse_list(None) is None
    assert parse_list("") == []


def test_far_timestamps_keep_their_fraction(spark):
    # Python's own type ends with year 9999.
    times = ["9999-12-31 23:59:59.5", "+10000-01-01 00:00:00.123456", "+10000-01-01 00:00:00.123457", "+10000-01-01 00:00:00"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(times)], "i int, t string").selectExpr("i", "CAST(t AS TIMESTAMP_NTZ) AS t")
    got = [r.x for r in df.select("i", canonical_text("t", T.TimestampNTZType()).alias("x")).orderBy("i").collect()]
    assert got == ["9999-12-31 23:59:59.500000", *times[1:]]


def test_oracle_numbers(spark):
    huge = Decimal("9" * 28)
    any_size = [None, Decimal(0), Decimal(1), Decimal(-12), Decimal("1.5"), Decimal("-0.25"), huge, Decimal(10) ** 16]
    got = texts(spark, any_size, T.DecimalType(38, 10), decimals="oracle")
    assert got == ["", "0", "1", "-12", "1.5", "-0.25", "9" * 28, "10000000000000000"]
    with_scale = [None, Decimal("1.00"), Decimal("1.50"), Decimal("-3.25")]
    assert texts(spark, with_scale, T.DecimalType(10, 2), decimals="oracle") == ["", "1.0", "1.5", "-3.25"]
    assert texts(spark, [None, Decimal(7)], T.DecimalType(10, 0), decimals="oracle") == ["", "7"]
