"""Checks on names (no job) and on key uniqueness (inside the plan)."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evenkeel.functions.names import quoted
from evenkeel.functions.text import text_sql


DUPLICATE_MESSAGE = "A key repeats in"


class DuplicateKeyError(ValueError):
    """A key occurs more than once on one side."""


def check_columns(
    df: DataFrame, keys: Sequence[str], compare: Sequence[str] | None, side: str
) -> None:
    """Raise ValueError unless every named column exists, letter for letter."""
    present = df.columns
    if not present:
        raise ValueError(f"{side} has no columns")
    if not keys:
        raise ValueError("at least one key column is needed")
    repeated = sorted({name for name in present if present.count(name) > 1})
    if repeated:
        raise ValueError(f"{side} has repeated column names: {repeated}")
    for role, names in (("key", keys), ("compare", compare or ())):
        absent = [name for name in names if name not in present]
        if absent:
            raise ValueError(f"{side} lacks {role} columns: {absent}")


def key_names(keys: Sequence[str]) -> list[str]:
    """Report names of the key columns: ``key_1 .. key_n``."""
    return [f"key_{position}" for position in range(1, len(keys) + 1)]


def canonical_keys(df: DataFrame, keys: Sequence[str], decimals: str = "plain") -> list[str]:
    """SQL of the key columns as canonical text under their report names."""
    schema = df.schema
    return [
        f"{text_sql(quoted(name), schema[name].dataType, decimals)} AS {alias}"
        for name, alias in zip(keys, key_names(keys), strict=True)
    ]


def duplicate_keys(df: DataFrame, keys: Sequence[str], decimals: str = "plain") -> DataFrame:
    """Keys that occur more than once after normalising, with their row count.

    Only the key columns are read, and a hot key is folded to one row per input
    task before the shuffle.
    """
    check_columns(df, keys, None, "table")
    counted = df.selectExpr(*canonical_keys(df, keys, decimals)).groupBy(*key_names(keys))
    return counted.agg(F.count("*").alias("n")).where("n > 1")


def assert_unique(df: DataFrame, keys: Sequence[str], side: str, decimals: str = "plain") -> int:
    """Run one job that raises DuplicateKeyError if any key repeats; returns the row count."""
    names = key_names(keys)
    counted = df.selectExpr(*canonical_keys(df, keys, decimals)).groupBy(*names).agg(
        F.count("*").alias("n")
    )
    rows, repeated = counted.selectExpr(
        "coalesce(sum(n), 0)", f"min(CASE WHEN n > 1 THEN {_shown(names)} END)"
    ).first()
    if repeated is not None:
        raise DuplicateKeyError(f"{DUPLICATE_MESSAGE} {side}: {repeated}")
    return rows


def guard_counted(counted: DataFrame, keys: Sequence[str], count: str, side: str) -> DataFrame:
    """Fail the running query if a counted key has more than one row.

    The guard is a filter above an aggregate that the plan has anyway, so it
    costs no further pass over the data.
    """
    failure = f"raise_error(concat('{DUPLICATE_MESSAGE} {side}: ', {_shown(keys)}))"
    return counted.where(f"CASE WHEN {count} > 1 THEN CAST({failure} AS BOOLEAN) ELSE true END")


def guard_first(rows: DataFrame, keys: Sequence[str], side: str) -> DataFrame:
    """Fail before ``rows`` move if a key of theirs repeats.

    The check is a scalar subquery over the key columns alone, so a columnar
    source is read a second time only in those columns.
    """
    counted = rows.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")
    repeated = counted.agg(F.expr(f"min({_shown(keys)})")).scalar()
    message = F.concat(F.lit(f"{DUPLICATE_MESSAGE} {side}: "), repeated)
    failure = F.raise_error(message).cast("boolean")
    return rows.where(F.when(repeated.isNotNull(), failure).otherwise(F.lit(True)))


def _shown(keys: Sequence[str]) -> str:
    """SQL of a key's text for messages: ``(k1, k2)``."""
    return f"concat('(', concat_ws(', ', {', '.join(keys)}), ')')"


@contextmanager
def duplicate_keys_raised() -> Iterator[None]:
    """Turn a guard's failure of a Spark job into DuplicateKeyError."""
    try:
        yield
    except PySparkException as error:
        found = re.search(rf"{DUPLICATE_MESSAGE} \w+: \(.*\)", str(error))
        if found is None:
            raise
        raise DuplicateKeyError(found.group()) from error
