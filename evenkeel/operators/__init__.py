"""Checks, keyed comparison and report shaping on DataFrames."""

from evenkeel.operators.report import VALUE_MISMATCH, Labels
from evenkeel.operators.validate import (
    DuplicateKeyError,
    assert_unique,
    check_columns,
    duplicate_keys,
)

__all__ = [
    "VALUE_MISMATCH",
    "DuplicateKeyError",
    "Labels",
    "assert_unique",
    "check_columns",
    "duplicate_keys",
]
