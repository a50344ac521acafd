"""Helpers for column names, name lists and file tags."""

from __future__ import annotations

import re
from collections.abc import Iterable
from urllib.parse import unquote

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: longest worksheet name that spreadsheet programs accept; a length to cut tags to.
SHEET_NAME_LENGTH = 31


def quoted(name: str) -> str:
    """SQL identifier of that exact name, also with dots or backticks in it."""
    return "`" + name.replace("`", "``") + "`"


def literal(text: str) -> str:
    """SQL string literal of that exact text."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def column(name: str) -> Column:
    """Column of that exact name."""
    return F.col(quoted(name))


def parse_list(value: str | Iterable[str] | None) -> list[str] | None:
    """Names from ``"a, b,,c"`` or from any iterable; None stays None."""
    if value is None:
        return None
    if not isinstance(value, str):
        return list(value)
    stripped = (item.strip() for item in value.split(","))
    return [item for item in stripped if item]


def sheet_name(file_name: Column, length: int | None = None) -> Column:
    """Tag of a file: its base name without ``.csv``, cut to ``length`` only if one is given.

    ``file_name`` is percent-encoded, as file metadata columns are.
    """
    # url_decode reads forms, in which a plus sign is a space
    decoded = F.url_decode(F.replace(file_name, F.lit("+"), F.lit("%2B")))
    name = F.replace(decoded, F.lit(".csv"), F.lit(""))
    return name if length is None else F.substring(name, 1, length)


def sheet_name_of(file_name: str, length: int | None = None) -> str:
    """The same tag for a name the driver already holds."""
    return file_name.replace(".csv", "")[:length]


def as_path(uri: str) -> str:
    """Reader path of a file URI: decoded, with glob characters escaped."""
    return re.sub(r"([*?\[\]{}\\])", r"\\\1", unquote(uri))
