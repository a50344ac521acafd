"""Keyed comparison of two tables: one shuffle per side, then one join.

Keys must be unique, and two ways of checking that keep a hot key (say, a third
of all rows with a blank key) from ever reaching one join task:

* ``inline`` groups each side on its keys. The grouping folds a hot key to one
  row per input task before the shuffle and leaves the data partitioned and
  sorted for the join. Every table is read once.
* ``keys_first`` counts the keys in a scalar subquery that reads only the key
  columns, and joins the plain rows once it has passed. That spares the grouping
  of whole rows, so it is faster on columnar tables, which it reads twice.

Cells travel through the shuffle in their own types and become text only after
the join, and only where the raw values are not plainly equal.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evenkeel.functions.names import literal, quoted
from evenkeel.functions.text import quick_text, text_sql
from evenkeel.operators.validate import canonical_keys, guard_counted, guard_first, key_names

SOURCE = "s"
TARGET = "t"

UNIQUE_CHECKS = ("inline", "keys_first")


@dataclass(frozen=True)
class Cell:
    """One side of a compare column as it stands after the join, in SQL."""

    raw: str
    data_type: T.DataType
    text: str
    quick_text: str
    quick_text_holds: str


@dataclass(frozen=True)
class CellPair:
    """Both sides of one compare column, for a key that both sides have."""

    name: str
    source: Cell
    target: Cell

    def may_differ(self) -> str:
        """SQL test that is true wherever the texts differ, and cheap where not."""
        left, right = self.source, self.target
        same_type = left.data_type == right.data_type
        if same_type and isinstance(left.data_type, T.DoubleType):
            # 0.0 equals -0.0 but prints differently
            as_printed = f"CAST({left.raw} AS STRING) = CAST({right.raw} AS STRING)"
            equal = f"{left.raw} = {right.raw} AND ({left.raw} <> 0 OR {as_printed})"
            return f"NOT coalesce({equal}, {left.raw} IS NULL AND {right.raw} IS NULL)"
        # A collation may call different strings equal.
        collated = isinstance(left.data_type, T.StringType) and left.data_type != T.StringType()
        if same_type and not collated and not isinstance(left.data_type, T.FloatType):
            return f"NOT ({left.raw} <=> {right.raw})"
        holds = f"{left.quick_text_holds} AND {right.quick_text_holds}"
        return f"NOT ({left.quick_text} = {right.quick_text} AND {holds})"


def cell_name(prefix: str, position: int) -> str:
    return f"{prefix}_{position}"


def count_name(prefix: str) -> str:
    return f"{prefix}_n"


def order_name(prefix: str) -> str:
    return f"{prefix}_order"


def keyed(
    df: DataFrame,
    keys: Sequence[str],
    compare: Sequence[str],
    prefix: str,
    side: str,
    decimals: str,
    unique_check: str = "inline",
    order: str | None = None,
) -> DataFrame:
    """One row per canonical key: a presence mark (``*_n``) and the raw cells.

    Compare columns the table lacks are left out; see ``pair_cells``. ``order`` names a
    column that goes along as ``*_order``.
    """
    cells = {
        cell_name(prefix, i): quoted(name) for i, name in enumerate(compare) if name in df.columns
    }
    if order is not None:
        cells[order_name(prefix)] = quoted(order)
    rows = df.selectExpr(
        *canonical_keys(df, keys, decimals),
        f"1 AS {count_name(prefix)}",
        *[f"{cell} AS {name}" for name, cell in cells.items()],
    )
    names = key_names(keys)
    if unique_check == "keys_first" and cells:
        return guard_first(rows, names, side)
    mark = count_name(prefix)
    if not cells:
        # Keys alone are counted in a hash aggregate, which no other check beats.
        return guard_counted(rows.groupBy(*names).agg(F.count("*").alias(mark)), names, mark, side)
    # One struct is cheaper to carry through the sort-based aggregate than many columns.
    grouped = (
        rows.selectExpr(*names, f"struct({', '.join(cells)}) AS cells")
        .groupBy(*names)
        .agg(F.count("*").alias(mark), F.first("cells").alias("cells"))
    )
    return guard_counted(grouped, names, mark, side).selectExpr(
        *names, mark, *[f"cells.{name} AS {name}" for name in cells]
    )


def pair_cells(
    source: DataFrame, target: DataFrame, compare: Sequence[str], decimals: str
) -> list[CellPair]:
    """Both sides of every compare column, by original schema."""
    return [
        CellPair(name, _cell(source, name, SOURCE, i, decimals), _cell(target, name, TARGET, i, decimals))
        for i, name in enumerate(compare)
    ]


def _cell(df: DataFrame, name: str, prefix: str, position: int, decimals: str) -> Cell:
    if name not in df.columns:
        return Cell("''", T.NullType(), "''", "''", "true")
    data_type = df.schema[name].dataType
    raw = cell_name(prefix, position)
    text = text_sql(raw, data_type, decimals)
    return Cell(raw, data_type, text, *quick_text(raw, data_type, decimals))


# SQL tests of a full outer join's rows
IN_SOURCE = f"{count_name(SOURCE)} IS NOT NULL"
IN_TARGET = f"{count_name(TARGET)} IS NOT NULL"
IN_BOTH = f"{IN_SOURCE} AND {IN_TARGET}"


def may_differ(cells: Sequence[CellPair]) -> str:
    """SQL test that is true wherever some compare column differs.

    It is kept small on purpose: the JVM leaves methods of more than 8,000 bytes
    of code uncompiled, and the exact texts of a few columns take that much.
    """
    return " OR ".join(pair.may_differ() for pair in cells) or "false"


def changed_cells(cells: Sequence[CellPair]) -> str:
    """SQL array of (column_name, source_value, target_value) that differ.

    For rows that may differ; it prints every cell.
    """
    lines = ", ".join(
        f"named_struct('column_name', {literal(pair.name)},"
        f" 'source_value', {pair.source.text}, 'target_value', {pair.target.text})"
        for pair in cells
    )
    return f"filter(array({lines}), cell -> cell.source_value <> cell.target_value)"


def any_cell_differs(cells: Sequence[CellPair]) -> str:
    """SQL test: some compare column differs, for a key that both sides have."""
    return f"({may_differ(cells)}) AND size({changed_cells(cells)}) > 0" if cells else "false"
