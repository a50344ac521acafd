"""The long-form difference report and the one-row summary."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evenkeel.operators.compare import (
    IN_BOTH,
    IN_SOURCE,
    IN_TARGET,
    SOURCE,
    TARGET,
    CellPair,
    any_cell_differs,
    changed_cells,
    count_name,
    may_differ,
)

# Fixed value: the report line for a cell that differs.
VALUE_MISMATCH = "VALUE_MISMATCH"


class Labels:
    """Names that depend on what the target is called."""

    def __init__(self, target: str = "target") -> None:
        if not target.isidentifier():
            raise ValueError(f"target label must be a plain name, not {target!r}")
        # Report line types, report columns and summary columns.
        self.missing_type = f"MISSING_IN_{target.upper()}"
        self.extra_type = f"EXTRA_IN_{target.upper()}"
        self.target_value = f"{target}_value"
        self.target_rows = f"{target}_rows"
        self.missing_count = f"missing_in_{target}"
        self.extra_count = f"extra_in_{target}"


def difference_lines(
    joined: DataFrame, keys: Sequence[str], cells: Sequence[CellPair], labels: Labels, kept: Sequence[str] = ()
) -> DataFrame:
    """Report lines of a joined table: one per one-sided key, one per differing cell.

    Columns of ``kept`` stay behind the others.
    """
    suspect = joined.where(f"NOT ({IN_SOURCE}) OR NOT ({IN_TARGET}) OR {may_differ(cells)}")
    kind = (
        f"CASE WHEN NOT ({IN_TARGET}) THEN '{labels.missing_type}'"
        f" WHEN NOT ({IN_SOURCE}) THEN '{labels.extra_type}'"
        f" ELSE '{VALUE_MISMATCH}' END AS reconciliation_type"
    )
    if not cells:
        blank = "CAST(NULL AS STRING) AS"
        return suspect.selectExpr(
            kind,
            *keys,
            f"{blank} column_name",
            f"{blank} source_value",
            f"{blank} {labels.target_value}",
            *kept,
        )
    # A one-sided key gives one line without a cell, a false alarm gives none.
    lines = f"CASE WHEN {IN_BOTH} THEN {changed_cells(cells)} ELSE array(NULL) END"
    return suspect.selectExpr(kind, *keys, *kept, f"explode({lines}) AS cell").selectExpr(
        "reconciliation_type",
        *keys,
        "cell.column_name AS column_name",
        "cell.source_value AS source_value",
        f"cell.target_value AS {labels.target_value}",
        *kept,
    )


def summary_columns(cells: Sequence[CellPair], labels: Labels) -> list[Column]:
    """Aggregates over a full outer join; mismatches count keys, not cells."""
    return [
        F.expr(f"{aggregate} AS {name}")
        for aggregate, name in (
            (f"count({count_name(SOURCE)})", "source_rows"),
            (f"count({count_name(TARGET)})", labels.target_rows),
            (f"count_if(NOT ({IN_TARGET}))", labels.missing_count),
            (f"count_if(NOT ({IN_SOURCE}))", labels.extra_count),
            (f"count_if({IN_BOTH} AND ({any_cell_differs(cells)}))", "value_mismatches"),
        )
    ]


def report_order(keys: Sequence[str], compare: Sequence[str], labels: Labels, inputs: Sequence[str] = ()) -> list[Column]:
    """Sort columns: missing, extra, mismatches; then ``inputs``; then key; then compare order."""
    kind = F.col("reconciliation_type")
    rank = F.when(kind == labels.missing_type, 0).when(kind == labels.extra_type, 1).otherwise(2)
    order = [rank, *[F.col(name) for name in (*inputs, *keys)]]
    if compare:
        names = F.array(*[F.lit(name) for name in compare])
        order.append(F.array_position(names, F.col("column_name")))
    return order
