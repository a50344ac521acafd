"""Reconcile a source table with a target table by key."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Observation, SparkSession

from evenkeel.functions.names import parse_list
from evenkeel.operators import compare as cmp
from evenkeel.operators.report import (
    Labels,
    difference_lines,
    report_order,
    summary_columns,
)
from evenkeel.operators.validate import (
    DuplicateKeyError,
    assert_unique,
    check_columns,
    duplicate_keys_raised,
    key_names,
)
from evenkeel.session import scratch_path
from evenkeel.sinks.report import write_report_csv


def reconcile(
    source: DataFrame,
    target: DataFrame,
    keys: str | Iterable[str],
    compare: str | Iterable[str] | None = None,
    where: str | Column | None = None,
    target_label: str = "target",
    decimals: str = "plain",
    unique_check: str = "inline",
    source_order: str | None = None,
    target_order: str | None = None,
) -> Reconciliation:
    """Compare ``source`` to ``target`` and return the lazy result.

    ``keys`` and ``compare`` take a list or a comma-separated string. Without
    ``compare``, every non-key source column is compared and a column the target
    lacks counts as blank; an empty list compares keys only. ``where`` filters
    the target alone, so a source row whose match it hides is reported missing.
    ``decimals`` is explained at ``canonical_text``.

    A key that repeats on either side fails the query. ``unique_check="inline"``
    reads each table once; ``"keys_first"`` is faster on columnar tables, whose
    key columns it reads beforehand. Both are explained in ``operators.compare``.

    ``source_order`` and ``target_order`` name columns that hold a row's place in its
    table, as ``read_csv_strict(ordinal=True)`` adds; they are not compared. A report that
    is ``ordered="input"`` follows them: missing rows and mismatches as in the source,
    extra rows as in the target (by key without a ``target_order``).
    """
    return Reconciliation(
        source, target, keys, compare, where, target_label, decimals, unique_check, (source_order, target_order)
    )


class Reconciliation:
    """Lazy comparison; every method but ``write`` only builds a plan."""

    def __init__(
        self,
        source: DataFrame,
        target: DataFrame,
        keys: str | Iterable[str],
        compare: str | Iterable[str] | None,
        where: str | Column | None,
        target_label: str,
        decimals: str,
        unique_check: str,
        orders: tuple[str | None, str | None] = (None, None),
    ) -> None:
        if unique_check not in cmp.UNIQUE_CHECKS:
            raise ValueError(f"unique_check must be one of {cmp.UNIQUE_CHECKS}")
        self._orders = dict(zip((cmp.SOURCE, cmp.TARGET), orders, strict=True))
        self.keys = parse_list(keys) or []
        named = parse_list(compare)
        check_columns(source, self.keys, named, "source")
        check_columns(target, self.keys, named, target_label)
        if named is None:
            named = [name for name in source.columns if name not in self.keys and name != orders[0]]
        self.compare = list(dict.fromkeys(named))
        self.labels = Labels(target_label)
        if where is not None:
            target = target.where(where)
        self._source = source
        self._target = target
        self._target_label = target_label
        self._decimals = decimals
        self._unique_check = unique_check
        self._key_names = key_names(self.keys)
        self._cells = cmp.pair_cells(source, target, self.compare, decimals)

    def report(self, ordered: bool | str = False) -> DataFrame:
        """All differences: missing rows, extra rows and differing cells.

        ``ordered`` sorts them by kind and key, ``ordered="input"`` by kind and place in
        their tables.
        """
        places = self._places(ordered)
        lines = self._lines(self._joined("full_outer", places), places)
        return self._sorted(lines, places) if ordered else lines

    def summary(self) -> DataFrame:
        """One row: rows per side, missing, extra, and keys with a differing cell."""
        return self._joined("full_outer").agg(*summary_columns(self._cells, self.labels))

    def missing(self) -> DataFrame:
        """Keys of the source that the target lacks."""
        source, target = self._sides([])
        return source.join(target, self._key_names, "left_anti").select(*self._key_names)

    def extra(self) -> DataFrame:
        """Keys of the target that the source lacks."""
        source, target = self._sides([])
        return target.join(source, self._key_names, "left_anti").select(*self._key_names)

    def mismatches(self) -> DataFrame:
        """One line per differing cell of the keys both sides have."""
        return self._lines(self._joined("inner"))

    def write(self, path: str, ordered: bool | str = True, mode: str = "errorifexists") -> dict[str, int]:
        """Write the report as CSV and return the summary, in one pass.

        The summary is observed while the lines are written, in the tasks of the
        job's last stage: Spark counts each of those once, however often tasks or
        executors are lost. Sorting needs a further stage, so an ordered report
        is staged in the shared scratch folder (its differences only) first; the
        staged lines are deleted at the end, also after a failure. A ``path`` that
        exists is refused before any work if ``mode`` does not allow it.
        """
        if mode in ("error", "errorifexists"):
            check_absent(self._source.sparkSession, path)
        places = self._places(ordered)
        observed = Observation("summary")
        joined = self._joined("full_outer", places).observe(
            observed, *summary_columns(self._cells, self.labels)
        )
        lines = self._lines(joined, places)
        try:
            with duplicate_keys_raised():
                self._write_lines(lines, path, ordered, mode, places)
        except DuplicateKeyError:
            # Both sides may have repeated keys; the source's are named first.
            assert_unique(self._source, self.keys, "source", self._decimals)
            raise
        return observed.get

    def _write_lines(self, lines: DataFrame, path: str, ordered: bool | str, mode: str, places: list[str]) -> None:
        if ordered:
            spark = lines.sparkSession
            staged = scratch_path(spark, "report")
            try:
                lines.write.parquet(staged)
                write_report_csv(self._sorted(spark.read.parquet(staged), places), path, mode)
            finally:
                _delete(spark, staged)
        else:
            write_report_csv(lines, path, mode)

    def _places(self, ordered: bool | str) -> list[str]:
        """Columns of the joined table that an input-ordered report is sorted by."""
        if ordered != "input":
            return []
        if self._orders[cmp.SOURCE] is None:
            raise ValueError("a report in input order needs source_order")
        return [cmp.order_name(prefix) for prefix, name in self._orders.items() if name is not None]

    def _sides(self, compare: list[str], places: list[str] | None = None) -> list[DataFrame]:
        return [
            cmp.keyed(
                df, self.keys, compare, prefix, side, self._decimals, self._unique_check, self._orders[prefix] if places else None
            )
            for df, prefix, side in (
                (self._source, cmp.SOURCE, "source"),
                (self._target, cmp.TARGET, self._target_label),
            )
        ]

    def _joined(self, how: str, places: list[str] | None = None) -> DataFrame:
        source, target = self._sides(self.compare, places)
        return source.join(target, self._key_names, how)

    def _lines(self, joined: DataFrame, places: list[str] | None = None) -> DataFrame:
        return difference_lines(joined, self._key_names, self._cells, self.labels, places or [])

    def _sorted(self, lines: DataFrame, places: list[str] | None = None) -> DataFrame:
        order = report_order(self._key_names, self.compare, self.labels, places or [])
        return lines.orderBy(*order).drop(*places or [])


def _place(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def check_absent(spark: SparkSession, path: str) -> None:
    files, place = _place(spark, path)
    if files.exists(place):
        raise FileExistsError(f"report {path} already exists")


def _delete(spark: SparkSession, scratch: str) -> None:
    """Remove a folder of ``scratch_path``, with the parent made for it alone."""
    files, place = _place(spark, scratch)
    files.delete(place.getParent(), True)
