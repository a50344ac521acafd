"""Reconciliation rules on small tables."""

import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from evenkeel.operators import DuplicateKeyError, duplicate_keys
from evenkeel.plans import reconcile
from model import expected

CHECKS = ("inline", "keys_first")


def table(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def as_dicts(df):
    return [row.asDict() for row in df.collect()]


def lines(df):
    return {tuple(row) for row in df.collect()}


KEYS = [None, "", " 1", "1", "2 ", "3", "x", "\ty", "10", "11", "12"]
CELLS = [None, "", " ", "a", " a", "b", "1", "1.0"]


@pytest.mark.parametrize("check", CHECKS)
@pytest.mark.parametrize("seed", range(4))
def test_random_tables_equal_the_model(spark, seed, check):
    rng = random.Random(seed)

    def rows():
        seen, out = set(), []
        for _ in range(40):
            key = (rng.choice(KEYS), rng.choice(KEYS))
            if tuple((part or "").strip() for part in key) not in seen:
                seen.add(tuple((part or "").strip() for part in key))
                out.append((*key, rng.choice(CELLS), rng.choice(CELLS)))
        return out

    schema = "k string, `l.l` string, v string, `w``'` string"
    source, target = table(spark, rows(), schema), table(spark, rows(), schema)
    keys, compare = ["k", "l.l"], ["v", "w`'"]
    want_lines, want_summary = expected(as_dicts(source), as_dicts(target), keys, compare)
    result = reconcile(source, target, keys, compare, unique_check=check)
    report = result.report()
    assert lines(report) == want_lines
    assert report.count() == len(want_lines)
    assert tuple(result.summary().first()) == want_summary
    by_kind = {kind: {x for x in want_lines if x[0] == kind} for kind in {x[0] for x in want_lines}}
    assert lines(result.missing()) == {x[1:3] for x in by_kind.get("MISSING_IN_TARGET", set())}
    assert lines(result.extra()) == {x[1:3] for x in by_kind.get("EXTRA_IN_TARGET", set())}
    assert lines(result.mismatches()) == by_kind.get("VALUE_MISMATCH", set())


def test_types_may_differ_but_texts_decide(spark):
    source = table(spark, [("1", "10", "2.5"), ("2", "7", "1e16")], "id string, n string, x string")
    target = table(spark, [(1, 10.0, 2.5), (2, 7.0, 1e16)], "id int, n double, x double")
    got = lines(reconcile(source, target, "id").report())
    assert got == {
        ("VALUE_MISMATCH", "1", "n", "10", "10.0"),
        ("VALUE_MISMATCH", "2", "n", "7", "7.0"),
        ("VALUE_MISMATCH", "2", "x", "1e16", "1e+16"),
    }


def test_signed_zero_and_nan(spark):
    nan = float("nan")
    source = table(spark, [(1, 0.0), (2, nan), (3, None)], "id int, x double")
    target = table(spark, [(1, -0.0), (2, nan), (3, None)], "id int, x double")
    got = lines(reconcile(source, target, ["id"]).report())
    assert got == {("VALUE_MISMATCH", "1", "x", "0.0", "-0.0")}


def test_default_compare_uses_source_columns_and_blanks(spark):
    source = table(spark, [(1, "a", None), (2, "a", "only here")], "id int, v string, gone string")
    target = table(spark, [(1, "a", "x"), (2, "a", "x")], "id int, v string, own string")
    assert lines(reconcile(source, target, ["id"]).report()) == {
        ("VALUE_MISMATCH", "2", "gone", "only here", "")
    }
    with pytest.raises(ValueError, match="gone"):
        reconcile(source, target, ["id"], ["gone"])


def test_where_filters_the_target_only(spark):
    source = table(spark, [(1, "a"), (2, "b")], "id int, v string")
    for where in ("v = 'a'", F.col("v") == "a"):
        assert lines(reconcile(source, source, "id", where=where).report()) == {
            ("MISSING_IN_TARGET", "2", None, None, None)
        }


@pytest.mark.parametrize("check", CHECKS)
def test_where_applies_before_the_uniqueness_check(spark, check):
    source = table(spark, [(1, "a")], "id int, v string")
    target = table(spark, [(1, "a"), (1, "b")], "id int, v string")
    result = reconcile(source, target, "id", where="v = 'a'", unique_check=check)
    assert result.report().count() == 0


@pytest.mark.parametrize("check", CHECKS)
def test_empty_sides(spark, check):
    rows = table(spark, [(1, "a")], "id int, v string")
    none = rows.where("false")
    assert tuple(reconcile(none, rows, "id", unique_check=check).summary().first()) == (0, 1, 0, 1, 0)
    assert tuple(reconcile(rows, none, "id", unique_check=check).summary().first()) == (1, 0, 1, 0, 0)
    assert tuple(reconcile(none, none, "id", unique_check=check).summary().first()) == (0, 0, 0, 0, 0)


def test_labels(spark):
    rows = table(spark, [(1, "a")], "id int, v string")
    result = reconcile(rows, rows.where("false"), "id", target_label="oracle")
    assert result.report().columns[-1] == "oracle_value"
    assert result.report().first()[0] == "MISSING_IN_ORACLE"
    assert result.summary().columns == [
        "source_rows",
        "oracle_rows",
        "missing_in_oracle",
        "extra_in_oracle",
        "value_mismatches",
    ]
    with pytest.raises(ValueError, match="plain name"):
        reconcile(rows, rows, "id", target_label="a b")


@pytest.mark.parametrize("check", CHECKS)
@pytest.mark.parametrize("action", ["report", "summary", "missing", "extra", "mismatches"])
def test_repeated_keys_fail_on_either_side(spark, check, action):
    good = table(spark, [("1", "a"), ("2", "b")], "id string, v string")
    bad = table(spark, [("1", "a"), (" 1", "b"), ("2", "b")], "id string, v string")
    for source, target, side in ((bad, good, "source"), (good, bad, "target")):
        result = reconcile(source, target, "id", unique_check=check)
        with pytest.raises(PySparkException, match=rf"A key repeats in {side}: \(1\)"):
            getattr(result, action)().collect()


@pytest.mark.parametrize("check", CHECKS)
def test_blank_and_null_keys_are_one_key(spark, check):
    source = table(spark, [(None, "a"), (" ", "b")], "id string, v string")
    target = table(spark, [("1", "a")], "id string, v string")
    with pytest.raises(PySparkException, match=r"A key repeats in source: \(\)"):
        reconcile(source, target, "id", unique_check=check).report().collect()
    one = table(spark, [(None, "a")], "id string, v string")
    blank = table(spark, [(" ", "a")], "id string, v string")
    assert reconcile(one, blank, "id", unique_check=check).report().count() == 0


def test_duplicate_keys_are_counted(spark):
    df = table(spark, [("1", 1), (" 1", 2), (None, 3), ("", 4), ("x", 5)], "id string, v int")
    assert lines(duplicate_keys(df, ["id"])) == {("1", 2), ("", 2)}


def test_name_checks(spark):
    rows = table(spark, [(1, "a")], "id int, v string")
    for keys, compare in (([], None), ("", None), ("ID", None), ("id", ["V"]), ("nope", None)):
        with pytest.raises(ValueError):
            reconcile(rows, rows, keys, compare)
    twice = rows.select("id", "v", "v")
    with pytest.raises(ValueError, match="repeated"):
        reconcile(rows, twice, "id")
    with pytest.raises(ValueError, match="no columns"):
        reconcile(rows, rows.select(), "id")
    nested = rows.select("id", F.array("v").alias("v"))
    with pytest.raises(TypeError, match="array"):
        reconcile(nested, nested, "id")


@pytest.mark.parametrize("ordered", [True, False])
def test_write_gives_report_and_summary_in_one_pass(spark, tmp_path, ordered):
    source = table(spark, [(i, f"a{i}") for i in range(50)], "id int, v string")
    target = table(spark, [(i, "a3" if i < 9 else f"a{i}") for i in range(5, 60)], "id int, v string")
    path = str(tmp_path / "report")
    result = reconcile(source, target, "id")
    summary = result.write(path, ordered=ordered)
    assert summary == result.summary().first().asDict()
    written = spark.read.csv(path, header=True).collect()
    assert {tuple(row) for row in written} == lines(result.report())
    if ordered:
        assert [tuple(row) for row in written] == [tuple(r) for r in result.report(ordered=True).collect()]
        kinds = [row.reconciliation_type for row in written]
        ranks = ["MISSING_IN_TARGET", "EXTRA_IN_TARGET", "VALUE_MISMATCH"]
        assert kinds == sorted(kinds, key=ranks.index)


@pytest.mark.parametrize("ordered", [True, False])
def test_write_of_equal_and_of_empty_tables(spark, tmp_path, ordered):
    rows = table(spark, [(1, "a"), (2, None)], "id int, v string")
    for name, side, count in (("equal", rows, 2), ("empty", rows.where("false"), 0)):
        path = tmp_path / name
        summary = reconcile(side, side, "id").write(str(path), ordered=ordered)
        assert list(summary.values()) == [count, count, 0, 0, 0]
        text = "".join(part.read_bytes().decode() for part in path.glob("*.csv"))
        assert text == "reconciliation_type,key_1,column_name,source_value,target_value\n"


def test_write_raises_duplicate_key_error(spark, tmp_path):
    rows = table(spark, [(1, "a"), (1, "b")], "id int, v string")
    for check in CHECKS:
        with pytest.raises(DuplicateKeyError, match=r"^A key repeats in source: \(1\)$"):
            reconcile(rows, rows, "id", unique_check=check).write(str(tmp_path / check))


@pytest.mark.parametrize("check", CHECKS)
def test_a_hot_repeated_key_fails_without_pairing_its_rows(spark, check):
    # a third of 300,000 rows per side share a key: paired, 10 billion rows
    rows = spark.range(300_000).selectExpr("IF(id % 3 = 0, NULL, id) AS k", "id AS v")
    with pytest.raises(PySparkException, match="A key repeats"):
        reconcile(rows, rows, "k", unique_check=check).report().count()
