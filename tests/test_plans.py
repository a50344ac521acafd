"""Physical plans: what is read, what is shuffled, where filters go."""

import re

import pytest

from conftest import DATA
from evenkeel.operators import duplicate_keys
from evenkeel.plans import reconcile


@pytest.fixture(scope="module")
def orders(spark):
    # plans as for tables too large to broadcast
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark.read.parquet(f"{DATA}/sf0.001/orders.parquet")
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def scans(text):
    return [set(re.findall(r"(\w+):", schema)) for schema in re.findall(r"ReadSchema: struct<(.*)>", text)]


def count(text, node):
    return len(re.findall(rf"[-+:] ?{node}", text))


COMPARE = ["o_totalprice", "o_orderpriority"]
USED = {"o_orderkey", *COMPARE}


@pytest.mark.parametrize("action", ["report", "summary", "mismatches"])
def test_inline_check_needs_one_shuffle_per_side(orders, action):
    text = plan(getattr(reconcile(orders, orders, "o_orderkey", COMPARE), action)())
    assert count(text, "Exchange hashpartitioning") == 2
    # each side is sorted for its grouping before and after the shuffle, the join adds no sort
    assert count(text, "Sort ") == 4
    assert count(text, "SortMergeJoin") == 1
    assert scans(text) == [USED, USED]
    assert "BroadcastExchange" not in text and "Python" not in text and "Cartesian" not in text


def test_keys_first_check_reads_only_keys_twice(orders):
    text = plan(reconcile(orders, orders, "o_orderkey", COMPARE, unique_check="keys_first").report())
    assert "partial_first" not in text and "Python" not in text and "Cartesian" not in text
    assert count(text, "SortMergeJoin") == 1
    assert scans(text).count(USED) == 2
    assert all(columns in (USED, {"o_orderkey"}) for columns in scans(text))


@pytest.mark.parametrize("action", ["missing", "extra"])
def test_one_sided_keys_read_keys_only_and_hash(orders, action):
    text = plan(getattr(reconcile(orders, orders, "o_orderkey"), action)())
    assert scans(text) == [{"o_orderkey"}, {"o_orderkey"}]
    assert "SortAggregate" not in text
    assert count(text, "HashAggregate") == 4


def test_duplicate_keys_fold_before_the_shuffle(orders):
    text = plan(duplicate_keys(orders, ["o_custkey"]))
    assert "partial_count(1)" in text
    assert scans(text) == [{"o_custkey"}]


@pytest.mark.parametrize("check", ["inline", "keys_first"])
def test_where_reaches_the_target_scan_only(orders, check):
    result = reconcile(orders, orders, "o_orderkey", COMPARE, "o_orderstatus = 'F'", unique_check=check)
    pushed = re.findall(r"PushedFilters: \[(.*?)\], ReadSchema", plan(result.report()))
    filtered = [filters for filters in pushed if "EqualTo(o_orderstatus,F)" in filters]
    assert len(filtered) == len(pushed) / 2


@pytest.mark.parametrize("check", ["inline", "keys_first"])
def test_cells_travel_in_their_own_types(orders, check):
    text = plan(reconcile(orders, orders, "o_orderkey", COMPARE, unique_check=check).report())
    before_join = text.split("SortMergeJoin")[1]
    assert "o_totalprice" in before_join
    assert not re.search(r"cast\((s_0|o_totalprice)", before_join)


def test_only_possible_differences_are_printed(orders):
    """The exact texts stay out of the compiled filter above the join."""
    text = plan(reconcile(orders, orders, "o_orderkey", COMPARE).report())
    test = next(line for line in text.splitlines() if "Filter" in line and "<=>" in line)
    assert "regexp_replace" not in test and "trim" not in test
