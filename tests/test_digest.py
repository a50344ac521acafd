"""Digest reconciliation: the same result, and few rows that move."""

import json
import random
import subprocess
import sys

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from conftest import DATA, REPO
from evenkeel.operators import DuplicateKeyError
from evenkeel.plans import reconcile, reconcile_by_digest
from test_reconcile import CELLS, KEYS, as_dicts, lines, table
from model import expected


@pytest.mark.parametrize("nodes", [1, 7, None])
@pytest.mark.parametrize("seed", range(2))
def test_random_tables_equal_the_model(spark, seed, nodes):
    rng = random.Random(seed)

    def rows(of=None):
        if of:
            return [row if rng.random() < 0.8 else (*row[:2], rng.choice(CELLS), rng.choice(CELLS)) for row in of if rng.random() < 0.9]
        seen, out = set(), []
        for _ in range(40):
            key = (rng.choice(KEYS), rng.choice(KEYS))
            if tuple((part or "").strip() for part in key) not in seen:
                seen.add(tuple((part or "").strip() for part in key))
                out.append((*key, rng.choice(CELLS), rng.choice(CELLS)))
        return out

    schema = "k string, `l.l` string, v string, `w``'` string, node string, leaf int"
    first = rows()
    source = table(spark, [(*r, "clash", 1) for r in first], schema)
    target = table(spark, [(*r, "clash", 1) for r in rows(first)], schema)
    keys, compare = ["k", "l.l"], ["v", "w`'"]
    want_lines, want_summary = expected(as_dicts(source), as_dicts(target), keys, compare)
    result = reconcile_by_digest(source, target, keys, compare, nodes=nodes)
    assert lines(result.report()) == want_lines
    assert tuple(result.summary().first()) == want_summary
    assert lines(result.missing()) == {line[1:3] for line in want_lines if line[0].startswith("MISSING")}
    assert lines(result.extra()) == {line[1:3] for line in want_lines if line[0].startswith("EXTRA")}
    assert lines(result.mismatches()) == {line for line in want_lines if line[0].startswith("VALUE")}


def test_types_zeros_nulls_and_columns(spark):
    source = spark.sql("SELECT id, IF(id % 3 = 0, NULL, id * 1.5D) AS d, CAST(id AS STRING) AS s, DATE'2020-01-01' AS day, -0.0D AS z, 1 AS own FROM range(50)")
    target = spark.sql("SELECT id, IF(id % 3 = 0, NULL, id * 1.5D) AS d, CAST(id AS STRING) AS s, DATE'2020-01-01' AS day, 0.0D AS z FROM range(50)")
    for compare in (["d", "s", "day"], ["d", "z"], None):
        plain, digest = (f(source, target, "id", compare) for f in (reconcile, reconcile_by_digest))
        assert lines(digest.report()) == lines(plain.report())
        assert digest.summary().first() == plain.summary().first()
    # A NULL in one column is not one in the next.
    swapped = reconcile_by_digest(spark.sql("SELECT 1 AS k, 'x' AS a, CAST(NULL AS STRING) AS b"), spark.sql("SELECT 1 AS k, CAST(NULL AS STRING) AS a, 'x' AS b"), "k")
    assert swapped.mismatches().count() == 2
    # Other types on the two sides are compared by their texts.
    typed = spark.sql("SELECT id, id * 1.5D AS d FROM range(50)")
    texts = spark.sql("SELECT CAST(id AS STRING) AS id, CAST(id * 1.5D AS STRING) AS d FROM range(50)")
    same = reconcile_by_digest(typed, texts, "id")
    assert same.report().count() == 0 and same.opened == (0, 0) and same.rows == (50, 50)
    empty = reconcile_by_digest(typed.limit(0), typed.limit(0), "id")
    assert empty.report().count() == 0 and tuple(empty.summary().first()) == (0, 0, 0, 0, 0)


def test_repeated_keys_are_found_even_where_sides_agree(spark):
    rows = spark.range(2000).selectExpr("id AS k", "id % 7 AS v")
    twice = rows.unionAll(rows.where("k = 1234"))
    both = reconcile_by_digest(twice, twice, "k")
    with pytest.raises(PySparkException, match=r"A key repeats in (source|target): \(1234\)"):
        both.report().collect()
    with pytest.raises(PySparkException, match="1234"):
        reconcile_by_digest(rows, twice, "k").report().collect()
    hot = rows.unionAll(spark.range(1000).selectExpr("CAST(7 AS BIGINT) AS k", "CAST(0 AS BIGINT) AS v"))
    with pytest.raises(PySparkException, match=r"\(7\)"):
        reconcile_by_digest(hot, hot, "k").summary().collect()


MEASURED = """
import json, pathlib, sys
sys.path[:0] = [{repo!r}, {tests!r}]
from pyspark.sql import SparkSession
conf = {{"spark.master": "local[2]", "spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "4", "spark.checkpoint.dir": {work!r} + "/shared",
        "spark.eventLog.enabled": "true", "spark.eventLog.dir": "file://" + {work!r} + "/events", "spark.eventLog.rolling.enabled": "false", "spark.eventLog.compress": "false"}}
spark = SparkSession.builder.config(map=conf).getOrCreate()
from evenkeel.plans import reconcile_by_digest
source = spark.range(0, 1000000, 1, 2).selectExpr("id", "id % 1000 AS v", "concat('text of ', id) AS t")
target = source.selectExpr("id", "IF(id IN (5, 700001), -1, v) AS v", "t").where("id <> 999998")
result = reconcile_by_digest(source, target, "id", nodes=1000)
print(json.dumps([sorted(map(list, result.report().collect()), key=str), result.opened, result.rows]))
"""


def test_few_rows_are_shuffled(tmp_path):
    """Less than 5 % of the rows, by Spark's event log, where 0.3 % of the nodes differ."""
    (tmp_path / "events").mkdir()
    code = MEASURED.format(repo=str(REPO), tests=str(REPO / "tests"), work=str(tmp_path))
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=240, check=True)
    found, opened, rows = json.loads(done.stdout.strip().splitlines()[-1])
    assert found == sorted(
        [["VALUE_MISMATCH", "5", "v", "5", "-1"], ["VALUE_MISMATCH", "700001", "v", "1", "-1"], ["MISSING_IN_TARGET", "999998", None, None, None]], key=str
    )
    assert max(opened) < 1000 and rows == [1_000_000, 999_999]
    moved = 0
    for log in (tmp_path / "events").iterdir():
        for line in log.open():
            event = json.loads(line)
            if event["Event"] == "SparkListenerTaskEnd":
                moved += event["Task Metrics"]["Shuffle Write Metrics"]["Shuffle Records Written"]
    assert 0 < moved < 0.05 * 2_000_000


def test_write(spark, tmp_path):
    orders = spark.read.parquet(f"{DATA}/sf0.001/orders.parquet")
    changed = orders.withColumn("o_totalprice", F.when(F.col("o_orderkey") % 100 == 0, 1.0).otherwise(F.col("o_totalprice")))
    plain = reconcile(orders, changed, "o_orderkey").write(str(tmp_path / "a"))
    assert reconcile_by_digest(orders, changed, "o_orderkey").write(str(tmp_path / "b")) == plain
    twice = orders.unionAll(orders.where("o_orderkey = 7"))
    with pytest.raises(DuplicateKeyError, match="7"):
        reconcile_by_digest(twice, twice, "o_orderkey").write(str(tmp_path / "c"))
