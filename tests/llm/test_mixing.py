from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from evenkeel.llm.common import documents
from evenkeel.llm.mixing import MOST_LEAVES, WEIGHTS, document_levels, fill, leaf_budgets, mix

DATA = "/root/testdata"
SCHEMA = "doc_id long, text string, lang string, source string, tokens long, _upto string"


def test_fill_gives_what_is_short_to_the_others():
    assert fill(100, [(1, 1000), (1, 1000)]) == [50, 50]
    assert fill(100, [(1, 10), (1, 1000), (2, 1000)]) == [10, 30, 60]
    assert fill(100, [(1, 10), (1, 20), (0, 1000)]) == [10, 20, 0]
    assert fill(0, [(1, 1)]) == [0] and fill(5, []) == []


def test_siblings_come_before_the_parents_siblings():
    tokens = {("a", "x"): 10, ("a", "y"): 90, ("b", "x"): 500, ("b", "y"): 500}
    budgets = leaf_budgets(tokens, {}, 160, 1)
    assert budgets == {("a", "x"): 10, ("a", "y"): 70, ("b", "x"): 40, ("b", "y"): 40}
    budgets = leaf_budgets(tokens, {}, 400, 1)
    assert budgets == {("a", "x"): 10, ("a", "y"): 90, ("b", "x"): 150, ("b", "y"): 150}
    budgets = leaf_budgets(tokens, {("b", "y"): 0.0}, 10_000, 2)
    assert budgets == {("a", "x"): 20, ("a", "y"): 180, ("b", "x"): 1000, ("b", "y"): 0}


def brute(rows, places, names, weights, budget, epochs, seed_order):
    """Copies of each row index by sorting each leaf."""
    tokens, of = defaultdict(int), defaultdict(list)
    for i, (path, n) in enumerate(rows):
        tokens[path] += n
        of[path].append(i)
    wanted = budget * sum(tokens.values()) if budget <= 1 else budget
    copies = [0] * len(rows)
    for path, share in leaf_budgets(dict(tokens), weights, wanted, epochs).items():
        share = int(share + 1e-6)
        whole = min(epochs, share // tokens[path]) if tokens[path] else 0
        rest = share - whole * tokens[path] if whole < epochs else 0
        order = defaultdict(list)
        for i in of[path]:
            copies[i] += whole
            order[seed_order(i, whole) % (1 << 64)].append(i)
        used = 0
        for place in sorted(order) if rest > 0 else []:
            used += sum(rows[i][1] for i in order[place])
            if used > rest:
                break
            for i in order[place]:
                copies[i] += 1
    return copies


@pytest.mark.parametrize(("budget", "epochs", "seed"), [(0.5, 1, 3), (0.9, 2, 4), (5000, 3, 5), (10**9, 2, 6), (1, 1, 0)])
def test_same_as_brute_force(spark, budget, epochs, seed):
    rows = [(i, "w " * (i * 7 % 40), [None, "en", "de"][i % 3], f"src{i * i % 7}" if i % 11 else None, 1, "x") for i in range(300)]
    rows += [(1000 + i, "hot text of a leaf", "en", "src0", 1, "x") for i in range(200)]
    rows += [(2000, "twice the same", "en", "src1", 1, "x")] * 2 + [(None, None, "fr", "src1", 1, "x"), (3000, "long " * 100_000, "es", "src2", 1, "")]
    docs = spark.createDataFrame([(*r, k) for k, r in enumerate(rows)], SCHEMA + ", k int").repartition(5)
    marked = docs.withColumns({f"p{e}": F.xxhash64(F.xxhash64("doc_id", F.coalesce("text", F.lit(""))), F.lit(e + seed)) for e in range(epochs + 1)})
    levels = document_levels()
    marked = marked.withColumn("domain", levels["domain"]).orderBy("k").collect()
    leaves = [((r.domain, r.lang, r.source), len((r.text or "").split())) for r in marked]
    expected = brute(leaves, None, None, WEIGHTS, budget, epochs, lambda i, e: marked[i][f"p{e}"])
    taken = mix(docs, levels, WEIGHTS, budget, epochs, seed)
    assert taken.columns[: len(docs.columns)] == docs.columns
    got = Counter(r.k for r in taken.collect())
    assert [got[k] for k in range(len(rows))] == expected


def test_empty_table_and_bound(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert mix(docs, document_levels(), WEIGHTS, 0.5).count() == 0
    assert MOST_LEAVES == 100_000


def test_shares_of_the_sample_tables(spark):
    docs = documents(spark, f"{DATA}/sf0.01")
    taken = mix(docs, document_levels(), WEIGHTS, budget=0.3, epochs=2, seed=1)
    by = {r._mix_domain: r.n for r in taken.groupBy("_mix_domain").agg(F.sum("_mix_tokens").alias("n")).collect()}
    total = sum(by.values())
    for i, share in enumerate((0.4, 0.3, 0.2, 0.1)):
        assert abs(by[f"domain{i}"] / total - share) < 0.1
