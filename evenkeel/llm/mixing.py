"""Mixing of sources to target weights by hierarchical budgeting.

The texts form a tree: domain, language, source (any levels will do). A budget of tokens
comes in at the root and runs down by the weights of the nodes. A node can take the tokens
below it as often as the epochs allow; what its share exceeds goes to its siblings by
their weights, and only what the whole family cannot take goes to the parent's siblings.

A leaf takes its budget from its texts in a seeded order, a new one for each epoch: whole
epochs, then the longest prefix of the next that fits. The end of the prefix is found in
two steps, by sums over slices of the order, then row by row in the one slice where it
lies, so that no task holds a leaf.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from evenkeel.functions.names import quoted
from evenkeel.llm.common import WORD, stored

MOST_LEAVES = 100_000  # leaves on the driver and broadcast
SLICE_BITS = 14

Path = tuple[str | None, ...]


@dataclass
class Node:
    weight: float = 1.0
    tokens: int = 0
    children: dict[str | None, Node] = field(default_factory=dict)

    def capacity(self, epochs: float) -> float:
        return self.tokens * epochs


def fill(budget: float, wants: list[tuple[float, float]]) -> list[float]:
    """Shares of ``budget`` by (weight, capacity); what one cannot take goes to the others by weight."""
    out = [0.0] * len(wants)
    open_ = [i for i, (weight, capacity) in enumerate(wants) if weight > 0 and capacity > 0]
    while open_ and budget > 0:
        total = sum(wants[i][0] for i in open_)
        full = [i for i in open_ if wants[i][1] <= budget * wants[i][0] / total]
        if not full:
            for i in open_:
                out[i] = budget * wants[i][0] / total
            break
        for i in full:
            out[i] = wants[i][1]
        budget -= sum(out[i] for i in full)
        open_ = [i for i in open_ if i not in full]
    return out


def leaf_budgets(tokens: dict[Path, int], weights: dict[Path, float], budget: float, epochs: int) -> dict[Path, float]:
    """Tokens that each leaf gives. ``weights``: of nodes among their siblings, by path; 1 if not named.

    A node of weight 0 and all below it give nothing, whatever is short elsewhere.
    """
    root = Node()
    for path, n in tokens.items():
        node = root
        node.tokens += n
        for depth in range(len(path)):
            own = path[: depth + 1]
            node = node.children.setdefault(path[depth], Node(weights.get(own, 1.0)))
            node.tokens += n
    out: dict[Path, float] = {}

    def usable(node: Node) -> float:
        """Capacity of what has a weight."""
        if not node.children:
            return node.capacity(epochs)
        return sum(usable(child) for child in node.children.values() if child.weight > 0)

    def spend(node: Node, path: Path, share: float) -> None:
        if not node.children:
            out[path] = share
            return
        names = sorted(node.children, key=lambda name: (name is None, name))
        wants = [(node.children[name].weight, usable(node.children[name])) for name in names]
        for name, own in zip(names, fill(share, wants), strict=True):
            spend(node.children[name], (*path, name), own)

    spend(root, (), min(budget, usable(root)))
    return out


def mix(
    docs: DataFrame,
    levels: dict[str, Column],
    weights: dict[Path, float],
    budget: float,
    epochs: int = 1,
    seed: int = 0,
    id_column: str = "doc_id",
    text_column: str = "text",
    marks: bool = True,
) -> DataFrame:
    """Rows of ``docs``, each as often as it is taken, with ``_mix_<level>``, ``_mix_tokens`` and ``_mix_epoch``.

    Without ``marks`` it has the columns of ``docs`` alone, whatever their names; with them
    columns of ``docs`` that have these names are replaced.

    ``budget`` up to 1 is a share of all tokens, above 1 a number of them. Tokens are
    words. NULL texts have none; a text without tokens comes along where its place in the
    order lies within the prefix. A NULL level is a node of its own. Rows of the same id
    and text have one place: all are taken or none. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    names = list(levels)
    text = F.coalesce(F.col(text_column), F.lit(""))
    told = {
        **{f"_mix_{name}": column.cast("string") for name, column in levels.items()},
        "_mix_tokens": F.regexp_count(text, F.lit(WORD)).cast("long"),
        "_mix_place": F.xxhash64(F.col(id_column), text),
    }
    # The row itself is one column, so that no name of its own is in the way.
    row = F.struct(*[docs[quoted(name)] for name in docs.columns]).alias("_mix_row")
    marked = docs.select(row, *[column.alias(name) for name, column in told.items()])
    thin = stored(marked.drop("_mix_row"), "places")
    leaf = [f"_mix_{name}" for name in names]
    totals = thin.groupBy(*leaf).agg(F.sum("_mix_tokens").alias("tokens"))
    rows = totals.limit(MOST_LEAVES + 1).collect()
    if len(rows) > MOST_LEAVES:
        raise ValueError(f"more than {MOST_LEAVES} leaves in the tree of {names}")
    tokens = {tuple(row[c] for c in leaf): row.tokens for row in rows}
    wanted = budget * sum(tokens.values()) if budget <= 1 else budget
    spent = leaf_budgets(tokens, weights, wanted, epochs)
    plan = []
    for path in tokens:
        share = int(spent[path] + 1e-6)
        whole = min(epochs, share // tokens[path]) if tokens[path] else 0
        plan.append((*path, int(whole), share - whole * tokens[path] if whole < epochs else 0))
    schema = ", ".join(f"{c} string" for c in [f"_plan_{name}" for name in names]) + ", _plan_whole int, _plan_rest long"
    # At most MOST_LEAVES short rows.
    planned = F.broadcast(spark.createDataFrame(plan, schema))
    same = lambda df, p: [df[f"_mix_{n}"].eqNullSafe(p[f"_plan_{n}"]) for n in names]

    def placed(df: DataFrame) -> DataFrame:
        order = F.xxhash64("_mix_place", F.col("_plan_whole") + F.lit(seed))
        return df.join(planned, same(df, planned)).withColumn("_mix_order", order)

    some = placed(thin).where("_plan_rest > 0").withColumn("_slice", F.shiftrightunsigned("_mix_order", 64 - SLICE_BITS))
    # Orders compare as unsigned numbers: by slice, then by what follows.
    some = some.withColumn("_within", F.col("_mix_order").bitwiseAND(F.lit((1 << (64 - SLICE_BITS)) - 1)))
    sums = some.groupBy(*leaf, "_slice", "_plan_rest").agg(F.sum("_mix_tokens").alias("n"))
    upto = F.sum("n").over(Window.partitionBy(*leaf).orderBy("_slice"))
    ends = sums.withColumn("upto", upto).where("upto > _plan_rest")
    first = ends.groupBy(*leaf).agg(F.min_by(F.struct("_slice", (F.col("upto") - F.col("n")).alias("before")), "_slice").alias("end"))
    cut = first.select(*[F.col(c).alias(c.replace("_mix_", "_cut_")) for c in leaf], "end._slice", "end.before").withColumnRenamed("_slice", "_cut_slice")
    cut = stored(cut, "cuts")
    # One row for each leaf again.
    cuts = F.broadcast(cut)
    joined = some.join(cuts, [some[c].eqNullSafe(cuts[c.replace("_mix_", "_cut_")]) for c in leaf])
    last = joined.where("_slice = _cut_slice").withColumn(
        "_upto", F.col("before") + F.sum("_mix_tokens").over(Window.partitionBy(*leaf).orderBy("_within"))
    )
    bounds = last.where("_upto <= _plan_rest").groupBy(*leaf).agg(F.max("_within").alias("_cut_within"))
    bounds = stored(bounds.select(*[F.col(c).alias(c.replace("_mix_", "_end_")) for c in leaf], "_cut_within"), "bounds")
    ends = cut.join(bounds, [cut[f"_cut_{n}"].eqNullSafe(bounds[f"_end_{n}"]) for n in names], "left").select(
        *[f"_cut_{n}" for n in names], "_cut_slice", F.coalesce("_cut_within", F.lit(-1)).alias("_cut_within")
    )
    ends = F.broadcast(ends)
    chosen = placed(marked)
    chosen = chosen.join(ends, [chosen[f"_mix_{n}"].eqNullSafe(ends[f"_cut_{n}"]) for n in names], "left")
    slice_ = F.shiftrightunsigned("_mix_order", 64 - SLICE_BITS)
    within = F.col("_mix_order").bitwiseAND(F.lit((1 << (64 - SLICE_BITS)) - 1))
    before = (slice_ < F.col("_cut_slice")) | ((slice_ == F.col("_cut_slice")) & (within <= F.col("_cut_within")))
    # Without an end the prefix is the whole epoch.
    taken = (F.col("_plan_rest") > 0) & F.coalesce(before, F.lit(True))
    copies = F.col("_plan_whole") + taken.cast("int")
    added = [*leaf, "_mix_tokens", "_mix_epoch"] if marks else []
    kept = [F.col("_mix_row")[name].alias(name) for name in docs.columns if name not in added]
    return (
        chosen.withColumn("_mix_copies", copies)
        .where("_mix_copies > 0")
        .withColumn("_mix_epoch", F.explode(F.sequence(F.lit(1), F.col("_mix_copies"))))
        .select(*kept, *added)
    )


def source_domain(source: Column) -> Column:
    """Domain of a source of the sample tables: by its number, modulo 4."""
    number = F.regexp_extract(F.coalesce(source, F.lit("")), r"([0-9]+)$", 1)
    return F.when(number != "", F.concat(F.lit("domain"), (F.substring(number, -9, 9).cast("int") % 4).cast("string")))


# Production weights of the sample tables' tree. Nodes not named weigh 1.
WEIGHTS: dict[Path, float] = {
    ("domain0",): 4.0, ("domain1",): 3.0, ("domain2",): 2.0, ("domain3",): 1.0,
    **{(f"domain{d}", lang): w for d in range(4) for lang, w in (("en", 5.0), ("de", 2.0), ("fr", 2.0), ("es", 1.0))},
    **{("domain0", lang, "src0"): 2.0 for lang in ("en", "de", "fr", "es")},
}


def document_levels() -> dict[str, Column]:
    return {"domain": source_domain(F.col("source")), "lang": F.col("lang"), "source": F.col("source")}
