"""Mixing sources to target weights with a hierarchical budget.

A token budget flows down a tree, by default domain - language - source. Each node shares its
budget among its children by weight, but no child gets more than its subtree holds (its tokens
times ``epochs``). What a full child leaves over goes to its siblings, and only when all of them are
full does the parent itself count as full and leave the rest to its own siblings.

Each leaf then takes its tokens from seeded epochs: whole passes over the leaf, then the prefix of one
more pass, in the order of md5(seed:epoch:id), as far as the cumulative tokens fit.

The core is DataFrame operations only. Children are ordered by capacity / weight, where filling is a
running sum, so one window over the small table of nodes shares a level's budgets. A leaf may
hold any share of the rows: its order is cut into hash slices of about ``SLICE_ROWS`` rows, whole slices
before the cut are taken by a filter, and only the one slice that holds the cut is sorted.

Defined results: a null level counts as the child ``unknown``, null text as empty. A node
without a weight has weight 1; weight 0 gets nothing. Empty texts have 0 tokens and ride
along wherever the order reaches them. Rows that repeat an id each count and are ordered by text. A
null id is ordered as the text ``''``. Shares are rounded down, so a node may leave fewer tokens than
it has children. An empty table gives an empty table. Columns of the input named like an added one
(epoch, n_tokens) are replaced; all others pass through.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newslens.llm.common import or_empty, word_count, written

SLICE_ROWS = 4096
UNKNOWN = "unknown"
ADDED = ("epoch", "n_tokens")

#: Weights of a level by name; children that are not named have weight 1.
Weights = Sequence[Mapping[str, int]]


def _weight(name: Column, weights: Mapping[str, int]) -> Column:
    out = F.lit(1)
    for key, value in weights.items():
        out = F.when(name == key, int(value)).otherwise(out)
    return out.cast("bigint")


def allocate(leaves: DataFrame, levels: Sequence[str], weights: Weights, epochs: int) -> DataFrame:
    """(levels, granted) of the table of leaves, which has the level columns, ``tokens``, ``budget``."""
    d = "decimal(38,0)"
    room = F.col("tokens").cast(d) * epochs
    whole = Window.partitionBy(F.lit(0))  # a row per leaf
    nodes = leaves.select(*levels, room.cast(d).alias("room"), F.col("budget").cast(d).alias("budget"))
    granted = F.least(F.col("budget"), F.sum("room").over(whole).cast(d))
    nodes = nodes.withColumn("granted", granted).drop("budget")
    for depth, level in enumerate(levels):
        path, here = list(levels[:depth]), list(levels[: depth + 1])
        shares = nodes.groupBy(*here).agg(
            F.sum("room").cast("decimal(38,0)").alias("c"), F.first("granted").alias("b")
        )
        weight = _weight(F.col(level), weights[depth])
        shares = shares.withColumn("w", weight.cast("decimal(38,0)"))
        ratio = F.when(F.col("w") > 0, F.col("c").cast("double") / F.col("w").cast("double"))
        over = Window.partitionBy(*path) if path else Window.partitionBy(F.lit(0))
        order = over.orderBy(ratio.asc_nulls_last(), F.col(level))
        upto = order.rowsBetween(Window.unboundedPreceding, -1)
        rest = order.rowsBetween(0, Window.unboundedFollowing)
        shares = shares.withColumns(
            {
                "before": F.coalesce(F.sum("c").over(upto), F.lit(0)).cast(d),
                "open": F.sum("w").over(rest).cast(d),
            }
        )
        # full: its fair part of what the fuller siblings left is at least what it holds
        full = (F.col("w") > 0) & (
            F.col("c").cast("double") * F.col("open").cast("double")
            <= F.col("w").cast("double") * (F.col("b") - F.col("before")).cast("double")
        )
        shares = shares.withColumn("full", F.coalesce(full, F.lit(False)))
        taken = F.coalesce(F.sum(F.when(F.col("full"), F.col("c"))).over(over), F.lit(0)).cast(d)
        still = F.sum(F.when(~F.col("full"), F.col("w"))).over(over).cast(d)
        part = F.floor((F.col("b") - taken).cast("double") * F.col("w").cast("double") / F.nullif(still, F.lit(0).cast(d)).cast("double"))
        granted = F.when(F.col("full"), F.col("c")).otherwise(
            F.least(F.col("c"), F.coalesce(part, F.lit(0)).cast(d))
        )
        shares = shares.select(*here, granted.cast(d).alias("granted"))
        nodes = nodes.drop("granted").join(shares, here)
    return nodes.select(*levels, F.col("granted").cast("bigint").alias("granted"))


def mix(
    docs: DataFrame,
    levels: Mapping[str, str],
    weights: Weights,
    budget_percent: int = 60,
    epochs: int = 3,
    seed: int = 17,
    tokens: Column | None = None,
    id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """The chosen rows, once per epoch that chose them, with ``epoch`` (from 0) and ``n_tokens``.

    ``levels`` gives the tree from the top as named SQL expressions; the budget is
    ``budget_percent`` of all tokens.
    """
    length = word_count(or_empty(text)) if tokens is None else F.coalesce(tokens.cast("bigint"), F.lit(0))
    kept = [c for c in docs.columns if c.lower() not in ADDED]
    own = [f"level{k}" for k in range(len(levels))]
    paths = [F.coalesce(F.expr(e).cast("string"), F.lit(UNKNOWN)).alias(n) for n, e in zip(own, levels.values())]
    rows = docs.select(F.struct(*kept).alias("doc"), *paths, length.alias("tokens"))

    leaves = written(
        rows.groupBy(*own).agg(F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("rows")), "leaves"
    )
    whole = F.sum("tokens").over(Window.partitionBy(F.lit(0)))  # a row per leaf
    budgets = leaves.withColumn("budget", F.floor(whole * int(budget_percent) / 100))
    digits = F.ceil(F.log(16.0, F.greatest(F.col("rows") / SLICE_ROWS, F.lit(1.0)))).cast("int")
    passes = F.coalesce(F.expr("granted div nullif(tokens, 0)"), F.lit(0))
    plan = leaves.join(allocate(budgets, own, weights, epochs), own).withColumn("passes", passes.cast("int"))
    left = F.col("granted") - F.col("passes") * F.col("tokens")
    plan = plan.select(
        *own, "passes", digits.alias("digits"), left.alias("left"),
        ((left > 0) | (F.col("tokens") == 0)).alias("opened"),
    )
    plan = written(plan, "plan")  # small and of known size, so joins with it need no shuffle

    name = F.coalesce(F.col(f"doc.{id}").cast("string"), F.lit(""))
    key = F.md5(F.concat_ws(":", F.lit(str(seed)), "passes", name).cast("binary"))
    placed = rows.join(plan, own).withColumn("key", key)
    placed = placed.withColumn("slice", F.substring("key", F.lit(1), F.col("digits")))
    sums = placed.groupBy(*own, "slice", "left").agg(F.sum("tokens").alias("n"))
    sums = sums.withColumn("upto", F.sum("n").over(Window.partitionBy(*own).orderBy("slice")))
    # the first slice that does not fit whole holds the cut; all before it are taken
    first = F.min(F.struct("slice", (F.col("upto") - F.col("n")).alias("before"))).alias("at")
    cuts = sums.filter(F.col("upto") > F.col("left")).groupBy(*own).agg(first)
    cuts = written(cuts.select(*own, F.col("at.slice").alias("cut"), "at.before"), "cuts")
    placed = placed.join(cuts, own, "left")
    at = F.coalesce(F.col("slice") == F.col("cut"), F.lit(False))
    clear = F.col("cut").isNull() | (F.col("slice") < F.col("cut"))
    inside = Window.partitionBy(*own).orderBy("key", f"doc.{id}", f"doc.{text}")
    upto = F.col("before") + F.sum("tokens").over(inside.rowsBetween(Window.unboundedPreceding, 0))
    taken = (
        placed.filter(~at).withColumn("extra", clear)
        .unionByName(placed.filter(at).withColumn("extra", upto <= F.col("left")))
        .withColumn("extra", (F.col("extra") & F.col("opened")).cast("int"))
        .withColumn("copies", F.least(F.col("passes") + F.col("extra"), F.lit(int(epochs))))
    )
    return (
        taken.filter("copies > 0")
        .withColumn("epoch", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)))
        .select("doc.*", "epoch", F.col("tokens").alias("n_tokens"))
    )
