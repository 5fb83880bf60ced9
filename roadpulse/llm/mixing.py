"""Mixing sources to target weights: hierarchical budgets and a token prefix of seeded epochs for each leaf."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, words_of

#: Levels of the tree from the root on, as SQL over the columns of documents. Null names a branch of its own.
TREE = {
    "domain": r"concat('domain', coalesce(try_cast(regexp_extract(source, '([0-9]+)$', 1) AS int) % 4, -1))",
    "language": "coalesce(lang, '?')",
    "origin": "coalesce(source, '?')",
}
#: Relative weights among siblings by level and name; 1 for names that aren't listed.
WEIGHTS = {"domain": {"domain0": 4, "domain1": 3, "domain2": 2, "domain3": 2}, "language": {"en": 4, "de": 2, "fr": 2, "es": 2}}
MAX_EPOCHS = 3
BUDGET_SHARE = 0.6
SEED = 7

_P = "__rp_m_"
SALTS = 64
_SLICES = 4  # hexadecimal digits by which a leaf's order is cut into slices


def token_count(text: Column) -> Column:
    return F.size(words_of(text)).cast("long")


def _weight(level: str, weights: dict[str, dict[str, int]]) -> Column:
    out = None
    for name, w in weights.get(level, {}).items():
        hit = F.col(_P + level) == name
        out = F.when(hit, w) if out is None else out.when(hit, w)
    return F.lit(1).cast("long") if out is None else out.otherwise(1).cast("long")


def _share_out(nodes: DataFrame, parents: list[str], level: str) -> DataFrame:
    """Split each parent's ``budget`` among its children by ``weight``, none above its ``supply``.

    What a child can't use goes to its siblings in proportion to their weights; only what no sibling can
    use is missing from the parent, whose supply is that of its children, so the level above has
    already given it to the parent's own siblings. Children are taken by rising supply per weight:
    those that run short come first, so running sums decide. All sums are exact; each share is
    rounded down.
    """
    big = lambda c: F.col(c).cast("decimal(19,0)")
    family = Window.partitionBy(*parents) if parents else Window.partitionBy(F.lit(0))
    rising = family.orderBy(F.col("supply") / F.col("weight"), _P + level)
    nodes = nodes.withColumns({
        "given": F.coalesce(F.sum("supply").over(rising.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
        "rest": F.sum("weight").over(rising.rowsBetween(0, Window.unboundedFollowing)),
    })
    nodes = nodes.withColumn("short", big("supply") * big("rest") <= (F.col("budget") - F.col("given")).cast("decimal(19,0)") * big("weight"))
    nodes = nodes.withColumns({
        "given": F.coalesce(F.sum(F.when(F.col("short"), F.col("supply"))).over(family), F.lit(0)),
        "rest": F.sum(F.when(~F.col("short"), F.col("weight"))).over(family),
        "left": F.col("budget"),
    })
    nodes = nodes.withColumn("left", (F.col("left") - F.col("given")).cast("decimal(19,0)")).withColumns({"wide_rest": big("rest"), "wide": big("weight")})
    share = F.when(F.col("short"), F.col("supply")).otherwise(F.expr("wide * left div wide_rest"))
    return nodes.select(*parents, _P + level, share.alias("budget"))


def leaf_budgets(sizes: DataFrame, levels: list[str], weights: dict[str, dict[str, int]], budget_share: float, max_epochs: int) -> DataFrame:
    """``sizes`` (level columns and ``tokens`` by leaf) with each leaf's ``budget`` in tokens."""
    cols = [_P + x for x in levels]
    supply = sizes.withColumn("supply", F.col("tokens") * max_epochs)
    budgets = sizes.agg(F.floor(F.coalesce(F.sum("tokens"), F.lit(0)) * F.lit(budget_share)).cast("long").alias("budget"))
    for i, level in enumerate(levels):
        nodes = supply.groupBy(*cols[: i + 1]).agg(F.sum("supply").alias("supply")).withColumn("weight", _weight(level, weights))
        nodes = nodes.join(budgets, cols[:i]) if i else nodes.join(F.broadcast(budgets), how="cross")  # one row
        budgets = _share_out(nodes, cols[:i], level)
    return sizes.join(budgets, cols)


def _beside(rows: DataFrame, leaves: DataFrame, cols: list[str]) -> DataFrame:
    """``rows`` with the columns of their leaf. Leaves are there once for each salt, so that a hot leaf's rows go to many tasks."""
    salted = leaves.withColumn(_P + "salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salt = F.pmod(F.xxhash64(_P + "id"), F.lit(SALTS)).cast("int")
    return rows.withColumn(_P + "salt", salt).join(salted, [*cols, _P + "salt"]).drop(_P + "salt")


def mix_sources(
    docs: DataFrame, tree: dict[str, str] = TREE, weights: dict[str, dict[str, int]] = WEIGHTS, budget_share: float = BUDGET_SHARE,
    max_epochs: int = MAX_EPOCHS, seed: int = SEED, id_col: str = "doc_id", text_col: str = "text", epoch_col: str = "epoch",
) -> DataFrame:
    """The rows of ``docs`` with ``epoch_col``: once for each epoch in which the row is taken.

    The budget is ``budget_share`` of all tokens (words). A leaf with a budget of n full epochs and a
    rest gives all its rows n times, and of the next epoch those rows whose tokens, in the order of
    md5(seed, epoch, id), add up to no more than the rest; rows with the same id and leaf stand or fall
    together. Null and empty texts have no tokens: they come along for free where the order
    reaches them. An empty table gives an empty one; an input column named like ``epoch_col`` is
    replaced, and the others keep their names. A text of any length counts with all its words.
    """
    levels, names = list(tree), [c for c in docs.columns if c != epoch_col]
    cols = [_P + x for x in levels]
    own = [F.col(f"`{c}`") for c in names]
    docs = docs.select(*own, *[F.expr(e).alias(_P + x) for x, e in tree.items()])
    small = docs.select(*cols, F.col(id_col).alias(_P + "id"), token_count(F.col(text_col)).alias("tokens"))
    rows = materialize(small.groupBy(*cols, _P + "id").agg(F.sum("tokens").alias("tokens")))
    leaves = leaf_budgets(rows.groupBy(*cols).agg(F.sum("tokens").alias("tokens")), levels, weights, budget_share, max_epochs)
    leaves = materialize(leaves.select(
        *cols,
        F.when(F.col("tokens") > 0, F.expr("budget div tokens")).otherwise(1).alias(_P + "full"),
        F.when(F.col("tokens") > 0, F.expr("budget % tokens")).otherwise(0).cast("long").alias(_P + "rest"),
    ))
    # The place of a row in the next epoch. A hot leaf is cut into slices of its order: sums by slice,
    # then running sums within the slice that the budget ends in.
    key = F.md5(F.concat_ws("|", F.lit(str(seed)), F.col(_P + "full").cast("string"), F.coalesce(F.col(_P + "id").cast("string"), F.lit("?"))))
    placed = _beside(rows, leaves.filter(F.col(_P + "rest") > 0), cols).withColumn("key", key).withColumn("slice", F.substring("key", 1, _SLICES))
    slices = placed.groupBy(*cols, "slice").agg(F.sum("tokens").alias("n"))
    running = Window.partitionBy(*cols).orderBy("slice")
    slices = slices.withColumn("until", F.sum("n").over(running.rowsBetween(Window.unboundedPreceding, 0)))
    last = slices.join(leaves, cols).filter(F.col("until") > F.col(_P + "rest")).groupBy(*cols).agg(F.min(F.struct("slice", (F.col("until") - F.col("n")).alias("before"))).alias("last"))
    inside = placed.join(last.select(*cols, F.col("last.slice").alias("slice"), F.col("last.before").alias("before")), [*cols, "slice"])
    inside = inside.withColumn("until", F.col("before") + F.sum("tokens").over(Window.partitionBy(*cols, "slice").orderBy("key").rangeBetween(Window.unboundedPreceding, 0)))
    first_out = inside.filter(F.col("until") > F.col(_P + "rest")).groupBy(*cols).agg(F.min("key").alias(_P + "end"))
    ends = materialize(leaves.join(first_out, cols, "left"))
    full, rest = F.col(_P + "full"), F.col(_P + "rest")
    docs = _beside(docs.withColumn(_P + "id", F.col(id_col)), ends, cols).withColumn(_P + "key", key)
    taken = F.when((rest > 0) & (F.col(_P + "key") < F.coalesce(F.col(_P + "end"), F.lit("g"))), full + 1).otherwise(full)
    epochs = F.when(taken > 0, F.sequence(F.lit(0).cast("long"), (taken - 1).cast("long"))).otherwise(F.array().cast("array<bigint>"))
    return docs.select(*own, F.explode(epochs).alias(epoch_col))
