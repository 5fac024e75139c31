"""Mixing sources to target weights over a tree, in built-in functions only.

A token budget is propagated from the root through the levels of a tree.  At every node
the children get their weighted share, but no more than their subtree can give; what a
child lacks goes to its siblings by weight.  A node never gets more than its own subtree
holds, so a shortage leaves a family only when all of its members are used up.

Each leaf reads its documents in seeded epochs: whole epochs while the budget lasts, and
then the longest prefix of the next epoch's order that fits the rest.  The prefix is found
without ordering a leaf in one task: order keys are cut into buckets of a few thousand
rows, bucket sums are accumulated, and only the bucket at the edge is ordered.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugeframe.storage import cut_lineage

WORD = r"[^\x20\x09-\x0D]+"
BUCKET_ROWS = 4096
KEY_BITS = 60
BROADCAST_LEAVES = 200_000


def token_count(text: Column) -> Column:
    """Words of a text; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def order_key(identity: Column, epoch: Column, seed: int) -> Column:
    """60 bits that order the documents of one epoch; the same in every run."""
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), identity).cast("binary"))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def mix_sources(
    documents: DataFrame,
    levels: Mapping[str, Column],
    weights: Mapping[str, Mapping[str, int]],
    budget_share: tuple[int, int],
    max_epochs: int = 2,
    seed: int = 0,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """The selected rows, one per epoch in which a document is taken.

    ``levels`` names the levels from the root to the leaves and gives the label of a row at
    each; a null label is ``unknown``.  ``weights`` has whole weights by level and label, 1
    where none is given, 0 to leave a subtree out.  The budget is ``budget_share`` (a
    fraction) of all tokens of ``documents``.  All columns are kept; added are one column
    ``mix_<level>`` per level, ``mix_tokens`` and ``mix_epoch``.

    Rows with the same id and text are taken together.  Null and empty texts have no tokens;
    they are taken with the epochs they lie in.  A leaf without tokens gets no budget.
    Columns that have one of the new names already are replaced.
    """
    labels = {f"mix_{name}": F.coalesce(label.cast("string"), F.lit("unknown")) for name, label in levels.items()}
    names = list(labels)
    added = [*names, "mix_tokens", "mix_epoch"]
    text = documents[text_column]
    # The leading letter tells a null text from an empty one.
    body = F.coalesce(F.concat(F.lit("t"), F.md5(text.cast("binary"))), F.lit("n"))
    identity = F.concat_ws(":", F.coalesce(documents[id_column].cast("string"), F.lit("")), body)
    own = [documents[f"`{c}`"] for c in documents.columns if c.lower() not in added]
    marked = documents.select(
        F.struct(*own).alias("row"),
        *[label.alias(name) for name, label in labels.items()],
        token_count(text).alias("mix_tokens"),
        identity.alias("identity"),
    )
    rows = cut_lineage(marked.select(*names, "mix_tokens", "identity"))

    leaves = rows.groupBy(names).agg(F.sum("mix_tokens").alias("tokens"), F.count("*").alias("n_rows"))
    leaves = cut_lineage(leaves)
    plan = _leaf_plan(leaves, names, weights, budget_share, max_epochs)
    cuts = _cuts(rows, plan, names, seed)
    taken = marked.join(cuts, names)
    key = order_key(F.col("identity"), F.col("whole") + 1, seed)
    whole = F.when(F.col("whole") > 0, F.sequence(F.lit(1).cast("long"), "whole")).otherwise(
        F.array().cast("array<bigint>")
    )
    part = F.when(key <= F.col("cut"), F.array(F.col("whole") + 1)).otherwise(F.array().cast("array<bigint>"))
    epochs = F.explode(F.concat(whole, part)).alias("mix_epoch")
    return taken.select("row", *names, "mix_tokens", epochs).select("row.*", *added)


def _leaf_plan(
    leaves: DataFrame,
    names: Sequence[str],
    weights: Mapping[str, Mapping[str, int]],
    budget_share: tuple[int, int],
    max_epochs: int,
) -> DataFrame:
    """Whole epochs and the rest of the budget of every leaf."""
    capacity = (F.col("tokens") * max_epochs).alias("capacity")
    usable = reduce_and([_weight(n, weights) > 0 for n in names])
    tree = leaves.filter(usable & (F.col("tokens") > 0)).select(*names, "tokens", "n_rows", capacity)
    share = F.expr(f"sum(tokens) * {int(budget_share[0])} div {int(budget_share[1])}")
    budgets = leaves.agg(share.alias("budget"))
    parents: list[str] = []
    for depth, name in enumerate(names):
        level = names[: depth + 1]
        children = tree.groupBy(*level).agg(F.sum("capacity").alias("capacity"))
        children = children.withColumn("weight", _weight(name, weights))
        if parents:
            family = children.join(budgets, parents)
        else:
            family = children.withColumn("budget", F.lit(budgets.first()["budget"]).cast("long"))
        budgets = share_out(family, parents, name).select(*level, "budget")
        parents = level
    planned = tree.join(budgets, list(names))
    whole = F.expr("least(budget div tokens, %d)" % max_epochs)
    planned = planned.withColumn("whole", whole)
    return planned.withColumn("rest", F.col("budget") - F.col("whole") * F.col("tokens"))


def reduce_and(tests: Sequence[Column]) -> Column:
    total = F.lit(True)
    for test in tests:
        total = total & test
    return total


def _weight(name: str, weights: Mapping[str, Mapping[str, int]]) -> Column:
    given = weights.get(name.removeprefix("mix_"), {})
    weight = F.lit(1)
    for label, value in given.items():
        weight = F.when(F.col(name) == label, F.lit(int(value))).otherwise(weight)
    return weight.cast("long")


def share_out(family: DataFrame, parents: Sequence[str], name: str) -> DataFrame:
    """Replace ``budget`` of the family by each child's part; nobody gets more than its capacity.

    Children are ordered by how soon they are used up.  The first that can take its share of
    what is left fixes the level for itself and all after it; those before it give all.
    Needs columns ``budget``, ``capacity`` and ``weight``; whole numbers, rounded down.
    """
    group = [F.col(p) for p in parents] or [F.lit(0)]
    soon = (F.col("capacity") / F.col("weight"), F.col(name))
    ordered = Window.partitionBy(*group).orderBy(*soon)
    before = ordered.rowsBetween(Window.unboundedPreceding, -1)
    after = ordered.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    wide = "decimal(38,0)"
    left = F.col("budget") - F.coalesce(F.sum("capacity").over(before), F.lit(0))
    state = family.withColumn("left", left).withColumn("load", F.sum("weight").over(after))
    takes = F.col("left").cast(wide) * F.col("weight") <= F.col("capacity").cast(wide) * F.col("load")
    level = F.when(takes, F.struct(F.row_number().over(ordered).alias("place"), "left", "load"))
    state = state.withColumn("level", level)
    state = state.withColumn("first", F.min("level").over(Window.partitionBy(*group)))
    state = state.withColumn("place", F.row_number().over(ordered))
    free = F.col("first").isNotNull() & (F.col("place") >= F.col("first.place"))
    part = F.expr("cast(greatest(first.left, 0) as decimal(38,0)) * weight div first.load").cast("long")
    budget = F.least(F.when(free, part).otherwise(F.col("capacity")), F.col("capacity"))
    return state.withColumn("budget", budget).drop("left", "load", "level", "first", "place")


def _cuts(rows: DataFrame, plan: DataFrame, names: Sequence[str], seed: int) -> DataFrame:
    """Per leaf: whole epochs, and the last order key that the next epoch's prefix holds (-1: none)."""
    bits = F.greatest(F.lit(0), F.ceil(F.log2(F.col("n_rows") / BUCKET_ROWS))).cast("int")
    plan = cut_lineage(plan.select(*names, "whole", "rest", bits.alias("bits")))
    few = plan.limit(BROADCAST_LEAVES + 1).count() <= BROADCAST_LEAVES

    def small(df: DataFrame) -> DataFrame:
        return F.broadcast(df) if few else df

    partial = rows.join(small(plan.filter(F.col("rest") > 0)), list(names))
    partial = partial.withColumn("key", order_key(F.col("identity"), F.col("whole") + 1, seed))
    partial = partial.withColumn("bucket", F.expr(f"shiftright(key, {KEY_BITS} - bits)"))
    sums = partial.groupBy(*names, "bucket", "rest").agg(F.sum("mix_tokens").alias("held"))
    running = Window.partitionBy(*names).orderBy("bucket")
    summed = sums.withColumn("through", F.sum("held").over(running.rowsBetween(Window.unboundedPreceding, 0)))
    # The first bucket that does not fit; a leaf whose buckets all fit has a whole epoch instead.
    edge = summed.filter(F.col("through") > F.col("rest")).groupBy(*names).agg(
        F.min(F.struct("bucket", (F.col("rest") - F.col("through") + F.col("held")).alias("room"))).alias("edge")
    )
    edge = cut_lineage(edge.select(*names, "edge.bucket", "edge.room"))
    inner = partial.select(*names, "bucket", "key", "mix_tokens").join(small(edge), [*names, "bucket"])
    peers = Window.partitionBy(*names).orderBy("key").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    fitting = inner.withColumn("through", F.sum("mix_tokens").over(peers)).filter(F.col("through") <= F.col("room"))
    last = fitting.groupBy(*names).agg(F.max("key").alias("last"))
    # Below the edge everything is taken; in it, what fits.
    floor = F.expr(f"shiftleft(bucket, {KEY_BITS} - bits) - 1")
    cut = F.coalesce("last", floor, F.lit(-1).cast("long"))
    joined = plan.join(edge, list(names), "left").join(last, list(names), "left")
    return small(cut_lineage(joined.select(*names, "whole", cut.alias("cut"))))
