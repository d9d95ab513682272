"""Mixing sources to target weights by hierarchical budgets, with built-in functions only."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hitloom.llm.common import fresh, stage
from hitloom.sizing import broadcast_if_small

TOKEN = r"[^ \t\n\x0B\f\r]+"


def n_words(text: Column) -> Column:
    """Words of a text: maximal runs without ASCII white space; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(TOKEN)), F.lit(0)).cast("long")


def _same(a: DataFrame, b: DataFrame, pairs: list[tuple[str, str]]) -> Column:
    return reduce(lambda x, y: x & y, [a[p].eqNullSafe(b[q]) for p, q in pairs])


def budgets(leaves: DataFrame, depth: int, budget: Column, max_epochs: float) -> DataFrame:
    """Tokens for each leaf.

    `leaves` has ``p0`` ... (the path), ``w0`` ... (the weight of the node at each depth) and ``supply``.
    What a node can take is its leaves' supply times `max_epochs`; nodes of weight 0 take nothing.
    From the root down, a node's budget is shared among its children by weight. A child that cannot
    take its share takes what it can, and the rest goes to its siblings in proportion to their weights;
    only what a whole family cannot take has already gone to the family's siblings. With children in
    order of (capacity / weight), the level L that solves sum(min(capacity, L * weight)) = budget is
    the largest value of (budget - capacity before) / (weight from here on).
    """
    path = [f"p{i}" for i in range(depth)]
    tree = leaves.withColumn(f"c{depth - 1}", F.when(F.col(f"w{depth - 1}") > 0, F.col("supply") * F.lit(float(max_epochs))).otherwise(0.0))
    for i in range(depth - 2, -1, -1):
        node = Window.partitionBy(*path[: i + 1])
        tree = tree.withColumn(f"c{i}", F.when(F.col(f"w{i}") > 0, F.sum(f"c{i + 1}").over(node)).otherwise(0.0))
    tree = tree.withColumn("share", budget)
    for i in range(depth):
        parent = path[:i]
        nodes = tree.groupBy(*path[: i + 1]).agg(
            F.max(f"w{i}").alias("w"), F.max(f"c{i}").alias("c"), F.max("share").alias("b")
        ).filter("w > 0 and c > 0")
        order = [F.col("c") / F.col("w"), *[F.col(p) for p in path[: i + 1]]]
        family = Window.partitionBy(*(parent or [F.lit(0)]))
        before = family.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
        until = family.orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        level = (F.col("b") - F.coalesce(F.sum("c").over(before), F.lit(0.0))) / (
            F.sum("w").over(family) - F.sum("w").over(until) + F.col("w")
        )
        nodes = nodes.withColumn("level", level).withColumn("level", F.max("level").over(family))
        # a family that can take no more than its budget takes all
        full = F.sum("c").over(family) <= F.col("b")
        nodes = nodes.withColumn("got", F.when(full, F.col("c")).otherwise(F.least("c", F.col("w") * F.col("level"))))
        nodes = nodes.select(*[F.col(p).alias(f"n{k}") for k, p in enumerate(path[: i + 1])], "got")
        same = _same(tree, nodes, [(p, f"n{k}") for k, p in enumerate(path[: i + 1])])
        tree = tree.join(nodes, same, "left").drop(*[f"n{k}" for k in range(i + 1)], "share")
        tree = tree.withColumn("share", F.coalesce("got", F.lit(0.0))).drop("got")
    # a millionth of a token absorbs the rounding of sums
    return tree.select(*path, "supply", "n", F.floor(F.col("share") + 1e-6).cast("long").alias("take"))


def mix_sources(
    docs: DataFrame,
    levels: list[Column],
    weights: list[Column],
    id_col: str = "doc_id",
    text_col: str = "text",
    share: float = 0.5,
    max_epochs: float = 4.0,
    seed: int = 17,
) -> DataFrame:
    """Choose how often each row is used so that the leaves' tokens follow the target weights.

    `levels` name the tree from the top (say domain, language, source) and `weights` give each row its
    node's weight at each level (a node takes the largest among its rows; null, NaN and negative count
    as 0, which takes nothing). The budget is `share` of all tokens (words). See :func:`budgets`.

    A leaf that takes T of its S tokens uses every row in ``T div S`` epochs, then the prefix of one
    more epoch: rows in the order of md5("seed:epoch:id"), as long as the tokens before are less than
    ``T mod S``. All columns stay; ``copies`` (long, rows with 0 are left out) and ``tokens`` follow,
    with underscores where these names are taken. Nulls are ordinary names of nodes. Rows with equal
    ids (null is one id) in a leaf are chosen together. Rows without words have copies in full epochs
    and in the prefix like others. An empty table gives an empty table.

    Only (leaf, key, tokens) is shuffled. The prefix is found in two steps, sums of about sqrt(n) slices
    of the key and then the keys of the one slice that holds the end, so no task orders a whole leaf;
    the result per leaf is one boundary key, and the texts are never moved.
    """
    depth = len(levels)
    path = [f"p{i}" for i in range(depth)]
    clean = [F.when(w.isNull() | F.isnan(w.cast("double")) | (w < 0), 0.0).otherwise(w.cast("double")) for w in weights]
    rows = stage(
        docs.select(
            *[c.cast("string").alias(p) for c, p in zip(levels, path, strict=True)],
            *[c.alias(f"w{i}") for i, c in enumerate(clean)],
            F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"),
            n_words(F.col(text_col)).alias("tokens"),
        ),
        "mix_rows",
    )
    leaves = rows.groupBy(*path).agg(
        *[F.max(f"w{i}").alias(f"w{i}") for i in range(depth)],
        F.sum("tokens").alias("supply"),
        F.count(F.lit(1)).alias("n"),
    )
    leaves = stage(leaves, "mix_leaves")
    # a node's weight is the largest among all its leaves
    for i in range(depth - 1):
        leaves = leaves.withColumn(f"w{i}", F.max(f"w{i}").over(Window.partitionBy(*path[: i + 1])))
    total = leaves.agg(F.coalesce(F.sum("supply"), F.lit(0))).first()[0]
    plan = budgets(leaves, depth, F.lit(float(share) * total), max_epochs).filter("take > 0")
    names = [f"l{i}" for i in range(depth)]
    plan = stage(
        plan.select(
            *[F.col(p).alias(q) for p, q in zip(path, names, strict=True)],
            F.expr("take div supply").alias("epoch"),
            F.expr("take % supply").alias("rest"),
            F.ceil(F.sqrt("n")).alias("slices"),
        ),
        "mix_plan",
    )
    pairs = list(zip(path, names, strict=True))
    key = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("epoch").cast("string"), F.col("id")))
    keyed = rows.join(broadcast_if_small(plan), _same(rows, plan, pairs)).filter("rest > 0")
    keyed = keyed.select(*names, "rest", "slices", "tokens", key.alias("key"))
    part = F.floor(F.conv(F.substring("key", 1, 13), 16, 10).cast("double") / float(1 << 52) * F.col("slices"))
    keyed = keyed.withColumn("part", part)
    sums = keyed.groupBy(*names, "rest", "part").agg(F.sum("tokens").alias("t"))
    leaf = Window.partitionBy(*names).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    last = (
        sums.withColumn("before", F.coalesce(F.sum("t").over(leaf), F.lit(0)))
        .filter(F.col("before") < F.col("rest"))
        .groupBy(*names)
        .agg(F.max_by(F.struct("part", "before"), "part").alias("end"))
        .select(*[F.col(n).alias(f"e{n}") for n in names], F.col("end.part").alias("end_part"), "end.before")
    )
    same = _same(keyed, last, [(n, f"e{n}") for n in names]) & (keyed["part"] == last["end_part"])
    in_slice = Window.partitionBy(*names).orderBy("key").rowsBetween(Window.unboundedPreceding, -1)
    ends = (
        keyed.join(broadcast_if_small(last), same)
        .groupBy(*names, "rest", "before", "key")
        .agg(F.sum("tokens").alias("t"))
        .withColumn("before", F.col("before") + F.coalesce(F.sum("t").over(in_slice), F.lit(0)))
        .filter(F.col("before") < F.col("rest"))
        .groupBy(*names)
        .agg(F.max("key").alias("end_key"))
        .select(*[F.col(n).alias(f"e{n}") for n in names], "end_key")
    )
    same = _same(plan, ends, [(n, f"e{n}") for n in names])
    chosen = stage(plan.join(ends, same, "left").select(*names, "epoch", "end_key"), "mix_chosen")

    copies, tokens, *own = fresh(docs, "copies", "tokens", *[f"mix{i}" for i in range(depth)], "mix_epoch", "mix_end")
    chosen = chosen.select(*[F.col(c).alias(o) for c, o in zip(chosen.columns, own, strict=True)])
    epoch, end = F.col(own[-2]), F.col(own[-1])
    same = reduce(lambda x, y: x & y, [c.cast("string").eqNullSafe(chosen[o]) for c, o in zip(levels, own, strict=False)])
    own_key = F.md5(F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))))
    n_copies = epoch + F.when(own_key <= end, 1).otherwise(0)
    return (
        docs.join(broadcast_if_small(chosen), same)
        .withColumn(copies, n_copies.cast("long"))
        .filter(F.col(copies) > 0)
        .drop(*own)
        .withColumn(tokens, n_words(F.col(text_col)))
    )
