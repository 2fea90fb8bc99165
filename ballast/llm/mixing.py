"""Mixing sources to target weights by hierarchical budgeting, with DataFrame functions only.

Documents form a tree: domain, language, source. A token budget for the whole mix goes down the tree by weights. A leaf
can give at most `epochs` times its tokens, a node what its children can. Where a node cannot take its share, its
siblings get the rest by their weights; since a node is given no more than its children can take together, a shortage
among them is made up among them first and reaches the node's own siblings only where all of them run short.

A leaf uses all its documents in every whole epoch that its budget covers. Of the next epoch it uses a prefix: documents
in the order of a hash of seed, epoch and id, as many as the budget left holds. The order is cut into buckets by the
hash's first digits. Totals per bucket (an aggregate with a partial step) tell which bucket holds the end of the prefix,
and only the documents of that bucket are sorted. So a leaf with a third of all rows is no task of its own.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ballast.llm.common import stored

LEVELS = ("domain", "lang", "source")
#: Hexadecimal digits of the hash that name a bucket, coarse to fine: at most 256 buckets of a leaf are looked at each time.
DIGITS = (2, 4)
WORD = r"[^\x20\x09-\x0D]+"


def weight_of(level: str, weights: Mapping[str, Mapping[str, int]]) -> Column:
    """Weight of a node by its value at its level; 1 if none is given."""
    out = F.lit(1.0)
    for value, weight in weights.get(level, {}).items():
        out = F.when(F.col(level) == value, F.lit(float(weight))).otherwise(out)
    return out


def poured(nodes: DataFrame, parent: Sequence[str], own: str) -> DataFrame:
    """Split each parent's `budget` over its children by `weight`, none above its `room`: column `share`.

    With the children in order of room / weight, the level at which the budget stands is that of the first child which
    this level does not fill: (budget - rooms of those before) / (weights from here on). Those before are full.
    """
    family = Window.partitionBy(*parent) if parent else Window.partitionBy(F.lit(0))
    ordered = family.orderBy("fill", own)
    before, rest = ordered.rowsBetween(Window.unboundedPreceding, -1), ordered.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    nodes = nodes.withColumn("fill", F.when(F.col("weight") > 0, F.col("room") / F.col("weight")).otherwise(F.lit(1e300)))
    left = F.col("budget") - F.coalesce(F.sum("room").over(before), F.lit(0.0))
    nodes = nodes.withColumn("level", F.when(F.col("weight") > 0, left / F.sum("weight").over(rest)).otherwise(F.lit(0.0)))
    open_ = F.when(F.col("level") < F.col("fill"), F.col("level"))
    nodes = nodes.withColumn("stand", F.first(open_, ignorenulls=True).over(ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    share = F.when(F.col("stand").isNull(), F.col("room")).otherwise(F.least(F.col("weight") * F.col("stand"), F.col("room")))
    return nodes.withColumn("share", share).drop("fill", "level", "stand", "budget")


def weighed(nodes: DataFrame, parent: Sequence[str], level: str, weights: Mapping[str, Mapping[str, int]]) -> DataFrame:
    """Nodes with `weight`; a family whose weights are all 0 weighs the same throughout. Without weight there is no room."""
    family = Window.partitionBy(*parent) if parent else Window.partitionBy(F.lit(0))
    nodes = nodes.withColumn("weight", weight_of(level, weights))
    nodes = nodes.withColumn("weight", F.when(F.sum("weight").over(family) > 0, F.col("weight")).otherwise(F.lit(1.0)))
    return nodes.withColumn("room", F.when(F.col("weight") > 0, F.col("room")).otherwise(F.lit(0.0)))


def leaf_budgets(leaves: DataFrame, weights: Mapping[str, Mapping[str, int]], epochs: int, fraction: float, tokens: int | None) -> DataFrame:
    """Leaves (domain, lang, source, n_tokens) with `budget`, whole tokens. The mix has `tokens`, or `fraction` of all."""
    domain, lang, source = LEVELS
    low = weighed(leaves.withColumn("room", F.col("n_tokens").cast("double") * epochs), [domain, lang], source, weights)
    low = low.withColumnRenamed("weight", "source_weight").withColumnRenamed("room", "source_room")
    middle = weighed(low.groupBy(domain, lang).agg(F.sum("source_room").alias("room"), F.sum("n_tokens").alias("all")), [domain], lang, weights)
    top = middle.groupBy(domain).agg(F.sum("room").alias("room"), F.sum("all").alias("all"))
    top = weighed(top, [], domain, weights)
    whole = F.lit(float(tokens)) if tokens is not None else F.floor(F.sum("all").over(Window.partitionBy(F.lit(0))) * F.lit(fraction)).cast("double")
    top = poured(top.withColumn("budget", whole), [], domain).select(domain, F.col("share").alias("budget"))
    middle = poured(middle.join(top, domain), [domain], lang).select(domain, lang, F.col("share").alias("budget"))
    low = low.withColumnRenamed("source_weight", "weight").withColumnRenamed("source_room", "room")
    return poured(low.join(middle, [domain, lang]), [domain, lang], source).select(*LEVELS, "n_tokens", F.floor("share").alias("budget"))


def mix(
    docs: DataFrame,
    domain: Column,
    weights: Mapping[str, Mapping[str, int]],
    epochs: int = 2,
    fraction: float = 0.5,
    tokens: int | None = None,
    seed: int = 7,
) -> DataFrame:
    """One row per row of `docs` (doc_id, text, lang, source): doc_id, domain, lang, source, n_tokens, uses.

    Tokens are runs of other than white space. `uses`: in how many epochs the mix has the document, 0 to `epochs`. A null
    domain, lang or source is a value of its own, written as an empty string; a null text has no tokens. A document
    without tokens is used as often as its place in the order says, in a leaf without tokens never. Repeated rows count
    and are used each; the place of a row without id in the order comes from its text. Weights are whole numbers, 1 if not given.
    """
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(domain.cast("string"), F.lit("")).alias("domain"),
        *(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in LEVELS[1:]),
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("n_tokens"),
        F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("n"), F.md5(F.coalesce(F.col("text").cast("string"), F.lit(""))))).alias("name"),
    )
    rows = stored(rows, "tokens")
    leaves = rows.groupBy(*LEVELS).agg(F.sum("n_tokens").alias("n_tokens"))
    leaves = leaf_budgets(leaves, weights, epochs, fraction, tokens).where("n_tokens > 0")
    leaves = leaves.select(*LEVELS, F.floor(F.col("budget") / F.col("n_tokens")).alias("whole"), (F.col("budget") % F.col("n_tokens")).alias("left"))
    leaves = stored(leaves, "leaves")
    key = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("whole").cast("string"), F.col("name")))
    placed = rows.join(leaves, list(LEVELS), "left").withColumn("key", key)
    running = Window.partitionBy(*LEVELS).orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inner, cut = placed.where("left > 0").withColumn("base", F.lit(0).cast("long")), None
    for digits in DIGITS:
        if cut is not None:
            inner = placed.join(cut, list(LEVELS)).where("startswith(key, cut)")
        totals = inner.groupBy(*LEVELS, F.substring("key", 1, digits).alias("bucket")).agg(F.sum("n_tokens").alias("n"), F.max("left").alias("left"), F.max("base").alias("base"))
        totals = totals.withColumn("upto", F.col("base") + F.sum("n").over(running))
        cut = totals.where("upto > left").groupBy(*LEVELS).agg(F.min(F.struct("bucket", (F.col("upto") - F.col("n")).alias("base"))).alias("cut"))
        cut = stored(cut.select(*LEVELS, F.col("cut.bucket").alias("cut"), F.col("cut.base").alias("base")), "cuts")
    placed = placed.join(cut, list(LEVELS), "left")
    sure = placed.where("cut IS NULL OR NOT startswith(key, cut)")
    sure = sure.withColumn("more", F.when((F.col("left") > 0) & (F.col("cut").isNull() | (F.col("key") < F.col("cut"))), 1).otherwise(0))
    inside = Window.partitionBy(*LEVELS).orderBy("key", "doc_id", "n_tokens").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    last = placed.where("startswith(key, cut)").withColumn("more", F.when(F.col("base") + F.sum("n_tokens").over(inside) <= F.col("left"), 1).otherwise(0))
    uses = (F.coalesce(F.col("whole"), F.lit(0)) + F.col("more")).cast("long").alias("uses")
    return sure.unionByName(last).select("doc_id", *LEVELS, "n_tokens", uses)
