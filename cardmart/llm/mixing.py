"""Mixing sources to target weights: hierarchical token budgets and seeded epochs.

The sources form a tree of ``levels`` (domain, language, source).  A budget of
tokens goes down the tree.  At each node it is dealt among the children by
weight, and no child gets more than its leaves can supply in ``max_epochs``
passes.  What a child cannot use goes to its siblings by their weights; only
what all of them cannot use was never given to their parent, because a parent's
own limit is the sum of its children's.  So shortages are met by siblings before
ancestors.

Within a leaf, epoch ``e`` puts the documents in the order of
``md5(seed|e|id|md5(text))``.  A leaf takes whole epochs while its budget
lasts, then the longest prefix of the next epoch whose tokens fit.  The prefix
is found by buckets of the order key, so no leaf is sorted in one task: only the
bucket in which the budget ends is numbered row by row.

All amounts are integers; a share that is not whole is rounded down.

Rows: null or empty text has no tokens; in an epoch that is begun such a document is
taken if its place is within the prefix.  A null in a level is a node of its own.  Documents of
equal key and text share a place in the order and are numbered as they tie:
all of them are taken or none.  Children without a weight have ``default_weight``.
Extra columns stay unread and are not returned.  No leaves: empty result.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window, functions as F

from cardmart.llm.common import WORD, Scratch

LEVELS = ("domain", "lang", "source")
#: Production weights by level and value; a document's form is its domain.
WEIGHTS: dict[str, dict[str, int]] = {
    "domain": {"note": 30, "article": 50, "long": 20},
    "lang": {"en": 50, "de": 20, "fr": 20, "es": 10},
    "source": {"src0": 3, "src1": 2, "src2": 2},
}
DEFAULT_WEIGHT = 1
SEED = "mix-1"
BUCKET_DIGITS = 3  # 4,096 buckets of the order key in each leaf


def document_domain(n_tokens: Column) -> Column:
    """Form of a document by its length in words."""
    return F.when(n_tokens < 150, "note").when(n_tokens < 1500, "article").otherwise("long")


def token_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def _weight(level: str, weights: Mapping[str, Mapping[str, int]], default: int) -> Column:
    out = F.lit(default).cast("long")
    for value, w in weights.get(level, {}).items():
        out = F.when(F.col(level) == value, F.lit(w).cast("long")).otherwise(out)
    return out


def leaf_budgets(leaves: DataFrame, total: int, levels=LEVELS, weights=WEIGHTS,
                 default_weight: int = DEFAULT_WEIGHT, max_epochs: int = 1) -> DataFrame:
    """Budget of each leaf.  ``leaves``: the levels and ``supply`` (tokens), one row per leaf.

    ``total`` is the budget of the root.  Water is filled in at each level by running sums over the children of a
    node, in the order in which they fill up.
    """
    levels = list(levels)
    df = leaves.withColumn("limit", F.col("supply") * F.lit(max_epochs))
    # Limits of all inner nodes, bottom up.
    for depth in range(len(levels), 0, -1):
        name = f"cap{depth}"
        df = df.withColumn(name, F.sum("limit").over(Window.partitionBy(*levels[:depth])))
    df = df.withColumn("budget0", F.least(F.lit(total).cast("long"), F.sum("limit").over(Window.partitionBy(F.lit(1)))))
    for depth in range(1, len(levels) + 1):
        parent, key, cap = levels[:depth - 1], levels[:depth], f"cap{depth}"
        nodes = df.select(*key, f"budget{depth - 1}", cap).distinct().withColumn(
            "w", _weight(levels[depth - 1], weights, default_weight))
        nodes = nodes.where("w > 0")
        # Order in which children fill up as the level of water rises (cap / w), by exact integers where they tie.
        order = [F.col(cap) / F.col("w"), *[F.col(k) for k in key]]
        upto = Window.partitionBy(*parent).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
        whole = Window.partitionBy(*parent)
        nodes = nodes.withColumns({
            "cap_before": F.sum(cap).over(upto) - F.col(cap),
            "w_left": F.sum("w").over(whole) - F.sum("w").over(upto) + F.col("w"),
            "rank": F.row_number().over(Window.partitionBy(*parent).orderBy(*order))})
        left = F.col(f"budget{depth - 1}") - F.col("cap_before")
        nodes = nodes.withColumn("full", left * F.col("w") >= F.col(cap) * F.col("w_left"))
        # The first child that does not fill sets the level for itself and all after it.
        first = F.min(F.when(~F.col("full"), F.struct("rank", left.alias("left"), "w_left"))).over(whole)
        nodes = nodes.withColumn("first", first)
        share = F.floor(F.col("first.left") * F.col("w") / F.col("first.w_left")).cast("long")
        budget = F.when(F.col("first").isNull() | (F.col("rank") < F.col("first.rank")), F.col(cap)).otherwise(
            F.greatest(F.lit(0).cast("long"), F.least(share, F.col(cap))))
        nodes = nodes.select(*[F.col(k).alias("n_" + k) for k in key], budget.alias(f"budget{depth}"))
        on = [F.col(k).eqNullSafe(F.col("n_" + k)) for k in key]
        df = df.join(nodes, on, "left").drop(*["n_" + k for k in key]).withColumn(
            f"budget{depth}", F.coalesce(f"budget{depth}", F.lit(0).cast("long")))
    return df.select(*levels, "supply", F.col(f"budget{len(levels)}").alias("budget"))


def order_key(epoch: Column, key: Column, text: Column, seed: str = SEED) -> Column:
    return F.md5(F.concat_ws("|", F.lit(seed), epoch.cast("string"), F.coalesce(key.cast("string"), F.lit("null")),
                             F.md5(F.coalesce(text, F.lit("")))))


def mix(docs: DataFrame, budget_share: float | None = 0.8, budget: int | None = None, levels=LEVELS, weights=WEIGHTS,
        default_weight: int = DEFAULT_WEIGHT, max_epochs: int = 1, seed: str = SEED,
        scratch: Scratch | None = None) -> DataFrame:
    """One row per document: id, levels, n_tokens, leaf_budget, whole_epochs, in_prefix, epochs.

    The budget is ``budget`` tokens, or ``budget_share`` of all tokens.
    ``docs`` needs doc_id, text, lang and source.
    """
    scratch = scratch or Scratch(docs.sparkSession, "mix")
    n = token_count(F.col("text"))
    base = docs.select("doc_id", "lang", "source", n.alias("n_tokens"), F.md5(F.coalesce("text", F.lit(""))).alias("text_md5"))
    base = scratch.cut(base.withColumn("domain", document_domain(F.col("n_tokens"))), "tokens")
    levels = list(levels)
    leaves = scratch.cut(base.groupBy(*levels).agg(F.sum("n_tokens").alias("supply")), "leaves")
    total = budget
    if total is None:
        total = leaves.agg(F.floor(F.sum("supply") * F.lit(float(budget_share)))).first()[0] or 0
    budgets = leaf_budgets(leaves, total, levels, weights, default_weight, max_epochs)
    q = F.when(F.col("supply") > 0, F.floor(F.col("budget") / F.col("supply"))).otherwise(0).cast("long")
    budgets = scratch.cut(budgets.withColumn("whole_epochs", q).withColumn(
        "prefix_budget", F.col("budget") - F.col("whole_epochs") * F.col("supply")), "budgets")
    renamed = budgets.select(*[F.col(k).alias("b_" + k) for k in levels],
                             F.col("budget").alias("leaf_budget"), "whole_epochs", "prefix_budget")
    rows = base.join(renamed, [F.col(k).eqNullSafe(F.col("b_" + k)) for k in levels], "left").drop(
        *["b_" + k for k in levels])
    place = F.md5(F.concat_ws("|", F.lit(seed), F.col("whole_epochs").cast("string"),
                              F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.col("text_md5")))
    rows = rows.withColumn("place", place).withColumn("bucket", F.substring("place", 1, BUCKET_DIGITS))
    # Tokens before each bucket of a leaf: at most 4,096 rows a leaf.
    sums = rows.groupBy(*levels, "prefix_budget", "bucket").agg(F.sum("n_tokens").alias("in_bucket"))
    before = F.sum("in_bucket").over(Window.partitionBy(*levels).orderBy("bucket")) - F.col("in_bucket")
    sums = sums.withColumn("before", before)
    sums = sums.select(*[F.col(k).alias("s_" + k) for k in levels], F.col("bucket").alias("s_bucket"), "before",
                       (F.col("before") + F.col("in_bucket") <= F.col("prefix_budget")).alias("whole_bucket"),
                       (F.col("before") > F.col("prefix_budget")).alias("no_bucket"))
    on = [F.col(k).eqNullSafe(F.col("s_" + k)) for k in levels] + [F.col("bucket") == F.col("s_bucket")]
    rows = rows.join(sums, on, "left").drop(*["s_" + k for k in levels], "s_bucket")
    # Only the bucket in which the budget ends is numbered row by row.
    edge = ~F.col("whole_bucket") & ~F.col("no_bucket")
    split = F.when(edge, F.col("bucket")).otherwise(F.concat(F.lit("-"), F.substring("place", 1, 8)))
    run = F.sum("n_tokens").over(Window.partitionBy(*levels, split).orderBy("place")
                                 .rangeBetween(Window.unboundedPreceding, 0))
    begun = (F.col("leaf_budget") > 0)
    rows = rows.withColumn("in_prefix", begun & F.when(edge, F.col("before") + run <= F.col("prefix_budget"))
                           .otherwise(F.col("whole_bucket")))
    rows = rows.withColumn("in_prefix", F.col("in_prefix") & (F.col("whole_epochs") < max_epochs))
    return rows.select("doc_id", *levels, "n_tokens", "text_md5", "leaf_budget", "whole_epochs", "in_prefix",
                       (F.col("whole_epochs") + F.col("in_prefix").cast("long")).alias("epochs"))
