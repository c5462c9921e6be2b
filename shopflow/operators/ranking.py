"""Ranking metrics over groups of any size."""

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopflow.plans.hot_keys import top_k
from shopflow.plans.ordering import with_running


def group_key(request: Column, impression: Column, user: Column, time: Column) -> Column:
    """Request id, else impression id, else user and time."""
    known = lambda c: F.nullif(c.cast("string"), F.lit(""))
    return F.coalesce(known(request), known(impression), F.concat_ws(":", user.cast("string"), time.cast("string")))


# Pair counts outgrow 64 bits long before the row counts do.
WIDE = "decimal(18,0)"


def _wide(column: str) -> Column:
    return F.col(column).cast(WIDE)


def _class_counts(scored: DataFrame, keys: list[str]) -> DataFrame:
    """Positives and negatives per distinct score; combined map-side."""
    return scored.groupBy(*keys, "score").agg(
        F.sum("label").cast("bigint").alias("_pos"), F.sum(F.lit(1) - F.col("label")).cast("bigint").alias("_neg")
    )


def group_auc(scored: DataFrame, keys: list[str]) -> DataFrame:
    """Area under the curve per group, tied scores sharing their rank; groups of one class are left out.

    A positive wins over the negatives scored below it and half of those scored the same. The negatives
    below come from one global running count, so a group may be as large as the data.
    """
    counts = _class_counts(scored, keys)
    running = with_running(counts, [*keys, "score"], {"_cum": ("sum", F.col("_neg"))})
    below = F.col("_cum") - F.col("_neg")
    per_group = running.groupBy(*keys).agg(
        F.min(below).alias("_start"), F.sum("_pos").alias("positives"), F.sum("_neg").alias("negatives"),
        F.sum(_wide("_pos") * (F.lit(2) * below + F.col("_neg")).cast(WIDE)).alias("_twice"),
    )
    # Counts of earlier groups are inside the running total; take them out per positive.
    won = (F.col("_twice") - _wide("_start") * _wide("positives") * F.lit(2)).cast("double")
    mixed = per_group.filter((F.col("positives") > 0) & (F.col("negatives") > 0))
    return mixed.select(
        *keys, "positives", "negatives", (won / (F.lit(2.0) * F.col("positives") * F.col("negatives"))).alias("auc")
    )


def auc(scored: DataFrame) -> DataFrame:
    """AUC of all rows as one row; 0 when a class is missing."""
    one = group_auc(scored.withColumn("_all", F.lit(1)), ["_all"]).drop("_all")
    sizes = scored.agg(F.sum("label").cast("bigint").alias("positives"), F.sum(F.lit(1) - F.col("label")).cast("bigint").alias("negatives"))
    return sizes.join(one.select("auc"), F.lit(True), "left").withColumn("auc", F.coalesce("auc", F.lit(0.0)))


def group_metrics(scored: DataFrame, keys: list[str], tie_break: str, ks: list[int]) -> DataFrame:
    """HitRate, NDCG and MRR at each k per group.

    Only the first max(ks) rows of a group are ever ordered; the ideal gain follows from the number of positives.
    """
    deepest = max(ks)
    best = top_k(scored, keys, [F.desc("score"), F.asc(tie_break)], deepest, "place")
    totals = scored.groupBy(*keys).agg(F.sum("label").cast("int").alias("_positives"))
    hit = F.col("label") > 0
    aggregates = []
    for k in ks:
        within = hit & (F.col("place") <= k)
        gain = F.when(within, F.lit(1.0) / F.log2(F.col("place") + 1)).otherwise(0.0)
        aggregates += [
            F.max(within.cast("double")).alias(f"hitrate_{k}"),
            F.sum(gain).alias(f"_dcg_{k}"),
            F.coalesce(F.lit(1.0) / F.min(F.when(within, F.col("place"))), F.lit(0.0)).alias(f"mrr_{k}"),
        ]
    grouped = best.groupBy(*keys).agg(*aggregates).join(totals, keys)
    ideal = F.array(*[F.lit(sum(1.0 / math.log2(i + 2) for i in range(n))) for n in range(deepest + 1)])
    for k in ks:
        best_gain = F.element_at(ideal, F.least("_positives", F.lit(k)) + 1)
        grouped = grouped.withColumn(f"ndcg_{k}", F.when(F.col("_positives") > 0, F.col(f"_dcg_{k}") / best_gain).otherwise(0.0))
    return grouped.select(*keys, *[f"{m}_{k}" for k in ks for m in ("hitrate", "ndcg", "mrr")])


def ranking_report(scored: DataFrame, keys: list[str], tie_break: str, ks: list[int]) -> DataFrame:
    """Means over all groups, the mean AUC of mixed groups, and the overall AUC, as one row."""
    groups = group_metrics(scored, keys, tie_break, ks)
    means = groups.agg(
        F.count(F.lit(1)).alias("num_groups"), *[F.avg(c).alias(c) for c in groups.columns if c not in keys]
    )
    grouped = group_auc(scored, keys).agg(F.coalesce(F.avg("auc"), F.lit(0.0)).alias("gauc"), F.count(F.lit(1)).alias("valid_auc_groups"))
    return means.crossJoin(grouped).crossJoin(auc(scored).select("auc"))  # one row each


def top_recommendations(scored: DataFrame, user: str, item: str, k: int) -> DataFrame:
    return top_k(scored, [user], [F.desc("score"), F.asc(item)], k)


def first_per_class(frame: DataFrame, label: str, order: list, n: int) -> DataFrame:
    """First n rows of every class."""
    return top_k(frame, [label], order, n, "place")


def rank_in_group(scored: DataFrame, keys: list[str], tie_break: str) -> DataFrame:
    """Position of every row in its group by score; exact for groups that exceed one task."""
    from shopflow.plans.ordering import with_rank_in_group

    return with_rank_in_group(scored, keys, [F.desc("score"), F.asc(tie_break)])

