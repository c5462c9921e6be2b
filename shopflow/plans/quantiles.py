"""Exact order statistics of groups of any size.

Equal values combine first; their running counts come from the global order, so neither the values
of a group nor a histogram of them ever sit in one task (as Spark's exact percentile would hold them).
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopflow.plans.ordering import with_running


def counted_values(frame: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Distinct values with _from and _to, the 0-based half-open span of positions they take, and group size _n."""
    counts = frame.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_c"))
    running = with_running(counts, [*keys, value], {"_cum": ("sum", F.col("_c"))})
    groups = running.groupBy(*keys).agg(F.min(F.col("_cum") - F.col("_c")).alias("_start"), F.sum("_c").alias("_n"))
    joined = running.join(groups, keys) if keys else running.crossJoin(groups)
    return joined.select(
        *keys, value, "_c", "_n", (F.col("_cum") - F.col("_c") - F.col("_start")).alias("_from"), (F.col("_cum") - F.col("_start")).alias("_to")
    )


def quantiles(frame: DataFrame, keys: list[str], value: str, probabilities: list[float], nearest_rank: bool = False) -> DataFrame:
    """One row per group and probability: by linear interpolation, or the value of rank ceil(p n)."""
    spans = counted_values(frame, keys, value)
    picks = []
    for number, p in enumerate(probabilities):
        if nearest_rank:
            at = F.greatest(F.ceil(F.lit(p) * F.col("_n")), F.lit(1)) - 1
            low, high, weight = at, at, F.lit(0.0)
        else:
            place = (F.col("_n") - 1) * F.lit(p)
            low, high = F.floor(place), F.ceil(place)
            weight = (place - low).cast("double")
        picks.append(
            F.struct(F.lit(number).alias("q"), low.cast("bigint").alias("low"), high.cast("bigint").alias("high"), weight.alias("weight"))
        )
    inside = lambda at: (at >= F.col("_from")) & (at < F.col("_to"))
    hit = F.filter(F.array(*picks), lambda t: inside(t["low"]) | inside(t["high"]))
    rows = spans.select(*keys, value, "_from", "_to", F.explode(hit).alias("_t"))
    low_value = F.max(F.when(inside(F.col("_t.low")), F.col(value))).cast("double")
    high_value = F.max(F.when(inside(F.col("_t.high")), F.col(value))).cast("double")
    grouped = rows.groupBy(*keys, F.col("_t.q").alias("q")).agg(
        low_value.alias("_low"), high_value.alias("_high"), F.max("_t.weight").alias("_weight")
    )
    level = F.element_at(F.array(*[F.lit(float(p)) for p in probabilities]), F.col("q") + 1)
    mixed = F.col("_low") * (F.lit(1.0) - F.col("_weight")) + F.col("_high") * F.col("_weight")
    result: Column = F.when(F.col("_weight") == 0, F.col("_low")).otherwise(mixed)
    return grouped.select(*keys, level.alias("probability"), result.alias("quantile"))
