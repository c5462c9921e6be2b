"""Mergeable aggregates: partial results that can be stored, extended and combined later."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def partial_totals(frame: DataFrame, keys: list, value: str, order: str) -> DataFrame:
    """Count, sum, extremes and newest value per key; small enough to keep and merge."""
    newest = F.max_by(F.struct(order, value), F.struct(order, value)).alias("newest")
    return frame.groupBy(*keys).agg(
        F.count(value).alias("n"), F.sum(value).alias("total"), F.min(value).alias("low"), F.max(value).alias("high"), newest
    )


def merge_totals(partials: DataFrame, keys: list[str]) -> DataFrame:
    """Combine partial results; the order of merging does not matter."""
    return partials.groupBy(*keys).agg(
        F.sum("n").alias("n"), F.sum("total").alias("total"), F.min("low").alias("low"), F.max("high").alias("high"),
        F.max("newest").alias("newest"),
    )


def result(totals: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Readable totals with the mean."""
    return totals.select(
        *keys, "n", "total", "low", "high", F.col("newest")[value].alias("newest"), (F.col("total").cast("double") / F.col("n")).alias("mean")
    )
