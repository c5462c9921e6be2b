"""Traffic problems as dataset transforms, for trying the stream on: bursts, replays, late arrivals.

Rows are picked by hashes, so a transform repeats itself on every run.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopflow.functions.hashing import bucket


def inject_bursts(events: DataFrame, every: int, multiplier: int, seconds: int = 60) -> DataFrame:
    """Every n-th minute carries its events several times over, the copies under new ids."""
    tick = F.floor(F.unix_seconds("event_timestamp") / seconds)
    copies = F.when((F.pmod(tick, F.lit(every)) == 0) if every > 0 else F.lit(False), multiplier).otherwise(1)
    rows = events.withColumn("_copies", copies).withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies"))))
    renamed = F.when(F.col("_copy") > 1, F.concat_ws("-", "event_id", F.col("_copy").cast("string"))).otherwise(F.col("event_id"))
    return rows.withColumn("event_id", renamed).drop("_copies", "_copy")


def inject_replays(events: DataFrame, rate: float, delay_seconds: int) -> DataFrame:
    """A share of the events arrives again later with the same id."""
    picked = bucket(F.concat(F.lit("replay:"), F.col("event_id")), 1_000_000) < int(rate * 1_000_000)
    again = events.filter(picked).withColumn("ingestion_ts", F.col("ingestion_ts") + F.make_dt_interval(secs=F.lit(delay_seconds)))
    return events.unionByName(again)


def inject_late(events: DataFrame, rate: float, low_minutes: int, high_minutes: int) -> DataFrame:
    """A share of the events happened minutes before they were sent."""
    key = F.concat(F.lit("late:"), F.col("event_id"))
    picked = bucket(key, 1_000_000) < int(rate * 1_000_000)
    delay = (F.lit(low_minutes) + bucket(F.concat(F.lit("by:"), key), high_minutes - low_minutes + 1)) * 60
    moved = F.col("event_timestamp") - F.make_dt_interval(secs=delay)
    return events.withColumn("event_timestamp", F.when(picked, moved).otherwise(F.col("event_timestamp"))).withColumn(
        "injected_delay_seconds", F.when(picked, delay).otherwise(0)
    )
