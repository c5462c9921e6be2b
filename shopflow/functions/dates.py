"""Time columns."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def epoch_seconds(timestamp: Column) -> Column:
    return F.unix_seconds(timestamp)


def plus_hours(timestamp: Column, hours: int) -> Column:
    return timestamp + F.make_dt_interval(hours=F.lit(hours))


def iso_with_offset(timestamp: Column) -> Column:
    return F.date_format(timestamp, "yyyy-MM-dd'T'HH:mm:ssXXX")


def window_bounds(timestamp: Column, seconds: int) -> tuple[Column, Column]:
    """Start and end of the tumbling window a timestamp falls into."""
    span = seconds * 1_000_000
    start = F.unix_micros(timestamp) - F.pmod(F.unix_micros(timestamp), F.lit(span))
    return F.timestamp_micros(start), F.timestamp_micros(start + F.lit(span))


def to_millis(timestamp: Column) -> Column:
    return F.date_trunc("millisecond", timestamp)


def drift_factor(day: Column, start: str, ramp_days: int, multiplier: float, abrupt: bool = False) -> Column:
    """1 before the start, then a straight ramp to the multiplier (at once when abrupt)."""
    begin = F.lit(start).cast("date")
    progress = F.lit(1.0) if abrupt else F.least(F.datediff(day, begin) / F.lit(float(ramp_days)), F.lit(1.0))
    return F.when(day < begin, F.lit(1.0)).otherwise(F.round(F.lit(1.0) + progress * F.lit(multiplier - 1.0), 8))


def drift_phase(day: Column, baseline: tuple[str, str], start: str) -> Column:
    low, high = (F.lit(d).cast("date") for d in baseline)
    return F.when(day.between(low, high), "baseline").when(day >= F.lit(start).cast("date"), "post_drift").otherwise("pre_drift")


def drift_status(psi: Column, is_baseline: Column) -> Column:
    """Status by the fixed PSI limits 0.05, 0.10 and 0.15."""
    return (
        F.when(is_baseline, "baseline")
        .when(psi < 0.05, "stable")
        .when(psi < 0.10, "detected")
        .when(psi < 0.15, "strong")
        .otherwise("alert")
    )
