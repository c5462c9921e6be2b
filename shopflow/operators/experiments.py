"""Experiment and service-log statistics."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopflow.operators.marts import ratio
from shopflow.plans.quantiles import quantiles

# Fixed gate values: error delta, latency ratio, quality ratio, least samples.
MAX_ERROR_DELTA = 0.02
MAX_LATENCY_RATIO = 1.5
MIN_QUALITY_RATIO = 0.95
MIN_SAMPLES = 100


def arm_metrics(log: DataFrame, keys: list[str]) -> DataFrame:
    """Samples, error rate, 95th percentile latency and mean confidence per arm."""
    p95 = quantiles(log.filter(F.col("latency_seconds").isNotNull()), keys, "latency_seconds", [0.95]).select(
        *keys, F.col("quantile").alias("p95_latency")
    )
    sums = log.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("samples"), F.avg(F.col("is_error").cast("double")).alias("error_rate"),
        F.avg(F.col("confidence").cast("double")).alias("quality"),
    )
    return sums.join(p95, keys, "left")


def experiment_gate(
    log: DataFrame, experiment: str, *, max_error_delta: float = MAX_ERROR_DELTA, max_latency_ratio: float = MAX_LATENCY_RATIO,
    min_quality_ratio: float = MIN_QUALITY_RATIO, min_samples: int = MIN_SAMPLES,
) -> DataFrame:
    """hold, promote or rollback per experiment with the reasons; log has a variant column."""
    metrics = arm_metrics(log, [experiment, "variant"])
    cells = {}
    for arm in ("candidate", "control"):
        for name in ("samples", "error_rate", "p95_latency", "quality"):
            cells[f"{arm}_{name}"] = F.max(F.when(F.col("variant") == arm, F.col(name)))
    wide = metrics.groupBy(experiment).agg(*[value.alias(name) for name, value in cells.items()])
    for arm in ("candidate", "control"):
        wide = wide.withColumn(f"{arm}_samples", F.coalesce(f"{arm}_samples", F.lit(0)))
    few = (F.col("candidate_samples") < min_samples) | (F.col("control_samples") < min_samples)
    error = F.col("candidate_error_rate") > F.col("control_error_rate") + max_error_delta
    slow = (F.col("control_p95_latency") > 0) & (F.col("candidate_p95_latency") > F.col("control_p95_latency") * max_latency_ratio)
    worse = (F.col("control_quality") > 0) & (F.col("candidate_quality") < F.col("control_quality") * min_quality_ratio)
    reasons = F.concat_ws(",", F.when(error, "error"), F.when(slow, "latency"), F.when(worse, "quality"))
    reasons = F.when(few, "samples").otherwise(reasons)
    decision = F.when(few, "hold").when(reasons == "", "promote").otherwise("rollback")
    return wide.withColumn("reasons", reasons).withColumn("decision", decision)


def request_rates(log: DataFrame, timestamp: str, route: str, failed: str, latency: str) -> DataFrame:
    """Requests, failure ratio and mean latency per minute and route."""
    minute = F.window(timestamp, "1 minute")["start"].alias("minute")
    return log.groupBy(minute, route).agg(
        F.count(F.lit(1)).alias("requests"), F.avg(F.col(failed).cast("double")).alias("failure_ratio"), F.avg(latency).alias("mean_latency")
    )


def assignment_summary(log: DataFrame) -> DataFrame:
    """Assignments and mean score per arm."""
    return log.groupBy("variant").agg(F.count(F.lit(1)).alias("assignments"), F.avg("score").alias("mean_score"))


def confidence_histogram(log: DataFrame, column: str = "confidence") -> DataFrame:
    """Counts per tenth of the confidence."""
    tenth = F.floor(F.col(column) * 10).cast("int").alias("bucket")
    return log.groupBy(tenth).agg(F.count(F.lit(1)).alias("n"))


def late_and_duplicate_ratio(windows: DataFrame) -> DataFrame:
    """Late and duplicate shares per quality window."""
    return windows.select(
        "window_start", ratio(F.col("late_event_count"), F.col("event_count")).alias("late_ratio"),
        ratio(F.col("duplicate_event_count"), F.col("event_count")).alias("duplicate_ratio"),
    )
