"""Duplicate and lateness flags of one arrival sequence: shared by the stream and its batch twin."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopflow.plans.hot_keys import top_k
from shopflow.plans.joins import salted_join
from shopflow.plans.ordering import with_running
from shopflow.streaming.config import StreamConfig

ARRIVAL = ["record_timestamp", "payload_hash"]


def event_time(text: Column, record_timestamp: Column) -> Column:
    """Event time of a record: its own, else the record's, else now."""
    return F.coalesce(F.try_to_timestamp(text), record_timestamp, F.current_timestamp())


def status(event: Column, watermark_ms: Column, config: StreamConfig) -> dict[str, Column]:
    """Lateness of an event against a watermark; without a watermark nothing is late."""
    event_ms = F.unix_millis(event)
    window_ms = max(1, config.feature_window_seconds) * 1000
    window_end = event_ms - F.pmod(event_ms, F.lit(window_ms)) + window_ms
    allowed = max(0, config.allowed_lateness_seconds) * 1000
    known = watermark_ms.isNotNull()
    return {
        "late_by_seconds": F.when(known, F.greatest(watermark_ms - event_ms, F.lit(0)) / F.lit(1000.0)).otherwise(0.0),
        "is_late": known & (event_ms <= watermark_ms),
        "is_too_late": known & (watermark_ms >= window_end + allowed),
    }


def mark_duplicates(events: DataFrame) -> DataFrame:
    """is_duplicate: met in an earlier batch, or not the first copy to arrive in this one.

    The first copy per id is a map-side combined minimum; the join back spreads the copies of a hot id.
    """
    seen = F.col("seen_before") if "seen_before" in events.columns else F.lit(False)
    order = F.struct(*ARRIVAL)
    marked = events.withColumn("_arrival", order)
    first = marked.groupBy("event_id").agg(F.min("_arrival").alias("_first"), F.max(seen).alias("_seen"))
    joined = salted_join(marked, first, ["event_id"], "inner")
    return joined.withColumn("is_duplicate", F.col("_seen") | (F.col("_arrival") > F.col("_first"))).drop(
        "_arrival", "_first", "_seen", "seen_before"
    )


def classify(
    events: DataFrame, config: StreamConfig, highest_before: int | None = None, scratch: str | None = None
) -> DataFrame:
    """Lateness against the watermark that stood when each event arrived.

    The watermark is the highest event time so far minus the delay; highest_before (epoch ms) carries it
    over from earlier batches, so results do not depend on how the stream was cut.
    """
    at = F.unix_millis("event_timestamp")
    running = with_running(events.withColumn("_ms", at), [*ARRIVAL, "event_id"], {"_highest": ("max", F.col("_ms"))}, scratch)
    highest = F.col("_highest")
    if highest_before is not None:
        highest = F.greatest(highest, F.lit(highest_before))
    watermark = highest - config.watermark_delay_seconds * 1000
    flagged = running
    for name, value in status(F.col("event_timestamp"), watermark, config).items():
        flagged = flagged.withColumn(name, value)
    return flagged.drop("_ms", "_highest")


def feature_events(events: DataFrame, config: StreamConfig) -> DataFrame:
    """Events that count for features: no duplicates, and no too-late ones where those are dropped."""
    kept = ~F.col("is_duplicate")
    return events.filter(kept & ~F.col("is_too_late") if config.drop_late_events else kept)


def dead_letters(events: DataFrame, config: StreamConfig, run_ts: Column, reason: str = "too_late_for_feature_update") -> DataFrame:
    """Rows of the dead-letter table for events that came too late, of copies of an event the first to arrive."""
    left_out = ("is_late", "is_too_late", "is_duplicate", "late_by_seconds", "watermark_ms", "processed_timestamp")
    columns = [c for c in events.columns if c not in left_out]
    firsts = top_k(events.filter("is_too_late"), ["event_id"], ARRIVAL, 1, "_rank")
    return firsts.select(
        "event_id", "user_id", "product_id", "event_type", "event_timestamp", run_ts.alias("processed_timestamp"), "late_by_seconds",
        F.lit(config.allowed_lateness_seconds).alias("allowed_lateness_seconds"), F.lit(config.topic).alias("source_topic"),
        F.coalesce("payload_hash", F.lit("")).alias("payload_hash"), F.lit(reason).alias("reason"),
        F.to_json(F.struct(*sorted(columns)), {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}).alias("payload"), run_ts.alias("created_timestamp"),
    )


def late_counters(events: DataFrame) -> DataFrame:
    """Late events in all, accepted and too late; the first is the sum of the others."""
    return events.agg(
        F.count_if("is_late").alias("late_arrivals_total"),
        F.count_if(F.col("is_late") & ~F.col("is_too_late")).alias("accepted_late_events_total"),
        F.count_if(F.col("is_late") & F.col("is_too_late")).alias("too_late_events_total"),
    )


def quality_counts(events: DataFrame, config: StreamConfig) -> DataFrame:
    """Tumbling windows of the accepted events; combines map-side, so the single topic is no bottleneck."""
    span = f"{config.quality_window_seconds} seconds"
    grouped = events.filter(~F.col("is_too_late")).groupBy(F.window("event_timestamp", span).alias("w"), F.lit(config.topic).alias("topic"))
    counts = grouped.agg(
        F.count(F.lit(1)).alias("event_count"), F.count_if("is_late").alias("late_event_count"),
        F.count_if("is_duplicate").alias("duplicate_event_count"), F.max("late_by_seconds").alias("max_late_by_seconds"),
    )
    return counts.select(
        F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "topic", "event_count", "late_event_count",
        "duplicate_event_count", "max_late_by_seconds", (F.col("event_count") >= config.burst_threshold).alias("is_bursty"),
    )


def panes(events: DataFrame, key: str, config: StreamConfig) -> DataFrame:
    """Totals per entity and tumbling pane. Panes combine map-side; a hot entity sends one row per pane and task."""
    grouped = events.groupBy(key, F.window("event_timestamp", f"{config.feature_window_seconds} seconds").alias("w"))
    counts = grouped.agg(
        F.count(F.lit(1)).alias("event_count"), *[F.count_if(F.col("event_type") == t).alias(f"{t}s") for t in ("view", "cart", "purchase")],
        F.max("event_timestamp").alias("last_event_timestamp"),
    )
    return counts.select(key, F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *counts.columns[2:])


def metric_lines(windows: DataFrame, config: StreamConfig) -> DataFrame:
    """One JSON line per quality window, keys sorted."""
    iso = "yyyy-MM-dd'T'HH:mm:ssXXX"
    fields = {
        "status": F.lit("streaming_quality_window_metrics"), "window_start": F.date_format("window_start", iso),
        "window_end": F.date_format("window_end", iso), "drop_late_events": F.lit(config.drop_late_events),
        **{c: F.col(c) for c in ("topic", "event_count", "late_event_count", "duplicate_event_count", "max_late_by_seconds", "is_bursty")},
        **{c: (F.col(c) if c in windows.columns else F.lit(0)) for c in ("late_events_dropped", "side_output_late_events")},
    }
    return windows.select("window_start", F.to_json(F.struct(*[fields[k].alias(k) for k in sorted(fields)])).alias("line"))
