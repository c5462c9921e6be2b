"""SQL-mart layer: staging, outcomes, funnels, experiments and product performance.

Each model is a function of frames; marts that read a fact several times expect it stored.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopflow.operators.asof import scd_join

OUTCOMES = ("click", "cart", "purchase")
INVALID_STATUS = ("cancelled", "refunded")


def ratio(top: Column, bottom: Column) -> Column:
    """Quotient in double precision, null where the bottom is zero."""
    return F.try_divide(top.cast("double"), F.nullif(bottom.cast("double"), F.lit(0.0)))


def stg_behavior_events(events: DataFrame) -> DataFrame:
    return events.select(
        "event_id", F.col("event_timestamp").cast("timestamp").alias("event_timestamp"), "user_id", "session_id", "request_id",
        "impression_id", F.lower("event_type").alias("event_type"), "product_id", "category_id", "brand_id",
        F.col("price").cast("decimal(18,2)").alias("price"), F.coalesce(F.col("quantity").cast("int"), F.lit(1)).alias("quantity"),
        "device_type", "source", "campaign_id", "order_id",
    )


def stg_impressions(impressions: DataFrame) -> DataFrame:
    return impressions.select(
        "impression_id", "request_id", "user_id", "session_id", "impression_timestamp",
        F.col("candidate_product_id").alias("product_id"), "rank_position", "candidate_source", "retrieval_score",
        "ranking_score", "surface", F.coalesce("is_clicked", F.lit(False)).alias("source_is_clicked"),
    )


def stg_requests(requests: DataFrame) -> DataFrame:
    """Experiment and variant out of the request context; broken JSON and empty texts become null."""

    def member(name: str) -> Column:
        return F.nullif(F.get_json_object("request_context", f"$.{name}"), F.lit("")).alias(name)

    return requests.select(
        "request_id", "user_id", "session_id", "request_timestamp", "surface", member("experiment_id"), member("variant")
    )


def stg_products(scd: DataFrame) -> DataFrame:
    return scd.select(
        "product_id", "valid_from", "valid_to", "category_id", "category_code", "brand_id", "brand_name",
        F.col("current_price").cast("decimal(18,2)").alias("current_price"), F.col("price_bucket").cast("int").alias("price_bucket"),
        "is_active",
    )


def stg_users(users: DataFrame) -> DataFrame:
    return users.withColumnRenamed("segment", "user_segment")


def stg_orders(items: DataFrame, orders: DataFrame) -> DataFrame:
    """Order lines with their header; a line counts as a purchase unless its header is missing, cancelled or refunded."""
    header = orders.select("order_id", "user_id", "session_id", "order_timestamp", F.lower("status").alias("order_status"))
    valid = F.col("order_status").isNotNull() & ~F.col("order_status").isin(*INVALID_STATUS)
    return items.join(header, "order_id", "left").withColumn("is_valid_purchase", F.coalesce(valid, F.lit(False)))


def dim_product(scd: DataFrame) -> DataFrame:
    return stg_products(scd).withColumn("is_current", F.col("valid_to").isNull())


def outcome_flags(events: DataFrame) -> DataFrame:
    """Per impression: whether and when it was first clicked, carted and bought."""
    known = events.filter(F.col("impression_id").isNotNull())
    happened = {o: F.col("event_type") == o for o in OUTCOMES}
    times = {"click": "clicked_at", "cart": "carted_at", "purchase": "purchased_at"}
    return known.groupBy("impression_id").agg(
        *[F.max(is_it.cast("int")).alias(f"has_{o}") for o, is_it in happened.items()],
        *[F.min(F.when(is_it, F.col("event_timestamp"))).alias(times[o]) for o, is_it in happened.items()],
    )


def impression_outcomes(impressions: DataFrame, events: DataFrame, requests: DataFrame) -> DataFrame:
    """Impressions with experiment arm and outcomes; outcomes are aggregated before they are joined."""
    arms = requests.select("request_id", "experiment_id", "variant")
    joined = impressions.join(outcome_flags(events), "impression_id", "left").join(arms, "request_id", "left")
    clicked = F.greatest(F.coalesce("has_click", F.lit(0)), F.col("source_is_clicked").cast("int"))
    return (
        joined.withColumn("has_click", clicked)
        .withColumn("has_cart", F.coalesce("has_cart", F.lit(0)))
        .withColumn("has_purchase", F.coalesce("has_purchase", F.lit(0)))
    )


def _funnel_counts() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("impressions"),
        F.sum("has_click").alias("clicks"),
        F.sum("has_cart").alias("carts"),
        F.sum("has_purchase").alias("purchases"),
    ]


def session_funnels(outcomes: DataFrame) -> DataFrame:
    day = F.to_date("impression_timestamp").alias("metric_date")
    return outcomes.groupBy(day, "session_id", "user_id").agg(*_funnel_counts())


def daily_revenue(lines: DataFrame) -> DataFrame:
    paid = F.when(F.col("is_valid_purchase"), F.col("line_amount")).otherwise(F.lit(0).cast("decimal(18,2)"))
    return lines.groupBy(F.to_date("order_timestamp").alias("metric_date")).agg(F.sum(paid).alias("revenue"))


def funnel_daily(funnels: DataFrame, lines: DataFrame) -> DataFrame:
    """Daily sessions, users and funnel counts with revenue of the day and conversion rates."""
    days = funnels.groupBy("metric_date").agg(
        F.count_distinct("session_id").alias("sessions"),
        F.count_distinct("user_id").alias("users"),
        *[F.sum(c).alias(c) for c in ("impressions", "clicks", "carts", "purchases")],
    )
    joined = days.join(daily_revenue(lines), "metric_date", "left")
    clicks, purchases, shown = F.col("clicks"), F.col("purchases"), F.col("impressions")
    return (
        joined.withColumn("revenue", F.coalesce("revenue", F.lit(0).cast("decimal(18,2)")))
        .withColumn("ctr", ratio(clicks, shown))
        .withColumn("click_to_purchase_cvr", ratio(purchases, clicks))
        .withColumn("impression_to_purchase_cvr", ratio(purchases, shown))
    )


def experiment_daily(outcomes: DataFrame, users: DataFrame) -> DataFrame:
    """Daily funnel per experiment arm and current user segment; rows without an arm do not count."""
    assigned = outcomes.dropna(subset=["experiment_id", "variant"])
    segments = users.select("user_id", "user_segment")
    joined = assigned.join(segments, "user_id", "left").withColumn("user_segment", F.coalesce("user_segment", F.lit("unknown")))
    keys = [F.to_date("impression_timestamp").alias("metric_date"), "experiment_id", "variant", "user_segment"]
    grouped = joined.groupBy(*keys).agg(F.count_distinct("user_id").alias("users"), *_funnel_counts())
    return grouped.withColumn("ctr", ratio(F.col("clicks"), F.col("impressions"))).withColumn(
        "conversion_rate", ratio(F.col("purchases"), F.col("impressions"))
    )


def product_performance_daily(outcomes: DataFrame, products: DataFrame) -> DataFrame:
    """Daily exposure and outcomes per product, described as of each impression."""
    described = scd_join(outcomes, products, "product_id", "impression_timestamp")
    keys = [F.to_date("impression_timestamp").alias("metric_date"), "product_id", "category_id", "category_code", "brand_id", "brand_name"]
    grouped = described.groupBy(*keys).agg(*_funnel_counts()).withColumnRenamed("purchases", "attributed_purchases")
    return grouped.withColumn("ctr", ratio(F.col("clicks"), F.col("impressions"))).withColumn(
        "conversion_rate", ratio(F.col("attributed_purchases"), F.col("impressions"))
    )


def percent_columns(mart: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Rates as percentages under new names."""
    return mart.select(
        *[c for c in mart.columns if c not in columns], *[(F.col(c) * 100.0).alias(n) for c, n in columns.items()]
    )


STAGES = ["impressions", "clicks", "carts", "purchases"]


def funnel_stages(mart: DataFrame) -> DataFrame:
    """One row per day and funnel stage; a single scan where a union of four selects would read four times."""
    long = mart.select("metric_date", *[F.col(c).cast("bigint").alias(c) for c in STAGES]).unpivot(
        ["metric_date"], STAGES, "stage_name", "stage_value"
    )
    order = F.array_position(F.array(*[F.lit(s) for s in STAGES]), F.col("stage_name")).cast("int")
    return long.select(
        "metric_date",
        F.concat(order.cast("string"), F.lit(". "), F.initcap("stage_name")).alias("stage"),
        order.alias("stage_order"),
        "stage_value",
    )


def weighted_rate(top: str, bottom: str) -> Column:
    """Percentage of two sums, null for an empty bottom."""
    return ratio(F.lit(100.0) * F.sum(top), F.sum(bottom))


def group_totals(mart: DataFrame, keys: list[str], sums: list[str], k: int | None = None) -> DataFrame:
    """Chart totals, largest first; k keeps the top rows of the report."""
    totals = mart.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in sums])
    return totals if k is None else totals.orderBy(F.desc(sums[0]), *keys).limit(k)


def share_of_total(mart: DataFrame, key: str, value: str) -> DataFrame:
    """Share of each key in the overall sum; the total is one row joined back."""
    totals = mart.groupBy(key).agg(F.sum(value).alias(value))
    overall = mart.agg(F.sum(value).alias("_all"))
    return totals.crossJoin(F.broadcast(overall)).select(key, value, ratio(F.col(value), F.col("_all")).alias("share"))


def incremental_rows(frame: DataFrame, stored: DataFrame | None, timestamp: str, lookback_days: int = 2) -> DataFrame:
    """Rows to merge into a stored mart: from its newest timestamp minus the lookback on; all when it is empty."""
    if stored is None:
        return frame
    newest = stored.agg((F.max(timestamp) - F.make_dt_interval(days=F.lit(lookback_days))).alias("_from"))
    bounded = frame.crossJoin(F.broadcast(newest))  # one row
    return bounded.filter(F.col("_from").isNull() | (F.col(timestamp) >= F.col("_from"))).drop("_from")


def popular_products(products: DataFrame, weight: str, page: int, size: int) -> DataFrame:
    """One page of the listing by popularity, unknown popularity last."""
    return products.orderBy(F.desc_nulls_last(weight), F.asc("product_id")).offset(page * size).limit(size)


def schema_name(custom: str | None, target: str) -> str:
    """Schema of a model: its own if it names one, else the target's."""
    return custom.strip() if custom and custom.strip() else target
