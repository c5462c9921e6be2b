"""Drift of features between a baseline and current rows."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shopflow.functions.dates import drift_factor, drift_status
from shopflow.operators.clean import numeric_feature_columns, recent_rows
from shopflow.plans.quantiles import quantiles
from shopflow.plans.storage import materialize

EPSILON = 1e-4
THRESHOLD = 0.15


def long_features(frame: DataFrame, features: list[str], keep: list[str] | None = None) -> DataFrame:
    """One row per finite feature value; a single scan for all features."""
    keep = keep or []
    cells = frame.select(*keep, *[F.col(c).cast("double").alias(c) for c in features]).unpivot(keep, features, "feature", "value")
    return cells.filter(F.col("value").isNotNull() & ~F.isnan("value") & (F.abs("value") != F.lit(float("inf"))))


def _edges(baseline: DataFrame, current: DataFrame, closed: bool, buckets: int, approximate: bool) -> DataFrame:
    """Sorted inner structure of the histogram per feature: one small row each, as many as features."""
    levels = [i / buckets for i in range(buckets + 1)]
    if approximate:
        cuts = baseline.groupBy("feature").agg(F.percentile_approx("value", levels, 10000).alias("cuts"))
    else:
        points = quantiles(baseline, ["feature"], "value", levels)
        cuts = points.groupBy("feature").agg(
            F.transform(F.sort_array(F.collect_list(F.struct("probability", "quantile"))), lambda x: x["quantile"]).alias("cuts")
        )
    bounds = lambda frame, name: frame.groupBy("feature").agg(
        F.min("value").alias(f"{name}_min"), F.max("value").alias(f"{name}_max"), F.count(F.lit(1)).alias(f"{name}_n")
    )
    both = cuts.join(bounds(baseline, "b"), "feature").join(bounds(current, "c"), "feature")
    low, high = F.least("b_min", "c_min"), F.greatest("b_max", "c_max")
    if closed:
        unique = F.array_sort(F.array_distinct("cuts"))
        spread = F.array(low, (low + high) / 2, high)
        edges = F.when(F.size(unique) >= 3, unique).otherwise(F.when(low < high, spread))
    else:
        inner = F.array_sort(F.array_distinct(F.slice("cuts", 2, buckets - 1)))
        inner = F.filter(inner, lambda x: (x > F.col("b_min")) & (x < F.col("b_max")))
        edges = F.when(F.size(inner) > 0, inner).otherwise(F.when(low < high, F.array((low + high) / 2)))
    return both.select("feature", edges.alias("edges"), "b_n", "c_n")


def _bucket(closed: bool) -> Column:
    """Bucket of a value; null when it lies outside closed edges."""
    value, edges = F.col("value"), F.col("edges")
    below = F.size(F.filter(edges, lambda e: e <= value))
    if not closed:
        return below
    last = F.size(edges) - 1
    inside = (value >= edges[0]) & (value <= F.element_at(edges, -1))
    return F.when(inside, F.least(below - 1, last - 1))


def psi(
    baseline: DataFrame, current: DataFrame, *, closed: bool = True, buckets: int = 10, approximate: bool = False,
    by: list[str] | None = None,
) -> DataFrame:
    """Population stability index per feature from long frames (feature, value).

    Edges are the baseline's deciles. closed leaves out values beyond them and takes shares of the
    counted ones; otherwise the outer buckets are open and shares are of all values. by scores slices
    of the current rows, such as days, against the same edges. approximate swaps exact deciles for a sketch.
    """
    by = by or []
    edges = materialize(_edges(baseline, current, closed, buckets, approximate), "edges")  # read by several branches

    def histogram(frame: DataFrame, keys: list[str]) -> DataFrame:
        placed = frame.join(F.broadcast(edges), "feature")  # one row per feature column
        return placed.withColumn("bucket", _bucket(closed)).filter(F.col("bucket").isNotNull()).groupBy(
            *keys, "feature", "bucket"
        ).agg(F.count(F.lit(1)).alias("n"))

    expected = histogram(baseline, [])
    actual = histogram(current, by)
    total = lambda frame, keys, name: frame.groupBy(*keys, "feature").agg(F.sum("n").alias(name))
    cells = edges.withColumn("bucket", F.explode(F.sequence(F.lit(0), F.size("edges") - (2 if closed else 0)))).select(
        "feature", "bucket"
    )
    e = cells.join(expected.withColumnRenamed("n", "e"), ["feature", "bucket"], "left").join(total(expected, [], "e_all"), "feature", "left")
    slices = total(current.groupBy(*by, "feature").agg(F.count(F.lit(1)).alias("n")), by, "_rows").drop("_rows")
    grid = slices.join(F.broadcast(e), "feature")
    full = grid.join(actual.withColumnRenamed("n", "a"), [*by, "feature", "bucket"], "left").join(
        total(actual, by, "a_all"), [*by, "feature"], "left"
    )
    share = lambda n, n_all: F.greatest(
        F.coalesce(F.col(n), F.lit(0)) / F.greatest(F.coalesce(F.col(n_all), F.lit(1)), F.lit(1)), F.lit(EPSILON)
    )
    p, q = share("e", "e_all"), share("a", "a_all")
    scored = full.groupBy(*by, "feature").agg(F.sum((q - p) * F.log(q / p)).alias("psi"))
    # Features whose values never differ have no edges and no drift.
    return slices.join(scored, [*by, "feature"], "left").withColumn("psi", F.coalesce("psi", F.lit(0.0)))


def sample_rows(frame: DataFrame, n: int, seed_column: str) -> DataFrame:
    """n rows picked by a hash order: the report's sampling, the same rows on every run."""
    return frame.orderBy(F.xxhash64(seed_column), seed_column).limit(n)


def drift_report(
    baseline: DataFrame | None, current: DataFrame, table: str, *, days: int = 7, sample: int | None = None,
    seed_column: str = "event_id", threshold: float = THRESHOLD, approximate: bool = False,
) -> DataFrame:
    """One line per numeric feature both frames share. Without a baseline the current rows become it and pass."""
    recent = recent_rows(current, days)
    if sample:
        recent = sample_rows(recent, sample, seed_column)
    reference = recent if baseline is None else baseline
    shared = sorted(set(numeric_feature_columns(reference)) & set(numeric_feature_columns(recent)))
    scores = psi(long_features(reference, shared), long_features(recent, shared), approximate=approximate)
    sizes = reference.agg(F.count(F.lit(1)).alias("reference_rows")).crossJoin(
        recent.agg(F.count(F.lit(1)).alias("current_rows"))
    )  # one row each
    return scores.crossJoin(F.broadcast(sizes)).select(
        F.lit(table).alias("feature_table"), "feature", F.col("psi").alias("drift_score"), (F.col("psi") < threshold).alias("passed"),
        "reference_rows", "current_rows", F.lit(threshold).alias("threshold"),
    )


def failed_features(report: DataFrame) -> DataFrame:
    return report.filter(~F.col("passed")).select("feature_table", "feature", "drift_score")


DAILY_FEATURES = {
    "f_user_purchase_count_90d": "purchases",
    "f_user_total_orders_90d": "orders",
    "f_user_interaction_count_90d": "interactions",
}


def user_daily_features(
    events: DataFrame, orders: DataFrame, users: DataFrame, first_day: str, days: int, window: int = 90
) -> DataFrame:
    """Trailing sums over `window` days for every active user and day of the period, days without activity included.

    Activity is combined per user and day before the grid is joined, so a user's window holds one row
    per day however active the user is. Activity before the period counts as far as the window reaches back.
    """
    day = lambda c: F.to_date(c).alias("feature_date")
    activity = (
        events.groupBy("user_id", day("event_timestamp"))
        .agg(F.count(F.lit(1)).alias("interactions"), F.count_if(F.col("event_type") == "purchase").alias("purchases"))
        .join(
            orders.groupBy("user_id", day("order_timestamp")).agg(F.count(F.lit(1)).alias("orders")),
            ["user_id", "feature_date"],
            "full",
        )
    )
    period = F.sequence(F.lit(first_day).cast("date"), F.date_add(F.lit(first_day).cast("date"), days - 1))
    first, last = F.lit(first_day).cast("date"), F.date_add(F.lit(first_day).cast("date"), days - 1)
    active = users.filter("is_active").select("user_id")
    grid = active.select("user_id", F.explode(period).alias("feature_date"), F.lit(True).alias("_asked"))
    near = activity.filter(F.col("feature_date").between(F.date_sub(first, window - 1), last)).join(active, "user_id", "left_semi")
    filled = grid.join(near, ["user_id", "feature_date"], "full").withColumn("_day", F.datediff("feature_date", first))
    trailing = Window.partitionBy("user_id").orderBy("_day").rangeBetween(-(window - 1), 0)
    summed = filled.select(
        "user_id", "feature_date", "_asked",
        *[F.sum(F.coalesce(source, F.lit(0))).over(trailing).alias(name) for name, source in DAILY_FEATURES.items()],
    )
    return summed.filter("_asked").drop("_asked")


def feature_health(daily: DataFrame) -> DataFrame:
    """Mean and population deviation per feature and day."""
    cells = long_features(daily, list(DAILY_FEATURES), ["feature_date"])
    return cells.groupBy("feature_date", "feature").agg(F.avg("value").alias("mean"), F.stddev_pop("value").alias("stddev"))


def health_and_drift(
    daily: DataFrame, baseline: tuple[str, str], drift_start: str, ramp_days: int, multiplier: float
) -> DataFrame:
    """Daily health with the open-edge PSI against the baseline period, its status and the planned factor."""
    low, high = (F.lit(d).cast("date") for d in baseline)
    cells = long_features(daily, list(DAILY_FEATURES), ["feature_date"])
    reference = cells.filter(F.col("feature_date").between(low, high)).select("feature", "value")
    scores = psi(reference, cells, closed=False, by=["feature_date"])
    is_baseline = F.col("feature_date").between(low, high)
    return (
        feature_health(daily).join(scores, ["feature_date", "feature"])
        .withColumn("drift_status", drift_status(F.col("psi"), is_baseline))
        .withColumn("drift_factor", drift_factor(F.col("feature_date"), drift_start, ramp_days, multiplier))
    )


def drift_alerts(health: DataFrame, drift_start: str, threshold: float = THRESHOLD) -> DataFrame:
    wanted = (F.col("psi") >= threshold) & (F.col("drift_status") != "baseline") & (F.col("feature_date") >= F.lit(drift_start).cast("date"))
    return health.filter(wanted).select(
        F.col("feature_date").alias("alert_date"), F.col("feature").alias("feature_name"), F.col("psi").alias("psi_value"), "drift_factor"
    )


def recount_differences(stored: DataFrame, recounted: DataFrame) -> DataFrame:
    """Stored rolling features that differ from a recount, or exist on one side only."""
    names = list(DAILY_FEATURES)
    a = stored.select("user_id", "feature_date", *[F.col(c).alias(f"s_{c}") for c in names])
    b = recounted.select("user_id", "feature_date", *[F.col(c).alias(f"r_{c}") for c in names])
    same = F.lit(True)
    for c in names:
        same = same & F.col(f"s_{c}").eqNullSafe(F.col(f"r_{c}"))
    return a.join(b, ["user_id", "feature_date"], "full").filter(~same)


def conversion_rate(events: DataFrame, start: str, end: str | None = None) -> DataFrame:
    """Purchases per cart of a period, zero without carts."""
    day = F.to_date("event_timestamp")
    chosen = day >= F.lit(start).cast("date")
    if end is not None:
        chosen = chosen & (day <= F.lit(end).cast("date"))
    counts = events.filter(chosen).agg(
        F.count_if(F.col("event_type") == "cart").alias("carts"), F.count_if(F.col("event_type") == "purchase").alias("purchases")
    )
    return counts.withColumn("conversion_rate", F.coalesce(F.try_divide("purchases", "carts"), F.lit(0.0)))


def post_drift_labels(users: DataFrame, orders: DataFrame, since: str) -> DataFrame:
    """1 for users with an order on or after the date."""
    bought = orders.filter(F.to_date("order_timestamp") >= F.lit(since).cast("date")).groupBy("user_id").agg(
        F.count(F.lit(1)).alias("orders_after")
    )
    joined = users.select("user_id").join(bought, "user_id", "left").withColumn("orders_after", F.coalesce("orders_after", F.lit(0)))
    return joined.withColumn("label", (F.col("orders_after") > 0).cast("int"))


def latest_features_with_labels(daily: DataFrame, labels: DataFrame) -> DataFrame:
    newest = daily.agg(F.max("feature_date").alias("_newest"))
    latest = daily.join(F.broadcast(newest), F.col("feature_date") == F.col("_newest")).drop("_newest")  # one row
    return latest.join(labels, "user_id")
