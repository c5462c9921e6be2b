"""Online view tables: newest row per entity, lookups with fallback, candidate pools, materialization."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shopflow.plans.hot_keys import top_k

# Days an online row stays valid, per view.
TTL_SECONDS = {"user_sequence": 90 * 86400, "user_aggregate": 86400, "item": 7 * 86400}
POOL_LIMIT = 100


def json_payload(columns: dict[str, Column]) -> Column:
    """JSON text with sorted keys; NaN and infinities become null, nulls are written out."""
    fields = []
    for name in sorted(columns):
        value = columns[name]
        text = value.cast("string")
        fields.append(F.when(~F.coalesce(text.isin("NaN", "Infinity", "-Infinity"), F.lit(False)), value).alias(name))
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})


def newest_wins(current: DataFrame | None, updates: DataFrame, key: str, view: str) -> DataFrame:
    """Online rows after the updates: newest updated_at per key, equal times overwrite; expires_at from the TTL."""
    ttl = F.make_dt_interval(secs=F.lit(TTL_SECONDS[view]))
    fresh = updates.withColumn("expires_at", F.col("updated_at") + ttl).withColumn("_turn", F.lit(1))
    rows = fresh if current is None else current.withColumn("_turn", F.lit(0)).unionByName(fresh, allowMissingColumns=True)
    order = [F.desc("updated_at"), F.desc("_turn"), F.desc("payload")]
    return top_k(rows, [key], order, 1, "_rank").drop("_rank", "_turn")


def lookup_with_fallback(keys: DataFrame, realtime: DataFrame, batch: DataFrame, key: str) -> DataFrame:
    """Realtime row of each key, else its batch row, with where it came from."""
    r = realtime.select(key, F.col("payload").alias("_realtime"))
    b = batch.select(key, F.col("payload").alias("_batch"))
    joined = keys.join(r, key, "left").join(b, key, "left")
    origin = F.when(F.col("_realtime").isNotNull(), "realtime").when(F.col("_batch").isNotNull(), "batch").otherwise("none")
    return joined.select(key, F.coalesce("_realtime", "_batch").alias("payload"), origin.alias("origin"))


def trending_score(views_1h: Column, carts_1h: Column, purchases_24h: Column) -> Column:
    return (views_1h + carts_1h * 3 + purchases_24h * 10).cast("double")


def pool_updates(items: DataFrame) -> DataFrame:
    """Four pool entries per item row: trending and popular, overall and in its category."""
    category = F.col("category_id").cast("string")
    score = trending_score(F.col("views_1h"), F.col("carts_1h"), F.col("purchases_24h"))
    popular = F.coalesce(F.col("popularity_score"), score)
    pools = {
        "candidate:trending:1h": (F.lit(""), score),
        "candidate:trending:category:": (category, score),
        "candidate:popular:global": (F.lit(""), popular),
        "candidate:popular:category:": (category, popular),
    }
    entries = F.array(
        *[F.struct(F.concat(F.lit(n), part).alias("pool_key"), value.alias("score")) for n, (part, value) in pools.items()]
    )
    return items.select("product_id", "feature_timestamp", "event_id", F.inline(entries))


def candidate_pools(updates: DataFrame, limit: int = POOL_LIMIT) -> DataFrame:
    """Bounded pools: the newest score of each member, best members first."""
    newest = top_k(
        updates, ["pool_key", "product_id"], [F.desc("feature_timestamp"), F.desc("event_id")], 1, "_rank"
    )
    return top_k(
        newest.select("pool_key", "product_id", "score"), ["pool_key"], [F.desc("score"), F.desc("product_id")], limit
    )


def user_pools(pools: DataFrame, interactions: DataFrame, limit: int = POOL_LIMIT) -> DataFrame:
    """Personal pools: popular products of the categories a user touched, best score per product."""
    touched = interactions.select("user_id", "category_id").distinct()
    popular = pools.filter(F.col("pool_key").startswith("candidate:popular:category:")).select(
        F.regexp_extract("pool_key", r"(\d+)$", 1).cast("bigint").alias("category_id"), "product_id", "score"
    )
    scored = touched.join(popular, "category_id").groupBy("user_id", "product_id").agg(F.max("score").alias("score"))
    return top_k(scored, ["user_id"], [F.desc("score"), F.desc("product_id")], limit)


def candidates(users: DataFrame, personal: DataFrame, pools: DataFrame, limit: int) -> DataFrame:
    """Personal candidates, or the global pool for users without any. The global part is limit rows."""
    mine = personal.filter(F.col("rank") <= limit).select("user_id", "product_id", F.col("rank").alias("position"))
    overall = (
        pools.filter((F.col("pool_key") == "candidate:popular:global") & (F.col("rank") <= limit))
        .agg(F.sort_array(F.collect_list(F.struct(F.col("rank").alias("position"), "product_id"))).alias("_pool"))
    )  # one row of at most limit entries
    cold = users.select("user_id").distinct().join(mine.select("user_id").distinct(), "user_id", "left_anti")
    fallback = cold.crossJoin(F.broadcast(overall)).select("user_id", F.inline("_pool"))
    known = mine.join(users.select("user_id").distinct(), "user_id", "left_semi")
    return known.unionByName(fallback.select("user_id", "product_id", F.col("position").cast("int").alias("position")))


def first_occurrences(lists: DataFrame, key: str, array: str, limit: int) -> DataFrame:
    """Candidate lists without repeats, in first-seen order, at most limit long. Each list is one row."""
    return lists.select(key, F.slice(F.array_distinct(array), 1, limit).alias(array))


def lookup_in_order(requests: DataFrame, ids: str, rows: DataFrame, key: str) -> DataFrame:
    """Rows of requested ids with their place in the request; unknown ids keep a null row."""
    asked = requests.select("*", F.posexplode(ids).alias("position", key)).drop(ids)
    return asked.join(rows, key, "left")


def online_features(asked: DataFrame, pools: DataFrame, personal: DataFrame, items: DataFrame, users: DataFrame, top: int) -> DataFrame:
    """Model input per (user, candidate): given candidates, else five times top from the pools."""
    given = asked.filter(F.size("candidates") > 0).select("user_id", F.posexplode("candidates").alias("position", "product_id"))
    given = given.withColumn("position", F.col("position") + 1)
    open_users = asked.filter(F.coalesce(F.size("candidates"), F.lit(0)) <= 0)
    found = candidates(open_users, personal, pools, top * 5)
    wanted = given.unionByName(found)
    return wanted.join(items, "product_id", "left").join(users, "user_id", "left")


def source_bounds(tables: list[DataFrame], timestamp: str = "feature_timestamp") -> DataFrame:
    """Earliest and latest feature time over several tables, widened by a microsecond."""
    spans = [t.agg(F.min(timestamp).alias("low"), F.max(timestamp).alias("high")) for t in tables]
    merged = spans[0]
    for span in spans[1:]:
        merged = merged.unionByName(span)
    micro = F.expr("INTERVAL 0.000001 SECOND")
    return merged.agg((F.min("low") - micro).alias("start_ts"), (F.max("high") + micro).alias("end_ts"))


def materialize_increment(
    online: DataFrame | None, source: DataFrame, key: str, last_end: str | None, end: str, view: str
) -> DataFrame:
    """Online table after merging the source rows in (last_end, end]; without last_end it is rebuilt."""
    rows = source.filter(F.col("feature_timestamp") <= F.lit(end).cast("timestamp"))
    if last_end is not None:
        rows = rows.filter(F.col("feature_timestamp") > F.lit(last_end).cast("timestamp"))
    updates = rows.withColumn("updated_at", F.col("feature_timestamp")).drop("feature_timestamp")
    return newest_wins(online if last_end is not None else None, updates, key, view)


def materialization_mode(watermarks: list, end, valid_after) -> tuple[str, bool]:
    """Which run to make: (mode, rebuild). valid_after(mode) reports whether the online store then checks out.

    A watermark beyond the source means the store is ahead of its data and must be rebuilt; a failed
    check after an increment rebuilds too.
    """
    if not watermarks:
        raise ValueError("no online views are registered")
    if any(w is not None and w > end for w in watermarks):
        mode, rebuild = "full_watermark_recovery", True
    elif any(w is None or w < end for w in watermarks):
        mode, rebuild = "incremental", False
    else:
        mode, rebuild = "noop", False
    if valid_after(mode):
        return mode, rebuild
    mode = "full_online_store_recovery"
    if not valid_after(mode):
        raise RuntimeError("online store is invalid after recovery")
    return mode, True


def recommendation_rows(recommendations: DataFrame, existing: DataFrame, shown_at: Column) -> DataFrame:
    """Impression rows of ranked lists, skipping ids that were recorded before."""
    listed = recommendations.select("request_id", "user_id", "session_id", F.posexplode("items").alias("_place", "_item"))
    rows = listed.select(
        F.col("_item.impression_id").alias("impression_id"),
        "request_id",
        "user_id",
        "session_id",
        shown_at.alias("impression_timestamp"),
        F.col("_item.item_id").alias("candidate_product_id"),
        (F.col("_place") + 1).alias("rank_position"),
        F.lit("bst_online_ranking").alias("candidate_source"),
        F.col("_item.score").alias("retrieval_score"),
        F.col("_item.score").alias("ranking_score"),
        F.lit("home").alias("surface"),
        F.lit(False).alias("is_clicked"),
        F.lit(2).alias("schema_version"),
    )
    once = top_k(rows, ["impression_id"], [F.asc("request_id"), F.asc("rank_position")], 1, "_rank").drop("_rank")
    return once.join(existing.select("impression_id"), "impression_id", "left_anti")
