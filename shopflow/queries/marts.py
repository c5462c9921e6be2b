"""Marts, incremental merges and versioned tables."""

from pyspark.sql import functions as F

from shopflow.functions.hashing import bucket
from shopflow.operators import marts, versioned
from shopflow.plans.storage import materialize, scratch_path
from shopflow.queries.prelude import h
from shopflow.queries.registry import query

VIEWS = {
    "lines": """select i.order_item_id, i.order_id, i.product_id, o.user_id, o.session_id, o.order_timestamp, lower(o.status) order_status, i.quantity,
        i.discount_amount, i.line_amount, o.status is not null and lower(o.status) not in ('cancelled','refunded') is_valid_purchase
      from order_items i left join shop_orders o using (order_id)""",
    "staged_requests": """select request_id, user_id, session_id, request_timestamp, surface,
        nullif(case when json_valid(request_context) then json_extract_string(request_context, '$.experiment_id') end, '') experiment_id,
        nullif(case when json_valid(request_context) then json_extract_string(request_context, '$.variant') end, '') as variant from recommendation_requests""",
    "flags": """select impression_id, max((event_type='click')::int) has_click, max((event_type='cart')::int) has_cart, max((event_type='purchase')::int) has_purchase,
        min(event_timestamp) filter (event_type='click') clicked_at, min(event_timestamp) filter (event_type='cart') carted_at,
        min(event_timestamp) filter (event_type='purchase') purchased_at from behavior_events where impression_id is not null group by 1""",
    "outcomes": """select i.impression_id, i.candidate_product_id product_id, i.request_id, i.user_id, i.session_id, i.impression_timestamp, i.rank_position,
        i.candidate_source, r.experiment_id, r.variant, greatest(coalesce(f.has_click,0), coalesce(i.is_clicked,false)::int) has_click,
        coalesce(f.has_cart,0) has_cart, coalesce(f.has_purchase,0) has_purchase, f.clicked_at, f.carted_at, f.purchased_at
      from impressions i left join flags f using (impression_id) left join staged_requests r on r.request_id = i.request_id""",
    "funnels": """select strftime(impression_timestamp,'%Y-%m-%d') metric_date, session_id, user_id, count(*) impressions, sum(has_click)::bigint clicks,
        sum(has_cart)::bigint carts, sum(has_purchase)::bigint purchases from outcomes group by 1,2,3""",
    "daily": """select f.*, coalesce(r.revenue, 0)::double revenue, clicks/impressions::double ctr, purchases/nullif(clicks,0)::double click_to_purchase_cvr,
        purchases/impressions::double impression_to_purchase_cvr
      from (select metric_date, count(distinct session_id) sessions, count(distinct user_id) users, sum(impressions)::bigint impressions, sum(clicks)::bigint clicks,
          sum(carts)::bigint carts, sum(purchases)::bigint purchases from funnels group by 1) f
      left join (select strftime(order_timestamp,'%Y-%m-%d') metric_date, sum(case when is_valid_purchase then line_amount else 0 end) revenue from lines group by 1) r using (metric_date)""",
    "performance": """select strftime(o.impression_timestamp,'%Y-%m-%d') metric_date, o.product_id, p.category_id, p.category_code, p.brand_id, p.brand_name,
        count(*) impressions, sum(has_click)::bigint clicks, sum(has_cart)::bigint carts, sum(has_purchase)::bigint attributed_purchases,
        sum(has_click)/count(*)::double ctr, sum(has_purchase)/count(*)::double conversion_rate
      from outcomes o left join product_snapshots p on p.product_id = o.product_id and o.impression_timestamp >= p.valid_from
        and (p.valid_to is null or o.impression_timestamp < p.valid_to) group by all""",
}
OUTCOME_COLUMNS = [
    "impression_id", "product_id", "request_id", "user_id", "session_id", "impression_timestamp", "rank_position", "candidate_source",
    "experiment_id", "variant", "has_click", "has_cart", "has_purchase", "clicked_at", "carted_at", "purchased_at",
]


def outcomes(shop):
    return marts.impression_outcomes(
        marts.stg_impressions(shop.impressions), marts.stg_behavior_events(shop.behavior_events),
        marts.stg_requests(shop.recommendation_requests),
    ).select(*OUTCOME_COLUMNS)


def lines(shop):
    return marts.stg_orders(shop.order_items, shop.orders)


def daily(shop):
    return plain(marts.funnel_daily(marts.session_funnels(outcomes(shop)), lines(shop)))


def performance(shop):
    return plain(marts.product_performance_daily(outcomes(shop), marts.dim_product(shop.product_snapshots)))


def plain(frame):
    """Dates as text and money as double, as the SQL side returns them."""
    kinds = {f.name: f.dataType.simpleString() for f in frame.schema.fields}
    return frame.select(
        *[
            F.col(c).cast("string").alias(c) if k == "date" else F.col(c).cast("double").alias(c) if k.startswith("decimal") else F.col(c)
            for c, k in kinds.items()
        ]
    )


@query(
    "b8_staged_events",
    """select event_id, event_timestamp, user_id, session_id, request_id, impression_id, lower(event_type) event_type, product_id, category_id, brand_id,
      price::double price, coalesce(quantity, 1) quantity, device_type, source, campaign_id, order_id from behavior_events""",
)
def staged_events(shop):
    return plain(marts.stg_behavior_events(shop.behavior_events))


@query("b8_staged_impressions", "select * exclude (candidate_product_id, is_clicked), candidate_product_id product_id, is_clicked source_is_clicked from impressions")
def staged_impressions(shop):
    return marts.stg_impressions(shop.impressions)


@query("b8_staged_products", "select product_id, valid_from, valid_to, category_id, category_code, brand_id, brand_name, current_price::double current_price, price_bucket, is_active, valid_to is null is_current from product_snapshots")
def staged_products(shop):
    return plain(marts.dim_product(shop.product_snapshots))


@query("b8_staged_users", "select * exclude (segment), segment user_segment from users")
def staged_users(shop):
    return marts.stg_users(shop.users)


@query("h10_staged_requests", "select * from staged_requests", VIEWS)
def staged_requests(shop):
    return marts.stg_requests(shop.recommendation_requests)


@query(
    "c7_order_lines",
    "select order_item_id, order_id, product_id, user_id, session_id, order_timestamp, order_status, quantity, discount_amount::double discount_amount, line_amount::double line_amount, is_valid_purchase from lines",
    VIEWS,
)
def order_lines(shop):
    columns = ["order_item_id", "order_id", "product_id", "user_id", "session_id", "order_timestamp", "order_status", "quantity", "discount_amount", "line_amount", "is_valid_purchase"]
    return plain(lines(shop).select(*columns))


@query("d2_outcome_flags", "select * from flags", VIEWS)
def flags(shop):
    return marts.outcome_flags(marts.stg_behavior_events(shop.behavior_events))


@query("d3_c8_impression_outcomes", "select * from outcomes", VIEWS)
def outcome_rows(shop):
    return outcomes(shop)


@query("d4_session_funnels", "select * from funnels", VIEWS)
def session_funnels(shop):
    return plain(marts.session_funnels(outcomes(shop)))


@query(
    "d5_daily_distinct_funnel",
    "select metric_date, sessions, users, impressions, clicks, carts, purchases from daily",
    VIEWS,
)
def distinct_funnel(shop):
    return daily(shop).select("metric_date", "sessions", "users", "impressions", "clicks", "carts", "purchases")


@query(
    "d6_daily_revenue",
    "select strftime(order_timestamp,'%Y-%m-%d') metric_date, sum(case when is_valid_purchase then line_amount else 0 end)::double revenue from lines group by 1",
    VIEWS,
)
def revenue(shop):
    return plain(marts.daily_revenue(lines(shop)))


@query("d7_c10_funnel_daily", "select * from daily", VIEWS)
def funnel_mart(shop):
    return daily(shop)


@query(
    "d8_c9_experiment_daily",
    """select strftime(impression_timestamp,'%Y-%m-%d') metric_date, experiment_id, variant, coalesce(u.segment,'unknown') user_segment,
      count(distinct o.user_id) users, count(*) impressions, sum(has_click)::bigint clicks, sum(has_cart)::bigint carts, sum(has_purchase)::bigint purchases,
      sum(has_click)/count(*)::double ctr, sum(has_purchase)/count(*)::double conversion_rate
    from outcomes o left join users u on u.user_id = o.user_id where experiment_id is not null and variant is not null group by 1,2,3,4""",
    VIEWS,
)
def experiment_mart(shop):
    return plain(marts.experiment_daily(outcomes(shop), marts.stg_users(shop.users)))


@query("d9_product_performance_daily", "select * from performance", VIEWS)
def product_mart(shop):
    return performance(shop)


@query(
    "d10_weighted_rates",
    """select category_code, 100.0::double * sum(clicks)::double / nullif(sum(impressions)::double, 0) ctr_pct,
      100.0::double * sum(attributed_purchases)::double / nullif(sum(impressions)::double, 0) cvr_pct from performance group by 1""",
    VIEWS,
)
def weighted(shop):
    return performance(shop).groupBy("category_code").agg(
        marts.weighted_rate("clicks", "impressions").alias("ctr_pct"), marts.weighted_rate("attributed_purchases", "impressions").alias("cvr_pct")
    )


@query(
    "d11_top_brands_by_clicks",
    "select brand_name, sum(clicks)::bigint clicks, sum(impressions)::bigint impressions from performance group by 1 order by 2 desc, 1 limit 10",
    VIEWS,
)
def top_brands(shop):
    return marts.group_totals(performance(shop), ["brand_name"], ["clicks", "impressions"], 10)


@query(
    "d11_totals_by_date",
    "select metric_date, sum(impressions)::bigint impressions, sum(clicks)::bigint clicks from performance group by 1",
    VIEWS,
)
def totals_by_date(shop):
    return marts.group_totals(performance(shop), ["metric_date"], ["impressions", "clicks"])


@query(
    "d12_category_click_share",
    "select category_code, sum(clicks)::bigint clicks, sum(clicks)::double / (select sum(clicks) from performance)::double share from performance group by 1",
    VIEWS,
)
def category_share(shop):
    return marts.share_of_total(materialize(performance(shop), "mart"), "category_code", "clicks")


@query(
    "b18_dashboard_percentages",
    """select metric_date, sessions, users, impressions, clicks, carts, purchases, revenue, ctr*100.0::double ctr_pct,
      click_to_purchase_cvr*100.0::double click_to_purchase_cvr_pct, impression_to_purchase_cvr*100.0::double impression_to_purchase_cvr_pct from daily""",
    VIEWS,
)
def percentages(shop):
    rates = ("ctr", "click_to_purchase_cvr", "impression_to_purchase_cvr")
    return marts.percent_columns(daily(shop), {c: f"{c}_pct" for c in rates})


@query(
    "g1_funnel_stages",
    """select metric_date, '1. Impressions' stage, 1 stage_order, impressions stage_value from daily union all select metric_date, '2. Clicks', 2, clicks from daily
    union all select metric_date, '3. Carts', 3, carts from daily union all select metric_date, '4. Purchases', 4, purchases from daily""",
    VIEWS,
)
def stages(shop):
    return marts.funnel_stages(daily(shop))


@query(
    "f7_popular_products_page",
    "select product_id, product_name, popularity_weight from products order by popularity_weight desc nulls last, product_id limit 20 offset 20",
)
def popular_page(shop):
    return marts.popular_products(shop.products.select("product_id", "product_name", "popularity_weight"), "popularity_weight", 1, 20)


@query(
    "k20_incremental_order_items",
    "select order_item_id, order_id, order_timestamp, order_status, line_amount::double line_amount, is_valid_purchase from lines",
    VIEWS,
)
def incremental_lines(shop):
    """A mart loaded up to day 20 and then merged forward equals one full load; lines without a header come with the first."""
    columns = ["order_item_id", "order_id", "order_timestamp", "order_status", "line_amount", "is_valid_purchase"]
    full = materialize(lines(shop).select(*columns), "lines")
    first = F.col("order_timestamp").isNull() | (F.col("order_timestamp") <= F.lit("2024-01-20").cast("timestamp"))
    stored = full.filter(first)
    changes = marts.incremental_rows(full, stored, "order_timestamp")
    return plain(versioned.merge(stored, changes, ["order_item_id"], "order_timestamp"))


@query("k20_incremental_impressions", "select impression_id, product_id, impression_timestamp, has_click, has_purchase from outcomes", VIEWS)
def incremental_impressions(shop):
    columns = ["impression_id", "product_id", "impression_timestamp", "has_click", "has_purchase"]
    full = materialize(outcomes(shop).select(*columns), "impressions")
    stored = full.filter(F.col("impression_timestamp") < F.lit("2024-01-21").cast("timestamp")).withColumn("has_click", F.lit(0))
    stored = stored.filter(F.col("impression_timestamp") >= F.lit("2024-01-19").cast("timestamp")).unionByName(
        full.filter(F.col("impression_timestamp") < F.lit("2024-01-19").cast("timestamp"))
    )
    return versioned.merge(stored, marts.incremental_rows(full, stored, "impression_timestamp"), ["impression_id", "product_id"], "impression_timestamp")


STATE_SQL = {
    "state_a": f"""select impression_id, candidate_product_id target_item_id, user_id, case when {h("'split:'||impression_id")} % 100 < 80 then 'train' else 'test' end split,
      timestamp '2024-02-01' source_updated_at from impressions""",
    "state_b": f"""select impression_id, target_item_id, user_id, case when {h("'move:'||impression_id")} % 100 < 10 then 'val' else split end split,
      timestamp '2024-02-02' source_updated_at from state_a where {h("'drop:'||impression_id")} % 100 >= 14""",
}
KEYS = ["impression_id", "target_item_id"]


def states(shop):
    """Two states of a sample set: the second loses some rows and moves others to another split."""
    name = F.col("impression_id")
    a = shop.impressions.select(
        "impression_id", F.col("candidate_product_id").alias("target_item_id"), "user_id",
        F.when(bucket(F.concat(F.lit("split:"), name)) < 80, "train").otherwise("test").alias("split"),
        F.lit("2024-02-01").cast("timestamp").alias("source_updated_at"),
    )
    b = (
        a.filter(bucket(F.concat(F.lit("drop:"), name)) >= 14)
        .withColumn("split", F.when(bucket(F.concat(F.lit("move:"), name)) < 10, "val").otherwise(F.col("split")))
        .withColumn("source_updated_at", F.lit("2024-02-02").cast("timestamp"))
    )
    return a, b


@query(
    "c11_g2_delta_with_tombstones",
    """select impression_id, target_item_id, split, false is_deleted from state_b union all
    select a.impression_id, a.target_item_id, a.split, true from state_a a where not exists (select 1 from state_b b where b.impression_id = a.impression_id and b.target_item_id = a.target_item_id)""",
    STATE_SQL,
)
def tombstones(shop):
    a, b = states(shop)
    return versioned.delta(a, b, KEYS, "source_updated_at", "2024-02-02").select(*KEYS, "split", "is_deleted")


@query("k17_key_merge", "select * from state_b", STATE_SQL)
def key_merge(shop):
    a, b = states(shop)
    return versioned.merge(a, versioned.delta(a, b, KEYS, "source_updated_at", "2024-02-02"), KEYS, "source_updated_at")


def committed(shop):
    table = versioned.VersionedTable(shop.spark, scratch_path(shop.spark, "samples"), KEYS, "source_updated_at")
    a, b = states(shop)
    table.commit(a, "run-a", "2024-02-01")
    table.commit(b, "run-b", "2024-02-02")
    table.commit(b, "run-b", "2024-02-02")
    return table


@query(
    "k18_commits",
    """select 1 as version, 'run-a' run_id, count(*) upserts, 0::bigint deletes, count(*) as rows from state_a union all
    select 2, 'run-b', (select count(*) from state_b), (select count(*) from state_a) - (select count(*) from state_b), (select count(*) from state_b)""",
    STATE_SQL,
)
def commits(shop):
    return committed(shop).commits().select("version", "run_id", "upserts", "deletes", "rows")


@query("k18_time_travel", "select * from state_a", STATE_SQL)
def time_travel(shop):
    return committed(shop).read(1)


@query("k19_savepoint", "select v as version, v = 1 saved from (values (1),(2)) t(v)")
def savepoint(shop):
    table = committed(shop)
    table.savepoint(1)
    return table.commits().select("version", "saved")


@query("d21_split_counts", "select split, count(*) as rows from state_b group by 1", STATE_SQL)
def split_counts(shop):
    return states(shop)[1].groupBy("split").agg(F.count(F.lit(1)).alias("rows"))


@query(
    "g2_changes_between_versions",
    """select kind, count(*) as keys from (select case when b.split is null then 'removed' when a.split is null then 'added' when a.split <> b.split then 'changed' else 'unchanged' end kind
      from state_a a full join state_b b using (impression_id, target_item_id)) group by 1""",
    STATE_SQL,
)
def version_changes(shop):
    a, b = states(shop)
    return versioned.changes_between(a, b, KEYS, "split")


@query("a13_row_upsert_sink", f"select user_id, session_id, case when {h("'s:'||session_id")} % 100 < 30 then 'new' else 'old' end state from sessions")
def upsert_sink(shop):
    rows = shop.sessions.select("user_id", "session_id", F.col("session_end_ts").alias("updated_at"))
    newer = rows.filter(bucket(F.concat(F.lit("s:"), "session_id")) < 30).withColumn("state", F.lit("new"))
    merged = versioned.merge(rows.withColumn("state", F.lit("old")), newer, ["user_id", "session_id"], "updated_at")
    return merged.select("user_id", "session_id", "state")


@query("a13_insert_or_ignore", "select distinct event_id, 'late' reason from raw_events")
def insert_or_ignore(shop):
    rows = shop.raw_events.select("event_id", F.lit("late").alias("reason"))
    stored = versioned.insert_missing(None, rows.filter(bucket(F.col("event_id")) < 50), ["event_id", "reason"])
    return stored.unionByName(versioned.insert_missing(stored, rows, ["event_id", "reason"]))
