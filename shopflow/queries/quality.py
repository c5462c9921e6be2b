"""Profiles, integrity and data checks."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopflow.operators import aggregates, quality
from shopflow.operators.quality import Check
from shopflow.queries.registry import query


@query(
    "d16_duplicate_profile",
    """select sum(n)::bigint raw_rows, count(*) distinct_ids, sum(n-1)::bigint extra_rows, sum(n-p)::bigint exact_duplicate_rows
    from (select event_id, count(*) n, count(distinct payload_hash) p from raw_events group by 1)""",
)
def duplicates(shop):
    return quality.duplicate_profile(shop.raw_events, "event_id", "payload_hash")


@query(
    "k35_conflicting_duplicates",
    "select event_id, count(distinct payload_hash) payloads, count(*) as rows from raw_events group by 1 having count(distinct payload_hash) > 1",
)
def conflicts(shop):
    return quality.conflicting_ids(shop.raw_events, "event_id", "payload_hash")


@query(
    "d14_cardinality_profile",
    """select c column_name, n as rows, d distinct_values, d / n::double distinct_ratio from (
      select 'user_id' c, count(*) n, count(distinct user_id) d from behavior_events union all
      select 'product_id', count(*), count(distinct product_id) from behavior_events union all
      select 'session_id', count(*), count(distinct session_id) from behavior_events)""",
)
def cardinality(shop):
    return quality.cardinality_profile(shop.behavior_events, ["user_id", "product_id", "session_id"])


@query(
    "d15_top_values",
    """select column_name, value, n as rows, 100.0::double * n / total as percent, r::int as rank from (
      select *, row_number() over (partition by column_name order by n desc, value) r, sum(n) over (partition by column_name)::bigint total from (
        select column_name, value, count(*) n from (select 'event_type' column_name, event_type as value from behavior_events union all
          select 'product_id', product_id::varchar from behavior_events union all select 'device_type', device_type from behavior_events where device_type is not null) group by 1, 2))
    where r <= 5""",
)
def frequent_values(shop):
    events = shop.behavior_events.withColumn("device_type", F.coalesce("device_type", F.lit("")))
    rows = quality.top_values(events.select("event_type", "product_id"), ["event_type", "product_id"])
    devices = quality.top_values(events.filter("device_type <> ''").select("device_type"), ["device_type"])
    return rows.unionByName(devices)


@query(
    "d17_schema_evolution",
    """select case when event_timestamp < timestamp '2024-01-10' then 'early' when event_timestamp < timestamp '2024-01-20' then 'middle' else 'late' end phase,
      count(*) as rows, array_to_string(list_sort(list(distinct schema_version)), ',') versions,
      avg((device_type is null)::int) device_type_null_rate, avg((campaign_id is null)::int) campaign_id_null_rate from behavior_events group by 1""",
)
def evolution(shop):
    at = F.col("event_timestamp")
    phase = F.when(at < F.lit("2024-01-10").cast("timestamp"), "early").when(at < F.lit("2024-01-20").cast("timestamp"), "middle").otherwise("late")
    return quality.schema_evolution(shop.behavior_events, phase, ["device_type", "campaign_id"])


@query(
    "d18_order_reconciliation",
    """select o.order_id, o.net_amount::double net_amount, i.net::double item_net, case when i.net is null then 'no_items' else 'totals_differ' end problem
    from shop_orders o left join (select order_id, sum(gross) gross, sum(discount_amount) discount, sum(line_amount) net from order_items group by 1) i using (order_id)
    where i.net is null or o.gross_amount <> i.gross or o.discount_amount <> i.discount or o.net_amount <> i.net""",
)
def reconciliation(shop):
    rows = quality.order_totals(shop.orders, shop.order_items)
    return rows.select("order_id", F.col("net_amount").cast("double").alias("net_amount"), F.col("item_net").cast("double").alias("item_net"), "problem")


def check_rows(name, sql_value, good, expected="0"):
    return f"select '{name}' check_name, case when {good} then 'SUCCESS' else 'FAILED' end status, '{expected}' expected, ({sql_value})::varchar observed"


@query(
    "k22_declarative_checks",
    """select 'events' table_name, * from (
      select 'not_null(user_id,product_id)' check_name, case when sum((user_id is null or product_id is null)::int) = 0 then 'SUCCESS' else 'FAILED' end status, '0' expected,
        sum((user_id is null or product_id is null)::int)::bigint::varchar observed from raw_events
      union all select 'accepted_values(event_type)', case when sum((event_type not in ('view','cart','purchase'))::int) = 0 then 'SUCCESS' else 'FAILED' end, '0',
        sum((event_type not in ('view','cart','purchase'))::int)::bigint::varchar from raw_events
      union all select 'row_count()', 'SUCCESS', '>=1', count(*)::varchar from raw_events
      union all select 'freshness(event_timestamp)', case when a <= 26 then 'SUCCESS' when a <= 50 then 'WARN' else 'FAILED' end, '<=26h', a::varchar from
        (select round((epoch_us(timestamp '2024-02-01')//1000000 - epoch_us(max(event_timestamp))//1000000) / 3600.0::double, 2) a from raw_events)
      union all select 'unique(event_id)', case when count(*) = 0 then 'SUCCESS' else 'FAILED' end, '0', count(*)::varchar from (select event_id from raw_events group by 1 having count(*) > 1)
      union all select 'unique(event_id,payload_hash,ingestion_ts)', case when count(*) = 0 then 'SUCCESS' else 'FAILED' end, '0', count(*)::varchar
        from (select 1 from raw_events group by event_id, payload_hash, ingestion_ts having count(*) > 1)
      union all select 'required_columns(event_id,page_context)', 'FAILED', '0', '1')""",
)
def declarative(shop):
    checks = [
        Check("not_null", ("user_id", "product_id")),
        Check("accepted_values", ("event_type",), values=("view", "cart", "purchase")),
        Check("row_count"),
        Check("freshness", ("event_timestamp",)),
        Check("unique", ("event_id",)),
        Check("unique", ("event_id", "payload_hash", "ingestion_ts")),
        Check("required_columns", ("event_id", "page_context")),
    ]
    return quality.run_checks(shop.raw_events, "events", checks, "2024-02-01 00:00:00")


@query(
    "d26_key_profile",
    """select 'raw_events' table_name, count(*) row_count, 0::bigint null_key_rows, count(*) - count(distinct event_id) duplicate_key_rows from raw_events
    union all select 'requests', count(*), sum((request_id is null)::int)::bigint, count(request_id) - count(distinct request_id) from behavior_events""",
)
def keys(shop):
    return quality.key_profile(shop.raw_events, "raw_events", ["event_id"]).unionByName(
        quality.key_profile(shop.behavior_events, "requests", ["request_id"])
    )


@query(
    "k23_schema_conformance",
    """select 'users' table_name, c column_name, e expected_type, a actual_type, s status, (select count(*) from users) row_count from (values
      ('user_id','bigint','bigint','ok'), ('signup_ts','timestamp','timestamp','ok'), ('country','string','string','ok'), ('segment','string','string','ok'),
      ('age_bucket','smallint','int','mismatch'), ('is_active','boolean','boolean','ok'), ('city','string',null,'legacy_missing')) v(c,e,a,s)""",
)
def conformance(shop):
    contract = T.StructType(
        [
            T.StructField("user_id", T.LongType()),
            T.StructField("signup_ts", T.TimestampType()),
            T.StructField("country", T.StringType()),
            T.StructField("segment", T.StringType()),
            T.StructField("age_bucket", T.ShortType()),
            T.StructField("is_active", T.BooleanType()),
            T.StructField("city", T.StringType()),
        ]
    )
    return quality.schema_conformance(shop.users, "users", contract, legacy=("city",))


@query(
    "c15_integrity_report",
    """select 'session_user_missing' check_name, count(*) violations from sessions s where not exists (select 1 from users u where u.user_id = s.user_id)
    union all select 'session_user_inactive', count(*) from sessions s join users u using (user_id) where not u.is_active
    union all select 'event_product_missing', count(*) from behavior_events e where not exists (select 1 from products p where p.product_id = e.product_id)
    union all select 'event_session_missing', count(*) from behavior_events e where not exists (select 1 from sessions s where s.session_id = e.session_id)
    union all select 'impression_request_linkage', count(*) from impressions i left join recommendation_requests r using (request_id)
      where r.user_id is distinct from i.user_id or r.session_id is distinct from i.session_id
    union all select 'event_impression_linkage', count(*) from behavior_events e left join impressions i on i.impression_id = e.impression_id
      where e.impression_id is not null and (i.request_id is distinct from e.request_id or i.user_id is distinct from e.user_id or i.candidate_product_id is distinct from e.product_id)
    union all select 'event_product_metadata', count(*) from behavior_events e join products p using (product_id) where p.category_id <> e.category_id or p.brand_id <> e.brand_id
    union all select 'event_created_early', count(*) from behavior_events where created_ts < event_timestamp
    union all select 'event_id_not_positive', count(*) from behavior_events where least(user_id, product_id, category_id, brand_id) <= 0
    union all select 'item_order_missing', count(*) from order_items i where not exists (select 1 from shop_orders o where o.order_id = i.order_id)
    union all select 'item_product_missing', count(*) from order_items i where not exists (select 1 from products p where p.product_id = i.product_id)
    union all select 'order_totals', count(*) from shop_orders o left join (select order_id, sum(gross) gross, sum(discount_amount) discount, sum(line_amount) net from order_items group by 1) i using (order_id)
      where i.net is null or o.gross_amount <> i.gross or o.discount_amount <> i.discount or o.net_amount <> i.net""",
)
def integrity(shop):
    return quality.integrity_report(
        {
            "users": shop.users, "products": shop.products, "sessions": shop.sessions,
            "requests": shop.recommendation_requests, "impressions": shop.impressions, "events": shop.behavior_events,
            "orders": shop.orders, "order_items": shop.order_items,
        }
    )


@query(
    "d28_mergeable_totals",
    """select user_id, count(*) n, sum(price)::double total, min(price)::double low, max(price)::double high, arg_max(price, (event_timestamp, price))::double newest,
      sum(price)::double / count(*) mean from behavior_events group by 1""",
)
def mergeable(shop):
    """Hourly partial totals merged per user equal totals of all events."""
    hourly = aggregates.partial_totals(
        shop.behavior_events, ["user_id", F.date_trunc("hour", "event_timestamp").alias("hour")], "price", "event_timestamp"
    )
    out = aggregates.result(aggregates.merge_totals(hourly, ["user_id"]), ["user_id"], "price")
    return out.select("user_id", "n", *[F.col(c).cast("double").alias(c) for c in ("total", "low", "high", "newest")], "mean")
