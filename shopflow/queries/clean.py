"""Cleaning, projections, set operations and scalar functions."""

from pyspark.sql import functions as F

from shopflow.functions import arrays, catalog, dates, hashing, text
from shopflow.operators import clean, quality
from shopflow.queries.prelude import h
from shopflow.queries.registry import query
from shopflow.sources import cdc

CLEAN = """
    select * exclude (r) from (select * replace (coalesce(device_type,'unknown') as device_type, coalesce(campaign_id,'none') as campaign_id),
        case event_type when 'view' then 1 when 'cart' then 2 when 'purchase' then 3 else 0 end event_type_id,
        row_number() over (partition by event_id order by ingestion_ts, payload_hash) r
      from raw_events where schema_version <= 2) where r = 1"""
VIEWS = {"clean_events": CLEAN}
EVENT_COLUMNS = [
    "event_id", "event_timestamp", "ingestion_ts", "user_id", "event_type", "event_type_id", "product_id", "device_type",
    "campaign_id", "payload_hash", "schema_version",
]


@query("b1_optional_column_defaults", "select event_id, coalesce(device_type, 'unknown') device_type, 'none' page_context from behavior_events")
def optional_defaults(shop):
    wanted = clean.Contract("events", (), {"device_type": clean.Field(default="unknown"), "page_context": clean.Field(default="none")})
    return clean.conform(shop.behavior_events, wanted)[0].select("event_id", "device_type", "page_context")


@query("b2_clean_behavior_events", f"select {', '.join(EVENT_COLUMNS)} from clean_events", VIEWS)
def clean_events(shop):
    return clean.conform(shop.raw_events, clean.EVENTS)[0].select(*EVENT_COLUMNS)


@query(
    "b3_rejected_events",
    "select event_id, schema_version, payload_hash, 'unsupported_schema_version' rejection_reason from raw_events where schema_version > 2",
)
def rejected_events(shop):
    return clean.conform(shop.raw_events, clean.EVENTS)[1].select("event_id", "schema_version", "payload_hash", "rejection_reason")


@query("b4_clean_impressions", "select impression_id, impression_timestamp, user_id, candidate_product_id from impressions")
def clean_impressions(shop):
    twice = shop.impressions.unionByName(shop.impressions)
    return clean.conform(twice, clean.IMPRESSIONS)[0].select("impression_id", "impression_timestamp", "user_id", "candidate_product_id")


@query(
    "b5_clean_requests",
    "select request_id, request_timestamp, user_id, coalesce(request_context, '{}') request_context from recommendation_requests",
)
def clean_requests(shop):
    return clean.conform(shop.recommendation_requests, clean.REQUESTS)[0].select("request_id", "request_timestamp", "user_id", "request_context")


@query("b6_product_scd", "select product_id, valid_from, valid_to, price_bucket from product_snapshots")
def product_scd(shop):
    raw = {"product_snapshots": shop.product_snapshots, "products": shop.products}
    return clean.from_zone(raw, clean.VALIDITY)[0].select("product_id", "valid_from", "valid_to", "price_bucket")


@query("b6_product_scd_fallback", "select product_id, created_ts valid_from, null::timestamp valid_to from products")
def product_scd_fallback(shop):
    raw = {"product_snapshots": shop.product_snapshots.drop("valid_from"), "products": shop.products}
    return clean.from_zone(raw, clean.VALIDITY)[0].select("product_id", "valid_from", "valid_to")


@query(
    "b7_silver_build",
    """select 'clean_behavior_events' table_name, count(*) row_count from clean_events
    union all select 'rejected_behavior_events', count(*) from raw_events where schema_version > 2
    union all select 'clean_impressions', count(*) from impressions
    union all select 'clean_recommendation_requests', count(*) from recommendation_requests
    union all select 'product_scd', count(*) from product_snapshots union all select 'users', count(*) from users
    union all select 'products', count(*) from products union all select 'user_preferences', count(*) from user_preferences""",
    VIEWS,
)
def silver(shop):
    raw = {
        "behavior_events": shop.raw_events, "impressions": shop.impressions,
        "recommendation_requests": shop.recommendation_requests, "product_snapshots": shop.product_snapshots,
        "products": shop.products, "users": shop.users, "user_preferences": shop.user_preferences,
    }
    counts = [
        frame.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, frame in clean.silver_tables(raw).items()
    ]
    out = counts[0]
    for part in counts[1:]:
        out = out.unionByName(part)
    return out


@query(
    "b11_valid_clickstream",
    """select event_id, event_type, category_code from (select event_id, event_type, price,
        case when draw between 2 and 3 then null else 'cat.'||category_id end category_code, draw from
        (select *, """ + h("'bad:'||event_id") + """ % 100 draw from behavior_events))
    where draw > 1 and category_code is not null and event_type in ('view','cart','purchase') and (draw <> 4 )""",
)
def clickstream(shop):
    draw = hashing.bucket(F.concat(F.lit("bad:"), "event_id"))
    rows = shop.behavior_events.select(
        "event_id",
        F.when(draw <= 1, "not a time").otherwise(F.date_format("event_timestamp", "yyyy-MM-dd HH:mm:ss")).alias("event_time"),
        "event_type",
        "product_id",
        "user_id",
        F.col("session_id").alias("user_session"),
        F.when(draw == 4, -1.0).otherwise(F.col("price").cast("double")).alias("price"),
        F.when(~draw.between(2, 3), F.concat(F.lit("cat."), F.col("category_id").cast("string"))).alias("category_code"),
    )
    return clean.clean_clickstream(rows).select("event_id", "event_type", "category_code")


@query("b19_active_products", "select product_id, product_name, brand_name, current_price::double current_price from products where is_active")
def active_products(shop):
    rows = shop.products.filter("is_active").orderBy("product_id")
    return rows.select("product_id", "product_name", "brand_name", F.col("current_price").cast("double").alias("current_price"))


@query(
    "b20_numeric_feature_means",
    "select avg(quantity) quantity, avg(price_bucket) price_bucket, avg(schema_version) schema_version, avg(price::double) price from behavior_events",
)
def numeric_columns(shop):
    columns = clean.numeric_feature_columns(shop.behavior_events)
    means = shop.behavior_events.agg(*[F.avg(F.col(c).cast("double")).alias(c) for c in columns])
    return means.select("quantity", "price_bucket", "schema_version", "price")


@query(
    "b21_recent_rows",
    "select event_id, event_timestamp from behavior_events where event_timestamp > (select max(event_timestamp) from behavior_events) - interval 7 days",
)
def recent(shop):
    return clean.recent_rows(shop.behavior_events.select("event_id", "event_timestamp"), 7)


@query("f1_ordered_impressions", "select impression_id, impression_timestamp, row_number() over (order by impression_timestamp, impression_id) as row_number from impressions")
def ordered(shop):
    from shopflow.plans.ordering import with_row_number

    rows = shop.impressions.select("impression_id", "impression_timestamp")
    return with_row_number(rows, "impression_timestamp", "impression_id")


@query("g4_distinct_by_key", "select event_id, min(ingestion_ts) ingestion_ts, arg_min(payload_hash, (ingestion_ts, payload_hash)) payload_hash from raw_events group by 1")
def distinct_by_key(shop):
    rows = clean.first_per_id(shop.raw_events, ["event_id"], ["ingestion_ts", "payload_hash"])
    return rows.select("event_id", "ingestion_ts", "payload_hash")


@query("h1_parsed_timestamps", "select event_id, event_timestamp parsed, null::timestamp broken from behavior_events")
def parsed_timestamps(shop):
    stamp = F.date_format("event_timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    zoned = F.when(F.col("schema_version") == 1, F.concat(stamp, F.lit("Z"))).otherwise(stamp)
    rows = shop.behavior_events.select("event_id", zoned.alias("text"))
    return rows.select("event_id", cdc.parse_time(F.col("text")).alias("parsed"), cdc.parse_time(F.concat(F.lit("x"), "text")).alias("broken"))


@query(
    "h2_h6_h28_time_columns",
    """select event_id, strftime(event_timestamp, '%Y-%m-%dT%H:%M:%SZ') iso, epoch_us(event_timestamp)//1000000 epoch_seconds,
      event_timestamp + interval 24 hours next_day, strftime(event_timestamp, '%Y-%m-%d') event_day, event_timestamp - interval 2 days two_days_before,
      time_bucket(interval 60 seconds, event_timestamp) window_start, time_bucket(interval 60 seconds, event_timestamp) + interval 60 seconds window_end,
      date_trunc('milliseconds', event_timestamp) millis from behavior_events""",
)
def time_columns(shop):
    at = F.col("event_timestamp")
    start, end = dates.window_bounds(at, 60)
    return shop.behavior_events.select(
        "event_id", dates.iso_with_offset(at).alias("iso"), dates.epoch_seconds(at).alias("epoch_seconds"),
        dates.plus_hours(at, 24).alias("next_day"), F.to_date(at).cast("string").alias("event_day"),
        (at - F.expr("INTERVAL 2 DAYS")).alias("two_days_before"), start.alias("window_start"), end.alias("window_end"),
        dates.to_millis(at).alias("millis"),
    )


@query(
    "h8_coarse_recency",
    """select event_id, case when s < 300 then 0 when s < 1800 then 1 when s < 7200 then 2 when s < 21600 then 3 when s < 86400 then 4
      when s < 259200 then 5 when s < 604800 then 6 when s < 1209600 then 7 else 8 end recency
    from (select event_id, epoch_us(timestamp '2024-01-31')//1000000 - epoch_us(event_timestamp)//1000000 s from behavior_events)""",
)
def coarse(shop):
    age = F.unix_seconds(F.lit("2024-01-31").cast("timestamp")) - F.unix_seconds("event_timestamp")
    return shop.behavior_events.select("event_id", arrays.coarse_recency(age).alias("recency"))


@query(
    "h9_null_handling",
    """select event_id, lower(upper(event_type)) event_type, coalesce(device_type, campaign_id, 'none') origin, nullif(request_id, 'req-0') request_id,
      greatest(product_id, brand_id) largest, device_type is null device_missing from behavior_events""",
)
def null_handling(shop):
    return shop.behavior_events.select(
        "event_id", F.lower(F.upper("event_type")).alias("event_type"),
        F.coalesce("device_type", "campaign_id", F.lit("none")).alias("origin"), F.nullif(F.col("request_id"), F.lit("req-0")).alias("request_id"),
        F.greatest("product_id", "brand_id").alias("largest"), F.col("device_type").isNull().alias("device_missing"),
    )


@query(
    "h14_array_parsing",
    "select event_id, 2 numbers, product_id + category_id total from behavior_events",
)
def array_parsing(shop):
    """JSON array texts with broken members back to integers."""
    members = F.concat_ws(",", F.col("product_id").cast("string"), F.lit('null,"x"'), F.col("category_id").cast("string"))
    parsed = arrays.int_list(F.concat(F.lit("["), members, F.lit("]")))
    total = F.aggregate("numbers", F.lit(0).cast("bigint"), lambda t, x: t + x)
    rows = shop.behavior_events.select("event_id", parsed.alias("numbers"))
    return rows.select("event_id", F.size("numbers").alias("numbers"), total.alias("total"))


@query(
    "h15_payload_hash",
    """select event_id, sha256('{"event_id":"'||event_id||'","request_id":'||coalesce('"'||request_id||'"','null')||',"user_id":'||user_id||'}') payload_hash
    from behavior_events""",
)
def payload_hashes(shop):
    fields = {name: F.col(name) for name in ("user_id", "event_id", "request_id")}
    return shop.behavior_events.select("event_id", hashing.payload_hash(fields).alias("payload_hash"))


@query(
    "h16_h17_experiment_arms",
    f"""select user_id, {h("'exp-1:'||user_id")} % 100 as bucket, case when {h("'exp-1:'||user_id")} % 100 < 30 then 'candidate' else 'control' end as variant,
      {h("'shadow:exp-1:'||user_id")} % 100 < 20 shadow from users""",
)
def arms(shop):
    user = F.col("user_id")
    key = F.concat(F.lit("exp-1:"), user.cast("string"))
    return shop.users.select(
        "user_id", hashing.bucket(key).alias("bucket"), hashing.variant(user, "exp-1", 30).alias("variant"),
        hashing.shadow_sampled(user, "exp-1", 20).alias("shadow"),
    )


@query(
    "h18_stable_ids",
    "select impression_id, substr(sha256(user_id||'|'||session_id||'|'||candidate_product_id), 1, 32) stable_id from impressions",
)
def stable_ids(shop):
    parts = [F.col(c) for c in ("user_id", "session_id", "candidate_product_id")]
    return shop.impressions.select("impression_id", hashing.stable_id(*parts).alias("stable_id"))


@query(
    "h18_name_uuids",
    """select event_id, substr(d, 1, 8)||'-'||substr(d, 9, 4)||'-5'||substr(d, 14, 3)||'-'||translate(substr(d, 17, 1), '0123456789abcdef', '89ab89ab89ab89ab')||substr(d, 18, 3)||'-'||substr(d, 21, 12) request_uuid
    from (select event_id, sha1(unhex('6ba7b8119dad11d180b400c04fd430c8') || encode('https://shop.example/events/'||event_id)) d from behavior_events)""",
)
def name_uuids(shop):
    key = F.concat(F.lit("https://shop.example/events/"), F.col("event_id"))
    return shop.behavior_events.select("event_id", hashing.name_uuid(key).alias("request_uuid"))


@query(
    "h19_slugs",
    r"""select doc_id, upper(regexp_replace(regexp_replace(regexp_replace(strip_accents(text), '[^\x00-\x7F]', '', 'g'), '[^A-Za-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g')) slug
    from documents""",
)
def slugs(shop):
    return shop.documents.select("doc_id", text.slug(F.col("text")).alias("slug"))


@query(
    "h20_catalog_attributes",
    """select product_id, product_id % 91 + 10 stock_quantity, (40 + product_id % 10) / 10.0::double average_rating, product_id % 451 + 50 total_reviews,
      case product_id % 3 when 0 then 'north' when 1 then 'centre' else 'south' end warehouse_location,
      upper(replace(brand_name, '#', '-'))||'-'||upper(replace(category_code, '.', '-'))||'-'||product_id sku from products""",
)
def catalog_attributes(shop):
    item = F.col("product_id")
    named = [column.alias(name) for name, column in catalog.attributes(item).items()]
    return shop.products.select("product_id", *named, catalog.sku(F.col("brand_name"), F.col("category_code"), item).alias("sku"))


MAPPED = """select i.order_item_id, i.product_id, p.category_code, case when p.category_code is null then 'unknown_product_id' end rejection_reason
    from order_items i left join (select product_id, category_code from products where is_active) p using (product_id)"""


@query("h21_mapped_or_rejected", MAPPED)
def mapped(shop):
    items = shop.order_items.select("order_item_id", "product_id")
    known, unknown = catalog.map_dimension(items, shop.products.filter("is_active"), "product_id", "category_code")
    return known.unionByName(unknown, allowMissingColumns=True).select("order_item_id", "product_id", "category_code", "rejection_reason")


@query("h22_logarithms", "select product_id, round(ln(1 + current_price::double), 9) log1p, round(log2(1 + current_price::double), 9) as log2 from products")
def logarithms(shop):
    price = F.col("current_price").cast("double")
    return shop.products.select("product_id", F.round(F.log1p(price), 9).alias("log1p"), F.round(F.log2(price + 1), 9).alias("log2"))


@query(
    "h24_sentences",
    r"""select doc_id, position, sentence from (select doc_id, unnest(s) sentence, generate_subscripts(s, 1) - 1 as position
      from (select doc_id, list_filter(list_transform(string_split(regexp_replace(regexp_replace(text, '([.!?…])\s+', '\1' || chr(1), 'g'), '\n+', chr(1), 'g'), chr(1)),
        lambda x: regexp_replace(x, '^\s+|\s+$', '', 'g')), lambda x: x <> '') s from documents))""",
)
def sentence_rows(shop):
    return shop.documents.select("doc_id", F.posexplode(text.sentences(F.col("text"))).alias("position", "sentence")).withColumn(
        "position", F.col("position").cast("bigint")
    )


@query(
    "h25_h26_drift_columns",
    """select event_id, case when d < date '2024-01-10' then 1.0::double else round(1.0::double + least((d - date '2024-01-10') / 10.0::double, 1.0::double) * 1.5::double, 8) end factor,
      case when d between date '2024-01-01' and date '2024-01-05' then 'baseline' when d >= date '2024-01-10' then 'post_drift' else 'pre_drift' end phase,
      case when d between date '2024-01-01' and date '2024-01-05' then 'baseline' when price < 0.05 then 'stable' when price < 0.10 then 'detected' when price < 0.15 then 'strong' else 'alert' end status
    from (select event_id, event_timestamp::date d, price / 100 price from behavior_events)""",
)
def drift_columns(shop):
    day = F.to_date("event_timestamp")
    baseline = ("2024-01-01", "2024-01-05")
    phase = dates.drift_phase(day, baseline, "2024-01-10")
    return shop.behavior_events.select(
        "event_id", dates.drift_factor(day, "2024-01-10", 10, 2.5).alias("factor"), phase.alias("phase"),
        dates.drift_status(F.col("price").cast("double") / 100, phase == "baseline").alias("status"),
    )


@query(
    "h29_funnel_bucket",
    """select user_id, case when sum((event_type='purchase')::int) > 0 then 2 when sum((event_type='cart')::int) > 0 then 1 else 0 end as bucket
    from behavior_events group by 1""",
)
def funnel_bucket(shop):
    from shopflow.operators import training

    return training.user_funnel_stats(shop.behavior_events).select("user_id", "bucket")


@query(
    "g5_deleted_items",
    """select product_id, 'missing' side from (select distinct product_id from products except select distinct product_id from behavior_events)""",
)
def deleted_items(shop):
    return quality.set_difference(shop.products, shop.behavior_events, "product_id")


@query(
    "g6_id_sets_equal",
    """select m missing, u unexpected, m + u = 0 equal from
      (select count(*) m from (select impression_id from impressions except select impression_id from behavior_events)),
      (select count(*) u from (select impression_id from behavior_events where impression_id is not null except select impression_id from impressions))""",
)
def id_sets(shop):
    off = quality.set_difference(shop.impressions, shop.behavior_events.dropna(subset=["impression_id"]), "impression_id")
    counts = off.agg(
        F.count_if(F.col("side") == "missing").alias("missing"), F.count_if(F.col("side") == "unexpected").alias("unexpected")
    )
    return counts.withColumn("equal", (F.col("missing") == 0) & (F.col("unexpected") == 0))
