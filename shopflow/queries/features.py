"""Feature tables, point-in-time joins and labels."""

from pyspark.sql import functions as F

from shopflow.operators import asof, features, labels
from shopflow.plans.storage import materialize
from shopflow.queries.registry import query

# One view per feature table; the training table and the as-of joins reuse them.
ROLLING_USERS = """
    select user_id, event_id, event_timestamp feature_timestamp, epoch_us(event_timestamp)//1000000 sec, event_type, price, category_id from behavior_events"""
VIEWS = {
    "aggregates": f"""
        select user_id, event_id, feature_timestamp,
          (sum((event_type='view')::int) over w30)::bigint views_30m, (sum((event_type='cart')::int) over w30)::bigint carts_30m,
          (sum((event_type='purchase')::int) over w24)::bigint purchases_24h,
          len(list_distinct(list(category_id) over w7))::int distinct_categories_7d,
          case when sum((event_type='view')::int) over w7 > 0 then
            (sum(case when event_type='view' then price else 0 end) over w7)::double / (sum((event_type='view')::int) over w7)::double else 0.0 end avg_viewed_price_7d,
          case when sum((event_type='cart')::int) over w7 > 0 then
            (sum((event_type='purchase')::int) over w7)::double / (sum((event_type='cart')::int) over w7)::double else 0.0 end cart_to_purchase_ratio_7d,
          0 last_event_age_seconds
        from ({ROLLING_USERS})
        window w30 as (partition by user_id order by sec range between 1800 preceding and current row),
          w24 as (partition by user_id order by sec range between 86400 preceding and current row),
          w7 as (partition by user_id order by sec range between 604800 preceding and current row)""",
    "latest_products": """
        select * exclude (r) from (select *, row_number() over (partition by product_id order by valid_from desc) r
          from product_snapshots) where r = 1""",
    "item_counts": """
        select *, (sum((event_type='view')::int) over w1)::bigint views_1h, (sum((event_type='view')::int) over w24)::bigint views_24h,
          (sum((event_type='cart')::int) over w1)::bigint carts_1h, (sum((event_type='cart')::int) over w24)::bigint carts_24h,
          (sum((event_type='purchase')::int) over w24)::bigint purchases_24h,
          (sum((event_type='purchase')::int) over w7)::bigint purchases_7d, (sum((event_type='view')::int) over w7)::bigint views_7d
        from (select *, epoch_us(event_timestamp)//1000000 sec from behavior_events)
        window w1 as (partition by product_id order by sec range between 3600 preceding and current row),
          w24 as (partition by product_id order by sec range between 86400 preceding and current row),
          w7 as (partition by product_id order by sec range between 604800 preceding and current row)""",
    "items": """
        select c.product_id, event_id, event_timestamp feature_timestamp, coalesce(p.category_id, c.category_id) category_id,
          coalesce(p.brand_id, c.brand_id) brand_id, coalesce(p.price_bucket, c.price_bucket) price_bucket,
          coalesce(p.is_active, true) is_active, views_1h, views_24h, carts_1h, carts_24h, purchases_24h, purchases_7d,
          (purchases_7d + 1.0::double) / (views_7d + 10.0::double) conversion_rate_7d,
          (views_24h + 3*carts_24h + 10*purchases_24h)::double popularity_score
        from item_counts c left join latest_products p on c.product_id = p.product_id""",
    "sequences": """
        select user_id, event_id, event_timestamp feature_timestamp, list(product_id) over w items,
          list(case event_type when 'view' then 1 when 'cart' then 2 when 'purchase' then 3 else 0 end) over w types,
          list(category_id) over w categories, list(brand_id) over w brands, list(price_bucket) over w buckets,
          list(strftime(event_timestamp, '%Y-%m-%dT%H:%M:%SZ')) over w stamps, list(coalesce(request_id,'')) over w requests,
          list(coalesce(impression_id,'')) over w shown
        from behavior_events
        window w as (partition by user_id order by event_timestamp, event_id rows between 49 preceding and current row)""",
    "labelled": """
        select i.impression_id, i.request_id, i.user_id, i.candidate_product_id, i.impression_timestamp prediction_timestamp,
          i.impression_timestamp + interval 24 hours label_window_end, (min(e.event_timestamp) is not null)::int as label,
          arg_min(e.event_type, e.event_timestamp) positive_event_type, min(e.event_timestamp) positive_event_timestamp,
          'impression' sampling_strategy, 1.0::double sampling_probability,
          coalesce(i.candidate_source, 'unknown') candidate_source, i.rank_position, 'ranking_label_v1' label_version
        from impressions i left join (select * from behavior_events where event_type in ('cart','purchase')) e
          on e.user_id = i.user_id and e.product_id = i.candidate_product_id
          and e.event_timestamp > i.impression_timestamp and e.event_timestamp <= i.impression_timestamp + interval 24 hours
        group by i.impression_id, i.request_id, i.user_id, i.candidate_product_id, i.impression_timestamp, i.candidate_source, i.rank_position""",
    "user_asof": """
        select * exclude (r) from (select l.impression_id id, f.* , row_number() over (partition by l.impression_id
            order by f.feature_timestamp desc, f.event_id desc) r
          from labelled l join (select s.*, a.* exclude (user_id, event_id, feature_timestamp) from sequences s join aggregates a using (event_id)) f
            on f.user_id = l.user_id and f.feature_timestamp <= l.prediction_timestamp) where r = 1""",
    "item_asof": """
        select * exclude (r) from (select l.impression_id id, f.*, row_number() over (partition by l.impression_id
            order by f.feature_timestamp desc, f.event_id desc) r
          from labelled l join items f on f.product_id = l.candidate_product_id and f.feature_timestamp <= l.prediction_timestamp) where r = 1""",
}


def text(column: str):
    return F.concat_ws(",", F.col(column).cast("array<string>")).alias(column)


@query("e3_user_aggregate_features", "select * from aggregates", VIEWS)
def user_aggregates(shop):
    return features.user_aggregate_features(shop.behavior_events)


@query(
    "e3_user_aggregates_open_horizons",
    """select user_id, event_id, event_timestamp feature_timestamp,
      (sum((event_type='view')::int) over w30)::bigint views_30m, (sum((event_type='cart')::int) over w30)::bigint carts_30m,
      (sum((event_type='purchase')::int) over w24)::bigint purchases_24h
    from (select *, epoch_us(event_timestamp) us from behavior_events)
    window w30 as (partition by user_id order by us range between 1799999999 preceding and current row),
      w24 as (partition by user_id order by us range between 86399999999 preceding and current row)""",
)
def user_aggregates_open(shop):
    rows = features.user_aggregate_features(shop.behavior_events, exclusive=True)
    return rows.select("user_id", "event_id", "feature_timestamp", "views_30m", "carts_30m", "purchases_24h")


@query("d13_approximate_category_error", "select event_id, distinct_categories_7d from aggregates", VIEWS)
def trailing_categories(shop):
    """Trailing distinct counts by the linear route, against SQL that counts exactly: they have no error to report."""
    return features.trailing_category_counts(shop.behavior_events).select("event_id", "distinct_categories_7d")


RUN_TIME = "2024-06-01 00:00:00"
STORED = f"feature_timestamp event_timestamp, timestamp '{RUN_TIME}' created_timestamp, 'v1' feature_version"
WINDOWED = f"{STORED}, feature_timestamp aggregation_window_end_ts, feature_timestamp watermark_ts"


@query("e3_stored_user_aggregates", f"select *, {WINDOWED} from aggregates", VIEWS)
def stored_user_aggregates(shop):
    return features.as_feature_table(features.user_aggregate_features(shop.behavior_events), RUN_TIME)


@query("e4_stored_item_features", f"select *, {WINDOWED} from items", VIEWS)
def stored_item_features(shop):
    return features.as_feature_table(features.item_features(shop.behavior_events, shop.product_snapshots), RUN_TIME)


@query("e7_stored_sequences", f"select user_id, event_id, {STORED} from sequences", VIEWS)
def stored_sequences(shop):
    rows = features.as_feature_table(features.user_sequence_features(shop.behavior_events), RUN_TIME, windowed=False)
    return rows.select("user_id", "event_id", "event_timestamp", "created_timestamp", "feature_version")


@query(
    "d13_trailing_distinct_sketches",
    """select e.event_type, e.day, count(distinct h.event_id) exact_events, round(0.15::double * count(distinct h.event_id), 6) allowed_error, true within_bound
    from (select distinct event_type, event_timestamp::date as day from behavior_events) e join behavior_events h on h.event_type = e.event_type and h.event_timestamp::date between e.day - 6 and e.day group by 1, 2""",
)
def trailing_sketches(shop):
    """Sketches of high-cardinality ids over trailing days against exact counts; three deviations of 5 % are allowed."""
    events = shop.behavior_events
    found = features.trailing_distinct_sketches(events, ["event_type"], "event_timestamp", "event_id")
    firsts = events.select("event_type", "event_id", F.to_date("event_timestamp").alias("day")).distinct()
    served = firsts.withColumn("day", F.explode(F.sequence(F.col("day"), F.date_add("day", 6))))
    exact = served.groupBy("event_type", "day").agg(F.count_distinct("event_id").alias("exact_events"))
    allowed = F.round(0.15 * F.col("exact_events"), 6)
    error = F.abs(F.col("approximate") - F.col("exact_events"))
    return found.join(exact, ["event_type", "day"]).select(
        "event_type", "day", "exact_events", allowed.alias("allowed_error"), (error <= allowed).alias("within_bound")
    )


@query(
    "d13_approximate_distinct_products",
    "select count(distinct product_id) exact_products, true within_bound from behavior_events",
)
def approximate_products(shop):
    both = shop.behavior_events.agg(
        F.count_distinct("product_id").alias("exact_products"), F.approx_count_distinct("product_id", 0.05).alias("estimate")
    )
    error = F.abs(F.col("estimate") - F.col("exact_products")) / F.col("exact_products")
    return both.select("exact_products", (error <= 0.15).alias("within_bound"))


@query("e1_latest_product_metadata", "select * from latest_products", VIEWS)
def latest_products(shop):
    return features.latest_product_metadata(shop.product_snapshots).drop("created_ts")


@query("e4_item_features", "select * from items", VIEWS)
def item_features(shop):
    return features.item_features(shop.behavior_events, shop.product_snapshots)


@query(
    "e4_item_features_event_metadata",
    """select product_id, event_id, category_id, brand_id, price_bucket, true is_active,
      (sum((event_type='view')::int) over w1)::bigint views_1h, (sum((event_type='purchase')::int) over w24)::bigint purchases_24h
    from (select *, epoch_us(event_timestamp) us from behavior_events)
    window w1 as (partition by product_id order by us range between 3599999999 preceding and current row),
      w24 as (partition by product_id order by us range between 86399999999 preceding and current row)""",
)
def item_features_from_events(shop):
    rows = features.item_features(shop.behavior_events, None, exclusive=True)
    return rows.select(
        "product_id", "event_id", "category_id", "brand_id", "price_bucket", "is_active", "views_1h", "purchases_24h"
    )


@query(
    "e5_smoothed_conversion",
    """select product_id, (sum((event_type='purchase')::int) + 1.0::double) / (sum((event_type='view')::int) + 10.0::double) conversion_rate
    from behavior_events group by 1""",
)
def smoothed_conversion(shop):
    is_type = features.is_type
    return shop.behavior_events.groupBy("product_id").agg(
        features.smoothed_rate(F.sum(is_type("purchase")), F.sum(is_type("view"))).alias("conversion_rate")
    )


@query(
    "e6_weighted_popularity",
    """select product_id, (sum((event_type='view')::int) + 3*sum((event_type='cart')::int) + 10*sum((event_type='purchase')::int))::double popularity_score
    from behavior_events group by 1""",
)
def weighted_popularity(shop):
    count = lambda kind: F.sum(features.is_type(kind))
    return shop.behavior_events.groupBy("product_id").agg(
        features.popularity(count("view"), count("cart"), count("purchase")).alias("popularity_score")
    )


@query(
    "e7_user_sequence_features",
    """select user_id, event_id, feature_timestamp, array_to_string(items, ',') hist_item_ids, array_to_string(types, ',') hist_event_type_ids,
      array_to_string(categories, ',') hist_category_ids, array_to_string(brands, ',') hist_brand_ids,
      array_to_string(buckets, ',') hist_price_bucket_ids, array_to_string(stamps, ',') hist_event_timestamps,
      array_to_string(requests, ',') hist_request_ids, array_to_string(shown, ',') hist_impression_ids,
      len(items)::int hist_length, 50 max_history_length from sequences""",
    VIEWS,
)
def user_sequences(shop):
    rows = features.user_sequence_features(shop.behavior_events)
    return rows.select(
        "user_id", "event_id", "feature_timestamp", *[text(c) for c in features.SEQUENCE_FIELDS], "hist_length", "max_history_length"
    )


ASOF_SQL = """
    select l.impression_id, l.user_id, l.candidate_product_id, l.prediction_timestamp, u.event_id agg_event_id,
      u.feature_timestamp agg_feature_timestamp, u.views_30m agg_views_30m, u.purchases_24h agg_purchases_24h
    from labelled l left join user_asof u on u.id = l.impression_id"""


@query("c1_asof_join", ASOF_SQL, VIEWS)
def asof_features(shop):
    left = labels.ranking_labels(shop.impressions, shop.behavior_events).select(
        "impression_id", "user_id", "candidate_product_id", "prediction_timestamp"
    )
    view = features.user_aggregate_features(shop.behavior_events).select(
        "user_id", "event_id", "feature_timestamp", "views_30m", "purchases_24h"
    )
    return asof.asof_join(
        left, "prediction_timestamp", {"user_id": "user_id"}, [asof.FeatureView(view, "agg", tie_break="event_id")]
    )


@query(
    "e2_latest_earlier_item_row",
    """select i.impression_id, candidate_product_id, arg_max(e.event_id, (event_timestamp, e.event_id)) item_event_id
    from (select impression_id, candidate_product_id, impression_timestamp from impressions) i
    left join behavior_events e on e.product_id = i.candidate_product_id and e.event_timestamp <= i.impression_timestamp
    group by 1, 2""",
)
def latest_earlier_item(shop):
    view = shop.behavior_events.select("product_id", "event_id", "event_timestamp")
    left = shop.impressions.select("impression_id", "candidate_product_id", "impression_timestamp")
    joined = asof.asof_join(
        left,
        "impression_timestamp",
        {"candidate_product_id": "product_id"},
        [asof.FeatureView(view, "item", "event_timestamp", "event_id")],
    )
    return joined.select("impression_id", "candidate_product_id", "item_event_id")


ID_ARRAYS = ["hist_item_ids", "hist_event_type_ids", "hist_category_ids", "hist_brand_ids", "hist_price_bucket_ids"]


def training_inputs(shop, arrays=ID_ARRAYS, times_as_text=True):
    """Labels and feature tables, each computed once and stored before the joins read them twice.

    Storing ends Catalyst's pruning, so the wide history arrays are cut to those the caller reads.
    """
    events = shop.behavior_events
    sequences = features.user_sequence_features(events, times_as_text=times_as_text).select("user_id", "event_id", "feature_timestamp", *arrays)
    tables = (
        labels.ranking_labels(shop.impressions, events),
        sequences,
        features.user_aggregate_features(events),
        features.item_features(events, shop.product_snapshots),
    )
    return tuple(materialize(table, "feature") for table in tables)


@query(
    "c2_training_table",
    """select l.impression_id, l.request_id, l.user_id, coalesce(array_to_string(u.items, ','), '') hist_item_id,
      coalesce(array_to_string(u.types, ','), '') hist_event_type, coalesce(array_to_string(u.categories, ','), '') hist_category,
      coalesce(array_to_string(u.brands, ','), '') hist_brand, coalesce(array_to_string(u.buckets, ','), '') hist_price_bucket,
      coalesce(array_to_string(list_transform(u.items, lambda x: 1), ','), '') hist_time,
      l.candidate_product_id target_item_id, coalesce(i.category_id, 0)::int target_category, coalesce(i.brand_id, 0)::int target_brand,
      coalesce(i.price_bucket, 0)::int target_price_bucket, epoch_us(l.prediction_timestamp)//1000000 event_time, l.prediction_timestamp,
      l.label, coalesce(u.views_30m, 0)::int views_30m, coalesce(u.carts_30m, 0)::int carts_30m,
      coalesce(u.purchases_24h, 0)::int purchases_24h, 50 max_history_length
    from labelled l left join user_asof u on u.id = l.impression_id left join item_asof i on i.id = l.impression_id""",
    VIEWS,
)
def training(shop):
    rows = labels.training_table(*training_inputs(shop))
    arrays = ["hist_item_id", "hist_event_type", "hist_category", "hist_brand", "hist_price_bucket", "hist_time"]
    return rows.select(*[text(c) if c in arrays else c for c in rows.columns])


@query(
    "c3_asof_join_ttl",
    """select l.impression_id, case when l.prediction_timestamp - u.feature_timestamp <= interval 1 day then u.event_id end seq_event_id,
      case when l.prediction_timestamp - u.feature_timestamp <= interval 1 day then u.views_30m end agg_views_30m,
      case when l.prediction_timestamp - i.feature_timestamp <= interval 7 day then i.event_id end item_event_id
    from labelled l left join user_asof u on u.id = l.impression_id left join item_asof i on i.id = l.impression_id""",
    VIEWS,
)
def training_ttl(shop):
    joined = labels.join_feature_views(*training_inputs(shop, []), ttl_days={"seq": 1, "agg": 1, "item": 7})
    return joined.select("impression_id", "seq_event_id", "agg_views_30m", "item_event_id")


@query(
    "c3_later_run_wins",
    """select l.impression_id, u.event_id agg_event_id, u.views_30m + 1000 agg_views_30m, timestamp '2024-06-02 00:00:00' agg_created_timestamp
    from labelled l join user_asof u on u.id = l.impression_id
    union all select l.impression_id, null, null, null from labelled l anti join user_asof u on u.id = l.impression_id""",
    VIEWS,
)
def later_run(shop):
    """Two runs wrote features of the same times; a point-in-time join takes those of the later run."""
    found, sequences, aggregates, items = training_inputs(shop, [])
    runs = [aggregates.withColumn("views_30m", F.col("views_30m") + more).withColumn("created_timestamp", F.lit(f"2024-06-0{day}").cast("timestamp")) for day, more in ((2, 1000), (1, 0))]
    joined = labels.join_feature_views(found, sequences, runs[0].unionByName(runs[1]), items)
    return joined.select("impression_id", "agg_event_id", "agg_views_30m", "agg_created_timestamp")


@query(
    "c4_interval_join_counts",
    """select i.impression_id, i.user_id, i.candidate_product_id, i.impression_timestamp, count(e.event_id) positive_events
    from impressions i left join (select * from behavior_events where event_type in ('cart','purchase')) e
      on e.user_id = i.user_id and e.product_id = i.candidate_product_id
      and e.event_timestamp > i.impression_timestamp and e.event_timestamp <= i.impression_timestamp + interval 24 hours
    group by all""",
)
def interval_matches(shop):
    rows = labels.positive_counts(shop.impressions, shop.behavior_events)
    return rows.select("impression_id", "user_id", "candidate_product_id", "impression_timestamp", "positive_events")


@query("d1_ranking_labels", f"select *, timestamp '{RUN_TIME}' created_timestamp from labelled", VIEWS)
def ranking_labels(shop):
    return labels.ranking_labels(shop.impressions, shop.behavior_events, created=RUN_TIME)


SCD_SQL = """select e.event_id, e.product_id, e.event_timestamp, s.valid_from, s.category_code, s.brand_name, s.current_price::double current_price
    from behavior_events e {how} join product_snapshots s on s.product_id = e.product_id
      and e.event_timestamp >= s.valid_from and (s.valid_to is null or e.event_timestamp < s.valid_to)"""


def scd(shop, how):
    facts = shop.behavior_events.select("event_id", "product_id", "event_timestamp")
    joined = asof.scd_join(facts, shop.product_snapshots, "product_id", "event_timestamp", how)
    return joined.select(
        *facts.columns, "valid_from", "category_code", "brand_name", F.col("current_price").cast("double").alias("current_price")
    )


@query("c5_scd_range_join", SCD_SQL.format(how="left"))
def scd_left(shop):
    return scd(shop, "left")


@query("c19_scd_inner_join", SCD_SQL.format(how="inner"))
def scd_inner(shop):
    return scd(shop, "inner")


@query(
    "c6_events_with_product_metadata",
    """select e.event_id, e.product_id, p.category_id meta_category_id, p.brand_id meta_brand_id, p.price_bucket meta_price_bucket,
      p.is_active meta_is_active from behavior_events e left join latest_products p using (product_id)""",
    VIEWS,
)
def events_with_metadata(shop):
    meta = features.latest_product_metadata(shop.product_snapshots).select(
        "product_id", *[F.col(c).alias(f"meta_{c}") for c in ("category_id", "brand_id", "price_bucket", "is_active")]
    )
    return shop.behavior_events.select("event_id", "product_id").join(meta, "product_id", "left")


@query(
    "b6_closed_intervals",
    """select product_id, valid_from, coalesce(valid_to, lead(valid_from) over (partition by product_id order by valid_from)) valid_to
    from (select product_id, valid_from, null::timestamp valid_to from product_snapshots)""",
)
def closed_intervals(shop):
    unclosed = shop.product_snapshots.select("product_id", "valid_from", F.lit(None).cast("timestamp").alias("valid_to"))
    return asof.close_intervals(unclosed)


@query(
    "b17_prefixed_feature_rows",
    """select user_id, feature_timestamp agg_feature_timestamp, views_30m agg_views_30m, carts_30m agg_carts_30m from aggregates""",
    VIEWS,
)
def prefixed(shop):
    rows = features.user_aggregate_features(shop.behavior_events)
    return rows.select("user_id", *[F.col(c).alias(f"agg_{c}") for c in ("feature_timestamp", "views_30m", "carts_30m")])
