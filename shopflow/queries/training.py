"""Training sets: histories, samples, splits, vocabularies."""

from pyspark.sql import functions as F

from shopflow.functions import arrays
from shopflow.operators import features, labels, training
from shopflow.queries.features import VIEWS as FEATURE_VIEWS
from shopflow.queries.features import ID_ARRAYS, text, training_inputs
from shopflow.queries.prelude import h
from shopflow.queries.registry import query

VIEWS = {
    "history_events": """select *, case event_type when 'view' then 1 when 'cart' then 2 when 'purchase' then 3 else 0 end event_type_id
      from behavior_events where event_type in ('view','cart','purchase')""",
    "positives": """select * from (select *, list(product_id) over w items, list(event_type_id) over w types, list(category_id) over w categories, list(brand_id) over w brands,
        list(price_bucket) over w buckets, list(event_timestamp) over w times
      from history_events window w as (partition by user_id order by event_timestamp, event_id rows between 20 preceding and 1 preceding))
      where event_type in ('cart','purchase') and len(items) >= 2""",
    "item_stats": """select product_id, count(*) n_events, arg_min(category_id, (event_timestamp, event_id)) category_id, arg_min(brand_id, (event_timestamp, event_id)) brand_id,
        arg_min(price, (event_timestamp, event_id)) price, arg_min(price_bucket, (event_timestamp, event_id)) price_bucket from behavior_events group by 1""",
    "user_stats": """select user_id, count(*) n_events, count(distinct product_id) n_items, max((event_type='purchase')::int) has_purchase, max((event_type='cart')::int) has_cart,
        max((event_type='view')::int) has_view, case when max((event_type='purchase')::int) = 1 then 2 when max((event_type='cart')::int) = 1 then 1 else 0 end as bucket
      from behavior_events group by 1""",
}
HISTORICAL = {
    **FEATURE_VIEWS,
    "joined_views": """select l.*, case when l.prediction_timestamp - u.feature_timestamp <= interval 1 day then u.items end items,
        case when l.prediction_timestamp - u.feature_timestamp <= interval 1 day then u.stamps end stamps,
        case when l.prediction_timestamp - u.feature_timestamp <= interval 1 day then u.views_30m end views_30m,
        case when l.prediction_timestamp - i.feature_timestamp <= interval 7 day then i.category_id end category_id
      from labelled l left join user_asof u on u.id = l.impression_id left join item_asof i on i.id = l.impression_id""",
}
HISTORY = ["hist_item_id", "hist_event_type", "hist_category", "hist_brand", "hist_price_bucket"]


def typed(shop):
    return shop.behavior_events.withColumn("event_type_id", features.event_type_id())


@query(
    "e9_prior_histories",
    """select event_id, user_id, event_type, array_to_string(items, ',') hist_item_id, array_to_string(types, ',') hist_event_type, array_to_string(categories, ',') hist_category,
      array_to_string(brands, ',') hist_brand, array_to_string(buckets, ',') hist_price_bucket, len(items)::int hist_len from positives""",
    VIEWS,
)
def prior_histories(shop):
    return training.prior_histories(typed(shop)).select("event_id", "user_id", "event_type", *[text(c) for c in HISTORY], "hist_len")


@query(
    "k12_normalized_clickstream",
    """select event_id, user_id::varchar user_id, product_id::varchar target_item_id, category_id::varchar target_category, brand_id::varchar target_brand,
      price::double target_price, round(ln(1 + price::double), 9) target_price_log, price_bucket, len(items)::int hist_len, array_to_string(items, ',') hist_item_id,
      array_to_string(list_transform(times, lambda t: case when epoch_us(event_timestamp) - epoch_us(t) < 300000000 then 0 when epoch_us(event_timestamp) - epoch_us(t) < 1800000000 then 1
        when epoch_us(event_timestamp) - epoch_us(t) < 7200000000 then 2 when epoch_us(event_timestamp) - epoch_us(t) < 21600000000 then 3
        when epoch_us(event_timestamp) - epoch_us(t) < 86400000000 then 4 when epoch_us(event_timestamp) - epoch_us(t) < 259200000000 then 5
        when epoch_us(event_timestamp) - epoch_us(t) < 604800000000 then 6 when epoch_us(event_timestamp) - epoch_us(t) < 1209600000000 then 7 else 8 end), ',') hist_time_bucket
    from positives""",
    VIEWS,
)
def normalized(shop):
    rows = training.normalized_clickstream(training.prior_histories(typed(shop)))
    return rows.select(
        "event_id", "user_id", "target_item_id", "target_category", "target_brand", "target_price",
        F.round("target_price_log", 9).alias("target_price_log"), "price_bucket", "hist_len", text("hist_item_id"), text("hist_time_bucket"),
    )


@query(
    "b13_normalized_training_rows",
    """select event_id, array_to_string(items[-5:], ',') hist_item_id, array_to_string(brands[-5:], ',') hist_brand,
      array_to_string(list_concat(list_transform(range(0, greatest(least(len(items), 5) - 3, 0)), lambda i: 0), items[-least(len(items), 3):]), ',') hist_short
    from sequences""",
    FEATURE_VIEWS,
)
def normalized_rows(shop):
    """Suffix of five, and a history of three padded to the same length."""
    rows = features.user_sequence_features(shop.behavior_events).select(
        "event_id", F.col("hist_item_ids").alias("hist_item_id"), F.col("hist_brand_ids").alias("hist_brand"),
        arrays.last_n(F.col("hist_item_ids"), 3).alias("hist_short"),
    )
    names = ["hist_item_id", "hist_brand", "hist_short"]
    return training.normalize_histories(rows, names, 5).select("event_id", *[text(c) for c in names])


@query(
    "b14_padded_sequences",
    """select event_id, array_to_string(list_concat(list_transform(range(0, greatest(10 - len(items), 0)), lambda i: 0), items[-10:]), ',') padded from sequences""",
    FEATURE_VIEWS,
)
def padded(shop):
    rows = features.user_sequence_features(shop.behavior_events)
    return rows.select("event_id", arrays.pad_and_trim(F.col("hist_item_ids"), 10, F.lit(0)).alias("padded")).select("event_id", text("padded"))


@query(
    "b15_canonical_entities",
    "select impression_id row_id, impression_id, request_id, user_id, candidate_product_id product_id, prediction_timestamp event_timestamp, label from labelled",
    FEATURE_VIEWS,
)
def entities(shop):
    return training.canonical_entities(labels.ranking_labels(shop.impressions, shop.behavior_events), "impression_id")


@query(
    "b16_folded_ids",
    "select event_id, array_to_string(list_transform(items, lambda x: x % 37), ',') hist_item_ids from sequences",
    FEATURE_VIEWS,
)
def folded(shop):
    rows = features.user_sequence_features(shop.behavior_events)
    return rows.select("event_id", arrays.modulo_ids(F.col("hist_item_ids"), 37).alias("hist_item_ids")).select("event_id", text("hist_item_ids"))


@query(
    "k9_historical_training_rows",
    """select impression_id, user_id, coalesce(array_to_string(list_transform(h, lambda x: x[1]), ','), '') hist_item_id,
      coalesce(array_to_string(list_transform(h, lambda x: least((epoch_us(prediction_timestamp)//1000000 - epoch_us(strptime(x[2], '%Y-%m-%dT%H:%M:%SZ'))//1000000) // 300 + 1, 105120)), ','), '') hist_time,
      coalesce(category_id, 0)::int target_category, label, coalesce(views_30m, 0)::int views_30m
    from (select *, list_filter(list_zip(items, stamps), lambda x: strptime(x[2], '%Y-%m-%dT%H:%M:%SZ') < prediction_timestamp) h from joined_views)""",
    HISTORICAL,
)
def historical(shop):
    inputs = training_inputs(shop, [*ID_ARRAYS, "hist_event_timestamps"], times_as_text=False)
    joined = labels.join_feature_views(*inputs, ttl_days={"seq": 1, "agg": 1, "item": 7})
    rows = training.historical_training_rows(joined)
    return rows.select("impression_id", "user_id", text("hist_item_id"), text("hist_time"), "target_category", "label", "views_30m")


@query(
    "h7_h13_recency_of_history",
    """select event_id, array_to_string(list_transform(list_filter(times, lambda t: t < event_timestamp), lambda t: least((epoch_us(event_timestamp)//1000000 - epoch_us(t)//1000000) // 300 + 1, 105120)), ',') recency
    from positives""",
    VIEWS,
)
def recency(shop):
    rows = training.prior_histories(typed(shop))
    earlier = F.filter("hist_time", lambda t: t < F.col("event_timestamp"))
    return rows.select("event_id", arrays.recency_buckets(F.col("event_timestamp"), earlier).alias("recency")).select("event_id", text("recency"))


@query(
    "h11_h12_array_columns",
    """select event_id, len(items)::int size, coalesce(array_to_string(list_transform(items, lambda x: x + 1), ','), '') shifted, '' empty_array from sequences""",
    FEATURE_VIEWS,
)
def array_columns(shop):
    rows = features.user_sequence_features(shop.behavior_events)
    return rows.select(
        "event_id", F.size("hist_item_ids").alias("size"), F.transform("hist_item_ids", lambda x: x + 1).alias("shifted"),
        F.coalesce(F.lit(None).cast("array<int>"), F.array().cast("array<int>")).alias("empty_array"),
    ).select("event_id", "size", text("shifted"), text("empty_array"))


@query(
    "e10_equal_count_buckets",
    """select event_id, greatest(ceil((r-1)*q/(n-1)::double)::int - 1, 0)::int as bucket from (select event_id, row_number() over (order by price, event_id) r, count(*) over () n,
      least(10, (select count(distinct price) from behavior_events)) q from behavior_events)""",
)
def equal_counts(shop):
    return training.equal_count_buckets(shop.behavior_events.select("event_id", "price"), "price", ["event_id"]).select("event_id", "bucket")


@query(
    "e13_k7_temporal_split",
    """select impression_id, case when r <= floor(n*0.8::double) then 'train' when r <= floor(n*0.8::double) + floor(n*0.1::double) then 'val' else 'test' end split
    from (select impression_id, row_number() over (order by impression_timestamp, impression_id) r, count(*) over () n from impressions)""",
)
def temporal_split(shop):
    rows = shop.impressions.select("impression_id", "impression_timestamp")
    return training.temporal_split(rows, ["impression_timestamp", "impression_id"]).select("impression_id", "split")


@query(
    "k8_group_temporal_split",
    """select event_id, case when r <= floor(n*0.8::double) then 'train' when r <= floor(n*0.9::double) then 'val' else 'test' end split
    from behavior_events join (select user_id, d, row_number() over (order by d, user_id) r, count(*) over () n
      from (select distinct user_id, date_trunc('hour', event_timestamp) d from behavior_events)) g
      on g.user_id = behavior_events.user_id and g.d = date_trunc('hour', event_timestamp)""",
)
def group_split(shop):
    rows = shop.behavior_events.select("event_id", "user_id", F.date_trunc("hour", "event_timestamp").alias("event_time"))
    return training.group_temporal_split(rows, "event_time", "user_id").select("event_id", "split")


@query("h30_vocabulary", "select value, row_number() over (order by value) as id from (select distinct product_id::varchar as value from behavior_events)")
def vocabulary(shop):
    return training.vocabulary(shop.behavior_events, "product_id")


VOCAB = {"vocab": "select value, row_number() over (order by value) as id from (select distinct product_id::varchar as value from behavior_events)"}


@query(
    "h30_encoded_histories",
    """select event_id, (select id from vocab where value = product_id::varchar) product_id,
      (select string_agg(v.id::varchar, ',' order by o) from (select unnest(items) x, generate_subscripts(items, 1) o) t join vocab v on v.value = t.x::varchar) hist_item_id
    from positives""",
    {**VIEWS, **VOCAB},
)
def encoded(shop):
    vocab = training.vocabulary(shop.behavior_events, "product_id")
    rows = training.prior_histories(typed(shop)).select("event_id", "product_id", "hist_item_id")
    coded = training.encode_array(training.encode(rows, "product_id", vocab), "event_id", "hist_item_id", vocab)
    return coded.select("event_id", "product_id", text("hist_item_id"))


@query("d19_user_funnel_stats", "select * from user_stats", VIEWS)
def funnel_stats(shop):
    return training.user_funnel_stats(shop.behavior_events)


@query("d20_item_popularity", "select * replace (price::double as price) from item_stats", VIEWS)
def popularity(shop):
    rows = training.item_popularity(shop.behavior_events)
    return rows.withColumn("price", F.col("price").cast("double"))


@query(
    "d22_dataset_summary",
    """select count(*) as rows, count(distinct product_id) items, count(distinct session_id) sessions, count(distinct category_id) categories,
      avg((event_type='view')::int) view_share, avg((event_type='cart')::int) cart_share, avg((event_type='purchase')::int) purchase_share,
      (select count(*) from user_stats) users, (select avg(has_purchase) from user_stats) purchase_users from behavior_events""",
    VIEWS,
)
def summary(shop):
    return training.dataset_summary(shop.behavior_events)


@query(
    "f8_top_categories",
    "select event_id, category_id from behavior_events where category_id in (select category_id from behavior_events group by 1 order by count(*) desc, category_id limit 5)",
)
def best_categories(shop):
    return training.top_categories(shop.behavior_events.select("event_id", "category_id"), "category_id", 5)


NEGATIVES = {
    **VIEWS,
    "weights": "select product_id, pow(n_events, 0.75::double) w from item_stats",
    "spans": "select product_id, (sum(w) over (order by product_id) - w) / sum(w) over () low, sum(w) over (order by product_id) / sum(w) over () high from weights",
    "first_seen": "select user_id, product_id, min((event_timestamp, event_id)) first from history_events group by 1, 2",
    "draws": f"""select p.event_id, p.user_id, p.product_id positive_item, p.event_timestamp, i draw, {h("'42:'||p.event_id||':'||i")} / 4294967296.0::double u from positives p, range(0, 180) r(i)""",
    "accepted": """select d.event_id positive_id, d.user_id, s.product_id, row_number() over (partition by d.event_id order by d.draw) r
      from draws d join spans s on d.u >= s.low and d.u < s.high left join first_seen f on f.user_id = d.user_id and f.product_id = s.product_id
      where s.product_id <> d.positive_item and (f.first is null or f.first >= (d.event_timestamp, d.event_id))""",
}


@query(
    "k10_negative_samples",
    """select positive_id, user_id, product_id, r::int negative_rank, category_id, brand_id, price::double price, price_bucket
    from accepted join item_stats using (product_id) where r <= 3""",
    NEGATIVES,
)
def negatives(shop):
    return training.negative_samples(typed(shop))


SAMPLE = {
    **VIEWS,
    "eligible": f"""select *, {h("'42:'||user_id")} hh from user_stats where n_events >= 5 and n_items >= 2""",
    "wanted": "select floor((select count(*) from behavior_events) * 0.4 / greatest((select sum(n_events)::double / count(*) from eligible), 1)) w",
    "placed": "select *, row_number() over (partition by bucket order by hh, user_id) r, (select w from wanted) w from eligible",
    "quota": "select *, r <= floor(w * case bucket when 2 then 0.35::double when 1 then 0.35::double else 0.3::double end) picked from placed",
    "filled": "select user_id, n_events, hh from quota where picked union all (select user_id, n_events, hh from (select *, row_number() over (order by hh, user_id) r2 from quota where not picked) where r2 <= (select max(w) from quota) - (select count(*) from quota where picked))",
    "cumulated": "select *, sum(n_events) over (order by hh, user_id) c from filled",
    "chosen": """select user_id from cumulated where (select sum(n_events) from filled) <= (select count(*) from behavior_events) * 0.4 * 1.25
      or c < coalesce((select min(c) from cumulated where c > (select count(*) from behavior_events) * 0.4 and c - n_events > (select count(*) from behavior_events) * 0.4 * 0.9), 9e18)""",
}


@query("k11_c14_stratified_sample", "select event_id, user_id from behavior_events where user_id in (select user_id from chosen)", SAMPLE)
def stratified(shop):
    """About two fifths of the events, by whole users."""
    events = shop.behavior_events
    target = int(events.count() * 0.4)
    return training.stratified_sample(events, target, {2: 0.35, 1: 0.35, 0: 0.3}, min_events=5, min_items=2).select("event_id", "user_id")


@query(
    "c12_features_with_user_labels",
    """select user_id, event_id, views_30m, label from aggregates join (select user_id, max((event_type='purchase')::int) as label from behavior_events group by 1) using (user_id)""",
    FEATURE_VIEWS,
)
def history_labels(shop):
    rows = features.user_aggregate_features(shop.behavior_events).select("user_id", "event_id", "views_30m")
    outcome = shop.behavior_events.groupBy("user_id").agg(F.max((F.col("event_type") == "purchase").cast("int")).alias("label"))
    return training.history_label_join(rows, outcome)


@query(
    "k16_versioned_sample_rows",
    """select impression_id, candidate_product_id target_item_id, 'train' split, date_trunc('second', impression_timestamp) event_timestamp, timestamp '2024-02-01' source_updated_at from impressions""",
)
def sample_rows(shop):
    from shopflow.operators import versioned

    rows = shop.impressions.select(
        "impression_id", F.col("candidate_product_id").alias("target_item_id"), F.lit("train").alias("part"),
        F.unix_seconds("impression_timestamp").alias("event_time"),
    )
    out = versioned.sample_rows(rows, "part", "event_time", "2024-02-01", ["impression_id", "target_item_id"])
    return out.select("impression_id", "target_item_id", "split", "event_timestamp", "source_updated_at")
