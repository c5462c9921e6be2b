"""Drift, ranking metrics, experiments and online views."""

from pyspark.sql import functions as F

from shopflow.functions.hashing import bucket, unit_interval, variant
from shopflow.operators import drift, experiments, features, online, ranking
from shopflow.plans.quantiles import quantiles
from shopflow.plans.storage import materialize
from shopflow.queries.features import VIEWS as FEATURE_VIEWS
from shopflow.queries.features import text
from shopflow.queries.prelude import h
from shopflow.queries.registry import query

# Open-edge and closed-edge PSI in SQL over long tables named base(feature, value) and cur(feature, value).
PSI = {
    "cuts": "select feature, quantile_cont(value, [0.0,0.1,0.2,0.3,0.4,0.5,0.6,0.7,0.8,0.9,1.0]) q, min(value) lo, max(value) hi from base group by 1",
    "closed_edges": "select feature, list_sort(list_distinct(q)) e from cuts",
    "closed_cells": "select feature, e, unnest(range(1, len(e))) b from closed_edges",
    "closed_e": "select c.feature, b, count(v.value) n from closed_cells c left join base v on v.feature = c.feature and v.value >= e[b] and (v.value < e[b+1] or (b = len(e)-1 and v.value = e[b+1])) group by 1, 2",
    "closed_a": "select c.feature, b, count(v.value) n from closed_cells c left join cur v on v.feature = c.feature and v.value >= e[b] and (v.value < e[b+1] or (b = len(e)-1 and v.value = e[b+1])) group by 1, 2",
    "shares": """select x.feature, greatest(x.n / greatest(sum(x.n) over (partition by x.feature), 1), 1e-4) p, greatest(y.n / greatest(sum(y.n) over (partition by x.feature), 1), 1e-4) q
      from closed_e x join closed_a y on x.feature = y.feature and x.b = y.b""",
    "closed_psi": "select feature, sum((q - p) * ln(q / p)) psi from shares group by 1",
}
LONG = {
    **FEATURE_VIEWS,
    "wide": "select user_id, event_id, feature_timestamp, views_30m, carts_30m, purchases_24h, distinct_categories_7d, avg_viewed_price_7d, cart_to_purchase_ratio_7d from aggregates",
    "base": """select feature, value from (unpivot (select views_30m::double views_30m, carts_30m::double carts_30m, purchases_24h::double purchases_24h, distinct_categories_7d::double distinct_categories_7d,
        avg_viewed_price_7d, cart_to_purchase_ratio_7d from wide where feature_timestamp < timestamp '2024-01-15') on columns(*) into name feature value value)""",
    "cur": """select feature, value from (unpivot (select views_30m::double views_30m, carts_30m::double carts_30m, purchases_24h::double purchases_24h, distinct_categories_7d::double distinct_categories_7d,
        avg_viewed_price_7d, cart_to_purchase_ratio_7d from wide where feature_timestamp >= timestamp '2024-01-15') on columns(*) into name feature value value)""",
    "recent_cur": """select feature, value from (unpivot (select views_30m::double views_30m, carts_30m::double carts_30m, purchases_24h::double purchases_24h, distinct_categories_7d::double distinct_categories_7d,
        avg_viewed_price_7d, cart_to_purchase_ratio_7d from wide where feature_timestamp > (select max(feature_timestamp) from wide) - interval 7 days) on columns(*) into name feature value value)""",
    **PSI,
}
SHIFTED = {k: v.replace("from cur ", "from recent_cur ").replace("join cur v", "join recent_cur v") for k, v in LONG.items()}
WIDE = ["views_30m", "carts_30m", "purchases_24h", "distinct_categories_7d", "avg_viewed_price_7d", "cart_to_purchase_ratio_7d"]


def halves(shop):
    rows = materialize(features.user_aggregate_features(shop.behavior_events).select("user_id", "event_id", "feature_timestamp", *WIDE), "wide")
    middle = F.lit("2024-01-15").cast("timestamp")
    return rows.filter(F.col("feature_timestamp") < middle), rows.filter(F.col("feature_timestamp") >= middle)


@query("c18_long_feature_pairs", "select feature, 'b' as side, count(*) as rows, round(sum(value), 6) total from base group by 1 union all select feature, 'c', count(*), round(sum(value), 6) from cur group by 1", LONG)
def long_pairs(shop):
    before, after = halves(shop)
    totals = [
        drift.long_features(f, WIDE).groupBy("feature").agg(F.count(F.lit(1)).alias("rows"), F.round(F.sum("value"), 6).alias("total")).withColumn("side", F.lit(s))
        for f, s in ((before, "b"), (after, "c"))
    ]
    return totals[0].unionByName(totals[1])


@query("k1_psi_closed_edges", "select feature, round(psi, 9) psi from closed_psi", LONG)
def psi_closed(shop):
    before, after = halves(shop)
    scores = drift.psi(drift.long_features(before, WIDE), drift.long_features(after, WIDE))
    return scores.select("feature", F.round("psi", 9).alias("psi"))


DAILY = {
    "days": "select unnest(generate_series(date '2024-01-01', date '2024-01-30', interval 1 day))::date d",
    "lead_days": "select unnest(generate_series(date '2023-10-04', date '2024-01-30', interval 1 day))::date d",
    "activity": """select user_id, d, sum(i) interactions, sum(p) purchases, sum(o) orders from (
        select user_id, event_timestamp::date d, 1 i, (event_type='purchase')::int p, 0 o from behavior_events
        union all select user_id, order_timestamp::date, 0, 0, 1 from shop_orders) group by 1, 2""",
    "daily_rows": """select * from (select u.user_id, days.d feature_date, sum(coalesce(purchases,0)) over w f_user_purchase_count_90d, sum(coalesce(orders,0)) over w f_user_total_orders_90d,
        sum(coalesce(interactions,0)) over w f_user_interaction_count_90d
      from users u cross join lead_days days left join activity a on a.user_id = u.user_id and a.d = days.d where u.is_active
      window w as (partition by u.user_id order by days.d rows between 89 preceding and current row)) where feature_date >= date '2024-01-01'""",
    "long_daily": "select feature_date, feature, value::double value from (unpivot (select feature_date, f_user_purchase_count_90d::bigint f_user_purchase_count_90d, f_user_total_orders_90d::bigint f_user_total_orders_90d, f_user_interaction_count_90d::bigint f_user_interaction_count_90d from daily_rows) on f_user_purchase_count_90d, f_user_total_orders_90d, f_user_interaction_count_90d into name feature value value)",
    "base": "select feature, value from long_daily where feature_date between date '2024-01-07' and date '2024-01-12'",
    "open_cuts": "select feature, quantile_cont(value, [0.1,0.2,0.3,0.4,0.5,0.6,0.7,0.8,0.9]) q, min(value) lo, max(value) hi from base group by 1",
    "open_inner": "select feature, lo, list_filter(list_sort(list_distinct(q)), lambda x: x > lo and x < hi) e from open_cuts",
    "curs": "select feature, min(value) clo, max(value) chi from long_daily group by 1",
    "open_edges": "select i.feature, case when len(e) > 0 then e else [(least(i.lo, c.clo) + greatest(o.hi, c.chi)) / 2] end e from open_inner i join curs c using (feature) join open_cuts o using (feature)",
    "open_cells": "select feature, e, unnest(range(0, len(e) + 1)) b from open_edges",
    "open_e": "select c.feature, c.b, count(v.value) n from open_cells c left join base v on v.feature = c.feature and len(list_filter(e, lambda x: x <= v.value)) = c.b group by 1, 2",
    "placed_rows": "select feature_date, v.feature, len(list_filter(e, lambda x: x <= v.value)) b, count(*) n from long_daily v join open_edges using (feature) group by 1, 2, 3",
    "open_a": "select d.d feature_date, c.feature, c.b, coalesce(p.n, 0) n from open_cells c cross join days d left join placed_rows p on p.feature = c.feature and p.b = c.b and p.feature_date = d.d",
    "open_shares": """select a.feature_date, a.feature, greatest(x.n / sum(x.n) over (partition by a.feature_date, a.feature), 1e-4) p, greatest(a.n / sum(a.n) over (partition by a.feature_date, a.feature), 1e-4) q
      from open_a a join open_e x on x.feature = a.feature and x.b = a.b""",
    "open_psi": "select feature_date, feature, sum((q - p) * ln(q / p)) psi from open_shares group by 1, 2",
    "health": """select l.feature_date, l.feature, avg(value) mean, stddev_pop(value) stddev, any_value(psi) psi from long_daily l join open_psi using (feature_date, feature) group by 1, 2""",
}


def daily(shop):
    return drift.user_daily_features(shop.behavior_events, shop.orders, shop.users, "2024-01-01", 30, window=90)


@query(
    "e8_user_daily_features",
    "select user_id, strftime(feature_date, '%Y-%m-%d') feature_date, f_user_purchase_count_90d::bigint f_user_purchase_count_90d, f_user_total_orders_90d::bigint f_user_total_orders_90d, f_user_interaction_count_90d::bigint f_user_interaction_count_90d from daily_rows",
    DAILY,
)
def user_daily(shop):
    return daily(shop).withColumn("feature_date", F.col("feature_date").cast("string"))


@query("d24_feature_health", "select strftime(feature_date, '%Y-%m-%d') feature_date, feature, round(avg(value), 9) mean, round(stddev_pop(value), 9) stddev from long_daily group by 1, 2", DAILY)
def health(shop):
    rows = drift.feature_health(daily(shop))
    return rows.select(F.col("feature_date").cast("string").alias("feature_date"), "feature", F.round("mean", 9).alias("mean"), F.round("stddev", 9).alias("stddev"))


def monitored(shop):
    stored = materialize(daily(shop), "daily")
    return drift.health_and_drift(stored, ("2024-01-07", "2024-01-12"), "2024-01-15", 10, 2.0)


@query("k2_psi_open_edges", "select strftime(feature_date, '%Y-%m-%d') feature_date, feature, round(psi, 8) psi from open_psi", DAILY)
def psi_open(shop):
    return monitored(shop).select(F.col("feature_date").cast("string").alias("feature_date"), "feature", F.round("psi", 8).alias("psi"))


@query(
    "k5_drift_alerts",
    """select strftime(feature_date, '%Y-%m-%d') alert_date, feature feature_name, round(psi, 8) psi_value,
      round(1.0::double + least((feature_date - date '2024-01-15') / 10.0::double, 1.0::double), 8) drift_factor
    from open_psi where psi >= 0.0005 and feature_date >= date '2024-01-15'""",
    DAILY,
)
def alerts(shop):
    rows = drift.drift_alerts(monitored(shop), "2024-01-15", threshold=0.0005)
    return rows.select(F.col("alert_date").cast("string").alias("alert_date"), "feature_name", F.round("psi_value", 8).alias("psi_value"), "drift_factor")


@query(
    "k6_rolling_recount",
    f"""select user_id, strftime(feature_date, '%Y-%m-%d') feature_date, f_user_purchase_count_90d::bigint r_f_user_purchase_count_90d from daily_rows where {h("'off:'||user_id")} % 100 < 5""",
    DAILY,
)
def recount(shop):
    """Stored features with some users falsified; the recount finds exactly those."""
    truth = materialize(daily(shop), "daily")
    off = bucket(F.concat(F.lit("off:"), F.col("user_id").cast("string"))) < 5
    stored = truth.withColumn("f_user_purchase_count_90d", F.col("f_user_purchase_count_90d") + off.cast("int"))
    rows = drift.recount_differences(stored, truth)
    return rows.select("user_id", F.col("feature_date").cast("string").alias("feature_date"), "r_f_user_purchase_count_90d")


REPORT_SQL = """select 'user_aggregate_features' feature_table, feature, round(psi, 9) drift_score, psi < 0.15 passed,
  (select count(*) from wide where feature_timestamp < timestamp '2024-01-15') reference_rows,
  (select count(*) from wide where feature_timestamp > (select max(feature_timestamp) from wide) - interval 7 days) current_rows, 0.15::double threshold from closed_psi"""


def report(shop):
    before, after = halves(shop)
    return drift.drift_report(before, after, "user_aggregate_features")


@query("k3_g7_drift_report", REPORT_SQL, SHIFTED)
def drift_report(shop):
    return report(shop).withColumn("drift_score", F.round("drift_score", 9))


@query("k4_failed_features", "select 'user_aggregate_features' feature_table, feature, round(psi, 9) drift_score from closed_psi where psi >= 0.0005", SHIFTED)
def failing(shop):
    before, after = halves(shop)
    rows = drift.failed_features(drift.drift_report(before, after, "user_aggregate_features", threshold=0.0005))
    return rows.withColumn("drift_score", F.round("drift_score", 9))


@query("c13_d23_latest_features_with_labels", """select r.user_id, f_user_interaction_count_90d::bigint f_user_interaction_count_90d, coalesce(n, 0) orders_after, (coalesce(n, 0) > 0)::int as label
    from (select * from daily_rows where feature_date = (select max(feature_date) from daily_rows)) r
    left join (select user_id, count(*) n from shop_orders where order_timestamp >= timestamp '2024-01-20' group by 1) o on o.user_id = r.user_id""", DAILY)
def labelled(shop):
    rows = drift.latest_features_with_labels(materialize(daily(shop), "daily"), drift.post_drift_labels(shop.users, shop.orders, "2024-01-20"))
    return rows.select("user_id", "f_user_interaction_count_90d", "orders_after", "label")


@query("d25_period_conversion", """select count(*) filter (event_type='cart') carts, count(*) filter (event_type='purchase') purchases,
    count(*) filter (event_type='purchase') / (count(*) filter (event_type='cart'))::double conversion_rate from behavior_events
    where event_timestamp >= timestamp '2024-01-10' and event_timestamp < timestamp '2024-01-21'""")
def conversion(shop):
    return drift.conversion_rate(shop.behavior_events, "2024-01-10", "2024-01-20")


@query("h27_nearest_rank_percentiles", """select user_id, 0.5::double probability, quantile_disc(price, 0.5)::double quantile from behavior_events group by 1
    union all select user_id, 0.95::double, quantile_disc(price, 0.95)::double from behavior_events group by 1""")
def nearest_rank(shop):
    rows = shop.behavior_events.select("user_id", "price")
    return quantiles(rows, ["user_id"], "price", [0.5, 0.95], nearest_rank=True)


# Ranking

GROUPS = {
    "places": "select *, row_number() over (partition by group_id order by score desc, prediction_id) place from predictions",
    "group_pos": "select group_id, sum(label)::int npos from predictions group by 1",
    "ideal": "select n, sum(1.0::double / log2(i + 2)) best from range(1, 11) t(n), range(0, 10) s(i) where i < n group by 1",
    "group_scores": """select p.group_id, max((label > 0 and place <= 5)::int)::double hitrate_5,
        case when any_value(npos) > 0 then sum(case when label > 0 and place <= 5 then 1.0::double / log2(place + 1) else 0 end) / any_value(i5.best) else 0 end ndcg_5,
        coalesce(1.0::double / min(case when label > 0 and place <= 5 then place end), 0) mrr_5, max((label > 0 and place <= 10)::int)::double hitrate_10,
        case when any_value(npos) > 0 then sum(case when label > 0 and place <= 10 then 1.0::double / log2(place + 1) else 0 end) / any_value(i10.best) else 0 end ndcg_10,
        coalesce(1.0::double / min(case when label > 0 and place <= 10 then place end), 0) mrr_10
      from places p join group_pos using (group_id) left join ideal i5 on i5.n = least(npos, 5) left join ideal i10 on i10.n = least(npos, 10) group by 1""",
    "pair_wins": """select group_id, sum(case when a.score > b.score then 1.0::double when a.score = b.score then 0.5::double else 0 end) / count(*) auc, count(distinct a.prediction_id) positives, count(distinct b.prediction_id) negatives
      from predictions a join predictions b using (group_id) where a.label = 1 and b.label = 0 group by 1""",
    "ranked_all": "select label, rank() over (order by score) + (count(*) over (partition by score) - 1) / 2.0::double r from predictions",
    "overall": "select (sum(r) filter (label = 1) - count(*) filter (label = 1) * (count(*) filter (label = 1) + 1) / 2.0::double) / (count(*) filter (label = 1)::double * count(*) filter (label = 0)) auc from ranked_all",
}


@query("e11_position_in_group", "select prediction_id, group_id, place as position from places", GROUPS)
def positions(shop):
    rows = shop.predictions.select("prediction_id", "group_id", "score")
    return ranking.rank_in_group(rows, ["group_id"], "prediction_id").drop("score")


@query("k13_auc", "select (select sum(label)::bigint from predictions) positives, (select sum(1 - label)::bigint from predictions) negatives, round(auc, 10) auc from overall", GROUPS)
def auc(shop):
    return ranking.auc(shop.predictions.select("score", "label")).withColumn("auc", F.round("auc", 10))


@query("k14_group_auc", "select group_id, positives, negatives, round(auc, 10) auc from pair_wins", GROUPS)
def group_auc(shop):
    return ranking.group_auc(shop.predictions.select("group_id", "score", "label"), ["group_id"]).withColumn("auc", F.round("auc", 10))


@query(
    "k14_ranking_report",
    """select count(*) num_groups, round(avg(hitrate_5),8) hitrate_5, round(avg(ndcg_5),8) ndcg_5, round(avg(mrr_5),8) mrr_5, round(avg(hitrate_10),8) hitrate_10, round(avg(ndcg_10),8) ndcg_10,
      round(avg(mrr_10),8) mrr_10, (select round(avg(auc),8) from pair_wins) gauc, (select count(*) from pair_wins) valid_auc_groups, (select round(auc,8) from overall) auc from group_scores""",
    GROUPS,
)
def ranking_report(shop):
    scored = materialize(shop.predictions.select("prediction_id", "group_id", "score", "label"), "scored")
    row = ranking.ranking_report(scored, ["group_id"], "prediction_id", [5, 10])
    return row.select(*[c if c in ("num_groups", "valid_auc_groups") else F.round(c, 8).alias(c) for c in row.columns])


@query("k15_ranking_group_key", """select event_id, coalesce(nullif(request_id, 'req-0'), nullif(impression_id, ''), user_id||':'||epoch_us(event_timestamp)//1000000) group_key from behavior_events""")
def group_key(shop):
    request = F.nullif(F.col("request_id"), F.lit("req-0"))
    return shop.behavior_events.select(
        "event_id", ranking.group_key(request, F.col("impression_id"), F.col("user_id"), F.unix_seconds("event_timestamp")).alias("group_key")
    )


@query("f2_top_recommendations", "select user_id, prediction_id, score, r::int as rank from (select *, row_number() over (partition by user_id order by score desc, prediction_id) r from predictions) where r <= 10")
def recommendations(shop):
    return ranking.top_recommendations(shop.predictions.select("user_id", "prediction_id", "score"), "user_id", "prediction_id", 10)


@query("f9_first_rows_per_class", "select prediction_id, label, r::int place from (select *, row_number() over (partition by label order by prediction_id) r from predictions) where r <= 50")
def first_per_class(shop):
    return ranking.first_per_class(shop.predictions.select("prediction_id", "label"), "label", [F.asc("prediction_id")], 50)


# Experiments

ARMS = {
    "log": f"""select *, case when {h("'exp-1:'||user_id")} % 100 < 40 then 'candidate' else 'control' end as variant, 'exp-'||(group_id % 3) experiment_id from predictions""",
    "arms": """select experiment_id, variant, count(*) samples, avg(is_error::double) error_rate, avg(confidence) quality, quantile_cont(latency_seconds, 0.95) p95 from log group by 1, 2""",
    "gates": """select a.experiment_id, a.samples candidate_samples, b.samples control_samples, a.error_rate ae, b.error_rate be, a.p95 ap, b.p95 bp, a.quality aq, b.quality bq
      from (select * from arms where variant = 'candidate') a join (select * from arms where variant = 'control') b using (experiment_id)""",
    "verdicts": """select *, case when candidate_samples < 100 or control_samples < 100 then 'samples' else
        concat_ws(',', case when ae > be + 0.0005 then 'error' end, case when bp > 0 and ap > bp * 1.0005 then 'latency' end, case when bq > 0 and aq < bq * 0.999 then 'quality' end) end reasons from gates""",
}


def prediction_log(shop):
    return shop.predictions.withColumn("variant", variant(F.col("user_id"), "exp-1", 40)).withColumn(
        "experiment_id", F.concat(F.lit("exp-"), F.pmod("group_id", F.lit(3)).cast("string"))
    )


@query(
    "k25_experiment_gate",
    """select experiment_id, candidate_samples, control_samples, round(ae,8) candidate_error_rate, round(ap,8) candidate_p95_latency, round(aq,8) candidate_quality, reasons,
      case when reasons = 'samples' then 'hold' when reasons = '' then 'promote' else 'rollback' end decision from verdicts""",
    ARMS,
)
def gate(shop):
    rows = experiments.experiment_gate(prediction_log(shop), "experiment_id", max_error_delta=0.0005, max_latency_ratio=1.0005, min_quality_ratio=0.999)
    rounded = [F.round(c, 8).alias(c) for c in ("candidate_error_rate", "candidate_p95_latency", "candidate_quality")]
    return rows.select("experiment_id", "candidate_samples", "control_samples", *rounded, "reasons", "decision")


@query("d30_assignment_summary", "select variant, count(*) assignments, round(avg(score),8) mean_score from log group by 1", ARMS)
def assignments(shop):
    rows = experiments.assignment_summary(prediction_log(shop))
    return rows.withColumn("mean_score", F.round("mean_score", 8))


@query("d30_confidence_histogram", "select floor(score*10)::int as bucket, count(*) n from log group by 1", ARMS)
def confidence(shop):
    return experiments.confidence_histogram(prediction_log(shop), "score")


@query(
    "d29_request_rates",
    """select time_bucket(interval 1 minute, event_timestamp) as minute, source route, count(*) requests, avg((event_type='search')::int) failure_ratio, round(avg(price::double), 8) mean_latency from behavior_events group by 1, 2""",
)
def request_rates(shop):
    rows = shop.behavior_events.withColumn("failed", F.col("event_type") == "search").withColumn("price", F.col("price").cast("double"))
    out = experiments.request_rates(rows, "event_timestamp", "source", "failed", "price").withColumnRenamed("source", "route")
    return out.withColumn("mean_latency", F.round("mean_latency", 8))


# Online views

ONLINE = {
    **FEATURE_VIEWS,
    "newest_user": "select * exclude (r) from (select user_id, event_id, feature_timestamp, views_30m, row_number() over (partition by user_id order by feature_timestamp desc, views_30m desc) r from aggregates) where r = 1",
    "pool_rows": """select product_id, feature_timestamp, event_id, unnest(['candidate:trending:1h', 'candidate:trending:category:'||category_id, 'candidate:popular:global', 'candidate:popular:category:'||category_id]) pool_key,
        unnest([(views_1h + 3*carts_1h + 10*purchases_24h)::double, (views_1h + 3*carts_1h + 10*purchases_24h)::double, popularity_score, popularity_score]) score from items""",
    "members": "select * from (select pool_key, product_id, score, row_number() over (partition by pool_key, product_id order by feature_timestamp desc, event_id desc) r from pool_rows) where r = 1",
    "pools": "select * from (select pool_key, product_id, score, (row_number() over (partition by pool_key order by score desc, product_id desc))::int as rank from members) where rank <= 20",
    "personal": """select * from (select user_id, product_id, score, (row_number() over (partition by user_id order by score desc, product_id desc))::int as rank from (
        select t.user_id, p.product_id, max(p.score) score from (select distinct user_id, category_id from behavior_events where event_type = 'purchase') t
        join pools p on p.pool_key = 'candidate:popular:category:'||t.category_id group by 1, 2)) where rank <= 20""",
    "offered": """select user_id, product_id, rank as position from personal where rank <= 10 union all
      select u.user_id, p.product_id, p.rank from users u, pools p where p.pool_key = 'candidate:popular:global' and p.rank <= 10 and u.user_id not in (select user_id from personal)""",
}


def item_rows(shop):
    return materialize(features.item_features(shop.behavior_events, shop.product_snapshots), "items")


def online_users(shop):
    rows = features.user_aggregate_features(shop.behavior_events)
    return rows.select("user_id", F.col("feature_timestamp").alias("updated_at"), F.col("views_30m").cast("string").alias("payload"))


@query("a19_online_newest_wins", "select user_id, feature_timestamp updated_at, views_30m::varchar payload, feature_timestamp + interval 24 hours expires_at from newest_user", ONLINE)
def newest_wins(shop):
    rows = materialize(online_users(shop), "online")
    early = online.newest_wins(None, rows.filter(F.col("updated_at") < F.lit("2024-01-20").cast("timestamp")), "user_id", "user_aggregate")
    return online.newest_wins(early, rows, "user_id", "user_aggregate")


@query(
    "k24_incremental_materialization",
    "select user_id, feature_timestamp updated_at, views_30m::varchar payload, feature_timestamp + interval 24 hours expires_at from newest_user",
    ONLINE,
)
def materialization(shop):
    """A first run up to day 15 and an increment to the end equal the newest rows."""
    source = materialize(online_users(shop).withColumnRenamed("updated_at", "feature_timestamp"), "online")
    first = online.materialize_increment(None, source, "user_id", None, "2024-01-15", "user_aggregate")
    return online.materialize_increment(materialize(first, "first"), source, "user_id", "2024-01-15", "2024-02-01", "user_aggregate")


@query("d27_source_bounds", "select min(low) - interval 1 microsecond start_ts, max(high) + interval 1 microsecond end_ts from (select min(feature_timestamp) low, max(feature_timestamp) high from aggregates union all select min(feature_timestamp), max(feature_timestamp) from items)", ONLINE)
def bounds(shop):
    return online.source_bounds([features.user_aggregate_features(shop.behavior_events), features.item_features(shop.behavior_events, None)])


@query("f4_pool_updates", "select product_id, event_id, pool_key, score from pool_rows", ONLINE)
def pool_updates(shop):
    return online.pool_updates(item_rows(shop)).select("product_id", "event_id", "pool_key", "score")


def pools(shop, items=None):
    return materialize(online.candidate_pools(online.pool_updates(items or item_rows(shop)), 20), "pools")


def personal(shop, built):
    bought = shop.behavior_events.filter(F.col("event_type") == "purchase")
    return materialize(online.user_pools(built, bought, 20), "personal")


@query("f3_candidate_pools", "select pool_key, product_id, score, rank from pools", ONLINE)
def candidate_pools(shop):
    return pools(shop)


@query("k33_candidate_scoring_input", """select o.user_id, o.product_id, o.position, i.category_id target_category, u.views_30m from offered o
    left join (select product_id, arg_max(category_id, (feature_timestamp, event_id)) category_id from items group by 1) i using (product_id) left join newest_user u on u.user_id = o.user_id""", ONLINE)
def scoring_input(shop):
    items = item_rows(shop)
    built = pools(shop, items)
    newest_items = features.latest_per_key(items, ["product_id"], "feature_timestamp", ["event_id"]).select("product_id", F.col("category_id").alias("target_category"))
    newest_users = features.latest_per_key(features.user_aggregate_features(shop.behavior_events), ["user_id"], "feature_timestamp", ["views_30m"]).select("user_id", "views_30m")
    offered = online.candidates(shop.users, personal(shop, built), built, 10)
    return offered.join(newest_items, "product_id", "left").join(newest_users, "user_id", "left").select("user_id", "product_id", "position", "target_category", "views_30m")


@query("c16_candidates_with_fallback", "select user_id, product_id, position from offered", ONLINE)
def candidates(shop):
    built = pools(shop)
    return online.candidates(shop.users, personal(shop, built), built, 10)


@query(
    "c16_online_lookup_with_fallback",
    f"""select u.user_id, case when r.user_id is not null then r.views_30m::varchar when b.n is not null then b.n::varchar end payload,
      case when r.user_id is not null then 'realtime' when b.n is not null then 'batch' else 'none' end origin
    from users u left join (select * from newest_user where {h("'rt:'||user_id")} % 100 < 40) r using (user_id) left join (select user_id, count(*) n from behavior_events group by 1) b using (user_id)""",
    ONLINE,
)
def lookup(shop):
    newest = online.newest_wins(None, online_users(shop), "user_id", "user_aggregate")
    realtime = newest.filter(bucket(F.concat(F.lit("rt:"), F.col("user_id").cast("string"))) < 40)
    batch = shop.behavior_events.groupBy("user_id").agg(F.count(F.lit(1)).cast("string").alias("payload"))
    return online.lookup_with_fallback(shop.users.select("user_id"), realtime, batch, "user_id")


ASKED = {**ONLINE, "asked": "select event_id request_id, [product_id, category_id, product_id, brand_id, product_id + category_id] ids from behavior_events"}


def asked(shop):
    """A list of wanted ids per event, with repeats."""
    ids = F.array("product_id", "category_id", "product_id", "brand_id", F.col("product_id") + F.col("category_id"))
    return shop.behavior_events.select(F.col("event_id").alias("request_id"), ids.alias("ids"))


@query("c17_ordered_lookup", "select request_id, o - 1 as position, x product_id, p.brand_name from (select request_id, unnest(ids) x, generate_subscripts(ids, 1)::int o from asked) left join products p on p.product_id = x", ASKED)
def ordered_lookup(shop):
    return online.lookup_in_order(asked(shop), "ids", shop.products.select("product_id", "brand_name"), "product_id")


@query("f5_first_occurrences", """select request_id, array_to_string(list_transform(list_sort(list_transform(list_distinct(ids), lambda x: [list_position(ids, x), x])), lambda p: p[2])[:3], ',') ids from asked""", ASKED)
def first_occurrences(shop):
    return online.first_occurrences(asked(shop), "request_id", "ids", 3).select("request_id", text("ids"))


@query(
    "c20_online_feature_assembly",
    """select o.user_id, o.product_id, o.position, p.brand_name, u.country from (
      select o.* from offered o join users u on u.user_id = o.user_id where not u.is_active
      union all select user_id, unnest([user_id + 1, user_id, user_id + 1]), unnest([1, 2, 3])::int from users where is_active) o
    left join products p using (product_id) left join users u on u.user_id = o.user_id""",
    ONLINE,
)
def assembly(shop):
    """Active users ask with three candidates of their own, one twice; the others take theirs from the pools."""
    built = pools(shop)
    given = F.array(F.col("user_id") + 1, F.col("user_id"), F.col("user_id") + 1)
    requests = shop.users.select("user_id", F.when(F.col("is_active"), given).otherwise(F.array().cast("array<bigint>")).alias("candidates"))
    return online.online_features(
        requests, built, personal(shop, built), shop.products.select("product_id", "brand_name"), shop.users.select("user_id", "country"), 2
    )


@query(
    "k38_recommendation_impressions",
    f"""select 'r-'||request_id||'-'||o impression_id, request_id, x candidate_product_id, o rank_position, 'bst_online_ranking' candidate_source, false is_clicked, 2 schema_version
    from (select request_id, unnest(ids) x, generate_subscripts(ids, 1)::int o from asked) where {h("'r-'||request_id||'-'||o")} % 100 >= 25""",
    ASKED,
)
def recommendation_impressions(shop):
    items = F.transform(
        "ids", lambda x, i: F.struct(F.concat(F.lit("r-"), F.col("request_id"), F.lit("-"), (i + 1).cast("string")).alias("impression_id"), x.alias("item_id"), unit_interval(x.cast("string")).alias("score"))
    )
    lists = asked(shop).select("request_id", F.lit(1).alias("user_id"), F.lit("s").alias("session_id"), items.alias("items"))
    every = lists.select(F.explode("items.impression_id").alias("impression_id"))
    recorded = every.filter(bucket(F.col("impression_id")) < 25)
    rows = online.recommendation_rows(lists, recorded, F.lit("2024-02-01").cast("timestamp"))
    return rows.select("impression_id", "request_id", "candidate_product_id", "rank_position", "candidate_source", "is_clicked", "schema_version")
