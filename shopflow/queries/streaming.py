"""Event stream queries. Each hop of the stream runs once per data folder and session, when a query first reads its tables."""

import re
from functools import partial, reduce

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from shopflow.functions.hashing import bucket
from shopflow.operators import experiments
from shopflow.operators.features import latest_per_key
from shopflow.plans.hot_keys import top_k
from shopflow.plans.storage import materialize, scratch_path
from shopflow.queries.features import text
from shopflow.queries.prelude import h
from shopflow.queries.registry import query
from shopflow.session import state_partitions, streaming_session
from shopflow.sources import cdc
from shopflow.streaming import injection, jobs, lateness, sinks
from shopflow.streaming.config import StreamConfig

FLAGGED = ["event_id", "event_timestamp", "user_id", "product_id", "event_type", "price", "payload_hash", "record_timestamp", "is_duplicate", "late_by_seconds", "is_late", "is_too_late"]
ROLLING = {
    "ordered_kept": "select *, epoch_us(event_timestamp) us, (epoch_us(event_timestamp)//1000) // 60000 as minute from kept",
    "last_user": "select * from (select user_id, event_id, event_timestamp, us, minute, row_number() over (partition by user_id order by event_timestamp desc, event_id desc) r from ordered_kept) where r = 1",
    "last_item": "select * from (select *, row_number() over (partition by product_id order by event_timestamp desc, event_id desc) r from ordered_kept) where r = 1",
    "user_history": "select l.user_id, l.us now, e.* exclude (user_id) from last_user l join ordered_kept e on e.user_id = l.user_id and e.minute > l.minute - 10080",
    "item_history": "select l.product_id, l.us now, e.* exclude (product_id) from last_item l join ordered_kept e on e.product_id = l.product_id and e.minute > l.minute - 10080",
}


class Replay:
    """The stream over change records, landed in two parts. A hop behind the flagged events runs, over both, when its tables are first asked for."""

    HOP_OF = {
        "streaming_quality_windows": "quality", "stream_user_features": "users", "stream_user_sequence_features": "users", "stream_user_aggregate_features": "users",
        "stream_item_features": "items", "stream_user_panes": "panes", "stream_firings_user_id": "user_firings", "stream_firings_product_id": "item_firings",
        "stream_behavior_events": None, "stream_late_events_dlq": None,
    }

    def __init__(self, spark, records: DataFrame, rows: int):
        self.session, states = streaming_session(spark, rows), state_partitions(spark, rows)
        self.records, self.states, self.landing = records, states, scratch_path(spark, "landing")
        self.job = jobs.StreamJob(self.session, scratch_path(spark, "stream"), StreamConfig().for_partitions(states))
        self.first: int | None = None  # last batch of the first part
        self.flagged, self.done = False, set()

    def flag(self, part):
        self.records.filter(part).repartition(self.states).write.mode("append").parquet(self.landing)  # else as few files as the events have
        return self.job.flag_events(self.session.readStream.schema(jobs.RECORD_SCHEMA).parquet(self.landing))

    @staticmethod
    def start(job: jobs.StreamJob, hops: list[str], last: bool) -> list:
        starts = {
            "quality": job.quality_windows, "users": job.user_features, "items": job.item_features, "panes": job.user_panes,
            "user_firings": partial(job.firings, "user_id", last=last), "item_firings": partial(job.firings, "product_id", last=last),
        }
        return [starts[hop]() for hop in hops]

    def run(self, tables) -> None:
        """Flag the events and run the hops that feed the tables, each over the first part and then over all."""
        hops = sorted({self.HOP_OF[name] for name in tables} - {None} - self.done)
        early = F.col("record_timestamp") < F.lit("2024-01-16").cast("timestamp")
        behind = []
        if not self.flagged:
            self.flag(early).awaitTermination()
            self.first = self.job.last_batch()
        if self.first is not None:
            # All but the panes, which are not shown before the end.
            behind = self.start(self.job.up_to(self.first), [hop for hop in hops if hop != "panes"], last=False)
        if not self.flagged:
            behind.append(self.flag(~early))  # flagged while the first part runs through the hops behind
        jobs.finish(behind)
        self.flagged = True
        jobs.finish(self.start(self.job, hops, last=True))
        self.done |= set(hops)


_REPLAYS: dict[tuple[str, str], Replay] = {}


def stream_job(shop, *tables: str) -> jobs.StreamJob:
    """The stream over the folder's change records, with the tables filled."""
    key = (shop.spark.sparkContext.applicationId, shop.folder)
    replay = _REPLAYS.get(key)
    if replay is None:
        counted = Observation()
        records = materialize(shop.change_records(shop.raw_events).observe(counted, F.count(F.lit(1)).alias("rows")), "records")
        replay = Replay(shop.spark, records, counted.get["rows"])
    replay.run(tables)
    _REPLAYS[key] = replay
    return replay.job


def table(shop, name):
    return shop.spark.read.parquet(stream_job(shop, name).path(name))


@query("i1_event_time_fallback", f"select event_id, case when {h('event_id')} % 10 = 0 then ingestion_ts else event_timestamp end event_time from behavior_events")
def event_time(shop):
    stamp = F.date_format("event_timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
    broken = bucket(F.col("event_id"), 10) == 0
    return shop.behavior_events.select(
        "event_id", lateness.event_time(F.when(broken, "soon").otherwise(stamp), F.col("ingestion_ts")).alias("event_time")
    )


@query("i3_i4_flagged_stream", f"select {', '.join(FLAGGED)} from flagged")
def flagged(shop):
    return table(shop, "stream_behavior_events").select(*FLAGGED)


@query("i4_batch_twin_of_flags", f"select {', '.join(FLAGGED)} from flagged")
def batch_twin(shop):
    rows = cdc.normalize(materialize(shop.change_records(shop.raw_events), "records"))
    return lateness.classify(lateness.mark_duplicates(rows), StreamConfig()).select(*FLAGGED)


@query(
    "i5_late_counters",
    "select count(*) filter (is_late) late_arrivals_total, count(*) filter (is_late and not is_too_late) accepted_late_events_total, count(*) filter (is_late and is_too_late) too_late_events_total from flagged",
)
def counters(shop):
    return lateness.late_counters(table(shop, "stream_behavior_events"))


QUALITY = {
    "windows": """select time_bucket(interval 60 seconds, event_timestamp) window_start, time_bucket(interval 60 seconds, event_timestamp) + interval 60 seconds window_end, 'cdc.behavior_events' topic,
        count(*) event_count, count(*) filter (is_late) late_event_count, count(*) filter (is_duplicate) duplicate_event_count, max(late_by_seconds) max_late_by_seconds, count(*) >= 500 is_bursty
      from flagged where not is_too_late group by 1, 2""",
    "side": "select time_bucket(interval 60 seconds, event_timestamp) window_start, count(*) n from flagged where is_too_late group by 1",
    "quality": "select w.*, coalesce(n, 0) side_output_late_events, coalesce(n, 0) late_events_dropped from windows w left join side using (window_start)",
}


@query("i2_i6_i7_quality_windows", "select * from quality", QUALITY)
def quality_windows(shop):
    return stream_job(shop, "streaming_quality_windows").current_quality_windows()


@query("d30_late_and_duplicate_ratio", "select window_start, late_event_count / event_count::double late_ratio, duplicate_event_count / event_count::double duplicate_ratio from windows", QUALITY)
def ratios(shop):
    return experiments.late_and_duplicate_ratio(lateness.quality_counts(table(shop, "stream_behavior_events"), StreamConfig()))


@query(
    "i24_window_metric_lines",
    """select window_start, '{"drop_late_events":true,"duplicate_event_count":'||duplicate_event_count||',"event_count":'||event_count||',"is_bursty":'||is_bursty||',"late_event_count":'||late_event_count||
      ',"late_events_dropped":'||late_events_dropped||',"side_output_late_events":'||side_output_late_events||',"status":"streaming_quality_window_metrics","topic":"cdc.behavior_events","window_end":"'||
      strftime(window_end, '%Y-%m-%dT%H:%M:%SZ')||'","window_start":"'||strftime(window_start, '%Y-%m-%dT%H:%M:%SZ')||'"}' line, max_late_by_seconds::double max_late_by_seconds from quality""",
    QUALITY,
)
def metric_lines(shop):
    lines = lateness.metric_lines(stream_job(shop, "streaming_quality_windows").current_quality_windows(), StreamConfig())
    latest = F.get_json_object("line", "$.max_late_by_seconds").cast("double")  # engines write numbers differently, so it is compared as one
    return lines.withColumn("max_late_by_seconds", latest).withColumn("line", F.regexp_replace("line", '"max_late_by_seconds":[0-9.E-]+,', ""))


@query(
    "i8_a21_dead_letters",
    """select event_id, user_id, product_id, event_type, event_timestamp, late_by_seconds, 300::bigint allowed_lateness_seconds, 'cdc.behavior_events' source_topic, payload_hash, 'too_late_for_feature_update' reason,
      event_id payload_event_id, request_id payload_request_id, epoch_us(record_timestamp) payload_record_us, price::double payload_price
    from (select *, row_number() over (partition by event_id order by record_timestamp, payload_hash) r from flagged where is_too_late) where r = 1""",
)
def dead_letters(shop):
    """One letter per event and reason, the first copy to arrive."""
    letters = stream_job(shop, "stream_late_events_dlq").contract_table("stream_late_events_dlq").drop("processed_timestamp", "created_timestamp")
    field = lambda name: F.get_json_object("payload", f"$.{name}")
    return letters.withColumns({
        "payload_event_id": field("event_id"), "payload_request_id": field("request_id"),
        "payload_record_us": F.unix_micros(F.to_timestamp(field("record_timestamp"))), "payload_price": field("price").cast("double"),
    }).drop("payload")


# The stream is landed in two parts, so an open pane that changed fires early after each of them.
FIRINGS = {
    "on_panes": """select *, ms // 60000 * 60000 pane, is_late and ms + round(late_by_seconds * 1000)::bigint >= ms // 60000 * 60000 + 59999 after_close,
        record_timestamp < timestamp '2024-01-16' first_part from (select *, epoch_us(event_timestamp) // 1000 ms from kept)""",
    "marks": "select max(epoch_us(event_timestamp) // 1000) filter (record_timestamp < timestamp '2024-01-16') - 3600000 w1, max(epoch_us(event_timestamp) // 1000) - 3600000 w2 from flagged",
}


def firings_sql(key: str) -> str:
    totals = "count(*) event_count, count(*) filter (event_type = 'view') views, count(*) filter (event_type = 'cart') carts, count(*) filter (event_type = 'purchase') purchases, max(event_timestamp) last_event_timestamp"
    running = totals.split(", ")
    over = f"over (partition by {key}, pane order by after_close, case when after_close then record_timestamp end, case when after_close then event_id end)"
    later = ", ".join(re.sub(r" (\w+)$", rf" {over} \1", part) for part in running)
    return f"""
    select {key}, make_timestamp(pane * 1000) window_start, make_timestamp((pane + 60000) * 1000) window_end, firing, event_count, views, carts, purchases, last_event_timestamp from (
      select {key}, pane, 'early' firing, {totals} from on_panes, marks where not after_close and first_part and w1 < pane + 59999 group by {key}, pane
      union all select {key}, pane, 'early', {totals} from on_panes, marks where not after_close and w2 < pane + 59999 group by {key}, pane having count(*) filter (not first_part) > 0
      union all select {key}, pane, 'close', {totals} from on_panes, marks where not after_close and w2 >= pane + 59999 group by {key}, pane
      union all select {key}, pane, 'late', event_count, views, carts, purchases, last_event_timestamp from (select {key}, pane, after_close, {later} from on_panes) where after_close)"""


@query("i10_user_pane_firings", firings_sql("user_id"), FIRINGS)
def user_firings(shop):
    """Early, closing and late firings of user panes with the totals they show."""
    return table(shop, "stream_firings_user_id").drop("revision", "batch_id")


@query("i9_i10_item_pane_firings", firings_sql("product_id"), FIRINGS)
def item_firings(shop):
    return table(shop, "stream_firings_product_id").drop("revision", "batch_id")


@query(
    "i9_item_panes",
    """select product_id, w window_start, w + interval 60 seconds window_end, n event_count, v views, c carts, p purchases, last_event_timestamp
    from (select product_id, time_bucket(interval 60 seconds, event_timestamp) w, count(*) n, count(*) filter (event_type='view') v, count(*) filter (event_type='cart') c, count(*) filter (event_type='purchase') p,
      max(event_timestamp) last_event_timestamp from kept group by 1, 2)""",
)
def item_panes(shop):
    """Last firing of every item pane."""
    newest = top_k(table(shop, "stream_firings_product_id"), ["product_id", "window_start"], [F.desc("revision")], 1, "_rank")
    return newest.drop("_rank", "revision", "firing", "batch_id")


@query("b10_feature_events", "select event_id, event_timestamp, event_type from kept")
def feature_events(shop):
    rows = lateness.feature_events(table(shop, "stream_behavior_events"), StreamConfig())
    return rows.select("event_id", "event_timestamp", "event_type")


@query(
    "i9_i11_user_panes",
    """select user_id, w window_start, w + interval 60 seconds window_end, n event_count, v views, c carts, p purchases, last_event_timestamp,
      (select max((epoch_us(event_timestamp)//1000)) from flagged) - 3600000 >= (epoch_us(w + interval 60 seconds)//1000) - 1 is_final
    from (select user_id, time_bucket(interval 60 seconds, event_timestamp) w, count(*) n, count(*) filter (event_type='view') v, count(*) filter (event_type='cart') c, count(*) filter (event_type='purchase') p,
      max(event_timestamp) last_event_timestamp from kept group by 1, 2)""",
)
def panes(shop):
    return stream_job(shop, "stream_user_panes").current_panes()


USER_ROLLING = """
    select h.user_id, l.event_id, l.event_timestamp feature_timestamp, count(*) filter (h.event_type='view' and h.us > now - 1800000000)::int views_30m, count(*) filter (h.event_type='cart' and h.us > now - 1800000000)::int carts_30m,
      count(*) filter (h.event_type='purchase' and h.us > now - 86400000000)::int purchases_24h, count(distinct h.category_id)::int distinct_categories_7d,
      round(case when count(*) filter (h.event_type='view') > 0 then sum(h.price) filter (h.event_type='view') / count(*) filter (h.event_type='view') else 0 end, 6) avg_viewed_price_7d,
      case when count(*) filter (h.event_type='cart') > 0 then count(*) filter (h.event_type='purchase') / (count(*) filter (h.event_type='cart'))::double else 0.0 end cart_to_purchase_ratio_7d,
      array_to_string(list(h.product_id order by h.event_timestamp, h.event_id)[-50:], ',') hist_item_ids, array_to_string(list(h.event_type_id order by h.event_timestamp, h.event_id)[-50:], ',') hist_event_type_ids,
      least(count(*), 50)::int hist_length, time_bucket(interval 60 seconds, l.event_timestamp) window_start
    from user_history h join last_user l on l.user_id = h.user_id group by h.user_id, l.event_id, l.event_timestamp"""
USER_COLUMNS = ["user_id", "event_id", "feature_timestamp", "views_30m", "carts_30m", "purchases_24h", "distinct_categories_7d", "avg_viewed_price_7d", "cart_to_purchase_ratio_7d", "hist_item_ids", "hist_event_type_ids", "hist_length", "window_start"]


@query("i12_i13_rolling_user_state", USER_ROLLING, ROLLING)
def rolling_users(shop):
    newest = latest_per_key(table(shop, "stream_user_features"), ["user_id"], "batch_id")
    out = newest.select(*[text(c) if c.startswith("hist_") and c.endswith("ids") else c for c in USER_COLUMNS])
    return out.withColumn("avg_viewed_price_7d", F.round("avg_viewed_price_7d", 6))


ITEM_ROLLING = """
    select h.product_id, l.event_id, l.event_timestamp feature_timestamp, l.category_id, l.brand_id, l.price_bucket, true is_active, count(*) filter (h.event_type='view' and h.us > now - 3600000000)::int views_1h,
      count(*) filter (h.event_type='view' and h.us > now - 86400000000)::int views_24h, count(*) filter (h.event_type='cart' and h.us > now - 3600000000)::int carts_1h, count(*) filter (h.event_type='cart' and h.us > now - 86400000000)::int carts_24h,
      count(*) filter (h.event_type='purchase' and h.us > now - 86400000000)::int purchases_24h, count(*) filter (h.event_type='purchase')::int purchases_7d,
      (count(*) filter (h.event_type='purchase') + 1.0::double) / (count(*) filter (h.event_type='view') + 10.0::double) conversion_rate_7d,
      (count(*) filter (h.event_type='view' and h.us > now - 86400000000) + 3*count(*) filter (h.event_type='cart' and h.us > now - 86400000000) + 10*count(*) filter (h.event_type='purchase' and h.us > now - 86400000000))::double popularity_score
    from item_history h join last_item l on l.product_id = h.product_id group by h.product_id, l.event_id, l.event_timestamp, l.category_id, l.brand_id, l.price_bucket"""


@query("i14_rolling_item_state", ITEM_ROLLING, ROLLING)
def rolling_items(shop):
    newest = latest_per_key(table(shop, "stream_item_features"), ["product_id"], "batch_id")
    return newest.drop("batch_id", "window_start", "window_end", "late_revision")


@query("a19_stream_online_view", "select user_id, event_timestamp updated_at, event_timestamp + interval 24 hours expires_at, event_id from last_user", ROLLING)
def stream_online(shop):
    rows = stream_job(shop, "stream_user_features").online_view("stream_user_features", "user_id", "user_aggregate")
    return rows.select("user_id", "updated_at", "expires_at", F.get_json_object("payload", "$.event_id").alias("event_id"))


@query("i18_a20_offline_feature_rows", "select product_id, count(*) as rows, max(event_timestamp) newest from (select distinct product_id, event_id, event_timestamp from batch_last) group by 1",
       {**ROLLING, "batch_last": "select product_id, event_id, event_timestamp from (select *, row_number() over (partition by product_id order by event_timestamp desc, event_id desc) r from ordered_kept where record_timestamp < timestamp '2024-01-16') where r = 1 union all select product_id, event_id, event_timestamp from last_item where product_id in (select product_id from ordered_kept where record_timestamp >= timestamp '2024-01-16')"})
def offline_rows(shop):
    """Feature history of the items: one row per source event that closed a batch."""
    rows = stream_job(shop, "stream_item_features").offline_rows("stream_item_features", "product_id")
    return rows.groupBy("product_id").agg(F.count(F.lit(1)).alias("rows"), F.max("feature_timestamp").alias("newest"))


PARTS = {"first": "record_timestamp < timestamp '2024-01-16'", "second": "true"}


def both_parts(sql: str) -> dict[str, str]:
    """Views of the rolling answer after each part of the stream; the second covers the entities it touched."""
    views = {}
    for part, rows in PARTS.items():
        renamed = {name: f"{part}_{name}" for name in ROLLING}
        swap = lambda q: re.sub(r"\b(" + "|".join(renamed) + r")\b", lambda m: renamed[m[1]], q)  # noqa: B023, E731
        views |= {renamed[n]: swap(q).replace("from kept", f"from kept where {rows}") for n, q in ROLLING.items()}
        views[f"{part}_rows"] = swap(sql)
    return views


def offline_sql(sql: str, key: str, columns: str) -> tuple[str, dict[str, str]]:
    touched = f"(select {key} from kept where record_timestamp >= timestamp '2024-01-16')"
    kept = f"select * from second_rows where {key} in {touched} union all select * from first_rows where event_id not in (select event_id from second_rows where {key} in {touched})"
    return f"select event_id source_event_id, {columns} from ({kept})", both_parts(sql)


@query("a20_user_sequence_rows", *offline_sql(USER_ROLLING, "user_id", "user_id, feature_timestamp, hist_length sequence_length, 50 max_history_length, hist_item_ids item_ids, hist_event_type_ids event_type_ids, 'bst_sequence_v2' feature_version"))
def sequence_rows(shop):
    """One row per source event that closed a batch of its user."""
    rows = stream_job(shop, "stream_user_sequence_features").contract_table("stream_user_sequence_features")
    listed = lambda name: F.regexp_replace(F.get_json_object("feature_payload", f"$.{name}"), r"[\[\]]", "").alias(name)
    return rows.select("*", listed("item_ids"), listed("event_type_ids")).drop("feature_payload")


@query("a20_user_aggregate_rows", *offline_sql(USER_ROLLING, "user_id", "user_id, feature_timestamp, views_30m, carts_30m, purchases_24h, distinct_categories_7d, avg_viewed_price_7d, cart_to_purchase_ratio_7d, 'user_aggregate_v1' feature_version"))
def aggregate_rows(shop):
    rows = stream_job(shop, "stream_user_aggregate_features").contract_table("stream_user_aggregate_features")
    number = lambda name, kind: F.get_json_object("feature_payload", f"$.{name}").cast(kind).alias(name)
    rates = [F.round(number("avg_viewed_price_7d", "double"), 6).alias("avg_viewed_price_7d"), number("cart_to_purchase_ratio_7d", "double")]
    return rows.select("*", number("distinct_categories_7d", "int"), *rates).drop("feature_payload")


@query("a20_i18_item_rows", *offline_sql(ITEM_ROLLING, "product_id", "product_id, feature_timestamp, category_id, brand_id, price_bucket, views_1h, views_24h, purchases_24h, popularity_score, purchases_7d, 'item_features_v1' feature_version"))
def item_feature_rows(shop):
    rows = stream_job(shop, "stream_item_features").contract_table("stream_item_features")
    return rows.withColumn("purchases_7d", F.get_json_object("feature_payload", "$.purchases_7d").cast("int")).drop("feature_payload")


def _columns(name: str) -> str:
    return {
        "stream_behavior_events": "event_id,event_timestamp,processed_timestamp,user_id,product_id,event_type,event_type_id,category_id,brand_id,price,price_bucket,payload_hash,source_topic,late_by_seconds,is_late",
        "streaming_quality_windows": ",".join(sinks.QUALITY_COLUMNS),
    }.get(name) or ",".join(part.split()[0] for part in sinks.TABLES[name].split(", "))


FAN_OUT = {
    "stream_behavior_events": "select 1 from flagged",
    "stream_late_events_dlq": "select distinct event_id from flagged where is_too_late",
    "streaming_quality_windows": "select 1 from quality",
    "stream_user_sequence_features": "select distinct event_id from (select user_id, event_id from first_last_user union all select user_id, event_id from second_last_user where user_id in (select user_id from kept where record_timestamp >= timestamp '2024-01-16'))",
    "stream_user_aggregate_features": "select distinct event_id from (select user_id, event_id from first_last_user union all select user_id, event_id from second_last_user where user_id in (select user_id from kept where record_timestamp >= timestamp '2024-01-16'))",
    "stream_item_features": "select distinct event_id from (select product_id, event_id from first_last_item union all select product_id, event_id from second_last_item where product_id in (select product_id from kept where record_timestamp >= timestamp '2024-01-16'))",
}


@query(
    "a18_six_sinks",
    " union all ".join(f"select '{name}' table_name, '{_columns(name)}' columns, count(*) as rows from ({sql})" for name, sql in FAN_OUT.items()),
    {**QUALITY, **both_parts("select 1")},
)
def six_sinks(shop):
    """The six tables that one stream feeds, with their columns."""
    job = stream_job(shop, *sinks.STREAM_TABLES)
    tables = [job.contract_table(name) for name in sinks.STREAM_TABLES]
    counts = [
        t.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table_name"), F.lit(",".join(t.columns)).alias("columns"), "rows")
        for name, t in zip(sinks.STREAM_TABLES, tables, strict=True)
    ]
    return reduce(DataFrame.unionByName, counts)


@query(
    "a18_sink_fan_out",
    """select 'stream_behavior_events' table_name, count(*) as rows from flagged union all select 'stream_late_events_dlq', count(distinct event_id) from flagged where is_too_late""",
)
def fan_out(shop):
    counts = [
        table(shop, name).agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table_name"), "rows")
        for name in ("stream_behavior_events", "stream_late_events_dlq")
    ]
    return counts[0].unionByName(counts[1])


@query("g3_union_of_updates", "select 'user' kind, user_id entity_id, event_id from last_user union all select 'item', product_id, event_id from last_item", ROLLING)
def updates(shop):
    stream_job(shop, "stream_user_features", "stream_item_features")  # beside each other
    users = latest_per_key(table(shop, "stream_user_features"), ["user_id"], "batch_id")
    items = latest_per_key(table(shop, "stream_item_features"), ["product_id"], "batch_id")
    return jobs.union_updates(users, items).drop("feature_timestamp")


def landed_files(shop, files: int) -> str:
    landing = scratch_path(shop.spark, "files")
    shop.impressions.select("impression_id", "user_id", "impression_timestamp").repartition(files).write.parquet(landing)
    return landing


def streamed(shop, stream, name):
    """Replay a stream into files and read them back."""
    out = scratch_path(shop.spark, name)
    writer = stream.writeStream.format("parquet").option("path", f"{out}/data").option("checkpointLocation", f"{out}/checkpoint")
    writer.trigger(availableNow=True).start().awaitTermination()
    return shop.spark.read.schema(stream.schema).parquet(f"{out}/data")


@query("a16_a23_throttled_file_stream", "select impression_id, user_id, impression_timestamp from impressions")
def throttled(shop):
    session = streaming_session(shop.spark)
    stream = cdc.file_source(session, landed_files(shop, 4), "impression_id string, user_id bigint, impression_timestamp timestamp", max_files=1)
    return streamed(shop, stream, "throttled")


@query("f6_bounded_stream_prefix", "select least(100, count(*)) as rows, true known from impressions")
def prefix(shop):
    session = streaming_session(shop.spark)
    stream = cdc.file_source(session, landed_files(shop, 4), "impression_id string, user_id bigint, impression_timestamp timestamp")
    kept = streamed(shop, jobs.bounded_prefix(stream, 100), "prefix")
    known = kept.join(shop.impressions.select("impression_id"), "impression_id", "left_anti").agg((F.count(F.lit(1)) == 0).alias("known"))
    return kept.agg(F.count(F.lit(1)).alias("rows")).crossJoin(known)  # one row each


@query("i23_bursts", "select event_timestamp, event_id||case when c > 1 then '-'||c else '' end event_id from (select *, unnest(case when (epoch_us(event_timestamp)//60000000) % 10 = 0 then [1,2,3] else [1] end) c from behavior_events)")
def bursts(shop):
    return injection.inject_bursts(shop.behavior_events, 10, 3).select("event_timestamp", "event_id")


@query("i23_replays", f"select event_id, ingestion_ts from behavior_events union all select event_id, ingestion_ts + interval 600 seconds from behavior_events where {h(chr(39) + 'replay:' + chr(39) + '||event_id')} % 1000000 < 100000")
def replays(shop):
    return injection.inject_replays(shop.behavior_events, 0.1, 600).select("event_id", "ingestion_ts")


@query(
    "i23_late_arrivals",
    f"""select event_id, event_timestamp - to_seconds(d) event_timestamp, d injected_delay_seconds from (select *, case when {h("'late:'||event_id")} % 1000000 < 200000 then (5 + {h("'by:late:'||event_id")} % 26) * 60 else 0 end d from behavior_events)""",
)
def late_arrivals(shop):
    rows = injection.inject_late(shop.behavior_events, 0.2, 5, 30)
    return rows.select("event_id", "event_timestamp", "injected_delay_seconds")
