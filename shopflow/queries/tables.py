"""Sources and sinks: every query writes and reads real files in the shared folder."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopflow.functions.hashing import bucket
from shopflow.operators import clean, online
from shopflow.plans.storage import materialize, scratch_path
from shopflow.queries.registry import query
from shopflow.sources import cdc, files

RUN_TS = "2024-02-01 00:00:00"
LATER_COLUMNS = ["device_type", "campaign_id"]


def version_files(shop) -> str:
    """Event files of two schema versions; the first lacks the later columns."""
    root = scratch_path(shop.spark, "raw")
    events = shop.behavior_events
    events.filter("schema_version = 1").drop(*LATER_COLUMNS).write.parquet(f"{root}/behavior_events/v1")
    events.filter("schema_version > 1").write.parquet(f"{root}/behavior_events/v2")
    return root


def merged(shop):
    return shop.spark.read.option("mergeSchema", "true").option("recursiveFileLookup", "true")


@query("a1_scan_with_schema_merge", "select event_id, user_id, event_type, device_type, campaign_id, schema_version from behavior_events")
def scan_merge(shop):
    rows = files.sanitize_columns(merged(shop).parquet(f"{version_files(shop)}/behavior_events"))
    return rows.select("event_id", "user_id", "event_type", "device_type", "campaign_id", "schema_version")


@query("a2_catalog_table_scan", "select p_partkey, p_name, p_retailprice from part")
def catalog_scan(shop):
    view = files.register_views({"part": shop.table("part")}, "a2_")[0]
    return files.read_catalog_table(shop.spark, view).select("p_partkey", "p_name", "p_retailprice")


@query("a3_sanitized_columns", "select c_custkey as id, c_name as name, c_acctbal as balance from customer")
def sanitized(shop):
    names = shop.table("customer").selectExpr(
        "c_custkey as id", "c_name as name", "c_acctbal as balance", "c_mktsegment as other", "c_nationkey as business_date"
    )
    return files.sanitize_columns(names.toDF("id", "name", "balance", "NAME", "business_date"))


@query(
    "a4_zone_read",
    """select 'impressions' table_name, count(*) row_count from impressions union all
    select 'recommendation_requests', count(*) from recommendation_requests union all select 'users', count(*) from users""",
)
def zone_read(shop):
    root = scratch_path(shop.spark, "zone")
    tables = {"impressions": shop.impressions, "recommendation_requests": shop.recommendation_requests, "users": shop.users}
    files.replace_tables(tables, root)
    zone = files.read_zone(shop.spark, root, list(tables))
    counts = [f.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(n).alias("table_name"), "row_count") for n, f in zone.items()]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


@query(
    "a5_bronze_ingest",
    """select *, 'run-1' source_run_id, timestamp '2024-02-01' lakehouse_ingestion_ts from users""",
)
def bronze_ingest(shop):
    root = scratch_path(shop.spark, "bronze")
    files.ingest({"users": shop.users}, root, "run-1", RUN_TS)
    return shop.spark.read.parquet(f"{root}/bronze_users")


@query("a6_table_append", "select user_id, country from users union all select user_id, country from users")
def table_append(shop):
    path = scratch_path(shop.spark, "append")
    rows = shop.users.select("user_id", "country")
    for mode in ("overwrite", "append"):
        files.write_table(rows, path, mode)
    return shop.spark.read.parquet(path)


@query("a7_parquet_sink", "select product_id, category_id, current_price::double current_price from products")
def parquet_sink(shop):
    path = scratch_path(shop.spark, "products")
    files.write_table(shop.products.select("product_id", "category_id", F.col("current_price").cast("double").alias("current_price")), path)
    return shop.spark.read.parquet(path)


@query(
    "a8_date_partitioned_sink",
    """select strftime(event_timestamp, '%Y-%m-%d') business_date, count(*) row_count, sum(price)::double revenue,
      count(distinct user_id) users from behavior_events group by 1""",
)
def partitioned_sink(shop):
    path = scratch_path(shop.spark, "dated")
    files.write_by_date(shop.behavior_events, path, "event_timestamp")
    dated = shop.spark.read.parquet(path)
    return dated.groupBy(F.col("business_date").cast("string").alias("business_date")).agg(
        F.count(F.lit(1)).alias("row_count"), F.sum("price").cast("double").alias("revenue"), F.count_distinct("user_id").alias("users")
    )


@query(
    "a9_contract_read",
    """select event_id, user_id, case when schema_version > 1 then device_type end device_type, price::double price,
      null::varchar page_context, schema_version::bigint schema_version from behavior_events""",
)
def contract_read(shop):
    contract = T.StructType(
        [
            T.StructField("event_id", T.StringType()),
            T.StructField("user_id", T.LongType()),
            T.StructField("device_type", T.StringType()),
            T.StructField("price", T.DoubleType()),
            T.StructField("page_context", T.StringType()),
            T.StructField("schema_version", T.LongType()),
        ]
    )
    root = version_files(shop)
    parts = [files.read_contract(shop.spark, f"{root}/behavior_events/{v}", contract) for v in ("v1", "v2")]
    return parts[0].unionByName(parts[1])


@query(
    "a10_jsonl_export",
    f"""select case when {{h}} < 80 then 'train' else 'test' end split, count(*) row_count, min(impression_id) first_id, max(impression_id) last_id
    from impressions group by 1""".replace("{h}", "(('0x'||substr(sha256('split:'||impression_id),1,8))::bigint) % 100"),
)
def jsonl_export(shop):
    path = scratch_path(shop.spark, "jsonl")
    split = F.when(bucket(F.concat(F.lit("split:"), "impression_id")) < 80, "train").otherwise("test")
    samples = shop.impressions.withColumn("split", split)
    files.export_jsonl(samples, path, "split", ["impression_timestamp", "impression_id"])
    back = shop.spark.read.schema("impression_id string, split string").json(path)
    return back.groupBy("split").agg(
        F.count(F.lit(1)).alias("row_count"), F.min("impression_id").alias("first_id"), F.max("impression_id").alias("last_id")
    )


@query("a11_source_by_address", "select impression_id, user_id, candidate_product_id from impressions")
def source_by_address(shop):
    path = scratch_path(shop.spark, "source") + ".json"
    columns = ["impression_id", "user_id", "candidate_product_id"]
    shop.impressions.select(*columns).write.json(path)
    return files.load(shop.spark, path, columns)


@query(
    "a12_pruned_range_read",
    """select impression_id, user_id, candidate_product_id from impressions
    where impression_timestamp >= timestamp '2024-01-10' and impression_timestamp < timestamp '2024-01-20'""",
)
def range_read(shop):
    path = scratch_path(shop.spark, "labels")
    files.write_table(shop.impressions, path)
    return files.read_range(
        shop.spark, path, ["impression_id", "user_id", "candidate_product_id"], "impression_timestamp",
        "2024-01-10 00:00:00", "2024-01-20 00:00:00",
    )


@query("a14_truncate_and_load", "select user_id, session_id from sessions")
def truncate_load(shop):
    root = scratch_path(shop.spark, "offline")
    for frame in (shop.sessions.limit(0), shop.sessions):
        files.replace_tables({"sessions": frame.select("user_id", "session_id")}, root)
    return shop.spark.read.parquet(f"{root}/sessions")


@query("a15_sync_with_counts", "select count(*) source_rows, count(*) target_rows, 'SUCCESS' status from users")
def sync(shop):
    root = scratch_path(shop.spark, "sync")
    files.write_table(shop.users, f"{root}/silver")
    return files.sync_table(shop.spark, f"{root}/silver", f"{root}/staging", RUN_TS)


@query("a17_debezium_unwrap", "select count(*) rows_kept, count(distinct event_id) ids from behavior_events where (('0x'||substr(sha256('cdc:'||event_id),1,8))::bigint) % 100 >= 4")
def unwrap(shop):
    rows = cdc.unwrap(materialize(shop.cdc_records, "records"))
    return rows.agg(F.count(F.lit(1)).alias("rows_kept"), F.count_distinct("row.event_id").alias("ids"))


@query(
    "a22_feature_payload_json",
    """select user_id, '{"carts":'||c||',"ratio":'||case when c = 0 then 'null' else (p // c)||'.0' end||',"user_id":'||user_id||'}' payload
    from (select user_id, sum((event_type='cart')::int) c, sum((event_type='purchase')::int) p from behavior_events group by 1)""",
)
def feature_payload(shop):
    counts = shop.behavior_events.groupBy("user_id").agg(
        F.sum((F.col("event_type") == "cart").cast("int")).alias("carts"),
        F.sum((F.col("event_type") == "purchase").cast("int")).alias("purchases"),
    )
    ratio = F.when(F.col("carts") == 0, F.lit(float("nan"))).otherwise(F.floor(F.try_divide("purchases", "carts")).cast("double"))
    payload = online.json_payload({"user_id": F.col("user_id"), "carts": F.col("carts"), "ratio": ratio})
    return counts.select("user_id", payload.alias("payload"))


@query("a24_pruned_csv_scan", "select product_id, category_code, is_active from products")
def csv_scan(shop):
    path = scratch_path(shop.spark, "csv")
    columns = ["product_id", "product_name", "category_code", "brand_name", "is_active"]
    shop.products.select(*columns).write.option("header", "true").csv(path)
    schema = "product_id bigint, product_name string, category_code string, brand_name string, is_active boolean"
    return files.read_csv(shop.spark, path, schema, ["product_id", "category_code", "is_active"])


@query("a25_storage_summary")
def storage(shop):
    path = scratch_path(shop.spark, "stored")
    files.write_by_date(shop.behavior_events, path, "event_timestamp")
    return files.storage_summary(shop.spark, path)


@query("a26_file_metrics")
def metrics(shop):
    return files.file_metrics(shop.table("lineitem"))


@query(
    "a27_zone_views_sql",
    """select u.country, count(*) impressions from impressions i join users u using (user_id) group by 1""",
)
def zone_views(shop):
    files.register_views({"impressions": shop.impressions, "users": shop.users}, "silver_")
    return shop.spark.sql(
        "select u.country, count(*) impressions from silver_impressions i join silver_users u using (user_id) group by 1"
    )


@query("a28_gated_artifact_read", "select product_id, brand_name from products")
def gated(shop):
    path = scratch_path(shop.spark, "artifact")
    files.write_with_manifest(shop.products.select("product_id", "brand_name"), path, "product_id")
    return files.gated_read(shop.spark, path)


@query("b9_normalized_change_events", "select * from cdc_events")
def normalized(shop):
    return cdc.normalize(materialize(shop.cdc_records, "records")).drop("session_id")


@query(
    "k36_injected_problems",
    """select event_id, schema_version, count(*) copies, max((device_type is null)::int) device_missing,
      max((campaign_id is null)::int) campaign_missing
    from (select event_id, case when event_timestamp >= timestamp '2024-01-20' then 3 when event_timestamp >= timestamp '2024-01-10' then 2 else 1 end schema_version,
        case when event_timestamp >= timestamp '2024-01-10' then 'x' end device_type, case when event_timestamp >= timestamp '2024-01-10' then 'x' end campaign_id,
        unnest(case when (('0x'||substr(sha256('copy:'||event_id),1,8))::bigint) % 1000000 < 450000 then [1,2] else [1] end)
      from behavior_events) group by all""",
)
def injected(shop):
    rows = clean.inject_problems(shop.behavior_events, 0.45, "2024-01-10", "2024-01-20")
    return rows.groupBy("event_id", "schema_version").agg(
        F.count(F.lit(1)).alias("copies"),
        F.max(F.col("device_type").isNull().cast("int")).alias("device_missing"),
        F.max(F.col("campaign_id").isNull().cast("int")).alias("campaign_missing"),
    )
