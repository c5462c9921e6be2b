"""Shop tables derived from the given star-schema and event tables.

Every table is a lazy view over the whole source; nothing is generated on the driver.
"""

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shopflow.functions.hashing import bucket, unit_interval

EVENT_TYPES = {"view": "view", "click": "click", "error": "cart", "purchase": "purchase", "signup": "search"}


def seconds(amount: Column) -> Column:
    return F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), amount)


def money(value: Column) -> Column:
    return value.cast("decimal(18,2)")


class Shop:
    """The given tables of one folder and the shop tables built on them."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    @cached_property
    def behavior_events(self) -> DataFrame:
        number = F.col("event_id")
        kind = F.element_at(
            F.create_map(*[F.lit(x) for pair in EVENT_TYPES.items() for x in pair]), F.col("event_type")
        )
        raw = self.table("events").select(
            number,
            F.col("ts").cast("timestamp").alias("ts"),
            "user_id",
            "value",
            kind.alias("kind"),
            F.get_json_object("props", "$.k").cast("bigint").alias("k"),
        )
        late = bucket(F.concat(F.lit("late:"), number.cast("string")), 1000)
        shown = F.col("kind") != "search"
        old = F.pmod(number, F.lit(3)) == 0
        return raw.select(
            number.cast("string").alias("event_id"),
            F.col("ts").alias("event_timestamp"),
            F.col("ts").alias("created_ts"),
            (F.col("ts") + seconds(F.when(late < 100, late * 60).otherwise(F.pmod(late, F.lit(30))))).alias(
                "ingestion_ts"
            ),
            "user_id",
            F.concat_ws("-", F.col("user_id").cast("string"), F.date_format("ts", "yyyyMMdd")).alias("session_id"),
            F.when(shown, F.concat(F.lit("req-"), F.floor(number / 20).cast("string"))).alias("request_id"),
            F.when(shown, F.concat(F.lit("imp-"), F.floor(number / 4).cast("string"))).alias("impression_id"),
            F.col("kind").alias("event_type"),
            F.col("k").alias("product_id"),
            F.pmod("k", F.lit(12)).alias("category_id"),
            F.pmod("k", F.lit(25)).alias("brand_id"),
            money(F.col("value")).alias("price"),
            (F.pmod("k", F.lit(10)) + 1).cast("int").alias("price_bucket"),
            F.when(shown, F.pmod(number, F.lit(3)) + 1).cast("int").alias("quantity"),
            F.when(old, F.lit(None))
            .when(F.pmod(number, F.lit(3)) == 1, "mobile")
            .otherwise("desktop")
            .alias("device_type"),
            F.when(shown, "home").otherwise("search").alias("source"),
            F.when(~old, F.concat(F.lit("c"), F.pmod("k", F.lit(4)).cast("string"))).alias("campaign_id"),
            F.when(F.col("kind") == "purchase", F.concat(F.lit("ord-"), number.cast("string"))).alias("order_id"),
            F.sha2(F.concat_ws("|", number.cast("string"), F.col("kind"), F.col("k").cast("string")), 256).alias(
                "payload_hash"
            ),
            (F.pmod(number, F.lit(3)) + 1).cast("int").alias("schema_version"),
        )

    @cached_property
    def raw_events(self) -> DataFrame:
        """Events with replayed copies; some copies carry a different payload."""
        events = self.behavior_events
        draw = bucket(F.concat(F.lit("dup:"), F.col("event_id")))
        copies = (
            events.filter(draw < 20)
            .withColumn("ingestion_ts", F.col("ingestion_ts") + seconds(F.lit(300)))
            .withColumn(
                "payload_hash",
                F.when(draw < 5, F.sha2(F.concat(F.lit("changed:"), "payload_hash"), 256)).otherwise(
                    F.col("payload_hash")
                ),
            )
        )
        return events.unionByName(copies)

    @cached_property
    def impressions(self) -> DataFrame:
        events = self.behavior_events.withColumn("number", F.col("event_id").cast("bigint"))
        group = F.floor(F.col("number") / 4)
        first = (
            events.groupBy(group.alias("g"))
            .agg(
                F.min_by(
                    F.struct("number", "user_id", "session_id", "event_timestamp", "product_id"), "number"
                ).alias("e")
            )
            .select("g", "e.*")
        )
        gid = F.col("g").cast("string")
        return first.select(
            F.concat(F.lit("imp-"), gid).alias("impression_id"),
            F.concat(F.lit("req-"), F.floor(F.col("number") / 20).cast("string")).alias("request_id"),
            "user_id",
            "session_id",
            F.col("event_timestamp").alias("impression_timestamp"),
            F.col("product_id").alias("candidate_product_id"),
            (F.pmod("g", F.lit(5)) + 1).cast("int").alias("rank_position"),
            F.when(F.pmod("g", F.lit(3)) == 0, "trending")
            .when(F.pmod("g", F.lit(3)) == 1, "popular")
            .alias("candidate_source"),
            unit_interval(F.concat(F.lit("retrieval:"), gid)).alias("retrieval_score"),
            unit_interval(F.concat(F.lit("ranking:"), gid)).alias("ranking_score"),
            F.lit("home").alias("surface"),
            (bucket(F.concat(F.lit("click:"), gid)) < 10).alias("is_clicked"),
        )

    @cached_property
    def recommendation_requests(self) -> DataFrame:
        first = (
            self.impressions.groupBy("request_id")
            .agg(F.min_by(F.struct("user_id", "session_id", "impression_timestamp"), "impression_timestamp").alias("r"))
            .select("request_id", "r.*")
        )
        draw = bucket(F.concat(F.lit("ctx:"), "request_id"))
        arm = F.when(bucket(F.concat(F.lit("exp-1:"), F.col("user_id").cast("string"))) < 50, "candidate").otherwise(
            "control"
        )
        context = F.concat(F.lit('{"experiment_id":"exp-1","variant":"'), arm, F.lit('"}'))
        return first.select(
            "request_id",
            "user_id",
            "session_id",
            F.col("impression_timestamp").alias("request_timestamp"),
            F.lit("home").alias("surface"),
            F.when(draw < 5, "{broken").when(draw < 10, '{"experiment_id":"","variant":""}').when(draw >= 15, context).alias(
                "request_context"
            ),
        )

    @cached_property
    def sessions(self) -> DataFrame:
        return self.behavior_events.groupBy("session_id", "user_id").agg(
            F.min("event_timestamp").alias("session_start_ts"), F.max("event_timestamp").alias("session_end_ts")
        )

    @cached_property
    def users(self) -> DataFrame:
        key = F.col("c_custkey")
        draw = bucket(F.concat(F.lit("segment:"), key.cast("string")))
        return self.table("customer").select(
            key.alias("user_id"),
            F.expr("timestamp'2023-01-01' + make_interval(0, 0, 0, cast(pmod(c_custkey, 365) as int))").alias("signup_ts"),
            F.concat(F.lit("nation-"), F.col("c_nationkey").cast("string")).alias("country"),
            F.when(draw >= 6, F.col("c_mktsegment")).alias("segment"),
            (F.pmod(key, F.lit(7)) + 1).cast("int").alias("age_bucket"),
            (F.col("c_acctbal") >= 0).alias("is_active"),
        )

    @cached_property
    def user_preferences(self) -> DataFrame:
        return (
            self.behavior_events.groupBy("user_id", "category_id", "brand_id")
            .agg(F.count(F.lit(1)).alias("n"))
            .select("user_id", "category_id", "brand_id", F.col("n").cast("double").alias("preference_weight"))
        )

    @cached_property
    def products(self) -> DataFrame:
        key = F.col("p_partkey")
        return self.table("part").select(
            key.alias("product_id"),
            F.col("p_name").alias("product_name"),
            F.pmod(key, F.lit(12)).alias("category_id"),
            F.concat(F.lit("cat."), F.lower("p_type")).alias("category_code"),
            F.pmod(key, F.lit(25)).alias("brand_id"),
            F.col("p_brand").alias("brand_name"),
            money(F.col("p_retailprice")).alias("current_price"),
            (F.pmod(key, F.lit(10)) + 1).cast("int").alias("price_bucket"),
            (F.col("p_size") <= 45).alias("is_active"),
            F.expr("timestamp'2023-06-01'").alias("created_ts"),
            F.col("p_size").cast("double").alias("popularity_weight"),
        )

    @cached_property
    def product_snapshots(self) -> DataFrame:
        """Two validity rows per product; the price bucket changes at the cut and the last row is open."""
        cut, start = "timestamp'2024-01-15'", "timestamp'2023-06-01'"
        versions = F.expr(
            f"array(named_struct('valid_from', {start}, 'valid_to', {cut}, 'step', 0),"
            f" named_struct('valid_from', {cut}, 'valid_to', cast(null as timestamp), 'step', 1))"
        )
        exploded = self.products.withColumn("v", F.explode(versions))
        return exploded.select(
            "product_id",
            F.col("v.valid_from").alias("valid_from"),
            F.col("v.valid_to").alias("valid_to"),
            "category_id",
            "category_code",
            "brand_id",
            "brand_name",
            money(F.col("current_price") + F.col("v.step")).alias("current_price"),
            (F.pmod(F.col("price_bucket") + F.col("v.step"), F.lit(10)) + 1).cast("int").alias("price_bucket"),
            "is_active",
            F.col("v.valid_from").alias("created_ts"),
        )

    @cached_property
    def orders(self) -> DataFrame:
        status = F.when(F.col("o_orderstatus") == "O", "Paid").when(F.col("o_orderstatus") == "P", "Pending").otherwise(
            "Cancelled"
        )
        day = F.pmod(F.datediff(F.col("o_orderdate").cast("date"), F.lit("1992-01-01").cast("date")), F.lit(30))
        items = self.order_items.groupBy("order_id").agg(
            F.sum("gross").alias("gross_amount"),
            F.sum("discount_amount").alias("discount_amount"),
            F.sum("line_amount").alias("net_amount"),
        )
        off = bucket(F.concat(F.lit("net:"), F.col("o_orderkey").cast("string")))
        return (
            self.table("orders")
            .withColumn("order_id", F.concat(F.lit("o"), F.col("o_orderkey").cast("string")))
            .join(items, "order_id", "left")
            .select(
                "order_id",
                F.col("o_custkey").alias("user_id"),
                F.concat(F.lit("s"), F.col("o_custkey").cast("string")).alias("session_id"),
                F.expr("timestamp'2024-01-01'").alias("base"),
                day.alias("day"),
                status.alias("status"),
                money(F.col("gross_amount")).alias("gross_amount"),
                money(F.col("discount_amount")).alias("discount_amount"),
                money(F.col("net_amount") + F.when(off < 3, F.lit(1)).otherwise(F.lit(0))).alias("net_amount"),
            )
            .withColumn("order_timestamp", F.col("base") + seconds(F.col("day") * 86400))
            .drop("base", "day")
        )

    @cached_property
    def order_items(self) -> DataFrame:
        """Lines returned at a full discount point to a header that does not exist."""
        key = F.col("l_orderkey").cast("string")
        orphan = (F.col("l_returnflag") == "A") & (F.col("l_discount") == 0.1)
        quantity = F.col("l_quantity").cast("int")
        gross = money(F.col("l_extendedprice"))
        discount = money(gross * F.col("l_discount").cast("decimal(4,2)"))
        return self.table("lineitem").select(
            F.concat_ws("-", key, F.col("l_linenumber").cast("string"), F.col("l_partkey").cast("string"), F.col("l_suppkey").cast("string"), F.date_format("l_shipdate", "yyyyMMdd")).alias("order_item_id"),
            F.concat(F.when(orphan, "x").otherwise("o"), key).alias("order_id"),
            F.col("l_partkey").alias("product_id"),
            quantity.alias("quantity"),
            gross.alias("gross"),
            discount.alias("discount_amount"),
            money(gross - discount).alias("line_amount"),
        )

    @cached_property
    def predictions(self) -> DataFrame:
        """Scored candidates: one ranking group per order."""
        key = F.concat_ws(":", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"), F.col("l_partkey").cast("string"), F.col("l_suppkey").cast("string"), F.date_format("l_shipdate", "yyyyMMdd"))
        return self.table("lineitem").select(
            key.alias("prediction_id"),
            F.col("l_orderkey").alias("group_id"),
            F.col("l_partkey").alias("item_id"),
            (F.col("l_returnflag") == "R").cast("int").alias("label"),
            F.round(unit_interval(F.concat(F.lit("score:"), key)), 3).alias("score"),
            (F.col("l_extendedprice") / 100000.0).alias("latency_seconds"),
            (F.col("l_tax") == 0.08).cast("int").alias("is_error"),
            F.col("l_discount").alias("confidence"),
            F.col("l_suppkey").alias("user_id"),
            F.col("l_shipdate").cast("timestamp").alias("prediction_ts"),
        )

    @property
    def cdc_records(self) -> DataFrame:
        return self.change_records(self.behavior_events)

    def change_records(self, events: DataFrame) -> DataFrame:
        """Change records of the events: mostly enveloped, some deletes, bare rows and broken fields."""
        draw = bucket(F.concat(F.lit("cdc:"), "event_id"))
        row = F.struct(
            F.col("event_id"),
            F.date_format("event_timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").alias("event_timestamp"),
            F.col("user_id"),
            F.when(~draw.between(5, 7), F.col("product_id")).alias("product_id"),
            F.when(draw.between(8, 9), "").otherwise(F.col("event_type")).alias("event_type"),
            F.when(~draw.between(10, 14), F.col("category_id")).alias("category_id"),
            F.col("brand_id"),
            F.when(draw.between(15, 19), "n/a").otherwise(F.col("price").cast("string")).alias("price"),
            F.col("price_bucket"),
            "request_id",
            "impression_id",
            "payload_hash",
        )
        operation = F.when(draw < 3, "d").when(draw < 4, "t").when(draw < 50, "u").otherwise("c")
        wrapped = F.to_json(F.struct(F.struct(operation.alias("op"), row.alias("after")).alias("payload")))
        value = F.when(draw.between(20, 29), F.to_json(row)).otherwise(wrapped)
        return events.select(value.alias("value"), F.col("ingestion_ts").alias("record_timestamp"))

    @cached_property
    def embeddings(self) -> DataFrame:
        return self.table("embeddings")

    @cached_property
    def documents(self) -> DataFrame:
        return self.table("documents")

    @cached_property
    def conversations(self) -> DataFrame:
        return self.table("conversations")
