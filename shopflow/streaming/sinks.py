"""Keyed sinks of the stream: tables that are merged by key, and the mapping of feature rows to their columns.

A keyed table is a Parquet folder parted by a range of the key (such as its day) and a hash bucket. A batch of changes reads
and rewrites only the parts that its keys fall into, by dynamic partition overwrite, so the bytes written follow the batch
and not the table. The merged parts are stored under the batch's name first; a batch that is repeated after a failure
writes those again, whatever state the parts were left in, and one that was finished merges to the same rows.
"""

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from shopflow.operators.online import json_payload
from shopflow.plans.hot_keys import top_k
from shopflow.streaming.config import StreamConfig

PARTS = ["key_range", "key_bucket"]


class KeyedTable:
    """One row per key. A later row of a key replaces the row there is (`replace`), or is left out.

    key_range must be the same for all rows of a key; without it the hash alone parts the table. buckets belongs to the
    stored table and must not change later. Of rows of one key in a batch the first by `order` counts. Null keys are equal.
    """

    def __init__(
        self, spark: SparkSession, path: str, schema: str, keys: list[str], order: list, *, replace: bool, key_range: Column | None = None, buckets: int = 8
    ):
        self.spark, self.path, self.keys, self.order, self.replace, self.buckets = spark, path, keys, order, replace, buckets
        self.schema = StructType.fromDDL(schema)
        self.key_range = F.lit("all") if key_range is None else F.coalesce(key_range.cast("string"), F.lit("none"))

    def _stored(self, path: str) -> DataFrame | None:
        whole = StructType.fromDDL(f"{self.schema.toDDL()}, key_range string, key_bucket int")
        try:
            return self.spark.read.schema(whole).parquet(path)
        except AnalysisException:  # nothing written yet
            return None

    def read(self) -> DataFrame:
        found = self._stored(self.path)
        return (self.spark.createDataFrame([], self.schema) if found is None else found).select(*self.schema.names)

    def merged(self, changes: DataFrame) -> DataFrame:
        """The rows of the parts that the changes fall into, as they will be."""
        bucket = F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")
        new = top_k(changes.select(*self.schema.names), self.keys, self.order, 1, "_rank").drop("_rank")
        new = new.withColumn("key_range", self.key_range).withColumn("key_bucket", bucket).withColumn("_turn", F.lit(0 if self.replace else 1))
        stored = self._stored(self.path)
        if stored is None:
            return new.drop("_turn")
        # At most one row per part of the table comes to the driver, so that files of other parts are not even listed.
        touched = [tuple(r) for r in new.select(*PARTS).distinct().collect()]
        ranges = sorted({r for r, _ in touched})
        old = stored.filter(F.col("key_range").isin(ranges) & F.struct(*PARTS).isin([F.struct(F.lit(r), F.lit(b)) for r, b in touched]))
        rows = new.unionByName(old.withColumn("_turn", F.lit(0 if not self.replace else 1)))
        return top_k(rows, [*PARTS, *self.keys], ["_turn"], 1, "_rank").drop("_rank", "_turn")

    def merge(self, changes: DataFrame, batch: int, staging: str) -> int:
        """Take in a batch of changes; returns how many parts were rewritten."""
        target = f"{staging}/batch_id={batch}"
        done = self._stored(target)
        if done is None:
            self.merged(changes).repartition(*PARTS).write.mode("overwrite").partitionBy(*PARTS).parquet(target)
            done = self._stored(target)
        if done is None:  # no rows at all
            return 0
        # Parts are moved in when all are written; what the batch did not touch stays as it is. A stored part is a file or a few,
        # and a task takes whole files or pieces of a large one, so they need not be dealt again.
        done.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*PARTS).parquet(self.path)
        return len({file.rsplit("/", 1)[0] for file in done.inputFiles()})


# Columns of the stream's tables, fixed values of their contract.
TABLES = {
    "stream_user_sequence_features": (
        "source_event_id string, user_id bigint, feature_timestamp timestamp, sequence_length int, max_history_length int,"
        " feature_payload string, feature_version string"
    ),
    "stream_user_aggregate_features": (
        "source_event_id string, user_id bigint, feature_timestamp timestamp, views_30m int, carts_30m int, purchases_24h int,"
        " feature_payload string, feature_version string"
    ),
    "stream_item_features": (
        "source_event_id string, product_id bigint, feature_timestamp timestamp, category_id bigint, brand_id bigint, price_bucket int,"
        " views_1h int, views_24h int, purchases_24h int, popularity_score double, feature_payload string, feature_version string"
    ),
    "stream_late_events_dlq": (
        "event_id string, user_id bigint, product_id bigint, event_type string, event_timestamp timestamp, processed_timestamp timestamp,"
        " late_by_seconds double, allowed_lateness_seconds bigint, source_topic string, payload_hash string, reason string, payload string,"
        " created_timestamp timestamp"
    ),
}
QUALITY_COLUMNS = [
    "window_start", "window_end", "topic", "event_count", "late_event_count", "late_events_dropped", "side_output_late_events",
    "duplicate_event_count", "max_late_by_seconds", "is_bursty", "created_timestamp",
]
STREAM_TABLES = ["stream_behavior_events", *TABLES, "streaming_quality_windows"]
VERSIONS = {"sequence": "bst_sequence_v2", "aggregate": "user_aggregate_v1", "item": "item_features_v1"}


def keyed_table(spark: SparkSession, name: str, path: str, config: StreamConfig) -> KeyedTable:
    """The named table with the key of its contract."""
    if name == "stream_late_events_dlq":  # the first letter of an event and reason stays; copies may carry other times
        return KeyedTable(spark, path, TABLES[name], ["event_id", "reason"], ["created_timestamp", "payload_hash"], replace=False, buckets=config.sink_buckets)
    # The time of a feature row is that of its source event, so an event's rows share a day.
    return KeyedTable(
        spark, path, TABLES[name], ["source_event_id"], [F.desc("feature_payload")], replace=True, key_range=F.date_format("feature_timestamp", "yyyy-MM-dd"), buckets=config.sink_buckets
    )


def _iso(time: Column | str) -> Column:
    return F.date_format(time, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")


def behavior_rows(events: DataFrame, config: StreamConfig) -> DataFrame:
    """The event table's contract columns, from flagged events."""
    names = ["event_id", "event_timestamp", "processed_timestamp", "user_id", "product_id", "event_type", "event_type_id", "category_id", "brand_id"]
    rest = [F.coalesce("payload_hash", F.lit("")).alias("payload_hash"), F.lit(config.topic).alias("source_topic"), "late_by_seconds", "is_late"]
    return events.select(*names, "price", "price_bucket", *rest)


def user_sequence_rows(features: DataFrame, config: StreamConfig) -> DataFrame:
    """Rows of the user sequence table from rolling user features, the payload in sorted JSON."""
    fields = {
        "user_id": F.col("user_id"), "item_ids": F.col("hist_item_ids"), "event_type_ids": F.col("hist_event_type_ids"),
        "category_ids": F.col("hist_category_ids"), "brand_ids": F.col("hist_brand_ids"), "price_bucket_ids": F.col("hist_price_bucket_ids"),
        "event_timestamps": F.transform("hist_event_micros", lambda t: _iso(F.timestamp_micros(t))), "request_ids": F.col("hist_request_ids"), "impression_ids": F.col("hist_impression_ids"),
        "sequence_length": F.col("hist_length"), "max_history_length": F.lit(config.max_history_length), "updated_at": _iso("feature_timestamp"),
        "feature_version": F.lit(VERSIONS["sequence"]),
    }
    return features.select(
        F.col("event_id").alias("source_event_id"), "user_id", "feature_timestamp", F.col("hist_length").alias("sequence_length"),
        F.lit(config.max_history_length).alias("max_history_length"), _payload(fields), F.lit(VERSIONS["sequence"]).alias("feature_version"),
    )


def user_aggregate_rows(features: DataFrame, config: StreamConfig) -> DataFrame:
    """Rows of the user aggregate table from rolling user features."""
    names = ["user_id", "views_30m", "carts_30m", "purchases_24h", "distinct_categories_7d", "avg_viewed_price_7d", "cart_to_purchase_ratio_7d"]
    fields = {**{n: F.col(n) for n in names}, "last_event_age_seconds": F.lit(0), "updated_at": _iso("feature_timestamp"), "feature_version": F.lit(VERSIONS["aggregate"])}
    return features.select(
        F.col("event_id").alias("source_event_id"), "user_id", "feature_timestamp", "views_30m", "carts_30m", "purchases_24h",
        _payload(fields), F.lit(VERSIONS["aggregate"]).alias("feature_version"),
    )


def item_rows(features: DataFrame, config: StreamConfig) -> DataFrame:
    """Rows of the item table from rolling item features."""
    names = [
        "product_id", "category_id", "brand_id", "price_bucket", "is_active", "views_1h", "views_24h", "carts_1h", "carts_24h", "purchases_24h",
        "purchases_7d", "conversion_rate_7d", "popularity_score",
    ]
    fields = {**{n: F.col(n) for n in names}, "updated_at": _iso("feature_timestamp"), "feature_version": F.lit(VERSIONS["item"])}
    return features.select(
        F.col("event_id").alias("source_event_id"), "product_id", "feature_timestamp", "category_id", "brand_id", "price_bucket",
        "views_1h", "views_24h", "purchases_24h", "popularity_score", _payload(fields), F.lit(VERSIONS["item"]).alias("feature_version"),
    )


def _payload(fields: dict[str, Column]) -> Column:
    return json_payload(fields).alias("feature_payload")
