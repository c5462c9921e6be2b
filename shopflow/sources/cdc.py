"""Change-event records: unwrap the Debezium envelope and normalize the row."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shopflow.operators.features import event_type_id

DROPPED_OPERATIONS = ["d", "t"]
REQUIRED = ["event_id", "user_id", "product_id", "event_type", "event_timestamp"]
OPTIONAL = [
    "event_type_id", "category_id", "brand_id", "price_bucket", "price", "session_id", "request_id", "impression_id",
    "payload_hash",
]


def kafka_source(
    spark: SparkSession, servers: str, topic: str, *, group: str, start: str = "latest", max_offsets: int | None = None
) -> DataFrame:
    """Change topic as a stream; max_offsets bounds the rows of a micro-batch (needs the Kafka package)."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("groupIdPrefix", group)
        .option("startingOffsets", start)
        .option("failOnDataLoss", "false")
    )
    if max_offsets:
        reader = reader.option("maxOffsetsPerTrigger", str(max_offsets))
    return reader.load().selectExpr("cast(value as string) as value", "timestamp as record_timestamp")


def file_source(spark: SparkSession, path: str, schema: str, *, max_files: int | None = None) -> DataFrame:
    """Stream of new files in a folder; max_files throttles a micro-batch."""
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", str(max_files))
    return reader.parquet(path)


_ROW = ", ".join(f"{name}: string" for name in REQUIRED + OPTIONAL)
_COLUMNS = ", ".join(f"{name} string" for name in REQUIRED + OPTIONAL)
_ENVELOPE = (
    f"schema string, payload struct<op: string, after: struct<{_ROW}>, {_ROW}>, op string, after struct<{_ROW}>, {_COLUMNS}"
)


def unwrap(records: DataFrame, value: str = "value") -> DataFrame:
    """Add row, the image after the change; records without one (deletes, truncates, empty images) are dropped.

    A record without an envelope is the row itself. The text is parsed once.
    """
    parsed = records.withColumn("_r", F.from_json(value, _ENVELOPE))
    fields = REQUIRED + OPTIONAL
    after = F.coalesce("_r.payload.after", "_r.after")
    bare = F.when(F.col("_r.payload").isNotNull(), F.struct(*[F.col(f"_r.payload.{c}").alias(c) for c in fields])).otherwise(
        F.struct(*[F.col(f"_r.{c}").alias(c) for c in fields])
    )
    dropped = F.coalesce("_r.payload.op", "_r.op").isin(*DROPPED_OPERATIONS)
    emptied = after.isNull() & F.col("_r.payload").isNotNull() & F.col("_r.schema").isNotNull()
    image = F.when(F.coalesce(dropped, F.lit(False)) | emptied, F.lit(None)).otherwise(F.coalesce(after, bare))
    return parsed.withColumn("row", image).drop("_r").filter(F.col("row").isNotNull())


def parse_time(text: Column) -> Column:
    """ISO timestamp, zone or Z optional; without a zone it is UTC."""
    return F.try_to_timestamp(text)


def normalize(records: DataFrame, value: str = "value") -> DataFrame:
    """Typed events; records that miss a required field are dropped, bad optional values take defaults."""
    kept = [c for c in records.columns if c != value]
    row = unwrap(records, value).select(*kept, "row.*")
    for name in REQUIRED:
        row = row.filter(F.col(name).isNotNull() & (F.col(name) != ""))

    def whole(name: str, kind: str, default: Column | int = 0) -> Column:
        return F.coalesce(F.col(name).try_cast(kind), F.lit(default) if isinstance(default, int) else default)

    bucket = whole("price_bucket", "int")
    return row.select(
        *kept,
        "event_id",
        parse_time(F.col("event_timestamp")).alias("event_timestamp"),
        whole("user_id", "bigint").alias("user_id"),
        whole("product_id", "bigint").alias("product_id"),
        "event_type",
        whole("event_type_id", "int", event_type_id()).alias("event_type_id"),
        whole("category_id", "bigint").alias("category_id"),
        whole("brand_id", "bigint").alias("brand_id"),
        F.coalesce(F.col("price").try_cast("double"), bucket.cast("double")).alias("price"),
        bucket.alias("price_bucket"),
        "session_id",
        F.coalesce("request_id", F.lit("")).alias("request_id"),
        F.coalesce("impression_id", F.lit("")).alias("impression_id"),
        F.coalesce("payload_hash", F.lit("")).alias("payload_hash"),
    )
