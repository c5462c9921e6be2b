"""Reading and writing tables as files."""

import json
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

PARTITION_COLUMN = "business_date"


def sanitize_columns(frame: DataFrame, partition_column: str = PARTITION_COLUMN) -> DataFrame:
    """Keep the first of columns that differ only in case and drop the partition column."""
    seen, names, extra = set(), [], []
    for index, column in enumerate(frame.columns):
        if column.lower() in seen:
            column = f"_extra_{index}"
            extra.append(column)
        seen.add(column.lower())
        names.append(column)
    return frame.toDF(*names).drop(*extra, partition_column)


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """One table of a zone; files of older versions may lack columns."""
    return sanitize_columns(spark.read.option("mergeSchema", "true").parquet(f"{root.rstrip('/')}/{name}"))


def read_zone(spark: SparkSession, root: str, names: list[str]) -> dict[str, DataFrame]:
    return {name: read_table(spark, root, name) for name in names}


def read_catalog_table(spark: SparkSession, name: str) -> DataFrame:
    return sanitize_columns(spark.table(name))


def save_catalog_table(frame: DataFrame, name: str, mode: str = "overwrite") -> None:
    """Create or replace a table; append creates it when missing."""
    exists = frame.sparkSession.catalog.tableExists(name)
    frame.write.mode(mode if mode == "overwrite" or exists else "errorifexists").saveAsTable(name)


def write_table(frame: DataFrame, path: str, mode: str = "overwrite") -> None:
    frame.write.mode(mode).parquet(path)


def write_by_date(frame: DataFrame, path: str, timestamp: str, without: list[str] | None = None) -> None:
    """Date-partitioned zstd Parquet. Rebalancing keeps small dates in one file and splits hot dates."""
    dated = frame.drop(*(without or [])).withColumn(PARTITION_COLUMN, F.to_date(timestamp))
    balanced = dated.hint("rebalance", PARTITION_COLUMN)
    balanced.write.mode("append").partitionBy(PARTITION_COLUMN).option("compression", "zstd").parquet(path)


def read_contract(spark: SparkSession, path: str, contract: T.StructType) -> DataFrame:
    """Read files of any version as the contract: missing columns become null, the rest is cast."""
    found = spark.read.option("mergeSchema", "true").parquet(path)
    present = {c.lower() for c in found.columns}
    return found.select(
        *[
            (F.col(f.name) if f.name.lower() in present else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in contract.fields
        ]
    )


def bronze(frame: DataFrame, run_id: str, run_ts: str) -> DataFrame:
    """Raw rows with their audit columns."""
    return frame.withColumn("source_run_id", F.lit(run_id)).withColumn(
        "lakehouse_ingestion_ts", F.lit(run_ts).cast("timestamp")
    )


def ingest(tables: dict[str, DataFrame], root: str, run_id: str, run_ts: str, mode: str = "append") -> dict[str, int]:
    """Write every raw table to the bronze zone and report the rows this run wrote.

    Rows are counted by the write itself (an observation), not by a second pass.
    """
    from pyspark.sql import Observation

    written = {}
    for name, frame in tables.items():
        seen = Observation(f"ingest-{name}")
        counted = bronze(frame, run_id, run_ts).observe(seen, F.count(F.lit(1)).alias("rows"))
        write_table(counted, f"{root}/bronze_{name}", mode)
        written[name] = seen.get["rows"]
    return written


def export_jsonl(frame: DataFrame, path: str, split: str, order: list[str]) -> None:
    """JSON lines per split in global order: files sort by name, rows inside each file by order."""
    ordered = frame.repartitionByRange(split, *order).sortWithinPartitions(split, *order)
    ordered.write.mode("overwrite").partitionBy(split).json(path)


def load(spark: SparkSession, source: str, columns: list[str] | None = None) -> DataFrame:
    """Open a training source by its address: table:name, jdbc:..., or a path by its suffix."""
    if source.startswith("table:"):
        frame = read_catalog_table(spark, source.removeprefix("table:"))
    elif source.startswith("jdbc:"):
        url, _, table = source.partition("#")
        frame = spark.read.format("jdbc").option("url", url).option("dbtable", table).load()
    elif re.search(r"\.jsonl?(/|$)", source):
        frame = spark.read.json(source)
    elif re.search(r"\.csv(/|$)", source):
        frame = spark.read.option("header", "true").csv(source)
    else:
        frame = sanitize_columns(spark.read.option("mergeSchema", "true").parquet(source))
    return frame.select(*columns) if columns else frame


def read_range(spark: SparkSession, source: str, columns: list[str], timestamp: str, start: str, end: str) -> DataFrame:
    """Pruned and filtered read, start <= timestamp < end; both reach the scan or the remote database."""
    at = F.col(timestamp)
    return load(spark, source).filter((at >= F.lit(start).cast("timestamp")) & (at < F.lit(end).cast("timestamp"))).select(
        *columns
    )


def replace_tables(tables: dict[str, DataFrame], root: str) -> None:
    """Truncate and load: each table is replaced as a whole, written by the executors."""
    for name, frame in tables.items():
        write_table(frame, f"{root}/{name}", "overwrite")


def sync_table(spark: SparkSession, source: str, target: str, synced_at: str) -> DataFrame:
    """Copy a table, stamp the copy, and compare row counts."""
    stamped = spark.read.parquet(source).withColumn("analytics_synced_at", F.lit(synced_at).cast("timestamp"))
    write_table(stamped, target)
    counts = [spark.read.parquet(p).agg(F.count(F.lit(1)).alias(n)) for p, n in ((source, "source_rows"), (target, "target_rows"))]
    both = counts[0].crossJoin(counts[1])  # two one-row frames
    return both.withColumn("status", F.when(F.col("source_rows") == F.col("target_rows"), "SUCCESS").otherwise("FAILED"))


def read_csv(spark: SparkSession, path: str, schema: str, columns: list[str]) -> DataFrame:
    return spark.read.schema(schema).option("header", "true").csv(path).select(*columns)


def storage_summary(spark: SparkSession, path: str) -> DataFrame:
    """Files and bytes per compression codec. Only file metadata are read, never contents."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(path)
    codec = F.regexp_extract("path", r"\.([a-z0-9]+)\.parquet$", 1)
    return (
        files.select("path", "length")
        .groupBy(F.when(codec == "", "none").otherwise(codec).alias("codec"))
        .agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"))
    )


def file_metrics(frame: DataFrame) -> DataFrame:
    """File count and sizes of the files behind a frame."""
    files = frame.select("_metadata.file_path", "_metadata.file_size").distinct()
    return files.agg(
        F.count(F.lit(1)).alias("file_count"),
        F.coalesce(F.sum("file_size"), F.lit(0)).alias("total_size_bytes"),
        F.coalesce(F.min("file_size"), F.lit(0)).alias("min_file_size_bytes"),
        F.coalesce(F.max("file_size"), F.lit(0)).alias("max_file_size_bytes"),
        F.coalesce(F.avg("file_size"), F.lit(0.0)).alias("avg_file_size_bytes"),
    )


def register_views(tables: dict[str, DataFrame], prefix: str = "") -> list[str]:
    """Read-only names for ad-hoc SQL."""
    for name, frame in tables.items():
        frame.createOrReplaceTempView(f"{prefix}{name}")
    return [f"{prefix}{name}" for name in tables]


def write_with_manifest(frame: DataFrame, path: str, identity: str, status: str = "complete") -> None:
    """Write an artifact, then the manifest that releases it to readers."""
    write_table(frame, f"{path}/data")
    spark = frame.sparkSession
    rows = spark.read.parquet(f"{path}/data").count()
    manifest = json.dumps({"status": status, "row_count": rows, "identity": identity})
    spark.createDataFrame([(manifest,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/manifest")


def gated_read(spark: SparkSession, path: str) -> DataFrame:
    """Return the artifact only if it is complete, has the promised rows and no duplicate ids."""
    manifest = json.loads(spark.read.text(f"{path}/manifest").first()["value"])
    if manifest["status"] != "complete":
        raise ValueError(f"{path} is {manifest['status']}, not complete")
    data = spark.read.parquet(f"{path}/data")
    facts = data.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct(manifest["identity"]).alias("ids")).first()
    if facts["rows"] != manifest["row_count"]:
        raise ValueError(f"{path} holds {facts['rows']} rows, its manifest promises {manifest['row_count']}")
    if facts["ids"] != facts["rows"]:
        raise ValueError(f"{path} repeats ids of {manifest['identity']}")
    return data
