"""File layout: compaction, clustering, skew reports."""

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shopflow.sources.files import file_metrics

TARGET_BYTES = 134_217_728


CELLS_PER_FILE = 16
MOST_BITS = 12  # of a column, so its range edges number 4,095; inside a cell rows are sorted by the columns themselves


def curve_bits(files: int, columns: int) -> int:
    """Bits per column at which a curve has several cells for each file."""
    return min(MOST_BITS, max(1, math.ceil(math.log2(max(files, 1) * CELLS_PER_FILE) / columns)))


def _range_id(value: Column, edges: list, bits: int) -> Column:
    """Number of edges at or below the value, found by halving; nulls lie before the first."""
    listed, steps = F.array(*map(F.lit, edges)), F.array(*[F.lit(1 << bit) for bit in reversed(range(bits))])
    return F.aggregate(steps, F.lit(0), lambda place, step: place + F.when(F.get(listed, place + step - 1) <= value, step).otherwise(0))


def z_value(frame: DataFrame, columns: list[str], bits: int) -> Column:
    """Interleaved bits of the columns' range numbers; ranges come from approximate quantiles of all rows."""
    ranges = 1 << bits
    levels = [i / ranges for i in range(1, ranges)]
    accuracy = max(10_000, 8 * ranges)
    cuts = frame.agg(*[F.percentile_approx(c, levels, accuracy).alias(c) for c in columns]).first()  # one row of edges
    numbers = [_range_id(F.col(c), cuts[c], bits) if cuts[c] else F.lit(0) for c in columns]
    z = F.lit(0).cast("bigint")
    for bit in range(bits):
        for place, number in enumerate(numbers):
            one = F.shiftright(number, bit).bitwiseAND(F.lit(1)).cast("bigint")
            z = z + F.shiftleft(one, bit * len(columns) + place)
    return z


def pruned_files(frame: DataFrame, box: dict[str, tuple]) -> DataFrame:
    """Files behind a frame, and how many of them minima and maxima rule out for a range (low, high, both inside) of each column.

    Only the columns of the box are read, and one row per file is shuffled. A file without a value in a column is ruled out.
    """
    ends = [f(c).alias(f"_{name}_{c}") for c in box for name, f in (("min", F.min), ("max", F.max))]
    files = frame.select(F.col("_metadata.file_path").alias("_file"), *box).groupBy("_file").agg(*ends)
    met = F.lit(True)
    for c, (low, high) in box.items():
        met = met & F.coalesce((F.col(f"_min_{c}") <= F.lit(high)) & (F.col(f"_max_{c}") >= F.lit(low)), F.lit(False))
    return files.agg(F.count(F.lit(1)).alias("files"), F.count_if(~met).alias("skipped_files"))


def compact(
    spark: SparkSession, source: str, target: str, *, target_bytes: int = TARGET_BYTES, min_input_files: int = 2,
    cluster_by: list[str] | None = None,
) -> DataFrame:
    """Rewrite a folder into files of about the target size and report sizes before and after.

    Without cluster_by files are packed; with it rows are laid along a Z-order curve, so files have narrow
    value ranges in every clustering column. The curve is as fine as the number of files asks for.
    """
    if target_bytes <= 0 or min_input_files < 1:
        raise ValueError("target_bytes and min_input_files must be positive")
    rows = spark.read.parquet(source)
    before = file_metrics(rows)
    facts = before.first()
    if facts["file_count"] >= min_input_files:
        parts = max(1, math.ceil(facts["total_size_bytes"] / target_bytes))
        if cluster_by:
            keyed = rows.withColumn("_z", z_value(rows, cluster_by, curve_bits(parts, len(cluster_by))))
            packed = keyed.repartitionByRange(parts, "_z", *cluster_by).sortWithinPartitions("_z", *cluster_by).drop("_z")
        else:
            packed = rows.repartition(parts)
        packed.write.mode("overwrite").option("compression", "zstd").parquet(target)
        rewritten = spark.read.parquet(target)
    else:
        rewritten = rows
    after = file_metrics(rewritten)
    return before.withColumn("phase", F.lit("before")).unionByName(after.withColumn("phase", F.lit("after")))


def salted_counts(frame: DataFrame, key: str, salts: int = 8) -> DataFrame:
    """Rows and a distinct-safe total per key in two stages, spread over salts first."""
    salt = F.pmod(F.xxhash64(*[f.name for f in frame.schema.fields if not f.dataType.simpleString().startswith("map")]), F.lit(salts))
    first = frame.groupBy(key, salt.alias("_salt")).agg(F.count(F.lit(1)).alias("n"))
    return first.groupBy(key).agg(F.sum("n").alias("rows"))


def partition_load(frame: DataFrame, key: str, partitions: int, salts: int = 1) -> DataFrame:
    """Largest and total rows when rows are placed by key, or by key and salt."""
    salt = F.pmod(F.xxhash64(*frame.columns), F.lit(salts)) if salts > 1 else F.lit(0)
    place = F.pmod(F.xxhash64(F.col(key), salt), F.lit(partitions))
    loads = frame.groupBy(place.alias("partition")).agg(F.count(F.lit(1)).alias("n"))
    return loads.agg(F.max("n").alias("max_rows"), F.sum("n").alias("rows"))
