"""Global order without a one-partition window.

Rows are range-partitioned and sorted, which also splits any hot key, and stored once so that the
range boundaries are fixed. Only one summary row per partition is then ordered centrally, so the
central part grows with the number of partitions and not with the data.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shopflow.plans.storage import materialize

_BITS = 33  # monotonically_increasing_id keeps the row index in the low 33 bits


def range_ordered(frame: DataFrame, *order, scratch: str | None = None) -> DataFrame:
    """Stored copy in global order, with _part (partition rank) and _row (position inside it)."""
    ordered = frame.repartitionByRange(*order).sortWithinPartitions(*order)
    tagged = ordered.withColumn("_position", F.monotonically_increasing_id())
    return (
        materialize(tagged, "ordered", scratch)
        .withColumn("_part", F.shiftright("_position", _BITS))
        .withColumn("_row", F.col("_position").bitwiseAND(F.lit((1 << _BITS) - 1)))
        .drop("_position")
    )


def _earlier_parts(summary: DataFrame):
    # One row per range partition: the only thing that is ordered in a single task.
    return Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)


def with_row_number(frame: DataFrame, *order, name: str = "row_number") -> DataFrame:
    """Exact 1-based global row number."""
    ordered = range_ordered(frame, *order)
    sizes = ordered.groupBy("_part").agg(F.count(F.lit(1)).alias("_size"))
    offsets = sizes.select(
        "_part", F.coalesce(F.sum("_size").over(_earlier_parts(sizes)), F.lit(0)).alias("_offset")
    )
    return (
        ordered.join(F.broadcast(offsets), "_part")  # one row per partition
        .withColumn(name, F.col("_offset") + F.col("_row") + 1)
        .drop("_part", "_row", "_offset")
    )


def with_running(
    frame: DataFrame, order: list, totals: dict[str, tuple[str, Column]], scratch: str | None = None
) -> DataFrame:
    """Running sum or max over the global order; totals maps a new column to (kind, expression)."""
    ordered = range_ordered(frame, *order, scratch=scratch)
    combine = {"sum": F.sum, "max": F.max}
    per_part = ordered.groupBy("_part").agg(
        *[combine[kind](value).alias(name) for name, (kind, value) in totals.items()]
    )
    carried = per_part.select(
        "_part",
        *[
            combine[kind](name).over(_earlier_parts(per_part)).alias(f"_before_{name}")
            for name, (kind, _) in totals.items()
        ],
    )
    inside = Window.partitionBy("_part").orderBy("_row").rowsBetween(Window.unboundedPreceding, 0)
    out = ordered.join(F.broadcast(carried), "_part")  # one row per partition
    for name, (kind, value) in totals.items():
        local = combine[kind](value).over(inside)
        before = F.col(f"_before_{name}")
        whole = F.coalesce(before, F.lit(0)) + local if kind == "sum" else F.greatest(before, local)
        out = out.withColumn(name, whole)
    return out.drop("_part", "_row", *[f"_before_{name}" for name in totals])


def with_rank_in_group(frame: DataFrame, keys: list[str], order: list, name: str = "position") -> DataFrame:
    """1-based position inside each group, for groups of any size.

    A group that spans several range partitions is one of at most two boundary groups of each
    partition, so the carried sizes stay below two rows per partition.
    """
    ordered = range_ordered(frame, *keys, *order)
    sizes = ordered.groupBy("_part", *keys).agg(
        F.count(F.lit(1)).alias("_size"), F.min("_row").alias("_first")
    )
    # Only the group that opens a partition can have started earlier.
    span = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    openers = (
        sizes.withColumn("_offset", F.sum("_size").over(span))
        .filter(F.col("_offset").isNotNull())
        .select(*[F.col(k).alias(f"_k_{k}") for k in keys], F.col("_part").alias("_p"), "_offset")
    )
    same = F.col("_part") == F.col("_p")
    for key in keys:
        same = same & F.col(key).eqNullSafe(F.col(f"_k_{key}"))
    inside = Window.partitionBy("_part", *keys).orderBy("_row")
    return (
        ordered.withColumn("_local", F.row_number().over(inside))
        .join(F.broadcast(openers), same, "left")  # at most one row per partition
        .withColumn(name, F.coalesce("_offset", F.lit(0)) + F.col("_local"))
        .drop("_part", "_row", "_local", "_p", "_offset", *[f"_k_{k}" for k in keys])
    )


def with_running_in_group(frame: DataFrame, keys: list[str], order: list, sums: list[str]) -> DataFrame:
    """Running sums over the rows of each group, in order, in place of the given columns; nulls add nothing.

    Groups may have any size: range partitions split them by rows, and only the group that opens a partition has a total
    to carry, so at most one row per partition is broadcast.
    """
    ordered = range_ordered(frame, *keys, *order)
    totals = ordered.groupBy("_part", *keys).agg(*[F.sum(c).alias(f"_t_{c}") for c in sums])
    earlier = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    openers = (
        totals.withColumns({"_parts": F.count(F.lit(1)).over(earlier), **{f"_o_{c}": F.sum(f"_t_{c}").over(earlier) for c in sums}})
        .filter(F.col("_parts") > 0)
        .select(*[F.col(k).alias(f"_k_{k}") for k in keys], F.col("_part").alias("_p"), *[f"_o_{c}" for c in sums])
    )
    same = F.col("_part") == F.col("_p")
    for key in keys:
        same = same & F.col(key).eqNullSafe(F.col(f"_k_{key}"))
    inside = Window.partitionBy("_part", *keys).orderBy("_row").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rest = [c for c in frame.columns if c not in sums]
    running = [(F.coalesce(F.col(f"_o_{c}"), F.lit(0)) + F.coalesce(F.sum(c).over(inside), F.lit(0))).alias(c) for c in sums]
    return ordered.join(F.broadcast(openers), same, "left").select(*rest, *running)
