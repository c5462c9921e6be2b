"""Splitting of hot keys by time.

A key with more rows than one task should hold is cut into time blocks; all other keys stay whole
in block 0. Blocks are cut at quantiles of the key's own rows, so a stray time or a dense day leaves
them even; only rows of one and the same instant stay together. A key that needs more blocks than there
are quantiles has its blocks cut again in the same way, so blocks stay bounded at any size of a key. What a block needs from earlier blocks
(a latest value, a running total, a tail of rows) is carried in from one summary row per block.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shopflow.plans.storage import materialize

ROWS_PER_TASK = 1_000_000
QUANTILES = 1024  # a key's blocks have edges at some of these, round by round; their rank error is a tenth of a step at most


def null_safe_join(left: DataFrame, right: DataFrame, keys: list[str], how: str) -> DataFrame:
    """Join that treats null keys as equal and keeps the left key columns once."""
    renamed = right.select(
        *[F.col(k).alias(f"_r_{k}") for k in keys], *[c for c in right.columns if c not in keys]
    )
    same = reduce(lambda a, b: a & b, [left[k].eqNullSafe(renamed[f"_r_{k}"]) for k in keys])
    return left.join(renamed, same, how).drop(*[f"_r_{k}" for k in keys])


def hot_keys(frame: DataFrame, keys: list[str], limit: int) -> DataFrame | None:
    """Keys with more than limit rows and their count _n; None where there are none.

    The count reads the key columns alone and combines map-side, so it moves one row per key and map
    task however hot a key is. It runs at once: without hot keys, which is the usual case, the plan
    that follows needs neither a join nor a second branch. At most rows/limit keys qualify.
    """
    counted = frame.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > limit)
    return None if counted.isEmpty() else materialize(counted, "hot")


def block_edges(frame: DataFrame, hot: DataFrame, keys: list[str], timestamp: str, rows_per_task: int) -> DataFrame:
    """Per hot key the times that part its rows into blocks of about rows_per_task rows."""
    rows = null_safe_join(frame.select(*keys, F.unix_micros(timestamp).alias("_micros")), hot, keys, "inner")
    steps = [i / QUANTILES for i in range(1, QUANTILES)]
    ranked = rows.groupBy(*keys).agg(F.first("_n").alias("_n"), F.percentile_approx("_micros", steps, 10 * QUANTILES).alias("_all"))
    blocks = F.least(F.ceil(F.col("_n") / F.lit(rows_per_task)), F.lit(QUANTILES))
    # The quantiles next to the even cuts; equal ones, where many rows share a time, cut once.
    cuts = F.transform(F.sequence(F.lit(1), blocks - 1), lambda i: F.element_at("_all", F.round(i * QUANTILES / blocks).cast("int")))
    return materialize(ranked.select(*keys, F.array_distinct(F.when(blocks > 1, cuts)).alias("_edges")), "edges")


def with_blocks(
    frame: DataFrame, keys: list[str], timestamp: str, rows_per_task: int = ROWS_PER_TASK, *, null_keys_match: bool = False
) -> tuple[DataFrame, bool]:
    """Add _block, and _hot where some key is split; also returns whether one is.

    (keys, _block) is a safe window partition for ordered work. Unless null keys match each other, rows
    with a null key have no partners and stay in blocks of their own, one per partition they come from.
    """
    known = frame if null_keys_match else frame.dropna(subset=keys)
    hot = hot_keys(known, keys, rows_per_task)
    block = F.lit(0).cast("bigint")
    split = frame
    if hot is not None:
        split = _cut(frame.withColumn("_block", block), known, hot, keys, timestamp, rows_per_task)
        split = split.withColumn("_hot", F.col("_passed").isNotNull())
        most = hot.agg(F.max("_n")).first()[0] / rows_per_task / QUANTILES
        while most > 1:  # one round per factor of QUANTILES, whatever the data
            split = split.withColumn("_block", _numbered()).drop("_passed")
            parts, rows = [*keys, "_block"], split.filter("_hot")
            heavy = hot_keys(rows, parts, rows_per_task)
            split = split.withColumn("_passed", F.lit(0)) if heavy is None else _cut(split, rows, heavy, parts, timestamp, rows_per_task)
            most /= QUANTILES
        split = split.withColumn("_block", F.when(F.col("_hot"), _numbered()).otherwise(block))
        block = F.col("_block")
    if not null_keys_match:
        has_key = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
        block = F.when(has_key, block).otherwise(F.spark_partition_id())
    return split.withColumn("_block", block.cast("bigint")).drop("_passed"), hot is not None


def _cut(frame: DataFrame, rows: DataFrame, hot: DataFrame, keys: list[str], timestamp: str, rows_per_task: int) -> DataFrame:
    """Add _passed, the number of edges of the key (or of its block) before the row; null where it is not cut."""
    cut = null_safe_join(frame, block_edges(rows, hot, keys, timestamp, rows_per_task), keys, "left")
    passed = F.when(F.col("_edges").isNotNull(), F.size(F.filter("_edges", lambda e: e < F.unix_micros(timestamp))))
    return cut.withColumn("_passed", passed).drop("_edges")


def _numbered() -> Column:
    """Block numbers after a cut, in the order of time."""
    return F.col("_block") * QUANTILES + F.coalesce("_passed", F.lit(0))


def top_k(frame: DataFrame, keys: list[str], order: list, k: int, name: str = "rank") -> DataFrame:
    """First k rows of each group.

    Spark prunes to k rows per group and map task before the shuffle (WindowGroupLimit), so a hot
    group never reaches one task whole.
    """
    ranked = frame.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.filter(F.col(name) <= k)
