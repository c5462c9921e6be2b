"""Trailing sums and distinct counts per entity, and trailing row histories.

A trailing total is the difference of two running totals: the one at an event and the one just before its horizon begins.
Both are frames that only grow, which Spark moves forward without reading a row twice, so entities of ordinary size take one
shuffle and one sort for all horizons. The rows of an entity that is too large for a task are first combined per tick,
map-side, and its running totals go over range partitions that split it by its rows. Either route is linear and gives the
same whole numbers and decimals.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shopflow.plans.hot_keys import ROWS_PER_TASK, hot_keys, null_safe_join, with_blocks
from shopflow.plans.ordering import with_running_in_group


def rolling(
    events: DataFrame,
    keys: list[str],
    timestamp: str,
    sums: dict[str, tuple[Column, int]],
    distincts: dict[str, tuple[str, int]] | None = None,
    *,
    exclusive: bool = False,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Add trailing totals over [t - seconds, t] to every event.

    sums maps a new column to (expression, seconds), where the expression is a whole number or a decimal, so that
    differences are exact; distincts to (column, seconds). A sum over no value but nulls is null, a count of no value 0.
    Time counts in whole seconds and peers of the same second are included. exclusive=True works on microseconds and
    opens the lower end, (t - seconds, t]. Entities of more than rows_per_task rows are split.
    """
    distincts = distincts or {}
    scale = 1 if exclusive else 1_000_000
    ticks_per_second = 1_000_000 // scale
    lower = {s: s * ticks_per_second - (1 if exclusive else 0) for _, s in [*sums.values(), *distincts.values()]}
    prepared = events.withColumn("_tick", F.floor(F.unix_micros(timestamp) / F.lit(scale)).cast("bigint"))
    hot = hot_keys(prepared, keys, rows_per_task)
    if hot is None:
        return _direct(prepared, keys, sums, distincts, lower)
    names = hot.select(*keys)
    return _direct(null_safe_join(prepared, names, keys, "left_anti"), keys, sums, distincts, lower).unionByName(
        _split(null_safe_join(prepared, names, keys, "left_semi"), keys, sums, distincts, lower)
    )


def _direct(prepared: DataFrame, keys: list[str], sums: dict, distincts: dict, lower: dict[int, int]) -> DataFrame:
    """Trailing totals of entities that fit a task: growing frames over one order."""
    kinds = prepared.select(*[F.sum(value).alias(n) for n, (value, _) in sums.items()]).schema if sums else None
    rows = prepared.withColumns({f"_m_{n}": value for n, (value, _) in sums.items()})
    for name, (column, span) in distincts.items():
        rows = rows.unionByName(_cover_steps(prepared, keys, column, lower[span], name).withColumnRenamed("_at", "_tick"), allowMissingColumns=True)
    if distincts:
        step = " + ".join(f"abs(coalesce({n}, 0))" for n in distincts)
        rows = rows.withColumn("_is_step", F.expr(step) > 0)
    line = Window.partitionBy(*keys).orderBy("_tick")
    up_to = lambda end: line.rangeBetween(Window.unboundedPreceding, end)
    out = rows
    for name, (_, seconds) in sums.items():
        value, now, before = f"_m_{name}", up_to(Window.currentRow), up_to(-lower[seconds] - 1)
        total = F.coalesce(F.sum(value).over(now), F.lit(0)) - F.coalesce(F.sum(value).over(before), F.lit(0))
        some = F.count(value).over(now) > F.count(value).over(before)
        out = out.withColumn(name, F.when(some, total).cast(kinds[name].dataType))
    for name in distincts:
        out = out.withColumn(f"_d_{name}", F.coalesce(F.sum(name).over(up_to(Window.currentRow)), F.lit(0)).cast("int"))
    if distincts:
        out = out.filter(~F.col("_is_step")).drop("_is_step", *distincts).withColumnsRenamed({f"_d_{n}": n for n in distincts})
    return out.drop("_tick", *[f"_m_{n}" for n in sums])


def _split(prepared: DataFrame, keys: list[str], sums: dict, distincts: dict, lower: dict[int, int]) -> DataFrame:
    """Trailing totals of entities of any size: points and questions in range partitions that split an entity."""
    spans = sorted(set(lower.values()))
    measured = prepared.select(*keys, "_tick", *[value.alias(f"_m_{name}") for name, (value, _) in sums.items()])
    per_tick = measured.groupBy(*keys, "_tick").agg(
        F.count(F.lit(1)).alias("_rows"), *[F.sum(f"_m_{n}").alias(n) for n in sums], *[F.count(f"_m_{n}").alias(f"_values_{n}") for n in sums]
    )
    kinds = {n: per_tick.schema[n].dataType for n in sums}

    # What an event adds comes before what it asks at the same tick: at the tick itself and before every horizon.
    points = per_tick.drop("_rows").withColumnRenamed("_tick", "_at").withColumn("_asks", F.lit(False))
    for name, (column, span) in distincts.items():
        steps = _cover_steps(prepared, keys, column, lower[span], name).withColumn("_asks", F.lit(False))
        points = points.unionByName(steps, allowMissingColumns=True)
    asked = [F.struct(F.col("_tick").alias("_at"), F.lit(-1).cast("bigint").alias("_span"))]
    asked += [F.struct((F.col("_tick") - s - 1).alias("_at"), F.lit(s).cast("bigint").alias("_span")) for s in spans]
    questions = per_tick.select(*keys, F.col("_tick").alias("_origin"), F.explode(F.array(*asked)).alias("_ask"))
    questions = questions.select(*keys, "_origin", "_ask.*").withColumn("_asks", F.lit(True))
    points = points.unionByName(questions, allowMissingColumns=True)

    counted = [*sums, *[f"_values_{n}" for n in sums], *distincts]
    running = with_running_in_group(points, keys, ["_at", "_asks"], counted).filter("_asks")
    span_of = {**{n: lower[s] for n, (_, s) in sums.items()}, **{f"_values_{n}": lower[s] for n, (_, s) in sums.items()}}

    def at(name: str, span: int) -> Column:
        return F.max(F.when(F.col("_span") == span, F.col(name)))

    found = running.groupBy(*keys, F.col("_origin").alias("_tick")).agg(
        *[(at(n, -1) - at(n, s)).alias(n) for n, s in span_of.items()], *[at(n, -1).cast("int").alias(n) for n in distincts]
    )
    found = found.select(
        *keys, "_tick", *[F.when(F.col(f"_values_{n}") > 0, F.col(n)).cast(kinds[n]).alias(n) for n in sums], *distincts
    )
    return null_safe_join(prepared, found, [*keys, "_tick"], "inner").drop("_tick")


def _cover_steps(events: DataFrame, keys: list[str], column: str, span: int, name: str) -> DataFrame:
    """Steps of the distinct count: +1 when a value enters the horizon, -1 after it has left.

    Within one day-long slice a value never leaves (horizons are longer), so first and last tick per
    slice decide, and those are combined map-side.
    """
    slice_ticks = max(1, span // 2)
    value = [*keys, column]
    slices = events.groupBy(*value, F.floor(F.col("_tick") / F.lit(slice_ticks)).alias("_slice")).agg(
        F.min("_tick").alias("_first"), F.max("_tick").alias("_last")
    )
    line = Window.partitionBy(*value).orderBy("_slice")
    gap_before = F.col("_first") - F.lag("_last").over(line)
    gap_after = F.lead("_first").over(line) - F.col("_last")
    steps = slices.filter(F.col(column).isNotNull()).select(
        *keys,
        F.when(gap_before.isNull() | (gap_before > span), F.col("_first")).alias("_enter"),
        F.when(gap_after.isNull() | (gap_after > span), F.col("_last") + span + 1).alias("_leave"),
    )
    ends = F.explode(
        F.array(
            F.struct(F.col("_enter").alias("_at"), F.lit(1).alias(name)),
            F.struct(F.col("_leave").alias("_at"), F.lit(-1).alias(name)),
        )
    )
    return steps.select(*keys, ends.alias("_e")).select(*keys, "_e.*").filter(F.col("_at").isNotNull())


def trailing_rows(
    events: DataFrame,
    keys: list[str],
    timestamp: str,
    tie_break: str,
    row: Column,
    n: int,
    name: str = "history",
    *,
    include_current: bool = True,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Add the last n rows of the entity, oldest first, as an array.

    Every block of a hot key starts from the last n rows before it; n non-empty blocks always hold
    them, so the carry is exact.
    """
    prepared = events.withColumn("_row", row)
    blocked, split = with_blocks(prepared, keys, timestamp, rows_per_task, null_keys_match=True)
    last = 0 if include_current else -1
    inside = Window.partitionBy(*keys, "_block").orderBy(timestamp, tie_break).rowsBetween(last - n + 1, last)
    rows = F.collect_list("_row").over(inside)
    if not split:
        return blocked.withColumn(name, rows).drop("_row", "_block")
    carried = _tails(blocked, keys, timestamp, tie_break, n)
    joined = null_safe_join(blocked, carried, [*keys, "_block"], "left")
    joined = joined.withColumn(name, F.concat(F.coalesce("_carry", F.array().cast(_array_of(blocked, "_row"))), rows))
    trimmed = F.when(F.size(name) > n, F.slice(name, -n, n)).otherwise(F.col(name))
    return joined.withColumn(name, trimmed).drop("_row", "_hot", "_block", "_carry")


def _tails(blocked: DataFrame, keys: list[str], timestamp: str, tie_break: str, n: int) -> DataFrame:
    """Per block of a hot key: the last n rows of the blocks before it, oldest first."""
    block = [*keys, "_block"]
    newest = Window.partitionBy(*block).orderBy(F.desc(timestamp), F.desc(tie_break))
    tails = (
        blocked.filter("_hot")
        .select(*block, timestamp, tie_break, "_row", F.row_number().over(newest).alias("_back"))
        .filter(F.col("_back") <= n)
        .groupBy(*block)
        .agg(F.sort_array(F.collect_list(F.struct(timestamp, tie_break, "_row"))).alias("_tail"))
    )
    before = Window.partitionBy(*keys).orderBy("_block").rowsBetween(-n, -1)
    carried = tails.select(*block, F.flatten(F.collect_list("_tail").over(before)).alias("_carry"))
    return carried.select(*block, F.transform("_carry", lambda x: x["_row"]).alias("_carry"))


def _array_of(frame: DataFrame, column: str) -> str:
    return f"array<{frame.schema[column].dataType.simpleString()}>"
