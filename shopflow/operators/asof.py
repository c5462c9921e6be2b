"""Point-in-time joins.

Both sides are merged into one ordered stream per key and the latest feature row is carried forward,
which is linear in the rows of a key. Hot keys are cut into time blocks; each block starts from the
latest feature row of the blocks before it.
"""

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shopflow.plans.hot_keys import ROWS_PER_TASK, with_blocks


@dataclass(frozen=True)
class FeatureView:
    """A feature table to look up: rows of the key are valid from their timestamp on."""

    frame: DataFrame
    prefix: str
    timestamp: str = "feature_timestamp"
    tie_break: str | tuple[str, ...] | None = None  # most important first, compared in their own types
    ttl_seconds: int | None = None

    @property
    def ties(self) -> dict[str, str]:
        """Columns of the merged stream that order rows of this view at the same time, and where they come from."""
        columns = (self.tie_break,) if isinstance(self.tie_break, str) else self.tie_break or ()
        return {f"_tie{i}_{self.prefix}": c for i, c in enumerate(columns)}


def asof_join(
    left: DataFrame,
    timestamp: str,
    keys: dict[str, str],
    views: list[FeatureView],
    *,
    forward: bool = False,
    allow_equal: bool = True,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Left rows with the nearest row of every view, columns prefixed.

    keys maps left key columns to those of the views. All views share one shuffle. forward looks for
    the first later row instead of the last earlier one. Ties on the timestamp go to the highest
    tie_break (lowest when looking forward). A match older than its view's ttl_seconds becomes null.
    """
    names = [f"_k{i}" for i in range(len(keys))]
    own = left.select(
        *[F.col(k).alias(n) for k, n in zip(keys, names)],
        F.col(timestamp).alias("_ts"),
        F.lit(1 if allow_equal else -1).alias("_turn"),
        F.struct(*left.columns).alias("_left"),
    )
    stream = own
    for view in views:
        rows = view.frame.select(
            *[F.col(k).alias(n) for k, n in zip(keys.values(), names)],
            F.col(view.timestamp).alias("_ts"),
            F.lit(0).alias("_turn"),
            *[F.col(c).alias(name) for name, c in view.ties.items()],
            F.struct(*[c for c in view.frame.columns if c not in keys.values()]).alias(f"_v_{view.prefix}"),
        ).dropna(subset=[*names, "_ts"])
        stream = stream.unionByName(rows, allowMissingColumns=True)

    stream, split = with_blocks(stream, names, "_ts", rows_per_task)
    # Rows of other views have no value in a view's tie columns, so they never come between its rows.
    ties = [name for view in views for name in view.ties]
    nearest_last = F.desc if forward else F.asc
    order = [nearest_last("_ts"), F.asc("_turn"), *[nearest_last(name) for name in ties]]
    inside = Window.partitionBy(*names, "_block").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    match = {v.prefix: F.last(f"_v_{v.prefix}", ignorenulls=True).over(inside) for v in views}
    if split:
        stream = stream.join(_carried(stream, names, views, forward), [*names, "_block"], "left")
        match = {prefix: F.coalesce(value, F.col(f"_c_{prefix}")) for prefix, value in match.items()}
    found = stream.select("_left", *[value.alias(f"_v_{prefix}") for prefix, value in match.items()])
    found = found.filter(F.col("_left").isNotNull())
    columns = [F.col(f"_left.{c}").alias(c) for c in left.columns]
    for view in views:
        match = F.col(f"_v_{view.prefix}")
        if view.ttl_seconds is not None:
            age = F.unix_micros(f"_left.{timestamp}") - F.unix_micros(match[view.timestamp])
            match = F.when(F.abs(age) <= F.lit(view.ttl_seconds * 1_000_000), match)
        columns += [
            match[c].alias(f"{view.prefix}_{c}") for c in view.frame.columns if c not in keys.values()
        ]
    return found.select(*columns)


def _carried(stream: DataFrame, names: list[str], views: list[FeatureView], forward: bool) -> DataFrame:
    """Per block of a hot key: the nearest row of each view in the blocks before it."""
    pick = F.min_by if forward else F.max_by
    nearest = [
        pick(f"_v_{v.prefix}", F.when(F.col(f"_v_{v.prefix}").isNotNull(), F.struct("_ts", *v.ties))).alias(f"_c_{v.prefix}")
        for v in views
    ]
    blocks = Window.partitionBy(*names).orderBy(F.desc("_block") if forward else F.asc("_block"))
    before = blocks.rowsBetween(Window.unboundedPreceding, -1)
    per_block = stream.filter("_hot").groupBy(*names, "_block").agg(*nearest)
    return per_block.select(
        *names, "_block", *[F.last(f"_c_{v.prefix}", ignorenulls=True).over(before).alias(f"_c_{v.prefix}") for v in views]
    )


def scd_join(
    facts: DataFrame, dimension: DataFrame, key: str, timestamp: str, how: str = "left"
) -> DataFrame:
    """Join facts to the dimension version valid at their time, [valid_from, valid_to) with open end.

    Versions of one key do not overlap, so at most one row matches. No broadcast is forced: Spark
    picks one from the measured size, else a sort-merge join whose hot keys adaptive execution splits.
    """
    f, d = facts.alias("f"), dimension.alias("d")
    at = F.col(f"f.{timestamp}")
    valid = (
        (F.col(f"f.{key}") == F.col(f"d.{key}"))
        & (at >= F.col("d.valid_from"))
        & (F.col("d.valid_to").isNull() | (at < F.col("d.valid_to")))
    )
    kept = [c for c in dimension.columns if c != key and c not in facts.columns]
    return f.join(d, valid, how).select("f.*", *[F.col(f"d.{c}") for c in kept])


def close_intervals(snapshots: DataFrame, key: str = "product_id") -> DataFrame:
    """Fill valid_to from the next version's valid_from where the source left it open."""
    following = F.lead("valid_from").over(Window.partitionBy(key).orderBy("valid_from"))
    return snapshots.withColumn("valid_to", F.coalesce("valid_to", following))


def interval_counts(
    left: DataFrame,
    identity: str,
    timestamp: str,
    right: DataFrame,
    right_timestamp: str,
    keys: dict[str, str],
    seconds: int,
    name: str = "matches",
    *,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Left rows with the number of right rows of the key in (t, t + seconds].

    The count is a difference of two running totals, so pairs are never listed.
    """
    names = [f"_k{i}" for i in range(len(keys))]
    wanted = F.explode(
        F.array(
            F.struct(F.col(timestamp).alias("_ts"), F.lit(-1).alias("_sign")),
            F.struct((F.col(timestamp) + F.make_dt_interval(secs=F.lit(seconds))).alias("_ts"), F.lit(1).alias("_sign")),
        )
    )
    probes = left.select(F.col(identity).alias("_id"), *[F.col(k).alias(n) for k, n in zip(keys, names)], wanted.alias("_p"))
    probes = probes.select("_id", *names, "_p.*", F.lit(0).alias("_one"))
    hits = right.select(
        *[F.col(k).alias(n) for k, n in zip(keys.values(), names)], F.col(right_timestamp).alias("_ts"), F.lit(1).alias("_one")
    ).dropna(subset=names)
    points, split = with_blocks(probes.unionByName(hits, allowMissingColumns=True), names, "_ts", rows_per_task)
    inside = Window.partitionBy(*names, "_block").orderBy("_ts").rangeBetween(Window.unboundedPreceding, 0)
    total = F.sum("_one").over(inside)
    if split:
        per_block = points.filter("_hot").groupBy(*names, "_block").agg(F.sum("_one").alias("_n"))
        earlier = Window.partitionBy(*names).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
        offsets = per_block.select(*names, "_block", F.sum("_n").over(earlier).alias("_before"))
        points = points.join(offsets, [*names, "_block"], "left")
        total = F.coalesce("_before", F.lit(0)) + total
    counted = (
        points.withColumn("_total", total)
        .filter(F.col("_id").isNotNull())
        .groupBy(F.col("_id").alias(identity))
        .agg(F.sum(F.col("_total") * F.col("_sign")).alias(name))
    )
    return left.join(counted, identity)
