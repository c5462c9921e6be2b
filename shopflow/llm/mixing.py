"""Mixing sources to target weights by a Pfair schedule.

Each source is a task whose weight is an integer share of a period, and its rows are cut into blocks of equal size. Block
i (from 0) of a source with `share` slots in a period of `period` may not start before its release floor(i * period /
share) and must be placed by its deadline ceil((i + 1) * period / share). In every slot the released block with the
earliest deadline goes next. As all shares add up to the period, every block meets its window, so after any number of
slots a source is less than one block away from its target.

The schedule repeats after one period, because all windows do. So one period is planned, in a single fold over its slots
(its size is a parameter, not the data's), and every block finds its slot by its number in the period.
"""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shopflow.plans.ordering import with_rank_in_group

LEAST_SLOTS = 8  # slots of a period per source, so that rounding the shares leaves each source one


def targets(docs: DataFrame, source: str, weights: dict[str, float] | None = None, most: float = 0.25, period: int = 1024) -> DataFrame:
    """One row per source: _source, _n rows, target weight, share (slots in a period), period and capped.

    Without weights the target is the source's own part of the rows, but no more than `most` (or an even part, where the
    sources are too few for that); what is cut goes to the others in proportion. Shares are rounded by largest remainder
    and are 1 at least. capped: the weight is not the source's own part of what is left (always so with weights). The table has one row per source, so ordering it in one task is bounded.
    """
    counted = docs.groupBy(F.col(source).alias("_source")).agg(F.count(F.lit(1)).alias("_n"))
    if weights is not None:
        given = docs.sparkSession.createDataFrame([(k, float(v)) for k, v in weights.items() if v > 0], "_name string, _given double")
        counted = counted.join(F.broadcast(given), counted["_source"].eqNullSafe(given["_name"]))
    ranked = Window.orderBy(F.desc("_n"), F.col("_source").asc_nulls_first())
    everything = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rows = counted.withColumn("_rank", F.row_number().over(ranked)).withColumn("_sources", F.count(F.lit(1)).over(everything))
    if weights is not None:
        rows = rows.withColumn("weight", F.col("_given") / F.sum("_given").over(everything))
    else:
        rest = F.sum("_n").over(ranked.rowsBetween(Window.currentRow, Window.unboundedFollowing))
        rows = rows.withColumn("_most", F.greatest(F.lit(most), 1 / F.col("_sources"))).withColumn("_rest", rest)
        free = F.col("_n") / F.col("_rest") * (1 - (F.col("_rank") - 1) * F.col("_most"))
        rows = rows.withColumn("_capped", free > F.col("_most")).withColumn("_caps", F.sum(F.col("_capped").cast("int")).over(everything))
        left = F.sum(F.when(~F.col("_capped"), F.col("_n"))).over(everything)
        rows = rows.withColumn(
            "weight", F.when(F.col("_capped"), F.col("_most")).otherwise(F.col("_n") / left * (1 - F.col("_caps") * F.col("_most")))
        )
    rows = rows.withColumn("period", F.greatest(F.lit(period), F.col("_sources") * LEAST_SLOTS).cast("long"))
    exact = F.col("weight") * F.col("period")
    rows = rows.withColumn("_floor", F.greatest(F.floor(exact + 1e-9), F.lit(1)).cast("long")).withColumn("_part", exact - F.col("_floor"))
    rows = rows.withColumn("_over", F.col("period") - F.sum("_floor").over(everything))
    by_part = Window.orderBy(F.desc("_part"), F.col("_source").asc_nulls_first())
    by_share = Window.orderBy(F.desc("_floor"), F.col("_source").asc_nulls_first())
    more = (F.row_number().over(by_part) <= F.col("_over")).cast("long")
    less = F.when((F.row_number().over(by_share) == 1) & (F.col("_over") < 0), F.col("_over")).otherwise(0)
    capped = F.lit(True) if weights is not None else F.col("_capped")
    return rows.select("_source", "_n", "weight", (F.col("_floor") + more + less).alias("share"), "period", capped.alias("capped"))


def pattern(shares: DataFrame) -> DataFrame:
    """One period: _source, _turn (number of its block in the period) and _slot, by earliest deadline first."""
    task = F.struct(F.col("_source").isNotNull().alias("named"), F.col("_source").alias("name"), F.col("share").alias("share"))
    one = shares.agg(F.array_sort(F.collect_list(task)).alias("tasks"), F.first("period").alias("period"))
    begin = F.struct(F.transform("tasks", lambda t: F.lit(0).cast("long")).alias("done"), F.array().cast("array<int>").alias("order"))

    def step(state, slot):
        def window_of(task, i):
            done = state["done"][i]
            release = F.floor(done * F.col("period") / task["share"])
            deadline = F.ceil((done + 1) * F.col("period") / task["share"])
            return F.when(release <= slot, F.struct(deadline.alias("deadline"), i.cast("int").alias("task")))

        chosen = F.array_min(F.transform("tasks", window_of))["task"]
        return F.struct(
            F.transform(state["done"], lambda d, i: F.when(i == chosen, d + 1).otherwise(d)).alias("done"),
            F.concat(state["order"], F.array(chosen)).alias("order"),
        )

    slots = F.sequence(F.lit(0).cast("long"), F.col("period") - 1)
    order = one.filter(F.size("tasks") > 0).select("tasks", F.posexplode(F.aggregate(slots, begin, step)["order"]).alias("_slot", "_task"))
    turn = F.row_number().over(Window.partitionBy("_task").orderBy("_slot")) - 1
    return order.filter(F.col("_task").isNotNull()).select(
        F.element_at("tasks", F.col("_task") + 1)["name"].alias("_source"), turn.cast("long").alias("_turn"), F.col("_slot").cast("long").alias("_slot")
    )


def mix(
    docs: DataFrame,
    doc_id: str = "doc_id",
    source: str = "source",
    weights: dict[str, float] | None = None,
    most: float = 0.25,
    block_rows: int = 64,
    period: int = 1024,
    until: float = 0.7,
) -> DataFrame:
    """The place of every row in the mix: one row per input row.

    Rows of a source come in the order of a hash of their id, then by id. Every block gets a slot; a source that has run
    out leaves its slots empty and the others keep their windows. The mix ends (in_mix turns false) where sources of at
    least `until` of the target weight have run out, because from there on the targets cannot be met. Sources below the cap
    lie in it whole, also if their share was rounded down and they outlast the others. A null source is a
    source of its own; null ids and rows that repeat an id take their places like any other. With weights, a source that
    is not listed gets no slot. Returns _id, _source, block, release, deadline, slot, position (a sort key), in_mix.
    """
    rows = docs.select(F.col(doc_id).alias("_id"), F.col(source).alias("_source"))
    shares = targets(rows, "_source", weights, most, period)
    ended = F.ceil(F.ceil(F.col("_n") / block_rows) * F.col("period") / F.col("share")).cast("long")
    gone = F.sum("share").over(Window.orderBy("_ended").rangeBetween(Window.unboundedPreceding, Window.currentRow))
    end = (
        shares.withColumn("_ended", ended)
        .withColumn("_gone", gone)
        .agg(F.min(F.when(F.col("_gone") >= F.lit(until) * F.col("period"), F.col("_ended"))).alias("_end"))
    )
    plan = shares.drop("_n", "capped").join(pattern(shares).withColumnRenamed("_source", "_s"), F.col("_source").eqNullSafe(F.col("_s"))).drop("_s")
    plan = plan.withColumnsRenamed({"_source": "_of"}).crossJoin(F.broadcast(end))  # one row
    ranked = with_rank_in_group(rows.withColumn("_hash", F.xxhash64("_id")), ["_source"], ["_hash", "_id"], "_place")
    block = F.floor((F.col("_place") - 1) / block_rows).cast("long")
    numbered = ranked.withColumn("block", block).join(F.broadcast(shares.select(F.col("_source").alias("_whose"), F.col("share").alias("_share"), F.col("capped").alias("_is_capped"))), F.col("_source").eqNullSafe(F.col("_whose")), "left")
    numbered = numbered.withColumn("_turn_of", F.col("block") % F.col("_share")).drop("_whose")
    same = F.col("_source").eqNullSafe(F.col("_of")) & (F.col("_turn_of") == F.col("_turn"))
    # At most one row per slot of the period.
    placed = numbered.join(F.broadcast(plan), same, "left")
    slot = F.floor(F.col("block") / F.col("share")).cast("long") * F.col("period") + F.col("_slot")
    return placed.withColumn("slot", slot).select(
        "_id",
        "_source",
        "block",
        F.floor(F.col("block") * F.col("period") / F.col("share")).cast("long").alias("release"),
        F.ceil((F.col("block") + 1) * F.col("period") / F.col("share")).cast("long").alias("deadline"),
        "slot",
        (F.col("slot") * block_rows + (F.col("_place") - 1) % block_rows).alias("position"),
        F.coalesce((F.col("slot") < F.col("_end")) | ~F.col("_is_capped"), F.lit(False)).alias("in_mix"),
    )
