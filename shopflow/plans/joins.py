"""Equi joins that hold up under hot keys."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopflow.plans.hot_keys import ROWS_PER_TASK, hot_keys
from shopflow.plans.storage import materialize


def salted_join(
    left: DataFrame, right: DataFrame, keys: list[str], how: str = "left", rows_per_task: int = ROWS_PER_TASK
) -> DataFrame:
    """Equi join whose left side may hold one key in a third of all rows.

    Where keys are hot, the left rows are stored with a number, which gives the salt: a retried task repeats
    its choice, and equal rows are spread as well. Their few right rows are copied once per salt. how: inner,
    left, left_semi or left_anti.
    """
    found = hot_keys(left.dropna(subset=keys), keys, rows_per_task)
    if found is None:
        return left.join(right, keys, how)
    hot = found.select(*keys, F.ceil(F.col("_n") / F.lit(rows_per_task)).cast("int").alias("_salts"))
    numbered = materialize(left.withColumn("_number", F.monotonically_increasing_id()), "numbered")
    spread = numbered.join(hot, keys, "left").withColumn("_salt", F.pmod("_number", F.coalesce("_salts", F.lit(1)).cast("bigint"))).drop("_number")
    copies = right.join(hot, keys, "left").withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1).cast("array<bigint>"))
    )
    return spread.drop("_salts").join(copies.drop("_salts"), [*keys, "_salt"], how).drop("_salt")
