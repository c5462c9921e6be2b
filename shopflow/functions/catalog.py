"""Catalogue attributes that follow from an item id."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopflow.functions.text import slug

WAREHOUSES = ["north", "centre", "south"]


def attributes(item_id: Column, warehouses: list[str] = WAREHOUSES) -> dict[str, Column]:
    """Stock of 10 to 100, rating of 4.0 to 4.9, 50 to 500 reviews, and a warehouse by turn."""
    return {
        "stock_quantity": F.pmod(item_id, F.lit(91)) + 10,
        "average_rating": (F.lit(40) + F.pmod(item_id, F.lit(10))) / F.lit(10.0),
        "total_reviews": F.pmod(item_id, F.lit(451)) + 50,
        "warehouse_location": F.element_at(
            F.array(*[F.lit(w) for w in warehouses]), (F.pmod(item_id, F.lit(len(warehouses))) + 1).cast("int")
        ),
    }


def sku(brand: Column, category: Column, item_id: Column) -> Column:
    return F.concat_ws("-", slug(brand), slug(category), item_id.cast("string"))


def map_dimension(frame: DataFrame, mapping: DataFrame, key: str, value: str) -> tuple[DataFrame, DataFrame]:
    """Rows with the mapped value, and the rows whose key is unknown: those are rejected, not guessed."""
    joined = frame.join(mapping.select(key, value), key, "left")
    known = joined.filter(F.col(value).isNotNull())
    unknown = joined.filter(F.col(value).isNull()).drop(value)
    return known, unknown.withColumn("rejection_reason", F.lit(f"unknown_{key}"))
