"""Registry of runnable queries and their SQL answers."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from shopflow.queries.prelude import with_views
from shopflow.session import prepare
from shopflow.sources.shop import Shop

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None, views: dict[str, str] | None = None):
    """Register a function of the Shop; sql is the answer another engine computes."""

    def register(build: Callable[[Shop], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")

        def run(spark: SparkSession, folder: str) -> DataFrame:
            return build(Shop(prepare(spark), folder))

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = with_views(sql, views)
        return build

    return register
