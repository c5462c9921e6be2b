"""Raw tables to clean ones, by declared contracts.

A contract says what a clean table must look like: types and defaults of its fields, computed fields, why a row is refused,
and what identifies a row. One function applies any contract, and the silver zone is the list of its contracts.
"""

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopflow.functions.hashing import bucket, payload_hash
from shopflow.operators.features import event_type_id
from shopflow.plans.hot_keys import top_k


@dataclass(frozen=True)
class Field:
    """kind: the type of the clean column, None for the source's own. default: for nulls, and where the source has no such column."""

    kind: str | None = None
    default: object = None

    def read(self, frame: DataFrame, name: str) -> Column:
        if name not in frame.columns:
            return F.lit(self.default).cast(self.kind or "string")
        value, own = F.col(name), frame.schema[name].dataType.simpleString()
        if self.kind and self.kind != own:
            value = F.try_to_timestamp(value) if (self.kind, own) == ("timestamp", "string") else value.try_cast(self.kind)
        return value if self.default is None else F.coalesce(value, F.lit(self.default).cast(self.kind or own))


@dataclass(frozen=True)
class Source:
    """A raw table, the columns without which it is not used, and columns read under another name."""

    table: str
    needs: tuple[str, ...] = ()
    named: dict[str, str] = field(default_factory=dict)


@dataclass(frozen=True)
class Contract:
    name: str
    sources: tuple[Source, ...]  # the first one that has what it needs
    fields: dict[str, Field] = field(default_factory=dict)
    computed: dict[str, Callable[[], Column]] = field(default_factory=dict)
    refused: dict[str, str] = field(default_factory=dict)  # reason: condition
    identity: tuple[str, ...] = ()
    order: tuple[str, ...] = ()  # of rows with the same identity the first one stays


TIME = Field("timestamp")
EVENTS = Contract(
    "clean_behavior_events",
    (Source("behavior_events"),),
    {
        "device_type": Field(default="unknown"),
        "campaign_id": Field(default="none"),
        "schema_version": Field("smallint", 1),
        "event_timestamp": TIME,
        "ingestion_ts": TIME,
    },
    {"event_type_id": event_type_id},
    {"unsupported_schema_version": "schema_version > 2"},
    ("event_id",),
    ("ingestion_ts", "payload_hash"),
)
IMPRESSIONS = Contract(
    "clean_impressions",
    (Source("impressions"),),
    {"impression_timestamp": TIME},
    identity=("impression_id",),
    order=("impression_timestamp", "candidate_product_id"),
)
REQUESTS = Contract(
    "clean_recommendation_requests", (Source("recommendation_requests"),), {"request_context": Field(default="{}"), "request_timestamp": TIME}
)
VALIDITY = Contract(
    "product_scd",
    # Without snapshots every product has one open row from its creation.
    (Source("product_snapshots", ("valid_from",)), Source("products", ("created_ts",), {"valid_from": "created_ts"})),
    {"valid_from": TIME, "valid_to": TIME},
)
SILVER = (EVENTS, IMPRESSIONS, REQUESTS, VALIDITY, *[Contract(t, (Source(t),)) for t in ("users", "products", "user_preferences")])


def first_per_id(frame: DataFrame, identity: list[str], order: list[str]) -> DataFrame:
    """One row per id: the first by order. Copies are pruned map-side, so a hot id stays cheap."""
    return top_k(frame, identity, [F.asc(c) for c in order], 1, "_rank").drop("_rank")


def conform(frame: DataFrame, contract: Contract) -> tuple[DataFrame, DataFrame]:
    """Rows as the contract wants them, and the refused ones with their rejection_reason.

    Order is left to the writer: a sorted frame would only be shuffled again.
    """
    others = [c for c in frame.columns if c not in contract.fields]
    typed = frame.select(*others, *[f.read(frame, name).alias(name) for name, f in contract.fields.items()])
    typed = typed.withColumns({name: make() for name, make in contract.computed.items()})
    if not contract.refused:
        kept, rejected = typed, typed.filter(F.lit(False)).withColumn("rejection_reason", F.lit(None).cast("string"))
    else:
        reason = F.coalesce(*[F.when(F.expr(condition), F.lit(why)) for why, condition in contract.refused.items()])
        judged = typed.withColumn("rejection_reason", reason)
        kept, rejected = judged.filter("rejection_reason is null").drop("rejection_reason"), judged.filter("rejection_reason is not null")
    if contract.identity:
        kept = first_per_id(kept, list(contract.identity), list(contract.order))
    return kept, rejected


def from_zone(raw: dict[str, DataFrame], contract: Contract) -> tuple[DataFrame, DataFrame]:
    """The contract applied to the first of its sources that has what it needs."""
    for source in contract.sources:
        frame = raw.get(source.table)
        if frame is not None and set(source.needs) <= set(frame.columns):
            return conform(frame.withColumns({name: F.col(column) for name, column in source.named.items()}), contract)
    raise ValueError(f"no source for {contract.name}")


def silver_tables(raw: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """All clean tables of the raw zone, and the refused rows of those that refuse some."""
    out = {}
    for contract in SILVER:
        out[contract.name], rejected = from_zone(raw, contract)
        if contract.refused:
            out[contract.name.replace("clean_", "rejected_")] = rejected
    return out


HASHED_FIELDS = [
    "event_id", "user_id", "session_id", "request_id", "impression_id", "event_type", "product_id", "category_id",
    "brand_id", "price_bucket", "quantity", "device_type", "source", "campaign_id", "order_id", "schema_version",
]


def event_payload_hash() -> Column:
    return payload_hash({name: F.col(name) for name in HASHED_FIELDS})


def inject_problems(
    events: DataFrame, duplicate_rate: float, change_date: str, breaking_date: str | None = None, breaking_version: int = 3
) -> DataFrame:
    """Known data problems for testing the checks: schema versions by date, new hashes, exact copies by rate.

    Old versions lose the columns that came later. Copies are picked by a hash of the id, so the same
    rows are picked on every run.
    """
    day = F.to_date("event_timestamp")
    version = F.when(day >= F.lit(change_date).cast("date"), 2).otherwise(1)
    if breaking_date:
        version = F.when(day >= F.lit(breaking_date).cast("date"), breaking_version).otherwise(version)
    old = F.col("schema_version") < 2
    changed = (
        events.withColumn("schema_version", version)
        .withColumn("device_type", F.when(~old, F.coalesce("device_type", F.lit("mobile"))))
        .withColumn("campaign_id", F.when(~old, F.coalesce("campaign_id", F.lit("none"))))
        .withColumn("payload_hash", event_payload_hash())
    )
    copied = bucket(F.concat(F.lit("copy:"), F.col("event_id")), 1_000_000) < int(duplicate_rate * 1_000_000)
    return changed.withColumn("_copies", F.when(copied, 2).otherwise(1)).withColumn(
        "_copy", F.explode(F.sequence(F.lit(1), F.col("_copies")))
    ).drop("_copies", "_copy")


def clean_clickstream(rows: DataFrame) -> DataFrame:
    """Valid rows of a raw clickstream export: required fields, price not negative, known event types."""
    required = ["event_time", "event_type", "product_id", "user_id", "user_session"]
    return (
        rows.dropna(subset=required)
        .filter(F.coalesce("price", F.lit(0)) >= 0)
        .withColumn("event_time", TIME.read(rows, "event_time"))
        .dropna(subset=["event_time", "category_code"])
        .filter(F.col("event_type").isin("view", "cart", "remove_from_cart", "purchase"))
    )


NOT_FEATURES = {"label", "row_id"}
NUMERIC = ("tinyint", "smallint", "int", "bigint", "float", "double", "decimal", "boolean")
TIMESTAMP_COLUMNS = ["feature_timestamp", "event_timestamp", "prediction_timestamp", "created_timestamp"]


def numeric_feature_columns(frame: DataFrame) -> list[str]:
    """Numeric and boolean columns that are neither ids nor internal."""
    return [
        f.name
        for f in frame.schema.fields
        if f.dataType.simpleString().startswith(NUMERIC)
        and f.name not in NOT_FEATURES
        and not f.name.endswith("_id")
        and not f.name.startswith("__")
    ]


def recent_rows(frame: DataFrame, days: int) -> DataFrame:
    """Rows after the newest timestamp minus the given days; all rows where there is no timestamp column."""
    column = next((c for c in TIMESTAMP_COLUMNS if c in frame.columns), None)
    if column is None:
        return frame
    newest = frame.agg(F.max(column).alias("_newest"))
    bounded = frame.crossJoin(F.broadcast(newest))  # one row
    cutoff = F.col("_newest") - F.make_dt_interval(days=F.lit(days))
    return bounded.filter(F.col("_newest").isNull() | (F.col(column) > cutoff)).drop("_newest")
