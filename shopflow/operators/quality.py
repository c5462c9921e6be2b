"""Profiles, integrity checks and declarative data checks."""

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopflow.plans.hot_keys import top_k
from shopflow.plans.storage import materialize


def duplicate_profile(frame: DataFrame, identity: str, digest: str) -> DataFrame:
    """Raw rows, distinct ids, extra rows and exact copies. Copies collapse map-side in the first step."""
    pairs = frame.groupBy(identity, digest).agg(F.count(F.lit(1)).alias("n"))
    ids = pairs.groupBy(identity).agg(F.sum("n").alias("n"), F.sum(F.col("n") - 1).alias("exact"))
    return ids.agg(
        F.sum("n").alias("raw_rows"),
        F.count(F.lit(1)).alias("distinct_ids"),
        F.sum(F.col("n") - 1).alias("extra_rows"),
        F.sum("exact").alias("exact_duplicate_rows"),
    )


def conflicting_ids(frame: DataFrame, identity: str, digest: str) -> DataFrame:
    """Ids that occur with more than one payload."""
    pairs = frame.groupBy(identity, digest).agg(F.count(F.lit(1)).alias("n"))
    return (
        pairs.groupBy(identity)
        .agg(F.count(F.lit(1)).alias("payloads"), F.sum("n").alias("rows"))
        .filter(F.col("payloads") > 1)
    )


def cardinality_profile(frame: DataFrame, columns: list[str], rsd: float | None = None) -> DataFrame:
    """Distinct values and distinct ratio per column; rsd switches to the approximate count."""
    count = (lambda c: F.approx_count_distinct(c, rsd)) if rsd else F.count_distinct
    facts = frame.agg(F.count(F.lit(1)).alias("rows"), *[count(F.col(c)).alias(c) for c in columns])
    return facts.unpivot(["rows"], columns, "column_name", "distinct_values").select(
        "column_name", "rows", "distinct_values", (F.col("distinct_values") / F.col("rows")).alias("distinct_ratio")
    )


def top_values(frame: DataFrame, columns: list[str], k: int = 5) -> DataFrame:
    """Most frequent values per column with their share; ties by value."""
    cells = frame.select(*[F.col(c).cast("string").alias(c) for c in columns]).unpivot([], columns, "column_name", "value")
    counts = cells.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("rows"))
    totals = counts.groupBy("column_name").agg(F.sum("rows").alias("_total"))
    best = top_k(counts, ["column_name"], [F.desc("rows"), F.asc("value")], k)
    return best.join(totals, "column_name").select(
        "column_name", "value", "rows", (F.lit(100.0) * F.col("rows") / F.col("_total")).alias("percent"), "rank"
    )


def schema_evolution(frame: DataFrame, phase: Column, columns: list[str]) -> DataFrame:
    """Schema versions and null share of optional columns per phase."""
    versions = F.array_join(F.sort_array(F.collect_set("schema_version")).cast("array<string>"), ",")
    nulls = [F.avg(F.col(c).isNull().cast("int")).alias(f"{c}_null_rate") for c in columns]
    return frame.groupBy(phase.alias("phase")).agg(F.count(F.lit(1)).alias("rows"), versions.alias("versions"), *nulls)


def order_totals(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Orders without items or whose totals differ from their items, compared as exact decimals."""
    sums = items.groupBy("order_id").agg(
        F.sum("gross").alias("_gross"), F.sum("discount_amount").alias("_discount"), F.sum("line_amount").alias("_net")
    )
    joined = orders.join(sums, "order_id", "left")
    differs = (
        (F.col("gross_amount") != F.col("_gross"))
        | (F.col("discount_amount") != F.col("_discount"))
        | (F.col("net_amount") != F.col("_net"))
    )
    problem = F.when(F.col("_net").isNull(), "no_items").when(differs, "totals_differ")
    return joined.select("order_id", "net_amount", F.col("_net").alias("item_net"), problem.alias("problem")).filter(
        F.col("problem").isNotNull()
    )


@dataclass(frozen=True)
class Check:
    """One data check. columns are its subject; values, minimum or schema refine it."""

    kind: str  # not_null, unique, accepted_values, row_count, required_columns, freshness
    columns: tuple[str, ...] = ()
    values: tuple = ()
    minimum: int = 1
    warn_hours: int = 26
    error_hours: int = 50

    @property
    def name(self) -> str:
        return f"{self.kind}({','.join(self.columns)})"


def run_checks(frame: DataFrame, table: str, checks: list[Check], run_ts: str | None = None) -> DataFrame:
    """One row per check with status, expected and observed.

    All checks but uniqueness share one aggregate; each uniqueness check counts repeated keys, which
    combine map-side.
    """
    spark = frame.sparkSession
    measures, uniques, reports = [], [], []
    for index, check in enumerate(checks):
        cell, missing = f"m{index}", [c for c in check.columns if c not in frame.columns]
        if check.kind == "required_columns" or missing:
            status = "FAILED" if missing else "SUCCESS"
            reports.append((check.name, status, "0", str(len(missing))))
        elif check.kind == "not_null":
            empty = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in check.columns])
            measures.append((check, F.coalesce(F.sum(empty.cast("bigint")), F.lit(0)).alias(cell), cell))
        elif check.kind == "accepted_values":
            wrong = ~F.col(check.columns[0]).isin(*check.values)
            measures.append((check, F.coalesce(F.sum(wrong.cast("bigint")), F.lit(0)).alias(cell), cell))
        elif check.kind == "row_count":
            measures.append((check, F.count(F.lit(1)).alias(cell), cell))
        elif check.kind == "freshness":
            age = (F.unix_seconds(F.lit(run_ts).cast("timestamp")) - F.unix_seconds(F.max(check.columns[0]))) / 3600.0
            measures.append((check, age.alias(cell), cell))
        elif check.kind == "unique":
            uniques.append(check)
        else:
            raise ValueError(f"unknown check {check.kind}")

    def line(name: str, status: Column, expected: str, observed: Column) -> Column:
        return F.struct(
            F.lit(table).alias("table_name"), F.lit(name).alias("check_name"), status.alias("status"),
            F.lit(expected).alias("expected"), observed.cast("string").alias("observed"),
        )

    out = []
    if measures:
        lines = []
        for check, _, cell in measures:
            seen = F.col(cell)
            if check.kind == "row_count":
                lines.append(line(check.name, F.when(seen >= check.minimum, "SUCCESS").otherwise("FAILED"), f">={check.minimum}", seen))
            elif check.kind == "freshness":
                status = F.when(seen <= check.warn_hours, "SUCCESS").when(seen <= check.error_hours, "WARN").otherwise("FAILED")
                lines.append(line(check.name, status, f"<={check.warn_hours}h", F.round(seen, 2)))
            else:
                lines.append(line(check.name, F.when(seen == 0, "SUCCESS").otherwise("FAILED"), "0", seen))
        out.append(frame.agg(*[m for _, m, _ in measures]).select(F.inline(F.array(*lines))))
    for check in uniques:
        repeated = frame.groupBy(*check.columns).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > 1)
        found = repeated.agg(F.count(F.lit(1)).alias("_keys"))
        status = F.when(F.col("_keys") == 0, "SUCCESS").otherwise("FAILED")
        out.append(found.select(F.inline(F.array(line(check.name, status, "0", F.col("_keys"))))))
    if reports:
        schema = "table_name string, check_name string, status string, expected string, observed string"
        out.append(spark.createDataFrame([(table, *r) for r in reports], schema))
    return reduce(DataFrame.unionByName, out)


def key_profile(frame: DataFrame, table: str, keys: list[str]) -> DataFrame:
    """Rows, rows with a null key and surplus rows of repeated keys, in one pass over combined keys."""
    empty = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    per_key = frame.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(
        F.sum("n").alias("row_count"),
        F.coalesce(F.sum(F.when(empty, F.col("n"))), F.lit(0)).alias("null_key_rows"),
        F.coalesce(F.sum(F.when(~empty, F.col("n") - 1)), F.lit(0)).alias("duplicate_key_rows"),
    ).select(F.lit(table).alias("table_name"), "*")


def schema_conformance(frame: DataFrame, table: str, contract: T.StructType, legacy: tuple[str, ...] = ()) -> DataFrame:
    """Contract columns with what the table has; legacy columns may be missing. Adds the row count."""
    actual = {f.name: f.dataType.simpleString() for f in frame.schema.fields}
    report = []
    for f in contract.fields:
        have = actual.get(f.name)
        status = "ok" if have == f.dataType.simpleString() else ("legacy_missing" if have is None and f.name in legacy else "mismatch")
        report.append((table, f.name, f.dataType.simpleString(), have, status))
    report += [(table, name, None, kind, "unexpected") for name, kind in actual.items() if name not in contract.fieldNames()]
    schema = "table_name string, column_name string, expected_type string, actual_type string, status string"
    lines = frame.sparkSession.createDataFrame(report, schema)
    return lines.crossJoin(frame.agg(F.count(F.lit(1)).alias("row_count")))  # one row


def _violations(name: str, bad: DataFrame) -> DataFrame:
    return bad.agg(F.count(F.lit(1)).alias("violations")).select(F.lit(name).alias("check_name"), "violations")


def _tallies(frame: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Violations of several rules in one pass over the rows."""
    counted = frame.agg(*[F.count_if(bad).alias(name) for name, bad in rules.items()])
    return counted.unpivot([], list(rules), "check_name", "violations")


def integrity_report(tables: dict[str, DataFrame]) -> DataFrame:
    """Missing parents and wrong linkage across the shop tables, one count per rule.

    The tables that several rules read are stored once, cut to the columns the rules need.
    """
    users, products, sessions = tables["users"], tables["products"], tables["sessions"]
    requests = tables["requests"]
    impressions = materialize(
        tables["impressions"].select("impression_id", "request_id", "user_id", "session_id", "candidate_product_id"), "impressions"
    )
    events = materialize(
        tables["events"].select(
            "impression_id", "request_id", "session_id", "user_id", "product_id", "category_id", "brand_id", "event_timestamp", "created_ts"
        ),
        "events",
    )
    orders, items = tables["orders"], tables["order_items"]

    def orphans(child: DataFrame, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
        return child.join(parent.select(F.col(parent_key).alias(key)), key, "left_anti")

    linked = impressions.alias("c").join(
        requests.select("request_id", F.col("user_id").alias("p_user"), F.col("session_id").alias("p_session")), "request_id", "left"
    )
    wrong_request = ~(
        F.col("p_user").eqNullSafe(F.col("user_id")) & F.col("p_session").eqNullSafe(F.col("session_id"))
    )
    shown = events.filter(F.col("impression_id").isNotNull()).join(
        impressions.select(
            "impression_id", F.col("request_id").alias("p_request"), F.col("user_id").alias("p_user"),
            F.col("candidate_product_id").alias("p_product"),
        ),
        "impression_id",
        "left",
    )
    wrong_impression = ~(
        F.col("p_request").eqNullSafe(F.col("request_id"))
        & F.col("p_user").eqNullSafe(F.col("user_id"))
        & F.col("p_product").eqNullSafe(F.col("product_id"))
    )
    described = events.join(
        products.select("product_id", F.col("category_id").alias("p_category"), F.col("brand_id").alias("p_brand"), F.lit(True).alias("p_known")),
        "product_id",
        "left",
    )
    of_products = {
        "event_product_missing": F.col("p_known").isNull(),
        "event_product_metadata": (F.col("p_category") != F.col("category_id")) | (F.col("p_brand") != F.col("brand_id")),
    }
    of_rows = {
        "event_created_early": F.col("created_ts") < F.col("event_timestamp"),
        "event_id_not_positive": F.least("user_id", "product_id", "category_id", "brand_id") <= 0,
    }
    inactive = sessions.join(users.filter(~F.col("is_active")).select("user_id"), "user_id", "left_semi")
    parts = [
        _violations("session_user_missing", orphans(sessions, "user_id", users, "user_id")),
        _violations("session_user_inactive", inactive),
        _tallies(described, of_products),
        _tallies(events, of_rows),
        _violations("event_session_missing", orphans(events, "session_id", sessions, "session_id")),
        _violations("impression_request_linkage", linked.filter(wrong_request)),
        _violations("event_impression_linkage", shown.filter(wrong_impression)),
        _violations("item_order_missing", orphans(items, "order_id", orders, "order_id")),
        _violations("item_product_missing", orphans(items, "product_id", products, "product_id")),
        _violations("order_totals", order_totals(orders, items)),
    ]
    return reduce(DataFrame.unionByName, parts)


def set_difference(expected: DataFrame, actual: DataFrame, key: str) -> DataFrame:
    """Ids on one side only, with the side."""
    a, b = expected.select(key).distinct(), actual.select(key).distinct()
    return (
        a.join(b, key, "left_anti").withColumn("side", F.lit("missing"))
        .unionByName(b.join(a, key, "left_anti").withColumn("side", F.lit("unexpected")))
    )
