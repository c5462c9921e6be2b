"""Small cases with known answers for the batch operators."""

import datetime as dt
import json

import numpy as np
import pytest
from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopflow.functions import arrays, dates, hashing, text
from shopflow.operators import clean, drift, experiments, features, labels, marts, online, quality, ranking, training, versioned
from shopflow.operators.quality import Check
from shopflow.plans.quantiles import quantiles
from shopflow.sources import cdc, files

UTC = dt.datetime
FEW = settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def one(frame):
    return frame.collect()[0]


# Change records


@pytest.mark.parametrize(
    "record,expected",
    [
        ({"payload": {"op": "d", "after": None, "before": {"event_id": "1"}}}, None),
        ({"payload": {"op": "t"}}, None),
        ({"payload": {"op": "c", "after": {"event_id": "7"}}}, "7"),
        ({"schema": {}, "payload": {"op": "c", "after": None}}, None),
        ({"event_id": "9"}, "9"),
    ],
)
def test_unwrap(spark, record, expected):
    frame = spark.createDataFrame([(json.dumps(record),)], "value string")
    found = [r["row"]["event_id"] for r in cdc.unwrap(frame).collect()]
    assert found == ([] if expected is None else [expected])


def test_normalize_defaults(spark):
    good = {"event_id": "e1", "user_id": "1", "product_id": "10", "event_type": "view", "event_timestamp": "2024-01-01T00:00:00Z", "price": "x", "price_bucket": "3"}
    empty = {**good, "event_type": ""}
    missing = {k: v for k, v in good.items() if k != "user_id"}
    frame = spark.createDataFrame([(json.dumps(r),) for r in (good, empty, missing)], "value string")
    out = cdc.normalize(frame).collect()
    assert len(out) == 1
    r = out[0]
    assert (r["user_id"], r["event_type_id"], r["category_id"], r["price"], r["price_bucket"]) == (1, 1, 0, 3.0, 3)
    assert r["event_timestamp"] == UTC(2024, 1, 1)


# Files


def test_sanitize_columns(spark):
    frame = spark.range(1).selectExpr("1 as id", "2 as other", "date'2024-01-01' as business_date").toDF("id", "ID", "business_date")
    assert files.sanitize_columns(frame).columns == ["id"]


def test_gated_read(spark, tmp_path):
    frame = spark.range(5)
    files.write_with_manifest(frame, str(tmp_path / "ok"), "id")
    assert files.gated_read(spark, str(tmp_path / "ok")).count() == 5
    files.write_with_manifest(frame.union(frame), str(tmp_path / "twice"), "id")
    with pytest.raises(ValueError, match="repeats"):
        files.gated_read(spark, str(tmp_path / "twice"))
    files.write_with_manifest(frame, str(tmp_path / "open"), "id", status="partial")
    with pytest.raises(ValueError, match="partial"):
        files.gated_read(spark, str(tmp_path / "open"))
    files.write_with_manifest(frame, str(tmp_path / "short"), "id")
    spark.range(4).write.mode("overwrite").parquet(str(tmp_path / "short" / "data"))
    with pytest.raises(ValueError, match="promises"):
        files.gated_read(spark, str(tmp_path / "short"))


def test_export_is_ordered_and_complete(spark, tmp_path):
    frame = spark.range(100).selectExpr("id", "100 - id as t", "if(id % 4 = 0, 'val', 'train') as split")
    files.export_jsonl(frame, str(tmp_path / "out"), "split", ["t", "id"])
    for split in ("train", "val"):
        lines = []
        for part in sorted((tmp_path / "out" / f"split={split}").glob("*.json")):
            lines += [json.loads(line)["t"] for line in part.read_text().splitlines()]
        assert lines == sorted(lines) and len(lines) == (25 if split == "val" else 75)


def test_pruning_reaches_the_scan(spark, shop, tmp_path):
    files.write_by_date(shop.behavior_events, str(tmp_path / "dated"), "event_timestamp")
    frame = spark.read.parquet(str(tmp_path / "dated")).filter("business_date = date'2024-01-05' and user_id = 3").select("event_id")
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(business_date" in plan and "EqualTo(user_id,3)" in plan and "price" not in plan


# Cleaning


def test_clean_events(spark):
    schema = "event_id string, event_timestamp string, ingestion_ts string, event_type string, schema_version int, payload_hash string, device_type string"
    data = [
        ("a", "2024-01-01 00:00:00", "2024-01-01 00:00:05", "view", 1, "h2", None),
        ("a", "2024-01-01 00:00:00", "2024-01-01 00:00:05", "view", 1, "h1", None),
        ("b", "broken", "2024-01-01 00:00:05", "tap", None, "h", "tv"),
        ("c", "2024-01-01 00:00:00", "2024-01-01 00:00:05", "cart", 3, "h", None),
    ]
    good, rejected = clean.conform(spark.createDataFrame(data, schema), clean.EVENTS)
    got = {r["event_id"]: r for r in good.collect()}
    assert set(got) == {"a", "b"} and got["a"]["payload_hash"] == "h1"
    assert (got["a"]["device_type"], got["a"]["campaign_id"], got["a"]["event_type_id"]) == ("unknown", "none", 1)
    assert got["b"]["event_timestamp"] is None and got["b"]["schema_version"] == 1 and got["b"]["event_type_id"] == 0
    assert one(rejected)["rejection_reason"] == "unsupported_schema_version"


def test_numeric_columns_and_recent_rows(spark):
    frame = spark.createDataFrame([(1, 2.0, True, "x", 5, UTC(2024, 1, d)) for d in range(1, 11)], "item_id int, a double, b boolean, c string, __d int, event_timestamp timestamp")
    assert clean.numeric_feature_columns(frame) == ["a", "b"]
    assert clean.recent_rows(frame, 7).count() == 7


def test_injected_duplicates_are_found_again(shop):
    noisy = clean.inject_problems(shop.behavior_events, 0.45, "2024-01-10")
    profile = one(quality.duplicate_profile(noisy, "event_id", "payload_hash"))
    assert profile["raw_rows"] - profile["distinct_ids"] == profile["extra_rows"] == profile["exact_duplicate_rows"] > 0


def test_clickstream_filter(spark):
    schema = "event_time string, event_type string, product_id int, user_id int, user_session string, price double, category_code string"
    ok = ("2024-01-01 00:00:00", "view", 1, 1, "s", 1.0, "c")
    bad = [(None, *ok[1:]), (ok[0], "tap", *ok[2:]), (*ok[:5], -1.0, "c"), (*ok[:6], None), ("never", *ok[1:])]
    assert clean.clean_clickstream(spark.createDataFrame([ok, (*ok[:5], None, "c"), *bad], schema)).count() == 2


# Checks


def test_checks(spark):
    frame = spark.createDataFrame([(1, "a"), (1, None), (2, "z")], "id int, kind string")
    checks = [Check("unique", ("id",)), Check("not_null", ("kind",)), Check("accepted_values", ("kind",), values=("a", "z")), Check("row_count", minimum=4), Check("required_columns", ("id", "gone"))]
    got = {r["check_name"]: (r["status"], r["observed"]) for r in quality.run_checks(frame, "t", checks).collect()}
    assert got == {
        "unique(id)": ("FAILED", "1"), "not_null(kind)": ("FAILED", "1"), "accepted_values(kind)": ("SUCCESS", "0"),
        "row_count()": ("FAILED", "3"), "required_columns(id,gone)": ("FAILED", "1"),
    }


@pytest.mark.parametrize("hours,status", [(26, "SUCCESS"), (40, "WARN"), (51, "FAILED")])
def test_freshness(spark, hours, status):
    frame = spark.createDataFrame([(UTC(2024, 1, 1),)], "at timestamp")
    run = (UTC(2024, 1, 1) + dt.timedelta(hours=hours)).isoformat(sep=" ")
    assert one(quality.run_checks(frame, "t", [Check("freshness", ("at",))], run))["status"] == status


def test_schema_conformance(spark):
    contract = T.StructType([T.StructField("id", T.LongType()), T.StructField("old", T.StringType())])
    got = {r["column_name"]: r["status"] for r in quality.schema_conformance(spark.range(3).withColumn("more", F.lit(1)), "t", contract, ("old",)).collect()}
    assert got == {"id": "ok", "old": "legacy_missing", "more": "unexpected"}


# Features


def events_of(spark, data):
    schema = "event_id string, user_id bigint, product_id bigint, event_type string, event_timestamp timestamp, category_id bigint, brand_id bigint, price_bucket int, cents int, request_id string, impression_id string"
    frame = spark.createDataFrame(data, schema)
    return frame.withColumn("price", (F.col("cents") / 100).cast("decimal(18,2)"))


def test_open_horizons(spark):
    events = events_of(spark, [
        ("1", 1, 9, "view", UTC(2024, 1, 1, 0, 0), 1, 1, 1, 500, None, None),
        ("2", 1, 9, "cart", UTC(2024, 1, 1, 1, 1), 2, 1, 1, 700, None, None),
    ])
    last = features.user_aggregate_features(events, exclusive=True).filter("event_id = '2'")
    r = one(last)
    assert (r["views_30m"], r["carts_30m"], r["distinct_categories_7d"], r["avg_viewed_price_7d"]) == (0, 1, 2, 5.0)
    i = one(features.item_features(events, None, exclusive=True).filter("event_id = '2'"))
    assert (i["views_1h"], i["views_24h"], i["carts_1h"]) == (0, 1, 1)


def test_closed_horizon_includes_its_edge(spark):
    events = events_of(spark, [
        ("1", 1, 9, "view", UTC(2024, 1, 1, 0, 0), 1, 1, 1, 500, None, None),
        ("2", 1, 9, "view", UTC(2024, 1, 1, 0, 30), 1, 1, 1, 500, None, None),
    ])
    for exclusive, views in ((False, 2), (True, 1)):
        assert one(features.user_aggregate_features(events, exclusive=exclusive).filter("event_id = '2'"))["views_30m"] == views


def test_label_takes_the_first_positive(spark):
    at = UTC(2024, 1, 1)
    shown = spark.createDataFrame(
        [("i1", "r", 1, 9, at, None, 1), ("i2", "r", 1, 9, at - dt.timedelta(days=2), "popular", 1), ("i3", "r", None, 9, at, None, 1)],
        "impression_id string, request_id string, user_id bigint, candidate_product_id bigint, impression_timestamp timestamp, candidate_source string, rank_position int",
    )
    events = events_of(spark, [
        ("0", 1, 9, "cart", at, 1, 1, 1, 1, None, None),
        ("1", 1, 9, "view", at + dt.timedelta(hours=1), 1, 1, 1, 1, None, None),
        ("2", 1, 9, "purchase", at + dt.timedelta(hours=24), 1, 1, 1, 1, None, None),
        ("3", 1, 9, "cart", at + dt.timedelta(hours=24), 1, 1, 1, 1, None, None),
        ("4", None, 9, "cart", at + dt.timedelta(hours=2), 1, 1, 1, 1, None, None),
    ])
    got = {r["impression_id"]: r for r in labels.ranking_labels(shown, events).collect()}
    assert (got["i1"]["label"], got["i1"]["positive_event_type"]) == (1, "cart")
    assert got["i2"]["label"] == 0 and got["i3"]["label"] == 0 and got["i3"]["candidate_source"] == "unknown"
    counts = {r["impression_id"]: r["positive_events"] for r in labels.positive_counts(shown, events).collect()}
    assert counts == {"i1": 2, "i2": 0, "i3": 0}


# Arrays and time


def test_array_functions(spark):
    row = spark.createDataFrame([([1, 2, 3], [5], '[1, null, "x", 7]', "none")], "a array<int>, b array<int>, t string, u string")
    r = one(row.select(
        arrays.last_n(F.col("a"), 2).alias("last"), arrays.last_n(F.col("a"), 9).alias("all"), arrays.pad_and_trim(F.col("b"), 3, F.lit(0)).alias("pad"),
        arrays.int_list(F.col("t")).alias("ints"), arrays.int_list(F.col("u")).alias("none"), arrays.modulo_ids(F.array(F.lit(-4), F.lit(12)), 10).alias("fold"),
    ))
    assert (r["last"], r["all"], r["pad"], r["ints"], r["none"], r["fold"]) == ([2, 3], [1, 2, 3], [0, 0, 5], [1, 7], [], [0, 2])


def test_recency_classes(spark):
    edges = [0, 299, 300, 1799, 1800, 7200, 21600, 86400, 259200, 604800, 1209600]
    frame = spark.createDataFrame([(e,) for e in edges], "s int")
    assert [r[0] for r in frame.select(arrays.coarse_recency(F.col("s"))).collect()] == [0, 0, 1, 1, 2, 3, 4, 5, 6, 7, 8]
    at = UTC(2024, 1, 2)
    stamps = F.array(*[F.lit(at - dt.timedelta(seconds=s)) for s in (0, 299, 300, 400 * 86400)])
    assert one(spark.range(1).select(arrays.recency_buckets(F.lit(at), stamps)))[0] == [1, 1, 2, 105120]


def test_drift_columns(spark):
    days = spark.createDataFrame([(dt.date(2024, 1, d),) for d in (1, 10, 15, 30)], "d date")
    got = [r[0] for r in days.select(dates.drift_factor(F.col("d"), "2024-01-10", 10, 3.0)).collect()]
    assert got == [1.0, 1.0, 2.0, 3.0]
    statuses = spark.createDataFrame([(0.01,), (0.07,), (0.12,), (0.15,)], "p double")
    assert [r[0] for r in statuses.select(dates.drift_status(F.col("p"), F.lit(False))).collect()] == ["stable", "detected", "strong", "alert"]
    assert one(statuses.select(dates.drift_status(F.col("p"), F.lit(True))))[0] == "baseline"


def test_text_functions(spark):
    frame = spark.createDataFrame([("  Điện thoại — Été n°1 ",)], "t string")
    assert one(frame.select(text.slug(F.col("t"))))[0] == "IEN-THOAI-ETE-N1"
    many = spark.createDataFrame([("One. Two!  Three…\nfour\n\n five?six",)], "t string")
    assert one(many.select(text.sentences(F.col("t"))))[0] == ["One.", "Two!", "Three…", "four", "five?six"]


def test_arms_are_sticky(spark):
    users = spark.range(1000).select("id", hashing.variant(F.col("id"), "e", 30).alias("v"), hashing.variant(F.col("id"), "e", 0).alias("none"), hashing.variant(F.col("id"), "e", 100).alias("all"))
    shares = one(users.agg(F.avg((F.col("v") == "candidate").cast("int")).alias("s"), F.max("none").alias("n"), F.min("all").alias("a")))
    assert 0.25 < shares["s"] < 0.35 and (shares["n"], shares["a"]) == ("control", "candidate")


# Training


def test_temporal_split(spark):
    frame = spark.range(5)
    got = [r["split"] for r in training.temporal_split(frame, ["id"], 0.6, 0.2).orderBy("id").collect()]
    assert got == ["train"] * 3 + ["val", "test"]


def test_group_split_keeps_groups_whole(spark):
    frame = spark.range(40).selectExpr("id", "id % 3 as user_id", "id div 10 as event_time")
    got = training.group_temporal_split(frame, "event_time", "user_id", 0.5, 0.25)
    groups = got.groupBy("event_time", "user_id").agg(F.count_distinct("split").alias("n"), F.max("split").alias("s")).collect()
    assert all(g["n"] == 1 for g in groups) and sum(g["s"] == "train" for g in groups) == 6 and sum(g["s"] == "val" for g in groups) == 3


def test_negatives_are_unseen_and_filled(spark):
    # User 2 has met every item, so nothing can be drawn for it; user 1 may draw what it has not met yet.
    start = UTC(2024, 1, 1)
    data, n = [], 0
    for user, items in ((1, [1, 2, 3, 4]), (2, [1, 2, 3, 4, 5, 6])):
        for step, item in enumerate(items):
            n += 1
            data.append((str(n), user, item, "purchase", start + dt.timedelta(hours=step), 1, 1, 1, 100, None, None))
    events = events_of(spark, data).withColumn("event_type_id", features.event_type_id())
    out = training.negative_samples(events, k=3, first_draws=2).collect()
    seen = {(u, i): h for u, items in ((1, [1, 2, 3, 4]), (2, [1, 2, 3, 4, 5, 6])) for h, i in enumerate(items)}
    by_event = {}
    for r in out:
        by_event.setdefault(r["positive_id"], []).append(r["product_id"])
        number = int(r["positive_id"])
        user, step = (1, number - 1) if number <= 4 else (2, number - 5)
        assert seen.get((user, r["product_id"]), 99) > step
    assert set(by_event) == {"3", "4", "7", "8", "9"} and all(len(v) == 3 for v in by_event.values())


def test_equal_count_buckets(spark):
    frame = spark.range(23).selectExpr("id", "cast(id % 7 as double) as price")
    got = {r["id"]: r["bucket"] for r in training.equal_count_buckets(frame, "price", ["id"], 5).collect()}
    order = sorted(range(23), key=lambda i: (i % 7, i))
    for r, i in enumerate(order, start=1):
        assert got[i] == max(int(np.ceil((r - 1) * 5 / 22)) - 1, 0)


def test_stratified_sample_trims_whole_users(shop):
    events = shop.behavior_events
    total = events.count()
    sample = training.stratified_sample(events, total // 3, {2: 0.5, 1: 0.3, 0: 0.2})
    kept = {r["user_id"]: r["n"] for r in sample.groupBy("user_id").agg(F.count(F.lit(1)).alias("n")).collect()}
    full = {r["user_id"]: r["n"] for r in events.groupBy("user_id").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert kept and all(full[u] == n for u, n in kept.items()) and sum(kept.values()) <= total // 3 * 1.25


# Versions


def sample(spark, data):
    schema = "impression_id string, target_item_id bigint, split string, source_updated_at timestamp"
    return spark.createDataFrame([(*r, UTC(2024, 1, 1)) for r in data], schema)


def test_delta(spark):
    old, new = sample(spark, [("moved", 11, "train"), ("deleted", 12, "train")]), sample(spark, [("new", 13, "train"), ("moved", 11, "val")])
    got = rows(versioned.delta(old, new, ["impression_id", "target_item_id"], "source_updated_at", "2024-01-02").select("impression_id", "split", "is_deleted"))
    assert got == [("deleted", "train", True), ("moved", "val", False), ("new", "train", False)]


def test_versions(spark, tmp_path):
    keys = ["impression_id", "target_item_id"]
    table = versioned.VersionedTable(spark, str(tmp_path / "t"), keys, "source_updated_at")
    assert table.read() is None
    a, b = sample(spark, [("x", 1, "train"), ("y", 2, "train")]), sample(spark, [("x", 1, "val"), ("z", 3, "train")])
    assert table.commit(a, "run-a", "2024-01-01")["upserts"] == 2
    second = table.commit(b, "run-b", "2024-01-02")
    assert (second["version"], second["deletes"], second["rows"]) == (2, 1, 2)
    again = table.commit(b, "run-b", "2024-01-03")
    assert again["repeated"] and again["upserts"] == 0
    assert rows(table.read(1).select(*keys, "split")) == [("x", 1, "train"), ("y", 2, "train")]
    assert rows(table.read().select(*keys, "split")) == [("x", 1, "val"), ("z", 3, "train")]
    table.savepoint(1)
    assert table.removable(keep=1) == []
    with pytest.raises(ValueError):
        table.read(7)


@pytest.mark.parametrize("data,message", [([], "empty"), ([(None, 1, "a")], "null"), ([("x", 1, "a"), ("x", 1, "b")], "repeat")])
def test_sample_keys(spark, data, message):
    with pytest.raises(ValueError, match=message):
        versioned.check_keys(sample(spark, data), ["impression_id", "target_item_id"])


# Drift


def psi_of(spark, expected, actual, closed, approximate=False):
    frame = lambda values: spark.createDataFrame([("f", float(v)) for v in values], "feature string, value double")
    return one(drift.psi(frame(expected), frame(actual), closed=closed, approximate=approximate))["psi"]


def reference_psi(expected, actual, closed, buckets=10):
    expected, actual = np.asarray(expected, float), np.asarray(actual, float)
    cuts = np.quantile(expected, [i / buckets for i in range(buckets + 1)])
    low, high = min(expected.min(), actual.min()), max(expected.max(), actual.max())
    if closed:
        edges = np.unique(cuts)
        if len(edges) < 3:
            if low == high:
                return 0.0
            edges = np.array([low, (low + high) / 2, high])
    else:
        inner = np.unique(cuts[1:-1])
        inner = inner[(inner > expected.min()) & (inner < expected.max())]
        if not len(inner):
            if low == high:
                return 0.0
            inner = np.array([(low + high) / 2])
        edges = np.concatenate([[-np.inf], inner, [np.inf]])
    e, a = np.histogram(expected, edges)[0], np.histogram(actual, edges)[0]
    p, q = np.maximum(e / max(e.sum(), 1), 1e-4), np.maximum(a / max(a.sum(), 1), 1e-4)
    return float(((q - p) * np.log(q / p)).sum())


def test_psi_known_cases(spark):
    assert psi_of(spark, [0, 0, 0, 1, 1, 2, 2, 3], [0, 0, 0, 1, 1, 2, 2, 3], False) == 0
    assert psi_of(spark, [0, 0, 0, 1, 1, 2, 2, 3], [5, 5, 6, 6, 7, 7], False) > 0.15
    assert psi_of(spark, [0, 0], [0, 0], False) == 0 and psi_of(spark, [0, 0], [1, 1], False) > 0
    assert psi_of(spark, [1, 1, 2, 2, 3, 3, 4, 4], [10, 10, 11, 11, 12, 12, 13, 13], True) > 0.15
    assert abs(psi_of(spark, list(range(200)), [v + 20 for v in range(200)], True, True) - reference_psi(range(200), [v + 20 for v in range(200)], True)) < 0.05


@FEW
@given(st.lists(st.integers(0, 12), min_size=3, max_size=40), st.lists(st.integers(0, 15), min_size=3, max_size=40), st.booleans())
def test_psi_matches_numpy(spark, expected, actual, closed):
    assert psi_of(spark, expected, actual, closed) == pytest.approx(reference_psi(expected, actual, closed), abs=1e-9)


@FEW
@given(st.lists(st.tuples(st.integers(0, 2), st.integers(-20, 20)), min_size=1, max_size=60))
def test_quantiles_match_numpy(spark, data):
    frame = spark.createDataFrame(data, "g int, v int")
    levels = [0.0, 0.2, 0.5, 0.95, 1.0]
    for r in quantiles(frame, ["g"], "v", levels).collect():
        values = [v for g, v in data if g == r["g"]]
        assert r["quantile"] == pytest.approx(np.quantile(values, r["probability"]))
    for r in quantiles(frame, ["g"], "v", levels, nearest_rank=True).collect():
        values = sorted(v for g, v in data if g == r["g"])
        assert r["quantile"] == values[max(int(np.ceil(r["probability"] * len(values))), 1) - 1]


def test_ninety_day_sum(spark):
    start = UTC(2024, 1, 1)
    events = spark.createDataFrame([(1, "purchase", start + dt.timedelta(days=d)) for d, n in ((0, 2), (10, 3), (99, 5)) for _ in range(n)], "user_id bigint, event_type string, event_timestamp timestamp")
    orders = spark.createDataFrame([], "user_id bigint, order_timestamp timestamp")
    users = spark.createDataFrame([(1, True), (2, False)], "user_id bigint, is_active boolean")
    daily = drift.user_daily_features(events, orders, users, "2024-01-01", 100)
    got = {(r["feature_date"] - dt.date(2024, 1, 1)).days: r["f_user_purchase_count_90d"] for r in daily.collect()}
    assert len(got) == 100 and [got[d] for d in (9, 10, 89, 90, 98, 99)] == [2, 5, 5, 3, 3, 8]


def test_drift_report(spark):
    rows_of = lambda shift: [(i, float(i % 10 + shift), i % 3) for i in range(60)]
    frame = lambda shift: spark.createDataFrame(rows_of(shift), "item_id bigint, views_1h double, carts int")
    report = drift.drift_report(frame(0), frame(99), "item_features")
    assert {r["feature"] for r in report.collect()} == {"views_1h", "carts"}
    assert [r["feature"] for r in drift.failed_features(report).collect()] == ["views_1h"]
    assert all(r["passed"] and r["reference_rows"] == 60 for r in drift.drift_report(None, frame(5), "item_features").collect())


# Ranking


def brute_auc(data):
    pos, neg = [s for s, y in data if y], [s for s, y in data if not y]
    if not pos or not neg:
        return 0.0
    return sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))


@FEW
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 5), st.integers(0, 1)), min_size=1, max_size=60))
def test_auc_matches_pairs(spark, data):
    frame = spark.createDataFrame([(str(i), g, s / 10, y) for i, (g, s, y) in enumerate(data)], "id string, g int, score double, label int")
    assert one(ranking.auc(frame))["auc"] == pytest.approx(brute_auc([(s, y) for _, s, y in data]))
    for r in ranking.group_auc(frame, ["g"]).collect():
        assert r["auc"] == pytest.approx(brute_auc([(s, y) for g, s, y in data if g == r["g"]]))


def test_ranking_metrics(spark):
    frame = spark.createDataFrame([("a", 1, 0.9, 0), ("b", 1, 0.8, 1), ("c", 1, 0.7, 1), ("d", 2, 0.5, 0)], "id string, g int, score double, label int")
    got = {r["g"]: r for r in ranking.group_metrics(frame, ["g"], "id", [2]).collect()}
    dcg, ideal = 1 / np.log2(3), 1 + 1 / np.log2(3)
    assert got[1]["ndcg_2"] == pytest.approx(dcg / ideal) and got[1]["mrr_2"] == 0.5 and got[1]["hitrate_2"] == 1
    assert (got[2]["ndcg_2"], got[2]["mrr_2"], got[2]["hitrate_2"]) == (0, 0, 0)
    report = one(ranking.ranking_report(frame, ["g"], "id", [2]))
    assert report["num_groups"] == 2 and report["valid_auc_groups"] == 1 and report["hitrate_2"] == 0.5


def test_ranking_group_key(spark):
    frame = spark.createDataFrame([("r1", "i1", 1, 5), ("r1", "i2", 1, 5), ("", "i3", 1, 5), (None, None, 1, 5)], "r string, i string, u int, t int")
    assert [r[0] for r in frame.select(ranking.group_key(*[F.col(c) for c in "riut"])).collect()] == ["r1", "r1", "i3", "1:5"]


def test_gate(spark):
    def log(n, errors, latency, quality):
        return [("candidate", 1 if i < errors else 0, latency, quality) for i in range(n)] + [("control", 0, 1.0, 0.8) for _ in range(n)]

    def decide(data):
        frame = spark.createDataFrame([("e", *r) for r in data], "experiment string, variant string, is_error int, latency_seconds double, confidence double")
        r = one(experiments.experiment_gate(frame, "experiment"))
        return r["decision"], r["reasons"]

    assert decide(log(99, 0, 1.0, 0.8)) == ("hold", "samples")
    assert decide(log(100, 0, 1.5, 0.77)) == ("promote", "")
    assert decide(log(100, 3, 1.6, 0.7)) == ("rollback", "error,latency,quality")


# Marts and online views


def test_funnel_rates_guard_zero(spark):
    frame = spark.createDataFrame([(0, 3), (2, 1)], "a int, b int")
    assert [r[0] for r in frame.select(marts.ratio(F.col("b"), F.col("a"))).collect()] == [None, 0.5]


def test_request_context(spark):
    frame = spark.createDataFrame(
        [("1", '{"experiment_id":"e","variant":"v"}'), ("2", "{broken"), ("3", '{"experiment_id":""}'), ("4", "{}")], "request_id string, request_context string"
    ).selectExpr("request_id", "1 as user_id", "'s' as session_id", "timestamp'2024-01-01' as request_timestamp", "'h' as surface", "request_context")
    got = rows(marts.stg_requests(frame).select("request_id", "experiment_id", "variant"))
    assert got == [("1", "e", "v"), ("2", None, None), ("3", None, None), ("4", None, None)]


def test_newest_wins_and_ties_overwrite(spark):
    schema = "user_id bigint, updated_at timestamp, payload string"
    at = UTC(2024, 1, 2)
    current = online.newest_wins(None, spark.createDataFrame([(1, at, "old"), (2, at, "keep")], schema), "user_id", "item")
    updates = spark.createDataFrame([(1, at, "new"), (2, at - dt.timedelta(days=1), "stale")], schema)
    got = {r["user_id"]: (r["payload"], r["expires_at"] - at) for r in online.newest_wins(current, updates, "user_id", "item").collect()}
    assert got == {1: ("new", dt.timedelta(days=7)), 2: ("keep", dt.timedelta(days=7))}


def test_materialization_mode():
    sure, end = lambda mode: True, UTC(2024, 1, 5)
    assert online.materialization_mode([None, UTC(2024, 1, 4)], end, sure) == ("incremental", False)
    assert online.materialization_mode([UTC(2024, 1, 6)], end, sure) == ("full_watermark_recovery", True)
    assert online.materialization_mode([end], end, sure) == ("noop", False)
    recovers = lambda mode: mode == "full_online_store_recovery"
    assert online.materialization_mode([end], end, recovers) == ("full_online_store_recovery", True)
    with pytest.raises(RuntimeError):
        online.materialization_mode([end], end, lambda mode: False)
    with pytest.raises(ValueError):
        online.materialization_mode([], end, sure)


def test_json_payload(spark):
    frame = spark.createDataFrame([(1.5, float("nan"), float("inf"), None)], "b double, a double, d double, c string")
    assert one(frame.select(online.json_payload({c: F.col(c) for c in "badc"})))[0] == '{"a":null,"b":1.5,"c":null,"d":null}'


def test_pools_and_fallback(spark):
    at = UTC(2024, 1, 1)
    items = spark.createDataFrame(
        [(p, at, str(p), c, v, 0, 0, float(v)) for p, c, v in ((1, 7, 5), (2, 7, 9), (3, 8, 1))] + [(1, at - dt.timedelta(hours=1), "0", 7, 99, 0, 0, 99.0)],
        "product_id bigint, feature_timestamp timestamp, event_id string, category_id bigint, views_1h int, carts_1h int, purchases_24h int, popularity_score double",
    )
    pools = online.candidate_pools(online.pool_updates(items), 2)
    best = {(r["pool_key"], r["rank"]): r["product_id"] for r in pools.collect()}
    assert (best["candidate:popular:global", 1], best["candidate:popular:global", 2]) == (2, 1)
    touched = spark.createDataFrame([(10, 8)], "user_id bigint, category_id bigint")
    users = spark.createDataFrame([(10,), (11,)], "user_id bigint")
    got = rows(online.candidates(users, online.user_pools(pools, touched, 2), pools, 2).select("user_id", "position", "product_id"))
    assert got == [(10, 1, 3), (11, 1, 2), (11, 2, 1)]


def test_model_schema_name():
    assert [marts.schema_name(c, "dev") for c in (None, "", " core ")] == ["dev", "dev", "core"]


def test_catalog_table_is_created_and_appended(spark):
    spark.sql("drop table if exists shopflow_ids")
    for mode in ("append", "append", "overwrite"):
        files.save_catalog_table(spark.range(3), "shopflow_ids", mode)
    assert files.read_catalog_table(spark, "shopflow_ids").count() == 3
    files.save_catalog_table(spark.range(3), "shopflow_ids", "append")
    assert files.read_catalog_table(spark, "shopflow_ids").count() == 6
    spark.sql("drop table shopflow_ids")


def test_bronze_ingest_counts(spark, tmp_path):
    written = files.ingest({"a": spark.range(4), "b": spark.range(7)}, str(tmp_path), "run", "2024-01-01")
    assert written == {"a": 4, "b": 7}
    back = spark.read.parquet(str(tmp_path / "bronze_b"))
    assert back.columns == ["id", "source_run_id", "lakehouse_ingestion_ts"] and back.count() == 7


def test_name_uuids_equal_the_standard(spark):
    import uuid

    names = ["https://shop.example/events/1", "", "é 你好", "x" * 1000] + [f"k{i}" for i in range(200)]
    frame = spark.createDataFrame([(n,) for n in names] + [(None,)], "name string")
    got = {r["name"]: r["id"] for r in frame.select("name", hashing.name_uuid(F.col("name")).alias("id")).collect()}
    assert got == {**{n: str(uuid.uuid5(uuid.NAMESPACE_URL, n)) for n in names}, None: None}


def test_trailing_sketches_stay_near_the_exact_count(spark):
    events = spark.range(60_000).select(
        (F.col("id") % 2).alias("k"), F.timestamp_seconds(F.lit(1_704_067_200) + F.col("id") % 12 * 86400).alias("at"), (F.col("id") % 20_011).alias("v")
    )
    got = {(r["k"], str(r["day"])): r["approximate"] for r in features.trailing_distinct_sketches(events, ["k"], "at", "v", days=3).collect()}
    rows_ = events.select("k", F.to_date("at").alias("day"), "v").collect()
    assert len(got) == len({(r["k"], r["day"]) for r in rows_})
    for (k, day), estimate in got.items():
        exact = len({r["v"] for r in rows_ if r["k"] == k and 0 <= (dt.date.fromisoformat(day) - r["day"]).days < 3})
        assert abs(estimate - exact) <= 0.15 * exact


def test_daily_sums_reach_back_before_the_period(spark):
    from shopflow.operators import drift

    at = "user_id long, event_type string, event_timestamp string"
    days = [(1, "purchase", "2024-01-01"), (1, "view", "2024-01-05"), (1, "view", "2024-01-09"), (2, "view", "2024-01-09"), (1, "view", "2024-01-20")]
    events = spark.createDataFrame(days, at).withColumn("event_timestamp", F.col("event_timestamp").cast("timestamp"))
    orders = spark.createDataFrame([(1, "2024-01-08")], "user_id long, order_timestamp string").withColumn("order_timestamp", F.col("order_timestamp").cast("timestamp"))
    users = spark.createDataFrame([(1, True), (2, False), (3, True)], "user_id long, is_active boolean")
    got = drift.user_daily_features(events, orders, users, "2024-01-10", 3, window=10).collect()
    found = {(r.user_id, str(r.feature_date)[8:]): (r.f_user_interaction_count_90d, r.f_user_purchase_count_90d, r.f_user_total_orders_90d) for r in got}
    assert found == {
        (1, "10"): (3, 1, 1), (1, "11"): (2, 0, 1), (1, "12"): (2, 0, 1), (3, "10"): (0, 0, 0), (3, "11"): (0, 0, 0), (3, "12"): (0, 0, 0),
    }


def test_rows_of_the_later_run_count(spark):
    when = lambda frame, *names: frame.withColumns({n: F.col(n).cast("timestamp") for n in names})
    asked = when(spark.createDataFrame([("i", 1, 5, "2024-01-02")], "impression_id string, user_id int, candidate_product_id int, prediction_timestamp string"), "prediction_timestamp")
    kind = "event_id string, feature_timestamp string, created_timestamp string, n int"
    runs = [("z", "2024-01-01", "2024-03-01", 1), ("a", "2024-01-01", "2024-03-02", 2), ("b", "2024-01-01", "2024-03-02", 3)]
    users = when(spark.createDataFrame([(1, *r) for r in runs], f"user_id int, {kind}"), "feature_timestamp", "created_timestamp")
    items = when(spark.createDataFrame([(5, *r) for r in runs[:2]], f"product_id int, {kind}"), "feature_timestamp", "created_timestamp")
    got = labels.join_feature_views(asked, users, users.drop("created_timestamp"), items).first()
    assert (got.seq_n, got.agg_n, got.item_n) == (3, 1, 2)
