"""The hot-key routes give the same rows as the ordinary ones, and as brute force."""

import datetime as dt
import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from shopflow.operators import asof, features, labels, rolling
from shopflow.plans import hot_keys, joins, ordering

START = dt.datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of all rows belongs to user 1 and product 1; some keys are null and some times tie."""
    rng = random.Random(7)
    out = []
    for n in range(900):
        hot = n % 3 == 0
        user = 1 if hot else rng.choice([None, 2, 3, 4, 5, 6, 7])
        out.append(
            (
                str(n).zfill(4),
                START + dt.timedelta(seconds=rng.randrange(0, 12 * 86400, 600), microseconds=rng.choice([0, 400000])),
                user,
                1 if hot else rng.randrange(1, 9),
                rng.choice(["view", "cart", "purchase", "search"]),
                rng.randrange(0, 6),
                rng.randrange(0, 4),
                rng.randrange(1, 5),
                rng.randrange(1, 500),
                None if n % 7 else "req",
                None,
            )
        )
    schema = (
        "event_id string, event_timestamp timestamp, user_id bigint, product_id bigint, event_type string,"
        " category_id bigint, brand_id bigint, price_bucket int, cents int, request_id string, impression_id string"
    )
    frame = spark.createDataFrame(out, schema)
    return frame.withColumn("price", (F.col("cents") / 100).cast("decimal(18,2)")).drop("cents").cache()


def trailing(data, r, key, seconds, exclusive=False):
    def tick(o):
        past = o["event_timestamp"] - START
        return past // dt.timedelta(microseconds=1) if exclusive else past // dt.timedelta(seconds=1)

    width = seconds * 1_000_000 - 1 if exclusive else seconds
    return [o for o in data if o[key] == r[key] and 0 <= tick(r) - tick(o) <= width]


@pytest.mark.parametrize("exclusive", [False, True])
def test_user_aggregates_brute_force(skewed, exclusive):
    data = skewed.collect()
    got = {r["event_id"]: r for r in features.user_aggregate_features(skewed, exclusive=exclusive).collect()}
    assert len(got) == len(data)
    for r in data:
        week, half_hour = (trailing(data, r, "user_id", s, exclusive) for s in (7 * 86400, 1800))
        mine = got[r["event_id"]]
        assert mine["views_30m"] == sum(o["event_type"] == "view" for o in half_hour)
        assert mine["distinct_categories_7d"] == len({o["category_id"] for o in week})


def test_item_features_brute_force(skewed):
    data = skewed.collect()
    for r in features.item_features(skewed, None).collect():
        (event,) = [o for o in data if o["event_id"] == r["event_id"]]
        day = trailing(data, event, "product_id", 86400)
        assert (r["views_24h"], r["carts_24h"]) == tuple(sum(o["event_type"] == t for o in day) for t in ("view", "cart"))


@pytest.mark.parametrize("rows_per_task", [1_000_000, 1000, 2])
def test_sums_of_nulls_and_large_keys(spark, rows_per_task):
    """A key of 25,000 rows, one of 3 and null keys, whole or split; a sum over nulls only is null, a distinct count then 0."""
    events = spark.range(25_000).select(
        F.when(F.col("id") < 3, F.lit(2)).when(F.col("id") < 6, F.lit(None)).otherwise(1).alias("k"),
        F.col("id"),
        F.timestamp_seconds(F.col("id") * 10).alias("t"),
        F.when(F.col("id") % 5000 >= 100, F.lit(None)).otherwise(F.col("id") % 7).cast("decimal(10,2)").alias("v"),
        F.when(F.col("id") % 5000 >= 100, F.lit(None)).otherwise(F.col("id") % 900).alias("c"),
    )
    got = {r.id: r for r in rolling.rolling(events, ["k"], "t", {"s": (F.col("v"), 300), "n": (F.lit(1), 300)}, {"d": ("c", 300)}, rows_per_task=rows_per_task).collect()}
    assert len(got) == 25_000
    data = events.collect()
    for i in [0, 2, 3, 5, 6, 40, 99, 105, 129, 130, 131, 4999, 5000, 5031, 12_345, 20_050, 24_999]:
        near = [o for o in data[max(0, i - 30) : i + 1] if o.k == data[i].k]
        values = [o.v for o in near if o.v is not None]
        assert got[i].n == len(near) and got[i].d == len(set(o.c for o in near) - {None})
        assert got[i].s == (sum(values) if values else None)


@pytest.mark.parametrize("exclusive", [False, True])
def test_rolling_routes_agree(skewed, exclusive):
    """Growing frames over one order, and points over range partitions, in values and types."""
    flag = lambda kind: F.when(F.col("event_type") == kind, 1)
    args = ({"v": (flag("view"), 1800), "w": (flag("view"), 7 * 86400), "c": (F.col("price").cast("decimal(12,2)"), 86400)}, {"d": ("category_id", 7 * 86400), "e": ("product_id", 86400)})
    made = [rolling.rolling(skewed, ["user_id"], "event_timestamp", *args, exclusive=exclusive, rows_per_task=n) for n in (10**6, 60, 1)]
    assert made[0].schema.simpleString() == made[1].select(made[0].columns).schema.simpleString()
    assert rows(made[0]) == rows(made[1].select(made[0].columns)) == rows(made[2].select(made[0].columns))


@pytest.mark.parametrize("length", [1, 5, 50])
def test_sequences_split(skewed, length):
    whole = features.user_sequence_features(skewed, length)
    split = features.user_sequence_features(skewed, length, rows_per_task=10)
    assert rows(whole) == rows(split)


def test_prior_history_split(skewed):
    args = (skewed, ["user_id"], "event_timestamp", "event_id", F.col("event_id"), 4)
    whole = rolling.trailing_rows(*args, include_current=False)
    split = rolling.trailing_rows(*args, include_current=False, rows_per_task=7)
    assert rows(whole.select("event_id", "history")) == rows(split.select("event_id", "history"))


@pytest.mark.parametrize("forward,equal", [(False, True), (False, False), (True, False)])
def test_asof_split_and_brute_force(spark, skewed, forward, equal):
    left = skewed.filter(F.col("event_type") == "view").select(F.col("event_id").alias("id"), "user_id", "event_timestamp")
    view = asof.FeatureView(
        skewed.filter(F.col("event_type") != "view").select("user_id", "event_id", "event_timestamp"),
        "f",
        "event_timestamp",
        "event_id",
    )
    options = dict(forward=forward, allow_equal=equal)
    whole = asof.asof_join(left, "event_timestamp", {"user_id": "user_id"}, [view], **options)
    split = asof.asof_join(left, "event_timestamp", {"user_id": "user_id"}, [view], rows_per_task=11, **options)
    assert rows(whole) == rows(split)
    data = skewed.collect()
    for r in split.collect():
        near = [
            o for o in data
            if o["event_type"] != "view" and r["user_id"] is not None and o["user_id"] == r["user_id"]
            and (
                (o["event_timestamp"] > r["event_timestamp"]) if forward
                else (o["event_timestamp"] < r["event_timestamp"] or (equal and o["event_timestamp"] == r["event_timestamp"]))
            )
        ]
        best = None
        if near:
            pick = min if forward else max
            best = pick(near, key=lambda o: (o["event_timestamp"], o["event_id"]))["event_id"]
        assert r["f_event_id"] == best


def test_labels_and_counts_split(skewed):
    shown = skewed.select(
        F.concat(F.lit("i"), "event_id").alias("impression_id"), "request_id", "user_id",
        F.col("product_id").alias("candidate_product_id"), F.col("event_timestamp").alias("impression_timestamp"),
        F.lit(None).cast("string").alias("candidate_source"), F.lit(1).alias("rank_position"),
    )
    whole = labels.ranking_labels(shown, skewed)
    split = labels.ranking_labels(shown, skewed, rows_per_task=9)
    assert rows(whole) == rows(split)
    counts = {r["impression_id"]: r["positive_events"] for r in labels.positive_counts(shown, skewed).collect()}
    assert len(counts) == shown.count()
    assert all((counts[r["impression_id"]] > 0) == (r["label"] == 1) for r in split.collect())


def test_interval_counts_split(skewed):
    left = skewed.select("event_id", "user_id", "event_timestamp")
    args = (left, "event_id", "event_timestamp", skewed, "event_timestamp", {"user_id": "user_id"}, 86400)
    assert rows(asof.interval_counts(*args)) == rows(asof.interval_counts(*args, rows_per_task=8))


def test_salted_join(spark, skewed):
    right = spark.createDataFrame([(1, "a"), (2, "b"), (9, "c")], "user_id bigint, name string")
    left = skewed.select("event_id", "user_id")
    for how in ("left", "inner", "left_semi", "left_anti"):
        assert rows(left.join(right, "user_id", how)) == rows(joins.salted_join(left, right, ["user_id"], how, 10))


def test_global_order_helpers(spark, skewed):
    numbered = ordering.with_row_number(skewed.select("event_id", "user_id"), "user_id", "event_id").collect()
    expect = sorted(numbered, key=lambda r: (r["user_id"] is not None, r["user_id"] or 0, r["event_id"]))
    assert [r["row_number"] for r in expect] == list(range(1, len(expect) + 1))
    running = ordering.with_running(
        skewed.select("event_id", "price_bucket"), ["event_id"],
        {"total": ("sum", F.col("price_bucket")), "peak": ("max", F.col("price_bucket"))},
    ).collect()
    total = peak = 0
    for r in sorted(running, key=lambda r: r["event_id"]):
        total, peak = total + r["price_bucket"], max(peak, r["price_bucket"])
        assert (r["total"], r["peak"]) == (total, peak)
    ranked = ordering.with_rank_in_group(skewed.select("event_id", "user_id"), ["user_id"], ["event_id"]).collect()
    seen = {}
    for r in sorted(ranked, key=lambda r: r["event_id"]):
        seen[r["user_id"]] = seen.get(r["user_id"], 0) + 1
        assert r["position"] == seen[r["user_id"]]


def test_blocks_hold_even_numbers_of_rows(spark):
    """A stray time, a dense day, null keys and exact copies leave no block above twice the limit."""
    rows = spark.range(10_000).select(
        F.when(F.col("id") % 10 == 9, F.lit(None)).otherwise(1).alias("k"),
        F.timestamp_seconds(F.when(F.col("id") == 0, 0).when(F.col("id") % 3 == 0, 1.7e9 + F.col("id") % 5000).otherwise(1.6e9 + F.col("id") * 1000)).alias("t"),
    )
    blocked, split = hot_keys.with_blocks(rows.repartition(8), ["k"], "t", 1000)
    sizes = blocked.groupBy("k", "_block").count().collect()
    assert split and blocked.count() == 10_000
    assert max(r["count"] for r in sizes) <= 2000 and len([r for r in sizes if r["k"] == 1]) >= 8
    assert rows.filter("k = 1").count() == sum(r["count"] for r in sizes if r["k"] == 1)


def test_ties_compare_in_their_own_types(spark):
    """Of rows at one time the newest created one counts, then the highest number, not the highest text."""
    left = spark.createDataFrame([(1, START)], "k int, at timestamp")
    made = [START, START + dt.timedelta(days=1)]
    rows_ = [(1, START, made[0], 99), (1, START, made[1], 9), (1, START, made[1], 10)]
    view = spark.createDataFrame(rows_, "k int, feature_timestamp timestamp, created_timestamp timestamp, n int")
    joined = asof.asof_join(left, "at", {"k": "k"}, [asof.FeatureView(view, "f", tie_break=("created_timestamp", "n"))])
    assert joined.first()["f_n"] == 10


def test_equal_rows_of_a_hot_key_are_spread(spark):
    left = spark.createDataFrame([(1, "same")] * 60 + [(2, "x"), (3, "y"), (None, "z")], "k int, v string")
    right = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "k int, w string")
    for how in ("inner", "left", "left_semi", "left_anti"):
        got = joins.salted_join(left, right, ["k"], how, rows_per_task=7)
        assert rows(got) == rows(left.join(right, "k", how))


def test_blocks_are_cut_again_where_quantiles_run_out(spark, skewed, monkeypatch):
    """More blocks than quantiles: rounds of cuts keep blocks small, in the order of time, and answers the same."""
    view = asof.FeatureView(skewed.filter("event_type = 'view'").select("user_id", "event_timestamp", "price"), "v", "event_timestamp", "price")
    left = skewed.select("event_id", "user_id", "event_timestamp")
    whole = rows(asof.asof_join(left, "event_timestamp", {"user_id": "user_id"}, [view]))
    monkeypatch.setattr(hot_keys, "QUANTILES", 4)
    frame = spark.range(6000).selectExpr("if(id % 3 < 2, 1, id) as k", "timestamp_micros(if(id % 10 = 0, 50, id * id)) as t")
    blocked, split = hot_keys.with_blocks(frame.repartition(8), ["k"], "t", 50)
    parts = blocked.filter("k = 1").groupBy("_block").agg(F.count(F.lit(1)).alias("n"), F.min("t").alias("a"), F.max("t").alias("b"), F.count_distinct("t").alias("d")).orderBy("_block").collect()
    assert split and len(parts) > 60 and sum(p["n"] for p in parts) == 4000
    assert all(p["n"] <= 100 or p["d"] < 30 for p in parts)  # only the rows of one instant, a tenth, stay together
    assert all(x["b"] < y["a"] for x, y in zip(parts, parts[1:]))
    assert blocked.filter("k <> 1 and _block <> 0").isEmpty() and not blocked.filter("k <> 1 and _hot").count()
    assert rows(asof.asof_join(left, "event_timestamp", {"user_id": "user_id"}, [view], rows_per_task=5)) == whole
