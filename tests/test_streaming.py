"""Event stream: lateness rules, duplicate marks, rolling state over several runs, idempotent batches."""

import datetime as dt
import json
import os

import numpy as np
import pandas as pd
import pytest
from conftest import rows
from pyspark.sql import functions as F

from shopflow import session
from shopflow.session import streaming_session
from shopflow.streaming import firings, injection, jobs, lateness, sinks, state
from shopflow.streaming.config import StreamConfig, trigger

START = dt.datetime(2024, 1, 1)


@pytest.mark.parametrize(
    "watermark,expected",
    [(30, (30.0, True, False)), (360, (360.0, True, True)), (None, (0.0, False, False)), (-1, (0.0, False, False)), (359, (359.0, True, False))],
)
def test_lateness_rules(spark, watermark, expected):
    frame = spark.createDataFrame([(START, None if watermark is None else int(START.replace(tzinfo=dt.timezone.utc).timestamp() + watermark) * 1000)], "e timestamp, w bigint")
    r = frame.select(*[c.alias(n) for n, c in lateness.status(F.col("e"), F.col("w"), StreamConfig()).items()]).collect()[0]
    assert (r["late_by_seconds"], r["is_late"], r["is_too_late"]) == expected


def test_roles_and_triggers():
    assert [StreamConfig(online=a, offline=b).role for a in (True, False) for b in (True, False)] == ["hybrid", "online", "offline", "disabled"]
    assert trigger(StreamConfig(), True) == {"availableNow": True} and trigger(StreamConfig(), False) == {"processingTime": "5 seconds"}


def record(event, at, kind, user=1, item=10, arrival=None, category=1, price="5.00"):
    row = {
        "event_id": event, "event_timestamp": at.isoformat() + "Z", "user_id": user, "product_id": item, "event_type": kind, "category_id": category,
        "brand_id": 2, "price": price, "price_bucket": 3, "payload_hash": event,
    }
    return json.dumps({"payload": {"op": "c", "after": row}}), arrival or at


class Feed:
    def __init__(self, spark, folder, **config):
        self.session = streaming_session(spark)
        self.landing = f"{folder}/landing"
        self.job = jobs.StreamJob(self.session, f"{folder}/job", StreamConfig(**config))

    def send(self, *records):
        self.session.createDataFrame(list(records), jobs.RECORD_SCHEMA).coalesce(1).write.mode("append").parquet(self.landing)
        self.job.run_all(self.session.readStream.schema(jobs.RECORD_SCHEMA).parquet(self.landing))

    def newest(self, name, key):
        newest = {}
        for r in self.job.table(name).orderBy("batch_id").collect():
            newest[r[key]] = r
        return newest


def test_stream_over_several_runs(spark, tmp_path):
    feed = Feed(spark, tmp_path)
    minute = dt.timedelta(minutes=1)
    view, cart = record("e1", START + dt.timedelta(seconds=1), "view"), record("e2", START + dt.timedelta(seconds=8), "cart", category=2)
    feed.send(view, cart, (cart[0], cart[1] + minute))
    user = feed.newest("stream_user_features", "user_id")[1]
    assert (user["hist_length"], user["views_30m"], user["carts_30m"], user["distinct_categories_7d"]) == (2, 1, 1, 2)
    assert user["avg_viewed_price_7d"] == 5.0 and user["window_end"] == START + minute and not user["late_revision"]

    # A copy in a later run is still a duplicate; a late event revises its pane without counting twice.
    feed.send((cart[0], cart[1] + 2 * minute), record("e0", START + dt.timedelta(seconds=4), "view", arrival=START + 3 * minute))
    flags = {(r["event_id"], r["batch_id"]): r["is_duplicate"] for r in feed.job.table("stream_behavior_events").collect()}
    assert flags["e2", 1] and not flags["e0", 1]
    user = feed.newest("stream_user_features", "user_id")[1]
    assert (user["hist_length"], user["views_30m"], user["event_id"], user["late_revision"]) == (3, 2, "e2", True)

    # Eight days later only the new pane is left, and what arrives far behind goes to the dead letters.
    later = START + dt.timedelta(days=8)
    feed.send(record("e3", later, "purchase", item=11), record("e4", START, "view", arrival=later + minute))
    user = feed.newest("stream_user_features", "user_id")[1]
    assert user["hist_item_ids"] == [11] and (user["views_30m"], user["purchases_24h"]) == (0, 1)
    letters = feed.job.table("stream_late_events_dlq").collect()
    assert [r["event_id"] for r in letters] == ["e4"] and letters[0]["reason"] == "too_late_for_feature_update"
    assert json.loads(letters[0]["payload"])["event_id"] == "e4"
    counters = lateness.late_counters(feed.job.table("stream_behavior_events")).collect()[0]
    assert counters["late_arrivals_total"] == counters["accepted_late_events_total"] + counters["too_late_events_total"] == 1
    items = feed.newest("stream_item_features", "product_id")
    assert items[11]["purchases_7d"] == 1 and items[11]["conversion_rate_7d"] == pytest.approx(0.2) and items[10]["event_id"] == "e2"

    windows = {r["window_start"]: r for r in feed.job.current_quality_windows().collect()}
    first = windows[START]
    assert (first["event_count"], first["duplicate_event_count"], first["side_output_late_events"]) == (5, 2, 1)
    finality = {r["event_id"]: r["is_final"] for r in feed.job.with_finality(feed.job.table("stream_user_features")).collect()}
    assert finality["e2"] and not finality["e3"]
    view = feed.job.online_view("stream_user_features", "user_id", "user_aggregate").collect()
    assert len(view) == 1 and view[0]["updated_at"] == later and view[0]["expires_at"] == later + dt.timedelta(days=1)
    assert feed.job.offline_rows("stream_user_features", "user_id").count() == 2


def test_a_repeated_batch_changes_nothing(spark, tmp_path):
    feed = Feed(spark, tmp_path)
    feed.send(record("a", START, "view"))
    before = rows(feed.job.table("stream_behavior_events"))
    again = feed.job.table("stream_behavior_events").drop("batch_id").withColumn("seen_before", F.lit(False))
    feed.job._flag_batch(again, 0)
    assert rows(feed.job.table("stream_behavior_events")) == before


def test_hot_id_is_marked_once(spark, tmp_path):
    feed = Feed(spark, tmp_path)
    copies = [record("hot", START, "view", arrival=START + dt.timedelta(seconds=i)) for i in range(60)]
    others = [record(f"o{i}", START + dt.timedelta(seconds=i), "view", user=i % 5) for i in range(40)]
    feed.send(*copies, *others)
    marks = feed.job.table("stream_behavior_events").groupBy("event_id").agg(F.count_if(~F.col("is_duplicate")).alias("kept"), F.count(F.lit(1)).alias("n"))
    got = {r["event_id"]: (r["kept"], r["n"]) for r in marks.collect()}
    assert got["hot"] == (1, 60) and all(v == (1, 1) for k, v in got.items() if k != "hot")


def test_hot_copies_in_the_batch_twin(spark):
    data = [(f"e{i % 7 if i % 3 else 0}", START + dt.timedelta(seconds=i), str(i)) for i in range(90)]
    frame = spark.createDataFrame(data, "event_id string, record_timestamp timestamp, payload_hash string")
    marked = lateness.mark_duplicates(frame)
    firsts = {}
    for event, at, digest in data:
        firsts.setdefault(event, (at, digest))
    for r in marked.collect():
        assert r["is_duplicate"] == ((r["record_timestamp"], r["payload_hash"]) != firsts[r["event_id"]])


def test_injection_is_repeatable(shop):
    events = shop.behavior_events
    assert rows(injection.inject_late(events, 0.3, 5, 9).select("event_id", "event_timestamp")) == rows(injection.inject_late(events, 0.3, 5, 9).select("event_id", "event_timestamp"))
    assert injection.inject_bursts(events, 0, 3).count() == events.count()
    replayed = injection.inject_replays(events, 0.5, 60)
    assert events.count() < replayed.count() < 2 * events.count()


def test_dead_letters_are_unique_per_event_and_reason(spark, tmp_path):
    feed = Feed(spark, tmp_path)
    later = START + dt.timedelta(days=2)
    old = [record(f"old{i}", START, "view", arrival=later + dt.timedelta(seconds=i)) for i in range(3)]
    feed.send(record("now", later, "view"), *old, (old[0][0], old[0][1] + dt.timedelta(minutes=1)))
    feed.send((old[0][0], old[0][1] + dt.timedelta(minutes=9)), (old[2][0], old[2][1] + dt.timedelta(minutes=9)), record("old9", START, "cart", arrival=later + dt.timedelta(hours=1)))
    letters = feed.job.contract_table("stream_late_events_dlq").collect()
    assert sorted(r["event_id"] for r in letters) == ["old0", "old1", "old2", "old9"]
    first = next(r for r in letters if r["event_id"] == "old0")
    assert json.loads(first["payload"])["record_timestamp"].startswith((later).isoformat())


def keyed(spark, path, replace=True, buckets=8):
    return sinks.KeyedTable(spark, str(path), "id string, at timestamp, value int", ["id"], [F.desc("value")], replace=replace, key_range=F.date_format("at", "yyyy-MM-dd"), buckets=buckets)


def changes(spark, *rows_):
    return spark.createDataFrame([(i, None if d is None else START + dt.timedelta(days=d), v) for i, d, v in rows_], "id string, at timestamp, value int")


def stored_files(path):
    return {str(f.relative_to(path)): f.stat().st_mtime_ns for f in path.rglob("*.parquet")}


def test_keyed_table_rewrites_only_what_a_batch_touches(spark, tmp_path):
    path = tmp_path / "table"
    table = keyed(spark, path)
    assert rows(table.read()) == []
    many = changes(spark, *[(f"k{i}", i % 10, i) for i in range(2000)])
    assert table.merge(many, 0, f"{tmp_path}/staging") == 80
    before = stored_files(path)
    assert table.merge(changes(spark, ("k13", 3, -1), ("new", 3, 7), ("new", 3, 5)), 1, f"{tmp_path}/staging") <= 2
    after = stored_files(path)
    touched = {f.rsplit("/", 1)[0] for f in before.keys() ^ after.keys()}
    assert 1 <= len(touched) <= 2 and all(f.startswith("key_range=2024-01-04") for f in touched)
    got = {r["id"]: r["value"] for r in table.read().collect()}
    assert got == {**{f"k{i}": i for i in range(2000)}, "k13": -1, "new": 7}


def test_keyed_table_repeats_a_batch_after_any_failure(spark, tmp_path):
    path = tmp_path / "table"
    table = keyed(spark, path)
    table.merge(changes(spark, ("a", 0, 1), ("b", 1, 2), ("n", None, 3)), 0, f"{tmp_path}/staging")
    batch = changes(spark, ("a", 0, 10), ("b", 1, 20), ("c", 2, 30))
    table.merge(batch, 1, f"{tmp_path}/staging")
    whole = rows(table.read())
    table.merge(batch, 1, f"{tmp_path}/staging")
    assert rows(table.read()) == whole
    # The move of the parts broke off: one of them is gone.
    for file in list((path / "key_range=2024-01-02").rglob("*")):
        if file.is_file():
            file.write_bytes(b"") if file.suffix == ".crc" else file.rename(tmp_path / f"lost-{file.name}")
    table.merge(batch, 1, f"{tmp_path}/staging")
    assert rows(table.read()) == whole
    assert {r[0]: r[2] for r in whole} == {"a": 10, "b": 20, "c": 30, "n": 3}


def test_keyed_table_that_leaves_out_known_keys(spark, tmp_path):
    table = keyed(spark, tmp_path / "table", replace=False, buckets=2)
    table.merge(changes(spark, ("a", 0, 1), ("a", 0, 2), ("b", 0, 1)), 0, f"{tmp_path}/staging")
    table.merge(changes(spark, ("a", 0, 9), ("c", 0, 3)), 1, f"{tmp_path}/staging")
    table.merge(changes(spark), 2, f"{tmp_path}/staging")
    assert {r["id"]: r["value"] for r in table.read().collect()} == {"a": 2, "b": 1, "c": 3}


class FiringFeed(Feed):
    def send(self, *records):
        self.session.createDataFrame(list(records), jobs.RECORD_SCHEMA).coalesce(1).write.mode("append").parquet(self.landing)
        self.job.flag_events(self.session.readStream.schema(jobs.RECORD_SCHEMA).parquet(self.landing)).awaitTermination()
        self.job.firings("user_id").awaitTermination()

    def fired(self, user=1, start=START):
        shown = self.job.table("stream_firings_user_id").filter((F.col("user_id") == user) & (F.col("window_start") == F.lit(start)))
        return [(r["firing"], r["event_count"], r["views"], r["revision"]) for r in shown.orderBy("revision").collect()]


def test_panes_fire_early_at_close_and_late(spark, tmp_path):
    feed = FiringFeed(spark, tmp_path, watermark_delay_seconds=60)
    at = lambda seconds: START + dt.timedelta(seconds=seconds)
    feed.send(record("a", at(1), "view"), record("b", at(2), "cart"), record("x", at(3), "view", user=2))
    assert feed.fired() == [("early", 2, 1, 1)] and feed.fired(2) == [("early", 1, 1, 1)]
    # Only the pane that changed fires again.
    feed.send(record("c", at(30), "view"))
    assert feed.fired() == [("early", 2, 1, 1), ("early", 3, 2, 2)] and feed.fired(2) == [("early", 1, 1, 1)]
    # Another user's event moves the watermark past the panes' last instant; both fire once by their timers.
    feed.send(record("y", at(150), "view", user=3))
    assert feed.fired()[2:] == [("close", 3, 2, 3)] and feed.fired(2)[1:] == [("close", 1, 1, 2)]
    # Late events that are still accepted fire one by one; a copy, or one that comes too late, does not.
    feed.send(record("d", at(40), "view", arrival=at(160)), record("e", at(41), "purchase", arrival=at(161)), record("c", at(30), "view", arrival=at(162)))
    assert feed.fired()[3:] == [("late", 4, 3, 4), ("late", 5, 3, 5)]
    feed.send(record("z", at(1000), "view", user=3), record("f", at(42), "view", arrival=at(1001)))
    assert len(feed.fired()) == 5
    # In one batch a pane opens, is passed by the watermark and revised.
    day = 86400
    feed.send(record("g", at(day), "view", user=4), record("h", at(day + 200), "view", user=5), record("i", at(day + 1), "cart", user=4, arrival=at(day + 201)))
    assert feed.fired(4, at(day)) == [("close", 1, 1, 1), ("late", 2, 1, 2)]


def test_firings_of_a_hot_pane_are_sums_of_parts(spark):
    """Parts summed before the state equal the events themselves, in any grouping."""
    events = [(1, 0, i % 3 == 2, 1, i % 2, 0, 0, i, i, f"e{i}", 5) for i in range(90)]
    frame = spark.createDataFrame(events, "entity long, pane_ms long, after_close boolean, event_count long, views long, carts long, purchases long, last_us long, arrival long, event_id string, watermark_ms long")
    summed = frame.repartition(4).mapInPandas(firings._pre_totals, frame.schema)
    facts = lambda f: tuple(f.groupBy("after_close").agg(F.sum("event_count"), F.sum("views"), F.max("last_us")).orderBy("after_close").collect())
    assert facts(summed) == facts(frame)
    assert summed.filter("not after_close").count() <= 4 and summed.filter("after_close").count() == 30


class FakeMap(dict):
    reads = writes = 0

    def containsKey(self, key):
        return key in self

    def getValue(self, key):
        self.reads += 1
        return self[key]

    def updateValue(self, key, value):
        self.writes += 1
        self[key] = value

    def removeKey(self, key):
        self.pop(key, None)


class FakeValue:
    value = None

    def exists(self):
        return self.value is not None

    def get(self):
        return self.value

    def update(self, value):
        self.value = value


class FakeHandle:
    def __init__(self):
        self.parts = {}

    def getMapState(self, name, *_):
        return self.parts.setdefault(name, FakeMap())

    def getValueState(self, name, *_):
        return self.parts.setdefault(name, FakeValue())


def hot_events(rng, n, begin, end, dense):
    at = rng.integers(begin, end, n) if not dense else begin + rng.integers(0, 50, n) * 1000
    return pd.DataFrame({
        "event_id": [f"{begin}-{i:06d}" for i in range(n)], "user_id": 7, "product_id": rng.integers(1, 9, n), "event_type_id": rng.integers(1, 4, n),
        "category_id": rng.integers(1, 40, n), "brand_id": 1, "price_bucket": 2, "request_id": None, "impression_id": "i", "is_late": False,
        "at": at, "cents": rng.integers(1, 5000, n),
    })


def test_pane_hierarchy_of_a_hot_entity():
    """Days of events of one entity, late and dense ones among them, against sums over all of them."""
    rng, day, config = np.random.default_rng(5), 86_400_000_000, StreamConfig()
    handle, processor = FakeHandle(), state.UserRolling(config)
    processor.init(handle)
    begin = 19_723 * day + 12_345
    batches = [hot_events(rng, 900, begin + i * day // 2, begin + (i + 1) * day // 2, False) for i in range(20)]
    batches.append(hot_events(rng, 30_000, begin + 10 * day, 0, True))  # 50 instants with 30,000 events
    batches.append(hot_events(rng, 300, begin + 4 * day, begin + 10 * day, False))  # all late
    known = []
    for number, batch in enumerate(batches):
        known.append(batch)
        every = pd.concat(known)
        parts = np.array_split(np.arange(len(batch)), 3)
        totals = pd.concat(state._pre_totals("user_id", config.max_history_length)(batch.iloc[p] for p in parts))
        for column in totals.columns:
            if isinstance(totals[column].iloc[0], list):
                totals[column] = totals[column].map(np.array)
        if number == 20:
            assert len(totals) <= 3  # a row per second and batch of rows, however many events
            for part in handle.parts.values():
                part.reads = part.writes = 0
        (row,) = (f.iloc[0] for f in processor.handleInputRows((7,), iter([totals]), None))
        if number == 20:
            assert sum(handle.parts[n].writes for n in ("instants", "slots")) == 4
            assert sum(handle.parts[n].reads for n in ("instants", "slots")) <= 4 + 3 * (4 + 9)
        at = int(every["at"].max())
        oldest = at - at % 60_000_000 + 60_000_000 - 7 * day
        week = every[every["at"] >= oldest]
        kind = lambda k, seconds: int(((every["event_type_id"] == k) & (every["at"] > at - seconds * 1_000_000)).sum())
        of = lambda k: week[week["event_type_id"] == k]
        assert (row["views_30m"], row["carts_30m"], row["purchases_24h"]) == (kind(state.VIEW, 1800), kind(state.CART, 1800), kind(state.PURCHASE, 86400))
        assert row["distinct_categories_7d"] == week["category_id"].nunique()
        views = of(state.VIEW)
        assert row["avg_viewed_price_7d"] == pytest.approx(views["cents"].sum() / 100 / len(views))
        assert row["cart_to_purchase_ratio_7d"] == pytest.approx(len(of(state.PURCHASE)) / len(of(state.CART)))
        newest = week.sort_values(["at", "event_id"]).tail(50)
        assert row["hist_item_ids"] == newest["product_id"].to_list() and row["event_id"] == newest["event_id"].iloc[-1]
        assert row["late_revision"] == (number == 21)
    seconds = {key[0] for key in handle.parts["instants"]}
    assert min(seconds) >= oldest - day and len(handle.parts["days"].get()[0]) <= 9


class Cluster:
    """A session on a cluster, as far as its settings go."""

    def __init__(self, parts, master="spark://somewhere", cores=2):
        self.parts, self.sparkContext = parts, type("Context", (), {"master": master, "defaultParallelism": cores})
        self.conf = self

    def get(self, name):
        assert name == "spark.sql.shuffle.partitions"
        return str(self.parts)


def test_state_partitions_follow_the_records_of_a_replay():
    """Each partition costs a worker, a store and a commit per batch and hop, which 200 of them paid for a few records too."""
    assert [session.state_partitions(Cluster(200), n) for n in (0, 100_000, 6_000_000, 60_000_000)] == [12, 12, 120, 200]
    assert session.state_partitions(Cluster(200)) == 200 and session.state_partitions(Cluster(6), 10**9) == 6
    assert session.state_partitions(Cluster(200, "local[8]", 8), 10**9) == 8
    buckets = [(c.dedup_buckets, c.state_buckets) for c in (StreamConfig().for_partitions(n) for n in (12, 200))]
    assert buckets == [(48, 192), (800, 1024)]


def test_hops_run_beside_each_other(spark, tmp_path):
    """Every hop behind the flagged events is under way before the first is waited for."""
    feed, begun, waited = Feed(spark, tmp_path), [], []

    class Under:
        def __init__(self, hop):
            self.hop = hop
            begun.append(hop)

        def awaitTermination(self):
            waited.append((self.hop, len(begun)))

    feed.job._start = lambda stream, hop, *_: Under(hop)
    feed.session.createDataFrame([], jobs.RECORD_SCHEMA).write.parquet(feed.landing)
    feed.session.createDataFrame([], jobs.EVENT_SCHEMA).write.parquet(feed.job.path("stream_behavior_events"))
    records = feed.session.readStream.schema(jobs.RECORD_SCHEMA).parquet(feed.landing)
    feed.job.run_all(records, lambda: feed.job.firings("user_id"), feed.job.user_panes)
    assert waited == [("events", 1), *((hop, 6) for hop in ("quality", "users", "items", "firings_user_id", "panes"))]


def test_events_flagged_while_the_hops_run_wait_for_the_next_replay(spark, tmp_path):
    """A hop that has listed its input takes none of the events that are flagged before it ends."""
    feed, minute = Feed(spark, tmp_path), dt.timedelta(minutes=1)

    def flag(*records):
        feed.session.createDataFrame(list(records), jobs.RECORD_SCHEMA).coalesce(1).write.mode("append").parquet(feed.landing)
        return feed.job.flag_events(feed.session.readStream.schema(jobs.RECORD_SCHEMA).parquet(feed.landing))

    jobs.finish([flag(record("a", START, "view"))])
    behind = feed.job.start_behind(lambda: feed.job.firings("user_id"), feed.job.user_panes)
    jobs.input_listed(behind)
    jobs.finish([flag(record("b", START + minute, "view", user=2)), *behind])
    tables = ("streaming_quality_windows", "stream_user_features", "stream_item_features", "stream_firings_user_id", "stream_user_panes")
    assert [feed.job.table(name).count() for name in tables] == [1] * 5
    jobs.finish(feed.job.start_behind(lambda: feed.job.firings("user_id"), feed.job.user_panes))
    assert [feed.job.table(name).count() for name in tables] == [2] * 5
    assert feed.job.contract_table("stream_user_aggregate_features").count() == 2


def test_hops_run_when_their_tables_are_asked_for(spark):
    """Late counters need no rolling features; a hop that is asked for later sees the same two parts as one asked for at once."""
    from shopflow.queries.streaming import Replay

    first = START + dt.timedelta(days=14, hours=22)
    sent = [record("a", first, "view"), record("b", first + dt.timedelta(minutes=1), "cart", user=2), record("c", first + dt.timedelta(hours=3), "view")]
    records = spark.createDataFrame(sent, jobs.RECORD_SCHEMA)
    names = ["stream_firings_user_id", "stream_user_aggregate_features", "stream_user_features", "streaming_quality_windows"]
    later, at_once = Replay(spark, records, 3), Replay(spark, records, 3)
    later.run(["stream_behavior_events"])
    assert later.job.table("stream_behavior_events").count() == 3
    assert os.listdir(later.job.path("_checkpoints")) == ["events"]
    later.run(names)
    at_once.run(names)
    for name in names:
        tables = [r.job.contract_table(name) if name.endswith("aggregate_features") else r.job.table(name) for r in (later, at_once)]
        assert rows(tables[0]) == rows(tables[1]) != []
    batches = {(r["user_id"], r["batch_id"]) for r in later.job.table("stream_user_features").collect()}
    assert batches == {(1, 0), (2, 0), (1, 1)}
