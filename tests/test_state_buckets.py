"""State kept by bucket: the same features and firings as entity by entity, with few questions to the state."""

import itertools

import numpy as np
import pandas as pd
import pytest

from shopflow.streaming import firings, state
from shopflow.streaming.config import StreamConfig

DAY = 86_400_000_000


class Map(dict):
    calls = 0

    def containsKey(self, key):
        self.calls += 1
        return key in self

    def getValue(self, key):
        self.calls += 1
        return self.get(key)

    def updateValue(self, key, value):
        self.calls += 1
        self[key] = value

    def removeKey(self, key):
        self.calls += 1
        self.pop(key, None)

    def iterator(self):
        return iter(list(self.items()))


class Value:
    value = None

    def exists(self):
        return self.value is not None

    def get(self):
        return self.value

    def update(self, value):
        self.value = value

    def clear(self):
        self.value = None


class Handle:
    def __init__(self):
        self.parts, self.timers = {}, set()

    def getMapState(self, name, *_):
        return self.parts.setdefault(name, Map())

    def getValueState(self, name, *_):
        return self.parts.setdefault(name, Value())

    def registerTimer(self, at):
        self.timers.add(at)

    def deleteTimer(self, at):
        self.timers.discard(at)

    def calls(self):
        return sum(p.calls for p in self.parts.values() if isinstance(p, Map))


class Clock:
    def __init__(self, now):
        self.now = now

    def getCurrentWatermarkInMs(self):
        return self.now


def totals(rng, users, begin, end):
    n = 12 * len(users)
    events = pd.DataFrame({
        "event_id": [f"{begin}-{i:04d}" for i in range(n)], "user_id": np.repeat(users, 12), "product_id": rng.integers(1, 9, n), "event_type_id": rng.integers(1, 4, n),
        "category_id": rng.integers(1, 40, n), "brand_id": 1, "price_bucket": 2, "request_id": None, "impression_id": "i", "is_late": False,
        "at": rng.integers(begin, end, n), "cents": rng.integers(1, 5000, n),
    }).sample(frac=1, random_state=1)
    parts = np.array_split(np.arange(n), 3)
    return list(state._pre_totals("user_id", 50)(events.iloc[p] for p in parts))


@pytest.mark.parametrize(("small", "memory"), [(10_000, 10_000), (30, 10_000), (10_000, 50), (30, 50)])
def test_rolling_buckets_equal_single_entities(small, memory):
    """In one entry per entity, with panes of their own, and with more entities than are held at a time."""
    rng, config, users = np.random.default_rng(3), StreamConfig(), list(range(20))
    handle = Handle()
    buckets = state.RollingBuckets(state.UserRolling(config), "user_id")
    buckets.SMALL, buckets.MEMORY = small, memory
    buckets.init(handle)
    single = {u: state.UserRolling(config) for u in users}
    for u in users:
        single[u].init(Handle())
    for i in range(5):
        begin = 19_723 * DAY + i * 3 * DAY
        frames = totals(rng, users, begin, begin + 3 * DAY if i < 4 else begin + 1000)
        before = handle.calls()
        got = pd.concat(buckets.handleInputRows((0,), iter(frames), None)).sort_values("user_id")
        if (small, memory) == (10_000, 10_000):
            assert handle.calls() - before <= 2 * len(users)
        want = []
        for u in users:
            want += single[u].handleInputRows((u,), (f[f["user_id"] == u] for f in frames if (f["user_id"] == u).any()), None)
        pd.testing.assert_frame_equal(got.reset_index(drop=True), pd.concat(want).reset_index(drop=True))


def pane_rows(places, watermark, after_close=False, counter=itertools.count()):
    return pd.DataFrame(
        [(e, p, after_close, 1, 1, 0, 0, p * 1000, next(counter), f"e{p}", watermark) for e, p in places],
        columns=["entity", "pane_ms", "after_close", "event_count", "views", "carts", "purchases", "last_us", "arrival", "event_id", "watermark_ms"],
    )


def test_firings_of_a_bucket_of_panes():
    """Panes that a batch opens and ends for good are not stored; the others close by the one timer of their bucket."""
    config, minute = StreamConfig(), 60_000
    handle, processor = Handle(), firings.PaneFirings("user_id", config)
    processor.init(handle)
    old = [(e, m * minute) for e in range(50) for m in range(4)]
    live = [(e, 100 * minute) for e in range(50)]
    fired = lambda frames: sorted(map(tuple, pd.concat(list(frames))[["user_id", "window_start", "firing", "revision"]].to_numpy().tolist()))
    stamp = lambda place: pd.Timestamp(place[1], unit="ms")
    rows = pane_rows(old + live, 50 * minute)
    got = fired(processor.handleInputRows((0,), iter([rows.iloc[:99], rows.iloc[99:]]), Clock(0)))
    assert got == sorted([(p[0], stamp(p), "close", 1) for p in old] + [(p[0], stamp(p), "early", 1) for p in live])
    assert set(handle.parts["panes"]) == set(live) and len(handle.timers) == 1
    assert handle.calls() <= len(old) + 2 * len(live)
    due = handle.timers.pop()
    got = fired(processor.handleExpiredTimer((0,), Clock(due), None))
    assert got == [(p[0], stamp(p), "close", 2) for p in live] and len(handle.timers) == 1
    late = fired(processor.handleInputRows((0,), iter([pane_rows(live[:2], 101 * minute, after_close=True)]), Clock(due)))
    assert late == [(p[0], stamp(p), "late", 3) for p in live[:2]]
    assert not list(processor.handleExpiredTimer((0,), Clock(handle.timers.pop()), None)) and not handle.parts["panes"] and not handle.timers


def test_panes_of_a_full_entity_come_by_the_hour():
    """An entity with more panes than one entry takes: an entry per hour, and only those of crowded hours are their own."""
    config, handle = StreamConfig(), Handle()
    buckets, single = state.RollingBuckets(state.UserRolling(config), "user_id"), state.UserRolling(config)
    buckets.SMALL = 100
    buckets.init(handle)
    single.init(Handle())
    rng, crowded = np.random.default_rng(4), 19_726 * DAY + 7_200_000_000
    for i in range(14):
        begin = 19_723 * DAY + i * DAY
        frames = totals(rng, [7] * 30, begin, begin + DAY)
        if i in (3, 5):  # the second of these is late
            frames += totals(rng, [7] * 30, crowded, crowded + 3_600_000_000)
        before = handle.calls()
        (got,) = buckets.handleInputRows((0,), iter(frames), None)
        if i not in (3, 5, 10, 11):
            assert handle.calls() - before <= 200  # 360 events, which made about 1,000 panes
        (want,) = single.handleInputRows((7,), iter(frames), None)
        pd.testing.assert_frame_equal(got, want)
        own = {second for _, second in handle.parts["instants"]}
        assert bool(own) == (3 <= i <= 10) and all(crowded <= s < crowded + 3_600_000_000 for s in own)
    assert len(handle.parts["pages"]) <= 9 * 24


class Now:
    def __init__(self, now):
        self.now = now

    def getCurrentProcessingTimeInMs(self):
        return self.now


@pytest.mark.parametrize(("most", "held"), [(256, 200_000), (4, 200_000), (4, 30)])
def test_seen_ids_are_asked_by_leaves(monkeypatch, most, held):
    """Flags as from a plain dictionary of first sights, with few questions to the state."""
    monkeypatch.setattr(state._IdTree, "MOST", most)
    monkeypatch.setattr(state._IdTree, "HELD", held)
    rng, handle, processor, first = np.random.default_rng(8), Handle(), state._SeenIds(100), {}
    processor.init(handle)
    for now in (0, 40_000, 99_999, 100_000, 170_000, 250_000):
        names = [f"id{i}" for i in rng.integers(0, 3000, 2000)]
        frames = [pd.DataFrame({"event_id": part, "seen_before": False}) for part in (names[:900], names[900:])]
        before = handle.calls()
        got = pd.concat(processor.handleInputRows((3, -1), iter(frames), Now(now)))
        if (most, held) == (256, 200_000):
            assert handle.calls() - before <= 80
        known = {n for n, at in first.items() if at + 100_000 > now}
        assert got["seen_before"].tolist() == [n in known for n in names] and set(got["_route"]) == {-1}
        first |= {n: now for n in names if n not in known}
    (passed,) = processor.handleInputRows((3, 2), iter(frames[:1]), Now(300_000))
    assert not passed["seen_before"].any()


def test_a_bucket_without_panes_is_not_asked_for_them():
    handle, processor = Handle(), firings.PaneFirings("user_id", StreamConfig())
    processor.init(handle)
    old = [(e, m * 60_000) for e in range(50) for m in range(4)]
    assert len(pd.concat(processor.handleInputRows((0,), iter([pane_rows(old, 10**9)]), Clock(0)))) == len(old)
    assert handle.calls() == 0 and not handle.parts["panes"]


def test_an_hour_of_few_panes_shares_the_entry_of_its_day():
    """A full entity whose days are thin is asked by day, and a day with more panes than one entry takes parts into hours."""
    config, handle = StreamConfig(), Handle()
    buckets, single = state.RollingBuckets(state.UserRolling(config), "user_id"), state.UserRolling(config)
    buckets.init(handle)
    single.init(Handle())
    rng = np.random.default_rng(5)
    for i in range(12):
        begin = 19_723 * DAY + i * 3 * DAY
        frames = totals(rng, [7] * (60 if i == 5 else 12), begin, begin + (DAY if i == 5 else 3 * DAY))
        before = handle.calls()
        (got,) = buckets.handleInputRows((0,), iter(frames), None)
        if i not in (5, 6, 7):
            assert handle.calls() - before <= 60  # 144 events in 72 hours
        (want,) = single.handleInputRows((7,), iter(frames), None)
        pd.testing.assert_frame_equal(got, want)
        assert (len(handle.parts["pages"]) > 20) == (5 <= i <= 6)
    assert not handle.parts["instants"]


def test_totals_before_the_shuffle_are_those_of_pandas_groups():
    """Per entity and second, whatever the order of the rows, with events of one instant and missing texts."""
    rng, n = np.random.default_rng(6), 3000
    rows = pd.DataFrame({
        "event_id": [f"e{i}" for i in rng.permutation(n)], "user_id": rng.integers(1, 40, n), "product_id": rng.integers(1, 9, n), "event_type_id": rng.integers(0, 4, n),
        "category_id": rng.integers(1, 5, n), "brand_id": 1, "price_bucket": 2, "request_id": [None if i % 3 else "r" for i in range(n)], "impression_id": "i",
        "is_late": rng.random(n) < 0.1, "at": rng.integers(0, 40, n) * 250_000, "cents": rng.integers(1, 5000, n),
    })
    (out,) = state._pre_totals("user_id", 5)(iter([rows, rows.iloc[:0]]))
    assert out[["user_id", "second"]].apply(tuple, axis=1).is_monotonic_increasing
    for (user, second), own in rows.groupby(["user_id", rows["at"] // 1_000_000 * 1_000_000]):
        (line,) = out[(out["user_id"] == user) & (out["second"] == second)].to_dict("records")
        times = sorted(own["at"].unique())
        assert line["times"] == times and line["is_late"] == own["is_late"].any() and line["cents"] == own["cents"][own["event_type_id"] == 1].sum()
        for name, kind in (("views", 1), ("carts", 2), ("purchases", 3)):
            assert line[name] == [int(((own["at"] == t) & (own["event_type_id"] == kind)).sum()) for t in times]
        assert sorted(line["categories"]) == sorted(own["category_id"].unique())
        whole = rows[rows["user_id"] == user].sort_values(["at", "event_id"]).tail(5)
        last = second == whole["at"].max() // 1_000_000 * 1_000_000
        assert line["tail_event_id"] == (whole["event_id"].tolist() if last else []) and line["tail_request"] == (whole["request_id"].fillna("").tolist() if last else [])
