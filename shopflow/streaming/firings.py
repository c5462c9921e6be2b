"""When the panes of the stream fire: early while they change, once at their close, and for every late revision.

A pane is one entity's events of a tumbling window. While it is open, every trigger (the early-fire interval) in which it
changed fires it; an unchanged pane stays silent. When the watermark passes its last instant it fires once, by an event-time
timer or because a batch shows that the watermark has passed. Each accepted event that arrives after that revises the pane
and fires at once. State goes when no accepted event can come any more. An event is late by the watermark that stood when
it arrived, which the flagged events carry, so the order of firings does not depend on how the stream was cut into batches;
only the early firings do, as the trigger does.
"""

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from shopflow.streaming.config import StreamConfig
from shopflow.streaming.lateness import feature_events

EARLY, CLOSE, LATE = "early", "close", "late"
COUNTS = ["event_count", "views", "carts", "purchases"]
FIELDS = [*COUNTS, "last_us", "revision", "dirty", "closed"]
STATE = "event_count bigint, views bigint, carts bigint, purchases bigint, last_us bigint, revision int, dirty boolean, closed boolean"


def output_schema(key: str) -> str:
    return f"{key} bigint, window_start timestamp, window_end timestamp, firing string, revision int, event_count bigint, views bigint, carts bigint, purchases bigint, last_event_timestamp timestamp"


class PaneFirings(StatefulProcessor):
    """Panes of a bucket of entities: totals of each, whether they changed since they were last shown, and whether it is closed.

    A batch reads and writes the panes it touches, once each; a pane that it ends for good is not stored. Of the panes in the
    state one timer per bucket names the next that is due, and when it fires all that are due are closed or removed.
    """

    def __init__(self, key: str, config: StreamConfig):
        self.key = key
        self.span = config.feature_window_seconds * 1000
        self.allowed = config.allowed_lateness_seconds * 1000
        # Spark's own watermark stays this much behind, or it would drop the late events.
        self.behind = self.allowed + self.span
        self.final = config.drop_late_events  # nothing is added to a pane after its end of life

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.panes = handle.getMapState("panes", "entity bigint, pane_ms bigint", STATE)
        self.due = handle.getValueState("due", "at bigint")

    def _load(self, place: tuple, stored: bool) -> dict:
        held = self.panes.getValue(place) if stored else None
        return dict(zip(FIELDS, (0, 0, 0, 0, None, 0, False, False) if held is None else held, strict=True))

    def _fold(self, pane: dict, row) -> None:
        for name in COUNTS:
            pane[name] += int(getattr(row, name))
        pane["last_us"] = int(row.last_us) if pane["last_us"] is None else max(pane["last_us"], int(row.last_us))
        pane["dirty"] = True

    def _fire(self, place: tuple, pane: dict, kind: str) -> list:
        pane["dirty"] = False
        pane["revision"] += 1
        if kind == CLOSE:
            pane["closed"] = True
        stamp = lambda us: pd.Timestamp(us, unit="us")
        entity, start = place
        return [entity, stamp(start * 1000), stamp((start + self.span) * 1000), kind, pane["revision"], *(pane[n] for n in COUNTS), stamp(pane["last_us"])]

    def _frame(self, rows: list[list]) -> pd.DataFrame:
        return pd.DataFrame(rows, columns=[part.split()[0] for part in output_schema(self.key).split(", ")])

    def _timer(self, end: int, after: int = 0) -> int:
        """Reading of Spark's watermark at which the watermark passes the pane's last instant (and some time more)."""
        return end - 1 + after - self.behind

    def _due(self, place: tuple, pane: dict) -> int:
        """When the pane is to be closed or, once that is done, to be removed."""
        return self._timer(place[1] + self.span, self.span + self.allowed + 1 if pane["closed"] else 0)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        panes: dict[tuple, dict] = {}
        marks: dict[tuple, int] = {}
        late = []
        stored = self.due.get() is not None  # a bucket with panes in the state has a pane that is due
        for batch in rows:
            for row in batch.itertuples(index=False):
                place = (int(row.entity), int(row.pane_ms))
                if place not in panes:
                    panes[place] = self._load(place, stored)
                marks[place] = max(marks.get(place, int(row.watermark_ms)), int(row.watermark_ms))
                if row.after_close:
                    late.append((place, row))
                else:
                    self._fold(panes[place], row)
        out = []
        for place, pane in panes.items():
            if not pane["closed"] and pane["event_count"]:
                if marks[place] >= place[1] + self.span - 1:
                    out.append(self._fire(place, pane, CLOSE))
                elif pane["dirty"]:
                    out.append(self._fire(place, pane, EARLY))
        for place, row in sorted(late, key=lambda r: (r[1].arrival, r[1].event_id)):
            self._fold(panes[place], row)
            out.append(self._fire(place, panes[place], LATE))
            panes[place]["closed"] = True
        first = None
        for place, pane in panes.items():
            if self.final and pane["closed"] and marks[place] >= place[1] + 2 * self.span + self.allowed:
                if pane["revision"] > 1:
                    self.panes.removeKey(place)
                continue
            self.panes.updateValue(place, tuple(pane.values()))
            first = self._due(place, pane) if first is None else min(first, self._due(place, pane))
        self._set(first, timerValues)
        for begin in range(0, len(out), 10_000):
            yield self._frame(out[begin : begin + 10_000])

    def _set(self, at: int | None, timerValues) -> None:
        """One timer per bucket, at the first pane that is due."""
        if at is None:
            return
        at = max(at, timerValues.getCurrentWatermarkInMs() + 1)
        held = self.due.get()
        if held is not None:
            if held[0] <= at:
                return
            self.handle.deleteTimer(int(held[0]))
        self.handle.registerTimer(at)
        self.due.update((at,))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now, out, first = timerValues.getCurrentWatermarkInMs(), [], None
        self.due.clear()
        for place, held in list(self.panes.iterator()):
            place, pane = tuple(map(int, place)), dict(zip(FIELDS, held, strict=True))
            if self._due(place, pane) <= now:
                if pane["closed"]:
                    self.panes.removeKey(place)
                    continue
                out.append(self._fire(place, pane, CLOSE))
                self.panes.updateValue(place, tuple(pane.values()))
            first = self._due(place, pane) if first is None else min(first, self._due(place, pane))
        self._set(first, timerValues)
        for begin in range(0, len(out), 10_000):
            yield self._frame(out[begin : begin + 10_000])

    def close(self) -> None:
        pass


def _pre_totals(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One row per pane for the events that arrived before its close, map-side; later ones stay as they are."""
    for batch in batches:
        early = batch[~batch["after_close"]]
        how = {**{n: "sum" for n in COUNTS}, "last_us": "max", "watermark_ms": "max", "after_close": "first", "arrival": "max", "event_id": "max"}
        totals = early.groupby(["entity", "pane_ms"], as_index=False).agg(how)
        yield pd.concat([totals, batch[batch["after_close"]]], ignore_index=True)[list(batch.columns)]


def firing_rows(flagged: DataFrame, key: str, config: StreamConfig) -> DataFrame:
    """Accepted events as pane rows: whether each came after its pane's close, by the watermark at its arrival.

    That watermark lies late_by_seconds ahead of a late event. watermark_ms is the one after the event's batch.
    """
    at = F.unix_millis("event_timestamp")
    span = config.feature_window_seconds * 1000
    start = at - F.pmod(at, F.lit(span))
    after = F.col("is_late") & (at + F.round(F.col("late_by_seconds") * 1000).cast("bigint") >= start + span - 1)
    count = lambda kind: (F.col("event_type") == kind).cast("bigint")
    return flagged.select(
        F.col(key).alias("entity"), start.alias("pane_ms"), after.alias("after_close"), F.lit(1).cast("bigint").alias("event_count"),
        count("view").alias("views"), count("cart").alias("carts"), count("purchase").alias("purchases"), F.unix_micros("event_timestamp").alias("last_us"),
        F.unix_micros("record_timestamp").alias("arrival"), "event_id", F.coalesce("watermark_ms", F.lit(-(1 << 62))).alias("watermark_ms"),
    )


def pane_firings(flagged: DataFrame, key: str, config: StreamConfig) -> DataFrame:
    """Stream of firings: entity, pane, firing, revision and totals.

    The watermark follows all flagged events, also those that count for no feature. Events before the close are summed
    per task first, so a hot entity sends one row per pane, task and Arrow batch, and its state is one row of totals.
    """
    delay = config.watermark_delay_seconds + config.allowed_lateness_seconds + config.feature_window_seconds
    marked = flagged.withWatermark("event_timestamp", f"{delay} seconds")
    rows = firing_rows(feature_events(marked, config), key, config)
    bucket = F.pmod(F.xxhash64("entity"), F.lit(config.state_buckets)).cast("int")
    return (
        rows.mapInPandas(_pre_totals, rows.schema)
        .withColumn("_bucket", bucket)
        .groupBy("_bucket")
        .transformWithStateInPandas(PaneFirings(key, config), output_schema(key), "Append", "EventTime")
    )
