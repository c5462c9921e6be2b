"""Keyed state of the stream: seen ids and rolling entity features."""

import pickle
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from shopflow.operators.features import EVENT_TYPE_IDS
from shopflow.streaming.config import StreamConfig

MICROS = 1_000_000


class _IdTree:
    """Ids of a bucket and when each was first met, in leaves that a batch reads and writes once.

    A leaf of more than MOST ids is split 16 ways by the next digit of the id's CRC-32, so the bytes written follow the ids of
    the batch and not those known. A split place stays as a mark; it is written again with any leaf below, so that it
    does not expire before them. No more than about HELD ids are in memory at a time.
    """

    MOST, DEEPEST, HELD = 256, 8, 200_000

    def __init__(self, stored, now: int, ttl_ms: int):
        self.stored, self.now, self.ttl_ms = stored, now, ttl_ms
        self.leaves: dict[tuple, dict | None] = {}
        self.changed: set[tuple] = set()
        self.held = 0

    def met(self, name: str) -> bool:
        """Whether the id is known; if not, it is from now on."""
        place, leaf = self._leaf(name)
        if leaf.get(name, -self.ttl_ms) + self.ttl_ms > self.now:
            return True
        leaf[name] = self.now
        self.changed.add(place)
        self.held += 1
        return False

    def _leaf(self, name: str) -> tuple[tuple, dict]:
        digits = zlib.crc32(name.encode())
        for level in range(self.DEEPEST + 1):
            place = (level, digits & (16**level - 1))
            if place not in self.leaves:
                packed = self.stored.getValue(place)
                self.leaves[place] = {} if packed is None else pickle.loads(packed[0])
                self.held += len(self.leaves[place] or ())
            if self.leaves[place] is not None:
                return place, self.leaves[place]
        raise AssertionError("the deepest leaves are never split")

    def save(self) -> None:
        marks = set()
        for level, at in self.changed:
            marks |= {(above, at & (16**above - 1)) for above in range(level)}
            self._write(level, at, {n: first for n, first in self.leaves[level, at].items() if first + self.ttl_ms > self.now})
        for mark in marks:
            self.stored.updateValue(mark, (pickle.dumps(None),))
        self.leaves, self.changed, self.held = {}, set(), 0

    def _write(self, level: int, at: int, leaf: dict) -> None:
        whole = len(leaf) <= self.MOST or level == self.DEEPEST
        self.stored.updateValue((level, at), (pickle.dumps(leaf if whole else None),))
        if not whole:
            parts: dict[int, dict] = {}
            for name, first in leaf.items():
                parts.setdefault(zlib.crc32(name.encode()) & (16 ** (level + 1) - 1), {})[name] = first
            for part, ids in parts.items():
                self._write(level + 1, part, ids)


class _SeenIds(StatefulProcessor):
    """Flags rows whose id was met in an earlier batch; an id expires a fixed time after its first sight.

    A key is a bucket of ids, so that Python sees frames of many rows and asks the state once per
    leaf of ids. Only candidate rows ask; the other copies pass through.
    """

    def __init__(self, ttl_seconds: int):
        self.ttl_seconds = ttl_seconds

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getMapState("seen", "level int, place bigint", "packed binary", self.ttl_seconds * 1000)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        own = {"_bucket": key[0], "_route": key[1]}  # frames come without their key columns
        if key[1] >= 0:
            for batch in rows:
                yield batch.assign(**own)
            return
        tree = _IdTree(self.seen, timerValues.getCurrentProcessingTimeInMs(), self.ttl_seconds * 1000)
        fresh: set[str] = set()  # ids first met in this batch
        for batch in rows:
            known = {}
            for name in batch["event_id"].unique():
                known[name] = name not in fresh and tree.met(name)
                if not known[name]:
                    fresh.add(name)
                if tree.held > tree.HELD:
                    tree.save()
            yield batch.assign(seen_before=batch["event_id"].map(known).astype(bool), **own)
        tree.save()

    def close(self) -> None:
        pass


def _first_copies(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Route -1 for the first copy of an id in a batch of rows; other copies keep a route of their own."""
    for batch in batches:
        yield batch.assign(_route=batch["_route"].where(batch["event_id"].duplicated(), -1))


def mark_seen(events: DataFrame, config: StreamConfig) -> DataFrame:
    """Add seen_before: the id occurred in an earlier batch within the time to live.

    Before the shuffle each task lets one copy per id and batch of rows through to the state; the
    remaining copies only ride along, spread over salts. A hot id thus reaches its task in single rows.
    The flag of an id is the one of any of its copies.
    """
    bucket = F.pmod(F.xxhash64("event_id"), F.lit(config.dedup_buckets)).cast("int")
    salt = F.pmod(F.xxhash64(*events.columns), F.lit(config.dedup_salts)).cast("int")
    tagged = events.withColumn("seen_before", F.lit(False)).withColumn("_bucket", bucket).withColumn("_route", salt)
    routed = tagged.mapInPandas(_first_copies, tagged.schema)
    judged = routed.groupBy("_bucket", "_route").transformWithStateInPandas(
        _SeenIds(config.dedup_ttl_seconds), tagged.schema, "Append", "ProcessingTime"
    )
    return judged.drop("_bucket", "_route")


# Seconds of a span and of its slots: seconds of a minute, minutes of an hour, hours of a day.
SPANS = ((60, 1), (3600, 60), (86400, 3600))
SLOTS = (
    "slot array<int>, views array<bigint>, carts array<bigint>, purchases array<bigint>, viewed_cents array<bigint>,"
    " category_slot array<int>, category array<bigint>"
)
INSTANTS = "at array<bigint>, views array<bigint>, carts array<bigint>, purchases array<bigint>"
TAIL = (
    "at array<bigint>, event_id array<string>, item array<bigint>, kind array<int>, category array<bigint>,"
    " brand array<bigint>, bucket array<int>, request array<string>, impression array<string>"
)
_TAIL_FIELDS = ["at", "event_id", "item", "kind", "category", "brand", "bucket", "request", "impression"]
VIEW, CART, PURCHASE = (EVENT_TYPE_IDS[k] for k in ("view", "cart", "purchase"))

USER_OUTPUT = (
    "user_id bigint, feature_timestamp timestamp, event_id string, views_30m int, carts_30m int, purchases_24h int,"
    " distinct_categories_7d int, avg_viewed_price_7d double, cart_to_purchase_ratio_7d double, hist_item_ids array<bigint>,"
    " hist_event_type_ids array<int>, hist_category_ids array<bigint>, hist_brand_ids array<bigint>,"
    " hist_price_bucket_ids array<int>, hist_request_ids array<string>, hist_impression_ids array<string>, hist_event_micros array<bigint>, hist_length int,"
    " window_start timestamp, window_end timestamp, late_revision boolean"
)
ITEM_OUTPUT = (
    "product_id bigint, feature_timestamp timestamp, event_id string, category_id bigint, brand_id bigint, price_bucket int,"
    " is_active boolean, views_1h int, views_24h int, carts_1h int, carts_24h int, purchases_24h int, purchases_7d int,"
    " conversion_rate_7d double, popularity_score double, window_start timestamp, window_end timestamp, late_revision boolean"
)


class Totals:
    """Counts by kind, cents of viewed prices and categories of a stretch of time."""

    __slots__ = ("counts", "categories")

    def __init__(self, counts=(0, 0, 0, 0), categories=()):
        self.counts, self.categories = list(counts), set(categories)

    def add(self, other: "Totals") -> None:
        self.counts = [x + y for x, y in zip(self.counts, other.counts)]
        self.categories |= other.categories


class _RollingPanes(StatefulProcessor):
    """Panes of an entity at four levels: instants of a second, seconds of a minute, minutes of an hour, hours of a day.

    Input rows are totals made before the shuffle. Each adds to one pane of every level (an accepted late row revises old
    panes), and days beyond the retention go with all that lies below them. A horizon is the sum of what follows its lower
    end in the one second, minute, hour and day the end falls into, and of whole days after that, so it reads as many panes
    as there are levels and days, however many events the entity has. A batch yields one row per entity: the features as of
    its newest event.
    """

    columns: list[str]

    def __init__(self, config: StreamConfig):
        self.pane = config.feature_window_seconds * MICROS
        self.retention = config.state_ttl_seconds * MICROS
        self.keep = max(1, config.max_history_length)
        self.ttl = config.state_ttl_seconds * 1000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.instants = handle.getMapState("instants", "second bigint", INSTANTS, self.ttl)
        self.slots = handle.getMapState("slots", "span int, start bigint", SLOTS, self.ttl)
        self.days = handle.getValueState("days", "start array<bigint>", self.ttl)
        self.tail = handle.getValueState("tail", TAIL, self.ttl)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        newest_before, late = self.newest(), False
        for batch in rows:
            late = self.take(_listed(batch)) or late
        features = self.features(key[0], newest_before, late)
        if features is not None:
            yield pd.DataFrame({name: [features[name]] for name in self.columns})

    def newest(self) -> tuple | None:
        """Time and id of the newest event."""
        tail = self._tail()
        return (tail["at"][-1], tail["event_id"][-1]) if tail["at"] else None

    def _tail(self) -> dict:
        return dict(zip(_TAIL_FIELDS, map(list, self.tail.get()))) if self.tail.exists() else {f: [] for f in _TAIL_FIELDS}

    def _days(self) -> set[int]:
        return {int(d) for d in self.days.get()[0]} if self.days.exists() else set()

    def take(self, rows: list[dict]) -> bool:
        """Add rows of totals; whether one of them is late."""
        self.days.update((sorted(self._days() | self._fold(rows)),))
        tail = self._extend(self._tail(), rows)
        self.tail.update(tuple(tail[f] for f in _TAIL_FIELDS))
        return any(r["is_late"] for r in rows)

    def features(self, entity: int, newest_before: tuple | None, late: bool) -> dict | None:
        """The features as of the newest event, once a batch has been added; drops what lies beyond the retention."""
        tail, days = self._tail(), self._days()
        if not tail["at"]:
            return None
        at = tail["at"][-1]
        last_pane = at - at % self.pane
        oldest = last_pane + self.pane - self.retention
        for day in [d for d in days if d + SPANS[-1][0] * MICROS <= oldest]:
            self._drop(len(SPANS) - 1, day)
            days.remove(day)
        self.days.update((sorted(days),))
        first = next(i for i, t in enumerate(tail["at"]) if t >= oldest)
        tail = {f: values[first:] for f, values in tail.items()}
        self.tail.update(tuple(tail[f] for f in _TAIL_FIELDS))
        revised = newest_before is not None and (tail["at"][-1], tail["event_id"][-1]) == newest_before
        retained = self.since(oldest, days)
        within = lambda seconds: self.since(at - seconds * MICROS + 1, days).counts[:3]
        frame = self.payload(entity, retained, within, tail)
        stamp = lambda micros: pd.Timestamp(micros, unit="us")
        frame.update(
            feature_timestamp=stamp(at), event_id=tail["event_id"][-1], window_start=stamp(last_pane),
            window_end=stamp(last_pane + self.pane), late_revision=late or revised,
        )
        return frame

    def _fold(self, rows: list[dict]) -> set[int]:
        """Add rows of totals to every level; returns the days they fall into."""
        added: dict[int, Totals] = {}
        instants: dict[int, dict[int, list[int]]] = {}
        for row in rows:
            second = int(row["second"])
            if second not in instants:
                known = self.instants.getValue((second,)) if self.instants.containsKey((second,)) else ([], [], [], [])
                instants[second] = {int(at): [int(n) for n in counts] for at, *counts in zip(*known)}
            of, sums = instants[second], [0, 0, 0]
            for at, *counts in zip(row["times"], row["views"], row["carts"], row["purchases"]):
                held = of.get(at, (0, 0, 0))
                of[at] = [x + y for x, y in zip(held, counts)]
                sums = [x + y for x, y in zip(sums, counts)]
            added.setdefault(second, Totals()).add(Totals((*sums, int(row["cents"])), row["categories"]))
        for second, of in instants.items():
            times = sorted(of)
            self.instants.updateValue((second,), (times, *([of[at][i] for at in times] for i in range(3))))
        for span, step in SPANS:
            wider: dict[int, Totals] = {}
            spans: dict[int, dict[int, Totals]] = {}
            for start, fresh in added.items():
                whole = start - start % (span * MICROS)
                if whole not in spans:
                    spans[whole] = self._read(span, whole)
                spans[whole].setdefault((start - whole) // (step * MICROS), Totals()).add(fresh)
                wider.setdefault(whole, Totals()).add(fresh)
            for whole, slots in spans.items():
                self._write(span, whole, slots)
            added = wider
        return set(added)

    def _read(self, span: int, start: int) -> dict[int, Totals]:
        if not self.slots.containsKey((span, start)):
            return {}
        slot, *counts, category_slot, category = self.slots.getValue((span, start))
        out = {int(s): Totals(map(int, c)) for s, *c in zip(slot, *counts)}
        for s, c in zip(category_slot, category):
            out[int(s)].categories.add(int(c))
        return out

    def _write(self, span: int, start: int, slots: dict[int, Totals]) -> None:
        counts = [list(kind) for kind in zip(*(t.counts for t in slots.values()))]
        listed = [(slot, c) for slot, t in slots.items() for c in sorted(t.categories)]
        self.slots.updateValue((span, start), (list(slots), *counts, [s for s, _ in listed], [c for _, c in listed]))

    def _drop(self, level: int, start: int) -> None:
        if level < 0:
            self.instants.removeKey((start,))
            return
        span, step = SPANS[level]
        for slot in self._read(span, start):
            self._drop(level - 1, start + slot * step * MICROS)
        self.slots.removeKey((span, start))

    def since(self, start: int, days: set[int]) -> Totals:
        """Totals of the events at start or later; cents and categories only if start is a whole second."""
        out = Totals()
        second = start - start % MICROS
        if start > second:
            if self.instants.containsKey((second,)):
                for at, *counts in zip(*self.instants.getValue((second,))):
                    if at >= start:
                        out.add(Totals((*map(int, counts), 0)))
            start = second + MICROS
        for span, step in SPANS:
            whole = start - start % (span * MICROS)
            if start > whole:
                self._sum(out, span, step, whole, start)
                start = whole + span * MICROS
        for day in days:
            if day >= start:
                self._sum(out, *SPANS[-1], day, day)
        return out

    def _sum(self, out: Totals, span: int, step: int, whole: int, start: int) -> None:
        for slot, totals in self._read(span, whole).items():
            if whole + slot * step * MICROS >= start:
                out.add(totals)

    def _extend(self, tail: dict, rows: list[dict]) -> dict:
        lines = list(zip(*[tail[f] for f in _TAIL_FIELDS]))
        for row in rows:
            lines += zip(*[row[f"tail_{f}"] for f in _TAIL_FIELDS])
        lines = sorted(lines, key=lambda r: (r[0], r[1]))[-self.keep :]
        return {f: [r[i] for r in lines] for i, f in enumerate(_TAIL_FIELDS)}

    def close(self) -> None:
        pass


def _listed(batch: pd.DataFrame) -> list[dict]:
    """Rows with their arrays as lists of plain values."""
    columns = {
        name: [v.tolist() if isinstance(v, np.ndarray) else v for v in batch[name]] if batch[name].dtype == object else batch[name].tolist()
        for name in batch.columns
    }
    return [dict(zip(columns, row)) for row in zip(*columns.values())]


class _Cell:
    """A value of one entity in memory."""

    def __init__(self, value=None):
        self.value = value

    def exists(self) -> bool:
        return self.value is not None

    def get(self):
        return self.value

    def update(self, value) -> None:
        self.value = value


class _Pages:
    """Panes of one entity by day: a page of few panes is one entry of the state. A fuller day has a page for each hour, and the
    panes of a fuller hour are entries of their own. A parted page stays as a mark, written again with what lies below it."""

    LEVELS = tuple(span * MICROS for span, _ in reversed(SPANS[1:]))

    def __init__(self, entity, shared, maps: dict):
        self.entity, self.shared, self.maps = entity, shared, maps
        self.held: dict[tuple, dict | None] = {}
        self.changed: set[tuple] = set()

    def of(self, at: int, change: bool = False) -> dict | None:
        """The page that the time falls into, or None if its panes are entries of their own."""
        page = None
        for span in self.LEVELS:
            place = (span, at - at % span)
            if place not in self.held:
                stored = self.shared.getValue((self.entity, *place))
                self.held[place] = {} if stored is None else pickle.loads(stored[0])
            if change:
                self.changed.add(place)
            page = self.held[place]
            if page is not None:
                break
        return page

    def end(self, span: int, start: int) -> None:
        """The last pane of a parted page is gone."""
        self.held[span * MICROS, start] = {}
        self.changed.add((span * MICROS, start))

    def size(self) -> int:
        return sum(len(p) for p in self.held.values() if p) + len(self.held)

    def save(self, most: int) -> None:
        for place in self.changed:
            self._write(place, self.held[place], most)
        self.changed = set()

    def _write(self, place: tuple, page: dict | None, most: int) -> None:
        if page is not None and len(page) > most:
            below = self.LEVELS[self.LEVELS.index(place[0]) + 1 :]
            parts: dict[tuple, dict] = {}
            for (name, *key), value in page.items():
                if below:
                    parts.setdefault((below[0], key[-1] - key[-1] % below[0]), {})[name, *key] = value
                else:
                    self.maps[name].updateValue((self.entity, *key), value)
            for part, own in parts.items():
                self._write(part, own, most)
            page = None
        self.held[place] = page
        if page == {}:
            self.shared.removeKey((self.entity, *place))
        else:
            self.shared.updateValue((self.entity, *place), (pickle.dumps(page),))


class _Part:
    """One entity's part of a map state: in memory while the entity is small, in pages later; days are entries of the shared map."""

    def __init__(self, entity, name: str, shared, small: dict | None, pages: _Pages):
        self.entity, self.name, self.shared, self.small, self.pages = entity, name, shared, small, pages
        self.asked = (None, None)  # key asked last and its value

    def _page(self, key, change: bool = False) -> dict | None:
        whole_day = len(key) > 1 and key[0] == SPANS[-1][0]
        return None if whole_day else self.pages.of(key[-1], change)

    def _find(self, key):
        if self.small is not None:
            return self.small.get(key)
        page = self._page(key)
        if page is not None:
            return page.get((self.name, *key))
        if self.asked[0] != key:
            self.asked = (key, self.shared.getValue((self.entity, *key)))
        return self.asked[1]

    def containsKey(self, key) -> bool:
        return self._find(key) is not None

    def getValue(self, key):
        return self._find(key)

    def updateValue(self, key, value) -> None:
        if self.small is not None:
            self.small[key] = value
            return
        page = self._page(key, change=True)
        if page is not None:
            page[self.name, *key] = value
        else:
            self.asked = (None, None)
            self.shared.updateValue((self.entity, *key), value)

    def removeKey(self, key) -> None:
        if self.small is not None:
            self.small.pop(key, None)
            return
        page = self._page(key, change=True)
        if page is not None:
            page.pop((self.name, *key), None)
        else:
            self.asked = (None, None)
            self.shared.removeKey((self.entity, *key))
        if len(key) > 1 and (key[0] == SPANS[-1][0] or page is None and key[0] == SPANS[1][0]):
            self.pages.end(*key)  # the pane of the whole page is the last to go

    def spill(self) -> None:
        small, self.small = self.small, None
        for key, value in small.items():
            self.updateValue(key, value)


class _Held:
    """State of one entity, in the place of a handle."""

    def __init__(self, entity, packed: tuple | None, maps: dict, pages):
        days, tail, small = pickle.loads(packed[0]) if packed else (None, None, {name: {} for name in maps})
        self.pages = _Pages(entity, pages, maps)
        self.parts = {name: _Part(entity, name, shared, small[name] if small is not None else None, self.pages) for name, shared in maps.items()}
        self.cells = {"days": _Cell(days), "tail": _Cell(tail)}

    def getMapState(self, name, *_):
        return self.parts[name]

    def getValueState(self, name, *_):
        return self.cells[name]

    def _own(self) -> int:
        return sum(len(p.small) for p in self.parts.values() if p.small is not None)

    def size(self) -> int:
        return self._own() + self.pages.size()

    def packed(self, most: int) -> tuple:
        """What is kept under the entity's own key; its panes too while there are no more than `most`."""
        if self._own() > most:
            for part in self.parts.values():
                part.spill()
        self.pages.save(most)
        small = None if any(p.small is None for p in self.parts.values()) else {name: p.small for name, p in self.parts.items()}
        return (pickle.dumps((self.cells["days"].value, self.cells["tail"].value, small)),)


class RollingBuckets(StatefulProcessor):
    """Rolling panes of the entities of a bucket: the state is asked once and told once per entity and batch.

    Python sees frames of many entities and gives one frame for all. An entity of few panes is one entry of the state; with
    more than SMALL it has one entry per day, a day with more than SMALL one per hour, and the panes of an hour with more than
    SMALL are entries of their own. A batch touches those it needs. Of a batch no more panes than MEMORY are held at a time:
    beyond that what was added goes to the state and is read again for the result.
    """

    SMALL, MEMORY = 512, 200_000

    def __init__(self, rolling: _RollingPanes, key: str):
        self.rolling, self.key = rolling, key

    def init(self, handle: StatefulProcessorHandle) -> None:
        ttl = self.rolling.ttl
        self.entities = handle.getMapState("entities", "entity bigint", "packed binary", ttl)
        self.maps = {
            "instants": handle.getMapState("instants", "entity bigint, second bigint", INSTANTS, ttl),
            "slots": handle.getMapState("slots", "entity bigint, span int, start bigint", SLOTS, ttl),
        }
        self.pages = handle.getMapState("pages", "entity bigint, span bigint, start bigint", "packed binary", ttl)

    def _load(self, entity) -> _Held:
        return _Held(entity, self.entities.getValue((entity,)), self.maps, self.pages)

    def _save(self, entity, held: _Held) -> None:
        self.entities.updateValue((entity,), held.packed(self.SMALL))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        held: dict[int, _Held] = {}
        facts: dict[int, list] = {}  # newest event before the batch, and whether a row was late
        for batch in rows:
            of: dict[int, list[dict]] = {}
            for row in _listed(batch):
                of.setdefault(row[self.key], []).append(row)
            for entity, own in of.items():
                if entity not in held:
                    held[entity] = self._load(entity)
                self.rolling.init(held[entity])
                facts.setdefault(entity, [self.rolling.newest(), False])
                facts[entity][1] |= self.rolling.take(own)
            if sum(h.size() + 1 for h in held.values()) > self.MEMORY:
                for entity, state in held.items():
                    self._save(entity, state)
                held = {}
        out = []
        for entity, (newest_before, late) in facts.items():
            state = held.pop(entity, None) or self._load(entity)
            self.rolling.init(state)
            features = self.rolling.features(entity, newest_before, late)
            self._save(entity, state)
            if features is not None:
                out.append(features)
            if len(out) >= 5000:
                yield pd.DataFrame(out, columns=self.rolling.columns)
                out = []
        if out:
            yield pd.DataFrame(out, columns=self.rolling.columns)

    def close(self) -> None:
        pass


class UserRolling(_RollingPanes):
    columns = [part.split()[0] for part in USER_OUTPUT.split(", ")]

    def payload(self, user: int, retained: Totals, within, tail: dict) -> dict:
        views, carts, purchases, cents = retained.counts
        short = within(1800)
        return {
            "user_id": user,
            "views_30m": short[0],
            "carts_30m": short[1],
            "purchases_24h": within(86400)[2],
            "distinct_categories_7d": len(retained.categories),
            "avg_viewed_price_7d": cents / 100 / views if views else 0.0,
            "cart_to_purchase_ratio_7d": purchases / carts if carts else 0.0,
            "hist_item_ids": tail["item"], "hist_event_type_ids": tail["kind"], "hist_category_ids": tail["category"],
            "hist_brand_ids": tail["brand"], "hist_price_bucket_ids": tail["bucket"], "hist_request_ids": tail["request"],
            "hist_impression_ids": tail["impression"], "hist_event_micros": tail["at"], "hist_length": len(tail["at"]),
        }


class ItemRolling(_RollingPanes):
    columns = [part.split()[0] for part in ITEM_OUTPUT.split(", ")]

    def payload(self, item: int, retained: Totals, within, tail: dict) -> dict:
        week_views, week_purchases = retained.counts[0], retained.counts[2]
        (views_1h, carts_1h, _), (views, carts, purchases) = within(3600), within(86400)
        return {
            "product_id": item, "category_id": tail["category"][-1], "brand_id": tail["brand"][-1], "price_bucket": tail["bucket"][-1],
            "is_active": True, "views_1h": views_1h, "views_24h": views, "carts_1h": carts_1h, "carts_24h": carts,
            "purchases_24h": purchases, "purchases_7d": week_purchases,
            "conversion_rate_7d": (week_purchases + 1.0) / (week_views + 10.0),
            "popularity_score": float(views + 3 * carts + 10 * purchases),
        }


_TAIL_COLUMNS = dict(
    zip(_TAIL_FIELDS, ("at", "event_id", "product_id", "event_type_id", "category_id", "brand_id", "price_bucket", "request_id", "impression_id"))
)
PRE_TOTALS = (
    "second bigint, times array<bigint>, views array<bigint>, carts array<bigint>, purchases array<bigint>, cents bigint,"
    " categories array<bigint>, is_late boolean, " + ", ".join(f"tail_{part.strip()}" for part in TAIL.split(", "))
)


def _starts(*columns: np.ndarray) -> np.ndarray:
    """Where runs of equal values begin, in sorted columns."""
    differs = np.zeros(len(columns[0]) - 1, dtype=bool)
    for values in columns:
        differs |= values[1:] != values[:-1]
    return np.concatenate([[0], np.flatnonzero(differs) + 1])


def _runs(values: list, starts: np.ndarray, ends: np.ndarray) -> list[list]:
    return [values[begin:end] for begin, end in zip(starts.tolist(), ends.tolist())]


def _pre_totals(key: str, keep: int):
    """Totals per entity and second of each batch of rows; the newest `keep` events ride on the entity's newest second."""

    def combine(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            rows = rows.dropna(subset=[key, "at"]).sort_values([key, "at", "event_id"], ignore_index=True)
            if rows.empty:
                continue
            rows = rows.assign(request_id=rows["request_id"].fillna(""), impression_id=rows["impression_id"].fillna(""))
            entity, at, kind = (rows[c].to_numpy().astype("int64") for c in (key, "at", "event_type_id"))
            second = at - at % MICROS
            instants, seconds, entities = _starts(entity, at), _starts(entity, second), _starts(entity)
            ends = np.append(seconds[1:], len(rows))
            first = np.searchsorted(instants, seconds)  # of the instants of each second
            last = np.append(first[1:], len(instants))
            listed = lambda values: _runs(values.tolist(), first, last)
            count = lambda which: listed(np.add.reduceat((kind == which).astype("int64"), instants))
            cents = np.where(kind == VIEW, rows["cents"].fillna(0).to_numpy().astype("int64"), 0)
            out = pd.DataFrame({
                key: entity[seconds], "second": second[seconds], "times": listed(at[instants]), "views": count(VIEW), "carts": count(CART),
                "purchases": count(PURCHASE), "cents": np.add.reduceat(cents, seconds),
                "is_late": np.logical_or.reduceat(rows["is_late"].to_numpy().astype(bool), seconds),
                "categories": [list(dict.fromkeys(run)) for run in _runs(rows["category_id"].tolist(), seconds, ends)],
            })
            until = np.append(entities[1:], len(rows))
            newest = (np.searchsorted(seconds, until) - 1).tolist()  # each entity's newest second
            for name, column in _TAIL_COLUMNS.items():
                tails: list[list] = [[] for _ in range(len(out))]
                for place, tail in zip(newest, _runs(rows[column].tolist(), np.maximum(entities, until - keep), until)):
                    tails[place] = tail
                out[f"tail_{name}"] = tails
            yield out

    return combine


def rolling_input(events: DataFrame, key: str, config: StreamConfig) -> DataFrame:
    """Totals per entity and second, summed in the tasks that read the events, so that a hot entity crosses the shuffle as
    totals; prices as whole cents so sums are exact."""
    rows = events.select(
        "event_id", "user_id", "product_id", "event_type_id", "category_id", "brand_id", "price_bucket", "request_id", "impression_id",
        "is_late", F.unix_micros("event_timestamp").alias("at"), F.round(F.col("price") * 100).cast("bigint").alias("cents"),
    )
    return rows.mapInPandas(_pre_totals(key, max(1, config.max_history_length)), f"{key} bigint, {PRE_TOTALS}")


def rolling_features(events: DataFrame, key: str, rolling: _RollingPanes, output: str, config: StreamConfig) -> DataFrame:
    rows = rolling_input(events, key, config)
    bucket = F.pmod(F.xxhash64(key), F.lit(config.state_buckets)).cast("int")
    return rows.withColumn("_bucket", bucket).groupBy("_bucket").transformWithStateInPandas(
        RollingBuckets(rolling, key), output, "Update", "ProcessingTime"
    )


def rolling_user_features(events: DataFrame, config: StreamConfig) -> DataFrame:
    return rolling_features(events, "user_id", UserRolling(config), USER_OUTPUT, config)


def rolling_item_features(events: DataFrame, config: StreamConfig) -> DataFrame:
    return rolling_features(events, "product_id", ItemRolling(config), ITEM_OUTPUT, config)
