"""The event stream: change records to flagged events, quality windows and rolling features.

Every hop is a query of its own with its own checkpoint. A hop writes each batch into a folder named by
the batch id and finishes with a marker, so a repeated batch leaves one copy.
"""

import copy
import time
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from shopflow.operators.online import newest_wins
from shopflow.plans.hot_keys import top_k
from shopflow.sources import cdc
from shopflow.streaming import firings, lateness, sinks, state
from shopflow.streaming.config import StreamConfig, trigger

RECORD_SCHEMA = "value string, record_timestamp timestamp"
EVENT_SCHEMA = (
    "record_timestamp timestamp, event_id string, event_timestamp timestamp, user_id bigint, product_id bigint, event_type string,"
    " event_type_id int, category_id bigint, brand_id bigint, price double, price_bucket int, session_id string, request_id string,"
    " impression_id string, payload_hash string, is_duplicate boolean, late_by_seconds double, is_late boolean, is_too_late boolean,"
    " watermark_ms bigint, processed_timestamp timestamp"
)
MARKER_SCHEMA = "batch bigint, highest_ms bigint, rows bigint"


class StreamJob:
    """The stream's queries over one root folder of the shared file system."""

    def __init__(self, spark: SparkSession, root: str, config: StreamConfig | None = None):
        self.spark, self.root, self.config = spark, root.rstrip("/"), config or StreamConfig()
        self.upto: int | None = None  # last batch of flagged events that the hops behind may take

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))

    def _progress(self, hop: str, batch: int | None = None) -> tuple[bool, int | None]:
        """Whether the batch is done, and the highest event time (ms) of all done batches."""
        try:
            markers = self.spark.read.schema(MARKER_SCHEMA).option("recursiveFileLookup", "true").json(self.path(f"_done/{hop}"))
        except AnalysisException:  # nothing done yet
            return False, None
        facts = markers.agg(F.max(F.col("batch") == F.lit(batch)).alias("done"), F.max("highest_ms").alias("highest")).first()
        return bool(facts["done"]), facts["highest"]

    def _done(self, hop: str, batch: int) -> bool:
        """Whether the batch is done, from its own marker alone."""
        try:
            return not self.spark.read.schema(MARKER_SCHEMA).json(self.path(f"_done/{hop}/{batch}")).isEmpty()
        except AnalysisException:  # no marker
            return False

    def _finish(self, hop: str, batch: int, highest: int | None = None, rows: int = 0) -> None:
        facts = F.lit(batch).alias("batch"), F.lit(highest).cast("bigint").alias("highest_ms"), F.lit(rows).alias("rows")
        self.spark.range(0, 1, 1, 1).select(*facts).write.mode("overwrite").json(self.path(f"_done/{hop}/{batch}"))

    def _write(self, frame: DataFrame, name: str, batch: int) -> None:
        frame.write.mode("overwrite").parquet(f"{self.path(name)}/batch_id={batch}")

    def keyed(self, name: str) -> sinks.KeyedTable:
        """A table of the stream that is merged by key."""
        return sinks.keyed_table(self.spark, name, self.path(name if name == "stream_late_events_dlq" else f"offline/{name}"), self.config)

    def _start(self, stream: DataFrame, hop: str, sink, mode: str, replay: bool) -> StreamingQuery:
        return (
            stream.writeStream.foreachBatch(sink)
            .outputMode(mode)
            .option("checkpointLocation", self.path(f"_checkpoints/{hop}"))
            .trigger(**trigger(self.config, replay))
            .start()
        )

    # Hop 1: records to flagged events

    def flag_events(self, records: DataFrame, replay: bool = True) -> StreamingQuery:
        """Unwrap, normalize, mark duplicates and lateness; write events and dead letters."""
        events = cdc.normalize(records).withColumn("session_id", F.coalesce("session_id", F.lit("")))
        seen = state.mark_seen(events, self.config)
        return self._start(seen, "events", self._flag_batch, "append", replay)

    def _flag_batch(self, batch: DataFrame, batch_id: int) -> None:
        done, before = self._progress("events", batch_id)
        if done:
            return
        batch.persist()
        try:
            facts = batch.agg(F.max(F.unix_millis("event_timestamp")).alias("h"), F.count(F.lit(1)).alias("n")).first()
            highest = max([h for h in (facts["h"], before) if h is not None], default=None)
            after = F.lit(None if highest is None else highest - self.config.watermark_delay_seconds * 1000).cast("bigint")
            flagged = lateness.classify(lateness.mark_duplicates(batch), self.config, before, self.path("_scratch/arrival"))
            flagged = flagged.withColumns({"watermark_ms": after, "processed_timestamp": F.current_timestamp()})
            columns = [part.split()[0] for part in EVENT_SCHEMA.split(", ")]
            self._write(flagged.select(*columns), "stream_behavior_events", batch_id)
            written = batch.sparkSession.read.schema(EVENT_SCHEMA).parquet(f"{self.path('stream_behavior_events')}/batch_id={batch_id}")
            if self.config.dead_letters:
                letters = lateness.dead_letters(written, self.config, F.current_timestamp())
                self.keyed("stream_late_events_dlq").merge(letters, batch_id, self.path("_staging/stream_late_events_dlq"))
            self._finish("events", batch_id, highest, facts["n"])
        finally:
            batch.unpersist()

    def up_to(self, batch: int) -> "StreamJob":
        """The job as its hops behind the flagged events see it after that batch of events, whatever has been flagged since."""
        part = copy.copy(self)
        part.upto = batch
        return part

    def last_batch(self, hop: str = "events") -> int | None:
        """The last batch of a hop that is done."""
        try:
            return self.spark.read.schema(MARKER_SCHEMA).option("recursiveFileLookup", "true").json(self.path(f"_done/{hop}")).agg(F.max("batch")).first()[0]
        except AnalysisException:  # nothing done yet
            return None

    def flagged_stream(self) -> DataFrame:
        path = self.path("stream_behavior_events")
        if self.upto is not None:
            path = f"{path}/batch_id={{{','.join(map(str, range(self.upto + 1)))}}}"
        columns = [part.split()[0] for part in EVENT_SCHEMA.split(", ")]
        return self.spark.readStream.schema(EVENT_SCHEMA).parquet(path).select(*columns)

    # Hop 2a: quality windows

    def quality_windows(self, replay: bool = True) -> StreamingQuery:
        """Windows re-emitted whenever accepted events change them; state is kept for delay plus allowed lateness."""
        keep = self.config.watermark_delay_seconds + self.config.allowed_lateness_seconds + self.config.quality_window_seconds
        events = self.flagged_stream().withWatermark("event_timestamp", f"{keep} seconds")
        windows = lateness.quality_counts(events, self.config)
        return self._start(windows, "quality", self._sink("streaming_quality_windows"), "update", replay)

    def current_quality_windows(self) -> DataFrame:
        """Last revision of every window, with the number of its events that came too late, copies included."""
        newest = top_k(self.table("streaming_quality_windows"), ["topic", "window_start"], [F.desc("batch_id")], 1, "_rank")
        span = self.config.quality_window_seconds
        start = F.window("event_timestamp", f"{span} seconds")["start"].alias("window_start")
        late = self.table("stream_behavior_events").filter("is_too_late").groupBy(start).agg(F.count(F.lit(1)).alias("side_output_late_events"))
        joined = newest.drop("_rank", "batch_id").join(late, "window_start", "left")
        sent = F.coalesce("side_output_late_events", F.lit(0))
        dropped = sent if self.config.drop_late_events else F.lit(0)
        return joined.withColumn("side_output_late_events", sent).withColumn("late_events_dropped", dropped)

    def user_panes(self, replay: bool = True) -> StreamingQuery:
        """Tumbling panes per user; a pane is emitted again whenever an event revises it."""
        keep = self.config.watermark_delay_seconds + self.config.allowed_lateness_seconds + self.config.feature_window_seconds
        events = lateness.feature_events(self.flagged_stream(), self.config).withWatermark("event_timestamp", f"{keep} seconds")
        return self._start(lateness.panes(events, "user_id", self.config), "panes", self._sink("stream_user_panes"), "update", replay)

    def current_panes(self) -> DataFrame:
        newest = top_k(self.table("stream_user_panes"), ["user_id", "window_start"], [F.desc("batch_id")], 1, "_rank")
        return self.with_finality(newest.drop("_rank", "batch_id"))

    # Hop 2b: rolling features

    def user_features(self, replay: bool = True) -> StreamingQuery:
        kept = lateness.feature_events(self.flagged_stream(), self.config)
        updates = state.rolling_user_features(kept, self.config)
        return self._start(updates, "users", self._sink("stream_user_features"), "update", replay)

    def item_features(self, replay: bool = True) -> StreamingQuery:
        kept = lateness.feature_events(self.flagged_stream(), self.config)
        updates = state.rolling_item_features(kept, self.config)
        return self._start(updates, "items", self._sink("stream_item_features"), "update", replay)

    def _sink(self, name: str):
        """Append-only feature log per batch, for the sinks that the job's role asks for."""

        def write(batch: DataFrame, batch_id: int) -> None:
            if self._done(name, batch_id):
                return
            if name.startswith("streaming") or self.config.offline or self.config.online:
                self._write(batch, name, batch_id)
                if self.config.offline:
                    self._merge_rows(name, batch_id)
            self._finish(name, batch_id)

        return write

    def _merge_rows(self, name: str, batch_id: int) -> None:
        """Feature rows of a written batch into the offline tables, one row per source event."""
        tables = {
            "stream_user_features": {"stream_user_sequence_features": sinks.user_sequence_rows, "stream_user_aggregate_features": sinks.user_aggregate_rows},
            "stream_item_features": {"stream_item_features": sinks.item_rows},
        }.get(name, {})
        if tables:
            written = self.spark.read.parquet(f"{self.path(name)}/batch_id={batch_id}")

            def merge(table: str) -> None:
                self.keyed(table).merge(tables[table](written, self.config), batch_id, self.path(f"_staging/{table}"))

            with ThreadPoolExecutor(len(tables)) as beside:
                list(beside.map(merge, tables))

    def contract_table(self, name: str) -> DataFrame:
        """One of the stream's six tables with the columns of its contract."""
        if name == "stream_behavior_events":
            return sinks.behavior_rows(self.table(name), self.config)
        if name == "streaming_quality_windows":
            windows = self.current_quality_windows().withColumn("created_timestamp", F.current_timestamp())
            return windows.select(*sinks.QUALITY_COLUMNS)
        return self.keyed(name).read()

    # Firings

    def firings(self, key: str, replay: bool = True, last: bool = True) -> StreamingQuery:
        """Early, closing and late firings of the panes of users or items. A replay that is not the last leaves its due timers to the next."""
        events = firings.pane_firings(self.flagged_stream(), key, self.config)
        # Timers of the last batch need one more batch without data; a query takes the setting with it when it starts.
        name = "spark.sql.streaming.noDataMicroBatches.enabled"
        before = self.spark.conf.get(name)
        self.spark.conf.set(name, "true" if last else before)
        try:
            return self._start(events, f"firings_{key}", self._sink(f"stream_firings_{key}"), "append", replay)
        finally:
            self.spark.conf.set(name, before)

    def with_finality(self, features: DataFrame) -> DataFrame:
        """is_final: the watermark has passed the last instant of the feature row's window."""
        highest = self._progress("events")[1]
        if highest is None:
            return features.withColumn("is_final", F.lit(False))
        watermark = highest - self.config.watermark_delay_seconds * 1000
        return features.withColumn("is_final", F.lit(watermark) >= F.unix_millis("window_end") - 1)

    # Sinks

    def online_view(self, name: str, key: str, view: str) -> DataFrame:
        """Newest feature row per entity as sorted JSON with its expiry."""
        rows = self.table(name)
        fields = sorted(c for c in rows.columns if c not in ("batch_id", "late_revision"))
        payload = rows.select(
            key, F.col("feature_timestamp").alias("updated_at"), F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}).alias("payload")
        )
        return newest_wins(None, payload, key, view)

    def offline_rows(self, name: str, key: str) -> DataFrame:
        """Feature history keyed by its source event: the last revision of each."""
        newest = top_k(self.table(name), [key, "event_id"], [F.desc("batch_id")], 1, "_rank")
        return newest.drop("_rank", "batch_id")

    def start_behind(self, *also: Callable[[], StreamingQuery]) -> list[StreamingQuery]:
        """Start the hops behind the flagged events, `also` with them, beside each other."""
        queries = [self.quality_windows()]
        if self.config.role != "disabled":
            queries += [self.user_features(), self.item_features()]
        return queries + [start() for start in also]

    def run_all(self, records: DataFrame, *also: Callable[[], StreamingQuery]) -> None:
        """Replay what is available through every hop. The hops behind the flagged events run beside each other, `also` with them."""
        self.flag_events(records).awaitTermination()
        finish(self.start_behind(*also))


def input_listed(queries: list[StreamingQuery]) -> None:
    """Wait until replays have listed their input, which ends with the files there were at that time; later ones are left to the next replay."""
    for query in queries:
        while query.isActive and not query.status["isTriggerActive"] and query.lastProgress is None:
            time.sleep(0.02)


def finish(queries: list[StreamingQuery]) -> None:
    for query in queries:
        query.awaitTermination()


def bounded_prefix(events: DataFrame, n: int) -> DataFrame:
    """First n rows of a stream."""
    return events.limit(n)


def union_updates(users: DataFrame, items: DataFrame) -> DataFrame:
    """User and item updates as one stream of (kind, entity, time)."""
    head = lambda frame, kind, key: frame.select(
        F.lit(kind).alias("kind"), F.col(key).alias("entity_id"), "feature_timestamp", "event_id"
    )
    return head(users, "user", "user_id").unionByName(head(items, "item", "product_id"))
