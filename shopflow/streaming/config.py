"""Settings of the event stream."""

from dataclasses import dataclass, replace


@dataclass(frozen=True)
class StreamConfig:
    topic: str = "cdc.behavior_events"
    watermark_delay_seconds: int = 3600
    allowed_lateness_seconds: int = 300
    quality_window_seconds: int = 60
    feature_window_seconds: int = 60
    burst_threshold: int = 500
    drop_late_events: bool = True
    dead_letters: bool = True
    state_ttl_seconds: int = 7 * 86400
    dedup_ttl_seconds: int = 86400
    max_history_length: int = 50
    early_fire_seconds: int = 5
    # Seen ids are kept in buckets, a few times the number of shuffle partitions; copies of one id are
    # spread over salts before they meet. Both belong to the checkpoint and must not change later.
    dedup_buckets: int = 64
    dedup_salts: int = 4
    state_buckets: int = 1024  # buckets of entities with rolling state or panes; belongs to the checkpoint too
    sink_buckets: int = 8  # hash buckets of each day of a keyed sink; part of the stored table
    online: bool = True
    offline: bool = True

    def for_partitions(self, parts: int) -> "StreamConfig":
        """Buckets for a stream of so many partitions: a few for each, as every bucket is a call of Python in each batch."""
        return replace(self, dedup_buckets=4 * parts, state_buckets=min(self.state_buckets, 16 * parts))

    @property
    def role(self) -> str:
        """Which feature sinks the job feeds."""
        return {(True, True): "hybrid", (True, False): "online", (False, True): "offline"}.get(
            (self.online, self.offline), "disabled"
        )


def trigger(config: StreamConfig, replay: bool) -> dict:
    """Micro-batch trigger: everything available for a replay, else the early-fire interval."""
    return {"availableNow": True} if replay else {"processingTime": f"{config.early_fire_seconds} seconds"}
