"""Versioned tables on Parquet: key merge, commits, time travel, savepoints.

A version is a folder of Parquet files; commits are small JSON files beside it. A commit file is
written last, so readers never see half a version.
"""

import json

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopflow.plans.hot_keys import top_k

DELETED = "is_deleted"
COMMIT_SCHEMA = "run_id string, version int, upserts bigint, deletes bigint, rows bigint, saved boolean"


def delta(existing: DataFrame, incoming: DataFrame, keys: list[str], order: str, at: str) -> DataFrame:
    """Upserts plus tombstones for the keys that the incoming state no longer has."""
    gone = existing.join(incoming.select(*keys).distinct(), keys, "left_anti")
    tombstones = gone.withColumn(DELETED, F.lit(True)).withColumn(order, F.lit(at).cast("timestamp"))
    return incoming.withColumn(DELETED, F.lit(False)).unionByName(tombstones)


def merge(existing: DataFrame | None, changes: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Newest row per key by the ordering column, changes winning ties, deleted keys removed.

    Rows of one key meet by key alone, so a row may move between partitions of the table. Copies of a
    hot key are pruned before the shuffle.
    """
    if DELETED not in changes.columns:
        changes = changes.withColumn(DELETED, F.lit(False))
    rows = changes.withColumn("_turn", F.lit(1))
    if existing is not None:
        kept = existing if DELETED in existing.columns else existing.withColumn(DELETED, F.lit(False))
        rows = kept.withColumn("_turn", F.lit(0)).unionByName(rows)
    newest = top_k(rows, keys, [F.desc(order), F.desc("_turn")], 1, "_rank")
    return newest.filter(~F.col(DELETED)).drop("_rank", "_turn", DELETED)


def insert_missing(existing: DataFrame | None, rows: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key is new; the first of repeated keys."""
    once = rows.dropDuplicates(keys)
    return once if existing is None else once.join(existing.select(*keys), keys, "left_anti")


def sample_rows(frame: DataFrame, split: str, event_time: str, run_ts: str, keys: list[str]) -> DataFrame:
    """Rows ready for a version: keys checked, split and timestamps attached."""
    check_keys(frame, keys)
    return (
        frame.withColumn("split", F.col(split))
        .withColumn("event_timestamp", F.timestamp_seconds(F.col(event_time)))
        .withColumn("source_updated_at", F.lit(run_ts).cast("timestamp"))
    )


def check_keys(frame: DataFrame, keys: list[str]) -> None:
    """Refuse an empty input, null keys and repeated keys. One combined aggregate, three numbers back."""
    empty = F.lit(False)
    for key in keys:
        empty = empty | F.col(key).isNull()
    per_key = frame.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    facts = per_key.agg(F.sum("n").alias("rows"), F.count_if(empty).alias("nulls"), F.count_if(F.col("n") > 1).alias("repeated")).first()
    if not facts["rows"]:
        raise ValueError("the input is empty")
    if facts["nulls"]:
        raise ValueError(f"null in key columns {keys}")
    if facts["repeated"]:
        raise ValueError(f"{facts['repeated']} keys repeat in {keys}")


class VersionedTable:
    """A keyed table whose every commit is a readable version."""

    def __init__(self, spark: SparkSession, root: str, keys: list[str], order: str):
        self.spark, self.root, self.keys, self.order = spark, root.rstrip("/"), keys, order

    def commits(self) -> DataFrame:
        try:
            log = self.spark.read.schema(COMMIT_SCHEMA).json(f"{self.root}/_commits")
        except AnalysisException:  # no commit yet, so no folder
            return self.spark.createDataFrame([], COMMIT_SCHEMA)
        # A savepoint is a second line for the version with saved set.
        return log.groupBy("version").agg(
            *[F.first(c, True).alias(c) for c in ("run_id", "upserts", "deletes", "rows")], F.max("saved").alias("saved")
        )

    def _history(self) -> list:
        return self.commits().orderBy("version").collect()  # one row per commit

    def read(self, version: int | None = None) -> DataFrame | None:
        """The newest version, or an older one."""
        known = [c["version"] for c in self._history()]
        if not known:
            return None
        chosen = known[-1] if version is None else version
        if chosen not in known:
            raise ValueError(f"version {chosen} does not exist")
        return self.spark.read.parquet(f"{self.root}/version={chosen}")

    def commit(self, state: DataFrame, run_id: str, at: str) -> dict:
        """Make the table equal to the state. A run id that was committed before changes nothing."""
        history = self._history()
        for done in history:
            if done["run_id"] == run_id:
                return {"version": done["version"], "upserts": 0, "deletes": 0, "rows": done["rows"], "repeated": True}
        version = history[-1]["version"] + 1 if history else 1
        existing = self.read()
        changes = state.withColumn(DELETED, F.lit(False)) if existing is None else delta(existing, state, self.keys, self.order, at)
        stored = f"{self.root}/_changes/{version}"
        changes.write.mode("overwrite").parquet(stored)
        changes = self.spark.read.parquet(stored)
        counts = changes.agg(F.count_if(~F.col(DELETED)).alias("u"), F.count_if(DELETED).alias("d")).first()
        target = f"{self.root}/version={version}"
        merge(existing, changes, self.keys, self.order).write.mode("overwrite").parquet(target)
        rows = self.spark.read.parquet(target).count()
        entry = {"run_id": run_id, "version": version, "upserts": counts["u"], "deletes": counts["d"], "rows": rows}
        self._log({**entry, "saved": False})
        return {**entry, "repeated": False}

    def savepoint(self, version: int) -> None:
        """Keep a version through later cleaning."""
        if version not in [c["version"] for c in self._history()]:
            raise ValueError(f"version {version} does not exist")
        self._log({"version": version, "saved": True})

    def removable(self, keep: int) -> list[int]:
        """Versions that cleaning may drop: all but the newest ones and the saved ones."""
        history = self._history()
        return [c["version"] for c in history[: max(len(history) - keep, 0)] if not c["saved"]]

    def _log(self, entry: dict) -> None:
        line = self.spark.createDataFrame([(json.dumps(entry),)], "value string")
        line.coalesce(1).write.mode("append").text(f"{self.root}/_commits")


def changes_between(old: DataFrame, new: DataFrame, keys: list[str], digest: str) -> DataFrame:
    """Counts of added, removed, changed and unchanged keys between two versions."""
    a = old.select(*keys, F.col(digest).alias("_old"))
    b = new.select(*keys, F.col(digest).alias("_new"))
    kind = (
        F.when(F.col("_old").isNull(), "added").when(F.col("_new").isNull(), "removed")
        .when(F.col("_old") != F.col("_new"), "changed").otherwise("unchanged")
    )
    return a.join(b, keys, "full").groupBy(kind.alias("kind")).agg(F.count(F.lit(1)).alias("keys"))
