"""Intermediate tables in the cluster's shared folder.

Lineage is cut by writing Parquet there and reading it back, never by a local checkpoint: the
files survive the loss of executors and keep column pruning for later stages.
"""

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


_LOCAL_FOLDERS: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """Folder named by spark.checkpoint.dir; where that is unset, a temporary one for a local master only."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if context.applicationId not in _LOCAL_FOLDERS:
        _LOCAL_FOLDERS[context.applicationId] = tempfile.mkdtemp(prefix="shopflow-")
    return _LOCAL_FOLDERS[context.applicationId]


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def materialize(frame: DataFrame, label: str = "stage", path: str | None = None) -> DataFrame:
    """Write the frame once and continue from the written files.

    A path of the caller's is overwritten, so that work which repeats without end keeps one copy.
    """
    spark = frame.sparkSession
    target = path or scratch_path(spark, label)
    frame.write.mode("overwrite").parquet(target)
    return spark.read.schema(frame.schema).parquet(target)
