"""Session settings the jobs rely on."""

from pyspark.sql import SparkSession

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

# Safe to set on a running session; cluster sizing (executors, memory, shuffle partitions)
# stays with whoever submits the job.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.parquet.compression.codec": "zstd",
    # Rows with long texts: bound the batches that go to Python by bytes, not only by rows.
    "spark.sql.execution.arrow.maxBytesPerBatch": "8388608",
}


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = "*", app: str = "shopflow", shuffle_partitions: int = 8) -> SparkSession:
    """Single-machine session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for key, value in RUNTIME_CONF.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


ROWS_A_STATE = 50_000  # records of a replay whose state one partition takes
LEAST_STATES = 12


def state_partitions(spark: SparkSession, rows: int | None = None) -> int:
    """Partitions of a stateful stream; their number is fixed by the first run of a query.

    A cluster's setting is taken as it stands, also while executors are still joining. Only a single machine, which has no
    more cores to come, bounds it by them. Every partition costs a Python worker, a state store and a commit in each batch
    of each hop, so a replay of a known number of records has no more of them than its records ask for.
    """
    wanted = int(spark.conf.get("spark.sql.shuffle.partitions"))
    if rows is not None:
        wanted = min(wanted, max(LEAST_STATES, -(-rows // ROWS_A_STATE)))
    if spark.sparkContext.master.startswith("local["):
        wanted = min(wanted, max(4, spark.sparkContext.defaultParallelism))
    return wanted


def streaming_session(spark: SparkSession, rows: int | None = None) -> SparkSession:
    """Sibling session for stateful streams, so their settings do not leak into batch work. rows: records of a bounded replay."""
    sibling = spark.newSession()
    prepare(sibling)
    sibling.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    # A commit writes what the batch changed; whole copies of a store follow in the background.
    sibling.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
    # State that expires by the clock would otherwise ask for empty batches without end, and a replay
    # that stops at the newest record would never stop.
    sibling.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", "false")
    sibling.conf.set("spark.sql.shuffle.partitions", str(state_partitions(spark, rows)))
    return sibling
