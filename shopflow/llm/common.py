"""Small helpers the corpus operators share."""

import pickle

from pyspark import Broadcast, cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

WHITE = " \t\n\x0b\x0c\r"  # the characters of [\x20\x09-\x0D]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def send(spark: SparkSession, value) -> Broadcast:
    """Broadcast of a value with its classes, so that executors need no copy of this package; received() opens it."""
    return spark.sparkContext.broadcast(cloudpickle.dumps(value))


def received(sent: Broadcast):
    return pickle.loads(sent.value)


def bounded_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Rows of an Arrow batch: texts may be long, so a batch must not hold many of them."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def fold_is(key: Column, folds: int, rest: int) -> Column:
    """crc32 of the key as text leaves this rest; a null key is in no fold."""
    return F.coalesce(F.crc32(key.cast("string")) % folds == rest, F.lit(False))


def fresh(frame: DataFrame, name: str) -> str:
    """A column name the frame does not have yet, in either case."""
    taken = {c.lower() for c in frame.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def with_text_digest(docs: DataFrame, text: str, name: str) -> DataFrame:
    """Column of the SHA-256 of the text's UTF-8; null counts as empty."""
    return docs.withColumn(name, F.unhex(F.sha2(F.coalesce(F.col(text), F.lit("")), 256)))


def keep_rows(docs: DataFrame, kept: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Rows of docs whose (id, text digest) is listed in kept (columns _id, _digest), all columns unchanged.

    Rows that repeat both an id and a text are one document: one of them stays. A null id matches a null id.
    """
    digest, place = fresh(docs, "_text_digest"), fresh(docs, "_place")
    listed = kept.select(F.col("_id").alias("_kept_id"), F.col("_digest").alias("_kept_digest")).distinct()
    rows = with_text_digest(docs, text, digest)
    same = rows[doc_id].eqNullSafe(listed["_kept_id"]) & (rows[digest] == listed["_kept_digest"])
    once = Window.partitionBy(doc_id, digest).orderBy(F.lit(0))
    return (
        rows.join(listed.hint("merge"), same, "left_semi")
        .withColumn(place, F.row_number().over(once))
        .filter(F.col(place) == 1)
        .drop(digest, place)
    )
