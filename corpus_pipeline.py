"""Corpus pipeline: stages over the documents, each an operator of shopflow.llm.

Every stage takes all rows its predecessor kept and, but for the last, returns rows of the documents with all columns as
they were. Rows are only left out by the decision of the stage's operator.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopflow.llm import bpe, exact_dedup, lang_id, mixing, near_dedup
from shopflow.llm.common import fresh, keep_rows, table
from shopflow.llm.queries import language_model, word_vocabulary
from shopflow.plans.storage import scratch_path


def in_known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with letters, half of them or more in labelled spans that read like their language; others go.

    Languages are learned from the labelled documents at hand, outside the fold that is held out.
    """
    return lang_id.accepted(docs, language_model(docs))


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    kept = exact_dedup.exact_groups(docs).filter("kept")
    return keep_rows(docs, kept.select("_id", F.col("_text_digest").alias("_digest")), "doc_id", "text")


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates."""
    kept = near_dedup.near_classes(docs).filter("kept")
    return keep_rows(docs, kept.select("_id", "_digest"), "doc_id", "text")


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in the order of the mix, up to the end of it.

    No source may take more than a quarter of the mix; the others keep their proportions. The rows are written in range
    partitions of their position, so the files in order are the mix.
    """
    place, whose = fresh(docs, "_position"), fresh(docs, "_whose")
    placed = mixing.mix(docs).filter("in_mix").groupBy(F.col("_id").alias(whose)).agg(F.min("position").alias(place))
    return (
        docs.join(placed, docs["doc_id"].eqNullSafe(placed[whose]))
        .drop(whose)
        .repartitionByRange(place)
        .sortWithinPartitions(place)
        .drop(place)
    )


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and the digests of ids and decoded text."""
    tokens = bpe.encode_texts(docs, word_vocabulary(), want=("ids", "ids_sha256", "decoded_sha256"))
    return tokens.withColumnRenamed("_id", "doc_id")


STAGES = [
    ("language ID", in_known_language),
    ("exact dedup", without_copies),
    ("near dedup", without_near_copies),
    ("mixing", mixed),
    ("BPE", encoded),
]

# Learned languages, sketches and merges of a vocabulary have no SQL form; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"pipeline-{name.replace(' ', '-')}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
