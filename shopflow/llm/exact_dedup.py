"""Exact deduplication by a tree merge of sorted digest runs.

Every input partition is a leaf of a binomial tree. A leaf sorts its digests into a run with one entry per digest: how
many rows have it and which of them stays. In each round the runs of 2**bits neighbouring nodes meet in their parent and
are merged, so an entry that stands in many runs shrinks by that factor per round and a group that holds a third of all
rows costs no task more than 2**bits entries per digest. The runs of a node are themselves dealt out by digest, so the
root is no single task. The root's winners then go back down: first to the leaf runs, then to the rows of each leaf.

An entry is keyed by the SHA-256 of the normalised text and carries a second proof, its byte length and an independent
64-bit hash. Entries only merge where both agree, so the smallest identifier kept at each level is a verified one.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopflow.llm.common import WHITE
from shopflow.plans.storage import materialize

PROOF = ["_digest", "_octets", "_hash"]


def leaf_rows(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """One narrow stored row per document: digests, code points, the leaf it belongs to and a number unique in the table."""
    whole = F.coalesce(F.col(text), F.lit(""))
    bare = F.translate(whole, WHITE, "")
    rows = docs.select(F.col(doc_id).alias("_id"), whole.alias("_text"), bare.alias("_bare")).select(
        "_id",
        F.length("_text").alias("_points"),
        F.unhex(F.sha2("_text", 256)).alias("_text_digest"),
        F.unhex(F.sha2("_bare", 256)).alias("_digest"),
        F.octet_length("_bare").alias("_octets"),
        F.xxhash64("_bare").alias("_hash"),
        F.spark_partition_id().alias("_leaf"),
        F.monotonically_increasing_id().alias("_row"),
    )
    return materialize(rows, "digest-rows")


def merge_runs(entries: DataFrame) -> DataFrame:
    """Entries of the same node, digest and proof become one: rows counted, the smallest identifier kept."""
    return entries.groupBy("_node", *PROOF).agg(F.min("_best").alias("_best"), F.sum("_size").alias("_size"))


def exact_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", bits: int = 4) -> DataFrame:
    """One row per input row: its group of equal texts and whether it stays.

    Texts are equal when identical without the characters [\\x20\\x09-\\x0D]; a null text is empty. Of a group stays the
    row with the most code points, then the smallest id (null last), then one of the rows that repeat that id: exactly one
    row of each group has kept = true. Returns _id, _text_digest (of the whole text), keep_id, group_size, kept,
    text_sha256 (normalised). Other columns of docs are not read. An empty table gives an empty result.
    """
    rows = leaf_rows(docs, doc_id, text)
    leaves = (rows.agg(F.max("_leaf")).first()[0] or 0) + 1
    best = F.struct((-F.col("_points")).alias("p"), F.col("_id").isNull().alias("n"), F.col("_id").alias("id"), F.col("_row").alias("row"))
    leaf_runs = merge_runs(rows.select(F.col("_leaf").alias("_node"), *PROOF, best.alias("_best"), F.lit(1).cast("long").alias("_size")))
    runs, width = leaf_runs, leaves
    while width > 1:
        runs = merge_runs(runs.withColumn("_node", F.shiftright("_node", bits)))
        width = (width + (1 << bits) - 1) >> bits
    winners = runs.select(*PROOF, F.col("_best.id").alias("keep_id"), F.col("_best.row").alias("_keep_row"), F.col("_size").alias("group_size"))
    to_leaves = leaf_runs.select(F.col("_node").alias("_leaf"), *PROOF).join(winners, PROOF)
    return rows.join(to_leaves, ["_leaf", *PROOF]).select(
        "_id",
        "_text_digest",
        "keep_id",
        "group_size",
        (F.col("_row") == F.col("_keep_row")).alias("kept"),
        F.lower(F.hex("_digest")).alias("text_sha256"),
    )
