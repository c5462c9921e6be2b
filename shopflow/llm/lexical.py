"""Ranked lexical search by presence masks.

A block of documents holds, for every query term, a bitmap of the documents with the term. For an item its terms' bitmaps
are laid side by side, so that each document reads as a mask of matched terms, and equal masks form a group. A group's
score has a ceiling: the weights of its terms, each with the highest saturation the term reaches in the block. Groups are
evaluated from the highest ceiling down, and an item is finished once the next ceiling lies below its k-th best score.
The blocks' best documents are then merged per item.
"""

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shopflow.llm.common import bounded_batches
from shopflow.plans.storage import scratch_path

# Every byte that is no letter, digit or part of a character beyond ASCII parts terms; only A-Z are lower-cased.
PARTING = bytes(b if chr(b).isalnum() and b < 128 or b >= 128 else 32 for b in bytes(range(256)).lower())
PIECE = 1 << 20  # bytes of a text that are cut into terms at once
TOGETHER = 64  # documents evaluated between two looks at the next ceiling


def terms_of(text: str | None) -> Iterator[list[bytes]]:
    """The terms of a whole text, in lists of bounded size."""
    data = (text or "").encode("utf-8", "surrogatepass").translate(PARTING)
    begin = 0
    while begin < len(data):
        end = data.find(b" ", begin + PIECE)
        end = len(data) if end < 0 else end
        yield data[begin:end].split()
        begin = end


def count_terms(docs: DataFrame, wanted: list[bytes], doc_id: str, text: str) -> DataFrame:
    """Per document its number of terms, and the wanted terms it holds (by number) with their counts."""
    sent = docs.sparkSession.sparkContext.broadcast(wanted)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = {t: i for i, t in enumerate(sent.value)}
        for batch in batches:
            sizes, held, often = [], [], []
            for whole in batch.column("_text").to_pylist():
                size, found = 0, Counter()
                for terms in terms_of(whole):
                    size += len(terms)
                    found.update(filter(None.__ne__, map(place.get, terms)))
                order = sorted(found)
                sizes.append(size)
                held.append(order)
                often.append([found[t] for t in order])
            columns = [batch.column("_id"), pa.array(sizes, pa.int64()), pa.array(held, pa.list_(pa.int32())), pa.array(often, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, ["_id", "_size", "_terms", "_often"])

    rows = docs.select(F.col(doc_id).cast("long").alias("_id"), F.col(text).alias("_text"))
    return rows.mapInArrow(count, "_id long, _size long, _terms array<int>, _often array<long>")


def presence_masks(bitmaps: list[np.ndarray], size: int) -> np.ndarray:
    """Matched-term mask of each document, 64 terms a column, from one bitmap of documents per term."""
    masks = np.zeros((size, -(-len(bitmaps) // 64)), dtype=np.uint64)
    for i, bitmap in enumerate(bitmaps):
        masks[:, i // 64] |= np.unpackbits(bitmap, count=size).astype(np.uint64) << np.uint64(i % 64)
    return masks


class Block:
    """Documents with their postings of query terms, ready to be searched."""

    def __init__(self, ids: np.ndarray, starts: np.ndarray, terms: np.ndarray, values: np.ndarray, n_terms: int):
        self.ids, self.starts, self.terms, self.values = ids, starts, terms, values
        owner = np.repeat(np.arange(len(ids)), np.diff(starts))
        order = np.argsort(terms, kind="stable")
        self.by_term = owner[order]
        self.edges = np.searchsorted(terms[order], np.arange(n_terms + 1))
        self.highest = np.zeros(n_terms, dtype=np.int64)
        np.maximum.at(self.highest, terms, values)
        self.bitmaps: dict[int, np.ndarray] = {}

    def bitmap(self, term: int) -> np.ndarray:
        """Documents that hold the term, one bit each."""
        if term not in self.bitmaps:
            held = np.zeros(len(self.ids), dtype=bool)
            held[self.by_term[self.edges[term] : self.edges[term + 1]]] = True
            self.bitmaps[term] = np.packbits(held)
        return self.bitmaps[term]

    def scores(self, chosen: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """Exact scores of the chosen documents, none of which is without postings."""
        sizes = self.starts[chosen + 1] - self.starts[chosen]
        ends = np.cumsum(sizes)
        at = np.arange(ends[-1]) + np.repeat(self.starts[chosen] - (ends - sizes), sizes)
        return np.add.reduceat(weights[self.terms[at]] * self.values[at], ends - sizes)

    def search(self, terms: np.ndarray, weights: np.ndarray, best: list[tuple[int, int]], k: int) -> tuple[list[tuple[int, int]], int]:
        """The k best (-score, id) of the block and of those known before, and how many documents were evaluated.

        weights holds a number for every query term, 0 for those that are not the item's.
        """
        terms = np.array([t for t in terms if weights[t] > 0 and self.edges[t + 1] > self.edges[t]], dtype=np.int64)
        if not len(terms):
            return best, 0
        masks = presence_masks([self.bitmap(t) for t in terms], len(self.ids))
        if masks.shape[1] == 1:
            distinct, group = np.unique(masks[:, 0], return_inverse=True)
            distinct = distinct[:, None]
        else:
            distinct, group = np.unique(masks, axis=0, return_inverse=True)
        bits = np.unpackbits(distinct.astype("<u8").view(np.uint8), axis=1, count=len(terms), bitorder="little")
        ceilings = bits.astype(np.int64) @ (weights[terms] * self.highest[terms])
        falling = np.argsort(-ceilings, kind="stable")
        members = np.argsort(group.ravel(), kind="stable")
        edges = np.searchsorted(group.ravel()[members], np.arange(len(distinct) + 1))
        seen, at = 0, 0
        while at < len(falling):
            least = -best[k - 1][0] if len(best) >= k else 1
            chosen = []
            while at < len(falling) and len(chosen) < TOGETHER and ceilings[falling[at]] >= least:
                chosen.extend(members[edges[falling[at]] : edges[falling[at] + 1]])
                at += 1
            if not chosen:
                break
            chosen = np.array(chosen)
            found = self.scores(chosen, weights)
            seen += len(chosen)
            good = np.flatnonzero(found >= least)
            best = sorted(best + list(zip((-found[good]).tolist(), self.ids[chosen[good]].tolist(), strict=True)))[:k]
        return best, seen


def _list_column(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    offsets = column.offsets.to_numpy().astype(np.int64)
    return offsets - offsets[0], column.flatten().to_numpy(zero_copy_only=False)


def best_of_blocks(counted: DataFrame, items: list[Counter], weights: list[int], documents: int, words: int, k: int) -> DataFrame:
    """Best documents of every task's blocks for each item (by number): _item, doc_id, score."""
    sent = counted.sparkSession.sparkContext.broadcast(([dict(i) for i in items], weights))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries, weight_of = sent.value
        n_terms = len(weight_of)
        best: list[list[tuple[int, int]]] = [[] for _ in queries]
        for batch in batches:
            starts, terms = _list_column(batch.column("_terms"))
            _, often = _list_column(batch.column("_often"))
            if not len(terms):
                continue
            often = often.astype(np.int64)
            long = 100 - 25 + (25 * batch.column("_size").to_numpy().astype(np.int64) * documents) // words
            values = (1_000_000_000 * often) // (1000 * often + 12 * np.repeat(long, np.diff(starts)))
            block = Block(batch.column("_id").to_numpy(), starts, terms.astype(np.int64), values, n_terms)
            for i, query in enumerate(queries):
                own = np.zeros(n_terms, dtype=np.int64)
                for t, times in query.items():
                    own[t] = times * weight_of[t]
                best[i], _ = block.search(np.fromiter(query, dtype=np.int64, count=len(query)), own, best[i], k)
        rows = [(i, d, -s) for i, found in enumerate(best) for s, d in found]
        columns = [pa.array([r[c] for r in rows], kind) for c, kind in enumerate((pa.int32(), pa.int64(), pa.int64()))]
        yield pa.RecordBatch.from_arrays(columns, ["_item", "doc_id", "score"])

    return counted.mapInArrow(search, "_item int, doc_id long, score long")


def _item_blocks(items: DataFrame, item_id: str, text: str, at_once: int) -> Iterator[list[tuple]]:
    rows = items.select(item_id, text).distinct().orderBy(item_id, text).toLocalIterator()
    block, held = [], 0
    for row in rows:
        terms = Counter(t for part in terms_of(row[1]) for t in part)
        if terms:
            block.append((row[0], terms))
            held += len(terms)
        if held >= at_once:
            yield block
            block, held = [], 0
    if block:
        yield block


def ranked_search(
    docs: DataFrame,
    items: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    k: int = 20,
    terms_at_once: int = 200_000,
    block_rows: int = 4096,
) -> DataFrame:
    """The k documents with the highest scores above 0 for each item: item_id, rank, doc_id, score.

    Terms are runs of ASCII letters and digits and of characters beyond ASCII in the whole text, with A-Z lower-cased; a
    null text has none. All scores are exact whole numbers; equal ones rank by id. Items are asked in blocks of about
    terms_at_once distinct terms, which bounds what is sent to the tasks; each block reads the documents once. Rows that
    repeat an id are documents each; a document without an id counts in the statistics but is not ranked. Items that
    repeat an id and a text are asked once; an item without terms, an empty table of items or of documents gives no rows.
    Other columns are not read.
    """
    spark: SparkSession = docs.sparkSession
    target = scratch_path(spark, "ranked")
    kind = items.schema[item_id].dataType.simpleString()
    spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long").write.parquet(target)
    for block in _item_blocks(items, item_id, item_text, terms_at_once):
        wanted = sorted(set().union(*(terms for _, terms in block)))
        place = {t: i for i, t in enumerate(wanted)}
        bounded_batches(spark, 256)
        counts = scratch_path(spark, "term-counts")
        count_terms(docs, wanted, doc_id, text).write.parquet(counts)
        counted = spark.read.parquet(counts)
        documents, words = counted.filter("_size > 0").agg(F.count(F.lit(1)), F.sum("_size")).first()
        if not documents:
            continue
        holding = dict(counted.select(F.explode("_terms").alias("t")).groupBy("t").count().collect())  # at most one row per wanted term
        weights = [math.floor(1000 * math.log((2 * documents + 2) / (2 * holding.get(i, 0) + 1))) for i in range(len(wanted))]
        bounded_batches(spark, block_rows)
        numbered = [Counter({place[t]: n for t, n in terms.items()}) for _, terms in block]
        found = best_of_blocks(counted.filter(F.col("_id").isNotNull()), numbered, weights, documents, words, k)
        order = Window.partitionBy("_item").orderBy(F.desc("score"), "doc_id")
        top = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
        names = spark.createDataFrame([(i, name) for i, (name, _) in enumerate(block)], f"_item int, item_id {kind}")
        top.join(F.broadcast(names), "_item").select("item_id", "rank", "doc_id", "score").write.mode("append").parquet(target)
    return spark.read.schema(f"item_id {kind}, rank int, doc_id long, score long").parquet(target)
