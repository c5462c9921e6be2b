"""Document fingerprints by a homomorphic multiset hash.

Every paragraph is hashed to a wide vector, and a document's fingerprint is the sum of its paragraphs' vectors modulo powers
of two. The order of paragraphs therefore does not matter, and a paragraph is inserted into or deleted from a fingerprint
by adding or subtracting its vector, without the rest of the text. The vector has two parts: 8 lanes modulo 2**64 that are
uniform in the whole paragraph and serve equality, and 256 lanes modulo 2**16 in which every pair of neighbouring words of
the paragraph counts +1 or -1 in one lane. The cosine of two such counts estimates that of the pairs themselves, so two
fingerprints also say how alike their documents are; its error is about 0.06.
"""

import base64
import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shopflow.llm.common import bounded_batches
from shopflow.plans.ordering import range_ordered

EQUAL_LANES, LIKE_LANES = 8, 256
# Every byte of white space of a paragraph parts words.
WHITE_BYTES = np.isin(np.arange(256), list(b" \t\n\x0b\x0c\r"))
FACTOR, MIX = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93  # odd constants of the word hash
POWERS = np.cumprod(np.full(4096, FACTOR, dtype=np.uint64), dtype=np.uint64)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(MIX)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(MIX)
    return x ^ (x >> np.uint64(32))


def word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and begin of every word of some bytes."""
    inside = ~WHITE_BYTES[data]
    edges = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8)))
    begins, ends = edges[::2], edges[1::2]
    if not len(begins):
        return np.zeros(0, dtype=np.uint64), begins
    starts = np.zeros(len(data), dtype=np.int64)
    starts[begins] = begins
    at = np.arange(len(data)) - np.maximum.accumulate(starts)
    parts = np.where(inside, (data.astype(np.uint64) + np.uint64(1)) * POWERS[at % len(POWERS)] + (at // len(POWERS)).astype(np.uint64), np.uint64(0))
    return _mixed(np.add.reduceat(parts, begins) + (ends - begins).astype(np.uint64)), begins


def likeness_lanes(text: str) -> np.ndarray:
    """Signed counts of the neighbouring words of each paragraph; a paragraph of one word counts that word."""
    data = np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8)
    hashes, begins = word_hashes(data)
    if not len(hashes):
        return np.zeros(LIKE_LANES, dtype=np.uint16)
    paragraph = np.searchsorted(np.flatnonzero(data == 10), begins)
    joined = paragraph[1:] == paragraph[:-1]
    pairs = _mixed(hashes[:-1] * np.uint64(FACTOR) + hashes[1:])[joined]
    alone = np.concatenate([[True], ~joined]) & np.concatenate([~joined, [True]])
    units = np.concatenate([pairs, hashes[alone]])
    lanes, signs = (units & np.uint64(LIKE_LANES - 1)).astype(np.int64), np.where(units >> np.uint64(63), 1.0, -1.0)
    return np.bincount(lanes, weights=signs, minlength=LIKE_LANES).astype(np.int64).astype(np.uint16)


def equality_lanes(text: str) -> np.ndarray:
    total = np.zeros(EQUAL_LANES, dtype=np.uint64)
    digests = b"".join(hashlib.blake2b(p.encode("utf-8", "surrogatepass"), digest_size=64).digest() for p in text.split("\n") if p)
    if digests:
        total += np.frombuffer(digests, dtype="<u8").reshape(-1, EQUAL_LANES).sum(axis=0, dtype=np.uint64)
    return total


class Fingerprint:
    """Sum of the vectors of a multiset of paragraphs."""

    __slots__ = ("equal", "like")

    def __init__(self, equal: np.ndarray, like: np.ndarray):
        self.equal, self.like = equal, like

    @classmethod
    def of(cls, text: str | None) -> "Fingerprint":
        """Fingerprint of a text's paragraphs, which end at line feeds; empty ones count nothing."""
        return cls(equality_lanes(text or ""), likeness_lanes(text or ""))

    def __add__(self, other: "Fingerprint") -> "Fingerprint":
        return Fingerprint(self.equal + other.equal, self.like + other.like)

    def __sub__(self, other: "Fingerprint") -> "Fingerprint":
        return Fingerprint(self.equal - other.equal, self.like - other.like)

    def __eq__(self, other: object) -> bool:
        return isinstance(other, Fingerprint) and bool((self.equal == other.equal).all() and (self.like == other.like).all())

    __hash__ = None

    def __str__(self) -> str:
        return base64.b64encode(self.equal.astype("<u8").tobytes() + self.like.astype("<u2").tobytes()).decode()

    @classmethod
    def parse(cls, written: str) -> "Fingerprint":
        data = base64.b64decode(written)
        cut = EQUAL_LANES * 8
        return cls(np.frombuffer(data[:cut], dtype="<u8").astype(np.uint64), np.frombuffer(data[cut:], dtype="<u2").astype(np.uint16))

    def likeness(self, other: "Fingerprint") -> float:
        """1 for equal fingerprints, else the estimated cosine of the word pairs, between 0 and 1."""
        if self == other:
            return 1.0
        a, b = self.like.view(np.int16).astype(np.float64), other.like.view(np.int16).astype(np.float64)
        size = float(np.sqrt((a @ a) * (b @ b)))
        return min(1.0, max(0.0, float(a @ b) / size)) if size else 0.0


def edited(text: str, following: str) -> str:
    """The last half of the text (rounded down) replaced by as many code points of the following text, or all it has."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def fingerprint_texts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprint of every row's whole text: _id, fingerprint. A null text is empty; an empty table gives no rows."""
    bounded_batches(docs.sparkSession, 256)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            written = [str(Fingerprint.of(t)) for t in batch.column("_text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("_id"), pa.array(written, pa.string())], ["_id", "fingerprint"])

    rows = docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("_text"))
    return rows.mapInArrow(run, f"_id {rows.schema['_id'].dataType.simpleString()}, fingerprint string")


def merge_fingerprints(prints: DataFrame, keys: list[str], fingerprint: str = "fingerprint") -> DataFrame:
    """Sum of the fingerprints of each group, as of one text that holds all their paragraphs.

    Sums are taken per task first and then per key, so a key that holds a third of all rows sends one row per task.
    """

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple, Fingerprint] = {}
        kinds: list = []

        def out():
            columns = [pa.array([k[i] for k in sums], kind) for i, kind in enumerate(kinds)]
            return pa.RecordBatch.from_arrays([*columns, pa.array([str(f) for f in sums.values()], pa.string())], [*keys, fingerprint])

        for batch in batches:
            kinds = [batch.column(k).type for k in keys]
            found = zip(zip(*(batch.column(k).to_pylist() for k in keys), strict=True), batch.column(fingerprint).to_pylist(), strict=True)
            for key, written in found:
                if written is not None:
                    one = Fingerprint.parse(written)
                    sums[key] = sums[key] + one if key in sums else one
            if len(sums) >= 50_000:
                yield out()
                sums.clear()
        if sums:
            yield out()

    rows = prints.select(*keys, fingerprint)
    partial = rows.mapInArrow(add_up, rows.schema)
    # Keys lie in the partitions of their hash; of each, at most a row per task and 50,000 other keys comes together.
    return partial.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(_merge_sorted(keys, fingerprint), rows.schema)


def _merge_sorted(keys: list[str], fingerprint: str):
    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, total = None, None
        for batch in batches:
            kinds = [batch.column(k).type for k in keys]
            done = []
            for key, written in zip(zip(*(batch.column(k).to_pylist() for k in keys), strict=True), batch.column(fingerprint).to_pylist(), strict=True):
                one = Fingerprint.parse(written)
                if total is not None and key == last:
                    total = total + one
                else:
                    if total is not None:
                        done.append((*last, str(total)))
                    last, total = key, one
            if done:
                yield pa.RecordBatch.from_arrays([pa.array([d[i] for d in done], t) for i, t in enumerate([*kinds, pa.string()])], [*keys, fingerprint])
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip((*last, str(total)), [*kinds, pa.string()], strict=True)], [*keys, fingerprint])

    return merge


def _places(docs: DataFrame, key, parts: int):
    """Number of the quantile block of a whole-number key, found among about sqrt(parts) groups of as many edges."""
    steps = [i / parts for i in range(1, parts)]
    edges = sorted(set(docs.agg(F.percentile_approx(key, steps, 10 * parts)).first()[0] or [])) if steps else []
    wide = max(1, round(len(edges) ** 0.5))
    groups = [edges[i : i + wide] for i in range(0, len(edges), wide)]
    if not groups:
        return F.lit(0).cast("long"), 1
    # Constants of the plan, folded once.
    firsts = F.from_json(F.lit(json.dumps([g[0] for g in groups])), "array<bigint>")
    tails = F.from_json(F.lit(json.dumps(groups)), "array<array<bigint>>")
    group = F.size(F.filter(firsts, lambda e: e <= key))
    inner = F.size(F.filter(F.element_at(tails, F.greatest(group, F.lit(1))), lambda e: e <= key))
    return F.when(group == 0, F.lit(0)).otherwise((group - 1) * wide + inner).cast("long"), len(edges) + 1


def with_following(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Rows in ascending order of their ids within blocks, each block followed by the row that comes after it.

    Returns _part, _guest, _key, _id, _text in sorted partitions. A guest stands behind its block's rows and is the first row
    of the next block; behind the last block stands the first row of all. Each text is shuffled once. Block edges are
    quantiles of the ids, one per shuffle partition and never more, so the table of first rows that is broadcast is
    bounded by the setting.
    """
    spark = docs.sparkSession
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    lowest = -(1 << 63)
    rows = docs.select(F.col(doc_id).alias("_id"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    key = F.coalesce(F.col("_id").cast("long"), F.lit(lowest))
    place, blocks = _places(docs.select(F.col(doc_id).alias("_id")), key, parts)
    rows = rows.withColumns({"_key": key, "_part": place})
    # One row per block: its first key, and the block in front of it.
    firsts = rows.groupBy("_part").agg(F.min("_key").alias("_key"))
    order = Window.orderBy("_part")
    around = firsts.select(
        F.col("_key").alias("_first"),
        F.lag("_part").over(order).alias("_before"),
        F.max("_part").over(Window.partitionBy()).alias("_last"),
    )
    targets = around.select("_first", F.coalesce("_before", "_last").alias("_guest_of"))
    own = F.struct(F.col("_part"), F.lit(False).alias("_guest"))
    guest = F.when(F.col("_guest_of").isNotNull(), F.struct(F.col("_guest_of").alias("_part"), F.lit(True).alias("_guest")))
    sent = rows.join(F.broadcast(targets), F.col("_key") == F.col("_first"), "left").withColumn("_to", F.explode(F.array_compact(F.array(own, guest))))
    sent = sent.select("_to._part", "_to._guest", "_key", "_id", "_text")
    return sent.repartitionById(blocks, F.col("_part").cast("int")).sortWithinPartitions("_part", "_guest", "_key", F.xxhash64("_text"))


def fingerprint_report(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited text, whose last half is the next document's beginning.

    Documents follow each other by ascending whole-number id (null first), rows that repeat an id by a hash of their texts,
    and after the last comes the first; a single row follows itself. A null text is empty. Rows that repeat are reported
    each. Returns doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next; an empty table
    gives no rows, other columns are not read.
    """
    bounded_batches(docs.sparkSession, 256)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the row that waits for its follower: block, id, text, fingerprint
        for batch in batches:
            out = []
            columns = (batch.column(c).to_pylist() for c in ("_part", "_guest", "_id", "_text"))
            for part, guest, own, whole in zip(*columns, strict=True):
                one = Fingerprint.of(whole)
                if held is not None and held[0] == part:
                    _, before, body, mark = held
                    changed = edited(body, whole)
                    other = Fingerprint.of(changed)
                    digest = hashlib.sha256(changed.encode("utf-8", "surrogatepass")).hexdigest()
                    out.append((before, len(body), digest, str(mark), str(other), mark.likeness(other), mark.likeness(one)))
                held = None if guest else (part, own, whole, one)
            kinds = [batch.column("_id").type, pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
            names = [doc_id, "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
            yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], kind) for i, kind in enumerate(kinds)], names)

    kind = docs.schema[doc_id].dataType.simpleString()
    columns = f"`{doc_id}` {kind}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return with_following(docs, doc_id, text).mapInArrow(run, columns)
