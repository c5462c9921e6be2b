"""Near-duplicate classes by Order MinHash of word pairs and banded alignment.

A text is its sequence of words between two marks. Its k-mers (k words each) are labelled with their occurrence number, so
that a repeated phrase counts as often as it stands there. Each sketch takes the 3 k-mers with the smallest hashes and keeps
them in the order they have in the text, so texts that hold the same words in another order share few sketches. An edit
changes k k-mers at most: texts of which a fifth of the words differ have at least three sevenths of their word pairs (k = 2)
in common and agree in 7 to 8 % of the sketches; of 40 sketches none does for one such pair in about 25, and for fewer the more alike texts are. Texts that share a
sketch are candidates, and an alignment within the band that the least similarity allows decides.

Equal texts form one node first. In a bucket of nodes with the same sketch, each is paired with the smallest and the
largest node, which are the same ones in most buckets of a large class, so few pairs are left to align. Where a bucket then
still has members of several classes, as where many texts share a passage, its members part by the next sketch, and again by
the one after, until no bucket holds two classes; in each of the smaller buckets they meet the smallest and the largest
node of another class. Where a bucket holds several classes even then, every two of its members of different classes are
compared by counts of their words, block against block, and aligned where those leave the similarity open. So no link
between two classes of a bucket is missed: the classes are those that all pairs of all buckets would give. Only that last
step grows with pairs, of one bucket and different classes. Classes are the connected components of the verified links,
found by star contraction.
"""

import hashlib
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopflow.llm.common import bounded_batches
from shopflow.plans.storage import materialize

REMEMBERED = 500_000
LONG = 1000  # words above which a text's k-mers are spread over bins
LANES = 256  # cells that the words of a text are counted in, each up to 255
BLOCK = 512  # members of a bucket that meet others as one matrix
BEFORE, AFTER = np.uint64(0x8CB92BA72F3D8DD7), np.uint64(0xF1357AEA2E62A9C5)  # marks around the words


def words_of(text: str | None) -> list[str]:
    return (text or "").lower().split()


def node_of(words: list[str]) -> bytes:
    return hashlib.blake2b(" ".join(words).encode("utf-8", "surrogatepass"), digest_size=16).digest()


class _Hashes(dict):
    def __missing__(self, word: str) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        found = self[word] = xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"))
        return found


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


class OrderMinHash:
    """Sketches of word sequences, and the parities (`whole`: and counts) of the words by cells of their hashes.

    Each of the `sketches` takes the `keep` k-mers of the smallest hashes, in text order. k - 1 marks stand before and after
    the words, so that an edit at an end changes fewer k-mers and every text has some. Texts of up to LONG words are ranked
    anew for every sketch. Longer ones spread their k-mers over as many bins and take the smallest of each. Texts that a
    link could lead across that length have both kinds. The two kinds are lists of their own.
    """

    def __init__(self, k: int, sketches: int, keep: int, least: float):
        self.k, self.keep, self.sketches = k, keep, sketches
        self.both_to = LONG / least
        self.hashes = _Hashes()
        self.seeds = _mix(np.arange(1, 2 * sketches + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))[:, None]
        self.factors = _mix(self.seeds[:sketches]) | np.uint64(1)  # multiplying by an odd number permutes
        self.bounds = (np.arange(sketches + 1, dtype=object) * 2**64 // sketches)[1:-1].astype(np.uint64)
        self.places = np.uint64((1 << (int(self.both_to) + k).bit_length()) - 1)  # low bits of a rank that hold the place

    def __call__(self, words: list[str]) -> tuple[list[list[int]], list[int]]:
        return self.whole(words)[:2]

    def whole(self, words: list[str]) -> tuple[list[list[int]], list[int], bytes]:
        if not words:
            return [[], []], [0] * 4, bytes(LANES)
        h = np.array(list(map(self.hashes.__getitem__, words)), dtype=np.uint64)
        held = np.bincount((h >> np.uint64(56)).astype(np.int64), minlength=LANES)
        parities = np.packbits((held & 1).astype(bool)).view(np.int64).tolist()
        counts = np.minimum(held, 255).astype(np.uint8).tobytes()
        edge = self.k - 1
        h = np.concatenate([np.full(edge, BEFORE), h, np.full(edge, AFTER)])
        n = len(h) - edge
        grams = np.zeros(n, dtype=np.uint64)
        for i in range(self.k):
            grams = (grams ^ _mix(h[i : i + n])) * np.uint64(0x9FB21C651E98DF25)
        grams = self._labelled(_mix(grams))
        ranked, binned = [], []
        if len(words) <= self.both_to:
            ranks = grams[None, :] * self.factors & ~self.places | np.arange(n, dtype=np.uint64)
            if self.keep < n:
                ranks = np.partition(ranks, self.keep - 1, axis=1)[:, : self.keep]
            at = np.sort(ranks & self.places, axis=1).astype(np.int64)
            ranked = self._joined(grams[at], self.seeds[: self.sketches, 0])
        if len(words) > LONG:
            order = np.argsort(grams, kind="stable")
            begins = np.concatenate([[0], np.searchsorted(grams[order], self.bounds), [n]])
            at = begins[:-1, None] + np.arange(self.keep)
            held = at < begins[1:, None]
            at = np.sort(np.where(held, order[np.minimum(at, n - 1)], n), axis=1)
            binned = self._joined(np.append(grams, np.uint64(0))[at], self.seeds[self.sketches :, 0])
        return [ranked, binned], parities, counts

    @staticmethod
    def _joined(lowest: np.ndarray, seeds: np.ndarray) -> list[int]:
        out = seeds.copy()
        for i in range(lowest.shape[1]):
            out = _mix(out * np.uint64(0xD6E8FEB86659FD93) + lowest[:, i])
        return out.view(np.int64).tolist()

    @staticmethod
    def _labelled(grams: np.ndarray) -> np.ndarray:
        """Hashes of the k-mers with their occurrence number."""
        order = np.argsort(grams, kind="stable")
        ordered = grams[order]
        repeats = ordered[1:] == ordered[:-1]
        if not repeats.any():
            return grams
        starts = np.flatnonzero(np.concatenate([[True], ~repeats]))
        number = np.arange(len(grams)) - np.repeat(starts, np.diff(np.append(starts, len(grams))))
        out = grams.copy()
        out[order] = np.where(number > 0, _mix(ordered + number.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), ordered)
        return out


def banded_distance(x: list, y: list, band: int) -> int | None:
    """Edit distance of two sequences, or None if it is above the band.

    The columns of the alignment are bit vectors over the rows of the band: bit i stands for row j - band + i in column j.
    Positive and negative steps down a column decide the steps of the next one; the score follows the band's lower edge and
    then the last row. Only the rows inside the band have their words in `rows`, shifted when they are used.
    """
    m, n = len(x), len(y)
    if abs(m - n) > band:
        return None
    width = 2 * band + 1
    full, edge = (1 << width) - 1, 1 << (width - 1)
    rows: dict = {}
    for r in range(min(m, band)):  # rows 1 to band, as seen from column 0
        mask, _ = rows.get(x[r], (0, 0))
        rows[x[r]] = (mask | 1 << (band + r + 1), 0)
    down, up = full ^ ((1 << band) - 1), 0  # seen from column 1
    row = score = min(band, m)
    for j in range(1, n + 1):
        entering = j + band
        if entering <= m:
            mask, at = rows.get(x[entering - 1], (0, j))
            rows[x[entering - 1]] = (mask >> (j - at) | edge, j)
        mask, at = rows.get(y[j - 1], (0, j))
        same = mask >> (j - at) & full
        diagonal = ((((same & down) + down) ^ down) | same | up) & full
        right, left = up | (full ^ (diagonal | down)), diagonal & down
        if row < m:
            row += 1
            score += not diagonal & edge
            if score > 3 * band:
                return None
        else:
            bit = m - j + band
            score += (right >> bit & 1) - (left >> bit & 1)
        shifted = diagonal >> 1
        down, up = left | (full ^ (shifted | right)), shifted & right
    return score if score <= band else None


def edit_similarity(x: list[str], y: list[str], least: float) -> float | None:
    """1 - distance / longer length, or None if it is below `least`."""
    longer = max(len(x), len(y))
    if not longer:
        return 1.0
    limit = int(longer * (1 - least) + 1e-9)
    if abs(len(x) - len(y)) > limit or sum((Counter(x) & Counter(y)).values()) < longer - limit:
        return None  # each edit changes at most one word of the longer text
    begin, shorter = 0, min(len(x), len(y))
    while begin < shorter and x[begin] == y[begin]:
        begin += 1
    end = 0
    while end < shorter - begin and x[-1 - end] == y[-1 - end]:
        end += 1
    x, y = x[begin : len(x) - end], y[begin : len(y) - end]
    band = min(32, limit)
    while True:
        distance = banded_distance(x, y, band)
        if distance is not None:
            return 1 - distance / longer
        if band >= limit:
            return None
        band = min(4 * band, limit)


def sketch_rows(docs: DataFrame, doc_id: str, text: str, k: int, sketches: int, keep: int, least: float) -> DataFrame:
    """One stored row per document: _row, _id, _digest (of the text), node, words, sketches, parities, counts."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketcher = OrderMinHash(k, sketches, keep, least)
        for batch in batches:
            split = [words_of(t) for t in batch.column("_text").to_pylist()]
            made = [sketcher.whole(w) for w in split]
            yield pa.RecordBatch.from_arrays(
                [batch.column("_row"), batch.column("_id"), batch.column("_digest"), pa.array([node_of(w) for w in split], pa.binary()),
                 pa.array([len(w) for w in split], pa.int32()), pa.array([m[0] for m in made], pa.list_(pa.list_(pa.int64()))),
                 pa.array([m[1] for m in made], pa.list_(pa.int64())), pa.array([m[2] for m in made], pa.binary())],
                ["_row", "_id", "_digest", "node", "words", "sketches", "parities", "counts"],
            )

    bounded_batches(docs.sparkSession)
    digest = F.unhex(F.sha2(F.coalesce(F.col(text), F.lit("")), 256))
    rows = docs.select(F.monotonically_increasing_id().alias("_row"), F.col(doc_id).alias("_id"), digest.alias("_digest"), F.col(text).alias("_text"))
    kind = rows.schema["_id"].dataType.simpleString()
    return materialize(rows.mapInArrow(sketch, f"_row long, _id {kind}, _digest binary, node binary, words int, sketches array<array<long>>, parities array<long>, counts binary"), "sketches")


def shared_buckets(nodes: DataFrame) -> DataFrame:
    """One stored row per node and bucket of two nodes or more: sketch, its kind and place, num, words, low and high (the bucket's ends), size."""
    kinds = nodes.select("num", "words", F.posexplode("sketches").alias("kind", "values"))
    members = kinds.select("num", "words", F.col("kind").cast("byte"), F.posexplode("values").alias("place", "sketch")).withColumn("place", F.col("place").cast("short"))
    one = F.struct("num", "words")
    ends = members.groupBy("sketch").agg(F.min(one).alias("low"), F.max(one).alias("high"), F.count(F.lit(1)).alias("size"))
    return materialize(members.join(ends.filter("size > 1"), "sketch"), "buckets")


def close(x: str, y: str, least: float) -> Column:
    """Lengths that do not exclude the similarity."""
    return F.greatest(x, y) * (1 - least) + 1e-9 >= F.abs(F.col(x) - F.col(y))


def end_pairs(buckets: DataFrame, least: float) -> DataFrame:
    """a, b: each node with the smallest and the largest node of its buckets, unless the lengths exclude the similarity."""
    met = buckets.select("num", "words", F.explode(F.array("low", "high")).alias("other"))
    met = met.filter((F.col("num") != F.col("other.num")) & close("words", "other.words", least))
    return met.select(F.least("num", "other.num").alias("a"), F.greatest("num", "other.num").alias("b")).distinct()


def parted_pairs(buckets: DataFrame, nodes: DataFrame, tops: DataFrame, least: float) -> DataFrame | None:
    """a, b: pairs of different classes (tops: node, top) from buckets that part round by round by their next sketches.

    A bucket goes on while it holds two classes. Its members meet the ends of the bucket and, beside a class that holds an
    end, the other end, so a round makes at most two pairs of a member. The rounds end with the last sketch at the latest,
    when members agree in all of them.
    """
    of = F.coalesce("top", "num").alias("top")
    members = buckets.filter("size > 2").select(F.col("sketch").alias("bucket"), "num", "words", "kind", "place")
    members = members.join(tops.withColumnRenamed("node", "num"), "num", "left").select("bucket", "num", "words", "kind", "place", of)
    found, depth, most = [], 0, None
    while True:
        one = F.struct("num", "words", "top")
        ends = members.groupBy("bucket").agg(F.min(one).alias("low"), F.max(one).alias("high"), F.min("top").alias("t0"), F.max("top").alias("t1"))
        members = materialize(members.join(ends.filter("t0 < t1").select("bucket", "low", "high"), "bucket"), "mixed-buckets")
        if members.isEmpty():
            break
        if depth:
            met = members.select("num", "words", "top", F.explode(F.array("low", "high")).alias("other"))
            met = met.filter((F.col("top") != F.col("other.top")) & close("words", "other.words", least))
            found.append(met.select(F.least("num", "other.num").alias("a"), F.greatest("num", "other.num").alias("b")))
        else:
            members = members.join(nodes.select("num", "sketches"), "num")
            members = members.withColumn("chain", F.element_at("sketches", F.col("kind") + 1)).drop("sketches")
            most = members.agg(F.max(F.size("chain"))).first()[0]
        depth += 1
        if depth >= most:
            break
        following = F.element_at("chain", ((F.col("place") + depth) % F.size("chain") + 1).cast("int"))
        members = members.withColumn("bucket", F.xxhash64("bucket", following)).drop("low", "high")
    if not found:
        return None
    return reduce(DataFrame.unionByName, found).distinct()


def crossing_pairs(buckets: DataFrame, nodes: DataFrame, tops: DataFrame, least: float) -> DataFrame | None:
    """a, b: every two nodes of different classes (tops: node, top) of one bucket whose words do not exclude the similarity.

    The members of a bucket are dealt into blocks, and every two blocks meet in a cell, so neither a task nor a row holds a
    bucket. An edit takes one word of a text away at most and adds one at most, so a text has no more words in cells of
    LANES that the other lacks than there are edits. Buckets of two are left out, as their nodes are each other's ends.
    """
    members = buckets.filter("size > 2").select("sketch", "num").join(tops.withColumnRenamed("node", "num"), "num", "left")
    members = members.select("sketch", "num", F.coalesce("top", "num").alias("top"))
    mixed = members.groupBy("sketch").agg(F.min("top").alias("t0"), F.max("top").alias("t1"), F.count(F.lit(1)).alias("n")).filter("t0 < t1")
    members = members.join(mixed.select("sketch", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks")), "sketch")
    members = materialize(members.withColumn("block", F.pmod(F.xxhash64("num"), "blocks").cast("int")), "crossing")
    if members.isEmpty():
        return None

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, cell in zip(batch.column("i").to_pylist(), batch.column("j").to_pylist(), batch.column("cell"), strict=True):
                of = cell.values
                block, num, top, words = (of.field(name).to_numpy() for name in ("block", "num", "top", "words"))
                counts = np.frombuffer(b"".join(of.field("counts").to_pylist()), dtype=np.uint8).reshape(-1, LANES).astype(np.int16)
                left, right, low, high = np.flatnonzero(block == i), np.flatnonzero(block == j), [], []
                for place, at in enumerate(left):
                    near = right[place + 1 :] if i == j else right
                    near = near[top[near] != top[at]]
                    limit = (np.maximum(words[near], words[at]) * (1 - least) + 1e-9).astype(np.int64)
                    apart = np.abs(words[near].astype(np.int64) - int(words[at]))
                    able = apart <= limit
                    near, limit, apart = near[able], limit[able], apart[able]
                    differing = np.abs(counts[near] - counts[at]).sum(axis=1, dtype=np.int64)
                    met = num[near[differing + apart <= 2 * limit]]
                    low.append(np.minimum(met, num[at]))
                    high.append(np.maximum(met, num[at]))
                if low:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(low)), pa.array(np.concatenate(high))], ["a", "b"])

    bounded_batches(nodes.sparkSession)
    members = members.join(nodes.select("num", "words", "counts"), "num")
    blocks = members.groupBy("sketch", "blocks", "block").agg(F.collect_list(F.struct("block", "num", "top", "words", "counts")).alias("of"))
    meeting = blocks.select("sketch", "block", "of", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    cells = meeting.groupBy("sketch", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"))
    cells = cells.agg(F.flatten(F.collect_list("of")).alias("cell")).select("i", "j", "cell")
    return cells.mapInArrow(compare, "a long, b long").distinct()


def able_pairs(pairs: DataFrame, nodes: DataFrame, least: float) -> DataFrame:
    """The pairs whose words do not exclude the similarity: an edit changes two of the 256 parities of the words at most."""
    facts = nodes.select("num", "words", "parities")
    sides = pairs.join(facts.select(F.col("num").alias("a"), F.col("words").alias("wa"), F.col("parities").alias("pa")), "a")
    sides = sides.join(facts.select(F.col("num").alias("b"), F.col("words").alias("wb"), F.col("parities").alias("pb")), "b")
    differing = sum((F.bit_count(F.col("pa")[i].bitwiseXOR(F.col("pb")[i])) for i in range(4)), F.lit(0))
    return sides.filter(differing <= 2 * F.floor(F.greatest("wa", "wb") * (1 - least) + 1e-9)).select("a", "b")


def texts_of(docs: DataFrame, doc_id: str, text: str, wanted: DataFrame) -> DataFrame:
    """num, text: one for each wanted node (columns num, node, _of: the id of a row that has it).

    Rows that repeat both meet in one stretch of the join, of which the first stays; where Spark splits a stretch over
    tasks, each may give one.
    """

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, seen = None, set()
        for batch in batches:
            same = []
            for of, num, whole, node in zip(*(batch.column(c).to_pylist() for c in ("_of", "num", "text", "node")), strict=True):
                if of != last:
                    last, seen = of, set()
                good = num not in seen and node_of(words_of(whole)) == node
                if good:
                    seen.add(num)
                same.append(good)
            yield batch.select(["num", "text"]).filter(pa.array(same, pa.bool_()))

    whole = docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("text"))
    read = whole.join(wanted, whole["_id"].eqNullSafe(wanted["_of"])).select("_of", "num", "node", "text")
    return read.mapInArrow(check, "num long, text string")


def verified(pairs: DataFrame, texts: DataFrame, least: float) -> DataFrame:
    """The pairs (a, b) whose edit similarity over words is at least `least`."""

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sides = zip(batch.column("text_a").to_pylist(), batch.column("text_b").to_pylist(), strict=True)
            found = [edit_similarity(words_of(x), words_of(y), least) is not None for x, y in sides]
            yield batch.select(["a", "b"]).filter(pa.array(found, pa.bool_()))

    sides = pairs.join(texts.select(F.col("num").alias("b"), F.col("text").alias("text_b")), "b")
    sides = sides.join(texts.select(F.col("num").alias("a"), F.col("text").alias("text_a")), "a")
    return sides.select("a", "b", "text_a", "text_b").mapInArrow(align, "a long, b long").distinct()


def components(links: DataFrame) -> DataFrame:
    """node, top: the smallest node each node is connected with, for nodes that have links (a, b).

    Large-star links every larger neighbour to the smallest one around, small-star every smaller; both keep the
    components and end in stars. Every round is stored, so a lost executor costs one round at most.
    """
    edges = materialize(links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")

    def state(frame):
        return tuple(frame.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    before = state(edges)
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        around = materialize(both.groupBy("u").agg(F.least("u", F.min("v")).alias("m")), "around")
        large = both.join(around, "u").filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = materialize(large.distinct(), "large-star")
        below = materialize(edges.groupBy("u").agg(F.min("v").alias("m")), "below")
        small = edges.join(below, "u")
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(small.select("u", F.col("m").alias("v")))
        edges = materialize(small.filter(F.col("u") != F.col("v")).distinct(), "small-star")
        after = state(edges)
        if after == before:
            return edges.groupBy("u").agg(F.min("v").alias("top")).withColumnRenamed("u", "node").unionByName(
                edges.select(F.col("v").alias("node"), F.col("v").alias("top")).distinct()
            )
        before = after


def near_classes(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least: float = 0.8, k: int = 2, sketches: int = 40, keep: int = 3
) -> DataFrame:
    """One row per input row: _id, _digest (SHA-256 of the text), class_id, class_size, n_links, kept.

    Texts are compared as words in lower case between white space; texts with the same words are equal, and so are all
    texts without words and null texts. Other texts are linked when their edit similarity (1 - edits / words of the longer)
    is at least `least` and they share a bucket; classes are what all such links connect. A class is named by its smallest id (null last), whose row stays; of rows
    that repeat an id and words one stays. n_links counts the other texts of the class that the row's text was aligned
    with and linked to; copies need no link and not all links of a class are sought.
    """
    rows = sketch_rows(docs, doc_id, text, k, sketches, keep, least)
    first = F.struct(F.col("_id").isNull().alias("n"), F.col("_id").alias("id"), F.col("_row").alias("row"))
    nodes = materialize(
        rows.groupBy("node").agg(
            F.min(first).alias("first"), F.count(F.lit(1)).alias("size"), F.first("words").alias("words"),
            F.first("sketches").alias("sketches"), F.first("parities").alias("parities"), F.first("counts").alias("counts"),
        ).withColumn("num", F.monotonically_increasing_id()),
        "nodes",
    )
    buckets = shared_buckets(nodes)

    def links_of(pairs: DataFrame) -> DataFrame:
        ends = pairs.select(F.col("a").alias("num")).unionByName(pairs.select(F.col("b").alias("num"))).distinct()
        wanted = ends.join(nodes, "num").select("num", "node", F.col("first.id").alias("_of"))
        return verified(pairs, materialize(texts_of(docs, doc_id, text, wanted), "candidate-texts"), least)

    pairs = materialize(end_pairs(buckets, least), "pairs")
    links = materialize(links_of(materialize(able_pairs(pairs, nodes, least), "able-pairs")), "first-links")
    tops = materialize(components(links), "first-classes")
    more = parted_pairs(buckets, nodes, tops, least)
    if more is not None:
        more = materialize(more.join(pairs, ["a", "b"], "left_anti"), "more-pairs")
        links = materialize(links.unionByName(links_of(materialize(able_pairs(more, nodes, least), "able-pairs"))), "links")
        tops = materialize(components(links), "classes")
        pairs = pairs.unionByName(more)
    rest = crossing_pairs(buckets, nodes, tops, least)
    if rest is not None:
        rest = materialize(rest.join(pairs, ["a", "b"], "left_anti"), "crossing-pairs")
        found = materialize(links_of(rest), "crossing-links")
        if not found.isEmpty():
            links = materialize(links.unionByName(found), "all-links")
            tops = materialize(components(links), "all-classes")
    counted = links.select(F.explode(F.array("a", "b")).alias("num")).groupBy("num").agg(F.count(F.lit(1)).alias("n_links"))
    tops = tops.withColumnRenamed("node", "num")
    named = nodes.select("num", "node", "first", "size").join(tops, "num", "left").join(counted, "num", "left")
    named = named.select("node", F.coalesce("top", "num").alias("top"), "first", "size", F.coalesce("n_links", F.lit(0)).alias("n_links"))
    named = materialize(named, "named")
    classes = named.groupBy("top").agg(F.min("first").alias("first"), F.sum("size").alias("class_size"))
    of_node = materialize(named.select("node", "top", "n_links").join(classes, "top").select("node", "first", "class_size", "n_links"), "node-classes")
    return rows.join(of_node, "node").select(
        "_id", "_digest", F.col("first.id").alias("class_id"), "class_size", "n_links", (F.col("_row") == F.col("first.row")).alias("kept")
    )
