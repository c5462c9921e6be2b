"""Language-model scores by a weighted backoff automaton.

The n-grams of all training texts are counted, and every one of them is an arc: none is pruned, and the counts grow with
the corpus. A state stands for the last words of an n-gram that was seen, the root for none. An arc carries the smoothed
probability of the next word, p(w|h) = (n(hw) + prior * p(w|h')) / (n(h) + prior), and a state without the arc falls to
the shorter history h' along its failure arc, which weighs prior / (n(h) + prior). The root holds the add-one
probabilities of all words. A text is scored in one traversal from left to right that carries the state and adds up
log10 probabilities; every text ends with one end token.

Texts are cut into blocks of bounded bytes. A block asks for the counts of its own n-grams only: its sorted keys travel in
slices to the bucket of their key range, where the slices of all blocks are summed, and the sums travel back. The number
of buckets follows the number of tokens, so what a task holds does not grow, and an n-gram that is frequent weighs no
more than one key per block. Words and n-grams are told apart by 64-bit keys.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopflow.llm.common import bounded_batches, fold_is
from shopflow.plans.storage import materialize

ORDER = 3  # words in the longest n-grams
PRIOR = 100.0  # pseudo-counts of the shorter history
BLOCK_BYTES = 8 << 20  # of texts; a block is closed when it holds as many, and a longer text is a block of its own
BUCKET_TOKENS = 1_000_000

MULTIPLIER = 0x9E3779B97F4A7C15  # odd, so that it has an inverse modulo 2^64
INVERSE = pow(MULTIPLIER, -1, 1 << 64)
END = np.uint64(MULTIPLIER)  # key of the end token


def mixed(keys: np.ndarray) -> np.ndarray:
    """Every bit of a key reaches every bit of the result; one to one."""
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        keys = (keys ^ (keys >> np.uint64(shift))) * np.uint64(factor)
    return keys ^ (keys >> np.uint64(31))


def powers(base: int, size: int) -> np.ndarray:
    steps = np.full(size, base, dtype=np.uint64)
    steps[:1] = 1
    return np.cumprod(steps, dtype=np.uint64)


def squeezed(values: np.ndarray) -> bytes:
    """Numbers by planes of their bytes, compressed; those of sorted keys are squeezed as steps."""
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(len(values), values.itemsize).T)
    return len(values).to_bytes(8, "little") + pa.compress(planes.tobytes(), "zstd", asbytes=True)


def opened(stored: bytes, kind: type) -> np.ndarray:
    n, width = int.from_bytes(stored[:8], "little"), np.dtype(kind).itemsize
    raw = pa.decompress(stored[8:], n * width, "zstd", asbytes=True)
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(width, n).T).reshape(-1).view(kind)


def steps(keys: np.ndarray) -> np.ndarray:
    return np.diff(keys, prepend=np.uint64(0))


class WordKeys:
    """Keys of the words between the characters [\\x20\\x09-\\x0D], A-Z in lower case, and of an end token after each text."""

    def __init__(self, window: int = 1 << 20):
        """`window` bytes are hashed at once; a longer word is hashed alone."""
        lower = np.arange(256, dtype=np.uint8)
        lower[65:91] += 32
        self.weights = mixed((lower.astype(np.uint64) + np.uint64(1)) * np.uint64(MULTIPLIER))
        self.gap = np.zeros(256, dtype=bool)
        self.gap[[9, 10, 11, 12, 13, 32]] = True
        self.window = window
        self.up, self.down = powers(MULTIPLIER, window), powers(INVERSE, window)

    def __call__(self, texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
        """The keys of all texts one after the other, and the number of each text's tokens."""
        parts = [t or b"" for t in texts]
        data = np.frombuffer(b" ".join([b"", *parts, b""]), dtype=np.uint8)
        edge = np.flatnonzero(np.diff(self.gap[data]))  # the gaps at both sides make edges come in pairs
        starts, ends = edge[::2] + 1, edge[1::2] + 1
        words = np.empty(len(starts), dtype=np.uint64)
        first = 0
        while first < len(starts):
            last = max(int(np.searchsorted(ends, starts[first] + self.window, "right")), first + 1)
            origin, size = starts[first], int(ends[last - 1] - starts[first])
            up, down = (self.up, self.down) if size <= self.window else (powers(MULTIPLIER, size), powers(INVERSE, size))
            sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(self.weights[data[origin : origin + size]] * up[:size], dtype=np.uint64)])
            begins = starts[first:last] - origin
            words[first:last] = (sums[ends[first:last] - origin] - sums[begins]) * down[begins]
            first = last
        stops = np.cumsum([1 + len(p) for p in parts], dtype=np.int64)  # where the gap after each text lies
        upto = np.searchsorted(starts, stops)
        return np.insert(mixed(words), upto, END), np.diff(upto, prepend=0) + 1


def n_grams(words: np.ndarray, sizes: np.ndarray, order: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Per order from 1: places of the tokens that end an n-gram within their text, and the n-grams' keys."""
    depth = np.arange(len(words)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    keys = words
    for length in range(1, order + 1):
        if length > 1:
            keys = np.concatenate([keys[:1], mixed(keys[:-1] * np.uint64(MULTIPLIER) + words[1:])])
        inside = np.flatnonzero(depth >= length - 1)
        yield inside, keys[inside]


def text_blocks(rows: DataFrame) -> DataFrame:
    """Blocks of whole texts: their ids, folds and sizes, and the keys of their words, each stored once."""
    kind = rows.schema["_id"].dataType.simpleString()

    def filled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            if sum(b.nbytes for b in held) >= BLOCK_BYTES:
                yield pa.concat_batches(held)
                held = []
        if held:
            yield pa.concat_batches(held)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        word_keys = WordKeys()
        for batch in filled(batches):
            bytes_of = batch.column("_text").cast(pa.binary())
            lengths = np.array([len(t) if t else 0 for t in bytes_of.to_pylist()], dtype=np.int64)
            block_of = np.cumsum(lengths) // (2 * BLOCK_BYTES)
            cuts = [0, *(np.flatnonzero(np.diff(block_of)) + 1).tolist(), len(lengths)]
            for a, b in zip(cuts, cuts[1:]):
                if a == b:
                    continue
                words, sizes = word_keys(bytes_of.slice(a, b - a).to_pylist())
                distinct, places = np.unique(words, return_inverse=True)
                ids, held = batch.column("_id").slice(a, b - a), batch.column("held_out").slice(a, b - a)
                train = int(sizes[~held.to_numpy(zero_copy_only=False).astype(bool)].sum())
                offsets = pa.array([0, b - a], pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("_row").slice(a, 1),
                        pa.ListArray.from_arrays(offsets, ids),
                        pa.ListArray.from_arrays(offsets, held),
                        pa.array([sizes.tolist()], pa.list_(pa.int64())),
                        pa.array([squeezed(steps(distinct))], pa.binary()),
                        pa.array([squeezed(places.astype(np.uint32))], pa.binary()),
                        pa.array([train], pa.int64()),
                    ],
                    ["block", "ids", "held", "sizes", "words", "places", "train"],
                )

    fields = f"block long, ids array<{kind}>, held array<boolean>, sizes array<bigint>, words binary, places binary, train long"
    return rows.mapInArrow(pack, fields)


def unpacked(words: bytes, places: bytes) -> np.ndarray:
    return np.cumsum(opened(words, np.uint64), dtype=np.uint64)[opened(places, np.uint32)]


def training_counts(blocks: DataFrame, order: int, buckets: int) -> DataFrame:
    """block, length, bucket, totals: how often each n-gram of the block occurs in all training texts, by ascending key.

    Rows without a block hold the number of distinct training words of a bucket in `found`.
    """

    slices = pa.schema([("length", pa.int32()), ("bucket", pa.int64()), ("block", pa.int64()), ("keys", pa.binary()), ("counts", pa.binary())])

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                sizes = np.array(row["sizes"], dtype=np.int64)
                teaches = np.repeat(~np.array(row["held"], dtype=bool), sizes)
                out: dict[str, list] = {"length": [], "bucket": [], "block": [], "keys": [], "counts": []}
                for length, (at, grams) in enumerate(n_grams(unpacked(row["words"], row["places"]), sizes, order), 1):
                    keys, inverse = np.unique(grams, return_inverse=True)
                    counts = np.bincount(inverse, weights=teaches[at], minlength=len(keys)).astype(np.int32)
                    bucket = ((keys >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
                    cuts = [0, *(np.flatnonzero(np.diff(bucket)) + 1).tolist(), len(keys)]
                    for a, b in zip(cuts, cuts[1:]):
                        if a < b:
                            out["length"].append(length)
                            out["bucket"].append(int(bucket[a]))
                            out["block"].append(row["block"])
                            out["keys"].append(squeezed(steps(keys[a:b])))
                            out["counts"].append(squeezed(counts[a:b]))
                yield pa.RecordBatch.from_pydict(out, slices)

    def add_up(asked: pa.Table) -> pa.Table:
        keys = [np.cumsum(opened(k, np.uint64), dtype=np.uint64) for k in asked.column("keys").to_pylist()]
        counts = np.concatenate([opened(c, np.int32) for c in asked.column("counts").to_pylist()])
        _, inverse = np.unique(np.concatenate(keys), return_inverse=True)
        sums = np.bincount(inverse, weights=counts).astype(np.int64)
        totals = np.split(sums[inverse], np.cumsum([len(k) for k in keys])[:-1])
        length, bucket = asked.column("length")[0].as_py(), asked.column("bucket")[0].as_py()
        n = len(totals) + 1
        return pa.table(
            {
                "block": pa.array([*asked.column("block").to_pylist(), None], pa.int64()),
                "length": pa.array([length] * n, pa.int32()),
                "bucket": pa.array([bucket] * n, pa.int64()),
                "totals": pa.array([*(squeezed(t) for t in totals), None], pa.binary()),
                "found": pa.array([None] * (n - 1) + [int((sums > 0).sum()) if length == 1 else 0], pa.int64()),
            }
        )

    asked = blocks.select("block", "held", "sizes", "words", "places").mapInArrow(ask, "length int, bucket long, block long, keys binary, counts binary")
    return asked.groupBy("length", "bucket").applyInArrow(add_up, "block long, length int, bucket long, totals binary, found long")


class Automaton:
    """The part of the automaton that the texts of a block can reach, laid beside their tokens.

    arcs[d][i]: log10 weight of the arc by which token i leaves the state of the d words before it; seen[d][i]: whether
    there is one (the root has one for every token); fails[d][i]: weight of that state's failure arc.
    """

    def __init__(self, counts: list[np.ndarray], total: int, distinct: int, prior: float):
        """counts[d][i]: training count of the n-gram of d + 1 words that ends at token i, 0 where the text begins later."""
        chance = (counts[0] + 1) / (total + distinct + 1)
        arcs, fails, seen = [np.log10(chance)], [np.zeros(len(chance))], [counts[0] > 0]
        for shorter, longer in zip(counts, counts[1:]):
            history = np.concatenate([[0], shorter[:-1]])
            chance = np.where(longer > 0, (longer + prior * chance) / (history + prior), chance * prior / (history + prior))
            arcs.append(np.log10(chance))
            fails.append(np.log10(prior / (history + prior)))
            seen.append(longer > 0)
        self.base, self.known = arcs[0], seen[0]
        self.arcs, self.fails, self.seen = arcs, fails, seen

    def score(self, first: int, last: int, window: int = 1 << 16) -> float:
        """log10 probability of the tokens from first to before last, in one traversal that starts at the root."""
        deepest = len(self.arcs) - 1
        state, total = 0, 0.0
        for begin in range(first, last, window):
            end = min(begin + window, last)
            arcs, fails, seen = ([column[begin:end].tolist() for column in side] for side in (self.arcs, self.fails, self.seen))
            for i in range(end - begin):
                while state and not seen[state][i]:
                    total += fails[state][i]
                    state -= 1
                total += arcs[state][i]
                if state < deepest and (state or seen[0][i]):
                    state += 1
        return total


def score(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", folds: int = 7, rest: int = 2, order: int = ORDER, prior: float = PRIOR
) -> DataFrame:
    """Base and model log10 probabilities of every whole text, one row per input row.

    Texts whose crc32(id as text) mod `folds` is `rest` are held out; all others, also those with a null id, teach. `order`
    is the number of words in the longest n-grams. A null text is empty and has the end token only. Rows that repeat count
    and score as often as they stand there. Without any training text every token has probability 1 / (V + 1) with V = 0.
    Other columns are not read. Returns doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.
    """
    bounded_batches(docs.sparkSession)
    held = fold_is(F.col(doc_id), folds, rest)
    rows = docs.select(F.monotonically_increasing_id().alias("_row"), F.col(doc_id).alias("_id"), held.alias("held_out"), F.col(text).alias("_text"))
    kind = rows.schema["_id"].dataType.simpleString()
    blocks = materialize(text_blocks(rows), "text-blocks")
    sums = blocks.agg(F.sum("train").alias("train"), F.sum(F.aggregate("sizes", F.lit(0).cast("long"), lambda a, b: a + b)).alias("tokens")).first()
    total = sums["train"] or 0
    buckets = 1 + (sums["tokens"] or 0) // BUCKET_TOKENS
    totals = materialize(training_counts(blocks, order, buckets), "n-gram-totals")
    distinct = totals.filter(F.col("block").isNull()).agg(F.sum("found")).first()[0] or 0

    def traverse(block: pa.Table, found: pa.Table) -> pa.Table:
        row = {c: block.column(c)[0].as_py() for c in ("sizes", "words", "places")}
        sizes = np.array(row["sizes"], dtype=np.int64)
        answers: dict[int, list] = {}
        for length, _, slice_ in sorted(zip(*(found.column(c).to_pylist() for c in ("length", "bucket", "totals")), strict=True), key=lambda r: r[:2]):
            answers.setdefault(length, []).append(opened(slice_, np.int64))
        counts = []
        for length, (at, grams) in enumerate(n_grams(unpacked(row["words"], row["places"]), sizes, order), 1):
            n = np.zeros(int(sizes.sum()), dtype=np.int64)
            if len(at):
                n[at] = np.concatenate(answers[length])[np.unique(grams, return_inverse=True)[1]]
            counts.append(n)
        automaton = Automaton(counts, total, distinct, prior)
        starts = np.cumsum(sizes) - sizes
        ids, held_out = (block.column(c).combine_chunks().flatten() for c in ("ids", "held"))
        return pa.table(
            {
                doc_id: ids,
                "held_out": held_out,
                "n_tokens": pa.array(sizes),
                "n_known": pa.array(np.add.reduceat(automaton.known, starts, dtype=np.int64)),
                "train_tokens": pa.array(np.full(len(sizes), total, dtype=np.int64)),
                "base_score": pa.array(np.add.reduceat(automaton.base, starts)),
                "score": pa.array([automaton.score(a, a + n) for a, n in zip(starts.tolist(), sizes.tolist(), strict=True)], pa.float64()),
            }
        )

    asked = blocks.select("block", "ids", "held", "sizes", "words", "places").groupBy("block")
    fields = f"`{doc_id}` {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return asked.cogroup(totals.filter(F.col("block").isNotNull()).groupBy("block")).applyInArrow(traverse, fields)
