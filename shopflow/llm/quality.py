"""Document quality by attention-based multiple-instance learning.

A document is a bag of passages, and only the whole document has a label. Every passage is encoded: character classes and
symbols, word lengths and repetitions become a vector, which one layer turns into a representation. Gated attention, a
tanh branch times a sigmoid branch, gives each passage a weight that is learned from the document labels alone; the
weighted mean of the representations is the document's, and a logistic unit scores it.
"""

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopflow.llm.common import bounded_batches, fold_is, received, send

PASSAGE_WORDS = 64
# Character classes: 0 small letter, 1 capital, 2 digit, 3 white space, 4 line end, 5 other; from 6 on the ASCII signs one by one.
SIGNS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
CLASSES = 6 + len(SIGNS)
POINTS = 0x3000  # code points above are class 5, or letters as Python says


def class_table() -> np.ndarray:
    def of(ch: str) -> int:
        if ch in "\n\r\x0b\x0c":
            return 4
        if ch.isspace():
            return 3
        if ch.isupper():
            return 1
        if ch.isalpha():
            return 0
        return 2 if ch.isdigit() else 5

    table = np.fromiter((of(chr(i)) for i in range(POINTS)), dtype=np.int64, count=POINTS)
    for i, sign in enumerate(SIGNS):
        table[ord(sign)] = 6 + i
    return table


class Encoder:
    """Passage vectors of a text."""

    width = CLASSES + 10

    def __init__(self):
        self.table = class_table()
        self.powers = np.cumprod(np.full(64, 0x9E3779B97F4A7C15, dtype=np.uint64))

    def __call__(self, text: str | None) -> np.ndarray:
        points = np.frombuffer((text or "").encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        kinds = np.where(points < POINTS, self.table[np.minimum(points, POINTS - 1)], 0)
        inside = (kinds != 3) & (kinds != 4)
        starts = np.flatnonzero(inside & ~np.concatenate([[False], inside[:-1]]))
        if not len(starts):
            return np.zeros((1, self.width), dtype=np.float32)
        ends = np.flatnonzero(inside & ~np.concatenate([inside[1:], [False]])) + 1
        lengths = (ends - starts).astype(float)
        passage = np.arange(len(starts)) // PASSAGE_WORDS
        n = int(passage[-1]) + 1
        words = np.bincount(passage, minlength=n)
        # Characters belong to the passage of the last word that began before them.
        of_char = np.repeat(np.arange(n), np.diff(np.append(starts[::PASSAGE_WORDS], len(points))))
        own_kinds = kinds[starts[0] :]
        counts = np.bincount(of_char * CLASSES + own_kinds, minlength=n * CLASSES).reshape(n, CLASSES)
        chars = counts.sum(axis=1, keepdims=True)
        inner = np.arange(starts[0], len(points)) - np.repeat(starts, np.diff(np.append(starts, len(points))))
        salted = np.where(inside[starts[0] :], points[starts[0] :].astype(np.uint64) + np.uint64(1), np.uint64(0)) * self.powers[inner & 63]
        hashes = np.add.reduceat(salted, starts - starts[0])
        again = np.concatenate([[False], hashes[1:] == hashes[:-1]])
        _, firsts = np.unique((hashes ^ passage.astype(np.uint64)) * self.powers[1], return_index=True)
        distinct = np.bincount(passage[firsts], minlength=n)
        signed = kinds[ends - 1] >= 5
        capital = kinds[starts] == 1
        repeated = 0.0
        if len(hashes) >= 5:
            runs = sum(np.roll(hashes, -i)[: len(hashes) - 4] * self.powers[i] for i in range(5))
            repeated = 1 - len(np.unique(runs)) / len(runs)

        def share(flags):
            return np.bincount(passage, weights=flags, minlength=n) / words

        mean = np.bincount(passage, weights=lengths, minlength=n) / words
        square = np.bincount(passage, weights=lengths**2, minlength=n) / words
        extra = np.stack(
            [np.log1p(words), np.full(n, np.log1p(len(starts))), mean, np.sqrt(np.maximum(square - mean**2, 0)), distinct / words,
             share(again), share(signed), share(capital), np.full(n, repeated), np.full(n, len(np.unique(hashes)) / len(hashes))], axis=1,
        )
        return np.concatenate([np.sqrt(counts / chars), extra], axis=1).astype(np.float32)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


class AttentionMIL:
    """Gated attention pooling over passages and a logistic unit on the pooled representation."""

    def __init__(self, width: int, hidden: int = 24, gates: int = 12, seed: int = 7):
        random = np.random.default_rng(seed)

        def layer(a, b):
            return random.normal(0, 1 / np.sqrt(a), (a, b)).astype(np.float32)

        self.mean, self.scale = np.zeros(width, np.float32), np.ones(width, np.float32)
        self.w = {"E": layer(width, hidden), "e": np.zeros(hidden, np.float32), "V": layer(hidden, gates), "U": layer(hidden, gates),
                  "a": layer(gates, 1)[:, 0], "c": layer(hidden, 1)[:, 0], "b": np.zeros(1, np.float32)}

    def forward(self, x: np.ndarray, first: np.ndarray):
        """Scores of bags whose passages begin at `first`, and what the gradient needs."""
        w = self.w
        x = np.clip((x - self.mean) / self.scale, -8, 8)
        h = np.tanh(x @ w["E"] + w["e"])
        t, s = np.tanh(h @ w["V"]), _sigmoid(h @ w["U"])
        logits = (t * s) @ w["a"]
        sizes = np.diff(np.append(first, len(x)))
        bag = np.repeat(np.arange(len(first)), sizes)
        raised = np.exp(logits - np.maximum.reduceat(logits, first)[bag])
        attention = raised / np.add.reduceat(raised, first)[bag]
        pooled = np.add.reduceat(h * attention[:, None], first, axis=0)
        return _sigmoid(pooled @ w["c"] + w["b"]), (x, h, t, s, bag, attention, pooled)

    def fit(self, x: np.ndarray, first: np.ndarray, labels: np.ndarray, weights: np.ndarray, rounds: int = 150, rate: float = 0.01, decay: float = 1e-3):
        self.mean, self.scale = x.mean(axis=0, dtype=float).astype(np.float32), x.std(axis=0, dtype=float).astype(np.float32) + np.float32(1e-3)
        w = self.w
        moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in w.items()}
        weights, labels = (weights / weights.sum()).astype(np.float32), labels.astype(np.float32)
        for step in range(1, rounds + 1):
            score, (z, h, t, s, bag, attention, pooled) = self.forward(x, first)
            d = (score - labels) * weights
            d_pooled = d[:, None] * w["c"]
            d_h = d_pooled[bag] * attention[:, None]
            reach = (d_pooled[bag] * h).sum(axis=1)
            centre = np.add.reduceat(reach * attention, first)[bag]
            d_logit = attention * (reach - centre)
            d_gate = d_logit[:, None] * w["a"]
            d_t, d_s = d_gate * s * (1 - t**2), d_gate * t * s * (1 - s)
            d_h += d_t @ w["V"].T + d_s @ w["U"].T
            d_z = d_h * (1 - h**2)
            slopes = {"E": z.T @ d_z, "e": d_z.sum(axis=0), "V": h.T @ d_t, "U": h.T @ d_s, "a": (t * s).T @ d_logit, "c": pooled.T @ d, "b": np.array([d.sum()])}
            for k, g in slopes.items():
                g = g + decay * w[k] / len(labels)
                m, v = moments[k]
                m[...] = 0.9 * m + 0.1 * g
                v[...] = 0.999 * v + 0.001 * g**2
                w[k] -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-9)
        return self


def labelled_bags(docs: DataFrame, labels: DataFrame, doc_id: str, text: str, label: str, per_class: int, most_chars: int) -> pd.DataFrame:
    """Passage vectors and labels of a bounded sample: per label the documents with the smallest hashes of their id."""
    bounded_batches(docs.sparkSession)
    known = labels.filter(F.col(label).isin(0, 1) & F.col(doc_id).isNotNull()).groupBy(F.col(doc_id).alias("_key")).agg(F.max(label).alias("_label"))
    able = docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("_text"))
    short = able.filter(F.col("_text").isNotNull() & (F.length("_text") <= most_chars)).select("_id")
    both = short.join(known, short["_id"] == known["_key"]).select("_id", "_label").distinct()
    chosen = None
    for value in (0, 1):
        part = both.filter(F.col("_label") == value).orderBy(F.xxhash64("_id"), "_id").limit(per_class)
        chosen = part if chosen is None else chosen.unionByName(part)
    chosen = chosen.withColumnsRenamed({"_id": "_chosen"})

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder()
        for batch in batches:
            vectors = [encoder(t) for t in batch.column("_text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id"), batch.column("_label"), pa.array([v.ravel() for v in vectors], pa.list_(pa.float32()))], ["_id", "_label", "bag"]
            )

    kinds = {f.name: f.dataType.simpleString() for f in able.join(known, able["_id"] == known["_key"]).schema}
    rows = able.join(F.broadcast(chosen), able["_id"] == chosen["_chosen"]).select("_id", "_label", "_text")  # at most 2 * per_class rows
    return rows.mapInArrow(encode, f"_id {kinds['_id']}, _label {kinds['_label']}, bag array<float>").toPandas()


def learn(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality", per_class: int = 1500, most_chars: int = 20_000) -> AttentionMIL:
    """A model of the labels 0 and 1, fitted on at most `per_class` texts of each (of up to `most_chars` characters).

    Both labels weigh the same as a whole. Rows without text or label teach nothing; with fewer than two labels at hand
    the model is the untrained one and scores around a half.
    """
    model = AttentionMIL(Encoder.width)
    bags = labelled_bags(docs, labels, doc_id, text, label, per_class, most_chars).sort_values("_id", kind="stable")
    truth = bags["_label"].to_numpy(dtype=float)
    if len(set(truth)) < 2:
        return model
    vectors = [np.asarray(b, dtype=np.float32).reshape(-1, Encoder.width) for b in bags["bag"]]
    first = np.concatenate([[0], np.cumsum([len(v) for v in vectors])[:-1]])
    weights = np.where(truth == 1, 1 / truth.sum(), 1 / (1 - truth).sum())
    return model.fit(np.concatenate(vectors), first, truth, weights)


def score(docs: DataFrame, model: AttentionMIL, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: _id, score (0 to 1), n_passages and focus, the number of the passage with the largest weight.

    A null text is empty; a text without words is one empty passage. Rows that repeat repeat their score.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    shared = send(spark, model)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, network = Encoder(), received(shared)
        for batch in batches:
            scores, sizes, focus = [], [], []
            for value in batch.column("_text").to_pylist():
                bag = encoder(value)
                found, (*_, attention, _) = network.forward(bag, np.array([0]))
                scores.append(float(found[0]))
                sizes.append(len(bag))
                focus.append(int(attention.argmax()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id"), pa.array(scores, pa.float64()), pa.array(sizes, pa.int32()), pa.array(focus, pa.int32())],
                ["_id", "score", "n_passages", "focus"],
            )

    rows = docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("_text"))
    return rows.mapInArrow(apply, f"_id {rows.schema['_id'].dataType.simpleString()}, score double, n_passages int, focus int")


def quality_report(docs: DataFrame, labels: DataFrame, folds: int = 5, rest: int = 0, least: float = 0.3) -> DataFrame:
    """doc_id, held_out, score, predicted, n_passages, focus; only documents outside the held-out fold teach."""
    model = learn(docs.filter(~fold_is(F.col("doc_id"), folds, rest)), labels)
    return score(docs, model).select(
        F.col("_id").alias("doc_id"),
        fold_is(F.col("_id"), folds, rest).alias("held_out"),
        "score",
        (F.col("score") >= least).cast("int").alias("predicted"),
        "n_passages",
        "focus",
    )
