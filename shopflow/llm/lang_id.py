"""Language identification with spans: script ranges narrow the candidates, Viterbi over words labels them.

Training counts, for every language, the letter trigrams of all labelled texts (hashed to a fixed number of cells) and the
scripts its letters come from. A word is a run of letters. Its score under a language is the sum of the log-probabilities
of its trigrams; languages that do not write the word's script are no candidates. Viterbi then finds the best labels of
all words of a text, where a change of language between two words costs a fixed penalty, so that one borrowed word does
not open a span but a foreign sentence does.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopflow.llm.common import bounded_batches

CELLS = 1 << 16
PENALTY = 20.0
CHANCE = 6.0  # twice the spread of a trigram's log-probability
UNKNOWN = "und"
# First code points of script ranges and the script's number.
# 0 Latin, 1 Greek, 2 Cyrillic, 3 Armenian, 4 Hebrew, 5 Arabic, 6 Indic, 7 Thai and Lao, 8 Georgian, 9 Hangul, 10 Kana, 11 Han, 12 other
RANGES = [
    (0x0000, 0), (0x0370, 1), (0x0400, 2), (0x0530, 3), (0x0590, 4), (0x0600, 5), (0x0700, 12), (0x0750, 5), (0x0780, 12),
    (0x08A0, 5), (0x0900, 6), (0x0E00, 7), (0x0F00, 12), (0x10A0, 8), (0x1100, 9), (0x1200, 12), (0x1C80, 2), (0x1C90, 8),
    (0x1CC0, 12), (0x1D00, 0), (0x1F00, 1), (0x2000, 12), (0x2C60, 0), (0x2C80, 12), (0x2DE0, 2), (0x2E00, 12), (0x3040, 10),
    (0x3100, 12), (0x3130, 9), (0x3190, 12), (0x31F0, 10), (0x3200, 12), (0x3400, 11), (0xA000, 12), (0xA640, 2), (0xA6A0, 12),
    (0xA720, 0), (0xA800, 12), (0xAC00, 9), (0xD800, 12), (0xF900, 11), (0xFB00, 0), (0xFB13, 3), (0xFB1D, 4), (0xFB50, 5),
    (0xFE00, 12), (0xFE70, 5), (0xFF00, 0), (0xFF66, 10), (0xFFA0, 9), (0xFFE0, 12), (0x20000, 11), (0x32000, 12),
]
SCRIPTS = 13
STARTS = np.array([r[0] for r in RANGES])
NUMBERS = np.array([r[1] for r in RANGES], dtype=np.int8)
LETTERS_TO = 0x32000


def letter_table() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(LETTERS_TO)), dtype=bool, count=LETTERS_TO)


class Words:
    """The words of a text: their places, letters, trigram cells and scripts."""

    def __init__(self, text: str, letters: np.ndarray):
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.int64)
        is_letter = letters[np.minimum(points, LETTERS_TO - 1)] & (points < LETTERS_TO)
        at = np.flatnonzero(is_letter)
        self.count = len(at)
        if not self.count:
            return
        low = text.lower()
        if len(low) == len(text):  # else a letter changed its length; the text is then taken as it stands
            points = np.frombuffer(low.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.int64)
        padded = np.zeros(len(points) + 2, dtype=np.int64)
        padded[1:-1] = np.where(is_letter, points, 0)
        # A fixed mixing of three code points.
        mixed = (padded[at] * 0x9E3779B1 + padded[at + 1] * 0x85EBCA77 + padded[at + 2] * 0xC2B2AE3D) & 0xFFFFFFFF
        self.cells = ((mixed ^ (mixed >> 15)) * 0x2C1B3C6D >> 7) & (CELLS - 1)
        self.first = np.flatnonzero(np.diff(at, prepend=-2) > 1)  # in at
        self.begin = at[self.first]
        self.sizes = np.diff(np.append(self.first, self.count))
        self.scripts = NUMBERS[np.searchsorted(STARTS, points[self.begin], side="right") - 1]


def shuffled(text: str, letters: np.ndarray) -> str:
    """The text with the letters of all its words in another order, the same one for the same number of letters."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).copy()
    at = np.flatnonzero(letters[np.minimum(points, LETTERS_TO - 1)] & (points < LETTERS_TO))
    points[at] = points[at[np.random.default_rng(len(at)).permutation(len(at))]]
    return points.tobytes().decode("utf-32-le", "surrogatepass")


def learn(docs: DataFrame, text: str, lang: str) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
    """Languages, log-probabilities (language x cell), scripts of each (language x script) and what the log-probability of
    a trigram is on average in its texts, and in the same texts with shuffled letters (language x 2), from all rows given.

    Rows without text or language teach nothing. What comes to the driver is at most two numbers per language and cell.
    """
    bounded_batches(docs.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters, found = letter_table(), {}
        for batch in batches:
            for value, name in zip(batch.column("_text").to_pylist(), batch.column("_lang").to_pylist(), strict=True):
                words = Words(value, letters)
                if words.count:
                    cells = found.setdefault(name, np.zeros(2 * CELLS + SCRIPTS, dtype=np.int64))
                    cells[:CELLS] += np.bincount(words.cells, minlength=CELLS)
                    cells[CELLS + SCRIPTS :] += np.bincount(Words(shuffled(value, letters), letters).cells, minlength=CELLS)
                    cells[CELLS : CELLS + SCRIPTS] += np.bincount(words.scripts, weights=words.sizes, minlength=SCRIPTS).astype(np.int64)
        for name, cells in found.items():
            seen = np.flatnonzero(cells)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(seen), pa.string()), pa.array(seen, pa.int32()), pa.array(cells[seen], pa.int64())], ["lang", "cell", "n"]
            )

    rows = docs.select(F.col(text).alias("_text"), F.col(lang).alias("_lang")).filter("_text is not null and _lang is not null")
    counted = rows.mapInArrow(count, "lang string, cell int, n long").groupBy("lang", "cell").agg(F.sum("n").alias("n")).toPandas()
    names = sorted(counted["lang"].unique())
    table = np.zeros((len(names), 2 * CELLS + SCRIPTS))
    place = {n: i for i, n in enumerate(names)}
    table[counted["lang"].map(place).to_numpy(dtype=int), counted["cell"].to_numpy()] = counted["n"].to_numpy()
    grams, scripts, mixed = table[:, :CELLS], table[:, CELLS : CELLS + SCRIPTS], table[:, CELLS + SCRIPTS :]
    logs = np.log((grams + 0.5) / (grams.sum(axis=1, keepdims=True) + 0.5 * CELLS))
    writes = scripts >= 0.001 * scripts.sum(axis=1, keepdims=True)
    average = lambda counts: (counts * logs).sum(axis=1) / counts.sum(axis=1)
    return names, logs.astype(np.float32), writes, np.stack([average(grams), average(mixed)], axis=1)


def viterbi(scores: np.ndarray, penalty: float) -> np.ndarray:
    """Best label of every row of scores (words x languages) when a change costs the penalty.

    A single label is the best where no stretch of words gains more than half a penalty under another: k stretches with
    other labels gain at most k/2 penalties and cost k - 1 at least, and a single other label has no better total.
    """
    best = int(scores.sum(axis=0).argmax())
    gains = np.cumsum(scores - scores[:, [best]], axis=0)
    lowest = np.minimum.accumulate(np.vstack([np.zeros((1, scores.shape[1])), gains[:-1]]), axis=0)
    if (gains - lowest).max() <= penalty / 2:
        return np.full(len(scores), best)
    stays = np.empty(scores.shape, dtype=bool)
    tops = np.empty(len(scores), dtype=np.int32)
    total = [0.0] * scores.shape[1]
    for i, line in enumerate(scores.tolist()):
        top = max(total)
        tops[i] = total.index(top)
        change = top - penalty
        stays[i] = [t >= change for t in total]
        total = [(t if t >= change else change) + s for t, s in zip(total, line, strict=True)]
    labels = np.empty(len(scores), dtype=np.int64)
    label = total.index(max(total))
    for i in range(len(scores) - 1, -1, -1):
        labels[i] = label
        if not stays[i, label]:
            label = tops[i]
    return labels


class Labeller:
    def __init__(self, names: list[str], logs: np.ndarray, writes: np.ndarray, averages: np.ndarray, penalty: float = PENALTY):
        self.names, self.logs, self.writes, self.penalty = names, logs.T.astype(np.float64), writes, penalty
        self.floors = averages.mean(axis=1)  # half way between the language and shuffled letters
        self.letters = letter_table()

    def __call__(self, text: str | None) -> tuple[str, float, list[tuple[int, int, str]]]:
        """Main language, how sure it is (0 to 1), and the spans (begin, end, language)."""
        words = Words(text or "", self.letters)
        if not words.count or not self.names:
            return UNKNOWN, 0.0, []
        scores, labels = self.labels(words)
        letters = np.bincount(labels, weights=words.sizes, minlength=len(self.names))
        main = int(letters.argmax())
        total = scores[labels == main].sum(axis=0)
        sure = 1 / np.exp(np.minimum(total - total[main], 700)).sum()
        starts = np.flatnonzero(np.diff(labels, prepend=-1))
        ends = np.append(starts[1:], len(labels)) - 1
        stop = words.begin + words.sizes
        spans = [(int(words.begin[a]), int(stop[b]), self.names[labels[a]]) for a, b in zip(starts, ends, strict=True)]
        return self.names[main], float(letters[main] / words.count * sure), spans

    def labels(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """Scores of the words (words x languages) and the numbers of their languages."""
        scores = np.add.reduceat(self.logs[words.cells], words.first, axis=0)
        allowed = self.writes[:, words.scripts].T
        allowed |= ~allowed.any(axis=1, keepdims=True)  # a script no language writes rules none out
        scores = np.where(allowed, scores, scores.min() - 10 * self.penalty)
        return scores, viterbi(scores, self.penalty)

    def known_part(self, text: str | None) -> float | None:
        """Part of the letters in spans that read like their language; None without letters or languages.

        A span does if its trigrams are, on average, likelier than half way down to those of shuffled letters, give or take
        what chance does to a span of its length. Words in a script that the span's language does not write do not count.
        """
        words = Words(text or "", self.letters)
        if not words.count or not self.names:
            return None
        _, labels = self.labels(words)
        written = self.writes[labels, words.scripts]
        begin = np.flatnonzero(np.diff(labels, prepend=-1))
        logs = self.logs[words.cells, np.repeat(labels, words.sizes)] * np.repeat(written, words.sizes)
        sums, letters = np.add.reduceat(logs, words.first[begin]), np.add.reduceat(words.sizes * written, begin)
        reads = sums / np.maximum(letters, 1) + CHANCE / np.sqrt(np.maximum(letters, 1)) >= self.floors[labels[begin]]
        return float(letters[reads].sum() / words.count)


def label_languages(docs: DataFrame, model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: _id, lang_pred, score, spans (places in code points).

    lang_pred is the language with the most letters over all spans; `und`, with score 0, where the text is null or has no
    letter, or nothing was learned. Ties go to the first language by name. The score is that language's part of the
    letters times its probability there. Rows that repeat repeat their result; other columns are not read.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    shared = spark.sparkContext.broadcast(model)

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labeller = Labeller(*shared.value)
        spans = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("lang", pa.string())]))
        for batch in batches:
            found = [labeller(t) for t in batch.column("_text").to_pylist()]
            listed = [[{"start": s, "end": e, "lang": n} for s, e, n in f[2]] for f in found]
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id"), pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64()), pa.array(listed, spans)],
                ["_id", "lang_pred", "score", "spans"],
            )

    rows = docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("_text"))
    kind = rows.schema["_id"].dataType.simpleString()
    return rows.mapInArrow(label, f"_id {kind}, lang_pred string, score double, spans array<struct<start:bigint,end:bigint,lang:string>>")


def accepted(docs: DataFrame, model, text: str = "text", least: float = 0.5) -> DataFrame:
    """Rows with at least this part of their letters in spans that read like a learned language; all columns as they were.

    The words are scored and labelled as for label_languages, and a span counts by its trigrams, so a text in a language that
    was not learned goes though its script is known. How the letters divide among the learned languages does not matter.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    shared = spark.sparkContext.broadcast(model)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labeller = Labeller(*shared.value)
        for batch in batches:
            found = [labeller.known_part(t) for t in batch.column(text).to_pylist()]
            yield batch.filter(pa.array([part is not None and part >= least for part in found], pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)
