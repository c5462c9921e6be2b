"""BPE encoding and decoding with a public vocabulary, by tree concatenation.

A text above `cut` characters is halved, at any place, until the halves are short. Halves are cut into pieces, the units
that the vocabulary's pre-tokenizer parts and that merge for themselves, side by side; then they are joined pair by pair up
the tree. Around each join a window is cut anew and grows until it agrees with both sides: with several pieces in a row, at
the same places, at the far end of either side. A cut reads from left to right, so from the place of agreement on it goes
on as the side did, and the spliced list is that of the whole text.

A piece that was met before is not encoded again. A piece may itself be of any length; above `leaf` characters it goes
through a tree of tokens in the same way, where two neighbouring tokens that stand next to each other in some encoding do
so in any text in which the rest agrees. Pieces are known for texts of printable ASCII and Latin letters; other texts are cut
at white space, which never lies inside a token, and their other words are encoded whole.
"""

import hashlib
import re
from collections.abc import Callable, Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from shopflow.llm.common import bounded_batches

# Fixed values of the word vocabulary: the marks its pre-tokenizer takes off, the letters whose lower case is one letter.
LETTERS = "a-zß-öø-ÿ"
PIECE = f"'s|'t|'re|'ve|'m|'ll|'d|[{LETTERS}]+|[0-9]|[^{LETTERS}0-9 \t-\r]+"
PIECES = re.compile(PIECE)
COVER = re.compile(f"{PIECE}|[ \t-\r]+")  # the same and the white space between, so that nothing is left out
WORD_COVER = re.compile("[^ \t-\r]+|[ \t-\r]+")
PLAIN = re.compile("[ \t-\r -~A-ZÀ-ÖØ-Þ" + LETTERS + "]*")
PROBE = "It's 12 SÉCOLE.* don't!! we'll--x'S\tßAÑo 'd'"
AGREE = 4  # pieces or tokens in a row that must be the same on either side of a join
REMEMBERED = 96 << 20  # bytes that a task keeps of encoded pieces, about
ENTRY_BYTES = 400  # of an entry, besides its texts
AT_ONCE = 4096
BATCH_CHARS = 8 << 20  # of texts that are encoded together

Tokens = list[tuple[int, int, int]]  # id, begin and end in the text
Entry = tuple[tuple[int, ...], str, str]  # ids, the ids as text, the decoded text


class TreeEncoder:
    """Encodes and decodes whole texts as the tokenizer does without special tokens, truncation or padding."""

    def __init__(self, definition: str, leaf: int = 256, window: int = 32, cut: int = 4096):
        self.tokenizer = Tokenizer.from_str(definition)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.leaf, self.window, self.cut = max(2, leaf), window, max(2, cut)
        self.known: dict[str, Entry] = {}
        self.held = 0
        self.joins = 0
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        whole = self.tokenizer.encode(PROBE, add_special_tokens=False).ids
        self.has_pieces = whole == list(chain.from_iterable(self._ids(PIECES.findall(PROBE.lower()))))

    def _ids(self, pieces: list[str]) -> list[list[int]]:
        """Ids of each piece."""
        found = self.tokenizer.encode(pieces, is_pretokenized=True, add_special_tokens=False)
        out: list[list[int]] = [[] for _ in pieces]
        for token, at in zip(found.ids, found.word_ids, strict=True):
            out[at].append(token)
        return out

    def _encoded(self, texts: list[str], begins: list[int]) -> list[Tokens]:
        found = self.tokenizer.encode_batch(texts, add_special_tokens=False)
        return [[(i, b + s, b + e) for i, (s, e) in zip(f.ids, f.offsets, strict=True)] for f, b in zip(found, begins, strict=True)]

    def _plain(self, text: str) -> bool:
        return self.has_pieces and PLAIN.fullmatch(text) is not None and not ("<" in text and any(t in text for t in self.special))

    def pieces(self, text: str) -> list[str]:
        """The pieces of a whole text, in order."""
        if self._plain(text):
            text = text.lower()
            if len(text) <= self.cut:
                return PIECES.findall(text)
            return [p for p in self._cover(text, COVER.findall) if not p.isspace()]
        out = []
        for word in self._cover(text, WORD_COVER.findall):
            if word[0] not in " \t\n\x0b\x0c\r":
                out += PIECES.findall(word.lower()) if self._plain(word) else [word]
        return out

    def _cover(self, text: str, split: Callable[[str], list[str]]) -> list[str]:
        """The parts of a text, white space included; those of a long one from its halves."""
        size = 1
        while size * self.cut < len(text):
            size *= 2
        edges = [len(text) * i // size for i in range(size + 1)]
        level = [split(text[b:e]) for b, e in zip(edges, edges[1:], strict=False)]
        while len(level) > 1:
            level = [self._splice(a, b, split) for a, b in zip(level[::2], level[1::2], strict=True)]
        return level[0]

    def _splice(self, left: list[str], right: list[str], split: Callable[[str], list[str]]) -> list[str]:
        """Parts of two neighbouring halves as one text."""
        self.joins += 1
        reach = 2 * AGREE
        while True:
            ours, theirs = left[-reach:], right[:reach]
            window = split("".join(ours) + "".join(theirs))
            begins = len(ours) == len(left) or window[:AGREE] == ours[:AGREE]
            ends = len(theirs) == len(right) or window[-AGREE:] == theirs[-AGREE:]
            if begins and ends:
                return left[: len(left) - len(ours)] + window + right[len(theirs) :]
            reach *= 2

    def run_tokens(self, run: str) -> Tokens:
        """Tokens of one run of any length."""
        pieces = -(-len(run) // self.leaf)
        size = 1
        while size < pieces:
            size *= 2
        edges = sorted({len(run) * i // size for i in range(size + 1)})
        spans = list(zip(edges, edges[1:], strict=False))
        level = [(b, e, t) for (b, e), t in zip(spans, self._encoded([run[b:e] for b, e in spans], [b for b, _ in spans]), strict=True)]
        while len(level) > 1:
            joined = [
                (a[0], b[1], self._join(run, a, b)) for a, b in zip(level[::2], level[1::2], strict=False)
            ]
            level = joined + level[len(joined) * 2 :]
        return level[0][2] if level else []

    def _join(self, run: str, left: tuple[int, int, Tokens], right: tuple[int, int, Tokens]) -> Tokens:
        """Tokens of two neighbouring halves as one text."""
        begin, middle, ours = left
        _, end, theirs = right
        reach = self.window
        while True:
            low = max((t[1] for t in ours if t[1] <= middle - reach), default=begin) if middle - reach > begin else begin
            high = min((t[2] for t in theirs if t[2] >= middle + reach), default=end) if middle + reach < end else end
            (window,) = self._encoded([run[low:high]], [low])
            first = 0 if low == begin else self._agreement(ours, window, low, middle)
            if first is not None:
                keep, at = (0, 0) if low == begin else first
                last = self._agreement(theirs, window, middle, high) if high < end else (len(theirs), len(window))
                if last is not None and (low == begin or high == end or last[1] >= at):
                    resume, until = last
                    return ours[:keep] + window[at:until] + theirs[resume:]
            if low == begin and high == end:
                return window
            reach *= 2

    @staticmethod
    def _agreement(side: Tokens, window: Tokens, low: int, high: int) -> tuple[int, int] | None:
        """Positions (in the side, in the window) in the middle of a stretch of equal tokens inside [low, high)."""
        place = {t: i for i, t in enumerate(window)}
        row = []
        for i, token in enumerate(side):
            if token[1] < low:
                continue
            if token[2] > high:
                break
            at = place.get(token)
            if at is not None and row and at == row[-1][1] + 1:
                row.append((i, at))
            else:
                row = [] if at is None else [(i, at)]
            if len(row) == AGREE:
                return row[AGREE // 2]
        return None

    def _remember(self, pieces: Iterable[str]) -> None:
        """Note the encoding of all these pieces; what was noted before goes where it grows too large."""
        distinct = set(pieces)
        new = [p for p in distinct if p not in self.known]
        if self.held + ENTRY_BYTES * len(new) > REMEMBERED:
            self.known.clear()
            self.held = 0
            new = list(distinct)
        short = [p for p in new if len(p) <= self.leaf]
        for start in range(0, len(short), AT_ONCE):
            part = short[start : start + AT_ONCE]
            self._note(part, self._ids(part))
        for piece in new:
            if len(piece) > self.leaf:
                self._note([piece], [[t[0] for t in self.run_tokens(piece)]])

    def _note(self, pieces: list[str], ids: list[list[int]]) -> None:
        token = self.tokenizer.id_to_token
        for piece, found in zip(pieces, ids, strict=True):
            entry = (tuple(found), " ".join(map(str, found)), " ".join(map(token, found)))
            self.known[piece] = entry
            self.held += ENTRY_BYTES + 4 * len(piece) + 40 * len(found) + len(entry[1]) + len(entry[2])

    def entries(self, texts: list[str]) -> Iterator[list[Entry]]:
        """Per text the entries of its pieces, in order."""
        at = 0
        while at < len(texts):
            end, size = at + 1, len(texts[at])
            while end < len(texts) and size + len(texts[end]) <= BATCH_CHARS:
                size += len(texts[end])
                end += 1
            split = [self.pieces(t) for t in texts[at:end]]
            self._remember(chain.from_iterable(split))
            for pieces in split:
                yield [e for e in map(self.known.__getitem__, pieces) if e[0]]
            at = end

    def decoded(self, found: list[Entry]) -> str:
        if self.tokenizer.decoder is None:  # tokens are then joined by one space
            return " ".join([f[2] for f in found])
        return self.tokenizer.decode(list(chain.from_iterable(f[0] for f in found)), skip_special_tokens=False)

    def encode_many(self, texts: list[str]) -> tuple[list[list[tuple[int, ...]]], list[str]]:
        """Per text the ids of its pieces, in order, and the decoded text."""
        found = list(self.entries(texts))
        return [[f[0] for f in one] for one in found], [self.decoded(one) for one in found]


def encode_texts(
    docs: DataFrame, vocabulary: str, doc_id: str = "doc_id", text: str = "text", leaf: int = 256, want: tuple[str, ...] = ("ids", "decoded"), cut: int = 4096
) -> DataFrame:
    """Token ids and the text decoded from them, one row per input row: _id, n_tokens and the wanted columns.

    want names any of ids, decoded, ids_sha256 (of the decimal ids joined by one space) and decoded_sha256; digests are
    made where the text is encoded. vocabulary is the path of a definition file on the driver, whose size bounds what is
    sent to the tasks. It must be one in which no token holds white space. A null text is empty; an empty text has no ids
    and decodes to an empty text. Rows that repeat repeat their result; an empty table gives no rows; other columns are
    not read. What a task keeps is bounded in bytes, but for the texts of one Arrow batch.
    """
    spark = docs.sparkSession
    bounded_batches(spark, 64)
    with open(vocabulary, encoding="utf-8") as file:
        definition = spark.sparkContext.broadcast(file.read())
    kinds = {"ids": pa.list_(pa.int32()), "decoded": pa.string(), "ids_sha256": pa.string(), "decoded_sha256": pa.string()}

    def value(name: str, encoder: TreeEncoder, found: list[Entry], written: str):
        if name == "ids":
            return np.fromiter(chain.from_iterable(f[0] for f in found), dtype=np.int32)
        if name == "decoded":
            return encoder.decoded(found)
        whole = written if name == "ids_sha256" else encoder.decoded(found)
        return hashlib.sha256(whole.encode("utf-8", "surrogatepass")).hexdigest()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = TreeEncoder(definition.value, leaf, cut=cut)
        for batch in batches:
            sizes, columns = [], {name: [] for name in want}
            for found in encoder.entries([t or "" for t in batch.column("_text").to_pylist()]):
                written = " ".join([f[1] for f in found])
                sizes.append(written.count(" ") + 1 if found else 0)
                for name in want:
                    columns[name].append(value(name, encoder, found, written))
            arrays = [pa.array(columns[name], kinds[name]) for name in want]
            yield pa.RecordBatch.from_arrays([batch.column("_id"), pa.array(sizes, pa.int64()), *arrays], ["_id", "n_tokens", *want])

    rows = docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("_text"))
    kind = rows.schema["_id"].dataType.simpleString()
    wanted = ", ".join(f"{name} {'array<int>' if name == 'ids' else 'string'}" for name in want)
    return rows.mapInArrow(encode, f"_id {kind}, n_tokens long, {wanted}")


def token_report(docs: DataFrame, vocabulary: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Counts and digests of ids and decoded texts."""
    return encode_texts(docs, vocabulary, doc_id, text, want=("ids_sha256", "decoded_sha256")).withColumnRenamed("_id", doc_id)
