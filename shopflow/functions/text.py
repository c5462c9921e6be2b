"""Text columns: slugs, sentences, hashed bag-of-words vectors."""

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

SENTENCE_END = r"(?<=[.!?…])\s+|\n+"
EDGE_SPACE = r"^\s+|\s+$"


def _accent_map() -> tuple[str, str]:
    """Letters with accents and their plain letters, from the Unicode decompositions of the Latin blocks."""
    accented, plain = [], []
    for code in [*range(0xC0, 0x250), *range(0x1E00, 0x1F00)]:
        letter = chr(code)
        base = unicodedata.normalize("NFKD", letter).encode("ascii", "ignore").decode()
        if len(base) == 1:
            accented.append(letter)
            plain.append(base)
    return "".join(accented), "".join(plain)


def strip_accents(text: Column) -> Column:
    accented, plain = _accent_map()
    return F.regexp_replace(F.translate(text, accented, plain), r"[^\x00-\x7F]", "")


def slug(text: Column) -> Column:
    """Upper-case ASCII words joined by single dashes."""
    dashed = F.regexp_replace(strip_accents(text), r"[^A-Za-z0-9]+", "-")
    return F.upper(F.regexp_replace(dashed, r"^-+|-+$", ""))


def sentences(text: Column) -> Column:
    """Sentences in order, trimmed, empty ones left out."""
    parts = F.transform(F.split(text, SENTENCE_END), lambda s: F.regexp_replace(s, EDGE_SPACE, ""))
    return F.filter(parts, lambda s: s != "")


def words(text: Column) -> Column:
    return F.filter(F.split(text, r"\s+"), lambda w: w != "")


def dot(a: Column, b: Column) -> Column:
    """Dot product in double precision, summed from the first element on."""
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)


def l2_norm(vector: Column) -> Column:
    return F.sqrt(dot(vector, vector))


def normalized(vector: Column) -> Column:
    """Unit vector; a zero vector stays zero."""
    size = l2_norm(vector)
    return F.transform(vector, lambda x: F.when(size > 0, x.cast("double") / size).otherwise(F.lit(0.0)))
