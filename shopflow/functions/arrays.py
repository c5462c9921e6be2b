"""Histories as arrays: trimming, padding, parsing, recency buckets."""

from pyspark.sql import Column
from pyspark.sql import functions as F

RECENCY_STEP_SECONDS = 300
RECENCY_CAP = 24 * 12 * 365
# Upper bounds in seconds of the coarse recency classes; older rows get the last class.
RECENCY_BOUNDS = [300, 1800, 7200, 21600, 86400, 259200, 604800, 1209600]


def last_n(values: Column, n: int | Column) -> Column:
    """Suffix of at most n elements."""
    n = F.lit(n) if isinstance(n, int) else n
    size = F.size(values)
    return F.slice(values, F.greatest(size - n, F.lit(0)) + 1, F.greatest(n, F.lit(0)))


def pad_left(values: Column, n: int | Column, pad: Column) -> Column:
    n = F.lit(n) if isinstance(n, int) else n
    return F.concat(F.array_repeat(pad, F.greatest(n - F.size(values), F.lit(0)).cast("int")), values)


def pad_and_trim(values: Column, n: int, pad: Column) -> Column:
    """Exactly n elements: the most recent ones, padded on the left."""
    return pad_left(last_n(values, n), n, pad)


def int_list(text: Column) -> Column:
    """Integers of a JSON array text, nulls and non-numbers removed; empty for anything else."""
    parsed = F.from_json(F.when(F.trim(text).startswith("["), text), "array<string>")
    numbers = F.transform(F.coalesce(parsed, F.array().cast("array<string>")), lambda x: x.try_cast("bigint"))
    return F.filter(numbers, lambda x: x.isNotNull())


def recency_buckets(prediction: Column, stamps: Column) -> Column:
    """Five-minute age classes from 1, capped at a year."""
    age = lambda t: F.greatest(F.unix_seconds(prediction) - F.unix_seconds(t), F.lit(0))
    return F.transform(
        stamps, lambda t: F.least(F.floor(age(t) / RECENCY_STEP_SECONDS) + 1, F.lit(RECENCY_CAP)).cast("int")
    )


def coarse_recency(seconds: Column) -> Column:
    """Nine recency classes from under five minutes to two weeks and more."""
    chain = F.lit(len(RECENCY_BOUNDS))
    for number, bound in reversed(list(enumerate(RECENCY_BOUNDS))):
        chain = F.when(seconds < bound, number).otherwise(chain)
    return chain


def modulo_ids(values: Column, cardinality: int) -> Column:
    """Ids folded into a vocabulary of fixed size."""
    return F.transform(values, lambda x: F.pmod(F.greatest(F.coalesce(x, F.lit(0)), F.lit(0)), F.lit(cardinality)))
