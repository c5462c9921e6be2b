"""Hash-based columns. SHA-256 is used wherever another system must reproduce the value."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def sha_number(text: Column) -> Column:
    """First 32 bits of SHA-256 of the text as a non-negative bigint."""
    return F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("bigint")


def bucket(text: Column, buckets: int = 100) -> Column:
    """Sticky bucket in [0, buckets)."""
    return F.pmod(sha_number(text), F.lit(buckets))


def unit_interval(text: Column) -> Column:
    """Uniform draw in [0, 1) fixed by the text."""
    return sha_number(text) / F.lit(4294967296.0)


def payload_hash(columns: dict[str, Column]) -> Column:
    """SHA-256 of the canonical JSON of the columns, keys sorted, nulls written out."""
    fields = [columns[name].alias(name) for name in sorted(columns)]
    return F.sha2(F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}), 256)


def stable_id(*parts: Column) -> Column:
    """Deterministic id of a composite key."""
    return F.substring(F.sha2(F.concat_ws("|", *[p.cast("string") for p in parts]), 256), 1, 32)


URL_NAMESPACE = "6ba7b8119dad11d180b400c04fd430c8"  # fixed value: the name space of URLs


def name_uuid(name: Column, namespace: str = URL_NAMESPACE) -> Column:
    """Name-based id, version 5: SHA-1 of name space and name, with the version and variant bits set. Null stays null."""
    digest = F.sha1(F.concat(F.unhex(F.lit(namespace)), F.encode(name, "UTF-8")))
    part = lambda begin, size: F.substring(digest, begin, size)
    high_bits = F.translate(part(17, 1), "0123456789abcdef", "89ab89ab89ab89ab")  # the variant's bits, 10
    return F.concat(
        part(1, 8), F.lit("-"), part(9, 4), F.lit("-5"), part(14, 3), F.lit("-"), high_bits, part(18, 3), F.lit("-"), part(21, 12)
    )


def variant(user_id: Column, experiment: str, candidate_percent: int) -> Column:
    """Sticky experiment arm; 0 % and 100 % switch an arm off."""
    if candidate_percent <= 0:
        return F.lit("control")
    if candidate_percent >= 100:
        return F.lit("candidate")
    key = F.concat(F.lit(f"{experiment}:"), user_id.cast("string"))
    return F.when(bucket(key) < candidate_percent, "candidate").otherwise("control")


def shadow_sampled(user_id: Column, experiment: str, percent: int) -> Column:
    """Whether the user's request is mirrored to the candidate; its bucket is independent of the arm."""
    key = F.concat(F.lit(f"shadow:{experiment}:"), user_id.cast("string"))
    return bucket(key) < F.lit(percent)
