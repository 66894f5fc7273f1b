"""Column functions: quantities, hashes, times, exact percentiles' thresholds."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

INT64_MAX = 2**63 - 1
HASH = r"^0x[0-9a-f]{64}\z"
QUANTITY = r"^0x(?:0|[1-9a-f][0-9a-f]*)\z"
UUID4 = r"^[0-9a-f]{8}-[0-9a-f]{4}-4[0-9a-f]{3}-[89ab][0-9a-f]{3}-[0-9a-f]{12}\z"


def is_hash(c: Column) -> Column:
    """Whether text is a 32-byte hash: 0x and 64 lower-case hex digits. False for null."""
    return F.coalesce(c.rlike(HASH), F.lit(False))


def packed_hash(c: Column) -> Column:
    """Text as bytes: 32 for a hash, which shuffles do not compress as text; of any other text its own after 33 bytes of 0xff, so none is taken for a hash and hashes sort as their texts do."""
    return F.when(is_hash(c), F.unhex(F.substring(c, 3, 64))).otherwise(F.concat(F.unhex(F.lit("ff" * 33)), c.cast("binary")))


def unpacked_hash(c: Column) -> Column:
    """The text that packed_hash made bytes of."""
    return F.when(F.octet_length(c) == 32, F.concat(F.lit("0x"), F.lower(F.hex(c)))).otherwise(F.substring(c, 34, 2**31 - 1).cast("string"))


def is_uuid4(c: Column) -> Column:
    return F.coalesce(c.rlike(UUID4), F.lit(False))


def quantity(c: Column) -> Column:
    """A JSON-RPC quantity as bigint; null unless it is 0x0, or 0x and hex without a leading zero, up to 2^63-1."""
    # Sixteen digits are all that conv takes without an overflow error; more exceed 2^63-1 anyway.
    fits = c.rlike(QUANTITY) & (F.length(c) <= 18)
    number = F.conv(F.when(fits, F.substring(c, 3, 16)), 16, 10).cast("decimal(20,0)")
    return F.when(number <= INT64_MAX, number.cast("bigint"))


def to_quantity(c: Column) -> Column:
    return F.concat(F.lit("0x"), F.lower(F.hex(c)))


def as_hash(c: Column) -> Column:
    """0x and the SHA-256 of a value's text."""
    return F.concat(F.lit("0x"), F.sha2(c.cast("string"), 256))


def utc_text(c: Column) -> Column:
    """Unix seconds as 2026-01-02T03:04:05Z, whatever the session's time zone."""
    at = F.timestamp_add("SECOND", c, F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))
    return F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def unix_seconds_ntz(c: Column) -> Column:
    """Whole seconds since 1970 of a time stamp without a zone."""
    return F.timestamp_diff("SECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), c).cast("bigint")


def threshold(gas: Column, percent: int) -> Column:
    """The whole-number ceiling of gas * percent / 100, exactly."""
    return F.floor((gas.cast("decimal(20,0)") * F.lit(percent).cast("decimal(3,0)") + F.lit(99).cast("decimal(3,0)")) / F.lit(100).cast("decimal(3,0)"))


_SHAPE = r"^\d{4}-\d{2}-\d{2}(?:T\d{2}(?::\d{2}(?::\d{2})?)?(?:Z|[+-]\d{2}:\d{2}))?\z"
_ZONED = r"T.*[+-](?:[01]\d|2[0-3]):[0-5]\d\z"
#: Length of the text before the zone -> what completes it, and the seconds it stands for.
_PRECISIONS = {10: ("T00:00:00", 86_400), 13: (":00:00", 3_600), 16: (":00", 60), 19: ("", 1)}


def time_bound(c: Column, end: bool) -> Column:
    """A time bound as unix seconds, null if it is none.

    Bounds are a date, or a date with hour, minute or second and a zone. A start is the beginning of
    the stated period, an end its final second.
    """
    zoned = c.rlike(_ZONED)
    local = F.regexp_replace(c, r"(?<=.{13})(?:Z|[+-].*)\z", "")
    size = F.length(local)
    pick = lambda k: F.coalesce(*(F.when(size == n, F.lit(p[k])) for n, p in _PRECISIONS.items()))
    # The zone is taken off by hand: parsing depends on no session setting, and all offsets below a day are read.
    at = F.unix_seconds(F.try_to_timestamp(F.concat(local, pick(0), F.lit("Z")), F.lit("yyyy-MM-dd'T'HH:mm:ssXXX")))
    zone = F.right(c, F.lit(6))
    offset = F.when(zoned, F.when(zone.startswith("-"), -1).otherwise(1) * (F.substring(zone, 2, 2).cast("int") * 3600 + F.substring(zone, 5, 2).cast("int") * 60)).otherwise(0)
    bound = at - offset + (pick(1) - 1 if end else 0)
    fits = c.rlike(_SHAPE) & (zoned | c.endswith("Z") | (F.length(c) == 10))
    return F.when(fits & (bound >= 0), bound.cast("bigint"))
