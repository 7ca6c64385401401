"""Column functions. All are built-in expressions; none depends on the session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from basketflow import schemas


def business_key(prefix: str, digits: int, number: Column) -> Column:
    """Prefix and zero-padded number; a number with more digits widens the key.

    ``format_string`` gives the same text but calls the Java formatter for each row. It is kept
    for negative numbers, where the sign takes one of the places.
    """
    n = number.cast("bigint")
    limit = 10**digits
    # The digits after the leading 1 of 10...0 + n are n with its zeros.
    padded = F.substring((n + limit).cast("string"), 2, digits)
    return (
        F.when((n >= 0) & (n < limit), F.concat(F.lit(prefix), padded))
        .when(n >= limit, F.concat(F.lit(prefix), n.cast("string")))
        .otherwise(F.when(n < 0, F.format_string(f"{prefix}%0{digits}d", n)))
    )


def transaction_key(number: Column) -> Column:
    return business_key(schemas.TRANSACTION_PREFIX, schemas.TRANSACTION_DIGITS, number)


def store_key(number: Column) -> Column:
    return business_key(schemas.STORE_PREFIX, schemas.STORE_DIGITS, number)


def sku_key(number: Column) -> Column:
    return business_key(schemas.SKU_PREFIX, schemas.SKU_DIGITS, number)


def parse_local_time(text: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` to a zoneless timestamp; any other text gives null.

    The shape test comes first because a cast alone also takes dates, ``T`` and fractions.
    """
    return F.when(text.rlike(schemas.DATE_SHAPE), text.try_cast("timestamp_ntz"))


def format_local_time(ts: Column) -> Column:
    """Zoneless timestamp to ``yyyy-MM-dd HH:mm:ss``; ``date_format`` would pass a zone."""
    return F.substring(ts.cast("timestamp_ntz").cast("string"), 1, 19)


def money(amount: Column, precision: int = 10) -> Column:
    """Two decimal places; text that is no number gives null."""
    return amount.try_cast(f"decimal({precision},2)")


def in_cents(amount: Column) -> Column:
    """A two-decimal amount as a whole number, for fast sums."""
    return (amount * 100).cast("bigint")


def wide_cents(cents: Column | str) -> Column:
    """Cents as a decimal whose sums have room for any number of rows."""
    return (F.col(cents) if isinstance(cents, str) else cents).cast("decimal(20,0)")


def from_cents(cents: Column | str) -> Column:
    """Exact: the cast only moves the point."""
    whole = F.col(cents) if isinstance(cents, str) else cents
    return (whole.cast("decimal(36,0)") * F.lit("0.01").cast("decimal(2,2)")).cast("decimal(38,2)")


def in_opening_hours(ts: Column) -> Column:
    """Monday to Saturday, from nine until just before nine in the evening."""
    return (
        (F.weekday(ts) != schemas.SUNDAY)
        & (F.hour(ts) >= schemas.OPENING_HOUR)
        & (F.hour(ts) < schemas.CLOSING_HOUR)
    )


def zone_time(ts: Column, zone: str = schemas.STORE_ZONE, source_zone: str = "UTC") -> Column:
    """Wall-clock time in ``zone`` for a wall-clock time in ``source_zone``."""
    return F.convert_timezone(F.lit(source_zone), F.lit(zone), ts)
