"""Epoch-millisecond clocks."""

from pyspark.sql import Column
from pyspark.sql import functions as F

HOUR_MS = 3_600_000
DAY_MS = 24 * HOUR_MS
LOOK_BACK_SECONDS = 12 * 3600


def now_ms() -> Column:
    return F.unix_millis(F.current_timestamp())


def epoch_ms(text: Column) -> Column:
    """Milliseconds of `2018-08-10T17:17:53Z` or `Mon Sep 10 13:05:35 +0000 2018`; null if neither."""
    iso = F.try_to_timestamp(text)
    # the weekday is dropped, as Spark's parser has no pattern letter for it
    worded = F.try_to_timestamp(F.substring(text, 5, 26), F.lit("MMM dd HH:mm:ss Z yyyy"))
    return F.unix_millis(F.coalesce(iso, worded))


def as_ms(now) -> Column:
    """Accept a number or a Column as a moment."""
    return now if isinstance(now, Column) else F.lit(int(now)).cast("bigint")


def since(clock: Column, now, milliseconds) -> Column:
    """Rolling look-back that includes its boundary."""
    return clock >= as_ms(now) - milliseconds
