"""Event time as whole microseconds, and the minute grid laid over it."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MINUTE_US = 60_000_000


def minute_of(ts_us: Column) -> Column:
    """Index of the minute holding ``ts_us``; whole-number arithmetic, right before 1970 too."""
    return F.floor((ts_us - F.pmod(ts_us, F.lit(MINUTE_US))) / F.lit(MINUTE_US))


def iso_utc(ts_us: Column, digits: int = 3) -> Column:
    """ISO text with ``Z``; ``digits`` 3 or 6 decimals, cut off rather than rounded."""
    pattern = "yyyy-MM-dd'T'HH:mm:ss." + "S" * digits + "'Z'"
    epoch = F.lit("1970-01-01").cast("timestamp_ntz")
    return F.date_format(F.timestamp_add("MICROSECOND", ts_us, epoch), pattern)
