"""Strict and safe time parsing, date keys.  All built-in expressions.

Times are ``timestamp_ntz`` throughout: raw times are UTC wall-clock
text, and NTZ keeps results independent of the session time zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Shapes accepted by the safe parsers ('%Y-%m-%d %H:%M:%S'
# and '%Y-%m-%d'; month, day and time parts may have one or two digits).
TS_SHAPE = r"^\d{4}-\d{1,2}-\d{1,2} \d{1,2}:\d{1,2}:\d{1,2}$"
DATE_SHAPE = r"^\d{4}-\d{1,2}-\d{1,2}$"

# A full date at the start; a clock time that an offset follows.
FULL_DATE = r"^\s*\d{4}-\d{1,2}-\d{1,2}([ T]|\s*$)"
WITH_OFFSET = r":\d{1,2}(\.\d+)?\s*(Z|UTC|GMT|[+-]\d{1,2}(:\d{2})?)\s*$"

# The sentinel for sources without a time, and the
# default high-water mark of an empty target.
SENTINEL_TS = "1970-01-01 00:00:00"
EMPTY_WATERMARK_TS = "1900-01-01 00:00:00"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strict_ts(c: Column | str) -> Column:
    """``CAST(x AS TIMESTAMP)`` in UTC: an offset is applied; text that is malformed or lacks a full date is an error."""
    c = _c(c)
    utc = F.timestamp_add("MICROSECOND", F.unix_micros(c.cast("timestamp")), ts_literal(SENTINEL_TS))
    return (F.when(~c.rlike(FULL_DATE), F.raise_error(F.concat(F.lit("not a timestamp: "), c)).cast("timestamp_ntz"))
            .when(c.rlike(WITH_OFFSET), utc).otherwise(c.cast("timestamp_ntz")))


def safe_ts(c: Column | str) -> Column:
    """``SAFE.PARSE_TIMESTAMP('%Y-%m-%d %H:%M:%S', x)``: NULL when not parseable."""
    c = _c(c)
    return F.when(c.rlike(TS_SHAPE), c.try_cast("timestamp_ntz"))


def safe_date(c: Column | str) -> Column:
    """``SAFE.PARSE_DATE('%Y-%m-%d', x)``: NULL when not parseable."""
    c = _c(c)
    return F.when(c.rlike(DATE_SHAPE), c.try_cast("date"))


def ts_literal(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def date_key(c: Column | str) -> Column:
    """``CAST(FORMAT_*('%Y%m%d', x) AS INT)`` as ``bigint``; NULL in, NULL out."""
    return F.date_format(_c(c), "yyyyMMdd").cast("bigint")


def epoch_day(c: Column | str) -> Column:
    """UTC calendar date of epoch seconds, independent of the session zone."""
    return F.date_from_unix_date(F.floor(_c(c) / 86400).cast("int"))
