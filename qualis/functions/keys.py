"""Surrogate keys and natural-id normalisation (all JVM-side expressions)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def whole_id(c: Column | str, dtype: T.DataType | None = None) -> Column:
    """Natural id as ``bigint`` for equality lookups.

    Integral ids pass through.  A float id equals an integer member only
    when it is integral; a non-integral float id has no member (its text
    form never equals an integer's), so it maps to NULL.
    """
    c = _c(c)
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return F.when(c == F.round(c), c.cast("bigint"))
    return c.cast("bigint")


def rounded_id(c: Column | str) -> Column:
    """Float id rounded half away from zero to ``bigint`` (2.5 -> 3, -2.5 -> -3)."""
    return F.round(_c(c)).cast("bigint")


def id_string(c: Column | str, dtype: T.DataType | None = None) -> Column:
    """Text form of an id as the keys hash it: integral floats print without ``.0``."""
    c = _c(c)
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return F.when(c == F.round(c), c.cast("bigint").cast("string")).otherwise(c.cast("string"))
    return c.cast("string")


def surrogate_key(*parts: Column | str) -> Column:
    """``md5`` hex of the concatenated parts; NULL if any part is NULL."""
    cols = [_c(p) for p in parts]
    return F.md5(cols[0] if len(cols) == 1 else F.concat(*cols))


def id_key(c: Column | str, dtype: T.DataType | None = None) -> Column:
    """``md5(CAST(id AS STRING))`` with float-aware formatting."""
    return F.md5(id_string(c, dtype))


def joined_key(*parts: Column | str, sep: str = "_") -> Column:
    """``md5(concat(p1, sep, p2, ...))`` with NULL propagation (no ``concat_ws``)."""
    cols: list[Column] = []
    for i, p in enumerate(parts):
        if i:
            cols.append(F.lit(sep))
        cols.append(_c(p))
    return F.md5(F.concat(*cols))


def packed(c: Column | str) -> Column:
    """A text as bytes that a shuffle carries: an md5 in hex as its 16 bytes, any other text behind 17 zero bytes.

    Equal exactly where the texts are; ``unpacked`` gives the text back.
    """
    c = _c(c)
    other = F.concat(F.lit(bytes(17)), c.cast("binary"))
    return F.when(c.rlike(r"\A[0-9a-f]{32}\z"), F.unhex(c)).otherwise(other)


def unpacked(c: Column | str) -> Column:
    c = _c(c)
    return F.when(F.octet_length(c) == 16, F.lower(F.hex(c))).otherwise(F.substring(c, 18, 2**31 - 1).cast("string"))
