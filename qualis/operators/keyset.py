"""Key filters: which of a batch's keys a stored part may hold, without reading the part.

A filter is a blocked Bloom filter as a small table ``part, word, bits``: a
key's hash names one 64-bit word, in which four bits stand for the key.  The
words are made by one ``bit_or`` aggregate over the part's keys.  With a word
for every four keys about one key in a hundred is taken for present though it
is not (the test measures it); none that is present is missed.  Beside it
stand the lowest and the highest key.

Everything is a relational plan: the batch's keys are joined with the words
of the parts whose range covers them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KEYS_A_WORD = 4
STORED = "part string, word long, bits long"


def words(rows: int) -> int:
    return rows // KEYS_A_WORD + 1


def bounds(key: str) -> list[Column]:
    """Aggregates of a part: null keys, lowest and highest key (as text)."""
    return [F.count_if(F.col(key).isNull()).alias("nulls"), F.min(key).cast("string").alias("low"), F.max(key).cast("string").alias("high")]


def _mask(key: str) -> Column:
    """Four bits of the key's word, from a second hash."""
    h = f"xxhash64(`{key}`, 'bits')"
    return F.expr(" | ".join(f"shiftleft(1L, CAST(shiftrightunsigned({h}, {6 * k}) & 63 AS INT))" for k in range(4)))


def build(df: DataFrame, key: str, n_words: int, part: str) -> DataFrame:
    """The filter of the keys of ``df``."""
    keyed = df.where(F.col(key).isNotNull()).select(F.pmod(F.xxhash64(key), F.lit(n_words)).alias("word"), _mask(key).alias("mask"))
    return keyed.groupBy("word").agg(F.bit_or("mask").alias("bits")).select(F.lit(part).alias("part"), "word", "bits")


def possible(keys: DataFrame, key: str, parts: dict[str, dict], stored: DataFrame) -> DataFrame:
    """(key, part) for each key of ``keys`` that a part may hold.

    ``parts`` gives the range and the words of each part's filter, ``stored``
    the filters' rows.
    """
    kind = keys.schema[key].dataType.simpleString()
    ranges = F.array(*[F.struct(F.lit(name).alias("part"), F.lit(f["words"]).cast("long").alias("words"),
                                F.lit(f["low"]).cast(kind).alias("low"), F.lit(f["high"]).cast(kind).alias("high")) for name, f in parts.items()])
    covered = keys.select(key, _mask(key).alias("mask"), F.xxhash64(key).alias("hash"), F.explode(ranges).alias("r"))
    covered = covered.where(F.col(key).between(F.col("r.low"), F.col("r.high")))
    asked = covered.select(key, "mask", F.col("r.part").alias("part"), F.pmod("hash", F.col("r.words")).alias("word"))
    return asked.join(stored, ["part", "word"]).where(F.col("bits").bitwiseAND(F.col("mask")) == F.col("mask")).select(key, "part")
