"""Pipeline stages over documents with columns of any name: what goes, what stays, how often.

Operators use helper columns of their own.  ``plain_names`` keeps the
columns that a stage works with and gives all others numbered names while it
runs, so that no input column can clash with a helper or be overwritten.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from qualis.llm import linededup, mixing, neardup, quality
from qualis.llm.common import checkpointed, saved, text_of

#: Columns of documents that stages work with; text must be there, a missing id or source is null.
WORKING = ("doc_id", "text", "source", "n_chars")
_MISSING = {"doc_id": "long", "source": "string"}


def plain_names(stage: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """A stage of (docs, ...) that sees the working columns and numbered ones, and returns the columns of docs."""
    @wraps(stage)
    def run(docs: DataFrame, *args) -> DataFrame:
        numbered = {c: c if c in WORKING else f"__column_{i}" for i, c in enumerate(docs.columns)}
        added = [c for c in _MISSING if c not in numbered]
        inner = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in numbered.items()], *[F.lit(None).cast(_MISSING[c]).alias(c) for c in added])
        return stage(inner, *args).select(*[F.col(n).alias(c) for c, n in numbered.items()])
    return run


@plain_names
def quality_stage(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows that neither the base rules nor the decision list learned from ``labels`` reject.

    A null or empty text fails the base rules.  Repeated rows are judged
    alike, null ids like others (they have no label); an empty table gives no
    rows, without labels only the base rules count.  Texts are judged whole.
    """
    rules = quality.fit(docs, labels)
    return quality.judge(docs, rules, carry=tuple(docs.columns)).where("kept").select(docs.columns)


@plain_names
def line_stage(docs: DataFrame) -> DataFrame:
    """Rows without the lines that repeat an earlier line; n_chars, where there is one, follows the text.

    Rows left without a word go, so do those with a null or empty text.
    Places are ordered by id (null first), the hash of the text and the line
    number, so of ties the same stay in every run.  Rows that agree in id and
    text keep the same lines.  An empty table gives no rows.
    """
    kept = linededup.dedup_lines(docs)
    if "n_chars" in docs.columns:
        kept = kept.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return kept.where(F.btrim("text", F.lit(" \t\n\x0b\x0c\r")) != "").select(docs.columns)


@plain_names
def near_stage(docs: DataFrame) -> DataFrame:
    """One row of each near-duplicate class: of the smallest id (null only if all are) the text of the smallest hash.

    Of rows that agree in id and text one stays, also where their other
    columns differ (the least of them).  All null and empty texts are one
    class.  An empty table gives no rows.  Texts are compared whole.
    """
    kept = neardup.classes(docs).where("kept").groupBy("class_key", "doc_id", "text_key").agg(F.count(F.lit(1)).alias("n"))
    kept = kept.groupBy("class_key").agg(F.min(F.struct("doc_id", "text_key", "n")).alias("k"))
    kept = checkpointed(kept.select(F.col("k.doc_id").alias("_id"), F.col("k.text_key").alias("_key"), F.col("k.n").alias("_n")))
    keyed = docs.withColumn("_text_key", neardup.text_key(text_of(docs)))
    on = keyed["doc_id"].eqNullSafe(kept["_id"]) & (keyed["_text_key"] == kept["_key"])
    alone = keyed.join(kept.where("_n = 1"), on, "left_semi").select(docs.columns)
    repeated = kept.where("_n > 1")
    if repeated.isEmpty():
        return alone
    rows = keyed.join(repeated, on, "left_semi").groupBy("doc_id", "_text_key").agg(F.min(F.struct(*docs.columns)).alias("row"))
    return alone.unionByName(rows.select("row.*"))


@plain_names
def mixing_stage(docs: DataFrame) -> DataFrame:
    """Each row as many times as the mix of its sources takes it (see ``mixing.mix``).

    Of n rows that agree in id, source and size, copies mod n take one copy
    more than the others, in the order of their hashes.  Rows without a word
    go; the null source is a source, null ids are ids; an empty table gives
    no rows.
    """
    copies = mixing.mix(docs, carry=True).groupBy("doc_id", "source", "size").agg(F.sum("copies").alias("copies"), F.count(F.lit(1)).alias("n"))
    copies = checkpointed(copies.where("copies > 0").select(F.col("doc_id").alias("_id"), F.col("source").alias("_source"), F.col("size").alias("_size"), "copies", "n"))
    sized = docs.withColumn("_words", F.regexp_count(text_of(docs), F.lit(mixing.WORD)).cast("long"))
    on = sized["doc_id"].eqNullSafe(copies["_id"]) & sized["source"].eqNullSafe(copies["_source"]) & (sized["_words"] == copies["_size"])
    taken = sized.join(copies.where("n = 1"), on).select(*docs.columns, F.col("copies").alias("_share"))
    like = copies.where("n > 1")
    n_like = like.count()
    if n_like:
        rows = numbered(sized.join(F.broadcast(like) if n_like <= mixing.BROADCAST_SOURCES else like, on), ["doc_id", "source", "_words"])
        share = F.floor(F.col("copies") / F.col("n")) + F.when(F.col("_number") <= F.col("copies") % F.col("n"), 1).otherwise(0)
        taken = taken.unionByName(rows.select(*docs.columns, share.cast("long").alias("_share")))
    return taken.where("_share > 0").withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_share")))).select(docs.columns)


def numbered(rows: DataFrame, like: list[str]) -> DataFrame:
    """Rows numbered from 1 (_number) within those that agree in the columns ``like``, in the order of their hashes.

    Hashes are numbered in 64 ranges, equal rows in 64 parts, each after what
    stands before, so that a group of very many rows is not one task's.
    """
    group = F.xxhash64(*[c for x in like for c in (F.col(x), F.col(x).isNull())])
    salt = F.pmod(F.monotonically_increasing_id(), F.lit(64))
    rows = saved(rows.withColumns({"_group": group, "_hash": F.xxhash64(*rows.columns), "_salt": salt}), "like")
    part = rows.groupBy("_group", F.shiftright("_hash", 58).alias("_range"), "_hash", "_salt").agg(F.count(F.lit(1)).alias("_rows"))
    up_to_here = (Window.unboundedPreceding, -1)
    total = part.groupBy("_group", "_range").agg(F.sum("_rows").alias("_rows"))
    before = total.select("_group", "_range", F.coalesce(F.sum("_rows").over(Window.partitionBy("_group").orderBy("_range").rowsBetween(*up_to_here)), F.lit(0)).alias("_ranges"))
    inside = F.sum("_rows").over(Window.partitionBy("_group", "_range").orderBy("_hash", "_salt").rowsBetween(*up_to_here))
    offsets = part.withColumn("_inside", F.coalesce(inside, F.lit(0))).join(before, ["_group", "_range"])
    offsets = checkpointed(offsets.select("_group", "_hash", "_salt", (F.col("_ranges") + F.col("_inside")).alias("_before")))
    own = F.row_number().over(Window.partitionBy("_group", "_hash", "_salt").orderBy("_hash"))
    return rows.withColumn("_own", own).join(offsets, ["_group", "_hash", "_salt"]).withColumn("_number", F.col("_before") + F.col("_own"))
