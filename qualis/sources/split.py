"""Large single files read by many tasks: CSV with quoted line breaks, and one JSON document.

Spark's text source cuts a file into blocks and gives every piece between two
separators to the block it begins in.  Whether a piece begins inside quotes
depends on all text before it, so blocks are read in two steps:

* each block says what it does to a reader, whichever state the reader comes
  in: it turns "inside quotes" over or not, and it moves the depth of braces
  by one amount or by another.  Such effects combine associatively, so a scan
  over one small row per block gives the state in which each block begins;
* with that, pieces that belong together are known in every block, and only
  those (a record of several lines, the pieces of a list element) are grouped.

A group is one record or element; no task holds a file.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from qualis import schemas
from qualis.session import materialize
from qualis.sources.csv_source import text_schema, typed_rows
from qualis.sources.json_source import conform, element_schema, flatten, repair_legacy_text

_BLOCK = ("file", "block")
_BEFORE = (Window.unboundedPreceding, -1)


def pieces(spark: SparkSession, paths: str | list[str], separator: str) -> DataFrame:
    """file, block (its start), at (ascending within a block) and value of every piece between separators."""
    return spark.read.option("lineSep", separator).text(paths).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"), "value")


def _within() -> Window:
    return Window.partitionBy(*_BLOCK).orderBy("at").rowsBetween(*_BEFORE)


def _over_blocks() -> Window:
    """A file's blocks in order: one short row each."""
    return Window.partitionBy("file").orderBy("block").rowsBetween(*_BEFORE)


def _so_far(amount: Column | str, window: Window) -> Column:
    return F.coalesce(F.sum(amount).over(window), F.lit(0))


# -- CSV --------------------------------------------------------------------

def csv_records(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """file, number and record (text) of every CSV record; number 0 is a file's header.

    Quotes inside a cell must be doubled and the cell quoted, as exports write
    them.  Line breaks within quotes stay; the carriage return of a record's
    own line end goes; blank lines are no records.
    """
    lines = pieces(spark, paths, "\n").withColumn("quotes", F.regexp_count("value", F.lit('"')))
    blocks = lines.groupBy(*_BLOCK).agg(F.sum("quotes").alias("quotes"))
    begins = blocks.select(*_BLOCK, (_so_far("quotes", _over_blocks()) % 2).alias("inside_block"))
    lines = lines.join(begins, list(_BLOCK))
    lines = lines.withColumn("inside", (F.col("inside_block") + _so_far("quotes", _within())) % 2 == 1)
    blank = ~F.col("inside") & F.col("value").isin("", "\r")
    lines = lines.where(~blank).withColumn("open", F.col("inside") != (F.col("quotes") % 2 == 1))
    # records are numbered by the lines that begin one; a line that begins inside quotes goes on with the last of them
    counts = lines.groupBy(*_BLOCK).agg(F.count_if(~F.col("inside")).alias("begun"))
    first = counts.select(*_BLOCK, _so_far("begun", _over_blocks()).alias("begun_before"))
    lines = lines.join(first, list(_BLOCK))
    number = F.col("begun_before") + _so_far((~F.col("inside")).cast("long"), _within()) - F.col("inside").cast("long")
    lines = lines.withColumn("number", number)
    whole = ~F.col("inside") & ~F.col("open")
    alone = lines.where(whole).select("file", "number", F.col("value").alias("record"))
    parts = lines.where(~whole).groupBy("file", "number").agg(F.array_sort(F.collect_list(F.struct("block", "at", "value"))).alias("parts"))
    joined = parts.select("file", "number", F.array_join("parts.value", "\n").alias("record"))
    records = alone.unionByName(joined)
    return records.withColumn("record", F.regexp_replace("record", "\r$", ""))


def read_csv_split(spark: SparkSession, paths: str | list[str], table: str) -> DataFrame:
    """As ``read_csv``, but a file with line breaks in cells is read by as many tasks as it has blocks."""
    records = csv_records(spark, paths)
    options = {"escape": '"', "quote": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record", "multiLine": "true", "emptyValue": ""}
    schema = text_schema(table)
    cells = F.from_csv("record", schema.simpleString(), options)
    names = schemas.columns(table)
    rows = records.select("number", cells.alias("cells"), "record").select("number", "record", "cells.*")
    header = F.array(*[F.lower(F.trim(c)) for c in names])
    wrong = (F.col("number") == 0) & (F.col("_corrupt_record").isNotNull() | ~header.eqNullSafe(F.array(*[F.lit(n.lower()) for n in names])))
    checked = rows.filter(F.when(wrong, F.raise_error(F.concat(F.lit(f"{table}: the header names other columns: "), F.col("record"))))
                          .otherwise(F.col("number") > 0))
    return typed_rows(checked.drop("number", "record"), table)


# -- JSON -------------------------------------------------------------------

def json_elements(spark: SparkSession, paths: str | list[str], legacy: bool = True) -> DataFrame:
    """file, number and text of every element of the documents' top-level list.

    A file is one document ``{"list": [{...}, ...], ...}``; the list comes
    first, what follows it is left alone.  ``legacy``: its text is repaired as
    ``parse_documents`` does.  A document without a list is an error.
    """
    found = pieces(spark, paths, "}")
    if legacy:
        # no repair's text holds a brace, so repairing pieces is repairing the document
        found = found.withColumn("value", repair_legacy_text(F.col("value")))
    plain = F.regexp_replace("value", r"\\.", "")  # a quote after a backslash ends nothing
    found = found.withColumn("quotes", F.regexp_count(plain, F.lit('"')) % 2)
    # braces opened outside strings, for a piece that begins outside and for one that begins inside a string
    outside = F.regexp_replace(plain, r'"[^"]*("|$)', "")
    inside = F.regexp_replace(F.regexp_replace(plain, r'^[^"]*("|$)', ""), r'"[^"]*("|$)', "")
    # the brace that ends a piece closes an object unless it stands in a string
    found = found.withColumns({
        "if_outside": F.regexp_count(outside, F.lit(r"\{")) - F.when(F.col("quotes") == 0, 1).otherwise(0),
        "if_inside": F.regexp_count(inside, F.lit(r"\{")) - F.when(F.col("quotes") == 1, 1).otherwise(0)})
    found = materialize(found.withColumn("turned", _so_far("quotes", _within()) % 2))
    same = F.when(F.col("turned") == 0, F.col("if_outside")).otherwise(F.col("if_inside"))
    other = F.when(F.col("turned") == 0, F.col("if_inside")).otherwise(F.col("if_outside"))
    effect = found.groupBy(*_BLOCK).agg(F.sum("quotes").alias("quotes"), F.sum(same).alias("same"), F.sum(other).alias("other"))
    state = effect.withColumn("inside_block", _so_far("quotes", _over_blocks()) % 2)
    moved = F.when(F.col("inside_block") == 0, F.col("same")).otherwise(F.col("other"))
    state = state.select(*_BLOCK, "inside_block", _so_far(moved, _over_blocks()).alias("depth_block"))
    found = found.join(state, list(_BLOCK)).withColumn("inside", (F.col("inside_block") + F.col("turned")) % 2)
    found = found.withColumn("move", F.when(F.col("inside") == 0, F.col("if_outside")).otherwise(F.col("if_inside")))
    found = found.withColumn("depth", F.col("depth_block") + _so_far("move", _within()) + F.col("move"))
    # an element ends with the piece that closes a brace and comes back to the document's own depth
    closed = (F.col("inside") == F.col("quotes")) & (F.col("depth") == 1)
    found = materialize(found.select(*_BLOCK, "at", "value", closed.alias("closed")))
    ended = found.groupBy(*_BLOCK).agg(F.count_if("closed").alias("ended"))
    ended = ended.select(*_BLOCK, _so_far("ended", _over_blocks()).alias("ended_before"))
    found = found.join(ended, list(_BLOCK)).withColumn("number", F.col("ended_before") + _so_far(F.col("closed").cast("long"), _within()))
    # the list ends where an element would begin with its bracket; what a document holds after that is left alone
    empty_list, end = F.col("begin").rlike(r'^\s*\{\s*"list"\s*:\s*\[\s*\]'), F.col("begin").rlike(r"^\s*\]")
    begins = found.groupBy("file", "number").agg(F.min_by(F.substring("value", 1, 200), F.struct("block", "at")).alias("begin"))
    sizes = begins.groupBy("file").agg(F.min(F.when(F.when(F.col("number") == 0, empty_list).otherwise(end), F.col("number"))).alias("elements"))
    grouped = found.groupBy("file", "number").agg(F.array_sort(F.collect_list(F.struct("block", "at", "value"))).alias("parts"))
    # a row for each file
    text = grouped.select("file", "number", F.array_join("parts.value", "}").alias("text")).join(F.broadcast(sizes), "file")
    opening = r'^\s*\{\s*"list"\s*:\s*\[\s*'
    first = F.col("number") == 0
    whole = F.col("elements").isNotNull() & F.when(first, F.col("text").rlike(opening)).otherwise(
        (F.col("number") >= F.col("elements")) | F.col("text").rlike(r"^\s*,\s*\{"))
    text = text.filter(F.when(~whole, F.raise_error(F.concat(F.lit("document without a whole list: "), F.substring("text", 1, 80))))
                       .otherwise(F.col("number") < F.col("elements")))
    element = F.regexp_replace("text", F.when(first, opening).otherwise(r"^\s*,\s*"), F.lit(""))
    return text.select("file", "number", F.concat(element, F.lit("}")).alias("text"))


def read_json_split(spark: SparkSession, paths: str | list[str], legacy: bool = True) -> DataFrame:
    """As ``read_json_documents``, but a document is read by as many tasks as its file has blocks."""
    elements = json_elements(spark, paths, legacy).select(F.from_json("text", element_schema(), {"mode": "FAILFAST"}).alias("e")).select("e.*")
    return conform(flatten(elements)).hint("rebalance", "subscription_id")
