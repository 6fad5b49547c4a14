"""Landed CSV exports -> typed raw tables.

Reading follows what the exports need: a header row, double-quote
escaping, commas and line breaks inside quoted fields.  Typing follows
the declared raw schemas instead of inference.  Two rules keep the
results equal to the reference's loader:

* the usual missing-value tokens (``NA``, ``N/A``, ``null``, ``NaN``, ...)
  and blank cells are NULL;
* a row with fewer fields than the header is padded with NULLs, but a row
  with more fields, or a cell that does not parse as its declared type, is
  an error, and so is a header that names other columns or another order.

Everything is column expressions over ``spark.read.csv``: the checks are
``raise_error`` projections evaluated on the executors while the files
are read, so no row is inspected on the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from qualis import schemas

# Cell texts read as missing (the common CSV missing-value
# tokens of dataframe readers), plus the blank cell.
NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# Landed file name of each raw table.
LANDED_FILES = {
    "autoqa_ratings": "autoqa_ratings_test - autoqa_ratings.csv",
    "autoqa_reviews": "autoqa_reviews_test - autoqa_reviews_test.csv",
    "autoqa_root_cause": "autoqa_root_cause_test - autoqa_root_cause_test.csv",
    "conversations": "conversations_test - conversations.csv",
    "manual_rating": "manual_rating_test - manual_rating.csv",
    "manual_reviews": "manual_reviews_test - manual_reviews.csv",
}

_CORRUPT = "_corrupt_record"


def text_schema(table: str) -> T.StructType:
    """A raw table's columns as text, and the place of a malformed row."""
    return T.StructType([T.StructField(c, T.StringType()) for c in [*schemas.columns(table), _CORRUPT]])


def read_csv(spark: SparkSession, path: str | list[str], table: str, multiline: bool = True) -> DataFrame:
    """Read one raw table's CSV file(s) with its declared schema.

    ``multiline`` allows line breaks inside quoted cells (the exports have
    them); such files are read one task per file.  ``split.read_csv_split``
    reads a large one with a task per block.
    """
    raw = (spark.read.schema(text_schema(table))
           .option("header", True).option("enforceSchema", False).option("escape", '"').option("quote", '"')
           .option("multiLine", multiline).option("mode", "PERMISSIVE")
           .option("columnNameOfCorruptRecord", _CORRUPT)
           .option("nullValue", None).option("emptyValue", "")
           .csv(path))
    return typed_rows(raw, table)


def typed_rows(raw: DataFrame, table: str) -> DataFrame:
    """Rows of text cells (``text_schema``) as the raw table's; long rows and cells of another type are errors."""
    names = schemas.columns(table)
    # A malformed line is either short (padded: allowed) or long (an error).
    wide = T.StructType([T.StructField(f"f{i}", T.StringType()) for i in range(len(names) + 1)])
    extra = F.from_csv(F.col(_CORRUPT), wide.simpleString(),
                       {"escape": '"', "quote": '"', "mode": "PERMISSIVE"}).getField(f"f{len(names)}")
    long_row = F.col(_CORRUPT).isNotNull() & extra.isNotNull()
    checked = raw.filter(F.when(long_row, F.raise_error(
        # naming every column here keeps the check the same whichever columns are read
        F.concat(F.lit(f"{table}: row has more fields than the header: "), F.col(_CORRUPT), F.lit(" read as "),
                 F.concat_ws("|", *names))))
        .otherwise(F.lit(True)))
    out = []
    for name, typ in schemas.RAW_COLUMNS[table]:
        s = F.when(~F.col(name).isin(*NULL_TOKENS), F.col(name))
        if typ == "string":
            out.append(s.alias(name))
            continue
        if typ == "bigint":
            # integer columns may arrive as "12.0" when a blank made the exporter write floats
            v = F.coalesce(s.try_cast("bigint"),
                           F.when(s.try_cast("double") == F.round(s.try_cast("double")),
                                  s.try_cast("double").try_cast("bigint")))
        else:
            v = s.try_cast(typ)
        out.append(F.when(s.isNotNull() & v.isNull(), F.raise_error(
            F.concat(F.lit(f"{table}.{name}: not a {typ}: "), s))).otherwise(v).cast(typ).alias(name))
    return checked.select(*out)
