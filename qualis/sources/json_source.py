"""Nested subscription export (JSON documents) -> flat raw table.

A document is ``{"list": [{"subscription": {...}, "customer": {...,
"billing_address": {...}}}, ...]}``.  Legacy exports are Python-literal
text (single quotes, ``True``/``False``, arrays written as quoted
strings); they are repaired by plain text replacement before parsing,
exactly in this order: ``'[`` -> ``[``, ``]'`` -> ``]``, ``'`` -> ``"``,
``True``/``False`` -> ``true``/``false``.  The repair is lossy (an
apostrophe inside a value breaks the document, which then fails to
parse); valid JSON passes through it unchanged unless it contains those
texts, so valid exports should use ``read_json_lines``.

Steps, all column expressions: whole-file text -> repair -> strict
``from_json`` (FAILFAST) -> ``explode(list)`` -> recursive flatten of
nested objects with ``_`` (arrays stay arrays) -> declared raw columns
-> signup date from ``customer_created_at``.  Files are read in
parallel, one task per document; right after the explode the rows are
rebalanced by ``subscription_id`` (the merge key) with AQE splitting any
hot key, so one large document does not become one large downstream task.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from qualis import schemas
from qualis.functions.times import epoch_day

# The legacy-text repairs, in the order they are applied.
REPAIRS = (("'[", "["), ("]'", "]"), ("'", '"'), ("True", "true"), ("False", "false"))

# Nesting of the flat column names (longest prefix first).
NESTING = (("customer_billing_address_", ("customer", "billing_address")),
           ("customer_", ("customer",)),
           ("subscription_", ("subscription",)))

SIGNUP_DATE = "dt_customer_signup_date"


def repair_legacy_text(c: Column) -> Column:
    for old, new in REPAIRS:
        c = F.replace(c, F.lit(old), F.lit(new))
    return c


# A string in either quotes with backslash escapes, or what lies between strings.
_TOKENS = r"""(?s)'[^'\\]*+(?:\\.[^'\\]*+)*+'|"[^"\\]*+(?:\\.[^"\\]*+)*+"|[^'"]+"""


def literal_to_json(c: Column) -> Column:
    """Text of a Python literal (dicts, lists, strings, numbers, None, True, False) as JSON, token by token.

    Only what stands outside strings is translated, so apostrophes and the
    words None, True and False inside values stay.  Strings take JSON's
    quotes and escapes.  A string that holds an array (``'[...]'``) becomes
    the array, as in legacy exports.  Valid JSON passes unchanged but for such
    strings.
    """
    return _tokens_to_json(c, lambda inner: _tokens_to_json(inner, None))


def _tokens_to_json(c: Column, array: Callable[[Column], Column] | None) -> Column:
    def string(token: Column) -> Column:
        inner = F.substring(token, F.lit(2), F.length(token) - 2)
        # JSON escapes double quotes, not apostrophes, and writes \xHH as \u00HH; a backslash belongs to the character after it
        own = F.when(token.startswith("'"), F.regexp_replace(inner, r'(?<!\\)((?:\\\\)*)"', r'$1\\"')).otherwise(inner)
        own = F.regexp_replace(own, r"(?s)(\\[^'])|\\(')", "$1$2")
        own = F.regexp_replace(own, r"(?<!\\)((?:\\\\)*)\\x([0-9a-fA-F]{2})", r"$1\\u00$2")
        json_string = F.concat(F.lit('"'), own, F.lit('"'))
        if array is None:
            return json_string
        return F.when(inner.rlike(r"(?s)^\[.*\]$"), array(inner)).otherwise(json_string)

    def translated(token: Column) -> Column:
        for word, json_word in (("None", "null"), ("True", "true"), ("False", "false")):
            token = F.regexp_replace(token, rf"\b{word}\b", json_word)
        return token

    tokens = F.regexp_extract_all(c, F.lit(_TOKENS), F.lit(0))
    return F.array_join(F.transform(tokens, lambda t: F.when(t.startswith("'") | t.startswith('"'), string(t)).otherwise(translated(t))), "")


def _path_of(flat: str) -> tuple[str, ...]:
    for prefix, path in NESTING:
        if flat.startswith(prefix):
            return path + (flat[len(prefix):],)
    return (flat,)


def element_schema() -> T.StructType:
    """Nested schema of one list element, derived from the flat raw columns."""
    tree: dict = {}
    for name, typ in schemas.RAW_COLUMNS["customer_subscriptions"]:
        if name == SIGNUP_DATE:
            continue
        node = tree
        *parents, leaf = _path_of(name)
        for p in parents:
            node = node.setdefault(p, {})
        node[leaf] = typ

    def build(node: dict) -> T.StructType:
        return T.StructType([
            T.StructField(k, build(v) if isinstance(v, dict) else T._parse_datatype_string(v))
            for k, v in node.items()])
    return build(tree)


def document_schema() -> T.StructType:
    return T.StructType([T.StructField("list", T.ArrayType(element_schema()))])


def flatten(df: DataFrame, sep: str = "_") -> DataFrame:
    """Flatten nested struct columns to ``a_b_c`` columns at any depth; arrays stay whole."""
    def walk(prefix: list[str], dtype: T.DataType):
        if isinstance(dtype, T.StructType):
            for f in dtype.fields:
                yield from walk(prefix + [f.name], f.dataType)
        else:
            path = ".".join(f"`{p}`" for p in prefix)
            yield F.col(path).alias(sep.join(prefix))
    cols = []
    for f in df.schema.fields:
        cols.extend(walk([f.name], f.dataType))
    return df.select(*cols)


def conform(flat: DataFrame) -> DataFrame:
    """Declared raw columns in order; absent ones as typed NULLs; signup date derived."""
    have = set(flat.columns)
    cols = []
    for name, typ in schemas.RAW_COLUMNS["customer_subscriptions"]:
        if name == SIGNUP_DATE:
            created = F.col("customer_created_at") if "customer_created_at" in have else F.lit(None)
            cols.append(epoch_day(created.cast("bigint")).alias(name))
        elif name in have:
            cols.append(F.col(name).cast(typ).alias(name))
        else:
            cols.append(F.lit(None).cast(typ).alias(name))
    return flat.select(*cols)


def parse_documents(docs: DataFrame, legacy: bool | str = True) -> DataFrame:
    """One row per list element from a DataFrame of whole documents (column ``value``).

    ``legacy``: True repairs by plain replacement, "tokens" by
    ``literal_to_json``, False takes the text as JSON.
    """
    text = F.col("value")
    if legacy:
        text = literal_to_json(text) if legacy == "tokens" else repair_legacy_text(text)
    parsed = docs.select(F.from_json(text, document_schema(), {"mode": "FAILFAST"}).alias("doc"))
    # a document that is empty or has no list is an error, not an export of no rows
    items = F.when(F.col("doc.list").isNull(), F.raise_error(F.lit("document without a list"))).otherwise(F.col("doc.list"))
    elements = parsed.select(F.explode(items).alias("e")).select("e.*")
    return conform(flatten(elements)).hint("rebalance", "subscription_id")


def read_json_documents(spark: SparkSession, paths: str | list[str], legacy: bool | str = True) -> DataFrame:
    """Whole-document JSON files (one document per file), legacy text repaired first."""
    docs = spark.read.option("wholetext", True).text(paths)
    return parse_documents(docs, legacy)


def read_json_lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Valid JSON, one list element per line (splittable; the scalable export form)."""
    elements = spark.read.schema(element_schema()).option("mode", "FAILFAST").json(paths)
    return conform(flatten(elements)).hint("rebalance", "subscription_id")


def to_elements(raw_subscriptions: DataFrame) -> DataFrame:
    """Nest flat subscription rows back into list elements (the export's shape)."""
    tree: dict = {}
    for name, _ in schemas.RAW_COLUMNS["customer_subscriptions"]:
        if name == SIGNUP_DATE:
            continue
        node = tree
        *parents, leaf = _path_of(name)
        for p in parents:
            node = node.setdefault(p, {})
        node[leaf] = name

    def build(node: dict) -> Column:
        return F.struct(*[(build(v) if isinstance(v, dict) else F.col(v)).alias(k) for k, v in node.items()])
    return raw_subscriptions.select(*[build(v).alias(k) for k, v in tree.items()])


def write_documents(raw_subscriptions: DataFrame, path: str, max_elements: int = 50_000,
                    legacy: bool | str = True) -> int:
    """Write the export as whole-document files of at most ~``max_elements`` elements.

    A document is one JSON value on one line of a file, so one task writes
    it: element by element, in a sort that spills, so that no task holds it.
    The number of documents grows with the data (``ceil(rows / max_elements)``,
    from one count) instead of being fixed.  Rows go to documents by a hash
    of the whole element (stable under task retries; rows sharing an id
    still spread).  Returns the number
    of documents.
    """
    n_docs = max(1, -(-raw_subscriptions.count() // max_elements))
    el = to_elements(raw_subscriptions).withColumn(
        "doc", F.pmod(F.xxhash64(F.col("subscription"), F.col("customer")), F.lit(n_docs)))
    text = F.to_json(F.struct("subscription", "customer"), {"ignoreNullFields": str(legacy != "tokens").lower()})
    opening, closing = '{"list":[', "]}"
    if legacy == "tokens":
        # a literal that keeps double quotes, as the language writes strings with apostrophes
        for word, own in (("null", "None"), ("true", "True"), ("false", "False")):
            text = F.replace(text, F.lit(f":{word}"), F.lit(f": {own}"))
    elif legacy:
        text = F.replace(F.replace(F.replace(text, F.lit('"'), F.lit("'")), F.lit("true"), F.lit("True")),
                         F.lit("false"), F.lit("False"))
        opening = opening.replace('"', "'")
    # the place is unique, so every sort of a document's elements is the same
    rows = el.select("doc", F.monotonically_increasing_id().alias("place"), text.alias("value"))
    order = Window.partitionBy("doc").orderBy("place")
    rows = rows.withColumns({"first": F.lag("place").over(order).isNull(), "last": F.lead("place").over(order).isNull()})
    value = F.concat(F.when(F.col("first"), opening).otherwise(","), "value", F.when(F.col("last"), closing).otherwise(""))
    (rows.select("doc", "place", value.alias("value")).sortWithinPartitions("doc", "place").select("doc", "value")
     .write.mode("overwrite").option("lineSep", " ").partitionBy("doc").text(path))
    return n_docs
