"""Secret scan with a trigram inverted index, in DataFrame functions only.

From each rule's regular expression a Boolean trigram query is derived: an
AND over its mandatory literal stretches of an OR over their spellings of an
AND over the spelling's trigrams.  The index holds the postings (trigram,
document) of every trigram that some rule asks for.  Intersecting postings
gives, for each rule, the documents that can match at all; only those are
verified with the expression itself.  A rule without mandatory trigrams
scans every document.

Trigrams are taken of lower-cased text and expressions, so a posting list
can only be too long, never too short.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce
from itertools import product

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from qualis.llm.common import id_and_text, table


@dataclass(frozen=True)
class Rule:
    """A secret's pattern (in the syntax that Java, RE2 and Python share).

    A match counts if group ``group`` of it has at least ``least`` characters.
    """

    kind: str
    pattern: str
    group: int = 0
    least: int = 0
    base: bool = False


#: The base kinds in order, then well-known key formats.
RULES = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12, base=True),
    Rule("access", r"AKIA[A-Z0-9]{14,}", base=True),
    Rule("hex", r"[0-9a-f]{16,}", base=True),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[0-9A-Za-z_-]{35}"),
    Rule("stripe", r"(?:sk|rk)_live_[0-9A-Za-z]{16,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+"),
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("url_login", r"://[A-Za-z0-9._%-]+:[^/@:\x20\x09-\x0D]{6,}@[A-Za-z0-9.-]+"),
)

#: Spellings of one literal stretch that are followed up; a stretch with more is cut there.
MAX_SPELLINGS = 64


def trigram_query(pattern: str) -> list[list[list[str]]]:
    """AND of stretches, each an OR of spellings, each an AND of trigrams; [] if nothing is mandatory."""
    stretches: list[set[str]] = []
    for spellings in _stretches(re._parser.parse(pattern)):
        if spellings and min(map(len, spellings)) >= 3:
            stretches.append(spellings)
    query = []
    for spellings in stretches:
        sets = {frozenset(s[i:i + 3] for i in range(len(s) - 2)) for s in spellings}
        # a spelling whose trigrams include all of another's adds nothing to the OR
        query.append(sorted(sorted(s) for s in sets if not any(other < s for other in sets)))
    return query


def _stretches(parsed) -> list[set[str]]:
    """Sets of spellings, one of which must occur, between parts that are not literal."""
    done, now = [], {""}
    for op, arg in parsed:
        exact = _exact(op, arg)
        if exact is not None and len(now) * len(exact) <= MAX_SPELLINGS:
            now = {a + b for a, b in product(now, exact)}
            continue
        done.append(now)
        now = exact or {""}
        if exact is None:
            inner = _inside(op, arg)
            done += _stretches(inner) if inner else []
    return [*done, now]


def _inside(op, arg):
    """The part of a node that must match at least once."""
    if str(op) == "SUBPATTERN":
        return arg[-1]
    if str(op) in ("MAX_REPEAT", "MIN_REPEAT", "POSSESSIVE_REPEAT") and arg[0] >= 1:
        return arg[2]
    return None


def _exact(op, arg) -> set[str] | None:
    """All lower-cased spellings of a node, if they are few."""
    name = str(op)
    if name == "LITERAL":
        return {chr(arg).lower()}
    if name == "IN" and all(str(o) == "LITERAL" for o, _ in arg):
        return {chr(v).lower() for _, v in arg}
    if name == "SUBPATTERN":
        return _all_of(arg[-1])
    if name == "BRANCH":
        parts = [_all_of(p) for p in arg[1]]
        found = None if None in parts else set().union(*parts)
        return found if found is not None and len(found) <= MAX_SPELLINGS else None
    if name in ("MAX_REPEAT", "MIN_REPEAT") and arg[1] <= 1:
        inner = _all_of(arg[2])
        return None if inner is None else inner | ({""} if arg[0] == 0 else set())
    return None


def _all_of(parsed) -> set[str] | None:
    now = {""}
    for op, arg in parsed:
        exact = _exact(op, arg)
        if exact is None or len(now) * len(exact) > MAX_SPELLINGS:
            return None
        now = {a + b for a, b in product(now, exact)}
    return now


def _terms(spark: SparkSession, rules: tuple[Rule, ...]) -> DataFrame:
    """(trigram, rule, stretch, spelling, spelling_size, stretches): the rules' queries, some rows a rule."""
    rows = []
    for rule in rules:
        query = trigram_query(rule.pattern)
        rows += [(t, rule.kind, i, j, len(spelling), len(query)) for i, stretch in enumerate(query)
                 for j, spelling in enumerate(stretch) for t in spelling]
    return spark.createDataFrame(rows, "trigram string, rule string, stretch int, spelling int, spelling_size int, stretches int")


def trigram_postings(keyed: DataFrame, vocabulary: list[str]) -> DataFrame:
    """The inverted index (trigram, key) of a table (key, text) for the trigrams of the vocabulary."""
    lowered = keyed.select("key", F.lower("text").alias("lowered"))
    found = F.array_compact(F.array(*[F.when(F.contains("lowered", F.lit(t)), F.lit(t)) for t in vocabulary]))
    return lowered.select("key", F.explode(found).alias("trigram"))


def candidates(postings: DataFrame, terms: DataFrame) -> DataFrame:
    """(key, rules): the rules whose Boolean query a document's postings satisfy.

    ``terms`` holds some dozens of rows, fixed by the rules, and is broadcast.
    """
    hits = postings.distinct().join(F.broadcast(terms), "trigram")
    spelled = (hits.groupBy("key", "rule", "stretch", "spelling", "spelling_size", "stretches").count()
               .where("count = spelling_size"))
    met = (spelled.groupBy("key", "rule", "stretches").agg(F.count_distinct("stretch").alias("met")).where("met = stretches"))
    return met.groupBy("key").agg(F.collect_set("rule").alias("rules"))


def matches(text: Column, rule: Rule, rank: int) -> Column:
    """array<struct<start, rank, end>> of a rule's matches: leftmost, non-overlapping, in code points.

    Splitting the text at the matches gives what lies between them; start k
    is the length of the first k + 1 of those and the first k matches.
    """
    pattern = F.lit(rule.pattern)
    whole = F.regexp_extract_all(text, pattern, F.lit(0))
    tested = whole if rule.group == 0 else F.regexp_extract_all(text, pattern, F.lit(rule.group))
    between = F.split(text, rule.pattern, -1)
    zipped = F.arrays_zip(whole.alias("whole"), F.slice(between, 1, F.size(whole)).alias("gap"), tested.alias("tested"))
    empty = F.array().cast("array<struct<start:bigint,rank:int,end:bigint>>")
    zero = F.struct(F.lit(0).cast("long").alias("at"), empty.alias("found"))

    def step(state: Column, x: Column) -> Column:
        start = state["at"] + F.length(x["gap"])
        end = start + F.length(x["whole"])
        span = F.array(F.struct(start.alias("start"), F.lit(rank).alias("rank"), end.alias("end")))
        counts = F.length(x["tested"]) >= rule.least
        return F.struct(end.alias("at"), F.when(counts, F.concat(state["found"], span)).otherwise(state["found"]).alias("found"))

    return F.when(F.size(whole) > 0, F.aggregate(zipped, zero, step)["found"]).otherwise(empty)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Every document's secrets: doc_id, text, found: array<struct<start, rank, end>> by start, then rule order.

    ``rank`` is the rule's place in ``rules``.  A null text is empty and has
    none.  Null ids and repeated rows are scanned as they are, row by row.
    An empty table gives no rows.
    """
    spark = docs.sparkSession
    rows = id_and_text(docs, id_col, text_col).withColumn("key", F.xxhash64("doc_id", "text"))
    indexed = tuple(r for r in rules if trigram_query(r.pattern))
    if indexed:
        terms = _terms(spark, indexed)
        vocabulary = sorted({t for r in indexed for stretch in trigram_query(r.pattern) for spelling in stretch for t in spelling})
        able = candidates(trigram_postings(rows, vocabulary), terms)
        # like rows share a key, and so their candidates; another text under the same key is only verified in vain
        rows = rows.join(able, "key", "left")
    else:
        rows = rows.withColumn("rules", F.lit(None).cast("array<string>"))
    found = []
    for rank, rule in enumerate(rules):
        spans = matches(F.col("text"), rule, rank)
        if rule in indexed:
            spans = F.when(F.array_contains("rules", rule.kind), spans).otherwise(F.array().cast("array<struct<start:bigint,rank:int,end:bigint>>"))
        found.append(spans)
    return rows.select("doc_id", "text", F.array_sort(reduce(lambda a, b: F.concat(a, b), found)).alias("found"))


def joined(found: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """kind:start:end of each span, comma-joined."""
    kinds = F.array(*[F.lit(r.kind) for r in rules])
    return F.array_join(F.transform(found, lambda s: F.concat_ws(
        ":", F.element_at(kinds, s["rank"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def _of_rank(rank: int):
    return lambda span: span["rank"] == rank


def query(spark, sf_dir: str) -> DataFrame:
    """op2: the whole texts of all documents."""
    found = scan(table(spark, sf_dir, "documents"))
    base = [i for i, r in enumerate(RULES) if r.base]
    counts = [F.size(F.filter("found", _of_rank(i))).cast("long").alias(f"n_{RULES[i].kind}") for i in base]
    base_spans = F.filter("found", lambda s: s["rank"] < len(base))
    return found.select("doc_id", *counts, F.sha2(joined(base_spans), 256).alias("base_sha256"), joined(F.col("found")).alias("spans"))


def _oracle() -> str:
    """The same by splitting at matches in DuckDB; each rule scans every text."""
    parts = []
    for rank, r in enumerate(RULES):
        p = r.pattern.replace("'", "''")
        parts.append(f"""
  SELECT row, {rank} AS rank, '{r.kind}' AS kind, unnest(range(1, len(w) + 1)) AS k, w, g, t FROM (
    SELECT row, regexp_extract_all(text, '{p}') AS w, string_split_regex(text, '{p}') AS g, regexp_extract_all(text, '{p}', {r.group}) AS t
    FROM d) WHERE len(w) > 0 AND {r.least} >= 0""")
    least = "CASE rank " + " ".join(f"WHEN {i} THEN {r.least}" for i, r in enumerate(RULES)) + " END"
    base = [i for i, r in enumerate(RULES) if r.base]
    counts = ", ".join(f"count(*) FILTER (rank = {i}) AS n_{RULES[i].kind}" for i in base)
    return f"""
WITH d AS (SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS text FROM documents),
m AS ({" UNION ALL ".join(parts)}
),
s AS (
  SELECT row, rank, kind,
         coalesce(list_sum(list_transform(g[1:k], lambda x: length(x))), 0) + coalesce(list_sum(list_transform(w[1:k - 1], lambda x: length(x))), 0) AS start,
         length(w[k]) AS n
  FROM m WHERE length(t[k]) >= {least}),
f AS (SELECT row, rank, CAST(start AS BIGINT) AS start, kind || ':' || CAST(start AS BIGINT) || ':' || CAST(start + n AS BIGINT) AS span FROM s),
a AS (
  SELECT row, {counts},
         string_agg(span, ',' ORDER BY start, rank) FILTER (rank < {len(base)}) AS base_spans,
         string_agg(span, ',' ORDER BY start, rank) AS spans
  FROM f GROUP BY row)
SELECT doc_id, {", ".join(f"coalesce(n_{RULES[i].kind}, 0) AS n_{RULES[i].kind}" for i in base)},
       sha256(coalesce(base_spans, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN a USING (row)
"""


ORACLE = _oracle()
