"""Quality rules: a learned decision list over text statistics.

Statistics of a text are counted per row.  From labelled documents a
decision list is learned by sequential covering: a rule is a conjunction of
thresholds, grown by information gain on one part of the labels, pruned on
the other part, and kept if it is precise there; the documents that it
covers are set aside and the next rule is learned.  The list is emitted as
one ordered Spark conditional expression.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from qualis.llm.common import slices, table, text_of

COUNTS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_distinct", "n_upper", "n_digits", "n_stops",
          "longest_word")
#: Labelled documents that a list is learned from, at most (taken by hash of their id).
LABEL_ROWS = 50_000
SYMBOLS, UPPER, DIGITS, STOPS = b"#*$%&|<>", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b".,;:!?"


def text_counts(text: str) -> tuple[int, ...]:
    """The COUNTS of a text.  Words are runs of anything but ASCII white space (what ``bytes.split`` splits at)."""
    data = text.encode("utf-8", "surrogatepass")
    words = data.split()
    compact = b"".join(words)
    lines = [line for line in data.split(b"\n") if line.strip()]
    n, repeated = len(words), 0
    windows = list(zip(words, words[1:], words[2:]))
    seen = Counter(windows)
    if len(seen) < len(windows):
        end = 0  # words before this are counted
        for i, window in enumerate(windows):
            if seen[window] > 1:
                repeated += i + 3 - max(i, end)
                end = i + 3

    def of(kind: bytes) -> int:
        return len(compact) - len(compact.translate(None, kind))

    return (n, len(compact.decode("utf-8", "surrogatepass")), of(SYMBOLS), len(lines), len(lines) - len(set(lines)), repeated,
            len(set(words)), of(UPPER), of(DIGITS), of(STOPS), max(map(len, words), default=0))


def with_counts(docs: DataFrame, text_col: str = "text", carry: tuple[str, ...] = ()) -> DataFrame:
    """The COUNTS of every row's whole text (null: empty), after the columns to carry along."""
    rows = docs.select(*[docs[c] for c in carry], text_of(docs, text_col).alias("_counted"))
    kept = rows.schema.fields[:-1]
    kind = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in kept] + [f"{c} long" for c in COUNTS])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            counts = [text_counts(t) for t in batch.column(batch.num_columns - 1).to_pylist()]
            columns = [pa.array(c, pa.int64()) for c in (zip(*counts) if counts else [()] * len(COUNTS))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *columns], names=[*batch.schema.names[:-1], *COUNTS])

    return rows.mapInArrow(run, kind)


def _share(a: str, b: str) -> Column:
    return F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(0.0)


def features() -> dict[str, Column]:
    """What rules test: sizes and shares, defined for empty texts too."""
    return {
        "words": F.col("n_words").cast("double"), "word_length": _share("word_chars", "n_words"), "symbol_share": _share("n_symbols", "word_chars"),
        "dup_line_share": _share("n_dup_lines", "n_lines"), "repeat_share": _share("n_repeat_words", "n_words"),
        "distinct_share": _share("n_distinct", "n_words"), "upper_share": _share("n_upper", "word_chars"), "digit_share": _share("n_digits", "word_chars"),
        "stop_share": _share("n_stops", "n_words"), "line_words": _share("n_words", "n_lines"), "longest_word": F.col("longest_word").cast("double"),
    }


@dataclass(frozen=True)
class Condition:
    feature: str
    at_least: bool
    threshold: float

    def column(self) -> Column:
        value = features()[self.feature]
        return value >= self.threshold if self.at_least else value < self.threshold

    def mask(self, x: dict[str, np.ndarray]) -> np.ndarray:
        return x[self.feature] >= self.threshold if self.at_least else x[self.feature] < self.threshold

    def __str__(self) -> str:
        return f"{self.feature} {'>=' if self.at_least else '<'} {self.threshold:g}"


Rule = tuple[Condition, ...]


@dataclass(frozen=True)
class DecisionList:
    """Ordered rules; a document is rejected by the first that holds, and kept if none does."""

    rules: tuple[Rule, ...]

    def column(self) -> Column:
        """1-based number of the first rule that holds, null if none does."""
        out = F.lit(None).cast("int")
        chain = None
        for i, rule in enumerate(self.rules, 1):
            holds = F.lit(True)
            for c in rule:
                holds = holds & c.column()
            chain = F.when(holds, i) if chain is None else chain.when(holds, i)
        return out if chain is None else chain.otherwise(out)

    def mask(self, x: dict[str, np.ndarray]) -> np.ndarray:
        n = len(next(iter(x.values())))
        return np.logical_or.reduce([_holds(r, x) for r in self.rules], axis=0) if self.rules else np.zeros(n, bool)

    def __str__(self) -> str:
        return "\n".join(f"{i}. reject if " + " and ".join(map(str, r)) for i, r in enumerate(self.rules, 1))


def _holds(rule: Rule, x: dict[str, np.ndarray]) -> np.ndarray:
    return np.logical_and.reduce([c.mask(x) for c in rule], axis=0)


def _thresholds(values: np.ndarray, most: int) -> np.ndarray:
    """Cuts between neighbouring values, at quantiles if there are many."""
    distinct = np.unique(values)
    cuts = (distinct[1:] + distinct[:-1]) / 2
    return cuts if len(cuts) <= most else np.unique(np.quantile(cuts, np.linspace(0, 1, most)))


def learn(x: dict[str, np.ndarray], bad: np.ndarray, part: np.ndarray, min_precision: float = 0.98, min_covered: int = 3,
          max_rules: int = 12, max_conditions: int = 4, cuts: int = 128) -> DecisionList:
    """Sequential covering of the bad rows.  ``part``: True to grow rules on, False to prune them on.

    Growing adds the condition with the greatest information gain (weighted
    by the bad rows it keeps) until only bad rows are covered or nothing is
    gained.  Pruning drops trailing conditions as long as precision on the
    pruning rows does not fall.  Learning ends at the first rule that covers
    fewer than ``min_covered`` bad rows there or is less precise than
    ``min_precision``.
    """
    rules: list[Rule] = []
    open_rows = np.ones(len(bad), bool)
    while len(rules) < max_rules:
        grow, prune = open_rows & part, open_rows & ~part
        rule: Rule = ()
        covered = grow
        while len(rule) < max_conditions and (covered & ~bad).any() and (covered & bad).any():
            p0, n0 = (covered & bad).sum(), (covered & ~bad).sum()
            best, best_gain = None, 1e-9
            for name, values in x.items():
                order = np.sort(values[covered & bad]), np.sort(values[covered & ~bad])
                for t in _thresholds(values[covered], cuts):
                    below = [int(np.searchsorted(v, t, "left")) for v in order]
                    for at_least in (True, False):
                        p, n = (p0 - below[0], n0 - below[1]) if at_least else below
                        gain = p * (math.log2(p / (p + n)) - math.log2(p0 / (p0 + n0))) if p else 0.0
                        if gain > best_gain:
                            best, best_gain = Condition(name, at_least, float(f"{t:.6g}")), gain
            if best is None:
                break
            # a tighter cut of the same feature replaces the looser one
            rule = (*(c for c in rule if (c.feature, c.at_least) != (best.feature, best.at_least)), best)
            covered = covered & best.mask(x)
        if not rule:
            break

        def precision(r: Rule) -> tuple[float, int]:
            hit = prune & _holds(r, x)
            good = int((hit & bad).sum())
            return (good + 1) / (hit.sum() + 2), good

        while len(rule) > 1 and precision(rule[:-1])[0] >= precision(rule)[0]:
            rule = rule[:-1]
        hit = prune & _holds(rule, x)
        good = int((hit & bad).sum())
        if good < min_covered or good < min_precision * hit.sum():
            break
        rules.append(rule)
        open_rows &= ~_holds(rule, x)
    return DecisionList(tuple(rules))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
        label_rows: int = LABEL_ROWS, **options) -> DecisionList:
    """Learn a list from labelled documents (label 0: bad).

    At most ``label_rows`` labels are used, those whose ids hash lowest.
    Labels or ids that are null are left out; a document labelled more than
    once is bad if any label says so; one listed more than once counts once,
    with the text of the smallest hash, so that the driver never holds more
    than ``label_rows`` rows.  Without labels the list is empty and keeps
    everything.
    """
    one = (labels.select(labels[id_col].cast("long").alias("id"), labels[label_col].cast("int").alias("label")).dropna()
           .groupBy("id").agg(F.min("label").alias("label")))
    sample = one.orderBy(F.xxhash64("id"), "id").limit(label_rows)  # 12 bytes a row, at most label_rows: broadcast
    named = docs.select(docs[id_col].cast("long").alias("id"), text_of(docs, text_col).alias("text"))
    counted = with_counts(named.join(F.broadcast(sample), "id").withColumn("hash", F.xxhash64("text")), "text", ("id", "label", "hash"))
    counted = counted.groupBy("id", "label").agg(F.min(F.struct("hash", *COUNTS)).alias("one")).select("id", "label", "one.*")
    rows = counted.select((F.col("label") == 0).alias("bad"), (F.pmod(F.xxhash64("id", F.lit(1)), F.lit(3)) < 2).alias("part"),
                          *[c.alias(n) for n, c in features().items()], "id").toPandas().sort_values("id")
    if rows.empty:
        return DecisionList(())
    return learn({n: rows[n].to_numpy(float) for n in features()}, rows["bad"].to_numpy(bool), rows["part"].to_numpy(bool), **options)


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def judge(docs: DataFrame, rules: DecisionList, text_col: str = "text", carry: tuple[str, ...] = ()) -> DataFrame:
    """Counts, base_failed, rule (number of the first rule that holds) and kept for every row.

    A null text is empty; it has no words and fails the base rules.  Rows are
    judged one by one, so repeated rows get the same verdict.  An empty table
    gives no rows.  Columns to carry that bear the name of a result are an
    error.
    """
    clash = {c.lower() for c in carry} & {*COUNTS, "base_failed", "rule", "kept", "_counted"}
    if clash:
        raise ValueError(f"columns to carry bear names of results: {sorted(clash)}")
    counted = with_counts(docs, text_col, carry)
    return (counted.withColumn("base_failed", base_failed()).withColumn("rule", rules.column())
            .withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull()))


def query(spark, sf_dir: str) -> DataFrame:
    """op5: counts and verdicts for all documents; rules learned from ``labels``."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rules = fit(docs, table(spark, sf_dir, "labels"))
    return judge(docs, rules, carry=("doc_id",)).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rule")
