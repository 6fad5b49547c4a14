"""Mixing sources to target weights by pivotal dependent rounding.

A source whose target is p times its size takes floor(p) copies of each of
its documents, and one more of some of them.  Which ones is decided by the
pivotal method: two documents with fractional copy probabilities are
paired, and mass (in words) is moved at random from one to the other until
one probability is 0 or 1.  Each move keeps the words that a source is
expected to take and every document's own probability.  Groups of
documents settle among themselves; the one fraction that is left of each
group goes up a reduction tree, until one is left per source.

All of it is DataFrame functions.  Only ids, sources and sizes are
shuffled, never texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from qualis.llm.common import WORD, checkpointed, table, text_of

#: Documents that settle among themselves in one task step (mean size of a group).
GROUP = 64
WEIGHTS = (1, 2, 3)
MAX_COPIES = 3
#: The table of sources (four numbers a row) is broadcast up to so many rows.
BROADCAST_SOURCES = 100_000
#: Rows of a unit of like rows that are made from one row at a time.
ROWS_AT_A_TIME = 10_000


def with_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_copies: int = MAX_COPIES) -> DataFrame:
    """source -> source_size, target, n_units (rows) for a table (source, size).

    Sources in code point order, null last, weigh ``weights`` in turn.
    Targets share the total by weight, but stop at ``max_copies`` times the
    source's size; what is above is shared again among the others.  So a
    target is min(max_copies * size, level * weight), with the one level at
    which targets add up to the total: sources are filled in order of the
    level that caps them, and the level is that of the first source that the
    rest does not fill.  One row per source; documents are summed before.
    """
    per_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_units"))
    in_order = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((F.row_number().over(in_order) - 1) % len(weights) + 1).cast("int"))
    by_cap = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    everything = by_cap.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    filled = (
        per_source.withColumn("weight", weight).withColumn("cap", (F.col("source_size") * max_copies).cast("double"))
        .withColumn("left", F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
        .withColumn("left_weight", F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
        .withColumn("level", F.col("left") / F.col("left_weight"))
        # the level of the first source (in this order) that stays under its cap holds for all that follow
        .withColumn("level", F.min(F.when(F.col("level") * F.col("weight") < F.col("cap"), F.struct(F.col("cap") / F.col("weight"), "source", "level"))).over(everything)["level"])
    )
    target = F.when(F.col("level").isNull(), F.col("cap")).otherwise(F.least("cap", F.col("level") * F.col("weight")))
    return filled.select("source", "source_size", target.alias("target"), "n_units")


def _uniform(*parts: Column) -> Column:
    """A number in [0, 1) that depends on the parts alone."""
    return F.pmod(F.xxhash64(*parts), F.lit(1 << 52)) / F.lit(float(1 << 52))


def _settle(level: int, seed: int) -> Column:
    """Fold a group: the state holds the settled units and the one fraction still open (null: none)."""
    unit = "struct<key:bigint,doc_id:bigint,size:bigint,n:bigint,whole:bigint,p:double>"
    zero = F.struct(F.array().cast(f"array<{unit}>").alias("done"), F.lit(None).cast(unit).alias("open"))

    def step(state: Column, new: Column) -> Column:
        old = state["open"]
        a, b = old["p"] * old["size"], new["p"] * new["size"]  # words at stake
        up = F.least(old["size"] - a, b)  # words that can move from new to old ...
        down = F.least(a, new["size"] - b)  # ... and from old to new
        rises = _uniform(F.lit(seed + level), old["key"], new["key"]) * (up + down) < down
        a2, b2 = F.when(rises, a + up).otherwise(a - down), F.when(rises, b - up).otherwise(b + down)
        old_whole = F.when(rises, up == old["size"] - a).otherwise(down == a)  # else new is whole
        old2, new2 = _with_p(old, F.when(old_whole, F.when(rises, 1.0).otherwise(0.0)).otherwise(a2 / old["size"])), _with_p(
            new, F.when(~old_whole, F.when(rises, 0.0).otherwise(1.0)).otherwise(b2 / new["size"]))
        settled, left = F.when(old_whole, old2).otherwise(new2), F.when(old_whole, new2).otherwise(old2)
        none = F.lit(None).cast(unit)
        left_is_whole = (left["p"] <= 0) | (left["p"] >= 1)
        both = F.struct(
            F.concat(state["done"], F.when(left_is_whole, F.array(settled, left)).otherwise(F.array(settled))).alias("done"),
            F.when(left_is_whole, none).otherwise(left).alias("open"))
        return F.when(old.isNull(), F.struct(state["done"].alias("done"), new.alias("open"))).otherwise(both)

    return F.aggregate(F.col("units"), zero, step)


def _with_p(unit: Column, p: Column) -> Column:
    return F.struct(*[unit[c].alias(c) for c in ("key", "doc_id", "size", "n", "whole")], p.alias("p"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: tuple[int, ...] = WEIGHTS, max_copies: int = MAX_COPIES, seed: int = 20, carry: bool = False) -> DataFrame:
    """Copies of each document in the mix: doc_id, size, source_size, target, copies, taken.

    size counts words; taken = copies * size.  Every copies value is floor(p)
    or floor(p) + 1 of its source's rate p = target / source_size, which
    never exceeds ``max_copies``.  A source takes its target up to less than
    its largest document.

    Null texts have size 0; documents and sources of size 0 take nothing.  The
    null source is a source of its own.  Rows that agree in source, id and
    size are interchangeable: they are settled as one unit of n rows, and
    their copies are dealt out within it.  An empty table gives no rows.  The
    choice depends on the rows alone, not on partitions, so reruns agree.
    ``carry`` also returns the source.
    """
    sized = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[source_col].cast("string").alias("source"),
                        F.regexp_count(text_of(docs, text_col), F.lit(WORD)).cast("long").alias("size"))
    units = checkpointed(sized.groupBy("source", "doc_id", "size").agg(F.count(F.lit(1)).alias("n")))
    targets = checkpointed(with_targets(units.select("source", (F.col("size") * F.col("n")).alias("size")), weights, max_copies)
                           .withColumn("source_key", F.xxhash64("source", F.col("source").isNull())))
    n_sources, most = targets.agg(F.count(F.lit(1)), F.max("n_units")).first()
    targets = targets.drop("source")
    if n_sources <= BROADCAST_SOURCES:
        targets = F.broadcast(targets)
    rate = F.when(F.col("target") >= max_copies * F.col("source_size"), F.lit(float(max_copies))).otherwise(F.col("target") / F.col("source_size"))
    rated = (
        units.withColumn("source_key", F.xxhash64("source", F.col("source").isNull())).join(targets, "source_key")
        .withColumn("rate", F.when(F.col("source_size") > 0, rate).otherwise(0.0)).withColumn("base", F.floor("rate"))
        # n like rows: whole ones take an extra copy surely, the fraction p of one more is open
        .withColumn("extra", (F.col("rate") - F.col("base")) * F.col("n")).withColumn("whole", F.floor("extra"))
        .withColumn("p", F.when(F.col("size") > 0, F.col("extra") - F.col("whole")).otherwise(0.0))
        .withColumn("key", F.xxhash64(F.lit(seed), "source_key", "doc_id", F.col("doc_id").isNull(), "size")))
    open_units = rated.where("p > 0").select("source_key", "n_units", F.struct("key", "doc_id", "size", "n", "whole", "p").alias("unit"))
    most = most or 0

    settled, level = [], 0
    while True:
        groups = F.ceil(F.col("n_units") / F.lit(float(GROUP ** (level + 1))))
        folded = (
            open_units.withColumn("group", F.pmod(F.xxhash64(F.lit(seed + level), F.col("unit")["key"]), groups))
            .groupBy("source_key", "n_units", "group").agg(F.array_sort(F.collect_list("unit")).alias("units"))
            .withColumn("state", _settle(level, seed)))
        most = -(-most // GROUP)
        if most > 1:
            folded = checkpointed(folded.select("source_key", "n_units", "state"))
        settled.append(folded.select("source_key", F.explode("state.done").alias("unit")))
        open_units = folded.where("state.open is not null").select("source_key", "n_units", F.col("state.open").alias("unit"))
        level += 1
        if most <= 1:
            break
    # the last fraction of a source is rounded by itself
    last = open_units.select("source_key", _with_p(F.col("unit"), F.when(
        _uniform(F.lit(seed - 1), F.col("unit")["key"]) < F.col("unit")["p"], 1.0).otherwise(0.0)).alias("unit"))
    for part in settled:
        last = last.unionByName(part)
    chosen = last.select("source_key", "unit.doc_id", "unit.size", F.col("unit.p").cast("long").alias("one"))
    left, right = rated.alias("l"), chosen.alias("r")
    on = (F.col("l.source_key") == F.col("r.source_key")) & F.col("l.doc_id").eqNullSafe(F.col("r.doc_id")) & (F.col("l.size") == F.col("r.size"))
    dealt = left.join(right, on, "left").select(
        "l.doc_id", "l.size", "l.source_size", "l.target", "l.source", "l.base", "l.n",
        (F.col("l.whole") + F.coalesce("r.one", F.lit(0))).alias("extra_n"))
    # rows of a unit by spans of ROWS_AT_A_TIME, which are dealt over all tasks: no array or task holds a large unit
    span = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / ROWS_AT_A_TIME)))
    spans = dealt.withColumn("span", span).repartition("doc_id", "size", "source", "span")
    first = F.col("span") * ROWS_AT_A_TIME + 1
    rank = F.explode(F.sequence(first, F.least(F.col("n"), first + (ROWS_AT_A_TIME - 1))))
    out = spans.withColumn("rank", rank).withColumn(
        "copies", F.when(F.col("size") > 0, F.col("base") + F.when(F.col("rank") <= F.col("extra_n"), 1).otherwise(0)).otherwise(0).cast("long"))
    return out.select("doc_id", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"),
                      *(["source"] if carry else []))


def query(spark, sf_dir: str) -> DataFrame:
    """op8: all documents, sources weighing 1, 2, 3 in turn."""
    return mix(table(spark, sf_dir, "documents"))
