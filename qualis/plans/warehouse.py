"""Warehouse build: staging -> dimensions -> facts -> flat marts.

``build`` returns every mart as a lazy DataFrame.  Full refresh (the
scheduled default) rebuilds each mart from staging.  Incremental mode
takes the current mart tables as ``targets`` and, per model, computes
the new rows with the reference's filter (high-water mark or new keys)
and merges them by the model's unique key; dimensions are merged first
so facts look up the updated members, as the model order requires.

``run`` materialises the build into a ``Warehouse`` (versioned parquet
tables): dimensions are written before the facts read them, which cuts
the lineage between the two stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from qualis.lazy import LazyTables, lazy
from qualis.operators.incremental import StoredKeys, upsert
from qualis.plans import dims as dim_models
from qualis.plans import facts as fact_models
from qualis.plans import marts as flat_marts
from qualis.plans.facts import Dims
from qualis.plans.staging import staging
from qualis.session import RELEASE_ROWS, materialize, release

# Dimensions each fact looks up.
FACT_DIMENSIONS = {
    "fact_autoqa_reviews": ("dim_payment", "dim_team", "dim_user"),
    "fact_autoqa_ratings": ("dim_payment", "dim_team", "dim_user", "dim_rating_category"),
    "fact_autoqa_root_cause": (),
    "fact_conversations": ("dim_payment", "dim_user"),
    "fact_manual_ratings": ("dim_payment", "dim_team", "dim_rating_category"),
    "fact_manual_reviews": ("dim_payment", "dim_team", "dim_user"),
}

# Unique key of each incremental model.
UNIQUE_KEYS = {
    "dim_team": "team_id",
    "dim_payment": "payment_id",
    "dim_user": "user_id",
    "dim_rating_category": "category_id",
    "fact_autoqa_reviews": "autoqa_review_id",
    "fact_autoqa_ratings": "autoqa_rating_id",
    "fact_autoqa_root_cause": "autoqa_root_cause_key",
    "fact_conversations": "conversation_key",
    "fact_manual_ratings": "manual_rating_key",
    "fact_manual_reviews": "review_id",
}
DIMENSIONS = ("dim_team", "dim_payment", "dim_user", "dim_rating_category")
FACTS = ("fact_autoqa_reviews", "fact_autoqa_ratings", "fact_autoqa_root_cause",
         "fact_conversations", "fact_manual_ratings", "fact_manual_reviews")
FLAT = ("customer", "subscriptions")
# Models that load only keys their table does not hold.
NEW_KEY_MODELS = ("dim_rating_category", "fact_autoqa_ratings", "fact_autoqa_root_cause", "fact_manual_ratings")


def merge_new(targets: dict[str, DataFrame], new: dict[str, DataFrame],
              check_duplicates: bool = True, size_new: bool = True) -> dict[str, DataFrame]:
    """Upsert each model's new rows into its target.

    With ``size_new`` the new rows are materialised (reliable checkpoint)
    and counted first, so a small batch is merged with broadcast keys.
    """
    def merged(name):
        t = targets.get(name)
        if t is None:
            return new[name]
        rows, n = new[name], None
        if size_new:
            rows = materialize(rows)
            n = rows.count()
        return upsert(t, rows, UNIQUE_KEYS[name], check_duplicates, n)
    return lazy(list(new), merged)


def build_dimensions(stg: dict[str, DataFrame], targets: dict[str, DataFrame] | None = None,
                     check_duplicates: bool = True, marks: dict[str, str] | None = None,
                     together: bool = False) -> dict[str, DataFrame]:
    if not targets:
        return dim_models.dimensions(stg, together=together)
    return merge_new(targets, dim_models.dimensions(stg, targets, marks), check_duplicates)


def build_facts(stg: dict[str, DataFrame], dims: dict[str, DataFrame],
                targets: dict[str, DataFrame] | None = None, check_duplicates: bool = True,
                marks: dict[str, str] | None = None) -> dict[str, DataFrame]:
    if not targets:
        return fact_models.facts(stg, dims)
    return merge_new(targets, fact_models.facts(stg, dims, targets, marks), check_duplicates)


def build_flat(stg: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return LazyTables({"customer": lambda: flat_marts.customer(stg["customer_subscriptions"]),
                       "subscriptions": lambda: flat_marts.subscriptions(stg["customer_subscriptions"])})


class SizedDims:
    """Dimensions for fact lookups, each materialised and counted on first use.

    A reliable checkpoint (shared folder) cuts the dimension's lineage and
    its exact row count decides whether lookups broadcast it.  Without a
    shared checkpoint folder the dimension stays lazy and is counted (and
    later recomputed) instead.
    """

    def __init__(self, dims):
        self._dims = dims
        self._frames: dict[str, DataFrame] = {}
        self.rows: dict[str, int] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._frames:
            df = materialize(self._dims[name])
            self._frames[name] = df
            self.rows[name] = df.count()
        return self._frames[name]

    def prefetch(self, names) -> None:
        """Materialise and count several dimensions as concurrent jobs."""
        todo = [n for n in names if n not in self._frames]
        if len(todo) < 2:
            return
        from concurrent.futures import ThreadPoolExecutor
        with ThreadPoolExecutor(max_workers=len(todo)) as pool:
            done = list(pool.map(lambda n: (n, materialize(self._dims[n])), todo))
            counts = list(pool.map(lambda item: item[1].count(), done))
        for (n, df), c in zip(done, counts):
            self._frames[n], self.rows[n] = df, c


def build(raw: dict[str, DataFrame], targets: dict[str, DataFrame] | None = None,
          full_refresh: bool = True, check_duplicates: bool = True,
          size_dims: bool = True, together: bool = False) -> dict[str, DataFrame]:
    """All marts, lazily.  ``targets`` are used only when ``full_refresh`` is False.

    With ``size_dims`` the first access to a fact materialises and counts
    the dimensions (one small job each) so lookups can broadcast them.
    ``together``: all dimensions are wanted, so a full refresh reads every
    staging table once for them (``dims.dimensions``).
    """
    stg = staging(raw)
    t = None if full_refresh else targets
    dims = build_dimensions(stg, t, check_duplicates, together=together)
    fact_dims = SizedDims(dims) if size_dims else dims
    facts = build_facts(stg, fact_dims, t, check_duplicates)
    if size_dims:
        unsized = facts

        def fact(n):
            fact_dims.prefetch(FACT_DIMENSIONS[n])
            return unsized[n]
        facts = lazy(FACTS, fact)
    flat = build_flat(stg)
    parts = {**{n: dims for n in DIMENSIONS}, **{n: facts for n in FACTS}, **{n: flat for n in FLAT}}
    return lazy(parts, lambda n: parts[n][n])


# Raw tables that each model's rows come from.
MODEL_SOURCES = {
    "dim_team": ("autoqa_reviews", "manual_reviews", "manual_rating"),
    "dim_payment": ("autoqa_reviews", "manual_reviews", "conversations", "manual_rating", "autoqa_ratings"),
    "dim_user": ("manual_reviews", "conversations", "autoqa_reviews", "autoqa_ratings"),
    "dim_rating_category": ("autoqa_ratings", "manual_rating"),
    "fact_autoqa_reviews": ("autoqa_reviews",),
    "fact_autoqa_ratings": ("autoqa_ratings",),
    "fact_autoqa_root_cause": ("autoqa_root_cause",),
    "fact_conversations": ("conversations",),
    "fact_manual_ratings": ("manual_rating",),
    "fact_manual_reviews": ("manual_reviews",),
}


def run(raw: dict[str, DataFrame], warehouse, full_refresh: bool = True, parallel: int = 4,
        prints: dict[str, str] | None = None, only: tuple[str, ...] | None = None) -> dict[str, int]:
    """Build and write every mart into ``warehouse``; returns row counts written.

    ``only``: these marts and the dimensions that they look up.

    Order: dimensions, then facts reading the written dimensions, then the
    flat marts.  Tables of one group are independent and are written as
    ``parallel`` concurrent jobs.  A mart whose target is missing is built
    as a full refresh.  The calendar is written with the dimensions; the
    flat marts are left out while no subscription export has been loaded.

    ``prints``: fingerprints of raw tables (``Warehouse.fingerprints``).  An
    incremental run leaves out the models whose raw tables are, by these, the
    ones that their live version was computed from: no row of theirs can be
    new.
    """
    stg = staging(raw)
    prints = prints or {}
    wanted = set(only or DIMENSIONS + FACTS + FLAT)
    wanted |= {d for n in wanted for d in FACT_DIMENSIONS.get(n, ())}
    dimensions, facts, flat = ([n for n in group if n in wanted] for group in (DIMENSIONS, FACTS, FLAT))

    def sources(name):
        own = {t: prints[t] for t in MODEL_SOURCES[name] if t in prints}
        return own if len(own) == len(MODEL_SOURCES[name]) else None

    def targets(names):
        """What each model's new rows are told by: a frame with times, or the stored keys."""
        have = [] if full_refresh else [n for n in names if warehouse.exists(n)]
        return {n: StoredKeys(warehouse, n, UNIQUE_KEYS[n]) if n in NEW_KEY_MODELS else warehouse.read(n) for n in have}

    def marks(names):
        # high-water marks recorded by the writes: no scan of the targets
        return {n: m for n in names if (m := warehouse.watermark(n)) is not None}

    def load(new, names, have):
        same = [n for n in names if n in have and sources(n) is not None and warehouse.live(n).sources == sources(n)]
        write = loader(warehouse, have, {n: sources(n) for n in names})
        counts = warehouse.write_many(new, [n for n in names if n not in same], parallel, write)
        return {n: counts[n] if n in counts else warehouse.rows(n) for n in names}

    have = targets(dimensions)
    new = dim_models.dimensions(stg, have, marks(dimensions), together=len(dimensions) > 1)
    counts = load(new, dimensions, have)
    if only is None and (full_refresh or not warehouse.exists("dim_date")):
        counts["dim_date"] = warehouse.write("dim_date", dim_models.dim_date(warehouse.spark))
    # written dimensions: lineage cut, exact sizes known from the writes
    dims = Dims({n: warehouse.read(n) for n in dimensions}, {n: counts[n] for n in dimensions})
    # each writer thread builds its fact (and sizes its incremental batch)
    have = targets(facts)
    new = fact_models.facts(stg, dims, have, marks(facts)) if have else fact_models.facts(stg, dims)
    counts.update(load(new, facts, have))
    if flat and "customer_subscriptions" in raw:
        counts.update(warehouse.write_many(build_flat(stg), flat, parallel))
    return counts


def loader(warehouse, have, sources: dict[str, dict | None]):
    """write(name, rows) that loads a model's new rows into its table and returns the table's rows.

    A model without a table is written whole.  Otherwise the new rows are
    materialised and counted, and written as a part of their own, beside the
    keys that they replace (new-key models replace none).  Columns that
    changed are changed in the log.  No new rows: nothing is written.
    """
    def write(name: str, rows: DataFrame) -> int:
        key = UNIQUE_KEYS[name]
        if name not in have:
            return warehouse.write(name, rows, key=key, sources=sources[name])
        rows = materialize(rows)
        n = rows.count()
        if n >= RELEASE_ROWS:
            release(warehouse.spark)
        if [(f.name, f.dataType) for f in warehouse.live(name).struct] != [(f.name, f.dataType) for f in rows.schema]:
            warehouse.set_schema(name, rows.schema)
        if not n:
            return warehouse.rows(name)
        if name in NEW_KEY_MODELS:
            warehouse.append(name, rows, key, sources[name])
            return warehouse.rows(name)
        return warehouse.upsert(name, rows, key, n, sources[name])
    return write
