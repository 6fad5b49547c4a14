"""Layered parquet warehouse: raw / refined / dw tables with versioned writes.

A version of a table is a list of parts.  A part is a folder that one write
made (``<root>/<layer>/<table>/<part>/``), or one partition value's folder in
it, and is never changed afterwards.  An append-only log
``<root>/<layer>/_versions/`` holds one JSON entry per completed write; the
live version of a table is its largest logged one.  So a job never overwrites
the files it is reading, readers never see a half-written table, and a new
version costs what it changes:

* ``append`` lists the live parts and one new part;
* ``upsert`` writes the batch as a part and the keys that it replaces as a
  small table of deletes, each with the version as its sequence number; a
  read leaves out rows whose key a later version replaced.  ``compact`` folds
  the deletes in, which ``upsert`` does itself above a share of the rows;
* ``replace_values`` rewrites the partition values that change (a MERGE
  passes the days that it touches) and keeps the others by reference;
* a table of more values than folders are good for is partitioned by spans of
  days (``span``): a folder's value is then the first day of its span;
* ``set_schema`` adds, drops and retypes columns in the log alone: each part
  keeps the schema it was written with and is projected when read.

A part of a keyed table may have a key filter beside it (``operators.keyset``):
a blocked Bloom filter and the key's range, so that a batch's keys are
compared only with the parts that may hold them (``held_keys``).

A log entry is created without overwriting: of two writers of one version the
second fails, and neither loses files.  ``sweep`` removes the parts that no
kept version names.  Folders are ordinary Spark reads and writes, the log
goes through the same Hadoop file system, so any shared store works; nothing
is kept on a machine-local disk.

Sink rules: an empty input leaves a ``raw`` table untouched (the pointer
does not move; the write job itself counts its rows, so the input is
computed once), while a ``dw`` or ``refined`` rebuild replaces the table
even by no rows; after a write the rows and their fingerprint (a sum of row
hashes, whatever their order) are taken from the written files again and
compared with those the write job itself observed.
"""

from __future__ import annotations

import json
import re
import time
import uuid
from collections.abc import Callable
from dataclasses import asdict, dataclass, replace

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from qualis.functions.keys import packed, unpacked
from qualis.operators import keyset
from qualis.operators.incremental import sync_columns
from qualis.operators.lookup import broadcastable
from qualis.session import RELEASE_ROWS, materialize, release

LAYERS = ("raw", "refined", "dw")
#: A table is rewritten when its deletes exceed this share of its rows, or when it has more parts than this.
COMPACT_SHARE = 0.2
COMPACT_PARTS = 32
#: It is rewritten by slices of its keys, one after the other, so that their shuffles do not lie on disk together: so many, of so many rows at least.
COMPACT_SLICES = 4
COMPACT_SLICE_ROWS = 1_000_000


@dataclass(frozen=True)
class Part:
    """A folder of rows.  ``seq``: the version that wrote it; ``schema``: what it was written with, as JSON."""

    folder: str
    seq: int
    rows: int
    schema: str
    #: Partition column and value of a part that is one value's folder within ``folder`` (value None: the null folder).
    column: str | None = None
    value: str | None = None
    #: Key filter: key column, null keys, lowest and highest key, words (see ``operators.keyset``).
    keys: dict | None = None


@dataclass(frozen=True)
class Deletes:
    """Keys whose rows in parts written before version ``seq`` are replaced."""

    folder: str
    seq: int
    rows: int
    key: str
    #: The key's type as written.
    kind: str


@dataclass(frozen=True)
class Version:
    version: int
    rows: int
    mark: str
    schema: str
    parts: tuple[Part, ...]
    deletes: tuple[Deletes, ...] = ()
    fingerprint: str = ""
    #: What the rows were computed from: table -> fingerprint.
    sources: dict | None = None
    #: The version since which parts and deletes were only added.
    base: int = 0

    @classmethod
    def parse(cls, entry: dict) -> "Version":
        own = {k: v for k, v in entry.items() if k != "table"}
        # a part without a schema of its own has the version's
        return cls(**{**own, "parts": tuple(Part(**{"schema": own["schema"], **p}) for p in own["parts"]), "deletes": tuple(Deletes(**d) for d in own["deletes"])})

    @property
    def struct(self) -> StructType:
        return StructType.fromJson(json.loads(self.schema))


#: Values that stand in a folder's name as they are.
_PLAIN = re.compile(r"[A-Za-z0-9_-]+")
_SPAN = re.compile(r"(.+)_by_(\d+)_days")


def span(column: str, days: int) -> str:
    """The partition column for spans of so many days of a date column (one day: the column itself)."""
    return column if days <= 1 else f"{column}_by_{days}_days"


def partition_value(partition_by: str, columns) -> Column:
    """What a partition column holds: a column of the rows, or the first day of the row's span."""
    found = None if partition_by in columns else _SPAN.fullmatch(partition_by)
    if found is None:
        return F.col(partition_by)
    day = F.unix_date(F.col(found[1]).cast("date"))
    return F.date_from_unix_date((day - F.pmod(day, F.lit(int(found[2])))).cast("int"))


def row_hash(df: DataFrame) -> Column:
    """A hash of whole rows; columns by name, so their order does not matter."""
    names = sorted(df.columns)
    nulls = [F.col(f"`{c}`").isNull() for c in names]
    return F.xxhash64(*[F.col(f"`{c}`") for c in names], *nulls)


def fingerprint(df: DataFrame) -> Column:
    """An order-independent fingerprint of a multiset of rows: the exact sum of their hashes."""
    return F.coalesce(F.sum(row_hash(df).cast("decimal(28,0)")), F.lit(0)).cast("string")


class Warehouse:
    def __init__(self, spark: SparkSession, root: str, layer: str = "dw"):
        if layer not in LAYERS:
            raise ValueError(f"unknown layer {layer!r}")
        self.spark, self.root, self.layer = spark, root.rstrip("/"), layer
        self.refresh()

    # -- the log ----------------------------------------------------------

    def _fs(self, path: str):
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return folder.getFileSystem(self.spark._jsc.hadoopConfiguration()), folder

    def _log(self) -> str:
        return f"{self.root}/{self.layer}/_versions"

    def _dir(self, table: str) -> str:
        return f"{self.root}/{self.layer}/{table}"

    def _entries(self) -> DataFrame | None:
        """table, version and entry of every logged version; an entry still being written has no version yet."""
        fs, folder = self._fs(self._log())
        if not fs.exists(folder):
            return None
        log = self.spark.read.option("recursiveFileLookup", True).text(self._log())
        return log.select(F.get_json_object("value", "$.table").alias("table"),
                          F.get_json_object("value", "$.version").cast("int").alias("version"), F.col("value").alias("entry")).where("version IS NOT NULL")

    def refresh(self) -> None:
        """Reload the live versions from the log (one small job); without a log there are no tables."""
        entries = self._entries()
        rows = [] if entries is None else entries.groupBy("table").agg(F.max_by("entry", "version").alias("entry")).collect()  # a row per table
        self._live = {r["table"]: Version.parse(json.loads(r["entry"])) for r in rows}

    def at(self, layer: str) -> "Warehouse":
        return Warehouse(self.spark, self.root, layer)

    def version(self, table: str) -> int | None:
        """Live version as of the last ``refresh``/write by this object.

        Call ``refresh`` to pick up versions written by another job.
        """
        return self._live[table].version if table in self._live else None

    def live(self, table: str) -> Version:
        if table not in self._live:
            raise FileNotFoundError(f"{self.layer}.{table} does not exist")
        return self._live[table]

    def rows(self, table: str) -> int:
        """Rows of the live version, as counted by its writes."""
        return self.live(table).rows

    def fingerprints(self, tables) -> dict[str, str]:
        """Rows and fingerprint of the tables whose live version was written at once (others are left out)."""
        return {t: f"{v.rows}:{v.fingerprint}" for t in tables if (v := self._live.get(t)) is not None and v.fingerprint}

    def watermark(self, table: str, ts_col: str = "updated_at") -> str | None:
        """``MAX(ts_col)`` of the live version as observed by its writes.

        ``None``: not recorded (the caller computes it); ``""``: the table
        held no non-NULL time.
        """
        mark = self._live[table].mark if table in self._live else ""
        return mark[len(ts_col) + 1:] if mark.startswith(f"{ts_col}=") else None

    def exists(self, table: str) -> bool:
        return table in self._live

    def _publish(self, table: str, new: Version) -> None:
        """Log ``new``; an error if its version is logged already."""
        fs, path = self._fs(f"{self._log()}/{table}.v{new.version}.json")
        own = asdict(new)
        for p in own["parts"]:
            if p["schema"] == new.schema:
                del p["schema"]
        # the version comes last: of an entry that is still being written it is not found
        data = json.dumps({"table": table, **{k: own[k] for k in own if k != "version"}, "version": new.version}) + "\n"
        try:
            out = fs.create(path, False)
        except Py4JJavaError as e:
            raise RuntimeError(f"{self.layer}.{table}: version {new.version} was written by another job") from e
        try:
            out.write(bytearray(data.encode()))
        finally:
            out.close()
        self._live[table] = new

    # -- reading ----------------------------------------------------------

    def paths(self, table: str) -> list[str]:
        """Folders of the live version's parts."""
        return [self._path(table, p) for p in self.live(table).parts]

    def path(self, table: str) -> str:
        """The folder of a live version that was written at once."""
        folders = {p.folder for p in self.live(table).parts}
        if len(folders) > 1:
            raise ValueError(f"{self.layer}.{table} has {len(folders)} parts; use paths()")
        return f"{self._dir(table)}/{folders.pop()}"

    def _path(self, table: str, part: Part) -> str:
        base = f"{self._dir(table)}/{part.folder}"
        if part.column is None:
            return base
        # as Spark names partition folders
        value = "__HIVE_DEFAULT_PARTITION__" if part.value is None else part.value if _PLAIN.fullmatch(part.value) else self.spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(part.value)
        return f"{base}/{part.column}={value}"

    def read(self, table: str, schema=None, columns: list[str] | None = None) -> DataFrame:
        """Live version of ``table``; ``schema`` fixes column types (also of partition columns), ``columns`` a part of them."""
        v = self.live(table)
        df = self._rows(table, v, v.parts, v.struct if schema is None else schema)
        return df if columns is None else df.select(columns)

    def _rows(self, table: str, v: Version, parts, schema: StructType, of: Callable[[Column], Column] | None = None) -> DataFrame:
        """The live rows of some parts, projected to ``schema``; ``of``: those whose key meets a condition."""
        groups: dict[tuple, list[Part]] = {}
        newest = max((d.seq for d in v.deletes), default=0)
        for p in parts:
            # parts that no later delete concerns are read together
            groups.setdefault((p.folder if p.column else "", p.schema, p.seq if p.seq < newest else newest), []).append(p)
        out = None
        for (folder, own, seq), members in groups.items():
            reader = self.spark.read.schema(StructType.fromJson(json.loads(own)))
            if folder:
                reader = reader.option("basePath", f"{self._dir(table)}/{folder}")
            # a folder all of whose values are live is named once, not once a value
            whole = folder and len(members) == len(v.parts) and all(p.seq == v.version for p in members)
            df = self._without_deleted(table, v, reader.parquet(*([f"{self._dir(table)}/{folder}"] if whole else [self._path(table, p) for p in members])), seq, of)
            df = sync_columns(df, schema)
            out = df if out is None else out.unionByName(df)
        return self.spark.createDataFrame([], schema) if out is None else out

    def _without_deleted(self, table: str, v: Version, df: DataFrame, seq: int, of: Callable[[Column], Column] | None = None) -> DataFrame:
        later = [d for d in v.deletes if d.seq > seq]
        if of is not None:
            df = df.where(of(F.col(v.deletes[0].key).cast(v.struct[v.deletes[0].key].dataType)))
        if not later:
            return df
        key = later[0].key
        now = v.struct[key].dataType
        gone = None
        for kind in sorted({d.kind for d in later}):
            stored = self.spark.read.schema(f"`{key}` {kind}").parquet(*[f"{self._dir(table)}/{d.folder}" for d in later if d.kind == kind])
            stored = stored.select(F.col(key).cast(now).alias("__gone"))
            gone = stored if gone is None else gone.unionByName(stored)
        if of is not None:
            gone = gone.where(of(F.col("__gone")))
        if broadcastable(sum(d.rows for d in later)):
            return df.join(F.broadcast(gone), df[key].cast(now) == gone["__gone"], "left_anti")
        # rows and deletes meet in a shuffle, for which texts are packed; the optimizer would push an anti join below that
        texts = [f.name for f in df.schema.fields if f.dataType == StringType()]
        rows = df.select(*[packed(f"`{c}`").alias(c) if c in texts else F.col(f"`{c}`") for c in df.columns])
        if now == StringType():
            match, gone = F.col(key) if key in texts else packed(F.col(key).cast(now)), gone.select(packed("__gone").alias("__gone"))
        else:
            match = (unpacked(key) if key in texts else F.col(key)).cast(now)
        left = rows.join(gone, match == F.col("__gone"), "left").where(F.col("__gone").isNull())
        return left.select(*[unpacked(f"`{c}`").alias(c) if c in texts else F.col(f"`{c}`") for c in df.columns])

    # -- writing ----------------------------------------------------------

    def _write_part(self, table: str, df: DataFrame, partition_by: str | None = None, key: str | None = None) -> tuple[list[Part], int, str, str]:
        """Write a folder; returns its parts, its rows, its high-water mark and its fingerprint."""
        seq = (self.version(table) or 0) + 1
        folder = f"v{seq}-{uuid.uuid4().hex[:8]}"
        target = f"{self._dir(table)}/{folder}"
        schema = df.schema
        obs = Observation(f"rows_{self.layer}_{table}_{folder}")
        metrics = [F.count(F.lit(1)).alias("rows"), fingerprint(df).alias("fingerprint")]
        if partition_by:
            # AQE splits the values that hold many rows and joins small ones
            df = df.withColumn(partition_by, partition_value(partition_by, df.columns)).hint("rebalance", F.col(partition_by))
        if "updated_at" in schema.names:
            # the high-water mark of this version, recorded for incremental loads
            metrics.append(F.max("updated_at").cast("string").alias("mark"))
        # observed after the exchange: map tasks that run again count no row twice
        w = df.observe(obs, *metrics).write.option("compression", "zstd")
        if partition_by:
            w = w.partitionBy(partition_by)
        w.parquet(target)
        seen = obs.get
        parts, rows = self._confirmed(table, folder, schema, seen, partition_by, key)
        if rows >= RELEASE_ROWS:
            release(self.spark)
        mark = f"updated_at={seen['mark'] or ''}" if "mark" in seen else ""
        return [replace(p, seq=seq) for p in parts], rows, mark, seen["fingerprint"]

    def _confirmed(self, table: str, folder: str, schema: StructType, seen: dict, partition_by: str | None, key: str | None) -> tuple[list[Part], int]:
        """The parts of a written folder; an error if it does not hold the rows that the write job saw."""
        whole = Part(folder, 0, 0, schema.json())
        if not seen["rows"]:
            return [whole], 0
        back = self.spark.read.schema(schema).parquet(f"{self._dir(table)}/{folder}")
        own = back if partition_by is None or partition_by in schema.names else back.drop(partition_by)
        metrics = [F.count(F.lit(1)).alias("rows"), fingerprint(own).alias("fingerprint"), *([] if key is None else keyset.bounds(key))]
        if partition_by:
            values = back.groupBy(F.col(partition_by).cast("string").alias("value")).agg(*metrics).collect()  # a row per partition value
        else:
            values = [back.agg(*metrics).first()]
        rows, total = sum(r["rows"] for r in values), sum(int(r["fingerprint"]) for r in values)
        if (rows, total) != (seen["rows"], int(seen["fingerprint"])):
            raise RuntimeError(f"{self.layer}.{table}: wrote {seen['rows']} rows but read back {rows}" if rows != seen["rows"] else
                               f"{self.layer}.{table}: the rows read back are not those written")
        if partition_by:
            return [replace(whole, rows=r["rows"], column=partition_by, value=r["value"]) for r in values], rows
        if key is None:
            return [replace(whole, rows=rows)], rows
        words = keyset.words(rows)
        keyset.build(back, key, words, folder).write.parquet(f"{self._dir(table)}/{folder}.keys")
        return [replace(whole, rows=rows, keys={"column": key, "kind": schema[key].dataType.simpleString(), "words": words, **{n: values[0][n] for n in ("nulls", "low", "high")}})], rows

    def write(self, table: str, df: DataFrame, partition_by: str | None = None,
              keep_on_empty: bool | None = None, key: str | None = None, sources: dict | None = None) -> int:
        """Write ``df`` as the next version; returns the row count.

        With ``keep_on_empty`` (by default in the raw layer only) an empty
        ``df`` leaves the live version as it was.

        With ``partition_by`` the folders are one per value; rows are
        rebalanced by value, so a value holding a third of the data is
        split over several tasks.  With ``key`` the part gets a key filter.
        ``sources`` is logged: what the rows were computed from.
        """
        parts, rows, mark, total = self._write_part(table, df, partition_by, key)
        if rows or not (self.layer == "raw" if keep_on_empty is None else keep_on_empty):
            self._publish(table, Version(parts[0].seq, rows, mark, df.schema.json(), tuple(parts), (), total, sources, parts[0].seq))
        return rows

    def append(self, table: str, df: DataFrame, key: str | None = None, sources: dict | None = None) -> int:
        """The live version and the rows of ``df`` as the next version; returns the rows added.

        Only ``df`` is written; without rows the live version stays.
        """
        live = self.live(table)
        parts, rows, mark, _ = self._write_part(table, df, key=key)
        if rows:
            self._publish(table, replace(live, version=parts[0].seq, rows=live.rows + rows, mark=max(mark, live.mark), parts=live.parts + tuple(parts),
                                         fingerprint="", sources=sources))
        return rows

    def held_keys(self, table: str, keys: DataFrame, key: str, few: bool = False) -> DataFrame:
        """The key column of the live rows whose key is among ``keys`` (distinct, not null): one row per live row.

        Parts with a key filter are read only if they may hold one of the
        keys, and only for the keys that they may hold.  ``few``: the keys
        are few enough to broadcast.
        """
        v = self.live(table)
        keys = keys.select(F.col(key).alias("__key"))
        kind = v.struct[key].dataType.simpleString()
        usable = {p.folder for p in v.parts if p.keys and (p.keys["column"], p.keys["kind"]) == (key, kind)}
        sure = [p for p in v.parts if p.rows and p.folder not in usable]
        filtered = [p for p in v.parts if p.folder in usable and p.rows > p.keys["nulls"]]
        schema = StructType([v.struct[key]])
        out = []
        if sure:
            out.append(self._rows(table, v, sure, schema).join(F.broadcast(keys) if few else keys, F.col(key) == F.col("__key"), "left_semi"))
        if filtered:
            stored = self.spark.read.schema(keyset.STORED).parquet(*[f"{self._dir(table)}/{p.folder}.keys" for p in filtered])
            possible = materialize(keyset.possible(keys, "__key", {p.folder: p.keys for p in filtered}, stored))
            hit = {r["part"] for r in possible.select("part").distinct().collect()}  # at most one per part
            some = possible.select("__key").distinct()
            hits = [p for p in filtered if p.folder in hit]
            if hits:
                out.append(self._rows(table, v, hits, schema).join(F.broadcast(some) if few else some, F.col(key) == F.col("__key"), "left_semi"))
        if not out:
            return self.spark.createDataFrame([], schema)
        return out[0] if len(out) == 1 else out[0].unionByName(out[1])

    def null_keys(self, table: str, key: str) -> int | None:
        """How many live rows have a null key, as counted by the writes; None if some part has no key filter."""
        parts = self.live(table).parts
        if any(p.keys is None or p.keys["column"] != key for p in parts if p.rows):
            return None
        return sum(p.keys["nulls"] for p in parts if p.rows)

    def upsert(self, table: str, df: DataFrame, key: str, n: int, sources: dict | None = None) -> int:
        """The live version in which the ``n`` rows of ``df`` replace those of their keys, as the next version; returns the live rows.

        Written are the rows and the keys they replace.  Two rows of ``df``
        for one live row are an error; null keys match nothing.
        """
        live = self.live(table)
        if not n:
            return live.rows
        few = broadcastable(n)
        counted = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("__n"))
        held = materialize(self.held_keys(table, counted.select(key), key, few).groupBy(key).agg(F.count(F.lit(1)).alias("__live")))
        found = held.join(F.broadcast(counted) if few else counted, key).agg(
            F.count(F.lit(1)).alias("keys"), F.coalesce(F.sum("__live"), F.lit(0)).alias("rows"), F.max("__n").alias("most")).first()
        if found["keys"] and found["most"] > 1:
            raise ValueError(f"{self.layer}.{table}: several new rows match one row on {key}")
        if not found["keys"]:
            self.append(table, df, key, sources)
            return self.rows(table)
        parts, rows, mark, _ = self._write_part(table, df, key=key)
        seq = parts[0].seq
        folder = f"{parts[0].folder}.deletes"
        held.select(key).coalesce(found["keys"] // 1_000_000 + 1).write.parquet(f"{self._dir(table)}/{folder}")
        self._publish(table, replace(live, version=seq, rows=live.rows - found["rows"] + rows, mark=max(mark, live.mark), parts=live.parts + tuple(parts),
                                     deletes=live.deletes + (Deletes(folder, seq, found["keys"], key, live.struct[key].dataType.simpleString()),), fingerprint="", sources=sources))
        now = self.live(table)
        if sum(d.rows for d in now.deletes) > COMPACT_SHARE * now.rows or len(now.parts) > COMPACT_PARTS:
            self.compact(table, key)
        return self.rows(table)

    def compact(self, table: str, key: str | None = None) -> int:
        """The live rows as one part, or as one a slice of the keys, without deletes, as the next version; returns the rows."""
        live = self.live(table)
        column = next((p.column for p in live.parts if p.column), None)
        n = min(COMPACT_SLICES, live.rows // COMPACT_SLICE_ROWS + 1) if live.deletes and not column else 1
        parts, rows, total = [], 0, 0
        for k in range(n):
            of = None if n == 1 else lambda c, k=k: F.pmod(F.xxhash64(c), F.lit(n)) == k
            made, some, _, sum_of = self._write_part(table, self._rows(table, live, live.parts, live.struct, of), column, None if column else key)
            parts, rows, total = parts + made, rows + some, total + int(sum_of)
        if rows != live.rows:
            raise RuntimeError(f"{self.layer}.{table}: {live.rows} live rows but {rows} after compaction")
        self._publish(table, replace(live, version=parts[0].seq, rows=rows, parts=tuple(parts), deletes=(), fingerprint=str(total), base=parts[0].seq))
        return rows

    def replace_values(self, table: str, df: DataFrame, column: str, values: set[str | None]) -> int:
        """The live version in which ``df`` takes the place of all rows whose partition value is among ``values``; returns the live rows.

        Rows of ``df`` with other values are added to theirs.  Folders of
        values that are not among ``values`` stay as they are, by reference.
        """
        live = self.live(table)
        if any(p.column != column for p in live.parts if p.rows):
            raise ValueError(f"{self.layer}.{table} is not partitioned by {column}")
        parts, rows, mark, _ = self._write_part(table, df, column)
        kept = tuple(p for p in live.parts if p.rows and p.value not in values)
        new = tuple(p for p in parts if p.rows)
        self._publish(table, replace(live, version=(self.version(table) or 0) + 1, rows=sum(p.rows for p in kept) + rows,
                                     mark=max(mark, live.mark), parts=kept + new, fingerprint="", base=live.version + 1))
        return self.rows(table)

    def values(self, table: str, column: str, values: set[str | None], schema: StructType) -> DataFrame:
        """The live rows of some partition values; only their folders are read."""
        v = self.live(table)
        return self._rows(table, v, [p for p in v.parts if p.rows and p.column == column and p.value in values], schema)

    def set_schema(self, table: str, schema: StructType) -> None:
        """Make the columns of ``table`` those of ``schema`` (see ``sync_columns``): logged, no row is written."""
        live = self.live(table)
        self._publish(table, replace(live, version=live.version + 1, schema=schema.json(), fingerprint=""))

    def changes(self, table: str, since: int) -> tuple[DataFrame, DataFrame] | None:
        """Rows that came and rows that went after version ``since``; None if the table was written whole since.

        Only the parts written since are read whole, and of the older ones
        the rows of replaced keys.
        """
        v = self.live(table)
        if since < v.base:
            return None
        came = self._rows(table, v, [p for p in v.parts if p.seq > since], v.struct)
        before = replace(v, deletes=tuple(d for d in v.deletes if d.seq <= since))
        later = replace(v, deletes=tuple(d for d in v.deletes if d.seq > since))
        old = [p for p in v.parts if p.seq <= since]
        if not later.deletes or not old:
            return came, self.spark.createDataFrame([], v.struct)
        key = later.deletes[0].key
        gone = self.spark.read.schema(StructType([v.struct[key]])).parquet(*[f"{self._dir(table)}/{d.folder}" for d in later.deletes]).distinct()
        small = broadcastable(sum(d.rows for d in later.deletes))
        went = self._rows(table, before, old, v.struct).join(F.broadcast(gone) if small else gone, key, "left_semi")
        return came, went

    # -- upkeep -----------------------------------------------------------

    def sweep(self, table: str, keep_versions: int = 2, older_than_s: float = 86_400.0) -> list[str]:
        """Remove folders of ``table`` that none of its newest ``keep_versions`` versions names; returns their names.

        Folders younger than ``older_than_s`` stay: a job that has not logged
        its version yet may be writing them.  Readers of a kept version lose
        nothing.  Log entries of older versions go first, so that no entry
        names a missing folder.
        """
        if keep_versions < 1:
            raise ValueError("at least one version stays")
        entries = self._entries().where(F.col("table") == table)
        newest = [r["version"] for r in entries.select("version").orderBy(F.desc("version")).limit(keep_versions).collect()]
        kept = [Version.parse(json.loads(r["entry"])) for r in entries.where(F.col("version") >= min(newest)).collect()]
        named = {n for v in kept for p in v.parts for n in (p.folder, f"{p.folder}.keys")} | {d.folder for v in kept for d in v.deletes}
        for r in entries.where(F.col("version") < min(newest)).select("version").collect():
            fs, path = self._fs(f"{self._log()}/{table}.v{r['version']}.json")
            fs.delete(path, False)
        fs, folder = self._fs(self._dir(table))
        gone = []
        for status in fs.listStatus(folder):
            name = status.getPath().getName()
            if name not in named and status.getModificationTime() / 1000 < time.time() - older_than_s:
                fs.delete(status.getPath(), True)
                gone.append(name)
        return sorted(gone)

    def write_many(self, frames, names, parallel: int = 4, write=None) -> dict[str, int]:
        """Write independent tables as concurrent Spark jobs (one thread each), by ``write(name, frame)``.

        ``frames`` may be a lazy mapping: each thread builds its own table's
        plan.  Tables never share folders (data or version-log entries).
        """
        names, write = list(names), write or self.write
        if parallel <= 1:
            return {n: write(n, frames[n]) for n in names}
        from concurrent.futures import ThreadPoolExecutor
        with ThreadPoolExecutor(max_workers=parallel) as pool:
            futures = {n: pool.submit(lambda n=n: write(n, frames[n])) for n in names}
            return {n: f.result() for n, f in futures.items()}

    def register(self) -> list[str]:
        """Expose the live version of every table as ``<layer>.<table>`` in the catalog.

        SQL written against the warehouse (ad-hoc metric scripts) then runs
        with ``spark.sql``; re-register after writes to follow new versions.
        A table of several parts becomes a view over them.
        """
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {self.layer}")
        names = []
        for table in sorted(self._live):
            name, v = f"{self.layer}.{table}", self._live[table]
            if self.spark.catalog.tableExists(name):
                kind = "VIEW" if self.spark.catalog.getTable(name).tableType == "VIEW" else "TABLE"
                self.spark.sql(f"DROP {kind} {name}")
            alone = len({p.folder for p in v.parts}) == 1 and all(p.schema == v.schema for p in v.parts) and not v.deletes
            if alone:
                self.spark.catalog.createTable(name, path=self.path(table), source="parquet")
                if any(c.isPartition for c in self.spark.catalog.listColumns(name)):
                    self.spark.catalog.recoverPartitions(name)
            else:
                self.spark.sql(f"CREATE VIEW {name} AS {self._select(table, v)}")
            names.append(name)
        return names

    def _select(self, table: str, v: Version) -> str:
        """The live rows as SQL text, for a view."""
        def quoted(value: str) -> str:
            return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"

        out = []
        folders: dict[tuple, list[Part]] = {}
        for p in v.parts:
            folders.setdefault((p.folder, p.schema, p.seq, p.column), []).append(p)
        for (folder, own, seq, column), members in folders.items():
            have = {f.name for f in StructType.fromJson(json.loads(own)).fields}
            columns = ", ".join(f"CAST({f'p.`{f.name}`' if f.name in have else 'NULL'} AS {f.dataType.simpleString()}) AS `{f.name}`" for f in v.struct.fields)
            sql = f"SELECT {columns} FROM parquet.`{self._dir(table)}/{folder}` p"
            where = []
            if column:
                named = [quoted(p.value) for p in members if p.value is not None]
                either = [f"CAST(p.`{column}` AS STRING) IN ({', '.join(named)})"] if named else []
                either += [f"p.`{column}` IS NULL"] if any(p.value is None for p in members) else []
                where.append("(" + " OR ".join(either) + ")")
            for d in v.deletes:
                if d.seq > seq:
                    where.append(f"NOT EXISTS (SELECT 1 FROM parquet.`{self._dir(table)}/{d.folder}` d WHERE d.`{d.key}` = p.`{d.key}`)")
            out.append(sql + (" WHERE " + " AND ".join(where) if where else ""))
        return " UNION ALL ".join(out)
