"""Raw tables that take batches: delta files, a bucketed base, and one registry of layouts and column types.

A table is a *base*, bucketed by its key, and the *deltas* of the batches that came since; a batch writes only its own
rows. Readers lay the deltas over the base: rows of touched matches (or keys) are merged, all others come from the base as
they are. `compact` folds the deltas in when they have grown to a share of the base. The base is a bucketed Spark table, so
the merge reads it without a shuffle and only the deltas are dealt out; the number of buckets follows from measured bytes,
and a base whose size calls for another number is dealt out anew.

The registry is one small table per warehouse. A commit appends the layouts of all tables of a load at once, as the last
step: readers see a load as a whole or not at all, and files of a commit that failed are never read. One writer at a time
is assumed; readers that began before a compaction keep their files until `vacuum`.

Columns may appear, and their types may change between batches. Each delta keeps the types it came with; the registry holds
the widened type of each column (`widened`), and readers cast. Numbers that meet text become text: whole ones without a
fraction, so that it does not matter whether they were stored as long or double before.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import asdict, dataclass, field, replace

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .shared import input_state

BUCKET_BYTES = 128 << 20
MAX_BUCKETS = 100_000
FOLD_SHARE, FOLD_BATCHES = 0.25, 32
BATCH = "_batch"

#: A column that meets another of these types takes the first one that both can become; any other pair becomes text.
_WIDER = {"boolean": ["boolean", "string"], "int": ["int", "bigint", "double", "string"], "bigint": ["bigint", "double", "string"], "double": ["double", "string"], "string": ["string"]}
_SAME = {"tinyint": "int", "smallint": "int", "float": "double"}


def plain_type(name: str) -> str:
    """The registry's name of a column type."""
    return _SAME.get(name, name)


def widened(a: str, b: str) -> str:
    """The type that holds both; `void`, a column of nulls, fits every other."""
    if "void" in (a, b) or a == b:
        return b if a == "void" else a
    a, b = ("double" if t.startswith("decimal") else t for t in (a, b))
    return next((t for t in _WIDER.get(a, []) if t in _WIDER.get(b, [])), "string")


def cast_to(c: Column, have: str, want: str) -> Column:
    """A stored value in its registered type."""
    if have == want:
        return c
    if want == "string":
        if have == "double" or have.startswith("decimal"):
            whole = (c == F.floor(c)) & (F.abs(c) < 1e15)
            return F.when(whole, c.cast("bigint").cast("string")).otherwise(c.cast("double").cast("string"))
        if have.startswith(("array", "map", "struct")):
            return F.to_json(c)
        if have.startswith("timestamp"):
            return F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss")
    return c.cast("string" if want == "void" else want)


def ddl(types: dict[str, str]) -> str:
    return ", ".join(f"`{c}` {'string' if t == 'void' else t}" for c, t in types.items())


def _c(name: str, of: str | None = None) -> Column:
    return F.col(f"{of}.`{name}`" if of else f"`{name}`")


@dataclass(frozen=True)
class Layout:
    """One table: how its rows replace one another, and the files that hold them."""
    keys: list[str]                      # a row replaces the one of its keys, column by column
    measure: str | None = None           # ... only if this column is larger
    whole: bool = False                  # rows of a match (the first key) replace all its rows
    columns: dict[str, str] = field(default_factory=dict)
    base: str | None = None
    base_types: dict[str, str] = field(default_factory=dict)
    base_bytes: int = 0
    buckets: int = 0
    deltas: list[dict] = field(default_factory=list)   # path, batch, types, bytes
    batch: int = 0


def bucket_keys(layout: Layout) -> list[str]:
    return layout.keys[:1] if layout.whole else layout.keys


class Store:
    """The tables under one folder. Changes are pending until `commit`."""

    def __init__(self, spark: SparkSession, root: str, bucket_bytes: int = BUCKET_BYTES):
        self.spark, self.root, self.bucket_bytes = spark, root.rstrip("/"), bucket_bytes
        self.layouts: dict[str, Layout] = {}
        self.version = -1
        self._pending: set[str] = set()
        if input_state(spark, self._registry)[0]:
            rows = spark.read.schema("version bigint, name string, layout string").parquet(self._registry)
            for r in rows.groupBy("name").agg(F.max("version").alias("version"), F.max_by("layout", "version").alias("layout")).collect():
                self.layouts[r.name] = Layout(**json.loads(r.layout))
                self.version = max(self.version, r.version)

    @property
    def _registry(self) -> str:
        return f"{self.root}/_registry"

    def commit(self) -> None:
        """Makes all pending changes visible with one file."""
        if self._pending:
            rows = [(self.version + 1, name, json.dumps(asdict(self.layouts[name]))) for name in sorted(self._pending)]
            self.spark.createDataFrame(rows, "version bigint, name string, layout string").coalesce(1).write.mode("append").parquet(self._registry)
            self.version, self._pending = self.version + 1, set()

    def _change(self, name: str, layout: Layout) -> None:
        self.layouts[name] = layout
        self._pending.add(name)

    # -- writing ---------------------------------------------------------------------

    def append(self, name: str, rows: DataFrame, keys: list[str], measure: str | None = None, whole: bool = False) -> None:
        """Adds a batch. With `whole` the rows of a match replace all its stored rows; else a row replaces the stored one of
        its keys column by column (columns the batch lacks stay), with `measure` only if that is larger. Within the batch a
        key must be unique."""
        old = self.layouts.get(name) or Layout(keys, measure, whole)
        types = {f.name: plain_type(f.dataType.simpleString()) for f in rows.schema.fields}
        clash = {c.lower() for c in types} & {c.lower() for c in old.columns} - {c.lower() for c in set(types) & set(old.columns)}
        if clash:
            raise ValueError(f"{name}: columns {sorted(clash)} differ in case only")
        path = f"{self.root}/{name}/delta-{old.batch:06}-{uuid.uuid4().hex[:8]}"
        rows.select(*[_c(c).cast("string" if t == "void" else t).alias(c) for c, t in types.items()]).write.parquet(path)
        columns = dict(old.columns)
        for c, t in types.items():
            columns[c] = widened(columns[c], t) if c in columns else t
        delta = {"path": path, "batch": old.batch, "types": types, "bytes": input_state(self.spark, path)[1]}
        self._change(name, replace(old, columns=columns, deltas=[*old.deltas, delta], batch=old.batch + 1))

    def truncate(self, *names: str) -> None:
        """Empties the tables, keeping their columns."""
        for name in names:
            self._change(name, replace(self.layouts[name], base=None, base_types={}, base_bytes=0, buckets=0, deltas=[]))

    # -- reading ---------------------------------------------------------------------

    def read(self, name: str) -> DataFrame:
        """The rows of a table as all its batches left them."""
        layout = self.layouts[name]
        base, deltas = self._base(layout), self._deltas(layout)
        if deltas is None:
            return base if base is not None else self.spark.createDataFrame([], ddl(layout.columns))
        return self._laid_over(layout, base, deltas)

    def _shaped(self, layout: Layout, rows: DataFrame, types: dict[str, str], *more: Column) -> DataFrame:
        """Rows of a file with the registered columns and types."""
        cols = [(cast_to(_c(c), types[c], t) if c in types else F.lit(None).cast("string" if t == "void" else t)).alias(c) for c, t in layout.columns.items()]
        return rows.select(*cols, *more)

    def _base(self, layout: Layout) -> DataFrame | None:
        """The base as a bucketed table of this session; its scan is dealt out by key."""
        if layout.base is None:
            return None
        table, by = "touchline_" + layout.base.rsplit("-", 1)[-1], ", ".join(f"`{k}`" for k in bucket_keys(layout))
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({ddl(layout.base_types)}) USING parquet CLUSTERED BY ({by}) INTO {layout.buckets} BUCKETS LOCATION '{layout.base}'")
        return self._shaped(layout, self.spark.table(table), layout.base_types)

    def _deltas(self, layout: Layout) -> DataFrame | None:
        """All deltas with registered types and their batch number."""
        out = None
        for d in layout.deltas:
            rows = self._shaped(layout, self.spark.read.schema(ddl(d["types"])).parquet(d["path"]), d["types"], F.lit(d["batch"]).cast("bigint").alias(BATCH))
            out = rows if out is None else out.unionByName(rows)
        return out

    def _laid_over(self, layout: Layout, base: DataFrame | None, deltas: DataFrame) -> DataFrame:
        if layout.whole:
            return self._replaced(layout, base, deltas)
        keyed = F.lit(True)
        for k in layout.keys:
            keyed = keyed & _c(k).isNotNull()
        # Rows without a key cannot be told apart: those of a match replace those of the match.
        out = self._replaced(layout, None if base is None else base.filter(~keyed), deltas.filter(~keyed))
        changed = self._by_key(layout, deltas.filter(keyed))
        return out.unionByName(changed.select("new.*") if base is None else self._merged(layout, base.filter(keyed), changed))

    def _replaced(self, layout: Layout, base: DataFrame | None, deltas: DataFrame) -> DataFrame:
        match = layout.keys[0]
        last = deltas.groupBy(_c(match).alias("_match")).agg(F.max(BATCH).alias("_last"))
        out = deltas.join(last, _c(match).eqNullSafe(_c("_match")) & (F.col(BATCH) == F.col("_last")), "left_semi").drop(BATCH)
        return out if base is None else out.unionByName(base.join(last, _c(match) == _c("_match"), "left_anti"))

    def _by_key(self, layout: Layout, rows: DataFrame) -> DataFrame:
        """Per key the row `new` its batches leave, and for each column whether any of them had it."""
        keys, every = [_c(k) for k in layout.keys], F.struct(*[_c(c) for c in layout.columns]).alias("new")
        if layout.measure:
            m = _c(layout.measure)
            # Of equal measures the first stays; among rows without one the last does.
            order = F.struct(m.isNotNull(), m, F.when(m.isNotNull(), -F.col(BATCH)).otherwise(F.col(BATCH)))
            return rows.groupBy(*keys).agg(F.max_by(every, order).alias("new"))
        rest = [c for c in layout.columns if c not in layout.keys]
        had = {c: F.col(BATCH).isin([d["batch"] for d in layout.deltas if c in d["types"]]) for c in rest}
        latest = [F.max_by(F.struct(_c(c).alias("v")), F.when(had[c], F.col(BATCH)))["v"].alias(c) for c in rest]
        made = rows.groupBy(*keys).agg(*latest, F.struct(F.lit(True).alias("_"), *[F.max(had[c]).alias(c) for c in rest]).alias("_had"))
        return made.select(*keys, every, F.col("_had").alias("had"))

    def _merged(self, layout: Layout, base: DataFrame, changed: DataFrame) -> DataFrame:
        """Full join with the base, which is bucketed by the keys: only `changed` is dealt out."""
        keys = layout.keys
        both = base.select(*[_c(k) for k in keys], F.struct(*[_c(c) for c in layout.columns]).alias("old")).join(changed, keys, "full")
        came, was = F.col("new").isNotNull(), F.col("old").isNotNull()
        if layout.measure:
            new, old = _c(layout.measure, "new"), _c(layout.measure, "old")
            wins = came & (~was | old.isNull() | (new > old))
            return both.select(*[F.when(wins, _c(c, "new")).otherwise(_c(c, "old")).alias(c) for c in layout.columns])
        return both.select(*[(_c(c) if c in keys else F.when(came & (_c(c, "had") | ~was), _c(c, "new")).otherwise(_c(c, "old"))).alias(c) for c in layout.columns])

    # -- keeping the layout ----------------------------------------------------------

    def wanted_buckets(self, size: int) -> int:
        """Buckets of about `bucket_bytes`, a power of two, so that a growing table is dealt out anew only when it doubles."""
        n = 1
        while n < MAX_BUCKETS and size > n * self.bucket_bytes:
            n *= 2
        return n

    def due(self, name: str) -> bool:
        layout = self.layouts[name]
        return len(layout.deltas) > FOLD_BATCHES or bool(layout.deltas) and sum(d["bytes"] for d in layout.deltas) > FOLD_SHARE * layout.base_bytes

    def compact(self, name: str) -> None:
        """Folds the deltas into a new base."""
        layout = self.layouts[name]
        rows = self.read(name)
        buckets = self.wanted_buckets(layout.base_bytes + sum(d["bytes"] for d in layout.deltas))
        tag = uuid.uuid4().hex[:12]
        path = f"{self.root}/{name}/base-{tag}"
        by = bucket_keys(layout)
        dealt = rows if buckets == layout.buckets else rows.repartition(buckets, *[_c(k) for k in by])
        dealt.write.format("parquet").bucketBy(buckets, *by).option("path", path).saveAsTable(f"touchline_{tag}")
        self._change(name, replace(layout, base=path, base_types=dict(layout.columns), base_bytes=input_state(self.spark, path)[1], buckets=buckets, deltas=[]))

    def compact_due(self) -> list[str]:
        """Compacts what has grown enough; returns the tables."""
        found = [name for name in self.layouts if self.due(name)]
        for name in found:
            self.compact(name)
        return found

    def vacuum(self) -> int:
        """Deletes files that no committed layout names; returns how many folders went."""
        live = {p for x in self.layouts.values() for p in (x.base, *(d["path"] for d in x.deltas)) if p}
        live = {p.split("://")[-1].split(":")[-1] for p in live}
        where = self.spark._jvm.org.apache.hadoop.fs.Path
        files = where(self.root).getFileSystem(self.spark._jsc.hadoopConfiguration())
        gone = 0
        for name in self.layouts:
            folder = where(f"{self.root}/{name}")
            for f in files.listStatus(folder) if files.exists(folder) else []:
                if f.getPath().toUri().getPath() not in live:
                    gone += bool(files.delete(f.getPath(), True))
        return gone


def reading(store: Store) -> Callable[[str], DataFrame]:
    """Reads tables of a store by name, each once."""
    seen: dict[str, DataFrame] = {}

    def read(name: str) -> DataFrame:
        if name not in seen:
            seen[name] = store.read(name)
        return seen[name]

    return read
