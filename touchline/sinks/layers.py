"""Layers of published tables (S30, S31, S33): written aside, checked while written, switched together.

A layer is a folder and a Spark namespace. `write` puts a table into a new folder and counts its rows and the nulls of its
key columns in the same pass (`Observation`). `publish` appends one file that names the current folder of every table
written since, and points the namespace's tables to them; until then readers see the old ones. A refresh whose checks fail
is not published, and its folders go with the next `vacuum`.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from .shared import input_state
from .store import ddl

LAYERS = ("raw", "staging", "marts")


def namespace(layer: str) -> str:
    return f"touchline_{layer}"


class Layer:
    """The published tables under `{base}/{layer}`."""

    def __init__(self, spark: SparkSession, base: str, layer: str):
        if layer not in LAYERS:
            raise ValueError(f"no layer {layer}: {LAYERS}")
        self.spark, self.layer, self.root = spark, layer, f"{base.rstrip('/')}/{layer}"
        self.version, self.current = -1, {}
        self._written: dict[str, dict] = {}
        if input_state(spark, self._registry)[0]:
            rows = spark.read.schema("version bigint, name string, entry string").parquet(self._registry)
            for r in rows.groupBy("name").agg(F.max("version").alias("version"), F.max_by("entry", "version").alias("entry")).collect():
                self.current[r.name] = json.loads(r.entry)
                self.version = max(self.version, r.version)

    @property
    def _registry(self) -> str:
        return f"{self.root}/_published"

    def write(self, name: str, df: DataFrame, not_null: list[str] = (), note: dict | None = None) -> DataFrame:
        """Writes a table aside and returns it; its row and null counts are in `counts`, `note` is kept with it."""
        path = f"{self.root}/{name}/v-{uuid.uuid4().hex[:12]}"
        seen = Observation()
        df.observe(seen, F.count(F.lit(1)).alias("rows"), *[F.count_if(F.col(c).isNull()).alias(f"null:{c}") for c in not_null]).write.parquet(path)
        self._written[name] = {"path": path, "columns": {f.name: f.dataType.simpleString() for f in df.schema.fields}, "counts": seen.get, "note": note}
        return self.read(name)

    def counts(self, name: str) -> dict[str, int]:
        return (self._written.get(name) or self.current[name])["counts"]

    def read(self, name: str) -> DataFrame:
        """The table as this writer sees it: what it wrote last, else what is published."""
        entry = self._written.get(name) or self.current[name]
        return self.spark.read.schema(ddl(entry["columns"])).parquet(entry["path"])

    def publish(self) -> None:
        """Makes everything written so far current, with one file."""
        if self._written:
            rows = [(self.version + 1, name, json.dumps(entry)) for name, entry in sorted(self._written.items())]
            self.spark.createDataFrame(rows, "version bigint, name string, entry string").coalesce(1).write.mode("append").parquet(self._registry)
            self.version, self.current, self._written = self.version + 1, self.current | self._written, {}
        self.attach()

    def attach(self) -> None:
        """Declares the published tables in this session's catalog."""
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {namespace(self.layer)} LOCATION '{self.root}/_namespace'")
        for name, entry in self.current.items():
            table = f"{namespace(self.layer)}.{name}"
            self.spark.sql(f"DROP TABLE IF EXISTS {table}")
            self.spark.sql(f"CREATE TABLE {table} ({ddl(entry['columns'])}) USING parquet LOCATION '{entry['path']}'")

    def truncate(self, *names: str) -> None:
        """Empties tables, all if none is named; their columns stay."""
        for name in names or sorted(self.current):
            self.write(name, self.spark.createDataFrame([], ddl(self.current[name]["columns"])))
        self.publish()

    def vacuum(self) -> int:
        """Deletes folders of tables that are not current; returns how many went."""
        live = {e["path"].rsplit("/", 1)[1] for e in [*self.current.values(), *self._written.values()]}
        where = self.spark._jvm.org.apache.hadoop.fs.Path
        files = where(self.root).getFileSystem(self.spark._jsc.hadoopConfiguration())
        gone = 0
        for name in self.current:
            for f in files.listStatus(where(f"{self.root}/{name}")):
                if f.getPath().getName() not in live:
                    gone += bool(files.delete(f.getPath(), True))
        return gone
