"""Tables whose partitions are written beside the live ones and published in one step.

A table is a folder of versions, each partitioned by one column. The manifest says which version of
each partition is live; it is one small file, put in place by a rename, so readers see all tables
as they were before a publish or as they are after it. A writer that fails in between leaves folders
that nobody reads. One writer publishes to a lake at a time; readers need no lock.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerlake.session import CODEC

NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


def folder(by: str, value) -> str:
    return f"{by}={NO_VALUE if value is None else value}"


def _no_rows(spark: SparkSession, schema: str) -> DataFrame:
    """An empty frame that the optimizer sees to be empty, so joins and unions with it cost nothing."""
    fields = StructType.fromDDL(schema).fields if schema else []
    return spark.range(1).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in fields]).where("false")


@dataclass
class State:
    """tables: {table: {partition folder: version}}; batches: last batch of each source; numbers: sizes."""

    number: int = 0
    tables: dict[str, dict[str, str]] = field(default_factory=dict)
    batches: dict[str, int] = field(default_factory=dict)
    numbers: dict[str, int] = field(default_factory=dict)


class Lake:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        jvm = spark._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())
        self._text = jvm.org.apache.commons.io.IOUtils

    def _names(self, where: str) -> list[str]:
        path = self._path(f"{self.root}/{where}")
        return [s.getPath().getName() for s in self._fs.listStatus(path)] if self._fs.exists(path) else []

    def manifests(self) -> list[str]:
        return sorted(n for n in self._names("_manifest") if n.endswith(".json") and not n.startswith("."))

    def state(self, name: str | None = None) -> State:
        """What the newest manifest says (or the named one)."""
        names = [name] if name else self.manifests()
        if not names:
            return State()
        stream = self._fs.open(self._path(f"{self.root}/_manifest/{names[-1]}"))
        try:
            return State(**json.loads(self._text.toString(stream, "UTF-8")))
        finally:
            stream.close()

    def done(self, source: str, batch_id: int | None) -> bool:
        """Whether a batch of a source is already published, so a replay has nothing to do."""
        return batch_id is not None and self.state().batches.get(source, -1) >= batch_id

    def read(self, table: str, schema: str | None = None, folders: list[str] | None = None) -> DataFrame:
        """The live partitions of a table, or those of them that are named; others are not even listed.

        A partition may live in several versions at once, under names of the form folder@version.
        """
        wanted = None if folders is None else set(folders)
        live = [(name.split("@")[0], v) for name, v in self.state().tables.get(table, {}).items()]
        return self._load(table, schema, [f"{self.root}/{table}/v={v}/{f}" for f, v in live if wanted is None or f in wanted])

    def staged(self, table: str, schema: str | None, version: str) -> DataFrame:
        """What a version holds, published or not."""
        where = f"{table}/v={version}"
        return self._load(table, schema, [f"{self.root}/{where}/{n}" for n in self._names(where) if "=" in n])

    def _load(self, table: str, schema: str | None, paths: list[str]) -> DataFrame:
        if not paths:
            return _no_rows(self.spark, schema or "")
        reader = self.spark.read if schema is None else self.spark.read.schema(f"{schema}, v string")
        return reader.option("basePath", f"{self.root}/{table}").parquet(*paths).drop("v")

    def stage(self, df: DataFrame, table: str, by: str, version: str, dealt: bool = False) -> dict[str, str]:
        """Write a version beside the live ones; returns its partitions for publish().

        Rebalancing gives a small partition one file and lets AQE cut a large one into several. Rows that
        are `dealt` lie by partition already, as those read from a table stored by it, and are not shuffled.
        """
        where = f"{table}/v={version}"
        rows = df if dealt else df.hint("rebalance", by)
        rows.write.mode("overwrite").option("compression", CODEC).partitionBy(by).parquet(f"{self.root}/{where}")
        return {n: version for n in self._names(where) if "=" in n}

    def publish(
        self, changes: dict[str, dict[str, str | None]], source: str = "", batch_id: int | None = None, **numbers: int | None
    ) -> None:
        """Make staged partitions live; a partition whose version is None is no longer there."""
        state = self.state()
        for table, partitions in changes.items():
            live = {**state.tables.get(table, {}), **partitions}
            state.tables[table] = {f: v for f, v in sorted(live.items()) if v is not None}
        if batch_id is not None:
            state.batches[source] = batch_id
        state.numbers = {k: n for k, n in {**state.numbers, **numbers}.items() if n is not None}
        state.number += 1
        waiting = self._path(f"{self.root}/_manifest/.{uuid.uuid4().hex}.tmp")
        out = self._fs.create(waiting)
        out.write(bytearray(json.dumps(vars(state)).encode()))
        out.close()
        target = self._path(f"{self.root}/_manifest/{state.number:012d}.json")
        if self._fs.exists(target) or not self._fs.rename(waiting, target):
            raise RuntimeError(f"{self.root} was published by another writer")

    def vacuum(self, keep: int = 2) -> int:
        """Delete what the newest `keep` manifests do not name; returns how many version folders went."""
        names = self.manifests()
        used: set[tuple[str, str]] = set()
        tables: set[str] = set()
        for name in names[-keep:]:
            for table, live in self.state(name).tables.items():
                tables.add(table)
                used |= {(table, v) for v in live.values()}
        gone = 0
        for table in tables:
            for n in self._names(table):
                if n.startswith("v=") and (table, n[2:]) not in used:
                    gone += bool(self._fs.delete(self._path(f"{self.root}/{table}/{n}"), True))
        for name in names[:-keep]:
            self._fs.delete(self._path(f"{self.root}/_manifest/{name}"), False)
        return gone
