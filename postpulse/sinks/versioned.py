"""Tables that are published in versions, so that readers see one whole version and never a write in progress.

Data files lie in folders of their own for each write and are never changed. A version is one small file: for each table its schema, and for each
day (or other key) the folder that holds its rows. Publishing writes the data first and then puts this file in place in one step,
under the next number. A run that dies in between leaves folders that no version names; a reader keeps the version it opened.
Several tables are published together, so they always belong to each other.

A write of some days carries the folders of all other days over from the version before, and costs what these days hold.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from postpulse.sinks.files import Files

PART = "_part"


class PublishConflict(RuntimeError):
    """Another writer published first; nothing of this write is visible."""


@dataclass
class Version:
    number: int = 0
    #: What writers noted, for instance the last batch of a stream.
    notes: dict[str, str] = field(default_factory=dict)
    schemas: dict[str, str] = field(default_factory=dict)
    #: table -> key -> folder
    parts: dict[str, dict[str, str]] = field(default_factory=dict)


class VersionedTables:
    """A group of tables below ``base``."""

    def __init__(self, spark: SparkSession, base: str):
        self.spark, self.base, self.files = spark, base.rstrip("/"), Files(spark)

    def versions(self) -> list[int]:
        names = [e.name for e in self.files.entries(f"{self.base}/versions")]
        return [int(n.removesuffix(".json")) for n in names if n.endswith(".json") and not n.startswith(".")]

    def version(self, number: int | None = None) -> Version:
        """The given version, or the latest one; version 0 has no tables."""
        if number is None:
            number = max(self.versions(), default=0)
        return Version(**json.loads(self.files.read(self._file(number)))) if number else Version()

    def _file(self, number: int) -> str:
        return f"{self.base}/versions/{number:012d}.json"

    def read(self, table: str, version: Version | None = None, keys: Iterable[str] | None = None) -> DataFrame:
        """A table of a version, or only the rows under ``keys``: other folders are not opened."""
        version = version or self.version()
        folders = version.parts[table]
        wanted = sorted(folders if keys is None else set(keys) & set(folders))
        schema = StructType.fromJson(json.loads(version.schemas[table]))
        if not wanted:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.base}/data/{folders[k]}" for k in wanted])

    def stage(self, tables: dict[str, DataFrame], key: str) -> tuple[dict[str, str], dict[str, dict[str, str]]]:
        """Write the data, invisibly: schemas, and the folder of each key."""
        batch, schemas, parts = f"{int(time.time())}-{uuid.uuid4().hex}", {}, {}
        for name, df in tables.items():
            schemas[name] = df.schema.json()
            keyed = df.withColumn(PART, F.col(key).cast("string"))
            keyed.hint("rebalance", F.col(PART)).write.partitionBy(PART).parquet(f"{self.base}/data/{batch}/{name}")
            found = self.files.entries(f"{self.base}/data/{batch}/{name}")
            parts[name] = {e.name.removeprefix(f"{PART}="): f"{batch}/{name}/{e.name}" for e in found if e.is_dir}
        return schemas, parts

    def publish(
        self, tables: dict[str, DataFrame], key: str, replace: Iterable[str], notes: dict[str, str] | None = None, onto: Version | None = None
    ) -> Version:
        """Publish ``tables`` as the version after ``onto`` (the latest one). Their rows take the place of all rows under the keys ``replace``, also
        where there are no new ones; rows under other keys may not be among them. NULL keys are not allowed."""
        before, replaced = onto or self.version(), set(replace)
        schemas, parts = self.stage(tables, key)
        for name, own in parts.items():
            if not set(own) <= replaced:
                raise ValueError(f"rows of {name} under other keys than those replaced: {sorted(set(own) - replaced)[:5]}")
            parts[name] = {k: f for k, f in before.parts.get(name, {}).items() if k not in replaced} | own
        new = Version(before.number + 1, before.notes | (notes or {}), before.schemas | schemas, before.parts | parts)
        if not self.files.write_new(self._file(new.number), json.dumps(vars(new))):
            raise PublishConflict(f"version {new.number} of {self.base} exists already")
        return new

    def expire(self, keep: int = 5, grace_hours: float = 24) -> int:
        """Delete all but the newest versions, and the data that none of these names; unnamed data younger than the grace time stays, as
        it may belong to a write in progress. The number of deleted folders."""
        numbers = sorted(self.versions())
        for number in numbers[:-keep]:
            self.files.delete(self._file(number))
        kept = [self.version(n) for n in numbers[-keep:]]
        used = {folder.split("/", 1)[0] for v in kept for own in v.parts.values() for folder in own.values()}
        latest = time.time() - grace_hours * 3600
        old = [e for e in self.files.entries(f"{self.base}/data") if e.name not in used and int(e.name.split("-", 1)[0]) <= latest]
        for entry in old:
            self.files.delete(entry.path)
        return len(old)
