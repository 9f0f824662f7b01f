"""What is stored for how long: partitions listed through the file system, a rule for each tier, and deletion on request."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from datetime import date, timedelta
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession

from postpulse.config import RETENTION, Tier
from postpulse.sinks.files import Entry, Files

REPORT = "tier string, path string, partition string, files long, bytes long, reason string"


@dataclass(frozen=True)
class Partition:
    path: str
    value: str
    files: int
    size: int


def _folders(files: Files, path: str) -> list[Entry]:
    return [e for e in files.entries(path) if e.is_dir and not e.name.startswith(("_", "."))]


def _content(files: Files, path: str) -> Iterator[Entry]:
    """All files below a folder."""
    for entry in files.entries(path):
        if entry.is_dir:
            yield from _content(files, entry.path)
        else:
            yield entry


def partition_catalogue(spark: SparkSession, path: str, column: str = "date") -> list[Partition]:
    """The partitions of a table by one of its partition columns, at whatever depth it lies; only folders are listed, nothing is read."""
    files, found, open_ = Files(spark), [], [path]
    while open_:
        for entry in _folders(files, open_.pop()):
            name, _, value = entry.name.partition("=")
            if name == column and value:
                content = [e for e in _content(files, entry.path) if not e.name.startswith(("_", "."))]
                found.append(Partition(entry.path, unquote(value), len(content), sum(e.size for e in content)))
            elif value:
                open_.append(entry.path)
    return sorted(found, key=lambda p: (p.value, p.path))


def expired_partitions(spark: SparkSession, base: str, as_of: str, tiers: Sequence[Tier] = RETENTION) -> list[tuple]:
    """Partitions and models that the rules of their tier no longer keep, as rows of ``REPORT``. Partitions of other names than days stay."""
    day, out, files = date.fromisoformat(as_of[:10]), [], Files(spark)
    for tier in tiers:
        path = f"{base.rstrip('/')}/{tier.folder}"
        if tier.days is not None:
            first = (day - timedelta(days=tier.days)).isoformat()
            for p in partition_catalogue(spark, path, tier.column):
                if re.fullmatch(r"\d{4}-\d\d-\d\d", p.value) and p.value < first:
                    out.append((tier.folder, p.path, p.value, p.files, p.size, f"older than {tier.days} days"))
        if tier.latest is not None:
            # Names carry the time of their making, so their order is that of time.
            for entry in [e for e in files.entries(path) if not e.name.startswith(("_", "."))][: -tier.latest or None]:
                content = list(_content(files, entry.path)) if entry.is_dir else [entry]
                out.append((tier.folder, entry.path, entry.name, len(content), sum(e.size for e in content), f"not among the latest {tier.latest}"))
    return out


def apply_retention(spark: SparkSession, base: str, as_of: str, tiers: Sequence[Tier] = RETENTION, delete: bool = False) -> DataFrame:
    """What retention drops. Nothing is deleted unless ``delete`` is asked for; a run that was cut short is finished by the next one."""
    found = expired_partitions(spark, base, as_of, tiers)
    if delete:
        files = Files(spark)
        for row in found:
            files.delete(row[1])
    return spark.createDataFrame(found, REPORT)
