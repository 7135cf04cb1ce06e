"""Versioned dimension tables.

``publish`` makes the lookup tables ready to be joined, once per change: one row a key
(the last record), and IP ranges as disjoint intervals with their country's name. They are
written as a new version, whose marker is written last; readers take the newest
marked one. ``DimensionReader`` looks at the marker alone and opens tables only when the
version is another, so a micro-batch joins plain scans: no aggregate, no sweep.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..operators.enrich import prepare_lookups
from ..session import ensure_shared_dir
from ..streaming.commits import Folder

TABLES = ("products", "visitors", "country_ranges")
KEPT_VERSIONS = 3


def _versions(folder: Folder) -> list[str]:
    return [n for n in folder.names() if n.startswith("v") and folder.exists(f"{n}/_READY")]


def publish(spark: SparkSession, path: str, products: DataFrame, visitors: DataFrame, ip_ranges: DataFrame,
            countries: DataFrame) -> str:
    """Write the next version; returns its name."""
    folder = Folder(spark, path)
    known = _versions(folder)
    number = int(known[-1][1:11]) + 1 if known else 0
    version = f"v{number:010d}-{uuid.uuid4().hex}"
    for name, table in prepare_lookups(products, visitors, ip_ranges, countries).items():
        table.write.parquet(f"{folder.base}/{version}/{name}")
    folder.write(f"{version}/_READY", "")
    for old in [*known, version][:-KEPT_VERSIONS]:
        folder.delete(old)
    return version


def current_version(spark: SparkSession, path: str) -> str | None:
    return next(reversed(_versions(Folder(spark, path))), None)


def open_version(spark: SparkSession, path: str, version: str) -> dict[str, DataFrame]:
    return {name: spark.read.parquet(f"{path.rstrip('/')}/{version}/{name}") for name in TABLES}


class DimensionReader:
    """The newest version's tables; they are opened again only when there is a newer one. ``refresh`` is
    called first and may publish one."""

    def __init__(self, spark: SparkSession, path: str, refresh: Callable[[], None] = lambda: None):
        self.spark, self.path, self.refresh = spark, path, refresh
        self.version: str | None = None
        self.opened = 0
        self.tables: dict[str, DataFrame] = {}

    def __call__(self) -> dict[str, DataFrame]:
        self.refresh()
        version = current_version(self.spark, self.path)
        if version != self.version:
            self.tables = open_version(self.spark, self.path, version) if version else {}
            self.version, self.opened = version, self.opened + 1
        return self.tables


def change_marker(spark: SparkSession, *paths: str) -> str:
    """A digest of the names, sizes and change times of all files below the paths (missing ones count as empty)."""
    hadoop, conf = spark._jvm.org.apache.hadoop.fs, spark._jsc.hadoopConfiguration()
    found = []
    for path in paths:
        p = hadoop.Path(path)
        fs = p.getFileSystem(conf)
        if fs.exists(p):
            files = fs.listFiles(p, True)
            while files.hasNext():
                f = files.next()
                found.append(f"{f.getPath()}|{f.getLen()}|{f.getModificationTime()}")
    return hashlib.sha256("\n".join(sorted(found)).encode()).hexdigest()


def published(spark: SparkSession, sources: list[str], load: Callable[[], tuple[DataFrame, DataFrame, DataFrame, DataFrame]]) -> dict[str, DataFrame]:
    """The tables of ``load()``, published in the shared folder once per state of the source files."""
    path = f"{ensure_shared_dir(spark).rstrip('/')}/dimensions/{change_marker(spark, *sources)}"
    version = current_version(spark, path) or publish(spark, path, *load())
    return open_version(spark, path, version)
