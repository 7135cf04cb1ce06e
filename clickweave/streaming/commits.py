"""Commits in a folder that many jobs read: staged batches, and logs of runs.

``commit_batch`` (X13): a batch is written in a hidden staging folder, then its
manifest, the list of its partition folders, is written in one step, and only then are the
folders moved to where consumers look. A write that breaks off before the manifest leaves nothing
to see and is done again; one that breaks off behind it is only moved on. So consumers,
streams included, see all files of one attempt, once.

``RunLog`` (X4, X7): what every batch adds to an additive table, as runs in levels.
``FANOUT`` runs of a level are merged into one of the next, so n batches leave
about FANOUT * log(n) folders. The live runs are named by a manifest, a new file per
commit that is renamed into place: readers take the newest one and see the state before or
after a commit or a compaction, never between. Replaced runs stay for some commits, for readers that began earlier.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FANOUT = 8
KEPT_COMMITS = 16


class Folder:
    """A folder of any Hadoop file system; names are relative to it."""

    def __init__(self, spark: SparkSession, base: str):
        self.spark, self.base = spark, base.rstrip("/")
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.base).getFileSystem(spark._jsc.hadoopConfiguration())

    def path(self, name: str):
        return self._path(f"{self.base}/{name}" if name else self.base)

    def exists(self, name: str) -> bool:
        return self._fs.exists(self.path(name))

    def names(self, name: str = "") -> list[str]:
        p = self.path(name)
        return sorted(s.getPath().getName() for s in self._fs.listStatus(p)) if self._fs.exists(p) else []

    def make(self, name: str = "") -> None:
        self._fs.mkdirs(self.path(name))

    def move(self, name: str, to: str) -> None:
        parent = to.rpartition("/")[0]
        if parent:
            self.make(parent)
        if not self._fs.rename(self.path(name), self.path(to)):
            raise OSError(f"{self.base}: {name} could not be moved to {to}")

    def delete(self, name: str) -> None:
        self._fs.delete(self.path(name), True)

    def write(self, name: str, text: str) -> None:
        """A whole small file in one step."""
        folder, _, last = name.rpartition("/")
        hidden = f"{folder}/.{last}.{uuid.uuid4().hex}" if folder else f".{last}.{uuid.uuid4().hex}"
        out = self._fs.create(self.path(hidden), True)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()
        self.move(hidden, name)

    def read(self, name: str) -> str:
        source = self._fs.open(self.path(name))
        try:
            return bytes(self.spark._jvm.org.apache.commons.io.IOUtils.toByteArray(source)).decode()
        finally:
            source.close()


def _partition_folders(folder: Folder, top: str, depth: int) -> list[str]:
    """Folders of ``depth`` partition columns below ``top``, relative to it."""
    found = [""]
    for _ in range(depth):
        found = [f"{f}/{n}".lstrip("/") for f in found for n in folder.names(f"{top}/{f}".rstrip("/")) if "=" in n]
    return found


def commit_batch(df: DataFrame, path: str, batch_id: int, partition_cols: list[str], at: Callable[[str], None] = lambda step: None) -> None:
    """Write a batch under its own ``batch`` partitions, all of it or nothing, once. ``at`` is told the steps."""
    folder = Folder(df.sparkSession, path)
    stage, manifest = f"_staging/{batch_id}", f"_batches/{batch_id}"
    if not folder.exists(manifest):
        out = df.withColumn("batch", F.lit(batch_id).cast("long"))
        out.write.mode("overwrite").partitionBy(*partition_cols, "batch").parquet(f"{folder.base}/{stage}")
        at("before manifest")
        folder.write(manifest, "\n".join(_partition_folders(folder, stage, len(partition_cols) + 1)))
    elif not folder.exists(stage):
        return
    at("behind manifest")
    for name in folder.read(manifest).splitlines():
        if folder.exists(f"{stage}/{name}"):
            folder.move(f"{stage}/{name}", name)
    folder.delete(stage)


def breaking_off(step: str, batch: int) -> Callable:
    """``commit_batch`` that fails at a step of one batch, to rehearse a lost driver."""
    def commit(df: DataFrame, path: str, batch_id: int, partition_cols: list[str]) -> None:
        def at(now: str) -> None:
            if batch_id == batch and now == step:
                raise RuntimeError(f"broken off {step}")
        commit_batch(df, path, batch_id, partition_cols, at)
    return commit


class RunLog:
    """An additive table. ``merge`` makes one run of the union of several (also of one); it must give the
    same whatever is merged first. ``retain`` filters what a compaction keeps."""

    def __init__(self, spark: SparkSession, path: str, schema: str, merge: Callable[[DataFrame], DataFrame],
                 retain: Callable[[DataFrame], DataFrame] | None = None, fanout: int = FANOUT):
        self.spark, self.schema, self.merge, self.retain, self.fanout = spark, schema, merge, retain, fanout
        self.folder = Folder(spark, path)

    def _state(self) -> tuple[int, dict]:
        names = [n for n in self.folder.names("_manifest") if n.isdigit()]
        if not names:
            return 0, {"batch": -1, "runs": [], "gone": []}
        return int(names[-1]), json.loads(self.folder.read(f"_manifest/{names[-1]}"))

    def _runs(self, names: list[str]) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(*[f"{self.folder.base}/{n}" for n in names])

    def _write(self, df: DataFrame, level: int) -> list:
        name = f"runs/level{level}-{uuid.uuid4().hex}"
        df.write.parquet(f"{self.folder.base}/{name}")
        return [level, name]

    def commit(self, df: DataFrame, batch_id: int) -> None:
        """Add a batch's rows, once, and merge levels that are full."""
        number, state = self._state()
        if batch_id <= state["batch"]:
            return
        runs = [*state["runs"], self._write(self.merge(df), 0)]
        gone = list(state["gone"])
        level = 0
        while True:
            full = [r for r in runs if r[0] == level]
            if len(full) < self.fanout:
                break
            rows = self._runs([name for _, name in full])
            merged = self._write(self.merge(self.retain(rows) if self.retain else rows), level + 1)
            runs = [r for r in runs if r[0] != level] + [merged]
            gone += [[number + 1, name] for _, name in full]
            level += 1
        old = [g for g in gone if g[0] <= number + 1 - KEPT_COMMITS]
        state = {"batch": batch_id, "runs": runs, "gone": [g for g in gone if g not in old]}
        self.folder.write(f"_manifest/{number + 1:020d}", json.dumps(state))
        for _, name in old:
            self.folder.delete(name)
        for name in self.folder.names("_manifest"):
            if name.isdigit() and int(name) <= number + 1 - KEPT_COMMITS:
                self.folder.delete(f"_manifest/{name}")

    def read(self, narrow: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
        """The merged table; ``narrow`` is applied before the merge (it must commute with it)."""
        names = [name for _, name in self._state()[1]["runs"]]
        rows = self._runs(names) if names else self.spark.range(0).select(*[F.lit(None).cast(t).alias(c) for c, t in (f.split() for f in self.schema.split(", "))])
        return self.merge(narrow(rows))
