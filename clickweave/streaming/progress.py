"""Progress counters as observations, kept as a table.

A counted frame carries a named row counter that Spark fills while the rows are
processed: no extra job, no collect. In a stream, ``ProgressTable`` listens to the query's progress and
writes each batch's counts as one small file per (query, batch), so a repeated report
replaces itself; ``read_progress`` reads them.
"""

from __future__ import annotations

import json
import time

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from .commits import Folder

PROGRESS = "progress"
PROGRESS_SCHEMA = "query string, batch long, name string, rows long"


def counted(df: DataFrame, name: str = PROGRESS) -> tuple[DataFrame, Observation | None]:
    """The frame with a row counter, and in batch the observation to ``get`` it from after an action."""
    rows = F.count(F.lit(1)).alias("rows")
    if df.isStreaming:
        return df.observe(name, rows), None
    seen = Observation(name)
    return df.observe(seen, rows), seen


class ProgressTable(StreamingQueryListener):
    """Writes the counters of every finished batch below ``path``."""

    def __init__(self, spark: SparkSession, path: str):
        self.folder = Folder(spark, path)
        self.folder.make()

    def onQueryStarted(self, event) -> None: ...

    def onQueryIdle(self, event) -> None: ...

    def onQueryTerminated(self, event) -> None: ...

    def onQueryProgress(self, event) -> None:
        p = event.progress
        for name, row in p.observedMetrics.items():
            record = {"query": str(p.id), "batch": p.batchId, "name": name, "rows": row["rows"]}
            self.folder.write(f"{p.id}-{p.batchId}-{name}.json", json.dumps(record))


def read_progress(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(PROGRESS_SCHEMA).json(path)


def await_reports(table: ProgressTable, query: StreamingQuery, name: str = PROGRESS, seconds: float = 60) -> None:
    """Reports are delivered behind the batches: wait for that of the query's last batch."""
    last = query.lastProgress
    end = time.time() + seconds
    while last is not None and time.time() < end:
        if table.folder.exists(f"{last.id}-{last.batchId}-{name}.json"):
            return
        time.sleep(0.1)
