"""SparkSession construction and shared-folder helpers.

Everything that the library writes between stages (checkpoints, stream
state, mart tables) goes under the folder the cluster names in
``spark.checkpoint.dir`` or the context's checkpoint folder. Only a local
master without either, as in tests, gets a fresh scratch folder.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Session settings the library relies on. UTC pins every time computation;
# AQE re-plans joins (size-checked broadcast, skew splitting) and coalesces
# small shuffle partitions at run time.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # Python workers talk to the JVM over a unix socket: no extra TCP port.
    "spark.python.unix.domain.socket.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "clickweave", extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the library's settings.

    On a cluster ``master`` is left to spark-submit; tests pass ``local[n]``.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return prepare(spark)


# Runtime SQL settings the library needs on *any* session it is handed:
# UTC (epoch <-> TIMESTAMP_NTZ conversions) and the RocksDB state store
# (required by transformWithStateInPandas).
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the library's runtime settings and the shared folder to a session,
    and ship the package to the Python workers."""
    for k, v in RUNTIME_CONF.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
    ensure_shared_dir(spark)
    ship_package(spark)
    return spark


def ship_package(spark: SparkSession) -> None:
    """Make the package's code available to every Python worker.

    Operators that run pandas code in tasks (``mapInPandas``, the keyed-state
    processor) use functions of this package. Registering the package with
    PySpark's cloudpickle as pickle-by-value sends that code with each task,
    so executors and the streaming state runner never need to import it
    (no files to distribute, works from any working directory).
    """
    import sys

    from pyspark import cloudpickle
    pkg = sys.modules[__name__.rsplit(".", 1)[0]]
    if pkg.__name__ not in getattr(cloudpickle.cloudpickle, "_PICKLE_BY_VALUE_MODULES", set()):
        cloudpickle.register_pickle_by_value(pkg)


def ensure_shared_dir(spark: SparkSession) -> str:
    """The shared folder: the context's checkpoint folder, else ``spark.checkpoint.dir``.

    Where neither is set, a local master (tests) gets a scratch folder; on a cluster that
    would be a different disk on each machine, so there it is an error.
    """
    sc = spark.sparkContext
    d = spark.conf.get("spark.checkpoint.dir", None) or None
    if sc.getCheckpointDir() is None:
        if d is None:
            if not sc.master.startswith("local[") and sc.master != "local":
                raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
            d = tempfile.mkdtemp(prefix="clickweave-ckpt-")
        sc.setCheckpointDir(d)
    return d or sc.getCheckpointDir()


def shared_path(spark: SparkSession, *parts: str) -> str:
    """A fresh path under the shared folder (unique per call)."""
    base = ensure_shared_dir(spark)
    return os.path.join(base.rstrip("/"), *parts, uuid.uuid4().hex)
