"""Small helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickweave.session import ensure_shared_dir, shared_path

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: cuts the lineage, survives
    lost executors, and gives later joins a plain scan on this side."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def aside(docs: DataFrame, *needed: str) -> tuple[DataFrame, list[str]]:
    """``docs`` with all columns but the needed ones under names of our own, by position, so
    that no name of the input clashes with one in use; and the names."""
    names = [c if c in needed else f"_in_{i}" for i, c in enumerate(docs.columns)]
    return docs.toDF(*names), names


def checkpointed(df: DataFrame) -> DataFrame:
    ensure_shared_dir(df.sparkSession)
    return df.checkpoint()


def fold_of(doc_id: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo 4 (null for a null id)."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4


def is_held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(fold_of(doc_id) == 2, F.lit(False))


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def texts_of(column: pa.Array) -> Iterator[str | None]:
    """The texts one by one, so that only a slice of a batch is held as Python strings."""
    return (x.as_py() for x in column)


def text_slices(texts: Iterable[str | None], max_chars: int = 4_000_000) -> Iterator[tuple[int, list[str]]]:
    """Runs of whole texts of about ``max_chars`` in all (one text may be longer), with
    the index of the first; null counts as empty. Bounds the work memory per step."""
    start, run, chars = 0, [], 0
    for i, t in enumerate(texts):
        t = t or ""
        if run and chars + len(t) > max_chars:
            yield start, run
            start, run, chars = i, [], 0
        run.append(t)
        chars += len(t)
    if run:
        yield start, run


def arrow_batch(columns: dict, schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], type=f.type) for f in schema], schema=schema)
