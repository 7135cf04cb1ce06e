"""From documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir), works on all rows its predecessor kept and returns
a DataFrame. All but the last return the columns of documents. ``run`` writes each
stage's rows as Parquet in the shared folder and reads them again for the next.

1. language_id: documents without letters (``und``) or whose best language has a score
   under ``MIN_LANG_SCORE`` go.
2. line_dedup: lines that documents share stay in the one with the smallest id; n_chars is
   the length of the text that is left. Documents with nothing left but white space go.
3. near_dedup: of each class of near-duplicates one row stays, one with the smallest id (if
   several rows of the class have that id, or none has any, one of them). Documents without
   words are in no class and stay.
4. mix: documents are repeated, or left out, towards the target weights of the sources that
   are there, to about as many rows as before.
5. pack: the documents' tokens in sequences of at most 2048.

Every stage accepts nulls in any column, empty and very long texts, repeated rows, extra
columns (kept to the last stage) and an empty table; see the operators' docstrings.
``ORACLE_SQL`` is None: the CRF and the packing are no SQL; ``tests/llm`` compares the
stages with brute-force versions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickweave.llm import crf_langid, line_runs, lsh_forest, poisson_mix, vector_pack
from clickweave.llm.common import aside, fold_of, written
from clickweave.llm.params import OTHER_SHARE, TARGETS
from clickweave.session import prepare

MIN_LANG_SCORE = 0.3
ORACLE_SQL = None


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = crf_langid.fit(crf_langid.training_sample(docs, fold_of() != 2))
    here, names = aside(docs, "text")
    judged = crf_langid.predict(here, model, keep=names)
    kept = judged.where((F.col("lang_pred") != crf_langid.UNKNOWN) & (F.col("score") >= MIN_LANG_SCORE))
    return kept.select(*names).toDF(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    here, names = aside(docs, "doc_id", "text", "n_chars")
    kept = line_runs.dedup_lines(here).where(F.col("_line_kept").rlike(r"\S"))
    new = {"text": F.col("_line_kept"), "n_chars": F.char_length("_line_kept").cast("long")}
    return kept.select(*[new.get(c, F.col(c)).alias(c) for c in names]).toDF(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    classes = lsh_forest.near_classes(docs)
    stays = written(classes.where(F.col("doc_id").eqNullSafe(F.col("class_id")))
                    .select("class", F.col("doc_id").alias("_near_id"), F.col("text_hash").alias("_near_hash")).distinct(), "stays")
    here, names = aside(docs, "doc_id", "text")
    own_id = F.col("doc_id").cast("long")
    of_stay = own_id.eqNullSafe(F.col("_near_id")) & (F.xxhash64("text") == F.col("_near_hash"))
    again = written(docs.groupBy(own_id.alias("_near_id")).agg(F.count("*").alias("n")).where("n > 1 and _near_id is not null").select("_near_id"), "again")
    # An id that one row has names it. Rows with another's id, or none, are told apart by a position, written so that it stays.
    single = stays.where("_near_id is not null").join(again, "_near_id", "left_anti")
    named = here.join(single, of_stay, "left_semi").select(*names)
    marked = F.monotonically_increasing_id().alias("_near_row")
    loose = written(here.where(own_id.isNull()).unionAll(here.join(again, own_id == F.col("_near_id"), "left_semi")).select(*names, marked), "loose")
    members = loose.select("_near_row", "doc_id", F.xxhash64("text").alias("_own_hash")).join(
        stays, own_id.eqNullSafe(F.col("_near_id")) & (F.col("_own_hash") == F.col("_near_hash")))
    first = members.where("class is not null").groupBy("class").agg(F.min("_near_row").alias("_near_row")).select("_near_row")
    one = loose.join(first.unionAll(members.where("class is null").select("_near_row")), "_near_row", "left_semi").select(*names)
    return named.unionAll(one).toDF(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return poisson_mix.poisson_mix(docs, TARGETS, OTHER_SHARE, number=None, present_only=True)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return vector_pack.pack(docs)


def _ready(stage):
    """The stage on a session that has the library's settings and code."""
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        return stage(prepare(spark), docs, sf_dir)
    return run_stage


STAGES = [(f.__name__, _ready(f)) for f in (language_id, line_dedup, near_dedup, mix, pack)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
