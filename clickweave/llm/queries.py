"""The training-data operators as registered queries; their DuckDB SQL is in ``sql``.

Each query applies its operator with production parameters to the whole intended table.
Queries without SQL are compared with brute-force versions in ``tests/llm``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickweave.llm import (byte_shards, crf_langid, fim_arrow, line_runs, link_trust, lsa_knn, lsh_forest, nra_topk, poisson_mix, radix_dedup, sql,
                            turn_repair, vector_pack, warc)
from clickweave.llm.common import fold_of, is_held_out, table
from clickweave.llm.params import OTHER_SHARE, RULES, TARGETS

def op1_crf_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = crf_langid.fit(crf_langid.training_sample(docs, fold_of() != 2))
    return crf_langid.predict(docs, model).select("doc_id", is_held_out().alias("held_out"), "lang_pred", "score")


def op2_radix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return radix_dedup.exact_groups(table(spark, sf_dir, "documents"))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_runs.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", F.col("_line_n").cast("long").alias("n_lines"), F.col("_line_lost").cast("long").alias("n_dropped"),
        F.sha2(F.col("_line_kept").cast("binary"), 256).alias("kept_sha256"))


def op4_lsh_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lsh_forest.near_groups(table(spark, sf_dir, "documents")).drop("text_hash")


def op5_knn_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = lsa_knn.fit(*lsa_knn.training_sample(docs, table(spark, sf_dir, "labels"), fold_of() != 2))
    return lsa_knn.score(docs, model).select("doc_id", is_held_out().alias("held_out"), "score",
                                             (F.col("score") >= lsa_knn.PREDICT_AT).cast("int").alias("predicted"))


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_pack.pack(table(spark, sf_dir, "documents"))


def op7_poisson_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return poisson_mix.poisson_mix(table(spark, sf_dir, "documents"), TARGETS, OTHER_SHARE, present_only=True)


def op8_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nra_topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_trust.judge_urls(table(spark, sf_dir, "pages"), RULES)


def op10_byte_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_shards.byte_shards(table(spark, sf_dir, "documents"))


def op11_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    found = turn_repair.digests(turn_repair.damaged(turns))
    numbers = [c for c in found.columns if c not in ("conv_id", "audit", "repaired_sha256")]
    ids = turns.select(F.col("conv_id").alias("id")).distinct()
    return ids.join(found, F.col("id").eqNullSafe(F.col("conv_id")), "left").select(
        F.col("id").alias("conv_id"), *[F.coalesce(c, F.lit(0)).alias(c) for c in numbers], F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"))


def op12_fim_arrow(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fim_arrow.fill_in_middle(table(spark, sf_dir, "documents"))
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
                       F.sha2(fim_arrow.restore(F.col("output"), F.col("form")).cast("binary"), 256).alias("restored_sha256"))


def op13_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.payload_facts(warc.write(table(spark, sf_dir, "pages")))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {f.__name__: f for f in (op1_crf_langid, op2_radix_dedup, op3_line_dedup, op4_lsh_forest, op5_knn_quality, op6_best_fit_packing, op7_poisson_mix,
                                   op8_exact_topk, op9_url_filter, op10_byte_shards, op11_turn_repair, op12_fim_arrow, op13_warc, pipeline)}


def oracle_sql() -> dict[str, str]:
    return sql.ORACLES
