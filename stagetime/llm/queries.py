"""The registered queries of this folder and the SQL that they are held against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontam, langid, license_scan, merkle, near_dedup, packing, pii, pivot_search, quality, repair, simhash, token_orc, toxicity
from .common import fold, shared_path, table


def op1_multi_length_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), with_ids=False)


def op2_nnpu_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    learn = fold("doc_id", 5) != 0
    model = toxicity.fit(docs.filter(learn), labels.filter(learn))
    scored = toxicity.score(docs.select("doc_id", "text"), model)
    score = F.col("toxic_score")
    return scored.select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), score.alias("score"), (score >= 0.5).cast("int").alias("predicted"))


def op4_ftrl_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid.fit(docs.filter(fold("doc_id", 3) != 1))
    predicted = langid.predict(docs.select("doc_id", "text"), model)
    return predicted.select("doc_id", (fold("doc_id", 3) == 1).alias("held_out"), "lang_pred", F.col("lang_score").alias("score"))


def op8_license_dice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents"))


def _of_kind(kind: int) -> Column:
    """How many base spans are of a kind; the function has one parameter, as Spark passes the place as a second."""
    return F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long")


def op9_information_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = pii.all_spans(table(spark, sf_dir, "documents"))
    counts = [_of_kind(k).alias(f"n_{name}") for k, name in enumerate(pii.KINDS[:4])]
    return spans.select("doc_id", *counts, F.sha2(pii.listed(F.col("base")), 256).alias("base_sha256"), pii.listed(F.col("spans")).alias("spans"))


def op10_nbsvm_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    learn = fold("doc_id", 3) != 1
    model = quality.fit(docs.filter(learn), labels.filter(learn).select("doc_id", F.col("quality").alias("label")))
    scored = quality.score(docs.select("doc_id", "text"), model)
    score = F.col("quality_score")
    return scored.select("doc_id", (fold("doc_id", 3) == 1).alias("held_out"), score.alias("score"), (score >= 0.5).cast("int").alias("predicted"))


def op3_token_orc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_path(spark, "tokens.orc")
    token_orc.write_token_files(table(spark, sf_dir, "documents"), path)
    return token_orc.digests(spark, path)


def op5_pivot_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pivot_search.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


def op6_bm25_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    leaks = decontam.find_leaks(docs, table(spark, sf_dir, "benchmark"))
    return leaks.select("doc_id", F.explode("leaks").alias("x")).select("doc_id", "x.*")


def op7_bbit_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"), percent=85)


def op11_merkle_veb(spark: SparkSession, sf_dir: str) -> DataFrame:
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    return merkle.proofs(table(spark, sf_dir, "documents"), tampered)


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.repaired_damage(table(spark, sf_dir, "conversations"))


def op13_simhash_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


TOP_K_SQL = """
WITH v AS (SELECT vec_id, row_number() OVER () AS row, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, q.row AS query_row, c.vec_id AS vec_id, list_sum(list_transform(range(1, len(q.e) + 1), lambda i: q.e[i] * c.e[i])) AS score
      FROM v q JOIN v c ON q.row <> c.row AND len(q.e) = len(c.e) WHERE q.vec_id % 50 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_row ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, rank::INTEGER AS rank, vec_id, score::BIGINT AS score FROM r WHERE rank <= 5
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_multi_length_packing, op2_nnpu_toxicity, op3_token_orc, op4_ftrl_langid, op5_pivot_distance, op6_bm25_decontamination, op7_bbit_minhash, op8_license_dice, op9_information_pii, op10_nbsvm_quality, op11_merkle_veb, op12_conversation_repair, op13_simhash_trie)}


def oracle_sql() -> dict[str, str]:
    return {"op5_pivot_distance": TOP_K_SQL, "op8_license_dice": license_scan.scan_sql(), "op11_merkle_veb": merkle.proofs_sql(), "op12_conversation_repair": repair.repaired_damage_sql()}
