"""Thin queries: each applies one operator to its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wagerlens.llm import decontaminate, lang_id, merge_replay, near_dup, quality_pu, shard_partition, suffix_dedup, token_count, token_shards, vp_search
from wagerlens.llm._io import table


def _remainder(n: int):
    """crc32 of the id as text, modulo ``n``."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(n))


def op1_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = _remainder(4) == 2
    net = lang_id.learn(docs, ~held_out)
    return lang_id.identify(docs.select("doc_id", "text"), net).select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "lang_pred", "score")


def op2_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_shards.token_shards(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=1)


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"), length=100, outputs=("n_bytes", "n_removed", "n_spans", "kept_sha256"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = _remainder(5) == 0
    net = quality_pu.learn(docs, table(spark, sf_dir, "labels"), ~held_out)
    return quality_pu.score(docs.select("doc_id", "text"), net).select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "score", "predicted")


def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(table(spark, sf_dir, "documents"), size=4)


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.pairs(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), short=True)


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_partition.shard_documents(table(spark, sf_dir, "documents"), n_shards=16)


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_count.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), limit=1024)


def op9_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return vp_search.nearest(vectors, vectors.filter("vec_id % 50 = 0"), k=5, factor=1.0)


def op10_merge_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return merge_replay.encode_documents(
        table(spark, sf_dir, "documents"),
        path=public_tokenizers.path("byte_bpe_50k.tiktoken"),
        pattern=public_tokenizers.PATTERN,
        outputs=("n_tokens", "ids_sha256", "decoded_sha256"),
    )


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_language": op1_language,
        "op2_token_shards": op2_token_shards,
        "op3_suffix_dedup": op3_suffix_dedup,
        "op4_quality": op4_quality,
        "op5_near_duplicates": op5_near_duplicates,
        "op6_decontamination": op6_decontamination,
        "op7_sharding": op7_sharding,
        "op8_token_counts": op8_token_counts,
        "op9_neighbours": op9_neighbours,
        "op10_merge_replay": op10_merge_replay,
    }


def oracle_sql() -> dict[str, str]:
    usable = "embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, x -> x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, x -> x <> 0)) > 0 AND vec_id IS NOT NULL"
    return {
        "op9_neighbours": f"""
            WITH v AS (SELECT DISTINCT vec_id, embedding::DOUBLE[] AS e FROM embeddings WHERE {usable}),
            pairs AS (
                SELECT q.vec_id AS query_id, c.vec_id AS vec_id, list_dot_product(q.e, c.e) / (sqrt(list_dot_product(q.e, q.e)) * sqrt(list_dot_product(c.e, c.e))) AS score
                FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e)
                WHERE q.vec_id % 50 = 0
            ),
            ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM pairs)
            SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 5
        """,
    }
