"""The corpus pipeline: raw documents to token ids, in five stages.

Each stage takes all documents that the one before kept, is written as Parquet in the
shared folder and read again. A lost executor costs the tasks of its stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wagerlens.llm import decontaminate, lang_id, merge_replay, near_dup, suffix_dedup
from wagerlens.llm._io import stage, table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: How far a credible language's pooled probability stands above an even split, of the way to one.
CREDIBLE = 0.05


def least_language(labels: int) -> float:
    """Pooled probability below which no language is credible, whatever the number of languages."""
    return 1 / labels + CREDIBLE * (1 - 1 / labels)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter (also null and empty texts), or of no credible language, go.

    Rows are judged one by one, so repeated ones and null ids fare alike; an empty table stays empty.
    """
    learn_rows = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) != 2, F.lit(False))
    net = lang_id.learn(docs, learn_rows)
    if net is None:  # nothing to learn from: nothing can be rejected but texts without letters
        return docs.filter(F.col("text").rlike(r"\p{L}")).select(*COLUMNS)
    found = lang_id.identify(docs.select(*COLUMNS), net)
    return found.filter((F.col("lang_pred") != "und") & (F.col("score") >= least_language(len(net.labels)))).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (five-word shingles, similarity 0.8) the least id stays.

    Texts that share an id are told apart; of rows equal in id and text one stays. Rows with
    a null id or text, and texts without words, are like nothing and stay; an empty table stays empty.
    """
    removed = near_dup.near_duplicates(docs, size=5, hash_col="__hash").filter(~F.col("kept")).select("doc_id", "__hash").distinct()
    node = ["doc_id", "__hash"]
    marked = docs.select(*COLUMNS).withColumn("__hash", near_dup.text_hash("text"))
    left = marked.join(stage(removed, "removed"), node, "left_anti")
    repeats = stage(marked.filter("doc_id is not null").groupBy(*node).count().filter("count > 1").select(*node), "repeats")
    if repeats.isEmpty():
        return left.select(*COLUMNS)
    once = left.join(repeats, node, "left_semi").groupBy("doc_id", "text").agg(F.min(F.struct(*COLUMNS[2:])).alias("row")).select("doc_id", "text", "row.*")
    return left.join(repeats, node, "left_anti").select(*COLUMNS).unionByName(once)


def suffix_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Strings of 100 bytes that stand earlier already are cut out of the texts.

    A character goes only if all its bytes do; a text may become empty, its row stays. A null
    text becomes an empty one; null ids come first; an empty table stays empty.
    """
    cut = suffix_dedup.remove_repeats(docs, length=100, outputs=("kept_text",), keep_columns=("lang", "source"))
    return cut.select("doc_id", F.col("kept_text").alias("text"), "lang", "source", F.length("kept_text").cast("long").alias("n_chars"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of a benchmark item go.

    Rows are told apart by id and text: a clean row that shares its id, or has none, stays,
    as do null and empty texts; without items, or documents, nothing changes.
    """
    return decontaminate.clean(docs.select(*COLUMNS), table(spark, sf_dir, "benchmark"), short=True)


def byte_level_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with digests of the ids and of the decoded text.

    A null or empty text has no ids; null ids and repeated rows pass through row by row.
    """
    import public_tokenizers

    return merge_replay.encode_documents(
        docs,
        path=public_tokenizers.path("byte_bpe_50k.tiktoken"),
        pattern=public_tokenizers.PATTERN,
        outputs=("n_tokens", "ids", "ids_sha256", "decoded_sha256"),
    )


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("suffix_dedup", suffix_dedup_stage),
    ("decontamination", decontamination),
    ("byte_level_bpe", byte_level_bpe),
]

#: No SQL: the first stage is a trained network. Tested against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
