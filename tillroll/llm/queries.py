"""The operators as named queries over a folder of Parquet tables."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm import oracles
from tillroll.llm.bpe import bpe_round_trip
from tillroll.llm.embeddings import embedding_near_duplicates
from tillroll.llm.fingerprints import edited_fingerprints
from tillroll.llm.html_text import extract_text
from tillroll.llm.line_dedup import line_dedup
from tillroll.llm.mixing import mix_sources
from tillroll.llm.ngram_join import ngram_jaccard_join
from tillroll.llm.prefix_trie import prefix_trie
from tillroll.llm.quality import quality_scores
from tillroll.llm.sharding import shard_groups
from tillroll.llm.spelling import spelling_variants
from tillroll.llm.token_counts import token_counts
from tillroll.llm.toxicity import toxicity_scores
from tillroll.llm.workspace import table

Query = Callable[[SparkSession, str], DataFrame]


def vocabulary(name: str) -> str:
    """Place of a public tokenizer file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_ngram_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_jaccard_join(table(spark, folder, "documents"), k=4, num=85, den=100)


def op2_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts(table(spark, folder, "documents"), vocabulary("piece_bpe_32k.model"))


def op3_embedding_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return embedding_near_duplicates(table(spark, folder, "embeddings"), cosine=0.98)


def held_out(modulus: int, remainder: int):
    """Rows that are never learned from, told by a checksum of the id as text."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % modulus == remainder


def op4_quality_ranking(spark: SparkSession, folder: str) -> DataFrame:
    aside = held_out(4, 2)
    labels = table(spark, folder, "labels").filter(~aside)
    scored = quality_scores(table(spark, folder, "documents"), labels, threshold=0.7)
    return scored.select("doc_id", aside.alias("held_out"), "score", "predicted")


def op5_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    return mix_sources(table(spark, folder, "documents"), weights=(5, 2, 1), share=1.5, repeats=2)


def op6_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    aside = held_out(5, 0)
    labels = table(spark, folder, "labels").filter(~aside)
    scored = toxicity_scores(table(spark, folder, "documents"), labels, threshold=0.5)
    return scored.select("doc_id", aside.alias("held_out"), "score", "predicted")


def op7_shard_groups(spark: SparkSession, folder: str) -> DataFrame:
    return shard_groups(table(spark, folder, "documents"), 24)


def op8_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    kept = line_dedup(table(spark, folder, "documents"), edits=2, every=25, min_chars=20, min_equal=1)
    return kept.select(
        "doc_id", F.col("n_lines").cast("long").alias("n_lines"), "removed_lines",
        F.length("text").cast("long").alias("kept_chars"), F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"),
    )


def op9_edited_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return edited_fingerprints(table(spark, folder, "documents"), share=4)


def op10_bpe_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    coded = bpe_round_trip(table(spark, folder, "documents"), vocabulary("byte_bpe_50k.json"))
    return coded.select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"),
    )


def op11_html_text(spark: SparkSession, folder: str) -> DataFrame:
    return extract_text(table(spark, folder, "pages"))


def op12_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return spelling_variants(table(spark, folder, "documents"), modulus=97, least_chars=5, least_count=3, times=2)


def op13_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return prefix_trie(table(spark, folder, "conversations"), span=5, heads=9)


def queries() -> dict[str, Query]:
    return {name: query for name, query in globals().items() if name.startswith("op")}


def oracle_sql() -> dict[str, str]:
    return dict(oracles.SQL)
