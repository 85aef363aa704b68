"""Registered queries of this subpackage: each applies its operator to the whole of its table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    decontaminate, language, near_dedup, neighbours, packing, personal_data, prefix_trie, secrets, simhash, spelling,
    token_counts, token_files, toxicity,
)
from .shipping import ship


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(documents, _table(spark, sf_dir, "labels"), folds=5, held_out=0)
    scored = toxicity.score(documents, model)
    return scored.select("doc_id", F.coalesce(toxicity.fold("doc_id", 5) == 0, F.lit(False)).alias("held_out"),
                         "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "log_ratio")


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminate(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(
        _table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), limit=512)


def op4_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(_table(spark, sf_dir, "documents"), percent=85)


def op5_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.search(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10)


def op6_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return personal_data.find(documents, personal_data.fit(documents))


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = language.fit(documents, public_tokenizers.path("piece_bpe_32k.model"), folds=3, held_out=1)
    found = language.identify(documents.select("doc_id", "text"), model)
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.round_trip(
        _table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), end_id=0)


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"),
                        capacity=4096, end_id=1)


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents").select("doc_id", "text")
    model = secrets.fit(documents, public_tokenizers.path("piece_bpe_32k.model"))
    return secrets.find(documents, model)


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(_table(spark, sf_dir, "conversations"))


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(_table(spark, sf_dir, "documents"))


def op13_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_toxicity, op2_decontamination, op3_token_counts, op4_near_dedup, op5_neighbours, op6_personal_data, op7_language,
    op8_token_files, op9_packing, op10_secrets, op11_prefix_trie, op12_spelling, op13_simhash,
)}
#: Token ids, trained models and hash placement cannot be written in SQL; tests hold them against brute force.
ORACLE: dict[str, str] = {}
