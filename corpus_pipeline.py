"""The corpus pipeline: stages over ``documents``, each by one operator of ``tickloom.llm``.

A stage takes (spark, docs, sf_dir) and gives a DataFrame, which is written and read again as the next one's
docs. All but the last give the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm import decontaminate, near_dedup, packing, secrets, toxicity
from tickloom.llm.shipping import ship
from tickloom.session import stage

#: Smaller than for single operators: executors and their workers last through all stages.
BATCH_BYTES = 2 << 20


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the class-conditional models reject go."""
    ship(spark, BATCH_BYTES)
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), folds=5, held_out=0, whole=True)
    return toxicity.keep_ordinary(docs, model)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    ship(spark, BATCH_BYTES)
    return near_dedup.keep_one(docs, percent=85)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of the benchmark go."""
    ship(spark, BATCH_BYTES)
    index = decontaminate.build_index(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return decontaminate.keep_clean(docs, index)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark; every document stays, with its length counted again."""
    ship(spark, BATCH_BYTES)
    model = secrets.fit(docs, public_tokenizers.path("piece_bpe_32k.model"), whole=True)
    clean = secrets.redact(docs, model)
    if "n_chars" not in docs.columns:
        return clean
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's tokens get their places in sequences of 4096."""
    ship(spark, BATCH_BYTES)
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), capacity=4096, end_id=1)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("secrets", redact_secrets),
    ("packing", pack),
]
#: Trained models, sketches and token ids cannot be written in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES:
        docs = function(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = stage(docs)
    return docs
