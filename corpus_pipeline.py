"""A training corpus in five stages: toxicity, line dedup, near-dedup, mixing, packing.

Each stage is one operator over all that the stage before kept, written as Parquet to the
shared scratch folder and read again, so a lost executor costs a stage's tasks at most.
Toxicity drops the documents it rejects; line dedup takes repeated passages out of texts;
near-dedup keeps one document of each class; mixing repeats and drops documents to reach
the source targets; packing returns the pieces of training sequences.  All but the last
return the columns of documents, ``n_chars`` brought up to date where a text changed.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tickloom.llm import dart_minhash, line_chunks, mixing, packing, toxicity
from tickloom.session import scratch_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_chunks.drop_repeated_passages(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return dart_minhash.drop_near_duplicates(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_sequences(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_repeated_passages),
    ("near-dedup", drop_near_duplicates),
    ("mixing", mix_sources),
    ("packing", pack),
]

#: The first stage votes over fitted neighbours, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"stage-{name.replace(' ', '-')}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
