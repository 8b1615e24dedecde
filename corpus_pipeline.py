"""From documents to packed training sequences.

Stages, each written as Parquet and read again as the next one's documents:

1. quality        score whole texts, documents scored below 0.7 go
2. exact_copies   of texts equal after lower-casing A-Z one row stays
3. near_copies    of documents linked by a similarity of 0.8 or more on
                  five-word shingles one stays
4. packing        token sequences of 2048, filled in the corpus's own
                  proportions of sources

All but the last return the columns of documents.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tideline.llm.exact_dedup import drop_copies
from tideline.llm.near_dedup import drop_near_copies
from tideline.llm.packing import pack
from tideline.llm.quality import good_documents
from tideline.session import ensure_checkpoint_dir

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return good_documents(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_near_copies(docs, shingle=5, threshold=0.8)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack(docs, TOKENIZER)


STAGES = [
    ("quality", quality),
    ("exact_copies", exact_copies),
    ("near_copies", near_copies),
    ("packing", packing),
]

# Trained scores and token ids are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{ensure_checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
