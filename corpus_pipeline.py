"""Training-data pipeline over the documents table.

Four stages, each one call of an operator of ``eddyline.llm``: rejected toxic
documents go, one document of each near-duplicate group stays, sources are mixed
to target weights, and the mixture is encoded.  Every stage reads what its
predecessor wrote; all but the last return the columns of documents.

Nulls, empty texts, ties, repeated rows, empty tables and extra columns have the
results that the operators define.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eddyline.llm.bpe import decode_documents, encode_documents
from eddyline.llm.common import checkpoint_root, read
from eddyline.llm.mixing import poisson_mix
from eddyline.llm.queries import tokenizer_path
from eddyline.llm.simhash import keep_one
from eddyline.llm.toxicity import drop_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_toxic(docs, read(spark, sf_dir, "labels").select("doc_id", "toxic"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return poisson_mix(docs, copy_col=None, key_col=None)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The packed ids of every document of the mixture and the digest of the
    text they decode to."""
    coded = decode_documents(encode_documents(docs, tokenizer_path()), tokenizer_path())
    return coded.select("doc_id", "lang", "source", "n_tokens", "token_ids",
                        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


STAGES = [
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("mix_sources", mix_sources),
    ("encode", encode),
]

# SQL cannot express the fitted model, the groups or the merges; the tests hold
# the stages against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is written as Parquet to the shared
    folder and read again by the next."""
    base = f"{checkpoint_root(spark)}/corpus-{uuid.uuid4().hex}"
    docs = read(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{base}/{i}-{name}")
        docs = spark.read.parquet(f"{base}/{i}-{name}")
    return docs
