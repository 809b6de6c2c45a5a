"""A corpus pipeline: toxic documents go, one document of each group of near duplicates stays, repeated passages go, secrets are
masked, and what is left is packed into token sequences."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.llm import column_bwt, lsh_forest, packing, secrets, toxicity
from gleaner.session import scratch_folder

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _with_text(rows: DataFrame) -> DataFrame:
    """The columns of documents, the length that of the text."""
    return rows.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model scores below 0.5."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.without_toxic(docs.select(*COLUMNS), labels)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one with the least id, of each group linked by 80 % of its five-word shingles."""
    found = lsh_forest.near_duplicates(docs.select("doc_id", "text"), words=5)
    return docs.select(*COLUMNS).join(found.filter("not kept").select("doc_id").distinct(), "doc_id", "left_anti").select(*COLUMNS)


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the 50-byte passages that an earlier document holds; a letter cut in two goes with its passage."""
    found = column_bwt.remove_repeats(docs, carry=("lang", "source"))
    rest = F.from_json("rest", "lang string, source string")
    return _with_text(found.select("doc_id", F.col("kept").alias("text"), rest.alias("rest")).select("doc_id", "text", "rest.*"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with a mark in place of each secret."""
    return _with_text(secrets.redacted(docs.select(*COLUMNS)))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of 2048 tokens."""
    return packing.harmonic_pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("repeated_passages", drop_repeated_passages),
    ("secrets", mask_secrets),
    ("packing", pack),
]

#: SQL cannot express the stages; they are tested one by one against direct computations.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written to the shared folder and read again by the next."""
    folder = f"{scratch_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
