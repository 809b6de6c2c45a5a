"""Registered queries of the operators of this subpackage."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.llm import bpe, column_bwt, hnsw, language, lsh_forest, packing, pii, secrets, spelling, template, toxicity, whitening
from gleaner.llm import order_minhash as omh
from gleaner.llm.common import documents
from gleaner.session import spread

QUERIES = {}
ORACLES: dict[str, str] = {}

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query
def op1_order_minhash(spark: SparkSession, folder: str) -> DataFrame:
    return omh.order_minhash(documents(spark, folder))


@query
def op2_harmonic_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.harmonic_pack(documents(spark, folder), VOCABULARY)


@query
def op3_column_bwt(spark: SparkSession, folder: str) -> DataFrame:
    return column_bwt.remove_repeats(documents(spark, folder), keep_text=False).drop("kept", "rest")


@query
def op4_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.toxicity(documents(spark, folder), _table(spark, folder, "labels"))


@query
def op5_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    return pii.personal_data(documents(spark, folder)).drop("base")


@query
def op6_secret_battery(spark: SparkSession, folder: str) -> DataFrame:
    return secrets.find_secrets(documents(spark, folder)).withColumn("base_sha256", F.sha2("base", 256)).drop("base")


@query
def op7_lsh_forest(spark: SparkSession, folder: str) -> DataFrame:
    return lsh_forest.near_duplicates(documents(spark, folder), words=2)


@query
def op8_template_text(spark: SparkSession, folder: str) -> DataFrame:
    pages = spread(spark.read.parquet(f"{folder}/pages.parquet").select("page_id", "url", "html"))
    return template.main_text(pages).withColumn("n_chars", F.length("text").cast("long"))


@query
def op9_hnsw(spark: SparkSession, folder: str) -> DataFrame:
    return hnsw.similar_vectors(spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", "embedding", "label"))


@query
def op10_bpe_pair_index(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.bpe_digests(documents(spark, folder), VOCABULARY)


@query
def op11_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = spread(spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text", "lang"))
    return language.language(docs).drop("n_words")


@query
def op12_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.whitened(_table(spark, folder, "embeddings"))


@query
def op13_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.spelling_variants(documents(spark, folder))
