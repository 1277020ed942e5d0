"""Documents to packed training windows: language, near duplicates, mixture, packing.

Each stage takes (spark, docs, sf_dir) and returns a table; run() writes each and hands it, read back, to the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from splatlake.llm import language, mixing, ngram_join, packing
from splatlake.llm.common import durable
from splatlake.llm.queries import vocabulary

SAMPLING_KEEP = 0.9


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language the model knows: `und` (null texts, texts without a letter) go, all others stay."""
    model = language.fit(*language.sample(docs))
    return language.identify(docs, model).filter(F.col("lang_pred") != language.UNKNOWN).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one of the smallest doc_id; of equal rows one.

    Rows that share a doc_id stay or go together; rows without a doc_id stay.
    """
    again = durable(docs.groupBy("doc_id").count().filter("count > 1").select(F.col("doc_id").alias("_again")))
    if not again.isEmpty():  # only rows of repeated ids move
        same = F.col("doc_id").eqNullSafe(F.col("_again"))
        docs = durable(docs.join(again, same, "left_anti").unionByName(docs.join(again, same, "left_semi").dropDuplicates()))
    groups = ngram_join.jaccard_components(docs).filter("doc_id IS NOT NULL")
    gone = groups.groupBy("doc_id").agg(F.max(F.col("component_id") == F.col("doc_id")).alias("first")).filter("NOT first")
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents sampled by raked probabilities."""
    return mixing.mix(docs, keep=SAMPLING_KEEP).filter("sampled").select(*docs.columns)


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every kept document's pieces and their places in windows of 2048 tokens."""
    pieces = packing.tokenise(docs, vocabulary())
    return packing.pack(pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens"))


STAGES = [("language_id", language_id), ("near_duplicates", near_duplicates), ("mix_sources", mix_sources), ("pack_windows", pack_windows)]
ORACLE_SQL = None  # kernels, raking and tokenizers are beyond SQL; tests/llm compares with brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = durable(stage(spark, docs, sf_dir))
    return docs
