"""From a table of documents to encoded training text, in stages of which each calls one operator of the library.

Every stage gets all rows that its predecessor kept, as a frame read back from Parquet, and all but the last
return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fathomline.llm import bpe, jaccard, kneser_ney, mixing, pii
from fathomline.session import materialize


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose perplexity under the model of trusted ones among them is within their language's limit."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return kneser_ney.classify(docs, labels).filter("kept").select(*docs.columns)


def different_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class, that of the smallest id."""
    return jaccard.keep_one_of_each(docs)


def masked_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by its kind; the number of characters follows."""
    return pii.mask(docs).withColumn("n_chars", F.coalesce(F.length("text").cast("long"), "n_chars"))


def mixed_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as its source's target asks for."""
    return mixing.mix(docs)


def encoded_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, and the text decoded from them."""
    return bpe.encode(docs, bpe.word_vocabulary())


STAGES = [
    ("quality-classifier", good_documents),
    ("jaccard-join", different_documents),
    ("personal-data", masked_documents),
    ("source-mix", mixed_documents),
    ("bpe", encoded_documents),
]

ORACLE_SQL = None  # the model, the links and the encoding are beyond SQL; tests/llm has a plain version


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what one stage returns is written as Parquet and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
