"""A training corpus from raw documents, in five stages.

Each stage reads what its predecessor wrote and returns the columns of
`documents`, but for the last, which returns token ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pointflow.llm import forced_bpe, heavy_dedup, minhash_bayes, sainte_lague, weak_labels
from pointflow.llm.queries import word_bpe_file
from pointflow.llm.tables import Scratch


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    return weak_labels.keep_quality(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of equal texts."""
    return heavy_dedup.exact_dedup(docs)


def minhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near copies: five words, a similarity of 0.8 or more."""
    return minhash_bayes.near_dedup(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in the shares of their sources: left out, cut, whole or twice."""
    return sainte_lague.mix_documents(docs)


def bpe_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token ids of each document, and the digest of the text they decode to."""
    coded = forced_bpe.encode_documents(docs.select("doc_id", "text"), word_bpe_file(), forms=("ids", "decoded"))
    return coded.select(
        "doc_id",
        F.size("bpe.ids").cast("bigint").alias("n_tokens"),
        F.col("bpe.ids").alias("ids"),
        F.sha2(F.col("bpe.decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


STAGES = [
    ("quality_classifier", quality_classifier),
    ("exact_dedup", exact_dedup),
    ("minhash_near_dedup", minhash_near_dedup),
    ("mix_sources", mix_sources),
    ("bpe_tokens", bpe_tokens),
]

# the classifier and MinHash have no SQL form; the tests hold the rows against plain Python
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on `documents`, each written and read again."""
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = scratch.keep(stage(spark, docs, sf_dir), name)
    return docs
