"""From raw documents to packed training sequences: five stages, each one operator.

Each stage reads the stored table of the one before, and its decisions take effect there. All but the last return the columns of
documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from pressroom.llm import exact_dedup, minhash, mixing, packing, quality
from pressroom.session import materialize


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the risk-controlled cutoffs of their language."""
    return quality.drop_bad(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup.drop_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similar texts."""
    return minhash.drop_near(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.mixed_documents(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of at most 1024 tokens."""
    import public_tokenizers

    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json")).select(
        F.col("_id").alias("doc_id"), F.col("_row").alias("doc_row"), "start", "length", F.crc32("ids").alias("ids_crc32"),
        F.col("tokens").alias("doc_tokens"), "sequence_id", "offset",
    )


STAGES = [
    ("quality_rules", quality_rules), ("exact_copies", exact_copies), ("near_copies", near_copies), ("source_mix", source_mix),
    ("packed", packed),
]

#: Cutoffs, draws and packing are not expressible in SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = materialize(docs, name)
    return docs
