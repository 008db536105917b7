"""A training-data pipeline over the documents table, counted as part of the llm subpackage.

Each stage takes (spark, docs, sf_dir) and works on all that the one before kept; its result is written as Parquet and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillstone.llm import apportion, jaccard, pieces, secrets, weak_quality
from quillstone.llm.common import remove, stored, table
from quillstone.llm.queries import tokenizer_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weak-label classifier rejects go."""
    return weak_quality.kept(spark, docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that the n-gram Jaccard join links stays."""
    return jaccard.deduplicated(spark, docs)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are taken out of the texts; n_chars follows."""
    return secrets.redacted(docs, secrets.model(spark, docs)).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return apportion.mixed(spark, docs)


def piece_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of the whole texts, with digests of the ids and of the text decoded from them."""
    return pieces.encoded(spark, docs, tokenizer_path("piece_bpe_32k.model"), (*pieces.DIGESTS, "ids"))


STAGES = [("quality classifier", quality), ("n-gram Jaccard join", near_duplicates), ("secret scans", secret_scan), ("mixing sources", source_mix), ("SentencePiece encoding", piece_ids)]

#: SQL expresses neither the classifier nor the encoder; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES[:-1]):
        was, docs = docs, stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        if k:
            remove(spark, was)
    return STAGES[-1][1](spark, docs, sf_dir)
