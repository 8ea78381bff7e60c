"""A training corpus from documents: stages of the operators, each written as Parquet and read again.

1. `toxicity`: subword-bag classifier, learnt from `labels`; documents at or above one half go.
2. `near_duplicates`: five-word shingles, similarity 0.8 or more; of each class the document with the smallest id stays
   (of rows equal in id and shingles one; null ids come last).
3. `pii`: every span is replaced by its kind in brackets, and `n_chars` follows.
4. `mix`: sources to target weights; a document is repeated as often as the mix takes it.
5. `pack`: sequences of at most 1024 token ids; one row a piece, with the ids.

All but the last return the columns that came in. Nulls, empty texts, repeated rows and further columns of any name are
treated as the operators state; an empty table passes through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from obslake.llm import jaccard_join, mixing, packing, pii, toxicity
from obslake.session import scratch_dir


def _aside(docs: DataFrame) -> DataFrame:
    """The id, the text and the whole row, so that no column's name can clash."""
    return docs.select("doc_id", "text", F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.score(_aside(docs), labels).where("predicted = 0").select("row.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard_join.one_of_each(_aside(docs), n=5, percent=80).select("row.*")


def mask_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = pii.find(_aside(docs)).withColumn("clean", pii.redacted("text", "spans"))
    new = {"text": F.col("clean"), "n_chars": F.when(F.size("spans") > 0, F.length("clean").cast("long")).otherwise(F.col("row.n_chars"))}
    return found.select(*[new.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, size=1024)


STAGES = [
    ("toxicity", drop_toxic), ("near_duplicates", drop_near_duplicates), ("pii", mask_pii), ("mix", mix_sources), ("pack", pack_sequences),
]

#: Trained models and tokenizers have no SQL; tests/llm/test_pipeline.py holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_dir(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
