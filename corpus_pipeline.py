"""A corpus pipeline: from raw documents to the tokens of a deduplicated, mixed training set.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet in the
shared folder and read again as the next stage's documents.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crosslane.llm import bpe, exact_dedup, jaccard_join, mixing, toxicity
from crosslane.llm.work import ship, written

#: Near duplicates: words of a shingle, and the least similarity as a fraction.
SHINGLE, SIMILAR, OF = 5, 80, 100


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score under 0.5; the classifier learns from the labels that aren't held out."""
    ship(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    model = toxicity.train(docs.select("doc_id", "text"), labels)
    name = f"_score_{uuid.uuid4().hex[:8]}"  # no column of the documents has this name
    return toxicity.score(docs, model, score_col=name).where(F.col(name) < 0.5).drop(name)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal texts the one with the smallest id."""
    ship(spark)
    index = exact_dedup.new_index_name()
    kept = exact_dedup.kept_rows(docs, index)
    exact_dedup.drop_index(spark, index)
    return kept


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest id."""
    ship(spark)
    return jaccard_join.representatives(docs, SHINGLE, SIMILAR, OF)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    ship(spark)
    return mixing.mixed_rows(docs)


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document."""
    ship(spark)
    encoded = bpe.encode(docs.select("doc_id", "lang", "source", "text"), bpe.rank_file())
    return encoded.select("doc_id", "lang", "source", F.size("token_ids").cast("long").alias("n_tokens"), "token_ids")


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("jaccard_join", drop_near_copies),
    ("mix_sources", mix_sources),
    ("bpe_tokens", tokenise),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


#: The classifier, the order by hash and the tokens have no SQL form; the stages are tested one by one.
ORACLE_SQL = None
