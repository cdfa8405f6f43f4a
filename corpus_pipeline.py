"""A training corpus from documents: toxic ones go, near copies go, the rest is mixed and packed.

Each stage takes what the stage before it kept, as Parquet. Columns of documents stay as
they are up to the last stage, which returns the packed sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retinue.llm import jaccard, mixing, packing, toxicity
from retinue.llm.common import written

#: A near copy shares at least this percentage of its runs of so many words.
NEAR_WORDS, NEAR_PERCENT = 5, 80


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, learnt from ``labels``, does not reject."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.fit(docs, labels)
    return docs.where(toxicity.score(spark, model, F.col("text")) < 0.5)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that the similarity join links: the one with the least id.

    Documents without words are in no group and stay. Of rows that repeat the least id of
    their group, one stays.
    """
    return jaccard.representatives(docs, words=NEAR_WORDS, percent=NEAR_PERCENT)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.repeated(mixing.mix(docs))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of every document with its place in the training sequences."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_copies", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: The first stage is a trained classifier, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
