"""From raw documents to token ids: five stages, each written as Parquet and read by the next."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.llm import mixing, pieces, pii, simhash, toxicity
from shelfcast.llm.common import stored, table

MODEL = public_tokenizers.path("piece_bpe_32k.model")


def clean_of_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model, learnt from the labels on these documents, does not reject."""
    return toxicity.without_toxic(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def one_of_each_class(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates."""
    return simhash.one_per_class(docs, words=4, max_bits=4)


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with each span of personal data replaced by its kind."""
    return pii.redacted(docs, n_chars="n_chars")


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: whole documents or runs of their words, by shard and in shuffled order, repeats included."""
    mix = mixing.mixture(docs, mixing.by_rank((5.0, 2.0, 1.0)))
    return mixing.drawn(docs, mix, n_chars="n_chars")


def tokenised(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each piece of the mix, and whether they decode to its text."""
    out = pieces.encoded(docs, MODEL)
    return out.select(
        "doc_id", "lang", "source", F.col("pieces.ids").alias("ids"),
        F.size("pieces.ids").cast("long").alias("n_tokens"),
        (F.coalesce("text", F.lit("")) == F.col("pieces.decoded")).alias("round_trip"),
    )


STAGES = [
    ("toxicity", clean_of_toxic),
    ("near duplicates", one_of_each_class),
    ("personal data", without_personal_data),
    ("mix", mixed),
    ("tokens", tokenised),
]

#: No stage but the third could be said in SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
