"""A training corpus from raw documents: identify languages, drop copies, mix sources, tokenize.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which ``run``
writes as Parquet and reads again as the next stage's ``docs``. All stages but
the last return the columns of ``docs``, extra ones too.

Texts that are null, empty or without letters go in the first stage, as do those
whose language is not clear; all others are handled whole. Stages that drop
copies do so by id: rows without one stay, and never win over one with an id;
rows that repeat an id share its fate, and if it is kept all stay. Null sources
form a source. Empty tables give empty tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioforge.llm import bpe, exact_dedup, langid, mixing, near_dedup
from folioforge.llm.common import materialize
from folioforge.llm.queries import vocabulary


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known with a probability of one half or more."""
    return langid.keep_identified(docs)


def _without(docs: DataFrame, dropped: DataFrame) -> DataFrame:
    """``docs`` without the ids that were dropped; a null id drops nothing."""
    ids = dropped.select(F.col("doc_id").alias("dropped_id"))
    return docs.join(ids, docs["doc_id"] == ids["dropped_id"], "left_anti")


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest id stays."""
    return _without(docs, exact_dedup.exact_dedup(docs).where("NOT kept"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts that links of 0.8 or more over five-word shingles connect, the document with the smallest id stays."""
    return _without(docs, near_dedup.near_dedup(docs).where("NOT kept"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources weighed by the square root of their size; a document comes out as often as its Poisson count says."""
    return mixing.replicate(docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, their number, and SHA-256 of the text that the ids decode to."""
    coded = bpe.encode(docs.select("doc_id", "lang", "source", "text"), vocabulary(), decoded_col="decoded")
    return coded.select("doc_id", "lang", "source", "token_ids", F.size("token_ids").cast("long").alias("n_tokens"), F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("language_id", identify_language),
    ("exact_dedup", drop_exact_copies),
    ("near_dedup", drop_near_copies),
    ("mixing", mix),
    ("bpe", tokenize),
]

#: The first stage is a trained model, which SQL can't express; the tests hold the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
