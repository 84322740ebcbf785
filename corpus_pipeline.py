"""Corpus pipeline: language, exact dedup, near dedup, mixing, packing.

Each stage is a function of (spark, docs, sf_dir). `run` writes a stage's result as Parquet in the
shared folder and reads it back for the next one. All stages but the last return the columns of
their input. Every stage takes nulls, empty texts and an empty table as its operator does.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from studyloom.llm.exact_dedup import DigestIndex, keep_distinct
from studyloom.llm.language_id import keep_identified
from studyloom.llm.mixing import mix_whole
from studyloom.llm.near_dedup import keep_one_of_each
from studyloom.llm.packing import pack_texts
from studyloom.llm.queries import vocabulary
from studyloom.session import durable

#: Least score of a document's language.
LEAST_SCORE = 0.5
#: Target weights of the sources in code point order, in turn; share of all words; most repeats.
WEIGHTS, SHARE, MOST = [3, 1, 2], 1.5, 2.0


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with letters whose language is told with some certainty."""
    return keep_identified(docs, vocabulary("piece_bpe_32k.model"), least=LEAST_SCORE)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text (A-Z lower-cased): the one with the largest doc_id."""
    return keep_distinct(docs, DigestIndex(spark))


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near duplicates: the one with the smallest doc_id."""
    return keep_one_of_each(docs, threshold=75)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: whole ones, 0 to 2 times."""
    return mix_whole(docs, WEIGHTS, share=SHARE, most=MOST)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences; a repeated document is packed as often as it is there."""
    return pack_texts(docs, vocabulary("byte_bpe_50k.json"))


STAGES = [
    ("language id", language),
    ("exact dedup", exact),
    ("near dedup", near),
    ("mixing", mixture),
    ("packing", packing),
]

#: Fitted language models, banded signatures and token ids are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of `sf_dir`."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = durable(stage(spark, docs, sf_dir))
    return docs
