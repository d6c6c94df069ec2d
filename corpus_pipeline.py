"""The corpus pipeline: from raw documents to token ids.

Each stage works on all rows the one before it kept; results are written as Parquet in the shared folder and read again,
so that a lost executor costs a stage's tasks, not the run. All stages but the last return the columns of documents,
whatever they are called. Null texts count as empty; null and repeated ids are documents like others (see the operators);
an empty table gives empty stages.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontaminate, mixing, quality, simhash, tokens
from tidemark.llm.common import read, written
from tidemark.session import new_dir

END_ID = 1


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    model = quality.train(docs, read(spark, sf_dir, "labels"))
    return quality.score(docs, model, docs.columns).where(F.col("score") >= quality.KEEP).select("kept.*")


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of fingerprints linked: shingles of four words, four bits or fewer apart."""
    return simhash.keep_one(docs, words=4, radius=4)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark text."""
    found = decontaminate.find(docs, read(spark, sf_dir, "benchmark"), docs.columns)
    return found.where("n_hit = 0").select("kept.*")


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of their sources takes them."""
    return mixing.repeated(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of a token table, as they are read back from it."""
    path = new_dir(spark, "tokens")
    tokens.write_tokens(docs, path, public_tokenizers.path("word_bpe_49k.json"), END_ID)
    return tokens.documents_of(tokens.read_tokens(spark, path))


STAGES = [
    ("quality classifier", good_quality),
    ("SimHash near-dedup", without_near_duplicates),
    ("benchmark decontamination", without_benchmark),
    ("mixing sources to target weights", mixed),
    ("token-ID / binary output", encoded),
]

#: SQL has no words for a trained model, a fingerprint or a balanced draw; the stages are tested one by one.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES[:-1]):
        docs = written(stage(spark, docs, sf_dir), f"stage-{number}")
    return STAGES[-1][1](spark, docs, sf_dir)
