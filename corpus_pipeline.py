"""A training corpus made from documents by five of the operators, one after another."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paylens.llm import bpe, line_join, phrase_index, quality_rules, simhash
from paylens.llm.common import table
from paylens.llm.registry import Query
from paylens.session import written


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality_rules.keep_documents(docs, table(spark, sf_dir, "labels"), certify=quality_rules.joint_cutoffs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document without the lines that match an earlier line; one without lines left has an empty text."""
    out = line_join.deduplicate(docs)
    return out.withColumn("n_chars", F.char_length("text").cast("bigint"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group of near copies."""
    return simhash.keep_one(docs, width=4, distance=4)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no ten consecutive words of a benchmark item occur."""
    return phrase_index.drop_contaminated(docs, table(spark, sf_dir, "benchmark"), size=10)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the ids and of the bytes decoded from them."""
    vocabulary = bpe.Vocabulary.read(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return bpe.round_trip(docs, vocabulary)


STAGES = [
    ("quality rules", quality), ("line dedup", line_dedup), ("simhash near-dedup", near_dedup),
    ("benchmark decontamination", decontaminate), ("byte-level bpe", tokenize),
]

#: Links between fingerprints and certified cutoffs are tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each is written and read again before the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)


def load() -> dict[str, Query]:
    return {"pipeline": Query("pipeline", run, ORACLE_SQL)}
