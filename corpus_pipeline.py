"""A training-data pipeline over the documents table.

``STAGES`` in order: language identification (documents whose predicted language has a margin near zero go),
toxicity (documents predicted toxic go), n-gram Jaccard join (one document of each group of
near-duplicates stays), mixing sources to target weights (documents repeat or go by their
source's rate), byte-level BPE (every text encoded and decoded again).

Every stage reads the whole table its predecessor left, as Parquet below the session's shared
checkpoint folder; all but the last return the columns of documents. Null, empty and
letterless texts leave in the first stage; an empty table gives empty results throughout.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from strata.llm import byte_bpe, language, mixing, ngram_join, toxicity
from strata.llm.common import stored, table

#: Words of a shingle and least likeness of near-duplicates; op5 has a contract of its own (4 words, 85 %).
WIDTH, PERCENT = 5, 80


def keep_known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language.keep_identified(docs)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.keep_clean(docs, table(spark, sf_dir, "labels"))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.keep_one_of_each(docs, width=WIDTH, percent=PERCENT)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return byte_bpe.encode_decode(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [
    ("language_id", keep_known_language),
    ("toxicity", drop_toxic),
    ("ngram_jaccard", one_of_each_group),
    ("mix", mix),
    ("byte_bpe", encode),
]

#: No SQL expresses the learned stages; tests compare each stage with its operator or brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are written and read again."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stored(docs, f"pipeline-{name}")
    return docs


__all__ = ["ORACLE_SQL", "STAGES", "run"]
