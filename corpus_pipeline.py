"""The corpus pipeline: five stages over ``documents``, each one an operator of ``tillhouse.llm``.

Every stage takes all that its predecessor kept, extra columns included, and returns the columns of its input; the last
returns token ids. Nulls, empty texts, repeated rows and empty tables are handled as the operators' docstrings say.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tillhouse.llm import bpe, simhash
from tillhouse.llm import exact_dedup as exact
from tillhouse.llm import toxicity as classifier
from tillhouse.llm.decontaminate import drop_contaminated
from tillhouse.llm.frames import documents, stored, table

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score 0.3 or more go."""
    return classifier.drop_toxic(docs, table(spark, sf_dir, "labels"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the row with the largest doc_id stays."""
    return exact.drop_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked fingerprints, the document with the smallest doc_id stays."""
    return simhash.drop_near_copies(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which a benchmark window occurs go."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, with digests of the ids and of the bytes they decode to."""
    return bpe.encoded(docs, RANKS, public_tokenizers.PATTERN, carry=["doc_id"])


STAGES = [
    ("toxicity", toxicity),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("byte_bpe", byte_bpe),
]

#: A trained classifier decides in the first stage; tests compare run() with brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read back, so a lost executor costs one stage."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
