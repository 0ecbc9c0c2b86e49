"""The training-data pipeline: documents in, token files out.

``STAGES`` lists ``(name, function)``; a function takes ``(spark, docs, sf_dir)`` and returns a DataFrame. Every stage
but the last returns the columns of ``documents``; each result is written as Parquet and read again by the next.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from shelfwise.llm import decontamination, mixing, near_dup, quality, token_store
from shelfwise.llm.common import is_in_fold, table
from shelfwise.sources.checkpoints import stored


def reject_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, learnt from the labels outside the held-out fold, scores 0.3 or more."""
    model = quality.train(docs, table(spark, sf_dir, "labels"), ~is_in_fold("doc_id", 5, 0))
    return quality.keep_good(docs, model, threshold=0.3)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that shares 80% of its shingles of five words."""
    return near_dup.keep_one(docs, words=5, percent=80)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that cover less than half of every benchmark item."""
    return decontamination.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources mixed to weights 3, 1, 2, repeating, up to two epochs each."""
    return mixing.mix(docs)


def write_token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files in the shared folder, and per document where its ids stand, read back from them."""
    return token_store.store_tokens(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality classifier", reject_low_quality),
    ("near duplicates", drop_near_duplicates),
    ("benchmark decontamination", drop_leaks),
    ("mixing to target weights", mix_sources),
    ("token files", write_token_files),
]

# Several stages (a fitted model, tilings, a tokenizer) are beyond SQL; tests compare them with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, applied to ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)


QUERIES = {"pipeline": run}
ORACLE = {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
