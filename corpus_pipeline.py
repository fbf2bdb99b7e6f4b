"""A training corpus from ``documents``: language identification, near-duplicate removal, pseudonyms, packing.

Each stage takes (spark, docs, sf_dir), works on all rows that its predecessor kept, and returns a DataFrame that is
written as Parquet and read again for the next one.  All but the last return the columns of ``documents``.
Null, empty and repeated rows: see the operators; rows without a letter go in the first stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from levain.llm import op1_lsh_forest, op2_language, op6_packing, op10_pseudonyms
from levain.llm.common import table, written
from levain.llm.queries import pii_key


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is sure; those that are rejected (no letter, or a narrow margin) go."""
    known = op2_language.learn(docs.filter(~op2_language.held_out()))
    return op2_language.keep_accepted(docs, known)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies: the one with the smallest id."""
    return op1_lsh_forest.keep_one(docs)


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data under pseudonyms; ``n_chars`` is that of the new text."""
    return op10_pseudonyms.pseudonymise(docs, pii_key(spark))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with token counts, length buckets and batches."""
    return op6_packing.packed(docs)


STAGES = [("language_id", language_id), ("near_duplicates", near_duplicates), ("pii", pii), ("packing", packing)]

#: Compression, Feistel rounds over SHA-256 and tokenizer counts are beyond SQL; tests hold each stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
