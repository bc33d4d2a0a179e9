"""Corpus pipeline: raw documents to packed token sequences.

Each stage takes all rows that the one before kept, and its decisions take effect:

1. ``quality``: documents that the quality classifier rejects go.
2. ``near_dedup``: of each group of near-duplicate documents (``NEAR_PERCENT`` % of their shingles shared) one stays.
3. ``secrets``: secrets in the texts are masked; all documents stay.
4. ``mixture``: documents are taken as often as the mixture of their sources asks for.
5. ``packing``: the mixture's documents are packed into sequences of tokens; one row for each piece.

The first four return the columns of ``documents``. Empty tables give empty tables; nulls, repeated
rows and very long texts are handled as each operator's docstring says.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from kandela.llm import minhash, mixing, packing, quality, secrets
from kandela.llm.common import bounded_batches, stage, table

#: Documents are near duplicates from this share of common shingles on; half keys find a pair of it with 0.99993.
NEAR_PERCENT = 80


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    return minhash.one_of_each(docs, NEAR_PERCENT)


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    return secrets.mask_secrets(docs)


def mixture_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    return mixing.mix(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    return packing.pack_documents(docs)


STAGES = [
    ("quality", quality_stage),
    ("near_dedup", near_dedup_stage),
    ("secrets", secrets_stage),
    ("mixture", mixture_stage),
    ("packing", packing_stage),
]

#: A trained classifier, hashes and token ids are not for SQL; the stages are tested one by one.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows for ``documents``; between the stages the rows lie in the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for name, apply in STAGES[:-1]:
        docs = stage(apply(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
