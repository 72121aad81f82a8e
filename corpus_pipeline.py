"""Documents to training sequences, in five stages.

Each stage calls one operator of ``boxoffice.llm`` on all that the stage before
kept. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from boxoffice.llm import bpe, mixing, secret_scan, simhash, toxicity as toxic
from boxoffice.llm.common import cut, pick, prepare, table


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not predicted to be toxic."""
    return toxic.reject_toxic(docs, pick(table(spark, sf_dir, "labels"), "doc_id", "toxic"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: that with the smallest doc_id."""
    prepare(spark)
    return simhash.keep_one(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with a mark in place of each secret."""
    prepare(spark)
    return secret_scan.redact_secrets(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the sources' targets take them."""
    prepare(spark)
    return mixing.mixed_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, ids, their number, and digests of the ids and of the text decoded from them."""
    prepare(spark)
    encoded = bpe.encode_documents(pick(docs, "doc_id", "source", "text"))
    return bpe.encoding_report(encoded, "source", "ids")


STAGES = [
    ("toxicity", toxicity),
    ("simhash_near_dedup", near_duplicates),
    ("secret_scans", secrets),
    ("mixing", mix),
    ("byte_bpe", encode),
]

# Fingerprints, Viterbi decoding and BPE have no SQL; tests hold the rows
# against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the table documents, each one's rows written before the next begins."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = cut(docs)
    return docs
