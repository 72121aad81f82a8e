"""The operators of this subpackage as queries over the given tables, with their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from boxoffice.llm.common import pick, table
from boxoffice.llm.divergence import AUDIT_SQL
from boxoffice.llm.lexical_search import SEARCH_SQL
from boxoffice.llm.line_dedup import DEDUP_SQL
from boxoffice.llm.voronoi_topk import TOPK_SQL


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from boxoffice.llm.mixing import mixture

    mixed = mixture(pick(table(spark, sf_dir, "documents"), "doc_id", "text", "source"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "source")


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from boxoffice.llm.suffix_dedup import dedup_report

    return dedup_report(pick(table(spark, sf_dir, "documents"), "doc_id", "text"))


def op3_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    from boxoffice.llm.neighbours import EVERY, nearest

    vectors = pick(table(spark, sf_dir, "embeddings"), "vec_id", "embedding").withColumnRenamed("embedding", "vector")
    return nearest(vectors, vectors.filter(F.col("vec_id") % EVERY == 0))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from boxoffice.llm.token_counts import count_tokens

    return count_tokens(pick(table(spark, sf_dir, "documents"), "doc_id", "text"))


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from boxoffice.llm.bpe import encode_documents, encoding_report

    return encoding_report(encode_documents(pick(table(spark, sf_dir, "documents"), "doc_id", "text")))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from boxoffice.llm.simhash import near_duplicates

    return near_duplicates(pick(table(spark, sf_dir, "documents"), "doc_id", "text"))


def op7_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from boxoffice.llm.line_quality import quality

    return quality(pick(table(spark, sf_dir, "documents"), "doc_id", "text"),
                   pick(table(spark, sf_dir, "labels"), "doc_id", "quality"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from boxoffice.llm.line_dedup import dedup_report

    return dedup_report(pick(table(spark, sf_dir, "documents"), "doc_id", "text"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from boxoffice.llm.toxicity import toxicity

    return toxicity(pick(table(spark, sf_dir, "documents"), "doc_id", "text"),
                    pick(table(spark, sf_dir, "labels"), "doc_id", "toxic"))


def op10_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    from boxoffice.llm.secret_scan import secret_report

    return secret_report(pick(table(spark, sf_dir, "documents"), "doc_id", "text"))


def op11_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    from boxoffice.llm.voronoi_topk import EVERY, top_products

    vectors = pick(table(spark, sf_dir, "embeddings"), "vec_id", "embedding").withColumnRenamed("embedding", "vector")
    return top_products(vectors, vectors.filter(F.col("vec_id") % EVERY == 0))


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    from boxoffice.llm.lexical_search import search

    return search(pick(table(spark, sf_dir, "documents"), "doc_id", "text"),
                  pick(table(spark, sf_dir, "benchmark"), "item_id", "text"))


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    from boxoffice.llm.divergence import audit

    return audit(pick(table(spark, sf_dir, "documents"), "text", "lang", "source"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_mixing": op1_mixing,
    "op2_suffix_dedup": op2_suffix_dedup,
    "op3_neighbours": op3_neighbours,
    "op4_token_counts": op4_token_counts,
    "op5_byte_bpe": op5_byte_bpe,
    "op6_simhash": op6_simhash,
    "op7_line_quality": op7_line_quality,
    "op8_line_dedup": op8_line_dedup,
    "op9_toxicity": op9_toxicity,
    "op10_secret_scans": op10_secret_scans,
    "op11_topk_search": op11_topk_search,
    "op12_lexical_search": op12_lexical_search,
    "op13_source_divergence": op13_source_divergence,
}

ORACLE_SQL: dict[str, str] = {
    "op8_line_dedup": DEDUP_SQL,
    "op11_topk_search": TOPK_SQL,
    "op12_lexical_search": SEARCH_SQL,
    "op13_source_divergence": AUDIT_SQL,
}
