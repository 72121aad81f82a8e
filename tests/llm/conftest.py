"""Fixtures of the corpus tests: one local session, small tables with every odd case."""

import pytest


ODD_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def make(spark):
    """Rows of (doc_id, text, lang, source) -> a table with the columns of documents."""
    def build(rows):
        return spark.createDataFrame(
            [(r[0], r[1], r[2] if len(r) > 2 else None, r[3] if len(r) > 3 else None,
              None if r[1] is None else len(r[1])) for r in rows], ODD_SCHEMA)
    return build


@pytest.fixture(scope="session")
def clash():
    """A table with two extra columns whose names clash with the ones in use."""
    from pyspark.sql import functions as F

    def add(df):
        return df.withColumns({"size": F.lit(7), "fingerprint": F.lit("x"), "_x": F.lit(1)}).toDF(
            *df.columns, "TEXT", "Doc_ID", "_x")
    return add
