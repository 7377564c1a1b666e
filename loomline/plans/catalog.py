"""Queries of the core operators, and SQL where SQL can state them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from loomline.plans import corpus, files, packed, review, verdicts

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {**packed.QUERIES, **corpus.QUERIES, **verdicts.QUERIES, **review.QUERIES, **files.QUERIES}

SQL: dict[str, str] = {**packed.SQL, **corpus.SQL, **verdicts.SQL, **review.SQL, **files.SQL}


def flagship(spark: SparkSession, folder: str) -> DataFrame:
    """The term preservation report."""
    return corpus.x1_x6_term_verdicts(spark, folder)
