"""Queries over fields that pack several values."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from loomline.operators.packed import infer_delimiters, split_packed
from loomline.sources.tables import table

COLUMNS = ["segment_id", "zh-CN", "ko", "source_file"]


def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    """One row per single value of each packed field of segments."""
    values = split_packed(table(spark, folder, "segments", COLUMNS, spread=True), "segment_id", ["zh-CN", "ko"], "source_file")
    return values.select("segment_id", "field", "position")


def p3_values(spark: SparkSession, folder: str) -> DataFrame:
    """The single values themselves."""
    return split_packed(table(spark, folder, "segments", COLUMNS, spread=True), "segment_id", ["zh-CN", "ko"], "source_file")


def p3_delimiters(spark: SparkSession, folder: str) -> DataFrame:
    """The inferred delimiters of each source."""
    return infer_delimiters(table(spark, folder, "segments", COLUMNS, spread=True), ["zh-CN", "ko"], "source_file")


QUERIES = {"p3_found": p3_found, "p3_values": p3_values, "p3_delimiters": p3_delimiters}
SQL: dict[str, str] = {}
