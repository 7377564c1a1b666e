"""Scans of the corpus tables: stripped columns, empty-row policy, stable order."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomline.functions.text import strip


def require_columns(df: DataFrame, columns: list[str]) -> None:
    """Raises at plan time, without a job, where a column is missing."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")


def scan(df: DataFrame, columns: Mapping[str, str], on_empty: str = "keep") -> DataFrame:
    """The columns under new names, stripped, null as empty text.

    ``on_empty``: "keep" every row, "drop" rows with an empty column, or "fail"
    while the query runs.  Other columns are left out.
    """
    require_columns(df, list(columns.values()))
    if on_empty not in ("keep", "drop", "fail"):
        raise ValueError(f"on_empty: {on_empty}")
    out = df.select(*(strip(F.col(f"`{old}`").cast("string")).alias(new) for new, old in columns.items()))
    if on_empty == "keep":
        return out
    empty = F.lit(False)
    for name in columns:
        empty = empty | (F.col(f"`{name}`") == "")
    if on_empty == "drop":
        return out.where(~empty)
    first = next(iter(columns))
    checked = F.when(empty, F.raise_error(F.concat(F.lit("empty field in row "), F.col(f"`{first}`")))).otherwise(F.col(f"`{first}`"))
    return out.withColumn(first, checked)


SEGMENT = {"segment_id": "segment_id", "src": "zh-CN", "tgt": "ko"}
TERM = {"term_id": "term_id", "term_src": "zh-CN", "term_tgt": "ko"}


def segments(df: DataFrame, on_empty: str = "drop") -> DataFrame:
    """(segment_id, src, tgt) of a segment table."""
    return scan(df, SEGMENT, on_empty)


def terms(df: DataFrame, on_empty: str = "drop") -> DataFrame:
    """(term_id, term_src, term_tgt) of a glossary table."""
    return scan(df, TERM, on_empty)


def distinct_pairs(glossary: DataFrame) -> DataFrame:
    """Distinct (term_src, term_tgt)."""
    return glossary.select("term_src", "term_tgt").distinct()


def translation_rows(df: DataFrame) -> DataFrame:
    """(row_number, segment_id, source, reference, candidate, system); null as empty text, an empty candidate stays."""
    require_columns(df, ["row_number", "segment_id", "source", "references", "candidates"])
    text = {"source": "source", "reference": "references", "candidate": "candidates"}
    return df.select("row_number", "segment_id", *(strip(F.col(f"`{old}`")).alias(new) for new, old in text.items()), "system")


def multilingual_terms(df: DataFrame, languages: list[str], order: str, key: str = "term_id") -> DataFrame:
    """(term_id, languages) of a glossary in several languages.

    A row without an id gets its number in the order of a unique column, from 1;
    a language that the table lacks is empty text.
    """
    from loomline.operators.review import with_ordinal

    require_columns(df, [order])
    rows = with_ordinal(df, order, "__row")
    own = strip(F.col(f"`{key}`").cast("string")) if key in df.columns else F.lit("")
    text = lambda c: strip(F.col(f"`{c}`").cast("string")) if c in df.columns else F.lit("")
    return rows.select(F.when(own == "", (F.col("__row") + 1).cast("string")).otherwise(own).alias("term_id"), *(text(c).alias(c) for c in languages))


def require_rows(df: DataFrame, name: str) -> DataFrame:
    """The table itself; an empty one is an error.  One job that reads a single row."""
    if df.isEmpty():
        raise ValueError(f"{name} has no rows")
    return df


def training_pairs(df: DataFrame, key: str = "segment_id", source: str = "source_text", target: str = "target_text") -> DataFrame:
    """(segment_id, src, tgt) of training examples under any column names; an empty field fails while the query runs."""
    return scan(df, {"segment_id": key, "src": source, "tgt": target}, "fail")


def inference_records(df: DataFrame, key: str = "segment_id", source: str = "zh", reference: str | None = "ko") -> DataFrame:
    """(segment_id, source, references) to translate; without a reference column it is empty.  Ids and sources must be filled."""
    filled_columns = scan(df, {"segment_id": key, "source": source}, "fail") if reference is None else scan(df, {"segment_id": key, "source": source, "references": reference})
    if reference is None:
        return filled_columns.withColumn("references", F.lit(""))
    bad = (F.col("segment_id") == "") | (F.col("source") == "")
    return filled_columns.withColumn("segment_id", F.when(bad, F.raise_error(F.concat(F.lit("empty field in row "), F.col("segment_id")))).otherwise(F.col("segment_id")))


def split_records(df: DataFrame, split: str, column: str = "split", **names: str) -> DataFrame:
    """inference_records of one split; an unknown split has no rows and is an error."""
    require_columns(df, [column])
    return inference_records(require_rows(df.where(F.col(f"`{column}`") == split), f"split {split}"), **names)
