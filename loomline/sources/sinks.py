"""Sinks: CSV with a fixed header, renumbered corpora, sorted glossaries, JSONL
requests, splits and atomic state files."""

from __future__ import annotations

import json
import os
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_csv(df: DataFrame, path: str, columns: list[str]) -> None:
    """A folder of quoted CSV files with exactly these columns."""
    df.select(*(F.col(f"`{c}`") for c in columns)).write.mode("overwrite").csv(path, header=True, quote='"', escape='"', quoteAll=True)


def export_csv(df: DataFrame, path: str, columns: list[str], order: str) -> int:
    """One CSV file with a byte order mark, ordered, written row by row; the number of rows.

    For hand-over of review lists: the rows stream through the driver and are
    never held there together.
    """
    import csv

    rows = 0
    with open(path, "w", encoding="utf-8-sig", newline="") as file:
        writer = csv.writer(file)
        writer.writerow(columns)
        for row in df.orderBy(order).select(*(F.col(f"`{c}`") for c in columns)).toLocalIterator():
            writer.writerow(["" if v is None else v for v in row])
            rows += 1
    return rows


def renumbered(df: DataFrame, key: str, order: str) -> DataFrame:
    """The table with ``key`` replaced by contiguous numbers from 1, as text."""
    from loomline.operators.review import with_ordinal

    return with_ordinal(df, order, "__ord").withColumn(key, (F.col("__ord") + 1).cast("string")).drop("__ord")


def sorted_glossary(terms: DataFrame, collation: str = "zh") -> DataFrame:
    """Terms in the collation's order with new ids from 1.

    A glossary is small; its numbering runs in one partition.
    """
    from pyspark.sql import Window

    order = Window.orderBy(F.collate("term_src", collation), "term_src", "term_tgt")
    return terms.withColumn("term_id", F.row_number().over(order).cast("string"))


def write_splits(df: DataFrame, path: str) -> None:
    """Parquet, one folder for each value of ``split``."""
    df.write.mode("overwrite").partitionBy("split").parquet(path)


def write_requests(payloads: DataFrame, path: str, batch: str = "batch_no", prefix: str = "seg-batch-") -> None:
    """JSONL of requests with a ``custom_id`` for each batch."""
    name = F.concat(F.lit(prefix), F.lpad(F.col(batch).cast("string"), 4, "0"))
    payloads.select(F.to_json(F.struct(name.alias("custom_id"), F.col("payload").alias("body")))).write.mode("overwrite").text(path)


def write_reviews(folder: str, audit: DataFrame, reviews: dict[str, str]) -> None:
    """``audit`` written once as Parquet; for each name a folder of the audit's rows
    that meet its condition, read back from there so that nothing runs twice."""
    audit.write.mode("overwrite").parquet(f"{folder}/audit")
    written = audit.sparkSession.read.parquet(f"{folder}/audit")
    for name, condition in reviews.items():
        written.where(condition).write.mode("overwrite").parquet(f"{folder}/{name}")


#: Review files of the cleaning stage: name and condition on its audit.
CLEANING_REVIEWS = {
    "removed_markup_only": "action = 'REMOVE_MARKUP_ONLY'", "removed_structured_unparsed": "action = 'REMOVE_STRUCTURED_UNPARSED'", "removed_empty": "action = 'REMOVE_EMPTY'",
    "removed_contaminated": "action = 'REMOVE_TARGET_LANGUAGE_CONTAMINATION'", "removed_fragments": "action = 'REMOVE_NON_SEGMENT_FRAGMENT'", "removed_term_like": "action = 'REMOVE_TERM_LIKE'",
    "removed_exact_pairs": "reason = 'exact_glossary_pair'", "entity_review": "semantic_action = 'REVIEW_SEMANTIC_TERM_ENTITY'", "kept_placeholders": "reason = 'placeholder_kept'",
    "kept_wrappers": "semantic_action = 'SKIP_STRUCTURE_WRAPPER'", "split_rows": "split_index > 0", "kept": "action = 'KEEP'",
}

#: Review files of the glossary stage.
GLOSSARY_REVIEWS = {
    "removed": "final_action = 'AUTO_REMOVE'", "split_compounds": "final_action = 'AUTO_SPLIT_COMPOUND'", "merged": "final_action = 'MERGED_DUPLICATE'", "kept": "final_action in ('AUTO_KEEP', 'KEEP_UNCERTAIN')",
    "uncertain": "final_action = 'KEEP_UNCERTAIN'", "not_in_corpus": "product_score = 0",
}

#: Review files of the cross-check, of its terms and of its rows.
CROSS_TERM_REVIEWS = {
    "strong_terms": "term_action = 'STRONG_GLOSSARY_TERM'", "noise_terms": "term_action = 'AUTO_REMOVE_GLOSSARY_NOISE'", "review_terms": "term_action = 'TERM_NEEDS_REVIEW'",
    "unenforceable_terms": "strict_action = 'AUTO_REMOVE_GLOSSARY_UNENFORCEABLE'",
}
CROSS_ROW_REVIEWS = {
    "conflict_rows": "row_action = 'AUTO_REMOVE_SEGMENT_CONFLICT'", "review_rows": "row_action = 'ROW_NEEDS_REVIEW'", "noise_rows": "row_action = 'KEEP_AFTER_GLOSSARY_NOISE_REMOVAL'",
    "strict_mismatch_rows": "strict_row_action = 'STRICT_REMOVE_SEGMENT_MISMATCH'",
}

#: Review files of the model stage.
MODEL_REVIEWS = {
    "removed": "final_action = 'REMOVE'", "rewritten": "final_action = 'REWRITE'", "rewrite_failed": "validation_status like 'REWRITE_REJECTED%'", "review": "final_action = 'REVIEW'",
    "contaminated": "target_contamination = 'YES'", "structured": "structured_hint = 'YES'", "kept": "final_action = 'KEEP'",
}


def write_evaluation(folder: str, summary: DataFrame, per_row: DataFrame, sample: DataFrame) -> None:
    """The reports of an evaluation: summary, one row for each translation, and the rows to look at first."""
    write_csv(summary, f"{folder}/summary", summary.columns)
    write_csv(per_row, f"{folder}/rows", per_row.columns)
    write_csv(sample, f"{folder}/sample", sample.columns)


#: Columns of a file of translations.
GENERATION = ["segment_id", "source", "references", "candidates"]


def write_generation(df: DataFrame, path: str) -> None:
    """Translations as CSV with the columns of GENERATION."""
    write_csv(df, path, GENERATION)


def append_raw(answers: DataFrame, path: str, run: str, attempt: int) -> None:
    """Adds raw requests and answers of one attempt to a table, with run and attempt, for later inspection.

    Written before anything is parsed; partitioned by run and attempt, so that a repeated attempt replaces its own rows only.
    """
    stamped = answers.withColumns({"run": F.lit(run), "attempt": F.lit(attempt)})
    stamped.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run", "attempt").parquet(path)


def write_manifest(path: str, inputs: dict[str, str], counts: DataFrame, settings: dict) -> dict:
    """A JSON manifest: hashes of the input files, a one-row table of counts, settings and the time."""
    from datetime import datetime, timezone

    from loomline.sources.files import content_hash

    manifest = {
        "inputs": {name: {"path": file, "sha256": content_hash(file)} for name, file in inputs.items()},
        "counts": counts.first().asDict(), "settings": settings, "written_at": datetime.now(timezone.utc).isoformat(),
    }
    save_state(path, manifest)
    return manifest


def save_state(path: str, state: dict) -> None:
    """Writes a JSON state file so that readers see the old one or the new one, whole."""
    target = Path(path)
    part = target.with_suffix(target.suffix + ".tmp")
    part.write_text(json.dumps(state, ensure_ascii=False, indent=2), encoding="utf-8")
    os.replace(part, target)


def load_state(path: str) -> dict | None:
    """The state of a file, or None where there is none."""
    return json.loads(Path(path).read_text(encoding="utf-8")) if Path(path).exists() else None
