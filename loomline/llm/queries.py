"""Queries of the training-data operators, and SQL where SQL can state them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomline.llm import bpe, chunking, duplicates, leakage, lookalike, pairs, splits, truncation
from loomline.sources.tables import table


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    """Values that are not in the consistent form."""
    found = None
    for name, key, columns in (("segments", "segment_id", ["zh-CN", "ko"]), ("glossary", "term_id", ["zh-CN"])):
        cases = lookalike.find_inconsistent(table(spark, folder, name, [key, *columns], spread=name == "segments"), key, columns)
        part = cases.select(F.lit(name).alias("table_name"), "record_id", "field")
        found = part if found is None else found.unionAll(part)
    return found


def p1_segments(spark: SparkSession, folder: str) -> DataFrame:
    """All segments with both texts in the consistent form."""
    return lookalike.normalize_columns(table(spark, folder, "segments", ["segment_id", "zh-CN", "ko"], spread=True), ["zh-CN", "ko"])


def _cut_off(spark: SparkSession, folder: str) -> list[tuple[str, str, str, str, DataFrame]]:
    """(table, key, text, source, result of find_cut_off) of both tables."""
    results = table(spark, folder, "evaluation_translation_result", ["row_number", "source", "candidates", "system"])
    decisions = table(spark, folder, "decisions", ["decision_id", "segment_id", "corrected_ko", "model"]).where(F.col("corrected_ko").rlike(r"\S"))
    segments = table(spark, folder, "segments", ["segment_id", "zh-CN"])
    rewritten = decisions.join(segments, "segment_id", "left")
    return [
        ("evaluation_translation_result", "row_number", "candidates", "system", truncation.find_cut_off(results, "candidates", "source", "system")),
        ("decisions", "decision_id", "corrected_ko", "model", truncation.find_cut_off(rewritten, "corrected_ko", "zh-CN", "model")),
    ]


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    """Texts that were cut off."""
    found = None
    for name, key, _, _, result in _cut_off(spark, folder):
        part = result.where("cut_off").select(F.lit(name).alias("table_name"), F.col(key).alias("record_id"))
        found = part if found is None else found.unionAll(part)
    return found


def p2_rates(spark: SparkSession, folder: str) -> DataFrame:
    """Share of cut texts of each system and each model."""
    rates = None
    for name, _, text, source, result in _cut_off(spark, folder):
        part = truncation.cut_off_rates(result, text, source).select(F.lit(name).alias("table_name"), "source", "texts", "cut", "share")
        rates = part if rates is None else rates.unionAll(part)
    return rates


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    """Segments whose answer is unfit for training, with the defect."""
    return pairs.find_defects(table(spark, folder, "segments", ["segment_id", "zh-CN", "ko"], spread=True), "segment_id", "zh-CN", "ko")


def _overlaps(spark: SparkSession, folder: str) -> DataFrame:
    evaluation = table(spark, folder, "segment_rows", ["segment_id", "zh", "ko"])
    training = table(spark, folder, "training_examples", ["segment_id", "source_text", "target_text"])
    return splits.find_overlaps(evaluation, training, "segment_id", "segment_id", ["zh", "ko"], ["source_text", "target_text"])


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    """Evaluation records that come again, the same or nearly so, in training."""
    return _overlaps(spark, folder).select("eval_id", "train_id")


def p5_report(spark: SparkSession, folder: str) -> DataFrame:
    """Numbers of overlapping pairs and records for each split and source."""
    rows = table(spark, folder, "segment_rows", ["segment_id", "split", "source"]).withColumnRenamed("segment_id", "eval_id")
    pairs_of = _overlaps(spark, folder).join(rows, "eval_id")
    return pairs_of.groupBy("split", "source").agg(
        F.count("*").alias("pairs"), F.countDistinct("eval_id").alias("records"), F.sum((F.col("distance") == 0).cast("long")).alias("equal_pairs"), F.avg("coverage").alias("mean_coverage")
    )


def _overlap_classes(spark: SparkSession, folder: str) -> splits.Overlaps:
    evaluation = table(spark, folder, "segment_rows", ["segment_id", "zh", "ko"])
    training = table(spark, folder, "training_examples", ["segment_id", "source_text", "target_text"])
    return splits.class_overlaps(evaluation, training, "segment_id", "segment_id", ["zh", "ko"], ["source_text", "target_text"])


def p5_links(spark: SparkSession, folder: str) -> DataFrame:
    """Links between classes of equal texts of both splits, with their numbers of copies."""
    links = _overlap_classes(spark, folder).links
    return links.select("field", F.hex("eval_cls").alias("eval_class"), F.hex("train_cls").alias("train_class"), "distance", "coverage", "eval_copies", "train_copies")


def p5_members(spark: SparkSession, folder: str) -> DataFrame:
    """Class of every record's texts, of both splits."""
    found = _overlap_classes(spark, folder)
    side = lambda rows, name: rows.select(F.lit(name).alias("side"), "field", F.hex("cls").alias("class"), F.col("id").alias("record_id"))
    return side(found.eval_members, "evaluation").unionAll(side(found.train_members, "training"))


def p6_found(spark: SparkSession, folder: str) -> DataFrame:
    """Segments that are copies of another one but for formatting."""
    return duplicates.list_copies(table(spark, folder, "segments", ["segment_id", "zh-CN", "ko"], spread=True), "segment_id", ["zh-CN", "ko"])


def p6_copies(spark: SparkSession, folder: str) -> DataFrame:
    """Every distinct segment with the number of its copies."""
    return duplicates.count_copies(table(spark, folder, "segments", ["segment_id", "zh-CN", "ko"], spread=True), "segment_id", ["zh-CN", "ko"])


def p7_ids(spark: SparkSession, folder: str) -> DataFrame:
    """Token ids of every document."""
    return bpe.encode_documents(table(spark, folder, "documents", ["doc_id", "text"], spread=True))


def p7_decoded(spark: SparkSession, folder: str) -> DataFrame:
    """Every document encoded and decoded again: its text, the empty one for null."""
    return bpe.decode_documents(p7_ids(spark, folder).select("doc_id", "ids"))


def p8_found(spark: SparkSession, folder: str) -> DataFrame:
    """Documents with the test items that they leak."""
    return leakage.find_leaks(table(spark, folder, "documents", ["doc_id", "text"], spread=True), table(spark, folder, "benchmark"))


def p9_found(spark: SparkSession, folder: str) -> DataFrame:
    """Documents that were cut into pieces."""
    pieces = chunking.split_documents(table(spark, folder, "documents", ["doc_id", "text"], spread=True), with_text=False)
    return pieces.where("piece_no = 1").select("doc_id")


def p9_pieces(spark: SparkSession, folder: str) -> DataFrame:
    """The pieces of every oversized document."""
    return chunking.split_documents(table(spark, folder, "documents", ["doc_id", "text"], spread=True))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "p1_found": p1_found,
    "p1_segments": p1_segments,
    "p2_found": p2_found,
    "p2_rates": p2_rates,
    "p4_found": p4_found,
    "p5_found": p5_found,
    "p5_report": p5_report,
    "p5_links": p5_links,
    "p5_members": p5_members,
    "p6_found": p6_found,
    "p6_copies": p6_copies,
    "p7_ids": p7_ids,
    "p7_decoded": p7_decoded,
    "p8_found": p8_found,
    "p9_found": p9_found,
    "p9_pieces": p9_pieces,
}

_WIDE = "translate(lower(coalesce({c}, '')), '：＝；｜，＋－％．／～、‐‑‒–—−', ':=;|,+-%./~,------')"
_LABELLED = r"\p{L}[\p{L}\p{N} ]*\s*[:=]\s*[+\-]?\d[\d.]*\s*%?"


def _bare_sql(text: str) -> str:
    """Letters, digits and the signs of numbers: marks the signs that stay, then drops the rest.

    Patterns without a look around consume what they test, so they run twice."""
    for _ in range(3):
        text = rf"regexp_replace({text}, '(\d),(\d{{3}})(\D|$)', '\1\2\3', 'g')"
    between = r"(\p{N})(?:([.,])|\s*([/:~\-])\s*)(\p{N})"
    for _ in range(2):
        text = rf"regexp_replace({text}, '{between}', '\1' || chr(1) || '\2\3\4', 'g')"
    text = rf"regexp_replace({text}, '(^|[^\p{{L}}\p{{N}}\x01.,/:~+\-])([+\-])(\p{{N}})', '\1' || chr(1) || '\2\3', 'g')"
    return rf"regexp_replace({text}, '\x01(.)|[^\p{{L}}\p{{N}}\x01]', '\1', 'g')"


def _canonical_sql(column: str) -> str:
    """SQL of the canonical form; compatibility characters aside, which DuckDB cannot fold."""
    text = "regexp_replace(" + _WIDE.replace("{c}", column) + r", '\\[nrt]', chr(10), 'g')"
    items = f"regexp_extract_all({text}, '{_LABELLED}')"
    listed = f"array_to_string(list_sort(list_transform({items}, lambda x: regexp_replace(x, '[^\\p{{L}}\\p{{N}}+\\-%.]+', '', 'g'))), ';')"
    rest = f"regexp_replace({text}, '{_LABELLED}', '', 'g')"
    pieces = f"list_filter(string_split_regex({text}, CASE WHEN regexp_matches({text}, '[;|]') THEN '[;|]' ELSE ',' END), lambda x: regexp_matches(x, '[\\p{{L}}\\p{{N}}]'))"
    named = f"array_to_string(list_sort(list_transform({pieces}, lambda x: {_bare_sql("regexp_extract(x, '^([^:=]*)', 1)")} || '=' || {_bare_sql("regexp_extract(x, '[:=](.*)$', 1)")})), ';')"
    labelled = r"^[^:=]*\p{L}[^:=]*[:=][^:=]*[\p{L}\p{N}][^:=]*$"
    return (
        f"CASE WHEN len({items}) > 1 AND NOT regexp_matches({rest}, '[\\p{{L}}\\p{{N}}]') THEN {listed}"
        f" WHEN len({pieces}) > 1 AND len(list_filter({pieces}, lambda x: NOT regexp_matches(x, '{labelled}'))) = 0 THEN {named} ELSE {_bare_sql(text)} END"
    )


_COPIES = f"""k AS (SELECT segment_id, {_canonical_sql('"zh-CN"')} AS a, {_canonical_sql('ko')} AS b FROM segments), g AS (SELECT segment_id, min(segment_id) OVER (PARTITION BY a, b) AS kept_id FROM k)"""

SQL: dict[str, str] = {
    "p6_found": f"WITH {_COPIES} SELECT kept_id, segment_id AS copy_id FROM g WHERE segment_id <> kept_id",
    "p6_copies": f"WITH {_COPIES} SELECT kept_id, count(*) AS copies FROM g GROUP BY kept_id",
    "p7_decoded": "SELECT doc_id, coalesce(text, '') AS text FROM documents",
}
