"""Segment cleaning: markup and wrappers, tuple splitting, the first-match verdict
and the verdict on entity-like rows from provider scores."""

from __future__ import annotations

import csv
import re
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomline.functions import lexicons as L
from loomline.functions import text as X


def normalize_rows(segments: DataFrame) -> DataFrame:
    """(segment_id, src, tgt) normalised, with what was found on the way.

    Presentation tags go from both sides where either has one; a wrapper goes
    where both sides have the same one.  ``mismatches`` names a one-sided or
    unknown tag, and a one-sided wrapper; different wrappers are no mismatch.
    """
    tags = segments.withColumns({
        "src_tags": X.tag_count(F.col("src")), "tgt_tags": X.tag_count(F.col("tgt")),
        "src_unknown": X.unknown_tags(F.col("src")), "tgt_unknown": X.unknown_tags(F.col("tgt")),
    })
    tagged = (F.col("src_tags") > 0) | (F.col("tgt_tags") > 0)
    bare = tags.withColumns({c: F.when(tagged, X.strip_tags(F.col(c))).otherwise(F.col(c)) for c in ("src", "tgt")})
    wrapped = bare.withColumns({"__s": X.wrapper(F.col("src")), "__t": X.wrapper(F.col("tgt"))})
    same = F.coalesce(F.col("__s.name") == F.col("__t.name"), F.lit(False))
    markup = ((F.col("src_tags") > 0) != (F.col("tgt_tags") > 0)) | (F.col("src_unknown") != "") | (F.col("tgt_unknown") != "")
    one_side = F.col("__s").isNull() != F.col("__t").isNull()
    mismatches = F.array_compact(F.array(F.when(markup, F.lit("presentation_tag_one_side_or_unknown_angle")), F.when(one_side, F.lit("wrapper_one_side"))))
    return wrapped.select(
        "segment_id", F.when(same, F.col("__s.inner")).otherwise(F.col("src")).alias("src"), F.when(same, F.col("__t.inner")).otherwise(F.col("tgt")).alias("tgt"),
        "src_tags", "tgt_tags", "src_unknown", "tgt_unknown", F.when(same, F.col("__s.name")).alias("unwrapped"), mismatches.alias("mismatches"),
    )


def markup_mismatches(normalized: DataFrame) -> DataFrame:
    """(segment_id, mismatch_type, unknown tags): up to two rows for a segment."""
    each = normalized.select("segment_id", F.explode("mismatches").alias("mismatch_type"), "src_unknown", "tgt_unknown")
    tag = F.col("mismatch_type") != "wrapper_one_side"
    return each.withColumns({c: F.when(tag, F.col(c)).otherwise("") for c in ("src_unknown", "tgt_unknown")})


def placeholder_mismatches(normalized: DataFrame) -> DataFrame:
    """(segment_id, src_placeholders, tgt_placeholders) where the two sides differ."""
    both = normalized.select("segment_id", X.placeholder_list(F.col("src")).alias("src_placeholders"), X.placeholder_list(F.col("tgt")).alias("tgt_placeholders"))
    return both.where("src_placeholders <> tgt_placeholders")


_TUPLE = re.compile(X.TUPLE_LIKE)


def parse_tuple(text: str | None) -> list[str] | None:
    """Fields of a bracketed record of quoted values; None for anything else.

    The text between the brackets is one CSV record: its number of fields is not
    known beforehand, which no JVM parser here allows.
    """
    text = (text or "").strip()
    if not _TUPLE.match(text):
        return None
    body = text[1:-1] if text[0] in "{[" and text[-1] in "}]" else text
    try:
        fields = [f.strip() for f in next(csv.reader([body]))]
    except (csv.Error, StopIteration):
        return None
    return fields if len(fields) > 1 else None


def tuple_fields(column: Column) -> Column:
    """parse_tuple of a column; only texts that look like a tuple leave the JVM."""

    @F.pandas_udf(T.ArrayType(T.StringType()))
    def parse(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for values in batches:
            yield values.map(parse_tuple, na_action=None)

    return parse(F.when(column.rlike(X.TUPLE_LIKE), column))


def split_tuples(normalized: DataFrame) -> DataFrame:
    """(segment_id, split_index, src, tgt, aligned): tuples as one row for each pair of fields.

    ``split_index`` is 0 for rows that are no tuple, else from 1; a tuple whose
    sides do not parse to equally many fields stays one row with ``aligned`` off.
    """
    parsed = normalized.select("segment_id", "src", "tgt", tuple_fields(F.col("src")).alias("a"), tuple_fields(F.col("tgt")).alias("b"))
    either = F.col("a").isNotNull() | F.col("b").isNotNull()
    aligned = F.coalesce(F.size("a") == F.size("b"), F.lit(False)) & F.col("a").isNotNull() & F.col("b").isNotNull()
    whole = F.array(F.struct(F.lit(0).alias("split_index"), F.col("src").alias("src"), F.col("tgt").alias("tgt"), (~either).alias("aligned")))
    fields = F.transform(F.arrays_zip("a", "b"), lambda x, i: F.struct((i + 1).alias("split_index"), x["a"].alias("src"), x["b"].alias("tgt"), F.lit(True).alias("aligned")))
    rows = F.explode(F.when(either & aligned, fields).otherwise(whole))
    return parsed.select("segment_id", rows.alias("r")).select("segment_id", "r.*")


def classify(rows: DataFrame, pairs: DataFrame, markers: Sequence[str] = L.SENTENCE_MARKERS, keep: float = 0.55) -> DataFrame:
    """Adds ``action``, ``reason`` and ``semantic_action``: the first rule that holds.

    ``rows``: segment_id, split_index, src, tgt, aligned; ``pairs``: distinct
    (term_src, term_tgt).  Rows that no rule settles are PENDING_SEMANTIC.
    ``sentence_score`` is null where an earlier rule settles the row, and 1
    for a placeholder.
    """
    exact = pairs.select(F.col("term_src").alias("src"), F.col("term_tgt").alias("tgt"), F.lit(True).alias("__exact"))
    joined = rows.join(exact, ["src", "tgt"], "left")
    src, tgt, both = F.col("src"), F.col("tgt"), F.concat("src", "tgt")
    contaminated = X.contamination(tgt)
    score = X.sentence_score(src, tgt, markers)
    rules = [
        (~X.has_meaning(both) & (F.col("split_index") == 0), "REMOVE_MARKUP_ONLY", F.lit("markup_only_after_normalization"), "SKIP_MARKUP_ONLY"),
        (~F.col("aligned"), "REMOVE_STRUCTURED_UNPARSED", F.lit("tuple_parse_or_alignment_failed"), "SKIP_STRUCTURED_UNPARSED"),
        ((src == "") | (tgt == ""), "REMOVE_EMPTY", F.lit("empty_after_split"), "SKIP_EMPTY"),
        (contaminated != "", "REMOVE_TARGET_LANGUAGE_CONTAMINATION", contaminated, "AUTO_REMOVE_TARGET_LANGUAGE_CONTAMINATION"),
        (X.is_fragment(src, tgt), "REMOVE_NON_SEGMENT_FRAGMENT", F.lit("pure_cjk_single_char_fragment"), "AUTO_REMOVE_NON_SEGMENT_FRAGMENT"),
        (both.rlike(X.PLACEHOLDER), "KEEP", F.lit(PLACEHOLDER_KEPT), "SKIP_PLACEHOLDER"),
        (F.col("__exact").isNotNull(), "REMOVE_TERM_LIKE", F.lit("exact_glossary_pair"), "AUTO_REMOVE_EXACT_GLOSSARY"),
        (score >= keep, "KEEP", F.lit("sentence_like_kept"), "SKIP_SENTENCE_LIKE"),
        (src.rlike(X.TUPLE_WRAPPER) | tgt.rlike(X.TUPLE_WRAPPER), "KEEP", F.lit("structured_wrapper_kept_for_review"), "SKIP_STRUCTURE_WRAPPER"),
    ]
    chain = None
    for test, action, reason, semantic in rules:
        value = F.struct(F.lit(action).alias("action"), reason.alias("reason"), F.lit(semantic).alias("semantic_action"))
        chain = F.when(test, value) if chain is None else chain.when(test, value)
    rest = F.struct(F.lit("KEEP").alias("action"), F.lit("kept").alias("reason"), F.lit("PENDING_SEMANTIC").alias("semantic_action"))
    judged = joined.withColumn("__v", chain.otherwise(rest))
    scored = F.when(F.col("__v.reason") == PLACEHOLDER_KEPT, 1.0).when(F.col("__v.semantic_action").isin("SKIP_SENTENCE_LIKE", "SKIP_STRUCTURE_WRAPPER", PENDING), score)
    return judged.select("segment_id", "split_index", "src", "tgt", "__v.action", "__v.reason", "__v.semantic_action", scored.alias("sentence_score"))


PENDING, PLACEHOLDER_KEPT = "PENDING_SEMANTIC", "placeholder_kept"


def judge_pending(rows: DataFrame, terms: DataFrame, seeds: Sequence[str] = L.ENTITY_SEEDS) -> DataFrame:
    """The rows of classify with the pending ones settled by their scores.

    Adds ``noun_score``, ``glossary_similarity``, ``seed_similarity`` and
    ``semantic_score``, null for rows that a rule has settled.  Words and vectors
    are those of :mod:`loomline.operators.tagging`, computed once for each
    distinct pair of texts; a seed itself is as near as can be.
    """
    from loomline.functions.lineage import checkpointed
    from loomline.operators import glossary, tagging

    spark, pair = rows.sparkSession, F.md5(F.concat_ws("\x1f", "src", "tgt"))
    pending = rows.where(F.col("semantic_action") == PENDING).select("src", "tgt").distinct().withColumn("__pair", pair)
    sw, tw = tagging.source_words(F.col("src")), tagging.target_words(F.col("tgt"))
    meaningful = F.filter(F.transform("tw", lambda w: w["tag"]), lambda t: ~F.startswith(t, F.lit("J")))
    tagged = pending.withColumns({"sw": sw, "tw": tw, "v": tagging.hashed_vector(F.col("src"))})
    tagged = checkpointed(tagged)  # used several times
    nouns = tagged.select("__pair", "src", "v", F.least(
        glossary.segment_source_noun(F.col("src"), F.transform("sw", lambda w: w["flag"]), F.transform("sw", lambda w: w["upos"])),
        glossary.segment_target_noun(F.col("tgt"), meaningful, F.transform("tw", lambda w: w["upos"])),
    ).alias("noun_score"))
    listed = spark.createDataFrame([(w,) for w in seeds], "w string").select(tagging.hashed_vector(F.col("w")).alias("t"))
    known = terms.select("term_src").distinct().select(tagging.hashed_vector(F.col("term_src")).alias("t"))
    near = glossary.max_similarity(nouns, "__pair", "v", known, "t").withColumnRenamed("similarity", "glossary_similarity")
    like = glossary.max_similarity(nouns, "__pair", "v", listed, "t").withColumnRenamed("similarity", "seed_similarity")
    scores = nouns.drop("v").join(near, "__pair").join(like, "__pair").withColumn("glossary_similarity", F.coalesce("glossary_similarity", F.lit(0.0)))
    scores = glossary.seed_similarity(scores, "src", "seed_similarity", seeds).drop("src")
    joined = rows.withColumn("__pair", F.when(F.col("semantic_action") == PENDING, pair)).join(scores, "__pair", "left").drop("__pair")
    verdict = entity_verdict(F.col("noun_score"), F.col("glossary_similarity"), F.col("seed_similarity"), F.coalesce("sentence_score", F.lit(0.0)))
    out = joined.withColumn("__v", F.when(F.col("semantic_action") == PENDING, verdict))
    settled = {c: F.coalesce(F.col(f"__v.{c}"), F.col(c)) for c in ("action", "reason", "semantic_action")}
    return out.withColumns({"semantic_score": F.col("__v.score"), **settled}).drop("__v")


def clean_segments(segments: DataFrame, glossary: DataFrame) -> DataFrame:
    """The whole stage: normalise, split tuples, classify, and settle what is left by scores.

    One join on exact pairs, one back from the distinct pending pairs; everything else is narrow."""
    from loomline.functions.lineage import checkpointed
    from loomline.sources.pairs import distinct_pairs

    rows = checkpointed(classify(split_tuples(normalize_rows(segments)), distinct_pairs(glossary)))
    return judge_pending(rows, glossary)


def entity_verdict(noun: Column, glossary: Column, seed: Column, sentence: Column) -> Column:
    """struct(score, action, reason, semantic_action) of a pending row from its scores.

    Fixed values: weights 0.38, 0.30, 0.27, -0.25; removal from 0.68 with a noun
    of 0.55 and a near term, review from 0.56.
    """
    score = F.greatest(F.lit(0.0), F.least(F.lit(1.0), 0.38 * noun + 0.30 * glossary + 0.27 * seed - 0.25 * sentence))
    near = (glossary >= 0.70) | (seed >= 0.72)
    verdict = lambda action, reason, semantic: F.struct(
        score.alias("score"), F.lit(action).alias("action"), F.lit(reason).alias("reason"), F.lit(semantic).alias("semantic_action")
    )
    return (
        F.when((score >= 0.68) & (noun >= 0.55) & near, verdict("REMOVE_TERM_LIKE", "semantic_term_entity_like", "AUTO_REMOVE_SEMANTIC_TERM_ENTITY"))
        .when((score >= 0.56) & (noun >= 0.55), verdict("KEEP", "semantic_term_entity_review", "REVIEW_SEMANTIC_TERM_ENTITY"))
        .otherwise(verdict("KEEP", "kept", "KEEP_SEMANTIC_SEGMENT"))
    )
