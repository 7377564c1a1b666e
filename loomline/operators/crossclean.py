"""Cross-checking of glossary and segments: statistics of each term over its
matches, verdicts on terms, joined back to verdicts on rows."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomline.functions import lexicons as L
from loomline.functions.text import contains_any, ends_with_any, source_length
from loomline.operators.matching import find_matches


@dataclass(frozen=True)
class Rules:
    """Thresholds, scores and word lists of the cross-check."""

    noise_occurrences: int = 5
    noise_missing: float = 0.65
    weak: float = 0.85
    strong_domain: float = 0.65
    strong_preserved: int = 3
    strong_missing: float = 0.6
    empirical_preserved: int = 20
    empirical_rate: float = 0.8
    anchor: float = 0.9
    seed: float = 0.85
    acronym: float = 0.9
    noun_suffix: float = 0.65
    compound_suffix: float = 0.7
    four: float = 0.35
    six: float = 0.5
    exact: float = 1.0
    short: float = 0.6
    common: float = 0.85
    seeds: Sequence[str] = field(default=L.GAME_TERM_SEEDS)
    anchors: Sequence[str] = field(default=L.GAME_ANCHORS)
    acronyms: Sequence[str] = field(default=L.ACRONYMS)
    compound_suffixes: Sequence[str] = field(default=L.COMPOUND_SUFFIXES)
    noun_suffixes: Sequence[str] = field(default=L.NOUN_SUFFIXES)
    nonterms: Sequence[str] = field(default=L.NONTERM_EXACT)
    common_words: Sequence[str] = field(default=L.GENERAL_WORDS_ZH + L.COMMON_NOUNS_ZH)


def score(test: Column, value: float) -> Column:
    return F.when(test, F.lit(float(value))).otherwise(F.lit(0.0))


def domain_score(term: Column, rules: Rules = Rules()) -> Column:
    """How much a term belongs to the domain: the strongest signal, 1 at most."""
    size = source_length(term)
    return F.least(F.lit(1.0), F.greatest(
        score(term.isin(*rules.seeds), rules.seed), score(contains_any(term, rules.anchors), rules.anchor),
        score(contains_any(F.upper(term), [a.upper() for a in rules.acronyms]), rules.acronym),
        score(ends_with_any(term, rules.compound_suffixes), rules.compound_suffix), score(ends_with_any(term, rules.noun_suffixes), rules.noun_suffix),
        score(size >= 6, rules.six), score((size >= 4) & (size < 6), rules.four),
    ))


def weak_score(term: Column, domain: Column, rules: Rules = Rules()) -> Column:
    """How much a term is an everyday word."""
    return F.least(F.lit(1.0), F.greatest(
        score(term.isin(*rules.nonterms), rules.exact), score(term.isin(*rules.common_words), rules.common),
        score((source_length(term) <= 2) & (domain < rules.strong_domain), rules.short),
    ))


def term_statistics(matches: DataFrame, terms: DataFrame) -> DataFrame:
    """(term_id, term_src, term_tgt, occurrences, preserved, missing); terms without a match stay."""
    each = matches.select(F.explode("matches").alias("m")).select("m.term_id", "m.preserved")
    counts = each.groupBy("term_id").agg(F.count("*").alias("occurrences"), F.count_if("preserved").alias("preserved"))
    zero = F.lit(0).cast("long")
    return terms.join(counts, "term_id", "left").select(
        "term_id", "term_src", "term_tgt", F.coalesce("occurrences", zero).alias("occurrences"), F.coalesce("preserved", zero).alias("preserved"),
        (F.coalesce("occurrences", zero) - F.coalesce("preserved", zero)).alias("missing"),
    )


def term_verdicts(statistics: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """The statistics with rates, scores and the normal and the strict verdict on each term."""
    rate = lambda c: F.coalesce(F.try_divide(F.col(c), F.col("occurrences")), F.lit(0.0))
    scored = statistics.withColumns({"missing_rate": rate("missing"), "preserved_rate": rate("preserved"), "domain_score": domain_score(F.col("term_src"), rules)})
    scored = scored.withColumn("weak_score", weak_score(F.col("term_src"), F.col("domain_score"), rules))
    noise = (
        (F.col("occurrences") >= rules.noise_occurrences) & (F.col("missing_rate") >= rules.noise_missing)
        & (F.col("weak_score") >= rules.weak) & (F.col("domain_score") < rules.strong_domain)
    )
    strong = (F.col("domain_score") >= rules.strong_domain) & (F.col("preserved") >= rules.strong_preserved) & (F.col("missing_rate") <= rules.strong_missing)
    empirical = (F.col("preserved") >= rules.empirical_preserved) & (F.col("preserved_rate") >= rules.empirical_rate) & (F.col("weak_score") < rules.weak)
    clean = F.col("missing") == 0
    return scored.withColumns({
        "term_action": F.when(noise, "AUTO_REMOVE_GLOSSARY_NOISE").when(strong, "STRONG_GLOSSARY_TERM").otherwise("TERM_NEEDS_REVIEW"),
        "strict_action": F.when(clean, "STRICT_CLEAN").when(strong | empirical, "STRICT_RETAIN_AND_ENFORCE").otherwise("AUTO_REMOVE_GLOSSARY_UNENFORCEABLE"),
        "strict_reason": F.when(clean, "no_missing_terms").when(strong, "domain_preserved_evidence").when(empirical, "empirical_stable_translation").otherwise("not_enforceable_in_segments"),
    })


def row_verdicts(segments: DataFrame, matches: DataFrame, verdicts: DataFrame) -> DataFrame:
    """(segment_id, row_action, strict_row_action and the terms behind them) of every segment.

    Terms are joined by ``|`` in the order of their places; a term occurs once
    for each match.  Segments without a match are kept as they are.
    """
    each = matches.select("segment_id", F.posexplode("matches").alias("at", "m")).select("segment_id", "at", "m.term_id", "m.preserved")
    known = each.join(verdicts.select("term_id", "term_action", "strict_action"), "term_id")
    missing = ~F.col("preserved")
    named = lambda test: F.array_join(F.transform(F.array_sort(F.collect_list(F.when(test, F.struct("at", "term_id")))), lambda x: x["term_id"]), "|")
    grouped = known.groupBy("segment_id").agg(
        named(F.lit(True)).alias("matched_terms"), named(missing).alias("missing_terms"),
        F.count_if(missing).alias("n_missing"), F.count_if(missing & (F.col("term_action") == "STRONG_GLOSSARY_TERM")).alias("n_strong"),
        F.count_if(missing & (F.col("term_action") == "AUTO_REMOVE_GLOSSARY_NOISE")).alias("n_noise"),
        F.count_if(missing & (F.col("strict_action") != "AUTO_REMOVE_GLOSSARY_UNENFORCEABLE")).alias("n_strict"),
    )
    joined = segments.select("segment_id").join(grouped, "segment_id", "left")
    n = lambda c: F.coalesce(F.col(c), F.lit(0))
    action = F.when(n("n_strong") > 0, "AUTO_REMOVE_SEGMENT_CONFLICT").when((n("n_missing") > 0) & (n("n_missing") == n("n_noise")), "KEEP_AFTER_GLOSSARY_NOISE_REMOVAL")
    strict = F.when(n("n_strict") > 0, "STRICT_REMOVE_SEGMENT_MISMATCH").when(n("n_missing") > 0, "STRICT_KEEP_AFTER_GLOSSARY_REMOVAL")
    return joined.select(
        "segment_id", action.when(n("n_missing") > 0, "ROW_NEEDS_REVIEW").otherwise("KEEP").alias("row_action"), strict.otherwise("STRICT_KEEP").alias("strict_row_action"),
        F.coalesce("matched_terms", F.lit("")).alias("matched_terms"), F.coalesce("missing_terms", F.lit("")).alias("missing_terms"),
    )


def cross_check(segments: DataFrame, terms: DataFrame, rules: Rules = Rules()) -> tuple[DataFrame, DataFrame]:
    """(term verdicts, row verdicts) of a corpus; the matches are computed once."""
    return cross_check_all(segments, terms, rules)[1:]


def cross_check_all(segments: DataFrame, terms: DataFrame, rules: Rules = Rules()) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(matches, term verdicts, row verdicts) of a corpus."""
    from loomline.functions.lineage import checkpointed

    matches = checkpointed(find_matches(segments, terms))
    verdicts = term_verdicts(term_statistics(matches, terms), rules)
    return matches, verdicts, row_verdicts(segments, matches, verdicts)


def apply_verdicts(segments: DataFrame, terms: DataFrame, verdicts: DataFrame, rows: DataFrame, strict: bool = False) -> tuple[DataFrame, DataFrame]:
    """(segments, terms) that remain: what the verdicts remove is left out, nothing is changed."""
    if strict:
        drop_rows, drop_terms = F.col("strict_row_action") == "STRICT_REMOVE_SEGMENT_MISMATCH", F.col("strict_action") == "AUTO_REMOVE_GLOSSARY_UNENFORCEABLE"
    else:
        drop_rows, drop_terms = F.col("row_action") == "AUTO_REMOVE_SEGMENT_CONFLICT", F.col("term_action") == "AUTO_REMOVE_GLOSSARY_NOISE"
    return segments.join(rows.where(drop_rows).select("segment_id"), "segment_id", "left_anti"), terms.join(verdicts.where(drop_terms).select("term_id"), "term_id", "left_anti")


MODES = ("dry-run", "apply", "strict-dry-run", "strict-apply", "strict-check")


@dataclass(frozen=True)
class CrossRun:
    """What a mode of the cross-check removes and leaves."""

    segments: DataFrame  # what remains
    terms: DataFrame
    counts: DataFrame  # one row


def run_mode(segments: DataFrame, terms: DataFrame, verdicts: DataFrame, rows: DataFrame, mode: str) -> CrossRun:
    """One of the five modes over the verdicts of cross_check.

    Dry runs count what they would remove and leave everything; the check
    removes nothing and only counts rows that miss a term.
    """
    if mode not in MODES:
        raise ValueError(f"mode: {mode}")
    strict = mode.startswith("strict")
    row_test, term_test = ("strict_row_action = 'STRICT_REMOVE_SEGMENT_MISMATCH'", "strict_action = 'AUTO_REMOVE_GLOSSARY_UNENFORCEABLE'") if strict else (
        "row_action = 'AUTO_REMOVE_SEGMENT_CONFLICT'", "term_action = 'AUTO_REMOVE_GLOSSARY_NOISE'")
    none = mode == "strict-check"
    left = (segments, terms) if not mode.endswith("apply") else apply_verdicts(segments, terms, verdicts, rows, strict)
    removed = lambda test: F.lit(0).cast("long") if none else F.count_if(F.expr(test))
    of_terms = verdicts.agg(F.count("*").alias("input_terms"), removed(term_test).alias("removed_terms"), F.count_if(F.expr("strict_action = 'AUTO_REMOVE_GLOSSARY_UNENFORCEABLE'")).alias("unenforceable_terms"))
    of_rows = rows.agg(
        F.count("*").alias("input_segments"), removed(row_test).alias("removed_segments"), F.count_if(F.col("missing_terms") != "").alias("mismatch_rows"),
        F.count_if(F.expr("strict_row_action = 'STRICT_REMOVE_SEGMENT_MISMATCH'")).alias("strict_mismatch_rows"),
    )
    counts = of_terms.join(of_rows).select(
        F.lit(mode).alias("mode"), "input_terms", (F.col("input_terms") - F.col("removed_terms")).alias("output_terms"), "removed_terms", "input_segments",
        (F.col("input_segments") - F.col("removed_segments")).alias("output_segments"), "removed_segments", "mismatch_rows", "unenforceable_terms", "strict_mismatch_rows",
    )
    return CrossRun(*left, counts)


def strict_gate(rows: DataFrame) -> DataFrame:
    """(mismatch_rows, passed): the gate is passed where no row misses a term."""
    return rows.agg(F.count_if(F.col("missing_terms") != "").alias("mismatch_rows")).withColumn("passed", F.col("mismatch_rows") == 0)


def six(column: str) -> Column:
    """A score as text, six digits behind the point."""
    return F.format_string("%.6f", F.col(column))


def removed_terms(verdicts: DataFrame, strict: bool = False) -> DataFrame:
    """Removed terms with their statistics as text."""
    name, reason = ("strict_action", "AUTO_REMOVE_GLOSSARY_UNENFORCEABLE") if strict else ("term_action", "AUTO_REMOVE_GLOSSARY_NOISE")
    return verdicts.where(F.col(name) == reason).select(
        F.col("term_id").alias("original_term_id"), F.col("term_src").alias("term_zh-CN"), F.col("term_tgt").alias("expected_ko"), F.col("occurrences").cast("string").alias("occurrence_count"),
        F.col("preserved").cast("string").alias("preserved_count"), F.col("missing").cast("string").alias("missing_count"), *(six(c).alias(c) for c in ("missing_rate", "preserved_rate", "domain_score", "weak_score")),
        F.lit(reason).alias("remove_reason"),
    )


def removed_rows(segments: DataFrame, matches: DataFrame, verdicts: DataFrame, rows: DataFrame, strict: bool = False) -> DataFrame:
    """Removed segments, numbered from 1, with the terms that they miss and, in the
    normal mode, those terms' statistics."""
    from loomline.operators.review import with_ordinal

    name, reason = ("strict_row_action", "STRICT_REMOVE_SEGMENT_MISMATCH") if strict else ("row_action", "AUTO_REMOVE_SEGMENT_CONFLICT")
    gone = with_ordinal(segments.join(rows.where(F.col(name) == reason).select("segment_id"), "segment_id"), "segment_id", "__ord")
    each = matches.select("segment_id", F.posexplode("matches").alias("at", "m")).where("not m.preserved").select("segment_id", "at", "m.term_id").join(verdicts, "term_id")
    each = each.where(F.col("strict_action") != "AUTO_REMOVE_GLOSSARY_UNENFORCEABLE" if strict else F.col("term_action") == "STRONG_GLOSSARY_TERM")
    stats = F.concat_ws(";", *(F.concat(F.lit(f"{label}="), value) for label, value in (
        ("term_id", F.col("term_id")), ("occ", F.col("occurrences").cast("string")), ("preserved", F.col("preserved").cast("string")), ("missing", F.col("missing").cast("string")),
        ("missing_rate", six("missing_rate")), ("domain_score", six("domain_score")),
    )))
    named = F.concat(F.col("term_id"), F.lit(":"), F.col("term_src"), F.lit("=>"), F.col("term_tgt"))
    joined = lambda value: F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", value.alias("x")))), lambda s: s["x"]), "|")
    listed = each.groupBy("segment_id").agg(joined(named).alias("terms"), joined(stats).alias("stats"))
    out = gone.join(listed, "segment_id", "left").select(
        (F.col("__ord") + 1).cast("string").alias("removed_id"), F.col("segment_id").alias("original_segment_id"), F.col("src").alias("zh-CN"), F.col("tgt").alias("ko"),
        F.col("terms").alias("strict_missing_terms" if strict else "missing_strong_terms"), F.col("stats").alias("term_level_stats"), F.lit(reason).alias("remove_reason"),
    )
    return out.drop("term_level_stats") if strict else out
