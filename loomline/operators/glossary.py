"""Glossary cleaning: compound families, corpus evidence, scores from word lists
and vectors, the verdict ladder, exact-pair merging and the one-to-one constraint.

Parts of speech, word frequencies and vectors come in as columns from providers;
everything made of them is a column expression.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomline.functions import lexicons as L
from loomline.functions.text import contains_any, ends_with_any, filled, has_source, has_target, starts_with_any

# Patterns of the glossary rules.
PLACEHOLDER = r"%[sd]|\{\d+\}|<[^>]+>|\$\{[^}]+\}|\[[^\]]+\]"
SENTENCE_PUNCT = r"[。！？!?，,；;：:]"
BOOK_TITLE = r"[《》]"
PAREN_PREFIX = r"^[（(][^）)]{1,12}[）)]"
NUMERIC = r"^[+\-]?\d+(?:\.\d+)?\z"
STATUS = r"(不足|不可用|无法使用|不能使用|失败|成功|已满|未开启|已开启|已完成|未完成)$"
SOURCE_END = r"[了着过吗呢吧]$"
TARGET_END = r"(다|요|니다|세요|십시오|했습니다|됩니다|있습니다|없습니다|않습니다|까요|네요|군요|입니다|합니다|하지)$"
ASCII_SIGNAL = r"[A-Za-z0-9·+.\-]"
BLOCKERS = r"[《》\[\]【】（）()]"
PROPER = r"/nr[a-z]?(?:\s|\||$)|/ns(?:\s|\||$)|/nz(?:\s|\||$)|/PROPN/root"
NON_NOUN_ROOT = r"/(?:VERB|ADJ)/root"


def split_compound(term: Column, suffixes: Sequence[str] = L.COMPOUND_SUFFIXES) -> Column:
    """struct(stem, suffix) by the longest suffix that leaves two characters; empty parts without one."""
    ordered = F.array(*map(F.lit, sorted(suffixes, key=lambda s: (-len(s), suffixes.index(s)))))
    suffix = F.get(F.filter(ordered, lambda s: F.endswith(term, s) & (F.length(term) > F.length(s) + 1)), F.lit(0))
    stem = F.substring(term, F.lit(1), F.length(term) - F.length(suffix))
    return F.struct(F.coalesce(stem, F.lit("")).alias("stem"), F.coalesce(suffix, F.lit("")).alias("suffix"))


def compound_families(terms: DataFrame) -> DataFrame:
    """(stem, suffixes, n_suffixes) of every stem of an unblocked compound."""
    parts = terms.where(~F.col("term_src").rlike(BLOCKERS)).select(split_compound(F.col("term_src")).alias("c")).where("c.stem <> ''")
    return parts.groupBy(F.col("c.stem").alias("stem")).agg(F.array_sort(F.collect_set("c.suffix")).alias("suffixes")).withColumn("n_suffixes", F.size("suffixes"))


def corpus_counts(segments: DataFrame, terms: DataFrame) -> DataFrame:
    """(term_id, src_count, tgt_count): occurrences of each term in all segments.

    Occurrences do not overlap; terms of one character count none.  The glossary
    is broadcast within the bound of the matcher.
    """
    from loomline.operators.matching import candidates

    def side(text: str, term: str, name: str) -> DataFrame:
        own = terms.where(F.length(term) >= 2).select("term_id", F.col(term).alias("term_src")).withColumn("n", F.length("term_src"))
        met = candidates(segments.select(text), own, text)
        times = ((F.length(text) - F.length(F.replace(F.col(text), F.col("term_src"), F.lit("")))) / F.col("n")).cast("long")
        return met.groupBy("term_id").agg(F.sum(times).alias(name))

    zero = F.lit(0).cast("long")
    joined = terms.select("term_id").join(side("src", "term_src", "src_count"), "term_id", "left").join(side("tgt", "term_tgt", "tgt_count"), "term_id", "left")
    return joined.select("term_id", F.coalesce("src_count", zero).alias("src_count"), F.coalesce("tgt_count", zero).alias("tgt_count"))


def acronyms_present(segments: DataFrame, acronyms: Sequence[str] = L.ACRONYMS) -> DataFrame:
    """(acronym) of the acronyms that occur on both sides of the corpus."""
    flags = segments.agg(*(F.max(F.contains(F.upper(c), F.lit(a))).alias(f"{c}_{i}") for i, a in enumerate(acronyms) for c in ("src", "tgt")))
    pairs = F.explode(F.array(*(F.struct(F.lit(a).alias("acronym"), (F.col(f"src_{i}") & F.col(f"tgt_{i}")).alias("on")) for i, a in enumerate(acronyms))))
    return flags.select(pairs.alias("x")).where("x.on").select("x.acronym")


def evidence_score(terms: DataFrame, counts: DataFrame, present: DataFrame) -> DataFrame:
    """(term_id, src_count, tgt_count, product_score): both sides 1, one side 0.55,
    an acronym of the corpus on both sides of the term 0.75 at least."""
    found = F.broadcast(present.agg(F.collect_list("acronym").alias("acronyms")))  # as many as the word list has
    joined = terms.join(counts, "term_id").crossJoin(found)
    src, tgt = F.upper("term_src"), F.upper("term_tgt")
    fallback = F.exists("acronyms", lambda a: F.contains(src, a) & F.contains(tgt, a))
    both, one = (F.col("src_count") > 0) & (F.col("tgt_count") > 0), (F.col("src_count") > 0) | (F.col("tgt_count") > 0)
    base = F.when(both, 1.0).when(one, 0.55).otherwise(0.0)
    return joined.select("term_id", "src_count", "tgt_count", F.greatest(base, F.when(fallback, 0.75).otherwise(0.0)).alias("product_score"))


def source_noun_score(text: Column, flags: Column, upos: Column, root: Column) -> Column:
    """How noun-like a source term is, from tagger columns (arrays may be empty)."""
    nouns = lambda tags, test: F.coalesce(F.try_divide(F.size(F.filter(tags, test)), F.size(tags)), F.lit(0.0))
    first = nouns(flags, lambda t: t.isin("eng", "x", "m") | F.startswith(t, F.lit("n")))
    second = nouns(upos, lambda t: t.isin("NOUN", "PROPN", "NUM", "X"))
    add = lambda test, value: F.when(test, F.lit(value)).otherwise(F.lit(0.0))
    suffix = ends_with_any(text, L.NOUN_SUFFIXES)
    total = (
        0.22 + 0.28 * first + 0.35 * second + add(root.isin("NOUN", "PROPN"), 0.18) - add(root.isin("VERB", "AUX", "ADJ"), 0.25)
        + add(F.length(text).between(2, 6), 0.08) + add(suffix, 0.15) + add(text.rlike(ASCII_SIGNAL), 0.05)
        - add(text.rlike(SENTENCE_PUNCT) | text.rlike(SOURCE_END), 0.45) - add(contains_any(text, L.PHRASE_MARKERS) & ~suffix, 0.35)
        - add(text.rlike(BOOK_TITLE) | text.rlike(PAREN_PREFIX) | text.rlike(PLACEHOLDER), 0.35)
    )
    return F.when(filled(text) == "", 0.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), total)))


def target_noun_score(text: Column, tags: Column, upos: Column, root: Column) -> Column:
    """How noun-like a target term is; ``tags`` are its meaningful morpheme tags."""
    noun = lambda t: t.isin("NR", "NP", "SL", "SH", "SN", "XR") | F.startswith(t, F.lit("NN"))
    last = F.get(tags, F.size(tags) - 1)
    add = lambda test, value: F.when(test, F.lit(value)).otherwise(F.lit(0.0))
    share = lambda a, test: F.coalesce(F.try_divide(F.size(F.filter(a, test)), F.size(a)), F.lit(0.0))
    total = (
        0.22 + 0.33 * share(tags, noun) + 0.30 * share(upos, lambda t: t.isin("NOUN", "PROPN", "NUM", "X")) + add(noun(last), 0.12)
        - add(last.isin("VV", "VA", "VX", "VCP", "VCN", "EF", "EC", "ETM", "ETN", "EP"), 0.40) + add(root.isin("NOUN", "PROPN"), 0.16)
        - add(root.isin("VERB", "AUX", "ADJ"), 0.25) - add(text.rlike(TARGET_END), 0.45) - add(text.rlike(r"[?!。！？]"), 0.30)
    )
    return F.when(filled(text) == "", 0.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), total)))


@dataclass(frozen=True)
class SegmentNouns:
    """Weights of the noun scores of segments."""

    base: float = 0.15
    tags: float = 0.45
    source_upos: float = 0.40
    target_upos: float = 0.35
    no_letters: float = 0.35
    signal: float = 0.08
    noun_end: float = 0.10
    verb_end: float = 0.25


def _share(tags: Column, test) -> Column:
    return F.coalesce(F.try_divide(F.size(F.filter(tags, test)), F.size(tags)), F.lit(0.0))


def _unit(value: Column) -> Column:
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), value))


_NOUN_UPOS = ("NOUN", "PROPN", "NUM", "X")
_NOUN_TAGS = ("NR", "NP", "SL", "SH", "SN", "XR")
_VERB_TAGS = ("VV", "VA", "VX", "VCP", "VCN", "EF", "EC", "ETM", "ETN", "EP")


def segment_source_noun(text: Column, flags: Column, upos: Column, weights: SegmentNouns = SegmentNouns()) -> Column:
    """How noun-like the source of a segment is: other weights than for terms, and no root."""
    first = _share(flags, lambda t: t.isin("eng", "x") | F.startswith(t, F.lit("n")))
    bare = ~has_source(text) & ~text.rlike("[A-Za-z]")
    total = weights.base + weights.tags * first + weights.source_upos * _share(upos, lambda t: t.isin(*_NOUN_UPOS))
    total = total - F.when(bare, weights.no_letters).otherwise(0.0) + F.when(text.rlike("[A-Za-z0-9]"), weights.signal).otherwise(0.0)
    return F.when(filled(text) == "", 0.0).otherwise(_unit(total))


def segment_target_noun(text: Column, tags: Column, upos: Column, weights: SegmentNouns = SegmentNouns()) -> Column:
    """How noun-like the target of a segment is; ``tags`` are its meaningful morpheme tags."""
    noun = lambda t: t.isin(*_NOUN_TAGS) | F.startswith(t, F.lit("NN"))
    last = F.get(tags, F.size(tags) - 1)
    total = weights.base + weights.tags * _share(tags, noun) + weights.target_upos * _share(upos, lambda t: t.isin(*_NOUN_UPOS))
    total = total + F.when(noun(last), weights.noun_end).otherwise(0.0) - F.when(last.isin(*_VERB_TAGS), weights.verb_end).otherwise(0.0)
    return F.when(filled(text) == "", 0.0).otherwise(_unit(total))


def has_anchor(text: Column) -> Column:
    """Whether a text holds a part that marks a domain term, in any case of Latin letters."""
    return contains_any(text, L.GAME_ANCHORS) | contains_any(F.upper(text), L.GAME_ANCHORS)


def general_score(src: Column, tgt: Column, pos: Column) -> Column:
    """How general a word is."""
    listed = src.isin(*L.GENERAL_WORDS_ZH) | tgt.isin(*L.GENERAL_WORDS_KO)
    return F.when(listed, 1.0).when(pos.rlike(NON_NOUN_ROOT) & (F.length(src) <= 4), 0.8).otherwise(0.0)


def game_score(src: Column, tgt: Column, embedding: Column) -> Column:
    """Strongest of six signals of a domain term."""
    add = lambda test, value: F.when(test, F.lit(value)).otherwise(F.lit(0.0))
    return F.greatest(
        add(F.upper(src).isin(*L.ACRONYMS), 1.0), add(has_anchor(src), 0.9), add(ends_with_any(src, L.NOUN_SUFFIXES), 0.65),
        add(embedding >= 0.72, 0.6), add(src.rlike(ASCII_SIGNAL), 0.45), add(contains_any(tgt, L.KO_GAME_TOKENS), 0.75),
    )


def common_noun_score(src: Column, tgt: Column, src_noun: Column, tgt_noun: Column, src_zipf: Column, tgt_zipf: Column, generic: Column) -> Column:
    """How ordinary a noun is."""
    noun = (src_noun >= 0.75) & (tgt_noun >= 0.75)
    add = lambda test, value: F.when(test, F.lit(value)).otherwise(F.lit(0.0))
    short = noun & (F.length(src) <= 4)
    by_frequency = F.when(short & (src_zipf >= 4.2), 0.85).when(short & (src_zipf >= 3.8), 0.75).otherwise(0.0)
    by_vector = F.when(noun & (generic >= 0.78), 0.85).when(noun & (generic >= 0.74) & (src_zipf >= 3.2), 0.80).otherwise(0.0)
    return F.greatest(add(src.isin(*L.COMMON_NOUNS_ZH) | tgt.isin(*L.COMMON_NOUNS_KO), 1.0), by_frequency, by_vector, add((tgt_zipf >= 4.0) & noun, 0.75))


def domain_specificity(src: Column, pos: Column, src_zipf: Column, game: Column) -> Column:
    """How specific a term is to the domain."""
    add = lambda test, value: F.when(test, F.lit(value)).otherwise(F.lit(0.0))
    proper = pos.rlike(PROPER) & ((src_zipf < 3.8) | (F.length(src) >= 3))
    return F.least(F.lit(1.0), F.greatest(game, add(F.upper(src).isin(*L.ACRONYMS) | has_anchor(src), 0.95), add(proper, 0.7), add(src.rlike(ASCII_SIGNAL), 0.55)))


def reasons(*checks: tuple[Column, str]) -> Column:
    """Names of the tests that hold, in order."""
    return F.array_compact(F.array(*(F.when(test, F.lit(name)) for test, name in checks)))


def with_verdicts(df: DataFrame) -> DataFrame:
    """Adds ``action``, ``reasons`` and ``term_score`` to term rows.

    Needs term_src, term_tgt, product_score, src_noun, tgt_noun, bilingual, game,
    common, domain, general, family (number of suffixes of the stem).
    """
    src, tgt = F.col("term_src"), F.col("term_tgt")
    acronym, signal, suffix = F.upper(src).isin(*L.ACRONYMS), src.rlike(ASCII_SIGNAL), ends_with_any(src, L.NOUN_SUFFIXES)
    marker = contains_any(src, L.PHRASE_MARKERS)
    noun = (F.col("src_noun") + F.col("tgt_noun")) / 2
    hard = reasons(
        (tgt == "", "missing_ko_for_zh_ko_glossary"), (src.rlike(PLACEHOLDER) | tgt.rlike(PLACEHOLDER), "placeholder_or_square_bracket_markup"),
        (src.rlike(BOOK_TITLE), "book_or_test_title_markup"), (src.rlike(PAREN_PREFIX), "parenthetical_modifier_fragment"),
        (src.rlike(SENTENCE_PUNCT), "sentence_punctuation"), (src.isin(*L.NONTERM_EXACT), "standalone_ui_action_or_fragment"),
        (src.rlike(NUMERIC), "standalone_numeric_or_signed_token"), (has_target(src), "zh_column_contains_hangul"),
        (~has_source(src) & ~acronym, "zh_column_has_no_chinese_content"), (src.rlike(STATUS), "ui_or_status_sentence_fragment"),
        ((F.col("general") >= 0.8) & (F.col("game") < 0.65) & ~signal, "common_word_without_game_term_signal"),
        ((F.col("common") >= 0.8) & (F.col("domain") < 0.65) & ~has_anchor(src) & ~acronym & ~signal, "common_noun_without_domain_signal"),
        (F.col("product_score") == 0.0, "not_in_segments_redundant_for_current_corpus"),
    )
    low = (tgt != "") & (F.col("bilingual") < 0.3) & (F.col("product_score") == 0.0) & (noun < 0.45) & ~(signal | src.rlike("[【】]"))
    ending = (tgt != "") & tgt.rlike(TARGET_END)
    phrase = reasons(
        (starts_with_any(src, L.UI_STARTS), "ui_or_sentence_start"), (src.rlike(SOURCE_END), "zh_sentence_particle_end"), (ending, "ko_sentence_or_verb_end"),
        (marker & ~suffix, "phrase_marker_without_noun_suffix"), ((F.length(src) >= 9) & (marker | ending), "long_sentence_like"),
        (low, "low_embedding_similarity_without_product_or_noun_signal"),
    )
    stem = split_compound(src)["stem"]
    compound = (stem != "") & (F.col("family") >= 3) & (F.length(stem) >= 2) & ~src.rlike(BLOCKERS)
    raw = 0.45 * noun + 0.35 * F.greatest(F.lit(0.0), F.col("bilingual")) + 0.20 * F.col("game")
    out = df.withColumns({"__hard": hard, "__phrase": phrase, "__low": low, "__noun": noun, "__raw": raw, "__compound": compound})
    several = (F.size("__phrase") >= 2) | ((F.size("__phrase") > 0) & (F.col("__noun") < 0.45))
    keep = (F.col("__raw") >= 0.55) & (F.col("__noun") >= 0.45)
    action = (
        F.when(F.size("__hard") > 0, "AUTO_REMOVE").when(F.col("__compound"), "AUTO_SPLIT_COMPOUND").when(F.col("__low") | several, "AUTO_REMOVE")
        .when(keep, "AUTO_KEEP").otherwise("KEEP_UNCERTAIN")
    )
    fallback = lambda name: F.when(F.size("__phrase") > 0, F.col("__phrase")).otherwise(F.array(F.lit(name)))
    why = (
        F.when(F.size("__hard") > 0, F.concat("__hard", "__phrase")).when(F.col("__compound"), F.concat(F.array(F.lit("compound_family_suffix")), F.col("__phrase")))
        .when(F.col("__low") | several, F.col("__phrase")).when(keep, fallback("termhood_semantic_supported")).otherwise(fallback("weak_termhood_or_mid_semantic_confidence"))
    )
    out = out.withColumns({"action": action, "reasons": why, "term_score": F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col("__raw")))})
    return out.drop("__hard", "__phrase", "__low", "__noun", "__raw", "__compound")


def review_terms(verdicts: DataFrame) -> DataFrame:
    """(term_id, kind) of terms that are kept but look general or ordinary.

    Fixed values: general words from 0.8 with a domain signal under 0.8, ordinary
    nouns from 0.7 with a domain score under 0.75.
    """
    kinds = F.array_compact(F.array(
        F.when((F.col("general") >= 0.8) & (F.col("game") < 0.8), F.lit("common_word")),
        F.when((F.col("common") >= 0.7) & (F.col("domain") < 0.75), F.lit("common_noun")),
    ))
    return verdicts.where("action <> 'AUTO_REMOVE'").select("term_id", F.explode(kinds).alias("kind"))


def merge_pairs(terms: DataFrame, order: str = "term_id", languages: Sequence[str] = ()) -> DataFrame:
    """Adds ``pair_action``: the first row of each exact pair stays (KEEP), later
    ones are MERGED_DUPLICATE, or AUTO_REMOVE where another language differs.

    Later rows compare with the merged first one: a language that is empty there
    is filled by the first row that has it and does not conflict.
    """
    if not languages:
        number = F.row_number().over(Window.partitionBy("term_src", "term_tgt").orderBy(order))
        return terms.withColumn("pair_action", F.when(number == 1, "KEEP").otherwise("MERGED_DUPLICATE"))
    entry = F.struct(F.col(order).alias("ord"), *(filled(F.col(c)).alias(c) for c in languages))
    grouped = terms.groupBy("term_src", "term_tgt").agg(F.array_sort(F.collect_list(entry)).alias("rows"))
    none = F.array().cast("array<struct<ord:string,pair_action:string>>")
    state = F.struct(F.struct(*(F.lit("").alias(c) for c in languages)).alias("base"), none.alias("out"))

    def step(acc: Column, x: Column) -> Column:
        base = acc["base"]
        conflict = F.lit(False)
        for c in languages:
            conflict = conflict | ((base[c] != "") & (x[c] != "") & (base[c] != x[c]))
        merged = F.struct(*(F.when(base[c] == "", x[c]).otherwise(base[c]).alias(c) for c in languages))
        action = F.when(F.size(acc["out"]) == 0, "KEEP").when(conflict, "AUTO_REMOVE").otherwise("MERGED_DUPLICATE")
        row = F.struct(x["ord"].cast("string").alias("ord"), action.alias("pair_action"))
        return F.struct(F.when(conflict, base).otherwise(merged).alias("base"), F.array_append(acc["out"], row).alias("out"))

    acted = grouped.select(F.explode(F.aggregate("rows", state, step, lambda a: a["out"])).alias("a")).select("a.ord", "a.pair_action")
    return terms.join(acted, terms[order].cast("string") == acted["ord"]).drop("ord")


def one_to_one(terms: DataFrame) -> DataFrame:
    """Adds ``conflict``: the source has several targets, or the target several sources.

    Counts come from distinct pairs, so a frequent term costs one row for each
    partner."""
    pairs = terms.select("term_src", "term_tgt").where("term_src <> '' and term_tgt <> ''").distinct()
    by_src = pairs.groupBy("term_src").agg(F.count("*").alias("targets"))
    by_tgt = pairs.groupBy("term_tgt").agg(F.count("*").alias("sources"))
    joined = terms.join(by_src, "term_src", "left").join(by_tgt, "term_tgt", "left")
    conflict = (F.coalesce("targets", F.lit(0)) > 1) | (F.coalesce("sources", F.lit(0)) > 1)
    return joined.withColumn("conflict", conflict & (F.col("term_src") != "") & (F.col("term_tgt") != "")).drop("targets", "sources")


def dot(a: Column, b: Column) -> Column:
    """Inner product in double precision."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def centroid(df: DataFrame, vector: str, group: list[str]) -> DataFrame:
    """(group, centroid): mean vector of each group, of length one."""
    means = df.select(*group, F.posexplode(vector).alias("at", "x")).groupBy(*group, "at").agg(F.avg(F.col("x").cast("double")).alias("m"))
    listed = means.groupBy(*group).agg(F.array_sort(F.collect_list(F.struct("at", "m"))).alias("v"))
    mean = F.transform("v", lambda s: s["m"])
    out = listed.select(*group, mean.alias("mean"))
    norm = F.greatest(F.sqrt(F.aggregate("mean", F.lit(0.0), lambda s, x: s + x * x)), F.lit(1e-9))
    return out.select(*group, F.transform("mean", lambda x: x / norm).alias("centroid"))


def centroid_similarity(df: DataFrame, vector: str, seeds: DataFrame, seed_vector: str, name: str) -> DataFrame:
    """The table with the cosine of its unit vectors and the seeds' centroid."""
    one = centroid(seeds.select(F.lit(0).alias("__all"), seed_vector), seed_vector, ["__all"]).select(F.col("centroid").alias("__centroid"))
    return df.join(F.broadcast(one)).withColumn(name, dot(F.col(vector), F.col("__centroid"))).drop("__centroid")  # one row


def max_similarity(items: DataFrame, key: str, vector: str, terms: DataFrame, term_vector: str, block: int = 10_000, slice_rows: int = 50_000) -> DataFrame:
    """(key, similarity): the largest inner product of each item with any term.

    Up to ``block`` terms go to every worker as one matrix, and items stay where
    they are.  More terms are cut into blocks: slices of items meet blocks of
    terms as matrices, and the largest value of each item's blocks counts.
    Without terms the similarity is null; keys must be unique.
    """
    import numpy as np
    import pandas as pd

    kind = items.schema[key].dataType.simpleString()
    schema = f"{key} {kind}, similarity double"
    rows = terms.select(term_vector).limit(block + 1).collect()
    if not rows:
        return items.select(key, F.lit(None).cast("double").alias("similarity"))
    named = items.select(key, F.col(vector).alias("v"))
    if len(rows) <= block:
        shared = items.sparkSession.sparkContext.broadcast(np.array([r[0] for r in rows], np.float64).T)

        def best(batches):
            for frame in batches:
                vectors = np.stack(frame["v"].to_numpy()) if len(frame) else np.zeros((0, shared.value.shape[0]))
                yield pd.DataFrame({key: frame[key], "similarity": (vectors @ shared.value).max(axis=1).astype(float) if len(frame) else []})

        return named.mapInPandas(best, schema)
    blocks, slices = -(-terms.count() // block), max(1, -(-items.count() // slice_rows))
    one = named.withColumns({"__slice": F.pmod(F.xxhash64(key), F.lit(slices).cast("long")), "__block": F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))})
    other = terms.select(F.col(term_vector).alias("t"), F.pmod(F.xxhash64(term_vector), F.lit(blocks)).cast("int").alias("__block"))
    other = other.withColumn("__slice", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(slices - 1).cast("long"))))

    def best_of_block(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({key: left[key].iloc[:0], "similarity": np.zeros(0)})
        found = np.stack(left["v"].to_numpy()).astype(np.float64) @ np.stack(right["t"].to_numpy()).astype(np.float64).T
        return pd.DataFrame({key: left[key], "similarity": found.max(axis=1).astype(float)})

    each = one.groupBy("__slice", "__block").cogroup(other.groupBy("__slice", "__block")).applyInPandas(best_of_block, schema)
    return each.groupBy(key).agg(F.max("similarity").alias("similarity"))


def seed_similarity(df: DataFrame, text: str, similarity: str, seeds: Sequence[str]) -> DataFrame:
    """The table with ``similarity`` 1 where the text is a seed itself, 0 where it is null."""
    return df.withColumn(similarity, F.when(F.col(text).isin(*seeds), 1.0).otherwise(F.coalesce(similarity, F.lit(0.0))))


def judge_terms(terms: DataFrame, segments: DataFrame) -> DataFrame:
    """Every term with evidence, provider columns, scores and verdict.

    Words, parts of speech, frequencies and vectors are those of
    :mod:`loomline.operators.tagging`, made from the tables themselves.
    """
    from loomline.functions.lineage import checkpointed
    from loomline.operators import tagging

    spark = terms.sparkSession
    counts = checkpointed(corpus_counts(segments, terms))
    evidence = evidence_score(terms, counts, acronyms_present(segments))
    families = compound_families(terms).select(F.col("stem").alias("__stem"), F.col("n_suffixes").alias("family"))
    rows = terms.join(evidence, "term_id").withColumn("__stem", split_compound(F.col("term_src"))["stem"]).join(families, "__stem", "left").drop("__stem")
    chars = segments.agg(F.sum(F.length("src")).alias("s"), F.sum(F.length("tgt")).alias("t"))
    for side in ("src", "tgt"):
        table = tagging.frequency_table(rows, f"term_{side}", f"{side}_count", chars.select(F.col(side[0]).alias("chars")))
        rows = tagging.zipf_of(rows, f"term_{side}", table, f"{side}_zipf")
    src, tgt = F.col("term_src"), F.col("term_tgt")
    # Words and vectors are used many times over: they are written once.
    rows = checkpointed(rows.withColumns({"sw": tagging.source_words(src), "tw": tagging.target_words(tgt), "sv": tagging.hashed_vector(src), "tv": tagging.hashed_vector(tgt)}))
    seeds = lambda words: spark.createDataFrame([(w,) for w in words], "w string").select(tagging.hashed_vector(F.col("w")).alias("v"))
    rows = centroid_similarity(rows, "sv", seeds(L.GAME_TERM_SEEDS), "v", "game_embedding")
    rows = centroid_similarity(rows, "sv", seeds(L.COMMON_NOUN_SEEDS), "v", "generic_embedding")
    pos = tagging.summary(F.col("sw"))
    meaningful = F.filter(F.transform("tw", lambda w: w["tag"]), lambda t: ~F.startswith(t, F.lit("J")))
    rows = rows.withColumns({
        "family": F.coalesce("family", F.lit(0)), "bilingual": F.when(tgt == "", 0.0).otherwise(dot(F.col("sv"), F.col("tv"))), "pos": pos,
        "src_noun": source_noun_score(src, F.transform("sw", lambda w: w["flag"]), F.transform("sw", lambda w: w["upos"]), tagging.root_of(F.col("sw"))),
        "tgt_noun": target_noun_score(tgt, meaningful, F.transform("tw", lambda w: w["upos"]), F.lit("")),
    })
    rows = checkpointed(rows.drop("sv", "tv"))
    rows = rows.withColumns({"game": game_score(src, tgt, F.col("game_embedding")), "general": general_score(src, tgt, F.col("pos"))})
    rows = rows.withColumns({
        "domain": domain_specificity(src, F.col("pos"), F.col("src_zipf"), F.col("game")),
        "common": common_noun_score(src, tgt, F.col("src_noun"), F.col("tgt_noun"), F.col("src_zipf"), F.col("tgt_zipf"), F.col("generic_embedding")),
    })
    return with_verdicts(checkpointed(rows.drop("sw", "tw")))


REMOVED = ("AUTO_REMOVE", "AUTO_SPLIT_COMPOUND")


def settle_terms(judged: DataFrame, languages: Sequence[str] = ()) -> DataFrame:
    """Adds ``final_action`` and ``final_reasons``: exact pairs among the kept terms
    merge, then whatever breaks the one-to-one constraint among those that are
    left goes.  What the ladder removed keeps its verdict and takes no part.
    """
    from loomline.functions.lineage import checkpointed

    judged = checkpointed(judged)
    kept = judged.where(~F.col("action").isin(*REMOVED))
    merged = merge_pairs(kept.select("term_id", "term_src", "term_tgt", *languages), languages=languages).select("term_id", "term_src", "term_tgt", "pair_action")
    survivors = one_to_one(merged.where("pair_action = 'KEEP'")).select("term_id", "conflict")
    rows = judged.join(merged.select("term_id", "pair_action"), "term_id", "left").join(survivors, "term_id", "left")
    pair, conflict = F.col("pair_action"), F.coalesce("conflict", F.lit(False))
    final = F.when(pair.isin("MERGED_DUPLICATE", "AUTO_REMOVE"), pair).when(conflict, "AUTO_REMOVE").otherwise(F.col("action"))
    why = F.array_compact(F.array(
        F.when(pair == "MERGED_DUPLICATE", F.lit("merged_into_existing_zh_ko_pair")), F.when(pair == "AUTO_REMOVE", F.lit("duplicate_zh_ko_with_target_language_conflict")),
        F.when(conflict, F.lit("strict_zh_ko_bidirectional_conflict")),
    ))
    return rows.withColumns({"final_action": final, "final_reasons": F.concat("reasons", why)}).drop("pair_action", "conflict")
