"""Queries over the verdicts on segments and terms, from first rule to last score, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomline.functions import lexicons as L
from loomline.functions import text as X
from loomline.operators import cleaning, glossary, tagging
from loomline.plans import sqlparts as S
from loomline.plans.corpus import _CJK, _HANGUL, _NORMALIZED, _SCORE_SQL, _count_sql, _segments, _terms

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a query under its function's name, with SQL where there is any."""

    def add(function):
        QUERIES[function.__name__] = function
        if sql:
            SQL[function.__name__] = sql
        return function

    return add


# ---- tuples ----


def _fields_sql(text: str) -> str:
    """Stripped fields of a bracketed CSV record; null for anything else.

    A field that begins with a quote ends at its closing quote; what follows up to
    the comma belongs to it.
    """
    body = f"CASE WHEN left({text}, 1) IN ('{{', '[') AND right({text}, 1) IN ('}}', ']') THEN substr({text}, 2, length({text}) - 2) ELSE {text} END"
    raw = f"""regexp_extract_all({body}, '(?:^|,)("(?:[^"]|"")*(?:"[^,]*)?|[^",][^,]*|)', 1)"""
    quoted = """replace(regexp_extract(f, '^"((?:[^"]|"")*)', 1), '""', '"') || regexp_replace(f, '^"(?:[^"]|"")*"?', '')"""
    fields = f"list_transform({raw}, lambda f: {S.strip(f'CASE WHEN left(f, 1) = chr(34) THEN {quoted} ELSE f END')})"
    return f"CASE WHEN regexp_matches({text}, '{X.TUPLE_LIKE}') AND len({fields}) > 1 THEN {fields} END"


_TUPLES = f"""parsed AS (SELECT segment_id, src, tgt, {_fields_sql('src')} AS a, {_fields_sql('tgt')} AS b FROM norm),
judged AS (SELECT *, a IS NOT NULL OR b IS NOT NULL AS either, coalesce(len(a) = len(b), false) AS even FROM parsed),
item AS (SELECT segment_id, CAST(i AS INTEGER) AS split_index, a[i] AS src, b[i] AS tgt, true AS aligned FROM (SELECT *, unnest(range(1, len(a) + 1)) AS i FROM judged WHERE even)
  UNION ALL SELECT segment_id, 0, src, tgt, NOT either FROM judged WHERE NOT even)"""


@query(f"WITH {S.ALL_SEGMENTS}, {_NORMALIZED}, {_TUPLES} SELECT * FROM item")
def r15_r16_split_tuples(spark: SparkSession, folder: str) -> DataFrame:
    """Aligned tuples as one row for each pair of fields."""
    return cleaning.split_tuples(cleaning.normalize_rows(_segments(spark, folder, "keep")))


# ---- segments ----

_RULES = [
    ("NOT regexp_matches(src || tgt, '[\\x{4E00}-\\x{9FFF}\\x{AC00}-\\x{D7AF}A-Za-z0-9]') AND split_index = 0", "REMOVE_MARKUP_ONLY", "'markup_only_after_normalization'", "SKIP_MARKUP_ONLY"),
    ("NOT aligned", "REMOVE_STRUCTURED_UNPARSED", "'tuple_parse_or_alignment_failed'", "SKIP_STRUCTURED_UNPARSED"),
    ("src = '' OR tgt = ''", "REMOVE_EMPTY", "'empty_after_split'", "SKIP_EMPTY"),
    (f"regexp_matches(tgt, '{_CJK}')", "REMOVE_TARGET_LANGUAGE_CONTAMINATION", "'ko_contains_cjk'", "AUTO_REMOVE_TARGET_LANGUAGE_CONTAMINATION"),
    (f"NOT regexp_matches(tgt, '{_HANGUL}')", "REMOVE_TARGET_LANGUAGE_CONTAMINATION", "'ko_without_hangul'", "AUTO_REMOVE_TARGET_LANGUAGE_CONTAMINATION"),
    (f"regexp_full_match(src, '{_CJK}') AND NOT regexp_matches(src || tgt, '{S.PLACEHOLDER}') AND NOT regexp_matches(src || tgt, '{X.SENTENCE_PUNCTUATION}') AND NOT regexp_matches(tgt, '{X.TUPLE_WRAPPER}')",
     "REMOVE_NON_SEGMENT_FRAGMENT", "'pure_cjk_single_char_fragment'", "AUTO_REMOVE_NON_SEGMENT_FRAGMENT"),
    (f"regexp_matches(src || tgt, '{S.PLACEHOLDER}')", "KEEP", "'placeholder_kept'", "SKIP_PLACEHOLDER"),
    ("exact", "REMOVE_TERM_LIKE", "'exact_glossary_pair'", "AUTO_REMOVE_EXACT_GLOSSARY"),
    ("score >= 0.55", "KEEP", "'sentence_like_kept'", "SKIP_SENTENCE_LIKE"),
    (f"regexp_matches(src, '{X.TUPLE_WRAPPER}') OR regexp_matches(tgt, '{X.TUPLE_WRAPPER}')", "KEEP", "'structured_wrapper_kept_for_review'", "SKIP_STRUCTURE_WRAPPER"),
]
_case = lambda at, rest: "CASE " + " ".join(f"WHEN {r[0]} THEN {r[at] if at == 2 else repr(r[at])}" for r in _RULES) + f" ELSE '{rest}' END"
_SOURCE_WORDS = lambda text: S.source_words(text, L.NOUN_SUFFIXES, tagging.SOURCE_VERB, tagging.SOURCE_TOKEN)
_TARGET_WORDS = lambda text: S.target_words(text, tagging.TARGET_VERB, tagging.TARGET_PARTICLE)
_NOUNS, _UPOS = "list_contains(['NR', 'NP', 'SL', 'SH', 'SN', 'XR'], {0}) OR starts_with({0}, 'NN')", "list_contains(['NOUN', 'PROPN', 'NUM', 'X'], t.upos)"
_VERBS = "list_contains(['VV', 'VA', 'VX', 'VCP', 'VCN', 'EF', 'EC', 'ETM', 'ETN', 'EP'], {0})"
_CLEANED = f"""pairs AS (SELECT DISTINCT term_src, term_tgt FROM term),
scored AS (SELECT item.*, p.term_src IS NOT NULL AS exact, {_SCORE_SQL} AS score FROM item LEFT JOIN pairs p ON item.src = p.term_src AND item.tgt = p.term_tgt),
first_ AS (SELECT *, {_case(1, 'KEEP')} AS action, {_case(2, 'kept')} AS reason, {_case(3, 'PENDING_SEMANTIC')} AS semantic FROM scored),
scored2 AS (SELECT *, CASE WHEN reason = 'placeholder_kept' THEN 1.0 WHEN semantic IN ('SKIP_SENTENCE_LIKE', 'SKIP_STRUCTURE_WRAPPER', 'PENDING_SEMANTIC') THEN score END AS sentence_score FROM first_),
pend AS (SELECT DISTINCT src, tgt FROM first_ WHERE semantic = 'PENDING_SEMANTIC'),
words_ AS (SELECT *, {_SOURCE_WORDS('src')} AS sw, list_filter({_TARGET_WORDS('tgt')}, lambda w: true) AS tw FROM pend),
tags_ AS (SELECT *, list_filter(tw, lambda w: NOT starts_with(w.tag, 'J')) AS mw FROM words_),
vecs_ AS (SELECT *, {S.hashed_vector('src')} AS v FROM tags_),
tvec AS (SELECT {S.hashed_vector('term_src')} AS t FROM (SELECT DISTINCT term_src FROM term)),
svec AS (SELECT {S.hashed_vector('w')} AS t FROM (SELECT unnest({S.words(L.ENTITY_SEEDS)}) AS w)),
near_ AS (SELECT p.src, p.tgt, max(list_dot_product(p.v, t.t)) AS g FROM vecs_ p, tvec t GROUP BY ALL),
like_ AS (SELECT p.src, p.tgt, max(list_dot_product(p.v, s.t)) AS s FROM vecs_ p, svec s GROUP BY ALL),
nouns_ AS (SELECT src, tgt, least(
  greatest(0.0, least(1.0, 0.15 + 0.45 * {S.share('sw', "list_contains(['eng', 'x'], t.flag) OR starts_with(t.flag, 'n')")} + 0.40 * {S.share('sw', _UPOS)}
    - CASE WHEN NOT regexp_matches(src, '{_CJK}') AND NOT regexp_matches(src, '[A-Za-z]') THEN 0.35 ELSE 0.0 END + CASE WHEN regexp_matches(src, '[A-Za-z0-9]') THEN 0.08 ELSE 0.0 END)),
  greatest(0.0, least(1.0, 0.15 + 0.45 * {S.share('mw', _NOUNS.format('t.tag'))} + 0.35 * {S.share('tw', _UPOS)}
    + CASE WHEN {_NOUNS.format('mw[-1].tag')} THEN 0.10 ELSE 0.0 END - CASE WHEN {_VERBS.format('mw[-1].tag')} THEN 0.25 ELSE 0.0 END))) AS noun FROM vecs_),
sims AS (SELECT n.src, n.tgt, n.noun, g.g, CASE WHEN list_contains({S.words(L.ENTITY_SEEDS)}, n.src) THEN 1.0 ELSE l.s END AS s FROM nouns_ n JOIN near_ g USING (src, tgt) JOIN like_ l USING (src, tgt)),
joined_ AS (SELECT f.*, m.noun, m.g, m.s, CASE WHEN m.noun IS NOT NULL THEN greatest(0.0, least(1.0, 0.38 * m.noun + 0.30 * m.g + 0.27 * m.s - 0.25 * f.sentence_score)) END AS total
  FROM scored2 f LEFT JOIN sims m ON f.semantic = 'PENDING_SEMANTIC' AND f.src = m.src AND f.tgt = m.tgt),
cleaned AS (SELECT segment_id, split_index, src, tgt, CASE WHEN removed THEN 'REMOVE_TERM_LIKE' ELSE action END AS action,
  CASE WHEN removed THEN 'semantic_term_entity_like' WHEN doubt THEN 'semantic_term_entity_review' ELSE reason END AS reason,
  CASE WHEN removed THEN 'AUTO_REMOVE_SEMANTIC_TERM_ENTITY' WHEN doubt THEN 'REVIEW_SEMANTIC_TERM_ENTITY' WHEN semantic = 'PENDING_SEMANTIC' THEN 'KEEP_SEMANTIC_SEGMENT' ELSE semantic END AS semantic_action,
  sentence_score, noun, g, s, total FROM (SELECT *, coalesce(total >= 0.68 AND noun >= 0.55 AND (g >= 0.70 OR s >= 0.72), false) AS removed, coalesce(total >= 0.56 AND noun >= 0.55, false) AS doubt FROM joined_))"""
_CLEAN_ALL = f"{S.ALL_SEGMENTS}, {S.TERMS}, {_NORMALIZED}, {_TUPLES}, {_CLEANED}"


def _cleaned(spark: SparkSession, folder: str) -> DataFrame:
    return cleaning.clean_segments(_segments(spark, folder, "keep"), _terms(spark, folder))


@query(f"""WITH {_CLEAN_ALL} SELECT segment_id, split_index, src, tgt, action, reason, semantic_action, round(sentence_score, 4) AS sentence_score, round(noun, 4) AS noun_score,
  round(g, 4) AS glossary_similarity, round(s, 4) AS seed_similarity, round(total, 4) AS semantic_score FROM cleaned""")
def r18_r19_clean_segments(spark, folder):
    """The whole cleaning stage: every row or tuple field with its verdict, scores included."""
    rounded = ("sentence_score", "noun_score", "glossary_similarity", "seed_similarity", "semantic_score")
    return _cleaned(spark, folder).withColumns({c: F.round(c, 4) for c in rounded})


@query(f"WITH {_CLEAN_ALL} SELECT action, reason, semantic_action, count(*) AS rows FROM cleaned GROUP BY ALL")
def a17_cleaning_summary(spark, folder):
    """Rows by verdict and reason."""
    return _cleaned(spark, folder).groupBy("action", "reason", "semantic_action").agg(F.count("*").alias("rows"))


@query(f"""WITH {_CLEAN_ALL} SELECT segment_id, split_index, round(noun, 4) AS noun_score, round(g, 4) AS glossary_similarity, round(s, 4) AS seed_similarity, round(total, 4) AS semantic_score, semantic_action
FROM cleaned WHERE total IS NOT NULL""")
def g7_g9_g25_entity_rows(spark, folder):
    """Rows that no rule settles, with noun scores, similarities and the verdict on them."""
    rows = _cleaned(spark, folder).where("semantic_score is not null")
    return rows.select("segment_id", "split_index", *(F.round(c, 4).alias(c) for c in ("noun_score", "glossary_similarity", "seed_similarity", "semantic_score")), "semantic_action")


# ---- terms ----

_add = lambda test, value: f"CASE WHEN {test} THEN {value} ELSE 0.0 END"
_rx = lambda column, pattern: f"regexp_matches({column}, '{pattern}')"
_ANCHOR = f"({S.any_in('src', L.GAME_ANCHORS)} OR {S.any_in('upper(src)', L.GAME_ANCHORS)})"
_ACRONYM, _SIGNAL, _SUFFIX = f"list_contains({S.words(L.ACRONYMS)}, upper(src))", _rx("src", glossary.ASCII_SIGNAL), S.any_in("src", L.NOUN_SUFFIXES, "ends_with")
_MARKER, _END = S.any_in("src", L.PHRASE_MARKERS), _rx("tgt", glossary.TARGET_END)
_NON_NOUN, _PROPER = _rx("pos", glossary.NON_NOUN_ROOT), _rx("pos", glossary.PROPER)
_HARD = [
    ("tgt = ''", "missing_ko_for_zh_ko_glossary"), (f"{_rx('src', glossary.PLACEHOLDER)} OR {_rx('tgt', glossary.PLACEHOLDER)}", "placeholder_or_square_bracket_markup"),
    (_rx("src", glossary.BOOK_TITLE), "book_or_test_title_markup"), (_rx("src", glossary.PAREN_PREFIX), "parenthetical_modifier_fragment"), (_rx("src", glossary.SENTENCE_PUNCT), "sentence_punctuation"),
    (f"list_contains({S.words(L.NONTERM_EXACT)}, src)", "standalone_ui_action_or_fragment"), (_rx("src", glossary.NUMERIC), "standalone_numeric_or_signed_token"), (_rx("src", _HANGUL), "zh_column_contains_hangul"),
    (f"NOT {_rx('src', _CJK)} AND NOT {_ACRONYM}", "zh_column_has_no_chinese_content"), (_rx("src", glossary.STATUS), "ui_or_status_sentence_fragment"),
    (f"general >= 0.8 AND game < 0.65 AND NOT {_SIGNAL}", "common_word_without_game_term_signal"),
    (f"common >= 0.8 AND domain < 0.65 AND NOT {_ANCHOR} AND NOT {_ACRONYM} AND NOT {_SIGNAL}", "common_noun_without_domain_signal"), ("product_score = 0.0", "not_in_segments_redundant_for_current_corpus"),
]
_LOW = f"(tgt <> '' AND bilingual < 0.3 AND product_score = 0.0 AND (src_noun + tgt_noun) / 2 < 0.45 AND NOT ({_SIGNAL} OR {_rx('src', '[【】]')}))"
_PHRASE = [
    (S.any_in("src", L.UI_STARTS, "starts_with"), "ui_or_sentence_start"), (_rx("src", glossary.SOURCE_END), "zh_sentence_particle_end"), (f"tgt <> '' AND {_END}", "ko_sentence_or_verb_end"),
    (f"{_MARKER} AND NOT {_SUFFIX}", "phrase_marker_without_noun_suffix"), (f"length(src) >= 9 AND ({_MARKER} OR (tgt <> '' AND {_END}))", "long_sentence_like"), (_LOW, "low_embedding_similarity_without_product_or_noun_signal"),
]
_names = lambda checks: "list_filter([" + ", ".join(f"CASE WHEN {test} THEN '{name}' END" for test, name in checks) + "], lambda x: x IS NOT NULL)"
_seed = lambda words: f"(SELECT list_transform(m, lambda x: x / greatest(sqrt(list_dot_product(m, m)), 1e-9)) FROM (SELECT list(a ORDER BY i) AS m FROM (SELECT i, avg(x) AS a FROM (SELECT unnest(v) AS x, unnest(range(64)) AS i FROM (SELECT {S.hashed_vector('w')} AS v FROM (SELECT unnest({S.words(words)}) AS w))) GROUP BY i)))"
_FAMILIES = f"""sf AS (SELECT * FROM (SELECT unnest({S.words(L.COMPOUND_SUFFIXES)}) AS s)),
cs AS (SELECT t.term_id, arg_max(sf.s, length(sf.s)) AS suffix FROM term t JOIN sf ON ends_with(t.term_src, sf.s) AND length(t.term_src) > length(sf.s) + 1 GROUP BY t.term_id),
st9 AS (SELECT t.term_id, t.term_src, left(t.term_src, length(t.term_src) - length(cs.suffix)) AS stem, cs.suffix FROM term t JOIN cs USING (term_id)),
fam AS (SELECT stem, count(DISTINCT suffix) AS family FROM st9 WHERE NOT regexp_matches(term_src, '{glossary.BLOCKERS}') GROUP BY stem)"""
_TERM_SCORES = f"""{_FAMILIES}, a9 AS {_count_sql('src', 'term_src')}, b9 AS {_count_sql('tgt', 'term_tgt')},
ac AS (SELECT unnest({S.words(L.ACRONYMS)}) AS a), live AS (SELECT a FROM ac WHERE EXISTS (SELECT 1 FROM seg WHERE contains(upper(src), a)) AND EXISTS (SELECT 1 FROM seg WHERE contains(upper(tgt), a))),
chars9 AS (SELECT sum(length(src)) AS s, sum(length(tgt)) AS t FROM seg),
e9 AS (SELECT t.term_id, t.term_src AS src, t.term_tgt AS tgt, coalesce(a9.k, 0) AS sc, coalesce(b9.k, 0) AS tc, coalesce(st9.stem, '') AS stem, coalesce(fam.family, 0) AS family,
  EXISTS (SELECT 1 FROM live WHERE contains(upper(t.term_src), live.a) AND contains(upper(t.term_tgt), live.a)) AS fb
  FROM term t LEFT JOIN a9 USING (term_id) LEFT JOIN b9 USING (term_id) LEFT JOIN st9 USING (term_id) LEFT JOIN fam ON fam.stem = st9.stem),
z9 AS (SELECT e9.*, greatest(CASE WHEN sc > 0 AND tc > 0 THEN 1.0 WHEN sc > 0 OR tc > 0 THEN 0.55 ELSE 0.0 END, CASE WHEN fb THEN 0.75 ELSE 0.0 END) AS product_score,
  CASE WHEN sc > 0 THEN log10(sc / chars9.s * 1e9) ELSE -1 END AS src_zipf,
  coalesce(log10(max(CASE WHEN tc > 0 THEN tc END) OVER (PARTITION BY tgt) / chars9.t * 1e9), -1) AS tgt_zipf FROM e9, chars9),
w9 AS (SELECT *, {_SOURCE_WORDS('src')} AS sw, {_TARGET_WORDS('tgt')} AS tw FROM z9),
v9 AS (SELECT *, list_filter(tw, lambda w: NOT starts_with(w.tag, 'J')) AS mw, {S.hashed_vector('src')} AS sv, {S.hashed_vector('tgt')} AS tv, coalesce(sw[-1].upos, '') AS root FROM w9),
n9 AS (SELECT *, list_dot_product(sv, {_seed(L.GAME_TERM_SEEDS)}) AS game_embedding, list_dot_product(sv, {_seed(L.COMMON_NOUN_SEEDS)}) AS generic, CASE WHEN tgt = '' THEN 0.0 ELSE list_dot_product(sv, tv) END AS bilingual,
  array_to_string(list_transform(sw[1:10], lambda w, i: w.word || '/' || w.upos || '/' || CASE WHEN i = len(sw) THEN 'root' ELSE 'dep' END), ' ') AS pos,
  CASE WHEN src = '' THEN 0.0 ELSE greatest(0.0, least(1.0, 0.22 + 0.28 * {S.share('sw', "list_contains(['eng', 'x', 'm'], t.flag) OR starts_with(t.flag, 'n')")} + 0.35 * {S.share('sw', _UPOS)}
    + {_add("root IN ('NOUN', 'PROPN')", 0.18)} - {_add("root IN ('VERB', 'AUX', 'ADJ')", 0.25)} + {_add('length(src) BETWEEN 2 AND 6', 0.08)} + {_add(_SUFFIX, 0.15)} + {_add(_SIGNAL, 0.05)}
    - {_add(f"{_rx('src', glossary.SENTENCE_PUNCT)} OR {_rx('src', glossary.SOURCE_END)}", 0.45)} - {_add(f'{_MARKER} AND NOT {_SUFFIX}', 0.35)}
    - {_add(f"{_rx('src', glossary.BOOK_TITLE)} OR {_rx('src', glossary.PAREN_PREFIX)} OR {_rx('src', glossary.PLACEHOLDER)}", 0.35)})) END AS src_noun,
  CASE WHEN tgt = '' THEN 0.0 ELSE greatest(0.0, least(1.0, 0.22 + 0.33 * {S.share('mw', _NOUNS.format('t.tag'))} + 0.30 * {S.share('tw', _UPOS)} + {_add(_NOUNS.format('mw[-1].tag'), 0.12)}
    - {_add(_VERBS.format('mw[-1].tag'), 0.40)} - {_add(_END, 0.45)} - {_add(_rx('tgt', '[?!。！？]'), 0.30)})) END AS tgt_noun FROM v9),
g9 AS (SELECT *, greatest({_add(_ACRONYM, 1.0)}, {_add(_ANCHOR, 0.9)}, {_add(_SUFFIX, 0.65)}, {_add('game_embedding >= 0.72', 0.6)}, {_add(_SIGNAL, 0.45)}, {_add(S.any_in('tgt', L.KO_GAME_TOKENS), 0.75)}) AS game,
  CASE WHEN list_contains({S.words(L.GENERAL_WORDS_ZH)}, src) OR list_contains({S.words(L.GENERAL_WORDS_KO)}, tgt) THEN 1.0 WHEN {_NON_NOUN} AND length(src) <= 4 THEN 0.8 ELSE 0.0 END AS general FROM n9),
s9 AS (SELECT *, least(1.0, greatest(game, {_add(f'{_ACRONYM} OR {_ANCHOR}', 0.95)}, {_add(f'{_PROPER} AND (src_zipf < 3.8 OR length(src) >= 3)', 0.7)}, {_add(_SIGNAL, 0.55)})) AS domain,
  greatest({_add(f'list_contains({S.words(L.COMMON_NOUNS_ZH)}, src) OR list_contains({S.words(L.COMMON_NOUNS_KO)}, tgt)', 1.0)},
    CASE WHEN nn AND length(src) <= 4 AND src_zipf >= 4.2 THEN 0.85 WHEN nn AND length(src) <= 4 AND src_zipf >= 3.8 THEN 0.75 ELSE 0.0 END,
    CASE WHEN nn AND generic >= 0.78 THEN 0.85 WHEN nn AND generic >= 0.74 AND src_zipf >= 3.2 THEN 0.80 ELSE 0.0 END, {_add('tgt_zipf >= 4.0 AND nn', 0.75)}) AS common
  FROM (SELECT *, src_noun >= 0.75 AND tgt_noun >= 0.75 AS nn FROM g9)),
h9 AS (SELECT *, {_names(_HARD)} AS hard, {_names(_PHRASE)} AS phrase, {_LOW} AS low, (src_noun + tgt_noun) / 2 AS noun, 0.45 * ((src_noun + tgt_noun) / 2) + 0.35 * greatest(0.0, bilingual) + 0.20 * game AS raw,
  stem <> '' AND family >= 3 AND length(stem) >= 2 AND NOT regexp_matches(src, '{glossary.BLOCKERS}') AS compound FROM s9),
k9 AS (SELECT *, low OR len(phrase) >= 2 OR (len(phrase) > 0 AND noun < 0.45) AS gone, raw >= 0.55 AND noun >= 0.45 AS good FROM h9),
ladder AS (SELECT *, CASE WHEN len(hard) > 0 THEN 'AUTO_REMOVE' WHEN compound THEN 'AUTO_SPLIT_COMPOUND' WHEN gone THEN 'AUTO_REMOVE' WHEN good THEN 'AUTO_KEEP' ELSE 'KEEP_UNCERTAIN' END AS action,
  CASE WHEN len(hard) > 0 THEN list_concat(hard, phrase) WHEN compound THEN list_concat(['compound_family_suffix'], phrase) WHEN gone THEN phrase WHEN len(phrase) > 0 THEN phrase
    WHEN good THEN ['termhood_semantic_supported'] ELSE ['weak_termhood_or_mid_semantic_confidence'] END AS reasons, greatest(0.0, least(1.0, raw)) AS term_score FROM k9)"""
_JUDGED = f"{S.ALL_SEGMENTS}, {S.TERMS}, {_TERM_SCORES}"


def _judged(spark: SparkSession, folder: str) -> DataFrame:
    return glossary.judge_terms(_terms(spark, folder), _segments(spark, folder, "keep"))


_SCORES = {"bilingual": "bilingual", "game_embedding": "game_embedding", "generic_embedding": "generic", "src_zipf": "src_zipf", "tgt_zipf": "tgt_zipf", "src_noun": "src_noun", "tgt_noun": "tgt_noun",
           "game": "game", "general": "general", "common": "common", "domain": "domain"}


@query(f"WITH {_JUDGED} SELECT term_id, pos, {', '.join(f'round(CAST({c} AS DOUBLE), 4) AS {name}' for name, c in _SCORES.items())} FROM ladder")
def g5_g16_term_scores(spark, folder):
    """Noun scores, cosines, frequencies and domain scores of every term."""
    return _judged(spark, folder).select("term_id", "pos", *(F.round(F.col(c).cast("double"), 4).alias(c) for c in _SCORES))


@query(f"WITH {_JUDGED} SELECT term_id, action, array_to_string(reasons, ';') AS reasons, round(term_score, 6) AS term_score FROM ladder")
def g10_g19_term_verdicts(spark, folder):
    """Verdict and reasons of every glossary term."""
    return _judged(spark, folder).select("term_id", "action", F.array_join("reasons", ";").alias("reasons"), F.round("term_score", 6).alias("term_score"))


@query(f"""WITH {_JUDGED} SELECT term_id, 'common_word' AS kind FROM ladder WHERE action <> 'AUTO_REMOVE' AND general >= 0.8 AND game < 0.8
  UNION ALL SELECT term_id, 'common_noun' FROM ladder WHERE action <> 'AUTO_REMOVE' AND common >= 0.7 AND domain < 0.75""")
def g22_review_terms(spark, folder):
    """Kept terms that look general or ordinary."""
    return glossary.review_terms(_judged(spark, folder))


@query(f"""WITH {_JUDGED}, ok AS (SELECT * FROM ladder WHERE action NOT IN ('AUTO_REMOVE', 'AUTO_SPLIT_COMPOUND')), m9 AS (SELECT term_id, src, tgt, row_number() OVER (PARTITION BY src, tgt ORDER BY term_id) AS rn FROM ok),
left9 AS (SELECT * FROM m9 WHERE rn = 1), bs AS (SELECT src, count(DISTINCT tgt) AS k FROM left9 GROUP BY 1), bt AS (SELECT tgt, count(DISTINCT src) AS k FROM left9 GROUP BY 1),
c9 AS (SELECT term_id, bs.k > 1 OR bt.k > 1 AS conflict FROM left9 JOIN bs USING (src) JOIN bt USING (tgt))
SELECT l.term_id, CASE WHEN m9.rn > 1 THEN 'MERGED_DUPLICATE' WHEN c9.conflict THEN 'AUTO_REMOVE' ELSE l.action END AS action,
  array_to_string(list_concat(l.reasons, CASE WHEN m9.rn > 1 THEN ['merged_into_existing_zh_ko_pair'] WHEN c9.conflict THEN ['strict_zh_ko_bidirectional_conflict'] ELSE [] END), ';') AS reasons
FROM ladder l LEFT JOIN m9 USING (term_id) LEFT JOIN c9 USING (term_id)""")
def g20_g21_settled_terms(spark, folder):
    """The glossary pipeline to its end: verdicts, merged pairs and the one-to-one constraint over the survivors."""
    return glossary.settle_terms(_judged(spark, folder)).select("term_id", F.col("final_action").alias("action"), F.array_join("final_reasons", ";").alias("reasons"))


@query(f"""WITH {_JUDGED} SELECT action, count(*) AS terms, round(avg(term_score), 6) AS mean_score FROM ladder GROUP BY action""")
def a17_glossary_summary(spark, folder):
    """Terms by verdict, with their mean score."""
    return _judged(spark, folder).groupBy("action").agg(F.count("*").alias("terms"), F.round(F.avg("term_score"), 6).alias("mean_score"))
