"""Queries over segments, glossary and translations, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomline.functions import lexicons as L
from loomline.functions import text as X
from loomline.operators import cleaning, crossclean, glossary, matching, metrics
from loomline.plans import sqlparts as S
from loomline.sources import pairs as scans
from loomline.sources.tables import table

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


def _segments(spark: SparkSession, folder: str, on_empty: str = "drop") -> DataFrame:
    return scans.segments(table(spark, folder, "segments", ["segment_id", "zh-CN", "ko"], spread=True), on_empty)


def _terms(spark: SparkSession, folder: str) -> DataFrame:
    return scans.terms(table(spark, folder, "glossary", ["term_id", "zh-CN", "ko"]))


def _translations(spark: SparkSession, folder: str) -> DataFrame:
    return scans.translation_rows(table(spark, folder, "evaluation_translation_result", ["row_number", "segment_id", "source", "references", "candidates", "system"], spread=True))


def _scored(spark: SparkSession, folder: str) -> DataFrame:
    """Rows to score: translations, the rewrites of decisions (numbered below zero), and
    the corpus as a translation of itself (numbered above a billion), whose sources
    hold terms that targets preserve or not."""
    rows = scans.segments(table(spark, folder, "segments", ["segment_id", "zh-CN", "ko"], spread=True), "keep")
    decisions = table(spark, folder, "decisions", ["decision_id", "segment_id", "corrected_ko", "model"]).where(X.strip(F.col("corrected_ko")) != "")
    rewrites = decisions.join(rows, "segment_id").select(
        (-F.col("decision_id")).alias("row_number"), "segment_id", F.col("src").alias("source"), F.col("tgt").alias("reference"), X.strip(F.col("corrected_ko")).alias("candidate"), F.col("model").alias("system")
    )
    own = rows.select(
        (F.lit(1_000_000_000) + F.expr("try_cast(segment_id as bigint)")).alias("row_number"), "segment_id", F.col("src").alias("source"), F.col("tgt").alias("reference"),
        F.col("tgt").alias("candidate"), F.lit("corpus").alias("system"),
    )
    return _translations(spark, folder).unionByName(rewrites).unionByName(own)


# ---- scans ----


@query(f"WITH {S.SEGMENTS} SELECT segment_id, src, tgt FROM seg")
def s3_segment_scan(spark, folder):
    """Segments, stripped, rows with an empty field left out."""
    return _segments(spark, folder)


@query(f"WITH {S.TERMS} SELECT term_id, term_src, term_tgt, n, CAST(rk AS INTEGER) AS rank FROM term")
def s13_terms_longest_first(spark, folder):
    """Glossary terms with their rank, long ones first."""
    return matching.ranked(_terms(spark, folder))


@query(f"WITH {S.TERMS} SELECT DISTINCT term_src, term_tgt FROM term")
def s5_distinct_pairs(spark, folder):
    """Distinct glossary pairs."""
    return scans.distinct_pairs(_terms(spark, folder))


@query(f"WITH {S.TRANSLATIONS} SELECT * FROM tr")
def s12_translation_scan(spark, folder):
    """Translation rows; empty candidates stay."""
    return _translations(spark, folder)


@query(f"""SELECT CASE WHEN CAST(term_id AS BIGINT) % 10 = 0 THEN CAST(row_number() OVER (ORDER BY term_id) AS VARCHAR) ELSE {S.strip('term_id')} END AS term_id, {S.strip('"zh-CN"')} AS "zh-CN", {S.strip('ko')} AS ko, '' AS en FROM glossary""")
def s6_multilingual_terms(spark, folder):
    """The glossary with a language that it lacks; every tenth term has lost its id and gets its row's number."""
    rows = table(spark, folder, "glossary", ["term_id", "zh-CN", "ko"]).withColumn("row", F.col("term_id"))
    lost = rows.withColumn("term_id", F.when(F.col("term_id").cast("long") % 10 != 0, F.col("term_id")))
    return scans.multilingual_terms(lost, ["zh-CN", "ko", "en"], "row")


@query(f"SELECT {S.strip('segment_id')} AS segment_id, {S.strip('source_text')} AS src, {S.strip('target_text')} AS tgt FROM training_examples WHERE {S.strip('source_text')} <> '' AND {S.strip('target_text')} <> ''")
def s8_s10_training_scan(spark, folder):
    """Training examples under the corpus's names; rows with an empty field are taken out first, as one would fail the query."""
    rows = table(spark, folder, "training_examples", ["segment_id", "source_text", "target_text"])
    filled = rows.where((X.strip(F.col("source_text")) != "") & (X.strip(F.col("target_text")) != ""))
    return scans.training_pairs(scans.require_rows(filled, "training_examples"))


@query(f"SELECT {S.strip('segment_id')} AS segment_id, {S.strip('zh')} AS source, {S.strip('ko')} AS \"references\" FROM segment_rows WHERE split = 'test'")
def s11_split_scan(spark, folder):
    """Records of the test split to translate."""
    return scans.split_records(table(spark, folder, "segment_rows", ["segment_id", "zh", "ko", "split"]), "test")


# ---- row-level predicates and normalisers ----

_CJK, _HANGUL = r"[\x{4E00}-\x{9FFF}]", r"[\x{AC00}-\x{D7AF}]"


@query(f"""WITH {S.ALL_SEGMENTS} SELECT segment_id, regexp_matches(src, '{_CJK}') AS src_cjk, regexp_matches(tgt, '{_HANGUL}') AS tgt_hangul,
  regexp_matches(src || tgt, '[\\x{{4E00}}-\\x{{9FFF}}\\x{{AC00}}-\\x{{D7AF}}A-Za-z0-9]') AS meaning,
  CASE WHEN regexp_full_match(src, '{_CJK}+') THEN length(src) ELSE 0 END AS pure_length, length(regexp_replace(src, '[^\\x{{4E00}}-\\x{{9FFF}}]', '', 'g')) AS src_length,
  CASE WHEN regexp_matches(tgt, '{_CJK}') THEN 'ko_contains_cjk' WHEN tgt <> '' AND NOT regexp_matches(tgt, '{_HANGUL}') THEN 'ko_without_hangul' ELSE '' END AS contamination,
  regexp_matches(tgt, '[\\x{{3400}}-\\x{{9FFF}}]') OR (tgt <> '' AND NOT regexp_matches(tgt, '[\\x{{AC00}}-\\x{{D7A3}}]')) AS contaminated,
  length({S.no_space('tgt')}) AS bare_length FROM seg""")
def r1_r7_script_predicates(spark, folder):
    """Script tests, lengths and target contamination of every segment."""
    src, tgt = F.col("src"), F.col("tgt")
    return _segments(spark, folder, "keep").select(
        "segment_id", X.has_source(src).alias("src_cjk"), X.has_target(tgt).alias("tgt_hangul"), X.has_meaning(F.concat(src, tgt)).alias("meaning"),
        X.pure_source_length(src).alias("pure_length"), X.source_length(src).alias("src_length"), X.contamination(tgt).alias("contamination"),
        X.is_contaminated(tgt).alias("contaminated"), F.length(X.no_space(tgt)).alias("bare_length"),
    )


@query(f"""WITH {S.ALL_SEGMENTS}, {S.TERMS}, both_ AS (SELECT segment_id AS id, src, tgt FROM seg UNION ALL SELECT 'head of ' || term_id, left(term_src, 1), left(term_tgt, 1) FROM term)
SELECT id FROM both_ WHERE regexp_full_match(src, '{_CJK}') AND NOT regexp_matches(src || tgt, '{S.PLACEHOLDER}')
  AND NOT regexp_matches(src || tgt, '[。！？!?；;]') AND NOT regexp_matches(tgt, '^\\s*[\\{{\\[].*[\\}}\\]]\\s*$')""")
def r8_fragments(spark, folder):
    """Single-character fragments among the segments and the heads of all terms."""
    heads = _terms(spark, folder).select(F.concat(F.lit("head of "), "term_id").alias("id"), F.substring("term_src", 1, 1).alias("src"), F.substring("term_tgt", 1, 1).alias("tgt"))
    rows = _segments(spark, folder, "keep").withColumnRenamed("segment_id", "id").unionByName(heads)
    return rows.where(X.is_fragment(F.col("src"), F.col("tgt"))).select("id")


def _placeholder_sql(column: str) -> str:
    return f"array_to_string(list_sort(list_distinct(regexp_extract_all({column}, '{S.PLACEHOLDER}'))), ';')"


@query(f"""WITH {S.ALL_SEGMENTS} SELECT * FROM (SELECT segment_id, {_placeholder_sql('src')} AS src_placeholders, {_placeholder_sql('tgt')} AS tgt_placeholders FROM seg)
  WHERE src_placeholders <> tgt_placeholders""")
def r10_placeholder_mismatches(spark, folder):
    """Segments whose two sides hold different placeholders."""
    return cleaning.placeholder_mismatches(_segments(spark, folder, "keep"))


def _untagged_sql(text: str) -> str:
    steps = [(X.PRESENTATION_TAG, " "), (r"[ \t]+", " "), (r" ?\\n ?", r"\\n"), (r" ([,，.。!?！？;；:：）)\]}])", r"\1"), (r"([（(\[{]) ", r"\1")]
    steps += [(r"([\x{4E00}-\x{9FFF}]) ([\x{4E00}-\x{9FFF}])", r"\1\2")] * 2
    for pattern, by in steps:
        text = f"regexp_replace({text}, '{pattern}', '{by}', 'g')"
    return S.strip(text)


def _wrapper_sql(column: str, part: str) -> str:
    cases = " ".join(
        f"WHEN regexp_matches({column}, '{pattern}') THEN " + (f"'{name}'" if part == "name" else S.strip(f"regexp_extract({column}, '{pattern}', 1)")) for name, pattern in X.WRAPPERS
    )
    return f"CASE {cases} END"


_UNKNOWN = "array_to_string(list_filter(regexp_extract_all({0}, '" + X.ANGLE_TAG + "'), lambda t: NOT regexp_matches(t, '" + X.KNOWN_TAG.replace("{", "{{").replace("}", "}}") + "')), ';')"
_NORMALIZED = f"""tagged AS (SELECT *, len(regexp_extract_all(src, '{X.PRESENTATION_TAG}')) AS src_tags, len(regexp_extract_all(tgt, '{X.PRESENTATION_TAG}')) AS tgt_tags,
  {_UNKNOWN.format('src')} AS src_unknown, {_UNKNOWN.format('tgt')} AS tgt_unknown FROM seg),
bare AS (SELECT * REPLACE (CASE WHEN src_tags + tgt_tags > 0 THEN {_untagged_sql('src')} ELSE src END AS src, CASE WHEN src_tags + tgt_tags > 0 THEN {_untagged_sql('tgt')} ELSE tgt END AS tgt) FROM tagged),
wrapped AS (SELECT *, {_wrapper_sql('src', 'name')} AS sn, {_wrapper_sql('tgt', 'name')} AS tn, {_wrapper_sql('src', 'inner')} AS si, {_wrapper_sql('tgt', 'inner')} AS ti FROM bare),
norm AS (SELECT segment_id, CASE WHEN sn = tn THEN si ELSE src END AS src, CASE WHEN sn = tn THEN ti ELSE tgt END AS tgt, CAST(src_tags AS INTEGER) AS src_tags, CAST(tgt_tags AS INTEGER) AS tgt_tags, src_unknown, tgt_unknown,
  CASE WHEN sn = tn THEN sn END AS unwrapped, (src_tags > 0) <> (tgt_tags > 0) OR src_unknown <> '' OR tgt_unknown <> '' AS markup, (sn IS NULL) <> (tn IS NULL) AS one_side FROM wrapped)"""


@query(f"""WITH {S.ALL_SEGMENTS}, {_NORMALIZED} SELECT segment_id, src, tgt, src_tags, tgt_tags, src_unknown, tgt_unknown, unwrapped,
  concat_ws(';', CASE WHEN markup THEN 'presentation_tag_one_side_or_unknown_angle' END, CASE WHEN one_side THEN 'wrapper_one_side' END) AS mismatches FROM norm""")
def r14_normalized_rows(spark, folder):
    """Segments without tags and shared wrappers, with what was found."""
    return cleaning.normalize_rows(_segments(spark, folder, "keep")).withColumn("mismatches", F.array_join("mismatches", ";"))


@query(f"""WITH {S.ALL_SEGMENTS}, {_NORMALIZED} SELECT segment_id, 'presentation_tag_one_side_or_unknown_angle' AS mismatch_type, src_unknown, tgt_unknown FROM norm WHERE markup
  UNION ALL SELECT segment_id, 'wrapper_one_side', '', '' FROM norm WHERE one_side""")
def r14_markup_mismatches(spark, folder):
    """One-sided or unknown markup."""
    return cleaning.markup_mismatches(cleaning.normalize_rows(_segments(spark, folder, "keep")))


_SCORE_SQL = f"""least(1.0, CAST(CASE WHEN regexp_matches(src || chr(10) || tgt, '{S.PLACEHOLDER}') THEN 1.0 ELSE 0.0 END AS DOUBLE)
  + CASE WHEN regexp_matches(src || chr(10) || tgt, '[。！？!?；;]') THEN 0.45 ELSE 0.0 END + CASE WHEN regexp_matches(src, '{X.SOURCE_SENTENCE_END}') THEN 0.35 ELSE 0.0 END
  + CASE WHEN regexp_matches(tgt, '{X.TARGET_SENTENCE_END}') THEN 0.35 ELSE 0.0 END + CASE WHEN {S.any_in('src', L.SENTENCE_MARKERS)} THEN 0.45 ELSE 0.0 END)"""


@query(f"WITH {S.ALL_SEGMENTS} SELECT segment_id, round({_SCORE_SQL}, 6) AS score FROM seg")
def r17_sentence_score(spark, folder):
    """How much each segment looks like a sentence."""
    return _segments(spark, folder, "keep").select("segment_id", F.round(X.sentence_score(F.col("src"), F.col("tgt"), L.SENTENCE_MARKERS), 6).alias("score"))


@query(f"WITH {S.TRANSLATIONS} SELECT row_number, {S.strip_markers('candidate')} AS visible, {S.no_space('candidate')} AS bare FROM tr")
def r23_r24_visible_text(spark, folder):
    """Candidates without term markers, and without blanks."""
    return _translations(spark, folder).select("row_number", X.strip_markers(F.col("candidate")).alias("visible"), X.no_space(F.col("candidate")).alias("bare"))


# ---- dictionary matching ----


@query(f"WITH {S.SEGMENTS}, {S.TERMS}, {S.MATCHES} SELECT segment_id, CAST(start AS INTEGER) AS start, CAST(\"end\" AS INTEGER) AS \"end\", term_id, preserved FROM each_match")
def m1_term_matches(spark, folder):
    """Accepted term occurrences of every segment."""
    found = matching.find_matches(_segments(spark, folder), _terms(spark, folder))
    return found.select("segment_id", F.explode_outer("matches").alias("m")).where("m is not null").select("segment_id", "m.*")


_SPAN = "STRUCT(p BIGINT, n BIGINT)[]"
_SPLICE = """list_reduce(list_transform({0}, lambda x: {{'p': x.p, 'n': x.n, 'out': ''}}), lambda acc, x: {{'p': x.p + x.n, 'n': CAST(0 AS BIGINT),
  'out': acc.out || substr({1}, acc.p, x.p - acc.p) || '<start>' || substr({1}, x.p, x.n) || '<end>'}}, {{'p': CAST(1 AS BIGINT), 'n': CAST(0 AS BIGINT), 'out': ''}})"""


def _thin_sql(places: str, size: str) -> str:
    whole = f"list_transform({places}, lambda q: CAST(q AS BIGINT))"
    return f"list_reduce({whole}, lambda acc, q: CASE WHEN len(acc) = 0 OR q >= acc[len(acc)] + {size} THEN list_append(acc, q) ELSE acc END, CAST([] AS BIGINT[]))"


def _free_sql(places: str, taken: str, size: str) -> str:
    return f"list_filter({places}, lambda q: len(list_filter({taken}, lambda o: q < o.p + o.n AND o.p < q + {size})) = 0)"


_BOTH = f"""cand6 AS (SELECT s.segment_id, t.rk, t.n, length(t.term_tgt) AS m, {S.places('s.src', 't.term_src', 't.n')} AS aps, {S.places('s.tgt', 't.term_tgt', 'length(t.term_tgt)')} AS aqs
  FROM seg s JOIN term t ON contains(s.src, t.term_src) AND contains(s.tgt, t.term_tgt)),
thin6 AS (SELECT segment_id, rk, n, m, {_thin_sql('aps', 'n')} AS ps, {_thin_sql('aqs', 'm')} AS qs FROM cand6),
g6 AS (SELECT segment_id, list({{'n': CAST(n AS BIGINT), 'm': CAST(m AS BIGINT), 'ps': ps, 'qs': qs, 'a': CAST([] AS {_SPAN}), 'b': CAST([] AS {_SPAN}), 'k': 0}} ORDER BY rk) AS es FROM thin6 GROUP BY segment_id),
f6 AS (SELECT segment_id, list_reduce(es, lambda acc, x: CASE WHEN len({_free_sql('x.ps', 'acc.a', 'x.n')}) > 0 AND len({_free_sql('x.qs', 'acc.b', 'x.m')}) > 0 THEN
  {{'n': x.n, 'm': x.m, 'ps': x.ps, 'qs': x.qs, 'a': list_concat(acc.a, list_transform({_free_sql('x.ps', 'acc.a', 'x.n')}, lambda q: {{'p': q, 'n': x.n}})),
    'b': list_concat(acc.b, list_transform({_free_sql('x.qs', 'acc.b', 'x.m')}, lambda q: {{'p': q, 'n': x.m}})), 'k': acc.k + 1}} ELSE acc END,
  {{'n': CAST(0 AS BIGINT), 'm': CAST(0 AS BIGINT), 'ps': CAST([] AS BIGINT[]), 'qs': CAST([] AS BIGINT[]), 'a': CAST([] AS {_SPAN}), 'b': CAST([] AS {_SPAN}), 'k': 0}}) AS r FROM g6),
m6 AS (SELECT s.segment_id, s.src, s.tgt, {_SPLICE.format('list_sort(r.a)', 's.src')} AS l, {_SPLICE.format('list_sort(r.b)', 's.tgt')} AS q, r.k AS k FROM seg s JOIN f6 USING (segment_id))"""


@query(f"""WITH {S.SEGMENTS}, {S.TERMS}, {_BOTH} SELECT s.segment_id, s.src, s.tgt, coalesce(l.out || substr(s.src, l.p), s.src) AS marked_src,
  coalesce(q.out || substr(s.tgt, q.p), s.tgt) AS marked_tgt, CAST(coalesce(k, 0) AS INTEGER) AS n_terms FROM seg s LEFT JOIN m6 USING (segment_id)""")
def m2_marked_pairs(spark, folder):
    """Training pairs with terms marked on both sides."""
    return matching.mark_pairs(_segments(spark, folder), _terms(spark, folder))


_MARKED = f"""cand3 AS (SELECT s.segment_id, s.src, t.rk, t.n, list_transform({S.places('s.src', 't.term_src', 't.n')}, lambda q: CAST(q AS BIGINT)) AS all_ps FROM seg s JOIN term t ON contains(s.src, t.term_src)),
thin3 AS (SELECT segment_id, src, rk, n, list_reduce(all_ps, lambda acc, q: CASE WHEN len(acc) = 0 OR q >= acc[len(acc)] + n THEN list_append(acc, q) ELSE acc END, CAST([] AS BIGINT[])) AS ps FROM (SELECT *, all_ps FROM cand3)),
g3 AS (SELECT segment_id, src, list({{'rk': rk, 'n': n, 'ps': ps, 'p': CAST(0 AS BIGINT)}} ORDER BY rk) AS es FROM thin3 GROUP BY ALL),
f3 AS (SELECT segment_id, src, list_reduce(es, lambda acc, x: list_concat(acc, list_transform(
  list_filter(x.ps, lambda q: len(list_filter(acc, lambda o: q < o.p + o.n AND o.p < q + x.n)) = 0), lambda q: {{'rk': x.rk, 'n': x.n, 'ps': x.ps, 'p': q}})), es[1:0]) AS ts FROM g3),
o3 AS (SELECT segment_id, src, len(ts) AS n_marked, list_sort(list_transform(ts, lambda x: {{'p': CAST(x.p AS BIGINT), 'n': CAST(x.n AS BIGINT), 'out': ''}})) AS ss FROM f3),
b3 AS (SELECT segment_id, src, n_marked, list_reduce(ss, lambda acc, x: {{'p': x.p + x.n, 'n': CAST(0 AS BIGINT), 'out': acc.out || substr(src, acc.p, x.p - acc.p) || '<start>' || substr(src, x.p, x.n) || '<end>'}},
  {{'p': CAST(1 AS BIGINT), 'n': CAST(0 AS BIGINT), 'out': ''}}) AS r FROM o3),
marked3 AS (SELECT s.segment_id, CASE WHEN b.segment_id IS NULL THEN s.src ELSE b.r.out || substr(s.src, b.r.p) END AS marked, CAST(coalesce(b.n_marked, 0) AS INTEGER) AS n_marked FROM seg s LEFT JOIN b3 b USING (segment_id))"""


@query(f"WITH {S.SEGMENTS}, {S.TERMS}, {_MARKED} SELECT count(*) FILTER (WHERE n_marked > 0) AS rows_marked, CAST(sum(n_marked) AS BIGINT) AS terms_marked FROM marked3")
def a23_marker_statistics(spark, folder):
    """Rows and occurrences that marking touches."""
    rows = m3_marked_sources(spark, folder)
    return rows.agg(F.count_if(F.col("n_marked") > 0).alias("rows_marked"), F.sum("n_marked").alias("terms_marked"))


@query(f"WITH {S.SEGMENTS}, {S.TERMS}, {_MARKED} SELECT * FROM marked3")
def m3_marked_sources(spark, folder):
    """Sources with all free terms marked."""
    return matching.mark_sources(_segments(spark, folder), _terms(spark, folder)).select("segment_id", "marked", "n_marked")


@query(f"""WITH {S.SEGMENTS}, {S.TERMS}, cand AS (SELECT s.segment_id, t.rk, t.n, t.term_id, {S.places('s.src', 't.term_src', 't.n')} AS ps FROM seg s JOIN term t ON contains(s.src, t.term_src)),
g AS (SELECT segment_id, list({{'rk': rk, 'n': n, 'ps': ps, 'term_id': term_id, 'p': CAST(0 AS BIGINT)}} ORDER BY rk) AS es FROM cand GROUP BY segment_id),
f AS (SELECT segment_id, list_reduce(es, lambda acc, x: list_concat(acc, list_transform(
  list_filter(x.ps, lambda q: len(list_filter(acc, lambda o: q < o.p + o.n AND o.p < q + x.n)) = 0)[1:1], lambda q: {{'rk': x.rk, 'n': x.n, 'ps': x.ps, 'term_id': x.term_id, 'p': CAST(q AS BIGINT)}})), es[1:0]) AS ts FROM g)
SELECT segment_id, array_to_string(list_transform(list_sort(list_transform(ts, lambda x: {{'p': x.p, 't': x.term_id}})), lambda x: x.t), '|') AS terms FROM f""")
def m4_feature_terms(spark, folder):
    """Terms of every segment at their first free places."""
    found = matching.first_free_terms(_segments(spark, folder), _terms(spark, folder))
    return found.select("segment_id", F.array_join("terms", "|").alias("terms"))


_FIRST = f"""cand5 AS (SELECT r.row_number, t.rk, instr(r.source, t.term_src) AS p, t.n, t.term_id, t.term_tgt FROM tr r JOIN term t ON contains(r.source, t.term_src)),
g5 AS (SELECT row_number, list({{'rk': rk, 'p': p, 'n': n, 'term_id': term_id, 'term_tgt': term_tgt}} ORDER BY rk) AS cs FROM cand5 GROUP BY row_number),
f5 AS (SELECT row_number, {S.greedy('cs')} AS ts FROM g5)"""


@query(f"WITH {S.SCORED}, {S.TERMS}, {_FIRST} SELECT row_number, array_to_string(list_transform(ts, lambda x: x.term_id), '|') AS terms FROM f5")
def m5_evaluation_terms(spark, folder):
    """Terms of every evaluated source at their first place."""
    found = matching.first_place_terms(_scored(spark, folder), _terms(spark, folder), "row_number", "source")
    return found.select("row_number", F.array_join(F.transform("terms", lambda t: t["term_id"]), "|").alias("terms"))


@query(f"WITH {S.SEGMENTS}, {S.TERMS} SELECT t.term_id, count(*) AS segments FROM seg s JOIN term t ON contains(s.src, t.term_src) GROUP BY t.term_id")
def m6_substring_hits(spark, folder):
    """Number of segments that contain each term, overlaps or not."""
    met = matching.candidates(_segments(spark, folder), matching.ranked(_terms(spark, folder)))
    return met.groupBy("term_id").agg(F.count("*").alias("segments"))


# ---- cross-check of glossary and segments ----

_R = crossclean.Rules()


def _score_sql(test: str, value: float) -> str:
    return f"CASE WHEN {test} THEN CAST({value} AS DOUBLE) ELSE CAST(0 AS DOUBLE) END"


_LEN = "length(regexp_replace(term_src, '[^\\x{4E00}-\\x{9FFF}]', '', 'g'))"
_DOMAIN = "least(1.0, greatest(" + ", ".join([
    _score_sql(f"list_contains({S.words(_R.seeds)}, term_src)", _R.seed), _score_sql(S.any_in("term_src", _R.anchors), _R.anchor),
    _score_sql(S.any_in("upper(term_src)", _R.acronyms), _R.acronym), _score_sql(S.any_in("term_src", _R.compound_suffixes, "ends_with"), _R.compound_suffix),
    _score_sql(S.any_in("term_src", _R.noun_suffixes, "ends_with"), _R.noun_suffix), _score_sql(f"{_LEN} >= 6", _R.six), _score_sql(f"{_LEN} BETWEEN 4 AND 5", _R.four),
]) + "))"
_WEAK = "least(1.0, greatest(" + ", ".join([
    _score_sql(f"list_contains({S.words(_R.nonterms)}, term_src)", _R.exact), _score_sql(f"list_contains({S.words(_R.common_words)}, term_src)", _R.common),
    _score_sql(f"{_LEN} <= 2 AND domain_score < {_R.strong_domain}", _R.short),
]) + "))"
_VERDICTS = f"""stats AS (SELECT t.term_id, t.term_src, t.term_tgt, coalesce(c.occurrences, 0) AS occurrences, coalesce(c.preserved, 0) AS preserved, coalesce(c.occurrences - c.preserved, 0) AS missing
  FROM term t LEFT JOIN (SELECT term_id, count(*) AS occurrences, count(*) FILTER (WHERE preserved) AS preserved FROM each_match GROUP BY term_id) c USING (term_id)),
domained AS (SELECT *, CASE WHEN occurrences > 0 THEN missing / occurrences ELSE 0.0 END AS missing_rate, CASE WHEN occurrences > 0 THEN preserved / occurrences ELSE 0.0 END AS preserved_rate, {_DOMAIN} AS domain_score FROM stats),
scored AS (SELECT *, {_WEAK} AS weak_score FROM domained),
judged AS (SELECT *, domain_score >= 0.65 AND preserved >= 3 AND missing_rate <= 0.6 AS strong, preserved >= 20 AND preserved_rate >= 0.8 AND weak_score < 0.85 AS empirical,
  occurrences >= 5 AND missing_rate >= 0.65 AND weak_score >= 0.85 AND domain_score < 0.65 AS noise FROM scored),
verdicts AS (SELECT term_id, term_src, term_tgt, occurrences, preserved, missing, round(missing_rate, 6) AS missing_rate, round(preserved_rate, 6) AS preserved_rate, domain_score, weak_score,
  CASE WHEN noise THEN 'AUTO_REMOVE_GLOSSARY_NOISE' WHEN strong THEN 'STRONG_GLOSSARY_TERM' ELSE 'TERM_NEEDS_REVIEW' END AS term_action,
  CASE WHEN missing = 0 THEN 'STRICT_CLEAN' WHEN strong OR empirical THEN 'STRICT_RETAIN_AND_ENFORCE' ELSE 'AUTO_REMOVE_GLOSSARY_UNENFORCEABLE' END AS strict_action,
  CASE WHEN missing = 0 THEN 'no_missing_terms' WHEN strong THEN 'domain_preserved_evidence' WHEN empirical THEN 'empirical_stable_translation' ELSE 'not_enforceable_in_segments' END AS strict_reason FROM judged)"""


@query(f"WITH {S.SEGMENTS}, {S.TERMS}, {S.MATCHES}, {_VERDICTS} SELECT * FROM verdicts")
def x1_x6_term_verdicts(spark, folder):
    """The term preservation report: statistics, scores and verdicts of every term."""
    verdicts, _ = crossclean.cross_check(_segments(spark, folder), _terms(spark, folder))
    return verdicts.withColumns({"missing_rate": F.round("missing_rate", 6), "preserved_rate": F.round("preserved_rate", 6)})


_ROWS = f"""k AS (SELECT m.segment_id, m.start, m.term_id, NOT m.preserved AS miss, v.term_action, v.strict_action FROM each_match m JOIN verdicts v USING (term_id)),
g AS (SELECT segment_id, string_agg(term_id, '|' ORDER BY start) AS matched_terms, coalesce(string_agg(term_id, '|' ORDER BY start) FILTER (WHERE miss), '') AS missing_terms,
  count(*) FILTER (WHERE miss) AS n, count(*) FILTER (WHERE miss AND term_action = 'STRONG_GLOSSARY_TERM') AS strong, count(*) FILTER (WHERE miss AND term_action = 'AUTO_REMOVE_GLOSSARY_NOISE') AS noise,
  count(*) FILTER (WHERE miss AND strict_action <> 'AUTO_REMOVE_GLOSSARY_UNENFORCEABLE') AS strict FROM k GROUP BY segment_id),
rows7 AS (SELECT s.segment_id, CASE WHEN strong > 0 THEN 'AUTO_REMOVE_SEGMENT_CONFLICT' WHEN n > 0 AND n = noise THEN 'KEEP_AFTER_GLOSSARY_NOISE_REMOVAL' WHEN n > 0 THEN 'ROW_NEEDS_REVIEW' ELSE 'KEEP' END AS row_action,
  CASE WHEN strict > 0 THEN 'STRICT_REMOVE_SEGMENT_MISMATCH' WHEN n > 0 THEN 'STRICT_KEEP_AFTER_GLOSSARY_REMOVAL' ELSE 'STRICT_KEEP' END AS strict_row_action,
  coalesce(matched_terms, '') AS matched_terms, coalesce(missing_terms, '') AS missing_terms FROM seg s LEFT JOIN g USING (segment_id))"""


@query(f"WITH {S.SEGMENTS}, {S.TERMS}, {S.MATCHES}, {_VERDICTS}, {_ROWS} SELECT * FROM rows7")
def x7_row_verdicts(spark, folder):
    """Normal and strict verdict on every segment."""
    return crossclean.cross_check(_segments(spark, folder), _terms(spark, folder))[1]


@query(f"""WITH {S.SEGMENTS}, {S.TERMS}, {S.MATCHES}, {_VERDICTS}, {_ROWS} SELECT s.segment_id AS original_id, row_number() OVER (ORDER BY s.segment_id) AS new_id, s.src, s.tgt
FROM seg s JOIN rows7 r USING (segment_id) WHERE r.strict_row_action <> 'STRICT_REMOVE_SEGMENT_MISMATCH'""")
def x9_corpus_after_strict_check(spark, folder):
    """Segments that remain after the strict check, renumbered from 1."""
    from loomline.operators.review import with_ordinal

    rows, terms = _segments(spark, folder), _terms(spark, folder)
    verdicts, audit = crossclean.cross_check(rows, terms)
    kept, _ = crossclean.apply_verdicts(rows, terms, verdicts, audit, strict=True)
    return with_ordinal(kept, "segment_id").select(F.col("segment_id").alias("original_id"), (F.col("ord") + 1).alias("new_id"), "src", "tgt")


_CROSS = f"{S.SEGMENTS}, {S.TERMS}, {S.MATCHES}, {_VERDICTS}, {_ROWS}"


@query(f"WITH {_CROSS}, n AS (SELECT (SELECT count(*) FROM term) AS t, (SELECT count(*) FROM seg) AS s, (SELECT count(*) FROM verdicts WHERE term_action = 'AUTO_REMOVE_GLOSSARY_NOISE') AS t1, "
       "(SELECT count(*) FROM verdicts WHERE strict_action = 'AUTO_REMOVE_GLOSSARY_UNENFORCEABLE') AS t2, (SELECT count(*) FROM rows7 WHERE row_action = 'AUTO_REMOVE_SEGMENT_CONFLICT') AS s1, "
       "(SELECT count(*) FROM rows7 WHERE strict_row_action = 'STRICT_REMOVE_SEGMENT_MISMATCH') AS s2, (SELECT count(*) FROM rows7 WHERE missing_terms <> '') AS m), "
       "k9 AS (SELECT unnest([{'mode': 'dry-run', 'a': t1, 'b': s1}, {'mode': 'apply', 'a': t1, 'b': s1}, {'mode': 'strict-dry-run', 'a': t2, 'b': s2}, {'mode': 'strict-apply', 'a': t2, 'b': s2}, {'mode': 'strict-check', 'a': 0, 'b': 0}]) AS x, * FROM n) "
       "SELECT x.mode AS mode, t AS input_terms, t - x.a AS output_terms, x.a AS removed_terms, s AS input_segments, s - x.b AS output_segments, x.b AS removed_segments, m AS mismatch_rows, t2 AS unenforceable_terms, s2 AS strict_mismatch_rows FROM k9")
def x9_mode_counts(spark, folder):
    """What each of the five modes of the cross-check removes and leaves."""
    from loomline.functions.lineage import checkpointed

    rows, terms = _segments(spark, folder), _terms(spark, folder)
    verdicts, audit = (checkpointed(d) for d in crossclean.cross_check(rows, terms))
    counts = None
    for mode in crossclean.MODES:
        part = crossclean.run_mode(rows, terms, verdicts, audit, mode).counts
        counts = part if counts is None else counts.unionByName(part)
    return counts


@query(f"WITH {_CROSS} SELECT count(*) FILTER (WHERE missing_terms <> '') AS mismatch_rows, count(*) FILTER (WHERE missing_terms <> '') = 0 AS passed FROM rows7")
def x10_strict_gate(spark, folder):
    """Whether any segment misses a term of the glossary."""
    return crossclean.strict_gate(crossclean.cross_check(_segments(spark, folder), _terms(spark, folder))[1])


@query(f"""WITH {_CROSS} SELECT term_id AS original_term_id, term_src AS "term_zh-CN", term_tgt AS expected_ko, CAST(occurrences AS VARCHAR) AS occurrence_count, CAST(preserved AS VARCHAR) AS preserved_count, CAST(missing AS VARCHAR) AS missing_count,
  printf('%.6f', missing_rate) AS missing_rate, printf('%.6f', preserved_rate) AS preserved_rate, printf('%.6f', domain_score) AS domain_score, printf('%.6f', weak_score) AS weak_score, strict_action AS remove_reason
  FROM verdicts WHERE strict_action = 'AUTO_REMOVE_GLOSSARY_UNENFORCEABLE'""")
def x11_removed_terms(spark, folder):
    """Terms that the strict check removes, with their statistics as text."""
    verdicts, _ = crossclean.cross_check(_segments(spark, folder), _terms(spark, folder))
    return crossclean.removed_terms(verdicts, strict=True)


def _removed_sql(test: str, terms: str, columns: str) -> str:
    return f"""WITH {_CROSS}, gone AS (SELECT s.*, row_number() OVER (ORDER BY s.segment_id) AS k FROM seg s JOIN rows7 r USING (segment_id) WHERE {test}),
lost AS (SELECT m.segment_id, string_agg(v.term_id || ':' || v.term_src || '=>' || v.term_tgt, '|' ORDER BY m.start) AS terms,
  string_agg('term_id=' || v.term_id || ';occ=' || v.occurrences || ';preserved=' || v.preserved || ';missing=' || v.missing || ';missing_rate=' || printf('%.6f', v.missing_rate) || ';domain_score=' || printf('%.6f', v.domain_score), '|' ORDER BY m.start) AS stats
  FROM each_match m JOIN verdicts v USING (term_id) WHERE NOT m.preserved AND {terms} GROUP BY m.segment_id)
SELECT CAST(k AS VARCHAR) AS removed_id, segment_id AS original_segment_id, src AS "zh-CN", tgt AS ko, {columns} FROM gone LEFT JOIN lost USING (segment_id)"""


@query(_removed_sql("strict_row_action = 'STRICT_REMOVE_SEGMENT_MISMATCH'", "v.strict_action <> 'AUTO_REMOVE_GLOSSARY_UNENFORCEABLE'", "terms AS strict_missing_terms, 'STRICT_REMOVE_SEGMENT_MISMATCH' AS remove_reason"))
def x11_strict_removed_rows(spark, folder):
    """Segments that the strict check removes, with the terms that they miss."""
    rows, terms = _segments(spark, folder), _terms(spark, folder)
    return crossclean.removed_rows(rows, *crossclean.cross_check_all(rows, terms), strict=True)


@query(_removed_sql("row_action = 'AUTO_REMOVE_SEGMENT_CONFLICT'", "v.term_action = 'STRONG_GLOSSARY_TERM'", "terms AS missing_strong_terms, stats AS term_level_stats, 'AUTO_REMOVE_SEGMENT_CONFLICT' AS remove_reason"))
def x8_x11_removed_rows(spark, folder):
    """Segments that the normal check removes, with strong terms that they miss and those terms' statistics."""
    rows, terms = _segments(spark, folder), _terms(spark, folder)
    return crossclean.removed_rows(rows, *crossclean.cross_check_all(rows, terms))


@query(f"WITH {S.SEGMENTS}, {S.TERMS}, {S.MATCHES}, {_VERDICTS} SELECT term_action AS action, count(*) AS terms FROM verdicts GROUP BY 1")
def x12_action_histogram(spark, folder):
    """Terms by verdict."""
    return x1_x6_term_verdicts(spark, folder).groupBy(F.col("term_action").alias("action")).agg(F.count("*").alias("terms"))


# ---- metrics ----


def _gram_sql(tokens: str, n: int) -> str:
    return f"list_transform(range(1, len({tokens}) - {n} + 2), lambda i: array_to_string({tokens}[i:i + {n - 1}], chr(31)))"


def _counts_sql(orders: int, tokens_of: str, end: str = "") -> str:
    parts = [f"toks{end} AS (SELECT row_number, system, {tokens_of.replace('@', 'reference')} AS r, {tokens_of.replace('@', 'candidate')} AS c FROM tr)"]
    unions = " UNION ALL ".join(
        f"SELECT row_number, system, {n} AS o, '{s}' AS side, unnest({_gram_sql(s, n)}) AS gram FROM toks{end}" for n in range(1, orders + 1) for s in "rc"
    )
    parts.append(f"gr{end} AS ({unions}), gc{end} AS (SELECT row_number, system, o, gram, count(*) FILTER (WHERE side = 'r') AS rn, count(*) FILTER (WHERE side = 'c') AS cn FROM gr{end} GROUP BY ALL)")
    parts.append(f"sums{end} AS (SELECT system, o, sum(least(rn, cn)) AS m, sum(cn) AS c, sum(rn) AS r FROM gc{end} GROUP BY ALL)")
    return ", ".join(parts)


_WORDS = "list_filter(regexp_split_to_array(@, '" + X.BLANK + "+'), lambda t: t <> '')"
_CHARS = "list_filter(string_split(regexp_replace(@, '" + X.BLANK + "+', '', 'g'), ''), lambda t: t <> '')"


@query(f"""WITH {S.TRANSLATIONS}, {_counts_sql(4, _WORDS)}, lens AS (SELECT system, sum(len(r)) AS rl, sum(len(c)) AS cl FROM toks GROUP BY system),
logs AS (SELECT system, avg(ln(CASE WHEN m = 0 THEN 0.1 / (c + 0.1) ELSE m / c END)) AS a FROM sums WHERE c > 0 GROUP BY system)
SELECT system, round(CASE WHEN a IS NULL THEN 0 ELSE exp(a) END * CASE WHEN cl = 0 THEN 0 WHEN cl > rl THEN 1 ELSE exp(1 - rl / cl) END, 6) AS bleu,
  round(CASE WHEN cl = 0 THEN 0 WHEN cl > rl THEN 1 ELSE exp(1 - rl / cl) END, 6) AS brevity_penalty, CAST(rl AS BIGINT) AS reference_length, CAST(cl AS BIGINT) AS candidate_length FROM lens LEFT JOIN logs USING (system)""")
def a3_bleu_by_system(spark, folder):
    """Corpus BLEU of every system."""
    scored = metrics.bleu(_translations(spark, folder), group=["system"])
    return scored.withColumns({"bleu": F.round("bleu", 6), "brevity_penalty": F.round("brevity_penalty", 6)})


_COMMON_CHARS = "list_filter(string_split(regexp_replace(@, '" + X.BLANK + "+', '', 'g'), ''), lambda t: t <> '')"


@query(f"""WITH {S.TRANSLATIONS}, {_counts_sql(4, _COMMON_CHARS)}, lens AS (SELECT sum(len(r)) AS rl, sum(len(c)) AS cl FROM toks),
tot AS (SELECT o, sum(m) AS m, sum(c) AS c FROM sums GROUP BY o), logs AS (SELECT avg(ln(CASE WHEN m = 0 THEN 0.1 / (c + 0.1) ELSE m / c END)) AS a FROM tot WHERE c > 0)
SELECT round(CASE WHEN a IS NULL THEN 0 ELSE exp(a) END * CASE WHEN cl = 0 THEN 0 WHEN cl > rl THEN 1 ELSE exp(1 - rl / cl) END, 6) AS bleu,
  round(CASE WHEN cl = 0 THEN 0 WHEN cl > rl THEN 1 ELSE exp(1 - rl / cl) END, 6) AS brevity_penalty, CAST(rl AS BIGINT) AS reference_length, CAST(cl AS BIGINT) AS candidate_length FROM lens, logs""")
def a3_bleu_characters(spark, folder):
    """Corpus BLEU over characters, all systems together."""
    scored = metrics.bleu(_translations(spark, folder), tokenization="char")
    return scored.withColumns({"bleu": F.round("bleu", 6), "brevity_penalty": F.round("brevity_penalty", 6)})


@query(f"""WITH {S.TRANSLATIONS}, {_counts_sql(6, _CHARS)}, pr AS (SELECT system, avg(CASE WHEN c > 0 THEN m / c ELSE 0 END) AS p, avg(CASE WHEN r > 0 THEN m / r ELSE 0 END) AS q FROM sums WHERE c > 0 OR r > 0 GROUP BY system)
SELECT system, round(CASE WHEN 4 * p + q > 0 THEN 5 * p * q / (4 * p + q) ELSE 0 END, 6) AS chrf FROM pr""")
def a5_chrf_by_system(spark, folder):
    """Corpus chrF of every system."""
    return metrics.chrf(_translations(spark, folder), group=["system"]).withColumn("chrf", F.round("chrf", 6))


_STATUS = "CASE WHEN n_terms = 0 THEN 'no_terms' WHEN n_terms = {0} THEN 'all_matched' WHEN {0} = 0 THEN 'not_matched' ELSE 'partially_matched' END"
_PRESERVED = f"""{_FIRST}, vis AS (SELECT r.*, {S.strip_markers('r.candidate')} AS v, {S.no_space(S.strip_markers('r.candidate'))} AS bare, f5.ts FROM tr r LEFT JOIN f5 USING (row_number)),
pre AS (SELECT row_number, system, candidate, coalesce(len(ts), 0) AS n_terms, coalesce(len(list_filter(ts, lambda t: contains(v, t.term_tgt))), 0) AS exact,
  coalesce(len(list_filter(ts, lambda t: contains(bare, {S.no_space('t.term_tgt')}))), 0) AS nospace FROM vis),
st AS (SELECT *, {_STATUS.format('exact')} AS se, {_STATUS.format('nospace')} AS sn FROM pre),
kept AS (SELECT system, CAST(sum(n_terms) AS BIGINT) AS total_terms, CAST(sum(exact) AS BIGINT) AS matched_exact, CAST(sum(nospace) AS BIGINT) AS matched_nospace,
  coalesce(sum(exact) / nullif(sum(n_terms), 0), 1) AS rate_exact, coalesce(sum(nospace) / nullif(sum(n_terms), 0), 1) AS rate_nospace, count(*) FILTER (WHERE n_terms > 0) AS rows_with_terms,
  {', '.join(f"count(*) FILTER (WHERE {c} = '{v}') AS rows_{name}{end}" for c, end in (('se', ''), ('sn', '_nospace')) for v, name in (('all_matched', 'all'), ('partially_matched', 'partial'), ('not_matched', 'none')))},
  count(*) FILTER (WHERE se = 'no_terms') AS rows_without_terms FROM st GROUP BY system)"""


@query(f"""WITH {S.SCORED}, {S.TERMS}, {_PRESERVED} SELECT row_number, CAST(n_terms AS INTEGER) AS n_terms, CAST(exact AS INTEGER) AS exact, CAST(nospace AS INTEGER) AS nospace,
  se AS status_exact, sn AS status_nospace FROM st""")
def a6_preservation_rows(spark, folder):
    """Terms that each candidate preserves."""
    rows = metrics.preservation_rows(_scored(spark, folder), _terms(spark, folder))
    return rows.select("row_number", "n_terms", "exact", "nospace", "status_exact", "status_nospace")


@query(f"WITH {S.SCORED}, {S.TERMS}, {_PRESERVED} SELECT * REPLACE (round(rate_exact, 6) AS rate_exact, round(rate_nospace, 6) AS rate_nospace) FROM kept")
def a6_preservation_by_system(spark, folder):
    """Terminology preservation of every system."""
    kept = metrics.preservation(metrics.preservation_rows(_scored(spark, folder), _terms(spark, folder)), ["system"])
    return kept.withColumns({"rate_exact": F.round("rate_exact", 6), "rate_nospace": F.round("rate_nospace", 6)})


_BLEU = f"""lens_w AS (SELECT system, sum(len(r)) AS rl, sum(len(c)) AS cl FROM toks_w GROUP BY system),
logs_w AS (SELECT system, avg(ln(CASE WHEN m = 0 THEN 0.1 / (c + 0.1) ELSE m / c END)) AS a FROM sums_w WHERE c > 0 GROUP BY system),
bleus AS (SELECT system, CAST(rl AS BIGINT) AS rl, CAST(cl AS BIGINT) AS cl, CASE WHEN cl = 0 THEN 0 WHEN cl > rl THEN 1 ELSE exp(1 - rl / cl) END AS bp, CASE WHEN a IS NULL THEN 0 ELSE exp(a) END * bp AS bleu
  FROM lens_w LEFT JOIN logs_w USING (system)),
chars AS (SELECT system, avg(CASE WHEN c > 0 THEN m / c ELSE 0 END) AS p, avg(CASE WHEN r > 0 THEN m / r ELSE 0 END) AS q FROM sums_c WHERE c > 0 OR r > 0 GROUP BY system),
chrfs AS (SELECT system, CASE WHEN 4 * p + q > 0 THEN 5 * p * q / (4 * p + q) ELSE 0 END AS chrf FROM chars),
sizes AS (SELECT system, count(*) AS n, count(*) FILTER (WHERE candidate = '') AS e FROM tr GROUP BY system),
ev AS (SELECT s.*, b.rl, b.cl, b.bp, b.bleu, coalesce(c.chrf, 0) AS chrf, k.*, 0.5 * b.bleu + 0.5 * k.rate_nospace AS composite FROM sizes s JOIN bleus b USING (system) LEFT JOIN chrfs c USING (system) JOIN kept k USING (system))"""
_EVALUATED = f"{S.SCORED}, {S.TERMS}, {_PRESERVED}, {_counts_sql(4, _WORDS, '_w')}, {_counts_sql(6, _CHARS, '_c')}, {_BLEU}"
_SUMMARY = [
    ("rows", "n"), ("empty_candidate_rows", "e"), ("bleu", "bleu"), ("bleu_tokenization", "'whitespace'"), ("bleu_reference_length", "rl"), ("bleu_candidate_length", "cl"), ("bleu_brevity_penalty", "bp"),
    ("chrf", "chrf"), ("chrf_max_n", "6"), ("chrf_beta", "'2.0'"), ("glossary_preservation_rate", "rate_exact"), ("glossary_preservation_rate_exact", "rate_exact"), ("glossary_preservation_rate_nospace", "rate_nospace"),
    ("glossary_terms", "total_terms"), ("glossary_terms_matched", "matched_exact"), ("glossary_terms_matched_exact", "matched_exact"), ("glossary_terms_matched_nospace", "matched_nospace"),
    ("rows_with_glossary_terms", "rows_with_terms"), *((f"{name}{end}", f"rows_{short}{'_nospace' if end == '_nospace' else ''}") for end in ("", "_exact", "_nospace")
      for name, short in (("rows_all_terms_matched", "all"), ("rows_partially_matched", "partial"), ("rows_not_matched", "none"))), ("rows_without_glossary_terms", "rows_without_terms"),
]
_SHARES = ("bleu", "bp", "chrf", "rate_exact", "rate_nospace")
_SUMMARY_SQL = ", ".join(f"{{'at': {i}, 'metric': '{m}', 'value': {f'printf(chr(37) || {chr(39)}.6f{chr(39)}, CAST({c} AS DOUBLE))' if c in _SHARES else f'CAST({c} AS VARCHAR)'}}}" for i, (m, c) in enumerate(_SUMMARY, 1))


@query(f"WITH {_EVALUATED}, long AS (SELECT system, unnest([{_SUMMARY_SQL}]) AS x FROM ev) SELECT system, x.at AS position, x.metric AS metric, x.value AS value FROM long")
def a8_a9_evaluation_summary(spark, folder):
    """The ordered metric summary of every system, as text."""
    return metrics.summary_rows(metrics.evaluate(_scored(spark, folder), _terms(spark, folder), ["system"]), ["system"])


@query(f"WITH {_EVALUATED}, r AS (SELECT system, round(composite, 6) AS composite FROM ev) SELECT system, composite, CAST(row_number() OVER (ORDER BY composite DESC, system) AS INTEGER) AS rank FROM r")
def a10_a21_system_ranking(spark, folder):
    """Systems ranked by the composite metric."""
    from loomline.operators.training import rank_by

    scored = metrics.evaluate(_scored(spark, folder), _terms(spark, folder), ["system"])
    return rank_by(scored.select("system", F.round("composite", 6).alias("composite")), "composite", "system")


@query(f"""WITH {S.SCORED}, {S.TERMS}, {_PRESERVED}, pr AS (SELECT row_number, CASE WHEN candidate = '' THEN 0 WHEN se IN ('not_matched', 'partially_matched') THEN 1 ELSE 2 END AS priority FROM st)
SELECT row_number, CAST(priority AS INTEGER) AS priority FROM pr ORDER BY priority, row_number LIMIT 200""")
def o1_review_sample(spark, folder):
    """The 200 rows to look at first: empty candidates, then rows that miss terms, then the rest."""
    rows = metrics.preservation_rows(_scored(spark, folder), _terms(spark, folder))
    return metrics.review_sample(rows, 200).select("row_number", "priority")


# ---- glossary ----


@query(f"""WITH {S.TERMS}, sf AS (SELECT * FROM (SELECT unnest({S.words(L.COMPOUND_SUFFIXES)}) AS s)),
c AS (SELECT t.term_id, arg_max(sf.s, length(sf.s)) AS suffix FROM term t JOIN sf ON ends_with(t.term_src, sf.s) AND length(t.term_src) > length(sf.s) + 1 GROUP BY t.term_id),
p AS (SELECT left(t.term_src, length(t.term_src) - length(c.suffix)) AS stem, c.suffix FROM term t JOIN c USING (term_id) WHERE NOT regexp_matches(t.term_src, '[《》\\[\\]【】（）()]'))
SELECT stem, array_to_string(list_sort(list(DISTINCT suffix)), '|') AS suffixes, CAST(count(DISTINCT suffix) AS INTEGER) AS n_suffixes FROM p GROUP BY stem""")
def g2_compound_families(spark, folder):
    """Stems of compound terms with their suffixes."""
    families = glossary.compound_families(_terms(spark, folder))
    return families.select("stem", F.array_join("suffixes", "|").alias("suffixes"), "n_suffixes")


def _count_sql(text: str, term: str) -> str:
    return f"""(SELECT t.term_id, CAST(sum((length(s.{text}) - length(replace(s.{text}, t.{term}, ''))) / length(t.{term})) AS BIGINT) AS k
  FROM seg s JOIN term t ON length(t.{term}) >= 2 AND contains(s.{text}, t.{term}) GROUP BY t.term_id)"""


@query(f"""WITH {S.ALL_SEGMENTS}, {S.TERMS}, a AS {_count_sql('src', 'term_src')}, b AS {_count_sql('tgt', 'term_tgt')},
ac AS (SELECT unnest({S.words(L.ACRONYMS)}) AS a), live AS (SELECT a FROM ac WHERE EXISTS (SELECT 1 FROM seg WHERE contains(upper(src), a)) AND EXISTS (SELECT 1 FROM seg WHERE contains(upper(tgt), a))),
c AS (SELECT t.term_id, coalesce(a.k, 0) AS src_count, coalesce(b.k, 0) AS tgt_count, EXISTS (SELECT 1 FROM live WHERE contains(upper(t.term_src), live.a) AND contains(upper(t.term_tgt), live.a)) AS fb
  FROM term t LEFT JOIN a USING (term_id) LEFT JOIN b USING (term_id))
SELECT term_id, src_count, tgt_count, CAST(greatest(CASE WHEN src_count > 0 AND tgt_count > 0 THEN 1.0 WHEN src_count > 0 OR tgt_count > 0 THEN 0.55 ELSE 0.0 END, CASE WHEN fb THEN 0.75 ELSE 0.0 END) AS DOUBLE) AS product_score FROM c""")
def g3_g4_corpus_evidence(spark, folder):
    """Occurrences of every term in the corpus and the evidence score."""
    rows, terms = _segments(spark, folder, "keep"), _terms(spark, folder)
    return glossary.evidence_score(terms, glossary.corpus_counts(rows, terms), glossary.acronyms_present(rows))


@query(f"""WITH {S.TERMS} SELECT term_id, CASE WHEN row_number() OVER (PARTITION BY term_src, term_tgt ORDER BY term_id) = 1 THEN 'KEEP' ELSE 'MERGED_DUPLICATE' END AS pair_action FROM term""")
def g20_merged_pairs(spark, folder):
    """Exact glossary pairs: the first stays, later ones merge."""
    return glossary.merge_pairs(_terms(spark, folder)).select("term_id", "pair_action")


@query(f"""WITH {S.TERMS}, s AS (SELECT term_src, count(DISTINCT term_tgt) AS k FROM term GROUP BY 1), t AS (SELECT term_tgt, count(DISTINCT term_src) AS k FROM term GROUP BY 1)
SELECT term_id, s.k > 1 OR t.k > 1 AS conflict FROM term JOIN s USING (term_src) JOIN t USING (term_tgt)""")
def g21_one_to_one(spark, folder):
    """Terms that break the one-to-one constraint."""
    return glossary.one_to_one(_terms(spark, folder)).select("term_id", "conflict")


@query("""WITH e AS (SELECT vec_id, label, unnest(embedding) AS x, unnest(range(len(embedding))) AS i FROM embeddings), m AS (SELECT label, i, avg(CAST(x AS DOUBLE)) AS a FROM e GROUP BY ALL),
n AS (SELECT label, greatest(sqrt(sum(a * a)), 1e-9) AS s FROM m GROUP BY label) SELECT m.label, CAST(m.i AS INTEGER) AS i, round(m.a / n.s, 5) AS x FROM m JOIN n USING (label)""")
def g8_centroids(spark, folder):
    """Unit centroid of every label's vectors."""
    found = glossary.centroid(table(spark, folder, "embeddings"), "embedding", ["label"])
    return found.select("label", F.posexplode("centroid").alias("i", "x")).withColumn("x", F.round("x", 5))


@query("""WITH seeds AS (SELECT embedding AS s FROM embeddings WHERE label = 0) SELECT e.vec_id, round(max(list_dot_product(CAST(e.embedding AS DOUBLE[]), CAST(s.s AS DOUBLE[]))), 4) AS similarity
FROM embeddings e CROSS JOIN seeds s GROUP BY e.vec_id""")
def g9_max_similarity(spark, folder):
    """Largest similarity of every vector with the seed vectors (those of label 0)."""
    vectors = table(spark, folder, "embeddings")
    return glossary.max_similarity(vectors, "vec_id", "embedding", vectors.where("label = 0"), "embedding").withColumn("similarity", F.round("similarity", 4))
