"""Pieces of SQL that the oracle queries share (DuckDB, RE2 patterns)."""

from __future__ import annotations

from collections.abc import Sequence

from loomline.functions.text import BLANK

PLACEHOLDER = r"%[sd]|\{\d+\}|<[^>]+>|\$\{[^}]+\}"


def strip(column: str) -> str:
    return f"regexp_replace(regexp_replace(coalesce({column}, ''), '^{BLANK}+', ''), '{BLANK}+$', '')"


def no_space(column: str) -> str:
    return f"regexp_replace(coalesce({column}, ''), '{BLANK}+', '', 'g')"


def strip_markers(column: str) -> str:
    return f"regexp_replace({column}, '<start>(.*?)<end>', '\\1', 'g')"


def words(items: Sequence[str]) -> str:
    return "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in items) + "]"


def any_in(column: str, items: Sequence[str], how: str = "contains") -> str:
    return f"len(list_filter({words(items)}, lambda word: {how}({column}, word))) > 0"


SEGMENTS = f"""seg AS (SELECT * FROM (SELECT {strip('segment_id')} AS segment_id, {strip('"zh-CN"')} AS src, {strip('ko')} AS tgt FROM segments)
  WHERE segment_id <> '' AND src <> '' AND tgt <> '')"""
ALL_SEGMENTS = f"""seg AS (SELECT {strip('segment_id')} AS segment_id, {strip('"zh-CN"')} AS src, {strip('ko')} AS tgt FROM segments)"""
TERMS = f"""term AS (SELECT *, length(term_src) AS n, row_number() OVER (ORDER BY length(term_src) DESC, coalesce(try_cast(term_id AS BIGINT), 1000000000000), term_id) AS rk
  FROM (SELECT {strip('term_id')} AS term_id, {strip('"zh-CN"')} AS term_src, {strip('ko')} AS term_tgt FROM glossary) WHERE term_id <> '' AND term_src <> '' AND term_tgt <> '')"""
#: Translations, the rewrites of decisions, and the corpus as a translation of itself: rows with and without terms.
SCORED = f"""tr AS (SELECT row_number, segment_id, {strip('source')} AS source, {strip('"references"')} AS reference, {strip('candidates')} AS candidate, system FROM evaluation_translation_result
  UNION ALL SELECT -d.decision_id, d.segment_id, {strip('s."zh-CN"')}, {strip('s.ko')}, {strip('d.corrected_ko')}, d.model FROM decisions d JOIN segments s ON d.segment_id = s.segment_id WHERE {strip('d.corrected_ko')} <> ''
  UNION ALL SELECT 1000000000 + try_cast(segment_id AS BIGINT), segment_id, {strip('"zh-CN"')}, {strip('ko')}, {strip('ko')}, 'corpus' FROM segments)"""
TRANSLATIONS = f"""tr AS (SELECT row_number, segment_id, {strip('source')} AS source, {strip('"references"')} AS reference, {strip('candidates')} AS candidate, system FROM evaluation_translation_result)"""


def places(text: str, term: str, size: str) -> str:
    return f"list_filter(range(1, length({text}) - {size} + 2), lambda q: substr({text}, CAST(q AS BIGINT), {size}) = {term})"


def greedy(spans: str) -> str:
    return (
        f"list_reduce({spans}, lambda acc, x: CASE WHEN len(list_filter(acc, lambda o: x.p < o.p + o.n AND o.p < x.p + x.n)) > 0 THEN acc ELSE list_append(acc, x) END, {spans}[1:0])"
    )


MATCHES = f"""cand AS (SELECT s.segment_id, t.rk, t.n, t.term_id, u.p AS p,
    contains(s.tgt, t.term_tgt) OR ({no_space('t.term_tgt')} <> '' AND contains({no_space('s.tgt')}, {no_space('t.term_tgt')})) AS preserved
  FROM seg s JOIN term t ON contains(s.src, t.term_src), unnest({places('s.src', 't.term_src', 't.n')}) u(p)),
spans AS (SELECT segment_id, list({{'rk': rk, 'p': p, 'n': n, 'term_id': term_id, 'preserved': preserved}} ORDER BY rk, p) AS cs FROM cand GROUP BY segment_id),
matches AS (SELECT segment_id, {greedy('cs')} AS ms FROM spans),
each_match AS (SELECT segment_id, m.p - 1 AS start, m.p + m.n - 1 AS "end", m.term_id AS term_id, m.preserved AS preserved FROM (SELECT segment_id, unnest(ms) AS m FROM matches))"""


def source_words(text: str, suffixes: Sequence[str], verb: str, token: str) -> str:
    """Words of a source text with flag and part of speech, as structs."""
    is_verb = f"regexp_matches(w, '{verb}') AND NOT {any_in('w', suffixes, 'ends_with')}"
    return (
        f"list_transform(regexp_extract_all({text}, '{token}'), lambda w: {{'word': w, "
        f"'flag': CASE WHEN regexp_matches(w, '^[A-Za-z]') THEN 'eng' WHEN regexp_matches(w, '^[0-9]') THEN 'm' WHEN {is_verb} THEN 'v' ELSE 'n' END, "
        f"'upos': CASE WHEN regexp_matches(w, '^[A-Za-z]') THEN 'X' WHEN regexp_matches(w, '^[0-9]') THEN 'NUM' WHEN {is_verb} THEN 'VERB' ELSE 'NOUN' END}})"
    )


def target_words(text: str, verb: str, particle: str) -> str:
    """Words of a target text with tag and part of speech, as structs; particles follow their word."""
    words_of = f"list_filter(regexp_split_to_array({text}, '{BLANK}+'), lambda w: w <> '')"
    kinds = lambda names: f"CASE WHEN regexp_matches(w, '^[A-Za-z]+$') THEN '{names[0]}' WHEN regexp_matches(w, '^[0-9]+$') THEN '{names[1]}' WHEN regexp_matches(w, '{verb}') THEN '{names[2]}' ELSE '{names[3]}' END"
    own = f"{{'tag': {kinds(('SL', 'SN', 'EF', 'NNG'))}, 'upos': {kinds(('X', 'NUM', 'VERB', 'NOUN'))}}}"
    return (
        f"flatten(list_transform({words_of}, lambda w: CASE WHEN regexp_matches(w, '{particle}') AND NOT regexp_matches(w, '{verb}') "
        f"THEN [{own}, {{'tag': 'JX', 'upos': 'ADP'}}] ELSE [{own}] END))"
    )


def share(items: str, test: str) -> str:
    """Share of a list's items, named ``t``, for which a test holds; 0 of none."""
    return f"coalesce(len(list_filter({items}, lambda t: {test})) / nullif(len({items}), 0), CAST(0 AS DOUBLE))"


def hashed_vector(text: str, size: int = 64) -> str:
    """Unit vector of the characters' counts by code point."""
    own = f"CASE WHEN coalesce({text}, '') = '' THEN '[EMPTY]' ELSE {text} END"
    places_of = f"list_transform(list_filter(string_split({own}, ''), lambda c: c <> ''), lambda c: unicode(c) % {size})"
    counts = f"list_transform(range(0, {size}), lambda i: CAST(len(list_filter({places_of}, lambda p: p = i)) AS DOUBLE))"
    return f"(SELECT list_transform(k, lambda x: x / greatest(sqrt(list_dot_product(k, k)), 1e-9)) FROM (SELECT {counts} AS k))"
