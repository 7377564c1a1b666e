"""Queries over model verdicts, requests, responses, splits and logs, with their SQL."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomline.functions.text import BLANK, normal_reason
from loomline.operators import matching, review, training
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


def _segments(spark: SparkSession, folder: str) -> DataFrame:
    return scans.segments(table(spark, folder, "segments", ["segment_id", "zh-CN", "ko"], spread=True), "keep")


def _terms(spark: SparkSession, folder: str) -> DataFrame:
    return scans.terms(table(spark, folder, "glossary", ["term_id", "zh-CN", "ko"]))


def _verdicts(spark: SparkSession, folder: str) -> DataFrame:
    """Decisions with their segment's texts, features and terms, and the errors of rewrites."""
    decisions = table(spark, folder, "decisions", ["decision_id", "segment_id", "action", "reason", "corrected_ko", "batch_no"])
    decisions = decisions.withColumn("corrected", F.coalesce("corrected_ko", F.lit(""))).drop("corrected_ko")
    rows = review.with_matched_terms(review.with_features(_segments(spark, folder)), _terms(spark, folder))
    full = decisions.join(rows, "segment_id").withColumn("term_targets", F.transform("matched_terms", lambda t: t["tgt"]))
    errors = review.rewrite_errors(F.col("src"), F.col("tgt"), F.col("corrected"), F.col("placeholders"), F.col("term_targets"))
    return full.withColumn("errors", F.when(F.upper("action").startswith("REWRITE"), errors).otherwise(F.array().cast("array<string>")))


_PH = review.PLACEHOLDER
_FEATURES = f"""{S.ALL_SEGMENTS}, feat AS (SELECT segment_id, src, tgt, list_sort(list_distinct(regexp_extract_all(src || ' ' || tgt, '{_PH}'))) AS ph,
  regexp_matches(tgt, '[\\x{{3400}}-\\x{{9FFF}}]') OR (tgt <> '' AND NOT regexp_matches(tgt, '[\\x{{AC00}}-\\x{{D7A3}}]')) AS contaminated,
  regexp_matches(src, '^\\s*[\\{{\\[]\\s*[''"].*[''"]\\s*[\\}}\\]]\\s*$') OR regexp_matches(tgt, '^\\s*[\\{{\\[]\\s*[''"].*[''"]\\s*[\\}}\\]]\\s*$') AS structured FROM seg)"""


@query(f"WITH {_FEATURES} SELECT segment_id, array_to_string(ph, ';') AS placeholders, contaminated, structured FROM feat")
def r21_r22_row_features(spark, folder):
    """Placeholders, contamination and structure of every segment."""
    found = review.with_features(_segments(spark, folder))
    return found.select("segment_id", F.array_join("placeholders", ";").alias("placeholders"), "contaminated", "structured")


_ERRORS = [
    (f"{S.strip('c')} = ''", "empty_corrected_ko"), ("han", "corrected_ko_contains_cjk"), ("NOT regexp_matches(c, '[\\x{AC00}-\\x{D7A3}]')", "corrected_ko_has_no_hangul"),
    ("len(list_filter(ph, lambda x: NOT list_contains(own, x))) > 0", "placeholder_missing"), ("len(list_filter(own, lambda x: NOT list_contains(ph, x))) > 0", "placeholder_extra"),
    (f"len(list_filter(wanted, lambda t: NOT (contains(c, t) OR ({S.no_space('t')} <> '' AND contains({S.no_space('c')}, {S.no_space('t')}))))) > 0", "glossary_term_missing"),
    (f"han OR ({S.strip('src')} <> '' AND {S.strip('c')} = {S.strip('src')}) OR regexp_matches(c, '{review.EXPLANATION}')", "copy_or_explanation_like"),
    (f"length({S.strip('c')}) > greatest(240, 4 * greatest(length(tgt), 1)) OR length({S.strip('c')}) < greatest(1, greatest(length(tgt), 1) // 8)", "length_ratio_outlier"),
    ("""CASE WHEN len(ws) >= 8 THEN list_max(list_transform(list_distinct(ws), lambda w: len(list_filter(ws, lambda x: x = w)))) / len(ws) > 0.55
      ELSE len(list_filter(range(2, 13), lambda k: len(list_filter(range(1, length(c) - 5 * k + 2), lambda q: substr(c, CAST(q AS BIGINT), CAST(5 * k AS BIGINT)) = repeat(substr(c, CAST(q AS BIGINT), CAST(k AS BIGINT)), 5))) > 0)) > 0 END""", "excessive_repetition"),
]
_OUTCOMES = f"""{_FEATURES}, {S.TERMS}, c4 AS (SELECT s.segment_id, t.rk, t.n, t.term_tgt, {S.places('s.src', 't.term_src', 't.n')} AS ps FROM seg s JOIN term t ON contains(s.src, t.term_src) WHERE s.tgt IS NOT NULL),
g4 AS (SELECT segment_id, list({{'rk': rk, 'n': n, 'ps': ps, 't': term_tgt, 'p': CAST(0 AS BIGINT)}} ORDER BY rk) AS es FROM c4 GROUP BY segment_id),
w4 AS (SELECT segment_id, list_transform(list_reduce(es, lambda acc, x: list_concat(acc, list_transform(
  list_filter(x.ps, lambda q: len(list_filter(acc, lambda o: q < o.p + o.n AND o.p < q + x.n)) = 0)[1:1], lambda q: {{'rk': x.rk, 'n': x.n, 'ps': x.ps, 't': x.t, 'p': CAST(q AS BIGINT)}})), es[1:0]), lambda x: x.t) AS wanted FROM g4),
vd AS (SELECT d.decision_id, d.segment_id, d.action, upper(coalesce(d.action, '')) AS act, coalesce(d.corrected_ko, '') AS c, f.src, f.tgt, f.ph, f.contaminated, f.structured, coalesce(w.wanted, []) AS wanted,
  regexp_matches(coalesce(d.corrected_ko, ''), '[\\x{{3400}}-\\x{{9FFF}}]') AS han, list_distinct(regexp_extract_all(coalesce(d.corrected_ko, ''), '{_PH}')) AS own,
  list_filter(regexp_split_to_array({S.strip('d.corrected_ko')}, '{BLANK}+'), lambda x: x <> '') AS ws FROM decisions d JOIN feat f USING (segment_id) LEFT JOIN w4 w USING (segment_id)),
er AS (SELECT *, CASE WHEN act LIKE 'REWRITE%' THEN concat_ws(';', {', '.join(f"CASE WHEN {test} THEN '{name}' END" for test, name in _ERRORS)}) ELSE '' END AS errors FROM vd),
st AS (SELECT *, CASE WHEN act LIKE 'REMOVE%' THEN 'REMOVE_REQUESTED' WHEN act LIKE 'REWRITE%' AND errors = '' THEN 'REWRITE_ACCEPTED' WHEN act LIKE 'REWRITE%' AND contaminated THEN 'REWRITE_REJECTED_REMOVE_CONTAMINATED'
  WHEN act LIKE 'REWRITE%' THEN 'REWRITE_REJECTED' WHEN act LIKE 'REVIEW%' THEN 'REVIEW' ELSE 'KEEP' END AS validation_status FROM er),
outcome AS (SELECT *, CASE WHEN validation_status IN ('REMOVE_REQUESTED', 'REWRITE_REJECTED_REMOVE_CONTAMINATED') THEN 'REMOVE' WHEN validation_status = 'REWRITE_ACCEPTED' THEN 'REWRITE'
  WHEN validation_status = 'REVIEW' THEN 'REVIEW' ELSE 'KEEP' END AS final_action FROM st)"""


@query(f"""WITH {_OUTCOMES} SELECT decision_id, segment_id, final_action, validation_status, errors,
  CASE final_action WHEN 'REMOVE' THEN '' WHEN 'REWRITE' THEN c ELSE tgt END AS final_ko FROM outcome""")
def v1_v6_outcomes(spark, folder):
    """Outcome of every decision, with the checks that a rewrite failed."""
    return review.outcomes(_verdicts(spark, folder)).select(
        "decision_id", "segment_id", "final_action", "validation_status", F.array_join("errors", ";").alias("errors"), "final_ko"
    )


@query(f"""WITH {_FEATURES} SELECT d.decision_id, CASE WHEN length(trim(f.tgt)) = 0 THEN 1 ELSE length(f.tgt) END AS before, length({S.strip('d.corrected_ko')}) AS after
FROM decisions d JOIN feat f USING (segment_id) WHERE upper(d.action) LIKE 'REWRITE%' AND (length({S.strip('d.corrected_ko')}) > greatest(20, 1.05 * greatest(length(f.tgt), 1))
  OR length({S.strip('d.corrected_ko')}) < greatest(1, floor(greatest(length(f.tgt), 1) / 1.05)))""")
def v4_length_outliers(spark, folder):
    """Rewrites more than a twentieth longer or shorter than what they replace (the stage's own bounds are far wider)."""
    rows = _verdicts_plain(spark, folder).where(F.upper("action").startswith("REWRITE"))
    from loomline.functions.text import strip

    before = F.greatest(F.length("tgt"), F.lit(1))
    found = rows.where(review.bad_length(F.col("tgt"), F.col("corrected"), 20, 1.05, 1.05))
    return found.select("decision_id", before.alias("before"), F.length(strip(F.col("corrected"))).alias("after"))


def _verdicts_plain(spark: SparkSession, folder: str) -> DataFrame:
    decisions = table(spark, folder, "decisions", ["decision_id", "segment_id", "action", "corrected_ko"]).withColumn("corrected", F.coalesce("corrected_ko", F.lit("")))
    return decisions.drop("corrected_ko").join(_segments(spark, folder), "segment_id")


@query("SELECT action, count(*) AS decisions, min(decision_id) AS first FROM decisions GROUP BY action")
def a11_action_histogram(spark, folder):
    """Decisions by action, with the first of each for a stable order."""
    return table(spark, folder, "decisions", ["decision_id", "action"]).groupBy("action").agg(F.count("*").alias("decisions"), F.min("decision_id").alias("first"))


_NORMAL = f"regexp_replace(lower({S.strip('reason')}), '{BLANK}+', ' ', 'g')"


@query(f"""WITH n AS (SELECT batch_no, {_NORMAL} AS normal, reason, decision_id FROM decisions), c AS (SELECT batch_no, normal, count(*) AS k, min(decision_id) AS first, arg_min(reason, decision_id) AS reason FROM n GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY batch_no ORDER BY k DESC, first) AS rn, sum(k) OVER (PARTITION BY batch_no) AS total FROM c)
SELECT batch_no, reason, k AS count, round(k / total, 6) AS rate FROM r WHERE rn = 1 AND total >= 5 AND k / total >= 0.25""")
def a12_reason_warnings(spark, folder):
    """Batches in which one reason makes up a quarter of the rows or more (the stage itself warns from 0.6 on)."""
    rows = table(spark, folder, "decisions", ["decision_id", "batch_no", "reason"])
    return review.reason_warnings(rows, least_rate=0.25).withColumn("rate", F.round("rate", 6))


@query(f"WITH c AS (SELECT {_NORMAL} AS normal, count(*) AS k FROM decisions GROUP BY 1) SELECT max(k) AS count, round(max(k) / sum(k), 6) AS rate FROM c")
def a14_most_repeated_reason(spark, folder):
    """The most frequent reason over all decisions."""
    return review.most_repeated_reason(table(spark, folder, "decisions", ["reason"])).withColumn("rate", F.round("rate", 6))


@query(f"SELECT {_NORMAL} AS reason, count(*) AS decisions FROM decisions GROUP BY 1")
def a13_reasons(spark, folder):
    """Decisions by reason in normal form."""
    return table(spark, folder, "decisions", ["reason"]).groupBy(normal_reason(F.col("reason")).alias("reason")).agg(F.count("*").alias("decisions"))


@query(f"""WITH {_OUTCOMES}, fx AS (SELECT final_action, action, unnest([{{'f': 'contaminated', 'v': contaminated}}, {{'f': 'structured', 'v': structured}}, {{'f': 'has_placeholders', 'v': len(ph) > 0}}, {{'f': 'has_terms', 'v': len(wanted) > 0}}]) AS x FROM outcome),
fg AS (SELECT x.f AS feature, count(*) AS count, min(final_action) AS f1, max(final_action) AS f2, min(action) AS a1, max(action) AS a2 FROM fx WHERE x.v GROUP BY 1 HAVING count(*) >= 2)
SELECT feature, 'surface_feature_single_final_action_warning' AS warning, f1 AS value, count FROM fg WHERE f1 = f2 UNION ALL SELECT feature, 'surface_feature_single_llm_action_warning', a1, count FROM fg WHERE a1 = a2""")
def a15_feature_warnings(spark, folder):
    """Features all of whose rows share one action."""
    rows = review.outcomes(_verdicts(spark, folder)).withColumn("has_placeholders", F.size("placeholders") > 0).withColumn("has_terms", F.size("term_targets") > 0)
    return review.feature_warnings(rows, ["contaminated", "structured", "has_placeholders", "has_terms"], least=2)


@query(f"WITH {_OUTCOMES} SELECT final_action, validation_status, count(*) AS rows, round(count(*) / (SELECT count(*) FROM outcome), 6) AS share FROM outcome GROUP BY ALL")
def a16_outcome_summary(spark, folder):
    """Counts and shares of the outcomes."""
    rows = review.outcomes(_verdicts(spark, folder))
    sums = rows.groupBy("final_action", "validation_status").agg(F.count("*").alias("rows"))
    return sums.join(rows.agg(F.count("*").alias("all"))).select("final_action", "validation_status", "rows", F.round(F.col("rows") / F.col("all"), 6).alias("share"))


@query("""WITH a AS (SELECT decision_id, CASE WHEN action LIKE 'REMOVE%' THEN 'REMOVE' ELSE action END AS action FROM decisions), r AS (SELECT *, row_number() OVER (PARTITION BY action ORDER BY decision_id) AS turn FROM a)
SELECT decision_id, action, CAST(turn AS INTEGER) AS turn FROM r ORDER BY turn, list_position(['REMOVE', 'REWRITE', 'REVIEW', 'KEEP'], action) LIMIT 200""")
def w3_round_robin_sample(spark, folder):
    """200 decisions taken from each action in turn."""
    rows = table(spark, folder, "decisions", ["decision_id", "action"])
    rows = rows.withColumn("action", F.when(F.col("action").startswith("REMOVE"), "REMOVE").otherwise(F.col("action")))
    return review.round_robin(rows, "action", "decision_id", 200)


@query(f"WITH {S.ALL_SEGMENTS} SELECT segment_id, row_number() OVER (ORDER BY segment_id) - 1 AS ord, CAST((row_number() OVER (ORDER BY segment_id) - 1) // 25 + 1 AS BIGINT) AS batch_no FROM seg")
def l1_w1_batches(spark, folder):
    """Contiguous numbers and batches of 25 consecutive segments."""
    return review.with_batches(_segments(spark, folder), "segment_id", 25).select("segment_id", "ord", "batch_no")


_TERMS_OF = f"""c8 AS (SELECT s.segment_id, t.rk, t.n, t.term_id, t.term_src, t.term_tgt, {S.places('s.src', 't.term_src', 't.n')} AS ps FROM seg s JOIN term t ON contains(s.src, t.term_src)),
g8 AS (SELECT segment_id, list({{'rk': rk, 'n': n, 'ps': ps, 'term_id': term_id, 'src': term_src, 'tgt': term_tgt, 'p': CAST(0 AS BIGINT)}} ORDER BY rk) AS es FROM c8 GROUP BY segment_id),
f8 AS (SELECT segment_id, list_reduce(es, lambda acc, x: list_concat(acc, list_transform(
  list_filter(x.ps, lambda q: len(list_filter(acc, lambda o: q < o.p + o.n AND o.p < q + x.n)) = 0)[1:1], lambda q: {{'rk': x.rk, 'n': x.n, 'ps': x.ps, 'term_id': x.term_id, 'src': x.src, 'tgt': x.tgt, 'p': CAST(q AS BIGINT)}})), es[1:0]) AS ts FROM g8),
held AS (SELECT segment_id, list_transform(list_sort(list_transform(ts, lambda x: {{'p': x.p, 'term_id': x.term_id, 'src': x.src, 'tgt': x.tgt}})), lambda x: {{'term_id': x.term_id, 'zh-CN': x.src, 'ko': x.tgt}}) AS ts FROM f8)"""
_HEAD = json.dumps({"task": review.TASK, "allowed_actions": list(review.ACTIONS), "policy": list(review.POLICY), "output_schema": review.RESULT_SCHEMA}, ensure_ascii=False)[:-1].replace("'", "''") + ', "rows": '


@query(f"""WITH {_FEATURES}, {S.TERMS}, {_TERMS_OF}, numbered AS (SELECT f.*, coalesce(h.ts, []) AS ts, CAST((row_number() OVER (ORDER BY f.segment_id) - 1) // 25 + 1 AS BIGINT) AS batch_no FROM feat f LEFT JOIN held h USING (segment_id)),
items AS (SELECT batch_no, CAST(count(*) AS INTEGER) AS rows, to_json(list({{'segment_id': segment_id, 'zh-CN': src, 'ko': tgt, 'placeholder_tokens': ph, 'glossary_terms': ts}} ORDER BY segment_id)) AS items FROM numbered GROUP BY batch_no)
SELECT batch_no, rows, '{{"model":"model","temperature":0.0,"messages":[{{"role":"user","content":' || to_json('{_HEAD}' || items || '}}') || '}}]}}' AS payload FROM items""")
def l2_request_payloads(spark, folder):
    """One JSON request for each batch of 25 segments, with placeholders and terms of each row."""
    rows = review.with_matched_terms(review.with_features(_segments(spark, folder)), _terms(spark, folder))
    return review.request_payload(review.with_batches(rows, "segment_id", 25))


_KIND = "CASE WHEN decision_id % 11 = 0 THEN 'MAYBE' WHEN action = 'KEEP' THEN 'KEEP_SEGMENT' WHEN action = 'REWRITE' THEN 'REWRITE_KO' WHEN action = 'REVIEW' THEN 'REVIEW_UNCERTAIN' ELSE action END"
_CORRECTED = "CASE WHEN decision_id % 13 = 0 THEN '' ELSE corrected_ko END"
_KNOWN_ACTION = "kind IN (" + ", ".join(f"'{a}'" for a in review.ACTIONS) + ")"


@query(f"""WITH r AS (SELECT batch_no, segment_id, {_KIND} AS kind, coalesce(reason, '') AS reason, coalesce({_CORRECTED}, '') AS corrected, batch_no % 4 = 3 AS cut,
  row_number() OVER (PARTITION BY batch_no ORDER BY decision_id) AS i, count(*) OVER (PARTITION BY batch_no) AS n FROM decisions),
valid AS (SELECT * FROM r WHERE NOT cut OR (i <= n // 2 AND {_KNOWN_ACTION} AND reason <> '')), first_ AS (SELECT DISTINCT ON (batch_no, segment_id) * FROM valid ORDER BY batch_no, segment_id, i),
asked AS (SELECT DISTINCT batch_no, segment_id FROM r), j AS (SELECT a.batch_no, a.segment_id, a.batch_no % 4 = 3 AS late, f.i, coalesce(f.kind, '') AS kind, coalesce(f.reason, '') AS reason, coalesce(f.corrected, '') AS corrected FROM asked a LEFT JOIN first_ f USING (batch_no, segment_id)),
b AS (SELECT *, kind = 'REWRITE_KO' AND {S.strip('corrected')} = '' AS bare FROM j)
SELECT batch_no, segment_id, CASE WHEN NOT {_KNOWN_ACTION} OR bare THEN 'REVIEW_UNCERTAIN' ELSE kind END AS action,
  CASE WHEN i IS NULL AND late THEN 'response truncated by token limit' WHEN i IS NULL THEN 'segment omitted from LLM response' WHEN NOT {_KNOWN_ACTION} AND reason = '' THEN 'invalid action' WHEN reason = '' THEN 'no reason provided by LLM'
    WHEN bare THEN 'REWRITE_KO missing corrected_ko (original reason: ' || reason || ')' ELSE reason END AS reason, corrected FROM b""")
def l3_parsed_responses(spark, folder):
    """Responses made of the stored decisions, some cut by a limit, some with unknown actions or empty rewrites; completed for every expected row."""
    decisions = table(spark, folder, "decisions", ["decision_id", "segment_id", "action", "reason", "corrected_ko", "batch_no"])
    entry = F.to_json(F.struct("segment_id", F.expr(_KIND).alias("action"), "reason", F.expr(_CORRECTED).alias("corrected_ko")))
    listed = decisions.groupBy("batch_no").agg(F.transform(F.array_sort(F.collect_list(F.struct("decision_id", entry.alias("e")))), lambda x: x["e"]).alias("es"))
    half = F.floor(F.size("es") / 2).cast("int")
    cut = F.concat(F.array_join(F.slice("es", 1, half), ","), F.lit(","), F.substring(F.get("es", half), 1, 25))
    late = F.col("batch_no") % 4 == 3
    content = F.concat(F.lit('Here: {"results":['), F.when(late, cut).otherwise(F.concat(F.array_join("es", ","), F.lit("]}"))))
    responses = listed.select("batch_no", content.alias("content"), F.when(late, "length").otherwise("stop").alias("finish_reason"))
    return review.parse_responses(responses, decisions.select("batch_no", "segment_id").distinct(), finish="finish_reason")


_TERM_BATCHES = f"""{S.TERMS}, nb AS (SELECT term_id, term_src, term_tgt, CAST((row_number() OVER (ORDER BY term_id) - 1) // 25 + 1 AS BIGINT) AS batch_no,
  CASE WHEN length(term_src) >= 4 THEN 'KEEP_GAME_TERM' ELSE 'REMOVE_COMMON_WORD' END AS action, 'reason of ' || term_id AS reason FROM term)"""


def _term_answers(spark: SparkSession, folder: str, spoiled: bool) -> tuple[DataFrame, DataFrame]:
    """(responses, expected) of the glossary in batches of 25; with ``spoiled`` six of seven answers have a fault of their own."""
    terms = review.with_batches(_terms(spark, folder), "term_id", 25)
    kind = F.when(F.length("term_src") >= 4, review.KEEP_TERM).otherwise("REMOVE_COMMON_WORD")
    fault = F.col("batch_no") % 7 if spoiled else F.lit(0)
    entry = F.struct("term_id", kind.alias("action"), F.concat(F.lit("reason of "), "term_id").alias("reason"))
    listed = terms.groupBy("batch_no").agg(F.array_sort(F.collect_list(entry)).alias("es"))
    first = F.get("es", F.lit(0))
    other = lambda term, action, reason: F.concat(F.array(F.struct(term.alias("term_id"), action.alias("action"), reason.alias("reason"))), F.slice("es", 2, F.greatest(F.size("es") - 1, F.lit(0))))
    es = (
        F.when(fault == 1, F.concat("es", F.slice("es", 1, 1))).when(fault == 2, F.slice("es", 1, F.size("es") - 1)).when(fault == 3, F.concat("es", F.array(F.struct(F.lit("x").alias("term_id"), first["action"].alias("action"), F.lit("x").alias("reason")))))
        .when(fault == 4, other(first["term_id"], F.lit("MAYBE"), first["reason"])).when(fault == 5, other(first["term_id"], first["action"], F.lit(" "))).otherwise(F.col("es"))
    )
    content = F.when(fault == 6, "no answer").otherwise(F.to_json(F.struct(es.alias("results"))))
    return listed.select("batch_no", content.alias("content")), terms.select("batch_no", "term_id")


@query(f"""WITH {_TERM_BATCHES} SELECT DISTINCT batch_no, ['', 'twice', 'missing', 'unknown', 'invalid', 'without_reason', 'no_results'][batch_no % 7 + 1] AS errors FROM nb""")
def l5_strict_errors(spark, folder):
    """What makes answers of the glossary stage void, batch by batch."""
    return review.strict_errors(*_term_answers(spark, folder, True)).select("batch_no", F.array_join("errors", ";").alias("errors"))


@query(f"""WITH {_TERM_BATCHES} SELECT term_id AS original_term_id, action, CASE WHEN action = 'KEEP_GAME_TERM' THEN 'YES' ELSE 'NO' END AS keep, reason, term_src AS "zh-CN", term_tgt AS ko FROM nb""")
def v7_term_audit(spark, folder):
    """The glossary's audit from strictly parsed answers: which terms are kept."""
    return review.term_audit(review.parse_strict(*_term_answers(spark, folder, False)).drop("batch_no"), _terms(spark, folder))


_AUDIT = f"""{_OUTCOMES}, {_TERMS_OF}, listed AS (SELECT segment_id, array_to_string(list_transform(ts, lambda t: t.term_id || ':' || t."zh-CN" || '=>' || t.ko), '|') AS glossary_terms FROM held),
audit AS (SELECT o.decision_id, o.segment_id AS original_segment_id, o.final_action, o.action AS llm_action, o.validation_status, d.reason, o.errors AS validation_errors, array_to_string(o.ph, ';') AS placeholder_tokens,
  coalesce(l.glossary_terms, '') AS glossary_terms, CASE WHEN o.contaminated THEN 'YES' ELSE 'NO' END AS target_contamination, CASE WHEN o.structured THEN 'YES' ELSE 'NO' END AS structured_hint,
  o.src AS "zh-CN", o.tgt AS original_ko, o.c AS corrected_ko, CASE o.final_action WHEN 'REMOVE' THEN '' WHEN 'REWRITE' THEN o.c ELSE o.tgt END AS final_ko
  FROM outcome o JOIN decisions d ON o.decision_id = d.decision_id LEFT JOIN listed l ON o.segment_id = l.segment_id)"""


def _audit(spark: SparkSession, folder: str) -> DataFrame:
    return review.audit_rows(review.outcomes(_verdicts(spark, folder)))


@query(f"WITH {_AUDIT} SELECT * FROM audit")
def v6_audit_rows(spark, folder):
    """The audit of all decisions."""
    return _audit(spark, folder)


@query(f"""WITH {_AUDIT} SELECT row_number() OVER (ORDER BY decision_id) AS removed_id, original_segment_id, validation_status AS remove_reason, llm_action, reason, "zh-CN", original_ko AS ko, corrected_ko FROM audit WHERE final_action = 'REMOVE'""")
def v6_removed_rows(spark, folder):
    """Removed segments, numbered."""
    return review.project(_audit(spark, folder), "removed")


@query(f"""WITH {_AUDIT} SELECT row_number() OVER (ORDER BY decision_id) AS rewrite_id, original_segment_id, reason, "zh-CN", original_ko, final_ko AS corrected_ko, glossary_terms FROM audit WHERE final_action = 'REWRITE'""")
def v6_rewritten_rows(spark, folder):
    """Accepted rewrites, numbered."""
    return review.project(_audit(spark, folder), "rewritten")


@query(f"""WITH {_AUDIT} SELECT row_number() OVER (ORDER BY decision_id) AS failed_id, original_segment_id, reason, validation_errors, "zh-CN", original_ko, corrected_ko, glossary_terms FROM audit WHERE validation_status LIKE 'REWRITE_REJECTED%'""")
def v6_rewrite_failed_rows(spark, folder):
    """Rejected rewrites, numbered, with the checks that they failed."""
    return review.project(_audit(spark, folder), "rewrite_failed")


@query(f"""WITH a AS ({SQL['a12_reason_warnings']}), b AS ({SQL['a15_feature_warnings']})
SELECT 'batch ' || batch_no AS scope, 'reason_repetition_warning' AS warning, reason AS value, count, rate FROM a UNION ALL SELECT feature, warning, value, count, CAST(1.0 AS DOUBLE) FROM b""")
def u1_all_warnings(spark, folder):
    """Both kinds of warnings in one list."""
    return review.all_warnings(a12_reason_warnings(spark, folder), a15_feature_warnings(spark, folder))


_SPLIT = """placed AS (SELECT segment_id, row_number() OVER (ORDER BY md5('42|' || segment_id), segment_id) - 1 AS o, count(*) OVER () AS n FROM training_examples),
sized AS (SELECT segment_id, o, CASE WHEN n >= 3 THEN greatest(1, CAST(floor(n * 0.1) AS BIGINT)) ELSE CAST(floor(n * 0.1) AS BIGINT) END AS k FROM placed)"""


@query(f"WITH {_SPLIT} SELECT segment_id, CASE WHEN o < k THEN 'validation' WHEN o < 2 * k THEN 'test' ELSE 'train' END AS split FROM sized")
def t1_exact_split(spark, folder):
    """Training examples in exact, repeatable splits of 80, 10 and 10 per cent."""
    return training.exact_split(table(spark, folder, "training_examples", ["segment_id"]), "segment_id")


@query("SELECT row_number() OVER (ORDER BY b.i, l.i, r.i) - 1 AS combo_id, b.v AS beams, l.v AS length_penalty, r.v AS no_repeat FROM (SELECT unnest([1, 4, 5]) AS v, unnest([0, 1, 2]) AS i) b, (SELECT unnest([CAST(1.0 AS DOUBLE), CAST(1.1 AS DOUBLE), CAST(1.2 AS DOUBLE)]) AS v, unnest([0, 1, 2]) AS i) l, (SELECT unnest([0, 3]) AS v, unnest([0, 1]) AS i) r")
def a22_parameter_grid(spark, folder):
    """All combinations of three decoding parameters."""
    return training.parameter_grid(spark, {"beams": [1, 4, 5], "length_penalty": [1.0, 1.1, 1.2], "no_repeat": [0, 3]})


@query("""WITH p AS (SELECT segment_id, count(*) AS n FROM decisions GROUP BY 1), e AS (SELECT segment_id FROM segments EXCEPT SELECT segment_id FROM decisions)
SELECT (SELECT count(*) FROM e) AS without_decision, (SELECT count(*) FROM p WHERE n > 1) AS with_several, (SELECT count(*) FROM decisions d ANTI JOIN segments s USING (segment_id)) AS unknown""")
def u2_j7_decision_coverage(spark, folder):
    """Segments without a decision, with several, and decisions on unknown segments."""
    ids, known = table(spark, folder, "segments", ["segment_id"]), table(spark, folder, "decisions", ["segment_id"])
    missing = ids.join(known, "segment_id", "left_anti").agg(F.count("*").alias("without_decision"))
    several = known.groupBy("segment_id").count().where("count > 1").agg(F.count("*").alias("with_several"))
    unknown = known.join(ids, "segment_id", "left_anti").agg(F.count("*").alias("unknown"))
    return missing.join(several).join(unknown)
