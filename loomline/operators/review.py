"""Model verdicts on segments: validation of rewrites, outcomes, warnings, samples,
request batches and the parsing of responses."""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomline.functions.text import BLANK, MODEL_CLEANUP, filled, has_source, has_target, is_contaminated, normal_reason, preserves, strip

# Patterns of the model-cleanup stage.
PLACEHOLDER = r"\{[A-Za-z0-9_]+\}|%[sdif]|%\d+\$[sdif]|\$\{[^}]+\}|<key\d+>|<[^>\s]+>"
STRUCTURED = r"""^\s*[\{\[]\s*['"].*['"]\s*[\}\]]\s*$"""
EXPLANATION = r"(translation|corrected|번역|수정|설명|理由|原因|改写)"

# When a repeated reason or a uniform action is worth a warning.
REPEAT_RATE, REPEAT_ROWS, FEATURE_ROWS = 0.6, 5, 5


def placeholders(text: Column) -> Column:
    """Distinct placeholders of a text in order."""
    return F.array_sort(F.array_distinct(F.regexp_extract_all(filled(text), F.lit(PLACEHOLDER), F.lit(0))))


def with_features(df: DataFrame) -> DataFrame:
    """Adds ``placeholders``, ``contaminated`` and ``structured`` to (src, tgt)."""
    return df.withColumns({
        "placeholders": placeholders(F.concat_ws(" ", "src", "tgt")),
        "contaminated": is_contaminated(F.col("tgt")),
        "structured": F.col("src").rlike(STRUCTURED) | F.col("tgt").rlike(STRUCTURED),
    })


def bad_length(original: Column, corrected: Column, always: int = 240, longer: float = 4, shorter: float = 8) -> Column:
    """Whether a rewrite is far longer or shorter than what it replaces; up to ``always`` characters are never too long."""
    before, after = F.greatest(F.length(strip(original)), F.lit(1)), F.length(strip(corrected))
    return (after > F.greatest(F.lit(always), before * longer)) | (after < F.greatest(F.lit(1), F.floor(before / shorter)))


def repetitive(text: Column) -> Column:
    """Whether one word makes most of a text, or a part comes five times in a row."""
    words = F.filter(F.split(strip(text), f"{BLANK}+"), lambda w: w != "")
    most = F.array_max(F.transform(F.array_distinct(words), lambda w: F.size(F.filter(words, lambda x: x == w))))
    return F.when(F.size(words) >= 8, most / F.size(words) > 0.55).otherwise(filled(text).rlike(r"(.{2,12})\1{4,}"))


def rewrite_errors(src: Column, tgt: Column, corrected: Column, expected: Column, terms: Column | None = None) -> Column:
    """Names of the checks that a rewrite fails, in fixed order.

    ``expected`` are the row's placeholders, ``terms`` the expected target terms.
    """
    text = filled(corrected)
    own = placeholders(text)
    han = has_source(text, MODEL_CLEANUP)
    checks = [
        (strip(text) == "", "empty_corrected_ko"), (han, "corrected_ko_contains_cjk"), (~has_target(text, MODEL_CLEANUP), "corrected_ko_has_no_hangul"),
        (F.size(F.array_except(expected, own)) > 0, "placeholder_missing"), (F.size(F.array_except(own, expected)) > 0, "placeholder_extra"),
        (F.exists(terms, lambda t: ~preserves(text, t)) if terms is not None else F.lit(False), "glossary_term_missing"),
        (han | ((strip(src) != "") & (strip(text) == strip(src))) | text.rlike(EXPLANATION), "copy_or_explanation_like"),
        (bad_length(tgt, text), "length_ratio_outlier"), (repetitive(text), "excessive_repetition"),
    ]
    return F.array_compact(F.array(*(F.when(test, F.lit(name)) for test, name in checks)))


def outcomes(df: DataFrame) -> DataFrame:
    """Adds ``final_action``, ``validation_status`` and ``final_ko`` to rows with
    ``action``, ``errors``, ``contaminated``, ``tgt`` and ``corrected``.

    Actions: REMOVE..., REWRITE..., REVIEW..., anything else keeps the row.
    """
    action = F.upper(filled(F.col("action")))
    remove, rewrite, review = action.startswith("REMOVE"), action.startswith("REWRITE"), action.startswith("REVIEW")
    accepted = F.size("errors") == 0
    status = (
        F.when(remove, "REMOVE_REQUESTED").when(rewrite & accepted, "REWRITE_ACCEPTED").when(rewrite & F.col("contaminated"), "REWRITE_REJECTED_REMOVE_CONTAMINATED")
        .when(rewrite, "REWRITE_REJECTED").when(review, "REVIEW").otherwise("KEEP")
    )
    out = df.withColumn("validation_status", status)
    final = (
        F.when(F.col("validation_status").isin("REMOVE_REQUESTED", "REWRITE_REJECTED_REMOVE_CONTAMINATED"), "REMOVE")
        .when(F.col("validation_status") == "REWRITE_ACCEPTED", "REWRITE").when(F.col("validation_status") == "REVIEW", "REVIEW").otherwise("KEEP")
    )
    out = out.withColumn("final_action", final)
    return out.withColumn("final_ko", F.when(F.col("final_action") == "REMOVE", "").when(F.col("final_action") == "REWRITE", F.col("corrected")).otherwise(F.col("tgt")))


def reason_warnings(df: DataFrame, batch: str = "batch_no", reason: str = "reason", order: str = "decision_id", least_rate: float = REPEAT_RATE) -> DataFrame:
    """(batch, reason, count, rate) of batches where one reason makes up most rows.

    Reasons are compared in normal form; of equal counts the one seen first wins.
    """
    known = df.select(F.col(batch).alias("batch_no"), normal_reason(F.col(reason)).alias("normal"), F.col(reason).alias("reason"), F.col(order).alias("ord"))
    counts = known.groupBy("batch_no", "normal").agg(F.count("*").alias("count"), F.min("ord").alias("first"), F.min_by("reason", "ord").alias("reason"))
    best = counts.groupBy("batch_no").agg(F.sum("count").alias("rows"), F.min_by(F.struct("reason", "count"), F.struct(-F.col("count"), F.col("first"))).alias("top"))
    rate = F.col("top.count") / F.col("rows")
    return best.where((F.col("rows") >= REPEAT_ROWS) & (rate >= least_rate)).select("batch_no", "top.reason", "top.count", rate.alias("rate"))


def most_repeated_reason(df: DataFrame, reason: str = "reason") -> DataFrame:
    """(count, rate) of the most frequent reason over all rows."""
    counts = df.groupBy(normal_reason(F.col(reason)).alias("normal")).agg(F.count("*").alias("count"))
    return counts.agg(F.max("count").alias("count"), (F.max("count") / F.sum("count")).alias("rate"))


def feature_warnings(df: DataFrame, features: list[str], least: int = FEATURE_ROWS) -> DataFrame:
    """(feature, warning, value, count) where all rows of a feature share an action."""
    pairs = F.explode(F.array(*(F.struct(F.lit(f).alias("feature"), F.col(f).alias("on")) for f in features)))
    on = df.select(pairs.alias("x"), "final_action", "action").where("x.on")
    grouped = on.groupBy(F.col("x.feature").alias("feature")).agg(
        F.count("*").alias("count"), F.min("final_action").alias("f1"), F.max("final_action").alias("f2"), F.min("action").alias("a1"), F.max("action").alias("a2")
    ).where(F.col("count") >= least)
    kinds = F.array(
        F.when(F.col("f1") == F.col("f2"), F.struct(F.lit("surface_feature_single_final_action_warning").alias("warning"), F.col("f1").alias("value"))),
        F.when(F.col("a1") == F.col("a2"), F.struct(F.lit("surface_feature_single_llm_action_warning").alias("warning"), F.col("a1").alias("value"))),
    )
    return grouped.select("feature", F.explode(F.array_compact(kinds)).alias("w"), "count").select("feature", "w.warning", "w.value", "count")


def all_warnings(reasons: DataFrame, features: DataFrame) -> DataFrame:
    """Both kinds of warnings as one list: (scope, warning, value, count, rate)."""
    first = reasons.select(
        F.concat(F.lit("batch "), F.col("batch_no").cast("string")).alias("scope"), F.lit("reason_repetition_warning").alias("warning"), F.col("reason").alias("value"), "count", "rate"
    )
    second = features.select(F.col("feature").alias("scope"), "warning", "value", "count", F.lit(1.0).alias("rate"))
    return first.unionByName(second)


def audit_rows(df: DataFrame) -> DataFrame:
    """The audit of outcomes: one row for each decision with texts, checks and features as text.

    Needs the columns of ``outcomes`` with ``placeholders``, ``matched_terms``
    (structs of term_id, src, tgt), ``structured`` and ``contaminated``.
    """
    flag = lambda c: F.when(F.col(c), "YES").otherwise("NO")
    return df.select(
        "decision_id", F.col("segment_id").alias("original_segment_id"), "final_action", F.col("action").alias("llm_action"), "validation_status", "reason",
        F.array_join("errors", ";").alias("validation_errors"), F.array_join("placeholders", ";").alias("placeholder_tokens"), term_list(F.col("matched_terms")).alias("glossary_terms"),
        flag("contaminated").alias("target_contamination"), flag("structured").alias("structured_hint"), F.col("src").alias("zh-CN"), F.col("tgt").alias("original_ko"),
        F.col("corrected").alias("corrected_ko"), "final_ko",
    )


def term_list(terms: Column) -> Column:
    """``id:source=>target`` of each term, joined by bars."""
    return F.array_join(F.transform(terms, lambda t: F.concat(t["term_id"], F.lit(":"), t["src"], F.lit("=>"), t["tgt"])), "|")


#: The audit's projections: name, condition, name of the running number, columns.
PROJECTIONS = {
    "removed": ("final_action = 'REMOVE'", "removed_id", ["original_segment_id", "validation_status as remove_reason", "llm_action", "reason", "`zh-CN`", "original_ko as ko", "corrected_ko"]),
    "rewritten": ("final_action = 'REWRITE'", "rewrite_id", ["original_segment_id", "reason", "`zh-CN`", "original_ko", "final_ko as corrected_ko", "glossary_terms"]),
    "rewrite_failed": ("validation_status like 'REWRITE_REJECTED%'", "failed_id", ["original_segment_id", "reason", "validation_errors", "`zh-CN`", "original_ko", "corrected_ko", "glossary_terms"]),
    "review": ("final_action = 'REVIEW'", "review_id", ["original_segment_id", "llm_action", "reason", "`zh-CN`", "original_ko as ko", "glossary_terms"]),
}


def project(audit: DataFrame, name: str, order: str = "decision_id") -> DataFrame:
    """One of the audit's projections, numbered from 1 in the order of the decisions."""
    condition, number, columns = PROJECTIONS[name]
    rows = with_ordinal(audit.where(condition), order, "__ord")
    return rows.withColumn(number, F.col("__ord") + 1).selectExpr(number, *columns)


def round_robin(df: DataFrame, action: str, order: str, size: int, actions: tuple[str, ...] = ("REMOVE", "REWRITE", "REVIEW", "KEEP")) -> DataFrame:
    """The first ``size`` rows taken from each action in turn; size 0 gives none."""
    number = F.row_number().over(Window.partitionBy(action).orderBy(order))
    place = F.array_position(F.array(*map(F.lit, actions)), F.col(action))
    first = df.withColumn("turn", number).where(F.col("turn") <= size)  # no action can give more than all
    return first.withColumn("place", place).orderBy("turn", "place").limit(size).drop("place")


def with_batches(df: DataFrame, order: str, size: int, number: str = "batch_no") -> DataFrame:
    """Adds the number of the batch of ``size`` consecutive rows, from 1, in the order of a unique column.

    Rows are numbered range by range: a sorted repartition, the ranges' counts
    (one number each) and a window within each range.
    """
    return with_ordinal(df, order).withColumn(number, F.floor(F.col("ord") / size).cast("long") + 1)


def with_ordinal(df: DataFrame, order: str, name: str = "ord") -> DataFrame:
    """Adds a contiguous number from 0 in the order of a unique column, without one partition for all rows."""
    ranged = df.repartitionByRange(F.col(order)).withColumn("__part", F.spark_partition_id())
    from loomline.functions.lineage import checkpointed

    ranged = checkpointed(ranged)
    counts = {r["__part"]: r["n"] for r in ranged.groupBy("__part").agg(F.count("*").alias("n")).collect()}
    before, total = {}, 0
    for part in sorted(counts):
        before[part] = total
        total += counts[part]
    if not before:
        return ranged.drop("__part").withColumn(name, F.lit(0).cast("long"))
    offset = F.element_at(F.create_map(*(F.lit(x) for p in before.items() for x in p)), F.col("__part"))
    number = F.row_number().over(Window.partitionBy("__part").orderBy(order)) - 1
    return ranged.withColumn(name, (offset + number).cast("long")).drop("__part")


#: What the request asks for, in our words; callers may pass their own.
TASK = "Review every segment row by itself; rewrite only the Korean side, where it needs it."
POLICY = (
    "Judge each row by the meaning of its own two sides.",
    "Terms of the row are required wording; placeholders must stay as they are and are no reason to remove a row.",
    "Keep usable pairs, short interface texts too; remove rows that are no segment, a bad pair, or not in the target language.",
    "Rewrite only what follows clearly from the Chinese side and the terms; if in doubt ask for a review.",
    "Give a reason that names something in the row. Return nothing but JSON.",
)

#: Actions of the segment stage and of the glossary stage.
ACTIONS = ("KEEP_SEGMENT", "REMOVE_BAD_PAIR", "REMOVE_NON_SEGMENT", "REMOVE_TARGET_CONTAMINATION", "REVIEW_UNCERTAIN", "REWRITE_KO")
KEEP_TERM = "KEEP_GAME_TERM"
TERM_ACTIONS = (KEEP_TERM, "REMOVE_BAD_PAIR", "REMOVE_COMMON_WORD", "REMOVE_FRAGMENT", "REMOVE_NOT_COMPANY_GAME_TERM", "REMOVE_PHRASE_OR_SENTENCE")

RESULT_SCHEMA = {"results": [{"segment_id": "string", "action": "one of allowed_actions", "reason": "string", "corrected_ko": "string, empty unless REWRITE_KO"}]}


def with_matched_terms(df: DataFrame, terms: DataFrame) -> DataFrame:
    """Adds ``matched_terms``: (term_id, src, tgt) of each term at its first free place, by place."""
    from loomline.operators.matching import first_free_terms

    ids = first_free_terms(df, terms).select("segment_id", F.posexplode("terms").alias("__at", "term_id"))
    named = ids.join(terms.select("term_id", "term_src", "term_tgt"), "term_id")
    listed = named.groupBy("segment_id").agg(F.array_sort(F.collect_list(F.struct("__at", "term_id", F.col("term_src").alias("src"), F.col("term_tgt").alias("tgt")))).alias("__terms"))
    bare = F.transform("__terms", lambda t: F.struct(t["term_id"].alias("term_id"), t["src"].alias("src"), t["tgt"].alias("tgt")))
    joined = df.join(listed, "segment_id", "left")
    return joined.withColumn("matched_terms", F.when(F.col("__terms").isNotNull(), bare).otherwise(F.array().cast("array<struct<term_id:string,src:string,tgt:string>>"))).drop("__terms")


def request_items(df: DataFrame, batch: str = "batch_no") -> DataFrame:
    """(batch, rows, items): the rows of each batch as JSON, with placeholders and terms; never the local verdicts."""
    if "matched_terms" not in df.columns:
        df = df.withColumn("matched_terms", F.array().cast("array<struct<term_id:string,src:string,tgt:string>>"))
    named = F.transform("matched_terms", lambda t: F.struct(t["term_id"].alias("term_id"), t["src"].alias("zh-CN"), t["tgt"].alias("ko")))
    entry = F.struct("segment_id", F.col("src").alias("zh-CN"), F.col("tgt").alias("ko"), F.col("placeholders").alias("placeholder_tokens"), named.alias("glossary_terms"))
    grouped = df.groupBy(batch).agg(F.collect_list(F.struct("segment_id", entry.alias("e"))).alias("rows"))  # a batch has a bounded size
    by_id = lambda x, y: F.when(x["segment_id"] < y["segment_id"], -1).when(x["segment_id"] > y["segment_id"], 1).otherwise(0)
    ordered = F.transform(F.array_sort("rows", by_id), lambda r: r["e"])
    return grouped.select(batch, F.size("rows").alias("rows"), F.to_json(ordered).alias("items"))


def request_payload(df: DataFrame, batch: str = "batch_no", model: str = "model", temperature: float = 0.0, task: str = TASK, policy: Sequence[str] = POLICY, most_tokens: int | None = None) -> DataFrame:
    """(batch, rows, payload): one JSON request for each batch, with task, allowed
    actions, policy, the schema of the answer and the rows of ``request_items``."""
    head = json.dumps({"task": task, "allowed_actions": list(ACTIONS), "policy": list(policy), "output_schema": RESULT_SCHEMA}, ensure_ascii=False)
    items = request_items(df, batch)
    user = F.concat(F.lit(head[:-1] + ', "rows": '), F.col("items"), F.lit("}"))
    fields = [F.lit(model).alias("model"), F.lit(temperature).alias("temperature"), F.array(F.struct(F.lit("user").alias("role"), user.alias("content"))).alias("messages")]
    if most_tokens is not None:
        fields.append(F.lit(most_tokens).alias("max_tokens"))
    return items.select(batch, "rows", F.to_json(F.struct(*fields)).alias("payload"))


def token_chunks(df: DataFrame, batch: str, batches: int, output_tokens: int, budget: int = 1_800_000, prompt_tokens: int = 3500) -> DataFrame:
    """Adds ``chunk_no``: batches that fit a token budget together."""
    size = max(1, int(budget / (prompt_tokens + output_tokens)))
    chunks = -(-batches // size)
    size = max(1, -(-batches // max(1, chunks)))
    return df.withColumn("chunk_no", F.floor((F.col(batch) - 1) / size).cast("long") + 1)


RESULT = "results array<struct<segment_id:string,action:string,reason:string,corrected_ko:string>>"


def recover_prefix(content: str | None) -> str | None:
    """The whole objects at the front of a cut ``results`` list, as JSON."""
    if not content:
        return None
    start = content.find("[", max(0, content.find('"results"')))
    if start < 0:
        return None
    decoder, out, at = json.JSONDecoder(), [], start + 1
    while True:
        while at < len(content) and content[at] in " \t\r\n,":
            at += 1
        if at >= len(content) or content[at] != "{":
            break
        try:
            value, at = decoder.raw_decode(content, at)
        except ValueError:
            break
        out.append(value)
    return json.dumps({"results": out}, ensure_ascii=False)


def parse_responses(responses: DataFrame, expected: DataFrame, content: str = "content", batch: str = "batch_no", finish: str | None = None) -> DataFrame:
    """(batch, segment_id, action, reason, corrected) for every expected row.

    JSON may stand inside other text; a cut answer gives the results before the
    cut and its bad results count as omitted.  Ids that were not asked for are
    ignored, of repeated ids the first counts, unknown actions and rewrites
    without text become REVIEW_UNCERTAIN, rows without an answer too.  With
    ``finish`` (a column of finish reasons) an answer is cut where it says
    ``length``; without it where its JSON does not parse.
    """

    @F.pandas_udf(T.StringType())
    def recovered(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for values in batches:
            yield values.map(recover_prefix, na_action=None)

    text = F.col(content)
    whole = F.coalesce(F.from_json(text, RESULT)["results"], F.from_json(F.regexp_extract(text, r"(?s)\{.*\}", 0), RESULT)["results"])
    parsed = responses.withColumn("__whole", whole)
    parsed = parsed.withColumn("__cut", F.coalesce(F.col(finish) == "length", F.lit(False)) if finish else F.col("__whole").isNull())
    parsed = parsed.withColumn("__all", F.coalesce("__whole", F.from_json(recovered(F.when(F.col("__whole").isNull(), text)), RESULT)["results"]))
    each = parsed.select(batch, "__cut", F.posexplode("__all").alias("at", "r")).select(batch, "__cut", "at", "r.*")
    valid = F.col("action").isin(*ACTIONS) & (filled(F.col("reason")) != "")
    each = each.where(~F.col("__cut") | valid)
    first = each.groupBy(batch, "segment_id").agg(F.min_by(F.struct("action", "reason", "corrected_ko"), "at").alias("r"))
    joined = expected.join(parsed.select(batch, "__cut"), batch, "left").join(first, [batch, "segment_id"], "left")
    action, reason, corrected = filled(F.col("r.action")), filled(F.col("r.reason")), filled(F.col("r.corrected_ko"))
    bare = (action == "REWRITE_KO") & (strip(corrected) == "")
    final = F.when(~action.isin(*ACTIONS) | bare, "REVIEW_UNCERTAIN").otherwise(action)
    why = (
        F.when(F.col("r").isNull(), F.when(F.col("__cut") & F.lit(finish is not None), "response truncated by token limit").otherwise("segment omitted from LLM response"))
        .when(~action.isin(*ACTIONS) & (reason == ""), "invalid action")
        .when(reason == "", "no reason provided by LLM").when(bare, F.concat(F.lit("REWRITE_KO missing corrected_ko (original reason: "), reason, F.lit(")"))).otherwise(reason)
    )
    return joined.select(batch, "segment_id", final.alias("action"), why.alias("reason"), corrected.alias("corrected"))


TERM_RESULT = "results array<struct<term_id:string,action:string,reason:string>>"


def strict_errors(responses: DataFrame, expected: DataFrame, content: str = "content", batch: str = "batch_no") -> DataFrame:
    """(batch, errors) of every expected batch: what makes an answer of the glossary stage void.

    No answer, no ``results`` list, a term that was not asked for, twice or not
    at all, an unknown action, a missing reason.  A batch with any error is asked again whole.
    """
    parsed = responses.select(batch, F.from_json(F.regexp_extract(content, r"(?s)\{.*\}", 0), TERM_RESULT)["results"].alias("results"))
    each = parsed.select(batch, F.explode_outer("results").alias("r")).where("r is not null").select(batch, strip(F.col("r.term_id")).alias("term_id"), "r.action", "r.reason")
    wanted = expected.select(batch, "term_id", F.lit(True).alias("__asked"))
    met = each.join(wanted, [batch, "term_id"], "full")
    per_term = met.groupBy(batch, "term_id").agg(
        F.count_if(F.col("action").isNotNull() | F.col("reason").isNotNull()).alias("n"), F.max("__asked").alias("asked"),
        F.max(~F.coalesce(F.col("action").isin(*TERM_ACTIONS), F.lit(False))).alias("bad"), F.max(strip(filled(F.col("reason"))) == "").alias("mute"),
    )
    found = F.col("n") > 0
    per_batch = per_term.groupBy(batch).agg(
        F.max(found & F.col("asked").isNull()).alias("unknown"), F.max(F.col("n") > 1).alias("twice"), F.max(~found).alias("missing"),
        F.max(found & F.col("bad")).alias("invalid"), F.max(found & F.col("mute")).alias("without_reason"),
    )
    joined = expected.select(batch).distinct().join(parsed, batch, "left").join(per_batch, batch, "left")
    names = ("unknown", "twice", "missing", "invalid", "without_reason")
    listed = F.array_compact(F.array(F.when(F.col("results").isNull(), F.lit("no_results")), *(F.when(F.col(n), F.lit(n)) for n in names)))
    return joined.select(batch, F.when(F.col("results").isNull(), F.array(F.lit("no_results"))).otherwise(listed).alias("errors"))


def parse_strict(responses: DataFrame, expected: DataFrame, content: str = "content", batch: str = "batch_no") -> DataFrame:
    """(batch, term_id, action, reason) of all expected terms; any anomaly is an error while the query runs."""
    errors = strict_errors(responses, expected, content, batch)
    parsed = responses.select(batch, F.from_json(F.regexp_extract(content, r"(?s)\{.*\}", 0), TERM_RESULT)["results"].alias("results"))
    rows = errors.join(parsed, batch, "left").select(batch, "errors", F.explode_outer("results").alias("r"))
    void = F.raise_error(F.concat(F.lit("void answer to batch "), F.col(batch).cast("string"), F.lit(": "), F.array_join("errors", ", ")))
    return rows.select(batch, F.when(F.size("errors") > 0, void).otherwise(strip(F.col("r.term_id"))).alias("term_id"), "r.action", "r.reason")


def term_audit(decisions: DataFrame, terms: DataFrame) -> DataFrame:
    """(original_term_id, action, keep, reason, zh-CN, ko) of every decided term; only one action keeps it."""
    return terms.join(decisions, "term_id").select(
        F.col("term_id").alias("original_term_id"), "action", F.when(F.col("action") == KEEP_TERM, "YES").otherwise("NO").alias("keep"), "reason",
        F.col("term_src").alias("zh-CN"), F.col("term_tgt").alias("ko"),
    )
