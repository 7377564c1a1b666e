"""Resumable model batches: a small state machine on the driver around Spark's
request and answer files, and the two cleanup stages from rows to audit."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomline.operators import review
from loomline.sources import sinks
from loomline.sources.files import content_hash

#: States of a batch job in their order.
STATES = ("init", "input_written", "uploaded", "submitted", "completed", "downloaded")


@dataclass
class BatchJob:
    """A job whose state is saved after every step; a new run goes on where the last one stopped.

    ``steps`` maps the state that a step leads to to a function of the saved
    values that returns what to add to them.  The state names the hash of the
    input file, if any: a job whose input has changed since is an error.
    """

    path: str
    steps: dict[str, Callable[[dict], dict]]
    values: dict = field(default_factory=dict)

    def run(self, until: str = STATES[-1]) -> dict:
        """Runs the steps that are left, up to a state; returns the saved values."""
        state = sinks.load_state(self.path) or {"state": STATES[0], "values": dict(self.values)}
        expected = state["values"].get("input_hash")
        if expected and content_hash(state["values"]["input"]) != expected:
            raise ValueError(f"{state['values']['input']} changed since the job began")
        for name in STATES[STATES.index(state["state"]) + 1 : STATES.index(until) + 1]:
            step = self.steps.get(name)
            added = step(dict(state["values"])) if step else {}
            state = {"state": name, "values": {**state["values"], **(added or {})}}
            sinks.save_state(self.path, state)
        return state["values"]


def answers_for(responses: DataFrame, payloads: DataFrame, batch: str = "batch_no") -> DataFrame:
    """The answers of a batch file joined to the requests by ``custom_id``; a request without an answer is an error.

    Needs ``custom_id`` on both sides; adds the batch to every answer.
    """
    joined = payloads.select(batch, "custom_id").join(responses, "custom_id", "left")
    known = F.when(F.col("content").isNull() & F.col("error").isNull(), F.raise_error(F.concat(F.lit("no answer to "), F.col("custom_id")))).otherwise(F.col(batch))
    return joined.withColumn(batch, known)


def clean_with_model(segments: DataFrame, terms: DataFrame, ask: Callable[[DataFrame], DataFrame], batch_rows: int = 25) -> DataFrame:
    """The segment stage from rows to audit.

    ``ask`` turns (batch_no, rows, payload) into (batch_no, content); every row
    gets a decision, is validated and audited.  ``decision_id`` is the row's number.
    """
    from loomline.functions.lineage import checkpointed

    rows = review.with_matched_terms(review.with_features(segments), terms)
    batches = checkpointed(review.with_batches(rows, "segment_id", batch_rows))
    answers = checkpointed(ask(review.request_payload(batches)))
    decided = review.parse_responses(answers, batches.select("batch_no", "segment_id"))
    joined = batches.join(decided, ["batch_no", "segment_id"]).withColumn("decision_id", F.col("ord") + 1)
    wanted = F.transform("matched_terms", lambda t: t["tgt"])
    errors = review.rewrite_errors(F.col("src"), F.col("tgt"), F.col("corrected"), F.col("placeholders"), wanted)
    checked = joined.withColumn("errors", F.when(F.col("action").startswith("REWRITE"), errors).otherwise(F.array().cast("array<string>")))
    return review.audit_rows(review.outcomes(checked))


def clean_terms_with_model(terms: DataFrame, ask: Callable[[DataFrame], DataFrame], batch_rows: int = 25, attempts: int = 3) -> DataFrame:
    """The glossary stage from terms to audit; a batch with a void answer is asked again whole.

    After the last attempt void answers are an error.
    """
    from loomline.functions.lineage import checkpointed

    batches = checkpointed(review.with_batches(terms, "term_id", batch_rows))
    entry = F.struct("term_id", F.col("term_src").alias("zh-CN"), F.col("term_tgt").alias("ko"))
    asked = batches.groupBy("batch_no").agg(F.array_sort(F.collect_list(entry)).alias("rows"))  # a batch has a bounded size
    payloads = asked.select("batch_no", F.to_json(F.struct(F.array(*map(F.lit, review.TERM_ACTIONS)).alias("allowed_actions"), "rows")).alias("payload"))
    expected, good = batches.select("batch_no", "term_id"), None
    for attempt in range(attempts):
        answers = checkpointed(ask(payloads))
        due = expected.join(payloads.select("batch_no"), "batch_no", "left_semi")
        errors = checkpointed(review.strict_errors(answers, due))
        fine = answers.join(errors.where(F.size("errors") == 0).select("batch_no"), "batch_no", "left_semi")
        good = fine if good is None else good.unionByName(fine)
        payloads = payloads.join(errors.where(F.size("errors") > 0).select("batch_no"), "batch_no", "left_semi")
        if payloads.isEmpty():
            break
    return review.term_audit(review.parse_strict(good, expected).drop("batch_no"), terms)


def generate(records: DataFrame, translate: Callable[[DataFrame], DataFrame], path: str, limit: int | None = None, provenance: dict | None = None) -> dict:
    """Translates records, writes them in the layout of generations and returns what was done.

    ``limit`` takes the first rows by id, for trial runs; ``provenance`` is added to the record of the run.
    """
    rows = records if limit is None else records.orderBy("segment_id").limit(limit)
    done = translate(rows).withColumnRenamed("candidate", "candidates")
    sinks.write_generation(done, path)
    written = records.sparkSession.read.csv(path, header=True, quote='"', escape='"', multiLine=True)
    counts = written.agg(F.count("*").alias("rows"), F.count_if(F.coalesce("candidates", F.lit("")) == "").alias("empty")).first()
    return {"path": path, "rows": counts["rows"], "empty": counts["empty"], "limit": limit, **(provenance or {})}
