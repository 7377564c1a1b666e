"""Queries that go through files: written into the shared folder, read back by the scans, with their SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomline.functions.lineage import shared_folder
from loomline.functions.text import BLANK
from loomline.operators import providers, review, training
from loomline.plans import sqlparts as S
from loomline.plans.corpus import _segments, _terms
from loomline.sources import files, sinks
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


def _place(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


@query(f"WITH {S.SEGMENTS} SELECT segment_id, src, tgt FROM seg")
def s1_s2_k1_csv_round_trip(spark, folder):
    """Segments written as quoted CSV and scanned again: quotes, line breaks and commas survive."""
    path = _place(spark, "csv")
    sinks.write_csv(table(spark, folder, "segments", ["segment_id", "zh-CN", "ko", "source_file"], spread=True), path, ["segment_id", "zh-CN", "ko", "source_file"])
    return scans.segments(files.read_csv(spark, path, ["segment_id", "zh-CN", "ko"]))


def _answers(spark: SparkSession, folder: str) -> DataFrame:
    """A file of batch answers, one for each batch of decisions, scanned."""
    decisions = table(spark, folder, "decisions", ["batch_no", "decision_id", "reason"])
    grouped = decisions.groupBy("batch_no").agg(F.count("*").alias("n"), F.sum(F.length(F.coalesce("reason", F.lit("")))).alias("chars"), F.min("decision_id").alias("first"))
    usage = F.struct(F.col("n").alias("prompt_tokens"), F.col("chars").alias("completion_tokens"), (F.col("n") + F.col("chars")).alias("total_tokens"))
    message = F.struct(F.concat(F.lit('{"first": "'), F.col("first").cast("string"), F.lit('"}')).alias("content"))
    body = F.struct(F.array(F.struct(F.when(F.col("n") > 20, "length").otherwise("stop").alias("finish_reason"), message.alias("message"))).alias("choices"), usage.alias("usage"))
    path = _place(spark, "answers")
    grouped.select(F.to_json(F.struct(F.format_string("b-%d", "batch_no").alias("custom_id"), F.struct(body.alias("body")).alias("response")))).write.text(path)
    return files.read_batch_output(spark, path)


_ANSWERS = "g AS (SELECT batch_no, count(*) AS n, CAST(sum(length(coalesce(reason, ''))) AS BIGINT) AS chars, min(decision_id) AS first FROM decisions GROUP BY batch_no)"


@query(f"""WITH {_ANSWERS} SELECT 'b-' || batch_no AS custom_id, CASE WHEN n > 20 THEN 'length' ELSE 'stop' END AS finish_reason, '{{"first": "' || first || '"}}' AS content, n AS prompt_tokens FROM g""")
def s19_l7_batch_answers(spark, folder):
    """Answers of a batch file: id, reason of the end, content and tokens."""
    return _answers(spark, folder).select("custom_id", "finish_reason", "content", F.col("usage.prompt_tokens").alias("prompt_tokens"))


@query(f"WITH {_ANSWERS} SELECT CAST(sum(n) AS BIGINT) AS prompt_tokens, CAST(sum(chars) AS BIGINT) AS completion_tokens, CAST(sum(n + chars) AS BIGINT) AS total_tokens FROM g")
def a18_token_usage(spark, folder):
    """Tokens of all answers."""
    return files.token_usage(_answers(spark, folder))


def _history(spark: SparkSession, folder: str) -> DataFrame:
    """A trainer's log made of the decisions, one entry for each, written as its state and scanned."""
    rows = table(spark, folder, "decisions", ["decision_id", "batch_no", "reason", "corrected_ko"])
    loss = F.when(F.col("decision_id") % 3 == 0, F.length("reason").cast("double"))
    score = F.when(F.col("decision_id") % 2 == 0, F.length("corrected_ko").cast("double"))
    entry = F.struct(F.col("batch_no").cast("double").alias("epoch"), loss.alias("loss"), score.alias("score"))
    log = rows.agg(F.transform(F.array_sort(F.collect_list(F.struct("decision_id", entry.alias("e")))), lambda x: x["e"]).alias("log_history"))  # a log is one small file
    path = _place(spark, "state")
    log.coalesce(1).write.json(path)
    return files.read_log_history(spark, path, ["loss", "score"])


_HISTORY = """h AS (SELECT CAST(batch_no AS DOUBLE) AS epoch, row_number() OVER (ORDER BY decision_id) - 1 AS step, CASE WHEN decision_id % 3 = 0 THEN CAST(length(reason) AS DOUBLE) END AS loss,
  CASE WHEN decision_id % 2 = 0 THEN CAST(length(corrected_ko) AS DOUBLE) END AS score FROM decisions)"""


@query(f"WITH {_HISTORY} SELECT epoch, arg_min(loss, step) FILTER (WHERE loss IS NOT NULL) AS loss, arg_min(score, step) FILTER (WHERE score IS NOT NULL) AS score FROM h WHERE epoch > (SELECT min(epoch) FROM h) GROUP BY epoch")
def s20_a19_epoch_log(spark, folder):
    """The first logged values of each epoch but the first."""
    return training.epoch_log(_history(spark, folder), ["loss", "score"])


@query(f"WITH {_HISTORY} SELECT arg_max(loss, step) FILTER (WHERE loss IS NOT NULL) AS loss FROM h")
def a20_last_logged(spark, folder):
    """The last value of a logged column."""
    return training.last_logged(_history(spark, folder), "loss")


def _lengths():
    """A provider: number of characters and of words of each text."""
    return lambda texts: [(len(t), len(t.split())) for t in texts]


@query(f"WITH {S.ALL_SEGMENTS} SELECT segment_id, CAST(length(tgt) AS INTEGER) AS characters, CAST(len(list_filter(regexp_split_to_array(tgt, '{BLANK}+'), lambda w: w <> '')) AS INTEGER) AS words FROM seg")
def g23_j10_distinct_cache(spark, folder):
    """A provider called once for each distinct text, joined back to all rows."""
    from pyspark.sql import types as T

    fields = T.StructType([T.StructField("characters", T.IntegerType()), T.StructField("words", T.IntegerType())])
    return providers.map_distinct(_segments(spark, folder, "keep"), "tgt", _lengths, fields).select("segment_id", "characters", "words")


@query(f"""WITH {S.ALL_SEGMENTS}, n AS (SELECT segment_id, CAST((row_number() OVER (ORDER BY segment_id) - 1) // 25 + 1 AS BIGINT) AS batch_no FROM seg), k AS (SELECT max(batch_no) AS m FROM n),
z AS (SELECT m, greatest(1, CAST(floor(60000 / (3500 + 4096)) AS BIGINT)) AS s FROM k), c AS (SELECT greatest(1, CAST(ceil(m / CAST(ceil(m / s) AS DOUBLE)) AS BIGINT)) AS s FROM z)
SELECT DISTINCT batch_no, (batch_no - 1) // s + 1 AS chunk_no FROM n, c""")
def l10_token_chunks(spark, folder):
    """Batches in chunks that fit a budget of tokens together."""
    batches = review.with_batches(_segments(spark, folder, "keep"), "segment_id", 25).select("batch_no").distinct()
    most = batches.agg(F.max("batch_no").alias("m")).first()["m"]
    return review.token_chunks(batches, "batch_no", most, 4096, budget=60_000)


@query(f"""WITH {S.TERMS} SELECT count(*) <= 100 AND count(*) FILTER (WHERE length(term_src) > 8) = 0 AS ok, CASE WHEN count(*) > 100 THEN 'too many items' WHEN count(*) FILTER (WHERE length(term_src) > 8) > 0 THEN 'text too long' END AS error FROM term""")
def i4_request_check(spark, folder):
    """Whether the glossary would be a valid request of a hundred short texts."""
    return providers.too_many(_terms(spark, folder), "term_src", 100, 8)
