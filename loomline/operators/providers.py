"""Adapters for models and services: taggers, encoders, tokenizers, translators
and chat clients come in as factories that each Python worker calls once."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomline.functions.text import strip, strip_markers


def map_distinct(df: DataFrame, column: str, factory: Callable[[], Callable[[list[str]], list[tuple]]], fields: T.StructType, batch: int = 96) -> DataFrame:
    """The table with ``fields`` computed once for each distinct text of a column.

    ``factory`` gives a function from texts to as many tuples.  Null texts get
    null fields; the distinct texts are joined back by an equi-join.
    """
    names = fields.names
    clash = set(names) & set(df.columns)
    if clash:
        raise ValueError(f"columns exist already: {sorted(clash)}")
    schema = T.StructType([T.StructField("__text", T.StringType()), *fields])

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        provider = factory()
        for frame in frames:
            texts = frame["__text"].tolist()
            rows = [row for i in range(0, len(texts), batch) for row in provider(texts[i : i + batch])]
            if len(rows) != len(texts):
                raise ValueError("the provider gave another number of results")
            yield pd.DataFrame([(t, *r) for t, r in zip(texts, rows)], columns=schema.names)

    known = df.select(F.col(f"`{column}`").alias("__text")).where("__text is not null").distinct().mapInPandas(run, schema)
    return df.join(known, F.col(f"`{column}`") == F.col("__text"), "left").drop("__text")


def tokenize_examples(df: DataFrame, source: str, target: str, factory: Callable, max_source: int, max_target: int) -> DataFrame:
    """Adds ``input_ids``, ``attention_mask`` and ``labels``.

    ``factory`` gives a function from texts and a length to lists of ids.  No
    padding: batches pad later.  A row without ids is an error.
    """
    kind = T.ArrayType(T.IntegerType())
    out = T.StructType([*df.schema, *(T.StructField(c, kind) for c in ("input_ids", "attention_mask", "labels"))])

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = factory()
        for frame in frames:
            ids, labels = encode(frame[source].tolist(), max_source), encode(frame[target].tolist(), max_target)
            if any(len(x) == 0 for x in [*ids, *labels]):
                raise ValueError("an example has no tokens")
            yield frame.assign(input_ids=ids, attention_mask=[[1] * len(x) for x in ids], labels=labels)

    return df.mapInPandas(run, out)


def translate(df: DataFrame, text: str, factory: Callable[[], Callable[[list[str]], list[str]]], out: str = "candidate", batch: int = 32) -> DataFrame:
    """The table with candidates of a model that each worker loads once; stripped, without markers."""
    schema = T.StructType([*df.schema, T.StructField("__raw", T.StringType())])

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = factory()
        for frame in frames:
            texts = frame[text].tolist()
            yield frame.assign(__raw=[c for i in range(0, len(texts), batch) for c in model(texts[i : i + batch])])

    return df.mapInPandas(run, schema).withColumn(out, strip_markers(strip(F.col("__raw")))).drop("__raw")


def ask(payloads: DataFrame, factory: Callable[[], Callable[[str], str]], batch: str = "batch_no", attempts: int = 3, longest_wait: float = 8.0, wait: float = 1.0) -> DataFrame:
    """(batch, content, error) of a client called once for each payload.

    Failures are tried again with doubled waits; what fails for good gives a row
    with its error.  Results are keyed by batch, so a task that runs twice gives
    the same rows; write them before use, or a lost executor asks again.
    """
    kind = payloads.schema[batch].dataType
    schema = T.StructType([T.StructField(batch, kind), T.StructField("content", T.StringType()), T.StructField("error", T.StringType())])

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        client = factory()
        for frame in frames:
            rows = []
            for number, payload in zip(frame[batch], frame["payload"]):
                content, error, pause = None, None, wait
                for attempt in range(attempts):
                    try:
                        content, error = client(payload), None
                        break
                    except Exception as failure:  # noqa: BLE001
                        error = f"{type(failure).__name__}: {failure}"
                        if attempt + 1 < attempts:
                            time.sleep(min(pause, longest_wait))
                            pause *= 2
                rows.append((number, content, error))
            yield pd.DataFrame(rows, columns=schema.names)

    return payloads.select(batch, "payload").mapInPandas(run, schema)


def too_many(items: DataFrame, text: str, most: int, longest: int) -> DataFrame:
    """(ok, error) of a request's items: their number, blank and overlong texts."""
    bad = items.agg(F.count("*").alias("n"), F.count_if(strip(F.col(text)) == "").alias("blank"), F.count_if(F.length(text) > longest).alias("long"))
    error = F.when(F.col("n") == 0, "no items").when(F.col("n") > most, "too many items").when(F.col("blank") > 0, "blank text").when(F.col("long") > 0, "text too long")
    return bad.select(error.isNull().alias("ok"), error.alias("error"))
