import pytest
from pyspark.sql import types as T

from loomline.operators import providers


def test_distinct_texts_are_asked_once(spark, tmp_path):
    log = tmp_path / "asked"
    log.mkdir()

    def factory():
        def provider(texts):
            for t in texts:
                (log / t).write_text("x") if not (log / t).exists() else (log / f"{t}-again").write_text("x")
            return [(len(t), t.upper()) for t in texts]

        return provider

    df = spark.createDataFrame([(1, "a"), (2, "bb"), (3, "a"), (4, None)], "id long, t string")
    fields = T.StructType([T.StructField("n", T.IntegerType()), T.StructField("u", T.StringType())])
    got = {r["id"]: (r["n"], r["u"]) for r in providers.map_distinct(df, "t", factory, fields).collect()}
    assert got == {1: (1, "A"), 2: (2, "BB"), 3: (1, "A"), 4: (None, None)}
    assert sorted(p.name for p in log.iterdir()) == ["a", "bb"]
    with pytest.raises(ValueError):
        providers.map_distinct(df, "t", factory, T.StructType([T.StructField("id", T.LongType())]))


def test_tokenize_and_translate(spark):
    df = spark.createDataFrame([("1", "a b c", "x y"), ("2", "d", "z")], "id string, s string, t string")
    words = lambda: lambda texts, most: [[len(w) for w in t.split()][:most] for t in texts]
    rows = {r["id"]: (r["input_ids"], r["attention_mask"], r["labels"]) for r in providers.tokenize_examples(df, "s", "t", words, 2, 5).collect()}
    assert rows == {"1": ([1, 1], [1, 1], [1, 1]), "2": ([1], [1], [1])}
    model = lambda: lambda texts: [f" <start>{t}<end>! " for t in texts]
    assert {r["candidate"] for r in providers.translate(df, "s", model, batch=1).collect()} == {"a b c!", "d!"}
    with pytest.raises(Exception, match="no tokens"):
        providers.tokenize_examples(df.limit(1).withColumn("s", df.s.substr(1, 0)), "s", "t", words, 2, 5).collect()


def test_client_is_tried_again(spark):
    def factory():
        calls = {}

        def client(payload):
            calls[payload] = calls.get(payload, 0) + 1
            if payload == "never" or payload == "late" and calls[payload] < 3:
                raise TimeoutError("busy")
            return payload.upper()

        return client

    df = spark.createDataFrame([(1, "now"), (2, "late"), (3, "never")], "batch_no long, payload string")
    got = {r["batch_no"]: (r["content"], r["error"]) for r in providers.ask(df, factory, wait=0.01).collect()}
    assert got == {1: ("NOW", None), 2: ("LATE", None), 3: (None, "TimeoutError: busy")}


def test_request_checks(spark):
    df = spark.createDataFrame([("a",), (" ",)], "t string")
    assert providers.too_many(df, "t", 5, 10).first()["error"] == "blank text"
    assert providers.too_many(df.limit(1), "t", 5, 10).first()["ok"]
    assert providers.too_many(df, "t", 1, 10).first()["error"] == "too many items"
