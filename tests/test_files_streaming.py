import json

import pytest
from pyspark.sql import functions as F

from loomline.operators import review
from loomline.sources import files, sinks
from loomline.streaming import segments as stream


def test_csv_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("1", 'a "q"\nline', "가"), ("2", "b,c", None)], "segment_id string, `zh-CN` string, ko string")
    sinks.write_csv(df, str(tmp_path / "out"), ["segment_id", "zh-CN"])
    got = files.read_csv(spark, str(tmp_path / "out"), ["segment_id", "zh-CN"])
    assert sorted(tuple(r) for r in got.collect()) == [("1", 'a "q"\nline'), ("2", "b,c")]
    assert sinks.export_csv(df, str(tmp_path / "one.csv"), ["segment_id", "zh-CN", "ko"], "segment_id") == 2
    again = files.read_csv(spark, str(tmp_path / "one.csv"), ["segment_id", "ko"])
    assert sorted(r["segment_id"] for r in again.collect()) == ["1", "2"]
    with pytest.raises(ValueError):
        files.read_csv(spark, str(tmp_path / "one.csv"), ["none"])


def test_words_rules_state_and_hash(tmp_path):
    path = tmp_path / "w.txt"
    path.write_text("﻿# c\na\n\nb\n", encoding="utf-8")
    assert files.read_words(str(path)) == ["a", "b"]
    digest = files.content_hash(str(path))
    files.require_hash(str(path), digest.lower())
    path.write_text("a\na\n")
    with pytest.raises(ValueError):
        files.read_words(str(path))
    with pytest.raises(ValueError):
        files.require_hash(str(path), digest)
    state = str(tmp_path / "s.json")
    assert sinks.load_state(state) is None
    sinks.save_state(state, {"step": 1})
    assert sinks.load_state(state) == {"step": 1} == files.read_rules(state)


def test_batch_files(spark, tmp_path):
    body = {"choices": [{"finish_reason": "stop", "message": {"content": "{}"}}], "usage": {"prompt_tokens": 2, "completion_tokens": 1, "total_tokens": 3}}
    lines = [json.dumps({"custom_id": f"seg-batch-000{i}", "error": None, "response": {"body": body}}) for i in (1, 2)]
    path = tmp_path / "o.jsonl"
    path.write_text("\n".join(lines))
    got = files.read_batch_output(spark, str(path))
    assert sorted(r["custom_id"] for r in got.collect()) == ["seg-batch-0001", "seg-batch-0002"]
    assert files.token_usage(got).first()["total_tokens"] == 6
    path.write_text("\n".join(lines + lines[:1]))
    with pytest.raises(Exception, match="custom_id"):
        files.read_batch_output(spark, str(path)).collect()
    rows = review.with_batches(review.with_features(spark.createDataFrame([("1", "a", "가"), ("2", "b", "나")], "segment_id string, src string, tgt string")), "segment_id", 1)
    sinks.write_requests(review.request_payload(rows), str(tmp_path / "req"))
    assert sorted(json.loads(r["value"])["custom_id"] for r in spark.read.text(str(tmp_path / "req")).collect()) == ["seg-batch-0001", "seg-batch-0002"]


def test_log_history(spark, tmp_path):
    path = tmp_path / "state.json"
    path.write_text(json.dumps({"log_history": [{"epoch": 0.5, "loss": 2.0}, {"epoch": 1.0, "eval": 0.1}]}))
    assert [tuple(r) for r in files.read_log_history(spark, str(path), ["loss", "eval"]).collect()] == [(0, 0.5, 2.0, None), (1, 1.0, None, 0.1)]


def test_renumbering_and_collation(spark):
    terms = spark.createDataFrame([("9", "中", "a"), ("8", "啊", "b"), ("7", "波", "c")], "term_id string, term_src string, term_tgt string")
    assert [r["term_src"] for r in sinks.sorted_glossary(terms).orderBy(F.col("term_id").cast("int")).collect()] == ["啊", "波", "中"]
    assert sorted((r["term_id"], r["term_src"]) for r in sinks.renumbered(terms, "term_id", "term_src").collect()) == [("1", "中"), ("2", "啊"), ("3", "波")]


def test_stream_equals_batch(spark, tmp_path):
    rows = [("1", '（获得）', "(획득)"), ("2", "宝箱", "宝箱"), ("3", None, None)]
    spark.createDataFrame(rows, stream.SEGMENTS).write.parquet(str(tmp_path / "in"))
    out = []
    query = stream.each_batch(stream.cleaned(stream.read_segments(spark, str(tmp_path / "in"))), lambda df, _: out.extend(df.select("segment_id", "src", "contamination").collect()), str(tmp_path / "cp"))
    query.awaitTermination(120)
    assert sorted(tuple(r) for r in out) == [("1", "获得", ""), ("2", "宝箱", "ko_contains_cjk"), ("3", "", "")]


def test_reviews_and_manifest(spark, tmp_path):
    audit = spark.createDataFrame([("1", "KEEP"), ("2", "REMOVE"), ("3", "REMOVE")], "id string, action string")
    sinks.write_reviews(str(tmp_path / "r"), audit, {"removed": "action = 'REMOVE'", "kept": "action = 'KEEP'"})
    assert spark.read.parquet(str(tmp_path / "r" / "removed")).count() == 2 and spark.read.parquet(str(tmp_path / "r" / "kept")).count() == 1
    source = tmp_path / "in.csv"
    source.write_text("x")
    manifest = sinks.write_manifest(str(tmp_path / "m.json"), {"in": str(source)}, audit.agg(F.count("*").alias("rows")), {"seed": 42})
    assert manifest["counts"] == {"rows": 3} and sinks.load_state(str(tmp_path / "m.json"))["inputs"]["in"]["sha256"] == files.content_hash(str(source))


def test_small_tables_are_spread(spark, tmp_path):
    from loomline.sources.tables import table

    spark.range(100).coalesce(1).write.parquet(str(tmp_path / "t.parquet"))
    assert table(spark, str(tmp_path), "t").rdd.getNumPartitions() == 1
    spread = table(spark, str(tmp_path), "t", spread=True)
    assert spread.rdd.getNumPartitions() > 1 and spread.count() == 100
