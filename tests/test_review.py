import json

from pyspark.sql import functions as F

from loomline.operators import review


def test_rewrite_checks(spark):
    df = spark.createDataFrame([
        ("获得{0}", "{0} 획득", "{0}개를 획득했습니다"), ("获得{0}", "{0} 획득", "획득"), ("获得", "획득", "{1} 획득"), ("获得", "획득", ""), ("获得", "획득", "获得"),
        ("获得", "획득", "번역: 획득"), ("获得", "획득", "획득" * 200), ("a", "가", "가 가 가 가 가 가 가 나"),
    ], "src string, tgt string, c string")
    df = review.with_features(df)
    got = [r[0] for r in df.select(review.rewrite_errors(F.col("src"), F.col("tgt"), F.col("c"), F.col("placeholders"))).collect()]
    assert got[:3] == [[], ["placeholder_missing"], ["placeholder_extra"]]
    assert got[3] == ["empty_corrected_ko", "corrected_ko_has_no_hangul", "length_ratio_outlier"]
    assert got[4] == ["corrected_ko_contains_cjk", "corrected_ko_has_no_hangul", "copy_or_explanation_like"]
    assert got[5] == ["copy_or_explanation_like"]
    assert got[6] == ["length_ratio_outlier", "excessive_repetition"]
    assert got[7] == ["excessive_repetition"]


def test_outcomes(spark):
    rows = [("REMOVE_BAD_PAIR", [], False), ("REWRITE", [], False), ("REWRITE", ["e"], True), ("REWRITE", ["e"], False), ("REVIEW", [], False), ("KEEP", [], False), (None, [], False)]
    df = spark.createDataFrame([(a, e, c, "원", "새") for a, e, c in rows], "action string, errors array<string>, contaminated boolean, tgt string, corrected string")
    got = [(r["final_action"], r["validation_status"], r["final_ko"]) for r in review.outcomes(df).collect()]
    assert got == [
        ("REMOVE", "REMOVE_REQUESTED", ""), ("REWRITE", "REWRITE_ACCEPTED", "새"), ("REMOVE", "REWRITE_REJECTED_REMOVE_CONTAMINATED", ""),
        ("KEEP", "REWRITE_REJECTED", "원"), ("REVIEW", "REVIEW", "원"), ("KEEP", "KEEP", "원"), ("KEEP", "KEEP", "원"),
    ]


def test_repeated_reasons(spark):
    df = spark.createDataFrame([(i, 1, r) for i, r in enumerate(["Same  x", "same x ", "SAME X", "other", "same x"])] + [(9, 2, "a")], "decision_id long, batch_no long, reason string")
    got = review.reason_warnings(df).collect()
    assert [(r["batch_no"], r["reason"], r["count"], r["rate"]) for r in got] == [(1, "Same  x", 4, 0.8)]
    assert review.most_repeated_reason(df).first()["count"] == 4


def test_feature_warnings(spark):
    df = spark.createDataFrame([("KEEP", a, True, i < 3) for i, a in enumerate("XXXXY")], "final_action string, action string, f boolean, g boolean")
    got = {(r["feature"], r["warning"], r["value"], r["count"]) for r in review.feature_warnings(df, ["f", "g"]).collect()}
    assert got == {("f", "surface_feature_single_final_action_warning", "KEEP", 5)}


def test_round_robin_and_numbers(spark):
    df = spark.createDataFrame([(i, a) for i, a in enumerate(["KEEP"] * 5 + ["REMOVE"] * 2)], "id long, action string")
    assert [r["id"] for r in review.round_robin(df, "action", "id", 4).collect()] == [5, 0, 6, 1]
    assert review.round_robin(df, "action", "id", 0).count() == 0
    assert [r["batch_no"] for r in review.with_batches(df, "id", 3).orderBy("id").collect()] == [1, 1, 1, 2, 2, 2, 3]
    assert review.with_ordinal(df.limit(0), "id").count() == 0


def test_responses(spark):
    whole = {"results": [
        {"segment_id": "1", "action": "KEEP_SEGMENT", "reason": "ok"}, {"segment_id": "1", "action": "REWRITE_KO", "reason": "later", "corrected_ko": "x"},
        {"segment_id": "2", "action": "NONSENSE", "reason": "?"}, {"segment_id": "9", "action": "KEEP_SEGMENT", "reason": "unknown"}, {"segment_id": "3", "action": "REWRITE_KO", "reason": "r", "corrected_ko": ""},
    ]}
    cut = '{"results": [{"segment_id": "5", "action": "KEEP_SEGMENT", "reason": "ok"}, {"segment_id": "6", "act'
    responses = spark.createDataFrame([(1, "Sure: " + json.dumps(whole)), (2, cut), (3, None)], "batch_no long, content string")
    expected = spark.createDataFrame([(1, "1"), (1, "2"), (1, "3"), (1, "4"), (2, "5"), (2, "6"), (3, "7")], "batch_no long, segment_id string")
    got = {r["segment_id"]: (r["action"], r["reason"]) for r in review.parse_responses(responses, expected).collect()}
    assert got["1"] == ("KEEP_SEGMENT", "ok") and got["2"] == ("REVIEW_UNCERTAIN", "?")
    assert got["3"][0] == "REVIEW_UNCERTAIN" and "missing corrected_ko" in got["3"][1]
    assert got["4"] == ("REVIEW_UNCERTAIN", "segment omitted from LLM response") == got["6"] == got["7"]
    assert got["5"] == ("KEEP_SEGMENT", "ok")
