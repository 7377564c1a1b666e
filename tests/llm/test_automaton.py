"""The stack automaton decides first, for every script and either kind of prompt; the baseline second."""

import pytest

from loomline.llm import pairs, truncation
from loomline.llm.truncation import Judge, read

PROMPT = "正午，国王若追踪闪亮的徽章，古雅琳请归还微小的药剂！"
JUDGE = Judge(frozenset({"조건"}))


@pytest.mark.parametrize("text,sentence,rendered,reason", [
    ('그는 "안녕하세요', True, None, "quote"), ('He said "hello (wor', True, None, "bracket"), ("레벨 10 이상 필요(", False, "需要10级以上（需组队）", "bracket"), ("<start>보스 도전", False, None, "markup"),
    ("《전설의 검", False, "《传说之剑》", "bracket"), ("国王（追踪", False, None, "bracket"), ("국왕이 휘장 <b>약제", False, "<b>药剂</b>", "markup"), ("보상: \\u00", False, None, "token"), ("a &am", False, None, "token"),
    ("국왕이 추적합니다. 기사가 �", True, None, "character"), ("국왕이 추적하면,", False, "国王追踪", "pause"), ("국왕이 휘장을", True, None, "clause"), ("정교한 청동", True, None, "terminator"),
    ("레벨 10 (", False, "10级（", None), ('15" 모니터', False, None, None), ("R&D", False, "R&D", None), ("100%", False, None, None), ("50 $", False, None, None), ("플레이어 :( 국왕이 추적합니다", True, None, None),
    ("전투<end> 전에 <start>우노제가 편지를 사용했습니다.", True, None, None), ("국왕이 됩니다..\"", True, None, None), ("국왕이 추적합니다. (수정)", True, None, None), ("국왕이 \"추적하자!\"라고 말했습니다", True, None, None),
    ("it's the players' item", False, None, None), ("버전 3.5", False, None, None), ("국왕이 추적합니<start>다<end>", True, None, None), ("<br>청동 거울", False, None, None), ("청동 거울,", False, "铜镜，", None),
])
def test_reasons(text, sentence, rendered, reason):
    assert JUDGE.reason(text, sentence, 1.0, rendered) == reason


def test_rows_that_only_the_automaton_or_only_the_baseline_finds(spark, monkeypatch):
    good = "정오에 국왕이 휘장을 추적하면 약제를 반환하십시오."
    rows = [(i, PROMPT, good, "good") for i in range(60)] + [(100, "《传说之剑》", "《전설의 검", "good"), (101, PROMPT, "정교하고 매우 값비싼 청동 거울 그리고 오래된 약제 청동 거울 약제", "good")]
    rows += [(200 + i, PROMPT, "정교하고 매우 값비싼 청동 거울 그리고 오래된 약제 청동 거울 방패", "nouns") for i in range(60)]
    df = spark.createDataFrame(rows, "id long, z string, k string, source string")
    whole = {r["id"]: r["cut_reason"] for r in truncation.find_cut_off(df, "k", "z", "source").where("cut_off").collect()}
    assert whole == {100: "bracket", 101: "terminator"}
    monkeypatch.setattr(truncation, "LEAST_BASELINE", 0.0)
    assert JUDGE.reason("정교한 청동", True, 0.1) == "terminator"
    monkeypatch.setattr(truncation, "LEAST_BASELINE", 0.5)
    assert JUDGE.reason("정교한 청동", True, 0.1) is None


def test_whole_texts_are_read():
    """No part of a text is left out, and no form changes with its size."""
    long = "국왕이 휘장을 추적합니다. " * 3000
    assert JUDGE.reason("(" + long, True) == "bracket" and JUDGE.reason(long, True) is None and JUDGE.reason(long + "기사가 휘장을", True) == "clause"
    assert read("가" * 5000 + " 추적합니다" + "!" * 5000).word == "추적합니다"


def test_long_prompts_follow_the_same_rule(spark):
    heading = "的" .join(["铜镜"] * 400)
    rows = [(1, heading, "a"), (2, "国王追踪徽章" * 100 + "，骑士归还龙蛋", "a"), (3, "国王追踪徽章，骑士归还龙蛋", "a"), (4, "国王追踪{0}徽章 骑士归还龙蛋", "a"), (5, "铜镜", "a"), (6, "a，骑士归还龙蛋", "a"), (7, None, "a")]
    df = spark.createDataFrame(rows, "id long, z string, s string")
    got = {r["id"] for r in df.where(truncation.renders_sentence(df["z"])).collect()}
    assert got == {2, 3}


def test_refusal_with_an_explanation_behind_it():
    examiner = pairs.Examiner(JUDGE)
    behind = " 국왕이 휘장을 추적합니다." * 60
    assert examiner.kind(PROMPT, "죄송하지만 이 문장은 번역해 드릴 수 없습니다." + behind, True) == "refusal"
    assert examiner.kind(PROMPT, behind + " 죄송하지만 이 문장은 번역해 드릴 수 없습니다.", True) == "refusal"
    assert examiner.kind(PROMPT, behind, True) is None


def test_common_subsequence_decides_on_copies():
    """The shingles of both are all there; the order or the rest is not."""
    examiner = pairs.Examiner(JUDGE)
    assert examiner.is_copy(PROMPT, "翻译：" + PROMPT)
    prompt = "甲乙丙丁戊己庚辛" + "子丑寅卯辰巳午未"
    swapped = "子丑寅卯辰巳午未" + "甲乙丙丁戊己庚辛"
    shingles = lambda t: {t[i : i + 3] for i in range(len(t) - 2)}
    assert len(shingles(prompt) & shingles(swapped)) >= 0.7 * len(shingles(prompt)) and not examiner.is_copy(prompt, swapped)
    assert not examiner.is_copy(PROMPT, PROMPT + " 정오에 국왕이 빛나는 휘장을 추적하면, 구야린이 작은 약제를 반환하십시오! 그리고 다시 말합니다.")


def test_empty_answers_of_any_length():
    examiner = pairs.Examiner(JUDGE)
    assert all(examiner.kind(PROMPT, sign * n, True) == "empty" for sign in ".-​" for n in (1, 40, 41, 60, 5000))


def test_filter_keeps_what_is_open(spark):
    answers = ['그는 "안녕하세요', "《전설의 검", "레벨 10 이상 필요(", "<start>보스 도전", "국왕이 '추적합니다"]
    df = spark.createDataFrame([(str(i), "铜镜", a) for i, a in enumerate(answers)], "id string, z string, k string")
    assert {r["defect"] for r in pairs.find_defects(df, "id", "z", "k").collect()} == {"truncated"} and pairs.find_defects(df, "id", "z", "k").count() == len(answers)
