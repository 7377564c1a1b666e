import pytest

from loomline.llm import pairs, truncation
from loomline.llm.truncation import Judge

JUDGE = Judge(frozenset({"조건", "방법"}))
PROMPT = "正午，国王若追踪闪亮的徽章，古雅琳请归还微小的药剂！"


@pytest.mark.parametrize("text,cut", [
    ("국왕이 휘장을 추적하면, 약제를 반환하십시오!", False), ("국왕이 휘장을 추적합니다", False), ("국왕이 휘장을 추적하면, 약제를", True), ("국왕이 휘장을 추", True), ("국왕이…", True),
    ("국왕이 휘장을 �", True), ("국왕이 추적합니다. (수정)", False), ("<start>국왕이<end> 추적합니다...", False), ("국왕이 휘장을 추적하는 조건", False), ("'국왕이 추적했습니까?'", False),
    ("국왕이 휘장 <start>약제", True), ("", False), ("  ", False), (None, False), ("국왕이 추적할게요!", False),
])
def test_cut_off_texts(text, cut):
    assert JUDGE.cut_off(text, True) is cut


def test_names_and_sources_without_baseline():
    assert not JUDGE.cut_off("정교한 청동 거울", False) and not JUDGE.cut_off("정교한 청동", True, 0.1)
    assert JUDGE.cut_off("그는 \"정교한 청동", True, 0.1)
    assert truncation.open_at_end("「a（b") == ["「", "（"] and truncation.open_at_end("<start>a<end> (b)") == []


def test_cut_off_operator(spark):
    good, bad = "국왕이 휘장을 추적합니다.", "국왕이 휘장을"
    rows = [(i, PROMPT, good, "a") for i in range(30)] + [(100, PROMPT, bad, "a"), (101, "名字", bad, "a"), (102, PROMPT, None, None), (103, PROMPT, "", None), (104, PROMPT, bad, None), (104, PROMPT, bad, None)]
    df = spark.createDataFrame(rows, "id long, z string, k string, source string")
    found = truncation.find_cut_off(df, "k", "z", "source")
    assert sorted(r["id"] for r in found.where("cut_off").collect()) == [100, 104, 104]
    rates = {r["source"]: (r["texts"], r["cut"]) for r in truncation.cut_off_rates(found, "k", "source").collect()}
    assert rates == {"a": (32, 1), None: (2, 2)}
    assert truncation.find_cut_off(df.limit(0), "k", "z", "source").count() == 0


@pytest.mark.parametrize("prompt,answer,defect", [
    (PROMPT, None, "empty"), (PROMPT, " \t", "empty"), (PROMPT, "...", "empty"), (PROMPT, "N/A", "empty"), (PROMPT, "(空)", "empty"),
    (PROMPT, "이 요청은 도와드릴 수 없어요.", "refusal"), (PROMPT, "Sorry, this request about Raien cannot be completed.", "refusal"), (PROMPT, "抱歉，我无法翻译这段关于德琳夏的内容。", "refusal"),
    (PROMPT, "죄송하지만 이 문장은 번역해 드릴 수 없습니다.", "refusal"),
    (PROMPT, PROMPT, "copied"), (PROMPT, "번역: " + PROMPT, "copied"), (PROMPT, PROMPT.replace("，", ", ").rstrip("！"), "copied"),
    (PROMPT, "At noon the king would track a badge.", "other_language"), (PROMPT, "渔夫已分解古老的船票。", "other_language"), (PROMPT, "待ちましょう。", "other_language"),
    (PROMPT, "정오에 국왕이 빛나는 휘장을", "truncated"), (PROMPT, "정오에 국왕이 휘장을 추적하면, 약제를 반환하십시오!", None),
    ("抱歉，露奥无法打开此门。骑士归还龙蛋。", "죄송합니다, 루오는 이 문을 열 수 없습니다. 기사가 알을 반환합니다.", None),
    ("a1B2C3|甲|乙", "", None), ("HP+20", "HP+20", None), ("铜镜", "청동 거울", None),
])
def test_defects(prompt, answer, defect):
    sentence = prompt.rstrip().endswith(("。", "！"))
    assert pairs.Examiner(JUDGE).defect(prompt, answer, sentence) == defect


def test_defects_operator(spark):
    rows = [("1", PROMPT, None, "x"), ("2", PROMPT, "정오에 국왕이 반환하십시오.", "x"), ("3", None, None, "x"), ("1", PROMPT, None, "x"), ("4", PROMPT, "끝까지 " * 50_000, "x")]
    df = spark.createDataFrame(rows, "id string, z string, k string, defect string")
    got = sorted(tuple(r) for r in pairs.find_defects(df, "id", "z", "k").collect())
    assert got == [("1", "empty"), ("1", "empty"), ("3", "empty"), ("4", "truncated")]
    assert pairs.find_defects(df.limit(0), "id", "z", "k").count() == 0


def test_common_length():
    assert pairs.common_length(list("abcde"), list("xaxcxe")) == 3 and pairs.common_length([], ["a"]) == 0
