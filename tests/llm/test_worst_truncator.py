"""A source that cuts most of its sentences is reported like any other."""

from loomline.llm import truncation
from loomline.llm.truncation import Judge

PROMPT = "正午，国王若追踪闪亮的徽章，古雅琳请归还微小的药剂！"
JUDGE = Judge(frozenset())


def test_begun_clauses_are_cut_whatever_the_source():
    for text in ("정오에 국왕이 휘장을", "국왕이 휘장을 추적하면, 약", "국왕이 추적합니다. 기사가 청동", "국왕이 빛나는 휘"):
        assert JUDGE.cut_off(text, True, 0.01), text
    for text in ("국왕이 휘장을 추적함", "국왕이 휘장을 추적하기", "정교한 청동 거울", "국왕이 휘장을 추적합니다"):
        assert not JUDGE.cut_off(text, True, 0.01), text


def test_worst_truncator(spark):
    good, cuts = "정오에 국왕이 휘장을 추적하면 약제를 반환하십시오.", ["정오에 국왕이 빛나는 휘장을", "정오에 국왕이 휘장을 추적하면, 약", "정오에 국", "빛나는 휘장"]
    rows = [(i, PROMPT, good, "good") for i in range(200)] + [(200 + i, PROMPT, good, "bad") for i in range(10)] + [(300 + i, PROMPT, cuts[i % 4], "bad") for i in range(90)]
    rows += [(400 + i, PROMPT, "정오에 국왕이 휘장을 추적하면 약제를 함께 반환할 것", "notes") for i in range(90)]
    df = spark.createDataFrame(rows, "id long, z string, k string, source string")
    found = truncation.find_cut_off(df, "k", "z", "source")
    assert sorted(r["id"] for r in found.where("cut_off").collect()) == list(range(300, 390))
    assert {r["source"]: r["cut"] for r in truncation.cut_off_rates(found, "k", "source").collect()} == {"good": 0, "bad": 90, "notes": 0}


def test_source_of_cut_texts_only(spark):
    df = spark.createDataFrame([(i, PROMPT, "정오에 국왕이 빛나는 휘장을", "bad") for i in range(5)], "id long, z string, k string, source string")
    assert truncation.find_cut_off(df, "k", "z", "source").where("cut_off").count() == 5
