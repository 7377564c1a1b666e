"""The delimiters inferred for each source decide; no length of an item or label does."""

import pytest

from loomline.operators import packed
from loomline.operators.packed import infer_delimiters, split_packed, split_value

ALL = frozenset({"|", ";", ",", "/", "\n", "—"})


@pytest.mark.parametrize("text,values", [
    ("공격력: 10, 방어력: 20", ["공격력: 10", "방어력: 20"]),
    ("铜" * 200 + "|" + "剑" * 49, ["铜" * 200, "剑" * 49]),
    ("标" * 90 + ": 5; 签: 7", ["标" * 90 + ": 5", "签: 7"]),
    ("이름: 홍길동; 도시: 서울", ["이름: 홍길동", "도시: 서울"]), ("名字：张三；等级：12；城市：北京", ["名字：张三", "等级：12", "城市：北京"]),
    ("活动：今天；使用长剑", None), ("이벤트 시간: 7:00-8:30; 하루 4회 제한", None), ("이름: 홍길동, 도시: 서울", None),
])
def test_values(text, values):
    assert split_value(text, ALL) == values


def test_the_same_sign_separates_in_one_source_and_is_text_in_another(spark, monkeypatch):
    prose = [(f"p{i}", f"骑士{i}归还龙蛋。然后—使用长剑。", f"기사가 알을 {i}번 반환합니다. 그리고—장검을 사용합니다.", "prose") for i in range(40)]
    lists = [(f"l{i}", f"剑{i}—盾—弓", f"검{i}—방패—활", "lists") for i in range(40)]
    df = spark.createDataFrame([*prose, *lists, ("x", "红—黑", "붉은—검은", "prose"), ("y", "红—黑", "붉은—검은", "lists")], "id string, zh string, ko string, src string")
    accepted = {(r["source"], r["field"]) for r in infer_delimiters(df, ["zh", "ko"], "src").where("accepted and delimiter = '—'").collect()}
    assert accepted == {("lists", "zh"), ("lists", "ko")}
    ids = lambda: {r["id"] for r in split_packed(df, "id", ["zh", "ko"], "src").collect()}
    assert ids() == {f"l{i}" for i in range(40)} | {"y"}
    monkeypatch.setattr(packed, "LEAST_SCORE", -1.0)
    assert ids() == {f"l{i}" for i in range(40)} | {"x", "y"}
