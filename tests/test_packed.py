import random

import pytest

from loomline.operators.packed import cut, infer_delimiters, is_list, may_be_packed, split_packed, split_value
from pyspark.sql import functions as F

ALL = frozenset({"|", ";", ",", "/", "//", "##", "\n", "\t", "\\n", "、"})


@pytest.mark.parametrize("text,values", [
    ("普通铃铛|完整棋子|镀金药草S84867", ["普通铃铛", "完整棋子", "镀金药草S84867"]),
    ("锻造等级；染血符石", ["锻造等级", "染血符石"]),
    ('["a 1B2C","b;c",""]', ["a 1B2C", "b;c", ""]),
    ('{"毒抗性", "\\"稀有\\"木盾"}', ["毒抗性", '"稀有"木盾']),
    ('"";"仓库头盔";木盾', ["", "仓库头盔", "木盾"]),
    ("'a, b';'c'", ["a, b", "c"]),
    ('"""x""y",z', ['"x"y', "z"]),
    ("攻击:+1; 防御:-20%", ["攻击:+1", "防御:-20%"]),
    ("法力值\\n头盔X1Y2Z3", ["法力值", "头盔X1Y2Z3"]),
    ("a // b // c", ["a", "b", "c"]),
    ("战靴|图表|生命值; 坐垫|法力值", ["战靴", "图表", "生命值", "坐垫", "法力值"]),
    ("渔网B7K122,掉落加成,药草", ["渔网B7K122", "掉落加成", "药草"]),
])
def test_lists(text, values):
    assert split_value(text, ALL) == values


@pytest.mark.parametrize("text", [
    None, "", " ", "一个值", '["灯笼, H5Z06C"]', '{"治疗量, JUJTN0"}', '"弩箭, DE5B58"', "截至2026/05/12，进度1/5，使用长剑。", "活动时间：8:00-9:30；每日限6次。使用长剑。",
    "春天，骑士若归还龙蛋，必须出售鳞片。", "봄에 기사가\n알을 반환하면, 판매해야 합니다.", "艾洛米·锻造等级UBO0TE", "移动速度 P19S72", "N/A",
])
def test_single_values(text):
    assert split_value(text, ALL) is None


def test_weak_separator_follows_parallel_field():
    assert split_value("깃털 / 행운", ALL) is None
    assert split_value("깃털 / 행운", ALL, 3) == ["깃털", "행운"]


def test_round_trip_of_quoted_lists():
    rng = random.Random(3)
    for _ in range(200):
        values = ["".join(rng.choice('ab;|, "甲乙') for _ in range(rng.randint(0, 6))).strip() for _ in range(rng.randint(2, 6))]
        text = ";".join('"' + v.replace('"', '""') + '"' for v in values)
        if all(v.strip('" ') for v in values):
            assert split_value(text, ALL) == values, text


def test_operator_with_awkward_rows(spark):
    rows = [
        ("1", "a|b|c", "가;나;다", None, "x"), ("2", None, "", "s", "x"), ("2", None, "", "s", "x"), ("3", "単", "단", "s", "x"), ("4", "x|y", "엑스 / 와이", "s", "x"),
        ("5", "很长" * 20000, "긴" * 20000, "s", "x"), ("1", "a|b|c", "가;나;다", None, "x"),
    ]
    df = spark.createDataFrame(rows, "id string, zh string, ko string, src string, `__source` string")
    got = sorted(tuple(r) for r in split_packed(df, "id", ["zh", "ko"], "src").collect())
    once = [("1", "ko", 1, "가"), ("1", "ko", 2, "나"), ("1", "ko", 3, "다"), ("1", "zh", 1, "a"), ("1", "zh", 2, "b"), ("1", "zh", 3, "c")]
    assert got == sorted(once + once + [("4", "ko", 1, "엑스"), ("4", "ko", 2, "와이"), ("4", "zh", 1, "x"), ("4", "zh", 2, "y")])
    empty = df.limit(0)
    assert split_packed(empty, "id", ["zh", "ko"], "src").count() == 0
    assert {r["delimiter"] for r in infer_delimiters(df, ["zh", "ko"], "src").where("accepted").collect()} >= {"|", ";"}


def test_cheap_row_test_holds_for_all_lists(spark):
    lists = ["a|b", "a;b", '"a","b"', "渔网B7K122,掉落加成", "a、b", "a##b", "a\\nb", "a\nb", "'a','b'"]
    assert all(is_list(cut(t)) or t in ("a\nb", "a##b") for t in lists)
    df = spark.createDataFrame([(t,) for t in lists], "t string")
    assert df.where(may_be_packed(F.col("t"))).count() == len(lists)
