"""The filter in the JVM keeps every value that is a list."""

import random

from loomline.operators.packed import WIDE, cut, is_list, may_be_packed, separator_class, split_packed
from pyspark.sql import functions as F


def test_filter_holds_for_every_list(spark):
    signs = [c for c in map(chr, range(0x21, 0xFFEF)) if len(cut(f"甲{c}乙").pieces) > 1]
    assert len(signs) > 500
    rng = random.Random(5)
    texts = [t for s in signs for t in (f"甲{s}乙", f"力量：12{s}敏捷：3", f"A1B2{s} 乙", f"ABCDEFG{s}乙")]
    parts = ["力量", "：", ":", "=", "12", "３５", "7", ",", "，", " ", "　", "\xa0", "%", "％", "+", "－", ".", "X1Y2", "'", "＂", "—", "‖", "；", "\n", "\\n", "＼n", "!", "。"]
    texts += ["".join(rng.choice(parts) for _ in range(rng.randint(2, 9))) for _ in range(20_000)]
    lists = [t for t in texts if is_list(cut(t))]
    assert len(lists) > 2000
    df = spark.createDataFrame([(t,) for t in lists], "t string")
    assert [r["t"] for r in df.where(~may_be_packed(F.col("t"))).collect()] == []
    prose = ["一个值", "春天，骑士若归还龙蛋，必须出售鳞片。", "봄에 기사가 알을 반환하면, 판매해야 합니다.", "什么？好！时间：晚上"]
    assert spark.createDataFrame([(t,) for t in prose], "t string").where(may_be_packed(F.col("t"))).count() == 0
    assert set(WIDE.values()) and "—" in separator_class()


def test_labelled_values_behind_commas_come_out(spark):
    rows = [("1", "力量：12，敏捷：30", "힘: 12, 민첩: 30", "s"), ("2", "剑—盾", "검—방패", "s"), ("3", "剑‖盾", "검‖방패", "s")]
    got = sorted(tuple(r) for r in split_packed(spark.createDataFrame(rows, "id string, zh string, ko string, src string"), "id", ["zh", "ko"], "src").collect())
    assert got == sorted([
        ("1", "ko", 1, "힘: 12"), ("1", "ko", 2, "민첩: 30"), ("1", "zh", 1, "力量：12"), ("1", "zh", 2, "敏捷：30"),
        *((i, f, n, v) for i in "23" for f, vs in (("ko", ["검", "방패"]), ("zh", ["剑", "盾"])) for n, v in enumerate(vs, 1)),
    ])
