"""Answers without content are empty at every length."""

import pytest

from loomline.llm import pairs
from loomline.llm.truncation import Judge


@pytest.mark.parametrize("answer", ["." * 40, "." * 41, "-" * 5000, "​" * 41, " " * 50, "없음" + "." * 60, "(" * 30 + "N/A" + ")" * 30])
def test_long_empties(spark, answer):
    assert pairs.Examiner(Judge(frozenset())).defect("铜镜", answer, False) == "empty"
    df = spark.createDataFrame([("1", "铜镜", answer)], "id string, z string, k string")
    assert [r["defect"] for r in pairs.find_defects(df, "id", "z", "k").collect()] == ["empty"]
