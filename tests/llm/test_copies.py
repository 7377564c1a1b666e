"""What makes two records the same: formatting does, numbers and values do not."""

import random

import duckdb
import pytest

from loomline.llm import duplicates
from loomline.llm.queries import _canonical_sql
from pyspark.sql import functions as F

SAME = [
    ("버전 1.5", "버전1.5."), ("1,000 골드", "1000골드"), ("이름: 홍길동; 도시: 서울", "도시：서울 | 이름：홍길동"), ("攻击=+1;防御=-2", "防御:-2 攻击:+1"), ("시간 8:00 - 9:30", "시간 8:00-9:30"),
    ("标" * 60 + ": 5; 签: 7", "签：7；" + "标" * 60 + "：5"), ("a, b", "A B"), ("3개, 5개", "3개 5개"), ("1~3", "1～3"), ("2026-05-12", "2026–05–12"),
]
OTHER = [
    ("버전 1.5", "버전 15"), ("-5 degrees", "5 degrees"), ("3/4", "34"), ("8:00", "800"), ("이름: 홍길동; 도시: 서울", "이름: 서울; 도시: 홍길동"), ("1-3", "13"), ("이름: 가, 나", "나, 이름: 가"),
    ("철수: 안녕\n영희: 잘 가", "영희: 잘 가\n철수: 안녕"), ("1.5; 2", "15; 2"),
]


@pytest.fixture(scope="module")
def forms(spark):
    texts = sorted({t for pair in SAME + OTHER for t in pair})
    rng = random.Random(4)
    parts = ["공격", "甲", " ", "1", "25", "000", ".", ",", "-", "+", "/", ":", "=", ";", "|", "%", "~", "\n", "b", "，", "："]
    texts += ["".join(rng.choice(parts) for _ in range(rng.randint(1, 9))) for _ in range(3000)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    return {r["t"]: r["c"] for r in df.select("t", duplicates.canonical(F.col("t")).alias("c")).collect()}


@pytest.mark.parametrize("a,b", SAME)
def test_same(forms, a, b):
    assert forms[a] == forms[b]


@pytest.mark.parametrize("a,b", OTHER)
def test_other(forms, a, b):
    assert forms[a] != forms[b]


def test_sql_written_for_the_other_engine_gives_the_same_forms(forms):
    connection = duckdb.connect()
    connection.execute("CREATE TABLE texts (t VARCHAR)")
    connection.executemany("INSERT INTO texts VALUES (?)", [(t,) for t in forms])
    assert {t: c for t, c in connection.execute(f"SELECT t, {_canonical_sql('t')} FROM texts").fetchall() if c != forms[t]} == {}


def test_ids_that_are_no_numbers_of_one_width(spark):
    for ids in (["10", "9", "9a"], ["010", "009", "011"], ["x", "", None]):
        df = spark.createDataFrame([(i, "甲", "가") for i in ids], "id string, zh string, ko string")
        least = min(i for i in ids if i is not None)
        got = duplicates.count_copies(df, "id", ["zh", "ko"]).collect()
        assert [(r["kept_id"], r["copies"]) for r in got] == [(least, 3)]
    numbers = spark.createDataFrame([(i, "甲") for i in (3, 10, 2)], "id long, zh string")
    assert sorted(tuple(r) for r in duplicates.list_copies(numbers, "id", ["zh"]).collect()) == [(2, 3), (2, 10)]


def test_plans_update_counts_in_place(spark, capsys):
    df = spark.createDataFrame([(f"{i:05}", f"文{i % 7}", "가") for i in range(60)], "id string, zh string, ko string")
    duplicates.count_copies(df, "id", ["zh", "ko"]).explain()
    plan = capsys.readouterr().out
    assert "HashAggregate" in plan and "SortAggregate" not in plan
