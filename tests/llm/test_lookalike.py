import pytest

from loomline.llm import lookalike

CORPUS = ["BOSS首级 NPC信件 VIP通行证 Séraphe戒指 Noctél怀表 HP药水 DPS图表 PVP", "Ω核心 β测试券"] * 30


@pytest.fixture(scope="module")
def normal(spark):
    df = spark.createDataFrame([(t,) for t in CORPUS], "t string")
    return lookalike.Normalizer(lookalike.pair_counts(df, ["t"]))


@pytest.mark.parametrize("text,expected", [
    ("ＤＰЅ图表", "DPS图表"), ("ΝРС信件", "NPC信件"), ("Ѕе́rарһе", "Séraphe"), ("Ω核心和β测试券", "Ω核心和β测试券"), ("⾦⽯", "金石"), ("神‌圣\xad", "神圣"),
    ("가", "가"), ("a b　c\t\n", "a b c\t\n"), ("（全角，标点！）；～", "（全角，标点！）；～"), ("Привет", "Привет"), ("⻳甲", "龟甲"), ("Ⅳ", "IV"), ("①²", "①²"), ("", ""),
])
def test_consistent_forms(normal, text, expected):
    assert normal(text) == expected
    assert normal(expected) == expected


def test_columns_and_cases(spark):
    rows = [("1", "ΒОЅЅ首级", "보스"), ("2", None, ""), ("3", "BOSS", "보\u00a0스"), ("3", "BOSS", "보\u00a0스"), ("4", "长" * 100_000 + "​", "가")]
    df = spark.createDataFrame(rows, "id string, `zh-CN` string, ko string").withColumn("field", __import__("pyspark").sql.functions.lit(1))
    pairs = {a + b: 50 for a, b in zip("^BOSBOS", "BOSSOSS")}
    found = sorted((r["record_id"], r["field"]) for r in lookalike.find_inconsistent(df, "id", ["zh-CN", "ko"], pairs).collect())
    assert found == [("1", "zh-CN"), ("3", "ko"), ("3", "ko"), ("4", "zh-CN")]
    changed = {r["id"]: (r["zh-CN"], r["ko"]) for r in lookalike.normalize_columns(df, ["zh-CN", "ko"], pairs).collect()}
    assert changed["1"] == ("BOSS首级", "보스") and changed["2"] == (None, "") and changed["3"] == ("BOSS", "보 스") and len(changed["4"][0]) == 100_000
    assert lookalike.find_inconsistent(df.limit(0), "id", ["zh-CN", "ko"]).count() == 0
