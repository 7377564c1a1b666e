"""Closing words come from different texts, not from copies of one."""

from loomline.llm import pairs, truncation

PROMPT = "正午，国王若追踪闪亮的徽章，古雅琳请归还微小的药剂！"
NOUNS = ["휘장", "약제", "거울", "용알", "방패", "물약", "지도", "왕관"]


def rows_of(copies):
    """Finished texts, headings on one noun, and copies of a cut text with varied signs."""
    good = [(PROMPT, f"국왕이 {a} 곁에서 {b}을 추적합니다.") for a in NOUNS for b in NOUNS if a != b]
    heads = [("铜镜的条件", f"{a} 획득 {b}의 조건") for a, b in zip(NOUNS, NOUNS[1:])] + [("铜镜的条件", f"{a} 조건") for a in NOUNS]
    cut = [(PROMPT, "정오에 국왕이 빛나는 휘장을 선물하시겠습" + "." * (i % 3)) for i in range(copies)]
    return [(i, z, k, "s") for i, (z, k) in enumerate(good + heads + cut)], len(good) + len(heads)


def test_copied_fragment_closes_nothing(spark):
    for copies in (1, 35):
        rows, first = rows_of(copies)
        df = spark.createDataFrame(rows, "id long, z string, k string, source string")
        words = truncation.closing_words(df, "k")
        assert "조건" in words and "선물하시겠습" not in words
        found = truncation.find_cut_off(df, "k", "z", "source").where("cut_off").collect()
        assert sorted(r["id"] for r in found) == list(range(first, first + copies))
        assert pairs.find_defects(df, "id", "z", "k").where("defect = 'truncated'").count() == copies


def test_small_tables_have_no_closing_words_of_single_texts(spark):
    df = spark.createDataFrame([(f"{a} 끝",) for a in NOUNS[:2]] + [("장인이",), ("국왕이 휘장을",)], "k string")
    assert truncation.closing_words(df, "k") == []
