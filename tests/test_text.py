import pytest
from pyspark.sql import functions as F

from loomline.functions import text as X
from loomline.functions.fold import fold_joined, fold_points, fold_text
from loomline.sources import pairs


def one(spark, value, *columns):
    return spark.createDataFrame([(value,)], "t string").select(*[c.alias(f"c{i}") for i, c in enumerate(columns)]).first()


def test_scripts(spark):
    t = F.col("t")
    assert tuple(one(spark, "挑战BOSS", X.has_source(t), X.has_target(t), X.pure_source_length(t), X.source_length(t))) == (True, False, 0, 2)
    assert tuple(one(spark, None, X.has_source(t), X.has_meaning(t), X.contamination(t), X.pure_source_length(t))) == (False, False, "", 0)
    assert one(spark, " 宝箱　", X.pure_source_length(t))[0] == 2
    assert one(spark, "보스 挑战", X.contamination(t))[0] == "ko_contains_cjk"
    assert one(spark, "BOSS", X.contamination(t))[0] == "ko_without_hangul"


def test_strip_takes_all_blanks(spark):
    assert one(spark, "　 \t 가 나 \x1c ", X.strip(F.col("t")))[0] == "가 나"
    assert one(spark, "가 　나", X.no_space(F.col("t")))[0] == "가나"


def test_tags_and_wrappers(spark):
    t = F.col("t")
    assert one(spark, "提升<c=#f00>攻击</c>2%", X.strip_tags(t), X.tag_count(t)) == ("提升攻击 2%", 2)
    assert one(spark, '{"获得"}', X.wrapper(t)["name"], X.wrapper(t)["inner"]) == ("brace_quote_wrapper", "获得")
    assert one(spark, "（获得）", X.wrapper(t)["name"])[0] == "paren_wrapper"
    assert one(spark, "a<key1><odd>b", X.unknown_tags(t), X.placeholder_list(t)) == ("<odd>", "<key1>;<odd>")
    assert one(spark, "x<start>보스<end>y", X.strip_markers(t))[0] == "x보스y"


def test_fragment_and_sentence(spark):
    df = spark.createDataFrame([("艮", "간"), ("艮", "간!"), ("获得{0}", "{0} 획득"), ("宝箱", "상자"), ("是否购买", "구매하시겠습니까")], "s string, t string")
    rows = df.select(X.is_fragment(F.col("s"), F.col("t")), F.round(X.sentence_score(F.col("s"), F.col("t"), ["是否"]), 2)).collect()
    assert [tuple(r) for r in rows] == [(True, 0.0), (False, 0.45), (False, 1.0), (False, 0.0), (False, 0.8)]


def test_scan_policies(spark):
    df = spark.createDataFrame([("1", " 宝箱 ", None, "x"), ("2", "石", "돌", "y")], "segment_id string, `zh-CN` string, ko string, src string")
    assert [tuple(r) for r in pairs.segments(df, "keep").collect()] == [("1", "宝箱", ""), ("2", "石", "돌")]
    assert pairs.segments(df, "drop").count() == 1
    with pytest.raises(Exception, match="empty field"):
        pairs.segments(df, "fail").collect()
    with pytest.raises(ValueError, match="missing columns"):
        pairs.segments(df.drop("ko"))
    with pytest.raises(ValueError):
        pairs.segments(df, "maybe")


@pytest.mark.parametrize("text", ["", "ＤＰЅ图表", "Séraphe", "Séraphe", "가ᅡᆨ x", "ﬁ Ⅳ ①", "a​b­c", "ΒОЅЅ"])
def test_folding_of_batches_equals_that_of_texts(text):
    points, starts = fold_joined(["x", text, None, text])
    own = "".join(map(chr, points[starts[1] : starts[2]].tolist()))
    assert own == fold_text(text) == "".join(map(chr, fold_points(text).tolist()))
    assert starts[3] == starts[2]
