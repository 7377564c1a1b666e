import pytest
from pyspark.sql import functions as F

from loomline.operators import cleaning, glossary, training


def test_compounds(spark):
    terms = spark.createDataFrame([("红宝石",), ("红宝剑",), ("红宝链",), ("石",), ("[红]宝石",)], "term_src string")
    assert tuple(terms.select(glossary.split_compound(F.col("term_src")).alias("c")).first()["c"]) == ("红宝", "石")
    got = {r["stem"]: (r["suffixes"], r["n_suffixes"]) for r in glossary.compound_families(terms).collect()}
    assert got == {"红宝": (["剑", "石", "链"], 3)}


def test_pairs_merge_and_conflict(spark):
    schema = "term_id string, term_src string, term_tgt string, en string, ja string"
    terms = spark.createDataFrame([("1", "a", "가", "x", ""), ("2", "a", "가", "x", "j"), ("3", "a", "가", "y", ""), ("4", "a", "가", "", "k"), ("5", "b", "나", None, None)], schema)
    got = {r["term_id"]: r["pair_action"] for r in glossary.merge_pairs(terms, languages=["en", "ja"]).collect()}
    assert got == {"1": "KEEP", "2": "MERGED_DUPLICATE", "3": "AUTO_REMOVE", "4": "AUTO_REMOVE", "5": "KEEP"}
    pairs = spark.createDataFrame([("1", "a", "가"), ("2", "a", "나"), ("3", "b", "다"), ("4", "c", "다"), ("5", "d", "라"), ("6", "d", "라")], "term_id string, term_src string, term_tgt string")
    assert {r["term_id"] for r in glossary.one_to_one(pairs).where("conflict").collect()} == {"1", "2", "3", "4"}


def test_verdict_ladder(spark):
    terms = spark.createDataFrame([
        ("1", "BOSS层", "보스층", 1.0), ("2", "请确认", "확인하세요", 1.0), ("3", "宝石", "", 1.0), ("4", "月亮", "달", 1.0), ("5", "神兵", "신병기", 0.0), ("6", "《书》", "책", 1.0), ("7", "战士", "전사", 1.0),
    ], "term_id string, term_src string, term_tgt string, product_score double")
    src, tgt, none = F.col("term_src"), F.col("term_tgt"), F.lit(-1.0)
    tags = F.array(F.lit("n"))
    game = glossary.game_score(src, tgt, F.lit(0.0))
    scored = terms.withColumns({
        "family": F.lit(0), "bilingual": F.lit(0.9), "game": game, "general": glossary.general_score(src, tgt, F.lit("")), "domain": glossary.domain_specificity(src, F.lit(""), none, game),
        "src_noun": glossary.source_noun_score(src, tags, F.array(F.lit("NOUN")), F.lit("NOUN")), "tgt_noun": glossary.target_noun_score(tgt, F.array(F.lit("NNG")), F.array(F.lit("NOUN")), F.lit("NOUN")),
    })
    scored = scored.withColumn("common", glossary.common_noun_score(src, tgt, F.col("src_noun"), F.col("tgt_noun"), none, none, F.lit(0.0)))
    judged = glossary.with_verdicts(scored)
    got = {r["term_id"]: (r["action"], r["reasons"]) for r in judged.collect()}
    assert got["1"] == ("AUTO_KEEP", ["termhood_semantic_supported"]) == got["7"]
    assert got["2"] == ("AUTO_REMOVE", ["ui_or_sentence_start", "ko_sentence_or_verb_end", "phrase_marker_without_noun_suffix"])
    assert got["3"][1] == ["missing_ko_for_zh_ko_glossary"] and got["4"][1] == ["common_noun_without_domain_signal"]
    assert got["5"][1] == ["not_in_segments_redundant_for_current_corpus"] and got["6"][1] == ["book_or_test_title_markup"]
    assert glossary.review_terms(judged.withColumns({"general": F.lit(1.0), "game": F.lit(0.1)}).where("term_id = '7'")).first()["kind"] == "common_word"
    families = judged.where("term_id = '1'").withColumns({"term_src": F.lit("红宝石"), "family": F.lit(3)})
    assert glossary.with_verdicts(families.drop("action", "reasons", "term_score")).first()["action"] == "AUTO_SPLIT_COMPOUND"


def test_corpus_evidence(spark):
    rows = spark.createDataFrame([("1", "甲甲甲乙BOSS", "가 boss"), ("2", "丙", "나나나나")], "segment_id string, src string, tgt string")
    terms = spark.createDataFrame([("1", "甲甲", "나나"), ("2", "丙", "x"), ("3", "BOSS层", "BOSS층"), ("4", "甲乙", "없음")], "term_id string, term_src string, term_tgt string")
    counts = glossary.corpus_counts(rows, terms)
    got = {r["term_id"]: (r["src_count"], r["tgt_count"], r["product_score"]) for r in glossary.evidence_score(terms, counts, glossary.acronyms_present(rows)).collect()}
    assert got == {"1": (1, 2, 1.0), "2": (0, 0, 0.0), "3": (0, 0, 0.75), "4": (1, 0, 0.55)}


def test_vectors(spark):
    df = spark.createDataFrame([(1, 0, [3.0, 4.0]), (2, 0, [3.0, 4.0]), (3, 1, [0.0, 0.0])], "id long, label int, v array<float>")
    got = {r["label"]: [round(x, 6) for x in r["centroid"]] for r in glossary.centroid(df, "v", ["label"]).collect()}
    assert got == {0: [0.6, 0.8], 1: [0.0, 0.0]}
    best = {r["id"]: r["similarity"] for r in glossary.max_similarity(df, "id", "v", df.where("id < 3"), "v").collect()}
    assert best == {1: 25.0, 2: 25.0, 3: 0.0}
    blocked = {r["id"]: r["similarity"] for r in glossary.max_similarity(df, "id", "v", df.where("id < 3"), "v", block=1, slice_rows=1).collect()}
    assert blocked == best
    assert {r["similarity"] for r in glossary.max_similarity(df, "id", "v", df.limit(0), "v").collect()} == {None}


def test_tuples_and_verdicts(spark):
    rows = spark.createDataFrame([
        ("1", '["a甲", "b乙"]', '["가", "나"]'), ("2", '["a甲","b乙"]', '["가"]'), ("3", '{"甲","乙"}', '{"가","나"}'), ("4", "宝箱", "상자"), ("5", "获得{0}", "{0} 획득"),
        ("6", "艮", "간"), ("7", "宝石", "宝石"), ("8", "<c></c>", "..."), ("9", "是否购买？", "구매하시겠습니까?"), ("10", "", "x"),
    ], "segment_id string, src string, tgt string")
    pairs = spark.createDataFrame([("宝箱", "상자"), ("宝箱", "상자")], "term_src string, term_tgt string")
    got = {(r["segment_id"], r["split_index"]): r["reason"] for r in cleaning.clean_segments(rows, pairs).collect()}
    assert {k[1] for k in got if k[0] == "1"} == {1, 2}
    assert got[("2", 0)] == "tuple_parse_or_alignment_failed" and got[("4", 0)] == "exact_glossary_pair" and got[("5", 0)] == "placeholder_kept"
    assert got[("6", 0)] == "pure_cjk_single_char_fragment" and got[("7", 0)] == "ko_contains_cjk" and got[("8", 0)] == "markup_only_after_normalization"
    assert got[("9", 0)] == "sentence_like_kept" and got[("10", 0)] == "empty_after_split"
    scores = spark.createDataFrame([(0.9, 0.9, 0.9, 0.0), (0.8, 0.6, 0.6, 0.0), (0.2, 0.9, 0.9, 0.0)], "n double, g double, s double, p double")
    verdicts = [r[0]["semantic_action"] for r in scores.select(cleaning.entity_verdict(F.col("n"), F.col("g"), F.col("s"), F.col("p"))).collect()]
    assert verdicts == ["AUTO_REMOVE_SEMANTIC_TERM_ENTITY", "REVIEW_SEMANTIC_TERM_ENTITY", "KEEP_SEMANTIC_SEGMENT"]


@pytest.mark.parametrize("n,expected", [(10, (8, 1, 1)), (5, (3, 1, 1)), (3, (1, 1, 1)), (1, (1, 0, 0)), (0, (0, 0, 0))])
def test_exact_split(spark, n, expected):
    df = spark.createDataFrame([(str(i),) for i in range(n)], "id string")
    first = {r["id"]: r["split"] for r in training.exact_split(df, "id").collect()}
    second = {r["id"]: r["split"] for r in training.exact_split(df.repartition(3), "id").collect()}
    counts = [list(first.values()).count(s) for s in ("train", "validation", "test")]
    assert tuple(counts) == expected and first == second


def test_split_ratios_are_checked(spark):
    with pytest.raises(ValueError):
        training.exact_split(spark.createDataFrame([("1",)], "id string"), "id", 0.5, 0.1, 0.1)


def test_grid_rank_and_logs(spark):
    grid = training.parameter_grid(spark, {"a": [1, 2], "b": ["x", "y"]})
    assert [(r["combo_id"], r["a"], r["b"]) for r in grid.orderBy("combo_id").collect()] == [(0, 1, "x"), (1, 1, "y"), (2, 2, "x"), (3, 2, "y")]
    ranked = training.rank_by(spark.createDataFrame([("a", 0.5), ("b", 0.7), ("c", 0.7)], "name string, score double"), "score", "name")
    assert {r["name"]: r["rank"] for r in ranked.collect()} == {"b": 1, "c": 2, "a": 3}
    history = spark.createDataFrame([(0, 0.0, 9.0, None), (1, 1.0, None, None), (2, 1.0, 3.0, 0.5), (3, 1.0, 2.0, 0.6)], "step long, epoch double, loss double, score double")
    assert [tuple(r) for r in training.epoch_log(history, ["loss", "score"]).collect()] == [(1.0, 3.0, 0.5)]
    assert training.last_logged(history, "score").first()[0] == 0.6
