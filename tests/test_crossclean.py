import dataclasses

from loomline.operators.crossclean import Rules, apply_verdicts, cross_check

RULES = dataclasses.replace(Rules(), noise_occurrences=3)


def run(spark, terms, rows):
    t = spark.createDataFrame(terms, "term_id string, term_src string, term_tgt string")
    s = spark.createDataFrame(rows, "segment_id string, src string, tgt string")
    verdicts, audit = cross_check(s, t, RULES)
    return s, t, verdicts, audit


def test_noise_term_is_removed_alone(spark):
    rules = dataclasses.replace(RULES, nonterms=("今日",))
    t = spark.createDataFrame([("1", "今日", "오늘")], "term_id string, term_src string, term_tgt string")
    s = spark.createDataFrame([(str(i), f"今日{c}", "일일 보상") for i, c in enumerate("甲乙丙丁戊")], "segment_id string, src string, tgt string")
    verdicts, audit = cross_check(s, t, rules)
    assert verdicts.first()["term_action"] == "AUTO_REMOVE_GLOSSARY_NOISE"
    assert {r["row_action"] for r in audit.collect()} == {"KEEP_AFTER_GLOSSARY_NOISE_REMOVAL"}
    kept, terms = apply_verdicts(s, t, verdicts, audit)
    assert kept.count() == 5 and terms.count() == 0


def test_strong_term_removes_the_row_that_misses_it(spark):
    s, t, verdicts, audit = run(spark, [("1", "技能", "스킬")], [("1", "技能甲", "스킬 가"), ("2", "技能乙", "스킬 나"), ("3", "技能丙", "스 킬 다"), ("4", "释放技能", "기술 사용"), ("5", "无关", "무관")])
    row = verdicts.first()
    assert (row["occurrences"], row["preserved"], row["missing"], row["term_action"], row["strict_action"]) == (4, 3, 1, "STRONG_GLOSSARY_TERM", "STRICT_RETAIN_AND_ENFORCE")
    actions = {r["segment_id"]: (r["row_action"], r["strict_row_action"], r["missing_terms"]) for r in audit.collect()}
    assert actions["4"] == ("AUTO_REMOVE_SEGMENT_CONFLICT", "STRICT_REMOVE_SEGMENT_MISMATCH", "1")
    assert actions["5"] == ("KEEP", "STRICT_KEEP", "")
    kept, _ = apply_verdicts(s, t, verdicts, audit, strict=True)
    assert sorted(r["segment_id"] for r in kept.collect()) == ["1", "2", "3", "5"]


def test_weak_evidence_goes_to_review(spark):
    _, _, verdicts, audit = run(spark, [("7", "传送", "전송")], [(str(i), f"传送{i}", "텔레포트") for i in range(3)])
    assert verdicts.first()["term_action"] == "TERM_NEEDS_REVIEW"
    assert {r["row_action"] for r in audit.collect()} == {"ROW_NEEDS_REVIEW"}
    assert {r["strict_row_action"] for r in audit.collect()} == {"STRICT_KEEP_AFTER_GLOSSARY_REMOVAL"}
