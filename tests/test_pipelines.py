"""Settings, manifests, resumable jobs, strict answers, modes and both model stages from rows to audit."""

import json

import pytest
from pyspark.sql import functions as F

from loomline.operators import batches, cleaning, crossclean, glossary, review, tagging
from loomline.sources import files, pairs, settings, sinks

TERMS = [("1", "宝箱", "상자"), ("2", "强化石", "강화석"), ("3", "宝箱", "보물함"), ("4", "铜镜", "거울"), ("5", "铜镜", "거울")]
ROWS = [("a", "打开宝箱", "상자를 엽니다"), ("b", "使用强化石", "돌을 사용합니다"), ("c", "你好", "你好"), ("d", "使用{0}", "{0} 사용합니다")]


@pytest.fixture(scope="module")
def corpus(spark):
    return spark.createDataFrame(ROWS, "segment_id string, src string, tgt string"), spark.createDataFrame(TERMS, "term_id string, term_src string, term_tgt string")


def test_settings_are_checked(tmp_path):
    assert settings.make(settings.SplitSettings, {"train": 0.6, "validation": 0.2, "test": 0.2}).seed == 42
    for kind, bad in ((settings.SplitSettings, {"train": 0.5}), (settings.SplitSettings, {"train": 1.0}), (settings.MetricSettings, {"chrf_beta": 0}), (settings.MetricSettings, {"tokenization": "x"}),
                      (settings.DecodingSettings, {"beams": 0}), (settings.DecodingSettings, {"beams": True}), (settings.DecodingSettings, {"beams": 1.5}), (settings.ServiceSettings, {"unknown": 1}), (settings.CleanupSettings, {"temperature": 3})):
        with pytest.raises(ValueError):
            settings.make(kind, bad)
    path = tmp_path / "s.json"
    path.write_text(json.dumps({"decoding": {"beams": 5, "length_penalty": 1}}), encoding="utf-8")
    assert settings.read_settings(settings.DecodingSettings, str(path), "decoding").beams == 5
    with pytest.raises(ValueError):
        settings.read_settings(settings.DecodingSettings, str(path), "other")


def test_rules_lexicons_manifests_and_checkpoints(tmp_path):
    (tmp_path / "rules.json").write_text(json.dumps({"patterns": {"a": r"(?P<x>a)\Z"}, "run": "out", "empty": " "}), encoding="utf-8")
    assert files.read_patterns(str(tmp_path / "rules.json")) == {"a": r"(?<x>a)\z"}
    for bad in ("(", r"(?P<x>a)(?P=x)", r"(a)?(?(1)b|c)"):
        with pytest.raises(Exception):
            files.jvm_pattern(bad)
    (tmp_path / "suffixes.txt").write_text("# list\n剑\n长剑\n", encoding="utf-8")
    found = files.read_lexicons(str(tmp_path), {"suffixes.txt": "COMPOUND_SUFFIXES", "none.txt": "ACRONYMS"})
    assert found["COMPOUND_SUFFIXES"] == ("长剑", "剑") and "BOSS" in found["ACRONYMS"]
    manifest = files.read_manifest(str(tmp_path / "rules.json"), ("run",))
    assert files.manifest_path(str(tmp_path / "rules.json"), manifest, "run") == tmp_path.resolve() / "out"
    with pytest.raises(ValueError):
        files.read_manifest(str(tmp_path / "rules.json"), ("empty",))
    assert files.latest_checkpoint(str(tmp_path)) is None
    for name in ("checkpoint-9", "checkpoint-100", "checkpoint-x", "other"):
        (tmp_path / name).mkdir()
    assert [p.name for p in files.list_checkpoints(str(tmp_path))] == ["checkpoint-9", "checkpoint-100"] and files.latest_checkpoint(str(tmp_path)).name == "checkpoint-100"


def test_scans(spark):
    df = spark.createDataFrame([(1, None, "甲", None), (2, " 7 ", "乙", "나")], "row long, term_id string, zh string, ko string")
    got = [tuple(r) for r in pairs.multilingual_terms(df, ["zh", "ko", "en"], "row").orderBy("zh").collect()]
    assert sorted(got) == [("1", "甲", "", ""), ("7", "乙", "나", "")]
    with pytest.raises(ValueError):
        pairs.require_rows(df.limit(0), "terms")
    rows = spark.createDataFrame([("1", "甲", None, "test"), ("2", "", "나", "train")], "segment_id string, zh string, ko string, split string")
    assert [tuple(r) for r in pairs.split_records(rows, "test").collect()] == [("1", "甲", "")]
    for bad in (lambda: pairs.split_records(rows, "none"), lambda: pairs.split_records(rows, "train").collect(), lambda: pairs.training_pairs(rows, "segment_id", "zh", "ko").collect()):
        with pytest.raises(Exception):
            bad()
    assert [r["references"] for r in pairs.inference_records(rows.where("zh <> ''"), reference=None).collect()] == [""]


def test_a_job_goes_on_where_it_stopped(tmp_path):
    source, calls = tmp_path / "in.jsonl", []
    source.write_text("x", encoding="utf-8")

    def step(name, fail=False):
        def run(values):
            calls.append(name)
            if fail:
                raise OSError(name)
            return {name: len(values)} | ({"input": str(source), "input_hash": files.content_hash(str(source))} if name == "input_written" else {})
        return run

    path = str(tmp_path / "state.json")
    with pytest.raises(OSError):
        batches.BatchJob(path, {"input_written": step("input_written"), "uploaded": step("uploaded"), "submitted": step("submitted", True)}).run()
    values = batches.BatchJob(path, {n: step(n) for n in batches.STATES[1:]}).run()
    assert calls == ["input_written", "uploaded", "submitted", "submitted", "completed", "downloaded"] and values["downloaded"] > values["uploaded"]
    source.write_text("y", encoding="utf-8")
    with pytest.raises(ValueError):
        batches.BatchJob(path, {}).run()


def test_answers_need_their_requests(spark):
    payloads = spark.createDataFrame([(1, "b-1"), (2, "b-2")], "batch_no long, custom_id string")
    answers = spark.createDataFrame([("b-1", None, "x"), ("b-9", None, "y")], "custom_id string, error string, content string")
    assert batches.answers_for(answers, payloads.where("batch_no = 1")).first()["content"] == "x"
    with pytest.raises(Exception):
        batches.answers_for(answers, payloads).collect()


def test_strict_answers(spark):
    expected = spark.createDataFrame([(b, t) for b in range(8) for t in ("1", "2")], "batch_no long, term_id string")
    one = lambda i, action="KEEP_GAME_TERM", reason="r": {"term_id": i, "action": action, "reason": reason}
    contents = [[one("1"), one("2")], [one("1"), one("2"), one("1")], [one("1")], [one("1"), one("2"), one("3")], [one("1", "KEEP"), one("2")], [one("1", reason=""), one("2")]]
    rows = [(b, json.dumps({"results": c})) for b, c in enumerate(contents)] + [(6, "none")]
    got = {r["batch_no"]: r["errors"] for r in review.strict_errors(spark.createDataFrame(rows, "batch_no long, content string"), expected).collect()}
    assert got == {0: [], 1: ["twice"], 2: ["missing"], 3: ["unknown"], 4: ["invalid"], 5: ["without_reason"], 6: ["no_results"], 7: ["no_results"]}
    good = spark.createDataFrame(rows[:1], "batch_no long, content string")
    assert review.parse_strict(good, expected.where("batch_no = 0")).count() == 2
    with pytest.raises(Exception):
        review.parse_strict(spark.createDataFrame(rows[1:2], "batch_no long, content string"), expected.where("batch_no = 1")).collect()


def test_model_stages_from_rows_to_audit(spark, corpus):
    rows, terms = corpus

    def ask(payloads):
        @F.udf("string")
        def answer(payload):
            content = json.loads(json.loads(payload)["messages"][0]["content"])
            assert content["allowed_actions"] and content["policy"] and content["output_schema"]
            by_id = {r["segment_id"]: r for r in content["rows"]}
            assert [t["term_id"] for t in by_id["b"]["glossary_terms"]] == ["2"] and by_id["d"]["placeholder_tokens"] == ["{0}"]
            kinds = {"a": ("KEEP_SEGMENT", ""), "b": ("REWRITE_KO", "강화석을 사용합니다"), "d": ("REWRITE_KO", "사용합니다")}
            return json.dumps({"results": [{"segment_id": i, "action": a, "reason": i, "corrected_ko": c} for i, (a, c) in kinds.items()]}, ensure_ascii=False)

        return payloads.select("batch_no", answer("payload").alias("content"))

    audit = {r["original_segment_id"]: r for r in batches.clean_with_model(rows, terms, ask).collect()}
    assert {k: r["validation_status"] for k, r in audit.items()} == {"a": "KEEP", "b": "REWRITE_ACCEPTED", "c": "REVIEW", "d": "REWRITE_REJECTED"}
    assert audit["b"]["final_ko"] == "강화석을 사용합니다" and audit["b"]["glossary_terms"] == "2:强化石=>강화석" and audit["d"]["validation_errors"] == "placeholder_missing"
    assert audit["c"]["target_contamination"] == "YES" and audit["c"]["reason"] == "segment omitted from LLM response"
    projected = review.project(batches.clean_with_model(rows, terms, ask), "rewrite_failed").collect()
    assert [(r["failed_id"], r["original_segment_id"]) for r in projected] == [(1, "d")]


def test_term_stage_asks_void_batches_again(spark, corpus):
    _, terms = corpus
    calls = []

    def ask(payloads):
        calls.append(payloads.count())
        first = len(calls) == 1

        @F.udf("string")
        def answer(payload):
            own = json.loads(payload)["rows"]
            results = [{"term_id": r["term_id"], "action": "KEEP_GAME_TERM" if r["term_id"] != "2" else "REMOVE_COMMON_WORD", "reason": "r"} for r in own]
            return json.dumps({"results": results[1:] if first and own[0]["term_id"] == "1" else results})

        return payloads.select("batch_no", answer("payload").alias("content"))

    audit = {r["original_term_id"]: r["keep"] for r in batches.clean_terms_with_model(terms, ask, 2).collect()}
    assert audit == {"1": "YES", "2": "NO", "3": "YES", "4": "YES", "5": "YES"} and calls == [3, 1]
    with pytest.raises(Exception):
        batches.clean_terms_with_model(terms, lambda p: p.select("batch_no", F.lit("none").alias("content")), 2, 2).collect()


def test_modes_gate_and_removed_rows(spark, corpus):
    rows, terms = corpus
    matches, verdicts, audit = crossclean.cross_check_all(rows, terms.where("term_id in ('1', '2')"))
    kept = terms.where("term_id in ('1', '2')")
    runs = {m: crossclean.run_mode(rows, kept, verdicts, audit, m) for m in crossclean.MODES}
    assert runs["strict-check"].counts.first()["mismatch_rows"] == 1 and runs["strict-check"].segments.count() == 4
    assert runs["strict-dry-run"].terms.count() == 2 and runs["strict-apply"].terms.count() == 1 and runs["strict-apply"].counts.first()["removed_terms"] == 1
    with pytest.raises(ValueError):
        crossclean.run_mode(rows, kept, verdicts, audit, "other")
    assert tuple(crossclean.strict_gate(audit).first()) == (1, False)
    gone = crossclean.removed_terms(verdicts, strict=True).first()
    assert gone["original_term_id"] == "2" and gone["missing_rate"] == "1.000000"
    strong = verdicts.withColumn("term_action", F.lit("STRONG_GLOSSARY_TERM"))
    removed = crossclean.removed_rows(rows, matches, strong, crossclean.row_verdicts(rows, matches, strong)).first()
    assert removed["missing_strong_terms"] == "2:强化石=>강화석" and removed["term_level_stats"].startswith("term_id=2;occ=1;preserved=0;missing=1;missing_rate=1.000000")


def test_settled_terms_take_survivors_only(spark):
    rows = [("1", "甲", "가", "AUTO_REMOVE"), ("2", "甲", "나", "AUTO_KEEP"), ("3", "甲", "나", "AUTO_KEEP"), ("4", "乙", "다", "AUTO_KEEP"), ("5", "乙", "라", "KEEP_UNCERTAIN"), ("6", "丙", "마", "AUTO_SPLIT_COMPOUND")]
    judged = spark.createDataFrame([(*r, ["x"], "") for r in rows], "term_id string, term_src string, term_tgt string, action string, reasons array<string>, en string")
    got = {r["term_id"]: (r["final_action"], r["final_reasons"][1:]) for r in glossary.settle_terms(judged).collect()}
    conflict = ("AUTO_REMOVE", ["strict_zh_ko_bidirectional_conflict"])
    assert got == {"1": ("AUTO_REMOVE", []), "2": ("AUTO_KEEP", []), "3": ("MERGED_DUPLICATE", ["merged_into_existing_zh_ko_pair"]), "4": conflict, "5": conflict, "6": ("AUTO_SPLIT_COMPOUND", [])}
    other = judged.withColumn("en", F.when(F.col("term_id") == "2", "p").when(F.col("term_id") == "3", "q").otherwise(""))
    assert {r["term_id"]: r["final_action"] for r in glossary.settle_terms(other, ["en"]).collect()}["3"] == "AUTO_REMOVE"


def test_entity_stage_settles_pending_rows(spark):
    rows = spark.createDataFrame([("1", "宝箱碎片", "보물상자 조각"), ("2", "红色的花", "붉은 꽃이 피었으면"), ("3", "宝箱", "상자")], "segment_id string, src string, tgt string")
    terms = spark.createDataFrame([("宝箱碎片", "조각"), ("宝箱", "상자")], "term_src string, term_tgt string")
    got = {r["segment_id"]: r for r in cleaning.clean_segments(rows, terms).collect()}
    assert got["1"]["semantic_action"] == "AUTO_REMOVE_SEMANTIC_TERM_ENTITY" and round(got["1"]["glossary_similarity"], 6) == 1.0
    assert got["2"]["semantic_action"] == "KEEP_SEMANTIC_SEGMENT" and got["3"]["reason"] == "exact_glossary_pair" and got["3"]["semantic_score"] is None and got["3"]["sentence_score"] is None
    seeded = glossary.seed_similarity(spark.createDataFrame([("宝箱", 0.2), ("x", None)], "t string, s double"), "t", "s", ["宝箱"])
    assert [r["s"] for r in seeded.orderBy("t").collect()] == [0.0, 1.0]


def test_words_vectors_and_frequencies(spark):
    row = spark.createDataFrame([("强化了Boss3", "검을 강화합니다 Boss 3")], "s string, t string").select(
        tagging.source_words(F.col("s")).alias("sw"), tagging.target_words(F.col("t")).alias("tw"), tagging.hashed_vector(F.col("s")).alias("v"), tagging.hashed_vector(F.lit("")).alias("e"),
        tagging.summary(tagging.source_words(F.col("s"))).alias("sum"),
    ).first()
    assert row["sum"] == "强化了/VERB/dep Boss/X/dep 3/NUM/root" and [w["tag"] for w in row["tw"]] == ["NNG", "JX", "EF", "SL", "SN"]
    assert abs(sum(x * x for x in row["v"]) - 1) < 1e-9 and abs(sum(x * x for x in row["e"]) - 1) < 1e-9
    counts = spark.createDataFrame([("a", 10), ("b", 0)], "w string, n long")
    table = tagging.frequency_table(counts, "w", "n", spark.createDataFrame([(1000,)], "chars long"))
    assert {r["w"]: round(r["z"], 6) for r in tagging.zipf_of(counts, "w", table, "z").collect()} == {"a": 7.0, "b": -1.0}


def test_review_files_reports_and_raw_answers(spark, corpus, tmp_path):
    rows, terms = corpus
    sinks.write_reviews(str(tmp_path / "c"), cleaning.clean_segments(rows, terms), sinks.CLEANING_REVIEWS)
    counts = {n: spark.read.parquet(str(tmp_path / "c" / n)).count() for n in sinks.CLEANING_REVIEWS}
    assert counts["removed_contaminated"] == 1 and counts["kept_placeholders"] == 1 and counts["removed_empty"] == 0
    verdicts, audit = crossclean.cross_check(rows, terms)
    sinks.write_reviews(str(tmp_path / "t"), verdicts, sinks.CROSS_TERM_REVIEWS)
    sinks.write_reviews(str(tmp_path / "r"), audit, sinks.CROSS_ROW_REVIEWS)
    sinks.write_reviews(str(tmp_path / "g"), glossary.settle_terms(glossary.judge_terms(terms, rows)), sinks.GLOSSARY_REVIEWS)
    assert spark.read.parquet(str(tmp_path / "g" / "audit")).count() == 5
    raw = spark.createDataFrame([(1, "x")], "batch_no long, content string")
    for attempt in (1, 2, 2):
        sinks.append_raw(raw, str(tmp_path / "raw"), "run", attempt)
    assert sorted(r["attempt"] for r in spark.read.parquet(str(tmp_path / "raw")).collect()) == [1, 2]
    made = batches.generate(rows.select("segment_id", F.col("src").alias("source"), F.col("tgt").alias("references")), lambda d: d.withColumn("candidate", F.col("references")), str(tmp_path / "gen"), 2, {"model": "m"})
    assert made["rows"] == 2 and made["model"] == "m" and made["empty"] == 0
