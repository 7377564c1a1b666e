"""The filter in the JVM keeps every pair that the examiner finds unfit."""

import unicodedata

from pyspark.sql import functions as F

from loomline.llm import pairs
from loomline.llm.truncation import Judge

PROMPT = "正午，国王若追踪闪亮的徽章，古雅琳请归还微小的药剂！"
TAILS = ["\\", "\\u", "\\u00", "\\x4", "&#39", "&amp", "&#x2", "<", "</sta", "<end", "${na", "$", "{na", "{", "%", "�", "�…", ",", "，", "、 ", ",\u200b", ", .", "\\u00\u3000"]


def test_filter_holds_for_every_defect(spark):
    answers = [None, "", " ", "...", "抱歉，我无法翻译这段关于 _ 的内容", PROMPT, "At noon", "국왕이 휘장을", "국왕이 추적합니다.", "청동 거울"]
    answers += [form for f in pairs.FILLERS for form in (f, f"({f})", f" {f}...", f[0] + " " + f[1:], unicodedata.normalize("NFD", f), f[0] + unicodedata.normalize("NFD", f[1:]), f + "." * 30)]
    answers += ["청동 거울" + t for t in TAILS] + ["국왕이 휘장을 추적합니다" + t for t in TAILS] + [r.replace("_", "국왕") for r in pairs.REFUSALS]
    rows = [(i, prompt, a, prompt is PROMPT) for i, (prompt, a) in enumerate((p, a) for p in (PROMPT, "铜镜") for a in answers)]
    df = spark.createDataFrame(rows, "id long, z string, k string, sentence boolean")
    kept = {r["id"] for r in df.where(pairs.may_be_defective(F.col("k"), F.col("sentence"))).select("id").collect()}
    examiner = pairs.Examiner(Judge(frozenset()))
    found = {i: d for i, z, k, s in rows if (d := examiner.defect(z, k, s))}
    assert [rows[i] for i in found if i not in kept] == []
    assert sum(d == "empty" for d in found.values()) > 2 * len(pairs.FILLERS)


def test_hangul_fillers_come_out(spark):
    df = spark.createDataFrame([("1", PROMPT, "없음"), ("2", "铜镜", "미정"), ("3", "铜镜", "추후입력"), ("4", "铜镜", "청동 거울\\u00"), ("5", "铜镜", "청동 거울"), ("6", "铜镜", "거울&#39")], "id string, z string, k string")
    got = sorted(tuple(r) for r in pairs.find_defects(df, "id", "z", "k").collect())
    assert got == [("1", "empty"), ("2", "empty"), ("3", "empty"), ("4", "truncated"), ("6", "truncated")]
