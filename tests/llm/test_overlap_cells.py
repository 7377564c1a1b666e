import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark import SparkContext
from pyspark.sql.classic.dataframe import DataFrame

from loomline.llm import splits

ZH = "甲乙丙丁戊己庚辛壬癸子丑寅卯辰巳午未申酉"


def edited(text: str, edits: int, rng: random.Random) -> str:
    other = list(text)
    for _ in range(edits):
        at = rng.randrange(len(other))
        other[at : at + 1] = rng.choice([[], [other[at], "甲"], [rng.choice(ZH)]])
    return "".join(other) or "乙"


def test_the_driver_gathers_and_broadcasts_nothing_of_the_texts(spark, monkeypatch):
    """Histograms and tables of bits of all runs went through the driver."""

    def refuse(*_, **__):
        raise AssertionError("texts reach the driver")

    monkeypatch.setattr(SparkContext, "broadcast", refuse)
    for name in ("toArrow", "toPandas"):
        monkeypatch.setattr(DataFrame, name, refuse)
    e = spark.createDataFrame([("e1", "甲乙丙丁戊己庚辛壬癸", "가"), ("e2", "子丑寅卯辰", None)], "id string, zh string, ko string")
    t = spark.createDataFrame([("t1", "甲乙丙丁戊己庚辛壬", "나"), ("t2", "天地", "가"), ("t3", None, "")], "id string, a string, b string")
    rows = splits.find_overlaps(e, t, "id", "id", ["zh", "ko"], ["a", "b"]).collect()
    assert sorted((r["eval_id"], r["train_id"], r["distance"]) for r in rows) == [("e1", "t1", 1), ("e1", "t2", 0)]


@pytest.mark.parametrize("length", [12, 60, 620])
def test_pairs_of_a_cell_equal_brute_force(monkeypatch, length):
    """Slices, batches, seeds and tables of any size; texts on both sides of PLACED."""
    rng, options = random.Random(length), splits.Winnowing()
    for name, value in (("INDEXED", 900), ("SLICE", 500), ("SEEDS", 40), ("TABLE", 300)):
        monkeypatch.setattr(splits, name, value)
    a = {"".join(rng.choice(ZH) for _ in range(rng.randint(length * 2 // 3, length))) for _ in range(40)} | {"甲" * length, "甲" * (length - 1) + "乙"}
    b = {edited(x, rng.randint(0, len(x) // 5 + 1), rng) for x in a}
    side = lambda texts: splits.Side([splits.copied(pa.record_batch({"text": sorted(texts), "code": [len(x) % 3 for x in sorted(texts)], "copies": [1] * len(texts)}), 0, len(texts))])
    own, other = side(a), side(b)
    found = [(own.texts[int(x)].as_py(), other.texts[int(y)].as_py()) for xs, ys in splits.near_pairs(own, other, True, options) for x, y in zip(xs, ys)]
    found += [(own.texts[int(x)].as_py(), other.texts[int(y)].as_py()) for ys, xs in splits.near_pairs(other, own, False, options) for x, y in zip(xs, ys)]
    near = {(x, y) for x in a for y in b if x != y and splits.edit_distance(x, y) <= 0.2 * max(len(x), len(y)) + 1e-9}
    assert len(found) == len(set(found)) and near <= set(found) and near
    assert sum(len(x) for x, _ in splits.equal_pairs(own, other)) == len(a & b)


def test_classes_stay_whole_where_chunks_end(spark, monkeypatch):
    monkeypatch.setattr(splits, "CHUNK", 60)
    rng = random.Random(6)
    texts = ["".join(rng.choice(ZH) for _ in range(20 + i % 5)) for i in range(30)]
    rows = [(f"t{i}", texts[i % 30]) for i in range(30 * 9)]
    e, t = spark.createDataFrame([(f"e{i}", edited(x, i % 3, rng)) for i, x in enumerate(texts)], "id string, zh string"), spark.createDataFrame(rows, "id string, a string").repartition(5)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        links = splits.class_overlaps(e, t, "id", "id", ["zh"], ["a"]).links.collect()
        pairs = splits.find_overlaps(e, t, "id", "id", ["zh"], ["a"]).count()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert len(links) == 30 and {(r["eval_copies"], r["train_copies"]) for r in links} == {(1, 9)} and pairs == 270


def test_parts_hold_a_bounded_share():
    options = splits.Winnowing()
    held, read = splits.parts(400_000_000, 3_000_000_000, options)
    assert 400_000_000 / held <= options.per_salt * 1000 and read > 1 and splits.parts(0, 0, options) == (1, 1)
    assert np.prod(splits.parts(4_000_000, 20_000_000, options)) >= splits.LEAST_CELLS
