import math
import random
from collections import Counter

import pytest

from loomline.operators import metrics

ROWS = "row_number long, segment_id string, source string, reference string, candidate string, system string"


def frame(spark, pairs, source="源"):
    return spark.createDataFrame([(i, str(i), source, r, c, "s") for i, (r, c) in enumerate(pairs)], ROWS)


def plain_bleu(pairs, order=4, smoothing=0.1):
    clipped, possible, rl, cl = [0] * order, [0] * order, 0, 0
    for r, c in pairs:
        r, c = r.split(), c.split()
        rl, cl = rl + len(r), cl + len(c)
        for n in range(1, order + 1):
            rc, cc = (Counter(tuple(x[i : i + n]) for i in range(len(x) - n + 1)) for x in (r, c))
            clipped[n - 1] += sum(min(v, rc[k]) for k, v in cc.items())
            possible[n - 1] += max(0, len(c) - n + 1)
    logs = [math.log(m / p if m else smoothing / (p + smoothing)) for m, p in zip(clipped, possible) if p]
    if not logs:
        return 0.0
    return (0.0 if cl == 0 else 1.0 if cl > rl else math.exp(1 - rl / cl)) * math.exp(sum(logs) / len(logs))


def test_bleu(spark):
    assert metrics.bleu(frame(spark, [("a b c d e", "a b c d e")])).first()["bleu"] == pytest.approx(1.0)
    empty = metrics.bleu(frame(spark, [("a b", "")])).first()
    assert (empty["bleu"], empty["candidate_length"]) == (0.0, 0)
    rng = random.Random(5)
    pairs = [(" ".join(rng.choices("abcd", k=rng.randint(1, 9))), " ".join(rng.choices("abcd", k=rng.randint(0, 9)))) for _ in range(60)]
    assert metrics.bleu(frame(spark, pairs)).first()["bleu"] == pytest.approx(plain_bleu(pairs))


def test_chrf(spark):
    assert metrics.chrf(frame(spark, [("abc def", "abc")])).first()["chrf"] == pytest.approx(0.21863, abs=5e-5)
    assert metrics.chrf(frame(spark, [("가나 다", "가나다")])).first()["chrf"] == pytest.approx(1.0)
    assert metrics.chrf(frame(spark, [("abc", "xyz")])).first()["chrf"] == 0.0


def test_preservation(spark):
    terms = spark.createDataFrame([("1", "BOSS", "보스"), ("2", "VIP卡", "VIP 카드"), ("3", "副本", "던전")], "term_id string, term_src string, term_tgt string")
    rows = spark.createDataFrame([
        (1, "1", "挑战BOSS", "보스 도전", "보스 도전", "s"), (2, "2", "领取VIP卡", "VIP 카드 수령", "<start>VIP 카드<end> 수령", "s"),
        (3, "3", "进入副本", "던전 입장", "입장", "s"), (4, "4", "普通句子", "일반 문장", "일반 문장", "s"), (5, "5", "VIP卡", "x", "VIP카드", "s"),
    ], ROWS)
    per_row = metrics.preservation_rows(rows, terms)
    assert [r["status_exact"] for r in per_row.orderBy("row_number").collect()] == ["all_matched", "all_matched", "not_matched", "no_terms", "not_matched"]
    total = metrics.preservation(per_row).first()
    assert (total["total_terms"], total["matched_exact"], total["matched_nospace"], total["rows_without_terms"]) == (4, 2, 3, 1)
    assert [r["row_number"] for r in metrics.review_sample(per_row, 2).collect()] == [3, 5]
    with pytest.raises(ValueError):
        metrics.review_sample(per_row, 0)
    long = metrics.long_format(metrics.evaluate(rows, terms, ["system"]), ["system"])
    assert {r["metric"] for r in long.collect()} >= {"bleu", "chrf", "composite", "empty_candidates"}
