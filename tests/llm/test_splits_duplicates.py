import random

from loomline.functions.fold import fold_text
from loomline.llm import duplicates, splits

ZH = "的一是不了人我在有他这中大来上国个到说们为子和你地出道也时年得就那要下以生会自着去之过家学"


def plain_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
    return row[-1]


def test_edit_distance():
    rng = random.Random(1)
    for _ in range(300):
        a, b = ("".join(rng.choice("甲乙丙") for _ in range(rng.randint(0, 12))) for _ in range(2))
        assert splits.edit_distance(a, b) == plain_distance(a, b)


def test_long_and_monotonous_texts(spark):
    rng = random.Random(4)
    long = "".join(rng.choice(ZH) for _ in range(30_000))
    e = spark.createDataFrame([("e1", "长" * 50_000 + "甲", long), ("e2", "短", "乙")], "id string, zh string, ko string")
    t = spark.createDataFrame([("t1", "长" * 49_000 + "乙", "x"), ("t2", "y", long[:15_000] + "改" + long[15_000:]), ("t3", "长" * 30_000, long[:20_000])], "id string, a string, b string")
    got = {(r["eval_id"], r["train_id"]) for r in splits.find_overlaps(e, t, "id", "id", ["zh", "ko"], ["a", "b"]).collect()}
    assert got == {("e1", "t1"), ("e1", "t2")}


def test_overlaps_equal_brute_force(spark):
    rng = random.Random(2)
    text = lambda n: "".join(rng.choice(ZH) for _ in range(n))
    train = [(f"t{i}", text(rng.randint(20, 50)), text(30) if i % 9 else None) for i in range(150)]
    evaluation = []
    for i in range(60):
        base = list(train[rng.randrange(len(train))][1])
        for _ in range(int(len(base) * rng.choice([0, 0.05, 0.1, 0.4]))):
            base[rng.randrange(len(base))] = rng.choice(ZH)
        base.insert(len(base) // 2, "， ")
        evaluation.append((f"e{i}", "".join(base) if i % 4 else text(40), train[i][2] if i % 5 == 0 else text(30)))
    evaluation += [("e90", None, None), ("e91", "", "  "), ("e92", "甲", "乙丙")]
    train += [("t900", "甲", "！"), ("t901", train[0][1], None), ("t902", None, "")]
    e = spark.createDataFrame([(*r, "x") for r in evaluation], "id string, zh string, ko string, field string")
    t = spark.createDataFrame(train, "id string, a string, b string")
    expected = set()
    for ei, *es in evaluation:
        for ti, *ts in train:
            for x, y in zip(es, ts):
                x, y = fold_text(x or ""), fold_text(y or "")
                if x and y and plain_distance(x, y) <= 0.2 * max(len(x), len(y)):
                    expected.add((ei, ti))
    rows = splits.find_overlaps(e, t, "id", "id", ["zh", "ko"], ["a", "b"]).collect()
    assert {(r["eval_id"], r["train_id"]) for r in rows} == expected and len(rows) == len(expected) > 30
    assert all(0 < r["coverage"] <= 1 for r in rows)
    salted = splits.find_overlaps(e, t, "id", "id", ["zh", "ko"], ["a", "b"], splits.Winnowing(per_salt=1)).collect()
    assert {(r["eval_id"], r["train_id"]) for r in salted} == expected
    assert splits.find_overlaps(e.limit(0), t, "id", "id", ["zh", "ko"], ["a", "b"]).count() == 0


def test_windows_keep_a_run_that_no_edit_spoils():
    """For every pair within the limit one kept run of the longer text stands in the other, near its place."""
    import numpy as np

    rng, options = random.Random(3), splits.Winnowing()
    for n in [*range(5, 60), 150, 700]:
        text = "".join(rng.choice(ZH) for _ in range(n))
        edits, other = int(n * 0.2), list(text)
        for _ in range(edits):
            at = rng.randrange(len(other))
            other[at : at + 1] = rng.choice([[], ["甲"], ["甲"]])
        other = "".join(other)
        own = splits.Batch(np.zeros(2, np.int64), [text, other], options)
        hashes, rows, places, numbers = own.rarest_runs(np.zeros(options.buckets, np.int64))
        k = int(options.run(n))
        mine = [(int(p), int(i)) for r, p, i in zip(rows, places, numbers) if r == 0]
        assert [i for _, i in sorted(mine)] == list(range(edits + 1)) and all(q - p >= k for (p, _), (q, _) in zip(sorted(mine), sorted(mine)[1:]))
        assert k in splits.run_lengths(len(other), options)
        assert any(text[p : p + k] == other[q : q + k] and abs(p - q) <= i and abs(n - len(other) - p + q) <= edits - i for p, i in mine for q in range(len(other) - k + 1)), (text, other)


def test_windows_keep_the_rarest_runs():
    import numpy as np

    options, text = splits.Winnowing(), "甲乙丙丁戊己庚辛壬癸子丑寅卯辰巳"  # 16 characters: four windows of four
    own = splits.Batch(np.zeros(1, np.int64), [text + "午未申酉"[:3]], options)
    counts = np.ones(options.buckets, np.int64) * 100
    rare = own.runs(4)[2]
    counts[int(rare % np.uint64(options.buckets))] = 0
    assert 2 in own.rarest_runs(counts)[2].tolist()


def test_chain():
    assert splits.chain([(0, 5), (1, 0), (2, 1), (3, 2), (2, 9)]) == [(1, 0), (2, 1), (3, 2)]
    assert splits.extended("abcdef", "xbcdey", [(2, 2)]) == 4


def test_copies(spark):
    rows = [
        ("3", "甲，乙 BOSS", "가 나."), ("1", "甲乙boss！", "가나"), ("2", "（甲乙）ＢＯＳＳ", "가\n나"), ("4", "甲丙", "가나"), ("5", "攻击=+1;防御：-2%", "공격: +1"), ("6", "防御: -2% | 攻击: +1", "공격=+1"),
        ("7", "攻击=-1;防御:-2%", "공격: +1"), ("8", None, None), ("9", "", " "), ("4", "甲丙", "가나"), ("a", "长" * 100_000, "x"), ("b", "长" * 100_000 + "。", "X"),
    ]
    df = spark.createDataFrame([(*r, "h") for r in rows], "id string, zh string, ko string, hash string")
    got = sorted(tuple(r) for r in duplicates.list_copies(df, "id", ["zh", "ko"]).collect())
    assert got == [("1", "2"), ("1", "3"), ("5", "6"), ("8", "9"), ("a", "b")]
    counts = {r["kept_id"]: r["copies"] for r in duplicates.count_copies(df, "id", ["zh", "ko"]).collect()}
    assert counts == {"1": 3, "4": 2, "5": 2, "7": 1, "8": 2, "a": 2}
    assert duplicates.list_copies(df.limit(0), "id", ["zh", "ko"]).count() == 0


def test_copies_beyond_the_hot_groups(spark, monkeypatch):
    monkeypatch.setattr(duplicates, "HOT_SHARE", 0.5)
    df = spark.createDataFrame([(f"{i:03}", f"文{i % 7}", "가") for i in range(60)] + [(f"9{i:03}", "热", "가") for i in range(200)], "id string, zh string, ko string")
    got = duplicates.list_copies(df, "id", ["zh", "ko"]).groupBy("kept_id").count().collect()
    assert {r["kept_id"]: r["count"] for r in got} == {**{f"{i:03}": len(range(i, 60, 7)) - 1 for i in range(7)}, "9000": 199}
