import random

from loomline.operators import matching as M

TERMS = "term_id string, term_src string, term_tgt string"
ROWS = "segment_id string, src string, tgt string"


def collect(df, *columns):
    return {r["segment_id"]: tuple(r[c] for c in columns) for r in df.collect()}


def test_longest_first_marking(spark):
    terms = spark.createDataFrame([("1", "BOSS", "보스"), ("2", "BOSS层", "보스층")], TERMS)
    rows = spark.createDataFrame([("a", "挑战BOSS和BOSS层", "x"), ("b", "没有", "y"), ("c", "<start>BOSS<end>来", "z"), ("d", "", "")], ROWS)
    got = collect(M.mark_sources(rows, terms), "marked", "n_marked")
    assert got == {"a": ("挑战<start>BOSS<end>和<start>BOSS层<end>", 2), "b": ("没有", 0), "c": ("<start>BOSS<end>来", 0), "d": ("", 0)}


def test_pair_marking(spark):
    terms = spark.createDataFrame([("1", "神秘宝箱", "신비한 보물상자"), ("2", "神", "신")], TERMS)
    rows = spark.createDataFrame([
        ("a", "打开神秘宝箱", "신비한 보물상자 열기"), ("b", "打开神秘宝箱", "상자 열기"), ("c", "<start>神秘宝箱<end>", "<start>신비한 보물상자<end>"),
    ], ROWS)
    got = collect(M.mark_pairs(rows, terms), "marked_src", "marked_tgt", "n_terms")
    assert got["a"] == ("打开<start>神秘宝箱<end>", "<start>신비한 보물상자<end> 열기", 1)
    assert got["b"] == ("打开神秘宝箱", "상자 열기", 0)
    assert got["c"] == ("<start>神秘宝箱<end>", "<start>신비한 보물상자<end>", 0)


def brute(text, terms):
    taken, out = [], []
    for tid, src in sorted(terms, key=lambda t: (-len(t[1]), int(t[0]))):
        for p in range(len(text) - len(src) + 1):
            if text[p : p + len(src)] == src and not any(p < e and s < p + len(src) for s, e in taken):
                taken.append((p, p + len(src)))
                out.append((p, p + len(src), tid))
    return sorted(out)


def test_matches_equal_brute_force(spark):
    rng = random.Random(7)
    words = sorted({"".join(rng.choice("甲乙丙") for _ in range(rng.randint(1, 4))) for _ in range(25)})
    terms = [(str(i), w) for i, w in enumerate(words, 1)]
    texts = [(str(i), "".join(rng.choice("甲乙丙丁") for _ in range(rng.randint(0, 14)))) for i in range(150)]
    term_df = spark.createDataFrame([(i, w, "가") for i, w in terms], TERMS)
    rows = spark.createDataFrame([(i, t, "가 나") for i, t in texts], ROWS)
    expected = {i: b for i, t in texts if (b := brute(t, terms))}
    for bound in (M.MAX_BROADCAST, 3):
        original, M.MAX_BROADCAST = M.MAX_BROADCAST, bound
        try:
            got = {r["segment_id"]: [(m["start"], m["end"], m["term_id"]) for m in r["matches"]] for r in M.find_matches(rows, term_df).collect()}
        finally:
            M.MAX_BROADCAST = original
        assert got == expected


def test_first_place_drops_and_first_free_retries(spark):
    terms = spark.createDataFrame([("1", "甲乙", "a"), ("2", "乙", "b")], TERMS)
    rows = spark.createDataFrame([("x", "甲乙丙乙", "t")], ROWS)
    assert collect(M.first_free_terms(rows, terms), "terms")["x"][0] == ["1", "2"]
    assert [t["term_id"] for t in collect(M.first_place_terms(rows, terms), "terms")["x"][0]] == ["1"]
    assert M.find_matches(rows.limit(0), terms).count() == 0
    assert M.find_matches(rows, terms.limit(0)).count() == 0


def test_terms_beyond_the_broadcast_bound_give_the_same(spark):
    from loomline.operators import matching

    texts = spark.createDataFrame([(str(i), "宝箱强化石宝箱" + "甲乙"[i % 2] * 3, "x") for i in range(40)] + [("long", "文" * 30_000 + "宝箱", "x"), ("none", "", "x")], "segment_id string, src string, tgt string")
    terms = spark.createDataFrame([("1", "宝箱", "x"), ("2", "强化石", "y"), ("3", "甲", "x"), ("4", "乙乙", "x"), ("5", "文宝箱", "x")], "term_id string, term_src string, term_tgt string")
    rows = lambda bound: sorted((r["segment_id"], r["term_id"]) for r in matching.candidates(texts, terms, bound=bound).collect())
    assert rows(100) == rows(2) and ("long", "5") in rows(2) and len([r for r in rows(2) if r[1] == "4"]) == 20


def test_more_terms_than_are_broadcast(spark):
    from pyspark.sql import functions as F

    from loomline.operators import matching

    many = spark.range(matching.MAX_BROADCAST + 1).select(F.col("id").cast("string").alias("term_id"), F.concat(F.lit("词"), F.col("id").cast("string"), F.lit("尾")).alias("term_src"), F.lit("x").alias("term_tgt"))
    texts = spark.createDataFrame([("a", "前词77尾后词100000尾"), ("b", "无")], "segment_id string, src string")
    assert {(r["segment_id"], r["term_id"]) for r in matching.candidates(texts, many).collect()} == {("a", "77"), ("a", "100000")}


def test_places_of_a_term(spark):
    import time

    from pyspark.sql import functions as F

    from loomline.operators import matching

    long = "文字" * 16_000 + "宝箱" + "文" * 10
    rows = [("aaaa", "aa"), ("xaxax", "ax"), ("a.b.", "."), (r"q\Eq\E", r"\E"), ("甲乙甲", "甲"), ("甲", "甲乙"), (long, "宝箱"), ("𠀀a𠀀", "𠀀")]
    df = spark.createDataFrame(rows, "t string, w string")
    began = time.time()
    got = [r[0] for r in df.select(matching.positions(F.col("t"), F.col("w"), F.length("w"))).collect()]
    assert got == [[1, 2, 3], [2, 4], [2, 4], [2, 5], [1, 3], [], [32_001], [1, 3]] and time.time() - began < 20
