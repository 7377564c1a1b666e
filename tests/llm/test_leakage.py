import random

from loomline.functions.fold import fold_text
from loomline.llm import leakage

ZH = "的一是不了人我在有他这中大来上国个到说们为子和你地出道也时年得就那要下以生会自着去之过家学对可她里后小么心多天而能好都然没日于起还发成事只作当想看文无开手十用主行方又如前所本见经头面公同三已老从动两长"


def brute(documents, items, share):
    found = set()
    for d, text in documents:
        text = fold_text(text or "")
        for i, item in items:
            item = fold_text(item)
            k = 6
            held = {text[p : p + k] for p in range(len(text) - k + 1)}
            covered = set()
            for p in range(len(item) - k + 1):
                if item[p : p + k] in held:
                    covered.update(range(p, p + k))
            if item and len(covered) / len(item) >= share:
                found.add((d, i))
    return found


def test_equals_brute_force(spark):
    rng = random.Random(1)
    sentence = lambda n: "".join(rng.choice(ZH) for _ in range(n))
    items = [(i, sentence(rng.randint(50, 200))) for i in range(40)]
    documents = []
    for d in range(120):
        text = sentence(rng.randint(50, 3000))
        if d % 2 == 0:
            item = rng.choice(items)[1]
            begin = rng.choice([0, 0, len(item) // 3])
            part = list(item[begin : begin + max(1, int(len(item) * rng.choice([0.2, 0.65, 1.0])))])
            if len(part) > 40:
                part[len(part) // 2] = "，"
            at = rng.randint(0, len(text))
            text = text[:at] + "。".join(["".join(part[:10]), "".join(part[10:])]) + text[at:]
        documents.append((d, text))
    documents += [(900, None), (901, ""), (902, "短"), (0, documents[0][1])]
    docs = spark.createDataFrame(documents, "doc_id long, text string")
    bench = spark.createDataFrame([(i, t, "x") for i, t in items] + [(800, None, "x"), (801, "短", "x"), (802, "", "x")], "item_id long, text string, doc_id string")
    got = {tuple(r) for r in leakage.find_leaks(docs, bench).collect()}
    assert got == brute(documents, items, 0.5) and len(got) > 20


def test_lead_ins_alone_are_no_leaks(spark):
    lead = "请将下面的文本译成韩语并保持原文的格式与称谓："
    items = spark.createDataFrame([(i, lead + "".join(ZH[(7 * i + 13 * k * (i + 1)) % len(ZH)] for k in range(60))) for i in range(4)], "item_id long, text string")
    docs = spark.createDataFrame([(1, lead + "完全不同的内容" * 9), (2, items.first()["text"])], "doc_id long, text string")
    assert {tuple(r) for r in leakage.find_leaks(docs, items).collect()} == {(2, 0)}


def test_blocks_of_items_give_the_same(spark, monkeypatch):
    items = spark.createDataFrame([(i, "".join(ZH[(11 * i + 17 * k * (i + 3)) % len(ZH)] for k in range(80))) for i in range(9)], "item_id long, text string")
    docs = spark.createDataFrame([(r["item_id"], r["text"]) for r in items.collect()], "doc_id long, text string")
    whole = {tuple(r) for r in leakage.find_leaks(docs, items).collect()}
    monkeypatch.setattr(leakage, "MAX_ITEMS", 4)
    assert {tuple(r) for r in leakage.find_leaks(docs, items).collect()} == whole >= {(i, i) for i in range(9)}
    assert leakage.find_leaks(docs.limit(0), items).count() == 0 == leakage.find_leaks(docs, items.limit(0)).count()


def test_many_items_take_one_scan(spark, monkeypatch, capsys):
    """Ten thousand items: every planted one is found, and the documents are read once."""
    rng = random.Random(8)
    sentence = lambda n: "".join(rng.choice(ZH) for _ in range(n))
    items = [(i, sentence(rng.randint(40, 160))) for i in range(10_000)]
    documents, expected = [], set()
    for d in range(60):
        i, item = rng.choice(items)
        documents.append((d, sentence(300) + item[: max(1, int(len(item) * 0.7))] + sentence(500)))
        expected.add((d, i))
    docs = spark.createDataFrame([*documents, (0, documents[0][1]), (90, None), (91, "")], "doc_id long, text string")
    bench = spark.createDataFrame([*items, (20_000, None), (20_001, "短")], "item_id long, text string")
    scans = []
    plain = leakage.join_leaks
    monkeypatch.setattr(leakage, "join_leaks", lambda *a: scans.append(1) or plain(*a))
    got = [tuple(r) for r in leakage.find_leaks(docs, bench).collect()]
    assert scans == [1] and set(got) == expected and len(got) == len(expected) + 1  # the repeated row is reported twice


def test_lead_ins_of_any_length(spark):
    lead = "请" * 90 + "："
    items = spark.createDataFrame([(i, lead + "".join(ZH[(7 * i + 13 * k * (i + 1)) % len(ZH)] for k in range(60))) for i in range(4)], "item_id long, text string")
    docs = spark.createDataFrame([(1, lead + "完全不同的内容" * 9), (2, items.first()["text"])], "doc_id long, text string")
    assert {tuple(r) for r in leakage.find_leaks(docs, items).collect()} == {(2, 0)}
