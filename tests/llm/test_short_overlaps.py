"""Every pair with up to a fifth edited is found, at every length."""

import random

from loomline.llm import splits

ZH = "的一是不了人我在有他这中大来上国个到说们为子和你地出道也时年得就那要下以生会自着去之过家学"


def test_a_fifth_edited_at_every_length(spark):
    rng = random.Random(6)
    train, evaluation, expected = [], [], set()
    for n in [*range(5, 31), 40, 60]:
        for k in range(8):
            text = [rng.choice(ZH) for _ in range(n)]
            other = list(text)
            places = rng.sample(range(n), n // 5) if k else range(n // (n // 5 + 1), n, n // (n // 5 + 1) + 1)
            for at in list(places)[: n // 5]:
                other[at] = "甲"
            train.append((f"t{n}_{k}", "".join(text), None))
            evaluation.append((f"e{n}_{k}", "".join(other), None))
            expected.add((f"e{n}_{k}", f"t{n}_{k}"))
    e = spark.createDataFrame(evaluation, "id string, zh string, ko string")
    t = spark.createDataFrame(train, "id string, a string, b string")
    rows = splits.find_overlaps(e, t, "id", "id", ["zh", "ko"], ["a", "b"]).collect()
    assert expected <= {(r["eval_id"], r["train_id"]) for r in rows} and len(rows) == len({(r["eval_id"], r["train_id"]) for r in rows})
