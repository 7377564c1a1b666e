"""Where single letters cannot be judged the lattice decides: words of other alphabets stay, mixed ones resolve both ways."""

import random

import pytest

from loomline.functions.fold import LOOKALIKES
from loomline.llm import lookalike

RUSSIAN = "москва привет письмо король крепость рыцарь хорошо север восток сокровище меч щит стрела карта орк".split()
GREEK = "ΣΟΦΙΑ ΚΟΣΜΟΣ ΘΑΛΑΣΣΑ ΛΟΓΟΣ ΦΩΣ ΔΡΑΚΩΝ".split()
LATIN = "BOSS NPC VIP Seraphe Noctel HP DPS PVP castle sword shield arrow potion market copper scope".split()


@pytest.fixture(scope="module")
def normal(spark):
    rows = [(w,) for w in (RUSSIAN + GREEK + LATIN) * 40]
    return lookalike.Normalizer(lookalike.pair_counts(spark.createDataFrame(rows, "t string"), ["t"]))


def plain(text):
    """What a substitution letter by letter would make of a text."""
    return "".join(LOOKALIKES.get(c, c) for c in text)


def test_words_of_other_alphabets_stay(normal):
    for word in RUSSIAN + GREEK:
        assert normal(word) == word
    assert sum(plain(w) != w for w in RUSSIAN + GREEK) > 15  # letter by letter they would not


def test_mixed_words_resolve_both_ways(normal):
    reverse = {}
    for other, latin in LOOKALIKES.items():
        if "а" <= other.lower() <= "я":
            reverse.setdefault(latin, other)
    rng = random.Random(3)
    right = {"latin": 0, "russian": 0}
    total = {"latin": 0, "russian": 0}
    for kind, words, swap in (("latin", [w for w in LATIN if len(w) > 3], reverse), ("russian", [w for w in RUSSIAN if len(w) > 4], {o: x for o, x in LOOKALIKES.items() if "а" <= o.lower() <= "я"})):
        for word in words:
            places = [i for i, c in enumerate(word) if c in swap]
            if not places:
                continue
            at = rng.choice(places)
            mixed = word[:at] + swap[word[at]] + word[at + 1 :]
            total[kind] += 1
            right[kind] += normal(mixed) == word
    assert total["latin"] >= 6 and total["russian"] >= 8
    assert right["latin"] >= 0.9 * total["latin"] and right["russian"] >= 0.9 * total["russian"]


def test_words_that_are_all_lookalikes_follow_the_corpus(normal):
    assert normal("ВОЅЅ") == "BOSS" and normal("орк") == "орк"
