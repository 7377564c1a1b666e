"""Problem 1: one consistent form for texts that only look the same.

Compatibility forms of letters and digits, combining accents and jamo, blanks
and invisible characters are normalised one by one.  Letters of other alphabets
that imitate a Latin letter (or the other way round) need their neighbours: every
token of such letters is a lattice of its possible readings, and Viterbi picks
the best one under character bigram scores, counted over the whole corpus, plus
a price for each change of script inside the token and for each substitution.
Punctuation and symbols stay as they are.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomline.functions.fold import LOOKALIKES, SAME_LOOK

#: Characters that show nothing, besides those of category Cf.
INVISIBLE = "\u034f\u115f\u1160\u17b4\u17b5\u180b\u180c\u180d\u180f\u3164\uffa0" + "".join(map(chr, range(0xFE00, 0xFE10)))

#: Radicals that look like a whole character and have no decomposition.
RADICALS = {
    "⺁": "厂", "⺌": "小", "⺎": "尢", "⺒": "巳", "⺓": "幺", "⺛": "旡", "⺝": "月", "⺟": "母", "⺠": "民", "⺮": "竹",
    "⺸": "羊", "⺻": "聿", "⺽": "臼", "⻁": "虎", "⻃": "西", "⻄": "西", "⻅": "见", "⻆": "角", "⻉": "贝", "⻋": "车",
    "⻑": "長", "⻒": "镸", "⻓": "长", "⻔": "门", "⻘": "青", "⻙": "韦", "⻚": "页", "⻛": "风", "⻜": "飞", "⻝": "食",
    "⻢": "马", "⻣": "骨", "⻤": "鬼", "⻥": "鱼", "⻦": "鸟", "⻧": "卤", "⻨": "麦", "⻩": "黄", "⻪": "黾", "⻫": "斉",
    "⻬": "齐", "⻭": "歯", "⻮": "齿", "⻯": "竜", "⻰": "龙", "⻲": "亀", "⻳": "龟",
}

#: What a change of script between two letters of a token costs, in nats.
SCRIPT_PRICE = 8.0

#: What reading a letter as another one costs.
CHANGE_PRICE = 0.25

#: Weight of the single-letter frequencies in a bigram's estimate.
BACKOFF = 200.0

#: A value is worth a look if it has a radical or any character but the plain
#: ones (Java syntax).  Punctuation and symbols are plain, whatever their width.
SUSPICIOUS = (
    r"[\u2E80-\u2FDF]|[^\t\n\r \p{P}\p{S}0-9A-Za-z\u00C0-\u024F\u1E00-\u1EFF\u3041-\u3096\u30A1-\u30FA\u30FC"
    r"\u3007\u3400-\u4DBF\u4E00-\u9FFF\uAC00-\uD7A3ΩβΣΠΔΨΦΓΛΘΞ]"
)

_REVERSE: dict[str, list[str]] = {}
for _other, _latin in LOOKALIKES.items():
    _REVERSE.setdefault(_latin, []).append(_other)

#: Letters and digits that the lattice knows.
ALPHABET = "".join(sorted(set("0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ") | set(LOOKALIKES) | set(LOOKALIKES.values())))

_TOKEN = re.compile(r"(?:[^\W_][\u0300-\u036f]*)+")


def script(char: str) -> str:
    """The alphabet of a letter; empty for digits and for characters without one."""
    point = ord(char)
    if point < 0x250 or 0x1E00 <= point < 0x1F00:
        return "Latin" if char.isalpha() else ""
    for name, low, high in (
        ("Greek", 0x370, 0x400), ("Cyrillic", 0x400, 0x530), ("Armenian", 0x530, 0x590), ("Cherokee", 0x13A0, 0x1400),
        ("Greek", 0x1F00, 0x2000), ("Latin", 0x250, 0x2B0),
    ):
        if low <= point < high:
            return name
    return "" if not char.isalpha() else "other"


class Normalizer:
    """Brings texts to the consistent form, given character pair counts."""

    def __init__(self, pairs: dict[str, int]):
        self.pairs = pairs
        self.single: dict[str, int] = {}
        for pair, n in pairs.items():
            self.single[pair[0]] = self.single.get(pair[0], 0) + n
        self.total = sum(self.single.values()) + len(ALPHABET)
        self.simple: dict[int, str | None] = {}
        self.tokens: dict[str, str] = {}

    def __call__(self, text: str) -> str:
        text = unicodedata.normalize("NFC", text.translate(self))
        if not any(c in LOOKALIKES for c in text):
            return text
        return unicodedata.normalize("NFC", _TOKEN.sub(self._token, text))

    def __getitem__(self, point: int) -> str:
        """str.translate looks characters up here."""
        found = self.simple.get(point)
        if found is None:
            found = self.simple[point] = plain_form(chr(point))
        return found

    def _token(self, match: re.Match) -> str:
        token = match.group()
        known = self.tokens.get(token)
        if known is None:
            if len(self.tokens) > 100_000:
                self.tokens.clear()
            known = self.tokens[token] = "".join(self.best(p) if any(c in LOOKALIKES for c in p) else p for p in runs(token))
        return known

    def score(self, before: str, char: str) -> float:
        """log P(char | before), with the letter's own frequency behind it."""
        own = (self.single.get(char, 0) + 1) / self.total
        seen = self.single.get(before, 0)
        return math.log((self.pairs.get(before + char, 0) + BACKOFF * own) / (seen + BACKOFF))

    def best(self, token: str) -> str:
        """The best path through the readings of a token."""
        scripts = {script(c) for c in token if c not in LOOKALIKES} - {"", "Latin"}
        # Per reading of the letter before: value, alphabet of the last letter, linked path.
        paths: dict[str, tuple[float, str, tuple | None]] = {"^": (0.0, "", None)}
        for char in token:
            if unicodedata.combining(char):  # an accent goes with the letter before it
                paths = {before: (value, last, (path, char)) for before, (value, last, path) in paths.items()}
                continue
            readings = {char: 0.0}
            if char in LOOKALIKES:
                readings[LOOKALIKES[char]] = CHANGE_PRICE
            elif scripts:  # a Latin letter may stand in a word of another alphabet
                readings.update({o: CHANGE_PRICE for o in _REVERSE.get(char, ()) if script(o) in scripts})
            following: dict[str, tuple[float, str, tuple | None]] = {}
            for reading, price in readings.items():
                kind = script(reading)
                best = None
                for before, (value, last, path) in paths.items():
                    value += self.score(before, reading) - price
                    if kind and last and last != kind:
                        value -= SCRIPT_PRICE
                    if best is None or value > best[0]:
                        best = (value, kind or last, (path, reading))
                following[reading] = best
            paths = following
        link = max(paths.values(), key=lambda p: p[0])[2]
        out = []
        while link is not None:
            link, char = link
            out.append(char)
        return "".join(reversed(out))


def runs(token: str) -> list[str]:
    """A word cut where letters of the lattice's alphabets meet others."""
    out: list[str] = []
    inside = None
    for char in token:
        now = script(char) != "other" or bool(unicodedata.combining(char))
        if now == inside:
            out[-1] += char
        else:
            out.append(char)
            inside = now
    return out


def plain_form(char: str) -> str:
    """The consistent form of one character without its neighbours."""
    kind = unicodedata.category(char)
    if char in "\t\n\r ":
        return char
    if char in INVISIBLE or 0xE0100 <= ord(char) <= 0xE01EF:
        return ""
    if char in "\x0b\x0c\x85" or kind in ("Zl", "Zp"):
        return "\n"
    if kind in ("Cc", "Cf"):
        return ""
    if kind == "Zs":
        return " "
    if char in RADICALS:
        return RADICALS[char]
    if kind[0] in "LM" or kind in ("Nd", "Nl") or 0x2E80 <= ord(char) <= 0x2FDF:
        parts = unicodedata.decomposition(char).split()
        if parts and (parts[0] in SAME_LOOK or parts[0][0] != "<"):
            return unicodedata.normalize("NFKC", char)
    return char


def pair_counts(df: DataFrame, columns: list[str]) -> dict[str, int]:
    """Counts of neighbouring characters inside tokens, over all rows.

    Only the lattice's alphabet counts, so there are at most ``len(ALPHABET)``
    squared pairs (about 40,000), however large the corpus is.
    """
    letters = f"[{ALPHABET}]"
    texts = df.select(F.explode(F.array(*(F.col(f"`{c}`") for c in columns))).alias("text"))
    # Outer: else the optimiser makes every array twice, to drop the empty ones first.
    tokens = texts.select(F.explode_outer(F.regexp_extract_all("text", F.lit(f"{letters}+"), F.lit(0))).alias("token")).where("token is not null")
    marked = tokens.select(F.concat(F.lit("^"), F.col("token")).alias("token"))
    pairs = marked.select(F.explode_outer(F.expr("transform(sequence(1, length(token) - 1), i -> substring(token, i, 2))")).alias("pair"))
    return {r["pair"]: r["n"] for r in pairs.groupBy("pair").agg(F.count("*").alias("n")).collect() if r["pair"]}


def suspicious(column: Column) -> Column:
    """Whether a value has any character that may need a change; null for null."""
    return column.rlike(SUSPICIOUS)


def normalizer_udf(spark, pairs: dict[str, int]):
    """Column function for the consistent form of values (null gives null)."""
    shared = spark.sparkContext.broadcast(pairs)

    @F.pandas_udf("string")
    def consistent(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        normalizer = Normalizer(shared.value)
        for values in batches:
            yield values.map(lambda v: None if v is None else normalizer(v), na_action=None)

    return consistent


def normalize_columns(df: DataFrame, columns: list[str], pairs: dict[str, int] | None = None) -> DataFrame:
    """The table with ``columns`` in the consistent form.

    Only values with a suspicious character leave the JVM.  Null stays null, the
    empty text empty; repeated rows and other columns are untouched.  The pair
    counts come from the whole table unless they are given.
    """
    pairs = pair_counts(df, columns) if pairs is None else pairs
    consistent = normalizer_udf(df.sparkSession, pairs)
    changed = {}
    for c in columns:
        value = F.col(f"`{c}`")
        changed[c] = F.coalesce(consistent(F.when(suspicious(value), value)), value)
    return df.withColumns(changed)


def find_inconsistent(df: DataFrame, key: str, columns: list[str], pairs: dict[str, int] | None = None) -> DataFrame:
    """(record_id, field, value, consistent) of every value not in the consistent form.

    Null and empty values give no rows; a repeated row gives its rows again.
    """
    pairs = pair_counts(df, columns) if pairs is None else pairs
    consistent = normalizer_udf(df.sparkSession, pairs)
    fields = F.explode(F.array(*(F.struct(F.lit(c).alias("field"), F.col(f"`{c}`").alias("value")) for c in columns)))
    values = df.select(F.col(f"`{key}`").alias("record_id"), fields.alias("f")).select("record_id", "f.field", "f.value")
    looked_at = values.where(suspicious(F.col("value"))).withColumn("consistent", consistent("value"))
    return looked_at.where(F.col("consistent") != F.col("value"))
