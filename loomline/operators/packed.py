"""Problem 3: several values packed in one field.

For every source and field the separators that occur are scored: by how regular
the types of the pieces are that they cut (labelled values, coded items, short
items, quoted values) and by how often the count of pieces agrees with that of
the parallel field.  Separators with a good score are the source's delimiters.
A value is a list when the delimiters that it holds cut it into regular pieces
only; quoted pieces may hold anything.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomline.functions.lineage import checkpointed

#: Full-width forms of characters that matter here.
WIDE = dict(zip(map(ord, "｜；，／：＝＂＇＃＼［］｛｝＆＊～＾＠！？％＋－．　"), "|;,/:=\"'#\\[]{}&*~^@!?%+-. "))

#: Signs that never separate values: stops, signs of numbers and labels.
NO_SEPARATORS = "\"'.。!?…·:=+-%$\\_<>‥․"


def separator_class() -> str:
    """Character class of the signs that may separate values: punctuation and
    symbols but brackets, quotes, radicals and NO_SEPARATORS."""
    kinds = {"Pd", "Po", "Sm", "Sc", "Sk", "So"}
    signs = [c for c in map(chr, [*range(0x21, 0x2E80), *range(0x3000, 0x3040), *range(0xFE30, 0xFFEF)]) if unicodedata.category(c) in kinds]
    return "".join(re.escape(c) for c in signs if c not in NO_SEPARATORS)


#: What may separate values: an escaped or real line break or tab, or one to
#: three times the same sign.
SEPARATOR = re.compile(rf"(\\[nrt])|(\r?\n|\t)|([{separator_class()}])\3{{0,2}}")
_BLANKS = re.compile(r"[ \xa0]*")

#: Separators that running text uses too: they need a piece of a strong type.
WEAK = frozenset({",", "/", "\n", "\t", "&", "~", "*"})

_LABELLED = re.compile(r"[^\W\d_][^:=|;\n]*[:=]\s*[+\-]?\d[\d.]*\s*%?")
_NAMED = re.compile(r"[^\W\d_][^:=\n]*[:=]\s*[^\s:=][^:=]*")
_CODED = re.compile(r".*(?<![0-9A-Za-z])(?:(?=[A-Za-z]*[0-9])(?=[0-9a-z]*[A-Z])[0-9A-Za-z]{4,}|[A-Z]{6,}|[0-9]{6,})", re.DOTALL)
_STOPS = re.compile(r"[,，、;；。!?！？…]|\.(?=\s|$)")
_CLOSE = re.compile(r"\s*(?:$|[^\w\s])|\s*\\[nrt]|[ \xa0]*[\n\t]")

#: Types of pieces that running text hardly ever has between separators.
STRONG = frozenset({"quoted", "labelled", "coded"})

@dataclass
class Piece:
    """One value of a list."""

    text: str
    quoted: bool


@dataclass
class Cut:
    """A value cut at the separators outside of quotes."""

    pieces: list[Piece]
    separators: list[str] = field(default_factory=list)


def separator_name(match: re.Match) -> str:
    """The separator; a line break has one name."""
    return "\n" if match.group(2) and match.group(2) != "\t" else match.group()


def cut(text: str, allowed: frozenset[str] | None = None) -> Cut:
    """Cuts a text at its separators, or at the allowed ones.

    A quote opens at the beginning of a piece and closes before a separator or
    the end; inside, a doubled or escaped quote is a sign of the text.  Brackets
    around a list of quoted values are taken off.
    """
    flat = text.translate(WIDE)
    begin, end = len(flat) - len(flat.lstrip()), len(flat.rstrip())
    if end - begin > 3 and flat[begin] + flat[end - 1] in ("[]", "{}") and flat[begin + 1 : end - 1].strip()[:1] in ('"', "'"):
        inner = flat[begin + 1 : end - 1].strip()
        if inner[-1:] == inner[0]:
            begin = flat.index(inner[0], begin + 1)
            end = flat.rindex(inner[0], begin, end - 1) + 1
    out = Cut([])
    start = at = begin
    while True:
        if at == start and flat[start : start + 1] in ('"', "'") and start < end:
            stop = closing(flat, start, end)
            after = _BLANKS.match(flat, stop + 1, end).end() if stop else 0
            match = SEPARATOR.match(flat, after, end) if stop else None
            if stop and (after >= end or match and (allowed is None or separator_name(match) in allowed)):
                quote = flat[start]
                inner = text[start + 1 : stop].replace(quote * 2, quote).replace("\\" + quote, quote)
                out.pieces.append(Piece(inner, True))
                if after >= end:
                    return out
                out.separators.append(separator_name(match))
                start = at = _BLANKS.match(flat, match.end(), end).end()
                continue
        match = SEPARATOR.search(flat, at, end)
        if match is None:
            out.pieces.append(Piece(text[start:end].strip(), False))
            return out
        name = separator_name(match)
        if allowed is None or name in allowed:
            out.pieces.append(Piece(text[start : match.start()].strip(), False))
            out.separators.append(name)
            start = at = _BLANKS.match(flat, match.end(), end).end()
        else:
            at = match.end()


def closing(flat: str, at: int, end: int) -> int:
    """Where the quote opened at ``at`` closes; 0 if nowhere."""
    quote = flat[at]
    i = at + 1
    while i < end:
        if flat[i] == "\\" and i + 1 < end and flat[i + 1] == quote:
            i += 2
        elif flat[i] == quote:
            if i + 1 < end and flat[i + 1] == quote:
                i += 2
            elif _CLOSE.match(flat, i + 1, end):
                return i
            elif i == at + 1:
                return i
            else:
                i += 1
        else:
            i += 1
    return 0


def piece_type(piece: Piece) -> str:
    """quoted, labelled, named, coded, item, sentence, empty, or "" for irregular.

    ``labelled`` is a label with its number, ``named`` a label with a text.
    """
    if piece.quoted:
        return "quoted"
    flat = piece.text.translate(WIDE).strip()
    if not flat:
        return "empty"
    if _LABELLED.fullmatch(flat):
        return "labelled"
    body = flat.rstrip("。.!?…")
    if not any(c.isalpha() for c in body) or _STOPS.search(body):
        return ""
    if ":" in body or "=" in body:
        return "named" if body == flat and _NAMED.fullmatch(body) else ""
    if body != flat:
        return "sentence"
    return "coded" if _CODED.fullmatch(body) else "item"


def is_list(parts: Cut, other: int = 0) -> bool:
    """Whether a cut gives two or more regular pieces.

    Separators of running text need a piece of a strong type, or a parallel
    field that is a list of ``other`` values; a label with a text needs labels
    in front of all values."""
    if len(parts.pieces) < 2:
        return False
    types = [piece_type(p) for p in parts.pieces]
    if "" in types or sum(t != "empty" for t in types) < 2 and "quoted" not in types:
        return False
    if "named" in types and not {"named", "labelled", "empty"}.issuperset(types):
        return False
    strong = bool(STRONG.intersection(types)) and "named" not in types
    if types.count("sentence") == len(types):
        return False
    return strong or not WEAK.intersection(parts.separators) or other > 1


def split_value(text: str | None, delimiters: frozenset[str], other: int = 0) -> list[str] | None:
    """The values of a packed text, or None where it is a single value."""
    if not text:
        return None
    parts = cut(text, delimiters)
    return [p.text for p in parts.pieces] if is_list(parts, other) else None


def packing_signs() -> str:
    """Character class (Java syntax) of all that separates or quotes, commas aside; in wide forms too.

    By categories, as a class of single signs is slow; with what a JVM does not know yet.
    """
    never = NO_SEPARATORS + "".join(chr(c) for c, to in WIDE.items() if to in NO_SEPARATORS) + ",，"
    return r"[\p{Pd}\p{Po}\p{S}\p{Cn}&&[^" + "".join("\\" + c if c.isascii() and c != "_" else c for c in never) + r"]]|[\"'＂＇\n\t\\＼]"


def may_be_packed(column: Column) -> Column:
    """A cheap test in the JVM that holds for every value that is a list.

    Separators but the comma, quotes, or a comma and a code or a labelled value
    before a comma or the end.
    """
    text = F.coalesce(column, F.lit(""))
    blank = r"[\s\p{Z}\x1c-\x1f\x85]*+"
    item = r"(?:[0-9A-Za-z]{4}|[:=：＝]" + blank + r"[+\-＋－]?\p{Nd}[\p{Nd}.．]*+" + blank + "[%％]?)" + blank + "(?:[,，]|$)"
    return text.rlike(packing_signs()) | (text.rlike("[,，]") & text.rlike(item))


STATS = T.StructType([
    T.StructField("source", T.StringType()),
    T.StructField("field", T.StringType()),
    T.StructField("delimiter", T.StringType()),
    T.StructField("cuts", T.LongType()),
    T.StructField("regular", T.LongType()),
    T.StructField("agreeing", T.LongType()),
])

#: A separator is a delimiter of a source from this score on.
LEAST_SCORE = 0.2

#: Weight, in values, of all sources together in the score of one.
PRIOR = 8.0


def delimiter_statistics(df: DataFrame, columns: list[str], source: str) -> DataFrame:
    """How often each separator cuts values of each source, into regular pieces,
    and into as many as the parallel field has.  Counted over all rows; the
    batches are aggregated before the shuffle."""
    candidates = df.where(any_packed(columns)).select(F.col(f"`{source}`").cast("string").alias("source"), *(F.col(f"`{c}`") for c in columns))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums: dict[tuple, list[int]] = {}
            sources, *texts = (c.to_pylist() for c in batch.columns)
            for row, name in enumerate(sources):
                cuts = [cut(t[row]) if t[row] else None for t in texts]
                good = [len(c.pieces) if c and is_list(c) else 0 for c in cuts]
                for i, parts in enumerate(cuts):
                    if not parts or len(parts.pieces) < 2:
                        continue
                    agrees = any(n == len(parts.pieces) for j, n in enumerate(good) if j != i)
                    strong = not STRONG.isdisjoint(map(piece_type, parts.pieces))
                    for s in set(parts.separators):
                        if s in WEAK and not strong and not agrees:  # running text says nothing of a list's separator
                            continue
                        entry = sums.setdefault((name, columns[i], s), [0, 0, 0])
                        entry[0] += 1
                        entry[1] += good[i] > 0 or agrees and is_list(parts, len(parts.pieces))
                        entry[2] += agrees
            if sums:
                rows = [(*k, *v) for k, v in sums.items()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), [pa.string()] * 3 + [pa.int64()] * 3)], names=STATS.names)

    counted = candidates.mapInArrow(count, STATS)
    return counted.groupBy("source", "field", "delimiter").agg(*(F.sum(c).alias(c) for c in ("cuts", "regular", "agreeing")))


def any_packed(columns: list[str]) -> Column:
    """Whether any of a row's columns may be packed."""
    test = F.lit(False)
    for c in columns:
        test = test | may_be_packed(F.col(f"`{c}`"))
    return test


def infer_delimiters(df: DataFrame, columns: list[str], source: str) -> DataFrame:
    """(source, field, delimiter, score, accepted) for every separator that occurs.

    The score is the share of regular cuts, raised by agreement with the
    parallel field; sources with few values lean on all sources together.
    """
    stats = delimiter_statistics(df, columns, source)
    everywhere = stats.groupBy("field", "delimiter").agg(
        (F.sum("regular") / F.sum("cuts")).alias("all_regular"), (F.sum("agreeing") / F.sum("cuts")).alias("all_agreeing")
    )
    regular = (F.col("regular") + PRIOR * F.col("all_regular")) / (F.col("cuts") + PRIOR)
    agreeing = (F.col("agreeing") + PRIOR * F.col("all_agreeing")) / (F.col("cuts") + PRIOR)
    scored = stats.join(everywhere, ["field", "delimiter"]).withColumn("score", F.lit(0.5) * regular + F.lit(0.5) * F.least(regular, agreeing))
    return scored.select("source", "field", "delimiter", "score", (F.col("score") >= LEAST_SCORE).alias("accepted"))


def split_packed(df: DataFrame, key: str, columns: list[str], source: str) -> DataFrame:
    """One row per single value of every packed field: (key, ``field``,
    ``position`` from 1, ``value``).

    Null and empty fields and single values give no rows; an empty value of a
    list keeps its place; a separator inside quotes does not split; a repeated
    row gives its rows again; a null source is a source of its own.  Fields are
    decided one by one, but equal piece counts of two fields count as evidence.
    """
    inferred = checkpointed(infer_delimiters(df, columns, source))
    per_source = inferred.groupBy("source").agg(F.collect_set(F.struct("field", "delimiter", "accepted")).alias("__delimiters"))
    # Bounded: one row for each field and sign that may separate.  A source that
    # says nothing of a separator follows the others.
    common = [
        (r["field"], r["delimiter"])
        for r in inferred.groupBy("field", "delimiter").agg(F.avg(F.col("accepted").cast("int")).alias("share")).where("share > 0.5").collect()
    ]
    rows = df.where(any_packed(columns)).select(
        F.col(f"`{key}`"), F.col(f"`{source}`").cast("string").alias("__source"), *(F.col(f"`{c}`").alias(f"__{i}") for i, c in enumerate(columns))
    )
    joined = rows.join(per_source, F.col("__source").eqNullSafe(F.col("source")), "left").select(key, *(f"__{i}" for i in range(len(columns))), "__delimiters")
    schema = T.StructType([
        T.StructField(key, df.schema[key].dataType), T.StructField("field", T.StringType()),
        T.StructField("position", T.IntegerType()), T.StructField("value", T.StringType()),
    ])

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(0)
            texts = [batch.column(i + 1).to_pylist() for i in range(len(columns))]
            sets: dict[int, list[frozenset[str]]] = {}
            took, fields, positions, values = [], [], [], []
            known: dict[tuple, list[frozenset[str]]] = {}
            for row, found in enumerate(batch.column(len(columns) + 1).to_pylist()):
                pairs = tuple(sorted((d["field"], d["delimiter"], d["accepted"]) for d in found or ()))
                sets = known.get(pairs)
                if sets is None:
                    seen = {(f, d) for f, d, _ in pairs}
                    pairs_here = [(f, d) for f, d, accepted in pairs if accepted] + [p for p in common if p not in seen]
                    sets = known[pairs] = [frozenset(d for f, d in pairs_here if f == c) for c in columns]
                first = [split_value(t[row], s) for t, s in zip(texts, sets)]
                for i, c in enumerate(columns):
                    pieces = first[i]
                    if pieces is None:
                        others = [len(p) for j, p in enumerate(first) if p and j != i]
                        pieces = split_value(texts[i][row], sets[i], max(others)) if others else None
                    for position, value in enumerate(pieces or (), 1):
                        took.append(row)
                        fields.append(c)
                        positions.append(position)
                        values.append(value)
            if took:
                yield pa.RecordBatch.from_arrays(
                    [keys.take(pa.array(took)), pa.array(fields, pa.string()), pa.array(positions, pa.int32()), pa.array(values, pa.string())], names=schema.names
                )

    return joined.mapInArrow(split, schema)
