"""Problem 6: duplicates hidden by formatting.

Every text column is brought to a canonical form (compatibility characters,
case, blanks, punctuation, order of labelled values), the forms are hashed to
128 bits, and counts are aggregated by hash with partial aggregation before the
shuffle.  A second, independent hash goes along as collision check: records that
share the first hash but not the second are kept apart.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomline.functions.fold import LOOKALIKES
from loomline.functions.lineage import checkpointed

#: A group of more than this share of the rows is joined by broadcast; there are fewer than 1 / HOT_SHARE of them.
HOT_SHARE = 0.001

#: Values of these characters need no compatibility normalisation (Java syntax).
SIMPLE = (
    r"^[\t\n\r -~À-ÿ·‐-―‘-‟…、-〃〈-】〔-〛"
    r"一-鿿가-힣！-／：-＠［-｀｛-～Ωβ]*$"
)

#: Full-width signs that matter in numbers and labelled values, and dashes.
WIDE_SIGNS, SIGNS = "：＝；｜，＋－％．／～、‐‑‒–—−", ":=;|,+-%./~,------"

#: A labelled value: a label, a colon or equals sign, a signed number.  Labels
#: start where a run of letters does or the value before ends: linear time.
LABELLED = r"(?:\G|(?<![\p{L}\p{N} ])) *+\p{L}[\p{L}\p{N} ]*+\s*[:=]\s*[+\-]?\d[\d.]*\s*%?"

#: A value with a label of any kind: one sign, a letter before it, a letter or digit behind it (each in linear time).
NAMED = (r"^[^:=]*+[:=][^:=]*+$", r"^[^:=\p{L}]*+\p{L}", r"[:=][^:=\p{L}\p{N}]*+[\p{L}\p{N}]")


def plain(text: str) -> str:
    """Compatibility form in lower case; blanks and punctuation stay."""
    text = "".join(LOOKALIKES.get(c, c) for c in unicodedata.normalize("NFKC", text)).lower()
    return "".join(c for c in unicodedata.normalize("NFKC", text) if unicodedata.category(c) not in ("Cf", "Mn") or c == "\n")


def plain_column(column: Column) -> Column:
    """``plain`` of a column; null gives null."""

    @F.pandas_udf("string")
    def apply(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for values in batches:
            yield values.map(lambda v: None if v is None else plain(v), na_action=None)

    return apply(column)


def bare(text: Column) -> Column:
    """Letters and digits, and the signs that make a number another one.

    A sign between digits stays (1.5 is not 15, 3/4 not 34, 8:00 not 800), but a
    comma between groups of three digits; so does a plus or minus before a
    number, where no letter or digit stands before it.
    """
    kept = F.regexp_replace(text, r"(?<=\d),(?=\d{3}(?!\d))", "")
    kept = F.regexp_replace(kept, r"(?<=\p{N})([.,])(?=\p{N})|(?<=\p{N})\s*([/:~\-])\s*(?=\p{N})", "\u0001$1$2")
    kept = F.regexp_replace(kept, r"(?<![\p{L}\p{N}\u0001.,/:~\-+])([+\-])(?=\p{N})", "\u0001$1")
    kept = F.regexp_replace(kept, r"(?<!\u0001)[^\p{L}\p{N}\u0001]+", "")
    return F.translate(kept, "\u0001", "")


def canonical(column: Column) -> Column:
    """Canonical form of a text; null counts as empty.

    Blanks (an escaped line break is one), punctuation and letter case go, but
    signs inside and before numbers.  A text that is nothing but labelled values
    becomes the sorted list of them, with sign, decimal point and percent sign:
    numbers with labels whatever separates them, other values with labels
    between semicolons, bars or commas.
    """
    text = F.coalesce(column, F.lit(""))
    simple = text.rlike(SIMPLE)
    text = F.coalesce(plain_column(F.when(~simple, text)), F.lower(text))
    text = F.regexp_replace(F.translate(text, WIDE_SIGNS, SIGNS), r"\\[nrt]", "\n")
    items = F.regexp_extract_all(text, F.lit(LABELLED), F.lit(0))
    listed = F.array_join(F.array_sort(F.transform(items, lambda x: F.regexp_replace(x, r"[^\p{L}\p{N}+\-%.]+", ""))), ";")
    is_list = text.rlike(r"[:=]\s*[+\-]?\d") & (F.size(items) > 1) & ~F.regexp_replace(text, LABELLED, "").rlike(r"[\p{L}\p{N}]")
    pieces = F.filter(F.when(text.rlike("[;|]"), F.split(text, "[;|]")).otherwise(F.split(text, ",")), lambda x: x.rlike(r"[\p{L}\p{N}]"))
    named = F.array_join(F.array_sort(F.transform(pieces, lambda x: F.concat_ws("=", bare(F.regexp_extract(x, "^([^:=]*)", 1)), bare(F.regexp_extract(x, "[:=](.*)$", 1))))), ";")
    is_named = text.rlike("[:=]") & (F.size(pieces) > 1) & F.forall(pieces, lambda x: x.rlike(NAMED[0]) & x.rlike(NAMED[1]) & x.rlike(NAMED[2]))
    return F.when(text.rlike("[:=]"), F.when(is_list, listed).when(is_named, named).otherwise(bare(text))).otherwise(bare(text))


def number_width(df: DataFrame, key: str) -> int:
    """Width of the ids where all are decimal numbers of one width that fits 64 bits, else 0.

    Such ids are aggregated as numbers, which hash aggregation can update in place.
    """
    if df.schema[key].dataType.simpleString() != "string":
        return 0
    value = F.col(f"`{key}`")
    shape = df.agg(F.min(F.length(value)).alias("least"), F.max(F.length(value)).alias("most"), F.bool_and(F.coalesce(value, F.lit("")).rlike("^[0-9]{1,18}$")).alias("numbers")).first()
    return shape["most"] if shape["numbers"] and shape["least"] == shape["most"] else 0


def record_keys(df: DataFrame, key: str, columns: list[str], width: int = 0) -> DataFrame:
    """(id, hash, check) of every row: a 128-bit and an independent 64-bit hash.

    With ``width`` the id is taken as a number of so many digits."""
    text = F.concat_ws("\x1f", *(canonical(F.col(f"`{c}`")) for c in columns))
    own = F.col(f"`{key}`")
    keyed = df.select((own.cast("long") if width else own).alias("id"), text.alias("text"))
    return keyed.select("id", F.unhex(F.md5("text")).alias("hash"), F.xxhash64("text").alias("check"))


def as_id(column: Column, width: int) -> Column:
    """The id of a number of ``record_keys``."""
    return F.lpad(column.cast("string"), width, "0") if width else column


def count_copies(df: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """(kept_id, copies) of every distinct record; ``copies`` counts the kept one too.

    The smallest id is kept.  Null texts equal empty ones; rows with the same id
    count each; an empty table gives no rows.  One shuffle of partial counts.
    """
    width = number_width(df, key)
    keys = record_keys(df, key, columns, width)
    groups = keys.groupBy("hash", "check").agg(F.min("id").alias("kept_id"), F.count("*").alias("copies"))
    return groups.select(as_id(F.col("kept_id"), width).alias("kept_id"), "copies")


def list_copies(df: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """(kept_id, copy_id) for every row that is a copy of a kept one.

    Groups of more than HOT_SHARE of the rows are joined by broadcast (their keys
    only, a bounded table), so a group that holds a third of all rows stays where
    it is read; all others are joined by hash.
    """
    width = number_width(df, key)
    keys = checkpointed(record_keys(df, key, columns, width))
    groups = keys.groupBy("hash", "check").agg(F.min("id").alias("kept_id"), F.count("*").alias("copies"))
    groups = checkpointed(groups.where("copies > 1"))
    least = keys.count() * HOT_SHARE
    is_hot = F.col("copies") > least
    hot = F.broadcast(groups.where(is_hot).select("hash", "check", F.col("kept_id").alias("hot_id")))
    marked = keys.join(hot, ["hash", "check"], "left")
    at_hot = marked.where("hot_id is not null").select("id", F.col("hot_id").alias("kept_id"))
    at_rest = marked.where("hot_id is null").join(groups.where(~is_hot).select("hash", "check", "kept_id"), ["hash", "check"]).select("id", "kept_id")
    both = at_hot.unionByName(at_rest).where(F.col("id") != F.col("kept_id"))
    return both.select(as_id(F.col("kept_id"), width).alias("kept_id"), as_id(F.col("id"), width).alias("copy_id"))
