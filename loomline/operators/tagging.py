"""Rule taggers and hashed vectors: providers that need no model.

They give the columns that taggers, frequency tables and encoders give, from
endings, scripts and the corpus's own counts; a model's columns go in their
place through :mod:`loomline.operators.providers`.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomline.functions import lexicons as L
from loomline.functions.text import BLANK, ends_with_any, filled

# Token classes, endings of verbs and particles.
SOURCE_TOKEN = r"[\x{4E00}-\x{9FFF}]+|[A-Za-z]+|[0-9]+"
SOURCE_VERB = r"[了着过吗呢吧把被使让]$|^(?:请|可以|不能|是否)"
TARGET_VERB = r"(?:다|요|까|오|며|면|고|지만)$"
TARGET_PARTICLE = r"[\x{AC00}-\x{D7A3}](?:을|를|이|가|은|는|의|에|에서|으로)$"

#: Words that a summary names.
SUMMARY_WORDS = 10


def source_words(text: Column, suffixes: Sequence[str] = L.NOUN_SUFFIXES) -> Column:
    """array<struct<word,flag,upos,deprel>> of a source text; the last word is the root."""
    words = F.regexp_extract_all(filled(text), F.lit(SOURCE_TOKEN), F.lit(0))

    def tagged(word: Column, i: Column) -> Column:
        letters, digits = word.rlike("^[A-Za-z]"), word.rlike("^[0-9]")
        verb = word.rlike(SOURCE_VERB) & ~ends_with_any(word, suffixes)
        return F.struct(
            word.alias("word"), F.when(letters, "eng").when(digits, "m").when(verb, "v").otherwise("n").alias("flag"),
            F.when(letters, "X").when(digits, "NUM").when(verb, "VERB").otherwise("NOUN").alias("upos"),
            F.when(i == F.size(words) - 1, "root").otherwise("dep").alias("deprel"),
        )

    return F.transform(words, tagged)


def target_words(text: Column) -> Column:
    """array<struct<form,tag,upos>> of a target text; a particle is a word of its own."""
    words = F.filter(F.split(filled(text), f"{BLANK}+"), lambda w: w != "")

    def tagged(word: Column) -> Column:
        noun = F.when(word.rlike("^[A-Za-z]+$"), "SL").when(word.rlike("^[0-9]+$"), "SN").when(word.rlike(TARGET_VERB), "EF").otherwise("NNG")
        upos = F.when(word.rlike("^[A-Za-z]+$"), "X").when(word.rlike("^[0-9]+$"), "NUM").when(word.rlike(TARGET_VERB), "VERB").otherwise("NOUN")
        own = F.struct(word.alias("form"), noun.alias("tag"), upos.alias("upos"))
        part = F.struct(F.lit("").alias("form"), F.lit("JX").alias("tag"), F.lit("ADP").alias("upos"))
        return F.when(word.rlike(TARGET_PARTICLE) & ~word.rlike(TARGET_VERB), F.array(own, part)).otherwise(F.array(own))

    return F.flatten(F.transform(words, tagged))


def summary(words: Column) -> Column:
    """``word/upos/deprel`` of the first words of a tagged source text."""
    return F.array_join(F.transform(F.slice(words, 1, SUMMARY_WORDS), lambda w: F.concat_ws("/", w["word"], w["upos"], w["deprel"])), " ")


def root_of(words: Column) -> Column:
    """Part of speech of the root; empty without one."""
    return F.coalesce(F.get(F.filter(words, lambda w: w["deprel"] == "root"), F.lit(0))["upos"], F.lit(""))


def hashed_vector(text: Column, size: int = 64) -> Column:
    """Unit vector of a text's characters, hashed by code point; the empty text counts as a mark of its own."""
    filled_text = F.when(filled(text) == "", "[EMPTY]").otherwise(filled(text))
    places = F.transform(F.filter(F.split(filled_text, ""), lambda c: c != ""), lambda c: F.pmod(F.ascii(c), F.lit(size)))
    # An array of one binds a value to a name, so that nothing is computed for each place again.
    counts = F.transform(F.array(places), lambda ps: F.transform(F.sequence(F.lit(0), F.lit(size - 1)), lambda i: F.size(F.filter(ps, lambda p: p == i)).cast("double")))
    lengths = F.transform(counts, lambda k: F.struct(k.alias("k"), F.greatest(F.sqrt(F.aggregate(k, F.lit(0.0), lambda s, x: s + x * x)), F.lit(1e-9)).alias("n")))
    return F.get(F.transform(lengths, lambda x: F.transform(x["k"], lambda v: v / x["n"])), F.lit(0))


def frequency_table(counts: DataFrame, word: str, count: str, total: DataFrame) -> DataFrame:
    """(word, zipf) of the words that occur: log10 of their frequency in a billion characters.

    ``total`` is a one-row table with the number of characters, ``chars``."""
    seen = counts.where(F.col(count) > 0).groupBy(F.col(word).alias("word")).agg(F.max(count).alias("n"))
    return seen.join(F.broadcast(total.select("chars"))).select("word", F.log10(F.col("n") / F.col("chars") * 1e9).alias("zipf"))


def zipf_of(df: DataFrame, column: str, table: DataFrame, name: str) -> DataFrame:
    """The table with a word frequency of a column; -1 for a word that is not in the frequency table."""
    found = table.select(F.col("word").alias("__word"), F.col("zipf").alias(name))
    return df.join(found, F.col(f"`{column}`") == F.col("__word"), "left").drop("__word").withColumn(name, F.coalesce(name, F.lit(-1.0)))
