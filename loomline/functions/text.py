"""Row-level text predicates and normalisers as column expressions.

All stay inside the JVM.  Scripts and patterns are parameters with the corpus's
defaults (Chinese source, Korean target); null counts as the empty text.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Blanks as Python's str.strip sees them, as a class for Java and RE2.
BLANK = r"[\t-\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


@dataclass(frozen=True)
class Scripts:
    """Character ranges of the source and the target script (regex class bodies)."""

    source: str = r"\x{4E00}-\x{9FFF}"
    target: str = r"\x{AC00}-\x{D7AF}"


#: Ranges of the cleaning stage and the wider ones of the model-cleanup stage.
CLEANING = Scripts()
MODEL_CLEANUP = Scripts(r"\x{3400}-\x{9FFF}", r"\x{AC00}-\x{D7A3}")

# Patterns of the markup that the corpus knows.
PLACEHOLDER = r"%[sd]|\{\d+\}|<[^>]+>|\$\{[^}]+\}"
PRESENTATION_TAG = r"</?c(?:\s*=\s*[^>]+)?>|<hlgreen>"
ANGLE_TAG = r"<[^>]+>"
KNOWN_TAG = r"^(?:</?c(?:\s*=\s*[^>]+)?>|<hlgreen>|<(?:key\d+|server|name|start|middle|end|code_id=[^>]+)>)$"
WRAPPERS = (
    ("brace_quote_wrapper", r'^\s*\{\s*"(.*)"\s*\}\s*$'),
    ("quote_wrapper", r'^\s*"(.*)"\s*$'),
    ("paren_wrapper", r"^\s*[（(](.*)[）)]\s*$"),
)
SENTENCE_PUNCTUATION = r"[。！？!?；;]"
TUPLE_WRAPPER = r"^\s*[\{\[].*[\}\]]\s*$"
TUPLE_LIKE = r'^\s*[\{\[].*"\s*,.*[\}\]]\s*$'
SOURCE_SENTENCE_END = r"[吗呢吧了着过啊呀哦嘛啦]$"
TARGET_SENTENCE_END = r"(?:다|요|니다|세요|습니까|까요|합니다|됩니다)[.!?。！？]?$"


def filled(text: Column) -> Column:
    """The text, or the empty one for null."""
    return F.coalesce(text, F.lit(""))


def strip(text: Column) -> Column:
    """Without blanks at both ends, all kinds of blanks.

    The look-behind keeps a long run of blanks inside a text from being tried at
    each of its characters.
    """
    return F.regexp_replace(F.regexp_replace(filled(text), f"^{BLANK}+", ""), f"(?<!{BLANK}){BLANK}+\\z", "")


def no_space(text: Column) -> Column:
    """Without any blanks."""
    return F.regexp_replace(filled(text), f"{BLANK}+", "")


def has_source(text: Column, scripts: Scripts = CLEANING) -> Column:
    """Whether any character is of the source script."""
    return filled(text).rlike(f"[{scripts.source}]")


def has_target(text: Column, scripts: Scripts = CLEANING) -> Column:
    """Whether any character is of the target script."""
    return filled(text).rlike(f"[{scripts.target}]")


def has_meaning(text: Column, scripts: Scripts = CLEANING) -> Column:
    """Whether any character is a letter of the two scripts, a Latin letter or a digit."""
    return filled(text).rlike(f"[{scripts.source}{scripts.target}A-Za-z0-9]")


def pure_source_length(text: Column, scripts: Scripts = CLEANING) -> Column:
    """Length of a text that is source script only, blanks around it aside; else 0."""
    bare = strip(text)
    return F.when(bare.rlike(f"^[{scripts.source}]+\\z"), F.length(bare)).otherwise(0)


def source_length(text: Column, scripts: Scripts = CLEANING) -> Column:
    """Number of characters of the source script."""
    return F.length(F.regexp_replace(filled(text), f"[^{scripts.source}]", ""))


def contamination(target: Column, scripts: Scripts = CLEANING) -> Column:
    """Why a target text is in the wrong language; empty where it is not."""
    text = filled(target)
    return (
        F.when(has_source(text, scripts), "ko_contains_cjk")
        .when((text != "") & ~has_target(text, scripts), "ko_without_hangul")
        .otherwise("")
    )


def is_contaminated(target: Column, scripts: Scripts = MODEL_CLEANUP) -> Column:
    """Whether a target holds source script, or is not blank and has no target script."""
    return has_source(target, scripts) | ((strip(target) != "") & ~has_target(target, scripts))


def is_fragment(source: Column, target: Column, scripts: Scripts = CLEANING) -> Column:
    """A single source character without placeholder, stop or wrapper on either side."""
    both = F.concat(filled(source), filled(target))
    return (
        (pure_source_length(source, scripts) == 1)
        & ~both.rlike(PLACEHOLDER) & ~both.rlike(SENTENCE_PUNCTUATION)
        & ~filled(source).rlike(TUPLE_WRAPPER) & ~filled(target).rlike(TUPLE_WRAPPER)
    )


def placeholder_list(text: Column, pattern: str = PLACEHOLDER) -> Column:
    """Distinct placeholders in order, joined by semicolons."""
    found = F.regexp_extract_all(filled(text), F.lit(pattern), F.lit(0))
    return F.array_join(F.array_sort(F.array_distinct(found)), ";")


def strip_tags(text: Column) -> Column:
    """Without presentation tags; a blank in a tag's place stays only between words."""
    value = F.regexp_replace(filled(text), PRESENTATION_TAG, " ")
    value = F.regexp_replace(value, r"[ \t]+", " ")
    value = F.regexp_replace(value, r" ?\\n ?", r"\\n")
    value = F.regexp_replace(value, r" (?=[,，.。!?！？;；:：）)\]}])", "")
    value = F.regexp_replace(value, r"(?<=[（(\[{]) ", "")
    value = F.regexp_replace(value, r"(?<=[\x{4E00}-\x{9FFF}]) (?=[\x{4E00}-\x{9FFF}])", "")
    return strip(value)


def tag_count(text: Column) -> Column:
    """Number of presentation tags."""
    return F.regexp_count(filled(text), F.lit(PRESENTATION_TAG))


def wrapper(text: Column) -> Column:
    """struct(name, inner) of the first wrapper that fits; null without one."""
    value, out = filled(text), None
    for name, pattern in WRAPPERS:
        found = F.struct(F.lit(name).alias("name"), strip(F.regexp_extract(value, pattern, 1)).alias("inner"))
        out = F.when(value.rlike(pattern), found) if out is None else out.when(value.rlike(pattern), found)
    return out


def unknown_tags(text: Column) -> Column:
    """Angle tags that are neither presentation nor placeholders, joined by semicolons."""
    found = F.regexp_extract_all(filled(text), F.lit(ANGLE_TAG), F.lit(0))
    return F.array_join(F.filter(found, lambda t: ~t.rlike(KNOWN_TAG)), ";")


def contains_any(text: Column, words: Sequence[str]) -> Column:
    """Whether a text contains any of a few words (a literal list)."""
    return F.exists(F.array(*map(F.lit, words)), lambda w: F.contains(filled(text), w))


def ends_with_any(text: Column, words: Sequence[str]) -> Column:
    """Whether a text ends with any of a few words."""
    return F.exists(F.array(*map(F.lit, words)), lambda w: F.endswith(filled(text), w))


def starts_with_any(text: Column, words: Sequence[str]) -> Column:
    """Whether a text begins with any of a few words."""
    return F.exists(F.array(*map(F.lit, words)), lambda w: F.startswith(filled(text), w))


def sentence_score(source: Column, target: Column, markers: Sequence[str]) -> Column:
    """How much a pair looks like a sentence, from 0 to 1."""
    both = F.concat(filled(source), F.lit("\n"), filled(target))

    def part(test: Column, value: float) -> Column:
        return F.when(test, F.lit(value)).otherwise(F.lit(0.0))

    total = (
        part(both.rlike(PLACEHOLDER), 1.0) + part(both.rlike(SENTENCE_PUNCTUATION), 0.45) + part(filled(source).rlike(SOURCE_SENTENCE_END), 0.35)
        + part(filled(target).rlike(TARGET_SENTENCE_END), 0.35) + part(contains_any(source, markers), 0.45)
    )
    return F.least(F.lit(1.0), total)


def strip_markers(text: Column) -> Column:
    """Without term markers; the marked text stays."""
    return F.regexp_replace(filled(text), r"(?d)<start>(.*?)<end>", "$1")


def preserves(text: Column, expected: Column) -> Column:
    """Whether a text contains the expected one, blanks taken as they are or left out."""
    bare = no_space(expected)
    return F.contains(filled(text), expected) | ((bare != "") & F.contains(no_space(text), bare))


def normal_reason(text: Column) -> Column:
    """A reason in lower case, blanks collapsed and stripped."""
    return F.regexp_replace(F.lower(strip(text)), f"{BLANK}+", " ")
