"""Problem 2: texts cut off by field limits or in transfer.

A stack automaton reads each text once.  It holds what is open: quotes, brackets,
markup, and the sentence, which the first word of a clause opens and a
terminator closes; at the end it also tells whether a character, an escape or a
placeholder stopped half way.  What is left on the stack is the reason for which
a text counts as cut:

- ``character``, ``token``: the text ends inside one;
- ``quote``, ``bracket``, ``markup``: open at the end, and closed in the text that
  it renders (markup only where the sentence is not closed either: a marker that
  lost its partner says nothing of the end);
- ``pause``: it ends on a comma and what it renders does not;
- ``clause``, ``terminator``: what it renders is a complete sentence, and no
  terminator came: a verb form that closes a Korean sentence, or a word with which
  the corpus itself closes different texts.  A clause that is begun and not
  ended counts whatever the source; a text without one, or in note form, where
  its source closes most of its other sentences (its baseline), or where it is
  far too short for what it renders.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomline.functions.lineage import checkpointed

#: Brackets and directed quotes.
PAIRS = dict(zip("([{（［｛「『【《〈“‘", ")]}）］｝」』】》〉”’"))
OPENERS = {closer: opener for opener, closer in PAIRS.items()}
QUOTES = frozenset("「『“‘\"'")

#: Full-width brackets, which may render the narrow ones.
NARROW = dict(zip("（［｛", "([{"))

#: Names of markup that has a closing form.
CONTAINERS = frozenset("start b i u s a em strong span div font color size link h1 h2 h3 h4 h5 h6 ul ol table".split())

#: Verb endings that close a Korean sentence (a written-out form
#: keeps two syllables, so that a word cut after its first one does not match).
FINAL_ENDINGS = (
    "니다", "니까", "시오", "세요", "어요", "아요", "해요", "여요", "워요", "려요", "게요", "네요", "데요", "군요", "까요", "지요", "예요", "에요", "돼요",
    "한다", "는다", "된다", "이다", "었다", "았다", "했다", "됐다", "겠다", "있다", "없다", "하다", "였다", "졌다", "렸다", "났다", "왔다", "갔다", "린다", "킨다",
    "는가", "인가", "을까", "할까", "됨", "했음", "있음", "없음", "였음", "하라", "해라", "하자", "하죠", "이죠", "구나", "군",
)

#: Signs that may follow the last word of a finished text.
TAIL_SIGNS = " \t\r\n\x0b\x0c\xa0\u3000.!?。！？…~\"'”’」』】》〉)]}）］"

#: Names of characters in entities.
ENTITIES = ("amp", "lt", "gt", "quot", "apos", "nbsp")

_PREFIXES = "|".join(sorted({e[:n] for e in ENTITIES for n in range(1, len(e) + 1)}, reverse=True))

#: What an escape, entity, tag or placeholder looks like when it is cut.
CUT_TOKEN = re.compile(rf"(?:\\(?:u[0-9A-Fa-f]{{0,3}}|x[0-9A-Fa-f]?)?|&(?:#x?[0-9A-Fa-f]*|{_PREFIXES})?|<(?:/?[A-Za-z]\w*|/)?|\$(?:\{{\w*)?|\{{\w*|%)$")
_CUT_STARTS = frozenset("\\&<${%")

#: Signs of the automaton, and words between them.
_READ = re.compile(
    r"(?P<tag><(?P<close>/?)(?P<name>[A-Za-z][\w-]*)(?:[ =][^<>]*)?(?P<void>/?)>)|(?P<stop>(?:[!?。！？…]|\.(?!\d)|(?<!\d)\.)+)|(?P<pause>[,，、])"
    r"|(?P<sign>[()\[\]{}（）［］｛｝「」『』【】《》〈〉“”‘’\"'])|(?P<word>[^\s()\[\]{}（）［］｛｝「」『』【】《》〈〉“”‘’\"'.!?。！？…,，、~<]+)|(?P<lone>[.<~])"
)

#: Smallest share of all distinct texts that end with a word, for it to be a closing word.
CLOSING_SHARE = 0.003

#: A closing word ends so many distinct texts at least, behind so many different
#: words: a fragment that recurs with the copies of its text does not.
CLOSED_TEXTS, CLOSED_WORDS = 5, 3

#: Share of finished sentences, begun clauses aside, from which a source's weak missing ends count.
LEAST_BASELINE = 0.5

#: Fewest letters of a Korean sentence for each letter of the Chinese one.
LEAST_LENGTH = 0.8

#: Particles and connective endings of a clause that is begun, and stops.
CLAUSE_ENDINGS = ("을", "를", "이", "가", "은", "는", "에", "에게", "에서", "께서", "으로", "면", "며", "지만")

#: Characters without a look, besides conjoining ones.
IGNORED = dict.fromkeys([0xAD, *range(0x200B, 0x2010), 0x2060, 0xFEFF])


def is_korean(text: str) -> bool:
    return any("가" <= c <= "힣" or "ᄀ" <= c <= "ᇿ" for c in text)


@dataclass
class Reading:
    """What the automaton holds after the last character of a text."""

    stack: list[str] = field(default_factory=list)  # openers and names of markup, the innermost last
    word: str = ""  # the last word of the last sentence, notes behind its end aside
    clause: bool = False  # a clause was begun in the last sentence that holds Hangul
    paused: bool = False  # nothing but a comma followed the last word

    def open_signs(self) -> list[str]:
        """Open brackets and quotes, wide ones as narrow ones."""
        return [NARROW.get(s, s) for s in self.stack if s not in CONTAINERS]


def read(text: str) -> Reading:
    """Runs the automaton over a whole text, in one pass."""
    if not text.isascii():
        text = unicodedata.normalize("NFC", text).translate(IGNORED)
    now = Reading()
    stack = now.stack
    notes: list[tuple[int, str, bool]] = []  # a bracket opened behind an end: its depth, and the word and clause before it
    stopped = False  # a terminator sign followed the last word
    begun, korean, end, glued = False, False, -1, False
    for match in _READ.finditer(text):
        kind = match.lastgroup
        if match.group("tag"):
            name = match.group("name").lower()
            if match.group("void"):
                pass
            elif match.group("close") or name == "end":
                wanted = "start" if name == "end" else name
                if wanted in stack:
                    del stack[len(stack) - 1 - stack[::-1].index(wanted) :]
            elif name in CONTAINERS:
                stack.append(name)
            glued, end = match.start() == end, match.end()
            continue
        if kind == "word":
            word = match.group()
            whole = now.word + word if glued and match.start() == end and not stopped else word
            if stopped and not notes:  # a new sentence
                begun, korean = False, False
            stopped = now.paused = False
            now.word = whole
            if is_korean(whole):
                if not korean:
                    begun = False
                korean = True
                begun = begun or (len(whole) > 1 and whole.endswith(CLAUSE_ENDINGS))
                now.clause = begun
            end, glued = match.end(), True
            continue
        if kind == "stop":
            if now.word:
                stopped = True
            now.paused = False
        elif kind == "pause":
            now.paused = True
            if korean:
                begun = now.clause = True
        elif kind == "sign":
            sign = match.group()
            before, behind = text[match.start() - 1 : match.start()], text[match.end() : match.end() + 1]
            if sign in PAIRS:
                if not (sign in "(（" and before and before in ":;："):  # no face
                    if stopped:
                        notes.append((len(stack), now.word, now.clause))
                    stack.append(sign)
            elif sign in OPENERS:
                if OPENERS[sign] in stack:
                    del stack[len(stack) - 1 - stack[::-1].index(OPENERS[sign]) :]
            elif sign in stack:
                if sign == '"' or not behind.isalpha():
                    del stack[len(stack) - 1 - stack[::-1].index(sign) :]
            elif not before.isalnum() and behind and not behind.isspace() and (sign == '"' or not behind.isascii()) and (match.start() == 0 or before not in TAIL_SIGNS.strip() or behind.isalnum()):
                stack.append(sign)
            while notes and len(stack) <= notes[-1][0]:  # the note is closed: the sentence ended before it
                _, now.word, now.clause = notes.pop()
                stopped, now.paused = True, False
        end, glued = match.end(), False
    return now


def open_at_end(text: str) -> list[str]:
    """What the stack automaton still holds after the last character, the sentence aside."""
    return read(text).stack


def last_token(text: str) -> str:
    """The token that a text ends inside of, from its first sign on; empty where there is none."""
    text = text.rstrip()
    at = len(text)
    while at and (text[at - 1].isalnum() or text[at - 1] in "_#/"):  # back over one word
        at -= 1
    while at and text[at - 1] in _CUT_STARTS:
        at -= 1
    found = CUT_TOKEN.search(text, at)
    if not found:
        return ""
    sign, before = found.group(), text[: found.start()][-1:]
    if sign in "%$" and text[: found.start()].rstrip()[-1:].isdigit() or sign == "\\" and before == "\\" or sign[0] == "&" and "#" not in sign and before.isalnum():
        return ""
    return sign


def cut_inside(text: str) -> str:
    """``character`` or ``token`` where a text ends inside one; else empty."""
    text = text.rstrip()
    if not text:
        return ""
    last = text.rstrip("….")[-1:]
    if last == "\ufffd" or text[-1] == "\ufffd" or 0x1100 <= ord(text[-1]) <= 0x115F or 0xD800 <= ord(text[-1]) <= 0xDFFF:
        return "character"
    return "token" if last_token(text) else ""


@dataclass(frozen=True)
class Judge:
    """Decides single texts, given the corpus's closing words."""

    closing: frozenset[str]

    def closed(self, state: Reading) -> bool:
        """Whether the last sentence has come to its end."""
        return not state.paused and (state.word.endswith(FINAL_ENDINGS) or state.word in self.closing)

    def finished(self, text: str) -> bool:
        """Whether the last sentence of a text has come to its end."""
        return self.closed(read(text))

    def closes(self, text: str) -> bool | None:
        """``finished``, or None for a clause that breaks off: it says nothing of how its source ends sentences."""
        state = read(text)
        return True if self.closed(state) else None if begun(state) else False

    def reason(self, text: str | None, sentence: bool, baseline: float = 1.0, rendered: str | None = None) -> str | None:
        """Why a text counts as cut, or None.

        ``sentence``: what it renders is a complete sentence.  ``rendered``:
        that text itself, for what it leaves open as well.  Nothing and blanks
        are never cut.
        """
        if not text or not text.strip():
            return None
        rendered = rendered or ""
        inside = cut_inside(text)
        if inside and not (inside == cut_inside(rendered) and last_token(rendered) == last_token(text)):
            return inside
        state = read(text)
        done = self.closed(state)
        if state.stack:
            other = read(rendered) if rendered else Reading()
            left, theirs = state.open_signs(), other.open_signs()
            for sign in theirs:
                if sign in left:
                    left.remove(sign)
            if left:
                return "quote" if left[-1] in QUOTES else "bracket"
            if not done and any(s in CONTAINERS for s in state.stack) and not any(s in CONTAINERS for s in other.stack):
                return "markup"
        if state.paused and (sentence or not read(rendered).paused):
            return "pause"
        if done or not sentence or not is_korean(text):
            return None
        if begun(state):
            return "clause"
        return "terminator" if baseline >= LEAST_BASELINE else None

    def cut_off(self, text: str | None, sentence: bool, baseline: float = 1.0, rendered: str | None = None) -> bool:
        """Whether a text stops early."""
        return self.reason(text, sentence, baseline, rendered) is not None


def begun(state: Reading) -> bool:
    """Whether the last sentence holds a part of a clause and is no note.

    Notes end on a verb made a noun (a last syllable with a final m, 기 or 것).
    """
    last = state.word
    if last == "것" or len(last) > 1 and not state.paused and ("가" <= last[-1] <= "힣" and (ord(last[-1]) - 0xAC00) % 28 == 16 or last[-1] in "기것"):
        return False
    return state.clause


#: Signs that stand between the values of a list, not inside a sentence (Java syntax).
_BEFORE, _BEHIND = r",，|;；\"\[\{", r",，|;；\"\]\}"

#: Running text without a stop: a clause, a comma or blank, and a tail that ends on Chinese characters.
#: Both start where a run of text does, so they take linear time.
_TWO_CLAUSES = (
    rf"(?:^|(?<=[{_BEFORE}]))[^{_BEFORE}一-鿿]*+[一-鿿][^{_BEFORE}]{{3,}}+[,，][^{_BEHIND}]*+(?<=[一-鿿]{{4}})$",
    rf"(?:^|(?<=[{_BEFORE}\]\}}]))[^{_BEFORE}\]\}}一-鿿]*+[一-鿿][^{_BEFORE}\]\}}]{{3}}[^{_BEFORE}\]\}}\s]*+\s[^{_BEHIND}\[\{{]*+(?<=[一-鿿]{{4}})$",
)


def renders_sentence(source: Column) -> Column:
    """Whether a Chinese text is a sentence, not a name or a heading.

    Sentences end with a stop; where formatting took the stop away, running
    text still has several clauses and no code or noun of a heading at its end.
    """
    signs = r"[\s\"'”’」』】》〉)\]}）］]"
    text = F.regexp_replace(F.coalesce(source, F.lit("")), f"(?<!{signs}){signs}+$", "")
    stopped = text.rlike(r"[。！？!?…]$|[^.\d]\.$|\.{2,}$")
    heading = text.rlike(r"的(?:条件|方法|顺序|步骤|原因|方式|时间|规则|说明|奖励)$")
    several = text.rlike(_TWO_CLAUSES[0]) | text.rlike(_TWO_CLAUSES[1])
    return stopped | (text.rlike("[一-鿿]{4}$") & ~heading & several)


def closing_words(df: DataFrame, text: str) -> list[str]:
    """Words that close texts and hardly stand elsewhere, over all distinct texts.

    Texts are the same if they differ in signs and blanks only.  Each word closes
    at least CLOSING_SHARE of the texts, so there are at most 1 / CLOSING_SHARE
    of them, and at least CLOSED_TEXTS behind CLOSED_WORDS different words.
    """
    value = F.col(f"`{text}`")
    bare = F.when(F.contains(value, F.lit("<")), F.regexp_replace(value, r"</?\w+>", " ")).otherwise(value)
    words = F.filter(F.split(bare, r"[\s.!?,。，！？…~\"'”’」』】》〉)\]}）］]+"), lambda w: w != "")
    forms = df.where(value.rlike("[가-힣]")).select(F.array_join(words, " ").alias("form")).where("form <> ''")
    forms = forms.groupBy(F.md5(F.translate("form", " ", "")).alias("text")).agg(F.min("form").alias("form"))
    marked = forms.select(F.split("form", " ").alias("w"))
    each = marked.select(F.posexplode("w").alias("at", "word"), (F.size("w") - 1).alias("last"), F.when(F.size("w") > 1, F.element_at("w", -2)).otherwise("").alias("before"))
    ending = F.col("at") == F.col("last")
    behind = F.size(F.collect_set(F.when(ending, F.pmod(F.xxhash64("before"), F.lit(64)))))  # 64 values at most
    ends = each.groupBy("word").agg(F.count("*").alias("n"), F.sum(ending.cast("long")).alias("ending"), behind.alias("behind"))
    ends = checkpointed(ends.where("ending > 0"))  # each text ends once, so the endings count the texts
    texts = ends.agg(F.coalesce(F.sum("ending"), F.lit(0)).alias("n")).first()["n"]
    often = (F.col("ending") >= CLOSED_TEXTS) & (F.col("behind") >= CLOSED_WORDS) & (F.col("ending") >= CLOSING_SHARE * texts)
    rows = ends.where(often & (F.col("ending") * 2 > F.col("n"))).select("word").collect()
    return sorted(r["word"] for r in rows)


#: What the automaton may find open (Java syntax); other texts need no look at what they render.
MAY_BE_OPEN = r"[(\[{（［｛「『【《〈“‘\"'<,，、]|[\uFFFD\\&$%\u1100-\u115F\uD800-\uDFFF]"


def judge_column(spark, judge: Judge, what: str):
    """Column function: ``closes(text)`` as 1, 0 or null, or ``reason(text, sentence, baseline, rendered)``; null gives 0 or null."""
    shared = spark.sparkContext.broadcast(judge)

    if what == "closes":

        @F.pandas_udf("double")
        def closes(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for texts in batches:
                yield pd.Series([shared.value.closes(t) if t else False for t in texts], dtype="float64")

        return closes

    @F.pandas_udf("string")
    def reason(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for texts, sentences, baselines, rendered in batches:
            decide = shared.value.reason
            yield pd.Series([decide(t, bool(s), b, r) for t, s, b, r in zip(texts, sentences, baselines, rendered)], dtype=object)

    return reason


def find_cut_off(df: DataFrame, text: str, rendered: str, source: str) -> DataFrame:
    """The table with ``__sentence``, ``__baseline``, ``cut_off`` and ``cut_reason``.

    ``rendered`` is the text that ``text`` renders, ``source`` what the baseline
    is taken of: the share of finished texts among those that render a sentence
    and do not break off inside a clause (a null source is a source of its own;
    one with few texts leans on all).  It is 1 for texts that are far too short.
    Null, empty and blank texts are never cut off; repeated rows count each.
    ``cut_reason`` names what was left open (see the module), null where nothing was.
    """
    spark = df.sparkSession
    judge = Judge(frozenset(closing_words(df, text)))
    closes = judge_column(spark, judge, "closes")
    value, other = F.col(f"`{text}`"), F.col(f"`{rendered}`")
    sentence = renders_sentence(other)
    told = df.where(value.rlike(r"\S") & sentence).select(F.col(f"`{source}`").alias("source"), closes(value).alias("done"))
    sums = checkpointed(told.groupBy("source").agg(F.coalesce(F.sum("done"), F.lit(0.0)).alias("done"), F.count("done").alias("n")))  # a row for each source
    total = sums.agg(F.coalesce(F.try_divide(F.sum("done"), F.sum("n")), F.lit(1.0)).alias("all")).first()["all"]
    base = sums.select(F.col("source").alias("__source"), ((F.col("done") + 20 * F.lit(total)) / (F.col("n") + 20)).alias("__baseline"))
    joined = df.withColumn("__sentence", F.coalesce(sentence, F.lit(False))).join(base, F.col(f"`{source}`").eqNullSafe(F.col("__source")), "left").drop("__source")
    letters = lambda c: F.length(F.regexp_replace(F.coalesce(c, F.lit("")), r"[^\p{L}\p{N}]+", ""))
    short = F.col("__sentence") & (letters(value) < LEAST_LENGTH * letters(other))
    joined = joined.withColumn("__baseline", F.when(short, 1.0).otherwise(F.coalesce("__baseline", F.lit(total))))
    reason = judge_column(spark, judge, "reason")
    joined = joined.withColumn("cut_reason", reason(value, F.col("__sentence"), F.col("__baseline"), F.when(value.rlike(MAY_BE_OPEN), other)))
    return joined.withColumn("cut_off", F.col("cut_reason").isNotNull())


def cut_off_rates(found: DataFrame, text: str, source: str) -> DataFrame:
    """(source, texts, cut, share) from the result of find_cut_off; blank texts aside."""
    filled = found.where(F.col(f"`{text}`").rlike(r"\S"))
    sums = filled.groupBy(F.col(f"`{source}`").alias("source")).agg(F.count("*").alias("texts"), F.sum(F.col("cut_off").cast("long")).alias("cut"))
    return sums.withColumn("share", F.col("cut") / F.col("texts"))
