"""Problem 4: prompt and response pairs whose response is unfit for training.

Prompt and response are aligned token by token: shingle containment finds
responses that may repeat the prompt, the longest common subsequence decides.
The same alignment against templates of refusals, with gaps where they name
what they refuse, finds refusals.  What renders a complete sentence and stops
early is truncated (see :mod:`loomline.llm.truncation`).
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomline.functions.fold import fold_text
from loomline.llm.truncation import FINAL_ENDINGS, Judge, closing_words, is_korean, renders_sentence
from loomline.operators.packed import cut, is_list

#: Fillers that stand for a missing text, folded.
FILLERS = frozenset(
    "tbd tba todo null none nil nan na empty blank undefined unknown placeholder fixme xxx notranslation missing "
    "空 无 暂无 待定 待翻译 未翻译 缺失 없음 미정 미번역 공란 빈칸 번역필요 번역대기 추후입력 なし 未定 空白".split()
)

#: How answerers decline; a gap (_) stands for what is named.
REFUSALS = (
    "이 요청은 도와드릴 수 없어요",
    "해당 요청은 도와드릴 수 없습니다",
    "죄송하지만 이 문장은 번역해 드릴 수 없습니다",
    "죄송합니다 이 내용은 번역할 수 없습니다",
    "죄송하지만 요청하신 작업을 수행할 수 없습니다",
    "요청하신 내용은 정책상 번역할 수 없습니다",
    "정책에 따라 이 요청에는 응답할 수 없습니다",
    "번역을 거부합니다 민감한 내용이 포함되어 있습니다",
    "원문을 이해할 수 없어 번역이 불가능합니다 양해 부탁드립니다",
    "해당 _ 에 대한 번역 제공이 어렵습니다 다른 문장을 보내 주세요",
    "저는 언어 모델이라 _ 관련 내용에는 답할 수 없습니다",
    "저는 인공지능이라 _ 에 대해 답변드릴 수 없습니다",
    "I'm sorry but I can't translate this text",
    "I'm sorry but I cannot help with that request",
    "Sorry this request about _ cannot be completed",
    "Sorry I can't assist with that",
    "I am unable to translate this content",
    "I cannot fulfill this request",
    "As a language model I am unable to help with _",
    "As an AI language model I cannot provide a translation of _",
    "This content violates the usage policy and cannot be translated",
    "抱歉 我无法翻译这段关于 _ 的内容",
    "对不起 我不能翻译这段文字",
    "抱歉 我无法完成这个请求",
    "很遗憾 该请求不符合使用规范 无法作答",
    "作为一个语言模型 我无法回答关于 _ 的问题",
    "根据政策 此内容无法翻译",
    "申し訳ありませんがこの文章は翻訳できません",
    "申し訳ございませんがこのリクエストにはお応えできません",
    "言語モデルのため _ についてはお答えできません",
)

#: Words by which a prompt itself voices an apology or a refusal.
VOICED = re.compile(r"抱歉|对不起|不好意思|遗憾|无法|不能为|拒绝")

#: What a refusal talks about, and a translated apology does not.
_TASK = r"번역|요청|언어 ?모델|인공지능|정책|translat|request|language model|assist|policy|翻译|请求|语言模型|作答|翻訳|リクエスト|モデル"
ABOUT_TASK = re.compile(_TASK, re.I)

#: A refusal has one of these, or of the words about the task.
TRIGGER = _TASK + r"|도와|죄송|sorry|unable|cannot|can't|抱歉|对不起|無法|无法|できません"
_TRIGGER = re.compile(TRIGGER, re.I)

DEFECTS = ("empty", "refusal", "copied", "other_language", "truncated")


@dataclass(frozen=True)
class Alignment:
    """Thresholds of the alignments, as shares of tokens."""

    shingle: int = 3
    contained: float = 0.7  # of the prompt's shingles
    prompt_share: float = 0.85  # of the prompt in common with the response
    response_share: float = 0.5  # of the response in common with the prompt
    template_share: float = 0.8  # of a refusal's template
    excess: float = 2.0  # length of the passage that refuses, in templates, gaps aside


def tokens(text: str) -> list[str]:
    """Words of letters and digits; of scripts without blanks, single characters."""
    out: list[str] = []
    word = ""
    for char in unicodedata.normalize("NFKC", text).lower():
        if not char.isalnum():
            if word:
                out.append(word)
            word = ""
        elif "぀" <= char <= "ヿ" or "㐀" <= char <= "鿿" or "가" <= char <= "힣":
            if word:
                out.append(word)
            word = ""
            out.append(char)
        else:
            word += char
    if word:
        out.append(word)
    return out


def common_length(a: list[str], b: list[str]) -> int:
    """Length of the longest common subsequence (bit-parallel)."""
    if not a or not b:
        return 0
    masks: dict[str, int] = {}
    for i, token in enumerate(a):
        masks[token] = masks.get(token, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for token in b:
        match = masks.get(token, 0)
        both = row & match
        row = ((row + both) | (row - both)) & full
    return len(a) - bin(row).count("1")


class Examiner:
    """Finds the defect of single pairs."""

    def __init__(self, judge: Judge, alignment: Alignment = Alignment()):
        self.judge = judge
        self.alignment = alignment
        self.templates = [tokens(t.replace("_", " ")) for t in REFUSALS]
        self.by_token: dict[str, list[int]] = {}
        for i, template in enumerate(self.templates):
            for token in set(template):
                self.by_token.setdefault(token, []).append(i)

    def defect(self, prompt: str | None, answer: str | None, sentence: bool) -> str | None:
        """The kind of defect of a pair, or None."""
        kind = self.kind(prompt or "", answer or "", sentence)
        if kind is None:
            return None
        first, second = cut(prompt or ""), cut(answer or "")
        if is_list(first) or is_list(second):
            return None
        return kind

    def kind(self, prompt: str, answer: str, sentence: bool) -> str | None:
        if self.is_empty(prompt, answer):
            return "empty"
        if self.is_refusal(prompt, answer):
            return "refusal"
        has_han = any("一" <= c <= "鿿" or "⼀" <= c <= "⿟" or "豈" <= c <= "﫿" for c in answer)
        if has_han and self.is_copy(prompt, answer):
            return "copied"
        if not is_korean(answer):
            return "other_language" if self.is_foreign(prompt, answer) else None
        return "truncated" if self.judge.cut_off(answer, sentence, rendered=prompt) else None

    def is_empty(self, prompt: str, answer: str) -> bool:
        """Nothing, blanks and signs, or a filler that the prompt does not hold."""
        folded = fold_text(answer)
        if not folded:
            return True
        return folded in FILLERS and fold_text(prompt) != folded

    def is_foreign(self, prompt: str, answer: str) -> bool:
        """A text without Hangul that is more than codes taken over from the prompt."""
        own = [t for t in tokens(answer) if any(c.isalpha() for c in t)]
        taken = set(tokens(prompt))
        return any(t not in taken for t in own) or any("㐀" <= c <= "鿿" or "぀" <= c <= "ヿ" for t in own for c in t)

    def is_copy(self, prompt: str, answer: str) -> bool:
        a, b = tokens(prompt), tokens(answer)
        k = min(self.alignment.shingle, len(a))
        if not a or len(b) < k:
            return False
        shingles = {tuple(a[i : i + k]) for i in range(len(a) - k + 1)}
        held = {tuple(b[i : i + k]) for i in range(len(b) - k + 1)}
        if len(shingles & held) < self.alignment.contained * len(shingles):
            return False
        common = common_length(a, b)
        return common >= self.alignment.prompt_share * len(a) and common >= self.alignment.response_share * len(b)

    def is_refusal(self, prompt: str, answer: str) -> bool:
        if not _TRIGGER.search(answer):
            return False
        if VOICED.search(prompt) and not (ABOUT_TASK.search(answer) and not ABOUT_TASK.search(prompt)):
            return False
        own = tokens(answer)
        held = set(own)
        hits: dict[int, int] = {}
        for token in held:
            for i in self.by_token.get(token, ()):
                hits[i] = hits.get(i, 0) + 1
        enough = self.alignment.template_share
        return any(n >= enough * len(set(self.templates[i])) and self.holds(own, self.templates[i]) for i, n in hits.items())

    def holds(self, own: list[str], template: list[str]) -> bool:
        """Local alignment: whether some passage of an answer, of any length, follows a template.

        Passages overlap by three quarters of a passage; one holds whole answers up to its size.
        """
        size = int(self.alignment.excess * len(template)) + 8
        enough = self.alignment.template_share * len(template)
        wanted = set(template)
        inside = [0, *accumulate(t in wanted for t in own)]
        for begin in range(0, max(1, len(own) - size + size // 4), size // 4):
            end = min(len(own), begin + size)
            if inside[end] - inside[begin] >= enough and common_length(template, own[begin:end]) >= enough:
                return True
        return False


#: Characters of the JVM's filter (Java syntax): those of a word, blanks, and parts that fold to Hangul syllables.
_WORD, _BLANK = r"\p{L}\p{N}_", r"\s\p{Z}\x1c-\x1f\x85"
_HANGUL_PARTS = r"\u1100-\u11FF\u3131-\u318E\u3200-\u321E\u3260-\u327E\uA960-\uA97C\uD7B0-\uD7FB\uFFA0-\uFFDC"

#: A filler in Hangul with any signs around and inside.
_FILLER = "^(?:" + "|".join("".join(rf"[^\p{{L}}\p{{N}}]*+{c}" for c in f) for f in sorted(FILLERS) if is_korean(f)) + r")[^\p{L}\p{N}]*+$"

#: A tail that may be a cut token, a broken character or a comma (see truncation).
_OPEN_END = (
    rf"(?:\\(?:u[0-9A-Fa-f]{{0,3}}|x[0-9A-Fa-f]?)?|&#?[{_WORD}]*+|<[/{_WORD}]*+|\$\{{?[{_WORD}]*+|\{{[{_WORD}]*+|%)[{_BLANK}]*$"
    rf"|\uFFFD[{_BLANK}.…]*$|[,，、][^가-힣{_WORD}]*$"
)

#: Signs that the automaton may leave open.
_OPENERS = r"[(\[{（［｛「『【《〈“‘\"'<]"


def may_be_defective(answer: Column, sentence: Column) -> Column:
    """A test in the JVM that holds for every pair that has a defect.

    Left out are Korean answers without Chinese characters, words of a refusal
    and signs that may be open, and that are no fillers, that close their last
    sentence, or render no sentence and do not end inside a token.
    """
    text = F.coalesce(answer, F.lit(""))
    other = r"[\u2E80-\u2FDF\u3400-\u4DBF\u4E00-\u9FFF\uF900-\uFAFF" + _HANGUL_PARTS + "]|(?i:" + TRIGGER + ")"
    plain = text.rlike("[가-힣]") & ~text.rlike(other) & ~text.rlike(_FILLER)
    closed = text.rlike("(?:" + "|".join(FINAL_ENDINGS) + r")[\s.!?。！？…~\"'”’」』】》〉)\]}）］]*$")
    plain = plain & ~text.rlike(_OPENERS) & ~text.rlike(_OPEN_END)
    return ~(plain & (closed | ~sentence))


def find_defects(df: DataFrame, key: str, prompt: str, answer: str, alignment: Alignment = Alignment()) -> DataFrame:
    """(key, ``defect``) of every pair with an unfit answer, one defect at most.

    Null counts as empty on both sides; fields that pack several values are no
    cases; a repeated row is reported again; an empty table gives no rows.  One
    narrow pass after one count of the words that close answers.
    """
    spark = df.sparkSession
    shared = spark.sparkContext.broadcast((Judge(frozenset(closing_words(df, answer))), alignment))
    schema = T.StructType([T.StructField(key, df.schema[key].dataType), T.StructField("defect", T.StringType())])

    def examine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        examiner = Examiner(*shared.value)
        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns[1:]]
            found = [(i, d) for i, row in enumerate(zip(*columns)) if (d := examiner.defect(row[0], row[1], bool(row[2])))]
            if found:
                rows, kinds = zip(*found)
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows)), pa.array(kinds, pa.string())], names=schema.names)

    sentence = F.coalesce(renders_sentence(F.col(f"`{prompt}`")), F.lit(False))
    rows = df.select(F.col(f"`{key}`"), F.col(f"`{prompt}`").alias("__prompt"), F.col(f"`{answer}`").alias("__answer"), sentence.alias("__sentence"))
    rows = rows.where(may_be_defective(F.col("__answer"), F.col("__sentence")))
    return rows.mapInArrow(examine, schema)
