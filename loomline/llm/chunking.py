"""Problem 9: content-defined splitting of oversized texts.

A piece ends where a rolling hash of the text has its maximum between the
smallest and the largest piece size; that landmark snaps to the nearest natural
boundary (end of a section, paragraph, line or sentence).  Both depend on the
text near the cut only, so an edit moves the cuts beside it and no others once
the pieces fall into step again.  Sizes are tokens of the byte-level vocabulary
of :mod:`loomline.llm.bpe`; every piece is encoded again by itself to make sure
that it keeps within the limit.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomline.llm.bpe import DEFAULT_RANKS, Transducer, machine, repaired, share_ranks, text_chunks

#: Bytes that the rolling hash covers (a power of two).
HASH_BYTES = 32

SENTENCE, LINE, PARAGRAPH, SECTION = 1, 2, 3, 4

_SENTENCE_END = re.compile(r"(?:[。！？!?…]+|\.+(?=[\s\"'”’」』）)\]】]|$))[\"'”’」』）)\]】]*[ \t]*")
_LINE_END = re.compile(r"(?:\r\n|[\n\r  ])(\s*)")
_HEADING = re.compile(r"#{1,6}\s|第.{1,6}[章节節部回]|제\s*\d+\s*[장절]|Chapter\b")


def boundaries(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(positions, levels) of the natural boundaries, as code points from 0."""
    level: dict[int, int] = {}
    for m in _SENTENCE_END.finditer(text):
        if text[m.end() : m.end() + 1] not in ("\n", "\r"):  # else the line ends there
            level[m.end()] = SENTENCE
    for m in _LINE_END.finditer(text):
        rest = m.group(1)
        kind = PARAGRAPH if "\n" in rest or "\r" in rest else LINE
        if kind == PARAGRAPH and opens_section(text, m.end()) or _HEADING.match(text, m.end()):
            kind = SECTION
        level[m.end()] = max(kind, level.get(m.end(), 0))
    level.pop(0, None)
    level.pop(len(text), None)
    at = np.array(sorted(level), np.int64)
    return at, np.array([level[i] for i in at.tolist()], np.int64)


def opens_section(text: str, at: int) -> bool:
    """Whether a heading, a short line of its own, begins at ``at``."""
    end = text.find("\n", at, at + 60)
    return at < end and text[end : end + 2] == "\n\n" and text[end - 1] not in "。！？!?….,，;；:："


def rolling_hash(data: np.ndarray) -> np.ndarray:
    """64-bit hash of the HASH_BYTES bytes before each offset (shorter at the front)."""
    h = (data.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    factor, width = np.uint64(0xD6E8FEB86659FD93), 1
    with np.errstate(over="ignore"):
        while width < HASH_BYTES:
            further = np.zeros_like(h)
            further[width:] = h[:-width] * factor
            h = h + further
            factor = factor * factor
            width *= 2
        h ^= h >> np.uint64(31)
        h *= np.uint64(0x94D049BB133111EB)
    return h


def cuts(data: np.ndarray, ends: np.ndarray, limit: int, least: int, overlap: int, smaller: dict[int, int]) -> list[tuple[int, int]]:
    """Byte ranges (begin, end) of the pieces of one text.

    ``ends`` are the byte offsets of its tokens' ends.  ``smaller`` holds limits
    for pieces by where they begin; all others keep to ``limit``.
    """
    text = data.tobytes().decode("utf-8")
    whole = (data & 0xC0) != 0x80  # a character begins here
    whole = np.append(whole, True)
    char_at = np.flatnonzero(whole)
    natural, levels = boundaries(text)
    natural = char_at[natural]
    hashes = rolling_hash(data)
    on_char = whole[ends]
    usable = np.flatnonzero(on_char)  # tokens that end a character
    pieces, begin, first = [], 0, 0  # first: index of the piece's first token
    while len(ends) - first > (size := smaller.get(begin, limit)):
        floor = min(least, size)
        low, high = int(ends[first + floor - 1]), int(ends[first + size - 1])
        landmark = low + int(np.argmax(hashes[low - 1 : high])) if high > low else high
        a, b = np.searchsorted(natural, [low, high + 1])
        cut = snapped(natural[a:b], levels[a:b], landmark, (high - low) * max(1, size // 8) // max(1, size - floor))
        if cut is None:  # no natural boundary: between words, else between characters
            blanks = np.flatnonzero(data[low:high] == 0x20) + low + 1
            cut = int(blanks[np.argmin(np.abs(blanks - landmark))]) if len(blanks) else None
        if cut is None:
            i = int(np.searchsorted(ends[usable], landmark, side="right")) - 1
            cut = int(ends[usable[i]]) if i >= 0 and ends[usable[i]] >= low else None
            if cut is None:  # no token ends a character there: the last character within the limit
                cut = int(char_at[np.searchsorted(char_at, high, side="right") - 1])
        pieces.append((begin, cut))
        last = int(np.searchsorted(ends, cut, side="right"))  # tokens up to the cut
        first = nearest(usable, last - overlap)
        first = first if first < last else last
        begin = int(ends[first - 1])
    pieces.append((begin, len(data)))
    return pieces


def snapped(at: np.ndarray, levels: np.ndarray, landmark: int, reach: int) -> int | None:
    """The boundary for a landmark: the nearest within reach of the highest
    level that has one there, else the nearest of any level."""
    if not len(at):
        return None
    far = np.abs(at - landmark)
    for level in (SECTION, PARAGRAPH, LINE, SENTENCE):
        own = np.flatnonzero((levels == level) & (far <= reach))
        if len(own):
            return int(at[own[np.argmin(far[own])]])
    return int(at[np.argmin(far)])


def nearest(usable: np.ndarray, wanted: int) -> int:
    """Index of the token after the token end on a character that is nearest."""
    i = int(np.searchsorted(usable, wanted - 1))
    near = [int(usable[k]) + 1 for k in (i - 1, i) if 0 <= k < len(usable)]
    return min(near, key=lambda k: (abs(k - wanted), k)) if near else max(wanted, 1)


def split_texts(
    data: np.ndarray, rows: np.ndarray, coder: Transducer, limit: int, least: int, overlap: int
) -> list[list[tuple[int, int, int, int]]]:
    """Per text the (begin, end, tokens, overlapping bytes) of its pieces; [] where it is within the limit."""
    ids, ends = coder.encode_joined(data, rows[:-1])
    first = np.searchsorted(ends, rows, side="right")
    out: list[list[tuple[int, int, int, int]]] = [[] for _ in range(len(rows) - 1)]
    open_texts: dict[int, dict[int, int]] = {i: {} for i in np.flatnonzero(np.diff(first) > limit).tolist()}
    while open_texts:
        spans = {
            i: cuts(data[rows[i] : rows[i + 1]], ends[first[i] : first[i + 1]] - rows[i], limit, least, overlap, smaller)
            for i, smaller in open_texts.items()
        }
        flat = [(i, a, b) for i, own in spans.items() for a, b in own]
        joined = np.concatenate([data[rows[i] + a : rows[i] + b] for i, a, b in flat])
        offsets = np.concatenate([[0], np.cumsum([b - a for _, a, b in flat])])
        counted = np.diff(np.searchsorted(coder.encode_joined(joined, offsets[:-1])[1], offsets, side="right"))
        again: dict[int, dict[int, int]] = {}
        for (i, a, _), n in zip(flat, counted.tolist()):
            if n > limit:  # a piece by itself can encode to a few tokens more: this piece shrinks, no other
                smaller = again.setdefault(i, open_texts[i])
                smaller[a] = smaller.get(a, limit) - max(1, n - limit)
        at = 0
        for i, own in spans.items():
            if i not in again:
                before = [a for a, _ in own[:1]] + [b for _, b in own[:-1]]
                out[i] = [(a, b, int(counted[at + k]), before[k] - a) for k, (a, b) in enumerate(own)]
            at += len(own)
        open_texts = again
    return out


def split_documents(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    limit: int = 2048,
    overlap: int = 128,
    least: int | None = None,
    with_text: bool = True,
    ranks: str = DEFAULT_RANKS,
) -> DataFrame:
    """Pieces of the texts with more than ``limit`` tokens.

    Columns: the key, ``piece_no`` from 1, ``n_pieces``, ``begin_char`` and
    ``end_char`` (code points, end exclusive), ``n_tokens`` of the piece by
    itself, ``overlap_chars`` shared with the piece before, and ``text`` unless
    ``with_text`` is off.  ``least`` is the smallest piece but the last, half
    the limit by default, and must exceed the overlap.

    One narrow pass, no shuffle.  Null, empty and short texts give no rows;
    repeated rows are split each; broken UTF-8 counts as U+FFFD; a text without
    any natural boundary is cut between characters.
    """
    least = limit // 2 if least is None else least
    if not 0 <= overlap < least <= limit:
        raise ValueError("sizes must keep 0 <= overlap < least <= limit")
    shared = share_ranks(df.sparkSession, ranks)
    fields = [
        T.StructField(key, df.schema[key].dataType),
        *(T.StructField(c, T.IntegerType()) for c in ("piece_no", "n_pieces", "begin_char", "end_char", "n_tokens", "overlap_chars")),
        *([T.StructField("text", T.StringType())] if with_text else []),
    ]

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = machine(shared.value)
        for batch in batches:
            keys = batch.column(0)
            for row, _, data, rows in text_chunks(batch.column(1)):
                try:
                    pieces = split_texts(data, rows, coder, limit, least, overlap)
                except UnicodeDecodeError:
                    data, rows = repaired(data, rows)
                    pieces = split_texts(data, rows, coder, limit, least, overlap)
                took: list[int] = []
                columns: list[list] = [[] for _ in range(7)]
                for i, own in enumerate(pieces):
                    if not own:
                        continue
                    chars = np.concatenate([[0], np.cumsum((data[rows[i] : rows[i + 1]] & 0xC0) != 0x80)])
                    for no, (a, b, n, shared_bytes) in enumerate(own, 1):
                        took.append(row + i)
                        begin, end = int(chars[a]), int(chars[b])
                        both = int(chars[a + shared_bytes]) - begin
                        values = (no, len(own), begin, end, n, both)
                        for column, value in zip(columns, values):
                            column.append(value)
                        if with_text:
                            columns[6].append(data[rows[i] + a : rows[i] + b].tobytes().decode("utf-8"))
                if took:
                    arrays = [keys.take(pa.array(took)), *(pa.array(c, pa.int32()) for c in columns[:6])]
                    if with_text:
                        arrays.append(pa.array(columns[6], pa.string()))
                    yield pa.RecordBatch.from_arrays(arrays, names=[f.name for f in fields])

    return df.select(F.col(f"`{key}`"), F.col(f"`{text}`").alias("__text")).mapInArrow(split, T.StructType(fields))
