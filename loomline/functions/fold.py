"""Character folding for matching: one table from code point to code point.

Two texts that differ in width, letter case, blanks, punctuation, invisible
characters or look-alike letters fold to the same sequence of letters and
digits.  The table does all of it for a whole batch of texts at once; the few
characters that need their neighbours (combining marks, conjoining jamo) or
fold to several characters send only their own text through ``unicodedata``.
"""

from __future__ import annotations

import unicodedata

import numpy as np

#: Letters of other alphabets that look like a Latin letter.
LOOKALIKES = {
    # Greek
    "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O",
    "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X", "ο": "o", "ν": "v", "ρ": "p", "ι": "i", "κ": "k", "υ": "u", "α": "a",
    "Ϲ": "C", "ϲ": "c", "Ϳ": "J", "ϳ": "j",
    # Cyrillic
    "А": "A", "В": "B", "Е": "E", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P", "С": "C", "Т": "T", "Х": "X",
    "У": "Y", "Ѕ": "S", "І": "I", "Ј": "J", "Ԛ": "Q", "Ԝ": "W", "Һ": "H", "Ү": "Y", "Ӏ": "I", "З": "3",
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "х": "x", "у": "y", "ѕ": "s", "і": "i", "ј": "j", "һ": "h",
    "ԁ": "d", "ԛ": "q", "ԝ": "w", "ү": "y", "ӏ": "l", "к": "k",
    # Armenian, Cherokee
    "Տ": "S", "Օ": "O", "Ս": "U", "օ": "o", "ս": "u", "հ": "h", "ո": "n", "ց": "g", "զ": "q",
    "Ꭺ": "A", "Ᏼ": "B", "Ꮯ": "C", "Ꭼ": "E", "Ꮋ": "H", "Ꭻ": "J", "Ꮶ": "K", "Ꮮ": "L", "Ꮇ": "M", "Ꮲ": "P", "Ꮪ": "S", "Ꭲ": "T", "Ꮃ": "W", "Ꮓ": "Z",
    # Latin letters that imitate others
    "ı": "i", "ɡ": "g", "ɑ": "a",
}

#: Kinds of compatibility decomposition that look the same.
SAME_LOOK = frozenset({"<wide>", "<narrow>", "<noBreak>", "<font>", "<compat>", "<initial>", "<medial>", "<final>", "<isolated>"})

DROP, SLOW = 0, 0xFFFFFFFF

_TABLE: np.ndarray | None = None


def fold_text(text: str) -> str:
    """The folded form of one text: letters and digits only, in lower case."""
    text = unicodedata.normalize("NFKC", text)
    text = "".join(LOOKALIKES.get(c, c) for c in text).lower()
    text = unicodedata.normalize("NFKC", text)
    return "".join(c for c in text if unicodedata.category(c)[0] in "LN")


def fold_table() -> np.ndarray:
    """Folded code point of each code point; DROP, or SLOW for ``fold_text``."""
    global _TABLE
    if _TABLE is None:
        table = np.zeros(0x110000, np.uint32)
        same = [(0x3400, 0x4DC0), (0x4E00, 0xA000), (0xAC00, 0xD7A4), (0x20000, 0x2F800), (0x30000, 0x32400)]
        for low, high in same:
            table[low:high] = np.arange(low, high)
        fixed = [(0, 0x3400), (0x4DC0, 0x4E00), (0xA000, 0xAC00), (0xD7A4, 0xD800), (0xE000, 0x20000), (0x2F800, 0x2FA20), (0xE0000, 0xE0200)]
        for low, high in fixed:
            for point in range(low, high):
                char = chr(point)
                kind = unicodedata.category(char)
                if kind[0] == "M" and kind != "Me" and not 0xFE00 <= point <= 0xFE0F and point < 0xE0000 or 0x1100 <= point <= 0x11FF:
                    table[point] = SLOW
                    continue
                folded = fold_text(char)
                table[point] = DROP if not folded else ord(folded) if len(folded) == 1 else SLOW
        _TABLE = table
    return _TABLE


def code_points(text: str) -> np.ndarray:
    """Code points of a text as an array."""
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def fold_points(text: str) -> np.ndarray:
    """Folded code points of one text."""
    points = fold_table()[code_points(text)]
    if (points == SLOW).any():
        return code_points(fold_text(text)).copy()
    return points[points != DROP]


def fold_joined(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(folded code points of all texts, offsets of the texts); null counts as empty."""
    texts = [t or "" for t in texts]
    raw = code_points("".join(texts))
    starts = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    points = fold_table()[raw]
    slow = points == SLOW
    if slow.any():
        rows = np.unique(np.searchsorted(starts, np.flatnonzero(slow), side="right") - 1).tolist()
        parts, at = [], 0
        for row in rows:
            parts += [points[at : starts[row]], code_points(fold_text(texts[row]))]
            at = starts[row + 1]
        sizes = np.diff(starts)
        parts.append(points[at:])
        for row in rows:
            sizes[row] = len(fold_text(texts[row]))
        points = np.concatenate(parts)
        starts = np.concatenate([[0], np.cumsum(sizes)])
    keep = points != DROP
    kept = np.concatenate([[0], np.cumsum(keep)])
    return points[keep], kept[starts]


def shingle_hashes(points: np.ndarray, size: int) -> np.ndarray:
    """64-bit hash of each run of ``size`` code points (len - size + 1 of them)."""
    n = len(points) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        wide = points.astype(np.uint64) + np.uint64(0x9E3779B9)
        h = wide[:n].copy()
        for i in range(1, size):
            h *= np.uint64(0xD6E8FEB86659FD93)
            h += wide[i : n + i]
        h ^= h >> np.uint64(32)
        h *= np.uint64(0x94D049BB133111EB)
        h ^= h >> np.uint64(29)
    return h
