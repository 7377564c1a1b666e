"""Problem 7: whole-corpus encoding with a byte-level BPE vocabulary.

The merges of a rank file are compiled into a finite-state transducer over
bytes.  For every prefix of a pre-token the BPE encoding has one last token; a
token ``t`` ending at byte ``i`` is that last token exactly when the token that
ends where ``t`` begins may stand before ``t`` (the pair re-encodes to itself).
A state therefore needs only the trie nodes that are still open at ``i`` and
the last token in front of each of them.  States and transitions are made when
text first asks for them (lazy determinisation) and live in a dense table, so a
whole Arrow batch of pre-tokens is driven through the machine in lock step with
numpy, one byte of all of them at a time.  A token is settled once no open node
begins before its end: the look-ahead is bounded by the longest vocabulary
entry.

The table has a documented bound (``MAX_STATES``); when it fills up it is
emptied and built again, which costs time but never changes a result.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rank file used where no path is given: 50,256 byte-level entries.
DEFAULT_RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"

#: Rows of the transition table (256 int32 each) before it is emptied.
MAX_STATES = 1 << 16

#: Text bytes driven through the machine at a time.
CHUNK_BYTES = 4 << 20

#: The white space of the pre-token pattern (Unicode White_Space).
WHITE_SPACE = (
    list(range(0x09, 0x0E)) + [0x20, 0x85, 0xA0, 0x1680] + list(range(0x2000, 0x200B))
    + [0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
)

OTHER, LETTER, NUMBER, SPACE = 0, 1, 2, 3


def read_ranks(data: bytes) -> dict[bytes, int]:
    """Token bytes to id of a rank file's content."""
    pairs = (line.split() for line in data.splitlines() if line)
    return {base64.b64decode(token): int(rank) for token, rank in pairs}


_CLASSES: np.ndarray | None = None


def char_classes() -> np.ndarray:
    """Class of each code point: letter, number, white space or other."""
    global _CLASSES
    if _CLASSES is None:
        import unicodedata

        kind = {"L": LETTER, "N": NUMBER}
        table = np.zeros(0x110000, np.uint8)
        # Planes 4 to 13 and 15, 16 hold neither letters nor numbers.
        for low, high in ((0, 0xD800), (0xE000, 0x40000), (0xE0000, 0xE1000)):
            table[low:high] = [kind.get(unicodedata.category(chr(c))[0], OTHER) for c in range(low, high)]
        table[WHITE_SPACE] = SPACE
        _CLASSES = table
    return _CLASSES


def pretokens(data: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Byte offsets at which the pre-tokens of joined UTF-8 texts begin.

    ``rows`` holds the byte offsets of the texts' beginnings; a text always
    begins a pre-token.  Equal to the GPT-2 pattern: contractions, runs of
    letters, numbers or other signs with one blank in front, white space.
    """
    if not len(data):
        return np.zeros(0, np.int64)
    points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    n = len(points)
    widths = 1 + (points >= 0x80).astype(np.int8) + (points >= 0x800) + (points >= 0x10000)
    at = np.zeros(n + 1, np.int64)
    np.cumsum(widths, out=at[1:])
    row_chars = np.searchsorted(at, rows[rows < len(data)])
    first = np.zeros(n + 1, bool)
    first[row_chars] = True
    first[n] = True
    kinds = char_classes()[points]
    edge = np.ones(n + 1, bool)
    edge[1:n] = kinds[1:] != kinds[:-1]
    edge |= first
    blank = points == 0x20
    start = edge[:n].copy()
    # A blank in front of a run belongs to it.
    inner = start[1:] & ~first[1:n] & (kinds[1:] != SPACE) & blank[:-1]
    start[1:][inner] = False
    # The last white space in front of a run stands alone or goes with the run.
    before_run = (kinds[:-1] == SPACE) & (kinds[1:] != SPACE) & ~first[1:n]
    start[:-1][before_run] = True
    quotes = np.flatnonzero(points == 0x27)
    if len(quotes):
        padded = np.concatenate([points, np.zeros(3, np.uint32)])
        same1 = ~np.concatenate([first, np.ones(3, bool)])[quotes + 1]
        same2 = same1 & ~np.concatenate([first, np.ones(3, bool)])[quotes + 2]
        a, b = padded[quotes + 1], padded[quotes + 2]
        opens = edge[quotes] & (first[quotes] | ~blank[quotes - 1])
        one = opens & same1 & np.isin(a, [ord(c) for c in "stmd"])
        two = opens & same2 & (
            ((a == ord("r")) & (b == ord("e"))) | ((a == ord("v")) & (b == ord("e"))) | ((a == ord("l")) & (b == ord("l")))
        )
        for hits, size in ((quotes[one], 2), (quotes[two], 3)):
            start[hits] = True
            start[hits + 1] = False
            after = hits + size
            start[after[after < n]] = True
    return at[:n][start]


class Transducer:
    """Byte-driven BPE encoder, determinised as texts need it."""

    def __init__(self, ranks: dict[bytes, int], max_states: int = MAX_STATES):
        self.ranks = ranks
        self.max_states = max_states
        self.tokens: dict[int, bytes] = {i: t for t, i in ranks.items()}
        self.length = np.zeros(max(self.tokens) + 1, np.int64)
        for i, t in self.tokens.items():
            self.length[i] = len(t)
        # Trie of the vocabulary: per node a dict of children, and its token.
        self.children: list[dict[int, int]] = [{}]
        self.token_of: list[int] = [-1]
        for token, i in ranks.items():
            node = 0
            for byte in token:
                child = self.children[node].get(byte)
                if child is None:
                    child = len(self.children)
                    self.children[node][byte] = child
                    self.children.append({})
                    self.token_of.append(-1)
                node = child
            self.token_of[node] = i
        self.pairs: dict[tuple[int, int], bool] = {}
        self.rebuilt = 0
        self.grown = 1 << 10
        self.reset()

    def reset(self) -> None:
        """Forget all states but the first."""
        start = ((0, -1),)
        self.number: dict[tuple, int] = {start: 0}
        self.state: list[tuple] = [start]
        self.table = np.full((self.grown, 256), -1, np.int32)
        self.last = np.full(self.grown, -1, np.int32)

    def renew(self, live: np.ndarray) -> np.ndarray:
        """Empties the table but for the states in use; their new numbers."""
        used, which = np.unique(live, return_inverse=True)
        keys = [self.state[i] for i in used.tolist()]
        self.rebuilt += 1
        self.reset()
        return np.array([self.number_of(key) for key in keys], np.int32)[which]

    def merge(self, piece: bytes) -> list[int]:
        """Ids of a short byte string by plain rank-ordered merging."""
        parts = [piece[i : i + 1] for i in range(len(piece))]
        while len(parts) > 1:
            best, where = None, -1
            for i in range(len(parts) - 1):
                rank = self.ranks.get(parts[i] + parts[i + 1])
                if rank is not None and (best is None or rank < best):
                    best, where = rank, i
            if best is None:
                break
            parts[where : where + 2] = [parts[where] + parts[where + 1]]
        return [self.ranks[p] for p in parts]

    def may_follow(self, left: int, right: int) -> bool:
        """Whether ``right`` may stand after ``left`` in an encoding."""
        known = self.pairs.get((left, right))
        if known is None:
            known = self.merge(self.tokens[left] + self.tokens[right]) == [left, right]
            if len(self.pairs) > 1 << 20:
                self.pairs.clear()
            self.pairs[left, right] = known
        return known

    def step(self, state: int, byte: int) -> int:
        """The state after one more byte; makes it where it is new."""
        token, open_nodes = -1, []
        for node, before in self.state[state]:
            child = self.children[node].get(byte)
            if child is None:
                continue
            here = self.token_of[child]
            if token < 0 and here >= 0 and (before < 0 or self.may_follow(before, here)):
                token = here
            if self.children[child]:
                open_nodes.append((child, before))
        if token < 0:
            raise ValueError(f"byte {byte} has no token: the vocabulary lacks single bytes")
        open_nodes.append((0, token))
        found = self.number_of(tuple(open_nodes))
        self.table[state, byte] = found
        return found

    def number_of(self, key: tuple) -> int:
        """The number of a state, which is added where it is new."""
        found = self.number.get(key)
        if found is None:
            found = len(self.state)
            if found >= len(self.last):
                self.grown = 2 * len(self.last)
                self.table = np.concatenate([self.table, np.full_like(self.table, -1)])
                self.last = np.concatenate([self.last, np.full_like(self.last, -1)])
            self.number[key] = found
            self.state.append(key)
            self.last[found] = key[-1][1]
        return found

    def ends(self, data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(is a token's last byte, token that would end there) per byte."""
        last = np.empty(len(data), np.int32)
        is_end = np.zeros(len(data), bool)
        if not len(starts):
            return is_end, last
        sizes = np.diff(np.append(starts, len(data)))
        order = np.argsort(-sizes, kind="stable")
        sizes, at = sizes[order], starts[order]
        active = np.searchsorted(-sizes, -np.arange(sizes[0]), side="left")
        state = np.zeros(len(at), np.int32)
        table = self.table.ravel()
        for done in range(int(sizes[0])):
            m = int(active[done])
            if m < 24:
                self._finish(data, last, at[:m] + done, sizes[:m] - done, state[:m])
                break
            where = at[:m] + done
            key = (state[:m].astype(np.int64) << 8) | data[where]
            after = table[key]
            missing = after < 0
            if missing.any():
                for k in np.unique(key[missing]).tolist():
                    self.step(k >> 8, k & 255)
                table = self.table.ravel()
                after = table[key]
            last[where] = self.last[after]
            state = after
            if len(self.state) > self.max_states:
                state = self.renew(state)
                table = self.table.ravel()
        end = starts + np.diff(np.append(starts, len(data)))
        begin = starts
        while len(end):
            is_end[end - 1] = True
            end = end - self.length[last[end - 1]]
            more = end > begin
            end, begin = end[more], begin[more]
        return is_end, last

    def _finish(self, data, last, at, sizes, states) -> None:
        """The few longest pre-tokens, byte by byte."""
        keys = [self.state[i] for i in states.tolist()]  # numbers do not outlive a renewal
        for begin, size, key in zip(at.tolist(), sizes.tolist(), keys):
            state = self.number_of(key)
            out = np.empty(size, np.int32)
            for i, byte in enumerate(data[begin : begin + size].tolist()):
                after = self.table[state, byte]
                state = int(after) if after >= 0 else self.step(state, byte)
                out[i] = self.last[state]
                if len(self.state) > self.max_states:
                    state = int(self.renew(np.array([state]))[0])
            last[begin : begin + size] = out

    def encode_joined(self, data: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in order, byte offset of each id's end)."""
        is_end, last = self.ends(data, pretokens(data, rows))
        where = np.flatnonzero(is_end)
        return last[where], where + 1

    def encode(self, text: str) -> list[int]:
        """Ids of one text."""
        data = np.frombuffer(text.encode("utf-8"), np.uint8)
        return self.encode_joined(data, np.zeros(1, np.int64))[0].tolist()


class Utf8Decoder:
    """Incremental UTF-8 machine: bytes in, whole characters out.

    The state is the unfinished tail (at most three bytes).  A byte that cannot
    continue the tail turns the tail into U+FFFD, as in the standard decoder.
    """

    def __init__(self) -> None:
        self.tail = b""

    def feed(self, data: bytes, final: bool = False) -> str:
        data = self.tail + data
        keep = 0 if final else unfinished(data)
        self.tail = data[len(data) - keep :] if keep else b""
        return data[: len(data) - keep].decode("utf-8", "replace")


def unfinished(data: bytes) -> int:
    """How many bytes at the end begin a character that is not yet whole."""
    for back in range(1, min(3, len(data)) + 1):
        byte = data[-back]
        if byte >= 0xC2:
            need = 2 if byte < 0xE0 else 3 if byte < 0xF0 else 4 if byte < 0xF5 else 1
            return back if need > back else 0
        if byte < 0x80:
            return 0
    return 0


def decode_ids(ids, tokens: dict[int, bytes]) -> str:
    """Text of a list of ids; streams through the incremental decoder."""
    decoder, out = Utf8Decoder(), []
    for i in ids:
        out.append(decoder.feed(tokens[int(i)]))
    out.append(decoder.feed(b"", final=True))
    return "".join(out)


_MACHINES: dict[int, Transducer] = {}


def machine(content: bytes) -> Transducer:
    """This worker's transducer for a rank file's content; built once."""
    key = hash(content)
    if key not in _MACHINES:
        _MACHINES[key] = Transducer(read_ranks(content))
    return _MACHINES[key]


def share_ranks(spark: SparkSession, path: str = DEFAULT_RANKS):
    """Broadcast of the rank file (under 1 MB; the size is checked)."""
    with open(path, "rb") as file:
        content = file.read()
    if len(content) > 64 << 20:
        raise ValueError(f"{path} is larger than a vocabulary may be (64 MB)")
    return spark.sparkContext.broadcast(content)


def text_chunks(column: pa.Array, chunk_bytes: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, joined bytes, row offsets) in bounded pieces.

    Null texts count as empty.  A text longer than the bound is a piece of its
    own: texts are never cut.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    buffer = column.buffers()[2]
    data = np.frombuffer(buffer, np.uint8) if buffer is not None else np.zeros(0, np.uint8)
    row = 0
    while row < len(column):
        end = int(np.searchsorted(offsets, offsets[row] + chunk_bytes, side="right")) - 1
        end = min(len(column), max(end, row + 1))
        yield row, end, data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]
        row = end


def repaired(data: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Joined texts and offsets with U+FFFD in place of broken UTF-8."""
    raw = data.tobytes()
    texts = [raw[a:b].decode("utf-8", "replace").encode() for a, b in zip(rows[:-1].tolist(), rows[1:].tolist())]
    return np.frombuffer(b"".join(texts), np.uint8), np.concatenate([[0], np.cumsum([len(t) for t in texts])])


def encode_column(column: pa.Array, coder: Transducer) -> pa.Array:
    """List-of-int ids of a string column; null and empty texts give []."""
    parts = []
    for _, _, data, rows in text_chunks(column):
        try:
            ids, ends = coder.encode_joined(data, rows[:-1])
        except UnicodeDecodeError:  # broken bytes in some text: they count as U+FFFD
            data, rows = repaired(data, rows)
            ids, ends = coder.encode_joined(data, rows[:-1])
        offsets = np.searchsorted(ends, rows, side="right").astype(np.int32)
        parts.append(pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids, pa.int32())))
    return pa.concat_arrays(parts) if parts else pa.array([], pa.list_(pa.int32()))


def encode_documents(
    df: DataFrame, text: str = "text", out: str = "ids", keep: list[str] | None = None, ranks: str = DEFAULT_RANKS
) -> DataFrame:
    """Adds ``out``, the token ids of ``text``, to the ``keep`` columns.

    One narrow pass, no shuffle.  Null, empty: ``[]``.  Strings that look like
    special tokens are ordinary text.  Repeated rows are encoded each; an empty
    table gives an empty table.  ``keep`` defaults to all columns but ``text``;
    a kept column named like ``out`` is an error.
    """
    keep = [c for c in df.columns if c != text] if keep is None else list(keep)
    if out in keep:
        raise ValueError(f"column {out} exists already")
    shared = share_ranks(df.sparkSession, ranks)
    schema = T.StructType([*(df.schema[c] for c in keep), T.StructField(out, T.ArrayType(T.IntegerType(), False), False)])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = machine(shared.value)
        for batch in batches:
            ids = encode_column(batch.column(len(keep)), coder)
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], ids], names=[*keep, out])

    columns = [F.col(f"`{c}`") for c in keep]
    return df.select(*columns, F.col(f"`{text}`").alias("__text")).mapInArrow(encode, schema)


def decode_documents(df: DataFrame, ids: str = "ids", out: str = "text", keep: list[str] | None = None, ranks: str = DEFAULT_RANKS) -> DataFrame:
    """Adds ``out``, the text of the token ids, to the ``keep`` columns (all but ``ids`` by default).

    The tokens' bytes go through the incremental decoder; bytes that make no
    character count as U+FFFD.  Null and empty lists give the empty text; an id
    that the vocabulary lacks is an error.
    """
    keep = [c for c in df.columns if c != ids] if keep is None else list(keep)
    if out in keep:
        raise ValueError(f"column {out} exists already")
    shared = share_ranks(df.sparkSession, ranks)
    schema = T.StructType([*(df.schema[c] for c in keep), T.StructField(out, T.StringType(), False)])

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = machine(shared.value).tokens
        for batch in batches:
            texts = [Utf8Decoder().feed(b"".join(map(tokens.__getitem__, row or ())), final=True) for row in batch.column(len(keep)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], pa.array(texts, pa.string())], names=[*keep, out])

    return df.select(*(F.col(f"`{c}`") for c in keep), F.col(f"`{ids}`").alias("__ids")).mapInArrow(decode, schema)
