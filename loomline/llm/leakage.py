"""Problem 8: held-out passages inside long training documents.

Size-partitioned MinHash containment search: the test items are grouped by
their number of character shingles, the documents are cut into overlapping
windows in proportion to each group's size, and a window whose MinHash signature
agrees with an item's in enough places makes a candidate.  Each candidate is
verified by the exact shingles, compared character by character, that the item
shares with one passage of the document.

The documents are read once, whatever the number of items.  Up to a fixed number
of items their index is broadcast, and everything about one document happens in
one row of one narrow pass: no shuffle, no pairs of documents.  More items keep
their signatures in a table: the windows whose signature meets enough of a bit
table of all items' signatures, of bounded size, are written with their passage,
joined with the signatures, and verified the same way.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomline.functions.fold import code_points, fold_joined, fold_points, shingle_hashes
from loomline.functions.lineage import checkpointed

#: Items whose index is broadcast (about 3 MB of signatures and shingles a thousand).
MAX_ITEMS = 4096

#: log2 of the bits of the signature table at most (16 MB), and bits for each entry.
MOST_BITS, BITS_EACH = 27, 16

#: Folded characters worked on at a time.
CHUNK_CHARS = 1 << 18

#: A lead-in is the text before the first colon that so many items share.
LEAD_IN_ITEMS = 3


@dataclass(frozen=True)
class Search:
    """Parameters of the search."""

    shingle: int = 6  # characters
    hashes: int = 64
    agree: int = 6  # agreeing places that make a candidate
    share: float = 0.5  # of the item's characters in one passage
    stretch: float = 1.25  # longest passage, in lengths of the item
    growth: float = 1.5  # between the size groups
    block: int = 8  # shingles; windows consist of whole blocks
    seed: int = 20


class Hashing:
    """The hash functions of the signatures."""

    def __init__(self, search: Search):
        self.search = search
        rng = np.random.default_rng(search.seed)
        self.factors = (rng.integers(0, 1 << 31, search.hashes, dtype=np.uint32) << np.uint32(1)) | np.uint32(1)
        self.shifts = rng.integers(0, 1 << 32, search.hashes, dtype=np.uint32)

    def mixed(self, hashes: np.ndarray, j: int) -> np.ndarray:
        return hashes * self.factors[j] + self.shifts[j]

    def signature(self, hashes: np.ndarray) -> np.ndarray:
        low = (hashes >> np.uint64(32)).astype(np.uint32)
        return np.array([self.mixed(low, j).min() for j in range(self.search.hashes)], np.uint32)

    def place(self, sizes: np.ndarray) -> np.ndarray:
        """Number of the size group of items with so many shingles."""
        return np.ceil(np.log(np.maximum(sizes, 2 * self.search.block)) / np.log(self.search.growth)).astype(int)

    def shape(self, place: int) -> tuple[int, int]:
        """(window, step) of a size group, in blocks: half of its smallest item fills a window."""
        blocks = max(1, int(self.search.growth ** (place - 1) * self.search.share / self.search.block))
        return blocks, max(1, blocks // 2)


class Windows:
    """The windows of joined texts, for some shapes, and their signatures."""

    def __init__(self, hashing: Hashing, points: np.ndarray, starts: np.ndarray, shapes: list[tuple[int, int]]):
        k, block = hashing.search.shingle, hashing.search.block
        self.hashing, self.shapes, self.starts = hashing, shapes, starts
        self.hashes = shingle_hashes(points, k)
        counts = np.maximum(np.diff(starts) - k + 1, 0)
        blocks = -(-counts // block)
        self.widest = max((w for w, _ in shapes), default=1)
        # Blocks of all texts in a row; behind each text a gap as wide as a window.
        self.row_at = np.concatenate([[0], np.cumsum(blocks + self.widest)])
        self.total = int(self.row_at[-1])
        owner = np.repeat(np.arange(len(counts)), blocks)
        inside = np.arange(len(owner)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
        begin = starts[:-1][owner] + inside * block
        self.any = bool(len(begin)) and bool(shapes)
        if not self.any:
            return
        final = (starts[:-1] + counts)[owner] - 1
        self.target = self.row_at[:-1][owner] + inside
        # One column for each block; a short block repeats its last shingle.
        low = (self.hashes >> np.uint64(32)).astype(np.uint32)
        self.low = low[np.minimum(begin + np.arange(block)[:, None], final)]
        self.row_of_block = np.repeat(np.arange(len(counts)), blocks + self.widest)
        offset = np.arange(self.total) - self.row_at[:-1][self.row_of_block]
        inside_text = offset < np.repeat(blocks, blocks + self.widest)
        self.at = [np.flatnonzero((offset % step == 0) & inside_text) for _, step in shapes]

    def minima(self, j: int) -> Iterator[np.ndarray]:
        """For each shape the j-th minimum of every window."""
        padded = np.empty(self.total, np.uint32)
        padded.fill(0xFFFFFFFF)
        padded[self.target] = self.hashing.mixed(self.low, j).min(axis=0)
        reached, width, powers = padded, 1, {1: padded}
        while 2 * width <= self.widest:
            wider = reached.copy()
            np.minimum(wider[:-width], reached[width:], out=wider[:-width])
            width *= 2
            powers[width] = reached = wider
        for (window, _), at in zip(self.shapes, self.at):
            width = 1 << (window.bit_length() - 1)
            level = powers[width]
            yield np.minimum(level[at], level[np.minimum(at + window - width, self.total - 1)])

    def span(self, at: int, window: int) -> tuple[int, int, int]:
        """(text number, begin, end) of a window, in folded characters of all texts."""
        row = int(self.row_of_block[at])
        first = int(self.starts[row] + (at - self.row_at[row]) * self.hashing.search.block)
        return row, first, first + window * self.hashing.search.block + self.hashing.search.shingle


@dataclass(frozen=True)
class Group:
    """Items of one size group."""

    window: int  # blocks
    step: int  # blocks
    items: np.ndarray  # numbers
    minima: np.ndarray  # hashes x items, sorted by value
    who: np.ndarray  # the item at each place of minima
    seen: np.ndarray  # hashes x 65536: some minimum has these low bits


class Item:
    """An item as it is verified: its distinct shingles, a place of each, how often each occurs, the shingle at each place."""

    def __init__(self, points: np.ndarray, hashes: np.ndarray):
        self.points = points
        self.distinct, self.first, self.which, self.times = np.unique(hashes, return_index=True, return_inverse=True, return_counts=True)


class Index:
    """MinHash index of a bounded number of items."""

    def __init__(self, items: list[tuple[object, str]], search: Search):
        self.search, self.hashing = search, Hashing(search)
        self.keys, self.items = [], []
        signatures, sizes = [], []
        for key, text in items:
            points = fold_points(text or "")
            hashes = shingle_hashes(points, search.shingle)
            if not len(hashes):
                continue
            self.keys.append(key)
            self.items.append(Item(points, hashes))
            signatures.append(self.hashing.signature(hashes))
            sizes.append(len(hashes))
        self.groups = []
        if not sizes:
            return
        signatures, place = np.stack(signatures), self.hashing.place(np.array(sizes))
        for p in np.unique(place).tolist():
            mine = np.flatnonzero(place == p)
            minima = signatures[mine].T
            order = np.argsort(minima, axis=1, kind="stable")
            seen = np.zeros((search.hashes, 1 << 16), bool)
            for j in range(search.hashes):
                seen[j, minima[j] & np.uint32(0xFFFF)] = True
            self.groups.append(Group(*self.hashing.shape(p), mine, np.take_along_axis(minima, order, 1), mine[order], seen))

    def search_joined(self, points: np.ndarray, starts: np.ndarray) -> list[tuple[int, int]]:
        """(text number, item number) of every item found in one of the joined texts."""
        windows = Windows(self.hashing, points, starts, [(g.window, g.step) for g in self.groups])
        if not windows.any:
            return []
        met: list[tuple[list, list]] = [([], []) for _ in self.groups]
        for j in range(self.search.hashes):
            for g, at, minima, (found, whom) in zip(self.groups, windows.at, windows.minima(j), met):
                near = np.flatnonzero(g.seen[j, minima & np.uint32(0xFFFF)])
                if len(near):
                    values = minima[near]
                    left = np.searchsorted(g.minima[j], values, side="left")
                    right = np.searchsorted(g.minima[j], values, side="right")
                    n = right - left
                    if n.any():
                        found.append(np.repeat(at[near], n))
                        ends = np.cumsum(n)
                        whom.append(g.who[j][np.repeat(left - (ends - n), n) + np.arange(ends[-1])])
        spans: dict[tuple[int, int], list[tuple[int, int]]] = {}
        for g, (found, whom) in zip(self.groups, met):
            if not found:
                continue
            pair, times = np.unique(np.concatenate(found) * len(self.keys) + np.concatenate(whom), return_counts=True)
            for value in pair[times >= self.search.agree].tolist():
                at, item = divmod(value, len(self.keys))
                row, first, last = windows.span(at, g.window)
                spans.setdefault((row, item), []).append((first, last))
        return [(row, item) for (row, item), own in spans.items() if holds(points, windows.hashes, int(starts[row]), int(starts[row + 1]), self.items[item], own, self.search)]


def holds(points: np.ndarray, hashes: np.ndarray, low: int, high: int, item: Item, spans: list[tuple[int, int]], search: Search) -> bool:
    """Whether one passage near a candidate window holds enough of an item."""
    k, size = search.shingle, len(item.points)
    reach = int(size * search.stretch)
    steps, done = np.arange(k), -1
    for begin, last in sorted(spans):
        a, b = max(low, begin - reach), min(high, last + reach)
        if b <= done:
            continue
        done = b
        here = hashes[a : max(a, b - k + 1)]
        found = np.minimum(np.searchsorted(item.distinct, here), len(item.distinct) - 1)
        hit = np.flatnonzero(item.distinct[found] == here)
        shingles = found[hit]
        if item.times[np.unique(shingles)].sum() * (k + 2) < search.share * size:  # too few to cover enough
            continue
        at = hit + a
        equal = (points[at[:, None] + steps] == item.points[item.first[shingles][:, None] + steps]).all(1)
        if covers(at[equal], shingles[equal], item.times, item.which, k, search.share * size, reach):
            return True
    return False


def covers(at: np.ndarray, shingles: np.ndarray, times: np.ndarray, which: np.ndarray, k: int, enough: float, reach: int) -> bool:
    """Whether shingles in one passage cover ``enough`` characters of an item.

    ``at`` are positions in the document, ``shingles`` the item's shingles there;
    ``which`` is the shingle at each place of the item.  A passage spans at most
    ``reach`` characters.  Single characters that were altered between two
    shingles count as covered.
    """
    count = np.zeros(len(times), np.int32)
    present, j, tried = 0, 0, 0
    positions, ids, weights = at.tolist(), shingles.tolist(), times.tolist()
    for p, q in zip(positions, ids):
        count[q] += 1
        if count[q] == 1:
            present += weights[q]
        while positions[j] < p - reach + k:
            gone = ids[j]
            count[gone] -= 1
            if count[gone] == 0:
                present -= weights[gone]
            j += 1
            tried = 0
        if present > tried and present * (k + 2) >= enough:
            where = np.flatnonzero(count[which])
            gaps = np.diff(where)
            covered = int(np.where(gaps <= k + 2, gaps, k).sum()) + k
            if covered >= enough:
                return True
            tried = present + max(0, int(enough - covered) // (k + 2) - 1)
    return False


def lead_ins(items: DataFrame, text: str) -> DataFrame:
    """The items with the column ``__body``: the text without a shared lead-in."""
    # Fixed format: a lead-in ends at the first colon of the first line.
    lead = F.regexp_extract(F.col(f"`{text}`"), r"^\s*([^:：\n]{2,}[:：])\s*", 1)
    marked = items.withColumn("__lead", F.when(lead != "", lead))
    common = marked.where("__lead is not null").groupBy("__lead").count().where(F.col("count") >= LEAD_IN_ITEMS)
    joined = marked.join(common.select("__lead", F.lit(True).alias("__shared")), "__lead", "left")
    body = F.when(F.col("__shared"), F.expr(f"substring(ltrim(`{text}`), length(__lead) + 1)")).otherwise(F.col(f"`{text}`"))
    return joined.withColumn("__body", body)


def find_leaks(
    documents: DataFrame,
    items: DataFrame,
    doc_key: str = "doc_id",
    doc_text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
    search: Search = Search(),
) -> DataFrame:
    """(document key, item key) of every document that holds at least
    ``search.share`` of an item's text, its lead-in aside, in one passage.

    Null and empty texts on either side give no rows, nor do items shorter than
    a shingle.  Repeated document rows are reported each, repeated items by each
    of their keys once.  Extra columns are ignored.
    """
    kinds = T.StructType([
        T.StructField(doc_key, documents.schema[doc_key].dataType),
        T.StructField(item_key, items.schema[item_key].dataType),
    ])
    bodies = lead_ins(items.where(F.col(f"`{item_text}`").isNotNull()), item_text).select(F.col(f"`{item_key}`").alias("key"), F.col("__body").alias("body"))
    texts = documents.select(F.col(f"`{doc_key}`").alias(doc_key), F.col(f"`{doc_text}`").alias("__text")).where("__text is not null")
    first = bodies.limit(MAX_ITEMS + 1).collect()
    if len(first) > MAX_ITEMS:
        return join_leaks(texts, checkpointed(bodies.withColumn("item", F.monotonically_increasing_id())), kinds, search)
    rows = sorted(((r["key"], r["body"]) for r in first), key=repr)
    shared = documents.sparkSession.sparkContext.broadcast((uuid.uuid4().hex, rows, search))
    return texts.mapInArrow(searcher(shared, kinds), kinds)


def table_place(slots: np.ndarray, values: np.ndarray, bits: int) -> np.ndarray:
    """Bit of each (slot, value) in the table of signatures."""
    with np.errstate(over="ignore"):
        mixed = (slots.astype(np.uint64) << np.uint64(32) | values.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
        return (mixed * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(64 - bits)


def join_leaks(texts: DataFrame, items: DataFrame, kinds: T.StructType, search: Search) -> DataFrame:
    """find_leaks for any number of items: one scan of the documents, a join with the signatures, the same verification."""
    spark = texts.sparkSession
    doc_key, item_key = kinds.names
    hashes = search.hashes

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashing = Hashing(search)
        for batch in batches:
            for number, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                own = shingle_hashes(fold_points(body or ""), search.shingle)
                if len(own):
                    place = int(hashing.place(np.array([len(own)]))[0])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(place * hashes + np.arange(hashes), pa.int32()), pa.array(hashing.signature(own).view(np.int32)), pa.array(np.full(hashes, number, np.int64))], names=["slot", "value", "item"]
                    )

    signatures = checkpointed(items.select("item", "body").mapInArrow(sign, "slot int, value int, item long"))
    places = sorted(r["p"] for r in signatures.select(F.floor(F.col("slot") / hashes).cast("int").alias("p")).distinct().collect())  # as many as the logarithm of the longest item
    bits = max(16, min(MOST_BITS, math.ceil(math.log2(max(2, signatures.count() * BITS_EACH)))))

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = np.zeros(1 << bits - 6, np.uint64)
        for batch in batches:
            at = table_place(batch.column(0).to_numpy(), batch.column(1).to_numpy().view(np.uint32), bits)
            np.bitwise_or.at(words, (at >> np.uint64(6)).astype(np.int64), np.uint64(1) << (at & np.uint64(63)))
        used = np.flatnonzero(words)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(words[used].view(np.int64))], names=["word", "bits"])

    marked = signatures.select("slot", "value").mapInArrow(mark, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    table = np.zeros(1 << bits - 6, np.int64)
    table[marked.column("word").to_numpy()] = marked.column("bits").to_numpy()
    shared = spark.sparkContext.broadcast(table.view(np.uint64))
    kind = kinds[doc_key].dataType
    schema = T.StructType([T.StructField("row", T.LongType()), T.StructField(doc_key, kind), T.StructField("place", T.IntegerType()), T.StructField("at", T.LongType()), T.StructField("offset", T.IntegerType()),
                           T.StructField("passage", T.StringType()), T.StructField("slots", T.ArrayType(T.IntegerType())), T.StructField("values", T.ArrayType(T.IntegerType()))])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashing = Hashing(search)
        shapes = [hashing.shape(p) for p in places]
        for keys, first, points, starts in joined_texts(batches):
            windows = Windows(hashing, points, starts, shapes)
            if not windows.any:
                continue
            times, hits = [np.zeros(len(at), np.int32) for at in windows.at], [[] for _ in shapes]
            for j in range(hashes):
                for g, minima in enumerate(windows.minima(j)):
                    slot = places[g] * hashes + j
                    bit = table_place(np.full(1, slot), minima, bits)
                    near = np.flatnonzero(shared.value[bit >> np.uint64(6)] >> (bit & np.uint64(63)) & np.uint64(1))
                    times[g][near] += 1
                    hits[g].append((near, np.full(len(near), slot, np.int32), minima[near].view(np.int32)))
            rows: list[tuple] = []
            for g, (own, count) in enumerate(zip(hits, times)):
                enough = np.flatnonzero(count >= search.agree)
                if not len(enough):
                    continue
                near, slots, values = (np.concatenate(x) for x in zip(*own))
                order = np.argsort(near, kind="stable")
                near, slots, values = near[order], slots[order], values[order]
                reach = int((search.growth ** places[g] + search.shingle) * search.stretch)
                for w in enough.tolist():
                    a, b = np.searchsorted(near, [w, w + 1])
                    row, begin, last = windows.span(int(windows.at[g][w]), shapes[g][0])
                    low, high = max(int(starts[row]), begin - reach), min(int(starts[row + 1]), last + reach)
                    passage = points[low:high].astype("<u4").tobytes().decode("utf-32-le", "surrogatepass")
                    rows.append((first + row, keys[row].as_py(), places[g], begin - int(starts[row]), begin - low, passage, slots[a:b].tolist(), values[a:b].tolist()))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), to_arrow(schema))], names=schema.names)

    numbered = texts.select(F.monotonically_increasing_id().alias("row"), doc_key, "__text")
    found = checkpointed(numbered.mapInArrow(scan, schema))
    window = ["row", "place", "at"]
    hit = found.select(*window, F.explode(F.arrays_zip("slots", "values")).alias("h")).select(*window, F.col("h.slots").alias("slot"), F.col("h.values").alias("value"))
    met = hit.join(signatures, ["slot", "value"]).groupBy(*window, "item").agg(F.count("*").alias("n")).where(F.col("n") >= search.agree)
    full = met.join(found.select(*window, doc_key, "offset", "passage"), window).join(items.select("item", F.col("key").alias(item_key), "body"), "item")
    out = T.StructType([T.StructField("row", T.LongType()), *kinds])

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for i, (place, offset, passage, body) in enumerate(zip(*(batch.column(k).to_pylist() for k in (3, 4, 5, 6)))):
                points, own = code_points(passage), fold_points(body)
                span = (offset, offset + Hashing(search).shape(place)[0] * search.block + search.shingle)
                if holds(points, shingle_hashes(points, search.shingle), 0, len(points), Item(own, shingle_hashes(own, search.shingle)), [span], search):
                    keep.append(i)
            rows = pa.array(keep, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(k).take(rows) for k in range(3)], names=out.names)

    verified = full.select("row", doc_key, item_key, "place", "offset", "passage", "body").mapInArrow(check, out)
    return verified.distinct().select(doc_key, item_key)


def to_arrow(schema: T.StructType) -> list[pa.DataType]:
    from pyspark.sql.pandas.types import to_arrow_type

    return [to_arrow_type(f.dataType) for f in schema]


def joined_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, int, np.ndarray, np.ndarray]]:
    """(keys, number of the first text, folded points, offsets) of some texts at a time; columns: number, key, text."""
    for batch in batches:
        numbers, keys, texts = batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist()
        for begin, end in portions(texts):
            yield keys.slice(begin, end - begin), numbers[begin], *fold_joined(texts[begin:end])


def portions(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    """Ranges of texts with so many characters together."""
    begin, chars = 0, 0
    for end in range(1, len(texts) + 1):
        chars += len(texts[end - 1] or "")
        if end == len(texts) or chars + len(texts[end] or "") > CHUNK_CHARS:
            yield begin, end
            begin, chars = end, 0


_INDEXES: dict[str, Index] = {}


def searcher(shared, kinds: T.StructType) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The pass over the documents with a broadcast index."""
    types, names = to_arrow(kinds), kinds.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, items, search = shared.value
        if name not in _INDEXES:
            _INDEXES.clear()
            _INDEXES[name] = Index(items, search)
        index = _INDEXES[name]
        for batch in batches:
            keys, texts = batch.column(0), batch.column(1).to_pylist()
            for begin, end in portions(texts):
                found = index.search_joined(*fold_joined(texts[begin:end]))
                if found:
                    docs = keys.take(pa.array([begin + i for i, _ in found]))
                    yield pa.RecordBatch.from_arrays([docs, pa.array([index.keys[i] for _, i in found], types[1])], names=names)

    return run
