"""Problem 5: records of evaluation splits that come again in the training split.

Winnowing: the longer text of a pair is laid out in disjoint windows, one more
than the edits it may have, and keeps one character run of each, those that are
the rarest in the other split.  An edit spoils one window at most, so one run at
least stands unchanged in the other text, near the place that the edits before
it allow: no near pair is lost, at any length.  Runs never leave a task: texts of
both splits meet in cells, and every cell indexes the runs of its shorter texts
by their places, a slice at a time.  Pairs whose lengths, places, character sets
or sets of character pairs cannot belong to near-equal texts are dropped there.
The exact edit distance decides.  Of what is left all common runs are chained
where they are collinear, and extended while characters agree; the share of
the evaluation text so covered is reported.

Equal texts are one class on each side, so copies meet once; they are expanded
in the result only.  The driver gathers the numbers of characters and nothing
else, and nothing is broadcast but a bounded table of the largest classes.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomline.functions.fold import code_points, fold_joined, shingle_hashes
from loomline.functions.lineage import checkpointed

#: Texts of more characters are compared bit-parallel in Python (the cost differs, not the result).
LONG_TEXT = 2000

#: Classes whose members are split over several tasks at most; any other holds under 1/1000 of the rows.
HOT_CLASSES = 1000

#: Members of a class that stay together when pairs become records.
PER_SLOT = 4096

#: Texts beyond the size have each of their runs once in an index, for all places.
PLACED = 512

#: Windows that are laid out at once, characters that are looked up, that are indexed and of a chunk, seeds that are compared, entries of an index's table.
WINDOWS, SLICE, INDEXED, CHUNK, SEEDS, TABLE = 64, 1 << 17, 1 << 20, 6 << 20, 1 << 18, 1 << 21

#: A split of so many characters is dealt out to so many cells at least.
SPREAD, LEAST_CELLS = 500_000, 6


@dataclass(frozen=True)
class Winnowing:
    """Parameters; results do not depend on any but ``distance``."""

    distance: float = 0.2  # edits, as share of the longer text
    longest: int = 8  # characters of a run at most
    buckets: int = 1 << 20  # of the histogram of an index's hashes
    per_salt: int = 32_000  # thousands of characters that one cell holds

    def edits(self, size):
        """Edits that the longer text of a pair may have."""
        return np.floor(self.distance * np.asarray(size) + 1e-9).astype(np.int64)

    def run(self, size):
        """Length of the runs of a text, as the longer one of a pair."""
        return np.clip(np.asarray(size) // (self.edits(size) + 1), 1, self.longest)


@lru_cache(maxsize=100_000)
def run_lengths(size: int, options: Winnowing) -> tuple[int, ...]:
    """Lengths of the runs of all texts of which one of ``size`` characters may be the shorter one."""
    longer = np.arange(size, int(size / max(1e-9, 1 - options.distance)) + 2)
    longer = longer[(longer - options.edits(longer) <= size) & (options.edits(longer) > 0)]
    return tuple(np.unique(options.run(longer)).tolist())


def fold_records(df: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """(field, cls, id) of every text that is not empty once folded; ``cls`` is its 128-bit hash."""
    schema = T.StructType([T.StructField("field", T.IntegerType()), T.StructField("id", df.schema[key].dataType), T.StructField("text", T.StringType())])

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(columns)):
                rows, texts = folded(batch.column(i + 1))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(rows), i, np.int32)), batch.column(0).take(pa.array(rows)), texts], names=schema.names)

    rows = df.select(F.col(f"`{key}`"), *(F.col(f"`{c}`").cast("string").alias(f"__{i}") for i, c in enumerate(columns)))
    return rows.mapInArrow(fold, schema).select("field", F.unhex(F.md5("text")).alias("cls"), "id")


def fold_texts(df: DataFrame, columns: list[str]) -> DataFrame:
    """(field, text, copies) of the texts that are not empty once folded; those of one batch come once."""

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(columns)):
                counts = folded(batch.column(i))[1].value_counts()
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(counts), i, np.int32)), counts.field("values"), counts.field("counts")], names=["field", "text", "copies"])

    rows = df.select(*(F.col(f"`{c}`").cast("string").alias(f"__{i}") for i, c in enumerate(columns)))
    return rows.mapInArrow(fold, "field int, text string, copies long")


def folded(column: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """(row numbers, folded texts) of the texts that are not empty once folded."""
    points, starts = fold_joined(column.to_pylist())
    rows = np.flatnonzero(np.diff(starts) > 0)
    whole = points.astype("<u4").tobytes().decode("utf-32-le")
    return rows, pa.array([whole[a:b] for a, b in zip(starts[rows].tolist(), starts[rows + 1].tolist())], pa.string())


class Batch:
    """The folded texts of one batch, with the hashes of their runs."""

    def __init__(self, fields: np.ndarray, texts: list[str], options: Winnowing):
        self.options = options
        self.sizes = np.array([len(t) for t in texts], np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.sizes)])
        self.joined = "".join(texts)
        self.points = code_points(self.joined)
        self.marks = fields.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        self.hashes: dict[int, np.ndarray] = {}

    def runs(self, length: int) -> np.ndarray:
        """Hash of the run at every place; those across texts are never looked at."""
        if length not in self.hashes:
            found = shingle_hashes(np.concatenate([self.points, np.zeros(length, np.uint32)]), length)[: len(self.points)]
            self.hashes[length] = found ^ np.repeat(self.marks, self.sizes)
        return self.hashes[length]

    def every_run(self, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(hash, text number, place) of all runs of a length in the texts of which a longer one may keep such runs."""
        sizes = [n for n in np.unique(self.sizes).tolist() if n >= length and length in run_lengths(n, self.options)]
        rows = np.flatnonzero(np.isin(self.sizes, sizes))
        counts = self.sizes[rows] - length + 1
        row = np.repeat(rows.astype(np.int32), counts)
        place = np.arange(len(row), dtype=np.int32) - np.repeat((np.cumsum(counts) - counts).astype(np.int32), counts)
        return self.runs(length)[self.starts[row] + place], row, place

    def rarest_runs(self, counts: np.ndarray, of: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(hash, text number, place, number from 0) of the runs that the windows of every text keep.

        Of all ways to lay the windows out the one with the least sum of
        counts is taken, for so many windows at a time; of equal counts the
        smaller hash.  ``of`` are the texts to lay out, all if not given.
        """
        edits = self.options.edits(self.sizes)
        if of is not None:
            edits = np.where(np.isin(np.arange(len(edits)), of), edits, 0)
        lengths = self.options.run(self.sizes)
        layouts: list[tuple[int, int, int, np.ndarray, int, int]] = []
        for size in np.unique(self.sizes[edits > 0]).tolist():
            rows = np.flatnonzero((self.sizes == size) & (edits > 0))
            m, k = int(edits[rows[0]]) + 1, int(lengths[rows[0]])
            slack, at, done = size - m * k, 0, 0
            while done < m:
                own = min(WINDOWS, m - done)
                spare = slack * own // m
                layouts.append((k, own, spare, rows, at, done))
                at += own * k + spare
                done += own
        weights: dict[int, np.ndarray] = {}
        parts = []
        for k, m, spare, row, at, done in layouts:
            if k not in weights:
                h = self.runs(k)
                weights[k] = counts[(h % np.uint64(self.options.buckets)).astype(np.int64)] + (h >> np.uint64(11)) / 2.0**53
            base = self.starts[row] + at
            cost = weights[k][base[:, None] + np.arange(m * k + spare - k + 1)]
            best, back, steps = np.zeros((len(row), spare + 1)), [], np.arange(spare + 1)
            for j in range(m):
                sums = best + cost[:, j * k : j * k + spare + 1]
                best = np.minimum.accumulate(sums, axis=1)
                fresh = np.ones(sums.shape, bool)
                fresh[:, 1:] = sums[:, 1:] < best[:, :-1]
                back.append(np.maximum.accumulate(np.where(fresh, steps, 0), axis=1))
            used = np.full(len(row), spare)
            for j in range(m - 1, -1, -1):
                used = back[j][np.arange(len(row)), used]
                place = at + j * k + used
                parts.append((self.runs(k)[self.starts[row] + place], row, place, np.full(len(row), done + j)))
        if not parts:
            return np.zeros(0, np.uint64), *(np.zeros(0, np.int64) for _ in range(3))
        return tuple(np.concatenate(p) for p in zip(*parts))


class Index:
    """The runs of some texts, in the order of their hashes and places."""

    def __init__(self, texts: list[str], options: Winnowing):
        self.options, self.batch = options, Batch(np.zeros(len(texts), np.int64), texts, options)
        self.letters, self.pairs = character_sets(self.batch.joined, self.batch.starts), None
        self.tables: dict[tuple[int, bool], tuple] = {}
        self.weights: dict[int, np.ndarray] = {}

    def table(self, length: int, placed: bool):
        """(number of every bucket, width, stretch, ends, rows, places, sizes, characters to the end) of the runs of a length, of the texts of up to PLACED characters or beyond."""
        if (length, placed) not in self.tables:
            hashes, rows, places = self.batch.every_run(length)
            own = (self.batch.sizes[rows] <= PLACED) == placed
            bucket, rows, places = (hashes[own] & np.uint64(self.options.buckets - 1)).astype(np.int32), rows[own], places[own]
            del hashes, own
            if not placed:
                first = np.unique(bucket.astype(np.int64) * len(self.batch.sizes) + rows, return_index=True)[1]
                bucket, rows, places = bucket[first], rows[first], np.zeros(len(first), np.int64)
            used = np.bincount(bucket, minlength=self.options.buckets) > 0
            number = np.where(used, np.cumsum(used) - 1, -1).astype(np.int32)
            n, longest = int(used.sum()), int(places.max(initial=0)) + 1
            stretch = max(1, -(-longest * n // TABLE))
            width = -(-longest // stretch)
            key = number[bucket].astype(np.int64) * width + places // stretch
            order = np.argsort(key)
            ends = np.concatenate([[0], np.cumsum(np.bincount(key, minlength=n * width))]).astype(np.int32)
            rows, places = rows[order].astype(np.int32), places[order]
            kind, sizes = (np.int16 if placed else np.int32), self.batch.sizes[rows]
            self.tables[length, placed] = number, width, stretch, ends, rows, places.astype(kind), sizes.astype(kind), (sizes - places).astype(kind)
        return self.tables[length, placed]

    def counts(self, length: int) -> np.ndarray:
        """Numbers of the runs of a length by hash bucket."""
        out = np.zeros(self.options.buckets, np.int64)
        for placed in (True, False):
            number, width, _, ends, *_ = self.table(length, placed)
            used = np.flatnonzero(number >= 0)
            at = number[used].astype(np.int64) * width
            out[used] += ends[at + width] - ends[at]
        return out

    def near(self, other: Batch, equal_size: bool) -> tuple[np.ndarray, np.ndarray]:
        """(number in ``other``, number here) of pairs that share a run where near-equal texts may share it.

        Texts of ``other`` are the longer ones.  Some run that one keeps has at
        most as many edits before it as there are windows before it, and at most
        as many behind it as there are windows behind; that bounds how far it may
        move.
        """
        sizes, found = self.batch.sizes, [np.zeros(0, np.int64)]
        allowed, lengths, total = self.options.edits(other.sizes), self.options.run(other.sizes), len(sizes)
        letters = character_sets(other.joined, other.starts)
        for length in np.unique(lengths[allowed > 0]).tolist():
            own = np.flatnonzero((lengths == length) & (allowed > 0))
            if length not in self.weights:
                self.weights[length] = self.counts(length)
            hashes, rows, places, numbers = other.rarest_runs(self.weights[length], own)
            bucket = (hashes & np.uint64(self.options.buckets - 1)).astype(np.int64)
            edits = allowed[rows]
            for placed in (True, False):
                number, width, stretch, ends, their_rows, their_places, their_sizes, their_tails = self.table(length, placed)
                at = number[bucket].astype(np.int64)
                met = np.flatnonzero(at >= 0)
                if not placed and len(met):  # a run that a text keeps in many windows meets such texts once
                    met = met[np.unique(rows[met] * self.options.buckets + bucket[met], return_index=True)[1]]
                low = np.maximum(places[met] - numbers[met], 0) // stretch
                high = (places[met] + np.minimum(numbers[met], edits[met] - numbers[met])) // stretch
                if not placed:
                    low, high = np.zeros(len(met), np.int64), np.zeros(len(met), np.int64)
                begin = ends[at[met] * width + np.minimum(low, width)].astype(np.int64)
                counts = ends[at[met] * width + np.minimum(high + 1, width)] - begin
                met, begin, counts = met[counts > 0], begin[counts > 0], counts[counts > 0]
                # Bounds of the other text's size, of a run's place, and of the characters from there to the text's end.
                own, most, before = other.sizes[rows[met]], edits[met], numbers[met]
                tail = own - places[met]
                bounds = [(their_sizes, own - most, own - (0 if equal_size else 1))]
                if placed:
                    bounds.append((their_tails, tail - (most - before), tail + (most - before)))
                    if stretch > 1:
                        bounds.append((their_places, places[met] - before, places[met] + before))
                kind = their_sizes.dtype
                bounds = [(x, *(np.clip(b, -1, np.iinfo(kind).max).astype(kind) for b in both)) for x, *both in bounds]
                sums, shift, start = np.cumsum(counts), begin - (np.cumsum(counts) - counts), 0
                while start < len(met):
                    done = int(sums[start - 1]) if start else 0
                    stop = max(start + 1, int(np.searchsorted(sums, done + SEEDS, side="right")))
                    n = counts[start:stop]
                    seed = np.arange(done, int(sums[stop - 1])) + np.repeat(shift[start:stop], n)
                    good = np.ones(len(seed), bool)
                    for x, least, largest in bounds:
                        x = x[seed]
                        good &= (x >= np.repeat(least[start:stop], n)) & (x <= np.repeat(largest[start:stop], n))
                    pick = np.flatnonzero(good)
                    window = met[start + np.searchsorted(sums[start:stop], done + pick, side="right")]
                    row, theirs = rows[window], their_rows[seed[pick]].astype(np.int64)
                    start = stop
                    good = within(letters[row], self.letters[theirs], edits[window])
                    found.append(np.unique(row[good] * total + theirs[good]))
        both = np.unique(np.concatenate(found))
        row, theirs = both // max(total, 1), both % max(total, 1)
        if len(both):
            if self.pairs is None:
                self.pairs = pair_sets(self.batch)
            pairs = pair_sets(other)
            good = within(pairs[row], self.pairs[theirs], 2 * allowed[row])
            row, theirs = row[good], theirs[good]
        return row, theirs


def within(a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
    """Whether of two sets neither has more than so many members that the other lacks."""
    lacks = lambda x, y: sum(np.bitwise_count(x[:, k] & ~y[:, k]).astype(np.int16) for k in range(x.shape[1]))
    return (lacks(a, b) <= most) & (lacks(b, a) <= most)


def pair_sets(batch: Batch) -> np.ndarray:
    """The sets of all pairs of neighbouring characters, hashed to 256 bits; an edit changes two pairs at most."""
    out = np.zeros((len(batch.sizes), 4), np.uint64)
    hashes = batch.runs(2)
    inner = np.ones(len(hashes), bool)
    inner[batch.starts[1:] - 1] = False  # not across texts
    bit = hashes >> np.uint64(56)
    ones = np.where(inner, np.uint64(1) << (bit & np.uint64(63)), np.uint64(0))
    for word in range(4):
        out[:, word] = np.bitwise_or.reduceat(np.where(bit >> np.uint64(6) == word, ones, np.uint64(0)), batch.starts[:-1])
    return out


def copied(batch: pa.RecordBatch, begin: int, end: int) -> pa.RecordBatch:
    """Rows of a batch with memory of their own; texts have 64-bit offsets."""
    rows = batch.take(pa.array(np.arange(begin, end)))
    return rows.set_column(0, "text", rows.column("text").cast(pa.large_string()))


class Side:
    """The distinct texts of one side of a cell, in the order of their sizes."""

    def __init__(self, rows: list[pa.RecordBatch]):
        self.texts = pa.concat_arrays([x.column("text") for x in rows])
        code, copies = (np.concatenate([x.column(k).to_numpy() for x in rows]) for k in ("code", "copies"))
        rows.clear()
        sizes = pc.utf8_length(self.texts).to_numpy().astype(np.int64)
        order = np.lexsort((code, sizes))
        again = np.flatnonzero((sizes[order[1:]] == sizes[order[:-1]]) & (code[order[1:]] == code[order[:-1]])) + 1
        fresh = np.ones(len(order), bool)
        fresh[again] = pc.not_equal(self.texts.take(pa.array(order[again])), self.texts.take(pa.array(order[again - 1]))).to_numpy(zero_copy_only=False)
        first = np.flatnonzero(fresh)
        self.order, self.sizes, self.codes = order[first], sizes[order[first]], code[order[first]]
        self.copies = np.zeros(len(order), np.int64)
        self.copies[self.order] = np.add.reduceat(copies[order], first)
        pa.default_memory_pool().release_unused()

    def slices(self, begin: int, end: int, most: int) -> Iterator[tuple[int, int]]:
        """Bounds of stretches of texts with so many characters, or one text."""
        sums = np.cumsum(self.sizes[begin:end])
        at = begin
        while at < end:
            stop = begin + int(np.searchsorted(sums, (sums[at - begin - 1] if at > begin else 0) + most, side="right"))
            stop = min(max(stop, at + 1), end)
            yield at, stop
            at = stop

    def part(self, begin: int, end: int) -> list[str]:
        return self.texts.take(pa.array(self.order[begin:end])).to_pylist()


def equal_pairs(own: Side, other: Side) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Numbers of the texts that are equal."""
    by_code = np.argsort(own.codes, kind="stable")
    low, high = (np.searchsorted(own.codes[by_code], other.codes, side=x) for x in ("left", "right"))
    rows = np.repeat(np.arange(len(low)), high - low)
    theirs = by_code[np.arange(len(rows)) + np.repeat(low - (np.cumsum(high - low) - (high - low)), high - low)]
    for i in range(0, len(rows), 10_000):
        a, b = own.order[theirs[i : i + 10_000]], other.order[rows[i : i + 10_000]]
        same = pc.equal(own.texts.take(pa.array(a)), other.texts.take(pa.array(b))).to_numpy(zero_copy_only=False)
        yield a[same], b[same]


def near_pairs(shorter: Side, longer: Side, equal_size: bool, options: Winnowing) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Numbers of texts of both sides that may be near-equal; every pair once."""
    least = longer.sizes - options.edits(longer.sizes)  # sizes that a text may have beside each; they do not fall
    for a, b in shorter.slices(0, len(shorter.sizes), INDEXED):
        begin = int(np.searchsorted(longer.sizes, shorter.sizes[a], side="left" if equal_size else "right"))
        end = int(np.searchsorted(least, shorter.sizes[b - 1], side="right"))
        if begin >= end:
            continue
        index = Index(shorter.part(a, b), options)
        for c, d in longer.slices(begin, end, SLICE):
            rows, theirs = index.near(Batch(np.zeros(d - c, np.int64), longer.part(c, d), options), equal_size)
            yield shorter.order[a + theirs], longer.order[c + rows]


def characters(df: DataFrame, columns: list[str]) -> list[int]:
    """Number of characters of each column."""
    return [n or 0 for n in df.agg(*(F.sum(F.length(F.col(f"`{c}`").cast("string"))).alias(f"n{i}") for i, c in enumerate(columns))).first()]


def parts(own: int, other: int, options: Winnowing) -> tuple[int, int]:
    """In how many parts the sides are split; a cell holds its part of the first, and reads that of the second a chunk at a time."""
    limit = options.per_salt * 1000
    held = max(1, -(-own // limit))
    return held, max(1, -(-min(LEAST_CELLS, 1 + other // SPREAD) // held), -(-other // (4 * limit)))


def candidates(evaluation: DataFrame, training: DataFrame, split: list[tuple[int, int]], options: Winnowing) -> DataFrame:
    """(field, a, b, eval_copies, train_copies) of equal texts and of texts that may be near-equal.

    Both sides are (field, text, copies), ``split`` the numbers of their parts for each field.  A text goes by its hash to one part of its side, which meets all
    parts of the other side; a class is whole in its part.
    """
    cells = sum(a * b for a, b in split)
    number = lambda k: F.expr(f"element_at(array({', '.join(str(w[k]) for w in split)}), field + 1)")

    def dealt(texts: DataFrame, k: int) -> DataFrame:
        mine = F.pmod(F.xxhash64("text"), number(k)).cast("int")
        texts = texts.withColumn("__mine", mine).withColumn("__theirs", F.explode(F.sequence(F.lit(0), number(1 - k) - 1)))
        cell = ("__mine", "__theirs") if k == 0 else ("__theirs", "__mine")
        return texts.select("field", F.col(cell[0]).alias("__a"), F.col(cell[1]).alias("__b"), F.lit(k).alias("side"), "text", "copies")

    def pairs(own: Side, other: Side) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        yield from equal_pairs(own, other)
        for a, b in near_pairs(own, other, True, options):
            differ = pc.not_equal(own.texts.take(pa.array(a)), other.texts.take(pa.array(b))).to_numpy(zero_copy_only=False)
            yield a[differ], b[differ]
        for b, a in near_pairs(other, own, False, options):
            yield a, b

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Training texts come behind those of evaluation, in the order of their sizes, equal ones together.
        own, held, chars = None, [], 0

        def against(rows: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            other = Side(rows)
            for a, b in pairs(own, other):
                if len(a):
                    texts = (x.texts.take(pa.array(at)).cast(pa.string()) for x, at in ((own, a), (other, b)))
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(a), field, np.int32)), *texts, pa.array(own.copies[a]), pa.array(other.copies[b])], names=["field", "a", "b", "eval_copies", "train_copies"])

        for batch in batches:
            field, side = batch.column("field")[0].as_py(), batch.column("side").to_numpy()
            batch, first = batch.select(["text", "code", "copies"]), int(np.searchsorted(side, 1))
            if own is None:
                held += [copied(batch, 0, first)] * (first > 0)
                if first == len(side):
                    continue
                if not held:
                    return
                own, held = Side(held), []
            code = batch.column("code").to_numpy()
            cut = int(np.flatnonzero(np.append(True, code[1:] != code[:-1]))[-1])
            if chars > CHUNK and cut > first:
                yield from against([*held, copied(batch, first, cut)])
                held, chars, first = [], 0, cut
            held.append(copied(batch, first, len(side)))
            chars += pc.sum(pc.utf8_length(held[-1].column("text"))).as_py()
        if own is not None:
            yield from against(held)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, cell in groupby(by_cell(batches, keys), key=lambda x: x[0]):
            yield from meet(batch for _, batch in cell)

    keys = ["field", "__a", "__b"]
    both = dealt(evaluation, 0).unionAll(dealt(training, 1)).repartition(max(1, 2 * cells), *keys).withColumn("code", F.xxhash64("text"))
    return both.sortWithinPartitions(*keys, "side", F.length("text"), "code").mapInArrow(each, "field int, a string, b string, eval_copies long, train_copies long")


def by_cell(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[tuple, pa.RecordBatch]]:
    """Batches cut where a key changes, with the keys; read one at a time."""
    for batch in batches:
        columns = [batch.column(k).to_numpy() for k in keys]
        ends = np.flatnonzero(np.any([c[1:] != c[:-1] for c in columns], axis=0)) + 1
        for a, b in zip([0, *ends.tolist()], [*ends.tolist(), batch.num_rows]):
            if a < b:
                yield tuple(int(c[a]) for c in columns), batch.slice(a, b - a)


def character_sets(joined: str, starts: np.ndarray) -> np.ndarray:
    """Two words for each text: the set of its characters, hashed to 128 bits."""
    points = code_points(joined).astype(np.uint64)
    bit = (points * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(57)
    ones = np.uint64(1) << (bit & np.uint64(63))
    out = np.zeros((len(starts) - 1, 2), np.uint64)
    if len(points):
        for half in (0, 1):
            own = np.where(bit >> np.uint64(6) == half, ones, np.uint64(0))
            out[:, half] = np.bitwise_or.reduceat(own, np.minimum(starts[:-1], len(own) - 1))
        out[np.diff(starts) == 0] = 0
    return out


def edit_distance(a: str, b: str) -> int:
    """Levenshtein distance (bit-parallel)."""
    if not a or not b:
        return max(len(a), len(b))
    masks: dict[str, int] = {}
    for i, char in enumerate(a):
        masks[char] = masks.get(char, 0) | 1 << i
    full, top = (1 << len(a)) - 1, 1 << (len(a) - 1)
    plus, minus, distance = full, 0, len(a)
    for char in b:
        match = masks.get(char, 0)
        diagonal = (((match & plus) + plus) ^ plus) | match | minus
        up = minus | ~(diagonal | plus)
        down = plus & diagonal
        distance += bool(up & top) - bool(down & top)
        up = (up << 1) | 1
        plus = ((down << 1) | ~(diagonal | up)) & full
        minus = up & diagonal & full
    return distance


def chain(seeds: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest chain of collinear seeds, as ordered (place, place) pairs."""
    # Longest increasing subsequence; of one place the farther partners come first.
    seeds = sorted(set(seeds), key=lambda s: (s[0], -s[1]))
    tails: list[int] = []
    ends: list[int] = []
    back: list[int] = []
    for i, (_, q) in enumerate(seeds):
        at = bisect_left(tails, q)
        back.append(ends[at - 1] if at else -1)
        tails[at : at + 1] = [q]
        ends[at : at + 1] = [i]
    best: list[tuple[int, int]] = []
    i = ends[-1] if ends else -1
    while i >= 0:
        best.append(seeds[i])
        i = back[i]
    return best[::-1]


def extended(a: str, b: str, links: list[tuple[int, int]]) -> int:
    """Characters of ``a`` covered by a chain whose seeds grow while characters agree."""
    same = None
    covered = bytearray(len(a))
    for p, q in links:
        if covered[p] and q - p == same:  # the seed before grew over this one
            continue
        same, left, right = q - p, 0, 0
        while p - left > 0 and q - left > 0 and a[p - left - 1] == b[q - left - 1]:
            left += 1
        while p + right < len(a) and q + right < len(b) and a[p + right] == b[q + right]:
            right += 1
        covered[p - left : p + right] = b"\1" * (left + right)
    return sum(covered)


def common_runs(a: str, b: str, length: int) -> list[tuple[int, int]]:
    """Seeds of a pair: places of the runs that both hold; of one that a text repeats the first."""
    places: dict[str, int] = {}
    for q in range(len(b) - length, -1, -1):
        places[b[q : q + length]] = q
    return [(p, q) for p in range(len(a) - length + 1) if (q := places.get(a[p : p + length])) is not None]


def near_classes(evaluation: DataFrame, training: DataFrame, split: list[tuple[int, int]], options: Winnowing) -> DataFrame:
    """(field, eval_cls, train_cls, distance, coverage, eval_copies, train_copies) of equal and near-equal texts."""
    pairs = candidates(evaluation, training, split, options)
    # The banded distance in the JVM gives -1 beyond its bound; its cost is the
    # product of length and bound, so long texts go to the bit-parallel one.
    size = "greatest(length(a), length(b))"
    banded = f"case when a = b then 0 when {size} <= {LONG_TEXT} then levenshtein(a, b, cast(floor({options.distance} * {size} + 1e-9) as int)) end"
    near = pairs.withColumn("distance", F.expr(banded)).where("distance is null or distance >= 0")
    schema = "field int, eval_cls binary, train_cls binary, distance int, coverage double, eval_copies long, train_copies long"

    def cover(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            took, distances, coverages = [], [], []
            for i, (distance, a, b) in enumerate(zip(*(batch.column(k).to_pylist() for k in ("distance", "a", "b")))):
                distance = edit_distance(a, b) if distance is None else distance
                longest = max(len(a), len(b))
                if distance <= options.distance * longest + 1e-9:
                    took.append(i)
                    distances.append(distance)
                    coverages.append(extended(a, b, chain(common_runs(a, b, int(options.run(longest))))) / len(a) if distance else 1.0)
            rows = pa.array(took, pa.int64())
            taken = {k: batch.column(k).take(rows) for k in ("field", "eval_cls", "train_cls", "eval_copies", "train_copies")}
            taken |= {"distance": pa.array(distances, pa.int32()), "coverage": pa.array(coverages, pa.float64())}
            names = ["field", "eval_cls", "train_cls", "distance", "coverage", "eval_copies", "train_copies"]
            yield pa.RecordBatch.from_arrays([taken[k] for k in names], names=names)

    cls = lambda text: F.unhex(F.md5(text))
    return near.withColumns({"eval_cls": cls("a"), "train_cls": cls("b")}).mapInArrow(cover, schema)


@dataclass(frozen=True)
class Overlaps:
    """Links between classes of equal texts, and the records of the classes."""

    links: DataFrame  # field, eval_cls, train_cls, distance, coverage, eval_copies, train_copies
    eval_members: DataFrame  # field, cls, id
    train_members: DataFrame


def class_overlaps(
    evaluation: DataFrame, training: DataFrame, eval_key: str, train_key: str, eval_columns: list[str], train_columns: list[str], options: Winnowing = Winnowing()
) -> Overlaps:
    """The links between equal and near-equal texts, one row for each pair of
    classes with its numbers of copies, and membership beside them: copies are
    not expanded into pairs.  Null, empty and blank texts are in no class."""
    own, other = characters(evaluation, eval_columns), characters(training, train_columns)
    split = [parts(a, b, options) for a, b in zip(own, other)]
    near = near_classes(fold_texts(evaluation, eval_columns), fold_texts(training, train_columns), split, options)
    return Overlaps(checkpointed(near), fold_records(evaluation, eval_key, eval_columns), fold_records(training, train_key, train_columns))


def hot_slots(links: DataFrame, side: str) -> DataFrame:
    """(field, cls, slots) of the largest linked classes, a bounded table: over how many slots their members go."""
    classes = links.select("field", F.col(f"{side}_cls").alias("cls"), F.col(f"{side}_copies").alias("copies")).distinct()
    hot = classes.where(F.col("copies") > PER_SLOT).orderBy(F.desc("copies"), "field", "cls").limit(HOT_CLASSES)
    slots = (F.col("copies") / PER_SLOT).cast("int") + 1
    return F.broadcast(hot.select("field", F.col("cls").alias(f"{side}_cls"), slots.alias(f"{side}_slots")))


def find_overlaps(
    evaluation: DataFrame, training: DataFrame, eval_key: str, train_key: str, eval_columns: list[str], train_columns: list[str], options: Winnowing = Winnowing()
) -> DataFrame:
    """(eval_id, train_id, distance, coverage) of every pair of records that has
    equal or near-equal texts in some pair of columns.

    Blanks, punctuation and letter case aside, at most ``options.distance`` of
    the longer text's characters may need an edit; ``distance`` is the least
    over the columns, ``coverage`` the largest share of the evaluation text that
    the chain covers.  Null, empty and blank texts never match; repeated ids give
    one row; empty tables give none.
    """
    found = class_overlaps(evaluation, training, eval_key, train_key, eval_columns, train_columns, options)
    # Copies of one text may fill both splits: members of the largest classes go
    # to slots by their ids, and links to all slots of both classes.
    links, members = found.links.select("field", "eval_cls", "train_cls", "distance", "coverage"), {}
    for side, records in (("eval", found.eval_members), ("train", found.train_members)):
        hot = hot_slots(found.links, side)
        slots = F.coalesce(f"{side}_slots", F.lit(1))
        rows = records.select("field", F.col("cls").alias(f"{side}_cls"), F.col("id").alias(f"{side}_id")).join(hot, ["field", f"{side}_cls"], "left")
        members[side] = rows.select("field", f"{side}_cls", f"{side}_id", F.pmod(F.xxhash64(f"{side}_id"), slots).cast("int").alias(f"{side}_slot"))
        links = links.join(hot, ["field", f"{side}_cls"], "left").withColumn(f"{side}_slot", F.explode(F.sequence(F.lit(0), slots - 1))).drop(f"{side}_slots")
    pairs = links.join(members["eval"], ["field", "eval_cls", "eval_slot"]).join(members["train"], ["field", "train_cls", "train_slot"])
    return pairs.groupBy("eval_id", "train_id").agg(F.min("distance").alias("distance"), F.max("coverage").alias("coverage"))
