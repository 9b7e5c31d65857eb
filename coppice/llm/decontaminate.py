"""Benchmark decontamination by the q-gram lemma and banded alignment.

Texts are reduced to words in small letters. Windows of a benchmark item are its strings of
``WINDOW`` bytes from every start, and its runs of ``WORDS`` words where these are shorter. A
window that a document holds with at most ``e`` edits leaves ``length + 1 - q * (e + 1)`` of the window's q-grams
intact, on diagonals that differ by ``e`` at most. So hits of q-grams are counted in
overlapping bands of diagonals, bands below that bound are dropped, and the windows of the
others are compared, and aligned within the band if they differ.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructType

from coppice.llm.text import LOWER, flat, powers, prefix_hash, text_slices

#: Bytes of a q-gram; bytes of a window; edits per byte of a window.
Q, WINDOW, EDITS = 10, 100, 0.07
#: Words that are a window too, if they have fewer bytes than ``WINDOW``.
WORDS = 13
#: Items and windows of fewer bytes, once reduced to words, are too short to tell a leak from chance.
LEAST_BYTES = 32
#: Text of benchmark items in one index; more items take more indexes and passes.
INDEX_BYTES = 4 << 20
#: Pairs of places in texts and items that are held at once, and bytes by which blocks overlap:
#: several times what the hits of a window in a band span.
MOST_PAIRS, OVERLAP = 1 << 20, 512
_BITS = 22

_WORD = np.zeros(256, bool)
_WORD[list(range(48, 58)) + list(range(97, 123)) + list(range(128, 256))] = True


def reduced(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Small letters and digits with single spaces: bytes, their places, and offsets.

    A-Z and the Latin letters of two bytes that begin with 0xC3 become small; all other
    bytes from 0x80 on are letters.
    """
    small = LOWER[data]
    if len(data) > 1:
        accent = np.flatnonzero((data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)) + 1
        small[accent] += 32
    word = _WORD[small]
    small[~word] = 32
    keep = word.copy()
    keep[1:] |= word[:-1]
    first = offsets[:-1][np.diff(offsets) > 0]
    keep[first] = word[first]
    places = np.flatnonzero(keep)
    return small[places], places, np.searchsorted(places, offsets)


def _codes(data: np.ndarray) -> np.ndarray:
    sums = prefix_hash(data)
    n = max(len(data) - Q + 1, 0)
    return (sums[Q:] - sums[:n]) * powers(len(sums))[1][:n]


def _bound(lengths: np.ndarray) -> np.ndarray:
    """The q-grams of a window that its edits leave intact at least."""
    return lengths + 1 - Q * ((lengths * EDITS).astype(np.int64) + 1)


def _slot(codes: np.ndarray) -> np.ndarray:
    return (codes * np.uint64(0xFF51AFD7ED558CCD)) >> np.uint64(64 - _BITS)


@dataclass
class BenchmarkIndex:
    """Items as one byte array, and where each of their q-grams lies."""

    ids: list
    data: np.ndarray
    offsets: np.ndarray

    def __post_init__(self):
        codes = _codes(self.data)
        starts = np.arange(len(codes))
        item = np.searchsorted(self.offsets, starts, "right") - 1
        inside = starts + Q <= self.offsets[item + 1]
        codes, starts = codes[inside], starts[inside]
        order = np.argsort(codes, kind="stable")
        self.starts = starts[order]
        self.codes, first = np.unique(codes[order], return_index=True)
        self.first = np.append(first, len(order))
        #: Places of each q-gram, ascending, as one sorted array.
        self.stride = len(self.data) + 1
        self.keys = np.repeat(np.arange(len(self.codes)), np.diff(self.first)) * self.stride + self.starts
        self.seen = np.zeros(1 << _BITS, bool)
        self.seen[_slot(self.codes)] = True
        size = np.diff(self.offsets)
        self.window = np.minimum(size, WINDOW)
        self.edits = (self.window * EDITS).astype(np.int64)
        # The least bound of an item's windows: what no band below it can hold.
        self.bound = np.array([_bound(self.windows(i)[1]).min() for i in range(len(size))], np.int64)

    def windows(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        """Starts and lengths of all windows of an item."""
        first, last = int(self.offsets[i]), int(self.offsets[i + 1])
        starts = np.arange(first, last - self.window[i] + 1)
        lengths = np.full(len(starts), self.window[i])
        space = np.flatnonzero(self.data[first:last] == 32) + first
        heads = np.concatenate(([first], space + 1))
        stops = np.append(space, last)
        heads, stops = heads[heads < last], stops[: np.count_nonzero(heads < last)]
        if len(heads) >= WORDS:
            end = np.maximum(np.arange(len(heads)) + WORDS - 1, np.searchsorted(stops, heads + LEAST_BYTES))
            heads, end = heads[end < len(stops)], end[end < len(stops)]
            size = stops[end] - heads
            starts, lengths = np.append(starts, heads[size < WINDOW]), np.append(lengths, size[size < WINDOW])
        return starts, lengths

    @classmethod
    def of(cls, ids: list, texts: list) -> BenchmarkIndex:
        data, _, offsets = reduced(*flat(pa.array([t or "" for t in texts], pa.string())))
        size = np.diff(offsets)
        keep = np.flatnonzero(size >= LEAST_BYTES)
        parts = [data[offsets[i] : offsets[i + 1]] for i in keep]
        ends = np.concatenate(([0], np.cumsum(size[keep]))).astype(np.int64)
        return cls([ids[i] for i in keep], np.concatenate(parts) if parts else np.zeros(0, np.uint8), ends)

    def hits(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of q-grams in the texts, ascending, and which q-grams of the items they are."""
        codes = _codes(data)
        at = np.flatnonzero(self.seen[_slot(codes)])
        found = np.searchsorted(self.codes, codes[at])
        found[found == len(self.codes)] = 0
        good = self.codes[found] == codes[at] if len(self.codes) else np.zeros(len(at), bool)
        at, found = at[good], found[good]
        doc = np.searchsorted(offsets, at, "right") - 1
        inside = at + Q <= offsets[doc + 1]
        return at[inside], found[inside]

    def _blocks(self, at: np.ndarray, found: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
        """Ranges of hits and of item places with at most ``MOST_PAIRS`` pairs each, or too short to cut.

        Neighbours overlap by more than the hits of a window in a band can span, so one block
        has all of them.
        """
        whole = len(self.data)
        upto = np.concatenate(([0], np.cumsum(self.first[found + 1] - self.first[found]))) if len(at) else np.zeros(1, np.int64)
        waiting = [(0, len(at))]
        while waiting:
            low, high = waiting.pop()
            if upto[high] - upto[low] <= MOST_PAIRS:
                if high > low:
                    yield low, high, 0, whole
            elif at[high - 1] - at[low] > 2 * OVERLAP:
                middle = (at[low] + at[high - 1]) // 2
                waiting.append((low, int(np.searchsorted(at, middle + OVERLAP // 2))))
                waiting.append((int(np.searchsorted(at, middle - OVERLAP // 2)), high))
            else:
                for start in range(0, whole, OVERLAP):
                    yield low, high, start, min(start + 2 * OVERLAP, whole)

    def matches(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Verified regions: document, item, start, stop (of ``data``), edits; merged.

        Texts that repeat what an item repeats too have very many pairs of places; those are
        gone through in blocks, so memory stays bounded.
        """
        at, found = self.hits(data, offsets)
        parts = [np.zeros((0, 5), np.int64)]
        for low, high, start, stop in self._blocks(at, found):
            first = np.searchsorted(self.keys, found[low:high] * self.stride + start)
            many = np.searchsorted(self.keys, found[low:high] * self.stride + stop) - first
            ends = np.cumsum(many)
            step = np.arange(ends[-1]) - np.repeat(ends - many, many)
            parts.append(self._regions(data, offsets, np.repeat(at[low:high], many), self.starts[np.repeat(first, many) + step]))
        return self._merged(np.concatenate(parts)) if len(parts) > 2 else parts[-1]

    def _regions(self, data: np.ndarray, offsets: np.ndarray, at: np.ndarray, place: np.ndarray) -> np.ndarray:
        """The same for pairs of places in the texts and in the items."""
        none = np.zeros((0, 5), np.int64)
        if not len(at):
            return none
        doc = np.searchsorted(offsets, at, "right") - 1
        item = np.searchsorted(self.offsets, place, "right") - 1
        diagonal = at - place + len(self.data)
        width = np.maximum(self.edits[item], 1)
        # Band b covers the diagonals of two steps, so every diagonal lies in two bands.
        band = np.concatenate((diagonal // width, diagonal // width - 1))
        doc, item, place, diagonal = (np.tile(x, 2) for x in (doc, item, place, diagonal))
        order = np.lexsort((place, band, item, doc))
        doc, item, band, place, diagonal = (x[order] for x in (doc, item, band, place, diagonal))
        new = np.ones(len(doc), bool)
        new[1:] = (doc[1:] != doc[:-1]) | (item[1:] != item[:-1]) | (band[1:] != band[:-1])
        heads = np.flatnonzero(new)
        ends = np.append(heads[1:], len(doc))
        enough = ends - heads >= self.bound[item[heads]]
        rows, held, held_item = [], (), -1
        for low, high in zip(heads[enough], ends[enough], strict=True):
            i = item[low]
            if i != held_item:
                held, held_item = self.windows(i), i
            starts, lengths = held
            # Hits of the band inside each window, against its bound once more.
            before = np.searchsorted(place[low:high], starts)
            inside = np.searchsorted(place[low:high], starts + lengths - Q, "right") - before
            good = inside >= np.maximum(_bound(lengths), 1)
            if good.any():
                middle = diagonal[low + before[good] + inside[good] // 2]
                s = starts[good]
                lowest = band[low] * max(self.edits[i], 1)
                rows.append(np.stack([np.full_like(s, doc[low]), np.full_like(s, i), s, lengths[good], np.full_like(s, lowest), middle], axis=1))
        if not rows:
            return none
        rows = np.concatenate(rows)
        rows[:, 4:] -= len(self.data)
        return self._merged(np.concatenate([self._verified(data, offsets, rows[k : k + 4096]) for k in range(0, len(rows), 4096)]))

    def _verified(self, data: np.ndarray, offsets: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """Rows of (document, item, window, length, lowest diagonal, likely diagonal) that hold within the edits."""
        rows = rows[np.argsort(-rows[:, 3], kind="stable")]
        doc, item, window, length, _, likely = rows.T
        start = window + likely
        same = (start >= offsets[doc]) & (start + length <= offsets[doc + 1])
        lanes = np.arange(length.max())
        beyond = lanes >= length[:, None]
        column, place = np.clip(start[:, None] + lanes, 0, len(data) - 1), np.minimum(window[:, None] + lanes, len(self.data) - 1)
        same &= (beyond | (data[column] == self.data[place])).all(axis=1)
        exact = np.stack([doc, item, start, start + length, np.zeros_like(doc)], axis=1)[same]
        return np.concatenate((exact, self._aligned(data, offsets, rows[~same]))) if not same.all() else exact

    def _aligned(self, data: np.ndarray, offsets: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """The same of rows in falling order of length, by alignment in the band."""
        doc, item, window, length, diagonal, _ = rows.T
        edits = (length * EDITS).astype(np.int64)
        low = window + diagonal - edits
        # The band of the item and what the edits may leave it by; of short windows more.
        span = int((2 * np.maximum(self.edits[item], 1) + 2 * edits).max()) + 1
        lanes = np.arange(span)
        steps = lanes.astype(np.int16)
        cost = np.zeros((len(rows), span), np.int16)
        first, last = offsets[doc][:, None], offsets[doc + 1][:, None]
        for i in range(length[0]):
            n = np.searchsorted(-length, -i)
            column = low[:n, None] + i + lanes
            inside = (column >= first[:n]) & (column < last[:n])
            other = np.where(inside, data[np.clip(column, 0, len(data) - 1)], 0)
            best = cost[:n] + (other != self.data[window[:n] + i][:, None])
            best[:, :-1] = np.minimum(best[:, :-1], cost[:n, 1:] + np.int16(1))
            cost[:n] = np.minimum.accumulate(best - steps, axis=1) + steps
        lane = cost.argmin(axis=1)
        least = cost[np.arange(len(rows)), lane]
        stop = np.minimum(low + length + lane, last[:, 0])
        start = np.maximum(stop - length, first[:, 0])
        return np.stack([doc, item, start, stop, least], axis=1)[least <= edits]

    @staticmethod
    def _merged(rows: np.ndarray) -> np.ndarray:
        """Overlapping regions of one document and item as one, with their least edits."""
        rows = rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))]
        out: list[list[int]] = []
        for r in rows.tolist():
            if out and out[-1][:2] == r[:2] and r[2] <= out[-1][3]:
                out[-1][3], out[-1][4] = max(out[-1][3], r[3]), min(out[-1][4], r[4])
            else:
                out.append(r)
        return np.array(out, np.int64).reshape(-1, 5)


def benchmark_indexes(benchmark: DataFrame) -> list[BenchmarkIndex]:
    """Indexes over all items; each holds about ``INDEX_BYTES``, so more items mean more."""
    sized = benchmark.select(F.col("item_id").alias("item"), "text")
    total = sized.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = -(-total // INDEX_BYTES) or 1
    part = F.pmod(F.xxhash64("item", "text"), F.lit(parts))
    out = []
    for p in range(parts):
        rows = sized.filter(part == p).orderBy("item", "text").collect()
        out.append(BenchmarkIndex.of([r["item"] for r in rows], [r["text"] for r in rows]))
    return out


def find_leaks(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each region of a document that holds a passage of a benchmark item.

    Returns doc_id, item_id, start and stop (bytes of the text, the start up to the allowed
    edits off) and edits of the best window. A leak is any ``WINDOW`` bytes of an item, any
    ``WORDS`` words that are shorter (with the words after them that ``LEAST_BYTES`` need),
    or a whole shorter item, with up to ``EDITS`` edits per byte. Null and empty texts and items
    and items of fewer than ``LEAST_BYTES`` have none; repeated rows and items are reported
    each; ids pass as they are. Texts are searched whole.
    """
    context = docs.sparkSession.sparkContext
    docs = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    schema = StructType([docs.schema["doc_id"], benchmark.schema["item_id"]])
    schema = schema.add("start", "long").add("stop", "long").add("edits", "integer")
    kind = to_arrow_type(schema["item_id"].dataType)
    out = None
    for index in benchmark_indexes(benchmark):
        shared = context.broadcast(index)

        def found(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part, data, offsets in text_slices(batch, "text"):
                    words, places, ends = reduced(data, offsets)
                    m = shared.value.matches(words, ends)
                    if len(m):
                        begin = offsets[m[:, 0]]
                        yield pa.RecordBatch.from_arrays(
                            [
                                part.column(0).take(pa.array(m[:, 0])),
                                pa.array([shared.value.ids[i] for i in m[:, 1]], kind),
                                pa.array(places[m[:, 2]] - begin),
                                pa.array(places[m[:, 3] - 1] + 1 - begin),
                                pa.array(m[:, 4].astype(np.int32)),
                            ],
                            names=["doc_id", "item_id", "start", "stop", "edits"],
                        )

        one = docs.mapInArrow(found, schema)
        out = one if out is None else out.unionByName(one)
    return out


def without_leaks(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """The rows whose text holds no passage of a benchmark item, as they are."""
    context = docs.sparkSession.sparkContext
    for index in benchmark_indexes(benchmark):
        shared = context.broadcast(index)

        def clean(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part, data, offsets in text_slices(batch, text):
                    words, _, ends = reduced(data, offsets)
                    keep = np.ones(part.num_rows, bool)
                    keep[shared.value.matches(words, ends)[:, 0]] = False
                    yield part.filter(pa.array(keep))

        docs = docs.mapInArrow(clean, docs.schema)
    return docs
