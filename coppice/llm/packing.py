"""Best-fit packing of token sequences, certified by dual-feasible functions.

Texts are encoded where they are read; their pieces are dealt evenly to bounded groups, so that
each holds a share of every source and length, and packed by best-fit decreasing. A dual-feasible function maps lengths so that no full sequence maps to more than
one, so the sum of the mapped lengths is a lower bound on the sequences of a group. A group
that meets the bound is done. Any other keeps its full sequences and hands the pieces of the
others over: those are dealt anew, so that groups exchange them, and packed again, until the
bound of all pieces is met, nothing is handed over, or a round saves no sequence.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coppice.llm.tables import Stored
from coppice.llm.text import released, text_slices

#: Pieces of a group, and rounds of exchange at most. Both bound work only; every piece is packed.
GROUP_PIECES, ROUNDS = 1 << 17, 8
#: Characters of the words a worker remembers; beyond that it starts afresh.
CACHE_CHARACTERS = 24 << 20
END_ID = 0
#: Dual-feasible functions of the second kind: k from 1 to this.
STEPS = 100
#: Bits of a sequence id: round, partition, group in the partition, sequence in the group.
_PARTITION_BITS, _GROUP_BITS, _BIN_BITS = 22, 16, 20

_PACKED = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long, done boolean"
_NAMES = [f.split()[0] for f in _PACKED.split(", ")]


class _Numbers(dict):
    """Words to numbers; a word that is asked for the first time gets the next one."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        self[word] = n = len(self)
        self.new.append(word)
        return n


class SpacedEncoder:
    """A vocabulary that drops white space, behind a dictionary of what stands between spaces.

    No token spans a space, and normalization stops at it, so each different word between two
    spaces goes through the library once.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.clear()

    def clear(self) -> None:
        self.number, self.held = _Numbers(), 0
        # No word holds a space, so a space stands for the end of a text.
        self.end = self.number[" "]
        self.number.new = []
        self.size, self.ids = np.ones(1, np.int64), np.array([END_ID], np.int32)

    def _learn(self) -> None:
        words = self.number.new
        if words:
            lists = [c.ids for c in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]
            self.size = np.concatenate((self.size, [len(i) for i in lists]))
            self.ids = np.concatenate((self.ids, *[np.array(i, np.int32) for i in lists]))
            self.held += sum(map(len, words))
            self.number.new = []

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, ``END_ID`` behind each, and n + 1 offsets."""
        if self.held > CACHE_CHARACTERS:
            self.clear()
        look, end = self.number.__getitem__, self.end
        index: list[int] = []
        stops = [0]
        for t in texts:
            if t:
                index.extend(map(look, t.split(" ")))
            index.append(end)
            stops.append(len(index))
        self._learn()
        index = np.array(index, np.int64)
        size = self.size[index]
        stop = np.cumsum(size)
        first = np.cumsum(self.size) - self.size
        at = np.arange(stop[-1] if len(stop) else 0) + np.repeat(first[index] - (stop - size), size)
        return self.ids[at], np.concatenate(([0], stop))[stops]


@lru_cache(maxsize=2)
def spaced_encoder(path: str) -> SpacedEncoder:
    return SpacedEncoder(path)


def cut_pieces(ids: np.ndarray, ends: np.ndarray, capacity: int) -> tuple[np.ndarray, ...]:
    """Document, number, start, length and crc32 of the pieces of each document."""
    size = np.diff(ends)
    n = -(-size // capacity)
    doc = np.repeat(np.arange(len(size)), n)
    piece = np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)
    start = piece * capacity
    length = np.minimum(size[doc] - start, capacity)
    raw = memoryview(np.ascontiguousarray(ids, "<u4")).cast("B")
    first = ends[:-1][doc] + start
    crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(first.tolist(), (first + length).tolist(), strict=True)]
    return doc, piece, start, length, np.array(crc, np.int64)


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sequence and offset of each piece by best-fit decreasing, and the room left in sequences.

    Pieces of one length are dealt together: the tightest sequences that can take one take as
    many as they can, which is what happens piece by piece.
    """
    order = np.argsort(-lengths, kind="stable")
    sizes, first = np.unique(-lengths[order], return_index=True)
    stops = np.append(first[1:], len(order))
    sequence, offset = np.empty(len(order), np.int64), np.empty(len(order), np.int64)
    waiting: dict[int, list[np.ndarray]] = {}
    mask, made = 0, 0  # bit r of mask: some sequence has room r

    def keep(room: int, which: np.ndarray) -> None:
        nonlocal mask
        if len(which):
            waiting.setdefault(room, []).append(which)
            mask |= 1 << room

    for size, at, stop in zip((-sizes).tolist(), first.tolist(), stops.tolist(), strict=True):
        while at < stop:
            fitting = mask >> size
            if fitting:
                room = size + (fitting & -fitting).bit_length() - 1
                which = np.concatenate(waiting.pop(room))
                mask &= ~(1 << room)
            else:
                room = capacity
                which = np.arange(made, made - (at - stop) // (capacity // size) + 1)
            each = room // size
            full = min(len(which), (stop - at) // each)
            taken = order[at : at + full * each]
            sequence[taken] = np.repeat(which[:full], each)
            offset[taken] = capacity - room + np.tile(np.arange(each) * size, full)
            at += full * each
            keep(room - each * size, which[:full])
            used = full
            rest = stop - at
            if used < len(which) and 0 < rest < each:
                taken = order[at:stop]
                sequence[taken], offset[taken] = which[used], capacity - room + np.arange(rest) * size
                keep(room - rest * size, which[used : used + 1])
                at, used = stop, used + 1
            if fitting:
                keep(room, which[used:])
            else:
                made += used
    room = np.zeros(made, np.int64)
    for r, some in waiting.items():
        room[np.concatenate(some)] = r
    return sequence, offset, room


def lower_bound(counts: np.ndarray, capacity: int) -> float:
    """Largest sum of dual-feasible functions over pieces; ``counts[x]`` pieces have length x.

    For a threshold t up to half the capacity, lengths above capacity - t count as one and those
    below t as nothing; for k, a length x counts as floor((k + 1) x / capacity) / k, or as
    itself where (k + 1) x / capacity is whole. No sequence holds lengths that map to more than
    one, so no packing takes fewer sequences. All sums are exact but for their last division.
    """
    counts = counts.astype(np.int64)
    length = np.arange(capacity + 1)
    above = np.concatenate((np.cumsum(counts[::-1])[::-1], [0]))  # pieces of at least that length
    mass = np.concatenate(([0], np.cumsum(counts * length)))  # total length below
    t = np.arange(capacity // 2 + 1)
    best = (above[capacity - t + 1] * capacity + mass[capacity - t + 1] - mass[t]).max() / capacity
    for k in range(1, STEPS + 1):
        scaled = (k + 1) * length
        value = np.where(scaled % capacity == 0, length * k, scaled // capacity * capacity)
        best = max(best, int((counts * value).sum()) / (capacity * k))
    return float(best)


def sequences_needed(bound: float) -> int:
    return int(np.ceil(bound - 1e-9))


def _packed_batch(columns: list[np.ndarray], capacity: int, base: int) -> pa.RecordBatch:
    """A group's pieces with sequence, offset, and whether the piece stays where it is."""
    lengths = columns[3]
    sequence, offset, room = best_fit(lengths, capacity)
    bound = lower_bound(np.bincount(lengths, minlength=capacity + 1), capacity)
    done = np.ones(len(lengths), bool) if len(room) - bound < 1e-9 else (room == 0)[sequence]
    arrays = [*columns, base + sequence, offset, done]
    fields = _PACKED.split(", ")
    types = {"long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_()}
    return pa.RecordBatch.from_arrays(
        [x if isinstance(x, pa.Array) else pa.array(x, types[f.split()[1]]) for x, f in zip(arrays, fields, strict=True)], names=_NAMES
    )


class _Groups:
    """Pieces of a task, packed whenever a group is full."""

    def __init__(self, round_: int, capacity: int):
        self.capacity, self.round, self.made = capacity, round_, 0
        self.held: list[list] = []
        self.n = 0

    def add(self, doc_ids: pa.Array, columns: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        self.held.append([doc_ids, *columns])
        self.n += len(doc_ids)
        if self.n >= GROUP_PIECES:
            yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        if not self.n:
            return
        ids, *columns = zip(*self.held, strict=True)
        part = TaskContext.get().partitionId()
        base = (((self.round << _PARTITION_BITS | part) << _GROUP_BITS) | self.made) << _BIN_BITS
        yield _packed_batch([pa.concat_arrays(ids), *map(np.concatenate, columns)], self.capacity, base)
        self.held, self.n, self.made = [], 0, self.made + 1


def document_pieces(docs: DataFrame, path: str, capacity: int, doc_id: str = "doc_id", text: str = "text") -> Stored:
    """Texts encoded and cut where they are read: doc_id, piece, start, length, ids_crc32."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))

    @released
    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = spaced_encoder(path)
        for batch in batches:
            for part, _, _ in text_slices(batch, "text"):
                ids, ends = encoder.encode([t or "" for t in part.column(1).to_pylist()])
                doc, piece, *others = cut_pieces(ids, ends, capacity)
                arrays = [part.column(0).take(pa.array(doc)), pa.array(piece, pa.int32()), *map(pa.array, others)]
                yield pa.RecordBatch.from_arrays(arrays, names=_NAMES[:5])

    return Stored(rows.mapInArrow(pieces, ", ".join(_PACKED.split(", ")[:5])), "pieces")


def repacking(open_: DataFrame, n: int, round_: int, capacity: int) -> Stored:
    """Pieces dealt evenly to groups, so that they meet others, and packed anew."""

    @released
    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups = _Groups(round_, capacity)
        for batch in batches:
            columns = [batch.column(i).to_numpy() for i in range(1, 5)]
            yield from groups.add(batch.column(0), columns)
        yield from groups.flush()

    dealt = open_.select(*_NAMES[:5]).repartition(max(1, -(-n // GROUP_PIECES)))
    return Stored(dealt.mapInArrow(packed, _PACKED), "packed")


@dataclass
class Packing:
    """Pieces in sequences, how many sequences there are, and how many any packing needs."""

    rows: DataFrame
    n_sequences: int
    needed: int


def _totals(rows: DataFrame) -> tuple[int, int]:
    """Sequences, and those that are done; each sequence has one piece at offset 0."""
    return tuple(rows.filter("offset = 0").agg(F.count(F.lit(1)), F.count_if(F.col("done"))).first())


def pack_documents(docs: DataFrame, path: str, capacity: int = 2048, doc_id: str = "doc_id", text: str = "text") -> Packing:
    """Whole texts as pieces of at most ``capacity`` ids, in as few sequences as can be found.

    ``path`` is a vocabulary of the tokenizers library that drops white space. A document is the
    ids of its text and ``END_ID``; null and empty texts are that one id. Only longer documents
    are cut, into pieces of ``capacity``, the last of which may be shorter. Rows of any id, null
    and repeated ones too, are documents of their own. Columns: doc_id, piece, start, length,
    ids_crc32, sequence_id (any numbers), offset. Other columns are not read. An empty table
    gives no rows.
    """
    pieces = document_pieces(docs, path, capacity, doc_id, text)
    counts = np.zeros(capacity + 1, np.int64)
    for r in pieces.df.groupBy("length").count().collect():  # at most capacity rows
        counts[r["length"]] = r["count"]
    needed = sequences_needed(lower_bound(counts, capacity))
    n_open = int(counts.sum())
    now = repacking(pieces.df, n_open, 0, capacity)
    n_sequences, n_done = _totals(now.df)
    kept, open_ = [now.df.filter("done")], now.df.filter("NOT done")
    open_sequences = n_sequences - n_done
    for round_ in range(1, ROUNDS):
        if n_open <= GROUP_PIECES or n_sequences == needed or not open_sequences:
            break
        n_open = open_.count()
        again = repacking(open_, n_open, round_, capacity)
        sequences, done = _totals(again.df)
        if sequences >= open_sequences:
            again.drop()
            break
        n_sequences -= open_sequences - sequences
        kept.append(again.df.filter("done"))
        open_, open_sequences = again.df.filter("NOT done"), sequences - done
    pieces.drop()
    rows = reduce(DataFrame.unionByName, [*kept, open_]).drop("done")
    return Packing(rows, n_sequences, needed)
