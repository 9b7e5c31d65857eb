"""Tokens of two tokenizers aligned on the bytes they share, by coalescing intervals.

A text is cut before every space that follows a character other than white space; both
tokenizers end a token there, so each different unit is aligned once and remembered. The
tokens of new units, of both sides, are sorted by start; where a start reaches the running
maximum of all ends before it, a group ends. Within a group every token of one side is linked
with every token of the other, as pairs of ids with the number of their occurrences.
"""

from __future__ import annotations

import hashlib
import itertools
import os
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coppice.llm.tables import Stored
from coppice.llm.text import list_array, released, text_slices

#: Characters of the units a worker remembers; beyond that it forgets those it met once.
CACHE_CHARACTERS = 6 << 20
#: Pairs of ids that are sent to every executor at most; more are joined by a shuffle.
BROADCAST_PAIRS = 1 << 21

_CUT = re.compile(r"(?<=\S)(?= )")
_ROWS = (
    "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
    "pairs array<struct<pair: long, n: long>>"
)


def places(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """``start, start + 1, ...`` of each run, one after the other."""
    stop = np.cumsum(size)
    return np.arange(stop[-1] if len(stop) else 0) + np.repeat(start - (stop - size), size)


def byte_level_characters() -> dict[str, int]:
    """The byte behind each character of a byte-level vocabulary.

    Printable bytes stand for themselves, the others follow from character 256 on.
    """
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


class _Vocabulary:
    """Bytes of all entries, one after the other."""

    def __init__(self, entries: list[bytes]):
        self.size = np.array([len(e) for e in entries], np.int64)
        self.start = np.cumsum(self.size) - self.size
        self.joined = np.frombuffer(b"".join(entries), np.uint8)

    def spelled(self, ids: np.ndarray) -> np.ndarray:
        return self.joined[places(self.start[ids], self.size[ids])]


def _flat(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    counts = np.array([len(x) for x in lists], np.int64)
    return np.fromiter(itertools.chain.from_iterable(lists), np.int64, int(counts.sum())), counts


def coalesce(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of intervals by start, and the group of each in that order.

    A group breaks where a start reaches the largest end before it.
    """
    order = np.lexsort((ends, starts))
    reached = np.maximum.accumulate(ends[order])
    fresh = np.ones(len(order), bool)
    fresh[1:] = starts[order][1:] >= reached[:-1]
    return order, np.cumsum(fresh) - 1


def _id_counts(group: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct ids of each group and their number of occurrences, by group."""
    order = np.lexsort((ids, group))
    group, ids = group[order], ids[order]
    fresh = np.ones(len(ids), bool)
    fresh[1:] = (group[1:] != group[:-1]) | (ids[1:] != ids[:-1])
    first = np.flatnonzero(fresh)
    return group[first], ids[first], np.diff(np.append(first, len(ids)))


def _sums(owner: np.ndarray, pair: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Occurrences of each pair of an owner, in order of both."""
    order = np.lexsort((pair, owner))
    owner, pair = owner[order], pair[order]
    fresh = np.ones(len(pair), bool)
    fresh[1:] = (owner[1:] != owner[:-1]) | (pair[1:] != pair[:-1])
    first = np.flatnonzero(fresh)
    return owner[first], pair[first], np.add.reduceat(n[order], first) if len(first) else n[:0]


class _Numbers(dict):
    """Units to numbers; a unit that is asked for the first time gets the next one."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, unit: str) -> int:
        self[unit] = n = len(self)
        self.new.append(unit)
        return n


class Aligner:
    """Two tokenizers and the alignment of the units seen so far."""

    def __init__(self, a_path: str, b_path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        names = [self.a.id_to_token(i) or "" for i in range(self.a.get_vocab_size())]
        values = byte_level_characters()
        self.a_bytes = _Vocabulary([bytes(values.get(c, 0x3F) for c in name) for name in names])
        pieces = range(self.b.get_piece_size())
        names = [self.b.id_to_piece(i) for i in pieces]
        self.b_bytes = _Vocabulary(
            [bytes([int(name[1:-1], 16)]) if self.b.is_byte(i) else name.replace("▁", " ").encode() for i, name in enumerate(names)]
        )
        self.names = [str(i) for i in range(max(self.a.get_vocab_size(), len(pieces)))]
        self.clear()

    def clear(self) -> None:
        self.number, self.held = _Numbers(), 0
        self.strings: list[str] = []
        self.good = np.zeros(0, bool)
        #: Of each unit: tokens of A, tokens of B, groups, links, place and number of its pairs.
        self.counts = np.zeros((0, 6), np.int64)
        self.pair, self.pair_n = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.uses = np.zeros(0, np.int64)

    def _forget(self) -> None:
        """Keep the units met more than once, unless even they take over half of the room."""
        units = [u for u, n in zip(self.number, self.uses.tolist(), strict=True) if n > 1]
        if 2 * sum(map(len, units)) > CACHE_CHARACTERS:
            self.clear()
            return
        kept = np.flatnonzero(self.uses > 1)
        self.number, self.held = _Numbers(), sum(map(len, units))
        self.number.update(zip(units, range(len(units)), strict=True))
        self.strings = [self.strings[i] for i in kept.tolist()]
        self.good, self.counts, self.uses = self.good[kept], self.counts[kept], self.uses[kept]
        at = places(self.counts[:, 4], self.counts[:, 5])
        self.pair, self.pair_n = self.pair[at], self.pair_n[at]
        self.counts[:, 4] = np.cumsum(self.counts[:, 5]) - self.counts[:, 5]

    def _pieces(self, units: list[str]) -> list[list[int]]:
        """B's pieces of units; the library itself puts a space before a text, but not before none."""
        out = self.b.encode([u[1:] for u in units], num_threads=1)
        blank = [i for i, u in enumerate(units) if len(u) == 1]
        if blank:
            alone = self.b.encode("a")
            for i in blank:
                out[i] = self.b.encode("a" + units[i])[len(alone) :]
        return out

    def _learn(self) -> None:
        units = self.number.new
        if not units:
            return
        raw = [u.encode() for u in units]
        size = np.array([len(r) for r in raw], np.int64)
        first = np.cumsum(size) - size
        data = np.frombuffer(b"".join(raw), np.uint8)
        coded = self.a.encode_batch_fast(units, add_special_tokens=False)
        good = np.ones(len(units), bool)
        sides = []
        for vocabulary, lists in ((self.a_bytes, [c.ids for c in coded]), (self.b_bytes, self._pieces(units))):
            ids, counts = _flat(lists)
            length = vocabulary.size[ids]
            spelled = np.bincount(np.repeat(np.arange(len(units)), counts), length, len(units)).astype(np.int64)
            same = spelled == size
            begin = np.cumsum(spelled) - spelled
            which = np.flatnonzero(same)
            differ = data[places(first[which], size[which])] != vocabulary.spelled(ids)[places(begin[which], size[which])]
            same[np.repeat(which, size[which])[differ]] = False
            good &= same
            sides.append((ids, counts, length, begin))
        self._align(sides, good, first)
        self.held += sum(map(len, units))
        self.number.new = []

    def _align(self, sides: list, good: np.ndarray, first: np.ndarray) -> None:
        """Groups, links and the text of the groups of new units."""
        n = len(good)
        starts, ends, ids, owners, side = [], [], [], [], []
        counts = np.zeros((n, 6), np.int64)
        for s, (token, number, length, begin) in enumerate(sides):
            owner = np.repeat(np.arange(n), number)
            start = np.cumsum(length) - length - begin[owner] + first[owner]
            kept = good[owner]
            starts.append(start[kept])
            ends.append((start + length)[kept])
            ids.append(token[kept])
            owners.append(owner[kept])
            side.append(np.full(int(kept.sum()), s))
            counts[:, s] = np.where(good, number, 0)
        start, end, token, owner, side = map(np.concatenate, (starts, ends, ids, owners, side))
        order, group = coalesce(start, end)
        token, owner, side = token[order], owner[order], side[order]
        if len(token):
            last = np.append(np.flatnonzero(np.diff(group)), len(group) - 1)
            counts[:, 2] = np.bincount(owner[last], minlength=n)
        # Each id of one side with each of the other, once, with the product of their numbers.
        a_group, a_id, a_n = _id_counts(group[side == 0], token[side == 0])
        b_group, b_id, b_n = _id_counts(group[side == 1], token[side == 1])
        b_first = np.searchsorted(b_group, a_group, "left")
        partners = np.searchsorted(b_group, a_group, "right") - b_first
        mine, theirs = np.repeat(np.arange(len(a_id)), partners), places(b_first, partners)
        group_owner = owner[np.searchsorted(group, a_group)] if len(group) else a_group
        unit, pair, each = _sums(group_owner[mine], (a_id[mine] << 32) | b_id[theirs], a_n[mine] * b_n[theirs])
        counts[:, 3] = np.bincount(unit, each, n).astype(np.int64)
        counts[:, 5] = np.bincount(unit, minlength=n)
        counts[:, 4] = len(self.pair) + np.cumsum(counts[:, 5]) - counts[:, 5]
        self.counts = np.concatenate((self.counts, counts))
        self.pair, self.pair_n = np.concatenate((self.pair, pair)), np.concatenate((self.pair_n, each))
        self.good = np.concatenate((self.good, good))
        # A's ids, then B's, group by group; the order by start stays within a side.
        order = np.lexsort((np.arange(len(token)), side, group))
        token, owner, side, group = token[order], owner[order], side[order], group[order]
        sign = np.full(len(token), 3)
        sign[:-1] = np.where(owner[1:] != owner[:-1], 3, np.where(group[1:] != group[:-1], 2, side[1:] - side[:-1]))
        names, marks = self.names, (",", "|", ";", "")
        parts = [names[t] + marks[m] for t, m in zip(token.tolist(), sign.tolist(), strict=True)]
        stops = np.cumsum(np.bincount(owner, minlength=n)).tolist()
        self.strings += ["".join(parts[a:b]) for a, b in zip([0, *stops], stops, strict=False)]

    def align(self, texts: list[str]) -> tuple[np.ndarray, list[str], np.ndarray, np.ndarray, np.ndarray]:
        """Counts (tokens of A and B, groups, links) and digest of each text; then the text, pair and number of links."""
        if self.held > CACHE_CHARACTERS:
            self._forget()
        look = self.number.__getitem__
        index: list[int] = []
        stops = [0]
        for t in texts:
            if t:
                index.extend(map(look, _CUT.split(" " + t)))
            stops.append(len(index))
        self._learn()
        unit = np.array(index, np.int64)
        number = np.diff(stops)
        met = np.bincount(unit, minlength=len(self.good))
        met[: len(self.uses)] += self.uses
        self.uses = met
        owner = np.repeat(np.arange(len(texts)), number)
        whole = np.bincount(owner[~self.good[unit]], minlength=len(texts)) == 0
        strings = self.strings
        digests = []
        for i, (a, b) in enumerate(zip(stops[:-1], stops[1:], strict=True)):
            told = ";".join([strings[u] for u in index[a:b]]) if b > a and whole[i] else ""
            digests.append(hashlib.sha256(told.encode()).hexdigest() if told else "")
        used = whole[owner]
        unit, owner = unit[used], owner[used]
        counts = np.stack([np.bincount(owner, self.counts[unit, c], len(texts)).astype(np.int64) for c in range(4)], axis=1)
        doc, unit, times = _id_counts(owner, unit)
        sizes = self.counts[unit, 5]
        at = places(self.counts[unit, 4], sizes)
        return counts, digests, *_sums(np.repeat(doc, sizes), self.pair[at], self.pair_n[at] * np.repeat(times, sizes))


@lru_cache(maxsize=2)
def aligner(a_path: str, b_path: str) -> Aligner:
    return Aligner(a_path, b_path)


def align_tokens(docs: DataFrame, a_path: str, b_path: str, doc_id: str = "doc_id", text: str = "text") -> Stored:
    """Every whole text aligned: counts, digest of its groups, and its linked pairs of ids.

    ``a_path`` is a byte-level vocabulary of the tokenizers library, ``b_path`` a SentencePiece
    model with byte fallback that puts a space before a text; A gets the space with the text.
    Strings of special tokens are plain text. A row each, whatever its id is (also null or
    repeated); null and empty texts, and those whose joined tokens of a side do not spell the
    space and the text (as with U+2581 in a text), have zeros, no pairs and an empty digest.
    ``pair`` is the id of A times 2**32 plus that of B, ``n`` how many token occurrences it
    links; a group's ids are counted before they meet, so a group of many tokens makes no more
    pairs than it has different ids. Other columns are not stored.
    """
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")
    )
    names = [f.strip().split()[0] for f in _ROWS.split(", ")][:7] + ["pairs"]

    @released
    def aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = aligner(a_path, b_path)
        for batch in batches:
            for part, _, _ in text_slices(batch, "text"):
                counts, digests, doc, pair, n = held.align([t or "" for t in part.column(2).to_pylist()])
                ends = np.concatenate(([0], np.cumsum(np.bincount(doc, minlength=part.num_rows))))
                links = pa.StructArray.from_arrays([pa.array(pair), pa.array(n)], ["pair", "n"])
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:2], *[pa.array(c) for c in counts.T], pa.array(digests, pa.string()), list_array(links, ends)],
                    names=names,
                )

    return Stored(rows.mapInArrow(aligned, _ROWS), "aligned")


def pair_counts(aligned: DataFrame) -> Stored:
    """How many rows hold each pair, and whether no other pair of its id of A has more."""
    counted = Stored(aligned.select(F.inline("pairs")).groupBy("pair").agg(F.count(F.lit(1)).alias("n_docs")), "pairs")
    first = F.shiftright("pair", 32)
    most = counted.df.groupBy(first.alias("a")).agg(F.max("n_docs").alias("most"))
    judged = counted.df.withColumn("a", first).join(most, "a")
    out = Stored(judged.select("pair", "n_docs", (F.col("n_docs") == F.col("most")).alias("best")), "pairs")
    counted.drop()
    return out


def link_counts(aligned: DataFrame) -> DataFrame:
    """``aligned`` without its pairs, with n_best and count_sum of its links.

    n_best counts the links whose pair is held by as many rows as any pair of that id of A;
    count_sum adds up the rows that hold the pair, over links. The table of pairs goes to all
    executors if it has at most ``BROADCAST_PAIRS`` rows, else Spark joins it by a shuffle.
    """
    pairs = pair_counts(aligned).df
    if pairs.count() <= BROADCAST_PAIRS:
        pairs = F.broadcast(pairs)
    sums = (
        aligned.select("row", F.inline("pairs"))
        .join(pairs, "pair")
        .groupBy("row")
        .agg(
            F.sum(F.when(F.col("best"), F.col("n")).otherwise(0)).alias("n_best"),
            F.sum(F.col("n") * F.col("n_docs")).alias("count_sum"),
        )
    )
    rest = [c for c in aligned.columns if c not in ("row", "pairs")]
    zero = F.lit(0).cast("long")
    return aligned.drop("pairs").join(sums, "row", "left").select(
        *rest, F.coalesce("n_best", zero).alias("n_best"), F.coalesce("count_sum", zero).alias("count_sum")
    )
