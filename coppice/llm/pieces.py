"""SentencePiece (merge type) encoding with seeded dropout, and its decoding.

A text is cut at its spaces; within such a unit, the agenda holds the pairs of neighbouring
pieces that form a piece, best score first, leftmost first among equals. Each candidate is
skipped for good if a hash of the seed, the document and the candidate's place says so;
without dropout the result is the model's own. Units of one length are merged side by side
in numpy, one merge of each per round; long units take a heap.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

from coppice.llm.tables import free_name
from coppice.llm.text import list_array, mix, text_slices

#: Units of more characters go through the heap.
LONG_UNIT = 48
_SPACE, _MARK = 0x20, 0x2581
_TABLE_BITS = 20
_NEVER = np.int32(2**31 - 1)


class PieceModel:
    """Pieces of a model file as tables: characters, mergeable pairs, bytes of pieces."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        names = [model.id_to_piece(i) for i in range(n)]
        plain = [not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i)) for i in range(n)]
        ids = {names[i]: i for i in range(n) if plain[i]}
        scores = np.array([model.get_score(i) for i in range(n)])
        self.rank = np.unique(-scores, return_inverse=True)[1].astype(np.int32)
        self.byte_ids = np.zeros(256, np.int32)
        self.bytes = [b""] * n
        for i in range(n):
            if model.is_byte(i):
                value = int(names[i][1:-1], 16)
                self.byte_ids[value], self.bytes[i] = i, bytes([value])
            elif plain[i]:
                self.bytes[i] = names[i].replace(chr(_MARK), " ").encode()
        #: Characters without a piece stand as -1 and become bytes at the end.
        self.characters = np.full(0x110000, -1, np.int32)
        for name, i in ids.items():
            if len(name) == 1:
                self.characters[_SPACE if ord(name) == _MARK else ord(name)] = i
        self.size = np.array([len(b) for b in self.bytes])
        self.place = np.concatenate(([0], np.cumsum(self.size)[:-1]))
        self.joined = np.frombuffer(b"".join(self.bytes), np.uint8)
        pairs = {}
        for name, i in ids.items():
            for cut in range(1, len(name)):
                left, right = ids.get(name[:cut]), ids.get(name[cut:])
                if left is not None and right is not None:
                    pairs[(left << 32) | right] = i
        self._keys = np.full((1 << _TABLE_BITS) + 64, -1, np.int64)
        self._values = np.zeros((1 << _TABLE_BITS) + 64, np.int32)
        self._probes = 1
        for key, slot in zip(pairs, self._slot(np.array(list(pairs), np.int64)).tolist(), strict=True):
            probe = 0
            while self._keys[slot + probe] != -1:
                probe += 1
            self._keys[slot + probe], self._values[slot + probe] = key, pairs[key]
            self._probes = max(self._probes, probe + 1)

    @staticmethod
    def _slot(keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - _TABLE_BITS)).astype(np.int64)

    def merged(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Piece that each pair forms, or -1."""
        keys = (left.astype(np.int64) << 32) | right.astype(np.int64)
        keys = np.where((left < 0) | (right < 0), -2, keys)
        slot = self._slot(keys)
        out = np.full(len(keys), -1, np.int32)
        open_ = np.arange(len(keys))
        for probe in range(self._probes):
            seen = self._keys[slot[open_] + probe]
            hit = seen == keys[open_]
            out[open_[hit]] = self._values[slot[open_[hit]] + probe]
            open_ = open_[~hit & (seen != -1)]
            if not len(open_):
                break
        return out


@lru_cache(maxsize=2)
def piece_model(path: str) -> PieceModel:
    return PieceModel(path)


def _skips(key: np.ndarray, start: np.ndarray, middle: np.ndarray, stop: np.ndarray, below: np.uint64) -> np.ndarray:
    """Whether the candidate of two pieces, by their places in a document, is skipped."""
    x = key + start.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x += middle.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
    x += stop.astype(np.uint64) * np.uint64(0x165667B19E3779F9)
    return mix(x) < below


class _Dropout:
    def __init__(self, model: PieceModel, dropout: float):
        self.model = model
        self.below = np.uint64(min(int(dropout * 2**64), 2**64 - 1))

    def candidates(self, key, left, right, start, middle, stop) -> tuple[np.ndarray, np.ndarray]:
        """Rank and resulting piece of pairs; skipped and impossible ones rank last."""
        piece = self.model.merged(left, right)
        rank = np.where(piece < 0, _NEVER, self.model.rank[piece])
        if self.below:
            possible = np.flatnonzero(piece >= 0)
            drop = _skips(key[possible], start[possible], middle[possible], stop[possible], self.below)
            rank[possible[drop]] = _NEVER
        return rank, piece

    def block(self, pieces: np.ndarray, places: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merge rows of one length: m x n pieces and m x (n + 1) places; -2 fills the rest."""
        m, n = pieces.shape
        out, size = np.full((m, n), -2, np.int32), np.full(m, n)
        if n == 1:
            return pieces, size
        rows = np.arange(m)
        flat_key = np.repeat(key, n - 1)
        rank, result = (
            x.reshape(m, n - 1)
            for x in self.candidates(
                flat_key, pieces[:, :-1].ravel(), pieces[:, 1:].ravel(),
                places[:, :-2].ravel(), places[:, 1:-1].ravel(), places[:, 2:].ravel(),
            )
        )
        while True:
            width = pieces.shape[1]
            at = rank.argmin(axis=1) if width > 1 else np.zeros(len(rows), np.int64)
            done = rank[np.arange(len(rows)), at] == _NEVER if width > 1 else np.ones(len(rows), bool)
            if done.any():
                out[rows[done], :width], size[rows[done]] = pieces[done], width
                go = ~done
                rows, at, key = rows[go], at[go], key[go]
                pieces, places, rank, result = pieces[go], places[go], rank[go], result[go]
            if not len(rows):
                return out, size
            each = np.arange(len(rows))
            merged = result[each, at]
            # Columns behind the merge move up by one; the pair's left column takes the piece.
            lanes = np.arange(width - 1)
            move = lanes + (lanes > at[:, None])
            pieces = np.take_along_axis(pieces, move, 1)
            pieces[each, at] = merged
            lanes = np.arange(width)
            places = np.take_along_axis(places, lanes + (lanes > at[:, None]), 1)
            lanes = np.arange(width - 2)
            move = lanes + (lanes >= at[:, None])
            rank, result = np.take_along_axis(rank, move, 1), np.take_along_axis(result, move, 1)
            for side in (-1, 0):  # the pairs left and right of the new piece
                pair = at + side
                ok = np.flatnonzero((pair >= 0) & (pair < width - 2))
                p = pair[ok]
                rank[ok, p], result[ok, p] = self.candidates(
                    key[ok], pieces[ok, p], pieces[ok, p + 1], places[ok, p], places[ok, p + 1], places[ok, p + 2]
                )

    def long(self, pieces: np.ndarray, first: int, key: np.uint64) -> np.ndarray:
        """The same for one unit of any length, by a heap."""
        n = len(pieces)
        piece, after, before = pieces.tolist(), list(range(1, n + 1)), list(range(-1, n - 1))
        keys = np.full(n, key)
        heap: list[tuple[int, int, int, int, int]] = []
        stop = list(range(1, n + 1))

        def push(lefts: list[int]) -> None:
            lefts = [x for x in lefts if x >= 0 and after[x] < n]
            if not lefts:
                return
            rights = [after[x] for x in lefts]
            ends = [stop[x] for x in rights]
            rank, result = self.candidates(
                keys[: len(lefts)], np.array([piece[x] for x in lefts]), np.array([piece[x] for x in rights]),
                np.array(lefts) + first, np.array(rights) + first, np.array(ends) + first,
            )
            for x, y, e, r, p in zip(lefts, rights, ends, rank.tolist(), result.tolist(), strict=True):
                if r != _NEVER:
                    heapq.heappush(heap, (r, x, y, e, p))

        push(list(range(n - 1)))
        gone = bytearray(n)
        while heap:
            _, left, right, end, result = heapq.heappop(heap)
            if gone[left] or gone[right] or after[left] != right or stop[right] != end or stop[left] != right:
                continue
            piece[left], gone[right], stop[left] = result, 1, end
            after[left] = after[right]
            if after[right] < n:
                before[after[right]] = left
            push([before[left], left])
        return np.array([p for p, g in zip(piece, gone, strict=True) if not g], np.int32)


def encode_texts(model: PieceModel, texts: list[str], keys: np.ndarray, dropout: float) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts and n + 1 offsets. ``keys``: of the dropout, one for each text."""
    whole = "".join(" " + t for t in texts if t)
    points = np.frombuffer(whole.encode("utf-32-le", "surrogatepass"), np.uint32)
    sizes = np.array([len(t) + 1 if t else 0 for t in texts], np.int64)
    ends = np.concatenate(([0], np.cumsum(sizes)))
    n_texts = len(texts)
    if not len(points):
        return np.zeros(0, np.int32), np.zeros(n_texts + 1, np.int64)
    space = points == _SPACE
    cut = space.copy()
    cut[1:] &= ~space[:-1]
    cut[ends[:-1][sizes > 0]] = True
    units = np.flatnonzero(cut)
    lengths = np.diff(np.append(units, len(points)))
    docs = np.searchsorted(ends, units, "right") - 1
    pieces = model.characters[points]
    places = np.arange(len(points)) - np.repeat(ends[:-1], sizes)
    agenda = _Dropout(model, dropout)
    counts = np.zeros(len(units), np.int64)
    out = np.full(len(points), -2, np.int32)
    for n in np.unique(lengths):
        group = np.flatnonzero(lengths == n)
        if n > LONG_UNIT:
            for u in group:
                got = agenda.long(pieces[units[u] : units[u] + n], int(places[units[u]]), keys[docs[u]])
                out[units[u] : units[u] + len(got)], counts[u] = got, len(got)
            continue
        index = units[group][:, None] + np.arange(n)
        first = places[units[group]][:, None] + np.arange(n + 1)
        got, counts[group] = agenda.block(pieces[index], first, keys[docs[group]])
        out[index] = got
    # Characters without a piece become the pieces of their bytes.
    used = np.flatnonzero(out != -2)
    ids, doc = out[used], np.repeat(docs, counts)
    unknown = np.flatnonzero(ids == -1)
    if len(unknown):
        starts = np.concatenate(([0], np.cumsum(counts)))
        unit = np.searchsorted(starts, unknown, "right") - 1
        point = _unknown_points(pieces, points, units, lengths, unit)
        coded = [chr(p).encode("utf-8", "surrogatepass") for p in point.tolist()]
        repeat = np.ones(len(ids), np.int64)
        repeat[unknown] = [len(c) for c in coded]
        at = np.concatenate(([0], np.cumsum(repeat)[:-1]))
        ids, doc = np.repeat(ids, repeat), np.repeat(doc, repeat)
        for u, c in zip(at[unknown].tolist(), coded, strict=True):
            ids[u : u + len(c)] = model.byte_ids[list(c)]
    return ids, np.concatenate(([0], np.cumsum(np.bincount(doc, minlength=n_texts))))


def _unknown_points(pieces, points, units, lengths, unit) -> np.ndarray:
    """Code points behind the characters without a piece, in order."""
    owner = np.repeat(np.arange(len(units)), lengths)
    missing = np.flatnonzero(pieces == -1)
    assert np.array_equal(owner[missing], unit)
    return points[missing]


def decode_ids(model: PieceModel, ids: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts and n + 1 offsets."""
    size = model.size[ids]
    stop = np.cumsum(size)
    step = np.arange(stop[-1] if len(stop) else 0) - np.repeat(stop - size, size)
    data = model.joined[np.repeat(model.place[ids], size) + step]
    bounds = np.concatenate(([0], stop))[ends]
    full = np.flatnonzero(np.diff(ends) > 0)
    keep = np.ones(len(data), bool)
    keep[bounds[full]] = False  # the space put before every text
    gone = np.concatenate(([0], np.cumsum(np.diff(ends) > 0)))
    return data[keep], bounds - gone


def encode_pieces(
    docs: DataFrame, path: str, seed: int = 0, dropout: float = 0.1, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``docs`` without ``text``, with ids (array), n_pieces, decoded_equal.

    Encodes whole texts, decodes the ids again and says whether the bytes are the same.
    Candidates are skipped with probability ``dropout``, by a hash of ``seed``, the id (null
    counts as 0) and the candidate's place, so a rerun gives the same ids. Null and empty
    texts have no ids. Characters without a piece, and the model's own space mark in a text,
    become byte pieces. Texts must be valid UTF-8. Other columns pass; added ones get
    underscores in front where their names are taken.
    """
    rest = [c for c in docs.columns if c != text]
    added = [free_name(docs, c) for c in ("ids", "n_pieces", "decoded_equal")]
    inner = [free_name(docs, c) for c in ("_key", "_text")]
    types = [ArrayType(IntegerType(), False), LongType(), BooleanType()]
    schema = StructType([*[docs.schema[c] for c in rest], *[StructField(a, t) for a, t in zip(added, types, strict=True)]])
    key = F.xxhash64(F.lit(seed), F.coalesce(F.col(doc_id).cast("long"), F.lit(0)))

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = piece_model(path)
        for batch in batches:
            for part, data, offsets in text_slices(batch, inner[1]):
                whole = part.column(len(rest) + 1)
                keys = part.column(len(rest)).to_numpy().view(np.uint64)
                ids, ends = encode_texts(model, [t or "" for t in whole.to_pylist()], keys, dropout)
                back, back_ends = decode_ids(model, ids, ends)
                same = np.diff(back_ends) == np.diff(offsets)
                if np.array_equal(back_ends, offsets):
                    wrong = np.flatnonzero(back != data)
                    same[np.searchsorted(offsets, wrong, "right") - 1] = False
                else:
                    for i in np.flatnonzero(same):
                        a, b = data[offsets[i] : offsets[i + 1]], back[back_ends[i] : back_ends[i + 1]]
                        same[i] = np.array_equal(a, b)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[: len(rest)], list_array(pa.array(ids), ends), pa.array(np.diff(ends)), pa.array(same)],
                    names=schema.names,
                )

    return docs.select(*rest, key.alias(inner[0]), F.col(text).alias(inner[1])).mapInArrow(encoded, schema)


def decode_pieces(encoded: DataFrame, path: str, ids: str = "ids", name: str = "text") -> DataFrame:
    """``encoded`` with the text of its ids as column ``name``; null ids give null."""
    schema = StructType([*encoded.schema.fields, StructField(free_name(encoded, name), StringType())])

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = piece_model(path)
        for part in batches:
            lists = part.column(part.schema.get_field_index(ids))
            sizes = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            ends = np.concatenate(([0], np.cumsum(sizes)))
            data, bounds = decode_ids(model, lists.flatten().to_numpy(zero_copy_only=False), ends)
            texts = pa.Array.from_buffers(
                pa.string(), len(lists), [None, pa.py_buffer(bounds.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data))]
            )
            texts = pc.if_else(lists.is_valid(), texts, None)
            yield pa.RecordBatch.from_arrays([*part.columns, texts], names=schema.names)

    return encoded.mapInArrow(decoded, schema)
