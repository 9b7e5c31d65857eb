"""Byte-level numpy helpers on Arrow batches: text slices, hashes, words, shingles.

Every helper works on one flat byte array that holds many documents one after the other,
so a batch costs a handful of numpy passes whatever the number of documents is.
"""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator
from functools import wraps

import numpy as np
import pyarrow as pa

#: Odd, so it has an inverse modulo 2**64.
BASE = np.uint64(0x9E3779B97F4A7C15)
BASE_INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
SLICE_BYTES = 1 << 20

#: Bytes that end a word: space and 0x09 to 0x0D.
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: A-Z to a-z, everything else as it is.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_powers = np.ones(1, np.uint64)
_inverses = np.ones(1, np.uint64)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """``BASE**i`` and ``BASE**-i`` for i below n."""
    global _powers, _inverses
    if n > len(_powers):
        size = max(n, SLICE_BYTES + 1)
        for base, name in ((BASE, "_powers"), (BASE_INVERSE, "_inverses")):
            steps = np.full(size, base)
            steps[0] = 1
            globals()[name] = np.multiply.accumulate(steps)
    return _powers[:n], _inverses[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit over all of them."""
    x = x ^ (x >> np.uint64(32))
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string or binary column and n + 1 offsets; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    large = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    width = np.int64 if large else np.int32
    buffers = column.buffers()
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(buffers[1], width)[column.offset : column.offset + len(column) + 1]
    offsets = offsets.astype(np.int64)
    data = buffers[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def text_slices(
    batch: pa.RecordBatch, column: str, most: int = SLICE_BYTES
) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Row slices of about ``most`` text bytes (at least one row) with their flat text."""
    data, offsets = flat(batch.column(batch.schema.get_field_index(column)))
    rows = len(offsets) - 1
    start = 0
    while start < rows:
        stop = int(np.searchsorted(offsets, offsets[start] + most, "right")) - 1
        stop = min(max(stop, start + 1), rows)
        yield (
            batch.slice(start, stop - start),
            data[offsets[start] : offsets[stop]],
            offsets[start : stop + 1] - offsets[start],
        )
        start = stop


#: A second, unrelated value for each byte.
OTHER = np.random.default_rng(7).integers(0, 1 << 64, 256, np.uint64)


def prefix_hash(data: np.ndarray, values: np.ndarray | None = None) -> np.ndarray:
    """n + 1 prefix sums of ``value[byte] * BASE**i`` modulo 2**64; byte + 1 by default."""
    power, _ = powers(len(data))
    sums = np.zeros(len(data) + 1, np.uint64)
    each = data.astype(np.uint64) + np.uint64(1) if values is None else values[data]
    np.cumsum(each * power, out=sums[1:])
    return sums


def span_hash(sums: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Hash of the bytes in ``[start, stop)``, the same wherever they lie."""
    _, inverse = powers(len(sums))
    return mix((sums[stop] - sums[start]) * inverse[start])


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, stop and document of every word; words end at white space and documents."""
    if len(data) == 0:
        none = np.zeros(0, np.int64)
        return none, none, none
    inside = ~SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    before = np.concatenate(([False], inside[:-1]))
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    after = np.concatenate((inside[1:], [False]))
    stops = np.flatnonzero(inside & (~after | edge[1:])) + 1
    docs = np.searchsorted(offsets, starts, "right") - 1
    return starts, stops, docs


def shingles(data: np.ndarray, offsets: np.ndarray, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the distinct word shingles and n + 1 offsets into them.

    Words are separated by white space, A-Z counts as a-z. A document with fewer than
    ``width`` words has its whole sequence as one shingle, one without words none.
    """
    data = LOWER[data]
    starts, stops, docs = word_spans(data, offsets)
    n_docs = len(offsets) - 1
    if len(starts) == 0:
        return np.zeros(0, np.uint64), np.zeros(n_docs + 1, np.int64)
    words = span_hash(prefix_hash(data), starts, stops)
    counts = np.bincount(docs, minlength=n_docs)
    first = np.concatenate(([0], np.cumsum(counts)[:-1]))
    short = np.flatnonzero((counts > 0) & (counts < width))
    n = max(len(words) - width + 1, 0)
    total = np.zeros(n, np.uint64)
    factor = 1
    for j in range(width):
        factor = factor * 0xC2B2AE3D27D4EB4F % (1 << 64)
        total += words[j : j + n] * np.uint64(factor)
    whole = docs[:n] == docs[width - 1 :] if n else np.zeros(0, bool)
    values, owners = [mix(total[whole])], [docs[:n][whole]]
    for d in short:  # at most width - 1 words each
        value, factor = int(counts[d]), 1
        for w in words[first[d] : first[d] + counts[d]].tolist():
            factor = factor * 0xC2B2AE3D27D4EB4F % (1 << 64)
            value = (value + w * factor) % (1 << 64)
        values.append(mix(np.array([value], np.uint64)))
        owners.append(np.array([d]))
    value, owner = np.concatenate(values), np.concatenate(owners)
    order = np.lexsort((value, owner))
    value, owner = value[order], owner[order]
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])
    value, owner = value[new], owner[new]
    ends = np.concatenate(([0], np.cumsum(np.bincount(owner, minlength=n_docs))))
    return value, ends


def list_array(values: pa.Array, offsets: np.ndarray) -> pa.Array:
    """Arrow lists from flat values and n + 1 offsets."""
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), values)


def signed(x: np.ndarray) -> np.ndarray:
    """Unsigned 64-bit values as the long with the same bits."""
    return x.view(np.int64)


def sliding_minimum(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values."""
    span, out = 1, x
    while span * 2 <= width:
        out = np.minimum(out[:-span], out[span:])
        span *= 2
    rest = width - span
    return np.minimum(out[: len(out) - rest], out[rest:]) if rest else out


def released(rows: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """``rows`` for ``mapInArrow`` that gives its task's memory back at the end.

    Workers wait for further tasks, and what the allocators keep meanwhile counts against
    the executor.
    """

    @wraps(rows)
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from rows(batches)
        gc.collect()
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim is not None:
            trim(0)

    return run
