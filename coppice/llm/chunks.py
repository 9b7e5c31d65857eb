"""Substring dedup by content-defined chunks.

A gear hash rolls over the bytes and ends a chunk wherever its top bits are zero, so chunk
borders move along with the text when something is inserted before it. Chunks are compared
by digest over the whole corpus; of each, the document with the smallest id keeps its first
one. Runs of repeated chunks that are long enough are cut out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from coppice.llm.tables import free_name
from coppice.llm.text import OTHER, prefix_hash, signed, span_hash, text_slices

#: Bytes that the gear hash sees, bits that are zero at a border, chunk sizes.
GEAR_BYTES, GEAR_BITS, LEAST_CHUNK, MOST_CHUNK = 16, 5, 16, 512
#: Bytes of the shortest run of repeated chunks that is removed.
LEAST_RUN = 64
#: A random 32-bit value for each byte.
GEAR = np.random.default_rng(2024).integers(0, 1 << 32, 256, np.uint32)


def chunk_borders(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start of each chunk and its document; chunks never cut a UTF-8 character."""
    gear = GEAR[data]
    step = 1
    while step < GEAR_BYTES:
        rolled = gear.copy()
        rolled[step:] += gear[:-step] << np.uint32(step)
        gear, step = rolled, step * 2
    whole = np.ones(len(data), bool)  # a character begins at the next byte
    whole[:-1] = (data[1:] & 0xC0) != 0x80
    borders = (np.flatnonzero((gear >> np.uint32(32 - GEAR_BITS) == 0) & whole) + 1).tolist()
    borders.append(len(data) + MOST_CHUNK)
    starts, docs, k = [], [], 0
    for d, (first, stop) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)):
        last = first
        while last < stop:
            starts.append(last)
            docs.append(d)
            while borders[k] < last + LEAST_CHUNK:
                k += 1
            last = borders[k] if borders[k] <= last + MOST_CHUNK else last + MOST_CHUNK
            while last < stop and data[last] & 0xC0 == 0x80:
                last += 1
    return np.array(starts, np.int64), np.array(docs, np.int64)


def _digests(data: np.ndarray, starts: np.ndarray, docs: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """Stop of each chunk, its 64-bit digest and 32 bits of another one."""
    stops = np.minimum(np.append(starts[1:], len(data)), offsets[docs + 1])
    digest = span_hash(prefix_hash(data), starts, stops)
    other = span_hash(prefix_hash(data, OTHER), starts, stops)
    return stops, signed(digest), (other >> np.uint64(32)).astype(np.uint32).view(np.int32)


def _first_in_doc(docs: np.ndarray, digests: np.ndarray) -> np.ndarray:
    """Whether a chunk is the first of its digest in its document."""
    order = np.lexsort((digests, docs))
    first = np.ones(len(order), bool)
    d, h = docs[order], digests[order]
    first[1:] = (d[1:] != d[:-1]) | (h[1:] != h[:-1])
    out = np.empty(len(order), bool)
    out[order] = first
    return out


def _chunk_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, data, offsets in text_slices(batch, "_text"):
            starts, docs = chunk_borders(data, offsets)
            _, digest, other = _digests(data, starts, docs, offsets)
            first = _first_in_doc(docs, digest)
            owner = part.column(0).take(pa.array(docs[first]))
            yield pa.RecordBatch.from_arrays(
                [owner, pa.array(digest[first]), pa.array(other[first])], names=["_key", "digest", "other"]
            )


def _kept(data: np.ndarray, offsets: np.ndarray, repeated: np.ndarray, repeated_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and stop of the runs to remove. ``repeated``: digests, by document."""
    starts, docs = chunk_borders(data, offsets)
    stops, digest, _ = _digests(data, starts, docs, offsets)
    gone = ~_first_in_doc(docs, digest)
    owners = np.repeat(np.arange(len(offsets) - 1), np.diff(repeated_ends))
    # Digests of a document's own list: both sides as (document, digest) in one order.
    side = np.concatenate((np.zeros(len(repeated), np.int8), np.ones(len(digest), np.int8)))
    both_docs, both = np.concatenate((owners, docs)), np.concatenate((repeated, digest))
    order = np.lexsort((side, both, both_docs))
    marked = side[order] == 0
    same = np.zeros(len(order), np.int64)
    change = np.ones(len(order), bool)
    change[1:] = (both_docs[order][1:] != both_docs[order][:-1]) | (both[order][1:] != both[order][:-1])
    same = np.cumsum(change) - 1
    listed = np.zeros(same[-1] + 1 if len(same) else 0, bool)
    listed[same[marked]] = True
    of_chunk = np.empty(len(order), np.int64)
    of_chunk[order] = same
    gone |= listed[of_chunk[len(repeated) :]]
    head = gone.copy()
    head[1:] &= ~(gone[:-1] & (docs[1:] == docs[:-1]))
    tail = gone.copy()
    tail[:-1] &= ~(gone[1:] & (docs[1:] == docs[:-1]))
    start, stop = starts[head], stops[tail]
    long = stop - start >= LEAST_RUN
    return start[long], stop[long]


def dedup_chunks(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with repeated passages cut from ``text``, and n_bytes, n_removed, n_spans.

    Of chunks with one digest (96 bits), the first one in the document of the smallest id
    stays. Rows of one id count as one document, which may keep its passage in each of
    them; rows without an id likewise, and they come first. Null texts stay null and have
    no bytes. Other columns pass; where one of them is called n_bytes, n_removed or n_spans,
    the added column gets underscores in front. Borders lie between characters.
    """
    added = [free_name(docs, c) for c in ("n_bytes", "n_removed", "n_spans")]
    key = F.coalesce(F.col(doc_id).cast("long"), F.lit(-(1 << 63)))
    rows = docs.select(key.alias("_key"), F.col(text).alias("_text")).mapInArrow(
        _chunk_rows, "_key long, digest long, other int"
    )
    shared = (
        rows.groupBy("digest", "other")
        .agg(F.min("_key").alias("_owner"), F.max("_key").alias("_last"))
        .filter("_owner <> _last")
        .select("digest", "other", "_owner")
    )
    repeated = (
        rows.join(shared, ["digest", "other"])
        .filter("_key <> _owner")
        .groupBy("_key")
        .agg(F.collect_list("digest").alias("_repeated"))  # at most the chunks of one document
    )
    name = free_name(docs, "_key")
    repeated = repeated.select(F.col("_key").alias(name), F.col("_repeated").alias(free_name(docs, "_repeated")))
    joined = docs.withColumn(name, key).join(repeated, name, "left").drop(name)
    place = docs.columns.index(text)
    schema = StructType([*docs.schema.fields, *[StructField(c, LongType()) for c in added]])
    schema.fields[place] = StructField(text, StringType())

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offsets in text_slices(batch, text):
                lists = part.column(part.num_columns - 1)
                sizes = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
                ends = np.concatenate(([0], np.cumsum(sizes)))
                marked = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                start, stop = _kept(data, offsets, marked, ends)
                keep = np.zeros(len(data) + 1, np.int8)
                keep[start] += 1
                keep[stop] -= 1
                stay = np.cumsum(keep[:-1]) == 0
                doc = np.searchsorted(offsets, start, "right") - 1
                n_docs = len(offsets) - 1
                removed = np.bincount(doc, stop - start, n_docs).astype(np.int64)
                spans = np.bincount(doc, minlength=n_docs)
                kept_ends = np.concatenate(([0], np.cumsum(np.diff(offsets) - removed))).astype(np.int32)
                whole = part.column(place)
                valid = None if not whole.null_count else pa.array(whole.is_valid()).buffers()[1]
                texts = pa.Array.from_buffers(
                    pa.string(), n_docs, [valid, pa.py_buffer(kept_ends), pa.py_buffer(np.ascontiguousarray(data[stay]))]
                )
                columns = list(part.columns[:-1])
                columns[place] = texts
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.array(np.diff(offsets)), pa.array(removed), pa.array(spans)],
                    names=schema.names,
                )

    return joined.mapInArrow(cut, schema)
