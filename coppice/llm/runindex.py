"""Removal of repeated byte strings by run-length compressed indexes.

Two equal strings of ``LENGTH`` bytes hold the same gram of least hash, so it is enough to
compare the surroundings of such anchors with each other. Anchors whose hash occurs once are
dropped; equal surroundings count as one fragment with a multiplicity. The different
fragments of an anchor meet in one task, which leaves out those that share no long core with
another, builds the Burrows-Wheeler transform of the rest,
keeps samples at the ends of its runs only, and reads the matching statistics from them:
between two samples the longest match shrinks by one byte per position, so the regions that
the samples mark are all long matches. An anchor with more fragments than a task should
hold is settled by hashes of its windows, first of ranges of windows, then of single ones.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType

from coppice.llm.tables import Stored
from coppice.llm.text import BASE, OTHER, flat, mix, powers, prefix_hash, released, signed, sliding_minimum, span_hash, text_slices

LENGTH, GRAM = 200, 100
BEFORE = LENGTH - GRAM  # bytes before an anchor that a window with it may begin
#: Fragments of one anchor that meet in a task; bytes of fragments indexed side by side.
GROUP_FRAGMENTS, INDEX_BYTES = 512, 1 << 19
#: Bytes of text whose anchors are found together: its numbers stay in a core's cache.
SLICE = 1 << 17
#: Cores by which fragments find out whether another one may share a window.
CORES = 4
#: Windows of a range.
RANGE = 9


def anchor_places(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, place in ``data`` and document of the anchors.

    Every window of ``LENGTH`` bytes of a document holds at least one.
    """
    if len(data) < LENGTH:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    sums = prefix_hash(data)
    n = len(data) - GRAM + 1
    grams = (sums[GRAM:] - sums[:n]) * powers(len(sums))[1][:n]
    # 32 bits tell the least gram; where they are equal there are more anchors than needed.
    rank = (((grams ^ (grams >> np.uint64(29))) * BASE) >> np.uint64(32)).astype(np.uint32)
    least = sliding_minimum(rank, BEFORE + 1)
    # Windows that reach into the next document.
    step = np.zeros(len(least) + 1, np.int64)
    np.add.at(step, np.clip(offsets[1:-1] - LENGTH + 1, 0, len(least)), 1)
    np.add.at(step, np.clip(offsets[1:-1], 0, len(least)), -1)
    least[np.cumsum(step[:-1]) > 0] = 0
    padded = np.zeros(len(least) + 2 * BEFORE, np.uint32)
    padded[BEFORE : BEFORE + len(least)] = least
    most = ~sliding_minimum(~padded, BEFORE + 1)
    at = np.flatnonzero(rank == most)
    return mix(grams[at]), at, np.searchsorted(offsets, at, "right") - 1


def anchors(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """Hash, digest of the surroundings, document, place, bytes before and behind."""
    hashes, at, doc = anchor_places(data, offsets)
    left = np.minimum(at - offsets[doc], BEFORE)
    right = np.minimum(offsets[doc + 1] - at, LENGTH)
    digest = span_hash(prefix_hash(data, OTHER), at - left, at + right)
    digest = mix(digest ^ (left.astype(np.uint64) << np.uint64(8)))
    return hashes, digest, doc, at - offsets[doc], left, right


@released
def _anchor_hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for _, data, offsets in text_slices(batch, "text", SLICE):
            yield pa.RecordBatch.from_arrays([pa.array(signed(anchor_places(data, offsets)[0]))], names=["anchor"])


@released
def _anchor_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, data, offsets in text_slices(batch, "text", SLICE):
            hashes, digest, doc, at, left, right = anchors(data, offsets)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(signed(hashes)), pa.array(signed(digest)),
                    *(part.column(c).take(pa.array(doc)) for c in (0, 1)),
                    pa.array((at << 16) | (left << 8) | right),
                ],
                names=["anchor", "digest", "k1", "k2", "place"],
            )


def suffix_order(data: np.ndarray, group: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Suffixes of all fragments, sorted within their group, by doubling.

    ``last``: end of each position's fragment. Suffixes are compared up to that end, a
    shorter one first; equal ones come in any order.
    """
    n = len(data)
    place = np.arange(n)
    room = last - place
    padded = np.concatenate((data.astype(np.uint64) + np.uint64(1), np.zeros(8, np.uint64)))
    key = np.zeros(n, np.uint64)
    for j in range(6):  # nine bits a byte
        key = (key << np.uint64(9)) | np.where(room > j, padded[j : j + n], np.uint64(0))
    if n and int(group[-1]) < 1 << 10:
        # Six bytes leave ten bits for the group, so one sort does for both.
        key |= group.astype(np.uint64) << np.uint64(54)
        order = np.argsort(key, kind="stable")
    else:
        order = np.lexsort((key, group))
    new = np.ones(n, bool)
    new[1:] = (key[order][1:] != key[order][:-1]) | (group[order][1:] != group[order][:-1])
    rank = np.empty(n, np.int64)
    rank[order] = np.cumsum(new)
    step = 6
    most = int(room.max(initial=0))
    while step < most:
        # Only suffixes that are still tied are sorted again.
        same = np.zeros(n + 1, bool)
        same[1:-1] = ~new[1:]
        tied = np.flatnonzero(same[:-1] | same[1:])
        if not len(tied):
            break
        some = order[tied]
        follow = np.where(room[some] > step, rank[np.minimum(some + step, n - 1)], 0)
        inner = np.argsort((rank[some].astype(np.uint64) << np.uint64(32)) | follow.astype(np.uint64), kind="stable")
        some, follow = some[inner], follow[inner]
        order[tied] = some
        old = rank[some]
        differs = np.ones(len(some), bool)
        differs[1:] = (old[1:] != old[:-1]) | (follow[1:] != follow[:-1])
        new[tied] = differs
        heads = np.maximum.accumulate(np.where(new, np.arange(n), 0))
        rank[order] = heads + 1
        step *= 2
    return order


def _stable(keys: np.ndarray, order: np.ndarray) -> np.ndarray:
    return order[np.argsort(keys[order], kind="stable")]


def run_ends(data: np.ndarray, ends: np.ndarray, groups: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Neighbours in the transform's order that go on from different bytes.

    The common prefix of other neighbours can be had from the positions before them.
    """
    owner = np.repeat(np.arange(len(ends) - 1), np.diff(ends))
    group = groups[owner]
    order = suffix_order(data, group, ends[1:][owner])
    # The transform; what precedes a fragment is a value of its own.
    before = np.where(order > 0, data[np.maximum(order - 1, 0)].astype(np.int32), 0)
    first = order == ends[:-1][owner[order]]
    before[first] = -1 - order[first]
    border = np.flatnonzero((before[1:] != before[:-1]) & (group[order[1:]] == group[order[:-1]]))
    return order[border], order[border + 1]


def anchored_run_ends(
    data: np.ndarray, ends: np.ndarray, groups: np.ndarray, anchors: np.ndarray, length: int
) -> tuple[np.ndarray, np.ndarray]:
    """``run_ends`` of fragments of which all from the anchor on is one letter.

    Such suffixes of equal rank lie equally far before their anchors. The transform is built from the
    anchors to the left: by the order of the suffixes from ``k`` bytes before them, it has the
    bytes in front, and a stable sort by these is the order for ``k + 1`` (the step that
    maps last letters to first ones). Suffixes shorter than ``length`` are left out at the end.
    """
    at = ends[:-1] + anchors
    size = ends[1:] - at
    group = groups.astype(np.uint16) if groups[-1] < 1 << 16 else groups
    place = np.arange(max(int(size.max()), 1))
    tails = np.where(place < size[:, None], data[np.minimum(at[:, None] + place, len(data) - 1)], 0).astype(np.uint8)
    # Shorter ones first; zeros behind them change nothing else.
    order = _stable(tails.view(f"S{len(place)}").ravel(), np.argsort(size, kind="stable"))
    order = _stable(group, order)
    place = np.arange(int(anchors.max()) + 1)[:, None]
    before = np.where(place < anchors, data[np.maximum(at - 1 - place, 0)].astype(np.uint16) + 1, 0).astype(np.uint16)
    same = groups[1:] == groups[:-1]
    found = []
    for k, column in enumerate(before):
        byte = column[order]
        # Fragments that begin here or behind, with 0, are the first of their group from here on.
        border = np.flatnonzero(same & ((byte[1:] != byte[:-1]) | (byte[1:] == 0)))
        pair = np.stack((order[border], order[border + 1]))
        pair = pair[:, ((anchors[pair] >= k) & (size[pair] + k >= length)).all(axis=0)]
        found.append(at[pair] - k)
        order = _stable(group, _stable(column, order))
    left, right = np.concatenate(found, axis=1)
    return left, right


def long_matches(
    data: np.ndarray,
    ends: np.ndarray,
    groups: np.ndarray,
    sources: np.ndarray,
    begins: np.ndarray,
    length: int = LENGTH,
    anchors: np.ndarray | None = None,
) -> tuple[np.ndarray, np.ndarray]:
    """Start and stop of regions of ``data`` that match elsewhere in their group.

    ``ends``: n + 1 offsets of the fragments; of each its group, ascending, its document and
    its place there: fragments of one document may overlap, and a place is no match of
    itself. The regions' union is that of all strings of ``length`` that another place of
    the group holds. ``anchors``: places in the fragments; the strings are then those that
    begin at them or before, equally far from them in both places.
    """
    owner = np.repeat(np.arange(len(ends) - 1), np.diff(ends))
    last = ends[1:][owner]
    if anchors is None:
        left, right = run_ends(data, ends, groups)
    else:
        left, right = anchored_run_ends(data, ends, groups, anchors, length)
    room = np.minimum(last[left] - left, last[right] - right)
    start = begins[owner] - ends[:-1][owner]
    itself = (sources[owner[left]] == sources[owner[right]]) & (start[left] + left == start[right] + right)
    enough = (room >= length) & ~itself
    left, right, room = left[enough], right[enough], room[enough]
    sums = prefix_hash(data)
    enough = span_hash(sums, left, left + length) == span_hash(sums, right, right + length)
    left, right, room = left[enough], right[enough], room[enough]
    low, high = np.full(len(left), length), room.copy()
    while (low < high).any():  # common prefix by halving
        middle = (low + high + 1) // 2
        equal = span_hash(sums, left, left + middle) == span_hash(sums, right, right + middle)
        low, high = np.where(equal, middle, low), np.where(equal, high, middle - 1)
    # The statistics of both sides fall from the sample on; it covers its common prefix.
    return np.concatenate((left, right)), np.concatenate((left, right)) + np.tile(low, 2)


def partnered(data: np.ndarray, ends: np.ndarray, groups: np.ndarray, left: np.ndarray) -> np.ndarray:
    """Whether another fragment of the group may share a window with the anchor in it.

    The windows that begin ``low`` to ``high`` bytes before the anchor have a core in common; of
    two that are equal, the cores are, too. ``left``: bytes of each fragment before its anchor.
    """
    sums = prefix_hash(data)
    at = ends[:-1] + left
    found = np.zeros(len(left), bool)
    step = -(-(BEFORE + 1) // CORES)
    for low in range(0, BEFORE + 1, step):
        start, stop = at - low, at - min(low + step - 1, BEFORE) + LENGTH
        holds = np.flatnonzero((start >= ends[:-1]) & (stop <= ends[1:]))
        core = span_hash(sums, start[holds], stop[holds]) ^ mix(groups[holds].astype(np.uint64))
        _, kind, n = np.unique(core, return_inverse=True, return_counts=True)
        found[holds[n[kind] > 1]] = True
    return found


def _union(start: np.ndarray, stop: np.ndarray, ends: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of overlapping or touching regions; runs end at ``ends`` of fragments."""
    if not len(start):
        return start, stop
    order = np.argsort(start, kind="stable")
    start, reach = start[order], np.maximum.accumulate(stop[order])
    head = np.ones(len(start), bool)
    head[1:] = start[1:] > reach[:-1]
    if ends is not None:
        head[1:] |= np.diff(np.searchsorted(ends, start, "right")) > 0
    return start[head], reach[np.append(np.flatnonzero(head)[1:] - 1, len(start) - 1)]


_FRAGMENT = ("anchor", "digest", "n", "left", "content", "source", "begin")
_MARK = "anchor long, digest long, start int, stop int"


@released
def _index_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Marks of fragments that come sorted by anchor, relative to the anchor."""
    held: list[pa.RecordBatch] = []

    def marks(rows: pa.RecordBatch) -> pa.RecordBatch:
        group = np.cumsum(np.diff(_numbers(rows, "anchor"), prepend=0) != 0)
        keep = partnered(*flat(rows.column("content")), group, _numbers(rows, "left"))
        # Fragments that occur twice are marked anyway, so a group of these alone tells nothing.
        once = keep & (_numbers(rows, "n") == 1)
        keep &= np.bincount(group[once], minlength=group[-1] + 1)[group] > 0
        rows, group = rows.filter(pa.array(keep)), np.unique(group[keep], return_inverse=True)[1]
        data, ends = flat(rows.column("content"))
        start = stop = np.zeros(0, np.int64)
        if rows.num_rows:
            left = _numbers(rows, "left").astype(np.int64)
            start, stop = long_matches(data, ends, group, _numbers(rows, "source"), _numbers(rows, "begin"), LENGTH, left)
            once = (_numbers(rows, "n") == 1)[np.searchsorted(ends, start, "right") - 1]
            start, stop = _union(start[once], stop[once], ends)
        fragment = np.searchsorted(ends, start, "right") - 1
        base = (ends[:-1] + _numbers(rows, "left"))[fragment]
        return pa.RecordBatch.from_arrays(
            [
                *(rows.column(c).take(pa.array(fragment)) for c in ("anchor", "digest")),
                pa.array((start - base).astype(np.int32)), pa.array((stop - base).astype(np.int32)),
            ],
            names=["anchor", "digest", "start", "stop"],
        )

    for batch in batches:
        for part, _, _ in text_slices(batch, "content", INDEX_BYTES):
            held.append(part)
            if sum(p.column("content").nbytes for p in held) < INDEX_BYTES:
                continue
            rows = pa.concat_batches(held)
            anchor = _numbers(rows, "anchor")
            # The last anchor's fragments may go on.
            whole = int(np.argmax(anchor == anchor[-1]))
            if whole:
                yield marks(rows.slice(0, whole))
            held = [rows.slice(whole)]
    if held:
        yield marks(pa.concat_batches(held))


def _numbers(rows: pa.RecordBatch, name: str) -> np.ndarray:
    return rows.column(name).to_numpy()


def _ranges(width: int, listed: bool):
    """Hashes of ranges of ``width`` windows: of what they share, and of all they cover.

    Windows count from ``-BEFORE`` before the anchor. ``listed``: only those windows whose
    range of ``RANGE`` is in column ``ranges``.
    """
    schema = "anchor long, digest long, n long, number int, core long, whole long, place long, first int, last int"

    @released
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            content = batch.column(batch.schema.get_field_index("content")).to_pylist()
            left = batch.column(batch.schema.get_field_index("left")).to_numpy().astype(np.int64)
            data = np.frombuffer(b"".join(content), np.uint8)
            sizes = np.array([len(c) for c in content])
            base = np.cumsum(sizes) - sizes + left  # of the anchor
            low, high = BEFORE - left, BEFORE - left + sizes - LENGTH  # windows, from 0
            first_range, ranges = low // width, np.maximum(high // width - low // width + 1, 0) * (high >= low)
            row = np.repeat(np.arange(len(sizes)), ranges)
            number = np.arange(ranges.sum()) - np.repeat(np.cumsum(ranges) - ranges, ranges) + first_range[row]
            if listed:
                wanted = batch.column(batch.schema.get_field_index("ranges")).to_pylist()
                keys = np.array([r * 1000 + x for r, w in enumerate(wanted) for x in w])
                keep = np.isin(row * 1000 + number * width // RANGE, keys)
                row, number = row[keep], number[keep]
            first = np.maximum(number * width, low[row])
            last = np.minimum(number * width + width - 1, high[row])
            at = base[row] - BEFORE
            sums = prefix_hash(data)
            core = span_hash(sums, at + number * width + width - 1, at + number * width + LENGTH)
            whole = mix(span_hash(sums, at + first, at + last + LENGTH) ^ (first * 1000 + last).astype(np.uint64))
            # The same place of a document in two fragments counts once.
            source, begin = (batch.column(batch.schema.get_field_index(c)).to_numpy() for c in ("source", "begin"))
            place = (begin + left)[row] + number * width
            place = mix(source[row].view(np.uint64) ^ mix(place.astype(np.uint64)))
            take = pa.array(row)
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(batch.schema.get_field_index(c)).take(take) for c in ("anchor", "digest", "n")),
                    pa.array(number.astype(np.int32)), pa.array(signed(core)), pa.array(signed(whole)), pa.array(signed(place)),
                    pa.array((first - BEFORE).astype(np.int32)), pa.array((last - BEFORE).astype(np.int32)),
                ],
                names=[c.split()[0] for c in schema.split(", ")],
            )

    return rows, schema


def _hashed_marks(fragments: DataFrame) -> DataFrame:
    """Marks of fragments of any number per anchor, by hashes of windows alone."""
    key = ["anchor", "number", "core"]
    ranges = fragments.mapInArrow(*_ranges(RANGE, False))
    places = [F.max("n").alias("n"), F.min("place").alias("p"), F.max("place").alias("q")]
    shared = ranges.groupBy(*key).agg(*places, F.min("whole").alias("a"), F.max("whole").alias("b"))
    shared = shared.filter("n > 1 OR p <> q").select(*key, (F.col("a") == F.col("b")).alias("same"))
    seen = ranges.join(shared, key)
    mark = ["anchor", "digest", F.col("first").alias("start"), (F.col("last") + LENGTH).cast("int").alias("stop")]
    open_ranges = seen.filter("NOT same").groupBy("anchor", "digest").agg(F.collect_set("number").alias("ranges"))
    windows = fragments.join(open_ranges, ["anchor", "digest"]).mapInArrow(*_ranges(1, True))
    repeated = windows.groupBy(*key).agg(*places).filter("n > 1 OR p <> q").select(*key)
    return seen.filter("same").select(*mark).union(windows.join(repeated, key).select(*mark))


@released
def _fragment_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Contents of the listed fragments of each document."""
    for batch in batches:
        for part, data, offsets in text_slices(batch, "text"):
            lists = part.column(part.schema.get_field_index("wanted"))
            item = lists.flatten()
            doc = np.repeat(np.arange(part.num_rows), lists.value_lengths().to_numpy())
            place = item.field("place").to_numpy()
            at, left, right = offsets[doc] + (place >> 16), (place >> 8) & 255, place & 255
            raw = memoryview(np.ascontiguousarray(data))
            content = [raw[a:b].tobytes() for a, b in zip((at - left).tolist(), (at + right).tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    *(item.field(c) for c in ("anchor", "digest", "n")), pa.array(left.astype(np.int32)), pa.array(content, pa.binary()),
                    part.column(part.schema.get_field_index("source")).take(pa.array(doc)), pa.array((place >> 16) - left),
                ],
                names=list(_FRAGMENT),
            )


def _kept_rows(with_kept: bool, names: list[str]):
    @released
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offsets in text_slices(batch, "text"):
                lists = part.column(part.schema.get_field_index("spans"))
                item = lists.flatten()
                doc = np.repeat(np.arange(part.num_rows), lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
                removed, spans, digests, kept = [], [], [], []
                packed = item.to_numpy(zero_copy_only=False).astype(np.int64)
                start, stop = packed >> 31, packed & _LOW
                bounds = np.searchsorted(doc, np.arange(part.num_rows + 1))
                raw = memoryview(np.ascontiguousarray(data))
                for i, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)):
                    s, e = _union(start[bounds[i] : bounds[i + 1]], stop[bounds[i] : bounds[i + 1]])
                    edges = [0, *np.stack((s, e), axis=1).ravel().tolist(), b - a]
                    rest = b"".join(raw[a + x : a + y] for x, y in zip(edges[::2], edges[1::2], strict=True))
                    removed.append(b - a - len(rest))
                    spans.append(len(s))
                    digests.append(hashlib.sha256(rest).hexdigest())
                    kept.append(rest)
                columns = [
                    part.column(part.schema.get_field_index("doc_id")), pa.array(np.diff(offsets)),
                    pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(digests, pa.string()),
                ]
                if with_kept:
                    columns.append(pa.array(kept, pa.binary()))
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return rows


#: Regions as one long: the start above 31 bits for the stop. Marks count from the anchor, so
#: they are shifted to be positive.
_LOW, _SHIFT = (1 << 31) - 1, 1024


def _packed(start: Column, stop: Column) -> Column:
    return F.shiftleft(start, 31).bitwiseOR(stop)


def _joined(regions: Column) -> Column:
    """Sorted packed regions with touching ones made one."""

    def add(done: Column, region: Column) -> Column:
        last = F.try_element_at(done, F.lit(-1))
        start, stop = F.shiftright(region, 31), region.bitwiseAND(F.lit(_LOW))
        touches = start <= last.bitwiseAND(F.lit(_LOW))
        longer = _packed(F.shiftright(last, 31), F.greatest(last.bitwiseAND(F.lit(_LOW)), stop))
        before = F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0)))
        return F.when(touches, F.concat(before, F.array(longer))).otherwise(F.concat(done, F.array(region)))

    return F.aggregate(regions, F.array().cast("array<long>"), add)


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", with_kept: bool = True) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept`` for every row.

    Removes each byte of a string of ``LENGTH`` bytes that also starts anywhere else, in
    the same text or another row; all its places lose it. Strings are judged on the input.
    ``kept`` (left out on request) holds the remaining bytes, which need not be valid UTF-8. Null and empty texts
    have no bytes. Repeated rows, and rows that share an id, are rows of their own. Other
    columns are ignored. Strings are compared by 64-bit hashes and more.
    """
    key = F.coalesce(F.col(doc_id).cast("long"), F.lit(-(1 << 63)))
    ids = docs.select(key.alias("k1")).groupBy("k1").count().filter("count > 1")
    repeated_ids = ids.limit(1).count() > 0
    # Where ids repeat, a digest of the text tells their rows apart. 32 or 64 bits would not:
    # rows taken for one lose each other's spans.
    digest = F.unhex(F.sha2(F.coalesce(F.col(text), F.lit("")).cast("binary"), 256))
    second = digest if repeated_ids else F.lit(0)
    keys = ["k1", "k2"] if repeated_ids else ["k1"]
    texts = docs.select(F.col(doc_id).alias("doc_id"), key.alias("k1"), second.alias("k2"), F.col(text).alias("text"))
    found = texts.select("k1", "k2", "text").mapInArrow(
        _anchor_rows, f"anchor long, digest long, k1 long, k2 {'binary' if repeated_ids else 'int'}, place long"
    )
    hashes = texts.select("text").mapInArrow(_anchor_hashes, "anchor long")
    twice = hashes.groupBy("anchor").count().filter("count > 1").select("anchor")
    # A hot anchor's rows may be split, so this is a join and not a window. A partition's
    # repeated anchors are few against its rows, which need no sort then.
    seen = Stored(found.join(twice.hint("shuffle_hash"), "anchor"), "repeated-anchors").df
    fragments = seen.groupBy("anchor", "digest").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("k1", "k2", "place")).alias("one")
    )
    fragments = Stored(fragments, "fragments").df
    groups = (
        fragments.groupBy("anchor")
        .agg(F.count(F.lit(1)).alias("kinds"), F.min("n").alias("least"))
        .filter("kinds > 1 AND least = 1")
        .select("anchor", (F.col("kinds") > GROUP_FRAGMENTS).alias("hot"))
    )
    wanted = fragments.join(groups, "anchor").select("one.k1", "one.k2", "one.place", "anchor", "digest", "n", "hot")
    # The texts are dealt once: both joins read the same columns of the same exchange.
    dealt = texts.drop(*{"k1", "k2"} - set(keys)).repartition(*keys)
    contents = dealt.dropDuplicates(keys) if repeated_ids else dealt

    def cut(some: DataFrame) -> DataFrame:
        lists = some.groupBy(*keys).agg(F.collect_list(F.struct("anchor", "digest", "n", "place")).alias("wanted"))
        return contents.join(lists, keys).select("doc_id", "text", "wanted", F.xxhash64(*keys).alias("source")).mapInArrow(
            _fragment_rows, "anchor long, digest long, n long, left int, content binary, source long, begin long"
        )

    cold = cut(wanted.filter("NOT hot").drop("hot"))
    marks = cold.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(_index_rows, _MARK)
    # What follows reads hot fragments several times, all from this exchange.
    marks = marks.union(_hashed_marks(cut(wanted.filter("hot").drop("hot")).repartition("anchor", "digest")))
    # Marks as one number each, and those of a fragment joined where they touch, since every
    # place of the fragment repeats them.
    packed = _packed(F.col("start").cast("long") + _SHIFT, F.col("stop").cast("long") + _SHIFT)
    marks = marks.groupBy("anchor", "digest").agg(_joined(F.sort_array(F.collect_list(packed))).alias("marks"))
    place = F.col("place")
    at, left, right = F.shiftright(place, 16), F.shiftright(place, 8).bitwiseAND(F.lit(255)), place.bitwiseAND(F.lit(255))
    # No marks of its own: the fragment occurs twice, so all of it is marked.
    known = fragments.filter("n > 1").select("anchor", "digest", F.lit(None).cast("array<long>").alias("marks")).union(marks)
    start, stop = F.shiftright("mark", 31), F.col("mark").bitwiseAND(F.lit(_LOW))
    spans = (
        seen.join(known, ["anchor", "digest"])
        .select(*keys, "place", F.explode_outer("marks").alias("mark"))
        .select(
            *keys,
            (at + F.coalesce(start - _SHIFT, -left)).alias("start"),
            (at + F.coalesce(stop - _SHIFT, right)).alias("stop"),
        )
        .filter(F.col("stop") - F.col("start") >= LENGTH)
        .select(*keys, _packed(F.col("start"), F.col("stop")).alias("span"))
        .groupBy(*keys)
        .agg(F.collect_list("span").alias("spans"))
    )
    schema = StructType([StructField("doc_id", docs.schema[doc_id].dataType)])
    for name in ("n_bytes", "n_removed", "n_spans"):
        schema.add(name, LongType())
    schema.add("kept_sha256", StringType())
    if with_kept:
        schema.add("kept", BinaryType())
    return dealt.join(spans, keys, "left").select("doc_id", "text", "spans").mapInArrow(
        _kept_rows(with_kept, schema.names), schema
    )
