"""Token ids in grammar-compressed files.

Texts are encoded in the order of their ids, cut into blocks, and each block is compressed
by Re-Pair: frequent pairs of neighbouring symbols become nonterminals, round by round,
until no pair is frequent. A round takes pairs from the most frequent on, as long as no
symbol is a left side of one and a right side of another: such pairs cannot overlap, so
replacing them together is the same as one after the other. Pairs of one symbol are replaced
from the left. Pairs never cross documents. A block stores its rules, the length
each symbol expands to, and where documents begin, so one of them is decoded by itself.
"""

from __future__ import annotations

import itertools
import os
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from coppice.llm.tables import Stored
from coppice.llm.text import flat, list_array, text_slices

#: Ids of a block; least occurrences of a pair that is replaced. A rule takes 12 bytes, so
#: rarer pairs would make the files larger.
BLOCK_IDS, LEAST_PAIRS = 1 << 20, 8
#: Bytes of text that are encoded together; units a worker remembers, beyond that it starts afresh.
BLOCK_TEXT = 4 << 20
CACHE_WORDS = 800_000
#: Units that the library gets as one text; longer ones take it more time a unit.
TOGETHER = 2000
#: Blocks whose starts are broadcast, 20 bytes each.
BROADCAST_BLOCKS = 1 << 20
END_ID = 0

_BLOCK = (
    "block int, doc_ids array<long>, id_ends array<long>, symbol_ends array<long>, "
    "n_ids long, first_rule int, rules binary, lengths binary, symbols binary, bits int"
)


class WordEncoder:
    """The tokenizers library behind a dictionary of units.

    A byte-level vocabulary splits every text where white space follows another character,
    after a single line feed, and where one of ``.,;:!?`` follows a letter, so what
    lies between such cuts encodes on its own and each different unit is given to the library
    once. Added tokens must not hold such a cut; no cut is made in a vocabulary where one does.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        n = self.tokenizer.get_vocab_size()
        self.spaced = np.array([self.tokenizer.id_to_token(i).startswith("\u0120") for i in range(n)])
        self.feed = self.tokenizer.token_to_id("\u010a")
        added = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.cuts = self.feed is not None and not any(unit_starts(np.frombuffer(t, np.uint8)).any() for t in added)
        self.clear()

    def clear(self) -> None:
        self.numbers: dict[str, int] = {}
        self.size, self.start = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.int32)

    def _coded(self, parts: list[str]) -> list[np.ndarray]:
        coded = self.tokenizer.encode_batch_fast(parts, add_special_tokens=False)
        return [np.array(c.ids, np.int32) for c in coded]

    def _together(self, units: list[str], spaced: bool) -> tuple[np.ndarray, np.ndarray]:
        """Ids and their number for units that one text tells apart, else one by one.

        Units after a space follow each other, and only their first id begins with a space.
        Units without white space get a line feed between them, which is an id of its own.
        """
        if spaced:
            texts = ["".join(units[i : i + TOGETHER]) for i in range(0, len(units), TOGETHER)]
            ids = np.concatenate(self._coded(texts))
            starts = np.flatnonzero(self.spaced[ids])
            if len(starts) == len(units) and starts[0] == 0:
                return ids, np.diff(np.append(starts, len(ids)))
        else:
            ids = self._coded(["\n".join(units)])[0]
            between = ids == self.feed
            ends = np.append(np.flatnonzero(between), len(ids))
            if len(ends) == len(units):
                return ids[~between], np.diff(ends, prepend=-1) - 1
        return self._singly(units)

    def _singly(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        each = self._coded(units)
        return np.concatenate(each), np.array([len(i) for i in each], np.int64)

    def _learn(self, new: list[str]) -> None:
        """Encode different units that have no number yet, and give them the next ones."""
        self.numbers.update(zip(new, range(len(self.size), len(self.size) + len(new)), strict=True))
        kinds: tuple[list[int], list[int], list[int]] = ([], [], [])
        for i, unit in enumerate(new):
            # What is made of letters and digits alone holds no white space.
            if unit.isalnum():
                kinds[1].append(i)
                continue
            if unit[0] == " " and unit[1:].isalnum():
                kinds[0].append(i)
                continue
            words = unit.split()
            if len(words) == 1 and words[0] == unit:
                kinds[1].append(i)
            elif len(words) == 1 and " " + words[0] == unit:
                kinds[0].append(i)
            else:
                kinds[2].append(i)
        found, order = [], [i for kind in kinds for i in kind]
        for kind, encode in zip(kinds, (lambda u: self._together(u, True), lambda u: self._together(u, False), self._singly), strict=True):
            if kind:
                found.append(encode([new[i] for i in kind]))
        if found:
            place = np.empty(len(order), np.int64)
            place[order] = np.arange(len(order))
            size = np.concatenate([f[1] for f in found])
            start = len(self.ids) + np.cumsum(size) - size
            self.size, self.start = np.concatenate((self.size, size[place])), np.concatenate((self.start, start[place]))
            self.ids = np.concatenate((self.ids, *[f[0] for f in found]))

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts and n + 1 offsets."""
        return self.encode_flat(*flat(pa.array(texts, pa.large_string())))

    def encode_flat(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts that lie one after the other, and n + 1 offsets."""
        if len(self.size) > CACHE_WORDS or len(self.ids) > 8 * CACHE_WORDS or not self.cuts:
            self.clear()
        begins = unit_starts(data) if self.cuts else np.zeros(len(data), bool)
        begins[offsets[:-1][offsets[:-1] < offsets[1:]]] = True
        at = np.append(np.flatnonzero(begins), len(data))
        units = pa.LargeStringArray.from_buffers(len(at) - 1, pa.py_buffer(at.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data)))
        coded = units.dictionary_encode()
        # Through numpy, which makes texts without a scalar for each.
        different = coded.dictionary.to_numpy(zero_copy_only=False)
        number = np.fromiter(map(self.numbers.get, different, itertools.repeat(-1)), np.int64, len(different))
        new = np.flatnonzero(number < 0)
        number[new] = len(self.size) + np.arange(len(new))
        self._learn(different[new].tolist())
        index = number[coded.indices.to_numpy()]
        size = self.size[index]
        stops = np.concatenate(([0], np.cumsum(size)))
        return self.ids[_places(self.start[index], size)], stops[np.searchsorted(at, offsets)]


def unit_starts(data: np.ndarray) -> np.ndarray:
    """Places of UTF-8 bytes where a unit begins; see ``WordEncoder``.

    No cut is made after characters that may be white space beyond ASCII.
    """
    starts = np.zeros(len(data), bool)
    if len(data) < 2:
        return starts
    kind = _KIND[data]
    before, here = kind[:-1], kind[1:]
    starts[1:] = (before >= 1) & (before <= 3) & (here == 5)
    starts[2:] |= starts[1:-1] & (data[1:-1] == 10) & (here[1:] >= 1) & (here[1:] <= 3)
    starts[1:] |= (before == 1) & (here == 2)
    wide = np.flatnonzero((before == 4) & (here == 5)) + 1
    if len(wide):
        second, third = data[wide - 2], data[np.maximum(wide - 3, 0)]
        space = (second == 0xC2) | ((third == 0xE2) & ((second == 0x80) | (second == 0x81)))
        space |= ((third == 0xE1) & (second == 0x9A)) | ((third == 0xE3) & (second == 0x80))
        starts[wide] = ~space
    return starts


#: Kinds of bytes: 1 ASCII letter, 2 mark that ends a word, 3 other visible ASCII, 4 beyond
#: ASCII, 5 white space, 0 other controls.
_KIND = np.zeros(256, np.uint8)
_KIND[33:127], _KIND[128:] = 3, 4
_KIND[65:91] = _KIND[97:123] = 1
_KIND[[ord(c) for c in ".,;:!?"]] = 2
_KIND[[32, *range(9, 14)]] = 5


@lru_cache(maxsize=2)
def word_encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


def _slots(codes: np.ndarray) -> np.ndarray:
    """A place below 2**20 for each pair."""
    if codes.dtype == np.uint32:
        return (codes * np.uint32(0x9E3779B1)) >> np.uint32(12)
    return ((codes * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(44)).astype(np.uint32)


def _chosen(pairs: np.ndarray, counts: np.ndarray, bits: int) -> np.ndarray:
    """Pairs that are replaced together, sorted: from the most frequent on, if none can overlap another."""
    lefts, rights, chosen = set(), set(), []
    for code in pairs[np.lexsort((pairs, -counts))].tolist():
        a, b = code >> bits, code & ((1 << bits) - 1)
        if a not in rights and b not in lefts and (a != b or (a not in lefts and b not in rights)):
            lefts.add(a)
            rights.add(b)
            chosen.append(code)
    return np.sort(np.array(chosen, pairs.dtype))


def _found(chosen: np.ndarray, codes: np.ndarray, slots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each code a place in ``chosen``, and where it is the code's own, ascending.

    A table of slots tells most; codes whose slot another chosen pair took are looked up.
    """
    table = np.full(1 << 20, -1, np.int32)
    own = _slots(chosen)
    table[own] = np.arange(len(chosen))
    at = table.take(slots)
    hit = (at >= 0) & (chosen.take(at, mode="clip") == codes)
    if (table[own] != np.arange(len(chosen))).any():
        rest = np.flatnonzero((at >= 0) & ~hit)
        place = np.minimum(np.searchsorted(chosen, codes[rest]), len(chosen) - 1)
        at[rest], hit[rest] = place, chosen[place] == codes[rest]
    return at, np.flatnonzero(hit)


def repair(ids: np.ndarray, ends: np.ndarray, first_rule: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Symbols, n + 1 document offsets into them, and rules (two symbols each)."""
    symbols = ids.astype(np.uint32)
    last = np.zeros(len(ids), bool)
    last[ends[1:][ends[1:] > ends[:-1]] - 1] = True
    # Places whose pair may be frequent: counts of pairs of old symbols only fall.
    live = ~last
    rules: list[np.ndarray] = []
    made = 0
    while True:
        bits = 16 if first_rule + made <= 1 << 16 else 32
        kind = np.uint32 if bits == 16 else np.uint64
        joint = np.flatnonzero(live)
        if 2 * len(joint) > len(symbols):  # in one go from neighbour to neighbour
            codes = ((symbols[:-1].astype(kind, copy=False) << kind(bits)) | symbols[1:]).take(joint)
        else:
            codes = (symbols.take(joint).astype(kind, copy=False) << kind(bits)) | symbols.take(joint + 1)
        slots = _slots(codes).astype(np.int64)
        often = np.flatnonzero((np.bincount(slots, minlength=1 << 20) >= LEAST_PAIRS).take(slots))
        joint, codes, slots = joint.take(often), codes.take(often), slots.take(often)
        live[:] = False
        live[joint] = True
        pairs, counts = np.unique(codes, return_counts=True)
        keep = counts >= LEAST_PAIRS
        if not keep.any():
            break
        chosen = _chosen(pairs[keep], counts[keep], bits)
        at, hit = _found(chosen, codes, slots)
        joint, at = joint.take(hit), at.take(hit)
        # Pairs of one symbol overlap in runs; every second place counts, from the left.
        apart = np.diff(joint, prepend=-2) > 1
        if not apart.all():
            run = np.maximum.accumulate(np.where(apart, joint, 0))
            even = (joint - run) % 2 == 0
            joint, at = joint[even], at[even]
        symbols[joint] = first_rule + made + at
        last[joint] |= last[joint + 1]
        live[joint] = True
        live[np.maximum(joint - 1, 0)] = True
        keep = np.ones(len(symbols), bool)
        keep[joint + 1] = False
        # The place before a new symbol may have been the right side of the one before it.
        live[np.maximum(joint - 2, 0)] |= ~keep[np.maximum(joint - 1, 0)]
        kept = np.flatnonzero(keep)
        symbols, last, live = symbols.take(kept), last.take(kept), live.take(kept)
        live &= ~last
        rules.append(np.stack((chosen >> kind(bits), chosen & kind((1 << bits) - 1)), axis=1).astype(np.int64))
        made += len(chosen)
    symbol_ends = np.zeros(len(ends), np.int64)
    symbol_ends[1:] = np.concatenate(([0], np.flatnonzero(last) + 1))[np.cumsum(ends[1:] > ends[:-1])]
    return symbols, symbol_ends, np.concatenate(rules) if rules else np.zeros((0, 2), np.int64)


class Grammar:
    """What each symbol stands for: ids below ``first_rule`` themselves, rules their ids."""

    def __init__(self, rules: np.ndarray, first_rule: int, lengths: np.ndarray | None = None):
        self.lengths = _lengths(rules, first_rule) if lengths is None else lengths.astype(np.int64)
        self.size = np.concatenate((np.ones(first_rule, np.int64), self.lengths))
        ends = first_rule + np.cumsum(self.lengths)
        self.start = np.concatenate((np.arange(first_rule), ends - self.lengths))
        self.ids = np.empty(ends[-1] if len(ends) else first_rule, np.int64)
        self.ids[:first_rule] = np.arange(first_rule)
        ready = np.zeros(first_rule + len(rules), bool)
        ready[:first_rule] = True
        missing = np.arange(len(rules))
        while len(missing):  # a round for each level of nesting
            now = missing[ready[rules[missing]].all(axis=1)]
            self.ids[_places(self.start[first_rule + now], self.lengths[now])] = self.expand(rules[now].ravel())
            ready[first_rule + now] = True
            missing = missing[~ready[first_rule + missing]]

    def expand(self, symbols: np.ndarray) -> np.ndarray:
        """Ids behind any run of symbols."""
        return self.ids[_places(self.start[symbols], self.size[symbols])]


def _places(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """``start, start + 1, ...`` of each run, one after the other."""
    stop = np.cumsum(size)
    return np.arange(stop[-1] if len(stop) else 0) + np.repeat(start - (stop - size), size)


def _lengths(rules: np.ndarray, first_rule: int) -> np.ndarray:
    """Ids behind each rule; a rule refers to earlier ones only."""
    out = np.zeros(len(rules), np.int64)
    missing = np.arange(len(rules))
    while len(missing):
        parts = rules[missing]
        size = np.where(parts < first_rule, 1, out[np.maximum(parts - first_rule, 0)])
        ready = (size > 0).all(axis=1)
        out[missing[ready]] = size[ready].sum(axis=1)
        missing = missing[~ready]
    return out


def _block_row(number: int, doc_ids: list, ids: np.ndarray, ends: np.ndarray, vocabulary: int) -> pa.RecordBatch:
    symbols, symbol_ends, rules = repair(ids, ends, vocabulary)
    bits = max(16, int(vocabulary + len(rules) - 1).bit_length())
    values = [
        [number], [doc_ids], [ends[1:].tolist()], [symbol_ends[1:].tolist()], [len(ids)], [vocabulary],
        [rules.astype("<u4").tobytes()], [_lengths(rules, vocabulary).astype("<u4").tobytes()],
        [_packed(symbols, bits)], [bits],
    ]
    types = [pa.int32(), *[pa.list_(pa.int64())] * 3, pa.int64(), pa.int32(), *[pa.binary()] * 3, pa.int32()]
    names = [c.split()[0] for c in _BLOCK.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(values, types, strict=True)], names=names)


def _packed(symbols: np.ndarray, bits: int) -> bytes:
    """The lower 16 bits of all symbols, then each higher bit of all of them."""
    planes = [np.packbits((symbols >> b & 1).astype(bool)).tobytes() for b in range(16, bits)]
    return b"".join([(symbols & 0xFFFF).astype("<u2").tobytes(), *planes])


def _unpacked(packed: bytes, n: int, bits: int) -> np.ndarray:
    symbols = np.frombuffer(packed, "<u2", n).astype(np.int64)
    planes = np.frombuffer(packed, np.uint8)[2 * n :].reshape(bits - 16, (n + 7) // 8)
    for b, plane in enumerate(planes, 16):
        symbols |= np.unpackbits(plane, count=n).astype(np.int64) << b
    return symbols


def block_grammar(block: dict) -> tuple[Grammar, np.ndarray]:
    """Grammar and symbols of a stored block."""
    rules = np.frombuffer(block["rules"], "<u4").astype(np.int64).reshape(-1, 2)
    grammar = Grammar(rules, block["first_rule"], np.frombuffer(block["lengths"], "<u4"))
    return grammar, _unpacked(block["symbols"], block["symbol_ends"][-1], block["bits"])


def document_ids(block: dict, document: int) -> np.ndarray:
    """Ids of one document of a block; no other document is expanded."""
    grammar, symbols = block_grammar(block)
    start = block["symbol_ends"][document - 1] if document else 0
    return grammar.expand(symbols[start : block["symbol_ends"][document]])


def ids_between(block: dict, start: int, stop: int) -> np.ndarray:
    """Ids ``[start, stop)`` of a block: the lengths of rules tell which symbols hold them."""
    grammar, symbols = block_grammar(block)
    ends = np.cumsum(grammar.size[symbols])
    first, last = np.searchsorted(ends, start, "right"), np.searchsorted(ends, stop)
    some = symbols[first : last + 1]
    before = ends[first] - grammar.size[symbols[first]] if len(some) else 0
    return grammar.expand(some)[start - before : stop - before]


def write_ids(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", label: str = "grammar") -> Stored:
    """Encode whole texts and store them as grammar blocks in ascending id order.

    The file format is Parquet, one row for each block; ``part`` and ``block`` give the order
    of blocks, ``start`` the ids of all documents before a block. Each document ends with
    ``END_ID``, so a null or empty text is that one id. Null ids come first; rows of one id
    are ordered by a hash of their text and keep a document each. An id may hold any number
    of rows: the range shuffle also cuts by the hash. Other columns are not stored.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    placed = rows.repartitionByRange(*order).sortWithinPartitions(*order, "text")

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_encoder(path)
        vocabulary = encoder.tokenizer.get_vocab_size()
        number, held, doc_ids, parts, ends = 0, 0, [], [], [np.zeros(1, np.int64)]
        for batch in batches:
            for part, data, offsets in text_slices(batch, "text", BLOCK_TEXT):
                found, bounds = encoder.encode_flat(data, offsets)
                with_end = np.insert(found, bounds[1:], END_ID)
                doc_ids += part.column(0).to_pylist()
                parts.append(with_end)
                ends.append(bounds[1:] + np.arange(1, len(bounds)) + held)
                held += len(with_end)
                if held >= BLOCK_IDS:
                    yield _block_row(number, doc_ids, np.concatenate(parts), np.concatenate(ends), vocabulary)
                    number, held, doc_ids, parts, ends = number + 1, 0, [], [], [np.zeros(1, np.int64)]
        if held:
            yield _block_row(number, doc_ids, np.concatenate(parts), np.concatenate(ends), vocabulary)

    made = placed.mapInArrow(blocks, _BLOCK).withColumn("part", F.spark_partition_id())
    return Stored(made, label)


def read_ids(stored: DataFrame) -> DataFrame:
    """Documents of stored blocks: doc_id, start (ids before it), n_tokens, ids_crc32, ids."""
    in_part = Window.partitionBy("part").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    sizes = stored.select("part", "block", "n_ids")
    # One row for each partition of the writing job, so one task sums them.
    parts = sizes.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_parts"))
    starts = (
        sizes.withColumn("_blocks", F.coalesce(F.sum("n_ids").over(in_part), F.lit(0)))
        .join(parts, "part")
        .select("part", "block", (F.col("_parts") + F.col("_blocks")).alias("start"))
    )
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long, ids array<int>"

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                block = batch.slice(i, 1).to_pylist()[0]
                grammar, symbols = block_grammar(block)
                ids = grammar.expand(symbols)
                ends = np.array([0, *block["id_ends"]], np.int64)
                raw = memoryview(ids.astype("<u4")).cast("B")
                crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(block["doc_ids"], pa.int64()),
                        pa.array(ends[:-1] + block["start"]),
                        pa.array(np.diff(ends)),
                        pa.array(crc, pa.int64()),
                        list_array(pa.array(ids.astype(np.int32)), ends),
                    ],
                    names=["doc_id", "start", "n_tokens", "ids_crc32", "ids"],
                )

    # Blocks are megabytes each, so they stay where they are while their numbers are few.
    if starts.count() <= BROADCAST_BLOCKS:
        starts = F.broadcast(starts)
    return stored.join(starts, ["part", "block"]).mapInArrow(decoded, schema)
