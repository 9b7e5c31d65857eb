"""Operators on texts against brute force, and on awkward and empty tables."""

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from coppice.llm import chunks, gam, grammar, minhash, pieces, runindex
from coppice.llm.components import connected_components
from coppice.llm.decontaminate import BenchmarkIndex, find_leaks, reduced, without_leaks
from coppice.llm.text import flat, shingles
from tests.llm.conftest import AWKWARD, PASSAGE, prose

BYTES = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def docs_of(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


# decontamination


def test_leaks_with_edits(spark):
    item = prose(25, 77)
    words = item.split()
    edited = " ".join(w.upper() if i % 9 else w[:-1] + "q" for i, w in enumerate(words))
    texts = [prose(30, 1) + " " + item + " " + prose(30, 2), prose(5, 3) + "\n" + edited, prose(200, 4), item[:60], None, ""]
    benchmark = spark.createDataFrame([(5, item), (6, None), (7, "tiny")], "item_id int, text string")
    rows = find_leaks(docs_of(spark, texts), benchmark).collect()
    assert {(r.doc_id, r.item_id) for r in rows} == {(0, 5), (1, 5)}
    exact = next(r for r in rows if r.doc_id == 0)
    assert exact.edits == 0 and texts[0][exact.start : exact.stop] == item
    assert [r.doc_id for r in without_leaks(docs_of(spark, texts), benchmark).orderBy("doc_id").collect()] == [2, 3, 4, 5]


@pytest.mark.parametrize("unit, item_unit", [("a", "a"), ("ha ", "ha "), ("abcdefghij klm ", "klm abcdefghij "), ("na na na bat ", "na ")])
def test_repetitive_texts_in_blocks(monkeypatch, unit, item_unit):
    """Blocks of places find what one block of all of them finds."""
    texts = [unit * (1500 // len(unit)), prose(60, 5), "x " + item_unit * 30 + prose(60, 6) + " " + unit * 40, unit * 2]
    index = BenchmarkIndex.of([1, 2, 3], [item_unit * (400 // len(item_unit)), prose(30, 6), prose(40, 8)])
    data, _, offsets = reduced(*flat(pa.array(texts, pa.string())))
    monkeypatch.setattr("coppice.llm.decontaminate.MOST_PAIRS", 1 << 40)
    whole = index.matches(data, offsets)
    monkeypatch.setattr("coppice.llm.decontaminate.OVERLAP", 256)
    for most in (20_000, 100):
        monkeypatch.setattr("coppice.llm.decontaminate.MOST_PAIRS", most)
        assert np.array_equal(index.matches(data, offsets), whole)
    assert (2, 1) in {(r[0], r[1]) for r in whole.tolist()}
    if unit == "a":
        assert whole[(whole[:, 0] == 0) & (whole[:, 1] == 0)].tolist() == [[0, 0, 0, 1500, 0]]


def edit_distance_inside(window: bytes, text: bytes) -> int:
    row = np.zeros(len(text) + 1, int)
    for i, c in enumerate(window, 1):
        new = np.empty_like(row)
        new[0] = i
        new[1:] = np.minimum(row[:-1] + (np.frombuffer(text, np.uint8) != c), row[1:] + 1)
        lanes = np.arange(len(new))
        row = np.minimum.accumulate(new - lanes) + lanes
    return int(row.min())


def test_leak_bound_against_alignment():
    """A text matches exactly if some window aligns within its edits, by full alignment."""
    rng = np.random.default_rng(5)
    item = prose(18, 9)
    index = BenchmarkIndex.of([1], [item])
    window, edits = int(index.window[0]), int(index.edits[0])
    for _ in range(40):
        copy = bytearray(item.encode())
        for _ in range(rng.integers(0, 30)):
            at, kind = rng.integers(0, len(copy)), rng.integers(0, 3)
            if kind == 0:
                copy[at] = 97 + rng.integers(0, 26)
            elif kind == 1:
                del copy[at]
            else:
                copy.insert(at, 97 + rng.integers(0, 26))
        text = prose(6, 1) + " " + copy.decode() + " " + prose(6, 2)
        data, _, ends = reduced(*flat(pa.array([text])))
        base = index.data.tobytes()
        starts = [*range(0, len(base) - window, window // 2), len(base) - window]
        expected = any(edit_distance_inside(base[s : s + window], data.tobytes()) <= edits for s in starts)
        assert bool(len(index.matches(data, ends))) == expected


def windows_by_brute_force(item: bytes) -> set[tuple[int, int]]:
    """Starts and lengths: 100 bytes at any start, and 13 words where they are shorter."""
    out = {(s, min(len(item), 100)) for s in range(max(len(item) - 100, 0) + 1)}
    words = [(m.start(), m.end()) for m in re.finditer(b"[^ ]+", item)]
    for (a, _), (_, b) in zip(words, words[12:], strict=False):
        if b - a < 100:
            out.add((a, next((e for _, e in words if e >= b and e - a >= 32), b) - a))
    return {(s, n) for s, n in out if n >= 32}


def test_every_window_of_an_item():
    """Passages at any start, also short ones and edited ones, by full alignment."""
    rng = np.random.default_rng(8)
    short = "the cat sat on a mat as it was so very tired of all the old red dogs we saw out in a big bare yard of his by an oak"
    for item in (prose(40, 9), short, short[:70], "0 1 2 3 4 5 6 7 8 9 10 11 12 13 14 15 16 17 18 19 20 21 22 23"):
        index = BenchmarkIndex.of([1], [item])
        base = index.data.tobytes()
        windows = windows_by_brute_force(base)
        starts, lengths = index.windows(0)
        assert set(zip(starts.tolist(), lengths.tolist(), strict=True)) == windows
        outcomes = set()
        for trial in range(30):
            start, length = sorted(windows)[rng.integers(0, len(windows))]
            copy = bytearray(base[start : start + length])
            for _ in range(rng.integers(0, length // 8) if trial % 3 else 0):
                at, kind = rng.integers(0, len(copy)), rng.integers(0, 3)
                if kind == 0:
                    copy[at] = 97 + rng.integers(0, 26)
                elif kind == 1:
                    del copy[at]
                else:
                    copy.insert(at, 97 + rng.integers(0, 26))
            data, _, ends = reduced(*flat(pa.array([prose(4, 1) + " ", prose(6, 1) + " " + copy.decode() + " " + prose(6, 2)])))
            text = data[ends[1] :].tobytes()
            expected = any(edit_distance_inside(base[s : s + n], text) <= int(n * 0.07) for s, n in windows)
            found = index.matches(data, ends)
            assert bool(len(found)) == expected and (found[:, 0] == 1).all()
            if trial % 3 == 0:
                assert expected and (found[:, 4] == 0).any()
            outcomes.add(expected)
        assert outcomes == {True, False}


def test_leaks_of_thirteen_words_and_between_steps(spark):
    item = " ".join(f"{w}ly" for w in prose(60, 78).translate(str.maketrans("", "", "0123456789")).split())
    at = item.index(" ", 10) + 1
    texts = [prose(20, 1) + " " + " ".join(item.split()[5:18]) + " " + prose(20, 2), prose(20, 3) + " " + item[at : at + 130] + " " + prose(9, 4)]
    benchmark = spark.createDataFrame([(5, item)], "item_id int, text string")
    assert {r.doc_id for r in find_leaks(docs_of(spark, texts), benchmark).collect()} == {0, 1}
    assert without_leaks(docs_of(spark, texts), benchmark).count() == 0


def test_leaks_on_awkward_rows(awkward, nothing, spark):
    benchmark = spark.createDataFrame([(1, PASSAGE)], "item_id int, text string")
    assert {r.doc_id for r in find_leaks(awkward, benchmark).collect()} == {9, 10}
    assert without_leaks(awkward, benchmark).columns == awkward.columns
    assert without_leaks(awkward, benchmark).count() == len(AWKWARD) - 2
    assert find_leaks(nothing, benchmark).count() == 0
    assert find_leaks(awkward, benchmark.filter("false")).count() == 0
    assert without_leaks(awkward, benchmark.filter("false")).count() == len(AWKWARD)


# repeated byte strings


def kept_by_brute_force(texts, length=runindex.LENGTH):
    raw = [(t or "").encode() for t in texts]
    seen = Counter(b[i : i + length] for b in raw for i in range(len(b) - length + 1))
    out = []
    for b in raw:
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                gone[i : i + length] = True
        spans = int(np.count_nonzero(gone & ~np.concatenate(([False], gone[:-1]))))
        rest = np.frombuffer(b, np.uint8)[~gone].tobytes()
        out.append((len(b), int(gone.sum()), spans, hashlib.sha256(rest).hexdigest()))
    return out


@pytest.mark.parametrize("most", [runindex.GROUP_FRAGMENTS, 1])
def test_repeats_against_brute_force(spark, awkward, monkeypatch, most):
    monkeypatch.setattr(runindex, "GROUP_FRAGMENTS", most)
    texts = [t for _, t, _ in AWKWARD if t is None or len(t) < 20000]
    texts += [PASSAGE[:199], PASSAGE[5:206] + "z", "ab" * 400, prose(30, 8) + PASSAGE[:250], prose(90, 8)]
    rows = runindex.remove_repeats(docs_of(spark, texts)).orderBy("doc_id").collect()
    assert [(r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows] == kept_by_brute_force(texts)


def test_repeats_on_awkward_rows(awkward, nothing):
    rows = runindex.remove_repeats(awkward).collect()
    got = Counter((r.doc_id, r.n_removed, r.n_spans) for r in rows)
    expected = kept_by_brute_force([t for _, t, _ in AWKWARD])
    assert got == Counter((i, e[1], e[2]) for (i, _, _), e in zip(AWKWARD, expected, strict=True))
    assert runindex.remove_repeats(nothing).count() == 0


def test_repeats_of_rows_with_one_id_and_equal_hashes(spark):
    """Texts under one id that 32-bit hashes take for each other are rows of their own."""
    head = F.when(F.col("id") % 2 == 0, prose(40, 21) + PASSAGE).otherwise(PASSAGE[:250])
    many = spark.range(400000).select("id", F.concat(head, F.col("id").cast("string")).alias("text"))
    pair = (
        many.groupBy(F.hash("text").alias("h")).agg(F.count_if(F.col("id") % 2 == 0).alias("even"), F.collect_list("id").alias("ids"))
        .filter("even = 1 AND size(ids) = 2").orderBy("h").first()["ids"]
    )
    texts = [r.text for r in many.filter(F.col("id").isin(pair)).collect()] + [None, "", prose(90, 8)]
    for i in (None, 7):
        docs = spark.createDataFrame([(i, t) for t in texts], "doc_id long, text string")
        got = Counter((r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in runindex.remove_repeats(docs).collect())
        assert got == Counter(kept_by_brute_force(texts))


def test_suffix_order_and_matches():
    rng = np.random.default_rng(3)
    parts = [bytes(rng.integers(97, 99, rng.integers(1, 60)).astype(np.uint8)) for _ in range(30)]
    data = np.frombuffer(b"".join(parts), np.uint8)
    ends = np.cumsum([0, *map(len, parts)])
    groups = np.repeat(np.arange(10), 3)
    owner = np.repeat(np.arange(30), np.diff(ends))
    order = runindex.suffix_order(data, groups[owner], ends[1:][owner])
    key = [(groups[owner[i]], bytes(data[i : ends[owner[i] + 1]])) for i in order]
    assert key == sorted(key)
    start, stop = runindex.long_matches(data, ends, groups, np.arange(30), np.zeros(30, np.int64), 8)
    covered = np.zeros(len(data), bool)
    for a, b in zip(start, stop, strict=True):
        covered[a:b] = True
    expected = np.zeros(len(data), bool)
    places = [i for i in range(len(data)) if i + 8 <= ends[owner[i] + 1]]
    seen = Counter((groups[owner[i]], bytes(data[i : i + 8])) for i in places)
    for i in places:
        if seen[groups[owner[i]], bytes(data[i : i + 8])] > 1:
            expected[i : i + 8] = True
    assert np.array_equal(covered, expected)


def test_fragments_without_a_partner_are_not_indexed(monkeypatch):
    rng = np.random.default_rng(5)
    letters = lambda n: bytes(rng.integers(97, 123, n).astype(np.uint8))
    gram, head, tail = letters(runindex.GRAM), letters(runindex.BEFORE), letters(runindex.LENGTH - runindex.GRAM)
    other = [letters(runindex.BEFORE) + gram + letters(len(tail)) for _ in range(300)]
    alike = [head[:10] + head[60:] + gram + tail, letters(50) + head[60:] + gram + tail[:-1] + b"."]
    content = [*other[:150], alike[0], *other[150:], alike[1]]
    left = [len(c.split(gram)[0]) for c in content]
    sizes = []
    indexed = runindex.long_matches
    monkeypatch.setattr(runindex, "long_matches", lambda data, ends, *rest: sizes.append(len(ends) - 1) or indexed(data, ends, *rest))
    n = len(content)
    columns = [[7] * n, list(range(n)), [1] * n, left, content, list(range(n)), [0] * n]
    types = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.int64(), pa.int64()]
    arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
    batch = pa.RecordBatch.from_arrays(arrays, names=list(runindex._FRAGMENT))
    found = [r for b in runindex._index_rows(iter([batch])) for r in b.to_pylist()]
    shared = {"anchor": 7, "start": 60 - len(head), "stop": runindex.LENGTH - 1}
    assert sizes == [2]
    assert sorted(found, key=lambda r: r["digest"]) == [{**shared, "digest": 150}, {**shared, "digest": n - 1}]


def test_anchored_transform_finds_matches_equally_far_from_the_anchor():
    rng = np.random.default_rng(11)
    letters = np.array([0, 97, 255], np.uint8)
    parts, anchors, groups, sources, begins = [], [], [], [], []
    for group in range(12):
        for _ in range(int(rng.integers(1, 9))):
            left, right = int(rng.integers(0, 9)), int(rng.integers(0, 14))
            parts.append(letters[rng.integers(0, 2 + group % 2, left + right) * (1 if group % 3 else 2) % 3].tobytes() or b"a")
            anchors.append(min(left, len(parts[-1]) - 1))
            groups.append(group)
            sources.append(int(rng.integers(0, 4)))
            begins.append(int(rng.integers(0, 3)) - anchors[-1])
    data, ends = np.frombuffer(b"".join(parts), np.uint8), np.cumsum([0, *map(len, parts)])
    lists = (np.array(x) for x in (groups, sources, begins))
    start, stop = runindex.long_matches(data, ends, *lists, 6, np.array(anchors))
    covered = [set() for _ in parts]
    for a, b in zip(start.tolist(), stop.tolist(), strict=True):
        f = int(np.searchsorted(ends, a, "right")) - 1
        covered[f].update(range(a - ends[f], b - ends[f]))
    windows = {}
    for f, (part, anchor) in enumerate(zip(parts, anchors, strict=True)):
        for k in range(anchor + 1):
            if len(part) >= anchor - k + 6:
                key = groups[f], k, part[anchor - k : anchor - k + 6]
                windows.setdefault(key, []).append((f, anchor - k))
    marked = {}  # by place of the document, which several fragments may hold
    for places in windows.values():
        if len({(sources[f], begins[f] + at) for f, at in places}) > 1:
            for f, at in places:
                marked.setdefault((groups[f], sources[f]), set()).update(range(begins[f] + at, begins[f] + at + 6))
    got = {}
    for f, places in enumerate(covered):
        if places:
            got.setdefault((groups[f], sources[f]), set()).update(begins[f] + x for x in places)
    assert marked and got == marked


def test_index_sorts_no_suffixes_behind_the_anchor(monkeypatch):
    """The order comes from the anchors by stable sorts, a region never spans two fragments."""
    monkeypatch.setattr(runindex, "suffix_order", lambda *_: pytest.fail("all suffixes are sorted"))
    gram, head = b"g" * runindex.GRAM, b"h" * runindex.BEFORE
    ends = [b"t" * 60 + x * 40 for x in (b"u", b"v", b"w")]
    content = [head + gram + e for e in ends] + [gram + ends[0], gram + b"x" * 100]
    columns = [[1] * 3 + [2] * 2, list(range(5)), [1] * 5, [100] * 3 + [0] * 2, content, list(range(5)), [0] * 5]
    types = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.int64(), pa.int64()]
    arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
    batch = pa.RecordBatch.from_arrays(arrays, names=list(runindex._FRAGMENT))
    found = [r for b in runindex._index_rows(iter([batch])) for r in b.to_pylist()]
    assert found == [{"anchor": 1, "digest": d, "start": -100, "stop": 160} for d in range(3)]


def test_anchors_are_the_same_in_slices_and_alone():
    """Every window holds an anchor, and equal windows hold theirs at equal places."""
    rng = np.random.default_rng(4)
    parts = [rng.integers(97, 100, n).astype(np.uint8).tobytes() for n in (900, 199, 200, 0, 1500, 7)]
    parts[4] = parts[4][:300] + parts[0][100:800] + parts[4][300:]
    data, offsets = np.frombuffer(b"".join(parts), np.uint8), np.cumsum([0, *map(len, parts)])
    hashes, at, docs = runindex.anchor_places(data, offsets)
    rows = set(zip(docs.tolist(), (at - offsets[docs]).tolist(), hashes.tolist(), strict=True))
    alone = set()
    for d, part in enumerate(parts):
        h, a, _ = runindex.anchor_places(np.frombuffer(part, np.uint8), np.array([0, len(part)]))
        alone |= {(d, x, y) for x, y in zip(a.tolist(), h.tolist(), strict=True)}
        places = sorted(a.tolist())
        assert all(any(s <= x <= s + runindex.BEFORE for x in places) for s in range(len(part) - runindex.LENGTH + 1))
    assert rows == alone
    inner = {(x - 100, h) for d, x, h in rows if d == 0 and 200 <= x <= 600}
    assert inner and inner == {(x - 300, h) for d, x, h in rows if d == 4 and 400 <= x <= 800}


# token files


def test_units_reach_the_library_in_texts_of_bounded_length(monkeypatch):
    path = public_tokenizers.path("byte_bpe_50k.json")
    encoder, library, most = grammar.WordEncoder(path), Tokenizer.from_file(path), []
    coded = encoder._coded
    monkeypatch.setattr(encoder, "_coded", lambda texts: most.append(max(map(len, texts))) or coded(texts))
    texts = [" ".join(f"w{i}q" for i in range(a, a + 4000)) + " end." for a in (0, 2500)]
    ids, ends = encoder.encode(texts)
    assert [ids[a:b].tolist() for a, b in zip(ends[:-1], ends[1:], strict=True)] == [
        library.encode(t, add_special_tokens=False).ids for t in texts
    ]
    assert max(most) <= 2000 * len(" w6499q")


def test_chosen_pairs_whose_slots_collide_are_found():
    rng = np.random.default_rng(2)
    many = np.unique(rng.integers(0, 1 << 32, 40000, np.uint64).astype(np.uint32))
    chosen = many[::4]
    assert len(np.unique(grammar._slots(chosen))) < len(chosen)
    codes = rng.permutation(np.concatenate((many, chosen)))
    at, hit = grammar._found(chosen, codes, grammar._slots(codes).astype(np.int64))
    assert np.array_equal(hit, np.flatnonzero(np.isin(codes, chosen)))
    assert np.array_equal(chosen[at[hit]], codes[hit])


def test_units_are_numbered_together():
    """New units of a slice get their numbers at once, whatever white space they hold."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    encoder, library = grammar.WordEncoder(path), Tokenizer.from_file(path)
    texts = ["", "a b  c", "\u00e9t\u00e9 x\u00a0y \u2003z", "a b\tc\n\nd, e", " \u4e2d\u6587 9x9", "a b  c d!"]
    for some in (texts[:3], texts, [""], texts[::-1]):
        ids, ends = encoder.encode(some)
        assert [ids[a:b].tolist() for a, b in zip(ends, ends[1:])] == [library.encode(t, add_special_tokens=False).ids for t in some]
        assert sorted(encoder.numbers.values()) == list(range(len(encoder.size)))
    # A plain dictionary: no call of Python for each new unit.
    assert type(encoder.numbers) is dict


def test_grammar_files_round_trip(spark, awkward, nothing, monkeypatch):
    monkeypatch.setattr(grammar, "LEAST_PAIRS", 2)
    monkeypatch.setattr(grammar, "BLOCK_IDS", 3000)
    stored = grammar.write_ids(awkward, BYTES)
    rows = grammar.read_ids(stored.df).collect()
    tokenizer = Tokenizer.from_file(BYTES)
    expected = [(i, [*tokenizer.encode(t or "", add_special_tokens=False).ids, 0]) for i, t, _ in AWKWARD]
    assert Counter((r.doc_id, tuple(r.ids)) for r in rows) == Counter((i, tuple(x)) for i, x in expected)
    ordered = sorted(rows, key=lambda r: r.start)
    assert [r.doc_id for r in ordered] == sorted((r.doc_id for r in rows), key=lambda i: (i is not None, i))
    assert [r.start for r in ordered] == np.cumsum([0, *[r.n_tokens for r in ordered]])[:-1].tolist()
    assert all(r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes()) for r in rows)
    assert any(r.rules for r in stored.df.collect())
    block = max(stored.df.collect(), key=lambda b: len(b.symbols)).asDict()
    whole = np.concatenate([grammar.document_ids(block, d) for d in range(len(block["doc_ids"]))])
    assert len(whole) == block["n_ids"]
    for a, b in ((0, 1), (5, 250), (len(whole) - 3, len(whole)), (7, 7)):
        assert grammar.ids_between(block, a, b).tolist() == whole[a:b].tolist()
    assert grammar.read_ids(grammar.write_ids(nothing, BYTES).df).count() == 0


def test_word_encoder_equals_library():
    texts = ["a  b", " lead", "trail ", "x\n y", "it's  they'll\n\nwe", "tab\t end", "", "é ñ 日本 🙂", "a <|endoftext|> b", "one two\n", "\u00a0 x"]
    encoder, tokenizer = grammar.WordEncoder(BYTES), Tokenizer.from_file(BYTES)
    for some in (texts, texts[::-1]):
        ids, ends = encoder.encode(some)
        for i, t in enumerate(some):
            assert ids[ends[i] : ends[i + 1]].tolist() == tokenizer.encode(t, add_special_tokens=False).ids


def test_word_encoder_equals_library_on_random_texts():
    rng = np.random.default_rng(3)
    parts = ["a", "Zx", "the", " ", "  ", "\n", "\r\n", "\t", "\x0b", "\x1c", ".", ",", ";", ":", "!", "?", "'", "'s", "'ll", "-", "7", "é", "日",
             "\u00a0", "\u0085", "\u2003", "\u2028", "\u3000", "\u1680", "\u200b", "\u2019", "<|endoftext|>", "<|endo", "🙂"]
    texts = ["".join(rng.choice(parts, rng.integers(0, 14))) for _ in range(6000)]
    encoder, tokenizer = grammar.WordEncoder(BYTES), Tokenizer.from_file(BYTES)
    assert encoder.cuts
    ids, ends = encoder.encode(texts)
    for i, coded in enumerate(tokenizer.encode_batch_fast(texts, add_special_tokens=False)):
        assert ids[ends[i] : ends[i + 1]].tolist() == coded.ids, repr(texts[i])


@pytest.mark.parametrize("first_rule", [5, (1 << 16) - 3, 1 << 17])
def test_repair_ends_without_frequent_pairs(first_rule, monkeypatch):
    monkeypatch.setattr(grammar, "LEAST_PAIRS", 3)
    rng = np.random.default_rng(first_rule)
    for n in (1, 7, 400, 3000):
        ids = np.where(rng.random(n) < 0.4, 2, rng.integers(0, 5, n))
        ends = np.concatenate(([0], np.sort(rng.integers(0, n, n // 40)), [n]))
        symbols, symbol_ends, rules = grammar.repair(ids, ends, first_rule)
        model = grammar.Grammar(rules, first_rule)
        bits = max(16, int(first_rule + len(rules) - 1).bit_length())
        assert np.array_equal(grammar._unpacked(grammar._packed(symbols, bits), len(symbols), bits), symbols)
        places, counts = [], Counter()
        for a, b, c, d in zip(symbol_ends[:-1], symbol_ends[1:], ends[:-1], ends[1:], strict=True):
            assert np.array_equal(model.expand(symbols[a:b]), ids[c:d])
            places += zip(symbols[a : b - 1].tolist(), symbols[a + 1 : b].tolist(), strict=True)
        counts.update(places)
        assert max(counts.values(), default=0) < 3


# near duplicates


def components_by_brute_force(rows):
    sets = []
    for i, t in rows:
        words = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets.append({tuple(words[j : j + 5]) for j in range(max(len(words) - 4, 1))} if words else set())
    parent = {i: i for i, _ in rows if i is not None}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, (i, _) in enumerate(rows):
        for b, (j, _) in enumerate(rows[:a]):
            both = len(sets[a] & sets[b])
            if i is not None and j is not None and both and 100 * both >= 85 * len(sets[a] | sets[b]):
                x, y = sorted((root(i), root(j)))
                parent[y] = x
    return [(i, len(s), None if i is None else root(i)) for (i, _), s in zip(rows, sets, strict=True)]


def near_copies(n):
    """A family with some links below the threshold, and chains."""
    rng, base, out = np.random.default_rng(n), prose(120, 50).split(), []
    for _ in range(n):
        words = list(base)
        for _ in range(rng.integers(0, 5)):
            words[rng.integers(0, len(words))] = f"changed{rng.integers(0, 10**6)}"
        out.append(" ".join(words))
    return out


@pytest.mark.parametrize("most", [minhash.GROUP_SHINGLES, 2000, 300])
def test_components_against_brute_force(spark, monkeypatch, most):
    monkeypatch.setattr(minhash, "GROUP_SHINGLES", most)
    texts = near_copies(40) + [t for _, t, _ in AWKWARD if len(t or "") < 20000]
    rows = list(enumerate(texts))[::-1]
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == sorted(components_by_brute_force(rows))
    assert all(r.kept == (r.component_id == r.doc_id) for r in got)


def pairs_between(texts, low, high):
    """Pairs of texts whose similarity in percent is at least ``low`` and below ``high``."""
    sets = [{tuple(w[j : j + 5]) for j in range(len(w) - 4)} for w in (t.split() for t in texts)]
    return [
        (i, j) for j in range(len(sets)) for i in range(j)
        if low * len(sets[i] | sets[j]) <= 100 * len(sets[i] & sets[j]) < high * len(sets[i] | sets[j])
    ]


@pytest.mark.parametrize("most", [minhash.GROUP_SHINGLES, 300])
def test_components_at_another_threshold(spark, monkeypatch, most):
    """Pairs of their own words, on both sides of 80 and 85 percent."""
    monkeypatch.setattr(minhash, "GROUP_SHINGLES", most)
    texts = []
    for n, changed in enumerate((1, 2, 2, 2, 3, 3, 3, 4)):
        words = prose(100, 300 + n).split()
        texts += [" ".join(words)]
        for k in range(changed):
            words[10 + 20 * k] = f"changed{k}"
        texts += [" ".join(words)]
    docs = docs_of(spark, texts)
    assert pairs_between(texts, 80, 85) and pairs_between(texts, 50, 80)
    for percent in (80, 85):
        linked = pairs_between(texts, percent, 101)
        got = minhash.near_duplicates(docs, percent=percent).filter("NOT kept").collect()
        assert sorted((r.component_id, r.doc_id) for r in got) == sorted(linked)
    stage = dict(corpus_pipeline.STAGES)["near_duplicates"]
    gone = {j for _, j in pairs_between(texts, 80, 101)}
    assert {r.doc_id for r in stage(spark, docs, "").collect()} == set(range(len(texts))) - gone


def test_components_on_awkward_rows(awkward, nothing):
    rows = [(i, t) for i, t, _ in AWKWARD]
    got = Counter((r.doc_id, r.n_shingles, r.component_id) for r in minhash.near_duplicates(awkward).collect())
    assert got == Counter(components_by_brute_force(rows))
    kept = minhash.without_near_duplicates(awkward)
    assert kept.columns == awkward.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter([1, 1, 4, 5, 6, 7, 8, 9, 10, 11, 12, None, None])
    assert minhash.near_duplicates(nothing).count() == 0
    assert minhash.without_near_duplicates(nothing).count() == 0


def test_long_chain_of_components(spark):
    edges = [(i, i + 1) for i in range(0, 300)] + [(900, 800), (800, 900), (7, 7), (None, 3)]
    found = connected_components(spark.createDataFrame(edges, "u long, v long")).df.collect()
    assert {(r.node, r.component) for r in found} == {(i, 0) for i in range(301)} | {(900, 800), (800, 800)}


def test_shingles_of_few_words():
    values, ends = shingles(*flat(pa.array(["A b", "a  B", "a b c d e", "a b c d e f", "", None, "b a"])))
    assert np.diff(ends).tolist() == [1, 1, 1, 2, 0, 0, 1]
    assert values[0] == values[1] != values[5]


# pieces


def test_pieces_without_dropout_equal_the_model(spark, awkward):
    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    rows = pieces.encode_pieces(awkward.select("doc_id", "text"), PIECES, dropout=0.0).collect()
    texts = Counter((i, t) for i, t, _ in AWKWARD)
    got = Counter((r.doc_id, tuple(r.ids)) for r in rows)
    for (i, t), n in texts.items():
        if "\u2581" not in (t or ""):
            assert got[i, tuple(model.encode(t or ""))] >= n
    assert all(r.decoded_equal for r in rows)


def test_pieces_with_dropout(awkward, nothing):
    once = pieces.encode_pieces(awkward, PIECES, seed=3, dropout=0.3)
    again = pieces.encode_pieces(awkward.repartition(5), PIECES, seed=3, dropout=0.3)
    other = pieces.encode_pieces(awkward, PIECES, seed=4, dropout=0.3)
    key = lambda df: sorted(((r.doc_id or -1), tuple(r["_ids"])) for r in df.collect())
    assert key(once) == key(again) != key(other)
    rows = once.collect()
    assert all(r.decoded_equal for r in rows) and all(r.n_pieces == len(r["_ids"]) for r in rows)
    back = pieces.decode_pieces(once, PIECES, ids="_ids", name="back")
    assert Counter((r.doc_id, r.back) for r in back.collect()) == Counter((i, t or "") for i, t, _ in AWKWARD)
    assert pieces.encode_pieces(nothing, PIECES).count() == 0


def plain_agenda(model, text, key, dropout):
    """Ids of one text: the best pair that is not skipped merges, the leftmost of equal ones."""
    names = {model.id_to_piece(i): i for i in range(model.get_piece_size()) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))}
    mask, below = 2**64 - 1, min(int(dropout * 2**64), 2**64 - 1)

    def skipped(start, middle, stop):
        x = (key + start * 0x9E3779B97F4A7C15 + middle * 0xC2B2AE3D27D4EB4F + stop * 0x165667B19E3779F9) & mask
        for _ in range(2):
            x = ((x ^ (x >> 32)) * 0xD6E8FEB86659FD93) & mask
        return x ^ (x >> 32) < below

    parts = [(c.replace(" ", "\u2581") if c != "\u2581" else "\0", n, n + 1) for n, c in enumerate(" " + text)] if text else []
    while True:
        best = None
        for n, ((a, i, j), (b, _, k)) in enumerate(zip(parts, parts[1:])):
            piece = names.get(a + b) if a in names and b in names else None
            if piece is not None and not skipped(i, j, k) and (best is None or model.get_score(piece) > best[0]):
                best = model.get_score(piece), n
        if best is None:
            break
        n = best[1]
        parts[n : n + 2] = [(parts[n][0] + parts[n + 1][0], parts[n][1], parts[n + 1][2])]
    out = []
    for a, i, _ in parts:
        raw = (" " + text)[i].encode() if a not in names else b""
        out += [model.piece_to_id(f"<0x{c:02X}>") for c in raw] or [names[a]]
    return out


@pytest.mark.parametrize("dropout", [0.0, 0.1, 0.5, 1.0])
def test_pieces_with_dropout_equal_plain_agenda(dropout):
    model, tables = sentencepiece.SentencePieceProcessor(model_file=PIECES), pieces.piece_model(PIECES)
    texts = [prose(12, 8), "", "  two  spaces ", "Größe 日本語🙂\u2581x", "internationalisation" * 4, "aaaaaaaaaaaaaaaa a", "\n\t tab"]
    keys = np.random.default_rng(4).integers(0, 1 << 64, len(texts), np.uint64)
    ids, ends = pieces.encode_texts(tables, texts, keys, dropout)
    for n, (text, key) in enumerate(zip(texts, keys.tolist(), strict=True)):
        assert ids[ends[n] : ends[n + 1]].tolist() == plain_agenda(model, text, key, dropout), repr(text)


def test_heap_equals_blocks(monkeypatch):
    model = pieces.piece_model(PIECES)
    texts, keys = [prose(300, 5), "Größe " * 30], np.array([5, 6], np.uint64)
    blocks = pieces.encode_texts(model, texts, keys, 0.4)
    monkeypatch.setattr(pieces, "LONG_UNIT", 0)
    heap = pieces.encode_texts(model, texts, keys, 0.4)
    assert all(np.array_equal(a, b) for a, b in zip(blocks, heap, strict=True))


# chunks


def test_chunks_cut_later_copies(spark):
    first, second = prose(60, 1) + " " + PASSAGE + " " + prose(50, 2), prose(45, 3) + " " + PASSAGE + " " + prose(60, 4)
    texts = [first, second, first, prose(100, 5), "é" * 2000, PASSAGE + " " + prose(200, 6) + " " + PASSAGE]
    rows = chunks.dedup_chunks(docs_of(spark, texts)).orderBy("doc_id").collect()
    assert rows[0].text == first and rows[3].text == texts[3]
    assert rows[2].text == "" and rows[2].n_removed == len(first)
    assert len(PASSAGE) * 0.6 < rows[1].n_removed <= len(PASSAGE) + 40 and rows[1].n_spans == 1
    for r, t in zip(rows, texts, strict=True):
        assert len(r.text.encode()) == r.n_bytes - r.n_removed and r.n_bytes == len(t.encode())
    assert PASSAGE not in rows[5].text


def test_chunk_borders_follow_insertions():
    text = prose(400, 8).encode()
    whole = [np.frombuffer(x, np.uint8) for x in (text, b"inserted here " + text)]
    pieces_of = []
    for data in whole:
        starts, _ = chunks.chunk_borders(data, np.array([0, len(data)]))
        assert starts[0] == 0 and np.diff(starts).min() >= 1 and np.diff(starts).max() <= chunks.MOST_CHUNK
        pieces_of.append({data[a:b].tobytes() for a, b in zip(starts, np.append(starts[1:], len(data)), strict=True)})
    assert len(pieces_of[0] & pieces_of[1]) >= len(pieces_of[0]) - 2


def plain_chunks(text):
    """Chunks by the gear hash of each place, byte by byte."""
    data, out, last = text.encode(), [], 0
    gear = [int(g) for g in chunks.GEAR]
    while last < len(data):
        for stop in range(last + chunks.LEAST_CHUNK, last + chunks.MOST_CHUNK + 1):
            if stop >= len(data):
                break
            value = sum(gear[data[stop - 1 - j]] << j for j in range(chunks.GEAR_BYTES)) % (1 << 32)
            if value >> (32 - chunks.GEAR_BITS) == 0 and data[stop] & 0xC0 != 0x80:
                break
        while stop < len(data) and data[stop] & 0xC0 == 0x80:
            stop += 1
        out.append(data[last:stop])
        last = stop
    return out


def plain_dedup(rows):
    """Text, bytes, removed bytes and spans of each row, by sets of whole chunks."""
    cut = [(-1 if i is None else i, plain_chunks(t or "")) for i, t in rows]
    owner = {}
    for key, parts in cut:
        for part in parts:
            owner[part] = min(owner.get(part, key), key)
    out = []
    for (i, t), (key, parts) in zip(rows, cut, strict=True):
        runs = []  # neighbours that go, or stay, together
        for n, part in enumerate(parts):
            gone = owner[part] != key or part in parts[:n]
            if runs and runs[-1][0] == gone:
                runs[-1][1] += part
            else:
                runs.append([gone, part])
        removed = [r for gone, r in runs if gone and len(r) >= chunks.LEAST_RUN]
        kept = b"".join(r for gone, r in runs if not gone or len(r) < chunks.LEAST_RUN)
        size = sum(map(len, parts))
        out.append((i, None if t is None else kept.decode(), size, sum(map(len, removed)), len(removed)))
    return out


def test_chunks_equal_brute_force(spark):
    rng = np.random.default_rng(6)
    passages = [prose(int(n), int(n)) for n in rng.integers(5, 120, 12)] + ["é日🙂ñ" * 90, "x" * 1500, "ab " * 300]
    rows = []
    for i in range(90):
        parts = []
        for k in range(rng.integers(0, 5)):
            parts += [passages[rng.integers(0, len(passages))], prose(int(rng.integers(1, 40)), 1000 + 10 * i + k)]
        rows.append((None if i % 30 == 7 else i - i % 15 % 2, " ".join(parts)))
    rows += [(500, None), (501, ""), (3, passages[0]), (3, passages[0]), (None, passages[1])]
    made = chunks.dedup_chunks(spark.createDataFrame(rows, "doc_id long, text string").repartition(5))
    got = [(r.doc_id, r.text, r.n_bytes, r.n_removed, r.n_spans) for r in made.collect()]
    assert Counter(got) == Counter(plain_dedup(rows))
    assert sum(r[3] for r in got) > 1000


def test_chunks_on_awkward_rows(awkward, nothing):
    cut = chunks.dedup_chunks(awkward)
    assert cut.columns == [*awkward.columns, "_n_bytes", "_n_removed", "n_spans"]
    rows = cut.collect()
    by_id = {r.doc_id: r for r in rows if r.doc_id is not None}
    without_id = [r for r in rows if r.doc_id is None]
    # Rows without an id come first, so they keep the text that others repeat.
    assert sorted(r.text for r in without_id) == sorted(t for i, t, _ in AWKWARD if i is None)
    assert by_id[1].text == by_id[2].text == "" and by_id[4].text is None and by_id[5].text == ""
    assert by_id[9].text == AWKWARD[9][1] and by_id[10]["_n_removed"] > 200
    assert by_id[12].text == AWKWARD[12][1]
    assert chunks.dedup_chunks(nothing).count() == 0


# quality


def test_quality_on_held_out_rows(spark):
    texts = [prose(60, i) if i % 3 else " ".join(w.upper() + "!!" for w in prose(60, i).split()) for i in range(400)]
    docs = docs_of(spark, texts)
    labels = docs.select("doc_id", (F.col("doc_id") % 3 != 0).cast("int").alias("quality"))
    model = gam.fit_quality(docs, labels)
    rows = gam.with_quality(docs, model).select("doc_id", "score", gam.held_out(F.col("doc_id")).alias("h")).collect()
    assert {r.h for r in rows} == {zlib.crc32(str(r.doc_id).encode()) % 4 == 2 for r in rows}
    assert all((r.score >= 0.7) == (r.doc_id % 3 != 0) for r in rows if r.h)


def test_held_out_labels_have_no_effect(spark):
    docs = docs_of(spark, [prose(30, i).upper() if i % 2 else prose(30, i) for i in range(200)])
    labels = docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("quality"))
    turned = labels.withColumn("quality", F.when(gam.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    scores = [[r.score for r in gam.with_quality(docs, gam.fit_quality(docs, x)).orderBy("doc_id").collect()] for x in (labels, turned)]
    assert scores[0] == scores[1]


def test_repeated_id_is_one_text_of_the_fit(spark, monkeypatch):
    """The fit gets one row of a sampled id, whatever its share of the documents."""
    sizes = []
    monkeypatch.setattr(gam, "AdditiveModel", lambda features, good: sizes.append((features.shape, len(good))))
    docs = docs_of(spark, [prose(30, i) for i in range(60)])
    labels = docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("quality"))
    free = labels.filter(~gam.held_out(F.col("doc_id")))
    hot = free.first()["doc_id"]
    copies = spark.range(500).select(F.lit(hot).alias("doc_id"), F.concat(F.lit("text "), F.col("id").cast("string")).alias("text"))
    gam.fit_quality(docs.union(copies), labels)
    gam.fit_quality(docs.union(copies), labels, 10)
    assert sizes == [((n, len(gam.FEATURES)), n) for n in (free.count(), 10)]


def test_quality_pairs_learn_an_interaction():
    rng = np.random.default_rng(0)
    x = rng.random((4000, 3))
    y = (x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)
    model = gam.AdditiveModel(x[:3000], y[:3000])
    assert ((model.score(x[3000:]) > 0.5) == y[3000:]).mean() > 0.9


def test_quality_on_awkward_rows(awkward, nothing, spark):
    labels = spark.createDataFrame([(1, 1), (1, 0), (7, 0), (None, 1), (9, None), (999, 1)], "doc_id long, quality int")
    for some in (labels, labels.filter("false")):
        model = gam.fit_quality(awkward, some)
        rows = gam.with_quality(awkward, model, "_score").collect()
        assert len(rows) == len(AWKWARD) and all(0 <= r["_score"] <= 1 for r in rows)
        for name in ("score", "SCORE"):
            clash = gam.with_quality(awkward.withColumn(name, F.lit("old")), model)
            assert Counter(r.score for r in clash.select("score").collect()) == Counter(r["_score"] for r in rows)
    assert gam.with_quality(nothing, gam.fit_quality(nothing, labels), "_score").count() == 0
