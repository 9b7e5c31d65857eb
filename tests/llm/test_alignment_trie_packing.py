"""Token alignment, the trie of conversations and packing against brute force."""

import hashlib
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from coppice.llm import align, packing, trie
from coppice.llm.queries import BYTE_VOCABULARY, PIECE_MODEL, QUERIES, WORD_VOCABULARY
from coppice.llm.tables import table
from tests.conftest import DATA
from tests.llm.conftest import AWKWARD, prose

TEXTS = ["", " ", "  ", "foo ", " foo\n  bar  ", "\n", "a▁b", "<|endoftext|> x <s> </s>", "x" * 3000, "a\t b\r\n c", "́ 　y", None]


# alignment


def whole_alignment(text, a, b):
    """Counts, groups and links of one text, from the ends of both libraries' tokens."""
    nothing = (0, 0, 0, 0, ""), Counter()
    if not text:
        return nothing
    values = align.byte_level_characters()
    a_ids, b_ids = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    a_bytes = [bytes(values[c] for c in a.id_to_token(i)) for i in a_ids]
    b_bytes = [bytes([int(b.id_to_piece(i)[1:-1], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in b_ids]
    if not b"".join(a_bytes) == b"".join(b_bytes) == (" " + text).encode():
        return nothing
    a_ends, b_ends = (np.cumsum([len(x) for x in some]).tolist() for some in (a_bytes, b_bytes))
    groups, links, i, j = [], Counter(), 0, 0
    for cut in sorted(set(a_ends) & set(b_ends)):
        k, m = a_ends.index(cut) + 1, b_ends.index(cut) + 1
        groups.append(",".join(map(str, a_ids[i:k])) + "|" + ",".join(map(str, b_ids[j:m])))
        links.update((x, y) for x in a_ids[i:k] for y in b_ids[j:m])
        i, j = k, m
    return (len(a_ids), len(b_ids), len(groups), sum(links.values()), hashlib.sha256(";".join(groups).encode()).hexdigest()), links


def expected_alignment(rows):
    a, b = Tokenizer.from_file(BYTE_VOCABULARY), sentencepiece.SentencePieceProcessor(model_file=PIECE_MODEL)
    a.encode_special_tokens = True
    found = [(i, *whole_alignment(t, a, b)) for i, t in rows]
    held = Counter(pair for _, _, links in found for pair in links)
    most = defaultdict(int)
    for (x, _), n in held.items():
        most[x] = max(most[x], n)
    return Counter(
        (i, *numbers, sum(n for p, n in links.items() if held[p] == most[p[0]]), sum(n * held[p] for p, n in links.items()))
        for i, numbers, links in found
    )


NAMES = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_best", "count_sum"]


@pytest.mark.parametrize("most_pairs", [align.BROADCAST_PAIRS, 0])
def test_alignment_of_awkward_texts(spark, awkward, most_pairs, monkeypatch):
    monkeypatch.setattr(align, "BROADCAST_PAIRS", most_pairs)
    rows = [(i, t) for i, t, _ in AWKWARD]
    got = align.link_counts(align.align_tokens(awkward, BYTE_VOCABULARY, PIECE_MODEL).df)
    assert Counter(map(tuple, got.select(NAMES).collect())) == expected_alignment(rows)
    rows = list(enumerate(TEXTS))
    docs = spark.createDataFrame(rows, "doc_id int, text string")
    got = align.link_counts(align.align_tokens(docs, BYTE_VOCABULARY, PIECE_MODEL).df)
    assert Counter(map(tuple, got.select(NAMES).collect())) == expected_alignment(rows)


def test_alignment_query(spark):
    rows = table(spark, DATA, "documents").select("doc_id", "text").collect()
    got = QUERIES["op11_interval_coalescing"](spark, DATA)
    assert Counter(map(tuple, got.select(NAMES).collect())) == expected_alignment(rows)
    assert {t for c, t in got.dtypes if c != "groups_sha256"} == {"bigint"}


def test_alignment_forgets_units(monkeypatch):
    texts = [prose(60, i) for i in range(6)] + TEXTS
    whole = align.Aligner(BYTE_VOCABULARY, PIECE_MODEL)
    counts, digests, doc, pair, n = whole.align([t or "" for t in texts])
    for room in (10, 1500, 4000):
        monkeypatch.setattr(align, "CACHE_CHARACTERS", room)
        short = align.Aligner(BYTE_VOCABULARY, PIECE_MODEL)
        for some in (texts, texts[::-1]):
            each = [short.align([t or ""]) for t in some][:: 1 if some is texts else -1]
            assert [e[1][0] for e in each] == digests and np.array_equal(np.concatenate([e[0] for e in each]), counts)
            assert [(e[3].tolist(), e[4].tolist()) for e in each] == [(pair[doc == i].tolist(), n[doc == i].tolist()) for i in range(len(texts))]


def test_groups_break_where_a_start_reaches_all_ends():
    starts, ends = np.array([0, 4, 6, 0, 3, 5, 6]), np.array([4, 6, 9, 3, 5, 6, 9])
    order, group = align.coalesce(starts, ends)
    by_group = defaultdict(set)
    for i, g in zip(order.tolist(), group.tolist(), strict=True):
        by_group[g].add((int(starts[i]), int(ends[i])))
    assert sorted(map(sorted, by_group.values())) == [[(0, 3), (0, 4), (3, 5), (4, 6), (5, 6)], [(6, 9)]]


def test_alignment_of_nothing(nothing):
    assert align.link_counts(align.align_tokens(nothing, BYTE_VOCABULARY, PIECE_MODEL).df).count() == 0


# conversations


def plain_trie(whole):
    """Nodes of {conv: [(role, text), ...]}."""
    members = defaultdict(list)
    for c, turns in whole.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = Counter(p[:-1] for p in members if p)
    out, below = set(), defaultdict(lambda: [0, 0])
    for p, some in members.items():
        words = len([w for w in p[-1][1].replace(" ", "x").split() if w]) if p else 0
        for d in range(len(p) + 1):
            below[p[:d]][0] += not children[p]
            below[p[:d]][1] += (len(some) - 1) * words
    for p, some in members.items():
        ended = sorted(c for c in some if len(whole[c]) == len(p))
        digest = hashlib.sha256(",".join(map(str, ended)).encode()).hexdigest()
        parent = min(members[p[:-1]]) if p else None
        out.add((min(some), len(p), parent, len(some), children[p], *below[p], digest))
    return out


TRIE = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def random_talks(rng, n, depth, branch):
    """Conversations that share starts of many lengths; some are equal, some start others."""
    talks = {}
    for c in rng.permutation(n * 3)[:n].tolist():
        turns = [("user" if d % 2 else "assistant", " ".join(["w"] * int(rng.integers(0, 4)) + [str(int(rng.integers(0, branch)))]))
                 for d in range(int(rng.integers(0, depth)))]
        if talks and rng.random() < 0.6:
            other = talks[list(talks)[int(rng.integers(0, len(talks)))]]
            turns = other[: int(rng.integers(0, len(other) + 1))] + turns
        talks[c] = turns
    return talks


@pytest.mark.parametrize("block, segment, hot", [(4, 4096, 1000), (3, 6, 4), (2, 2, 1)])
def test_trie_against_plain_prefixes(spark, monkeypatch, block, segment, hot):
    for name, value in (("BLOCK", block), ("SEGMENT", segment), ("HOT_SHARE", hot), ("CHUNK_IDS", 3)):
        monkeypatch.setattr(trie, name, value)
    talks = random_talks(np.random.default_rng(block), 60, 12, 2)
    # A ladder: each conversation hangs on the one before, so heads nest deeply.
    talks |= {1000 + i: [("user", "step")] * (i + 1) + [("user", f"off {i}")] for i in range(20)}
    talks |= {2000 + i: [("user", "same"), ("assistant", "same too")] for i in range(15)}
    rows = [(c, t, role, text) for c, turns in talks.items() for t, (role, text) in enumerate(turns)]
    df = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string").repartition(3)
    got = trie.conversation_trie(df)
    assert {t for c, t in got.dtypes if c != "ends_sha256"} == {"bigint"}
    found = [tuple(r) for r in got.select(TRIE).collect()]
    wanted = plain_trie({c: t for c, t in talks.items() if t})  # a conversation without rows is not in the table
    assert len(found) == len(wanted) and set(found) == wanted


def test_trie_of_awkward_turns(spark):
    rows = [
        (1, None, None, None, 5, "x"), (1, 0, "user", "a b", 5, "x"), (1, 0, "user", "a b", 5, "x"),  # null turn first, a repeated row
        (2, 7, "", "", 5, "x"), (2, 8, "user", "a  b", 5, "x"), (-3, 1, "", None, 5, "x"), (None, 1, "user", "lost", 5, "x"),
        (5, 0, "user", "\t a\nb " * 3000, 5, "x"),
    ]
    df = spark.createDataFrame(rows, "conv_id int, turn int, role string, text string, depth int, pos string")
    whole = {
        1: [("", ""), ("user", "a b"), ("user", "a b")], 2: [("", ""), ("user", "a  b")], -3: [("", "")],
        5: [("user", "\t a\nb " * 3000)],
    }
    found = [tuple(r) for r in trie.conversation_trie(df).select(TRIE).collect()]
    assert len(found) == len(set(found)) and set(found) == plain_trie(whole)
    assert trie.conversation_trie(df.filter("false")).count() == 0


def rebuilt(talks, every=20, most=3):
    out = {}
    for c, turns in talks.items():
        h = zlib.crc32(str(c).encode()) % (most + 1)
        out[c] = talks.get(c - c % every, [])[:h] + turns[h:]
    return out


def test_trie_of_shared_starts(spark):
    rng = np.random.default_rng(9)
    talks = {c: [("user", str(int(rng.integers(0, 3)))) for _ in range(int(rng.integers(1, 7)))] for c in range(90) if c % 40}
    rows = [(c, t, *told) for c, turns in talks.items() for t, told in enumerate(turns)]
    df = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")
    got = trie.prefix_trie(*trie.shared_starts(*trie.ordered_turns(df), 20, 3))
    wanted = plain_trie(rebuilt(talks))
    assert any(not t for t in rebuilt(talks).values())
    found = [tuple(r) for r in got.select(TRIE).collect()]
    assert len(found) == len(wanted) and set(found) == wanted


# packing


def check_packing(rows, docs, capacity):
    """rows: of the operator; docs: (id, text). All ids are there once, and sequences have no gaps."""
    tokenizer = Tokenizer.from_file(WORD_VOCABULARY)
    wanted = Counter()
    for i, text in docs:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        for p, at in enumerate(range(0, len(ids), capacity)):
            some = np.array(ids[at : at + capacity], "<u4")
            wanted[i, p, at, len(some), zlib.crc32(some.tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == wanted
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for some in sequences.values():
        at = 0
        for offset, length in sorted(some):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences)


def test_packing_of_awkward_texts(awkward, nothing):
    packed = packing.pack_documents(awkward, WORD_VOCABULARY, 64)
    assert packed.rows.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    n = check_packing(packed.rows.collect(), [(i, t) for i, t, _ in AWKWARD], 64)
    assert packed.needed <= n == packed.n_sequences
    packed = packing.pack_documents(nothing, WORD_VOCABULARY)
    assert (packed.rows.count(), packed.n_sequences, packed.needed) == (0, 0, 0)


def test_packing_special_strings(spark):
    texts = [*TEXTS, "a<|endoftext|>b", "<|startoftext|> \x00end", "don't  DON'T", "İIΣ Σ"]
    rows = list(enumerate(texts))
    packed = packing.pack_documents(spark.createDataFrame(rows, "doc_id int, text string"), WORD_VOCABULARY, 100)
    assert check_packing(packed.rows.collect(), rows, 100) == packed.n_sequences


def test_packing_exchanges_between_groups(spark, monkeypatch):
    """Groups leave sequences with room; what they hold is packed again with that of others."""
    monkeypatch.setattr(packing, "GROUP_PIECES", 40)
    rng = np.random.default_rng(3)
    rows = [(i, "a " * (int(rng.integers(0, 40)) if i < 500 else 23)) for i in range(700)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    pieces = packing.document_pieces(docs, WORD_VOCABULARY, 64).df
    first, done = packing._totals(packing.repacking(pieces, 700, 0, 64).df)
    packed = packing.pack_documents(docs, WORD_VOCABULARY, 64)
    n = check_packing(packed.rows.collect(), rows, 64)
    assert packed.needed <= n == packed.n_sequences < first and done < first


def test_packing_mixes_sources(spark):
    """Long documents of one file and short ones of another meet in sequences."""
    rows = [(i, "a " * (39 if i < 150 else 23)) for i in range(300)]
    parts = [spark.createDataFrame(some, "doc_id long, text string").coalesce(1) for some in (rows[:150], rows[150:])]
    packed = packing.pack_documents(parts[0].union(parts[1]), WORD_VOCABULARY, 64)
    assert check_packing(packed.rows.collect(), rows, 64) == packed.needed == 150


def test_packing_query(spark):
    rows = table(spark, DATA, "documents").select("doc_id", "text").collect()
    found = QUERIES["op13_bound_certified"](spark, DATA)
    n = check_packing(found.collect(), rows, 2048)
    total = found.agg(F.sum("length")).first()[0]
    assert n <= -(-total // 2048) + 1


def plain_best_fit(lengths, capacity):
    room = []
    for s in sorted(lengths, reverse=True):
        fits = [(r, i) for i, r in enumerate(room) if r >= s]
        if fits:
            room[min(fits)[1]] -= s
        else:
            room.append(capacity - s)
    return sorted(room)


def fewest(lengths, capacity):
    """Least number of sequences, by trying all ways."""
    best = len(lengths)

    def place(i, room):
        nonlocal best
        if len(room) >= best:
            return
        if i == len(lengths):
            best = len(room)
            return
        for j, r in enumerate(room):
            if r >= lengths[i] and r not in room[:j]:
                place(i + 1, [*room[:j], r - lengths[i], *room[j + 1 :]])
        place(i + 1, [*room, capacity - lengths[i]])

    lengths = sorted(lengths, reverse=True)
    place(0, [])
    return best


def test_best_fit_and_bound_against_plain_search():
    rng = np.random.default_rng(1)
    for t in range(200):
        capacity = int(rng.integers(5, 60))
        n = int(rng.integers(1, 80 if t % 4 else 9))
        lengths = rng.integers(1, capacity + 1, n) if t % 2 else np.minimum(rng.geometric(0.15, n), capacity)
        sequence, offset, room = packing.best_fit(lengths, capacity)
        assert sorted(room.tolist()) == plain_best_fit(lengths.tolist(), capacity)
        for b in range(len(room)):
            at = np.flatnonzero(sequence == b)
            at = at[np.argsort(offset[at])]
            assert np.array_equal(offset[at], np.cumsum(lengths[at]) - lengths[at])
            assert lengths[at].sum() == capacity - room[b]
        needed = packing.sequences_needed(packing.lower_bound(np.bincount(lengths, minlength=capacity + 1), capacity))
        assert needed <= len(room)
        if n < 9:
            assert needed <= fewest(lengths.tolist(), capacity)


def test_vocabulary_paths():
    assert WORD_VOCABULARY == public_tokenizers.path("word_bpe_49k.json")
