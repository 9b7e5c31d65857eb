"""Prefix trie of conversations by hashes of fixed-length blocks of turns.

Every turn has a digest that holds its place; the digest of a prefix is the exclusive or of
its turns' digests. Conversations are first grouped by the digests of successive blocks of
``BLOCK`` turns. Where a prefix has one block only below it, the turns inside are nodes with
the members of the block; only blocks that differ from a sibling are taken apart by turn, and
that on one row for each different block, whatever the number of its conversations is.

A node is named by its depth and its smallest member. The nodes that a conversation names lie
one below the other, from its head, the first depth where it is the smallest, to its end; a
head hangs on a node that another conversation names. Sums over subtrees are sums along such
paths plus the totals of the paths that hang on them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from coppice.llm.tables import Stored

#: Turns of a block, and of a segment that a running value may pass in one task.
BLOCK, SEGMENT = 4, 4096
#: A key that holds more than one of so many rows is looked up by a broadcast.
HOT_SHARE = 1000
#: Ids that are joined to one text before the texts of a node meet.
CHUNK_IDS = 4096

WORDS = r"[^\x20\x09-\x0D]+"
_EMPTY = hashlib.sha256(b"").hexdigest()


def ordered_turns(
    turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> tuple[DataFrame, DataFrame]:
    """Turns with their place, and conversations with their number of turns.

    Turns: conv, pos (from 0), u and v (128 bits for role and text), words. Conversations:
    conv, n. Turns are ordered by ``turn``, null first; those of one turn by role and by a hash
    of the text. Null role or text counts as empty. Rows without a conversation id take no
    part. A range shuffle deals the rows, so one conversation may lie in many partitions; what
    precedes it there is a row for each border between partitions.
    """
    who, what = F.coalesce(F.col(role), F.lit("")), F.coalesce(F.col(text), F.lit(""))
    rows = turns.filter(F.col(conv_id).isNotNull()).select(
        F.col(conv_id).cast("long").alias("conv"),
        F.col(turn).alias("turn"),
        who.alias("role"),
        F.xxhash64(who, what).alias("u"),
        F.xxhash64(F.lit("second"), F.octet_length(who), F.concat(who, what)).alias("v"),
        F.regexp_count(what, F.lit(WORDS)).cast("long").alias("words"),
    )
    order = ["conv", F.col("turn").asc_nulls_first(), "role", "u", "v"]
    sorted_rows = rows.repartitionByRange(*order).sortWithinPartitions(*order).drop("turn", "role")

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held = None, 0
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            conv = batch.column(0).to_numpy()
            fresh = np.ones(n, bool)
            fresh[1:] = conv[1:] != conv[:-1]
            place = np.arange(n)
            pos = place - np.maximum.accumulate(np.where(fresh, place, 0))
            if last is not None and conv[0] == last:
                pos[: int(np.argmax(fresh[1:])) + 1 if fresh[1:].any() else n] += held
            last, held = conv[-1], int(pos[-1]) + 1
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(pos)], names=[*batch.schema.names, "place"])

    schema = "conv long, u long, v long, words long, part int, place long"
    stored = Stored(
        sorted_rows.withColumn("part", F.spark_partition_id()).mapInArrow(numbered, schema), "trie-turns"
    ).df
    sizes = stored.groupBy("conv", "part").agg(F.count(F.lit(1)).alias("n"))
    # A conversation in several partitions: their number bounds the rows of this window.
    earlier = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.withColumn("before", F.sum("n").over(earlier)).filter("before > 0").drop("n")
    placed = stored.join(F.broadcast(before), ["conv", "part"], "left")
    pos = F.col("place") + F.coalesce("before", F.lit(0))
    return placed.select("conv", pos.alias("pos"), "u", "v", "words"), sizes.groupBy("conv").agg(F.sum("n").alias("n"))


def looked_up(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inner join with ``right``, whose keys are unique, whatever share of ``left`` a key holds.

    Keys with more than one of ``HOT_SHARE`` rows are fewer than that, so their rows of
    ``right`` are broadcast; all other keys are joined by a shuffle.
    """
    keys = list(keys)
    counts = left.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    least = left.count() // HOT_SHARE + 1
    hot = counts.filter(F.col("n") > max(least, HOT_SHARE)).select(*keys)
    known = Stored(right.join(F.broadcast(hot), keys), "trie-hot").df
    far = left.join(F.broadcast(known.select(*keys)), keys, "left_anti").join(right, keys)
    return left.join(F.broadcast(known), keys).unionByName(far)


def _prefixes(turns: DataFrame) -> DataFrame:
    """Digest (za, zb) of the prefix that ends with each turn: conv, pos, seg, ..., length."""
    segment = F.floor(F.col("pos") / SEGMENT)
    keyed = Stored(
        turns.select(
            "conv", "pos", segment.cast("long").alias("seg"), "words", "length",
            F.xxhash64("pos", "u", "v").alias("a"), F.xxhash64("v", "pos", "u", F.lit("b")).alias("b"),
        ),
        "trie-digests",
    ).df
    whole = keyed.filter(F.col("length") > SEGMENT).groupBy("conv", "seg").agg(*[F.bit_xor(c).alias(c) for c in "ab"])
    earlier = Window.partitionBy("conv").orderBy("seg").rowsBetween(Window.unboundedPreceding, -1)
    before = whole.select("conv", "seg", *[F.bit_xor(c).over(earlier).alias(f"{c}0") for c in "ab"]).filter("seg > 0")
    upto = Window.partitionBy("conv", "seg").orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    running = keyed.withColumns({f"z{c}": F.bit_xor(c).over(upto) for c in "ab"}).join(before, ["conv", "seg"], "left")
    shifted = {f"z{c}": F.col(f"z{c}").bitwiseXOR(F.coalesce(f"{c}0", F.lit(0))) for c in "ab"}
    return running.withColumns(shifted).drop("a0", "b0")


def _blocks(turns: DataFrame) -> DataFrame:
    """A row for each block of a conversation: the digest before it, and those of its turns."""
    place = Window.partitionBy("conv", "seg").orderBy("pos")
    ahead = {
        f"{c}{i}": F.lead(c, i).over(place) if i else F.col(c) for i in range(BLOCK) for c in ("za", "zb", "words")
    }
    first = _prefixes(turns).withColumns(ahead).filter(F.col("pos") % BLOCK == 0)
    ends = [F.coalesce(*[F.col(f"z{c}{i}") for i in reversed(range(BLOCK))]).alias(f"d{c}") for c in "ab"]
    start = [F.col(f"z{c}").bitwiseXOR(F.col(c)).alias(f"p{c}") for c in "ab"]
    return first.select("conv", "pos", "length", *start, *ends, *ahead)


def _turn_nodes(blocks: DataFrame) -> DataFrame:
    """Nodes of depth 1 and more: depth, digest, digest of the parent, words, conv, n."""
    inner = [f"{c}{i}" for i in range(BLOCK) for c in ("za", "zb", "words")]
    below = ["pos", "pa", "pb"]
    different = Stored(
        blocks.groupBy(*below, "da", "db").agg(
            F.count(F.lit(1)).alias("n"), F.min("conv").alias("conv"), *[F.first(c).alias(c) for c in inner]
        ),
        "trie-blocks",
    ).df
    # The only block below a prefix is found by its own digest, so no key is a hot one here.
    siblings = different.groupBy(*below).agg(F.count(F.lit(1)).alias("many"), F.min("da").alias("da"), F.min("db").alias("db"))
    alone = siblings.filter("many = 1").select("pos", "da", "db", F.lit(True).alias("alone"))
    turns = F.array(
        *[
            F.struct(
                (F.col("pos") + i + 1).alias("depth"), F.col(f"za{i}").alias("za"), F.col(f"zb{i}").alias("zb"),
                F.col(f"za{i - 1}" if i else "pa").alias("pza"), F.col(f"zb{i - 1}" if i else "pb").alias("pzb"),
                F.col(f"words{i}").alias("words"),
            )
            for i in range(BLOCK)
        ]
    )
    each = different.join(alone, ["pos", "da", "db"], "left").select("conv", "n", "alone", F.inline(turns)).filter("za IS NOT NULL")
    names = ["depth", "za", "zb", "pza", "pzb", "words", "conv", "n"]
    apart = each.filter("alone IS NULL").groupBy("depth", "za", "zb", "pza", "pzb", "words")
    refined = apart.agg(F.min("conv").alias("conv"), F.sum("n").alias("n"))
    return each.filter("alone").select(*names).unionByName(refined)


def _path_totals(paths: DataFrame) -> DataFrame:
    """Sum of s and l over each path and all that hang on it, directly or not: conv, s, l.

    Rounds of pointer doubling: a path holds the sums of those up to 2**j levels below it and
    the path 2**j levels above it, so rounds grow with the logarithm of the nesting.
    """
    current = Stored(paths.select("conv", "up", "s", "l"), "trie-paths")
    while not current.df.filter("up IS NOT NULL").isEmpty():
        open_ = current.df.filter("up IS NOT NULL")
        sent = open_.groupBy(F.col("up").alias("conv")).agg(F.sum("s").alias("s1"), F.sum("l").alias("l1"))
        above = current.df.filter("up IS NOT NULL").select(F.col("conv").alias("up"), F.col("up").alias("next"))
        higher = looked_up(open_.select("conv", "up"), above, ["up"]).select("conv", "next")
        summed = current.df.drop("up").join(sent, "conv", "left").join(higher, "conv", "left")
        following = Stored(
            summed.select(
                "conv", F.col("next").alias("up"),
                *[(F.col(c) + F.coalesce(f"{c}1", F.lit(0))).alias(c) for c in "sl"],
            ),
            "trie-paths",
        )
        current.drop()
        current = following
    return current.df.drop("up")


def _end_digests(ends: DataFrame) -> DataFrame:
    """SHA-256 of the ids that end at each node, ascending and comma-joined.

    Ids are joined to bounded texts where a range shuffle has sorted them, so a node where very
    many end sends few rows on; its digest is made from a stream of those texts.
    """
    keys = ["depth", "za", "zb"]
    placed = ends.repartitionByRange(*keys, "conv").sortWithinPartitions(*keys, "conv")

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            a, b, c, conv = (batch.column(i).to_numpy() for i in range(4))
            fresh = np.zeros(batch.num_rows, bool)
            fresh[::CHUNK_IDS] = True
            fresh[1:] |= (a[1:] != a[:-1]) | (b[1:] != b[:-1]) | (c[1:] != c[:-1])
            first = np.flatnonzero(fresh)
            told = list(map(str, conv.tolist()))
            texts = [",".join(told[x:y]) for x, y in zip(first, [*first[1:], len(told)], strict=True)]
            columns = [pa.array(x[first]) for x in (a, b, c, conv)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(texts, pa.string())], names=["depth", "za", "zb", "conv", "told"])

    schema = "depth long, za long, zb long, conv long, told string"
    joined = placed.select(*keys, "conv").mapInArrow(chunks, schema)

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None
        names = ["depth", "za", "zb", "ends_sha256"]

        def rows(found: list) -> pa.RecordBatch:
            types = [pa.int64(), pa.int64(), pa.int64(), pa.string()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found, strict=True), types, strict=True)], names=names)

        for batch in batches:
            found = []
            for a, b, c, told in zip(*[batch.column(i).to_pylist() for i in (0, 1, 2, 4)], strict=True):
                if (a, b, c) == key:
                    state.update(b"," + told.encode())
                    continue
                if key is not None:
                    found.append((*key, state.hexdigest()))
                key, state = (a, b, c), hashlib.sha256(told.encode())
            if found:
                yield rows(found)
        if key is not None:
            yield rows([(*key, state.hexdigest())])

    dealt = joined.repartition(*[F.col(k) for k in keys]).sortWithinPartitions(*keys, "conv")
    return dealt.mapInArrow(digests, "depth long, za long, zb long, ends_sha256 string")


def _suffix_sums(nodes: DataFrame, values: Sequence[str]) -> DataFrame:
    """Sums of ``values`` over the node and all deeper ones of its path."""
    segment = F.floor(F.col("depth") / SEGMENT).cast("long")
    nodes = nodes.withColumn("seg", segment)
    whole = nodes.filter(F.col("last") >= SEGMENT).groupBy("conv", "seg").agg(*[F.sum(c).alias(c) for c in values])
    later = Window.partitionBy("conv").orderBy(F.desc("seg")).rowsBetween(Window.unboundedPreceding, -1)
    after = whole.select("conv", "seg", *[F.sum(c).over(later).alias(f"{c}_after") for c in values])
    after = after.filter(F.col(f"{values[0]}_after").isNotNull())
    upto = Window.partitionBy("conv", "seg").orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = nodes.withColumns({c: F.sum(c).over(upto) for c in values}).join(after, ["conv", "seg"], "left")
    return summed.withColumns({c: F.col(c) + F.coalesce(f"{c}_after", F.lit(0)) for c in values})


def prefix_trie(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """A row for each node of the trie of all conversations, the textless root included.

    ``turns``: conv, pos (gapless from 0), u, v, words and length (turns of the conversation);
    ``convs``: conv and length of every conversation, turnless ones included. Equal u and v are
    equal turns. Returns conv_id (the smallest member), depth, parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens, ends_sha256, all but the last as long. No conversation:
    no rows, so no root either.
    """
    blocks = Stored(_blocks(turns), "trie-prefixes")
    nothing = [F.lit(None).cast("long").alias(c) for c in ("pza", "pzb")]
    zero = [F.lit(0).cast("long").alias(c) for c in ("depth", "za", "zb")]
    root = convs.agg(F.min("conv").alias("conv"), F.count(F.lit(1)).alias("n")).filter("n > 0")
    root = root.select(*zero, *nothing, F.lit(0).cast("long").alias("words"), "conv", "n")
    nodes = Stored(_turn_nodes(blocks.df).unionByName(root), "trie-nodes").df
    last_turn = [F.coalesce(*[F.col(f"z{c}{i}") for i in reversed(range(BLOCK))]).alias(f"z{c}") for c in "ab"]
    ends = blocks.df.filter(F.col("pos") + BLOCK >= F.col("length")).select(F.col("length").alias("depth"), *last_turn, "conv")
    ends = ends.unionByName(convs.filter("length = 0").select(*zero, "conv"))
    digests = _end_digests(ends)

    saved = (F.col("n") - 1) * F.col("words")
    paths = Stored(
        nodes.groupBy("conv").agg(
            F.min("depth").alias("head"), F.max("depth").alias("last"), F.sum(saved).alias("s"),
            F.min_by(F.struct("pza", "pzb"), "depth").alias("above"),
        ).select("conv", "head", "last", "s", F.col("above.pza").alias("za"), F.col("above.pzb").alias("zb")),
        "trie-heads",
    ).df
    heads = paths.filter("head > 0").select("conv", (F.col("head") - 1).alias("depth"), "za", "zb")
    hangs = looked_up(heads, nodes.select("depth", "za", "zb", F.col("conv").alias("up")), ["depth", "za", "zb"])
    hangs = Stored(hangs.select("conv", "up", F.col("depth").alias("at")), "trie-hangs").df
    # A path's end is a leaf unless something hangs on it.
    held = hangs.select(F.col("up").alias("conv"), F.col("at").alias("last")).distinct()
    leaves = paths.join(held.withColumn("held", F.lit(1)), ["conv", "last"], "left")
    leaves = leaves.select("conv", "s", F.when(F.col("held").isNull(), 1).otherwise(0).cast("long").alias("l"))
    totals = _path_totals(leaves.join(hangs, "conv", "left"))

    hanging = hangs.join(totals, "conv").groupBy(F.col("up").alias("conv"), F.col("at").alias("depth"))
    hanging = hanging.agg(F.count(F.lit(1)).alias("hung"), F.sum("s").alias("hung_s"), F.sum("l").alias("hung_l"))
    known = paths.select("conv", "head", "last").join(hangs.select("conv", "up"), "conv", "left")
    joined = nodes.join(digests, ["depth", "za", "zb"], "left").join(known, "conv").join(hanging, ["conv", "depth"], "left")
    goes_on, hung = F.col("depth") < F.col("last"), F.coalesce("hung", F.lit(0).cast("long"))
    parent = F.when(F.col("depth") == 0, None).when(F.col("depth") == F.col("head"), F.col("up")).otherwise(F.col("conv"))
    valued = Stored(
        joined.select(
            "conv", "depth", "last", "n", parent.alias("parent"),
            (hung + goes_on.cast("long")).alias("n_children"),
            (saved + F.coalesce("hung_s", F.lit(0))).alias("saved_tokens"),
            (F.coalesce("hung_l", F.lit(0)) + (~goes_on & (hung == 0)).cast("long")).alias("n_leaves"),
            F.coalesce("ends_sha256", F.lit(_EMPTY)).alias("ends_sha256"),
        ),
        "trie-values",
    ).df
    return _suffix_sums(valued, ["n_leaves", "saved_tokens"]).select(
        F.col("conv").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), F.col("n").alias("n_convs"),
        "n_children", "n_leaves", "saved_tokens", "ends_sha256",
    )


def conversation_trie(
    conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """``prefix_trie`` of a table of turns as they stand; see there and ``ordered_turns``."""
    turns, convs = ordered_turns(conversations, conv_id, turn, role, text)
    sizes = convs.select("conv", F.col("n").alias("length"))
    return prefix_trie(turns.join(sizes, "conv"), sizes)


def shared_starts(turns: DataFrame, convs: DataFrame, every: int, most: int) -> tuple[DataFrame, DataFrame]:
    """Turns and lengths after each conversation got its first turns from an earlier one.

    The first h turns of c come from conversation c - c % ``every`` as it stands (all, if it has
    fewer, none, if it is not there), the others are c's own after its first h; h is crc32 of
    the decimal c, modulo ``most`` + 1. Remainders have the sign of c.
    """
    convs = convs.select(
        "conv", "n", (F.col("conv") - F.col("conv") % every).alias("base"),
        (F.crc32(F.col("conv").cast("string").cast("binary")) % (most + 1)).alias("h"),
    )
    bases = convs.filter(F.col("conv") == F.col("base")).select("base", F.col("n").alias("base_n"))
    taken = F.least("h", F.coalesce("base_n", F.lit(0).cast("long")))
    rebuilt = convs.join(bases, "base", "left").withColumn("taken", taken)
    rebuilt = rebuilt.withColumn("length", F.col("taken") + F.greatest(F.col("n") - F.col("h"), F.lit(0)))
    own = turns.join(rebuilt.select("conv", "h", "taken", "length"), "conv").filter("pos >= h")
    starts = turns.filter((F.col("conv") % every == 0) & (F.col("pos") < most)).withColumnRenamed("conv", "base")
    lent = starts.join(rebuilt.select("conv", "base", "taken", "length"), "base").filter("pos < taken")
    names = ["conv", "pos", "u", "v", "words", "length"]
    moved = own.withColumn("pos", F.col("pos") - F.col("h") + F.col("taken"))
    return moved.select(*names).unionByName(lent.select(*names)), rebuilt.select("conv", "length")
