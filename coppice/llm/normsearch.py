"""Exact top-k inner products over vectors grouped by length.

Vectors lie in bands of similar length, bands in blocks of bounded size. A first pass over
the longest vectors gives each query a score that its k-th best reaches at least. In each
block that score becomes a cosine threshold: the query is skipped if even a parallel vector
of the block's greatest length cannot reach it; a high threshold prunes by the query's
strongest coordinates, a low one by length. What is left is verified by its products.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from coppice.llm.tables import Stored, small_table

#: Vectors of a block, queries of a block, vectors of the first pass.
BLOCK, QUERY_BLOCK, SEEDS = 4096, 8192, 1000
#: Natural logarithms of length per band.
BAND = 0.1
#: From this cosine threshold on, coordinates prune better than length.
COORDINATE_COSINE = 0.4
FOCUS = 3
_SLACK = 1e-9
_FOUND = "query_row long, query_id long, vec_row long, vec_id long, score long"


def integer_vectors(vector: Column, scale: int = 256) -> Column:
    """``floor(scale * x)`` of each component; null if any is missing or not finite."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    return F.when(finite, F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double"))))


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    lists = column.combine_chunks()
    rows = len(lists)
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(rows, -1)


def _top(rows: np.ndarray, scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions in ``rows`` of the k best: greatest score, then smallest id."""
    if len(scores) > k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        keep = np.flatnonzero(scores >= least)
    else:
        keep = np.arange(len(scores))
    return keep[np.lexsort((rows[keep], ids[rows[keep]], -scores[keep]))[:k]]


class _Block:
    """Vectors of one block, longest first."""

    def __init__(self, t: pa.Table):
        vectors, ids, rows = _matrix(t["v"]), t["vec_id"].to_numpy(), t["row"].to_numpy()
        lengths = t["length"].to_numpy()
        order = np.argsort(-lengths, kind="stable")
        self.v, self.ids, self.rows, self.lengths = vectors[order], ids[order], rows[order], lengths[order]
        self.longest = self.lengths[0] if len(order) else 0.0
        self.unit = self.v / np.maximum(self.lengths, 1e-300)[:, None]

    def candidates(self, q: np.ndarray, length: float, least: float) -> np.ndarray | None:
        """Rows that may score ``least``; None for all of them."""
        if not np.isfinite(least) or least <= 0:
            return None
        cosine = least / (length * self.longest) - _SLACK if length * self.longest > 0 else 2.0
        if cosine > 1:
            return np.zeros(0, np.int64)
        if cosine < COORDINATE_COSINE:
            # Shorter vectors than this cannot reach the score.
            reach = np.searchsorted(-self.lengths, -(least / length) * (1 - _SLACK), "right")
            return np.arange(reach)
        unit = q / length
        keep = np.ones(len(self.v), bool)
        for f in np.argsort(-np.abs(unit))[:FOCUS]:
            spread = np.sqrt(max(0.0, (1 - cosine**2) * (1 - min(1.0, unit[f] ** 2)))) + _SLACK
            middle = unit[f] * cosine
            x = self.unit[:, f]
            # A unit vector within the cosine of the query has this coordinate at least on
            # the query's side; on the far side the bound holds only below the cosine.
            if unit[f] >= 0:
                keep &= x >= middle - spread
            else:
                keep &= x <= middle + spread
        return np.flatnonzero(keep)


def _search(t: pa.Table, k: int) -> pa.Table:
    """Best k of the block for each query of the group."""
    queries = t.filter(pc.equal(t["side"], 0))
    block = _Block(t.filter(pc.equal(t["side"], 1)))
    found: list[tuple[np.ndarray, ...]] = []
    if queries.num_rows and len(block.v):
        q, ids, rows = _matrix(queries["v"]), queries["vec_id"].to_numpy(), queries["row"].to_numpy()
        lengths = queries["length"].to_numpy()
        least = queries["least"].to_numpy(zero_copy_only=False)
        bound = float(np.abs(q).max(initial=0)) * float(np.abs(block.v).max(initial=0)) * max(q.shape[1], 1)
        # Doubles hold these products exactly; beyond that, Python's integers do.
        kind = np.float64 if bound < 2**53 else object
        q, x = q.astype(kind), block.v.astype(kind)

        def keep(i: int, at: np.ndarray, scores: np.ndarray) -> None:
            own = block.rows[at] != rows[i]
            at, scores = at[own], scores[own]
            if kind is object:
                scores = np.array([min(max(int(s), -(1 << 63)), (1 << 63) - 1) for s in scores], np.int64)
            best = _top(at, scores.astype(np.int64), block.ids, k)
            n = len(best)
            found.append((np.full(n, rows[i]), np.full(n, ids[i]), block.rows[at[best]], block.ids[at[best]], scores[best].astype(np.int64)))

        whole = []
        for i in range(len(q)):
            at = block.candidates(q[i].astype(np.float64), lengths[i], least[i])
            if at is None:
                whole.append(i)
            elif len(at):
                keep(i, at, x[at] @ q[i])
        everything = np.arange(len(x))
        for start in range(0, len(whole), 256):
            part = whole[start : start + 256]
            for i, scores in zip(part, q[part] @ x.T, strict=True):
                keep(i, everything, scores)
    columns = [np.concatenate(c) if found else np.zeros(0, np.int64) for c in zip(*found, strict=True)] if found else [np.zeros(0, np.int64)] * 5
    return pa.table(dict(zip(("query_row", "query_id", "vec_row", "vec_id", "score"), columns, strict=True)))


def top_k_products(df: DataFrame, id_column: str, vector: Column, is_query: Column, k: int = 5) -> DataFrame:
    """The ``k`` greatest integer inner products of each query with all other rows.

    ``vector`` is an array of integers; rows where it or the id is null take no part, and
    vectors are compared only with those of as many components. Returns query_id, rank
    (from 1), vec_id, score; ties go to the smaller id. Queries without a partner have no
    row. Repeated rows are rows of their own. Work is queries times vectors before pruning;
    both sides are dealt in blocks. Products beyond a long are held at its limits.
    """
    spark = df.sparkSession
    vectors = Stored(
        df.select(
            F.col(id_column).cast("long").alias("vec_id"),
            vector.cast("array<long>").alias("v"),
            is_query.alias("is_query"),
            F.monotonically_increasing_id().alias("row"),
        )
        .filter(F.col("v").isNotNull() & F.col("vec_id").isNotNull())
        .withColumn("length", F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x)))
        .withColumn("dim", F.size("v"))
        # Lengths of doubles span about 15,000 bands, whatever the number of rows.
        .withColumn("band", F.floor(F.log(F.greatest("length", F.lit(1e-9))) / BAND)),
        "norm-vectors",
    ).df
    bands = vectors.groupBy("dim", "band").agg(F.count(F.lit(1)).alias("n")).collect()
    first, dealt = 0, []
    for b in sorted(bands, key=lambda b: (b["dim"], -b["band"])):
        blocks = -(-b["n"] // BLOCK)
        dealt.append((b["dim"], b["band"], first, blocks))
        first += blocks
    dealt = small_table(spark, "dim int, band long, first long, blocks long", dealt)
    in_blocks = vectors.join(F.broadcast(dealt), ["dim", "band"]).withColumn(
        "block", F.col("first") + F.pmod(F.xxhash64("row"), F.col("blocks"))
    )
    queries = vectors.filter("is_query")
    sizes = {r["dim"]: -(-r["n"] // QUERY_BLOCK) for r in queries.groupBy("dim").agg(F.count(F.lit(1)).alias("n")).collect()}
    asked = small_table(spark, "dim int, parts int", list(sizes.items()))
    queries = queries.join(F.broadcast(asked), "dim").withColumn("part", F.pmod(F.xxhash64("row"), F.col("parts")).cast("int"))

    columns = ["dim", "part", "block", "row", "vec_id", "v", "length"]

    def searched(queries: DataFrame, candidates: DataFrame) -> DataFrame:
        both = queries.select(*columns, "least", F.lit(0).alias("side")).unionByName(
            candidates.select(*columns, F.lit(None).cast("double").alias("least"), F.lit(1).alias("side"))
        )
        return both.groupBy("dim", "part", "block").applyInArrow(lambda t: _search(t, k), _FOUND)

    # Of each number of components the longest vectors, for every part of the queries.
    by_length = Window.partitionBy("dim").orderBy(F.desc("length"), "row")
    seeds = (
        vectors.withColumn("_n", F.row_number().over(by_length))
        .filter(F.col("_n") <= SEEDS)
        .join(F.broadcast(asked), "dim")
        .withColumn("block", F.lit(-1).cast("long"))
        .withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    )
    unbounded = F.lit(float("-inf"))
    seen = searched(queries.withColumn("block", F.lit(-1).cast("long")).withColumn("least", unbounded), seeds)
    least = seen.groupBy("query_row").agg(F.when(F.count(F.lit(1)) >= k, F.min("score").cast("double")).alias("least"))
    bounded = Stored(
        queries.join(least, F.col("row") == F.col("query_row"), "left").withColumn("least", F.coalesce("least", unbounded)),
        "norm-queries",
    ).df
    # A block goes to a part of the queries only if one of them can reach its score there.
    # Both tables have a row for each block, not for each vector.
    reach = bounded.groupBy("dim", "part").agg(
        F.min(F.when((F.col("least") > 0) & (F.col("length") > 0), F.col("least") / F.col("length")).otherwise(F.lit(0.0))).alias("need")
    )
    tallest = in_blocks.groupBy("dim", "block").agg(F.max("length").alias("longest"))
    pairs = tallest.join(reach, "dim").filter(F.col("longest") >= F.col("need") * (1 - _SLACK)).select("dim", "block", "part")
    found = searched(
        bounded.join(pairs, ["dim", "part"]),
        in_blocks.join(pairs, ["dim", "block"]),
    )
    best = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id", "vec_row")
    return (
        found.withColumn("rank", F.row_number().over(best))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
