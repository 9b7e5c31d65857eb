"""Text quality as a generalised additive model with pairwise interactions.

Each feature of a text falls into a bin, and a lookup table gives the bin's contribution to
the log-odds; so do tables over the bins of a few pairs of features. The tables are the sums
of shallow trees, boosted in a cycle over the features with a small learning rate, then over
the pairs that reduce the loss most. A score is a handful of table lookups.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

from coppice.llm.text import LOWER, prefix_hash, span_hash, text_slices, word_spans

#: Labelled texts that a fit uses at most, those of the smallest hashes of their ids.
FIT_ROWS = 30_000
BINS, ROUNDS, PAIRS, PAIR_ROUNDS, RATE = 32, 150, 8, 60, 0.1
PAIR_BINS = 8
#: Rows a leaf needs, and the ridge on leaf values.
LEAF_ROWS, RIDGE = 10, 2.0

_CLASSES = np.zeros(256, np.int8)  # other ASCII: 0
_CLASSES[list(range(65, 91))] = 1
_CLASSES[list(range(97, 123))] = 2
_CLASSES[list(range(48, 58))] = 3
_CLASSES[[32, *range(9, 14)]] = 4
_CLASSES[128:] = 5
_CLASSES[[33, 63]] = 6
_CLASSES[[44, 46]] = 7
_N_CLASSES = 8

FEATURES = [
    "log_bytes", "log_words", "upper", "digits", "symbols", "wide", "exclaims", "stops",
    "mean_word", "long_words", "single_words", "symbol_words", "distinct_words",
    "distinct_runs", "top_word", "distinct_lines", "line_words", "space",
]


def _per_doc(docs: np.ndarray, hashes: np.ndarray, n_docs: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes of each document, and the count of its most frequent one."""
    order = np.lexsort((hashes, docs))
    d, h = docs[order], hashes[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (d[1:] != d[:-1])
    heads = np.flatnonzero(new)
    sizes = np.diff(np.append(heads, len(h)))
    top = np.zeros(n_docs, np.int64)
    np.maximum.at(top, d[heads], sizes)
    return np.bincount(d[heads], minlength=n_docs), top


def text_features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of ``FEATURES`` for each document; an empty text has zeros."""
    n = len(offsets) - 1
    lengths = np.diff(offsets)
    doc_of = np.repeat(np.arange(n), lengths)
    kinds = np.bincount(doc_of * _N_CLASSES + _CLASSES[data], minlength=n * _N_CLASSES).reshape(n, _N_CLASSES).astype(float)
    per_byte = np.maximum(lengths, 1)
    lower = LOWER[data]
    starts, stops, docs = word_spans(lower, offsets)
    sums = prefix_hash(lower)
    words = np.bincount(docs, minlength=n).astype(float)
    per_word = np.maximum(words, 1)
    size = stops - starts
    hashes = span_hash(sums, starts, stops)
    distinct, top = _per_doc(docs, hashes, n)
    last = _CLASSES[data[stops - 1]] if len(stops) else np.zeros(0, np.int8)
    symbol = (last == 0) | (last == 6)
    runs = max(len(hashes) - 2, 0)
    triple = hashes[:runs] * np.uint64(3) + hashes[1 : runs + 1] * np.uint64(5) + hashes[2:] * np.uint64(7) if runs else hashes[:0]
    same = docs[:runs] == docs[2:] if runs else np.zeros(0, bool)
    distinct_runs, _ = _per_doc(docs[:runs][same], triple[same], n)
    n_runs = np.maximum(words - 2, 1)
    cut = np.zeros(len(data) + 1, bool)
    cut[offsets] = True
    cut[np.flatnonzero(data == 10) + 1] = True
    line_starts = np.flatnonzero(cut[:-1])
    line_stops = np.append(line_starts[1:], len(data)) if len(line_starts) else line_starts
    line_docs = np.searchsorted(offsets, line_starts, "right") - 1
    lines = np.bincount(line_docs, minlength=n)
    distinct_lines, _ = _per_doc(line_docs, span_hash(sums, line_starts, line_stops), n)
    letters = np.maximum(kinds[:, 1] + kinds[:, 2], 1)
    columns = [
        np.log1p(lengths), np.log1p(words), kinds[:, 1] / letters, kinds[:, 3] / per_byte,
        kinds[:, 0] / per_byte, kinds[:, 5] / per_byte, kinds[:, 6] / per_byte, kinds[:, 7] / per_word,
        np.bincount(docs, size, n) / per_word, np.bincount(docs, size > 12, n) / per_word,
        np.bincount(docs, size == 1, n) / per_word, np.bincount(docs, symbol, n) / per_word,
        distinct / per_word, np.where(words > 2, distinct_runs / n_runs, 1.0) * (words > 0), top / per_word,
        distinct_lines / np.maximum(lines, 1), words / np.maximum(lines, 1), kinds[:, 4] / per_byte,
    ]
    return np.stack(columns, axis=1)


def _newton(gradient: np.ndarray, weight: np.ndarray) -> np.ndarray:
    return gradient / (weight + RIDGE)


def _gain(gradient: np.ndarray, weight: np.ndarray) -> np.ndarray:
    return gradient**2 / (weight + RIDGE)


def _two_splits(g: np.ndarray, w: np.ndarray, n: np.ndarray) -> np.ndarray:
    """A tree of up to three leaves over ordered bins, as a table of leaf values."""
    edges = [0, len(g)]
    for _ in range(2):
        best = (1e-9, None)
        for low, high in itertools.pairwise(edges):
            cg, cw, cn = (np.cumsum(x[low:high]) for x in (g, w, n))
            left = slice(0, high - low - 1)
            gain = _gain(cg[left], cw[left]) + _gain(cg[-1] - cg[left], cw[-1] - cw[left]) - _gain(cg[-1], cw[-1])
            gain[(cn[left] < LEAF_ROWS) | (cn[-1] - cn[left] < LEAF_ROWS)] = 0
            if len(gain) and gain.max() > best[0]:
                best = (gain.max(), low + int(gain.argmax()) + 1)
        if best[1] is None:
            break
        edges = sorted([*edges, best[1]])
    table = np.zeros(len(g))
    for low, high in itertools.pairwise(edges):
        table[low:high] = _newton(g[low:high].sum(), w[low:high].sum())
    return table


def _quadrants(g: np.ndarray, w: np.ndarray) -> tuple[float, np.ndarray]:
    """The best cut of both axes into four leaves: its gain and its table."""
    cg, cw = (x.cumsum(0).cumsum(1) for x in (g, w))
    total_g, total_w = cg[-1, -1], cw[-1, -1]

    def leaves(c, total):
        a = c[:-1, :-1]
        b, d = c[:-1, -1:] - a, c[-1:, :-1] - a
        return np.stack([a, b, d, total - a - b - d])

    lg, lw = leaves(cg, total_g), leaves(cw, total_w)
    gain = _gain(lg, lw).sum(0) - _gain(total_g, total_w)
    i, j = np.unravel_index(int(gain.argmax()), gain.shape)
    values = _newton(lg[:, i, j], lw[:, i, j])
    table = np.empty(g.shape)
    table[: i + 1, : j + 1], table[: i + 1, j + 1 :] = values[0], values[1]
    table[i + 1 :, : j + 1], table[i + 1 :, j + 1 :] = values[2], values[3]
    return float(gain[i, j]), table


class AdditiveModel:
    """Bin edges, a table for each feature, and tables for pairs of features."""

    def __init__(self, features: np.ndarray, good: np.ndarray):
        share = (good.sum() + 1) / (len(good) + 2) if len(good) else 0.5
        self.base = float(np.log(share / (1 - share)))
        columns = features.shape[1]
        self.edges = [np.unique(np.quantile(features[:, f], np.arange(1, BINS) / BINS)) if len(good) else np.zeros(0) for f in range(columns)]
        self.tables = [np.zeros(len(e) + 1) for e in self.edges]
        self.pairs: list[tuple[int, int, np.ndarray]] = []
        self.coarse = [np.minimum(np.arange(len(e) + 1) * PAIR_BINS // (len(e) + 1), PAIR_BINS - 1) for e in self.edges]
        if 0 < good.sum() < len(good):
            self._fit(self._binned(features), good.astype(float))

    def _binned(self, features: np.ndarray) -> list[np.ndarray]:
        return [np.searchsorted(e, features[:, f], "right") for f, e in enumerate(self.edges)]

    def _fit(self, bins: list[np.ndarray], good: np.ndarray) -> None:
        score = np.full(len(good), self.base)

        def slopes() -> tuple[np.ndarray, np.ndarray]:
            p = 1 / (1 + np.exp(-score))
            return good - p, p * (1 - p)

        rows = [np.bincount(b, minlength=len(t)) for b, t in zip(bins, self.tables, strict=True)]
        for _ in range(ROUNDS):
            for f, b in enumerate(bins):
                g, w = slopes()
                size = len(self.tables[f])
                step = RATE * _two_splits(np.bincount(b, g, size), np.bincount(b, w, size), rows[f])
                self.tables[f] += step
                score += step[b]
        coarse = [c[b] for c, b in zip(self.coarse, bins, strict=True)]

        def grid(x: np.ndarray, i: int, j: int) -> np.ndarray:
            return np.bincount(coarse[i] * PAIR_BINS + coarse[j], x, PAIR_BINS**2).reshape(PAIR_BINS, PAIR_BINS)

        g, w = slopes()
        gains = [(_quadrants(grid(g, i, j), grid(w, i, j))[0], i, j) for i, j in itertools.combinations(range(len(bins)), 2)]
        self.pairs = [(i, j, np.zeros((PAIR_BINS, PAIR_BINS))) for _, i, j in sorted(gains, reverse=True)[:PAIRS]]
        for _ in range(PAIR_ROUNDS):
            for i, j, table in self.pairs:
                g, w = slopes()
                step = RATE * _quadrants(grid(g, i, j), grid(w, i, j))[1]
                table += step
                score += step[coarse[i], coarse[j]]

    def score(self, features: np.ndarray) -> np.ndarray:
        """Probability of label 1."""
        bins = self._binned(features)
        total = np.full(len(features), self.base)
        for table, b in zip(self.tables, bins, strict=True):
            total += table[b]
        for i, j, table in self.pairs:
            total += table[self.coarse[i][bins[i]], self.coarse[j][bins[j]]]
        return 1 / (1 + np.exp(-total))


def held_out(doc_id: Column) -> Column:
    """The fold whose labels no fit sees; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit_quality(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> AdditiveModel:
    """Fit on up to ``rows`` labelled texts outside the held-out fold.

    Null labels and ids are left out, labels other than 1 count as bad. Rows that share an
    id count once, with the least features of their texts. Without two kinds
    of labels the model gives every text the same score.
    """
    sample = (
        labels.filter(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
        .select("doc_id", (F.col("quality") == 1).alias("good"))
        .orderBy(F.xxhash64("doc_id"), "doc_id", "good")
        .limit(rows)
    )
    texts = docs.select("doc_id", "text").join(F.broadcast(sample.select("doc_id").distinct()), "doc_id", "left_semi")

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offsets in text_slices(batch, "text"):
                found = text_features(data, offsets)
                lists = pa.FixedSizeListArray.from_arrays(pa.array(found.ravel()), found.shape[1]).cast(pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([part.column(0), lists], names=["doc_id", "f"])

    # One row of an id, so that the driver gets no more rows than the sample has.
    schema = StructType([docs.schema["doc_id"], StructField("f", ArrayType(DoubleType()))])
    single = texts.mapInArrow(features, schema).groupBy("doc_id").agg(F.min("f").alias("f"))
    got = single.join(F.broadcast(sample), "doc_id").select("f", "good").orderBy("f", "good").toArrow()
    found = got["f"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, len(FEATURES))
    return AdditiveModel(found, got["good"].to_numpy())


def with_quality(docs: DataFrame, model: AdditiveModel, name: str = "score") -> DataFrame:
    """``docs`` with the score of the whole text; a null text scores as an empty one.

    A column of that name in ``docs`` gives way: the score replaces it.
    """
    docs = docs.drop(name)
    schema = StructType([*docs.schema.fields, StructField(name, DoubleType())])

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offsets in text_slices(batch, "text"):
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(model.score(text_features(data, offsets)))],
                    names=[*part.schema.names, name],
                )

    return docs.mapInArrow(scored, schema)
