"""Exhaustive trees of any depth and any number of labels, kept in tables.

The same questions, ties and leaves as ``tree.train_trees``, but nothing of the tree is in the
driver: rows with their node, label counts, splits and nodes are tables in the scratch folder,
and only the number of open nodes is asked for. Counts are sparse in the labels: a row for each
(node, feature, value, label) that occurs. The impurity of a candidate needs the sum of one
term per label on each side; going from one value to the next changes the terms of the labels
met there only, so running sums of those changes give every candidate without a column per
label.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from coppice.functions.numeric import combined_mass, impurity_term
from coppice.operators.columns import col
from coppice.operators.ordering import row_index
from coppice.operators.profile import CATEGORY_VALUES, feature_cell, is_number
from coppice.operators.tree import TIE_DIGITS
from coppice.operators.treemodel import ROOT
from coppice.session import ScratchTable

#: Tables of nodes or buckets up to this many rows are sent to all executors.
BROADCAST_ROWS = 200_000
#: Values of a feature that a running sum passes in one task, about; more are cut in segments.
SEGMENT_VALUES = 4096
#: A node of at most this many different rows is finished in one task.
LOCAL_CELLS = 8192
#: Different rows that a task takes on at once, unless one node alone has more.
BATCH_CELLS = 1 << 16
#: Node ids made in tasks: this bit, the id of the node they hang on, and a number.
_LOCAL_BIT, _LOCAL_SHIFT = 1 << 58, 20
_NODE_TYPES = (
    "node_id bigint, depth int, feature string, op string, value_num double, value_str string, "
    "yes_id bigint, no_id bigint, label string, n bigint"
)
_NODES = ["node_id", "depth", "feature", "op", "value_num", "value_str", "yes_id", "no_id", "label", "n"]


def _side(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


class _Growth:
    def __init__(self, df, features, label, criterion, max_depth, min_samples, category_values, weight, local_cells):
        self.local_cells = local_cells
        self.features, self.criterion = list(features), criterion
        self.max_depth, self.min_samples = max_depth, min_samples
        types = dict(df.dtypes)
        self.numeric = [is_number(types[f]) for f in self.features]
        cells = [feature_cell(f, types[f]) for f in self.features]
        values = [(num if is_num else text).alias(f"f{i}") for i, ((num, text), is_num) in enumerate(zip(cells, self.numeric))]
        n = F.lit(1) if weight is None else col(weight)
        rows = df.filter(col(label).isNotNull()).select(col(label).alias("y"), n.cast("bigint").alias("w"), *values)
        names = [f"f{i}" for i in range(len(self.features))]
        # Equal rows count once; how often is their weight.
        self.rows = ScratchTable(rows.filter("w > 0").groupBy("y", *names).agg(F.sum("w").alias("w")), "growth-rows")
        self._describe(category_values)

    def _describe(self, category_values: int) -> None:
        """Which features are asked ``<=``, and segments of those with many values."""
        numbers = [i for i, is_num in enumerate(self.numeric) if is_num]
        self.continuous, self.segmented = set(), []
        if not numbers:
            return
        sketch = [F.approx_count_distinct(f"f{i}").alias(f"d{i}") for i in numbers]
        missing = [F.count_if(F.col(f"f{i}").isNull()).alias(f"m{i}") for i in numbers]
        rough = self.rows.df.agg(*sketch, *missing).first()
        doubtful = [i for i in numbers if rough[f"d{i}"] <= 2 * category_values + 2]
        exact = self.rows.df.agg(*[F.count_distinct(f"f{i}").alias(f"d{i}") for i in doubtful]).first() if doubtful else {}
        for i in numbers:
            known = exact[f"d{i}"] if i in doubtful else category_values + 1
            if known + (rough[f"m{i}"] > 0) > category_values:
                self.continuous.add(i)
        self.segmented = [i for i in sorted(self.continuous) if rough[f"d{i}"] > SEGMENT_VALUES]
        rows = self.rows.df
        for i in self.segmented:
            n = int(rough[f"d{i}"] // SEGMENT_VALUES) + 2
            marks = rows.select(f"f{i}").approxQuantile(f"f{i}", [k / n for k in range(1, n)], 0.25 / n)
            edges = sorted(set(marks) - {float("-inf"), float("inf")}) or [0.0]
            rows = Bucketizer(
                splits=[float("-inf"), *edges, float("inf")], inputCol=f"f{i}", outputCol=f"s{i}", handleInvalid="keep"
            ).transform(rows)
        if self.segmented:
            cut = ScratchTable(rows, "growth-rows")
            self.rows.drop()
            self.rows = cut

    # One level ------------------------------------------------------------------

    def _counts(self, rows: DataFrame) -> DataFrame:
        """Rows per node, feature, value and label."""
        entries = []
        for i, is_num in enumerate(self.numeric):
            value = F.col(f"f{i}")
            entries.append(
                F.struct(
                    F.lit(i).alias("f"),
                    (F.col(f"s{i}").cast("int") if i in self.segmented else F.lit(0)).alias("segment"),
                    (value if is_num else F.lit(None).cast("double")).alias("num"),
                    (F.lit(None).cast("string") if is_num else value).alias("str"),
                )
            )
        each = rows.select("node", "y", "w", F.inline(F.array(*entries))).filter("num IS NOT NULL OR str IS NOT NULL")
        return each.groupBy("node", "f", "segment", "num", "str", "y").agg(F.sum("w").alias("c"))

    def _running(self, df: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
        """Running sums along the values of a feature; segments meet by their totals."""
        keys = list(keys)
        upto = Window.partitionBy(*keys, "segment").orderBy("num").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        summed = df.withColumns({f"{c}_upto": F.sum(c).over(upto) for c in values})
        if not self.segmented:
            return summed
        before = Window.partitionBy(*keys).orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
        totals = df.groupBy(*keys, "segment").agg(*[F.sum(c).alias(c) for c in values])
        offsets = totals.select(*keys, "segment", *[F.sum(c).over(before).alias(f"{c}_before") for c in values])
        offsets = offsets.filter(F.col(f"{values[0]}_before").isNotNull())
        joined = summed.join(offsets, [*keys, "segment"], "left")
        shifted = {f"{c}_upto": F.col(f"{c}_upto") + F.coalesce(f"{c}_before", F.lit(0)) for c in values}
        return joined.withColumns(shifted).drop(*[f"{c}_before" for c in values])

    def _best(self, rows: DataFrame, totals: DataFrame, few: bool) -> DataFrame:
        """Best question of every open node that leaves no side empty: node, f, num, str."""
        asks_upto = F.col("f").isin(sorted(self.continuous)) if self.continuous else F.lit(False)
        counts = self._running(self._counts(rows), ["node", "f", "y"], ["c"])
        labels = totals.select("node", "y", "t", "n", "mass")
        counts = counts.join(F.broadcast(labels) if few else labels, ["node", "y"])
        after = F.when(asks_upto, F.col("c_upto")).otherwise(F.col("c"))
        before = after - F.col("c")

        def term(c: Column) -> Column:
            return impurity_term(c, self.criterion)

        changes = counts.groupBy("node", "f", "segment", "num", "str").agg(
            F.sum("c").alias("yes"),
            F.sum(term(after) - term(before)).alias("gained"),
            F.sum(term(F.col("t") - after) - term(F.col("t") - before)).alias("lost"),
            F.first("n").alias("n"),
            F.first("mass").alias("mass"),
        )
        along = self._running(changes, ["node", "f"], ["yes", "gained", "lost"])

        def value(c: str) -> Column:
            return F.when(asks_upto, F.col(f"{c}_upto")).otherwise(F.col(c))

        yes, no = value("yes"), F.col("n") - value("yes")
        mass = combined_mass(yes, value("gained"), self.criterion) + combined_mass(
            no, F.col("mass") + value("lost"), self.criterion
        )
        merit = F.lit(0.0) - F.round(mass / F.col("n"), TIE_DIGITS)
        best = along.select("node", "n", F.struct(merit.alias("merit"), "f", "num", "str", yes.alias("yes")).alias("s"))
        best = best.groupBy("node").agg(F.max("s").alias("s"), F.first("n").alias("n"))
        return best.select("node", "s.f", "s.num", "s.str", "n", F.col("s.yes").alias("yes")).filter("yes > 0 AND yes < n").drop("yes")

    def _totals(self, rows: DataFrame) -> ScratchTable:
        """Label counts of the nodes that rows are in, and how many different rows they have."""
        counted = rows.groupBy("node", "y").agg(F.sum("w").alias("t"), F.count(F.lit(1)).alias("cells"))
        node = Window.partitionBy("node")
        return ScratchTable(
            counted.select(
                "node", "y", "t",
                F.sum("t").over(node).alias("n"),
                F.sum("cells").over(node).alias("cells"),
                F.count(F.lit(1)).over(node).alias("kinds"),
                F.sum(impurity_term(F.col("t"), self.criterion)).over(node).alias("mass"),
                F.row_number().over(node.orderBy(F.desc("t"), "y")).alias("place"),
            ),
            "growth-totals",
        )

    def run(self) -> ScratchTable:
        rows = self.rows.df.withColumn("node", F.lit(ROOT).cast("bigint"))
        held: list[ScratchTable] = []
        small_rows: list[DataFrame] = []
        found: list[DataFrame] = []
        stored_rows, next_id, depth = self.rows, ROOT + 1, 0
        names = F.element_at(F.array(*[F.lit(f) for f in self.features]), F.col("f") + 1)
        asks_upto = F.col("f").isin(sorted(self.continuous)) if self.continuous else F.lit(False)
        while True:
            totals = self._totals(rows)
            held.append(totals)
            at_end = self.max_depth is not None and depth >= self.max_depth
            unfinished = F.lit(False) if at_end else (F.col("kinds") > 1) & (F.col("n") >= self.min_samples)
            large = unfinished & (F.col("cells") > self.local_cells)
            first = F.col("place") == 1
            n_large, n_counts, n_small = totals.df.agg(
                F.count_if(first & large), F.count_if(large), F.count_if(first & unfinished & ~large)
            ).first()
            if n_small:
                few = totals.df.filter(first & unfinished & ~large).select("node")
                part = ScratchTable(rows.join(_side(few, n_small), "node", "left_semi"), "growth-small")
                held.append(part)
                small_rows.append(part.df.withColumn("depth", F.lit(depth)))
            info = totals.df.filter(first & (large | ~unfinished)).select(
                F.col("node").alias("node_id"), F.lit(depth).alias("depth"), F.col("y").cast("string").alias("label"), "n"
            )
            n_splits = 0
            if n_large:
                ids = totals.df.filter(first & large).select("node")
                best = self._best(rows.join(_side(ids, n_large), "node", "left_semi"), totals.df.filter(large), n_counts <= BROADCAST_ROWS)
                if n_large <= BROADCAST_ROWS:
                    numbered = best.withColumn("place", F.row_number().over(Window.orderBy("node")))
                else:
                    numbered = row_index(best, ["node"], "place")
                splits = ScratchTable(
                    numbered.select(
                        "node", "f", "num", "str", F.when(asks_upto, "<=").otherwise("=").alias("op"),
                        (F.lit(next_id) + 2 * (F.col("place") - 1)).cast("bigint").alias("yes_id"),
                    ).withColumn("no_id", F.col("yes_id") + 1),
                    "growth-splits",
                )
                held.append(splits)
                n_splits = splits.df.count()
            if n_splits:
                asked = splits.df.select(
                    F.col("node").alias("node_id"), names.alias("feature"), "op",
                    F.col("num").alias("value_num"), F.col("str").alias("value_str"), "yes_id", "no_id",
                )
                level = info.join(_side(asked, n_splits), "node_id", "left")
                level = level.withColumn("label", F.when(F.col("feature").isNull(), F.col("label")))
            else:
                missing = [f for f in StructType.fromDDL(_NODE_TYPES).fields if f.name not in info.columns]
                level = info.withColumns({f.name: F.lit(None).cast(f.dataType) for f in missing})
            found.append(level.select(*_NODES))
            if not n_splits:
                break
            moved = ScratchTable(self._advance(rows, splits.df, n_splits), "growth-rows")
            stored_rows.drop()
            stored_rows, rows, next_id, depth = moved, moved.df, next_id + 2 * n_splits, depth + 1
        if small_rows:
            found.append(self._finish(reduce(DataFrame.unionByName, small_rows)))
        nodes = ScratchTable(
            reduce(DataFrame.unionByName, found).select(F.lit(0).alias("tree_id"), *[F.col(f.name).cast(f.dataType) for f in StructType.fromDDL(_NODE_TYPES)]),
            "nodes",
        )
        for t in [*held, stored_rows]:
            t.drop()
        return nodes

    def _finish(self, rows: DataFrame) -> DataFrame:
        """Subtrees of nodes with few different rows, in tasks."""
        names = [f"f{i}" for i in range(len(self.features))]
        numeric, continuous = self.numeric, [i in self.continuous for i in range(len(self.features))]
        features, criterion = self.features, self.criterion
        min_samples, max_depth = self.min_samples, self.max_depth
        dealt = rows.select("node", "depth", F.col("y").cast("string").alias("label"), "y", "w", *names)
        dealt = dealt.repartition("node").sortWithinPartitions("node")

        def grown(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held: list[pa.Table] = []
            size = 0

            def finished(table: pa.Table) -> pa.RecordBatch:
                return _subtrees(table, features, numeric, continuous, criterion, min_samples, max_depth)

            for batch in batches:
                held.append(pa.Table.from_batches([batch]))
                size += batch.num_rows
                if size >= BATCH_CELLS:
                    table = pa.concat_tables(held)
                    node = table.column("node").to_numpy()
                    cut = int(np.searchsorted(node, node[-1]))  # the last node may go on
                    if cut:
                        yield finished(table.slice(0, cut))
                    held, size = [table.slice(cut)], table.num_rows - cut
            if size:
                yield finished(pa.concat_tables(held))

        return dealt.mapInArrow(grown, _NODE_TYPES)

    def _advance(self, rows: DataFrame, splits: DataFrame, n: int) -> DataFrame:
        """Rows of split nodes in the child that their answer leads to; others go."""
        joined = rows.join(_side(splits, n), "node")
        answer = None
        for i, is_num in enumerate(self.numeric):
            value = F.col(f"f{i}")
            if is_num:
                asked = F.when(F.col("op") == "<=", value <= F.col("num")).otherwise(value == F.col("num"))
            else:
                asked = value == F.col("str")
            here = F.col("f") == i
            answer = F.when(here, asked) if answer is None else answer.when(here, asked)
        child = F.when(answer, F.col("yes_id")).otherwise(F.col("no_id"))
        return joined.select(*[child.alias(c) if c == "node" else c for c in rows.columns])


def _groups(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order by all keys, the first one first, and where a new combination begins in it."""
    order = np.lexsort(keys[::-1])
    fresh = np.ones(len(order), bool)
    if len(order):
        fresh[1:] = reduce(np.logical_or, [k[order][1:] != k[order][:-1] for k in keys])
    return order, np.flatnonzero(fresh)


def _cumulated(x: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Running sums that start afresh at each of ``first``."""
    upto = np.cumsum(x)
    before = upto[first] - x[first]
    return upto - np.repeat(before, np.diff(np.append(first, len(x))))


def _term(x: np.ndarray, criterion: str) -> np.ndarray:
    x = x.astype(np.longdouble)
    if criterion == "gini":
        return x * x
    return x * np.log2(np.maximum(x, 1))


def _mass(n: np.ndarray, terms: np.ndarray, criterion: str) -> np.ndarray:
    n = n.astype(np.longdouble)
    return n - terms / np.maximum(n, 1) if criterion == "gini" else _term(n, criterion) - terms


def _best_of_feature(node, x, y, w, total_of, n, mass, upto, criterion):
    """Merit, value and rows of the yes side of the best question of each node on one feature."""
    order, first = _groups(node, x, y)
    cell_node, cell_x, cell_y = node[order][first], x[order][first], y[order][first]
    c = np.add.reduceat(w[order], first)
    after = c
    if upto:
        by_label, starts = _groups(cell_node, cell_y)  # the order by value stays within a label
        after = np.empty_like(c)
        after[by_label] = _cumulated(c[by_label], starts)
    every = total_of(cell_node, cell_y)
    gained = _term(after, criterion) - _term(after - c, criterion)
    lost = _term(every - after, criterion) - _term(every - after + c, criterion)
    fresh = np.ones(len(c), bool)
    fresh[1:] = (cell_node[1:] != cell_node[:-1]) | (cell_x[1:] != cell_x[:-1])
    first = np.flatnonzero(fresh)
    at, value = cell_node[first], cell_x[first]
    yes, gained, lost = (np.add.reduceat(v, first) for v in (c, gained, lost))
    starts = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
    if upto:
        yes, gained, lost = (_cumulated(v, starts) for v in (yes, gained, lost))
    both = _mass(yes, gained, criterion) + _mass(n[at] - yes, mass[at] + lost, criterion)
    merit = -np.round((both / n[at]).astype(np.float64), TIE_DIGITS) + 0.0
    # Of equal merits the largest value.
    last = np.append(starts[1:], len(at)) - 1
    best = np.lexsort((value, merit, at))[last]
    return at[best], merit[best], value[best], yes[best]


def _subtrees(table: pa.Table, features, numeric, continuous, criterion, min_samples, max_depth) -> pa.RecordBatch:
    """All nodes below (and with) the nodes of ``table``, level by level for all of them."""
    roots, node = np.unique(table.column("node").to_numpy(), return_inverse=True)
    depth = np.zeros(len(roots), np.int64)
    depth[node] = table.column("depth").to_numpy()
    labels, y = np.unique(table.column("y").to_numpy(zero_copy_only=False), return_inverse=True)
    names = np.empty(len(labels), object)
    names[y] = table.column("label").to_numpy(zero_copy_only=False)
    w = table.column("w").to_numpy()
    values, texts = [], []
    for i, is_num in enumerate(numeric):
        column = table.column(f"f{i}")
        if is_num:
            values.append(column.to_numpy(zero_copy_only=False).astype(np.float64))
            texts.append(None)
            continue
        present = column.is_valid().to_numpy(zero_copy_only=False)
        # Text in the order of its UTF-8 bytes, as numbers; missing ones are not a number.
        known, code = np.unique(column.to_numpy(zero_copy_only=False)[present].astype(object), return_inverse=True)
        x = np.full(len(present), np.nan)
        x[present] = code
        values.append(x)
        texts.append(known)
    ids, root_of = roots.copy(), np.arange(len(roots))
    out: dict[str, list] = {name: [] for name in _NODES}

    def emit(which: np.ndarray, **given: np.ndarray) -> None:
        some = {"node_id": ids[which], "depth": depth[which], "n": n[which], **given}
        for name in _NODES:
            out[name] += some[name].tolist() if name in some else [None] * len(which)

    made = 0
    while len(w):
        n_nodes = len(ids)
        order, first = _groups(node, y)
        held_node, held_y, t = node[order][first], y[order][first], np.add.reduceat(w[order], first)
        n = np.bincount(held_node, t, n_nodes).astype(np.int64)
        kinds = np.bincount(held_node, minlength=n_nodes)
        starts = np.searchsorted(held_node, np.arange(n_nodes))
        mass = np.add.reduceat(_term(t, criterion), starts)
        majority = held_y[np.lexsort((held_y, -t, held_node))[starts]]
        keys = held_node * len(labels) + held_y

        def total_of(a: np.ndarray, b: np.ndarray) -> np.ndarray:
            return t[np.searchsorted(keys, a * len(labels) + b)]

        unfinished = (kinds > 1) & (n >= min_samples)
        if max_depth is not None:
            unfinished &= depth < max_depth
        best_merit, best_value = np.full(n_nodes, -np.inf), np.zeros(n_nodes)
        best_feature, best_yes = np.zeros(n_nodes, np.int64), np.zeros(n_nodes, np.int64)
        for i, x in enumerate(values):
            use = unfinished[node] & ~np.isnan(x)
            if use.any():
                at, merit, value, yes = _best_of_feature(node[use], x[use], y[use], w[use], total_of, n, mass, continuous[i], criterion)
                better = merit >= best_merit[at]
                at = at[better]
                best_merit[at], best_value[at], best_yes[at], best_feature[at] = merit[better], value[better], yes[better], i
        split = unfinished & (best_yes > 0) & (best_yes < n)
        leaves = np.flatnonzero(~split)
        emit(leaves, label=names[majority[leaves]])
        asked = np.flatnonzero(split)
        yes_id = _LOCAL_BIT + (roots[root_of[asked]] << _LOCAL_SHIFT) + made + 2 * np.arange(len(asked))
        made += 2 * len(asked)
        f = best_feature[asked]
        is_num = np.array(numeric, bool)[f]
        value_num, value_str = best_value[asked].astype(object), np.empty(len(asked), object)
        for j in np.flatnonzero(~is_num):
            value_num[j], value_str[j] = None, str(texts[f[j]][int(best_value[asked[j]])])
        emit(
            asked, feature=np.array(features, object)[f], op=np.where(np.array(continuous, bool)[f], "<=", "=").astype(object),
            value_num=value_num, value_str=value_str, yes_id=yes_id, no_id=yes_id + 1,
        )
        child = np.full(n_nodes, -1)
        child[asked] = 2 * np.arange(len(asked))
        moved = split[node]
        node, y, w, values = node[moved], y[moved], w[moved], [x[moved] for x in values]
        x = np.select([best_feature[node] == i for i in range(len(values))], values) if len(node) else w.astype(np.float64)
        upto = np.array(continuous, bool)[best_feature[node]]
        answer = np.where(upto, x <= best_value[node], x == best_value[node])
        node = child[node] + ~answer
        ids = np.stack((yes_id, yes_id + 1), axis=1).ravel()
        depth, root_of = np.repeat(depth[asked] + 1, 2), np.repeat(root_of[asked], 2)
    types = {"bigint": pa.int64(), "int": pa.int32(), "double": pa.float64(), "string": pa.string()}
    kinds_of = [types[c.split()[1]] for c in _NODE_TYPES.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(out[c], k) for c, k in zip(_NODES, kinds_of, strict=True)], names=_NODES)


def grow_nodes(
    df: DataFrame,
    features: Sequence[str],
    label: str,
    criterion: str = "gini",
    max_depth: int | None = None,
    min_samples: int = 2,
    category_values: int = CATEGORY_VALUES,
    weight: str | None = None,
    local_cells: int = LOCAL_CELLS,
) -> ScratchTable:
    """The node table of one exhaustive tree, without a depth limit by default.

    Questions, ties and leaves are those of ``tree.train_trees``; ``category_values=0`` asks
    ``<=`` of every number. ``weight`` is a column of how often a row counts. Nodes of at most
    ``local_cells`` different rows are finished in tasks, which changes no question. Node ids are
    unique, not gapless; the two children of a question are neighbours, yes first. Rows without
    a label take no part; without any rows there are no nodes.
    """
    return _Growth(df, features, label, criterion, max_depth, min_samples, category_values, weight, local_cells).run()
