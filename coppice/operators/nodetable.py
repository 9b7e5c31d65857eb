"""Trees as node tables: merging equal answers, text, paths and scoring, all as DataFrames.

A table holds any number of trees, one row for each node (``treemodel.NODE_SCHEMA``). What
depends on subtrees goes from the deepest level up, a grouped join for each level; nothing but
the number of levels reaches the driver.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from coppice.operators.columns import col
from coppice.operators.profile import is_number, missing_to_null
from coppice.operators.treemodel import ROOT
from coppice.session import ScratchTable

#: Node tables up to this many rows are sent to all executors for scoring; larger ones are
#: joined level by level.
WALK_NODES = 1 << 18
#: Levels joined before rows are stored.
STORED_LEVELS = 8
_CONTENT = ["feature", "op", "value_num", "value_str", "yes_id", "no_id", "label"]


def question_text(op: Column | None = None) -> Column:
    """``feature op value`` of a node, null for a leaf; numbers as Spark writes doubles."""
    value = F.coalesce(F.col("value_num").cast("string"), F.col("value_str"))
    return F.when(F.col("feature").isNotNull(), F.concat_ws(" ", "feature", "op", value))


def _levels(nodes: DataFrame) -> int:
    deepest = nodes.agg(F.max("depth")).first()[0]
    return -1 if deepest is None else deepest


def _with_parents(nodes: DataFrame) -> DataFrame:
    sides = F.array(
        *[F.struct(F.col(f"{s}_id").alias("node_id"), F.col("node_id").alias("parent"), F.lit(s).alias("side")) for s in ("yes", "no")]
    )
    edges = nodes.filter("feature IS NOT NULL").select("tree_id", F.inline(sides))
    return nodes.join(edges, ["tree_id", "node_id"], "left")


def _from_leaves_up(
    nodes: DataFrame, values: Sequence[str], own: Callable[[], dict[str, Column]]
) -> tuple[DataFrame, list[ScratchTable]]:
    """``nodes`` with ``values``, which ``own`` makes from yes_<value> and no_<value> of the children.

    Both are null for leaves. Also returns the tables that hold the levels.
    """
    tagged = ScratchTable(_with_parents(nodes), "tree-parents")
    held, below, out = [tagged], None, None
    for depth in range(_levels(tagged.df), -1, -1):
        here = tagged.df.filter(F.col("depth") == depth)
        if below is None:
            level = here.withColumns({f"{s}_{v}": F.lit(None).cast(StringType()) for s in ("yes", "no") for v in values})
        else:
            answers = below.groupBy("tree_id", F.col("parent").alias("node_id")).agg(
                *[F.max(F.when(F.col("side") == s, F.col(v))).alias(f"{s}_{v}") for s in ("yes", "no") for v in values]
            )
            level = here.join(answers, ["tree_id", "node_id"], "left")
        stored = ScratchTable(level.withColumns(own()).drop(*[f"{s}_{v}" for s in ("yes", "no") for v in values]), "tree-level")
        held.append(stored)
        below = stored.df
        out = below if out is None else out.unionByName(below)
    if out is None:
        out = tagged.df.withColumns({v: F.lit(None).cast("string") for v in values})
    return out, held


def with_texts(nodes: DataFrame) -> ScratchTable:
    """``nodes`` with ``question`` and ``text``: ``{'question': [yes, no]}`` down to quoted labels.

    The text of a root is its whole tree.
    """

    def own() -> dict[str, Column]:
        inner = F.concat(F.lit("{'"), question_text(), F.lit("': ["), F.col("yes_text"), F.lit(", "), F.col("no_text"), F.lit("]}"))
        return {"text": F.when(F.col("feature").isNull(), F.concat(F.lit("'"), "label", F.lit("'"))).otherwise(inner)}

    out, held = _from_leaves_up(nodes, ["text"], own)
    texts = ScratchTable(out.drop("parent", "side").withColumn("question", question_text()), "tree-texts")
    for t in held:
        t.drop()
    return texts


def collapsed(nodes: DataFrame) -> ScratchTable:
    """Node table without questions whose two answers are equal trees, from the leaves up.

    Subtrees are equal if their digests are. A merged node keeps its id and its rows and takes
    the content of its answer; depths are counted anew. ``path``: answers from the root, as
    ``y`` and ``n``.
    """

    def own() -> dict[str, Column]:
        leaf, same = F.col("feature").isNull(), F.col("yes_sign") == F.col("no_sign")
        asked = F.to_json(F.struct("feature", "op", "value_num", "value_str", "yes_sign", "no_sign"))
        # The node whose content counts: the answer's own, which may be merged itself.
        source = F.when(~leaf & same, F.col("yes_source")).otherwise(F.col("node_id").cast("string"))
        sign = F.when(leaf, F.sha2(F.col("label"), 256)).when(same, F.col("yes_sign")).otherwise(F.sha2(asked, 256))
        return {"sign": sign, "source": source}

    signed, held = _from_leaves_up(nodes, ["sign", "source"], own)
    signed = ScratchTable(
        signed.select("tree_id", "node_id", "depth", *_CONTENT, "n", F.col("source").cast("bigint").alias("source")), "tree-signed"
    )
    content = signed.df.select("tree_id", F.col("node_id").alias("source"), *_CONTENT)
    places = signed.df.select("tree_id", "node_id", "n", "source")
    merged = ScratchTable(places.join(content, ["tree_id", "source"]).drop("source"), "tree-merged")
    held += [signed, merged]
    depth = 0
    level = ScratchTable(merged.df.filter(F.col("node_id") == ROOT).withColumns({"depth": F.lit(0), "path": F.lit("")}), "tree-level")
    held.append(level)
    out = level.df
    while True:
        children = F.array(
            *[F.struct(F.col(f"{s}_id").alias("node_id"), F.concat("path", F.lit(s[0])).alias("path")) for s in ("yes", "no")]
        )
        wanted = level.df.filter("feature IS NOT NULL").select("tree_id", F.inline(children))
        depth += 1
        level = ScratchTable(merged.df.join(wanted, ["tree_id", "node_id"]).withColumn("depth", F.lit(depth)), "tree-level")
        held.append(level)
        if level.df.isEmpty():
            break
        out = out.unionByName(level.df)
    kept = ScratchTable(out.select("tree_id", "node_id", "depth", *_CONTENT, "n", "path"), "tree-collapsed")
    for t in held:
        t.drop()
    return kept


# Scoring ------------------------------------------------------------------------


def _question_columns(df: DataFrame, features: Sequence[str]) -> list[Column]:
    """Features as questions see them: numbers as doubles (NaN is missing), the rest as text."""
    types = dict(df.dtypes)
    return [
        (missing_to_null(col(f), types[f]).cast("double") if is_number(types[f]) else col(f).cast("string")).alias(f"_f{i}")
        for i, f in enumerate(features)
    ]


class _Forest:
    """Nodes of some trees as arrays; questions point to features by number."""

    def __init__(self, table: pa.Table, features: Sequence[str]):
        tree, node = table.column("tree_id").to_numpy(), table.column("node_id").to_numpy()
        index = {f: i for i, f in enumerate(features)}
        self.asked = np.array([index.get(f, -1) for f in table.column("feature").to_pylist()], np.int64)
        self.upto = np.array([o == "<=" for o in table.column("op").to_pylist()], bool)
        self.num = np.array([np.nan if v is None else v for v in table.column("value_num").to_pylist()], float)
        self.text = np.array(table.column("value_str").to_pylist(), object)
        self.label = np.array(table.column("label").to_pylist(), object)
        self.trees, first = np.unique(tree, return_index=True)
        self.root, self.yes, self.no = np.zeros(len(first), np.int64), np.zeros(len(tree), np.int64), np.zeros(len(tree), np.int64)
        below = [table.column(c).fill_null(ROOT).to_numpy() for c in ("yes_id", "no_id")]
        for i, (start, stop) in enumerate(zip(first, [*first[1:], len(tree)], strict=True)):
            ids = node[start:stop]  # the table is sorted by tree and node
            self.root[i] = start + np.searchsorted(ids, ROOT)
            for out, c in zip((self.yes, self.no), below, strict=True):
                out[start:stop] = start + np.searchsorted(ids, c[start:stop])

    def leaves(self, root: int, values: list[np.ndarray], n: int) -> np.ndarray:
        """Labels of the leaves that n rows reach from ``root``, all rows a level at a time."""
        at, rows = np.full(n, root), np.arange(n)
        while len(rows):
            rows = rows[self.asked[at[rows]] >= 0]
            here = at[rows]
            feature, answer = self.asked[here], np.zeros(len(rows), bool)
            for i, x in enumerate(values):
                some = np.flatnonzero(feature == i)
                if not len(some):
                    continue
                x, node = x[rows[some]], here[some]
                if x.dtype == object:
                    answer[some] = x == self.text[node]
                else:
                    answer[some] = np.where(self.upto[node], x <= self.num[node], x == self.num[node])
            at[rows] = np.where(answer, self.yes[here], self.no[here])
        return self.label[at]


def _values(batch: pa.RecordBatch, first: int, n: int) -> list[np.ndarray]:
    out = []
    for i in range(first, first + n):
        column = batch.column(i)
        is_text = pa.types.is_string(column.type) or pa.types.is_large_string(column.type)
        out.append(column.to_numpy(zero_copy_only=False).astype(object if is_text else np.float64))
    return out


def _asked_features(nodes: DataFrame) -> list[str]:
    return [r[0] for r in nodes.filter("feature IS NOT NULL").select("feature").distinct().orderBy("feature").collect()]


def _tree_batches(nodes: DataFrame, trees: Sequence[int] | None) -> tuple[list[list[int]], list[int]]:
    """Trees in batches of at most ``WALK_NODES`` nodes, and trees that have more by themselves."""
    sizes = {r[0]: r[1] for r in nodes.groupBy("tree_id").count().collect()}  # a number for each tree
    batches, large, held = [], [], 0
    for t in sorted(sizes if trees is None else [t for t in trees if t in sizes]):
        if sizes[t] > WALK_NODES:
            large.append(t)
            continue
        if not batches or held + sizes[t] > WALK_NODES:
            batches.append([])
            held = 0
        batches[-1].append(t)
        held += sizes[t]
    return batches, large


def _forest(df: DataFrame, nodes: DataFrame, trees: list[int], features: list[str]):
    chosen = nodes.filter(F.col("tree_id").isin(trees)).select("tree_id", "node_id", *_CONTENT)
    return df.sparkSession.sparkContext.broadcast(_Forest(chosen.orderBy("tree_id", "node_id").toArrow(), features))


def predict_by_nodes(
    df: DataFrame, nodes: DataFrame, name: str = "prediction", label_type: str = "string", tree_id: int = 0
) -> DataFrame:
    """``df`` with the label of the leaf that each row reaches in one tree of a node table.

    Any depth. Tables of at most ``WALK_NODES`` nodes go to all executors, where batches of rows
    walk down together; larger ones are joined with the rows level by level. A missing value
    answers no. Without nodes the prediction is null.
    """
    if nodes.filter(F.col("tree_id") == tree_id).isEmpty():
        return df.withColumn(name, F.lit(None).cast(label_type))
    return predict_each_by_nodes(df, nodes, name, label_type, [tree_id]).drop("tree_id")


def predict_each_by_nodes(
    df: DataFrame, nodes: DataFrame, name: str = "prediction", label_type: str = "string", trees: Sequence[int] | None = None
) -> DataFrame:
    """Every row with every tree (or those of ``trees``): ``(..., tree_id, prediction)``.

    Rows never meet trees by a join on the root, so no key holds all rows: trees go to the
    executors in batches of at most ``WALK_NODES`` nodes. Only a tree larger than that by itself
    is joined, level by level.
    """
    features, n_columns = _asked_features(nodes), len(df.columns)
    schema = StructType([*df.schema.fields, StructField("tree_id", IntegerType()), StructField(name, StringType())])
    rows = df.select(*[col(c) for c in df.columns], *_question_columns(df, features))
    batches, large = _tree_batches(nodes, trees)
    parts = []
    for some in batches:
        held = _forest(df, nodes, some, features)

        def walked(arrow: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            forest = held.value
            for batch in arrow:
                values = _values(batch, n_columns, len(features))
                for tree, root in zip(forest.trees.tolist(), forest.root.tolist(), strict=True):
                    found = pa.array(forest.leaves(root, values, batch.num_rows), pa.string())
                    ids = pa.array(np.full(batch.num_rows, tree, np.int32))
                    yield pa.RecordBatch.from_arrays([*batch.columns[:n_columns], ids, found], names=schema.names)

        parts.append(rows.mapInArrow(walked, schema))
    for t in large:
        one = _walk_by_joins(df, nodes.filter(F.col("tree_id") == t).drop("tree_id"), features, name)
        parts.append(one.select(*[col(c) for c in df.columns], F.lit(t).alias("tree_id"), name))
    if not parts:
        return df.limit(0).withColumns({"tree_id": F.lit(None).cast("int"), name: F.lit(None).cast(label_type)})
    return reduce(DataFrame.unionByName, parts).withColumn(name, F.col(name).cast(label_type))


def accuracies_by_nodes(df: DataFrame, nodes: DataFrame, label: str, trees: Sequence[int] | None = None) -> DataFrame:
    """Share of rows that each tree gets right: tree_id, accuracy.

    Tasks count the hits of each tree on their rows, so rows times trees exist nowhere as rows.
    A row without a label is no hit.
    """
    features = _asked_features(nodes)
    rows = df.select(col(label).cast("string").alias("_y"), *_question_columns(df, features))
    batches, large = _tree_batches(nodes, trees)
    parts = []
    for some in batches:
        held = _forest(df, nodes, some, features)

        def counted(arrow: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            forest, hits, n = held.value, np.zeros(len(held.value.trees), np.int64), 0
            for batch in arrow:
                values, y = _values(batch, 1, len(features)), batch.column(0).to_numpy(zero_copy_only=False)
                known = batch.column(0).is_valid().to_numpy(zero_copy_only=False)
                for i, root in enumerate(forest.root.tolist()):
                    hits[i] += int(((forest.leaves(root, values, len(y)) == y) & known).sum())
                n += len(y)
            yield pa.RecordBatch.from_arrays(
                [pa.array(forest.trees.astype(np.int32)), pa.array(hits), pa.array(np.full(len(hits), n))], names=["tree_id", "hits", "n"]
            )

        parts.append(rows.mapInArrow(counted, "tree_id int, hits bigint, n bigint"))
    for t in large:
        scored = _walk_by_joins(df, nodes.filter(F.col("tree_id") == t).drop("tree_id"), features, "_found")
        hit = F.coalesce(F.col("_found") == col(label).cast("string"), F.lit(False))
        parts.append(scored.agg(F.lit(t).alias("tree_id"), F.count_if(hit).alias("hits"), F.count(F.lit(1)).alias("n")))
    if not parts:
        return df.sparkSession.createDataFrame([], "tree_id int, accuracy double")
    sums = reduce(DataFrame.unionByName, parts).groupBy("tree_id").agg(F.sum("hits").alias("hits"), F.sum("n").alias("n"))
    return sums.select("tree_id", F.try_divide(F.col("hits").cast("double"), "n").alias("accuracy"))


def _walk_by_joins(df: DataFrame, tree: DataFrame, features: list[str], name: str) -> DataFrame:
    types = dict(df.dtypes)
    sizes = {r[0]: r[1] for r in tree.groupBy("depth").count().collect()}  # one number for each level
    names = [*df.columns, *[f"_f{i}" for i in range(len(features))]]
    rows = df.select(*[col(c) for c in df.columns], *_question_columns(df, features), F.lit(ROOT).cast("bigint").alias("_node"), F.lit(None).cast("string").alias("_label"))
    nodes = tree.select(*[F.col(c).alias(f"_{c}" if c != "node_id" else "_node") for c in ["node_id", "depth", *_CONTENT[:-1]]], F.col("label").alias("_found"))
    answer = F.lit(False)
    for i, f in enumerate(features):
        value = F.col(f"_f{i}")
        if is_number(types[f]):
            asked = F.when(F.col("_op") == "<=", value <= F.col("_value_num")).otherwise(value == F.col("_value_num"))
        else:
            asked = value == F.col("_value_str")
        answer = F.when(F.col("_feature") == f, asked).otherwise(answer)
    for depth in sorted(sizes):
        here = nodes.filter(F.col("_depth") == depth).drop("_depth")
        if sizes[depth] <= WALK_NODES:
            here = F.broadcast(here)
        joined = rows.join(here, "_node", "left")
        following = F.when(F.col("_feature").isNotNull(), F.when(answer, F.col("_yes_id")).otherwise(F.col("_no_id")))
        rows = joined.select(*[col(c) for c in names], following.alias("_node"), F.coalesce("_label", "_found").alias("_label"))
        if depth % STORED_LEVELS == STORED_LEVELS - 1:
            rows = ScratchTable(rows, "node-walk").df
    return rows.select(*[col(c) for c in df.columns], F.col("_label").alias(name))
