"""Decision trees as a node table, as text, and as column expressions."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from coppice.operators.columns import col

NODE_SCHEMA = (
    "tree_id int, node_id bigint, depth int, feature string, op string, value_num double, "
    "value_str string, yes_id bigint, no_id bigint, label string, n bigint"
)
MODEL_SCHEMA = NODE_SCHEMA + ", label_type string, shard string"
ROOT = 1


@dataclass(frozen=True)
class Node:
    """A question (``feature op value``) or, with ``label`` set, a leaf."""

    tree_id: int
    node_id: int
    depth: int
    feature: str | None = None
    op: str | None = None
    value_num: float | None = None
    value_str: str | None = None
    yes_id: int | None = None
    no_id: int | None = None
    label: str | None = None
    n: int = 0

    @property
    def is_leaf(self) -> bool:
        return self.feature is None

    @property
    def value(self) -> float | str:
        return self.value_str if self.value_num is None else self.value_num

    @property
    def question(self) -> str:
        return f"{self.feature} {self.op} {self.value}"

    def row(self) -> tuple:
        return (
            self.tree_id, self.node_id, self.depth, self.feature, self.op, self.value_num,
            self.value_str, self.yes_id, self.no_id, self.label, self.n,
        )


def collapse(nodes: dict[int, Node]) -> dict[int, Node]:
    """Drop questions whose two answers are equal, from the leaves up."""
    shape: dict[int, object] = {}
    kept = dict(nodes)
    for node in sorted(nodes.values(), key=lambda n: (-n.depth, n.node_id)):
        if node.is_leaf:
            shape[node.node_id] = node.label
            continue
        yes, no = shape[node.yes_id], shape[node.no_id]
        if yes == no:
            shape[node.node_id] = yes
            answer = kept[node.yes_id]
            kept[node.node_id] = replace(answer, node_id=node.node_id, depth=node.depth, n=node.n)
        else:
            shape[node.node_id] = (node.feature, node.op, node.value, yes, no)
    return _reachable(kept)


def _reachable(nodes: dict[int, Node]) -> dict[int, Node]:
    """Nodes below the root, with depths counted anew."""
    result, waiting = {}, [(ROOT, 0)]
    while waiting:
        node_id, depth = waiting.pop()
        node = replace(nodes[node_id], depth=depth)
        result[node_id] = node
        if not node.is_leaf:
            waiting += [(node.yes_id, depth + 1), (node.no_id, depth + 1)]
    return result


@dataclass
class TreeModel:
    """One or more trees; ``shards`` names the part of the data each one has seen."""

    trees: dict[int, dict[int, Node]]
    label_type: str = "string"
    shards: dict[int, str] = field(default_factory=dict)

    @property
    def tree_ids(self) -> list[int]:
        return sorted(self.trees)

    def nodes(self) -> list[Node]:
        return [self.trees[t][i] for t in self.tree_ids for i in sorted(self.trees[t])]

    def collapsed(self) -> TreeModel:
        return replace(self, trees={t: collapse(nodes) for t, nodes in self.trees.items()})

    # Node table ---------------------------------------------------------------

    def to_table(self, spark: SparkSession) -> DataFrame:
        """Nodes as rows, plus the rendered question and the answers that lead there."""
        rows = []
        for t in self.tree_ids:
            paths = self.paths(t)
            for node_id in sorted(self.trees[t]):
                node = self.trees[t][node_id]
                rows.append(node.row() + (None if node.is_leaf else node.question, paths[node_id]))
        return spark.createDataFrame(rows, NODE_SCHEMA + ", question string, path string")

    @classmethod
    def from_table(cls, table: DataFrame) -> TreeModel:
        """The model of a node table, with its label type and shards if the table has them."""
        names = [part.split()[0] for part in NODE_SCHEMA.split(", ")]
        trees: dict[int, dict[int, Node]] = {}
        for row in table.select(*names).collect():
            trees.setdefault(row["tree_id"], {})[row["node_id"]] = Node(*row)
        if not {"label_type", "shard"} <= set(table.columns):
            return cls(trees)
        kept = table.select("tree_id", "label_type", "shard").distinct().collect()
        label_type = kept[0]["label_type"] if kept else "string"
        return cls(trees, label_type, {r["tree_id"]: r["shard"] for r in kept if r["shard"] is not None})

    def save(self, spark: SparkSession, path: str) -> None:
        """Write the nodes; they keep the label's type and each tree's shard."""
        rows = [(*node.row(), self.label_type, self.shards.get(node.tree_id)) for node in self.nodes()]
        spark.createDataFrame(rows, MODEL_SCHEMA).coalesce(1).write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> TreeModel:
        return cls.from_table(spark.read.parquet(path))

    def paths(self, tree_id: int) -> dict[int, str]:
        """Answers from the root to each node, as a text of ``y`` and ``n``."""
        result, waiting = {}, [(ROOT, "")]
        while waiting:
            node_id, path = waiting.pop()
            result[node_id] = path
            node = self.trees[tree_id][node_id]
            if not node.is_leaf:
                waiting += [(node.yes_id, path + "y"), (node.no_id, path + "n")]
        return result

    # Text -----------------------------------------------------------------------

    def nested(self, tree_id: int, node_id: int = ROOT) -> dict | str:
        """``{question: [yes, no]}`` down to the labels."""
        node = self.trees[tree_id][node_id]
        if node.is_leaf:
            return node.label
        return {node.question: [self.nested(tree_id, node.yes_id), self.nested(tree_id, node.no_id)]}

    def text_lines(self) -> list[str]:
        return [f"tree\t{self.nested(t)}" for t in self.tree_ids]

    # Scoring --------------------------------------------------------------------

    def _question(self, node: Node, types: dict[str, str]) -> Column:
        feature = col(node.feature)
        if node.value_num is None:
            return feature.cast("string") == F.lit(node.value_str)
        number = feature.cast("double")
        if types.get(node.feature) in ("double", "float"):
            number = F.when(~F.isnan(number), number)
        if node.op == "<=":
            return number <= F.lit(node.value_num)
        return number == F.lit(node.value_num)

    def prediction(self, df: DataFrame, tree_id: int | None = None) -> Column:
        """Label of each row of ``df`` by one tree (the first by default).

        The tree becomes nested conditions inside the query plan: nothing is joined
        and no row leaves the JVM. A missing value answers no.
        """
        chosen = self.tree_ids[0] if tree_id is None else tree_id
        nodes, types = self.trees[chosen], dict(df.dtypes)
        answers: dict[int, Column] = {}
        # From the leaves up, so that no depth of Python calls is needed.
        for node in sorted(nodes.values(), key=lambda n: -n.depth):
            if node.is_leaf:
                answers[node.node_id] = F.lit(node.label).cast(self.label_type)
            else:
                answers[node.node_id] = F.when(self._question(node, types), answers[node.yes_id]).otherwise(
                    answers[node.no_id]
                )
        return answers[ROOT]

    @property
    def depth(self) -> int:
        return max((n.depth for nodes in self.trees.values() for n in nodes.values()), default=0)

    @property
    def size(self) -> int:
        return sum(map(len, self.trees.values()))


def model_from_rows(rows: Iterable[tuple], label_type: str = "string") -> TreeModel:
    """A model from tuples in node-table order."""
    trees: dict[int, dict[int, Node]] = {}
    for row in rows:
        node = Node(*row)
        trees.setdefault(node.tree_id, {})[node.node_id] = node
    return TreeModel(trees, label_type)
