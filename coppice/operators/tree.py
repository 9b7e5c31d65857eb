"""Exhaustive decision-tree training, one distributed pass per tree level.

Every observed value of every feature is a candidate question. A level counts labels
per (tree, node, feature, value), turns the counts into the weighted impurity of each
candidate, and keeps the best one per node. All trees and all nodes of a level share
that work.

A feature with many values is first counted in buckets. The counts give a lower bound
on the impurity of any candidate inside a bucket; only buckets whose bound does not
exceed the best candidate already known are counted value by value, in segments of
bounded size where they hold many values. The answer is the exhaustive one, while the
shuffle stays small and no group holds all values of a feature.

Where equal rows make up at least half of a large table, each different row is kept once with
their number.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence
from dataclasses import dataclass
from functools import wraps
from itertools import product

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from coppice.functions.numeric import (
    combined_mass,
    impurity_mass,
    impurity_term,
    split_impurity,
    total,
)
from coppice.operators.columns import col
from coppice.operators.profile import CATEGORY_VALUES, feature_cell, is_number, type_class
from coppice.operators.treemodel import ROOT, Node, TreeModel
from coppice.session import ScratchTable, even_scans, scratch_root

# Impurities equal to this many decimals are ties; the last feature and value win.
TIE_DIGITS = 10
_SLACK = 10.0**-TIE_DIGITS * 2
# Small tables below this many rows are sent to all executors.
BROADCAST_ROWS = 200_000
# Up to this many opened buckets (counts only) may visit the driver.
LOCAL_BUCKETS = 20_000
# Tables up to this many rows are dealt out to all cores first.
SPREAD_ROWS = 5_000_000
# Rows drawn to place bucket edges. Any edges give the same tree.
EDGE_SAMPLE_ROWS = 500_000
# Up to this many labels the bound of a bucket looks at all corners of its counts.
CORNER_LABELS = 4
ROWS_PER_BUCKET = 500
# Values of opened buckets that a running count passes in one task, about.
SEGMENT_VALUES = 1_000_000
# Levels between two checkpoints of the row-to-node assignment.
CHECKPOINT_LEVELS = 6


def _once(method):
    """Keep a method's results on its object, so that they go when the object goes."""

    @wraps(method)
    def kept(self, *arguments):
        found = self.__dict__.setdefault("_kept_results", {})
        key = (method.__name__, *arguments)
        if key not in found:
            found[key] = method(self, *arguments)
        return found[key]

    return kept


@dataclass(frozen=True)
class _Feature:
    index: int
    name: str
    numeric: bool
    bucketed: bool
    # Trees in which the feature is continuous: all, none, or those listed.
    continuous: bool | frozenset

    @property
    def value(self) -> str:
        return f"f{self.index}"

    @property
    def bucket(self) -> str:
        return f"b{self.index}"


@dataclass(frozen=True)
class _Split:
    """Best question of a node, comparable: larger is better."""

    merit: float
    feature: int
    num: float | None
    text: str | None
    yes_counts: tuple[int, ...]

    @property
    def order(self) -> tuple:
        return (
            self.merit, self.feature, self.num is not None, self.num or 0.0, self.text or "",
        )


def train_tree(df: DataFrame, features: Sequence[str], label: str, **options) -> TreeModel:
    """One tree over the whole table; see ``train_trees`` for the options."""
    return train_trees(df, features, label, **options)


def train_trees(
    df: DataFrame,
    features: Sequence[str],
    label: str,
    shard: str | None = None,
    criterion: str = "entropy",
    max_depth: int | None = 5,
    min_samples: int = 2,
    category_values: int = CATEGORY_VALUES,
    direct_values: int = 4096,
    direct_rows: int = 200_000,
    buckets: int = 4096,
    collapse: bool = True,
    cache: bool = True,
) -> TreeModel:
    """Train one tree per value of ``shard`` (or one in all), in shared passes.

    A node becomes a leaf if it has one label, fewer than ``min_samples`` rows, lies
    at ``max_depth``, or its best question leaves one side empty; its label is the
    most frequent one, the smallest among equals. Text, and numbers with at most
    ``category_values`` distinct values in the shard, are asked ``=``; other numbers
    ``<=``. Rows without a label are not used.

    Tables above ``direct_rows`` rows count features with more than ``direct_values``
    values in ``buckets`` first; this does not change the result. ``cache`` keeps the
    projected rows in executor memory and disk during training.
    """
    return _Training(
        df, list(features), label, shard, criterion, max_depth, min_samples,
        category_values, direct_values, direct_rows, buckets, cache,
    ).run(collapse)


class _Training:
    def __init__(
        self, df, features, label, shard, criterion, max_depth, min_samples,
        category_values, direct_values, direct_rows, buckets, cache,
    ):
        self.spark = df.sparkSession
        self.criterion, self.max_depth, self.min_samples = criterion, max_depth, min_samples
        self.category_values = category_values
        self.direct_values, self.direct_rows = direct_values, direct_rows
        self.buckets, self.cache = buckets, cache
        self.names = features
        types = dict(df.dtypes)
        self.label_type = types[label]
        cells = [feature_cell(f, types[f]) for f in features]
        self.numeric = [is_number(types[f]) for f in features]
        self._check_long_integers(df, [f for f in features if types[f] == "bigint"])
        tree = F.lit("") if shard is None else F.coalesce(col(shard).cast("string"), F.lit(""))
        self.shard_numeric = shard is not None and type_class(types[shard]) == "int"
        self.rows = df.filter(col(label).isNotNull()).select(
            tree.alias("shard"),
            col(label).alias("label"),
            *[(num if is_num else text).alias(f"f{i}")
              for i, ((num, text), is_num) in enumerate(zip(cells, self.numeric))],
        )
        self._held: list[DataFrame] = []
        self._written: list[ScratchTable] = []

    # Preparation ----------------------------------------------------------------

    @staticmethod
    def _check_long_integers(df: DataFrame, features: Sequence[str]) -> None:
        """Questions compare doubles, which would merge integers beyond 2**53."""
        if not features:
            return
        edges = [f(col(c)).alias(f"{n}{i}") for i, c in enumerate(features) for n, f in (("a", F.min), ("b", F.max))]
        row = df.agg(*edges).first()
        for i, c in enumerate(features):
            if row[f"a{i}"] is not None and max(-row[f"a{i}"], row[f"b{i}"]) > 1 << 53:
                raise ValueError(f"feature {c} holds integers beyond 2**53: make it text or a rank first")

    def _hold(self, df: DataFrame) -> DataFrame:
        self._held.append(df.persist(StorageLevel.MEMORY_AND_DISK))
        return df

    def _release(self, keep: int = 0) -> None:
        while len(self._held) > keep:
            self._held.pop().unpersist()
        while self._written:
            self._written.pop().drop()

    def _prepare(self) -> None:
        even_scans(self.spark)
        by_label = self.rows.groupBy("shard", "label").agg(F.count(F.lit(1)).alias("count")).collect()
        self.labels = sorted({r["label"] for r in by_label})
        position = {v: k for k, v in enumerate(self.labels)}
        totals: dict[str, list[int]] = {}
        for r in by_label:
            totals.setdefault(r["shard"], [0] * len(self.labels))[position[r["label"]]] = r["count"]
        shards = sorted(totals, key=(lambda s: (s != "", int(s or 0))) if self.shard_numeric else None)
        self.shards = dict(enumerate(shards))
        self.root_counts = {t: tuple(totals[s]) for t, s in self.shards.items()}
        self.size = sum(sum(counts) for counts in totals.values())
        #: Rows at hand: all, or about the number of different ones, which have their number as weight.
        self.held_rows, self.weighted = self.size, False
        if self.size > self.direct_rows:
            # Equal rows count once in every one of these, so they hold for weighted rows too.
            different = F.approx_count_distinct(F.xxhash64(*[col(c) for c in self.rows.columns]))
            self.overall = self.rows.agg(different.alias("different"), *self._sketches()).first()
            self.weighted = 2 * self.overall["different"] <= self.size
        if self.weighted:
            self.held_rows = self.overall["different"]
            self.rows = self.rows.groupBy(*self.rows.columns).agg(F.count(F.lit(1)).alias("w"))
        if self.held_rows <= SPREAD_ROWS:
            # A small table may lie in a single file block; let every core have a part.
            self.rows = self.rows.repartition(self.spark.sparkContext.defaultParallelism)
        if self.cache:
            self._hold(self.rows)
        self._describe_features()
        self._place_rows()

    def _sketches(self) -> list[Column]:
        """About how many values each feature has, and how many rows lack each number."""
        return [F.approx_count_distinct(f"f{i}").alias(f"d{i}") for i in range(len(self.names))] + self._missing()

    def _missing(self) -> list[Column]:
        return [F.count_if(F.col(f"f{i}").isNull()).alias(f"m{i}") for i, is_num in enumerate(self.numeric) if is_num]

    def _describe_features(self) -> None:
        """Kind per feature and tree, and which features need buckets."""
        n = len(self.names)
        value = [F.col(f"f{i}") for i in range(n)]
        numbers = [i for i in range(n) if self.numeric[i]]
        missing = self._missing()
        # A sketch cannot report more than about this for category_values values.
        doubtful = 2 * self.category_values + 2
        many = [False] * n
        if self.size > self.direct_rows:
            many = [self.overall[f"d{i}"] > self.direct_values for i in range(n)]
            if len(self.shards) == 1:
                per_shard = dict.fromkeys(self.shards.values(), self.overall)
            else:
                described = self.rows.groupBy("shard").agg(*[self._sketches()[i] for i in numbers], *missing)
                per_shard = {r["shard"]: r for r in described.collect()}
            few = {
                i: [s for s, r in per_shard.items() if r[f"d{i}"] <= doubtful] for i in numbers
            }
            few = {i: held for i, held in few.items() if held}
            missing = []
        else:
            few = {i: list(self.shards.values()) for i in numbers}
            per_shard = {}
        exact = {}
        if few:
            distinct = [
                F.count_distinct(
                    value[i] if len(held) == len(self.shards)
                    else F.when(F.col("shard").isin(held), value[i])
                ).alias(f"d{i}")
                for i, held in few.items()
            ]
            counted = self.rows.groupBy("shard").agg(*distinct, *missing)
            exact = {r["shard"]: r for r in counted.collect()}
        per_shard = per_shard or exact

        self.features = []
        for i, name in enumerate(self.names):
            continuous_in = set()
            if self.numeric[i]:
                for tree, s in self.shards.items():
                    known = exact[s][f"d{i}"] if s in few.get(i, ()) else doubtful + 1
                    if known + (per_shard[s][f"m{i}"] > 0) > self.category_values:
                        continuous_in.add(tree)
            continuous: bool | frozenset = frozenset(continuous_in)
            if len(continuous_in) in (0, len(self.shards)):
                continuous = bool(continuous_in)
            self.features.append(_Feature(i, name, self.numeric[i], many[i], continuous))
        self.bucketed = [f for f in self.features if f.bucketed]

    def _place_rows(self) -> None:
        """Rows as (tree, node, label index, features, buckets)."""
        tree_of = F.lit(0)
        rows = self.rows
        if len(self.shards) > 1:
            table = self.spark.createDataFrame(
                [(s, t) for t, s in self.shards.items()], "shard string, tree int"
            )
            side = F.broadcast(table) if len(self.shards) <= BROADCAST_ROWS else table
            rows, tree_of = rows.join(side, "shard"), F.col("tree")
        label_index = F.coalesce(
            *[F.when(F.col("label") == F.lit(v), F.lit(k)) for k, v in enumerate(self.labels)]
        ) if self.labels else F.lit(0)
        numbers = [f for f in self.bucketed if f.numeric]
        texts = [f for f in self.bucketed if not f.numeric]
        if numbers:
            sample = self.rows.select(*[f.value for f in numbers])
            if self.held_rows > EDGE_SAMPLE_ROWS:
                sample = sample.sample(fraction=EDGE_SAMPLE_ROWS / self.held_rows, seed=1)
            # About ROWS_PER_BUCKET rows each, unless that takes more buckets than allowed.
            n = max(2, min(self.buckets, self.size // ROWS_PER_BUCKET))
            steps = [i / n for i in range(1, n)]
            quantiles = sample.approxQuantile([f.value for f in numbers], steps, 0.25 / n)
            for f, marks in zip(numbers, quantiles):
                # The outermost edges are infinite anyway, and Bucketizer takes each edge once.
                edges = sorted(set(marks) - {float("-inf"), float("inf")}) or [0.0]
                rows = Bucketizer(
                    splits=[float("-inf"), *edges, float("inf")],
                    inputCol=f.value, outputCol=f.bucket, handleInvalid="keep",
                ).transform(rows)
        self.base = rows.select(
            tree_of.cast("int").alias("tree"),
            F.lit(ROOT).cast("bigint").alias("node"),
            label_index.cast("int").alias("y"),
            *self._weight(),
            *[F.col(f.value) for f in self.features],
            *[F.when(F.col(f.value).isNotNull(), F.col(f.bucket).cast("int")).alias(f.bucket)
              for f in numbers],
            *[F.when(F.col(f.value).isNotNull(),
                     F.pmod(F.xxhash64(f.value), F.lit(self.buckets)).cast("int")).alias(f.bucket)
              for f in texts],
        )

    # One level ------------------------------------------------------------------

    def _weight(self) -> list[Column]:
        return [F.col("w")] if self.weighted else []

    @_once
    def _label_counts(self) -> list[Column]:
        if self.weighted:
            return [
                F.sum(F.when(F.col("y") == k, F.col("w")).otherwise(0)).alias(f"c{k}") for k in range(len(self.labels))
            ]
        return [F.count_if(F.col("y") == k).alias(f"c{k}") for k in range(len(self.labels))]

    def _vector(self, prefix: str) -> list[Column]:
        return [F.col(f"{prefix}{k}") for k in range(len(self.labels))]

    def _is_continuous(self) -> Column:
        """Whether the candidate's question is ``<=``, from ``tree`` and ``feature``."""
        always = [f.index for f in self.features if f.continuous is True]
        answer = F.col("feature").isin(always) if always else F.lit(False)
        for f in self.features:
            if isinstance(f.continuous, frozenset):
                answer = answer | ((F.col("feature") == f.index) & F.col("tree").isin(sorted(f.continuous)))
        return answer

    @_once
    def _entry(self, f: _Feature, detail: bool) -> Column:
        """A feature of a row as one element of the unpivoted form."""
        value = F.col(f.value)
        number = value if f.numeric else F.lit(None).cast("double")
        text = F.lit(None).cast("string") if f.numeric else value
        direct = detail or not f.bucketed
        return F.struct(
            F.lit(f.index).alias("feature"),
            (F.col(f.bucket) if f.bucketed else F.lit(None).cast("int")).alias("bucket"),
            (number if direct else F.lit(None).cast("double")).alias("num"),
            (text if direct else F.lit(None).cast("string")).alias("str"),
            (number if f.bucketed else F.lit(None).cast("double")).alias("raw"),
        )

    def _unpivot(self, rows: DataFrame, features: Sequence[_Feature], detail: bool) -> DataFrame:
        entries = F.array(*[self._entry(f, detail) for f in features])
        return rows.select("tree", "node", "y", *self._weight(), F.explode(entries).alias("e")).select(
            "tree", "node", "y", *self._weight(), "e.*"
        )

    def _first_pass(self, rows: DataFrame) -> DataFrame:
        """Counts per value, or per bucket of many-valued features, and running counts."""
        counted = self._unpivot(rows, self.features, False).groupBy(
            "tree", "node", "feature", "bucket", "num", "str"
        ).agg(
            *self._label_counts(), F.min("raw").alias("low"), F.max("raw").alias("high"),
            *([F.count(F.lit(1)).alias("held")] if self.weighted else []),
        )
        known, sums, kept = self._running()
        return counted.withColumns(sums).filter(known).select(*kept).withColumn(
            # The top value of a bucket of a continuous feature is a candidate as it stands.
            "exact", F.col("one_value") | (F.col("continuous") & F.col("num").isNotNull())
        )

    @_once
    def _running(self) -> tuple[Column, dict[str, Column], list]:
        known = F.col("bucket").isNotNull() | F.col("num").isNotNull() | F.col("str").isNotNull()
        group = Window.partitionBy("tree", "node", "feature").orderBy("bucket", "num", "str")
        upto = group.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        everything = group.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        kinds = range(len(self.labels))
        sums = {f"u{k}": F.sum(F.when(known, F.col(f"c{k}")).otherwise(0)).over(upto) for k in kinds}
        sums |= {f"t{k}": F.sum(f"c{k}").over(everything) for k in kinds}
        continuous = self._is_continuous()
        one_value = F.col("bucket").isNull() | (F.col("low") == F.col("high"))
        kept = [
            "tree", "node", "feature", "bucket", "str",
            F.coalesce("num", "high").alias("num"),
            continuous.alias("continuous"),
            F.coalesce(one_value, F.lit(False)).alias("one_value"),
            *[F.when(continuous, F.col(f"u{k}")).otherwise(F.col(f"c{k}")).alias(f"y{k}") for k in kinds],
            *[F.when(continuous, F.col(f"u{k}") - F.col(f"c{k}")).otherwise(0).alias(f"l{k}") for k in kinds],
            *self._vector("c"), *self._vector("t"),
            # Rows at hand, which bound the values of a bucket.
            *([F.col("held")] if self.weighted else []),
        ]
        return known, sums, kept

    @_once
    def _ranked(self) -> Column:
        """A candidate as a struct whose largest value is the best one."""
        yes, every = self._vector("y"), self._vector("t")
        no = [t - y for t, y in zip(every, yes)]
        merit = F.lit(0.0) - F.round(split_impurity(yes, no, self.criterion), TIE_DIGITS)
        return F.struct(merit.alias("merit"), "feature", "num", "str", *yes).alias("s")

    def _best(self, candidates: DataFrame) -> dict[tuple[int, int], _Split]:
        """Best question per node from rows with yes-counts ``y*`` and totals ``t*``."""
        best = candidates.select("tree", "node", self._ranked()).groupBy("tree", "node").agg(F.max("s").alias("s"))
        found = {}
        for r in best.collect():
            s = r["s"]
            counts = tuple(s[f"y{k}"] for k in range(len(self.labels)))
            found[r["tree"], r["node"]] = _Split(s["merit"], s["feature"], s["num"], s["str"], counts)
        return found

    def _with_bound(self, buckets: DataFrame) -> DataFrame:
        """Add the least impurity any question inside a bucket could reach.

        Weighted impurity is concave in the counts of the "yes" side, and those lie
        between the counts before the bucket and the same plus all its rows: the least
        value is at a corner of that box. With many labels (many corners), give the
        bucket's rows a pure side of their own instead, which is lower still.
        """
        left, held, every = self._vector("l"), self._vector("c"), self._vector("t")
        kinds = range(len(self.labels))
        if len(self.labels) > CORNER_LABELS:
            right = [t - a - c for t, a, c in zip(every, left, held)]
            mass = impurity_mass(left, self.criterion) + impurity_mass(right, self.criterion)
            return buckets.withColumn("bound", mass / total(every))
        # Both sides' terms per label, once without (0) and once with (1) the bucket's rows.
        terms = {}
        for k, (a, c, t) in enumerate(zip(left, held, every)):
            for taken, yes in enumerate((a, a + c)):
                no = t - yes
                terms[f"p{k}{taken}"] = impurity_term(yes, self.criterion)
                terms[f"q{k}{taken}"] = impurity_term(no, self.criterion)
        corners = []
        for taken in product((0, 1), repeat=len(self.labels)):
            n_yes = total([left[k] + held[k] if taken[k] else left[k] for k in kinds])
            n_no = total(every) - n_yes
            yes = total([F.col(f"p{k}{taken[k]}") for k in kinds])
            no = total([F.col(f"q{k}{taken[k]}") for k in kinds])
            corners.append(
                combined_mass(n_yes, yes, self.criterion) + combined_mass(n_no, no, self.criterion)
            )
        least = F.least(*corners) if len(corners) > 1 else corners[0]
        return buckets.withColumns(terms).withColumn("bound", least / total(every))

    def _open_buckets(self, first: DataFrame, known: dict) -> DataFrame:
        """Buckets that may hide a better question than the best one known."""
        bests = self.spark.createDataFrame(
            [(t, n, -s.merit) for (t, n), s in known.items()], "tree int, node bigint, reached double"
        )
        side = F.broadcast(bests) if len(known) <= BROADCAST_ROWS else bests
        may_win = F.col("reached").isNull() | (F.col("bound") <= F.col("reached") + _SLACK)
        many_valued = first.filter(F.col("bucket").isNotNull() & ~F.col("one_value"))
        return (
            self._with_bound(many_valued)
            .join(side, ["tree", "node"], "left")
            .filter(may_win)
            .select(
                "tree", "node", "feature", "bucket", "continuous",
                F.col("held") if self.weighted else total(self._vector("c")).alias("held"),
                *self._vector("l"), *self._vector("t"),
            )
        )

    def _upto(self, counted: DataFrame, keys: Sequence[str], n_values: int) -> DataFrame:
        """Running counts ``u*`` of ``c*`` along the values of each bucket.

        ``n_values`` bounds the rows of ``counted``. Beyond ``SEGMENT_VALUES`` they are dealt in
        ranges across all buckets, so that a bucket of any size is walked in segments, which
        meet by the totals of the segments before.
        """
        kinds = range(len(self.labels))
        along = Window.partitionBy(*keys).orderBy("num", "str")
        if n_values <= SEGMENT_VALUES:
            upto = along.rowsBetween(Window.unboundedPreceding, Window.currentRow)
            return counted.withColumns({f"u{k}": F.sum(f"c{k}").over(upto) for k in kinds})
        parts = -(-n_values // SEGMENT_VALUES)
        placed = counted.repartitionByRange(parts, *keys, "num", "str").withColumn("part", F.spark_partition_id())
        # Ranges come from a sample, so they are drawn once and stored.
        stored = ScratchTable(placed, "opened-values")
        self._written.append(stored)
        before = Window.partitionBy(*keys).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
        totals = stored.df.groupBy(*keys, "part").agg(*[F.sum(f"c{k}").alias(f"c{k}") for k in kinds])
        offsets = totals.select(*keys, "part", *[F.sum(f"c{k}").over(before).alias(f"o{k}") for k in kinds])
        # Only a bucket that a border cuts goes on in a further part: at most one for each part.
        offsets = offsets.filter("o0 IS NOT NULL")
        inside = Window.partitionBy(*keys, "part").orderBy("num", "str").rowsBetween(
            Window.unboundedPreceding, Window.currentRow
        )
        walked = stored.df.withColumns({f"u{k}": F.sum(f"c{k}").over(inside) for k in kinds})
        joined = walked.join(F.broadcast(offsets) if parts <= BROADCAST_ROWS else offsets, [*keys, "part"], "left")
        return joined.withColumns({f"u{k}": F.col(f"u{k}") + F.coalesce(f"o{k}", F.lit(0)) for k in kinds})

    def _second_pass(
        self, rows: DataFrame, opened: DataFrame, sizes: dict[int, int], n_values: int
    ) -> DataFrame:
        """Candidates value by value inside the opened buckets, which hold ``n_values`` at most."""
        chosen = [f for f in self.bucketed if f.index in sizes]
        keys = ["tree", "node", "feature", "bucket"]
        detail = self._unpivot(rows, chosen, True).drop("raw").filter("bucket IS NOT NULL")
        few = sum(sizes.values()) <= BROADCAST_ROWS
        if few:
            detail = detail.join(F.broadcast(opened.select(*keys)), keys, "left_semi")
        counted = detail.groupBy(*keys, "num", "str").agg(*self._label_counts())
        counted = counted.join(F.broadcast(opened) if few else opened, keys)
        kinds = range(len(self.labels))
        running = self._upto(counted, keys, n_values)
        return running.select(
            "tree", "node", "feature", "num", "str",
            *[F.when(F.col("continuous"), F.col(f"l{k}") + F.col(f"u{k}"))
              .otherwise(F.col(f"c{k}")).alias(f"y{k}") for k in kinds],
            *self._vector("t"),
        )

    def _level(self, rows: DataFrame) -> dict[tuple[int, int], _Split]:
        first = self._first_pass(rows)
        mark = len(self._held)
        if self.bucketed:
            self._hold(first)
        best = self._best(first.filter("exact"))
        if self.bucketed:
            opened = self._open_buckets(first, best)
            found = opened.limit(LOCAL_BUCKETS + 1).collect()
            if len(found) <= LOCAL_BUCKETS:
                sizes = Counter(r["feature"] for r in found)
                n_values = sum(r["held"] for r in found)
                opened = self.spark.createDataFrame(found, opened.schema) if found else opened
            else:
                opened = self._hold(opened)
                per_feature = opened.groupBy("feature").agg(F.count(F.lit(1)).alias("n"), F.sum("held").alias("held")).collect()
                sizes = {r["feature"]: r["n"] for r in per_feature}
                n_values = sum(r["held"] for r in per_feature)
            if sizes:
                for key, split in self._best(self._second_pass(rows, opened, sizes, n_values)).items():
                    if key not in best or split.order > best[key].order:
                        best[key] = split
        self._release(mark)
        return best

    def _advance(self, rows: DataFrame, splits: list[tuple]) -> DataFrame:
        """Move rows of split nodes to their child; rows of finished nodes go."""
        table = self.spark.createDataFrame(
            splits,
            "tree int, node bigint, feature int, op string, num double, str string, yes bigint, no bigint",
        )
        side = F.broadcast(table) if len(splits) <= BROADCAST_ROWS else table
        used = {s[2] for s in splits}
        answer = None
        for f in self.features:
            if f.index not in used:
                continue
            value = F.col(f.value)
            if f.numeric:
                asked = F.when(F.col("op") == "<=", value <= F.col("num")).otherwise(value == F.col("num"))
            else:
                asked = value == F.col("str")
            match = F.col("feature") == f.index
            answer = F.when(match, asked) if answer is None else answer.when(match, asked)
        child = F.when(answer, F.col("yes")).otherwise(F.col("no"))
        kept = [c for c in rows.columns if c not in ("tree", "node")]
        moved = rows.join(side, ["tree", "node"]).select("tree", child.alias("node"), *kept)
        return moved.filter("node IS NOT NULL")

    # The loop -------------------------------------------------------------------

    def _majority(self, counts: tuple[int, ...]) -> str:
        return str(self.labels[counts.index(max(counts))])

    def _is_open(self, counts: tuple[int, ...], depth: int) -> bool:
        n = sum(counts)
        pure = sum(c > 0 for c in counts) <= 1
        at_end = self.max_depth is not None and depth >= self.max_depth
        return not (pure or n < self.min_samples or at_end)

    def run(self, collapse: bool) -> TreeModel:
        try:
            return self._grow(collapse)
        finally:
            self._release()

    def _grow(self, collapse: bool) -> TreeModel:
        self._prepare()
        trees: dict[int, dict[int, Node]] = {t: {} for t in self.shards}
        next_id = dict.fromkeys(self.shards, ROOT + 1)
        opened: dict[tuple[int, int], tuple] = {}
        for t, counts in self.root_counts.items():
            if self._is_open(counts, 0):
                opened[t, ROOT] = counts
            else:
                trees[t][ROOT] = Node(t, ROOT, 0, label=self._majority(counts), n=sum(counts))
        rows, depth = self.base, 0
        closed = set(self.shards) - {t for t, _ in opened}
        if closed and opened:
            rows = rows.filter(~F.col("tree").isin(sorted(closed)))
        while opened:
            best = self._level(rows)
            depth += 1
            splits, following = [], {}
            for (t, node_id), counts in opened.items():
                split = best.get((t, node_id))
                n = sum(counts)
                no_counts = tuple(a - y for a, y in zip(counts, split.yes_counts)) if split else ()
                if split is None or sum(split.yes_counts) in (0, n):
                    trees[t][node_id] = Node(t, node_id, depth - 1, label=self._majority(counts), n=n)
                    continue
                f = self.features[split.feature]
                continuous = f.continuous if isinstance(f.continuous, bool) else t in f.continuous
                op = "<=" if continuous else "="
                ids = (next_id[t], next_id[t] + 1)
                next_id[t] += 2
                trees[t][node_id] = Node(
                    t, node_id, depth - 1, f.name, op, split.num, split.text, *ids, n=n
                )
                goes_on = []
                for child, held in zip(ids, (split.yes_counts, no_counts)):
                    if self._is_open(held, depth):
                        following[t, child] = held
                        goes_on.append(child)
                    else:
                        trees[t][child] = Node(t, child, depth, label=self._majority(held), n=sum(held))
                        goes_on.append(None)
                if any(goes_on):
                    splits.append((t, node_id, split.feature, op, split.num, split.text, *goes_on))
            opened = following
            if opened:
                rows = self._advance(rows, splits)
                if depth % CHECKPOINT_LEVELS == 0:
                    scratch_root(self.spark)
                    rows = rows.checkpoint()
        model = TreeModel(trees, self.label_type, self.shards)
        return model.collapsed() if collapse else model
