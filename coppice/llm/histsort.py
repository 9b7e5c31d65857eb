"""Sharding by histogram sort: exact bytes below probes, refined until splitters fit.

Rows get a total order (hash of a column, an id, and their place in a stored key table).
The job looks for boundaries in that order that cut the bytes into equal shards, and each
shard into ranges of bounded size. A round counts, in one grouped pass, the bytes of every
probe interval that still holds an open boundary; the interval is then cut into new
probes. A boundary is settled once it misses its target by no more than the tolerance, or
lies between two neighbouring rows. Then rows are exchanged once, by range.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from coppice.llm.tables import Stored, free_name, small_table

#: Most probes per interval, and about as many per round in all; the driver sees one row
#: for each probe interval with rows.
PROBES, ROUND_PROBES = 1024, 1 << 18
KEYS = ("_k0", "_k1", "_k2")


@dataclass
class _Cell:
    """An interval of the key order: which key part cuts it, and how."""

    number: int
    before: int  # bytes before it
    low: tuple[int, ...]
    high: tuple[int, ...]
    targets: list[int]  # boundaries inside, by number
    part: int = 0
    shift: int = 0
    base: int = 0

    def choose_probes(self, probes: int) -> None:
        """Cut by the first part of the key that differs."""
        for part, (low, high) in enumerate(zip(self.low, self.high, strict=True)):
            if low != high:
                bits = 64 if (low < 0) != (high < 0) else (low ^ high).bit_length()
                self.part, self.shift = part, max(0, bits - probes.bit_length() + 1)
                self.base = low >> self.shift
                return


def _probe(part: Column, shift: Column, base: Column) -> Column:
    key = F.when(part == 0, F.col(KEYS[0])).when(part == 1, F.col(KEYS[1])).otherwise(F.col(KEYS[2]))
    return F.call_function("shiftright", key, shift.cast("int")) - base


def histogram_sort(
    df: DataFrame,
    size: Column,
    order: Column,
    tie: Column,
    n_shards: int,
    tolerance: float = 0.001,
    range_rows: int = 1 << 20,
    least_ranges: int = 8,
) -> DataFrame:
    """All rows of ``df`` with ``shard`` (from 0) and ``slot`` (gapless from 0 in a shard).

    Shards hold equal sums of ``size`` up to ``tolerance`` of a shard plus one row. Rows
    are ordered by a hash of ``order``, so equal values are neighbours wherever no boundary
    falls between them, then by ``tie``, then by their place in the stored table, which
    also cuts through any number of equal rows. A range, which one task sorts, has about ``range_rows`` rows of
    mean size.
    Null ``order`` hashes as such, null ``tie`` comes first, null ``size`` is 0. An empty
    table gives an empty one. ``df`` is stored once; pass only the columns wanted.
    Where ``df`` has a column shard or slot, the added one gets underscores in front.
    """
    spark = df.sparkSession
    tie = F.coalesce(tie.cast("long"), F.lit(-(1 << 63)))
    keyed = Stored(
        df.select(
            F.struct("*").alias("row"),
            F.coalesce(size.cast("long"), F.lit(0)).alias("_kb"),
            F.xxhash64(order).alias(KEYS[0]),
            tie.alias(KEYS[1]),
            F.monotonically_increasing_id().alias(KEYS[2]),
        ),
        "histogram-keys",
    ).df
    whole = keyed.agg(
        F.sum("_kb").alias("bytes"),
        F.count(F.lit(1)).alias("rows"),
        *[f(k).alias(f"{n}{k}") for k in KEYS for f, n in ((F.min, "low"), (F.max, "high"))],
    ).first()
    total, ranges_per_shard = whole["bytes"] or 0, least_ranges
    while whole["rows"] / n_shards / ranges_per_shard > range_rows:
        ranges_per_shard *= 2
    n_ranges = n_shards * ranges_per_shard

    def slack(target: int) -> float:
        """How far boundary ``target`` may lie from its place; tight between shards."""
        share = tolerance if target % ranges_per_shard == 0 else 0.25 / ranges_per_shard
        return share * total / n_shards

    rows = keyed.withColumn("_cell", F.lit(0)).withColumn("_range", F.lit(None).cast("long"))
    open_cells = []
    if whole["rows"]:
        bounds = [tuple(whole[f"{n}{k}"] for k in KEYS) for n in ("low", "high")]
        if bounds[0] != bounds[1]:
            open_cells = [_Cell(0, 0, *bounds, list(range(1, n_ranges)))]
    if not open_cells:
        rows = rows.withColumn("_range", F.lit(0).cast("long"))
    while open_cells:
        probes = 1 << (min(PROBES, max(16, ROUND_PROBES // len(open_cells))).bit_length() - 1)
        for cell in open_cells:
            cell.choose_probes(probes)
        cells = small_table(
            spark,
            "_cell long, _part int, _shift int, _base long",
            [(c.number, c.part, c.shift, c.base) for c in open_cells],
        )
        # At most one row for each boundary, of which there is a fixed number per shard.
        placed = rows.join(F.broadcast(cells), "_cell", "left").withColumn(
            "_probe", F.when(F.col("_part").isNotNull(), _probe(F.col("_part"), F.col("_shift"), F.col("_base")))
        )
        counted = (
            placed.filter(F.col("_part").isNotNull())
            .groupBy("_cell", "_probe")
            .agg(
                F.sum("_kb").alias("bytes"),
                *[f(k).alias(f"{n}{k}") for k in KEYS for f, n in ((F.min, "low"), (F.max, "high"))],
            )
            .collect()
        )
        histogram: dict[int, list] = {}
        for row in counted:  # at most PROBES rows for each open boundary
            histogram.setdefault(row["_cell"], []).append(row)
        cuts, following, number = [], [], 0
        for cell in open_cells:
            at, waiting, range_now = cell.before, list(cell.targets), cell.targets[0] - 1
            for row in sorted(histogram[cell.number], key=lambda r: r["_probe"]):
                after, inside = at + row["bytes"], []
                start = range_now
                while waiting and waiting[0] * total / n_ranges <= after:
                    target = waiting.pop(0)
                    place = target * total / n_ranges
                    if place - at <= slack(target) and not inside:
                        start = target  # the boundary is the lower edge of this interval
                    elif after - place <= slack(target):
                        inside.append((target, True))
                    else:
                        inside.append((target, False))
                last_open = max((i for i, (_, settled) in enumerate(inside) if not settled), default=-1)
                within = [t for t, _ in inside[: last_open + 1]]
                range_now = inside[-1][0] if inside else start
                child = None
                if within:
                    bounds = [tuple(row[f"{n}{k}"] for k in KEYS) for n in ("low", "high")]
                    if bounds[0] != bounds[1]:
                        number += 1
                        child = _Cell(number, at, *bounds, within)
                        following.append(child)
                # Settled boundaries at the upper edge belong to the next interval; a row
                # that cannot be cut goes before its boundaries.
                cuts.append((cell.number, row["_probe"], child.number if child else None, None if child else start))
                at = after
        del histogram
        steps = small_table(spark, "_cell long, _probe long, _next long, _found long", cuts)
        # Bounded as above: probes with rows, for each open boundary.
        rows = (
            placed.join(F.broadcast(steps), ["_cell", "_probe"], "left")
            .withColumn("_range", F.coalesce("_range", "_found"))
            .withColumn("_cell", F.col("_next"))
            .drop("_part", "_shift", "_base", "_probe", "_next", "_found")
        )
        open_cells = following
    rows = rows.withColumn("shard", (F.col("_range") / ranges_per_shard).cast("int"))
    # The one exchange: rows of a range meet, in order; then ranges before it in its shard.
    in_range = Window.partitionBy("shard", "_range").orderBy(*KEYS)
    sizes = rows.groupBy("shard", "_range").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy("shard").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_range", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    return (
        rows.withColumn("slot", F.row_number().over(in_range).cast("long") - 1)
        .join(F.broadcast(offsets), "_range")  # one row for each range
        .withColumn("slot", F.col("slot") + F.col("_before"))
        .select("row.*", *[F.col(c).alias(free_name(df, c)) for c in ("shard", "slot")])
    )


def write_shards(df: DataFrame, path: str) -> None:
    """One folder ``shard=n`` for each shard, files of it in slot order."""
    df.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
