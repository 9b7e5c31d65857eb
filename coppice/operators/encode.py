"""Text to numbers: codes by frequency or by order, and feature vectors."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.ml.feature import StringIndexer, StringIndexerModel, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from coppice.operators.columns import col
from coppice.operators.ordering import row_index
from coppice.session import write_scratch

ORDERS = {"frequency": "frequencyDesc", "alphabet": "alphabetAsc"}

# A dictionary of at most this many values is kept as part of the model.
SMALL_DICTIONARY = 20_000
# The most frequent values of a large dictionary, which are broadcast.
DICTIONARY_HEAD = 100_000
SALTS = 1024
# A value with more than this share of the rows to be coded is broadcast with its code.
HOT_SHARE = 0.001


def _dictionary(df: DataFrame, column: str, order: str) -> DataFrame:
    """``(value, code)`` as a stored table, codes from 0 in the wanted order."""
    counted = df.select(col(column).alias("value")).filter("value IS NOT NULL").groupBy("value").count()
    ranking = ["value"] if order == "alphabet" else [-F.col("count"), F.col("value")]
    ranked = row_index(counted, ranking, "rank")
    return write_scratch(
        ranked.select("value", "count", (F.col("rank") - 1).cast("double").alias("code")), "dictionary"
    )


def _hot_values(df: DataFrame, columns: Sequence[str]) -> dict[str, list]:
    """Values that hold more than ``HOT_SHARE`` of the rows, among at most 1 / ``HOT_SHARE`` others.

    One pass for all columns, with counters of that number only.
    """
    staged = df.select(*[col(c).alias(f"v{i}") for i, c in enumerate(columns)])
    found = staged.stat.freqItems(staged.columns, HOT_SHARE).first()
    return {c: [v for v in (found[i] or []) if v is not None] for i, c in enumerate(columns)}


def _join_codes(
    df: DataFrame, column: str, dictionary: DataFrame, dictionary_rows: int, unseen: float, hot: Sequence = ()
) -> DataFrame:
    """Replace a column by its code from a large dictionary.

    Frequent values get their code from the broadcast head: those frequent in the learned
    table, and ``hot`` ones of this table, whether they were learned or not. Only the others
    meet the rest of the dictionary; rows that are done are spread over salts that match
    nothing, so no value, however frequent, gathers in one task.
    """
    names = df.columns
    # Fewer than DICTIONARY_HEAD values can each hold more than this share of the rows.
    heavy = F.col("count") > dictionary_rows / DICTIONARY_HEAD
    head = dictionary.filter(heavy).select(F.col("value").alias("_head"), F.col("code").alias("_head_code"))
    if hot:
        schema = StructType([StructField("_head", dictionary.schema["value"].dataType)])
        listed = F.broadcast(df.sparkSession.createDataFrame([(v,) for v in hot], schema))
        known = dictionary.join(listed, F.col("value") == F.col("_head"), "left_semi").select(F.col("value").alias("_head"), "code")
        codes = listed.join(known, "_head", "left").select("_head", F.coalesce("code", F.lit(unseen)).alias("_head_code"))
        head = head.union(codes).dropDuplicates(["_head"])
    tail = dictionary.select(
        F.col("value").alias("_tail"), F.lit(-1).alias("_tail_salt"), F.col("code").alias("_tail_code")
    )
    near = df.join(F.broadcast(head), col(column) == F.col("_head"), "left")
    done = F.col("_head_code").isNotNull() | col(column).isNull()
    salt = F.pmod(F.xxhash64(*[col(c) for c in names]), F.lit(SALTS)).cast("int")
    far = near.withColumn("_salt", F.when(done, salt).otherwise(F.lit(-1)))
    matched = far.join(
        tail, (F.col("_salt") == F.col("_tail_salt")) & (col(column) == F.col("_tail")), "left"
    )
    code = F.coalesce(F.col("_head_code"), F.col("_tail_code"), F.lit(unseen))
    return matched.select(*[code.alias(c) if c == column else col(c) for c in names])


@dataclass
class TextCodes:
    """Codes learned from one table, to be used on any table.

    Values that were not seen, and missing ones, get one code more than the largest.
    """

    small: dict[str, list[str]] = field(default_factory=dict)
    large: dict[str, tuple[DataFrame, int, float]] = field(default_factory=dict)

    def apply(self, df: DataFrame, keep: bool = False) -> DataFrame:
        """Replace the columns by their codes, or add ``<name>_index`` with ``keep``."""
        names = list(df.columns)
        coded = {}
        small = [c for c in self.small if c in names]
        if small:
            outputs = [f"_code_{i}" for i in range(len(small))]
            inputs = [f"_text_{i}" for i in range(len(small))]
            df = df.withColumns({t: col(c) for t, c in zip(inputs, small)})
            # One model per column: a model of several columns gives unseen values of all
            # of them the code that fits the first.
            for c, given, made in zip(small, inputs, outputs):
                model = StringIndexerModel.from_labels(
                    self.small[c], inputCol=given, outputCol=made, handleInvalid="keep"
                )
                df = model.transform(df)
            # Codes are plain numbers from here on, as after a round trip through a file.
            coded = {c: F.col(o).alias("x", metadata={}) for c, o in zip(small, outputs)}
        large = [c for c in self.large if c in names]
        if keep:
            df = df.withColumns({f"_keep_{i}": col(c) for i, c in enumerate(large)})
        hot = _hot_values(df, large) if large else {}
        for c in large:
            df = _join_codes(df, c, *self.large[c], hot=hot[c])
        if not keep:
            return df.select(*[coded[c].alias(c, metadata={}) if c in coded else col(c) for c in names])
        originals = {c: F.col(f"_keep_{i}") for i, c in enumerate(large)}
        extra = {**coded, **{c: col(c) for c in large}}
        return df.select(
            *[originals.get(c, col(c)).alias(c) for c in names],
            *[extra[c].alias(f"{c}_index", metadata={}) for c in [*small, *large]],
        )


def learn_codes(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    order: str = "frequency",
    small: int = SMALL_DICTIONARY,
) -> TextCodes:
    """Learn codes for text columns (all of them by default).

    ``frequency``: most frequent value 0, equal counts by value. ``alphabet``: by
    value. Columns with few values share one pass; a column with many gets its
    dictionary as a table and never visits the driver.
    """
    types = dict(df.dtypes)
    names = list(columns) if columns else [c for c, t in types.items() if t == "string"]
    codes = TextCodes()
    if not names:
        return codes
    sizes = df.agg(*[F.approx_count_distinct(col(c)).alias(f"d{i}") for i, c in enumerate(names)]).first()
    few = [c for i, c in enumerate(names) if sizes[f"d{i}"] <= small]
    if few:
        staged = df.select(*[col(c).cast("string").alias(f"t{i}") for i, c in enumerate(few)])
        indexer = StringIndexer(
            inputCols=staged.columns,
            outputCols=[f"o{i}" for i in range(len(few))],
            stringOrderType=ORDERS[order],
            handleInvalid="skip",
        )
        codes.small = dict(zip(few, [list(a) for a in indexer.fit(staged).labelsArray]))
    for c in names:
        if c not in codes.small:
            dictionary = _dictionary(df, c, order)
            held = dictionary.agg(F.count(F.lit(1)).alias("values"), F.sum("count").alias("rows")).first()
            codes.large[c] = (dictionary, held["rows"] or 0, float(held["values"]))
    return codes


def vector_input(c: Column, data_type: str) -> Column:
    """A number a feature vector accepts: dates and timestamps as days."""
    if data_type in ("timestamp", "timestamp_ntz", "date"):
        return F.unix_date(c.cast("date")).cast("double")
    return c.cast("double")


def assemble(
    df: DataFrame, columns: Sequence[str], output: str = "features", invalid: str = "keep"
) -> DataFrame:
    """Add a vector of the columns; missing cells become NaN with ``keep``."""
    types = dict(df.dtypes)
    inputs = [f"_v{i}" for i in range(len(columns))]
    staged = df.withColumns({v: vector_input(col(c), types[c]) for v, c in zip(inputs, columns)})
    assembler = VectorAssembler(inputCols=inputs, outputCol=output, handleInvalid=invalid)
    return assembler.transform(staged).drop(*inputs)
