"""The whole job on the food-delivery table: clean, fill, engineer, encode, train, score."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml.classification import DecisionTreeClassificationModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coppice.functions.text import (
    date_text,
    epoch_days,
    item_count,
    list_delimiter,
    strip_tag_quotes,
    tag_value,
)
from coppice.functions.timeofday import add_weekday_seconds, weekday_hours
from coppice.operators.columns import col
from coppice.operators.encode import TextCodes, learn_codes
from coppice.operators.impute import MISSING_TIME, FillPlan, learn_fill
from coppice.operators.score import predict
from coppice.operators.tree import train_tree
from coppice.operators.treemodel import TreeModel
from coppice.operators.vectortree import fit_vector_tree, predict_vector
from coppice.plans.schemas import (
    DATE_COLUMNS,
    ENGINEERED_ALIASES,
    ENGINEERED_COLUMNS,
    ENGINEERED_DOUBLES,
    TIME_COLUMNS,
    VECTOR_COLUMNS,
    WEEKDAYS,
)
from coppice.session import ScratchTable, write_scratch

LIST_COLUMNS = ["vendor_tag", "vendor_tag_name"]

# Strategy per type class; see coppice.operators.impute.STRATEGIES.
FAST_FILL = {"string": "frequent", "int": "median_approx", "double": "median_approx"}
EXACT_FILL = {"string": "frequent", "int": "median_lower", "double": "median_lower"}
MODE_FILL = {"string": "mode", "int": "median", "double": "median"}

LABEL = "target"


def clean_lists(df: DataFrame) -> DataFrame:
    """Commas in list columns become dashes."""
    return df.withColumns({c: list_delimiter(c) for c in LIST_COLUMNS})


def learn_missing(
    train: DataFrame, by_type: Mapping[str, str] = FAST_FILL, label: str = LABEL
) -> FillPlan:
    """Fill values from the training table: times by a constant, the rest by type."""
    constants = dict.fromkeys([c for c in TIME_COLUMNS if c in train.columns], MISSING_TIME)
    return learn_fill(train, by_type, constants, skip=[label])


def engineer(df: DataFrame, keep: Sequence[str] = (), wrap_midnight: bool = False) -> DataFrame:
    """The engineered columns (no ``target`` if the input has none) from the raw ones.

    Projections over the input only; ``keep`` names further columns to carry along.
    """
    special: dict[str, Column] = {
        **weekday_hours("", digits=1, binary=True),
        **{c: date_text(c) for c in DATE_COLUMNS},
        "create_at_x": date_text("created_at_x"),
        "primary_tags": strip_tag_quotes("primary_tags"),
        "vendor_tag_sum": item_count("vendor_tag"),
    }
    names = [n for n in ENGINEERED_COLUMNS if n != LABEL or LABEL in df.columns]
    values = {
        n: special[n] if n in special else col(ENGINEERED_ALIASES.get(n, n)) for n in names
    }
    timed = add_weekday_seconds(df, wrap_midnight=wrap_midnight)
    kinds = dict.fromkeys(names, "string") | dict.fromkeys(ENGINEERED_DOUBLES, "double")
    return timed.select(
        *[col(c) for c in keep], *[v.try_cast(kinds[n]).alias(n) for n, v in values.items()]
    )


def numeric_features(df: DataFrame, wrap_midnight: bool = False) -> DataFrame:
    """Hours per weekday, tag counts, tag values and dates as numbers; other text stays."""
    changed = {
        **weekday_hours("_opening_time", digits=2),
        "primary_tags": tag_value("primary_tags"),
        **{c: item_count(c) for c in LIST_COLUMNS},
        **{c: epoch_days(c) for c in DATE_COLUMNS},
    }
    timed = add_weekday_seconds(df, wrap_midnight=wrap_midnight)
    seconds = [f"{day}_seconds" for day in WEEKDAYS]
    return timed.withColumns(changed).drop(*TIME_COLUMNS, *seconds)


def learn_text_codes(train: DataFrame) -> TextCodes:
    """Codes by frequency for the text columns among the vector features."""
    types = dict(train.dtypes)
    return learn_codes(train, [c for c in VECTOR_COLUMNS if types.get(c) == "string"])


@dataclass
class FlowResult:
    """What a run leaves behind."""

    fill: FillPlan
    model: TreeModel | DecisionTreeClassificationModel
    scored: DataFrame
    stored: ScratchTable | None = None

    def drop(self) -> None:
        """Delete the stored rows that ``scored`` reads."""
        if self.stored is not None:
            self.stored.drop()

    def kept_summary(self) -> DataFrame:
        """``summary`` as a table of its own; the stored rows are deleted."""
        kept = write_scratch(self.summary(), "summary")
        self.drop()
        return kept

    def summary(self) -> DataFrame:
        """Rows and accuracy per part of the split."""
        hit = F.coalesce(F.col("prediction") == F.col(LABEL), F.lit(False))
        return self.scored.groupBy("split").agg(
            F.count(F.lit(1)).alias("n_rows"), F.avg(hit.cast("double")).alias("accuracy")
        )


def _filled(rows: DataFrame, split: Column, by_type: Mapping[str, str]) -> tuple[DataFrame, FillPlan]:
    """Tagged rows without missing values; fill values come from training rows alone."""
    tagged = clean_lists(rows).withColumn("split", split)
    fill = learn_missing(tagged.filter("split = 'Train'").drop("split"), by_type)
    return fill.apply(tagged), fill


def run_flow(
    rows: DataFrame,
    split: Column,
    by_type: Mapping[str, str] = FAST_FILL,
    max_depth: int = 5,
    store: bool = True,
) -> FlowResult:
    """Train the exhaustive tree on rows tagged ``Train``; score every row.

    ``store`` writes engineered rows to the scratch folder, so that later stages read narrow
    columns instead of repeating joins and text work; ``FlowResult.drop`` deletes them. ``rows``
    are read twice for the fill values and once to engineer them, so they have to repeat.
    """
    filled, fill = _filled(rows, split, by_type)
    shaped, stored = engineer(filled, keep=["split"]), None
    if store:
        stored = ScratchTable(shaped, "engineered")
        shaped = stored.df
    features = [c for c in ENGINEERED_COLUMNS if c != LABEL]
    model = train_tree(shaped.filter("split = 'Train'"), features, LABEL, max_depth=max_depth)
    return FlowResult(fill, model, predict(shaped, model), stored)


def run_vector_flow(
    rows: DataFrame,
    split: Column,
    by_type: Mapping[str, str] = FAST_FILL,
    max_depth: int = 4,
    max_bins: int = 256,
    store: bool = True,
) -> FlowResult:
    """As ``run_flow`` with encoded text, feature vectors and the binned MLlib tree."""
    filled, fill = _filled(rows, split, by_type)
    shaped = numeric_features(filled).select("split", *VECTOR_COLUMNS, LABEL)
    codes = learn_text_codes(shaped.filter("split = 'Train'").drop("split"))
    coded, stored = codes.apply(shaped), None
    if store:
        # Before the last fill values are learned, so that their passes read stored numbers.
        stored = ScratchTable(coded, "coded")
        coded = stored.df
    # Counts over lists that stayed missing have no value yet; vectors need one.
    numbers = {k: v for k, v in by_type.items() if k != "string"}
    rest = learn_fill(coded.filter("split = 'Train'").drop("split"), numbers, skip=[LABEL])
    coded = rest.apply(coded)
    train = coded.filter("split = 'Train'")
    model = fit_vector_tree(train, VECTOR_COLUMNS, LABEL, "entropy", max_depth, max_bins)
    scored = predict_vector(coded, model, VECTOR_COLUMNS)
    return FlowResult(fill, model, scored, stored)
