"""Given tables, and intermediate tables in the shared scratch folder."""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from coppice.session import scratch_path


#: Vectored reads of long text columns go through direct buffers as large as a column
#: chunk, which every reading thread keeps; plain streams need none of that memory.
READ_OPTIONS = {"parquet.hadoop.vectored.io.enabled": "false"}


#: Bytes of an Arrow batch: whole texts pass through Python, so rows are no measure.
BATCH_BYTES = 4 << 20


def bound_batches(spark: SparkSession) -> None:
    """Let the session's Arrow batches hold ``BATCH_BYTES``, or one row that is longer."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bound_batches(spark)
    return spark.read.options(**READ_OPTIONS).parquet(f"{sf_dir}/{name}.parquet")


#: Tables stored inside each open ``stored_until_here``, innermost last.
_open: list[list[Stored]] = []


@contextmanager
def stored_until_here() -> Iterator[None]:
    """Delete at the end what is stored inside, also if it fails; ``Stored.keep`` spares a table.

    For work whose results are written inside: plans that read the deleted tables cannot run
    any more. Inner blocks delete their own tables, and a table kept there is left to the block
    around it.
    """
    _open.append([])
    try:
        yield
    finally:
        for stored in _open.pop():
            if not stored.kept:
                stored.drop()
            elif _open:
                stored.kept = False
                _open[-1].append(stored)


class Stored:
    """A table written to the scratch folder: cuts lineage and outlives lost executors."""

    kept = False

    def __init__(self, df: DataFrame, label: str):
        self.spark = df.sparkSession
        self.path = scratch_path(self.spark, label)
        if _open:
            _open[-1].append(self)
        df.write.parquet(self.path)
        self.df = self.spark.read.options(**READ_OPTIONS).schema(df.schema).parquet(self.path)

    def keep(self) -> Stored:
        """The table outlives the ``stored_until_here`` block that it was stored in."""
        self.kept = True
        return self

    def drop(self) -> None:
        """Delete the files; for tables that no later plan reads."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def small_table(spark: SparkSession, schema: str, rows: Iterable[Sequence]) -> DataFrame:
    """A table of parameters as an expression of the plan.

    ``schema`` is DDL with fields of numbers, strings and arrays of them.
    """
    text = json.dumps([list(r) for r in rows])
    names = [f.name for f in _fields(spark, schema)]
    struct = ", ".join(f"`{f.name}`: {f.dataType.simpleString()}" for f in _fields(spark, schema))
    items = json.dumps([dict(zip(names, r, strict=True)) for r in json.loads(text)])
    parsed = F.from_json(F.lit(items), f"array<struct<{struct}>>")
    return spark.range(1).select(F.inline(parsed))


def _fields(spark: SparkSession, schema: str):
    from pyspark.sql.types import StructType

    return StructType.fromDDL(schema).fields


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores in front until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name
