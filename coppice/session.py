"""Session helpers: the shared scratch folder and a local session for tests."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int = 8, memory: str = "12g") -> SparkSession:
    """A single-machine session; on a cluster use the session you are given."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("coppice")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        # HotSpot does not compile methods above 8000 bytes; wide projections go through
        # one generated method per stage, which would then run interpreted.
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
        .getOrCreate()
    )


def scratch_root(spark: SparkSession) -> str:
    """Folder for checkpoints and intermediate tables, shared by all executors.

    The cluster names it in ``spark.checkpoint.dir``. Only a local-mode session
    without that setting gets a temporary folder of its own.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not root:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="coppice-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the scratch root."""
    return os.path.join(scratch_root(spark), "coppice", f"{label}-{uuid.uuid4().hex}")


def write_scratch(df: DataFrame, label: str) -> DataFrame:
    """Store ``df`` as a parquet table in the scratch folder and read it back.

    Cuts lineage and survives the loss of executors; readers still get column
    pruning and filter pushdown.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class ScratchTable:
    """A table stored in the scratch folder, which can be deleted when no plan reads it."""

    def __init__(self, df: DataFrame, label: str):
        self.spark = df.sparkSession
        self.path = scratch_path(self.spark, label)
        df.write.parquet(self.path)
        self.df = self.spark.read.schema(df.schema).parquet(self.path)

    def drop(self) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


#: Rows of a task that makes wide rows out of narrow ones, or holds them in memory.
ROWS_PER_TASK = 250_000


def deal_rows(df: DataFrame, n_rows: int) -> DataFrame:
    """Deal ``n_rows`` narrow rows out to as many tasks as their number asks for, a core each at least.

    Blocks of a file tell bytes only: well compressed columns put millions of rows in one task.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(max(cores, -(-n_rows // ROWS_PER_TASK)))


def split_large_methods(spark: SparkSession) -> None:
    """Have Spark split the code of wide projections into methods that HotSpot compiles.

    It does not compile methods above 8000 bytes, and whole-stage code puts a projection into one;
    beyond this limit Spark makes code by expression instead. Stays set in the session.
    """
    if int(spark.conf.get("spark.sql.codegen.hugeMethodLimit", "65535")) > 8000:
        spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")


#: Parts of a scan for each core, at least, where they hold more than the cost of opening a file.
SCAN_PARTS = 4


def even_scans(spark: SparkSession) -> None:
    """Have Spark cut scans into several parts a core, so that the last ones are short.

    Its own rule aims at one a core and often leaves one more, which then runs alone. Stays set in
    the session; a number that was set already is kept.
    """
    if spark.conf.get("spark.sql.files.minPartitionNum", None) is None:
        parts = SCAN_PARTS * spark.sparkContext.defaultParallelism
        spark.conf.set("spark.sql.files.minPartitionNum", str(parts))
