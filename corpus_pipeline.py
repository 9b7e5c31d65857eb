"""A training-data pipeline over ``documents``: each stage works on what the one before kept.

1. quality: documents that the additive model rejects go.
2. near_duplicates: of each component of near duplicates the document of the least id stays.
3. repeated_passages: passages that an earlier document holds already are cut out.
4. decontamination: documents with a passage of a benchmark item go.
5. pieces: texts become the ids of SentencePiece pieces under seeded dropout.

All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from coppice.llm.chunks import dedup_chunks
from coppice.llm.decontaminate import without_leaks
from coppice.llm.gam import fit_quality, with_quality
from coppice.llm.minhash import without_near_duplicates
from coppice.llm.pieces import encode_pieces
from coppice.llm.queries import DROPOUT, LEAST_QUALITY, PIECE_MODEL, SEED
from coppice.llm.tables import READ_OPTIONS, Stored, bound_batches, free_name, stored_until_here, table


#: Similarity of the word shingles of near duplicates; op4 has a threshold of its own.
NEAR_PERCENT = 80


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score is at least ``LEAST_QUALITY``."""
    plain_reads(spark)
    model = fit_quality(docs, table(spark, sf_dir, "labels"))
    score = free_name(docs, "score")
    return with_quality(docs, model, score).filter(F.col(score) >= LEAST_QUALITY).drop(score)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near duplicates."""
    plain_reads(spark)
    return without_near_duplicates(docs, percent=NEAR_PERCENT)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that earlier ones hold; texts may become empty."""
    plain_reads(spark)
    cut = dedup_chunks(docs).select(*docs.columns)
    if "n_chars" in docs.columns:
        n_chars = F.coalesce(F.length("text"), F.col("n_chars"))
        cut = cut.withColumn("n_chars", n_chars.cast(docs.schema["n_chars"].dataType))
    return cut


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of a benchmark item."""
    plain_reads(spark)
    return without_leaks(docs, table(spark, sf_dir, "benchmark"))


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of the pieces of each text, and whether they decode to it."""
    plain_reads(spark)
    return encode_pieces(docs, PIECE_MODEL, SEED, DROPOUT)


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("decontamination", decontamination),
    ("pieces", pieces),
]

#: A fitted model, MinHash, chunk borders and merges cannot be put into SQL.
ORACLE_SQL = None


def plain_reads(spark: SparkSession) -> None:
    """Read long text columns as plain streams in small batches, whoever made the reader."""
    bound_batches(spark)
    for key, value in READ_OPTIONS.items():
        spark.conf.set(key, value)


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the scratch folder and read again.

    What a stage stores on its way is deleted once its result is written, and that when the
    next stage has read it. The last stage is not written, so its input stays.
    """
    docs = table(spark, sf_dir, "documents")
    before = None
    for name, stage in STAGES[:-1]:
        with stored_until_here():
            stored = Stored(stage(spark, docs, sf_dir), f"pipeline-{name}").keep()
        if before is not None:
            before.drop()
        before, docs = stored, stored.df
    return STAGES[-1][1](spark, docs, sf_dir)
