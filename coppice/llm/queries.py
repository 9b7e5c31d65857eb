"""The subpackage's registered queries."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from coppice.llm.align import align_tokens, link_counts
from coppice.llm.chunks import dedup_chunks
from coppice.llm.decontaminate import find_leaks
from coppice.llm.gam import fit_quality, held_out, with_quality
from coppice.llm.grammar import read_ids, write_ids
from coppice.llm.histsort import histogram_sort
from coppice.llm.minhash import near_duplicates
from coppice.llm.normsearch import integer_vectors, top_k_products
from coppice.llm.packing import pack_documents
from coppice.llm.pieces import encode_pieces
from coppice.llm.runindex import remove_repeats
from coppice.llm.tables import table
from coppice.llm.templates import judge_urls
from coppice.llm.trie import ordered_turns, prefix_trie, shared_starts

N_SHARDS = 40
LEAST_QUALITY = 0.7
BYTE_VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
WORD_VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
SEQUENCE_IDS = 2048
PIECE_MODEL = public_tokenizers.path("piece_bpe_32k.model")
DROPOUT, SEED = 0.1, 17
URL_RULES = [
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
]
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(build: Callable[[SparkSession, str], DataFrame]):
    QUERIES[build.__name__] = build
    return build


@query
def op10_histogram_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents in 40 shards of equal bytes; copies are neighbours in the order."""
    rows = table(spark, sf_dir, "documents").select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 16).cast("long").alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"),
        F.xxhash64("text").alias("text_hash"),
    )
    placed = histogram_sort(rows, F.col("size"), F.col("text_hash"), F.col("doc_id"), N_SHARDS)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query
def op7_norm_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five best inner products of every 50th vector with all others."""
    rows = table(spark, sf_dir, "embeddings")
    vector = integer_vectors(F.col("embedding"))
    return top_k_products(rows, "vec_id", vector, F.col("vec_id") % 50 == 0)


@query
def op9_path_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's verdict: by rule, else by the purity of its path template."""
    judged = judge_urls(table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels"), URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict")


@query
def op8_additive_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every text by an additive model fitted outside the held-out fold."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit_quality(docs, table(spark, sf_dir, "labels"))
    return with_quality(docs, model).select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= LEAST_QUALITY).cast("int").alias("predicted"),
    )


@query
def op1_qgram_lemma(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages of benchmark items in documents."""
    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op6_gear_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without the passages that earlier documents hold already."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    kept = F.sha2(F.coalesce(F.col("text"), F.lit("")).cast("binary"), 256)
    return dedup_chunks(docs).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", kept.alias("kept_sha256"), "text"
    )


@query
def op5_merge_dropout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of every whole text under seeded dropout, and whether they decode to it."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return encode_pieces(docs, PIECE_MODEL, SEED, DROPOUT)


@query
def op3_repair_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of all documents, written as grammar blocks and read back."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    stored = write_ids(docs, BYTE_VOCABULARY)
    return read_ids(stored.df).select("doc_id", "start", "n_tokens", "ids_crc32")


@query
def op4_minhash_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of near duplicates of every document."""
    return near_duplicates(table(spark, sf_dir, "documents"), percent=85)


@query
def op2_run_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of documents without byte strings that occur more than once."""
    return remove_repeats(table(spark, sf_dir, "documents"), with_kept=False)


@query
def op11_interval_coalescing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups and links of the tokens that two tokenizers make of every whole text."""
    aligned = align_tokens(table(spark, sf_dir, "documents"), BYTE_VOCABULARY, PIECE_MODEL)
    return link_counts(aligned.df)


@query
def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes of the trie of conversations that share starts."""
    turns, convs = ordered_turns(table(spark, sf_dir, "conversations"))
    return prefix_trie(*shared_starts(turns, convs, every=20, most=3))


@query
def op13_bound_certified(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 2048 ids."""
    return pack_documents(table(spark, sf_dir, "documents"), WORD_VOCABULARY, SEQUENCE_IDS).rows
