"""Near-duplicate documents by MinHash, checked on their full sets of word shingles.

Minima of many universal hashes are cut into bands; documents that agree in a band may be
near. Documents of equal sets are one class from the start. Candidates that hang together
over any bands form families. A family's texts meet in one task, which walks from document
to linked document: signatures rule out most pairs, the full sets decide. Families that are
too large for a task are taken apart by band, and bands too large for one are dealt in
pairs of blocks, so no pair of candidates is lost.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coppice.llm.components import connected_components
from coppice.llm.tables import Stored, free_name
from coppice.llm.text import flat, list_array, mix, shingles, signed, text_slices

#: A pair shares no band with a chance of about 2e-8 at a similarity of 0.85, 7e-6 at 0.8.
BANDS, BAND_ROWS = 30, 5
#: Links have 100 * intersection >= percent * union; unless told otherwise it is this.
PERCENT = 85
#: Standard errors below that similarity at which signatures rule out a pair.
SIGNATURE_ERRORS = 6.0
#: Shingles that meet in one task.
GROUP_SHINGLES = 1 << 22

_random = np.random.default_rng(11)
_FACTORS = _random.integers(0, 1 << 64, BANDS * BAND_ROWS, np.uint64) | np.uint64(1)
_TERMS = _random.integers(0, 1 << 64, BANDS * BAND_ROWS, np.uint64)


def minima(values: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Minimum of each universal hash over each non-empty set, one row for each set."""
    heads = ends[:-1][np.diff(ends) > 0]
    out = np.empty((len(_FACTORS), len(heads)), np.uint32)
    for k, (a, b) in enumerate(zip(_FACTORS, _TERMS, strict=True)):
        hashed = values * a
        hashed += b
        hashed >>= np.uint64(32)
        out[k] = np.minimum.reduceat(hashed, heads)
    return out.T


def band_hashes(signatures: np.ndarray) -> np.ndarray:
    parts = signatures.reshape(-1, BANDS, BAND_ROWS).astype(np.uint64)
    total = np.arange(BANDS, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.zeros((len(parts), 1), np.uint64)
    factor = 1
    for r in range(BAND_ROWS):
        factor = factor * 0xC2B2AE3D27D4EB4F % (1 << 64)
        total += mix(parts[:, :, r] + np.uint64(r)) * np.uint64(factor)
    return mix(total)


def _signature_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, data, offsets in text_slices(batch, "text"):
            values, ends = shingles(data, offsets)
            sizes = np.diff(ends)
            full = sizes > 0
            digests = []
            for salt in (0x5851F42D4C957F2D, 0x14057B7EF767814F):
                sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(values ^ np.uint64(salt)))))
                digests.append(pa.array(signed(mix(sums[ends[1:]] - sums[ends[:-1]])), mask=~full))
            bands = signed(band_hashes(minima(values, ends)).ravel()) if full.any() else np.zeros(0, np.int64)
            places = np.concatenate(([0], np.cumsum(full) * BANDS))
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(sizes), *digests, list_array(pa.array(bands), places)],
                names=["doc_id", "n_shingles", "set_a", "set_b", "bands"],
            )


def linked(ids: np.ndarray, values: np.ndarray, ends: np.ndarray, percent: int = PERCENT) -> list[tuple[int, int]]:
    """A link from each set to the smallest id that it hangs together with in the group."""
    full = np.flatnonzero(np.diff(ends) > 0)
    signature = minima(values, ends)
    sizes = np.diff(ends)[full]
    order = np.argsort(sizes, kind="stable")
    full, sizes, signature = full[order], sizes[order], signature[order]
    codes = np.unique(values, return_inverse=True)[1].astype(np.int32)
    sets = [codes[ends[i] : ends[i + 1]] for i in full]
    ids = ids[full]
    share = percent / 100
    least = (share - SIGNATURE_ERRORS * np.sqrt(share * (1 - share) / signature.shape[1])) * signature.shape[1]
    mark = np.zeros(codes.max(initial=-1) + 1, bool)
    waiting = np.ones(len(full), bool)
    links = []
    for seed in range(len(full)):
        if not waiting[seed]:
            continue
        waiting[seed], reached, together = False, [seed], [seed]
        while reached:
            x = reached.pop()
            n = sizes[x]
            # Sets of other sizes cannot reach the similarity.
            low, high = np.searchsorted(sizes, -(-n * percent // 100)), np.searchsorted(sizes, n * 100 // percent, "right")
            near = low + np.flatnonzero(waiting[low:high])
            near = near[(signature[near] == signature[x]).sum(axis=1) >= least] if len(near) else near
            if not len(near):
                continue
            mark[sets[x]] = True
            common = np.array([np.count_nonzero(mark[sets[y]]) for y in near])
            mark[sets[x]] = False
            near = near[100 * common >= percent * (n + sizes[near] - common)]
            waiting[near] = False
            reached.extend(near.tolist())
            together.extend(near.tolist())
        least_id = int(ids[together].min())
        links.extend((int(i), least_id) for i in ids[together])
    return links


def _group_links(percent: int) -> Callable[[pa.Table], pa.Table]:
    def links(group: pa.Table) -> pa.Table:
        data, offsets = flat(group["text"])
        values, ends = shingles(data, offsets)
        found = linked(group["doc_id"].to_numpy(), values, ends, percent) if len(values) else []
        found = [(u, v) for u, v in found if u != v]
        return pa.table({"u": pa.array([u for u, _ in found], pa.int64()), "v": pa.array([v for _, v in found], pa.int64())})

    return links


def _dealt(members: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Members (group, doc_id, n_shingles) of groups that fit a task, and the other ones."""
    total = members.groupBy("group").agg(F.sum("n_shingles").alias("total"))
    sized = members.join(total, "group")
    return sized.filter(F.col("total") <= GROUP_SHINGLES).drop("total"), sized.filter(F.col("total") > GROUP_SHINGLES)


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = PERCENT
) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row.

    A document's set holds its distinct shingles of five words (A-Z as a-z); one with fewer
    words has its whole sequence, one without words or text is empty and linked with
    nothing. Sets whose similarity is ``percent`` or more are linked. ``component_id`` is the smallest id reachable over links, ``kept`` says that it
    is the row's own. Rows of one id are one document with several sets: linked with what
    any of them is linked with, kept or not together. Rows without an id are linked with
    nothing, have no component and are kept. Other columns are ignored.
    """
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    rows = Stored(
        docs.mapInArrow(
            _signature_rows, "doc_id long, n_shingles long, set_a long, set_b long, bands array<long>"
        ),
        "minhash-signatures",
    ).df
    same_set = ["set_a", "set_b", "n_shingles"]
    full = rows.filter("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = Stored(full.groupBy(*same_set).agg(F.min("doc_id").alias("doc_id"), F.max("doc_id").alias("_last")), "minhash-classes").df
    members = (
        full.join(classes, [*same_set, "doc_id"], "left_semi")
        .select("doc_id", "n_shingles", F.explode("bands").alias("band"))
    )
    shared = members.groupBy("band").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most"))
    shared = shared.filter("least <> most").select("band", "least")
    candidates = Stored(members.join(shared, "band"), "minhash-candidates").df
    families = connected_components(candidates.select(F.col("doc_id").alias("u"), F.col("least").alias("v")))
    in_family = (
        candidates.groupBy("doc_id").agg(F.max("n_shingles").alias("n_shingles"))
        .join(families.df, F.col("doc_id") == F.col("node"))
        .select(F.col("component").alias("group"), "doc_id", "n_shingles")
    )
    whole, large = _dealt(in_family)
    in_band = candidates.join(large.select("doc_id"), "doc_id", "left_semi").select(F.col("band").alias("group"), "doc_id", "n_shingles")
    by_band, hot = _dealt(in_band)
    blocks = F.ceil(F.col("total") * 2 / GROUP_SHINGLES).cast("int")
    own = F.pmod(F.xxhash64("doc_id"), blocks).cast("int")
    hot = (
        hot.withColumn("_own", own)
        .withColumn("_other", F.explode(F.sequence(F.lit(0), blocks - 1)))
        .select("group", F.least("_own", "_other").alias("a"), F.greatest("_own", "_other").alias("b"), "doc_id")
    )
    none = F.lit(None).cast("int")
    groups = Stored(
        whole.select(F.lit(0).alias("kind"), "group", none.alias("a"), none.alias("b"), "doc_id")
        .union(by_band.select(F.lit(1), "group", none, none, "doc_id"))
        .union(hot.select(F.lit(2), "group", "a", "b", "doc_id")),
        "minhash-groups",
    ).df
    links = (
        docs.join(groups, "doc_id")
        .groupBy("kind", "group", "a", "b")
        .applyInArrow(_group_links(percent), "u long, v long")
    )
    equal = (
        full.select(*same_set, F.col("doc_id").alias("u"))
        .join(classes.filter("doc_id <> _last").withColumnRenamed("doc_id", "v"), same_set)
        .filter("u <> v")
        .select("u", "v")
    )
    found = connected_components(links.union(equal))
    return (
        rows.select("doc_id", "n_shingles")
        .join(found.df, F.col("doc_id") == F.col("node"), "left")
        .select(
            "doc_id",
            "n_shingles",
            F.coalesce("component", "doc_id").alias("component_id"),
            F.coalesce(F.col("component") == F.col("doc_id"), F.lit(True)).alias("kept"),
        )
    )


def without_near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = PERCENT
) -> DataFrame:
    """The rows of ``docs`` that are kept: one document of each component."""
    name = free_name(docs, "_kept")
    kept = near_duplicates(docs, doc_id, text, percent).filter("kept AND doc_id IS NOT NULL")
    kept = kept.select(F.col("doc_id").alias(name)).distinct()
    with_id = docs.join(kept, F.col(doc_id).cast("long") == F.col(name), "left_semi")
    return with_id.unionByName(docs.filter(F.col(doc_id).isNull()))
