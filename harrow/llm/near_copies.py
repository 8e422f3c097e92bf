"""Near copies by SimHash and the Jaccard similarity of word shingles (the pipeline's third stage).

Texts are sets of hashed shingles of ``width`` words; equal sets are one node.  Candidates come from SimHash, nodes whose
fingerprints differ in two bits at most, found as in :mod:`harrow.llm.simhash`; and, as few pairs at the threshold are that
near, from min-hashes of a set, which are grouped into bands: nodes that agree in a whole band share a bucket.  Every
candidate pair is verified by the exact similarity of its sets before it links.  In each bucket all nodes first meet the
bucket's smallest; then those of different components meet one another, until no bucket holds a pair that is neither
in one component nor verified.  So a family of near copies costs its size and not its square.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harrow.llm.components import connected_components
from harrow.llm.simhash import _hashes, allocate, bit_statistics, fingerprint_of, links_within
from harrow.llm.store import Store

BANDS, ROWS = 20, 5
_RNG = np.random.default_rng(31)
_FACTORS = _RNG.integers(1 << 62, 1 << 63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_MIX = _RNG.integers(1 << 62, 1 << 63, ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BAND = _RNG.integers(0, 1 << 63, BANDS, dtype=np.uint64)


def shingle_set(text: str | None, width: int = 5) -> np.ndarray:
    """The distinct hashed shingles of one text in order; words as in :func:`harrow.llm.simhash.fingerprints`."""
    return np.unique(_hashes(text or "", width))


def band_keys(shingles: np.ndarray) -> np.ndarray:
    """One key for each band; sets of similarity s share a given key with probability s ** ROWS.  No shingles have no keys."""
    if not len(shingles):
        return np.zeros(0, np.int64)
    with np.errstate(over="ignore"):
        least = np.array([((shingles ^ (shingles >> np.uint64(29))) * f).min() for f in _FACTORS]).reshape(BANDS, ROWS)
        keys = ((least ^ (least >> np.uint64(31))) * _MIX).sum(axis=1, dtype=np.uint64) ^ _BAND
        return (keys * np.uint64(0x9E3779B97F4A7C15)).view(np.int64)


def _sketches(docs: DataFrame, width: int) -> DataFrame:
    """``doc_id, h, row, node, fp, keys``: the hash of the text, of all columns and of the shingle set, the set's SimHash, and the hashes of its bands."""
    import xxhash

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, fps, keys = [], [], []
            for text in batch.column(3):
                found = shingle_set(text.as_py(), width)
                nodes.append(xxhash.xxh64_intdigest(found.tobytes()))
                fps.append(fingerprint_of(found))
                keys.append(band_keys(found))
            longs = [pa.array(np.array(x, np.uint64).view(np.int64)) for x in (nodes, fps)]
            yield pa.record_batch([*batch.columns[:3], *longs, pa.array(keys, pa.list_(pa.int64()))], names=["doc_id", "h", "row", "node", "fp", "keys"])

    return docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("h"), F.xxhash64(*docs.columns).alias("row"), "text").mapInArrow(run, "doc_id long, h long, row long, node long, fp long, keys array<long>")


def _sets(texts: DataFrame, width: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.record_batch([batch.column(0), pa.array([shingle_set(t.as_py(), width).view(np.int64) for t in batch.column(1)], pa.list_(pa.int64()))], names=["node", "shingles"])

    return texts.select("node", "text").mapInArrow(run, "node long, shingles array<long>")


def _fingerprint_pairs(sketches: DataFrame, store: Store, distance: int = 2, bucket_cap: int = 64) -> DataFrame:
    """Pairs ``a, b`` of nodes, the larger first, whose fingerprints differ in ``distance`` bits at most: those of one fingerprint as a star, others by its smallest node."""
    nodes = sketches.groupBy("node").agg(F.first("fp").alias("fp"))
    fps = store.save(nodes.groupBy("fp").agg(F.min("node").alias("rep")), "fingerprints")
    equal = nodes.join(fps, "fp").where("node != rep").select(F.col("node").alias("a"), F.col("rep").alias("b"))
    near = links_within(fps, allocate(*bit_statistics(fps), distance), distance, bucket_cap)
    return equal.unionByName(near.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")))


def _verified(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The pairs ``a, b`` whose sets have at least the similarity."""
    a, b = (sets.select(F.col("node").alias(x), F.col("shingles").alias(f"s{x}")) for x in "ab")
    both = F.size(F.array_intersect("sa", "sb"))
    least, most = F.least(F.size("sa"), F.size("sb")), F.greatest(F.size("sa"), F.size("sb"))
    joined = pairs.join(a, "a").join(b, "b").where(least >= F.lit(similarity) * most)
    return joined.where(both >= F.lit(similarity) * (F.size("sa") + F.size("sb") - both)).select("a", "b")


def components(docs: DataFrame, store: Store, width: int = 5, similarity: float = 0.8) -> DataFrame:
    """``doc_id, h, row, component`` for every row of ``docs(doc_id, text)``, ``h`` the hash of its text and ``row`` of all its columns.

    Texts whose shingle sets have at least the similarity are linked; those without words are equal.  A pair within two bits of SimHash
    is a candidate; a pair at a similarity of 0.8 shares a bucket with probability 0.9996, one at 0.9 or more practically always.
    """
    sketches = store.save(_sketches(docs, width), "sketches")
    rows = sketches.groupBy("node").agg(F.first("keys").alias("keys")).select("node", F.explode("keys").alias("key"))
    sizes = rows.groupBy("key").agg(F.min("node").alias("first"), F.count("*").alias("n")).where("n > 1")
    buckets = store.save(rows.join(sizes, "key"), "buckets")
    fingerprints = store.save(_fingerprint_pairs(sketches, store), "fingerprint-pairs")
    # one text a node that has a candidate, read again as sets are needed only there
    met = buckets.select("node").unionByName(fingerprints.select(F.explode(F.array("a", "b")).alias("node"))).distinct()
    some = sketches.join(met, "node", "left_semi").groupBy("node").agg(F.min(F.struct("h", "doc_id")).alias("m"))
    texts = docs.select(F.xxhash64("text").alias("h"), F.col("text")).join(some.select("node", F.col("m.h").alias("h")), "h").dropDuplicates(["node"])
    sets = store.save(_sets(texts, width), "sets")
    leaders = buckets.where("node != first").select(F.col("node").alias("a"), F.col("first").alias("b"))
    tried = store.save(fingerprints.unionByName(leaders).distinct(), "tried")
    links = store.save(_verified(tried, sets, similarity), "links")
    roots = connected_components(links, store)
    # what the leaders didn't join meets in full: members of one component need no pair among themselves
    root = F.coalesce("root", "node").alias("root")
    of = buckets.where("n > 2").join(roots, "node", "left").select("key", "node", root)
    mixed = of.groupBy("key").agg(F.min("root").alias("x"), F.max("root").alias("y")).where("x < y").select("key")
    of = store.save(of.join(mixed, "key"), "mixed")
    a, b = of.select("key", F.col("node").alias("b"), F.col("root").alias("rb")), of.select("key", F.col("node").alias("a"), F.col("root").alias("ra"))
    rest = a.join(b, "key").where((F.col("a") > F.col("b")) & (F.col("ra") != F.col("rb"))).select("a", "b").distinct().join(tried, ["a", "b"], "left_anti")
    more = store.save(_verified(rest, sets, similarity), "links")
    if not more.isEmpty():
        roots = connected_components(links.unionByName(more), store)
    return sketches.join(roots, "node", "left").select("doc_id", "h", "row", F.coalesce("root", "node").alias("component"))
