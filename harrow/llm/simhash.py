"""SimHash near-duplicates by the generalised pigeonhole principle (operator 10).

Fingerprints within ``distance`` bits are linked.  The 64 bits are grouped into
partitions, correlated bits together, and each partition gets its own threshold so
that the thresholds add up to ``distance - partitions + 1``; then two linked
fingerprints agree within the threshold in at least one partition.  A dynamic
programme picks the thresholds with the fewest estimated candidates, and the number of
partitions with the lowest total is taken.  The estimate rests on bit statistics of all fingerprints.

Equal fingerprints are one node.  Buckets of up to ``bucket_cap`` nodes are verified
pair by pair; in larger ones every node is joined to the smallest node within one bit of a
common point instead.  Two fingerprints are at most two bits apart exactly when
such a point exists, so the components stay whole while the work grows with the bucket's
size and not its square.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harrow.llm.components import connected_components
from harrow.llm.store import Store

_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_LOWER = {c: c + 32 for c in range(65, 91)}
_SHIFTS = np.arange(64, dtype=np.uint64)


def _hashes(text: str, width: int) -> np.ndarray:
    import xxhash

    words = _WORD.findall(text.translate(_LOWER))
    if not words:
        return np.zeros(0, np.uint64)
    grams = map(" ".join, zip(*(words[k:] for k in range(width)))) if len(words) >= width else [" ".join(words)]
    digest = xxhash.xxh64_intdigest
    return np.array([digest(g.encode(), 42) for g in grams], np.uint64)


def fingerprint(text: str | None, width: int = 3) -> int:
    """The 64-bit SimHash of one text; see :func:`fingerprints`."""
    return fingerprint_of(_hashes(text or "", width))


def fingerprint_of(h: np.ndarray) -> int:
    """The bits that are set in over half the hashes; none give zero."""
    if not len(h):
        return 0
    counts = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int((np.uint64(1) << _SHIFTS)[counts * 2 > len(h)].sum(dtype=np.uint64))


def fingerprints(docs: DataFrame, width: int = 3) -> DataFrame:
    """``doc_id, fp`` of ``docs(doc_id, text)``, ``fp`` as a signed bigint with the same bits.

    A-Z become lower case; words are runs of anything but space and ``\\x09-\\x0D``; a
    bit is set if it is set in over half the hashes of the ``width``-word shingles, repeats
    included.  Shorter texts are one shingle; no words or a null text give zero.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(t.as_py(), width) for t in batch.column(1)], np.uint64).view(np.int64)
            yield pa.record_batch([batch.column(0), pa.array(fps)], names=["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, fp long")


def bit_statistics(fps: DataFrame) -> tuple[int, np.ndarray]:
    """How many fingerprints there are and how many have bits i and j both set (64 x 64)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros((64, 64)), 0
        for batch in batches:
            x = batch.column(0).to_numpy().view(np.uint8).reshape(-1, 8)
            bits = np.unpackbits(x, axis=1, bitorder="little").astype(np.float32)
            total, n = total + (bits.T @ bits), n + len(bits)
        i, j = np.divmod(np.arange(4096), 64)
        rows = [np.append(i, 64), np.append(j, 64), np.append(total.ravel(), n)]
        yield pa.record_batch([pa.array(rows[0].astype(np.int32)), pa.array(rows[1].astype(np.int32)), pa.array(rows[2].astype(np.float64))], names=["i", "j", "n"])

    sums = fps.select("fp").mapInArrow(count, "i int, j int, n double").groupBy("i", "j").agg(F.sum("n").alias("n")).collect()
    both, n = np.zeros((64, 64)), 0.0
    for r in sums:  # 4,097 rows, whatever the size of the corpus
        if r["i"] < 64:
            both[r["i"], r["j"]] = r["n"]
        else:
            n = r["n"]
    return int(n), both


def group_bits(n: int, both: np.ndarray, parts: int) -> list[list[int]]:
    """Split the bits into ``parts`` near-equal groups, each grown from a seed by mean absolute correlation."""
    p = both.diagonal() / max(n, 1)
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-9))
    corr = np.abs((both / max(n, 1) - np.outer(p, p)) / np.outer(spread, spread))
    left, groups = set(range(64)), []
    for k in range(parts):
        size = len(left) // (parts - k)
        group = [min(left)]
        left.discard(group[0])
        while len(group) < size:
            best = max(sorted(left), key=lambda b: corr[b, group].mean())
            group.append(best)
            left.discard(best)
        groups.append(sorted(group))
    return groups


def _estimates(n: int, p: np.ndarray, bits: list[int], most: int) -> list[float]:
    """Expected cost of thresholds -1, 0, .. ``most``: probes and candidate pairs, bits taken as independent."""
    same = p[bits] ** 2 + (1 - p[bits]) ** 2
    near = np.zeros(most + 1)
    near[0] = 1.0
    for s in same:  # distribution of the distance within the partition
        near = near * s + np.append(0, near[:-1]) * (1 - s)
    cost, probes = [0.0], 0
    for t in range(most + 1):
        probes += len(list(combinations(range(len(bits)), t)))
        cost.append(n * probes + n * n / 2 * near[: t + 1].sum())
    return cost


def allocate(n: int, both: np.ndarray, distance: int) -> list[tuple[list[int], int]]:
    """The partitions with thresholds of at least 0, by the lowest estimated cost."""
    p = np.clip(both.diagonal() / max(n, 1), 1e-6, 1 - 1e-6)
    best: tuple[float, list[tuple[list[int], int]]] | None = None
    for parts in range(1, distance + 4):
        groups = group_bits(n, both, parts)
        goal = distance - parts + 1
        # states: sum of the thresholds so far -> (cost, thresholds)
        states: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
        for g in groups:
            cost = _estimates(n, p, g, distance)
            after: dict[int, tuple[float, list[int]]] = {}
            for total, (c, chosen) in states.items():
                for t in range(-1, distance + 1):
                    new = (c + cost[t + 1], [*chosen, t])
                    if total + t not in after or new[0] < after[total + t][0]:
                        after[total + t] = new
            states = after
        if goal in states and (best is None or states[goal][0] < best[0]):
            best = (states[goal][0], [(g, t) for g, t in zip(groups, states[goal][1]) if t >= 0])
    return best[1]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def links_within(nodes: DataFrame, plan: list[tuple[list[int], int]], distance: int, cap: int) -> DataFrame:
    """Edges ``a, b`` (representative ids) whose components are those of all links."""
    rows = []
    for k, (bits, t) in enumerate(plan):
        mask = _signed(sum(1 << b for b in bits))
        flips = [_signed(sum(1 << b for b in c)) for r in range(1, t + 1) for c in combinations(bits, r)]
        key = F.col("fp").bitwiseAND(F.lit(mask))
        keys = F.array(F.struct(key.alias("key"), F.lit(True).alias("own")), *[F.struct(key.bitwiseXOR(F.lit(f)).alias("key"), F.lit(False).alias("own")) for f in flips])
        rows.append(nodes.select("fp", "rep", F.lit(k).alias("part"), F.explode(keys).alias("k")).select("fp", "rep", "part", "k.key", "k.own"))
    rows = reduce(DataFrame.unionByName, rows)
    sizes = rows.groupBy("part", "key").agg(F.count("*").alias("n"), F.max("own").alias("held")).where((F.col("n") > 1) & F.col("held"))
    rows = rows.join(sizes.select("part", "key", "n"), ["part", "key"])
    few = rows.where(F.col("n") <= cap).select("part", "key", "fp", "rep", "own")
    # at most cap partners a row, as the bucket has at most cap rows
    a, b = few.where("own").alias("a"), few.alias("b")
    apart = F.bit_count(F.col("a.fp").bitwiseXOR(F.col("b.fp")))
    same = (F.col("a.part") == F.col("b.part")) & (F.col("a.key") == F.col("b.key"))
    pairs = a.join(b, same & (F.col("a.fp") != F.col("b.fp")) & (apart <= distance)).select(F.col("a.rep").alias("a"), F.col("b.rep").alias("b"))
    # larger buckets: stars around common points within distance / 2
    balls = [0, *[_signed(sum(1 << b for b in c)) for r in range(1, distance // 2 + 1) for c in combinations(range(64), r)]]
    point = F.explode(F.array(*[F.col("fp").bitwiseXOR(F.lit(f)) for f in balls])).alias("point")
    many = rows.where(F.col("n") > cap).select("fp", "rep").distinct().select("rep", point)
    centre = many.groupBy("point").agg(F.min("rep").alias("b"), F.count("*").alias("n")).where("n > 1").select("point", "b")
    stars = many.join(centre, "point").where(F.col("rep") != F.col("b")).select(F.col("rep").alias("a"), "b")
    return pairs.unionByName(stars)


def near_duplicates(docs: DataFrame, store: Store, width: int = 3, distance: int = 2, bucket_cap: int = 64) -> DataFrame:
    """``doc_id, fingerprint, component_id`` for every row of ``docs(doc_id, text)``.

    Fingerprints at most ``distance`` (0 or an even number) bits apart link their documents; the
    component's id is its smallest ``doc_id``.  Null or blank texts have fingerprint
    zero and link like any other.  A null ``doc_id`` takes part but never names a component
    that has another id.  Repeated rows stay; other columns are ignored; an empty table gives none.
    """
    if distance % 2:
        raise ValueError("the distance must be even")
    fps = store.save(fingerprints(docs, width), "fingerprints")
    nodes = store.save(fps.groupBy("fp").agg(F.min("doc_id").alias("rep"), F.count("*").alias("n")), "nodes")
    n, both = bit_statistics(nodes)
    links = links_within(nodes.where(F.col("rep").isNotNull()), allocate(n, both, distance), distance, bucket_cap)
    roots = connected_components(links, store)
    named = (
        nodes.join(roots, nodes["rep"] == roots["node"], "left")
        .where((F.col("n") > 1) | F.col("root").isNotNull())
        .select("fp", F.coalesce("root", "rep").alias("component_id"))
    )
    shown = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return fps.join(named, "fp", "left").select("doc_id", shown.alias("fingerprint"), F.coalesce("component_id", "doc_id").alias("component_id"))
