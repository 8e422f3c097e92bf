"""Embedding near-duplicates by sorted projection passes (operator 5).

Each pass draws random hyperplanes, writes every vector's signs as one sequence of
hashes and sorts the vectors by it; the vectors within ``window`` places of each other are
compared by their exact cosine, and the linked ones are joined.  The union over the passes
gives the components.  The number of passes follows from how many signs the sorted vectors share across a
window, so that a pair just at the threshold is met with probability ``recall`` at every size and
density; where vectors crowd, signs are correlated and more passes follow.  Passes also go on until
one round of them joins no more components.

Linked vectors are in one component, so each vector's links are then counted
inside its component: components of up to ``cell`` vectors together in one cell, larger
ones in pairs of blocks of ``cell`` vectors spread over the tasks.  Only counts leave a
block, never pairs.  Equal vectors are one throughout, with their number as its weight.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harrow.llm.components import connected_components
from harrow.llm.store import Store

PLANES = 64
ROUND = 12  # passes that share one sort


def unit_vectors(vectors: DataFrame) -> DataFrame:
    """``vec_id, unit`` (array of doubles, length 1) for each vector that can link.

    Null, empty or zero vectors and those with null or non-finite components are left out.
    """
    def whole(x):
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))

    v = F.transform("embedding", lambda x: x.cast("double"))
    top = F.array_max(F.transform("v", F.abs))  # scaled first: squares neither overflow nor vanish
    norm = F.sqrt(F.aggregate("w", F.lit(0.0), lambda a, x: a + x * x))
    return (
        vectors.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & (F.size("embedding") > 0) & F.forall("embedding", whole))
        .select(F.col("vec_id").cast("long"), v.alias("v"))
        .withColumn("top", top)
        .where("top > 0")
        .select("vec_id", F.transform("v", lambda x: x / F.col("top")).alias("w"))
        .withColumn("norm", norm)
        .select("vec_id", F.transform("w", lambda x: x / F.col("norm")).alias("unit"))
    )


def passes_needed(n: int, window: int, cosine: float, recall: float) -> int:
    """Passes after which a pair at the threshold was within a window with probability ``recall`` if every sign halves the vectors: the least there are.

    A pass keeps such a pair together while their first log2(n / window) signs agree.
    """
    agree = 1 - math.acos(cosine) / math.pi
    met = agree ** max(1.0, math.log2(max(n, 2) / window))
    return max(2, math.ceil(math.log(1 - recall) / math.log(1 - met)))


def passes_for(shared: dict[int, int], cosine: float, recall: float) -> int:
    """Passes after which a pair at the threshold was met with probability ``recall``, on the mean over all and over the more crowded half.

    ``shared`` maps a number of leading signs that the vectors of a block have in common to the number of groups of linked vectors in
    such blocks; a pair stays together while it agrees in one sign more.
    """
    agree = 1 - math.acos(cosine) / math.pi
    depth = np.array(sorted(shared, reverse=True), float)
    n = np.array([shared[int(d)] for d in depth], float)
    met = agree ** (depth + 1)
    half = np.clip(n.sum() / 2 - (np.cumsum(n) - n), 0, n)

    def enough(passes: int) -> bool:
        return all(w @ (1 - (1 - met) ** passes) >= recall * w.sum() for w in (n, half))

    low, high = 1, 2
    while not enough(high):
        low, high = high, 2 * high
    while high - low > 1:
        middle = (low + high) // 2
        low, high = (low, middle) if enough(middle) else (middle, high)
    return high


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _stars(ids: np.ndarray, linked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each id that has a link, with the smallest id that its links reach in this block."""
    label = ids.copy()
    far = np.iinfo(np.int64).max
    while True:
        best = np.minimum(label, np.where(linked, label[None, :], far).min(axis=1))
        if (best == label).all():
            break
        label = best
    moved = label != ids
    return ids[moved], label[moved]


def window_links(units: DataFrame, passes: range, window: int, cosine: float, seed: int) -> DataFrame:
    """What the passes find, as ``kind, part, a, b``: edges (0); the first and last ids of a task's range (1, 2),
    which meet those of the ranges beside it later; and how many groups ``b`` of linked vectors stand in blocks that share ``a`` leading signs (3).

    One range sort by (pass, hashes, id) serves all passes.  A task streams through its range
    in blocks of ``window`` vectors and compares each with itself and the block before.
    """

    def hash_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column(1))
            for k in passes:
                planes = np.random.default_rng((seed, k, x.shape[1])).standard_normal((x.shape[1], PLANES))
                signs = np.packbits(x @ planes > 0, axis=1)
                order = pa.array([s.tobytes() for s in signs], pa.binary())
                yield pa.record_batch([pa.array(np.full(len(x), k, np.int32)), order, *batch.columns], names=["pass", "hashes", "vec_id", "unit"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()

        def found(kind: int, a, b) -> pa.RecordBatch:
            n = len(a)
            return pa.record_batch([pa.array(np.full(n, kind, np.int32)), pa.array(np.full(n, part, np.int32)), pa.array(np.asarray(a, np.int64)), pa.array(np.asarray(b, np.int64))], names=["kind", "part", "a", "b"])

        def blocks() -> Iterator[tuple]:
            """Whole blocks, whatever the batches; the last may be shorter."""
            ids, x, keys = np.zeros(0, np.int64), None, []
            for batch in batches:
                ids, new = np.concatenate([ids, batch.column(2).to_numpy()]), _matrix(batch.column(3))
                x = new if x is None else np.concatenate([x, new])
                keys += list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()))
                whole = len(ids) // window * window
                for at in range(0, whole, window):
                    yield ids[at : at + window], x[at : at + window], keys[at : at + window]
                ids, x, keys = ids[whole:], x[whole:], keys[whole:]
            if len(ids):
                yield ids, x, keys

        held_ids, held = None, None
        for ids, x, keys in blocks():
            if held is None:
                both_ids, both = ids, x
                yield found(1, ids, np.zeros(len(ids)))
            else:
                both_ids, both = np.concatenate([held_ids, ids]), np.concatenate([held, x])
            a, b = _stars(both_ids, both @ both.T >= cosine)
            if len(a):
                yield found(0, a, b)
            if len(ids) == window and keys[0][0] == keys[-1][0]:
                apart = int.from_bytes(keys[0][1], "big") ^ int.from_bytes(keys[-1][1], "big")
                groups = len(np.unique(np.concatenate([np.setdiff1d(ids, a), b])))
                if groups > 1:  # one linked group needs no more passes
                    yield found(3, [PLANES - apart.bit_length()], [groups])
            held_ids, held = both_ids[-window:], both[-window:]
        if held is not None:
            yield found(2, held_ids, np.zeros(len(held_ids)))

    rows = units.mapInArrow(hash_all, "pass int, hashes binary, vec_id long, unit array<double>")
    ordered = rows.repartitionByRange("pass", "hashes", "vec_id").sortWithinPartitions("pass", "hashes", "vec_id")
    return ordered.mapInArrow(compare, "kind int, part int, a long, b long")


def border_links(found: DataFrame, units: DataFrame, cosine: float) -> DataFrame:
    """Edges ``a, b`` between the last vectors of each range and the first of the next, from what :func:`window_links` gives."""
    parts = sorted(r["part"] for r in found.where("kind = 1").select("part").distinct().collect())  # one number a task
    after = dict(zip(parts, parts[1:]))
    if not after:
        return found.where("false").select("a", "b")
    following = units.sparkSession.createDataFrame(list(after.items()), "part int, border int")
    tails = found.where("kind = 2").join(F.broadcast(following), "part").select("border", F.col("a").alias("vec_id"))
    heads = found.where("kind = 1").select(F.col("part").alias("border"), F.col("a").alias("vec_id"))
    ends = tails.unionByName(heads.join(F.broadcast(following.select("border")), "border"))

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        ids, x = pdf["vec_id"].to_numpy(), np.stack(pdf["unit"].to_numpy())
        a, b = _stars(ids, x @ x.T >= cosine)
        return pd.DataFrame({"a": a, "b": b})

    return ends.distinct().join(units, "vec_id").groupBy("border").applyInPandas(compare, "a long, b long")


def all_links(units: DataFrame, store: Store, n: int, window: int, cosine: float, recall: float, seed: int) -> DataFrame:
    """``node, root`` of the components, from as many rounds of passes as the vectors ask for."""
    roots, done, most = None, 0, passes_needed(n, window, cosine, recall)
    shared: dict[int, int] = {}
    while True:
        new = min(most - done, ROUND) if most > done else ROUND // 2
        found = store.save(window_links(units, range(done, done + new), window, cosine, seed), "found")
        done += new
        for r in found.where("kind = 3").groupBy("a").agg(F.sum("b").alias("n")).collect():
            shared[r["a"]] = shared.get(r["a"], 0) + r["n"]
        most = max(most, passes_for(shared, cosine, recall)) if shared else most
        edges = found.where("kind = 0").select("a", "b").unionByName(border_links(found, units, cosine))
        if roots is None:
            joined, moved = edges, True
        else:
            ends = edges.distinct()
            for c in "ab":
                own = roots.select(F.col("node").alias(c), F.col("root").alias(f"r{c}"))
                ends = ends.join(own, c, "left").withColumn(f"r{c}", F.coalesce(f"r{c}", c))
            fresh = store.save(ends.where("ra != rb").select(F.col("ra").alias("a"), F.col("rb").alias("b")).distinct(), "fresh")
            joined, moved = fresh.unionByName(roots.select(F.col("node").alias("a"), F.col("root").alias("b"))), not fresh.isEmpty()
        if moved:
            roots = store.save(connected_components(joined, store), "roots")
        store.release()
        if done >= most and not moved:
            return roots


def count_links(units: DataFrame, roots: DataFrame, cosine: float, cell: int) -> DataFrame:
    """``vec_id, n`` over the pairs inside each component with a cosine of at least ``cosine``: the weights of all that a vector links with, itself included."""
    of_root = roots.select(F.col("node").alias("vec_id"), "root").unionByName(roots.select(F.col("root").alias("vec_id"), "root").distinct())
    sizes = of_root.groupBy("root").agg(F.count("*").alias("n"))
    member = units.join(of_root, "vec_id").join(sizes, "root")
    blocks = F.ceil(F.col("n") / cell).cast("long")
    mine = F.pmod(F.xxhash64("vec_id"), blocks)
    cells = max(64, 4 * int(units.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-of_root.count() // cell))
    # a block meets every block of its component once, as the row side; both sides get the rows
    none = F.lit(-1).cast("long")
    whole = member.where(blocks == 1).select("vec_id", "unit", "weight", "root", F.pmod(F.xxhash64("root"), F.lit(cells)).alias("c"), none.alias("i"), none.alias("j"), none.alias("mine"))
    every = F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)).alias("other")
    pairs = member.where(blocks > 1).select("vec_id", "unit", "weight", "root", mine.alias("mine"), every).select(
        "vec_id", "unit", "weight", "root", F.col("root").alias("c"), F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"), "mine"
    )

    def count(pdf: pd.DataFrame) -> pd.DataFrame:
        out_ids, out_n = [], []
        i, j = int(pdf["i"].iloc[0]), int(pdf["j"].iloc[0])
        for _, group in pdf.groupby("root", sort=False):
            ids, x, w = group["vec_id"].to_numpy(), np.stack(group["unit"].to_numpy()), group["weight"].to_numpy()
            if i == j:
                out_ids.append(ids)
                out_n.append(np.concatenate([(x[k : k + 1024] @ x.T >= cosine) @ w for k in range(0, len(x), 1024)]))
            else:
                first = group["mine"].to_numpy() == i
                links = x[first] @ x[~first].T >= cosine
                out_ids += [ids[first], ids[~first]]
                out_n += [links @ w[~first], w[first] @ links]
        return pd.DataFrame({"vec_id": np.concatenate(out_ids), "n": np.concatenate(out_n).astype(np.int64)})

    counted = whole.unionByName(pairs).groupBy("c", "i", "j").applyInPandas(count, "vec_id long, n long")
    return counted.groupBy("vec_id").agg(F.sum("n").alias("n"))


def small_groups(units: DataFrame, cosine: float) -> DataFrame:
    """``node, root`` of the components of vectors whose length few others have: each length's vectors are compared all with all."""

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        ids, x = pdf["vec_id"].to_numpy(), np.stack(pdf["unit"].to_numpy())
        node, root = _stars(ids, x @ x.T >= cosine)
        return pd.DataFrame({"node": node, "root": root})

    return units.withColumn("length", F.size("unit")).groupBy("length").applyInPandas(compare, "node long, root long")


def near_duplicates(vectors: DataFrame, store: Store, cosine: float = 0.9, window: int = 512, recall: float = 0.995, cell: int = 2048, seed: int = 7, mixed_lengths: bool = False) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row of ``vectors(vec_id, embedding)``.

    Links are pairs of different ids with a cosine, in double precision, of at least ``cosine``.  Vectors
    that are null, empty, zero or hold null or non-finite components link with nothing, as do rows
    without an id.  Vectors of different lengths raise an error, or with ``mixed_lengths`` link with those of their own length only: lengths
    that more vectors have than a window go through the passes one after the other, all others are compared all with all.
    Rows that repeat an id count as one vector (the first by value that can link).  Other columns are ignored.
    """
    valid = unit_vectors(vectors)
    rows = valid.groupBy("vec_id").agg(F.min("unit").alias("unit")).select("vec_id", F.xxhash64("unit").alias("h"), F.xxhash64(F.lit(1), F.col("unit")).alias("g"), "unit")
    rows = store.save(rows, "vectors")
    # equal vectors are one, the smallest of their ids, with their number as its weight
    first = F.min(F.struct("vec_id", "unit")).alias("first")
    units = store.save(rows.groupBy("h", "g").agg(first, F.count("*").alias("weight")).select("h", "g", "first.*", "weight"), "units")
    plain = units.select("vec_id", "unit")
    lengths = plain.groupBy(F.size("unit").alias("length")).agg(F.count("*").alias("n"))
    if not mixed_lengths and lengths.limit(2).count() > 1:
        raise ValueError("the vectors differ in length")
    # each has more vectors than a window, so there are few
    large = {r["length"]: r["n"] for r in lengths.where(F.col("n") > window).collect()}
    small = plain.where(~F.size("unit").isin(*large)) if large else plain
    roots = [store.save(small_groups(small, cosine), "small")]
    for length, n in sorted(large.items()):
        own = plain if len(large) == 1 and n == plain.count() else store.save(plain.where(F.size("unit") == length), "length")
        roots.append(all_links(own, store, n, window, cosine, recall, seed))
    roots = reduce(DataFrame.unionByName, roots)
    links = store.save(count_links(units.select("vec_id", "unit", "weight"), roots, cosine, cell), "links")
    leaders = units.select("h", "g", F.col("vec_id").alias("leader"), "weight").join(links.withColumnRenamed("vec_id", "leader"), "leader", "left").join(roots.withColumnRenamed("node", "leader"), "leader", "left")
    # a vector that links with others has them all and itself in n, one that doesn't has its equals
    each = leaders.select("h", "g", (F.coalesce("n", "weight") - 1).alias("n_links"), F.coalesce("root", "leader").alias("component_id"))
    known = rows.select("vec_id", "h", "g").join(each, ["h", "g"]).select(F.col("vec_id").alias("of"), "n_links", "component_id")
    found = vectors.select(F.col("vec_id").cast("long")).join(known, F.col("vec_id") == F.col("of"), "left")
    component = F.coalesce("component_id", "vec_id")
    return found.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"))
