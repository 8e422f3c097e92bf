from __future__ import annotations

import random

import numpy as np
import pytest

from harrow.llm import simhash, vector_dedup
from harrow.llm.components import connected_components


def roots_of(nodes, links):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, store, seed):
    rng = random.Random(seed)
    links = [(rng.randrange(60), rng.randrange(60)) for _ in range(35)] + [(100 + i, 101 + i) for i in range(40)] + [(300, 300 + i) for i in range(1, 50)] + [(None, 1), (5, 5)]
    expected = roots_of({x for e in links for x in e if x is not None}, [e for e in links if None not in e])
    got = {r["node"]: r["root"] for r in connected_components(spark.createDataFrame(links, "a long, b long"), store).collect()}
    assert got == {n: r for n, r in expected.items() if n != r}


def test_no_components(spark, store):
    assert connected_components(spark.createDataFrame([], "a long, b long"), store).count() == 0


def family(rng, base, n, flips):
    words = base.split()
    out = []
    for _ in range(n):
        w = list(words)
        for _ in range(flips):
            w[rng.randrange(len(w))] = f"w{rng.randrange(10**6)}"
        out.append(" ".join(w))
    return out


def simhash_truth(rows):
    import xxhash

    fps = {}
    for i, (d, t) in enumerate(rows):
        w = __import__("re").findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in (t or "")))
        grams = [" ".join(w[k : k + 3]) for k in range(len(w) - 2)] or ([" ".join(w)] if w else [])
        h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
        fps[i] = sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))
    links = [(i, j) for i in fps for j in fps if i < j and (fps[i] ^ fps[j]).bit_count() <= 2]
    roots = roots_of(fps, links)
    smallest = {}
    for i, r in roots.items():
        if rows[i][0] is not None:
            smallest[r] = min(smallest.get(r, rows[i][0]), rows[i][0])
    return sorted((repr(rows[i][0]), f"{fps[i]:016x}", repr(smallest.get(roots[i]))) for i in fps)


@pytest.mark.parametrize("cap", [64, 3])
def test_simhash_against_brute_force(spark, store, cap):
    rng = random.Random(4)
    base = " ".join(f"k{rng.randrange(500)}" for _ in range(300))
    texts = family(rng, base, 60, 1) + family(rng, base.replace("k", "m"), 20, 2) + [" ".join(f"u{rng.randrange(9999)}" for _ in range(20)) for _ in range(60)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(500, None), (501, ""), (502, " \t\n"), (503, "One two"), (504, "one TWO"), (505, "É one two three"), (506, "é one two three"), (2, texts[2]), (None, texts[3]), (900, "long " * 20000)]
    rng.shuffle(rows)
    df = spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, fp int")
    got = simhash.near_duplicates(df, store, bucket_cap=cap).collect()
    assert sorted((repr(r["doc_id"]), r["fingerprint"], repr(r["component_id"])) for r in got) == simhash_truth(rows)


def test_simhash_of_nothing(spark, store):
    assert simhash.near_duplicates(spark.createDataFrame([], "doc_id long, text string"), store).count() == 0
    with pytest.raises(ValueError):
        simhash.near_duplicates(spark.createDataFrame([], "doc_id long, text string"), store, distance=1)


def test_thresholds_follow_the_pigeonhole():
    both = np.full((64, 64), 25.0)
    np.fill_diagonal(both, 50.0)
    for n in (100, 10**6, 10**10):
        plan = simhash.allocate(n, both * n / 100, 2)
        rng = random.Random(n)
        for _ in range(300):
            x = rng.getrandbits(64)
            y = x ^ sum(1 << b for b in rng.sample(range(64), 2))
            assert any(sum((x ^ y) >> b & 1 for b in bits) <= t for bits, t in plan)


def vector_truth(rows):
    valid = {}
    for i, (d, v) in enumerate(rows):
        if d is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            x = np.array(v, float)
            valid[d] = x / np.abs(x).max()
            valid[d] /= np.linalg.norm(valid[d])
    ids = sorted(valid)
    links = [(a, b) for a in ids for b in ids if a < b and valid[a] @ valid[b] >= 0.9]
    roots = roots_of([d for d, _ in rows if d is not None], links)
    return sorted((d, sum(d in e for e in links), roots[d], roots[d] == d) for d, _ in rows if d is not None)


@pytest.mark.parametrize(("cell", "window"), [(2048, 512), (16, 32)])
def test_vectors_against_brute_force(spark, store, cell, window):
    rng = np.random.default_rng(3)
    centre = rng.standard_normal(16)
    rows = [(i, [float(x) for x in rng.standard_normal(16)]) for i in range(120)]
    rows += [(1000 + i, [float(x) for x in (centre + rng.standard_normal(16) * 0.2) * 10.0 ** rng.integers(-3, 3)]) for i in range(90)]
    rows += [(2000, None), (2001, []), (2002, [0.0] * 16), (2003, [float("nan")] * 16), (2004, [1.0] * 15 + [None]), (2005, [float("inf")] * 16), (1001, rows[121][1]), (2006, rows[5][1])]
    df = spark.createDataFrame([(d, v, 1) for d, v in rows], "vec_id long, embedding array<double>, root int")
    got = vector_dedup.near_duplicates(df.union(spark.createDataFrame([(None, [1.0] * 16, 1)], df.schema)), store, cell=cell, window=window)
    out = sorted((r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in got.collect() if r["vec_id"] is not None)
    assert out == vector_truth(rows)


def test_vectors_of_nothing_and_of_mixed_lengths(spark, store):
    assert vector_dedup.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>"), store).count() == 0
    mixed = spark.createDataFrame([(1, [1.0]), (2, [1.0, 2.0])], "vec_id long, embedding array<float>")
    with pytest.raises(ValueError, match="length"):
        vector_dedup.near_duplicates(mixed, store)
    assert vector_dedup.passes_needed(10**9, 512, 0.9, 0.99) > vector_dedup.passes_needed(10**5, 512, 0.9, 0.99) >= 2


@pytest.mark.parametrize("window", [512, 24])
def test_vectors_of_several_lengths_against_brute_force(spark, store, window):
    rng = np.random.default_rng(11)
    rows, k = [], 0
    for size, n in ((8, 90), (3, 40), (5, 2), (16, 1), (2, 60), (1, 5)):
        own = [[float(x) for x in rng.standard_normal(size)] for _ in range(n)]
        for v in own:
            rows.append((k := k + 1, v))
            if rng.random() < 0.4:
                rows.append((k := k + 1, [x * 3.0 for x in v] if rng.random() < 0.5 else [x + 0.02 * float(rng.standard_normal()) for x in v]))
    rows += [(5000, None), (5001, []), (5002, [0.0, 0.0]), (5003, [1.0, None])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    truth = []
    for size in {len(v) for _, v in rows if v}:
        truth += [r for r in vector_truth([(d, v) for d, v in rows if v and len(v) == size])]
    truth += [(d, 0, d, True) for d, v in rows if not v]
    got = sorted((r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in vector_dedup.near_duplicates(df, store, window=window, mixed_lengths=True).collect())
    assert got == sorted(truth)


def test_vectors_in_a_dense_cone(spark, store):
    rng = np.random.default_rng(5)
    unit = lambda x: x / np.linalg.norm(x, axis=-1, keepdims=True)
    centre = unit(rng.standard_normal(64))
    cone = unit(np.sqrt(0.75) * centre + 0.5 * unit(rng.standard_normal((1000, 64))))
    vectors = np.concatenate([cone, unit(rng.standard_normal((2000, 64)))])
    other = unit(rng.standard_normal((150, 64)))
    other = unit(other - (other * cone[:150]).sum(1, keepdims=True) * cone[:150])
    vectors = np.concatenate([vectors, 0.905 * cone[:150] + np.sqrt(1 - 0.905**2) * other])
    truth = (vectors @ vectors.T >= 0.9).sum(axis=1) - 1
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    got = {r["vec_id"]: r["n_links"] for r in vector_dedup.near_duplicates(df, store, window=16).collect()}
    assert truth.sum() >= 300 and sum(got[i] for i in range(len(vectors))) >= 0.99 * truth.sum()
