from __future__ import annotations

import random
import re

import duckdb
import numpy as np
import pytest

corpus_pipeline = pytest.importorskip("corpus_pipeline")

from harrow.llm import toxicity  # noqa: E402
from harrow.llm.oracles import LINE_DEDUP, SEED_OVERLAPS  # noqa: E402
from tests.llm.test_near_copies import roots_of  # noqa: E402
from tests.llm.test_text_operators import labelled  # noqa: E402
from tests.llm.test_tokens import check_packing, expected_tokens  # noqa: E402


def make_tables(spark, folder):
    rng = random.Random(12)
    rows = labelled(500, seed=3)
    item = " ".join(f"bench{rng.randrange(999)}" for _ in range(30))
    docs = [(d, t.replace(" ", "\n", 1), lang, "s", len(t)) for d, t, lang, _ in rows]
    clean = [r for r in docs if not re.search("zorg", r[1])]
    docs += [(1000 + i, r[1], r[2], "s", r[4]) for i, r in enumerate(clean[:20])]  # exact copies
    docs += [(1100 + i, f"{r[1]} extra{i} {item}", r[2], "s", 0) for i, r in enumerate(clean[20:30])]  # leaks
    docs += [(1300 + i, f"{r[1]} more{i}", r[2], "s", r[4]) for i, r in enumerate(clean[40:60])]  # edited copies
    docs += [(1200, None, "en", "s", None), (1201, "", None, None, 0), (1202, "word " * 9000, "en", "s", 45000)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(d, 1, tox) for d, _, _, tox in rows], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return docs


def test_pipeline_against_brute_force(spark, tmp_path):
    folder = f"file://{tmp_path}"
    docs = make_tables(spark, folder)
    out = corpus_pipeline.run(spark, folder).collect()
    # toxicity: the same classifier, one text at a time
    model = toxicity.fit(spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet"))
    kept = [(d, t) for d, t, lang, _, _ in docs if toxicity.score_texts(model, [t])[0] < model.thresholds.get(lang, model.default)]
    assert 300 < len(kept) < len(docs)
    con = duckdb.connect()
    con.register("documents", spark.createDataFrame([r for r in kept if r[1] is not None], "doc_id long, text string").toPandas())
    lines = {d: t for d, t in con.sql(f"SELECT doc_id, text FROM ({LINE_DEDUP})").fetchall()} | {d: None for d, t in kept if t is None}
    sets = {d: shingles("".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")) for d, t in lines.items()}
    roots = roots_of(sets, [(a, b) for a in sets for b in sets if a < b and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])])
    first = {d for d in sets if roots[d] == d}
    edited = {d for d in sets if 1300 <= d < 1400}
    assert edited and not edited & first
    con.register("documents", spark.createDataFrame([(d, lines[d] or "") for d in sorted(first)], "doc_id long, text string").toPandas())
    con.register("benchmark", spark.read.parquet(f"{folder}/benchmark.parquet").toPandas())
    leaks = {r[0] for r in con.sql(f"SELECT doc_id FROM ({SEED_OVERLAPS})").fetchall()}
    assert leaks
    final = [(d, lines[d]) for d in sorted(first - leaks)]
    pieces = [(d, k, len(ids[s : s + 2048])) for d, ids in expected_tokens("word_bpe_49k.json", final) for k, s in enumerate(range(0, len(ids), 2048))]
    assert sorted((r["doc_id"], r["piece"], r["length"]) for r in out) == sorted(pieces)
    used = check_packing(out, 2048)
    assert used <= -(-sum(p[2] for p in pieces) // 2048) + 1


def test_stages_keep_the_columns(spark, tmp_path):
    folder = f"file://{tmp_path}"
    make_tables(spark, folder)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    empty = docs.limit(0)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, empty, folder).schema.names == docs.columns, name
        assert stage(spark, empty, folder).count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, empty, folder).count() == 0
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line dedup", "simhash near-dedup", "benchmark decontamination", "best-fit packing"]
    assert np.isfinite(docs.count())


def shingles(text):
    w = text.split()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} or {tuple(w)}


def test_near_copies_of_edited_texts(spark):
    rng = random.Random(9)
    rows, base = [], []
    for k in range(60):
        words = [f"q{rng.randrange(10**6)}" for _ in range(200)]
        base.append(10 * k)
        rows.append((10 * k, " ".join(words)))
        for copy, edits in enumerate((1, 3, 4, 12)):
            other = list(words)
            for i in rng.sample(range(200), edits):
                other[i] = f"z{rng.randrange(10**6)}"
            rows.append((10 * k + copy + 1, " ".join(other)))
    hot = [f"h{i}" for i in range(150)]
    rows += [(5000 + i, " ".join([*hot[:i], f"x{i}", *hot[i + 1 :]])) for i in range(150)]  # one family
    rows += [(6000, None), (6001, ""), (6002, " \n")]
    docs = spark.createDataFrame([(d, t, "en", "s", 0) for d, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = {r["doc_id"] for r in corpus_pipeline.drop_near_copies(spark, docs, "").collect()}
    sets = {d: shingles(t or "") for d, t in rows}
    links = [(a, b) for a in sets for b in sets if a < b and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    roots = roots_of(sets, links)
    assert got == {d for d in sets if roots[d] == d}
    assert {b + 1 for b in base}.isdisjoint(got) and {b + 4 for b in base} <= got


def test_near_copies_of_repeated_ids(spark):
    copied, own = " ".join(f"a{i}" for i in range(40)), " ".join(f"b{i}" for i in range(40))
    rows = [(1, copied, "en"), (2, copied, "en"), (2, own, "en"), (2, own, "de"), (2, own, "en"), (None, own, "en"), (1, " ".join(f"c{i}" for i in range(40)), "en")]
    docs = spark.createDataFrame([(d, t, lang, "s", 0) for d, t, lang in rows], "doc_id long, text string, lang string, source string, n_chars long")
    shown = [sorted((repr(r["doc_id"]), r["text"][0], r["lang"]) for r in corpus_pipeline.drop_near_copies(spark, docs.repartition(k), "").collect()) for k in (1, 3)]
    assert shown[0] == shown[1] and [r[:2] for r in shown[0]] == [("1", "a"), ("1", "c"), ("2", "b"), ("None", "b")]


def test_near_copies_probe_simhash(spark, store):
    from harrow.llm import near_copies, simhash

    rng = random.Random(5)
    base = [f"s{rng.randrange(10**6)}" for _ in range(400)]
    texts = [" ".join([*base[:i], f"x{i}", *base[i + 1 :]]) for i in range(60)] + [" ".join(f"o{rng.randrange(10**6)}" for _ in range(30)) for _ in range(20)] + ["", None]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    sketches = store.save(near_copies._sketches(docs, 5), "sketches")
    fps = {r["node"]: r["fp"] & (2**64 - 1) for r in sketches.collect()}
    assert set(fps.values()) == {simhash.fingerprint_of(near_copies.shingle_set(t)) for t in texts}
    links = [(a, b) for a in fps for b in fps if a > b and (fps[a] ^ fps[b]).bit_count() <= 2]
    got = [(r["a"], r["b"]) for r in near_copies._fingerprint_pairs(sketches, store).collect()]
    assert len(links) > 20 and set(got) <= set(links) and roots_of(fps, got) == roots_of(fps, links)
