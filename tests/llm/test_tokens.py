from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from harrow.llm import packing, token_files
from harrow.llm.encoding import WordEncoder
from harrow.llm.queries import tokenizer

ODD = ["", " ", "\n", " a", "a ", "a\n", "\na", "a  b", "a \n b", "a\tb c", "naïve café́ x", "don't we'll 'sup x", "x | y || z", "<|endoftext|> a <|endoftext|>b", "a\x1cb c\x85d", "ΑΣ Σ ΟΔΟΣ İx", "a\r\nb", "12 5,6 ½ a.b\nC", "A, B.\nc! D\n", "word " * 5000]
FILES = ("byte_bpe_50k.json", "word_bpe_49k.json")


@pytest.mark.parametrize("name", FILES)
def test_words_encode_like_whole_texts(name):
    encoder = WordEncoder(tokenizer(name), limit=40)
    for texts in (ODD, ODD[::-1], ["x"] * 3, []):
        assert [x.tolist() for x in encoder.encode(texts)] == [encoder.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


ENCODERS = {n: WordEncoder(tokenizer(n)) for n in FILES}


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from(list("aB é.,!?\n\t'12|<> ßİ́ ")), max_size=30), max_size=4))
def test_any_text_encodes_like_the_library(texts):
    for encoder in ENCODERS.values():
        assert [x.tolist() for x in encoder.encode(texts)] == [encoder.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


def expected_tokens(name, rows, end=0):
    t = ENCODERS[name].tokenizer
    return [(d, t.encode(x or "", add_special_tokens=False).ids + [end]) for d, x in rows]


def test_files_round_trip(spark, store):
    rows = [(9, None), (3, ""), (5, "a b c " * 900), (7, "x"), (3, "twice"), (None, "no id"), (2, "é\n" * 40)]
    df = spark.createDataFrame([(d, t, "en", i) for i, (d, t) in enumerate(rows)], "doc_id long, text string, shard string, local int").repartition(3)
    folder = store.folder("files")
    index = token_files.write_token_files(df, folder, store, tokenizer(FILES[0]), seq_len=64)
    got = sorted(token_files.read_token_digests(index, folder).collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in got] == [None, 2, 3, 3, 5, 7, 9]
    sizes, by_id = 0, defaultdict(list)
    for d, ids in expected_tokens(FILES[0], rows):
        by_id[d].append((len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    for r in got:
        assert r["start"] == sizes and (r["n_tokens"], r["ids_crc32"]) in by_id[r["doc_id"]]
        sizes += r["n_tokens"]
    shards = sorted(p for p in __import__("pathlib").Path(folder.removeprefix("file:")).glob("shard-*.arrow"))
    real = 0
    for p in shards:
        file = pa.ipc.open_file(pa.memory_map(str(p)))
        assert file.schema.field("ids").type == pa.list_(pa.uint16(), 64) and file.schema.field("mask").type == pa.list_(pa.bool_(), 64)
        real += sum(np.count_nonzero(b.column(1).flatten().to_numpy(zero_copy_only=False)) for b in (file.get_batch(i) for i in range(file.num_record_batches)))
    assert real == sizes


def test_empty_token_table(spark, store):
    folder = store.folder("files")
    index = token_files.write_token_files(spark.createDataFrame([], "doc_id long, text string"), folder, store, tokenizer(FILES[0]))
    assert token_files.read_token_digests(index, folder).count() == 0


def check_packing(rows, capacity):
    by_sequence = defaultdict(list)
    for r in rows:
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
    for pieces in by_sequence.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by_sequence)


def test_packing(spark, store):
    rows = [(i, "a b " * (i * 7 % 40)) for i in range(120)] + [(7, "same"), (7, "same"), (None, None), (200, "long " * 700)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, length int")
    out = packing.pack(packing.cut_pieces(df, tokenizer(FILES[1]), capacity=100), store, capacity=100).collect()
    pieces = []
    for d, ids in expected_tokens(FILES[1], rows):
        pieces += [(d, k, s, len(ids[s : s + 100]), zlib.crc32(np.array(ids[s : s + 100], "<u4").tobytes())) for k, s in enumerate(range(0, len(ids), 100))]
    key = lambda x: tuple(-1 if v is None else v for v in x)
    assert sorted(((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in out), key=key) == sorted(pieces, key=key)
    used = check_packing(out, 100)
    total = sum(p[3] for p in pieces)
    assert -(-total // 100) <= used <= -(-total // 100) + 2
    assert packing.pack(packing.cut_pieces(df.limit(0), tokenizer(FILES[1])), store).count() == 0


def test_the_plan_of_packed_rows_does_not_grow_with_the_rounds(spark, store):
    rng = random.Random(8)
    rows = [(i, 0, 0, rng.choice([900, 700, 400, 300, 150, 90, 40, 20, 3]), i) for i in range(400)]
    out = packing.pack(spark.createDataFrame(rows, packing.PIECES), store)
    assert out.count() == 400
    assert out._jdf.queryExecution().optimizedPlan().toString().count("Relation") <= 3


def test_a_hot_length(spark, store):
    df = spark.range(5000).selectExpr("id as doc_id", "0 as piece", "0L as start", "700L as length", "1L as ids_crc32")
    out = packing.pack(df, store).collect()
    assert len(out) == 5000 and check_packing(out, 2048) == 2500


def test_matching_is_best_fit_decreasing():
    rng = random.Random(5)
    for _ in range(30):
        capacity = rng.choice([10, 37, 100])
        items = [rng.randint(1, capacity) for _ in range(rng.randint(0, 200))]
        runs = {n: items.count(n) for n in set(items)}
        segments = packing.match_runs(runs, capacity)
        used, held = set(), defaultdict(int)
        for length, low, high, first, offset in segments:
            for k in range(high - low + 1):
                used.add(first + k)
                held[first + k] += length
                assert held[first + k] <= capacity
        gaps: list[int] = []
        for n in sorted(items, reverse=True):
            fit = min((g for g in gaps if g >= n), default=None)
            if fit is not None:
                gaps.remove(fit)
            gaps.append((capacity if fit is None else fit) - n)
        assert len(used) == len(gaps) and sum(held.values()) == sum(items)
    with pytest.raises(ZeroDivisionError):
        packing.match_runs({11: 1}, 10)


def test_ranges_match_nearest_first_and_in_bulk():
    # range 0 leaves three pieces of at most 10, range 1 two of at most 25, range 2 has three gaps of at least 30
    assert packing.match_ranges([(0, 0, 0, 0, 3, 0, 10), (1, 0, 0, 0, 2, 0, 25), (2, 3, 0, 30, 0, 0, 0)]) == [(1, 0, 1, 2, 0, 1), (0, 0, 2, 2, 2, 3)]
    # a lower gap never takes a piece of its own or a higher range
    assert packing.match_ranges([(0, 2, 0, 5, 4, 2, 7)]) == []


@pytest.mark.parametrize("seed", range(3))
def test_supersteps_come_near_best_fit_decreasing(spark, store, seed):
    rng = np.random.default_rng(seed)
    lengths = [rng.integers(1, 101, 400), np.concatenate([np.ones(900, int), rng.integers(1, 60, 200)]), rng.choice([1, 7, 33, 34, 50, 51, 100], 500)][seed]
    df = spark.createDataFrame([(int(i), 0, 0, int(n), 0) for i, n in enumerate(lengths)], packing.PIECES)
    out = packing.pack(df, store, capacity=100).collect()
    assert sorted((r["doc_id"], r["length"]) for r in out) == list(enumerate(map(int, lengths)))
    used = check_packing(out, 100)
    best = max(first + high - low for _, low, high, first, _ in packing.match_runs(Counter(map(int, lengths)), 100)) + 1
    assert used <= best + max(2, best // 50)


@pytest.mark.parametrize("seed", range(2))
def test_packing_in_many_ranges_and_partitions(spark, store, monkeypatch, seed):
    """Ranges of 40 rows, more of one length than a range holds, and partitions that stay small."""
    monkeypatch.setattr(packing, "RANGE_ROWS", 40)
    rng = np.random.default_rng(seed)
    lengths = np.concatenate([rng.integers(1, 101, 500), np.full(300, 7), np.full(90, 51)])
    df = spark.createDataFrame([(int(i), 0, 0, int(n), 0) for i, n in enumerate(lengths)], packing.PIECES).repartition(40)
    kept = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "23")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = packing.pack(df, store, capacity=100).collect()
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)
    assert sorted((r["doc_id"], r["length"]) for r in out) == list(enumerate(map(int, lengths)))
    best = max(first + high - low for _, low, high, first, _ in packing.match_runs(Counter(map(int, lengths)), 100)) + 1
    assert check_packing(out, 100) <= best * 1.02 + 2
