from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest

from harrow.llm import importance
from harrow.llm.importance import Settings

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
ODD = ["", " ", "...", "A b-C d_e", "É é ÉCOLE 漢字  x", "x\x00y\x7fz", "9a 10", "a" * 9000, "tie " * 30, "tie " * 30]


def features(text, low, high):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return words, [" ".join(words[i : i + n]) for n in range(low, high + 1) for i in range(len(words) - n + 1)]


def brute(docs, target, s):
    bucket = lambda f: zlib.crc32(f.encode()) % s.buckets
    raw = Counter(bucket(f) for _, t in docs for f in features(t, s.low, s.high)[1])
    wanted = Counter(bucket(f) for t in target for f in features(t, s.low, s.high)[1])
    all_raw, all_wanted = sum(raw.values()), sum(wanted.values())
    gain = lambda b: math.floor(1000 * math.log((wanted[b] + 1) * (all_raw + s.buckets) / ((raw[b] + 1) * (all_wanted + s.buckets))))
    rows = []
    for d, t in docs:
        words, found = features(t, s.low, s.high)
        weight = math.floor(sum(gain(bucket(f)) for f in found) / len(found)) if found else 0
        h = int(hashlib.sha256(f"{s.seed}:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        rows.append((d, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(words) >= s.least_words))
    may = sorted((r for r in rows if r[4]), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1], r[2]))
    drawn = s.percent * len(may) // 100
    ranks = [(*r[:4], k if k <= drawn else None) for k, r in enumerate(may, 1)]
    return ranks + [(*r[:4], None) for r in rows if not r[4]]


def same(got, want):
    key = lambda r: tuple((x is None, x or 0) for x in r)
    assert sorted((tuple(r) for r in got), key=key) == sorted(want, key=key)


@pytest.mark.parametrize("s", [Settings(), Settings(1, 3, 97, 5, 40, 7, nodes=50), Settings(2, 2, 1000, 1, 100, 8), Settings(1, 2, 64, 3, 0, 9)])
def test_against_brute_force(spark, store, s, monkeypatch):
    monkeypatch.setattr(importance, "BLOCK", 40)
    rng = random.Random(s.seed)
    words = [f"w{i}" for i in range(60)] + ["Zoë", "ÀB", "x9"]
    docs = [(i, " ".join(rng.choices(words, k=rng.randint(0, 60)))) for i in range(150)] + [(500 + i, t) for i, t in enumerate(ODD)]
    docs += [(3, "tie " * 30), (3, "tie " * 30), (None, "tie " * 30), (7, None), (None, None)]
    target = [" ".join(rng.choices(words[:9], k=20)) for _ in range(12)] + [None, ""]
    df = spark.createDataFrame([(d, t, "w", 1) for d, t in docs], "doc_id long, text string, weight string, rank int").repartition(5)
    other = spark.createDataFrame([(t, 1) for t in target], "text string, doc_id int").repartition(2)
    same(importance.resample(df, other, store, s).collect(), brute(docs, target, s))


def test_blocks_hold_all_words():
    for text in [t.encode() for t in ODD] + [b"ab " * 50, b"x" * 30 + b" y", None]:
        for block in (1, 7, 1 << 20):
            assert [w for b in importance.word_blocks(text, block) for w in b] == [w.encode() for w in features((text or b"").decode(), 1, 1)[0]]


def test_empty_tables(spark, store):
    empty = spark.createDataFrame([], "doc_id long, text string")
    some = spark.createDataFrame([(i, "a b " * 20) for i in range(20)], "doc_id long, text string")
    assert importance.resample(empty, some, store).collect() == []
    same(importance.resample(some, empty, store).collect(), brute([(i, "a b " * 20) for i in range(20)], [], Settings()))


def test_equal_scores_go_to_the_smaller_id(spark, store):
    docs = [(i, "a b " * 20) for i in range(40)]
    rows = spark.createDataFrame([(5, 1), (3, 1), (9, 2), (3, 1), (1, 0)], "doc_id long, score long").repartition(3)
    got = importance.ranked(rows, [rows["score"].desc(), rows["doc_id"].asc_nulls_last()], store).orderBy("rank").collect()
    assert [(r["doc_id"], r["rank"]) for r in got] == [(9, 1), (3, 2), (3, 3), (5, 4), (1, 5)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    same(importance.resample(df, df, store, Settings(percent=50)).collect(), brute(docs, [t for _, t in docs], Settings(percent=50)))


@pytest.mark.parametrize("name", ["op12_fill_middle", "op13_importance"])
def test_registered_queries_match_their_sql(spark, name):
    import duckdb

    import __spark_entry__ as e

    con = duckdb.connect()
    for table in ("documents", "benchmark"):
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '/root/testdata/sf0.001/{table}.parquet'")
    df = e.queries()[name](spark, "/root/testdata/sf0.001")
    columns = sorted(df.columns)
    expected = con.sql(f"SELECT {', '.join(columns)} FROM ({e.oracle_sql()[name]})").fetchall()
    assert sorted(map(tuple, df.select(*columns).collect()), key=repr) == sorted(expected, key=repr) and len(expected) > 100
