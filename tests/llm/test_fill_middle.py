from __future__ import annotations

import hashlib
import re

import pyarrow as pa
import pytest

from harrow.llm import fill_middle

ODD = ["", " ", "a", " a", "a ", "a b", "a  b\n\nc ", "x <P> y", "x <S>y", "<M>", "< P>", "<p>", "é́ 😀\t漢字 ü", "a\x00b c\x85d\xa0e f", "one", "word " * 4000, "\x0b\x0c\r\n", "'; DROP", "%s {x} \\x20"]


def brute(doc_id, text, seed, rate, spm):
    text = text or ""
    units = re.findall(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+", text)
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    n = len(units)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return (doc_id, n, "plain", None, None, text, text)
    form = "spm" if h[3] % 100 < spm else "psm"
    output = f"<S>{suffix}<P>{prefix}<M>{middle}" if form == "spm" else f"<P>{prefix}<S>{suffix}<M>{middle}"
    return (doc_id, n, form, len(prefix), len(middle), output, text)


@pytest.mark.parametrize("seed,rate,spm", [(42, 50, 80), (1, 100, 50), (2, 0, 50), (3, 100, 0), (3, 100, 100)])
def test_against_brute_force(spark, seed, rate, spm):
    rows = [(i * 37 + k, t) for k in range(6) for i, t in enumerate(ODD)] + [(None, "a b c"), (None, None), (4, None), (-5, "x y z"), (4, "twice"), (4, "twice")]
    df = spark.createDataFrame([(d, t, "n", 1) for d, t in rows], "doc_id long, text string, n string, form int").repartition(3)
    got = fill_middle.transform(df, fill_middle.Settings(seed, rate, spm)).collect()
    want = [brute(d, t, seed, rate, spm) for d, t in rows]
    assert sorted(((*r[:7],) for r in got), key=repr) == sorted(want, key=repr)
    for r in got:
        assert r["output_sha256"] == hashlib.sha256(r["output"].encode()).hexdigest() and r["restored_sha256"] == hashlib.sha256(r["restored"].encode()).hexdigest()
    assert rate != 100 or {r["form"] for r in got} >= ({"spm"} if spm else set()) | ({"psm"} if spm < 100 else set())


def test_long_text_and_empty_table(spark):
    text = "wörd  of\n" * 300_000
    df = spark.createDataFrame([(d, text) for d in range(8)], "doc_id long, text string")
    got = fill_middle.transform(df, fill_middle.Settings(rate=100)).collect()
    assert sorted(((*r[:7],) for r in got), key=repr) == sorted((brute(d, text, 42, 100, 80) for d in range(8)), key=repr)
    assert fill_middle.transform(df.limit(0)).collect() == []


def test_batches_are_sliced_by_bytes():
    texts = ["a" * n for n in (3, 4, 50, 0, 1, 1)] + [None, "b" * 9]
    batch = pa.RecordBatch.from_arrays([pa.array(range(8)), pa.array(texts)], names=["doc_id", "text"])
    parts = [[len(t or "") for t in p.column(1).to_pylist()] for p in fill_middle.slices(batch, 1, 10)]
    assert parts == [[3, 4], [50], [0, 1, 1, 0], [9]] or parts == [[3, 4], [50, 0], [1, 1, 0], [9]]
    assert sum(parts, []) == [3, 4, 50, 0, 1, 1, 0, 9]
    assert list(fill_middle.slices(batch.slice(0, 0), 1)) == []
