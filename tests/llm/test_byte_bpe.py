from __future__ import annotations

import hashlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from harrow.llm import byte_bpe
from harrow.llm.queries import tokenizer

PATH, PATTERN = tokenizer("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
BPE = byte_bpe.ByteBpe(PATH, PATTERN, limit=300)
PLAIN = tiktoken.Encoding("plain", pat_str=PATTERN, mergeable_ranks=byte_bpe.read_ranks(PATH), special_tokens={})
SPACES = "\t\n\x0b\x0c\r \x85\xa0       　"
ODD = [
    "", " ", "\n", " a", "a ", "a\n", "\na", "a  b", "a \n b", "naïve café́ x", "don't we'll 'sup x's '", "<|endoftext|> a <|endoftext|>b", "a\x1cb c\x85d", "x\x00y", "a\r\nb",
    "12 5,6 ½ a.b\nC", "A, B.\nc! D\n", "été,où. ß;x", "😀😀 a😀", "漢字かな交じり文。", "𝒳 𝒴", "word " * 3000, "a" * 5000, "a,b.c!d?e;f:g", SPACES, "a" + " ".join(SPACES) + "b", "​ a​", " 's 't", "á.b", "ǅ,x", "É:", "x:'s",
]


def test_pieces_are_cut_where_the_pattern_cuts():
    for text in ODD:
        pieces = byte_bpe._PIECE.findall(text)
        assert "".join(pieces) == text
        assert [i for p in pieces for i in PLAIN.encode_ordinary(p)] == PLAIN.encode_ordinary(text)


@pytest.mark.parametrize("block,pieces", [(1 << 20, 1 << 17), (10, 7)])
def test_texts_encode_like_the_rank_library(monkeypatch, block, pieces):
    monkeypatch.setattr(byte_bpe, "BLOCK", block)
    monkeypatch.setattr(byte_bpe, "PIECES", pieces)
    for texts in (ODD, ODD[::-1], ["x"] * 3, []):
        assert [x.tolist() for x in BPE.encode(texts)] == [PLAIN.encode_ordinary(t) for t in texts]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.sampled_from(list("aB é.,!?:;\n\t'12|<> ßİ́ s")), st.sampled_from(list(SPACES)), st.characters(codec="utf-8")), max_size=30), max_size=4))
def test_any_text(texts):
    ids = BPE.encode(texts)
    assert [x.tolist() for x in ids] == [PLAIN.encode_ordinary(t) for t in texts]
    assert [BPE.decode(x) for x in ids] == [t.encode() for t in texts]
    for text, x in zip(texts, ids):
        starts, ends = BPE.offsets(text, x)
        assert list(zip(starts.tolist(), ends.tolist())) == BPE.tokenizer.encode(text, add_special_tokens=False).offsets


def test_every_byte_has_a_character_of_its_own():
    alphabet = byte_bpe.byte_characters()
    assert len(set(alphabet)) == 256 and all(len(c) == 1 and not c.isspace() for c in alphabet)
    assert sorted(BPE.spelled[i] for i in range(256)) == [bytes([b]) for b in range(256)]


def test_ranks_without_merges_are_refused():
    with pytest.raises(ValueError):
        byte_bpe.merges_of({b"a": 0, b"b": 1, b"c": 2, b"abc": 3})


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=12), st.integers(0, 40), st.integers(0, 40))
def test_split_characters(text, a, b):
    data = text.encode()
    a, b = sorted((min(a, len(data)), min(b, len(data))))
    head, tail = byte_bpe.split_characters(data[a:b])
    starts = {len(text[:i].encode()) for i in range(len(text) + 1)}
    if any(a <= s <= b for s in starts):  # a part inside one character has no place to tell
        first = min(s for s in starts if s >= a)
        last = max(s for s in starts if s <= b)
        assert (head, tail) == (first - a, b - last)


def test_frames_round_trip(spark):
    rows = [(i, t, 7) for i, t in enumerate(ODD)] + [(3, None, 8), (None, "no id", 9), (3, None, 8)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids int").repartition(3)
    found = byte_bpe.encode(df, PATH, PATTERN, offsets=True)
    assert found.columns == ["doc_id", "text", "ids", "starts", "ends"]
    got = found.collect()
    assert len(got) == len(rows)
    for r in got:
        assert r["ids"] == PLAIN.encode_ordinary(r["text"] or "") and len(r["starts"]) == len(r["ends"]) == len(r["ids"])
    back = byte_bpe.decode(found.withColumnRenamed("text", "was").drop("starts", "ends"), PATH, PATTERN).collect()
    assert all(r["text"] == (r["was"] or "") and bytes(r["decoded"]) == (r["was"] or "").encode() and r["first_split"] == r["last_split"] == 0 for r in back)


def test_parts_inside_characters(spark):
    ids = PLAIN.encode_ordinary("a😀漢字b")
    parts = [ids[i : i + 1] for i in range(len(ids))]
    df = spark.createDataFrame([(i, p) for i, p in enumerate(parts)] + [(99, None)], "n int, ids array<int>")
    got = {r["n"]: r for r in byte_bpe.decode(df, PATH, PATTERN).collect()}
    assert b"".join(bytes(got[i]["decoded"]) for i in range(len(parts))).decode() == "a😀漢字b"
    assert any(r["first_split"] or r["last_split"] for r in got.values()) and got[99]["text"] == ""


def test_digests(spark):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(None, "x"), (5, None), (5, None)]
    df = spark.createDataFrame([(d, t, "n", "s") for d, t in rows], "doc_id long, text string, n_tokens string, ids_sha256 string").repartition(4)
    got = sorted((tuple(r) for r in byte_bpe.token_digests(df, PATH, PATTERN).collect()), key=str)
    sha = lambda b: hashlib.sha256(b).hexdigest()
    want = [(d, len(PLAIN.encode_ordinary(t or "")), sha(" ".join(map(str, PLAIN.encode_ordinary(t or ""))).encode()), sha((t or "").encode())) for d, t in rows]
    assert got == sorted(want, key=str)
    assert byte_bpe.token_digests(df.limit(0), PATH, PATTERN).count() == 0
    assert byte_bpe.encode(df.limit(0), PATH, PATTERN, offsets=True).count() == 0


def test_registered_query_against_the_rank_library(spark):
    import __spark_entry__

    sf = "/root/testdata/sf0.001"
    docs = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = __spark_entry__.queries()["op11_byte_bpe"](spark, sf).collect()
    assert len(got) == len(docs)
    for r in got:
        ids = PLAIN.encode_ordinary(docs[r["doc_id"]])
        assert r["n_tokens"] == len(ids) and r["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(docs[r["doc_id"]].encode()).hexdigest()
    assert np.dtype("<u2") == BPE.dtype
