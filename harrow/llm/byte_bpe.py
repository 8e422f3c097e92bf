"""Byte-level BPE encoding and decoding with the ``tokenizers`` library over Arrow batches (operator 11).

A file of ranks (one base64 token and its rank a line) becomes a tokenizer of the library: tokens
are spelled in the byte alphabet, and the merges follow from the ranks.  A text is cut where no match of the
pattern can cross, so pieces repeat and each worker keeps the ids of those that it has met.
"""

from __future__ import annotations

import base64
import hashlib
import os
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, DataType, IntegerType, StringType, StructField, StructType

#: The characters that the pattern takes as white space.
SPACES = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_LETTERS = r"A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f"
# a match never goes on from another character to white space, nor from a letter to one of these marks
_PIECE = re.compile(f"[{SPACES}]*(?:[{_LETTERS}]+(?=[.,!?;:])|[^{SPACES}]+)|[{SPACES}]+")
_BULK = re.compile(f" ?[^{SPACES}]+")
KNOWN_PIECES = 500_000
BLOCK = 1 << 20
PIECES = 1 << 17


def byte_characters() -> list[str]:
    """The byte alphabet: printable bytes of Latin-1 stand for themselves, the others in order for U+0100 and on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = iter(range(0x100, 0x200))
    return [chr(b) if b in printable else chr(next(others)) for b in range(256)]


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


def merges_of(ranks: dict[bytes, int]) -> list[tuple[bytes, bytes]]:
    """The two parts that each token is merged from, in order: what earlier merges leave of it.

    Raises an error for a token that earlier ones don't leave in two parts, since no list of merges makes it.
    """
    found = []
    for token in sorted((t for t in ranks if len(t) > 1), key=ranks.__getitem__):
        parts = [token[i : i + 1] for i in range(len(token))]
        while len(parts) > 2:
            pairs = [ranks.get(a + b, len(ranks)) for a, b in zip(parts, parts[1:])]
            at = pairs.index(min(pairs))
            if pairs[at] >= ranks[token]:
                raise ValueError(f"token of rank {ranks[token]} isn't a merge of two earlier tokens")
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        found.append((parts[0], parts[1]))
    return found


def rank_tokenizer(path: str, pattern: str):
    """A tokenizer of the library with the ids of a file of ranks and no special tokens."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Regex, Tokenizer, decoders, models, pre_tokenizers

    ranks, alphabet = read_ranks(path), byte_characters()
    spelled = {token: "".join(map(alphabet.__getitem__, token)) for token in ranks}
    merges = [(spelled[a], spelled[b]) for a, b in merges_of(ranks)]
    # a match that is a token as a whole takes it without merging
    made = Tokenizer(models.BPE(vocab={spelled[t]: r for t, r in ranks.items()}, merges=merges, ignore_merges=True))
    made.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.Split(Regex(pattern), "isolated"), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
    made.decoder = decoders.ByteLevel()
    return made


class ByteBpe:
    """Ids of texts, their places in the text, and bytes of ids."""

    def __init__(self, path: str, pattern: str, limit: int = KNOWN_PIECES):
        self.tokenizer = rank_tokenizer(path, pattern)
        back = {c: b for b, c in enumerate(byte_characters())}
        vocabulary = self.tokenizer.get_vocab()
        self.spelled: list[bytes] = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            self.spelled[i] = bytes(map(back.__getitem__, token))
        self.sizes = np.array([len(t) for t in self.spelled], np.int64)
        self.decimals = [str(i) for i in range(len(self.spelled))]
        self.dtype = np.dtype("<u2") if len(self.spelled) <= 1 << 16 else np.dtype("<u4")
        self.limit = limit
        self.known: dict[str, bytes] = {}
        line_end = self.tokenizer.encode("\n", add_special_tokens=False).ids
        self.line_end = line_end[0] if len(line_end) == 1 else None

    def _each(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, self.dtype) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, pieces: set[str]) -> None:
        fresh = pieces.difference(self.known)
        if len(self.known) + len(fresh) > self.limit:
            self.known.clear()
            fresh = pieces
        # a line end between pieces is a match of its own, so many are one text
        many = [p for p in fresh if _BULK.fullmatch(p)] if self.line_end is not None else []
        for at in range(0, len(many), 4096):
            block = many[at : at + 4096]
            ids = self._each(["\n".join(block)])[0]
            ends = np.flatnonzero(ids == self.line_end)
            if len(ends) == len(block) - 1:
                self.known.update((p, ids[a:b].tobytes()) for p, a, b in zip(block, [0, *(ends + 1)], [*ends, len(ids)]))
        rest = [p for p in fresh if p not in self.known]
        self.known.update((p, x.tobytes()) for p, x in zip(rest, self._each(rest)))

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text.  Texts are read in blocks of pieces, so that the pieces of a very long one aren't held at once."""
        found: list[list[bytes]] = [[] for _ in texts]
        held: list[tuple[int, list[str]]] = []
        size = 0
        for n, text in enumerate(texts):
            matches = _PIECE.finditer(text) if len(text) > BLOCK else None
            while True:
                pieces = _PIECE.findall(text) if matches is None else [m[0] for m in islice(matches, PIECES)]
                held.append((n, pieces))
                size += len(pieces)
                if size > PIECES:
                    self._add(held, found)
                    held, size = [], 0
                if matches is None or not pieces:
                    break
        self._add(held, found)
        return [np.frombuffer(b"".join(parts), self.dtype) for parts in found]

    def _add(self, held: list[tuple[int, list[str]]], found: list[list[bytes]]) -> None:
        self._learn(set().union(*[pieces for _, pieces in held]))
        for n, pieces in held:
            found[n].append(b"".join(map(self.known.__getitem__, pieces)))

    def offsets(self, text: str, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where each token begins and ends in ``text``, in characters; a token with part of a character covers it whole."""
        data = np.frombuffer(text.encode(), np.uint8)
        character = np.cumsum((data & 0xC0) != 0x80) - 1  # of each byte
        ends = np.cumsum(self.sizes[ids])
        return character[ends - self.sizes[ids]], character[ends - 1] + 1

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.spelled.__getitem__, ids.tolist()))


@lru_cache(maxsize=2)
def byte_bpe(path: str, pattern: str, limit: int = KNOWN_PIECES) -> ByteBpe:
    """The encoder of this worker process, which later tasks find warm."""
    return ByteBpe(path, pattern, limit)


def split_characters(data: bytes) -> tuple[int, int]:
    """How many bytes at the start end a character that began before, and how many at the end begin one that isn't complete."""
    head = 0
    while head < min(3, len(data)) and data[head] & 0xC0 == 0x80:
        head += 1
    for tail in range(1, min(4, len(data) - head + 1)):
        lead = data[-tail]
        if lead & 0xC0 != 0x80:
            wanted = 4 if lead >= 0xF0 else 3 if lead >= 0xE0 else 2 if lead >= 0xC0 else 1
            return head, tail if wanted > tail else 0
    return head, 0


def _with_fields(df: DataFrame, added: dict[str, DataType]) -> StructType:
    return StructType([*df.schema.fields, *[StructField(name, kind) for name, kind in added.items()]])


def encode(docs: DataFrame, path: str, pattern: str, text: str = "text", offsets: bool = False) -> DataFrame:
    """``docs`` with ``ids array<int>``, and with ``offsets`` also ``starts`` and ``ends`` (characters) of each token.

    A null text is encoded as an empty one, which has no ids; every other column and every row, repeated or not,
    stays as it is.  A column of the name ``ids``, ``starts`` or ``ends`` is replaced.  An empty table gives an
    empty one.  Very long texts are encoded in blocks of pieces.
    """
    added = ["ids", "starts", "ends"] if offsets else ["ids"]
    kept = docs.drop(*added)
    if text not in kept.columns:
        raise ValueError(f"no column '{text}'")
    at = kept.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = byte_bpe(path, pattern)
        for batch in batches:
            texts = [t or "" for t in batch.column(at).to_pylist()]
            ids = bpe.encode(texts)
            lists = [ids]
            if offsets:
                lists += zip(*(bpe.offsets(t, i) for t, i in zip(texts, ids))) if texts else [[], []]
            columns = [pa.array([x.astype("<i4") for x in values], pa.list_(pa.int32())) for values in lists]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], names=[*batch.schema.names, *added])

    return kept.mapInArrow(run, _with_fields(kept, dict.fromkeys(added, ArrayType(IntegerType()))))


def decode(tokens: DataFrame, path: str, pattern: str, ids: str = "ids") -> DataFrame:
    """``tokens`` with the ``decoded`` bytes of their ids, and the ``text``.

    Ids may begin or end inside a character: ``first_split`` and ``last_split`` count the bytes of such characters, which
    ``text`` leaves out, so the parts of a text can be joined by their bytes.  Null ids decode to no bytes, and ids that
    the vocabulary lacks are an error.  Columns of these four names are replaced.
    """
    added = {"decoded": BinaryType(), "text": StringType(), "first_split": IntegerType(), "last_split": IntegerType()}
    kept = tokens.drop(*added)
    at = kept.columns.index(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = byte_bpe(path, pattern)
        for batch in batches:
            data = [bpe.decode(np.array(i or [], np.int64)) for i in batch.column(at).to_pylist()]
            ends = [split_characters(x) for x in data]
            texts = [x[a : len(x) - b].decode("utf-8", "replace") for x, (a, b) in zip(data, ends)]
            columns = [pa.array(data, pa.binary()), pa.array(texts, pa.string()), *[pa.array([e[k] for e in ends], pa.int32()) for k in (0, 1)]]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], names=[*batch.schema.names, *added])

    return kept.mapInArrow(run, _with_fields(kept, added))


def token_digests(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of every row of ``docs(doc_id, text)``.

    The first digest is of the decimal ids joined by one space, the second of the bytes decoded from the ids again.
    A null text counts as empty; a null id stays null; repeated rows each give a row.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = byte_bpe(path, pattern)
        for batch in batches:
            ids = bpe.encode([t or "" for t in batch.column(1).to_pylist()])
            shown = [hashlib.sha256(" ".join(map(bpe.decimals.__getitem__, x.tolist())).encode()).hexdigest() for x in ids]
            decoded = [hashlib.sha256(bpe.decode(x)).hexdigest() for x in ids]
            counts = pa.array([len(x) for x in ids], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), counts, pa.array(shown, pa.string()), pa.array(decoded, pa.string())], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
