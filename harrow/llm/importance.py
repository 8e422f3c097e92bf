"""Importance resampling towards a target distribution of word runs (operator 13).

Hashed features are counted by word tries that live in one partition each; their bucket totals are merged by Spark.
The gains of the buckets are then attached to the nodes of new tries, along whose paths documents are scored.
"""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from harrow.llm.store import Store

BLOCK = 4 << 20
_WORD = [b for b in range(256) if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80]
_FOLD = bytes(b + 0x20 if 0x41 <= b <= 0x5A else b if b in _WORD else 0x20 for b in range(256))
_GAP = re.compile(rb"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]")
SCORED = "doc_id long, n_features long, n_words long, weight long, score long"


@dataclass(frozen=True)
class Settings:
    """Features are runs of ``low`` to ``high`` words in ``buckets``; of documents with ``least_words``, ``percent`` in 100 are drawn.

    ``nodes`` bounds a trie: a full one adds its counts to the totals and begins anew, so results don't depend on it.
    """

    low: int = 1
    high: int = 1
    buckets: int = 10_000
    least_words: int = 20
    percent: int = 10
    seed: int = 2024
    nodes: int = 500_000


def word_blocks(text: bytes | None, block: int = BLOCK) -> Iterator[list[bytes]]:
    """The words of a text in order, a bounded number of bytes at a time unless a word is longer; only A-Z are folded."""
    at, end = 0, len(text or b"")
    while at < end:
        gap = _GAP.search(text, min(at + block, end))
        until = gap.start() if gap else end
        yield text[at:until].translate(_FOLD).split()
        at = until


class _Children(dict):
    """Nodes by key; a key that is new makes a node."""

    def __init__(self, make):
        super().__init__()
        self.make = make

    def __missing__(self, key):
        node = self[key] = self.make(key)
        return node


class WordTrie:
    """A trie over words: each node holds the CRC state of its run of words, how often the run was met, and its gain.

    The first level is keyed by words and numbers them; deeper levels by (node, number of the next word).
    """

    def __init__(self, high: int, gains: list[int] | None = None):
        self.gains = gains
        self.states: list[int] = []
        self.words: list[bytes] = []
        self.number: dict[int, int] = {}  # of the word of a node of the first level
        self.attached: list[int] = []
        self.first = _Children(self._first)
        self.deeper = _Children(self._deeper) if high > 1 else None
        self.high = high
        self.counts = np.zeros(0, np.int64)

    def __len__(self) -> int:
        return len(self.states)

    def _node(self, state: int) -> int:
        self.states.append(state)
        if self.gains is not None:
            self.attached.append(self.gains[state % len(self.gains)])
        return len(self.states) - 1

    def _first(self, word: bytes) -> int:
        node = self._node(zlib.crc32(word))
        if self.deeper is not None:
            self.number[node] = len(self.words)
            self.words.append(word)
        return node

    def _deeper(self, key: int) -> int:
        parent, word = key >> 32, key & 0xFFFFFFFF
        return self._node(zlib.crc32(self.words[word], zlib.crc32(b" ", self.states[parent])))

    def paths(self, words: list[bytes], known: int = 0) -> list[np.ndarray]:
        """For each length, the nodes of the runs that end after the first ``known`` words."""
        level = list(map(self.first.__getitem__, words))
        if self.deeper is None:
            return [np.array(level[known:], np.int64)]
        numbers = [self.number[n] for n in level]
        found = [np.array(level[known:], np.int64)]
        for length in range(2, self.high + 1):
            level = [self.deeper[parent << 32 | word] for parent, word in zip(level, numbers[length - 1 :])]
            found.append(np.array(level[max(known - length + 1, 0) :], np.int64))
        return found

    def count(self, nodes: np.ndarray) -> None:
        met = np.bincount(nodes, minlength=len(self.counts))
        met[: len(self.counts)] += self.counts
        self.counts = met

    def totals(self, buckets: int) -> np.ndarray:
        """How many features fell into each bucket."""
        counts = np.zeros(len(self), np.int64)
        counts[: len(self.counts)] = self.counts
        out = np.zeros(buckets, np.int64)
        np.add.at(out, np.array(self.states, np.int64) % buckets, counts)
        return out


def _runs(trie: WordTrie, text: bytes | None, settings: Settings) -> Iterator[tuple[np.ndarray, int]]:
    """The nodes of a text's features and its words, block by block; words that runs go on from are carried over."""
    carried: list[bytes] = []
    for words in word_blocks(text):
        paths = trie.paths(carried + words, len(carried))
        yield np.concatenate(paths[settings.low - 1 :]), len(words)
        carried = (carried + words)[-(settings.high - 1) :] if settings.high > 1 else []


def bucket_totals(texts: DataFrame, settings: Settings = Settings(), text: str = "text") -> DataFrame:
    """``bucket, n``: how many features of all texts fall into each bucket that has any."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals, trie = np.zeros(settings.buckets, np.int64), WordTrie(settings.high)
        for batch in batches:
            held, size = [], 0
            for value in batch.column(0).cast(pa.binary()).to_pylist():
                for nodes, _ in _runs(trie, value, settings):
                    held.append(nodes)
                    size += len(nodes)
                    if size > 1 << 20 or len(trie) > settings.nodes:
                        trie.count(np.concatenate(held))
                        held, size = [], 0
                    if len(trie) > settings.nodes:
                        totals += trie.totals(settings.buckets)
                        trie = WordTrie(settings.high)
            if held:
                trie.count(np.concatenate(held))
        totals += trie.totals(settings.buckets)
        met = np.flatnonzero(totals)
        yield pa.RecordBatch.from_arrays([pa.array(met, pa.int64()), pa.array(totals[met], pa.int64())], names=["bucket", "n"])

    counted = texts.select(F.col(text).cast("string").alias("text")).mapInArrow(run, "bucket long, n long")
    return counted.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains_of(raw: dict[int, int], target: dict[int, int], buckets: int) -> list[int]:
    """Each bucket's gain in thousandths: the log ratio of its smoothed shares in the target and in the raw texts."""
    all_raw, all_target = sum(raw.values()), sum(target.values())
    return [
        math.floor(1000 * math.log((float(target.get(b, 0) + 1) * float(all_raw + buckets)) / (float(raw.get(b, 0) + 1) * float(all_target + buckets))))
        for b in range(buckets)
    ]


def noise(seed: int, doc_id: int | None) -> int:
    """A Gumbel variable in thousandths that only the seed and the id decide."""
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def score(docs: DataFrame, gains: list[int], settings: Settings = Settings()) -> DataFrame:
    """``doc_id, n_features, n_words, weight, score`` of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = WordTrie(settings.high, gains)
        for batch in batches:
            rows = []
            for doc_id, value in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()):
                features = words = total = 0
                for nodes, n in _runs(trie, value, settings):
                    features, words = features + len(nodes), words + n
                    total += sum(map(trie.attached.__getitem__, nodes.tolist()))
                    if len(trie) > settings.nodes:
                        trie = WordTrie(settings.high, gains)
                weight = total // features if features else 0
                rows.append((doc_id, features, words, weight, weight + noise(settings.seed, doc_id)))
            names = [c.split()[0] for c in SCORED.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (zip(*rows) if rows else [[]] * 5)], names=names)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, SCORED)


def ranked(rows: DataFrame, order: list, store: Store, name: str = "rank") -> DataFrame:
    """``rows`` with their places in an order, from 1: sorted by ranges over all tasks, and numbered from the ranges' sizes."""
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = store.save(rows.repartitionByRange(n, *order).sortWithinPartitions(*order).withColumn("__part", F.spark_partition_id()).withColumn("__row", F.monotonically_increasing_id()), "ranges")
    sizes = placed.groupBy("__part").agg(F.count("*").alias("__n"), F.min("__row").alias("__first"))
    before = F.coalesce(F.sum("__n").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))  # one row a range
    starts = F.broadcast(sizes.select("__part", (before + 1 - F.col("__first")).alias("__shift")))
    return placed.join(starts, "__part").withColumn(name, F.col("__row") + F.col("__shift")).drop("__part", "__row", "__shift")


def resample(docs: DataFrame, target: DataFrame, store: Store, settings: Settings = Settings()) -> DataFrame:
    """``doc_id, n_features, weight, score, rank`` of every row of ``docs(doc_id, text)``; ``rank`` is null for what isn't drawn.

    Null texts have no words; a row without words has weight 0.  A null id counts as an empty one in the draw and comes last in
    ties; rows of equal score and id are ordered by their other columns.  Empty tables give an empty one, and other columns
    of ``docs`` and ``target`` are never looked at.

    To the driver come the buckets' totals, and how many rows have each score: scores are whole thousandths of a
    log ratio, so there are some ten thousand of them at any size.
    """
    totals = lambda df: {r["bucket"]: r["n"] for r in bucket_totals(df, settings).collect()}
    gains = gains_of(totals(docs), totals(target), settings.buckets)
    scored = store.save(score(docs, gains, settings), "scored")
    sizes = scored.where(F.col("n_words") >= settings.least_words).groupBy("score").agg(F.count("*").alias("n")).collect()
    wanted = settings.percent * sum(r["n"] for r in sizes) // 100
    lowest, above = None, 0
    for r in sorted(sizes, key=lambda r: -r["score"]):
        if above >= wanted:
            break
        lowest, above = r["score"], above + r["n"]
    may = F.lit(False) if lowest is None else (F.col("n_words") >= settings.least_words) & (F.col("score") >= lowest)
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("n_features"), F.col("weight")]
    drawn = ranked(scored.where(may), order, store).withColumn("rank", F.when(F.col("rank") <= wanted, F.col("rank")))
    return drawn.unionByName(scored.where(~may).withColumn("rank", F.lit(None).cast("long"))).select("doc_id", "n_features", "weight", "score", "rank")
