"""Toxicity by a convolutional text classifier trained in numpy (operator 3).

A word is the sum of hashed embeddings of the word itself and of its first four and five
letters, those that several training texts have; filters of several widths slide over the words, each is max-pooled over the whole
text, and a logistic layer gives the score.  Training sees a bounded, hash-chosen sample of
labelled texts.  Thresholds for rejecting are calibrated by language on further labelled texts.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

_WORD = re.compile(r"[^\W\d_]+")
#: Texts that are scored at a time, which bounds the activations in memory.
AT_ONCE = 128


@dataclass(frozen=True)
class Settings:
    """``train_rows`` and ``calibrate_rows`` bound the labelled sample, for each label."""

    train_rows: int = 1500
    calibrate_rows: int = 500
    buckets: int = 1 << 14
    dim: int = 12
    widths: tuple[int, ...] = (1, 2, 3)
    filters: int = 12
    epochs: int = 8
    least_steps: int = 400
    batch: int = 50
    rate: float = 0.02
    least_texts: int = 2  # training texts that a feature must occur in; others have a zero embedding
    drop: float = 0.3  # share of the words that a training step leaves out
    seed: int = 11


@dataclass
class Model:
    settings: Settings
    embed: np.ndarray
    filters: list[np.ndarray]  # one (width * dim, filters) for each width
    bias: np.ndarray
    out: np.ndarray
    out_bias: float
    shift: float = 0.0
    thresholds: dict[str, float] = field(default_factory=dict)
    default: float = 0.5


def split_words(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def _features(words: list[str], buckets: int) -> np.ndarray:
    """The three hashed feature ids of each word."""
    crc = zlib.crc32
    return np.array([(crc(w.encode()), crc(b"4" + w[:4].encode()), crc(b"5" + w[:5].encode())) for w in words], np.int64).reshape(-1, 3) % buckets


def _numbered(texts: list[str | None]) -> tuple[list[np.ndarray], list[str]]:
    """The words of each text as numbers, four bytes each, and the distinct words in order of their numbers."""
    places: dict[str, int] = {}
    return [np.array([places.setdefault(w, len(places)) for w in split_words(t)], np.int32) for t in texts], list(places)


def _own_numbers(texts: list[np.ndarray]) -> tuple[list[np.ndarray], np.ndarray]:
    """The words of these texts numbered anew as they first occur, and their numbers so far."""
    ids, first, back = np.unique(np.concatenate(texts), return_index=True, return_inverse=True)
    order = np.argsort(first)
    own = np.empty(len(ids), np.int32)
    own[order] = np.arange(len(ids), dtype=np.int32)
    return np.split(own[back], np.cumsum([len(t) for t in texts])[:-1]), ids[order]


class _Batch:
    """Texts of numbered words laid end to end, each followed by a gap of padding words; ``features`` has a row for each number."""

    def __init__(self, texts: list[np.ndarray], features: np.ndarray, settings: Settings):
        pad = max(settings.widths)
        lengths = [len(t) for t in texts]
        self.features = features
        sizes = np.array(lengths) + pad
        self.ends = np.cumsum(sizes)
        self.starts = self.ends - sizes
        self.word = np.full(int(sizes.sum()) + pad, len(features), np.int64)
        for start, text in zip(self.starts, texts):
            self.word[start : start + len(text)] = text
        self.stop = int(sizes.sum())


def _pooled(model: Model, batch: _Batch, places: bool):
    """Max of each filter over each text, and where it is."""
    s = model.settings
    words = np.vstack([model.embed[batch.features].sum(axis=1), np.zeros((1, s.dim), np.float32)])
    best, where = [], []
    for width, w in zip(s.widths, model.filters):
        acts = None
        for k in range(width):
            part = (words @ w[k * s.dim : (k + 1) * s.dim])[batch.word[k : k + batch.stop]]
            acts = part if acts is None else np.add(acts, part, out=acts)
        for k in range(1, width):  # windows that would reach into the next text
            acts[batch.ends - k] = -np.inf
        top = np.maximum.reduceat(acts, batch.starts, axis=0)
        best.append(top)
        if places:
            where.append(np.stack([a + acts[a:b].argmax(axis=0) for a, b in zip(batch.starts, batch.ends)]))
    return np.concatenate(best, axis=1), where, words


def _logits(model: Model, batch: _Batch) -> np.ndarray:
    pooled, _, _ = _pooled(model, batch, False)
    return np.maximum(pooled + model.bias, 0) @ model.out + model.out_bias + model.shift


def score_texts(model: Model, texts: list[str | None]) -> np.ndarray:
    """A score from 0 to 1 for each whole text; null and empty texts score as a text without words."""
    found = [np.zeros(0)]
    for at in range(0, len(texts), AT_ONCE):
        numbers, words = _numbered(texts[at : at + AT_ONCE])
        z = _logits(model, _Batch(numbers, _features(words, model.settings.buckets), model.settings))
        found.append(1 / (1 + np.exp(-np.clip(z.astype(np.float64), -40, 40))))
    return np.concatenate(found)


def train(texts: list[str | None], labels: np.ndarray, settings: Settings) -> Model:
    """Fit by Adam-scaled gradient steps; the gradient of a max-pooled filter touches one place a text."""
    s, rng = settings, np.random.default_rng(settings.seed)
    total = s.filters * len(s.widths)
    model = Model(
        s,
        rng.normal(0, 0.1, (s.buckets, s.dim)).astype(np.float32),
        [rng.normal(0, 0.3, (w * s.dim, s.filters)).astype(np.float32) for w in s.widths],
        np.zeros(total, np.float32),
        rng.normal(0, 0.3, total).astype(np.float32),
        0.0,
    )
    if not len(texts) or labels.min() == labels.max():
        model.out[:] = 0
        model.out_bias = 0.0 if not len(texts) else (4.0 if labels[0] else -4.0)
        return model
    numbers, words = _numbered(texts)
    features = _features(words, s.buckets)
    del words
    moments: dict[int, np.ndarray] = {}

    def step(k: int, value: np.ndarray, grad: np.ndarray, rows=slice(None)) -> None:
        m = moments.setdefault(k, np.full_like(value, 1e-4))
        m[rows] = 0.97 * m[rows] + 0.03 * grad * grad
        value[rows] -= s.rate * grad / np.sqrt(m[rows] + 1e-10)

    # features of a single text would learn that text by heart, and untrained ones would be noise in every maximum
    texts_with = np.zeros(s.buckets, np.int64)
    for t in numbers:
        texts_with[np.unique(features[np.unique(t)])] += 1
    known = texts_with >= s.least_texts
    model.embed[~known] = 0
    weight = np.where(labels == 1, np.sqrt((labels == 0).sum() / (labels == 1).sum()), 1.0).astype(np.float32)
    order = np.array_split(rng.permutation(len(numbers)), max(1, len(numbers) // s.batch))
    batches = []
    for part in order:
        own, ids = _own_numbers([numbers[i] for i in part])
        batches.append(_Batch(own, features[ids], s))
    del numbers, features
    out_bias = np.zeros(1, np.float32)
    values = [model.embed, model.bias, model.out, out_bias, *model.filters]
    epochs = max(s.epochs, s.least_steps // len(batches))
    means, counted = [np.zeros_like(v) for v in values], 0
    for epoch in range(epochs):
        for k in rng.permutation(len(batches)):
            batch, y = batches[k], labels[order[k]].astype(np.float32)
            whole = batch.word
            batch.word = np.where(rng.random(len(whole)) < s.drop, len(batch.features), whole)
            pooled, where, vectors = _pooled(model, batch, True)
            hidden = np.maximum(pooled + model.bias, 0)
            p = 1 / (1 + np.exp(-np.clip(hidden @ model.out + out_bias[0], -30, 30)))
            dz = (p - y) * weight[order[k]] / len(y)
            dh = np.outer(dz, model.out) * (hidden > 0)
            step(0, model.out, hidden.T @ dz)
            step(1, out_bias, np.array([dz.sum()], np.float32))
            step(2, model.bias, dh.sum(axis=0))
            d_words = np.zeros_like(vectors)
            for v, (width, w) in enumerate(zip(s.widths, model.filters)):
                d = dh[:, v * s.filters : (v + 1) * s.filters]
                dw = np.zeros_like(w)
                for j in range(width):
                    at = batch.word[where[v] + j]  # texts x filters
                    piece = slice(j * s.dim, (j + 1) * s.dim)
                    dw[piece] = np.einsum("tf,tfd->df", d, vectors[at])
                    np.add.at(d_words, at.ravel(), (d[:, :, None] * w[piece].T[None]).reshape(-1, s.dim))
                step(3 + v, w, dw)
            touched = np.flatnonzero(np.abs(d_words[:-1]).sum(axis=1))
            ids = batch.features[touched].ravel()
            rows, back = np.unique(ids, return_inverse=True)
            grad = np.zeros((len(rows), s.dim), np.float32)
            np.add.at(grad, back, np.repeat(d_words[touched], 3, axis=0))
            if known[rows].any():
                step(99, model.embed, grad[known[rows]], rows[known[rows]])
            batch.word = whole
        if 2 * epoch >= epochs - 1:  # the mean over the later half of the epochs varies less than the last step
            counted += 1
            for mean, value in zip(means, values):
                mean += (value - mean) / counted
    for mean, value in zip(means, values):
        value[...] = mean
    model.out_bias = float(out_bias[0])
    return model


def _cut(scores: np.ndarray, labels: np.ndarray) -> float | None:
    """The threshold with the fewest errors, in the middle of its gap; None without both labels."""
    if not len(labels) or labels.min() == labels.max():
        return None
    order = np.argsort(scores, kind="stable")
    s, y = scores[order], labels[order]
    errors = np.concatenate([[0], np.cumsum(y)]) + np.concatenate([np.cumsum((y == 0)[::-1])[::-1], [0]])
    edges = np.concatenate([[0.0], (s[1:] + s[:-1]) / 2, [1.0]])
    at = np.flatnonzero(errors == errors.min())
    return float(edges[at[len(at) // 2]])


def calibrate(model: Model, texts: list[str | None], labels: np.ndarray, langs: list[str | None]) -> None:
    """Shift the scores so that 0.5 separates the labels best, then set a threshold for each language."""
    if not len(texts):
        return
    cut = _cut(score_texts(model, texts), labels)
    if cut is not None:
        cut = min(max(cut, 0.02), 0.98)
        model.shift -= float(np.log(cut / (1 - cut)))
    scores = score_texts(model, texts)
    for lang in sorted({x for x in langs if x is not None}):
        mine = np.array([x == lang for x in langs])
        own = _cut(scores[mine], labels[mine])
        if own is not None and mine.sum() >= 20:
            model.thresholds[lang] = min(max(own, 0.25), 0.75)


def fit(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> Model:
    """Train and calibrate on ``docs(doc_id, text, lang)`` labelled by ``labels(doc_id, toxic)``.

    Rows whose crc32(doc_id as text) mod 5 is 0 are never looked at.  For each label the rows with
    the smallest id hashes are taken, ``train_rows`` to train and ``calibrate_rows`` to calibrate; so at most
    2 x (train_rows + calibrate_rows) texts reach the driver, one for each id, whole.  A repeated id counts as toxic if
    any of its labels does and gives its text with the least hash; null ids and labels are left out, and a null text is one without words.
    """
    rows = settings.train_rows + settings.calibrate_rows
    known = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull()).where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 0)
    known = known.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    order = F.xxhash64("doc_id")
    sample = known.where("toxic = 1").orderBy(order, "doc_id").limit(rows).unionByName(known.where("toxic <> 1").orderBy(order, "doc_id").limit(rows))
    got = (
        docs.select("doc_id", "text", F.col("lang") if "lang" in docs.columns else F.lit(None).cast("string").alias("lang"))
        .join(F.broadcast(sample), "doc_id")  # at most 2 x rows
        .groupBy("doc_id", "toxic")
        .agg(F.min_by(F.struct("text", "lang"), F.xxhash64("text", "lang")).alias("one"))
        .select("doc_id", "toxic", "one.*")
        .collect()
    )
    parts: dict[int, list] = {}
    for r in got:
        parts.setdefault(r["toxic"], []).append(r)
    first, rest = [], []
    for toxic in sorted(parts):
        mine = sorted(parts.pop(toxic), key=lambda r: (zlib.crc32(f"order {r['doc_id']}".encode()), r["doc_id"]))
        cut = math.ceil(len(mine) * settings.train_rows / rows)
        first += mine[:cut]
        rest += mine[cut:]
    toxic = lambda part: np.array([r["toxic"] for r in part], np.int32)
    model = train([r["text"] for r in first], toxic(first), settings)
    calibrate(model, [r["text"] for r in rest], toxic(rest), [r["lang"] for r in rest])
    return model


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``score``, and ``rejected`` for a score of at least its language's threshold.

    Only the text makes the score.  A null, unknown or missing language takes the threshold
    0.5.  Columns of these names in ``docs`` are replaced; all rows stay.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a fixed size
    docs = docs.drop("score", "rejected")
    schema = StructType([*docs.schema.fields, StructField("score", DoubleType())])
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            for k in range(0, batch.num_rows, AT_ONCE):
                part = batch.slice(k, AT_ONCE)
                found = pa.array(score_texts(m, part.column(at).to_pylist()))
                yield pa.record_batch([*part.columns, found], names=[*part.schema.names, "score"])

    scored = docs.mapInArrow(run, schema)
    threshold = F.lit(model.default)
    if "lang" in docs.columns:
        for lang, value in sorted(model.thresholds.items()):
            threshold = F.when(F.col("lang") == lang, value).otherwise(threshold)
    return scored.withColumn("rejected", F.col("score") >= threshold)
