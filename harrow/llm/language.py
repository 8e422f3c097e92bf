"""Language identification by Bayesian evidence fusion (operator 7).

The posterior of a page's language is the product of how likely its text, its declared markup
language and the suffix of its address are in each language, and of a prior from its host.  Text
likelihoods are multinomial over hashed character trigrams, counted over all labelled documents and
tempered, since trigrams overlap.  The other tables are grouped sums of the text posteriors of
all pages: declarations and suffixes by language, and languages by host, domain and top-level
domain, each smoothed towards the next wider level.  A page's own text is left out of all sums that it is judged by.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harrow.llm.html_main import page_lines
from harrow.llm.store import Store

_LETTERS = re.compile(r"[\W\d_]+")


@dataclass(frozen=True)
class Settings:
    buckets: int = 1 << 13
    temper: float = 0.3  # weight of a trigram's log likelihood
    most: int = 200  # trigrams that a text counts for at most, in weight
    smooth: float = 4.0  # pages that a wider level counts for
    trust: float = 0.02  # probability that a declaration or suffix is of any language


def _trigrams(text: str | None, buckets: int) -> np.ndarray:
    """Hashed trigram ids of the letters of a whole text, words set apart by one space."""
    flat = f" {_LETTERS.sub(' ', (text or '').lower()).strip()} "
    codes = np.frombuffer(flat.encode("utf-32-le"), np.uint32).astype(np.uint64)
    if len(codes) < 3:
        return np.zeros(0, np.int64)
    mixed = (codes[:-2] * np.uint64(0x9E3779B1) + codes[1:-1] * np.uint64(0x85EBCA77) + codes[2:] * np.uint64(0xC2B2AE3D)) & np.uint64(0xFFFFFFFF)
    return ((mixed * np.uint64(0x27D4EB2F) & np.uint64(0xFFFFFFFF)) >> np.uint64(13)).astype(np.int64) % buckets


def trigram_model(docs: DataFrame, settings: Settings) -> tuple[list[str], np.ndarray]:
    """Languages and log likelihoods (languages x buckets) from all of ``docs(text, lang)``.

    Rows without a language or text are left out.  Each task sends one count for each language and bucket.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                own = sums.setdefault(lang, np.zeros(settings.buckets, np.int64))
                own += np.bincount(_trigrams(text.as_py(), settings.buckets), minlength=settings.buckets)
        for lang, own in sums.items():
            at = np.flatnonzero(own)
            yield pa.record_batch([pa.array([lang] * len(at), pa.string()), pa.array(at), pa.array(own[at])], names=["lang", "bucket", "n"])

    known = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).select("lang", "text")
    rows = known.mapInArrow(count, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    langs = sorted(rows["lang"].unique())
    table = np.full((len(langs), settings.buckets), 0.5)
    table[[langs.index(x) for x in rows["lang"]], rows["bucket"].to_numpy(np.int64)] += rows["n"].to_numpy(np.float64)
    return langs, np.log(table / table.sum(axis=1, keepdims=True))


def text_likelihoods(pages: DataFrame, langs: list[str], table: np.ndarray, settings: Settings) -> DataFrame:
    """``page_id, url, declared, ll``: the declared language and each language's tempered log likelihood of the page's text."""
    shared = pages.sparkSession.sparkContext.broadcast(table)  # languages x buckets, whatever the number of pages

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                scores = []
                for source in part.column(2):
                    ids = _trigrams(" ".join(x[0] for x in page_lines(source.as_py() or "")), settings.buckets)
                    ll = shared.value[:, ids].sum(axis=1) if len(ids) else np.zeros(len(langs))
                    scores.append(ll * settings.temper * min(1.0, settings.most / max(len(ids), 1)))
                yield pa.record_batch([part.column(0), part.column(1), part.column(3), pa.array(scores, pa.list_(pa.float64()))], names=["page_id", "url", "declared", "ll"])

    tag = F.regexp_extract("html", r"(?is)<html\b[^>]*\slang\s*=\s*[\"']?([a-z]{2,3})\b", 1)
    declared = F.lower(F.nullif(tag, F.lit("")))
    return pages.select("page_id", "url", "html", declared.alias("declared")).mapInArrow(run, "page_id long, url string, declared string, ll array<double>")


def _array(prefix: str, langs: list[str]) -> Column:
    return F.array(*[F.col(f"{prefix}{x}") for x in langs])


def _totals(sums: DataFrame, key: str, langs: list[str]) -> tuple[int, list[float]]:
    """How many values the key has and the sums over them, without the row of nulls."""
    row = sums.where(F.col(key).isNotNull()).agg(F.count("*").alias("n"), *[F.coalesce(F.sum(x), F.lit(0.0)).alias(x) for x in langs]).first()
    return max(row["n"], 1), [row[x] for x in langs]


def _log_likelihood(own: list[Column], sums: str, totals: tuple[int, list[float]], trust: float) -> Column:
    """log P(value | language) for each language, from the array ``sums`` of the page's value without the page itself; zeros without a value."""
    n, whole = totals
    left = [F.greatest(F.get(sums, F.lit(k)) - p, F.lit(0.0)) for k, p in enumerate(own)]
    logs = [F.log((1 - trust) * (x + 0.1) / (F.greatest(F.lit(t) - p, F.lit(0.0)) + 0.1 * n) + trust / n) for x, t, p in zip(left, whole, own)]
    return F.when(F.col(sums).isNotNull(), F.array(*logs)).otherwise(F.array(*[F.lit(0.0)] * len(own)))


def identify(pages: DataFrame, docs: DataFrame, store: Store, settings: Settings = Settings()) -> DataFrame:
    """``page_id, url, lang, probability, text_lang, declared, host, host_pages`` for every row of ``pages(page_id, url, html)``.

    ``docs(text, lang)`` teaches the text likelihoods.  A null or empty html and a missing
    declaration or address just tell nothing; with no evidence at all the commonest language is given,
    and a null where there are no labelled documents.  Rows without a host share the widest
    prior.  Repeated rows count as often as they stand; other columns are ignored.
    """
    langs, table = trigram_model(docs, settings)
    if not langs:
        return pages.selectExpr("page_id", "url", "string(null) lang", "double(null) probability", "string(null) text_lang", "string(null) declared", "string(null) host", "0L host_pages")
    scored = text_likelihoods(pages, langs, table, settings)
    host = F.lower(F.nullif(F.regexp_extract("url", r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]+)", 1), F.lit("")))
    parts = F.split("host", r"\.")
    peak = F.array_max("ll")
    soft = F.transform("ll", lambda x: F.exp(x - peak))
    total = F.aggregate("soft", F.lit(0.0), lambda a, x: a + x)
    base = (
        scored.withColumn("host", host)
        .withColumn("domain", F.array_join(F.slice(parts, F.greatest(F.size(parts) - 1, F.lit(1)), 2), "."))
        .withColumn("suffix", F.get(parts, F.size(parts) - 1))
        .withColumn("soft", soft)
        .withColumn("soft", F.transform("soft", lambda x: x / total))
    )
    base = store.save(base.select("page_id", "url", "declared", "ll", "host", "domain", "suffix", *[F.get("soft", F.lit(k)).alias(f"p_{x}") for k, x in enumerate(langs)]), "base")
    sums = [F.sum(f"p_{x}").alias(x) for x in langs]
    declared = base.groupBy("declared").agg(*sums)
    # one row for each host, summed before the shuffle; each wider level sums the narrower one
    hosts = base.groupBy("host", "domain", "suffix").agg(*sums, F.count("*").alias("n"))
    domains = hosts.groupBy("domain", "suffix").agg(*[F.sum(x).alias(f"d_{x}") for x in langs])
    suffixes = domains.groupBy("suffix").agg(*[F.sum(f"d_{x}").alias(x) for x in langs])
    whole = suffixes.agg(*[F.coalesce(F.sum(x), F.lit(0.0)).alias(x) for x in langs]).first()
    by_declared, by_suffix = _totals(declared, "declared", langs), _totals(suffixes, "suffix", langs)
    levels = hosts.join(domains.drop("suffix"), "domain").join(suffixes.select("suffix", _array("", langs).alias("of_suffix")), "suffix")
    levels = levels.select("host", F.col("n").alias("host_pages"), _array("", langs).alias("of_host"), _array("d_", langs).alias("of_domain"), "of_suffix")
    # two or three letters: at most 18,252 declarations, however many pages
    said = declared.where(F.col("declared").isNotNull()).select("declared", _array("", langs).alias("of_declared"))
    fused = base.join(levels, "host", "left").join(F.broadcast(said), "declared", "left")
    own, k = [F.col(f"p_{x}") for x in langs], settings.smooth

    def smoothed(level: str) -> Column:
        n = F.greatest(F.aggregate(level, F.lit(0.0), lambda a, x: a + x) - sum(own, F.lit(0.0)), F.lit(0.0))
        found = [(F.greatest(F.get(level, F.lit(i)) - p, F.lit(0.0)) + k * F.get("wider", F.lit(i))) / (n + k) for i, p in enumerate(own)]
        return F.when(F.col(level).isNotNull(), F.array(*found)).otherwise(F.col("wider"))

    all_pages = sum(whole[x] for x in langs)
    fused = fused.withColumn("wider", F.array(*[F.greatest(F.lit(whole[x] + 1.0) - p, F.lit(1e-3)) / F.lit(max(all_pages, 1.0) + len(langs)) for x, p in zip(langs, own)]))
    for level in ("of_suffix", "of_domain", "of_host"):
        fused = fused.withColumn("wider", smoothed(level))
    fused = fused.withColumns({"d": _log_likelihood(own, "of_declared", by_declared, settings.trust), "s": _log_likelihood(own, "of_suffix", by_suffix, settings.trust)})
    post = F.array(*[(F.get("ll", F.lit(i)) + F.get("d", F.lit(i)) + F.get("s", F.lit(i)) + F.log(F.get("wider", F.lit(i)))) for i in range(len(langs))])
    names = F.array(*[F.lit(x) for x in langs])
    best = F.array_max("post")
    norm = F.aggregate("post", F.lit(0.0), lambda a, x: a + F.exp(x - best))
    text_lang = F.get(names, (F.array_position("ll", F.array_max("ll")) - 1).cast("int"))
    return fused.withColumn("post", post).select(
        "page_id", "url", F.get(names, (F.array_position("post", best) - 1).cast("int")).alias("lang"), (F.lit(1.0) / norm).alias("probability"),
        text_lang.alias("text_lang"), "declared", "host", F.coalesce("host_pages", F.lit(0)).cast("long").alias("host_pages"),
    )
