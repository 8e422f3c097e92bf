"""Substring deduplication by content-defined chunking (operator 8).

A gear hash rolls over the UTF-8 bytes and cuts where its top bits are zero, so a chunk's
borders depend on the few bytes before them and an insertion shifts no chunk but its own.
Chunks are grouped by a 128-bit digest.  Chunks that stand in more than one document and
follow each other make a passage, and passages of at least ``least`` bytes are reported: all but the
chunks of the first document that has them are duplicates.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

GEAR = np.random.default_rng(20).integers(0, 1 << 32, 256, dtype=np.uint32)
CHUNKS = "doc_id long, h long, start long, length long, d1 long, d2 long"


def cut_points(data: bytes, bits: int = 5, shortest: int = 16, longest: int = 256) -> list[int]:
    """The ends of a text's chunks, all at borders of characters.

    The gear hash of a place, the sum of G[byte] << age over the last 32 bytes, is built by doubling.
    """
    b = np.frombuffer(data, np.uint8)
    h = GEAR[b]
    for k in (1, 2, 4, 8, 16):
        older = np.zeros_like(h)
        older[k:] = h[:-k] << np.uint32(k)
        h = h + older
    border = np.append((b[1:] & 0xC0) != 0x80, True)
    ends, last = [], 0
    for place in (np.flatnonzero((h >> np.uint32(32 - bits) == 0) & border) + 1).tolist():
        while place - last > longest:
            last = _forced(border, last + longest)
            ends.append(last)
        if place - last >= shortest:
            ends.append(place)
            last = place
    while len(data) - last > longest:
        last = _forced(border, last + longest)
        ends.append(last)
    if last < len(data):
        ends.append(len(data))
    return ends


def _forced(border: np.ndarray, at: int) -> int:
    """The first character border at or after byte ``at``."""
    while not border[at - 1]:
        at += 1
    return at


def chunks(docs: DataFrame) -> DataFrame:
    """Every chunk of ``docs(doc_id, text)``: document and text hash, byte range and digest."""
    import xxhash

    names = [f.split()[0] for f in CHUNKS.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 128):
                part = batch.slice(at, 128)
                n, starts, lengths, digests = [], [], [], []
                for text in part.column(2):
                    data = text.as_py().encode()
                    ends = cut_points(data)
                    begin = [0, *ends[:-1]] if ends else []
                    n.append(len(ends))
                    starts += begin
                    lengths += [e - s for s, e in zip(begin, ends)]
                    digests += [xxhash.xxh3_128_digest(data[s:e]) for s, e in zip(begin, ends)]
                d = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)
                ids, hs = (np.repeat(part.column(k).to_numpy(), n) for k in (0, 1))
                yield pa.record_batch([pa.array(x, pa.int64()) for x in (ids, hs, starts, lengths, np.ascontiguousarray(d[:, 0]), np.ascontiguousarray(d[:, 1]))], names=names)

    known = docs.where(F.col("doc_id").isNotNull() & (F.length("text") > 0))
    return known.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("h"), "text").mapInArrow(run, CHUNKS)


def repeated_chunks(docs: DataFrame, least: int = 96, within: bool = False) -> DataFrame:
    """The chunks in reported passages: ``doc_id, h, start, length, passage, first_doc, copies, duplicate``.

    With ``within``, chunks that only one document has, but at several places, count as well; all but the first of them are duplicates.
    """
    all_chunks = chunks(docs)
    # rows that repeat a document have the same places, so that the least and the greatest tell whether there are several
    place = F.xxhash64("doc_id", "h", "start")
    several = F.min(place) != F.max(place) if within else F.min("doc_id") < F.max("doc_id")
    groups = all_chunks.groupBy("d1", "d2").agg(F.min("doc_id").alias("first_doc"), several.alias("several"), F.count("*").alias("copies")).where("several").drop("several")
    shared = all_chunks.join(groups, ["d1", "d2"]).select("doc_id", "h", "start", "length", "first_doc", "copies", *(["d1", "d2"] if within else []))
    marked = shared.dropDuplicates(["doc_id", "h", "start"])
    again = F.lit(False)
    if within:
        marked = marked.repartition("doc_id", "h").withColumn("own", F.min("start").over(Window.partitionBy("doc_id", "h", "d1", "d2"))).drop("d1", "d2")
        again = F.col("start") > F.col("own")
    of_doc = Window.partitionBy("doc_id", "h").orderBy("start")  # one document's own chunks
    marked = marked.withColumn("new", (F.col("start") != F.coalesce(F.lag(F.col("start") + F.col("length")).over(of_doc), F.lit(-1))).cast("int"))
    numbered = marked.withColumn("passage", F.sum("new").over(of_doc.rowsBetween(Window.unboundedPreceding, 0)))
    size = F.sum("length").over(Window.partitionBy("doc_id", "h", "passage"))
    found = numbered.withColumn("size", size).where(F.col("size") >= least).withColumn("duplicate", (F.col("doc_id") > F.col("first_doc")) | again)
    return found.drop("new", "size", "own")


def repeated_passages(docs: DataFrame, least: int = 96, within: bool = False) -> DataFrame:
    """One row for each passage that a document shares with another: ``doc_id, start, length`` (bytes), ``n_chunks``,
    ``n_duplicate`` (chunks that stand earlier), ``copies`` (of its commonest chunk) and ``first_docs``.

    With ``within``, passages that stand several times in one document alone count as well.
    Null ids and null or empty texts have no chunks.  Rows that repeat id and text are one
    document.  An empty table gives no rows.
    """
    found = repeated_chunks(docs, least, within).groupBy("doc_id", "h", "passage")
    return found.agg(
        F.min("start").alias("start"), F.sum("length").alias("length"), F.count("*").alias("n_chunks"),
        F.count_if("duplicate").alias("n_duplicate"), F.max("copies").alias("copies"), F.array_sort(F.collect_set("first_doc")).alias("first_docs"),
    ).drop("h", "passage")


def remove_repeats(docs: DataFrame, least: int = 96, within: bool = False) -> DataFrame:
    """``docs`` with the duplicate chunks of reported passages cut out of ``text``, ``within`` one document too; all rows and columns stay."""
    gone = repeated_chunks(docs, least, within).where("duplicate").groupBy("doc_id", "h").agg(F.array_sort(F.collect_list(F.struct("start", "length"))).alias("__gone")).withColumnsRenamed({"doc_id": "__id", "h": "__hash"})
    joined = docs.join(gone, (F.col("doc_id") == F.col("__id")) & (F.xxhash64("text") == F.col("__hash")), "left").select(*docs.columns, "__gone")
    names, at = docs.columns, docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for text, gone in zip(batch.column(at).to_pylist(), batch.column(batch.num_columns - 1).to_pylist()):
                if gone:
                    data, parts, last = text.encode(), [], 0
                    for g in gone:
                        parts.append(data[last : g["start"]])
                        last = g["start"] + g["length"]
                    text = b"".join([*parts, data[last:]]).decode()
                texts.append(text)
            columns = [*batch.columns[:-1]]
            columns[at] = pa.array(texts, pa.string())
            yield pa.record_batch(columns, names=names)

    return joined.mapInArrow(run, docs.schema)
