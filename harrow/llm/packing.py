"""Best-fit packing of documents into fixed-length sequences (operator 9).

Pieces over half a sequence open sequences of their own, and as many empty ones are opened as the rest of the
tokens fill.  Then supersteps follow until every piece has a place:

1. The pieces left and the gaps of the sequences are range-sorted by size in one table, pieces first where sizes agree, in as many
   ranges as their number asks for: the few pieces that a band has at the end are one range.
2. Each task sweeps its range upwards with a stack: a gap takes the largest pieces below it, as long as they fit.
   So every piece goes to its successor among the gaps, and of the pieces that want one gap the largest wins.
3. What a range leaves over, gaps without a piece and then pieces without a gap, is numbered.  From the counts of
   each range alone the driver tells which ranks of pieces meet which ranks of gaps of higher ranges, nearest range
   first, several pieces to a gap where the gaps are large enough; Spark joins them by rank.
4. The gaps shrink, gaps that no piece fits wait for shorter pieces, and where no gap fits any piece, sequences are opened for the rest.

The rounds deal with the longer pieces before the shorter ones, in a few bands of lengths.  Each round is written to the shared folder.  The driver sees how many pieces and gaps have each size, and a few numbers for each range, no documents.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from functools import reduce
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from harrow.llm.encoding import word_encoder
from harrow.llm.store import Store

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def cut_pieces(docs: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int = 0, known_words: int = 1_200_000) -> DataFrame:
    """Tokenize ``docs(doc_id, text)`` and cut those longer than ``capacity``.

    Null text is empty; each document ends with ``end_id``.  One row a piece:
    ``doc_id, piece, start, length, ids_crc32``.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_encoder(tokenizer, known_words)
        end = np.array([end_id], "<u4")
        for batch in batches:
            ids, rows = batch.column(0).to_pylist(), []
            for at in range(0, batch.num_rows, 64):
                for doc, tokens in zip(ids[at : at + 64], encoder.encode(batch.column(1).slice(at, 64).to_pylist())):
                    tokens = np.concatenate([tokens.astype("<u4"), end])
                    for k, start in enumerate(range(0, len(tokens), capacity)):
                        piece = tokens[start : start + capacity]
                        rows.append((doc, k, start, len(piece), zlib.crc32(piece.tobytes())))
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            columns = zip(*rows) if rows else [()] * len(kinds)
            yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], names=[f.split()[0] for f in PIECES.split(", ")])

    return docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text")).mapInArrow(cut, PIECES)


def match_runs(runs: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """Best-fit decreasing in one process over runs of equal lengths: the yardstick for the number of sequences, not used by :func:`pack`.

    ``runs`` maps a length to how many pieces have it.  Returns segments
    ``(length, first rank, last rank, first sequence, offset)``: the pieces of that
    length with those ranks go to consecutive sequences at that offset.
    """
    gaps: list[tuple[int, int, int]] = []  # (gap, first sequence, sequences), ascending
    segments: list[tuple[int, int, int, int, int]] = []
    opened = 0

    def put(length: int, rank: int, gap: int, first: int, n: int) -> None:
        segments.append((length, rank, rank + n - 1, first, capacity - gap))
        if gap > length:
            insort(gaps, (gap - length, first, n))

    for length in sorted(runs, reverse=True):
        left, rank = runs[length], 0
        while left:
            at = bisect_left(gaps, (length, -1, -1))
            if at < len(gaps):
                gap, first, n = gaps.pop(at)
                take = min(n, left)
                if take < n:
                    insort(gaps, (gap, first + take, n - take))
                put(length, rank, gap, first, take)
            else:
                take = -(-left // (capacity // length))
                put(length, rank, capacity, opened, take)
                opened += take
            left, rank = left - take, rank + take
    return segments


PLACED, PIECE, GAP, USED = range(4)
STATE = "kind int, id long, size long, seq long, at long"
SWEPT = f"part int, rank long, {STATE}"


#: Rows of pieces and gaps in a range, and in a task.
RANGE_ROWS = 20_000


def tasks_for(rows: int, spark: SparkSession) -> int:
    """Tasks for a table of so many rows: few where few are left, and at most the session's shuffle partitions."""
    return max(1, min(-(-rows // RANGE_ROWS), int(spark.conf.get("spark.sql.shuffle.partitions"))))


def sweep_ranges(state: DataFrame, sizes: dict[tuple[int, int], int], capacity: int) -> DataFrame:
    """Range-sort pieces and gaps by size and sweep each range: what is ``PLACED``, the gaps ``USED``, and each ``PIECE``
    (ranks from the largest) and ``GAP`` (ranks from the smallest) that its range leaves over.

    ``sizes`` tells how many pieces and gaps have each size, so the bounds of ranges of equally many rows are known; a size that
    many rows have is cut into several ranges by hashes of the ids.
    """

    def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
        names = [f.split()[0] for f in SWEPT.split(", ")]

        def table(rows: list[tuple]) -> pa.RecordBatch:
            return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows) if rows else [()] * len(kinds), kinds)], names=names)

        stack: list[tuple[int, int]] = []  # (size, piece) without a gap so far, ascending
        part, free = None, 0

        def rest() -> Iterator[pa.RecordBatch]:
            nonlocal free
            while stack:
                some = [stack.pop() for _ in range(min(len(stack), 10_000))]
                yield table([(part, free + k, PIECE, piece, size, None, None) for k, (size, piece) in enumerate(some)])
                free += len(some)

        for batch in batches:
            rows = []
            for of, kind, key, size in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if of != part:
                    yield from rest()
                    part, free = of, 0
                if kind == PIECE:
                    stack.append((size, key))
                elif stack:
                    left = size
                    while stack and stack[-1][0] <= left:
                        length, piece = stack.pop()
                        rows.append((part, None, PLACED, piece, length, key, capacity - left))
                        left -= length
                    if left:
                        rows.append((part, None, USED, key, left, None, None))
                else:
                    rows.append((part, free, GAP, key, size, None, None))
                    free += 1
            yield table(rows)
        yield from rest()

    spark = state.sparkSession
    ordered = sorted(sizes, key=lambda k: (k[1], k[0]))
    before = [0, *accumulate(sizes[k] for k in ordered)]
    bounds = spark.createDataFrame([(kind, size, first, sizes[kind, size]) for (kind, size), first in zip(ordered, before)], "kind int, size long, first long, n long")
    share = F.pmod(F.xxhash64("id"), F.lit(1 << 31)) / F.lit(float(1 << 31))
    part = F.floor((F.col("first") + F.floor(share * F.col("n"))) / F.lit(RANGE_ROWS)).cast("int")
    rows = state.where(F.col("kind") != PLACED).join(F.broadcast(bounds), ["kind", "size"]).select(part.alias("part"), "kind", "id", "size")
    dealt = rows.repartition("part").coalesce(tasks_for(before[-1], spark))
    return dealt.sortWithinPartitions("part", "size", "kind", "id").mapInArrow(sweep, SWEPT)


def match_ranges(ranges: list[tuple[int, int, int, int, int, int, int]]) -> list[tuple[int, int, int, int, int, int]]:
    """Match the pieces that lower ranges leave over with the gaps that higher ranges leave over, nearest range first.

    ``ranges`` holds ``(part, gaps, first gap rank, smallest gap, pieces, first piece rank, largest piece)`` in ascending order.  Returns
    ``(piece part, first rank, last rank, gap part, first gap rank, pieces to a gap)``, at most two for each range.
    """
    waiting: list[list[int]] = []
    found = []
    for part, gaps, gap_rank, smallest, pieces, piece_rank, largest in ranges:
        while gaps and waiting:
            run = waiting[-1]
            source, rank, n, length = run
            each = smallest // length
            take = min(n, gaps * each)
            used = -(-take // each)
            found.append((source, rank, rank + take - 1, part, gap_rank, each))
            gaps, gap_rank = gaps - used, gap_rank + used
            run[1:3] = rank + take, n - take
            if take == n:
                waiting.pop()
        if pieces:
            waiting.append([part, piece_rank, pieces, largest])
    return found


def superstep(state: DataFrame, sizes: dict[tuple[int, int], int], store: Store, capacity: int) -> DataFrame:
    """One round over ``state``: sweep the ranges, match what they leave over by rank, and shrink the gaps."""
    tasks = tasks_for(sum(sizes.values()), store.spark)
    swept = store.save(sweep_ranges(state, sizes, capacity), "swept")
    over = swept.where(F.col("kind").isin(PIECE, GAP)).groupBy("part", "kind")
    facts = over.agg(F.count("*").alias("n"), F.min("rank").alias("rank"), F.min("size").alias("low"), F.max("size").alias("high")).coalesce(1).collect()  # two rows a range
    gaps = {r["part"]: (r["n"], r["rank"], r["low"]) for r in facts if r["kind"] == GAP}
    pieces = {r["part"]: (r["n"], r["rank"], r["high"]) for r in facts if r["kind"] == PIECE}
    none = (0, 0, 0)
    matches = match_ranges([(p, *gaps.get(p, none), *pieces.get(p, none)) for p in sorted(gaps | pieces)])
    plan = F.broadcast(store.spark.createDataFrame(matches, "source int, low long, high long, target int, first long, each long"))
    taken = F.broadcast(plan.select("target", "first", (F.col("first") + F.floor((F.col("high") - F.col("low")) / F.col("each"))).alias("last")))

    left = swept.where(F.col("kind") == PIECE).select("part", "rank", "id", "size").join(plan, (F.col("part") == F.col("source")) & F.col("rank").between(F.col("low"), F.col("high")), "left")
    free = swept.where(F.col("kind") == GAP).select(F.col("part").alias("target"), F.col("rank").alias("place"), F.col("id").alias("seq"), F.col("size").alias("gap"))
    place = (F.col("first") + F.floor((F.col("rank") - F.col("low")) / F.col("each"))).alias("place")
    met = left.where("source IS NOT NULL").select("id", "size", "rank", "target", place).join(free, ["target", "place"]).coalesce(tasks)
    by_rank = Window.partitionBy("seq").orderBy("rank")
    met = met.select("id", "size", "seq", "gap", F.sum("size").over(by_rank).alias("filled"), F.lead("id").over(by_rank).isNull().alias("last"))
    rest, null = F.col("gap") - F.col("filled"), F.lit(None).cast("long")

    def row(kind: int, *columns):
        return F.struct(*(c.alias(n) for c, n in zip((F.lit(kind), *columns), ("kind", "id", "size", "seq", "at"))))

    placed = row(PLACED, F.col("id"), F.col("size"), F.col("seq"), F.lit(capacity).cast("long") - rest - F.col("size"))
    shrunk = F.when(F.col("last") & (rest > 0), row(GAP, F.col("seq"), rest, null, null))
    columns = ["kind", "id", "size", "seq", "at"]
    swept_on = F.when(F.col("kind") == USED, GAP).otherwise(F.col("kind")).alias("kind")
    unmet = free.alias("f").join(taken.alias("t"), (F.col("f.target") == F.col("t.target")) & F.col("place").between(F.col("first"), F.col("last")), "left_anti")
    after = store.save(
        swept.where(F.col("kind").isin(PLACED, USED)).select(swept_on, *columns[1:])
        .unionByName(met.select(F.inline(F.filter(F.array(placed, shrunk), lambda x: x.isNotNull()))))
        .unionByName(left.where("source IS NULL").select(F.lit(PIECE).alias("kind"), "id", "size", null.alias("seq"), null.alias("at")))
        .unionByName(unmet.select(F.lit(GAP).alias("kind"), F.col("seq").alias("id"), F.col("gap").alias("size"), null.alias("seq"), null.alias("at")))
        .coalesce(tasks),
        "round",
    )
    store.drop(swept)
    return after


def pack(pieces: DataFrame, store: Store, capacity: int = 2048, bands: tuple[int, ...] = (4, 8, 16, 32, 64)) -> DataFrame:
    """Give every piece its ``sequence_id`` and ``offset``; see the module text.

    ``bands`` are the parts of a sequence at which the pieces are divided: longer ones find their places first, so that the shortest are left to fill up.
    Equal pieces (same id, number and checksum) are told apart by their rows in the written table.  An
    empty table packs into nothing.
    """
    spark = store.spark
    columns = pieces.columns
    pieces = store.save(pieces.withColumn("row", F.monotonically_increasing_id()), "pieces")
    alone = 2 * F.col("length") > capacity
    facts = pieces.agg(F.max("length").alias("most"), F.sum("length").alias("total"), F.count_if(alone).alias("alone")).first()
    if (facts["most"] or 0) > capacity:
        raise ValueError("a piece is longer than a sequence")

    def empty(first: int, n: int) -> DataFrame:
        """Rows of new sequences, numbered from -1 down; those of long pieces have the numbers of their rows."""
        return spark.range(n).selectExpr(f"{GAP} kind", f"-1 - {first} - id AS id", f"{capacity}L size", "CAST(NULL AS long) seq", "CAST(NULL AS long) at")

    def sequences(tokens: int) -> int:
        return -(-tokens // capacity)

    opened = max(0, sequences(facts["total"] or 0) - facts["alone"])
    none = "CAST(NULL AS long)"
    placed, rounds = pieces.where(alone).selectExpr("row", "row sequence_id", "0L offset"), []
    gaps = pieces.where(alone & (F.col("length") < capacity)).selectExpr(f"{GAP} kind", "row id", f"{capacity} - length size", f"{none} seq", f"{none} at").unionByName(empty(0, opened))
    tops = [capacity // 2, *(capacity // d for d in bands)]
    for top, floor in zip(tops, [*tops[1:], 0]):
        band = pieces.where(F.col("length").between(floor + 1, top)).selectExpr(f"{PIECE} kind", "row id", "length size", f"{none} seq", f"{none} at")
        state, narrow = gaps.unionByName(band), []
        while True:
            # a row for each kind and size, so at most two for each length
            counted = state.groupBy("kind", "size").agg(F.count("*").alias("n")).coalesce(1).collect()
            sizes = {(r["kind"], r["size"]): r["n"] for r in counted}
            left = [size for kind, size in sizes if kind == PIECE]
            if not left:
                break
            fits = (F.col("kind") == PIECE) | (F.col("size") >= min(left))
            narrow.append(state.where(~fits))
            state = state.where(fits)
            sizes = {k: n for k, n in sizes.items() if k[0] == PIECE or k[1] >= min(left)}
            if all(kind == PIECE for kind, _ in sizes):
                more = sequences(sum(size * n for (kind, size), n in sizes.items()))
                state, opened = state.unionByName(empty(opened, more)), opened + more
                sizes[GAP, capacity] = more
            after = superstep(state, sizes, store, capacity)
            rounds.append(after)
            state = after.where(F.col("kind") != PLACED)
        gaps = reduce(DataFrame.unionByName, narrow, state)
    if rounds:
        placed = placed.unionByName(store.together(rounds).where(F.col("kind") == PLACED).selectExpr("id row", "seq sequence_id", "at offset"))
    return pieces.join(placed, "row").select(*columns, "sequence_id", "offset")
