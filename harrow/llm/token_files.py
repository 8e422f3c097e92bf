"""Token ids in Arrow files of fixed-size-list batches (operator 1).

A shard is one Arrow IPC file.  Its rows are sequences of equal length: ``ids``
(fixed-size list) and ``mask`` (fixed-size list of booleans, false on padding).
All batches but the last hold the same number of sequences, so the place of any
token follows from its number alone and is read from the memory map without a copy.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from harrow.llm.encoding import word_encoder
from harrow.llm.store import Store

BATCH_SEQUENCES = 256
INDEX = "doc_id long, shard int, local long, n_tokens long"


def _filesystem(folder: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (fs.LocalFileSystem(), folder)


class ShardWriter:
    """Writes one shard under a name of its own and renames it when complete, so a retried task replaces it whole."""

    def __init__(self, folder: str, shard: int, dtype: np.dtype, seq_len: int):
        self.fs, base = _filesystem(folder)
        self.fs.create_dir(base, recursive=True)
        self.final, self.part = f"{base}/shard-{shard:06d}.arrow", f"{base}/.shard-{shard:06d}-{uuid.uuid4().hex}"
        self.dtype, self.seq_len, self.pending, self.n = dtype, seq_len, [], 0
        kind = pa.from_numpy_dtype(dtype)
        self.schema = pa.schema([("ids", pa.list_(kind, seq_len)), ("mask", pa.list_(pa.bool_(), seq_len))])
        self.sink = self.fs.open_output_stream(self.part)
        self.out = pa.ipc.new_file(self.sink, self.schema)

    def _flush(self, ids: np.ndarray) -> None:
        full = -(-len(ids) // self.seq_len) * self.seq_len
        mask = np.arange(full) < len(ids)
        ids = np.concatenate([ids, np.zeros(full - len(ids), self.dtype)])
        columns = [pa.FixedSizeListArray.from_arrays(pa.array(x), self.seq_len) for x in (ids, mask)]
        self.out.write_batch(pa.record_batch(columns, schema=self.schema))

    def add(self, ids: np.ndarray) -> None:
        self.pending.append(ids)
        self.n += len(ids)
        size = BATCH_SEQUENCES * self.seq_len
        if self.n >= size:
            held = np.concatenate(self.pending)
            whole = len(held) // size * size
            for at in range(0, whole, size):
                self._flush(held[at : at + size])
            self.pending, self.n = [held[whole:]], len(held) - whole

    def close(self) -> None:
        if self.n:
            self._flush(np.concatenate(self.pending))
        self.out.close()
        self.sink.close()
        self.fs.move(self.part, self.final)


class ShardReader:
    """Any run of a shard's tokens, by number."""

    def __init__(self, folder: str, shard: int):
        from pyarrow import fs

        system, base = _filesystem(folder)
        path = f"{base}/shard-{shard:06d}.arrow"
        self.source = pa.memory_map(path) if isinstance(system, fs.LocalFileSystem) else system.open_input_file(path)
        self.file = pa.ipc.open_file(self.source)
        self.size = BATCH_SEQUENCES * self.file.schema.field("ids").type.list_size
        self.at, self.flat = -1, np.zeros(0)

    def tokens(self, start: int, n: int) -> np.ndarray:
        parts = []
        while n > 0:
            batch, offset = divmod(start, self.size)
            if batch != self.at:
                self.at, self.flat = batch, self.file.get_batch(batch).column(0).flatten().to_numpy(zero_copy_only=True)
            parts.append(self.flat[offset : offset + min(n, self.size - offset)])
            start, n = start + len(parts[-1]), n - len(parts[-1])
        return parts[0] if len(parts) == 1 else np.concatenate(parts) if parts else self.flat[:0]


def write_token_files(docs: DataFrame, folder: str, index_store: Store, tokenizer: str, seq_len: int = 2048, end_id: int = 0, known_words: int = 1_200_000) -> DataFrame:
    """Encode ``docs(doc_id, text)`` in ascending ``doc_id`` into shards under ``folder``.

    A null text is empty; every document ends with ``end_id``, so an empty one
    has one token.  Null ids come first; equal ids are ordered by their text's hash.
    Other columns are ignored; a worker keeps the ids of ``known_words`` words.  Each range partition makes one shard, which streams
    through the task.  Returns the index: ``doc_id, shard, local`` (place of the
    first token in the shard) and ``n_tokens``.  An empty table gives an empty index.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        shard = TaskContext.get().partitionId()
        encoder, writer, local = None, None, 0
        for batch in batches:
            if writer is None:
                encoder = word_encoder(tokenizer, known_words)
                writer = ShardWriter(folder, shard, encoder.dtype, seq_len)
            lengths, end = [], np.array([end_id], encoder.dtype)
            for at in range(0, batch.num_rows, 64):
                for tokens in encoder.encode(batch.column(1).slice(at, 64).to_pylist()):
                    writer.add(tokens)
                    writer.add(end)
                    lengths.append(len(tokens) + 1)
            n = np.array(lengths, np.int64)
            starts = local + np.cumsum(n) - n
            local += int(n.sum())
            yield pa.record_batch([batch.column(0), pa.array(np.full(len(n), shard, np.int32)), pa.array(starts), pa.array(n)], names=["doc_id", "shard", "local", "n_tokens"])
        if writer is not None:
            writer.close()

    ordered = (
        docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
        .repartitionByRange("doc_id")
        .sortWithinPartitions("doc_id", F.xxhash64("text"))
    )
    return index_store.save(ordered.mapInArrow(write, INDEX), "index")


def shard_starts(index: DataFrame) -> DataFrame:
    """Tokens of all shards before each: one row a shard, so the running sum is small."""
    totals = index.groupBy("shard").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))


def read_token_digests(index: DataFrame, folder: str) -> DataFrame:
    """Read every document's ids back from the files: ``doc_id, start, n_tokens, ids_crc32, shard``.

    Each row is a random access into its shard; the checksum covers the ids as
    little-endian unsigned 32-bit integers.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, reader = None, None
        for batch in batches:
            shards, locals_, n = (batch.column(i).to_numpy() for i in (1, 2, 3))
            crc = np.empty(batch.num_rows, np.int64)
            for i in range(batch.num_rows):
                if shards[i] != shard:
                    shard, reader = shards[i], ShardReader(folder, int(shards[i]))
                crc[i] = zlib.crc32(reader.tokens(int(locals_[i]), int(n[i])).astype("<u4").tobytes())
            yield pa.record_batch([*batch.columns, pa.array(crc)], names=["doc_id", "shard", "local", "n_tokens", "ids_crc32"])

    found = index.mapInArrow(read, INDEX + ", ids_crc32 long")
    return found.join(F.broadcast(shard_starts(index)), "shard").select(
        "doc_id", (F.col("base") + F.col("local")).alias("start"), "n_tokens", "ids_crc32", "shard"
    )
