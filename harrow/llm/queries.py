"""The registered queries of the training-data operators, with production parameters over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from harrow.llm import byte_bpe, chunk_dedup, decontaminate, fill_middle, html_main, importance, language, line_dedup, packing, simhash, token_files, toxicity, vector_dedup
from harrow.llm.oracles import FILL_MIDDLE, IMPORTANCE, LINE_DEDUP, SEED_OVERLAPS
from harrow.llm.store import Store


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's place and checksum, read back from the token files."""
    store = Store(spark, "op1")
    folder = store.folder("files")
    index = token_files.write_token_files(_table(spark, sf_dir, "documents"), folder, store, tokenizer("byte_bpe_50k.json"))
    return token_files.read_token_digests(index, folder)


def op2_html_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return html_main.extract(_table(spark, sf_dir, "pages"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A toxicity score for every document; rows without an id count as not held out."""
    docs = _table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, _table(spark, sf_dir, "labels"))
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))
    return toxicity.score(docs.select("doc_id", "text", "lang"), model).select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "rejected"
    )


def op4_benchmark_overlaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document and benchmark item that overlap."""
    return decontaminate.contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), Store(spark, "op4"), short_items=True)


def op5_vector_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all vectors."""
    return vector_dedup.near_duplicates(_table(spark, sf_dir, "embeddings"), Store(spark, "op5"), mixed_lengths=True)


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the lines that match an earlier one."""
    cleaned = line_dedup.dedup_lines(_table(spark, sf_dir, "documents").select("doc_id", "text"), Store(spark, "op6"))
    return cleaned.select("doc_id", F.col("n_lines").cast("long").alias("n_lines"), F.col("n_removed").cast("long").alias("n_removed"), "text")


def op7_page_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every page."""
    return language.identify(_table(spark, sf_dir, "pages"), _table(spark, sf_dir, "documents"), Store(spark, "op7"))


def op8_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every passage that a document shares with another, or has several times."""
    return chunk_dedup.repeated_passages(_table(spark, sf_dir, "documents"), within=True)


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document with its sequence and offset."""
    return packing.pack(packing.cut_pieces(_table(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json")), Store(spark, "op9"))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"), Store(spark, "op10"))


def op11_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every document's ids and of the bytes that they decode to."""
    import public_tokenizers

    return byte_bpe.token_digests(_table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op12_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Form, sizes and digests of every document's fill-in-the-middle text, and of the text rebuilt from it."""
    columns = ("doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256")
    return fill_middle.transform(_table(spark, sf_dir, "documents"), columns=columns)


def op13_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's weight and score towards the benchmark's words, with the ranks of those drawn."""
    return importance.resample(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), Store(spark, "op13"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (
        op1_token_files, op2_html_main_text, op3_toxicity, op4_benchmark_overlaps, op5_vector_near_duplicates,
        op6_line_dedup, op7_page_language, op8_repeated_passages, op9_packing, op10_simhash, op11_byte_bpe, op12_fill_middle, op13_importance,
    )
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    return {"op6_line_dedup": LINE_DEDUP, "op4_benchmark_overlaps": SEED_OVERLAPS, "op12_fill_middle": FILL_MIDDLE, "op13_importance": IMPORTANCE}
