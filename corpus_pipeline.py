"""A cleaning pipeline over ``documents``: each stage applies one of the training-data operators.

Stages get ``(spark, docs, sf_dir)`` with what the stage before kept, and all but the last
return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from harrow.llm import decontaminate, line_dedup, near_copies, packing, toxicity
from harrow.llm.queries import tokenizer
from harrow.llm.store import Store


_TABLES = ("lines", "copies", "leaks", "packing")
_begun: dict[str, Store] = {}


def _store(spark: SparkSession, name: str, docs: DataFrame) -> Store:
    """The tables of a stage.

    A stage's rows are written before the next one begins, so the tables of the stages before go now; those that ``docs`` still reads stay.
    """
    for earlier in _TABLES[: _TABLES.index(name)]:
        if earlier in _begun and _begun[earlier].spark is spark and not _begun[earlier].reads(docs):
            _begun.pop(earlier).clear()
    _begun[name] = Store(spark, name)
    return _begun[name]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity is below their language's threshold; the classifier learns from ``labels``.

    Null and empty texts have a score like others, rows without an id are scored too, and repeated rows stay or go together.
    An empty table keeps nothing.
    """
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.score(docs, model).where(~F.col("rejected")).select(*docs.columns)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines that match an earlier one; ``n_chars`` follows the text.

    Null texts and rows without an id stay as they are; lines of one place in rows that repeat an id are ordered by hashes of the texts.
    """
    cleaned = line_dedup.dedup_lines(docs, _store(spark, "lines", docs)).select(*docs.columns)
    return cleaned.withColumn("n_chars", F.char_length("text").cast("long")) if "n_chars" in docs.columns else cleaned


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group whose texts have a Jaccard similarity of five-word shingles of at least 0.8; rows without an id stay.

    Pairs come from SimHash and, where two bits are too few for a pair at the threshold, from min-hashes; all are verified.

    The row is the first by id, then by the hash of its text, then of all its columns, so an id that stands
    for several texts keeps each text that leads its group.
    """
    known = docs.where(F.col("doc_id").isNotNull())
    key = ["doc_id", "h", "row"]
    first = near_copies.components(known, _store(spark, "copies", docs)).groupBy("component").agg(F.min(F.struct(*key)).alias("m")).select("m.*")
    hashed = known.withColumn("h", F.xxhash64("text")).withColumn("row", F.xxhash64(*docs.columns))
    stays = hashed.join(first, key, "left_semi").dropDuplicates(key).select(*docs.columns)
    return stays.unionByName(docs.where(F.col("doc_id").isNull()))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that overlap with no benchmark item; null texts and rows without an id stay, and rows that repeat an id stay or go together."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), _store(spark, "leaks", docs))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the remaining documents with their sequences and offsets; a null text is one piece, its end mark, and repeated rows are packed each."""
    return packing.pack(packing.cut_pieces(docs, tokenizer("word_bpe_49k.json"), known_words=200_000), _store(spark, "packing", docs))


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_repeated_lines),
    ("simhash near-dedup", drop_near_copies),
    ("benchmark decontamination", drop_contaminated),
    ("best-fit packing", pack_sequences),
]

#: The toxicity and packing stages are not expressible in SQL; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``, writing and rereading each one's rows."""
    store = Store(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (name, stage) in enumerate(STAGES):
        kept = store.save(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        if number:
            store.drop(docs)  # what the stage before kept
        docs = kept
    return docs
