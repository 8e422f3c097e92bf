"""Fill-in-the-middle documents by DuckDB SQL inside Arrow batches (operator 12).

Each batch is registered as a table of the worker's own DuckDB, cut and reordered by one SQL
statement, and comes back as Arrow; no row passes through Python.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: White space with the word after it, or white space at the end.
TOKEN = r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+"
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
BATCH_BYTES = 8 << 20
COLUMNS = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string, restored string, output_sha256 string, restored_sha256 string"


@dataclass(frozen=True)
class Settings:
    """``seed`` of the hashes; of 100 documents ``rate`` are rearranged, and of 100 of these ``spm`` take the suffix first."""

    seed: int = 42
    rate: int = 50
    spm: int = 80


def statement(settings: Settings) -> str:
    """The SQL for a batch ``docs(doc_id, text)``: draw two cuts, write the form, and rebuild the text from output and form."""
    h = lambda k: f"('0x' || substr(digest, {8 * k - 7}, 8))::BIGINT"
    between = lambda a, b: f"substr(output, strpos(output, '{a}') + 3, strpos(output, '{b}') - strpos(output, '{a}') - 3)"
    after = f"substr(output, strpos(output, '{MIDDLE}') + 3)"
    return f"""
WITH cut AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '{TOKEN}') AS tokens, sha256('{settings.seed}:' || coalesce(doc_id::VARCHAR, '')) AS digest FROM docs
), drawn AS (
  SELECT doc_id, text, tokens, len(tokens) AS n, least({h(1)} % (len(tokens) + 1), {h(2)} % (len(tokens) + 1)) AS a, greatest({h(1)} % (len(tokens) + 1), {h(2)} % (len(tokens) + 1)) AS b,
    CASE WHEN text = '' OR contains(text, '{PREFIX}') OR contains(text, '{SUFFIX}') OR contains(text, '{MIDDLE}') OR {h(3)} % 100 >= {settings.rate} THEN 'plain'
         WHEN {h(4)} % 100 < {settings.spm} THEN 'spm' ELSE 'psm' END AS form
  FROM cut
), parts AS (
  SELECT doc_id, text, n, form, array_to_string(list_slice(tokens, 1, a), '') AS prefix, array_to_string(list_slice(tokens, a + 1, b), '') AS middle, array_to_string(list_slice(tokens, b + 1, n), '') AS suffix FROM drawn
), written AS (
  SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
    CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '{PREFIX}' || prefix || '{SUFFIX}' || suffix || '{MIDDLE}' || middle ELSE '{SUFFIX}' || suffix || '{PREFIX}' || prefix || '{MIDDLE}' || middle END AS output
  FROM parts
), restored AS (
  SELECT *, CASE form WHEN 'plain' THEN output WHEN 'psm' THEN {between(PREFIX, SUFFIX)} || {after} || {between(SUFFIX, MIDDLE)} ELSE {between(PREFIX, MIDDLE)} || {after} || {between(SUFFIX, PREFIX)} END AS restored FROM written
)
SELECT doc_id, n, form, prefix_chars, middle_chars, output, restored, sha256(output) AS output_sha256, sha256(restored) AS restored_sha256 FROM restored"""


@lru_cache(maxsize=1)
def connection():
    """The DuckDB of this worker process: one thread, in memory, without a folder to spill to."""
    import duckdb

    return duckdb.connect(":memory:", config={"threads": 1, "temp_directory": "", "preserve_insertion_order": True})


def slices(batch: pa.RecordBatch, column: int, most: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """A batch in runs of rows whose texts have ``most`` bytes or, for a single longer text, one row."""
    import pyarrow.compute as pc

    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    start = held = 0
    for i, size in enumerate(sizes.tolist()):
        if held and held + size > most:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += size
    if start < batch.num_rows:
        yield batch.slice(start)


def transform(docs: DataFrame, settings: Settings = Settings(), columns: tuple[str, ...] = tuple(c.split()[0] for c in COLUMNS.split(", "))) -> DataFrame:
    """Each document of ``docs(doc_id, text)`` with its output and the text rebuilt from it, and what ``columns`` names of them.

    A null text counts as empty and a null id as an empty decimal; empty texts and texts with one of the three marks stay plain.
    Rows with equal ids have equal draws; repeated rows each give a row, and other columns of ``docs`` are left out.
    ``output`` and ``restored`` are whole, however long the text is.
    """
    kinds = dict(c.split() for c in COLUMNS.split(", "))
    sql = f"SELECT {', '.join(columns)} FROM ({statement(settings)})"
    arrow = {"long": pa.int64(), "string": pa.string()}
    schema = pa.schema([(c, arrow[kinds[c]]) for c in columns])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        con = connection()
        for batch in batches:
            for part in slices(batch, 1):
                con.register("docs", pa.Table.from_batches([part]))
                found = con.sql(sql).to_arrow_table().cast(schema)
                con.unregister("docs")
                yield from found.to_batches()

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, ", ".join(f"{c} {kinds[c]}" for c in columns))
