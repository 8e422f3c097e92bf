"""Benchmark decontamination by spaced-seed hashing (operator 4), DataFrame functions only.

A seed is a mask over a short run of tokens whose ignored positions may hold any
token.  Every place of every test item and of every document is hashed under each mask and the
hashes are joined; a hit fixes how item and document line up.  Along that line-up the
tokens are compared one by one, and the document is contaminated where the best run
of ``min_overlap`` item tokens (or the whole of a shorter item) around the hits agrees in at
least ``similarity`` of its places.  Substitutions cost only their own place; each side of
an insertion lines up on its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harrow.llm.store import Store

#: Each keeps five words; 1 is compared, 0 is ignored.
MASKS = ("11111", "1101011", "110010101")
#: For whole items of 5 to 9 tokens with one substitution and of 10 with two, by length: one of these fits beside or around any place.
SHORT_MASKS = {5: ("111", "11011"), 6: ("111",), 7: ("111",), 8: ("1111",), 9: ("1111",), 10: ("111",)}
#: Items of fewer tokens than this aren't looked for.
LEAST_TOKENS = 5
#: Rows that are broadcast at most.
BROADCAST_SEEDS, BROADCAST_LINES, BROADCAST_IDS = 500_000, 50_000, 1_000_000


def tokens(text: Column) -> Column:
    """Lower-case runs of letters, marks and digits of a text; a null text has none."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{M}\p{N}]+"), lambda w: w != "")


def _seeds(words: Column, n: Column, masks: tuple[str, ...], wanted: dict[str, Column] | None = None) -> Column:
    """An array of (place, hash) for each place where a mask fits and, if it has one, its condition holds."""
    def places(k: int, mask: str) -> Column:
        kept = [i for i, c in enumerate(mask) if c == "1"]
        last = n - len(mask)
        at = lambda i: F.struct(i.alias("at"), F.xxhash64(F.lit(k), *[F.get(words, i + o) for o in kept]).alias("seed"))
        none = F.array().cast("array<struct<at:int,seed:bigint>>")
        return F.when((last >= 0) & (wanted or {}).get(mask, F.lit(True)), F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), at)).otherwise(none)

    return F.concat(*[places(k, mask) for k, mask in enumerate(masks)])


def _best_run(agree: Column, run: Column) -> Column:
    """(agreements, start) of the run of ``run`` places of the 0/1 array with the most agreements, the first of them."""
    sums = F.transform(
        F.sequence(F.lit(0), F.size(agree) - run),
        lambda s: F.struct(F.aggregate(F.slice(agree, s + 1, run), F.lit(0), lambda a, x: a + x).alias("same"), (-s).alias("back")),
    )
    return F.array_max(sums)


def contaminated(docs: DataFrame, items: DataFrame, store: Store, masks: tuple[str, ...] = MASKS, similarity: float = 0.8, min_overlap: int = 20, short_items: bool = False, least_tokens: int = LEAST_TOKENS) -> DataFrame:
    """One row for each document and item that overlap: ``doc_id, item_id, n_places, similarity, start, length``.

    ``docs(doc_id, text)`` and ``items(item_id, text)``; ``n_places`` counts the line-ups that were
    verified, the other columns describe the best one, ``start`` counting the document's tokens.
    With ``short_items``, items of 5 to 10 tokens get further masks, so that none with one substitution (two in 10) is missed.
    Null or empty texts and items of fewer than ``least_tokens`` (at least five) overlap with nothing, null ids are left out,
    repeated rows count once, other columns are ignored, and an empty table gives no rows.
    """
    test = items.where(F.col("item_id").isNotNull()).select("item_id", tokens(F.col("text")).alias("item")).distinct()
    test = store.save(test.withColumn("m", F.size("item")).where(F.col("m") >= max(least_tokens, 5)), "items")
    wanted: dict[str, Column] = {}
    if short_items:
        lengths = {r["m"] for r in test.where(F.col("m") <= max(SHORT_MASKS)).select("m").distinct().collect()}  # six at most
        for mask in sorted({x for m in lengths for x in SHORT_MASKS[m]} - set(masks)):
            wanted[mask] = F.col("m").isin([m for m in lengths if mask in SHORT_MASKS[m]])
            masks = (*masks, mask)
    seeds = test.select("item_id", F.inline(_seeds(F.col("item"), F.col("m"), masks, wanted))).withColumnRenamed("at", "item_at").distinct()
    seeds = store.save(seeds, "seeds")
    words = docs.where(F.col("doc_id").isNotNull()).select("doc_id", tokens(F.col("text")).alias("words"))
    places = words.select("doc_id", F.inline(_seeds(F.col("words"), F.size("words"), masks)))
    # the test set's seeds are broadcast only while there are few of them
    side = F.broadcast(seeds) if seeds.count() <= BROADCAST_SEEDS else seeds
    lines = places.join(side, "seed").select("doc_id", "item_id", (F.col("at") - F.col("item_at")).alias("shift")).distinct()
    lines = store.save(lines, "lines").join(test, "item_id")
    # line-ups are checked against the words of their documents; few of them go to the texts, many meet them by id
    few = F.broadcast(lines) if lines.count() <= BROADCAST_LINES else lines
    # the part of the document beside the item; texts are split once and only these few words are kept
    first = F.greatest(-F.col("shift"), F.lit(0))
    beside = F.slice(tokens(F.col("text")), F.col("first") + F.col("shift") + 1, F.col("m") - F.col("first"))
    checked = docs.select("doc_id", "text").join(few.withColumn("first", first), "doc_id")
    checked = store.save(checked.select("doc_id", "item_id", "shift", "first", "m", "item", beside.alias("beside")), "beside")
    # long items overlap in a run of min_overlap places or more
    run = F.least(F.col("m"), F.lit(min_overlap))
    agree = F.zip_with("beside", F.slice("item", F.col("first") + 1, F.size("beside")), lambda a, b: (a == b).cast("int"))
    found = (
        checked.withColumn("run", run)
        .where(F.size("beside") >= run)
        .withColumn("agree", agree)
        .withColumn("best", _best_run(F.col("agree"), F.col("run")))
        .withColumn("similarity", F.col("best.same") / F.col("run"))
        .where(F.col("similarity") >= similarity)
    )
    best = F.max(F.struct("similarity", F.col("run").alias("length"), (-(F.col("first") - F.col("best.back") + F.col("shift"))).alias("back")))
    return (
        found.groupBy("doc_id", "item_id")
        .agg(F.countDistinct("shift").alias("n_places"), best.alias("b"))
        .select("doc_id", "item_id", "n_places", "b.similarity", (-F.col("b.back")).cast("long").alias("start"), F.col("b.length").cast("long").alias("length"))
    )


def clean(docs: DataFrame, items: DataFrame, store: Store, **options) -> DataFrame:
    """The rows of ``docs`` that overlap with no item; rows without an id stay."""
    hit = store.save(contaminated(docs, items, store, **{"short_items": True, **options}).select("doc_id").distinct(), "hit")
    hit = F.broadcast(hit) if hit.count() <= BROADCAST_IDS else hit
    return docs.join(hit, "doc_id", "left_anti").select(*docs.columns)
