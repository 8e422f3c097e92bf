from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from harrow.operators import pairs, places, validate


@pytest.fixture
def plain_joins(spark):
    """No broadcast but those asked for, and no partitions dealt anew."""
    kept = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    for k, v in kept.items():
        spark.conf.set(k, v)


def test_row_numbers_and_sums(spark, workspace):
    rng = random.Random(1)
    rows = [(rng.randrange(50) if rng.random() < 0.9 else None, i, rng.randrange(9)) for i in range(500)]
    df = spark.createDataFrame(rows, "k int, i int, n int").repartition(7)
    got = places.row_numbers(df, [F.col("k").desc_nulls_last(), "i"], "place", workspace).collect()
    want = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    assert [tuple(r)[:3] for r in sorted(got, key=lambda r: r["place"])] == want and sorted(r["place"] for r in got) == list(range(1, 501))
    sums = {r["i"]: (r["before"], r["of"]) for r in places.sums_before(df.withColumn("of", F.lit("kept")), ["i"], {"before": "n"}, workspace).collect()}
    total = 0
    for k, i, n in sorted(rows, key=lambda r: r[1]):
        assert sums[i] == (total, "kept")
        total += n
    assert places.row_numbers(df.limit(0), ["i"], "place", workspace).count() == 0


@pytest.mark.parametrize("seed", range(3))
def test_places_in_groups(spark, workspace, seed):
    rng = random.Random(seed)
    names = ["big"] * 30 + ["a", "b", None, "é"]
    rows = [(i, rng.choice(names), rng.randrange(5)) for i in range(400)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "at int, file string, own int").repartition(5)
    got = {r["at"]: (r["_rank"], r["_in_group"], r["_place"]) for r in places.places_in_groups(df, "file", ["at"], workspace).collect()}
    ordered = sorted(rows)
    files = list(dict.fromkeys(f for _, f, _ in ordered))
    want, place = {}, 0
    for rank, file in enumerate(files, 1):
        for k, (at, _, _) in enumerate([r for r in ordered if r[1] == file], 1):
            place += 1
            want[at] = (rank, k, place)
    assert got == want


def test_one_file_is_spread_over_all_tasks(spark, workspace, plain_joins):
    df = spark.range(40_000).select(F.col("id").alias("at"), F.lit("one").alias("file"))
    rows = places.in_ranges(df, ["file", "at"], workspace)
    sizes = [r["count"] for r in rows.groupBy(places.RANGE).count().collect()]
    assert len(sizes) == 4 and max(sizes) < 2 * 40_000 / 4
    numbered = validate.numbered(df, ["at"], workspace)
    assert numbered.where((F.col("_global_row") != F.col("at") + 1) | (F.col("_row_in_file") != F.col("at") + 1) | (F.col("_file_rank") != 1)).count() == 0


def test_hot_cells_are_dealt_out_evenly(spark, workspace, plain_joins):
    # nine tenths of the rows have two null cells, the others are nearly all distinct
    df = spark.range(60_000).repartition(8).select("id", F.when(F.col("id") % 10 == 0, F.col("id").cast("string")).alias("a"), F.when(F.col("id") % 20 == 0, F.lit("x")).alias("b"))
    cells = {"s": F.col("a"), "t": F.col("b")}
    found, seen = pairs.distinct_cells(df, cells, workspace, nulls=F.sum(F.when(F.col("s").isNull(), F.col("n"))))
    assert seen == {"rows": 60_000, "nulls": 54_000}
    marked = found.withColumn("mark", F.concat_ws("/", F.lit("m"), "s", "t"))
    out = pairs.join_back(df, cells, marked, seen["rows"])
    sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 60_000 and len(sizes) == 4 and max(sizes) < 2 * 60_000 / 4
    assert out.where(~F.col("mark").eqNullSafe(F.concat_ws("/", F.lit("m"), "a", "b"))).count() == 0


def test_unchanged_combinations_get_nulls(spark, workspace):
    rows = [(i, "hot" if i % 2 else f"c{i}", None if i % 3 else "y") for i in range(3000)]
    df = spark.createDataFrame(rows, "i int, a string, b string")
    cells = {"s": F.col("a"), "t": F.col("b")}
    found, seen = pairs.distinct_cells(df, cells, workspace)
    for wanted, plain in ((F.col("t").isNull(), F.col("b").isNull()), (F.col("s") != "hot", F.col("a") != "hot"), (F.lit(False), F.lit(False))):
        out = pairs.join_back(df, cells, found.withColumn("hit", F.lit(1)), seen["rows"], wanted)
        want = df.withColumn("hit", F.when(plain, 1))
        assert sorted(map(tuple, out.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)


def test_long_cells_are_never_broadcast_as_hot(spark, workspace):
    text = "long " * 3000
    df = spark.createDataFrame([(i, text) for i in range(50)] + [(99, None)], "i int, a string")
    found, seen = pairs.distinct_cells(df, {"s": F.col("a")}, workspace)
    out = pairs.join_back(df, {"s": F.col("a")}, found.withColumn("size", F.length("s")), seen["rows"]).collect()
    assert sorted((r["i"], r["size"]) for r in out)[:2] == [(0, len(text)), (1, len(text))] and len(out) == 51


def test_files_that_begin_at_one_place(spark, workspace, plain_joins):
    """Groups whose first rows tie rank by their names, however the rows lie."""
    names = [None, *sorted(f"f{i}" for i in range(40))]
    rows = [(1, 1, "big")] + [(k, 7, f) for k in (1, 4) for f in names[::-1]]
    df = spark.createDataFrame(rows, "k int, n int, file string").repartition(3, "file")
    got = validate.numbered(df, ["k", "n"], workspace).select("file", "_file_rank").distinct().collect()
    assert sorted((r["_file_rank"], r["file"]) for r in got) == list(enumerate(["big", *names], 1))
