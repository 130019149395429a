"""Positions against a plain sort, over skewed and awkward keys and many numbers of ranges."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from weftgraph.operators.ranking import numbered
from weftgraph.scratch import Scratch


def check(frame, order, within=None, **options):
    scratch = Scratch(frame.sparkSession)
    numbered_rows = numbered(frame, order, "n", scratch, within=within, **options).collect()
    rows = frame.collect()
    assert len(numbered_rows) == len(rows)
    key = lambda r: tuple((r[c] is not None, r[c]) if r[c] is not None else (False, 0) for c in order)
    group = lambda r: r[within] if within else None
    expected = {}
    for row in sorted(rows, key=key):
        expected.setdefault(group(row), []).append(key(row))
    got = {}
    for row in sorted(numbered_rows, key=lambda r: r["n"]):
        got.setdefault(group(row), []).append((row["n"], key(row)))
    assert {g: [k for _, k in v] for g, v in got.items()} == expected
    assert all([n for n, _ in v] == list(range(len(v))) for v in got.values())


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows at one hub, a fifth of those exact copies; text, null and infinite properties."""
    rng = random.Random(5)
    rows = []
    for i in range(3000):
        a = 7 if i % 3 == 0 else rng.randrange(400)
        b = 1 if i % 15 == 0 else rng.randrange(50)
        text = rng.choice([None, "", 'quote " and \\ back', "ü-é-漢", "plain", "{}"])
        number = rng.choice([None, 0.5, -1e300, float("inf"), 3.0])
        rows.append((a, b, text, number, i))
    return spark.createDataFrame(rows, "a bigint, b bigint, t string, x double, id bigint").repartition(5).persist()


@pytest.mark.parametrize("rows_per_range", [60, 400, 1500, 10_000])
def test_hub_and_copies(skewed, rows_per_range):
    frame = skewed.withColumn("g", F.expr("a div 100L"))
    check(frame, ["a", "b", "t", "x", "id"], within="g", rows_per_range=rows_per_range)


@pytest.mark.parametrize("rows_per_range", [150, 800])
def test_one_column_orders(skewed, rows_per_range):
    check(skewed.select("id", "a"), ["id"], rows_per_range=rows_per_range)
    check(skewed.select("t"), ["t"], rows_per_range=rows_per_range)
    check(skewed.select("x"), ["x"], rows_per_range=rows_per_range)
    check(skewed.select("a", "b"), ["a", "b"], rows_per_range=rows_per_range)


def range_sizes(frame, order, **options):
    """Rows in each range that ``numbered`` wrote."""
    scratch = Scratch(frame.sparkSession)
    numbered(frame, order, "n", scratch, **options)
    written = frame.sparkSession.read.parquet(f"{scratch.path}/placed-*")
    return [r["count"] for r in written.groupBy("range").count().collect()]


def test_hot_keys_are_spread(skewed):
    frame = skewed.where("a = 7 and b = 1").select("a", "b", "id")
    sizes = range_sizes(frame, ["a", "b", "id"], rows_per_range=25)
    assert len(sizes) > 6
    assert max(sizes) <= 2.5 * 25


def test_very_many_ranges(spark):
    frame = spark.range(0, 13_000, numPartitions=4).select((F.col("id") * 7919 % 13_000).alias("a"))
    rows = numbered(frame, ["a"], "n", Scratch(spark), rows_per_range=2)
    wrong, top = rows.agg(F.count_if(F.col("a") != F.col("n")), F.max("n")).first()
    assert (wrong, top) == (0, 12_999)


def test_long_keys_keep_their_balance(spark):
    frame = spark.range(0, 60, numPartitions=6).select(
        F.concat(F.repeat(F.lit("k"), 1 << 20), F.lpad(F.col("id").cast("string"), 3, "0")).alias("k"), "id"
    )
    sizes = range_sizes(frame, ["k"], rows_per_range=10)
    assert len(sizes) >= 4 and max(sizes) <= 25
    assert numbered(frame, ["k"], "n", Scratch(spark), rows_per_range=10).where("id != n").count() == 0


def test_without_ansi(skewed):
    spark = skewed.sparkSession
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        check(skewed, ["a", "b", "t", "x", "id"], rows_per_range=90)
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


def test_any_column_names(spark):
    names = ["_range", "_shift", "row", "range", "place", "group", "rows", "shift", "of"]
    frame = spark.range(20).select(*[(F.col("id") * (i + 2)).alias(n) for i, n in enumerate(names)], "id")
    rows = numbered(frame, ["id"], "n", Scratch(spark), rows_per_range=3).orderBy("n").collect()
    assert [tuple(r[n] for n in names) for r in rows] == [tuple(k * (i + 2) for i in range(len(names))) for k in range(20)]


def test_empty(spark):
    frame = spark.createDataFrame([], "a bigint")
    assert numbered(frame, ["a"], "n", Scratch(spark)).collect() == []


def test_rows_are_written_once_and_not_shuffled_again(spark):
    frame = spark.range(1000).select(F.expr("id % 7").alias("a"), "id", F.expr("id % 7 div 2L").alias("g"))
    plan = numbered(frame, ["a", "id"], "n", Scratch(spark), within="g", rows_per_range=100)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in text and "Exchange hashpartitioning" not in text and "SinglePartition" not in text


def test_many_groups_join_by_a_shuffle(skewed):
    spark = skewed.sparkSession
    frame = skewed.withColumn("g", F.expr("a div 5L"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "100")
    try:
        check(frame, ["a", "b", "id"], within="g", rows_per_range=400)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
