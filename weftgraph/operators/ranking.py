"""Positions in a sorted order, without sorting the whole table in one task.

``row_number()`` over an unpartitioned window moves every row to one task. Here Spark
deals the rows out by ranges of the order and sorts each range; the rows are written
once with their range and their place in it. How many rows of which group each range
has is then counted from what was written, so where the ranges begin only sets the
balance, and the counts make the result exact.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window, WindowSpec, functions as F

from weftgraph.functions.types import quoted
from weftgraph.scratch import Scratch

ROWS_PER_RANGE = 1 << 20
# The part of a generated row number that counts rows within a partition.
PLACE_IN_PARTITION = (1 << 33) - 1


def dealt_ranges(spark: SparkSession, total: int, rows_per_range: int | None = None) -> tuple[int, int, int]:
    """Partitions, ranges in each and rows in a range for ``total`` rows.

    Each range has a task of its own while there are no more ranges than shuffle
    partitions and each holds ROWS_PER_RANGE rows at least; beyond that, a task
    takes several consecutive ranges, so that small ranges do not make tasks without end.
    """
    size = rows_per_range or ROWS_PER_RANGE
    ranges = max(1, -(-total // size))
    most = max(int(spark.conf.get("spark.sql.shuffle.partitions", "200")), -(-total // ROWS_PER_RANGE))
    parts = min(ranges, most)
    return parts, -(-ranges // parts), size


def with_ranges(frame: DataFrame, each: int, size: int, in_range: str = "range", place: str = "place") -> DataFrame:
    """Add each row's range and place in it, by its place in its partition; a partition's last range takes what is over."""
    at = frame.withColumn(place, F.monotonically_increasing_id().bitwiseAND(F.lit(PLACE_IN_PARTITION)))
    within = F.least(F.floor(quoted(place) / F.lit(size)), F.lit(each - 1))
    ranged = (F.spark_partition_id().cast("bigint") * F.lit(each) + within).cast("int")
    return at.select("*", ranged.alias(in_range)).withColumn(place, quoted(place) - within * F.lit(size))


def numbered(
    frame: DataFrame,
    order: Sequence[str],
    into: str,
    scratch: Scratch,
    within: str | None = None,
    total: int | None = None,
    rows_per_range: int | None = None,
) -> DataFrame:
    """Add the 0-based position of each row by ``order`` (nulls first) among the rows equal in ``within``.

    ``within`` must not decrease along ``order``, as the chunk number of the
    leading column does not. The rows may carry columns of any name but ``into``.

    A run of rows equal in all of ``order`` cannot be cut; end ``order`` with a
    unique column where such runs can be long.
    """
    if total is None:
        total = frame.count()
    parts, each, size = dealt_ranges(frame.sparkSession, total, rows_per_range)
    # The caller's columns stay inside one struct, out of the way of the helper columns.
    rows = frame.select(F.struct(*[quoted(c) for c in frame.columns]).alias("row"))
    keys = [F.col("row").getField(c) for c in order]
    ordered = rows.repartitionByRange(parts, *keys).sortWithinPartitions(*keys)
    group = F.col("row").getField(within) if within else F.lit(0)
    placed = scratch.keep(
        with_ranges(ordered, each, size).select("row", "range", "place", group.alias("group")),
        "placed",
    )
    counts = placed.groupBy("range", "group").agg(F.count(F.lit(1)).alias("rows"))
    in_earlier_ranges = Window.partitionBy("group").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    of_earlier_groups = Window.partitionBy("range").orderBy("group").rowsBetween(Window.unboundedPreceding, -1)
    shift = _rows(in_earlier_ranges)
    if within:
        shift -= _rows(of_earlier_groups)
    # Written, so that Spark knows its size when it plans the join: one row per range, and one more per group.
    shifts = scratch.keep(counts.select("range", F.col("group").alias("of"), shift.alias("shift")), "shifts")
    same = (placed["range"] == shifts["range"]) & placed["group"].eqNullSafe(shifts["of"])
    found = placed.join(shifts, same)
    own = [F.col("row").getField(c).alias(c) for c in frame.columns]
    return found.select(*own, (F.col("place") + F.col("shift")).alias(into))


def _rows(window: WindowSpec):
    return F.coalesce(F.sum("rows").over(window), F.lit(0))
