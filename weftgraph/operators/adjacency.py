"""Edges arranged by one of their ends, in chunks, with offsets.

Rows are dealt out by ranges of the order, sorted once and written once, with the range
and the place in it. Where each range's part of a vertex chunk begins is a small table
beside the rows: a row's position is looked up when it is read.
"""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import DataFrame, Window, functions as F

from weftgraph.functions.types import fresh, quoted
from weftgraph.operators.index import chunk_of
from weftgraph.operators.ranking import PLACE_IN_PARTITION, dealt_ranges, with_ranges
from weftgraph.scratch import Scratch

# The end an arrangement is sorted by, then the other end.
ENDS = {"source": ("src_vid", "dst_vid"), "destination": ("dst_vid", "src_vid")}


def keep_edges(resolved: DataFrame, scratch: Scratch) -> DataFrame:
    """Write resolved edges once for the passes that arrange them.

    ``edge_row`` makes every row distinct, so that even a long run of equal
    edges can be cut into ranges.
    """
    return scratch.keep(resolved.withColumn("edge_row", F.monotonically_increasing_id()), "edges")


def place_columns(properties: Collection[str]) -> tuple[str, str]:
    """Names for the columns that say where a row was written, apart from all properties."""
    return fresh("range", properties), fresh("place", properties)


def arranged(
    edges: DataFrame, by: str, vertex_chunk_size: int, total: int, rows_per_range: int | None = None
) -> DataFrame:
    """Kept edges ready to be written: vertex_chunk, range, place in it, src_vid, dst_vid and the properties.

    In each partition rows stand by vertex chunk and range, then by (near end, far end,
    properties); parallel edges that agree in everything are interchangeable. Written
    by the first two columns they need no further sort, unless a task takes more than two ranges.
    """
    near, far = ENDS[by]
    properties = [c for c in edges.columns if c not in (near, far, "edge_row")]
    in_range, place = place_columns(properties)
    parts, each, size = dealt_ranges(edges.sparkSession, total, rows_per_range)
    order = [quoted(c) for c in (near, far, *properties, "edge_row")]
    chunked = edges.withColumn("vertex_chunk", chunk_of(near, vertex_chunk_size))
    if each > 2:
        # Spark samples rows on the driver for each partition that it deals out, so many small ranges are told apart by place.
        dealt = chunked.repartitionByRange(parts, *order)
        in_order = with_ranges(dealt.sortWithinPartitions("vertex_chunk", *order), each, size, in_range, place)
    else:
        # Ranges known before their rows are sorted spare the writer a sort of its own.
        dealt = chunked.repartitionByRange(max(1, -(-total // size)), *order)
        marked = dealt.withColumn(in_range, F.spark_partition_id()).coalesce(parts)
        in_order = marked.sortWithinPartitions("vertex_chunk", quoted(in_range), *order)
        in_order = in_order.withColumn(place, F.monotonically_increasing_id().bitwiseAND(F.lit(PLACE_IN_PARTITION)))
    return in_order.select(
        "vertex_chunk", quoted(in_range), quoted(place), "src_vid", "dst_vid", *[quoted(c) for c in properties]
    )


def range_starts(written: DataFrame) -> DataFrame:
    """Where the rows of each range begin in their vertex chunk, from what was written.

    vertex_chunk, range, rows, first_place, first_pos, and ``whole``: whether each place
    from the first to the last is there once. One row per range, and one more per vertex chunk.
    """
    in_range, place = (F.col(f"`{c}`") for c in written.columns[1:3])
    counts = written.groupBy("vertex_chunk", in_range.alias("range")).agg(
        F.count(F.lit(1)).alias("rows"),
        F.min(place).alias("first_place"),
        F.max(place).alias("last_place"),
        F.sum(place.cast("decimal(38)")).alias("added"),
    )
    earlier = Window.partitionBy("vertex_chunk").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    span = F.col("last_place") - F.col("first_place") + 1
    # Places without a gap, with the sum that they then have.
    whole = (F.col("rows") == span) & (F.col("added") * 2 == span * (F.col("first_place") + F.col("last_place")))
    return counts.select(
        "vertex_chunk",
        "range",
        "rows",
        "first_place",
        F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("first_pos"),
        whole.alias("whole"),
    )


def with_positions(written: DataFrame, starts: DataFrame, edge_chunk_size: int) -> DataFrame:
    """What ``arranged`` wrote, with the position of each edge in its vertex chunk in place of range and place.

    ``edge_chunk`` cuts a vertex chunk's edges into pieces of equal size.
    """
    in_range, place = written.columns[1:3]
    begin = starts.select(
        F.col("vertex_chunk").alias("of_chunk"), F.col("range").alias("of_range"), (F.col("first_pos") - F.col("first_place")).alias("shift")
    )
    rows = written.select(F.struct(*[quoted(c) for c in written.columns]).alias("row"))
    of_row = F.col("row").getField
    found = rows.join(begin, (of_row("vertex_chunk") == F.col("of_chunk")) & (of_row(in_range) == F.col("of_range")))
    pos = of_row(place) + F.col("shift")
    return found.select(
        of_row("vertex_chunk").alias("vertex_chunk"),
        F.call_function("div", pos, F.lit(int(edge_chunk_size)).cast("bigint")).alias("edge_chunk"),
        pos.alias("pos"),
        *[of_row(c).alias(c) for c in written.columns[3:]],
    )


def adjacency(
    edges: DataFrame,
    by: str,
    scratch: Scratch,
    vertex_chunk_size: int,
    edge_chunk_size: int,
    total: int | None = None,
    rows_per_range: int | None = None,
) -> DataFrame:
    """Kept edges with their place among the edges of the same vertex chunk: vertex_chunk, edge_chunk, pos, ends, properties.

    ``pos`` counts by (near end, far end, properties).
    """
    if total is None:
        total = edges.count()
    written = scratch.keep(arranged(edges, by, vertex_chunk_size, total, rows_per_range), "arranged")
    return with_positions(written, scratch.keep(range_starts(written), "starts"), edge_chunk_size)


def offsets(edges: DataFrame, by: str, vertices: int, vertex_chunk_size: int) -> DataFrame:
    """Where each vertex's edges start in its chunk, and one closing entry per chunk.

    Every number below ``vertices`` has an entry, edges or not. The closing entry
    carries the next vertex number and the number of edges of the chunk.
    """
    near, _ = ENDS[by]
    degrees = edges.groupBy(F.col(near).alias("vid")).agg(F.count(F.lit(1)).alias("degree"))
    everyone = edges.sparkSession.range(vertices).select(
        F.col("id").alias("vid"), F.lit(0).cast("bigint").alias("degree")
    )
    # One shuffle by chunk serves both the sum per vertex and the running sum; the edges' own by vertex comes
    # before it, combined in the tasks, because by chunk a hub's edges would not be spread.
    filled = (
        degrees.unionByName(everyone)
        .withColumn("vertex_chunk", chunk_of("vid", vertex_chunk_size))
        .repartition("vertex_chunk")
        .groupBy("vertex_chunk", "vid")
        .agg(F.sum("degree").alias("degree"))
    )
    in_chunk = Window.partitionBy("vertex_chunk").orderBy("vid")
    end = F.sum("degree").over(in_chunk.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    ends = filled.withColumn("end", end)
    vid = F.col("vid")
    start = F.struct(vid.alias("vid"), (F.col("end") - F.col("degree")).alias("offset"))
    closing = F.struct((vid + 1).alias("vid"), F.col("end").alias("offset"))
    is_last = (vid % vertex_chunk_size == vertex_chunk_size - 1) | (vid == vertices - 1)
    entries = F.when(is_last, F.array(start, closing)).otherwise(F.array(start))
    return ends.select("vertex_chunk", F.inline(entries))
