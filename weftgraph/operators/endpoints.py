"""From endpoint keys to vertex numbers.

The joins carry no broadcast hint: Spark broadcasts an index it knows to be small. Where
it does not, the rows of an endpoint meet in one task, so endpoints that hold a good part
of all edges are found first, by a sketch, and joined in parts: each of their edges takes
one of several salts by its row number, and their index rows are copied to all salts. The
rest is joined plainly, so nothing depends on adaptive execution splitting a partition.
"""

from __future__ import annotations

from collections.abc import Collection, Mapping

from pyspark.sql import DataFrame, functions as F

from weftgraph.functions.types import quoted

# Null ends match nothing; they are spread over so many keys, lest they pile up in one task.
NULL_SALTS = 1024
# Keys with more than 1 in so many of an edge table's rows are heavy, so there are fewer of them.
HEAVY = 1000


def heavy_keys(edges: DataFrame, ends: Collection[str]) -> dict[str, list]:
    """For each end column the keys that hold more than 1 in ``HEAVY`` rows, and perhaps some that hold less.

    One pass over the end columns. Tasks keep ``HEAVY`` counters (a new key takes from all
    of them when none is free, so no heavy key is lost) and merge them.
    """
    ends = list(dict.fromkeys(ends))
    found = edges.select(*[quoted(end).alias(f"end{i}") for i, end in enumerate(ends)]).stat.freqItems(
        [f"end{i}" for i in range(len(ends))], support=1 / HEAVY
    )
    row = found.first()
    return {end: [key for key in row[f"end{i}_freqItems"] if key is not None] for i, end in enumerate(ends)}


def salts_of_heavy(edges: DataFrame) -> int:
    """Parts that a heavy key is joined in: as many as a shuffle has tasks."""
    return max(2, int(edges.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def matched_edges(
    edges: DataFrame,
    src: str,
    dst: str,
    source_index: DataFrame,
    destination_index: DataFrame,
    heavy: Mapping[str, Collection] | None = None,
) -> DataFrame:
    """Every edge as a struct ``row`` with ``src_vid`` and ``dst_vid``, null where there is no such vertex.

    An index is a frame of (key, vid), its key first. ``heavy`` has the heavy keys by
    column, as ``heavy_keys`` finds them; without it all keys are joined plainly.
    """
    salts = salts_of_heavy(edges)
    # The caller's columns stay inside one struct, out of the way of the helper columns. Rows are numbered
    # where they are read, so that a repeated task gives them the same salts.
    found = edges.select(F.struct(*[quoted(c) for c in edges.columns]).alias("row"), F.monotonically_increasing_id().alias("number"))
    for end, index, into in ((src, source_index, "src_vid"), (dst, destination_index, "dst_vid")):
        key, keys_of_end = F.col("row").getField(end), list((heavy or {}).get(end, ()))
        salt = F.when(key.isNull(), F.pmod("number", F.lit(NULL_SALTS)))
        copies = F.array(F.lit(0).cast("bigint"))
        index_key = quoted(index.columns[0])
        if keys_of_end:
            salt = salt.when(key.isin(keys_of_end), F.pmod("number", F.lit(salts)))
            all_salts = F.sequence(F.lit(0).cast("bigint"), F.lit(salts - 1).cast("bigint"))
            copies = F.when(index_key.isin(keys_of_end), all_salts).otherwise(copies)
        salted = found.select("*", key.alias("end"), salt.otherwise(F.lit(0)).cast("bigint").alias("end_salt"))
        keys = index.select(index_key.alias("key"), F.col("vid").alias(into), F.explode(copies).alias("key_salt"))
        same = (F.col("end") == F.col("key")) & (F.col("end_salt") == F.col("key_salt"))
        found = salted.join(keys, same, "left").select(*found.columns, into)
    return found


def edge_properties(edges: DataFrame, src: str, dst: str) -> list[str]:
    return [c for c in edges.columns if c not in (src, dst)]


def resolved_edges(
    edges: DataFrame,
    src: str,
    dst: str,
    source_index: DataFrame,
    destination_index: DataFrame,
    heavy: Mapping[str, Collection] | None = None,
) -> DataFrame:
    """Edges whose both ends exist: ``src_vid``, ``dst_vid`` and the properties."""
    matched = matched_edges(edges, src, dst, source_index, destination_index, heavy)
    properties = [F.col("row").getField(c).alias(c) for c in edge_properties(edges, src, dst)]
    return matched.where("src_vid IS NOT NULL AND dst_vid IS NOT NULL").select("src_vid", "dst_vid", *properties)


def dangling_edges(
    edges: DataFrame,
    src: str,
    dst: str,
    source_index: DataFrame,
    destination_index: DataFrame,
    heavy: Mapping[str, Collection] | None = None,
) -> DataFrame:
    """Edges with an end that is null or that no vertex has."""
    matched = matched_edges(edges, src, dst, source_index, destination_index, heavy)
    own = [F.col("row").getField(c).alias(c) for c in edges.columns]
    return matched.where("src_vid IS NULL OR dst_vid IS NULL").select(*own)
