"""Dense vertex numbers: the 0-based rank of a vertex's key among the keys of its label."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from weftgraph.functions.types import quoted
from weftgraph.operators.ranking import numbered
from weftgraph.scratch import Scratch


class BadKeysError(ValueError):
    """The keys of a label are not what a primary key must be."""


@dataclass(frozen=True)
class KeyCounts:
    vertices: int
    nulls: int
    repeated: int


def distinct_keys(frame: DataFrame, key: str) -> DataFrame:
    """Each key once as ``key``, with its number of rows (null included); combined before the shuffle."""
    return frame.groupBy(quoted(key).alias("key")).agg(F.count(F.lit(1)).alias("copies"))


def key_counts(keys: DataFrame) -> KeyCounts:
    """Totals of a frame made by ``distinct_keys``."""
    is_null = F.col("key").isNull()
    row = keys.agg(
        F.count("key").alias("vertices"),
        F.coalesce(F.sum(F.when(is_null, F.col("copies"))), F.lit(0)).alias("nulls"),
        F.count_if(~is_null & (F.col("copies") > 1)).alias("repeated"),
    ).first()
    return KeyCounts(row["vertices"], row["nulls"], row["repeated"])


def vertex_index(
    frame: DataFrame, key: str, scratch: Scratch, rows_per_range: int | None = None
) -> tuple[DataFrame, int]:
    """Add ``vid`` to every vertex; also gives the number of vertices.

    The full rows are only shuffled after the keys are known to be unique.
    """
    counts = key_counts(distinct_keys(frame, key))
    if counts.nulls or counts.repeated:
        raise BadKeysError(f"key {key!r}: {counts.nulls} null rows, {counts.repeated} keys held by several rows")
    indexed = numbered(frame, [key], "vid", scratch, total=counts.vertices, rows_per_range=rows_per_range)
    return indexed, counts.vertices


def key_index(frame: DataFrame, key: str, scratch: Scratch, rows_per_range: int | None = None) -> DataFrame:
    """The distinct keys of a label with their ``vid``; rows that share a key share its number."""
    keys = scratch.keep(frame.where(quoted(key).isNotNull()).select(quoted(key)).distinct(), "keys")
    return numbered(keys, [key], "vid", scratch, rows_per_range=rows_per_range)


def chunk_of(vid: str, size: int):
    """Number of the chunk that holds a vertex."""
    return F.expr(f"`{vid}` div {int(size)}L").alias("vertex_chunk")
