"""Rows that a load leaves out, with the reason and the row as its source holds it.

Reasons are found in the pass that reads the rows and written beside the rows that stay,
so the source is not read again: input = kept rows + rejects.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from weftgraph.functions.types import fresh, quoted
from weftgraph.operators.checks import row_checks
from weftgraph.operators.index import distinct_keys
from weftgraph.scratch import Scratch
from weftgraph.spec import FieldPlan

# Faults of a row by itself, by the check that finds it; of several the first counts.
ROW_REASONS = {
    "malformed_rows": "malformed_row",
    "lost_cells": "lost_cell",
    "null_keys": "null_key",
    "out_of_range": "out_of_range",
}
REPEATED_KEY = "repeated_key"
# Faults of an edge's ends.
NULL_SOURCE, NULL_DESTINATION = "null_source", "null_destination"
NO_SOURCE, NO_DESTINATION = "no_source", "no_destination"
END_REASONS = (NULL_SOURCE, NULL_DESTINATION, NO_SOURCE, NO_DESTINATION)

REJECT_COLUMNS = [["reason", "string"], ["raw", "string"]]


@dataclass(frozen=True)
class Sorted:
    """Rows that stay, and ``rejects`` (reason, raw) with their numbers by reason."""

    kept: DataFrame
    rows: int
    rejects: DataFrame
    counts: dict[str, int]


def as_json(row: Column) -> Column:
    return F.to_json(row, {"ignoreNullFields": "false"})


def judged(both: DataFrame, fields: Sequence[FieldPlan], keys: Sequence[str]) -> tuple[DataFrame, str]:
    """The typed columns of ``side_by_side`` rows, and the name of a column more: a struct of ``reason`` and ``raw``, null for good rows."""
    checks = row_checks(fields, keys, malformed=True)
    reason = F.coalesce(*[F.when(checks[check], reason) for check, reason in ROW_REASONS.items() if check in checks])
    raw = F.coalesce("line", as_json(F.col("raw")))
    name = fresh("rejected", [f.name for f in fields])
    typed = [F.col("typed").getField(f.name).alias(f.name) for f in fields]
    return both.select(*typed, F.when(reason.isNotNull(), F.struct(reason.alias("reason"), raw.alias("raw"))).alias(name)), name


def split_vertices(frame: DataFrame, rejected: str, key: str, scratch: Scratch) -> Sorted:
    """Vertices whose rows and keys are good. All rows of a key that several hold are rejected, since none is the right one."""
    written = scratch.keep(frame, "judged")
    own = [c for c in frame.columns if c != rejected]
    good = written.where(quoted(rejected).isNull()).select(*[quoted(c) for c in own])
    rejects = written.where(quoted(rejected).isNotNull()).select(F.col(f"`{rejected}`.reason"), F.col(f"`{rejected}`.raw"))
    repeated = scratch.keep(distinct_keys(good, key).where("copies > 1").select("key"), "repeated")
    if not repeated.isEmpty():
        # The caller's columns stay inside one struct, out of the way of the helper columns.
        rows = good.select(F.struct(*[quoted(c) for c in own]).alias("row"), quoted(key).alias("key"))
        also = rows.join(repeated, "key", "left_semi").select(F.lit(REPEATED_KEY).alias("reason"), as_json(F.col("row")).alias("raw"))
        rejects = rejects.unionByName(also)
        good = rows.join(repeated, "key", "left_anti").select("row.*")
    counts = _counts(rejects)
    return Sorted(good, written.count() - sum(counts.values()), rejects, counts)


def split_edges(matched: DataFrame, ends: Sequence[str], rejected: str | None, scratch: Scratch) -> Sorted:
    """Edges with both vertices, from rows of ``matched_edges`` (``row``, ``src_vid``, ``dst_vid``): src_vid, dst_vid, properties, edge_row.

    All rows are written in one pass, and read again as kept edges, rejects and counts.
    ``edge_row`` makes every row distinct, so that even a long run of equal edges can be
    cut into ranges.
    """
    of_row = F.col("row").getField
    own = [f.name for f in matched.schema["row"].dataType if f.name != rejected]
    properties = [c for c in own if c not in ends]
    src, dst = (of_row(end) for end in ends)
    reason = (
        F.when(src.isNull(), NULL_SOURCE)
        .when(dst.isNull(), NULL_DESTINATION)
        .when(F.col("src_vid").isNull(), NO_SOURCE)
        .when(F.col("dst_vid").isNull(), NO_DESTINATION)
    )
    raw = as_json(F.struct(*[of_row(c).alias(c) for c in own]))
    if rejected:
        reason = F.coalesce(of_row(rejected).getField("reason"), reason)
        raw = F.coalesce(of_row(rejected).getField("raw"), raw)
    fault = fresh("fault", properties)
    written = scratch.keep(
        matched.select(
            "src_vid",
            "dst_vid",
            *[of_row(c).alias(c) for c in properties],
            F.monotonically_increasing_id().alias("edge_row"),
            F.when(reason.isNotNull(), F.struct(reason.alias("reason"), raw.alias("raw"))).alias(fault),
        ),
        "edges",
    )
    is_kept = quoted(fault).isNull()
    rejects = written.where(~is_kept).select(F.col(f"`{fault}`.reason"), F.col(f"`{fault}`.raw"))
    by_reason = {r["reason"]: r["count"] for r in written.groupBy(F.col(f"`{fault}`.reason").alias("reason")).count().collect()}
    rows = by_reason.pop(None, 0)
    return Sorted(written.where(is_kept).drop(fault), rows, rejects, by_reason)


def _counts(rejects: DataFrame) -> dict[str, int]:
    return {r["reason"]: r["count"] for r in rejects.groupBy("reason").count().collect()}
