"""Vertex and edge frames as the mapping declares them."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from weftgraph.operators.rejects import judged
from weftgraph.sources import read_inputs, side_by_side
from weftgraph.spec import (
    GraphSchema,
    ImportSpec,
    Triplet,
    edge_property_fields,
    endpoint_fields,
    key_column,
    vertex_fields,
)


@dataclass(frozen=True)
class VertexFrame:
    label: str
    frame: DataFrame
    key: str
    # Where bad rows are kept apart: the column that says why a row is to be left out.
    rejected: str | None = None


@dataclass(frozen=True)
class EdgeFrame:
    """An edge table whose first two columns are the endpoint keys."""

    triplet: Triplet
    frame: DataFrame
    src: str
    dst: str
    rejected: str | None = None


def vertex_frame(
    spark: SparkSession,
    schema: GraphSchema,
    spec: ImportSpec,
    label: str,
    naming: str = "property",
    on_error: str | None = None,
) -> VertexFrame:
    """All inputs of a label; columns carry property names, or source names with ``naming="source"``.

    ``on_error="reject"`` keeps every row and adds a column that says which are bad and why.
    """
    fields = vertex_fields(schema, spec, label, naming)
    key, inputs = key_column(schema, spec, label, naming), spec.vertex(label).inputs
    if on_error == "reject":
        frame, rejected = judged(side_by_side(spark, spec.source, inputs, fields, malformed=True), fields, [key])
        return VertexFrame(label, frame, key, rejected)
    return VertexFrame(label, read_inputs(spark, spec.source, inputs, fields, on_error), key)


def edge_frame(
    spark: SparkSession,
    schema: GraphSchema,
    spec: ImportSpec,
    triplet: Triplet,
    naming: str = "property",
    on_error: str | None = None,
) -> EdgeFrame:
    """All inputs of a triplet: source key, destination key, then the properties."""
    src, dst = endpoint_fields(schema, spec, triplet, naming)
    fields, inputs = [src, dst, *edge_property_fields(schema, spec, triplet, naming)], spec.edge(triplet).inputs
    if on_error == "reject":
        # Null ends are found with the ends that no vertex has.
        frame, rejected = judged(side_by_side(spark, spec.source, inputs, fields, malformed=True), fields, [])
        return EdgeFrame(triplet, frame, src.name, dst.name, rejected)
    return EdgeFrame(triplet, read_inputs(spark, spec.source, inputs, fields, on_error), src.name, dst.name)
