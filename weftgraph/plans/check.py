"""Checking the sources of a graph before it is loaded."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from weftgraph.operators import checks
from weftgraph.operators.mapping import vertex_frame
from weftgraph.sources import side_by_side
from weftgraph.spec import (
    GraphSchema,
    ImportSpec,
    Triplet,
    edge_property_fields,
    endpoint_fields,
    key_column,
    validate,
    vertex_fields,
)


def vertex_checks(spark: SparkSession, schema: GraphSchema, spec: ImportSpec, label: str) -> dict[str, DataFrame]:
    """The offending rows of a label (structs ``raw`` and ``typed``), by name of the check; repeated keys as they are."""
    fields = vertex_fields(schema, spec, label)
    key = key_column(schema, spec, label)
    rows = side_by_side(spark, spec.source, spec.vertex(label).inputs, fields)
    found = {name: rows.where(condition) for name, condition in checks.row_checks(fields, [key]).items()}
    vertex = vertex_frame(spark, schema, spec, label, on_error="null")
    return found | {"duplicate_keys": checks.duplicate_keys(vertex.frame, vertex.key)}


def malformed_rows(spark: SparkSession, schema: GraphSchema, spec: ImportSpec, name: str | Triplet) -> DataFrame:
    """CSV rows of a label or triplet that do not have the cells of their file: the whole ``line``, and its ``fault``.

    The fault is ``unclosed_quote`` where the line has an odd number of quotes, else
    ``short_or_long``. The parser closes a quote that is still open in the last cell at the
    end of the line, so such a row has all its cells.
    """
    if isinstance(name, Triplet):
        inputs = spec.edge(name).inputs
        fields = [*endpoint_fields(schema, spec, name), *edge_property_fields(schema, spec, name)]
    else:
        inputs, fields = spec.vertex(name).inputs, vertex_fields(schema, spec, name)
    lines = side_by_side(spark, spec.source, inputs, fields, malformed=True).where("line IS NOT NULL").select("line")
    quote = F.lit(spec.source.options.get("quote_char", '"'))
    quotes = F.char_length("line") - F.char_length(F.replace("line", quote, F.lit("")))
    open_quote = (quotes % 2 == 1) & F.lit(spec.source.options.get("quoting") != "false")
    return lines.withColumn("fault", F.when(open_quote, "unclosed_quote").otherwise("short_or_long"))


def edge_checks(spark: SparkSession, schema: GraphSchema, spec: ImportSpec, triplet: Triplet) -> dict[str, DataFrame]:
    """The offending rows of a triplet (structs ``raw`` and ``typed``), by name of the check."""
    ends = endpoint_fields(schema, spec, triplet)
    fields = [*ends, *edge_property_fields(schema, spec, triplet)]
    rows = side_by_side(spark, spec.source, spec.edge(triplet).inputs, fields)
    return {name: rows.where(condition) for name, condition in checks.row_checks(fields, [e.name for e in ends]).items()}


def check_sources(spark: SparkSession, schema: GraphSchema, spec: ImportSpec, malformed: bool = False) -> DataFrame:
    """Number of offending rows per label or triplet and check.

    A type's rows are read once for all checks of single rows, and once more, its key
    alone, for repeated keys. ``malformed`` also counts CSV rows that do not have the
    cells of their file (``malformed_rows``); the cells that such rows lack or lose are
    not lost cells.
    """
    validate(schema, spec)
    counted = []
    for mapping in spec.vertices:
        label = mapping.label
        fields = vertex_fields(schema, spec, label)
        rows = side_by_side(spark, spec.source, mapping.inputs, fields, malformed)
        counted.append(_counts(rows, label, checks.row_checks(fields, [key_column(schema, spec, label)], malformed)))
        vertex = vertex_frame(spark, schema, spec, label, on_error="null")
        repeated = checks.duplicate_keys(vertex.frame, vertex.key)
        counted.append(_counts(repeated, label, {"duplicate_keys": F.lit(True)}))
    for mapping in spec.edges:
        ends = endpoint_fields(schema, spec, mapping.triplet)
        fields = [*ends, *edge_property_fields(schema, spec, mapping.triplet)]
        rows = side_by_side(spark, spec.source, mapping.inputs, fields, malformed)
        counted.append(_counts(rows, str(mapping.triplet), checks.row_checks(fields, [e.name for e in ends], malformed)))
    return reduce(DataFrame.unionByName, counted)


def _counts(rows: DataFrame, name: str, conditions: dict[str, Column]) -> DataFrame:
    """One row per condition with its number of rows, from one pass."""
    of_rows = rows.agg(*[F.count_if(condition).alias(check) for check, condition in conditions.items()])
    each = [F.struct(F.lit(check).alias("check"), F.col(check).alias("rows")) for check in conditions]
    return of_rows.select(F.lit(name).alias("name"), F.inline(F.array(*each)))
