"""Reading the inputs of a mapping as one frame."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from weftgraph.functions.types import cast_to, quoted, spark_type
from weftgraph.sources.files import MALFORMED, input_path, parsed_cells, read_columnar, read_csv
from weftgraph.sources.tables import read_table
from weftgraph.spec import DataSource, FieldPlan


def read_inputs(
    spark: SparkSession,
    source: DataSource,
    inputs: Sequence[str],
    fields: Sequence[FieldPlan],
    on_error: str | None = None,
) -> DataFrame:
    """UNION ALL of the inputs, projected to ``fields`` under their declared types and names.

    ``on_error`` "raise" fails on a cell that does not fit its type, "null" makes it
    null; without it CSV cells become null and casts of other sources fail.
    """
    if is_csv(source):
        if on_error == "raise":
            return strict_cells(spark, source, inputs, fields)
        # One scan for files that are different: the plan does not grow with their number.
        lots = [inputs] if len(set(inputs)) == len(inputs) else [[i] for i in inputs]
        frames = [
            read_csv(spark, [input_path(source.location, i) for i in lot], fields, source.options) for lot in lots
        ]
        return project(reduce(DataFrame.unionByName, frames), fields, "null")
    frames = [project(read_source(spark, source, i, fields), fields, on_error or "raise") for i in inputs]
    return reduce(DataFrame.unionByName, frames)


def is_csv(source: DataSource) -> bool:
    return source.kind == "file" and source.file_format == "csv"


def side_by_side(
    spark: SparkSession, source: DataSource, inputs: Sequence[str], fields: Sequence[FieldPlan], malformed: bool = False
) -> DataFrame:
    """The inputs as structs ``raw``, cells as the source holds them, and ``typed``, null where they do not fit.

    ``malformed`` adds a column ``line``: the whole line of a CSV row that does not have
    the cells of its file, else null.
    """
    uncast, line = read_uncast(spark, source, inputs, fields, malformed), []
    if malformed:
        found = uncast[MALFORMED] if is_csv(source) else F.lit(None).cast("string")
        line = [found.alias("line")]
    raw = F.struct(*[quoted(f.name) for f in fields]).alias("raw")
    if is_csv(source):
        parsed = parsed_cells({f.name: quoted(f.name) for f in fields}, fields, source.options).alias("p")
        both = uncast.select(raw, parsed, *line)
        typed = [F.col("p").getField(f"c{i}").alias(f.name) for i, f in enumerate(fields)]
        return both.select("raw", F.struct(*typed).alias("typed"), *both.columns[2:])
    kinds = {part.name: part.dataType for part in uncast.schema}
    typed = [cast_to(quoted(f.name), kinds[f.name], f.type, "null").alias(f.name) for f in fields]
    return uncast.select(raw, F.struct(*typed).alias("typed"), *line)


def strict_cells(
    spark: SparkSession, source: DataSource, inputs: Sequence[str], fields: Sequence[FieldPlan]
) -> DataFrame:
    """CSV inputs under their types; a cell that the parser cannot read fails the job."""
    both = side_by_side(spark, source, inputs, fields)
    columns = []
    for f in fields:
        raw, typed = F.col("raw").getField(f.name), F.col("typed").getField(f.name)
        failed = F.raise_error(F.concat(F.lit(f"{f.column} is no {f.type}: "), raw)).cast(spark_type(f.type))
        columns.append(F.when(raw.isNotNull() & typed.isNull(), failed).otherwise(typed).alias(f.name))
    return both.select(*columns)


def read_uncast(
    spark: SparkSession, source: DataSource, inputs: Sequence[str], fields: Sequence[FieldPlan], malformed: bool = False
) -> DataFrame:
    """UNION ALL of the inputs under their final names, with the cells as the source holds them."""
    frames, more = [], [MALFORMED] if malformed and is_csv(source) else []
    for name in inputs:
        if is_csv(source):
            path = input_path(source.location, name)
            frame = read_csv(spark, [path], fields, source.options, as_text=True, malformed=malformed)
        else:
            frame = read_source(spark, source, name, fields)
        frames.append(frame.select(*[quoted(f.column).alias(f.name) for f in fields], *more))
    return reduce(DataFrame.unionByName, frames)


def read_source(spark: SparkSession, source: DataSource, name: str, fields: Sequence[FieldPlan]) -> DataFrame:
    """One input as a frame that still has its source columns."""
    if source.kind == "table":
        return read_table(spark, input_path(source.location, name))
    path = input_path(source.location, name)
    if source.file_format == "csv":
        return read_csv(spark, [path], fields, source.options)
    return read_columnar(spark, path, source.file_format)


def project(frame: DataFrame, fields: Sequence[FieldPlan], on_error: str = "raise") -> DataFrame:
    """Select, cast and rename the mapped columns; nothing else leaves the source."""
    columns = list(dict.fromkeys(f.column for f in fields))
    chosen = frame.select(*[quoted(c) for c in columns])
    type_of = {c: part.dataType for c, part in zip(columns, chosen.schema)}
    return chosen.select(
        *[cast_to(quoted(f.column), type_of[f.column], f.type, on_error).alias(f.name) for f in fields]
    )
