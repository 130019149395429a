"""File scans: CSV with a declared schema, Parquet, ORC, and plain text lines.

Paths go to Spark as they are, so any Hadoop URI works (local disk, HDFS,
object stores).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession, functions as F, types as T

from weftgraph.functions.types import quoted, spark_type
from weftgraph.spec import FieldPlan

PLACEHOLDER = "_unmapped_"
# Spark only looks for rows of the wrong width where a column of this name is read.
MALFORMED = "_corrupt_record"


def input_path(location: str, name: str) -> str:
    return f"{location.rstrip('/')}/{name}" if location else name


def read_csv(
    spark: SparkSession,
    paths: Sequence[str],
    fields: Sequence[FieldPlan],
    options: Mapping[str, str],
    as_text: bool = False,
    malformed: bool = False,
) -> DataFrame:
    """Scan CSV files under the declared types, without inference.

    Columns bind by position: by the mapping's ``index`` where the indexes are
    all different, else in mapping order. Header names are not compared.
    ``as_text`` reads every cell as text, for the check of lost cells. ``malformed`` adds
    a column ``MALFORMED`` with the whole line where a row has more or fewer cells than
    the first line of its file, as after a quote that is not closed; else it is null.
    """
    types = {f.column: {spark_type(g.type) for g in fields if g.column == f.column} for f in fields}
    fields = list({f.column: f for f in fields}.values())
    # A column with several types is read as text; each property then casts it for itself.
    declared = {
        at: T.StructField(f.column, T.StringType() if as_text or len(types[f.column]) > 1 else min(types[f.column], key=str))
        for at, f in zip(positions(fields), fields)
    }
    width = max(declared, default=-1) + 1
    if malformed:
        options = {**options, "mode": "PERMISSIVE"}
        width = max([width, *[len(csv_reader(spark, options).csv(path).columns) for path in paths[:1]]])
    gaps = (T.StructField(f"{PLACEHOLDER}{i}", T.StringType()) for i in range(width))
    schema = T.StructType([declared.get(i, gap) for i, gap in enumerate(gaps)])
    if malformed:
        schema.add(MALFORMED, T.StringType())
    frame = csv_reader(spark, options).schema(schema).csv(list(paths))
    if not malformed:
        return frame.select(*[quoted(f.column) for f in fields])
    # Spark misses such rows where it reads some of the cells only, so the line is tied to all of them.
    some_cell = F.coalesce(*[quoted(part.name) for part in schema if part.name != MALFORMED])
    line = F.when(F.col(MALFORMED).isNotNull() | some_cell.isNull(), F.col(MALFORMED))
    return frame.select(*[quoted(f.column) for f in fields], line.alias(MALFORMED))


def positions(fields: Sequence[FieldPlan]) -> list[int]:
    indexes = [f.index for f in fields]
    if len(set(indexes)) == len(indexes):
        return indexes
    return list(range(len(indexes)))


def csv_reader(spark: SparkSession, options: Mapping[str, str]) -> DataFrameReader:
    """The dialect: ``|`` between cells and a header row unless the options say otherwise."""
    reader = (
        spark.read.option("sep", options.get("delimiter", "|"))
        .option("header", options.get("header_row", "true") in ("true", "TRUE"))
        .option("inferSchema", False)
        .option("enforceSchema", True)
        .option("mode", options.get("mode", "PERMISSIVE"))
    )
    quote = options.get("quote_char", '"')
    if options.get("quoting") == "false":
        return reader.option("quote", "")
    if "quote_char" in options:
        reader = reader.option("quote", quote)
    if options.get("escaping") != "false" and "escape_char" in options:
        reader = reader.option("escape", options["escape_char"])
    elif options.get("double_quote") == "true":
        reader = reader.option("escape", quote)
    return reader


def parsed_cells(cells: Mapping[str, Column], fields: Sequence[FieldPlan], options: Mapping[str, str]) -> Column:
    """Text cells (by name of the field) as the CSV parser reads them under the declared types: a struct, null where it cannot.

    The cells go through the parser once more, because a cast would take other
    texts for booleans and numbers than it does.
    """
    names = [f"c{i}" for i in range(len(fields))]
    kinds = ", ".join(f"{n} {spark_type(f.type).simpleString()}" for n, f in zip(names, fields))
    line = F.to_csv(F.struct(*[cells[f.name].alias(n) for n, f in zip(names, fields)]), _INNER)
    return F.from_csv(line, kinds, {**_INNER, "mode": "PERMISSIVE"})


# One dialect for cells that have left their file; white space stays as it is.
_INNER = {
    "sep": "|",
    "quoteAll": "true",
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def read_columnar(spark: SparkSession, path: str, file_format: str) -> DataFrame:
    return spark.read.format(file_format).load(path)


def count_lines(spark: SparkSession, path: str) -> DataFrame:
    """Number of text lines below a path, as a one-row frame."""
    return spark.read.text(path).groupBy().count().withColumnRenamed("count", "lines")
