"""Catalog table scans, whole or limited to a partition named in the input."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from weftgraph.functions.types import quoted
from weftgraph.spec import SpecError


def table_and_partitions(name: str) -> tuple[str, list[tuple[str, str]]]:
    """Split ``[project/]table[/p=v ...]`` into the table and its partition equalities."""
    parts = name.split("/")
    equalities = []
    while len(parts) > 1 and "=" in parts[-1]:
        column, _, value = parts.pop().partition("=")
        if not column or not value:
            raise SpecError(f"input {name!r}: a partition needs a name and a value")
        equalities.insert(0, (column, value))
    if len(parts) > 2 or not all(parts) or any("=" in p for p in parts):
        raise SpecError(f"input {name!r} is not [project/]table[/partition=value ...]")
    return parts[-1], equalities


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """Scan a table or view; the equalities reach the scan as typed literals, so partitions are pruned."""
    table, equalities = table_and_partitions(name)
    frame = spark.table(table)
    for column, value in equalities:
        of_column = frame.select(quoted(column)).schema[0].dataType
        frame = frame.where(quoted(column) == F.lit(value).cast(of_column))
    return frame
