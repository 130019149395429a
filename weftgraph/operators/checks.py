"""Data checks: each returns the offending rows as a frame."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from weftgraph.functions.types import DECLARED_RANGE, cast_to, fresh, quoted
from weftgraph.spec import FieldPlan


def null_keys(frame: DataFrame, key: str) -> DataFrame:
    return frame.where(quoted(key).isNull())


def duplicate_keys(frame: DataFrame, key: str) -> DataFrame:
    """Keys held by several rows, with their number; counted before the shuffle, so a hot key is one row."""
    copies = fresh("copies", [key])
    counted = frame.where(quoted(key).isNotNull()).groupBy(quoted(key)).agg(F.count(F.lit(1)).alias(copies))
    return counted.where(F.col(copies) > 1)


def is_out_of_range(values: Mapping[str, Column], declared: Mapping[str, str]) -> Column:
    """Whether one of the values (by column) is one that its declared 8/16-bit type cannot hold."""
    outside = [
        F.coalesce(~values[column].between(*DECLARED_RANGE[type_name]), F.lit(False))
        for column, type_name in declared.items()
        if type_name in DECLARED_RANGE
    ]
    return reduce(lambda a, b: a | b, outside, F.lit(False))


def out_of_range(frame: DataFrame, declared: Mapping[str, str]) -> DataFrame:
    """Rows with a value its declared 8/16-bit type cannot hold. ``declared`` maps column to type name."""
    return frame.where(is_out_of_range({c: quoted(c) for c in declared}, declared))


def lost_cells(frame: DataFrame, declared: Mapping[str, str]) -> DataFrame:
    """Rows with a non-null cell that the cast to its declared type turns into null.

    ``lost`` lists the columns concerned (under a longer name if the frame has such a column).
    """
    marks = [
        F.when(
            quoted(column).isNotNull()
            & cast_to(quoted(column), frame.select(quoted(column)).schema[0].dataType, type_name, "null").isNull(),
            F.lit(column),
        )
        for column, type_name in declared.items()
    ]
    lost = fresh("lost", frame.columns)
    return frame.withColumn(lost, F.array_compact(F.array(*marks))).where(F.size(lost) > 0)


def row_counts(frames: Mapping[str, DataFrame]) -> DataFrame:
    """One row per named frame with its number of rows."""
    counted = [
        frame.groupBy().agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("name"), "rows")
        for name, frame in frames.items()
    ]
    return reduce(DataFrame.unionByName, counted)


def row_checks(fields: Sequence[FieldPlan], keys: Sequence[str], malformed: bool = False) -> dict[str, Column]:
    """Conditions on the rows of ``side_by_side``, by name of the check."""
    raw = {f.name: F.col("raw").getField(f.name) for f in fields}
    typed = {f.name: F.col("typed").getField(f.name) for f in fields}
    lost = reduce(lambda a, b: a | b, [raw[f.name].isNotNull() & typed[f.name].isNull() for f in fields], F.lit(False))
    is_malformed = F.col("line").isNotNull() if malformed else F.lit(False)
    shape = {"malformed_rows": is_malformed} if malformed else {}
    return shape | {
        "null_keys": reduce(lambda a, b: a | b, [typed[k].isNull() for k in keys], F.lit(False)),
        "out_of_range": is_out_of_range(typed, {f.name: f.type for f in fields}),
        "lost_cells": lost & ~is_malformed,
    }
