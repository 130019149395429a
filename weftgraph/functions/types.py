"""Declared property types and the casts to them."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, functions as F, types as T

# The declared type names and what each is stored as.
STORED_AS: dict[str, T.DataType] = {
    "DT_SIGNED_INT64": T.LongType(),
    "DT_SIGNED_INT32": T.IntegerType(),
    "DT_STRING": T.StringType(),
    "DT_STRINGMAP": T.StringType(),
    "DT_DOUBLE": T.DoubleType(),
    "DT_BOOL": T.BooleanType(),
    "DT_SIGNED_INT8": T.IntegerType(),
    "DT_UNSIGNED_INT8": T.IntegerType(),
    "DT_SIGNED_INT16": T.IntegerType(),
    "DT_UNSIGNED_INT16": T.IntegerType(),
}

# The range of each type that is stored wider than declared.
DECLARED_RANGE: dict[str, tuple[int, int]] = {
    "DT_SIGNED_INT8": (-128, 127),
    "DT_UNSIGNED_INT8": (0, 255),
    "DT_SIGNED_INT16": (-32768, 32767),
    "DT_UNSIGNED_INT16": (0, 65535),
}

MILLIS_PER_DAY = 86_400_000
MILLIS_BEFORE_1970 = 719_162 * MILLIS_PER_DAY


def spark_type(declared: str) -> T.DataType:
    """The Spark type of a declared name; names match exactly."""
    try:
        return STORED_AS[declared]
    except KeyError:
        raise ValueError(f"unsupported property type {declared!r}") from None


def quoted(name: str) -> Column:
    """A column by its exact name, dots included."""
    return F.col("`" + name.replace("`", "``") + "`")


def fresh(name: str, taken: Iterable[str]) -> str:
    """The name, lengthened until no column has it."""
    used = {t.lower() for t in taken}
    while name.lower() in used:
        name += "_"
    return name


def cast_to(column: Column, source: T.DataType, declared: str, on_error: str = "raise") -> Column:
    """Cast to the declared type; dates and timestamps become epoch milliseconds in 64 bits.

    ``on_error="null"`` turns a value that cannot be cast into null instead of
    failing the job.
    """
    target = spark_type(declared)
    if isinstance(target, T.LongType) and isinstance(source, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return epoch_millis(column, source)
    if source == target:
        return column
    return column.try_cast(target) if on_error == "null" else column.cast(target)


def epoch_millis(column: Column, source: T.DataType) -> Column:
    if isinstance(source, T.TimestampType):
        return F.unix_millis(column)
    if isinstance(source, T.DateType):
        return F.unix_date(column).cast("bigint") * MILLIS_PER_DAY
    # Counted from year 1 as an interval, so the session zone plays no part and the count is not negative.
    since = column - F.lit("0001-01-01").cast("timestamp_ntz")
    seconds = since.cast("bigint")
    rest = since - F.expr("INTERVAL '1' SECOND") * seconds
    return seconds * 1000 + (rest * 1000).cast("bigint") - MILLIS_BEFORE_1970
