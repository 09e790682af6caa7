"""Scalar rules: dates to epoch milliseconds, decimals to one type, the rest unchanged."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from entityframe.functions.numbering import column
from entityframe.options import ScanOptions

MILLIS_PER_DAY = 86_400_000


def epoch_millis(col: Column, dtype: T.DataType) -> Column:
    """Milliseconds since 1970-01-01 UTC, rounded down.

    A zone-less value is read as UTC whatever the session zone is.
    """
    if isinstance(dtype, T.TimestampType):
        return F.unix_millis(col)
    days = F.unix_date(col.cast("date")).cast("bigint") * MILLIS_PER_DAY
    if isinstance(dtype, T.DateType):
        return days
    seconds = F.date_part(F.lit("SECOND"), col)  # decimal(8,6)
    return (
        days
        + F.hour(col).cast("bigint") * 3_600_000
        + F.minute(col) * 60_000
        + F.floor(seconds * 1000).cast("bigint")
    )


def converted_type(dtype: T.DataType, options: ScanOptions) -> T.DataType:
    if isinstance(dtype, T.StructType):
        return T.StructType(
            [
                T.StructField(f.name, converted_type(f.dataType, options), f.nullable, f.metadata)
                for f in dtype.fields
            ]
        )
    if isinstance(dtype, T.ArrayType):
        return T.ArrayType(converted_type(dtype.elementType, options), dtype.containsNull)
    if options.dates == "epoch_millis" and isinstance(
        dtype, (T.DateType, T.TimestampType, T.TimestampNTZType)
    ):
        return T.LongType()
    target = options.decimal_type
    if isinstance(dtype, T.DecimalType) and target is not None:
        holds = (
            dtype.scale <= target.scale
            and dtype.precision - dtype.scale <= target.precision - target.scale
        )
        # The default target never costs digits; one that was asked for may.
        if holds or options.decimal_forced:
            return target
    return dtype


def convert(col: Column, dtype: T.DataType, options: ScanOptions) -> Column:
    """``col`` under the rules; the same expression when nothing below it changes."""
    target = converted_type(dtype, options)
    if target == dtype:
        return col
    if isinstance(dtype, T.StructType):
        fields = [
            convert(col.getField(f.name), f.dataType, options).alias(f.name) for f in dtype.fields
        ]
        # A null struct must not become a struct of nulls.
        return F.when(col.isNotNull(), F.struct(*fields))
    if isinstance(dtype, T.ArrayType):
        return F.transform(col, lambda item: convert(item, dtype.elementType, options))
    if isinstance(dtype, T.DecimalType):
        return col.cast(target)
    return epoch_millis(col, dtype)


def converted_columns(schema: T.StructType, options: ScanOptions) -> list[Column]:
    """All columns of ``schema`` under the rules; unchanged ones keep their metadata."""
    columns = []
    for f in schema.fields:
        raw = column(f.name)
        changed = converted_type(f.dataType, options) != f.dataType
        columns.append(convert(raw, f.dataType, options).alias(f.name) if changed else raw)
    return columns
