"""Row projection: every column converted by its type, or projected to a stated schema."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from entityframe.functions.typing import converted_columns
from entityframe.options import ScanOptions


def coerce(df: DataFrame, options: ScanOptions = ScanOptions()) -> DataFrame:
    """Convert dates and decimals at any depth; unchanged columns pass through."""
    return df.select(*converted_columns(df.schema, options))


def project(df: DataFrame, schema: T.StructType) -> DataFrame:
    """One cell per field of ``schema``, in its order; a field the rows lack is null."""
    return df.to(schema)
