"""Structs to ``parent_child`` columns and arrays to ``parent_0_child`` columns.

A flatten is one ``select``: no Python runs per row, nothing is shuffled, and
filters and column pruning still reach the scan through the flat names.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping
from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from entityframe.functions.numbering import column
from entityframe.functions.paths import (
    ELEMENT,
    SOURCE_PATH,
    FlatColumn,
    array_paths,
    check_collisions,
    path_text,
    walk,
)
from entityframe.functions.typing import convert, converted_columns
from entityframe.options import FieldPath, OptionError, ScanOptions, as_path, parse_offsets


Measure = tuple[FieldPath, Callable[[Column], Column]]

# Cheapest to read first; an array is counted through one of these instead of whole elements.
_NARROW = [
    T.BooleanType,
    T.ByteType,
    T.ShortType,
    T.IntegerType,
    T.DateType,
    T.FloatType,
    T.LongType,
    T.DoubleType,
    T.TimestampType,
    T.TimestampNTZType,
    T.DecimalType,
    T.StringType,
]


def _length(array: Column, dtype: T.ArrayType) -> Column:
    """Array size, read from one narrow leaf of its elements where there is one."""
    element = dtype.elementType
    if isinstance(element, T.StructType):
        leaves = [f for f in element.fields if type(f.dataType) in _NARROW]
        if leaves:
            leaf = min(leaves, key=lambda f: _NARROW.index(type(f.dataType)))
            return F.array_size(array.getField(leaf.name))
    return F.array_size(array)


def _measures(dtype: T.DataType, path: FieldPath) -> list[Measure]:
    """Array paths in a value of ``dtype``, each with its size in terms of the value."""
    if isinstance(dtype, T.StructType):
        return [
            (p, lambda v, g=g, name=f.name: g(v.getField(name)))
            for f in dtype.fields
            for p, g in _measures(f.dataType, (*path, f.name))
        ]
    if isinstance(dtype, T.ArrayType):
        return [(path, lambda v: _length(v, dtype)), *_element_measures(dtype.elementType, path)]
    return []


def _element_measures(dtype: T.DataType, path: FieldPath) -> list[Measure]:
    """The same for arrays inside the elements of an array, in terms of that array: the largest.

    Fields are taken from the array of structs as a whole, outside any lambda,
    so that the scan is pruned to them.
    """
    if isinstance(dtype, T.StructType):
        return [
            (p, lambda a, g=g, name=f.name: g(a.getField(name)))
            for f in dtype.fields
            for p, g in _element_measures_of(f.dataType, (*path, f.name))
        ]
    return _element_measures_of(dtype, (*path, ELEMENT))


def _element_measures_of(dtype: T.DataType, path: FieldPath) -> list[Measure]:
    if isinstance(dtype, T.StructType):
        return _element_measures(dtype, path)
    if isinstance(dtype, T.ArrayType):
        return [
            (p, lambda a, g=g: F.array_max(F.transform(a, lambda item: g(item))))
            for p, g in _measures(dtype, path)
        ]
    return []


Offsets = Mapping[FieldPath, str]


def check_offsets(schema: T.StructType, offsets: Offsets) -> None:
    """Offsets must be whole-number columns of the record, for arrays of its schema."""
    unknown = set(offsets) - set(array_paths(schema))
    if unknown:
        raise OptionError(f"arrayOffsets names no array: {sorted('.'.join(p) for p in unknown)}")
    for name in offsets.values():
        if name not in schema.names or not isinstance(schema[name].dataType, T.IntegralType):
            raise OptionError(f"arrayOffsets needs a column of whole numbers, which {name!r} is not")


def largest_sizes(schema: T.StructType, offsets: Offsets | None = None) -> list[tuple[FieldPath, Column]]:
    """For each array path of the schema, how far one row reaches there: its size, and what lies before a part."""
    offsets = offsets or {}
    check_offsets(schema, offsets)
    reached = []
    for f in schema.fields:
        for path, measure in _measures(f.dataType, (f.name,)):
            size = measure(column(f.name))
            reached.append((path, (size + column(offsets[path])).cast("int") if path in offsets else size))
    return reached


def array_profile(df: DataFrame, offsets: Offsets | None = None) -> DataFrame:
    """``path`` and ``max_size`` of every array: one aggregate over the input.

    An array inside array elements gets the largest size over all elements; one
    that is always empty or null gets 0. With ``offsets``, arrays that continue in further
    rows are measured whole, as the last part ends where the array does.
    """
    sizes = largest_sizes(df.schema, offsets)
    entries = [
        F.struct(
            F.lit(".".join(path)).alias("path"),
            F.coalesce(F.col(f"s{i}"), F.lit(0)).alias("max_size"),
        )
        for i, (path, _) in enumerate(sizes)
    ]
    if not entries:
        return df.sparkSession.createDataFrame([], "path string, max_size int")
    widest = df.agg(*(F.max(size).alias(f"s{i}") for i, (_, size) in enumerate(sizes)))
    return widest.select(F.explode(F.array(*entries)).alias("e")).select("e.path", "e.max_size")


def first_rows(df: DataFrame, order_by, count: int = 1) -> DataFrame:
    """The first ``count`` rows in key order, rows without a key last: a top-k, never a full sort."""
    if not order_by:
        raise OptionError("orderBy is required to say which row is first")
    return df.orderBy(*(column(name).asc_nulls_last() for name in order_by)).limit(count)


def measure_sizes(df: DataFrame, offsets: Offsets | None = None) -> dict[FieldPath, int]:
    """Sizes of all arrays over all rows, as one collected row of integers."""
    sizes = largest_sizes(df.schema, offsets)
    if not sizes:
        return {}
    row = df.agg(*(F.max(size).alias(f"s{i}") for i, (_, size) in enumerate(sizes))).first()
    return {path: row[i] or 0 for i, (path, _) in enumerate(sizes)}


def resolve_sizes(df: DataFrame, policy, order_by=(), offsets: Offsets | None = None) -> dict[FieldPath, int]:
    """Array widths for ``max`` (one pass over the arrays), ``first`` (one top-k row) or stated
    sizes (no job). Stated sizes must name arrays of the schema."""
    if policy == "max":
        return measure_sizes(df, offsets)
    if policy == "first":
        return measure_sizes(first_rows(df, order_by), offsets)
    if not isinstance(policy, Mapping):
        raise OptionError(f"arraySizes must be max, first or a mapping, not {policy!r}")
    sizes = {as_path(path): size for path, size in policy.items()}
    unknown = set(sizes) - set(array_paths(df.schema))
    if unknown:
        raise OptionError(f"arraySizes names no array: {sorted('.'.join(p) for p in unknown)}")
    return sizes


def flat_columns(df: DataFrame, options: ScanOptions) -> list[FlatColumn]:
    """The flat columns ``flatten`` would add, before any is built."""
    if not options.expand_structs:
        return []
    stated = isinstance(options.array_sizes, Mapping)
    sizes = (
        resolve_sizes(df, options.array_sizes, options.order_by, dict(options.array_offsets))
        if (options.expand_arrays or stated) and array_paths(df.schema)
        else {}
    )
    flat = walk(df.schema, sizes, options.expand_arrays, options.max_flat_columns)
    case_sensitive = df.sparkSession.conf.get("spark.sql.caseSensitive") == "true"
    check_collisions(flat, df.columns if options.keep_nested else [], case_sensitive)
    return flat


def flatten(df: DataFrame, options: ScanOptions | None = None, **changes) -> DataFrame:
    """Flatten ``df`` under ``options``, whose fields may also be given as keywords.

    The nested columns stay, and the flat ones are appended (``keep_nested``).
    Dates and decimals are converted on the way, kept columns included, so the
    flat columns still read only their own leaf from the scan.
    """
    options = _with(options or ScanOptions(), changes)
    offsets = dict(options.array_offsets)
    check_offsets(df.schema, offsets)
    flat = flat_columns(df, options)
    if not options.expand_structs or options.keep_nested:
        kept = converted_columns(df.schema, options)
        flat = [item for item in flat if not item.is_root]
    else:
        kept = []
    return df.select(
        *kept,
        *(
            convert(item.raw(offsets), item.dtype, options).alias(item.name, metadata=item.metadata)
            for item in flat
        ),
    )


def lineage(df: DataFrame) -> list[tuple[str, str]]:
    """``(flat name, source path)`` of the flat columns of a flattened frame."""
    return [
        (f.name, path_text(tuple(json.loads(f.metadata[SOURCE_PATH]))))
        for f in df.schema.fields
        if SOURCE_PATH in f.metadata
    ]


def _with(options: ScanOptions, changes: dict) -> ScanOptions:
    if "decimal_type" in changes:
        changes = {"decimal_forced": True, **changes}
    if "array_offsets" in changes:
        changes = {**changes, "array_offsets": parse_offsets(changes["array_offsets"])}
    return replace(options, **changes)
