"""Schema inference over JSON text, and schema merging.

Spark's variant aggregate does the scan: it is one partially aggregated pass
whose result is a single type, and, unlike the JSON reader, it keeps "never
seen a value" apart from "string". A field that is null, an empty array or an
empty object in some rows takes the type it has in the others.
"""

from __future__ import annotations

import re
from collections.abc import Mapping
from contextlib import contextmanager
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from entityframe.functions.numbering import column, fresh_name
from entityframe.operators.flatten import first_rows

_TOKEN = re.compile(r"\s*(?:`((?:[^`]|``)*)`|([^\s<>:,()`]+)|([<>:,()]))")


DOUBLE_DIGITS = 15  # any decimal of as many digits survives a double


class SchemaConflict(ValueError):
    """A field has types that have no common form."""


Steps = tuple[str | None, ...]  # field names; None stands for the elements of an array


class Digits(NamedTuple):
    """The most digits of any number of a field: before the point, after it, and both without zeros at the ends."""

    whole: int = 0
    fraction: int = 0
    significant: int = 0


def variant_type(
    text: str,
    on_conflict: str = "fail",
    decimals: bool = False,
    digits: Mapping[Steps, T.DecimalType | None] | None = None,
) -> T.DataType:
    """The Spark type for a variant schema such as ``OBJECT<a: BIGINT, b: ARRAY<VOID>>``; see ``resolved``."""
    return resolved(observed_type(text), on_conflict, decimals, digits)


def observed_type(text: str) -> T.DataType:
    """A variant schema as a type: unknown is void, values of different kinds are a variant."""
    tokens = [(m[1], m[2], m[3]) for m in _TOKEN.finditer(text)]
    at = 0

    def take(mark=None):
        nonlocal at
        name, word, punctuation = tokens[at]
        if mark is not None and punctuation != mark:
            raise ValueError(f"unexpected variant schema: {text}")
        at += 1
        return name.replace("``", "`") if name is not None else word or punctuation

    def peek():
        return tokens[at][2] if at < len(tokens) else None

    def parse():
        word = take()
        if word == "OBJECT":
            fields = []
            take("<")
            while peek() != ">":
                name = take()
                take(":")
                fields.append(T.StructField(name, parse()))
                if peek() == ",":
                    take()
            take(">")
            return T.StructType(fields)
        if word == "ARRAY":
            take("<")
            inner = parse()
            take(">")
            return T.ArrayType(inner)
        if word == "DECIMAL":
            take("(")
            precision = int(take())
            take(",")
            scale = int(take())
            take(")")
            return T.DecimalType(precision, scale)
        return _VARIANT_SCALARS[word]

    return parse()


def resolved(
    dtype: T.DataType,
    on_conflict: str = "fail",
    decimals: bool = False,
    digits: Mapping[Steps, T.DecimalType | None] | None = None,
    steps: Steps = (),
) -> T.DataType:
    """The type that an observed one is read as.

    ``digits`` tells of fields whose numbers may need more digits than a double
    holds which decimal takes them, or None where a double does; the
    schema alone cannot tell, as whole numbers beside fractions widen it.
    """
    digits = digits or {}
    if isinstance(dtype, T.StructType):
        return T.StructType(
            [
                T.StructField(f.name, resolved(f.dataType, on_conflict, decimals, digits, (*steps, f.name)))
                for f in dtype.fields
            ]
        )
    if isinstance(dtype, T.ArrayType):
        return T.ArrayType(resolved(dtype.elementType, on_conflict, decimals, digits, (*steps, None)))
    if isinstance(dtype, T.DecimalType):
        if decimals or (dtype.precision > DOUBLE_DIGITS and steps not in digits):
            return dtype
        return digits.get(steps) or T.DoubleType()
    if isinstance(dtype, T.VariantType):
        if on_conflict == "string":
            return T.StringType()
        raise SchemaConflict(f"{steps_text(steps) or 'the root'} has values of different kinds")
    return dtype


def merge_observed(left: T.DataType, right: T.DataType) -> T.DataType:
    """What all rows have together, from what two sets of rows have: as the variant aggregate merges its parts."""
    if isinstance(left, T.NullType) or left == right:
        return right
    if isinstance(right, T.NullType):
        return left
    if isinstance(left, T.StructType) and isinstance(right, T.StructType):
        fields = {f.name: f.dataType for f in left.fields}
        for f in right.fields:
            fields[f.name] = merge_observed(fields.get(f.name, T.NullType()), f.dataType)
        names = sorted(fields, key=lambda name: name.encode("utf-16-be"))
        return T.StructType([T.StructField(name, fields[name]) for name in names])
    if isinstance(left, T.ArrayType) and isinstance(right, T.ArrayType):
        return T.ArrayType(merge_observed(left.elementType, right.elementType))
    numbers = [t for t in (left, right) if isinstance(t, (T.LongType, T.DecimalType, T.DoubleType))]
    if len(numbers) < 2:
        return T.VariantType()
    one, two = (T.DecimalType(20, 0) if isinstance(t, T.LongType) else t for t in numbers)
    if isinstance(one, T.DoubleType) or isinstance(two, T.DoubleType):
        return T.DoubleType()
    scale = max(one.scale, two.scale)
    whole = max(one.precision - one.scale, two.precision - two.scale)
    return T.DecimalType(whole + scale, scale) if whole + scale <= 38 else T.DoubleType()


_VARIANT_SCALARS = {
    "VOID": T.NullType(),
    "BOOLEAN": T.BooleanType(),
    "BIGINT": T.LongType(),
    "FLOAT": T.FloatType(),
    "DOUBLE": T.DoubleType(),
    "STRING": T.StringType(),
    "BINARY": T.BinaryType(),
    "DATE": T.DateType(),
    "TIMESTAMP": T.TimestampType(),
    "TIMESTAMP_NTZ": T.TimestampNTZType(),
    "VARIANT": T.VariantType(),
}


def steps_text(steps: Steps) -> str:
    """``("line", None, "price")`` is shown as ``line[].price``."""
    return "".join("[]" if s is None else f".{s}" for s in steps).removeprefix(".")


def _wide_numbers(dtype: T.DataType, steps: Steps = ()) -> list[Steps]:
    """Fields of decimals that the schema alone gives more digits than a double holds."""
    if isinstance(dtype, T.StructType):
        return [p for f in dtype.fields for p in _wide_numbers(f.dataType, (*steps, f.name))]
    if isinstance(dtype, T.ArrayType):
        return _wide_numbers(dtype.elementType, (*steps, None))
    return [steps] if isinstance(dtype, T.DecimalType) and dtype.precision > DOUBLE_DIGITS else []


def _numeric_leaves(dtype: T.DataType, steps: Steps = ()) -> list[Steps]:
    if isinstance(dtype, T.StructType):
        return [p for f in dtype.fields for p in _numeric_leaves(f.dataType, (*steps, f.name))]
    if isinstance(dtype, T.ArrayType):
        return _numeric_leaves(dtype.elementType, (*steps, None))
    return [steps] if isinstance(dtype, (T.LongType, T.DecimalType, T.DoubleType)) else []


def as_variant(df: DataFrame, name: str, skip_unreadable: bool = False) -> Column:
    """A column of variants as it is, one of JSON text parsed; unreadable text fails or is null."""
    if isinstance(df.schema[name].dataType, T.VariantType):
        return column(name)
    return F.try_parse_json(column(name)) if skip_unreadable else F.parse_json(column(name))


def addressable(steps: Steps) -> bool:
    return not any(s is not None and "'" in s and '"' in s for s in steps)


def _field_of(name: str):
    quote = '"' if '"' not in name else "'"
    return lambda v: F.try_variant_get(v, f"$[{quote}{name}{quote}]", "variant")


def _numbers_at(value: Column, steps: Steps) -> Column:
    """The numbers a record has at ``steps``, as an array of texts."""
    found = F.array(value)
    for step in steps:
        if step is None:
            found = F.flatten(
                F.transform(found, lambda v: F.coalesce(F.try_variant_get(v, "$", "array<variant>"), F.array()))
            )
        else:
            found = F.transform(found, _field_of(step))
    return F.filter(F.transform(found, lambda v: F.try_variant_get(v, "$", "string")), lambda t: t.isNotNull())


def _digit_counts(texts: Column) -> dict[str, Column]:
    """The profile of a field whose numbers each record has as ``texts``."""

    def most(count) -> Column:
        return F.coalesce(F.array_max(F.transform(texts, lambda t: count(F.ltrim(t, F.lit("-"))))), F.lit(0))

    def whole(t: Column) -> Column:
        return F.ltrim(F.split_part(t, F.lit("."), F.lit(1)), F.lit("0"))

    def fraction(t: Column) -> Column:
        return F.rtrim(F.split_part(t, F.lit("."), F.lit(2)), F.lit("0"))

    return {
        "numbers": F.sum(F.size(texts).cast("bigint")),
        "whole_digits": F.max(most(lambda t: F.length(whole(t)))),
        "fraction_digits": F.max(most(lambda t: F.length(fraction(t)))),
        "significant_digits": F.max(
            most(lambda t: F.length(F.ltrim(F.concat(whole(t), fraction(t)), F.lit("0"))))
        ),
        "negative": F.max(F.exists(texts, lambda t: t.startswith("-"))),
    }


def _profile(df: DataFrame, text: str, paths: list[Steps], skip_unreadable: bool = False) -> DataFrame:
    """One aggregate of one row: every path's counts, combined before the shuffle."""
    value = as_variant(df, text, skip_unreadable)
    texts = df.select(value.alias("_value")).select(
        *(_numbers_at(F.col("_value"), p).alias(f"_texts{i}") for i, p in enumerate(paths))
    )
    return texts.agg(
        *(
            count.alias(f"{name}{i}")
            for i in range(len(paths))
            for name, count in _digit_counts(F.col(f"_texts{i}")).items()
        )
    )


def number_profile(df: DataFrame, text: str) -> DataFrame:
    """Of every field that holds numbers alone: how many, and the most digits any of them has.

    ``path, numbers, whole_digits, fraction_digits, significant_digits, negative``, a row per
    field of the JSON in ``text``. Zeros at either end do not count. What one field holds says nothing about
    another.
    """
    with by_case(df):
        found = df.select(F.schema_of_variant_agg(as_variant(df, text))).first()[0]
    paths = [p for p in _numeric_leaves(variant_type(found, "string", True)) if addressable(p)]
    names = ["numbers", "whole_digits", "fraction_digits", "significant_digits", "negative"]
    if not paths:
        kinds = "path string, numbers bigint, whole_digits int, fraction_digits int, significant_digits int, negative boolean"
        return df.sparkSession.createDataFrame([], kinds)
    rows = [
        F.struct(F.lit(steps_text(p)).alias("path"), *(F.col(f"{n}{i}").alias(n) for n in names))
        for i, p in enumerate(paths)
    ]
    return _profile(df, text, paths).select(F.inline(F.array(*rows)))


def most_digits(df: DataFrame, text: str, paths: list[Steps], skip_unreadable: bool = False) -> dict[Steps, Digits]:
    """The most digits that the numbers of each field have; one pass, one row. Mergeable field by field by ``max``."""
    paths = [p for p in paths if addressable(p)]
    if not paths:
        return {}
    row = _profile(df, text, paths, skip_unreadable).first()
    return {
        path: Digits(*(row[f"{name}{i}"] or 0 for name in ("whole_digits", "fraction_digits", "significant_digits")))
        for i, path in enumerate(paths)
    }


def decimals_for(digits: Mapping[Steps, Digits]) -> dict[Steps, T.DecimalType | None]:
    """The decimal that holds a field's numbers, or None where a double does."""
    needed: dict[Steps, T.DecimalType | None] = {}
    for path, most in digits.items():
        precision = max(1, most.whole + most.fraction)
        if most.significant <= DOUBLE_DIGITS:
            needed[path] = None
        elif precision <= 38:
            needed[path] = T.DecimalType(precision, most.fraction)
    return needed


def observe(df: DataFrame, text: str, skip_unreadable: bool = False) -> T.DataType:
    """What the values of all rows have together, before it is decided how to read them."""
    with by_case(df):  # else the aggregate itself takes such names for one
        found = df.select(F.schema_of_variant_agg(as_variant(df, text, skip_unreadable))).first()[0]
    return observed_type(found) if found is not None else T.NullType()


def wide_numbers(dtype: T.DataType, on_conflict: str = "fail") -> list[Steps]:
    """Fields whose numbers have to be looked at, as an observed type alone does not tell what holds them."""
    return _wide_numbers(resolved(dtype, on_conflict, decimals=True))


def record_schema(
    observed: T.DataType, on_conflict: str, decimals: bool, digits: Mapping[Steps, Digits], both_cases: bool
) -> T.StructType:
    """The schema that records of an observed type are read with."""
    schema = resolved(observed, on_conflict, decimals, None if decimals else decimals_for(digits))
    if not both_cases:
        check_case(schema)
    if isinstance(schema, T.NullType):
        raise SchemaConflict("no rows to infer a schema from; give an explicit schema")
    if not isinstance(schema, T.StructType):
        raise SchemaConflict(f"records must be JSON objects, not {observed.simpleString()}")
    return schema


def infer_schema(
    df: DataFrame,
    text: str,
    sample_rows: int | str = "all",
    order_by=(),
    on_conflict: str = "fail",
    decimals: bool = False,
    skip_unreadable: bool = False,
) -> T.StructType:
    """Schema of the JSON objects in column ``text``, over all rows or the first few by key.

    The column holds text or variants; text that is not JSON fails or is left out. Fields whose numbers might not fit a double are
    looked at once more, each on its own.
    ``on_conflict="string"`` reads a field with irreconcilable values as text.
    ``decimals`` keeps fractions as decimals instead of doubles.
    """
    if on_conflict not in ("fail", "string"):
        raise ValueError(f"on_conflict must be fail or string, not {on_conflict!r}")
    if sample_rows != "all":
        df = first_rows(df, order_by, int(sample_rows))
    observed, digits = observe(df, text, skip_unreadable), {}
    if not decimals:
        with by_case(df):
            digits = most_digits(df, text, wide_numbers(observed, on_conflict), skip_unreadable)
    return record_schema(observed, on_conflict, decimals, digits, case_sensitive(df))


@contextmanager
def by_case(df: DataFrame):
    conf, key = df.sparkSession.conf, "spark.sql.caseSensitive"
    before = conf.get(key)
    conf.set(key, "true")
    try:
        yield
    finally:
        conf.set(key, before)


def case_sensitive(df: DataFrame) -> bool:
    return df.sparkSession.conf.get("spark.sql.caseSensitive") == "true"


def check_case(dtype: T.DataType, path: str = "") -> None:
    """Fails on fields whose names differ by case only: Spark would read one and leave the other null."""
    if isinstance(dtype, T.ArrayType):
        check_case(dtype.elementType, f"{path}[]")
    elif isinstance(dtype, T.StructType):
        seen: dict[str, str] = {}
        for f in dtype.fields:
            other = seen.setdefault(f.name.lower(), f.name)
            if other != f.name:
                raise SchemaConflict(
                    f"{path or 'record'} has both {other} and {f.name}; "
                    "set spark.sql.caseSensitive to keep them apart"
                )
            check_case(f.dataType, f"{path}.{f.name}" if path else f.name)


def readable_type(dtype: T.DataType) -> T.DataType:
    """A type rows can be read as: what was never seen with a value is read as text."""
    if isinstance(dtype, T.StructType) and dtype.fields:
        return T.StructType(
            [
                T.StructField(f.name, readable_type(f.dataType), f.nullable, f.metadata)
                for f in dtype.fields
            ]
        )
    if isinstance(dtype, T.ArrayType):
        return T.ArrayType(readable_type(dtype.elementType), dtype.containsNull)
    return T.StringType() if isinstance(dtype, (T.NullType, T.StructType)) else dtype


def parse_records(df: DataFrame, text: str, schema: T.StructType, keep=()) -> DataFrame:
    """Records of ``schema`` from JSON text or variants, after the columns in ``keep``.

    Variants are cast, so the schema should be the one inferred from them.
    """
    readable = readable_type(schema)
    name = fresh_name(df, "_record")
    if isinstance(df.schema[text].dataType, T.VariantType):
        record = F.variant_get(column(text), "$", readable.simpleString())
        return _record_columns(df.select(*map(column, keep), record.alias(name)), name, readable, keep)
    # A null record is a row without values; anything else unreadable fails.
    source = F.when(F.trim(column(text)) != "null", column(text))
    record = F.from_json(source, readable, {"mode": "FAILFAST"})
    return _record_columns(df.select(*map(column, keep), record.alias(name)), name, readable, keep)


def _record_columns(df: DataFrame, name: str, readable: T.StructType, keep) -> DataFrame:
    return df.select(
        *map(column, keep),
        *(F.col(name).getField(f.name).alias(f.name) for f in readable.fields),
    )


def merge_types(left: T.DataType, right: T.DataType, path: str = "") -> T.DataType:
    """The union of two observations of a field; unknown gives way to anything."""
    if isinstance(left, T.NullType):
        return right
    if isinstance(right, T.NullType) or left == right:
        return left
    if isinstance(left, T.StructType) and isinstance(right, T.StructType):
        return merge_schemas(left, right, path)
    if isinstance(left, T.ArrayType) and isinstance(right, T.ArrayType):
        inner = merge_types(left.elementType, right.elementType, f"{path}[]")
        return T.ArrayType(inner, left.containsNull or right.containsNull)
    # An object without fields says only that there was a value of some shape.
    for one, other in ((left, right), (right, left)):
        if isinstance(one, T.StructType) and not one.fields:
            return other
    if isinstance(left, T.DecimalType) and isinstance(right, T.DecimalType):
        scale = max(left.scale, right.scale)
        whole = max(left.precision - left.scale, right.precision - right.scale)
        if whole + scale <= 38:
            return T.DecimalType(whole + scale, scale)
    widest = [T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType()]
    if left in widest and right in widest:
        return max(left, right, key=widest.index)
    if {left, right} == {T.FloatType(), T.DoubleType()}:
        return T.DoubleType()
    raise SchemaConflict(
        f"{path or 'record'} is {left.simpleString()} in one schema and "
        f"{right.simpleString()} in another"
    )


def merge_schemas(left: T.StructType, right: T.StructType, path: str = "") -> T.StructType:
    """Fields of ``left`` in order, then those only ``right`` has; recursive."""
    others = {f.name: f for f in right.fields}
    merged = []
    for f in left.fields:
        other = others.pop(f.name, None)
        dtype = f.dataType
        if other is not None:
            dtype = merge_types(dtype, other.dataType, f"{path}.{f.name}" if path else f.name)
        merged.append(T.StructField(f.name, dtype, True, f.metadata))
    rest = (T.StructField(f.name, f.dataType, True, f.metadata) for f in others.values())
    return T.StructType([*merged, *rest])


def union_entities(*frames: DataFrame) -> DataFrame:
    """Rows of all frames under their merged schema; a missing field, at any depth, is null."""
    merged = frames[0].schema
    for frame in frames[1:]:
        merged = merge_schemas(merged, frame.schema)
    if not case_sensitive(frames[0]):
        check_case(merged)
    result = frames[0].to(merged)
    for frame in frames[1:]:
        result = result.unionByName(frame.to(merged))
    return result


def schema_paths(schema: T.StructType) -> list[tuple[str, str]]:
    """``(path, type)`` of every leaf; ``[]`` stands for the elements of an array."""
    found: list[tuple[str, str]] = []

    def visit(dtype, path):
        if isinstance(dtype, T.StructType) and dtype.fields:
            for f in dtype.fields:
                visit(f.dataType, f"{path}.{f.name}" if path else f.name)
        elif isinstance(dtype, T.ArrayType):
            visit(dtype.elementType, f"{path}[]")
        else:
            found.append((path, dtype.simpleString()))

    visit(schema, "")
    return found
