"""One walk over a schema: which flat columns a nested record has, and where each comes from.

A source is a tuple of steps, field names (``str``) and array positions
(``int``). Names are never taken apart again, so a field called ``first_name``
cannot be mistaken for ``name`` inside ``first``.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Mapping
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from entityframe.functions.numbering import column
from entityframe.options import FieldPath

SEPARATOR = "_"
SOURCE_PATH = "source_path"
ELEMENT = "element"  # names the elements of an array that hold arrays themselves

Steps = tuple[str | int, ...]


class FlattenError(ValueError):
    """The schema cannot be flattened as asked."""


@dataclass(frozen=True)
class FlatColumn:
    name: str
    steps: Steps
    dtype: T.DataType

    @property
    def is_root(self) -> bool:
        return len(self.steps) == 1

    @property
    def source_path(self) -> str:
        return path_text(self.steps)

    @property
    def metadata(self) -> dict:
        return {SOURCE_PATH: json.dumps(self.steps)}

    def raw(self, offsets: Mapping[FieldPath, str] | None = None) -> Column:
        return reach(self.steps, offsets)


def path_text(steps: Steps) -> str:
    """``("line", 0, "price")`` is shown as ``line[0].price``."""
    text = ""
    for step in steps:
        text += f"[{step}]" if isinstance(step, int) else (f".{step}" if text else step)
    return text


def reach(steps: Steps, offsets: Mapping[FieldPath, str] | None = None) -> Column:
    """The value at ``steps``: null below a null parent or past the end of an array.

    ``offsets`` names, for an array that a record holds a part of, the column that says how
    many elements lie before the part: positions are those in the whole array.
    """
    value, path, in_array = column(steps[0]), (steps[0],), False
    for step in steps[1:]:
        if isinstance(step, int):
            path = (*path, ELEMENT) if in_array else path
            before = (offsets or {}).get(path)
            at = F.lit(step) if before is None else (F.lit(step) - column(before)).cast("int")
            value, in_array = F.get(value, at), True
        else:
            value, path, in_array = value.getField(step), (*path, step), False
    return value


def array_paths(schema: T.StructType) -> list[FieldPath]:
    """Every array in the schema, outer before inner."""

    def visit(dtype: T.DataType, path: FieldPath) -> Iterator[FieldPath]:
        if isinstance(dtype, T.StructType):
            for field in dtype.fields:
                yield from visit(field.dataType, (*path, field.name))
        elif isinstance(dtype, T.ArrayType):
            yield path
            inner = dtype.elementType
            yield from visit(inner, (*path, ELEMENT) if isinstance(inner, T.ArrayType) else path)

    return list(visit(schema, ()))


def walk(
    schema: T.StructType,
    sizes: Mapping[FieldPath, int],
    expand_arrays: bool,
    max_columns: int,
) -> list[FlatColumn]:
    """Flat columns in schema order.

    Structs are entered at any depth. An array of known size 0 stays one array
    column; a longer one becomes ``size`` columns (or column groups) when
    ``expand_arrays`` is set, and otherwise adds nothing. A field whose type is
    not known yet adds nothing.
    """
    flat: list[FlatColumn] = []

    def leaf(name: str, steps: Steps, dtype: T.DataType) -> None:
        if len(flat) >= max_columns:
            raise FlattenError(
                f"more than {max_columns} flat columns, reached at {path_text(steps)}; "
                "give smaller arraySizes or raise maxFlatColumns"
            )
        flat.append(FlatColumn(name, steps, dtype))

    def visit(dtype: T.DataType, name: str, steps: Steps, path: FieldPath) -> None:
        if isinstance(dtype, T.StructType):
            for field in dtype.fields:
                visit(
                    field.dataType,
                    f"{name}{SEPARATOR}{field.name}",
                    (*steps, field.name),
                    (*path, field.name),
                )
        elif isinstance(dtype, T.ArrayType):
            size = sizes.get(path)
            if size == 0:
                leaf(name, steps, dtype)
            elif expand_arrays:
                if size is None:
                    raise FlattenError(f"no size is known for array {'.'.join(path)}")
                inner = dtype.elementType
                below = (*path, ELEMENT) if isinstance(inner, T.ArrayType) else path
                for i in range(size):
                    visit(inner, f"{name}{SEPARATOR}{i}", (*steps, i), below)
        elif not isinstance(dtype, T.NullType):
            leaf(name, steps, dtype)

    for field in schema.fields:
        visit(field.dataType, field.name, (field.name,), (field.name,))
    return flat


def check_collisions(flat: list[FlatColumn], kept: list[str], case_sensitive: bool) -> None:
    """Two sources must not share one output name."""
    key = (lambda name: name) if case_sensitive else str.lower
    owners = {key(name): name for name in kept}
    for item in flat:
        if item.is_root and owners.get(key(item.name)) == item.name:
            continue
        owner = owners.setdefault(key(item.name), item.source_path)
        if owner != item.source_path:
            raise FlattenError(
                f"flat column {item.name} would come from both {owner} and {item.source_path}"
            )
