"""The way back: structs and arrays built again from flat columns."""

from __future__ import annotations

import json
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from entityframe.functions.numbering import column
from entityframe.functions.paths import SOURCE_PATH, FlattenError, path_text


@dataclass
class _Node:
    """A place in the record: a leaf's column, the fields of a struct or the elements of an array."""

    leaf: str | None = None
    below: dict[str | int, "_Node"] = field(default_factory=dict)

    def put(self, steps: tuple, name: str, whole: tuple) -> None:
        if not steps:
            if self.leaf is not None or self.below:
                raise FlattenError(f"{path_text(whole)} is given twice")
            self.leaf = name
            return
        if self.leaf is not None:
            raise FlattenError(f"{path_text(whole)} lies below {self.leaf}, which is a value")
        self.below.setdefault(steps[0], _Node()).put(steps[1:], name, whole)
        if len({type(step) for step in self.below}) > 1:
            raise FlattenError(f"{path_text(whole)} is both a field and an element")

    def present(self) -> Column:
        """Whether anything at or below this place has a value."""
        if self.leaf is not None:
            return column(self.leaf).isNotNull()
        return reduce(lambda a, b: a | b, (node.present() for node in self.below.values()))

    def value(self) -> Column:
        if self.leaf is not None:
            return column(self.leaf)
        if isinstance(next(iter(self.below)), str):
            fields = [node.value().alias(name) for name, node in self.below.items()]
            return F.when(self.present(), F.struct(*fields))
        size = max(self.below) + 1
        missing = [i for i in range(size) if i not in self.below]
        if missing:
            raise FlattenError(f"element {missing[0]} has no columns, but a later one has")
        elements = F.array(*(self.below[i].value() for i in range(size)))
        ends = [F.when(self.below[i].present(), F.lit(i + 1)) for i in range(size)]
        last = F.coalesce(*reversed(ends))
        return F.when(last.isNotNull(), F.slice(elements, F.lit(1), last))


def unflatten(df: DataFrame) -> DataFrame:
    """Nested records from the flat columns of a flattened frame, by the source path each column carries.

    Names are not looked at, so separators in them do no harm. A struct or array below which nothing
    has a value is null, as flat columns cannot tell it from an empty one; elements after the last one
    with a value are cut off. Values stay as they were flattened (dates as milliseconds). Columns without
    a source path stay, unless a rebuilt record field has their name: that takes their place. One
    ``select``: nothing is shuffled.
    """
    roots: dict[str, _Node] = {}
    for f in df.schema.fields:
        if SOURCE_PATH in f.metadata:
            steps = tuple(json.loads(f.metadata[SOURCE_PATH]))
            roots.setdefault(steps[0], _Node()).put(steps[1:], f.name, steps)
    built, out = set(), []
    for f in df.schema.fields:
        name = json.loads(f.metadata[SOURCE_PATH])[0] if SOURCE_PATH in f.metadata else f.name
        if name in roots:
            if name not in built:
                out.append(roots[name].value().alias(name))
                built.add(name)
        else:
            out.append(column(f.name))
    return df.select(*out)
