"""Pages of nested business records in; typed, flat, SQL-ready DataFrames out."""

from entityframe.operators.coerce import coerce, project
from entityframe.operators.flatten import array_profile, flatten, lineage
from entityframe.operators.infer import (
    infer_schema,
    merge_schemas,
    number_profile,
    parse_records,
    union_entities,
)
from entityframe.operators.parts import elements, with_offsets
from entityframe.operators.unflatten import unflatten
from entityframe.options import OptionError, ScanOptions
from entityframe.sources.landing import write_landing
from entityframe.sources.reader import EntityReader

__all__ = [
    "EntityReader",
    "OptionError",
    "ScanOptions",
    "array_profile",
    "coerce",
    "elements",
    "flatten",
    "infer_schema",
    "lineage",
    "merge_schemas",
    "number_profile",
    "parse_records",
    "project",
    "unflatten",
    "union_entities",
    "with_offsets",
    "write_landing",
]
