"""Typed options of an entity scan.

Option names are matched without regard to case, as Spark's own readers do.
"""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import types as T

DEFAULT_ENTITY = "companyInfo"
DEFAULT_DECIMAL = T.DecimalType(38, 10)
PAGE_SIZE = 1000
BATCH_SIZE = 30
MAX_FLAT_COLUMNS = 1000

FieldPath = tuple[str, ...]


class OptionError(ValueError):
    """An option is missing, unknown or has a value that cannot be read."""


def parse_bool(name: str, value) -> bool:
    if isinstance(value, bool):
        return value
    text = str(value).strip().lower()
    if text in ("true", "false"):
        return text == "true"
    raise OptionError(f"{name} must be true or false, not {value!r}")


def parse_count(name: str, value) -> int:
    try:
        number = int(str(value))
    except ValueError:
        raise OptionError(f"{name} must be a whole number, not {value!r}") from None
    if number < 1:
        raise OptionError(f"{name} must be at least 1, not {value!r}")
    return number


def as_path(key) -> FieldPath:
    """A path is a tuple of field names; ``"a.b"`` is short for ``("a", "b")``."""
    return tuple(key) if isinstance(key, (tuple, list)) else tuple(str(key).split("."))


def parse_sizes(value) -> str | dict[FieldPath, int]:
    """``max``, ``first``, a mapping, a list of [path, size] pairs, or JSON text of either."""
    if isinstance(value, str):
        text = value.strip()
        if text.lower() in ("max", "first"):
            return text.lower()
        try:
            value = json.loads(text)
        except json.JSONDecodeError:
            raise OptionError(
                f"arraySizes must be max, first or a JSON object, not {text!r}"
            ) from None
    pairs = value.items() if isinstance(value, Mapping) else value
    sizes = {as_path(path): int(size) for path, size in pairs}
    negative = [path for path, size in sizes.items() if size < 0]
    if negative:
        raise OptionError(f"arraySizes has a negative size for {'.'.join(negative[0])}")
    return sizes


def parse_offsets(value) -> tuple[tuple[FieldPath, str], ...]:
    """``{"line": "line_offset"}`` as a mapping, pairs or JSON text: the column that says how many elements lie before."""
    if isinstance(value, str):
        try:
            value = json.loads(value)
        except json.JSONDecodeError:
            raise OptionError(f"arrayOffsets must be a JSON object, not {value!r}") from None
    pairs = value.items() if isinstance(value, Mapping) else value
    return tuple((as_path(path), str(name)) for path, name in pairs)


def parse_decimal(value) -> T.DecimalType | None:
    """``decimal(p,s)``, or ``source`` to leave decimals as they are."""
    if value is None or isinstance(value, T.DecimalType):
        return value
    text = str(value).replace(" ", "").lower()
    if text == "source":
        return None
    if text.startswith("decimal(") and text.endswith(")"):
        try:
            precision, scale = (int(part) for part in text[8:-1].split(","))
        except ValueError:
            raise OptionError(f"decimalType cannot be read: {value!r}") from None
        if 0 <= scale <= precision <= 38 and precision > 0:
            return T.DecimalType(precision, scale)
    raise OptionError(f"decimalType must be decimal(p,s) or source, not {value!r}")


def parse_schema(value) -> T.StructType | None:
    if value is None or isinstance(value, T.StructType):
        return value
    text = str(value).strip()
    if text.startswith("{"):
        return T.StructType.fromJson(json.loads(text))
    return T.StructType.fromDDL(text)


@dataclass(frozen=True)
class ScanOptions:
    path: str | None = None
    company_id: str | None = None
    entity: str = DEFAULT_ENTITY
    production: bool = False
    expand_structs: bool = True
    expand_arrays: bool = False
    keep_nested: bool = True
    array_sizes: str | dict[FieldPath, int] = "max"
    array_offsets: tuple[tuple[FieldPath, str], ...] = ()
    dates: str = "epoch_millis"
    decimal_type: T.DecimalType | None = DEFAULT_DECIMAL
    decimal_forced: bool = False
    schema: T.StructType | None = None
    order_by: tuple[str, ...] = ()
    page_size: int = PAGE_SIZE
    batch_size: int = BATCH_SIZE
    max_flat_columns: int = MAX_FLAT_COLUMNS
    file_format: str = "parquet"
    sample_rows: int | str = "all"
    on_conflict: str = "fail"
    json_pages: bool = False
    answers: str = "whole"
    on_unreadable: str = "fail"
    version: int | None = None
    ignored: tuple[str, ...] = field(default=(), compare=False)

    @property
    def environment(self) -> str:
        return "production" if self.production else "sandbox"

    @property
    def table_name(self) -> str:
        return f"{self.company_id}:{self.entity}"

    @classmethod
    def from_options(cls, options: Mapping[str, object]) -> "ScanOptions":
        given = {str(name).lower(): value for name, value in options.items()}
        values: dict[str, object] = {}

        def read(name, target, convert):
            value = given.pop(name.lower(), None)
            if value is not None:
                values[target] = convert(value)

        read("path", "path", str)
        read("companyId", "company_id", str)
        read("entity", "entity", str)
        for name, target in (
            ("production", "production"),
            ("expandStructs", "expand_structs"),
            ("expandArrays", "expand_arrays"),
            ("keepNested", "keep_nested"),
            ("jsonPages", "json_pages"),
        ):
            read(name, target, lambda value, name=name: parse_bool(name, value))
        for name, target in (
            ("pageSize", "page_size"),
            ("batchSize", "batch_size"),
            ("maxFlatColumns", "max_flat_columns"),
            ("version", "version"),
        ):
            read(name, target, lambda value, name=name: parse_count(name, value))
        read("arraySizes", "array_sizes", parse_sizes)
        read("arrayOffsets", "array_offsets", parse_offsets)
        read("schema", "schema", parse_schema)
        read("dates", "dates", lambda value: str(value).lower())
        read(
            "sampleRows",
            "sample_rows",
            lambda value: "all" if str(value).lower() == "all" else parse_count("sampleRows", value),
        )
        read("fileFormat", "file_format", lambda value: str(value).lower())
        read("onConflict", "on_conflict", lambda value: str(value).lower())
        read("answers", "answers", lambda value: str(value).lower())
        read("onUnreadable", "on_unreadable", lambda value: str(value).lower())
        if "decimaltype" in given:
            values["decimal_type"] = parse_decimal(given.pop("decimaltype"))
            values["decimal_forced"] = True
        read(
            "orderBy",
            "order_by",
            lambda value: tuple(
                part.strip() for part in (value.split(",") if isinstance(value, str) else value)
            ),
        )
        if values.get("dates", "epoch_millis") not in ("epoch_millis", "native"):
            raise OptionError(f"dates must be epoch_millis or native, not {values['dates']!r}")
        if values.get("file_format", "parquet") not in ("parquet", "json"):
            raise OptionError(f"fileFormat must be parquet or json, not {values['file_format']!r}")
        if values.get("on_conflict", "fail") not in ("fail", "string"):
            raise OptionError(f"onConflict must be fail or string, not {values['on_conflict']!r}")
        if values.get("answers", "whole") not in ("whole", "distinct", "any"):
            raise OptionError(f"answers must be whole, distinct or any, not {values['answers']!r}")
        if values.get("on_unreadable", "fail") not in ("fail", "reject"):
            raise OptionError(f"onUnreadable must be fail or reject, not {values['on_unreadable']!r}")
        # Sign-in options are accepted and unused: landed pages need no token.
        sign_in = {
            "accesstoken",
            "authorizationcode",
            "clientid",
            "clientsecret",
            "redirecturi",
            "redirecturl",
        }
        unknown = sorted(set(given) - sign_in)
        if unknown:
            raise OptionError(f"unknown option(s): {', '.join(unknown)}")
        return cls(**values, ignored=tuple(sorted(given)))
