"""Arrays that continue in further records: where a part begins in the whole array."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from entityframe.functions.numbering import column, fresh_name, number_rows
from entityframe.options import OptionError


def with_offsets(parts: DataFrame, key: list[str], order_by: list[str], array: str, into: str) -> DataFrame:
    """``parts`` with ``into``: how many elements of ``array`` the earlier parts of its record hold.

    A record is a value of ``key``, its parts are in ``order_by`` order, which must be unique in it, and
    may be of any size; a null array holds nothing. The sum runs over one narrow row per part
    and is cut like the rows themselves, so a record of any number of parts is never in one
    task. ``parts`` is read several times: stage the result of a join or aggregate first.
    """
    if into.lower() in {name.lower() for name in parts.columns}:
        raise OptionError(f"there is a column {into} already")
    size, after = fresh_name(parts, "_size"), fresh_name(parts, "_after")
    sized = parts.withColumn(size, F.coalesce(F.array_size(column(array)), F.lit(0)))
    placed = number_rows(sized, order_by, key, weight=size, into=after)
    return placed.withColumn(into, column(after) - 1).drop(size, after)


def elements(parts: DataFrame, array: str, offset: str, into: str = "element", at: str = "element_index") -> DataFrame:
    """One row per element, with its 0-based index in the whole array; other columns as they are."""
    clash = {into.lower(), at.lower()} & {name.lower() for name in parts.columns}
    if clash:
        raise OptionError(f"there is a column {sorted(clash)[0]} already")
    index = fresh_name(parts, "_index")
    others = [column(name) for name in parts.columns if name not in (array, offset)]
    rows = parts.select(*others, column(offset), F.posexplode(column(array)).alias(index, into))
    return rows.withColumn(at, column(index) + column(offset)).drop(index, offset)
