"""Exact row numbers without a single-task sort.

``row_number() over (order by k)`` moves the whole table into one task, and
``partition by g`` does the same with the largest group. Here the sort order is
cut at sampled keys into many buckets, rows are numbered inside a bucket, and
the number of rows before the bucket is added. The cuts are taken over
*all* sort columns, so one hot value of a leading column is cut as well.

The result is a lazy plan that needs nothing persisted: the cuts and the
offsets are literals in it, so a lost executor only repeats its own tasks.
"""

from __future__ import annotations

import datetime
import decimal
import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

ROWS_PER_BUCKET = 1_000_000
MAX_BUCKETS = 50_000
SAMPLES_PER_BUCKET = 10
_SEED = 17


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def column(name: str) -> Column:
    return F.col(quoted(name))


def fresh_name(df: DataFrame, stem: str) -> str:
    """A column name the frame does not use yet."""
    taken = {name.lower() for name in df.columns}
    name = stem
    while name.lower() in taken:
        name = "_" + name
    return name


def whole_div(col: Column, by: int) -> Column:
    """Integer division; a quotient of doubles would lose digits at large positions."""
    return F.call_function("div", col, F.lit(by))


def _sort_key(col: Column, dtype: T.DataType) -> tuple[Column, T.DataType]:
    """A form of a sort column that survives being written as text in UTC or any zone."""
    if isinstance(dtype, T.TimestampType):
        return F.unix_micros(col), T.LongType()
    if isinstance(dtype, T.FractionalType) and not isinstance(dtype, T.DecimalType):
        return col + F.lit(0).cast(dtype), dtype  # -0.0 and 0.0 are one key
    if isinstance(dtype, T.StringType) and dtype.collation != "UTF8_BINARY":
        raise TypeError(f"rows cannot be numbered by a column collated as {dtype.collation}")
    if isinstance(dtype, (T.NumericType, T.StringType, T.BooleanType, T.DateType, T.TimestampNTZType)):
        return col, dtype
    raise TypeError(f"rows cannot be numbered by a column of type {dtype.simpleString()}")


def literal_array(texts: list[str], dtype: T.DataType) -> Column:
    """One constant array, built from a single string so that many thousand cuts stay cheap to plan."""
    separator = next(c for c in map(chr, range(0xE000, 0xF8FF)) if not any(c in t for t in texts))
    parts = F.split(F.lit(separator.join(texts)), separator)
    return parts if isinstance(dtype, T.StringType) else parts.cast(T.ArrayType(dtype))


def _python_default(dtype: T.DataType):
    if isinstance(dtype, T.StringType):
        return ""
    if isinstance(dtype, T.BooleanType):
        return False
    if isinstance(dtype, T.DateType):
        return datetime.date(1970, 1, 1)
    if isinstance(dtype, T.TimestampNTZType):
        return datetime.datetime(1970, 1, 1)
    return decimal.Decimal(0) if isinstance(dtype, T.DecimalType) else 0


class Cuts:
    """Sampled cut points of a sort order, and the bucket of a row among them."""

    def __init__(self, df: DataFrame, group_by: list[str], order_by: list[str], buckets: int | None):
        self.group_size = len(group_by)
        names = [*group_by, *order_by]
        keys = [_sort_key(column(name), df.schema[name].dataType) for name in names]
        frame = df.select(*(key.alias(f"k{i}") for i, (key, _) in enumerate(keys)))
        rows = frame.count()
        if buckets is None:
            spread = 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
            buckets = min(MAX_BUCKETS, max(spread, math.ceil(rows / ROWS_PER_BUCKET)))
        wanted = buckets * SAMPLES_PER_BUCKET
        # Bounded by the bucket count, not by the table.
        sample = (frame if rows <= wanted else frame.sample(False, wanted / rows, _SEED)).collect()
        self.columns: list[Column] = []
        self.types: list[T.DataType] = []
        self.is_group: list[bool] = []
        parts: list[list] = []
        for i, (key, dtype) in enumerate(keys):
            values, in_group = [row[i] for row in sample], i < self.group_size
            if None in values:  # nulls sort first: a flag, then the value
                parts.append([value is not None for value in values])
                self._add(key.isNotNull(), T.BooleanType(), in_group)
                default = _python_default(dtype)
                values = [default if value is None else value for value in values]
                key = F.coalesce(key, F.lit(str(default)).cast(dtype))
            parts.append(values)
            self._add(key, dtype, in_group)
        # NaN sorts last, as in Spark.
        ordered = sorted(zip(*parts), key=lambda point: [(v != v, v) for v in point])
        every = max(1, len(ordered) // buckets)
        texts = (tuple(map(str, point)) for point in ordered[every::every])
        self.points = list(dict.fromkeys(texts))
        self.arrays = [
            literal_array([point[i] for point in self.points], dtype)
            for i, dtype in enumerate(self.types if self.points else ())
        ]

    def _add(self, col: Column, dtype: T.DataType, in_group: bool) -> None:
        self.columns.append(col)
        self.types.append(dtype)
        self.is_group.append(in_group)

    def bucket(self) -> Column:
        """Number of cut points at or before the row, by binary search."""
        if not self.points:
            return F.lit(0)
        powers = [1 << i for i in range(len(self.points).bit_length() - 1, -1, -1)]

        def at_or_before(index: Column, i: int = 0) -> Column:
            cut, key = F.get(self.arrays[i], index), self.columns[i]
            if i == len(self.columns) - 1:
                return cut <= key
            return (cut < key) | ((cut == key) & at_or_before(index, i + 1))

        return F.reduce(
            F.array(*map(F.lit, powers)),
            F.lit(0),
            lambda low, step: F.when(at_or_before(low + step - 1), low + step).otherwise(low),
        )

    def in_group_of(self, index: Column) -> Column:
        """Whether the row is in the group of the cut point at ``index``."""
        same = F.lit(True)
        for array, key, in_group in zip(self.arrays, self.columns, self.is_group):
            if in_group:
                same = same & F.coalesce(F.get(array, index) == key, F.lit(False))
        return same

    def group_of(self, index: int) -> tuple[str, ...]:
        point = self.points[index]
        return tuple(text for text, in_group in zip(point, self.is_group) if in_group)


def number_rows(
    df: DataFrame,
    order_by: list[str],
    group_by: list[str] = (),
    weight: str | None = None,
    into: str = "position",
    buckets: int | None = None,
) -> DataFrame:
    """Append the 1-based position of each row in ``order_by`` order, per ``group_by`` group.

    ``order_by`` must be unique inside a group; a tie fails the query, because
    its rows would have no fixed position. With ``weight``, a row stands for
    that many equal rows and gets the position of the first of them.

    The sort columns of ``df`` are read three times beside the numbered rows
    themselves. That is cheap for a scan; stage the result of a join first.
    """
    order_by, group_by = list(order_by), list(group_by)
    if not order_by:
        raise ValueError("numbering rows needs an order key")
    cuts = Cuts(df, group_by, order_by, buckets)
    bucket_name = fresh_name(df, "_bucket")
    bucketed = df.withColumn(bucket_name, cuts.bucket())
    bucket = F.col(bucket_name)
    size = column(weight).cast("bigint") if weight else F.lit(1).cast("bigint")

    window = Window.partitionBy(bucket, *map(column, group_by)).orderBy(*map(column, order_by))
    if weight:
        local = F.sum(size).over(window.rowsBetween(Window.unboundedPreceding, 0)) - size + 1
    else:
        local = F.row_number().over(window).cast("bigint")
    tied = F.row_number().over(window) > 1
    for name in order_by:  # column by column, so that no copy of the key is shuffled
        tied = tied & F.lag(column(name)).over(window).eqNullSafe(column(name))
    position = F.when(
        tied, F.raise_error(F.lit(f"order key {', '.join(order_by)} is not unique")).cast("bigint")
    ).otherwise(local)

    if cuts.points:
        position = position + _rows_before(bucketed, bucket, cuts, size)
    # Ranges of buckets, not hashes of them: even tasks, and each one a stretch of the order.
    return bucketed.repartitionByRange(bucket).withColumn(into, position).drop(bucket_name)


def _rows_before(bucketed: DataFrame, bucket: Column, cuts: Cuts, size: Column) -> Column:
    """Rows of the row's own group in earlier buckets.

    Only the group a bucket starts in can have any, and that group is known: it
    is the group of the cut point the bucket starts at. So two counts per
    bucket are enough, and the collected result has one row per bucket.
    """
    none = F.lit(0).cast("bigint")
    totals = (
        bucketed.groupBy(bucket.alias("b"))
        .agg(
            F.sum(F.when(cuts.in_group_of(bucket - 1), size).otherwise(none)).alias("of_start"),
            F.sum(F.when(cuts.in_group_of(bucket), size).otherwise(none)).alias("of_next"),
        )
        .collect()
    )
    counts = {row["b"]: row for row in totals}
    offsets = [0]
    for b in range(1, len(cuts.points) + 1):
        before = counts.get(b - 1)
        if b > 1 and cuts.group_of(b - 1) == cuts.group_of(b - 2):
            offsets.append(offsets[-1] + (before["of_start"] if before else 0))
        else:
            offsets.append(before["of_next"] if before else 0)
    array = literal_array([str(n) for n in offsets], T.LongType())
    if not any(cuts.is_group):
        return F.get(array, bucket)
    return F.when(cuts.in_group_of(bucket - 1), F.get(array, bucket)).otherwise(none)
