"""Nested business records built from the flat tables: invoices with lines, accounts with orders.

A record stays bounded even when one key holds a large share of all rows: a
group above ``part_size`` members continues in further parts, each with at most that
many. A part says how many members lie before it, so sizes and indexes are those of the group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from entityframe.functions.numbering import column, fresh_name, number_rows, whole_div
from entityframe.sources.landing import stage

LINE_FIELDS = ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity"]
# Only a group above this is not one record.
LINES_PER_PART = 10_000
ORDERS_PER_PART = 10_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def group_sizes(rows: DataFrame, key: str) -> DataFrame:
    """``key`` and ``members``: a count that is combined before it is shuffled."""
    return rows.groupBy(column(key)).agg(F.count(F.lit(1)).alias("members"))


def large_groups(sizes: DataFrame, key: str, part_size: int) -> DataFrame | None:
    """``key`` and ``members`` of groups that do not fit into one part; None if all do."""
    large = stage(sizes.where(F.col("members") > part_size), "large")
    return None if large.isEmpty() else large


def nest(
    rows: DataFrame,
    key: str,
    fields: list[str],
    into: str,
    part_size: int,
    *,
    large: DataFrame | None,
    unique_by: list[str] | None = None,
    derived: bool = False,
) -> DataFrame:
    """``key``, ``part_no`` and an array of structs of ``fields``, sorted by ``unique_by``.

    ``large`` is the answer of ``large_groups``. Groups outside it are known to
    fit into one part and are collected in one shuffle. The others are cut by
    exact position, however large they are. Without ``unique_by`` members are
    sorted by all fields and may have exact copies. ``derived`` rows (the
    result of joins) are staged if they have to be read more than once.
    """
    if large is None:
        return _nest_whole(rows, key, fields, into, unique_by)
    if derived:
        rows = stage(rows, f"nest-{into}")
    named = large.select(column(key).alias("_large_key"))
    same = column(key).eqNullSafe(F.col("_large_key"))
    whole = _nest_whole(rows.join(named, same, "left_anti"), key, fields, into, unique_by)
    return whole.unionByName(
        _nest_parts(rows.join(named, same, "left_semi"), key, fields, into, part_size, unique_by)
    )


def join_parts(
    headers: DataFrame,
    key: str,
    parts: DataFrame,
    parts_key: str,
    part_size: int,
    large: DataFrame | None,
) -> DataFrame:
    """Every header with each part of its group, or with nulls if it has none, and ``_members`` of large ones.

    Parts grow with the data and are already partitioned on the key, so they
    are merged, not broadcast. A large key has many parts, and the inner side
    of an outer join is never split at run time; so its parts are spread over
    salts, and its header, one row, is repeated for each.
    """
    if large is None:
        joined = headers.join(parts.hint("merge"), column(key) == column(parts_key), "left")
        return joined.withColumn("_members", F.lit(None).cast("bigint"))
    most = int(headers.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counts = large.select(column(parts_key).alias("_key"), F.col("members").alias("_members"))
    headers = headers.join(counts, column(key) == F.col("_key"), "left").drop("_key")
    needed = whole_div(F.col("_members") + part_size - 1, part_size)
    salts = F.least(F.lit(most), F.coalesce(needed, F.lit(1))).cast("int")
    salted = headers.withColumn("_salt", F.explode(F.sequence(F.lit(0), salts - 1)))
    spread = parts.withColumn("_part_salt", F.pmod("part_no", F.lit(most)).cast("int"))
    on = (column(key) == column(parts_key)) & (F.col("_salt") == F.col("_part_salt"))
    # Part 0 is always with salt 0, so only a repeated header can be left over.
    return (
        salted.join(spread.hint("merge"), on, "left")
        .where((F.col("_salt") == 0) | F.col("part_no").isNotNull())
        .drop("_salt", "_part_salt")
    )


def _nest_whole(rows, key, fields, into, unique_by) -> DataFrame:
    # Structs compare field by field, so the sort fields go first.
    order = unique_by or fields
    lead = [*order, *(f for f in fields if f not in order)]
    members = F.sort_array(F.collect_list(F.struct(*map(column, lead))))
    if lead != fields:
        members = _pick(members, fields)
    return _together(rows, column(key)).groupBy(column(key)).agg(members.alias(into)).select(
        column(key), F.lit(0).cast("bigint").alias("part_no"), column(into)
    )


def _nest_parts(rows, key, fields, into, part_size, unique_by) -> DataFrame:
    if unique_by is None:
        return _nest_copies(rows, key, fields, into, part_size)
    position = fresh_name(rows, "_position")
    numbered = number_rows(rows, unique_by, [key], into=position)
    placed = numbered.withColumn("part_no", whole_div(column(position) - 1, part_size))
    members = F.sort_array(F.collect_list(F.struct(column(position), *map(column, fields))))
    by = [column(key), F.col("part_no")]
    return _together(placed, *by).groupBy(*by).agg(_pick(members, fields).alias(into))


def _together(rows: DataFrame, *by: Column) -> DataFrame:
    """Rows of a group in one task before they are collected.

    The same single shuffle, but without collecting on the side of the scan
    first, which would sort all rows there and make none of them smaller.
    """
    return rows.repartition(*by)


def _nest_copies(rows, key, fields, into, part_size) -> DataFrame:
    """Copies are counted before the shuffle and only written out inside their own part."""
    distinct = rows.groupBy(column(key), *map(column, fields)).agg(F.count(F.lit(1)).alias("_copies"))
    placed = number_rows(
        stage(distinct, f"nest-{into}"), fields, [key], weight="_copies", into="_start"
    )
    first, last = F.col("_start") - 1, F.col("_start") + F.col("_copies") - 2
    pieces = placed.select(
        column(key),
        *map(column, fields),
        first.alias("_first"),
        last.alias("_last"),
        F.explode(
            F.sequence(whole_div(first, part_size), whole_div(last, part_size))
        ).alias("part_no"),
    )
    begin = F.greatest(F.col("_first"), F.col("part_no") * part_size)
    end = F.least(F.col("_last"), (F.col("part_no") + 1) * part_size - 1)
    members = F.sort_array(
        F.collect_list(
            F.struct(begin.alias("_at"), (end - begin + 1).cast("int").alias("_n"), *map(column, fields))
        )
    )
    written = F.flatten(
        F.transform(
            members,
            lambda m: F.array_repeat(F.struct(*(m.getField(f).alias(f) for f in fields)), m["_n"]),
        )
    )
    by = [column(key), F.col("part_no")]
    return _together(pieces, *by).groupBy(*by).agg(written.alias(into))


def _pick(members, fields: list[str]):
    return F.transform(members, lambda m: F.struct(*(m.getField(f).alias(f) for f in fields)))


def _line_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select("l_orderkey", *LINE_FIELDS)


def with_lines(
    headers: DataFrame,
    rows: DataFrame,
    fields: list[str],
    into: str,
    part_size: int,
) -> tuple[DataFrame, DataFrame | None]:
    """Headers keyed ``o_orderkey`` with their ``rows`` (keyed ``l_orderkey``) nested; large orders.

    ``part_no`` counts the parts, ``<into>_offset`` the members before a part, ``<into>_size`` all
    members of the group (null without any).
    """
    sizes = group_sizes(rows, "l_orderkey")
    large = large_groups(sizes, "l_orderkey", part_size)
    parts = nest(rows, "l_orderkey", fields, into, part_size, large=large)
    joined = join_parts(headers, "o_orderkey", parts, "l_orderkey", part_size, large)
    part_no = F.coalesce("part_no", F.lit(0)).cast("bigint")
    return joined.select(
        *map(column, headers.columns),
        part_no.alias("part_no"),
        (part_no * part_size).alias(f"{into}_offset"),
        F.coalesce("_members", F.array_size(column(into))).cast("bigint").alias(f"{into}_size"),
        column(into),
    ), large


def invoice_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One record per order, with ``customer_ref`` and its nation, without lines."""
    orders = table(spark, sf_dir, "orders")
    customer = table(spark, sf_dir, "customer")
    nation = table(spark, sf_dir, "nation")
    return (
        orders.join(customer, orders.o_custkey == customer.c_custkey, "left")
        .join(nation, customer.c_nationkey == nation.n_nationkey, "left")
        .select(
            "o_orderkey",
            "o_orderstatus",
            "o_totalprice",
            "o_orderdate",
            F.struct(
                F.col("o_custkey").alias("value"),
                F.col("c_name").alias("name"),
                F.struct(
                    F.col("n_nationkey").alias("value"), F.col("n_name").alias("name")
                ).alias("nation"),
            ).alias("customer_ref"),
        )
    )


def invoices(spark: SparkSession, sf_dir: str, part_size: int = LINES_PER_PART) -> DataFrame:
    """One record per order (part): header, ``customer_ref`` with its nation, and ``line``.

    ``line`` is null for an order without lines. ``line_offset`` and ``line_size`` are those of ``with_lines``.
    """
    headers = invoice_headers(spark, sf_dir)
    nested, _ = with_lines(headers, _line_rows(spark, sf_dir), LINE_FIELDS, "line", part_size)
    return nested.select(
        "o_orderkey",
        "part_no",
        "line_offset",
        "line_size",
        "o_orderstatus",
        "o_totalprice",
        "o_orderdate",
        "customer_ref",
        "line",
    )


def accounts(
    spark: SparkSession,
    sf_dir: str,
    part_size: int = ORDERS_PER_PART,
    line_part_size: int = LINES_PER_PART,
) -> DataFrame:
    """One record per customer (part): ``order`` elements that hold ``line`` arrays.

    ``order`` is null for a customer without orders. ``order_offset`` orders lie before the
    part, and ``line_offset`` lines before the lines it holds of each: an order of more than
    ``line_part_size`` lines goes on in records of its own.
    """
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_custkey").alias("c_custkey")
    )
    rows = _line_rows(spark, sf_dir)
    nested, long_orders = with_lines(orders, rows, LINE_FIELDS, "line", line_part_size)
    large = large_groups(group_sizes(orders, "c_custkey"), "c_custkey", part_size)
    if long_orders is not None:
        nested = stage(nested, "account-orders")
    parts = nest(
        nested.where("part_no = 0").select("c_custkey", "o_orderkey", "line"),
        "c_custkey",
        ["o_orderkey", "line"],
        "order",
        part_size,
        unique_by=["o_orderkey"],
        large=large,
        derived=long_orders is None,
    ).withColumnRenamed("c_custkey", "_owner")
    if large is not None:
        large = large.withColumnRenamed("c_custkey", "_owner")
    customers = table(spark, sf_dir, "customer").select("c_custkey")
    joined = join_parts(customers, "c_custkey", parts, "_owner", part_size, large)
    order_offset = F.coalesce(F.col("part_no") * part_size, F.lit(0)).cast("bigint")
    whole = joined.select(
        "c_custkey", order_offset.alias("order_offset"), F.lit(0).cast("bigint").alias("line_offset"), "order"
    )
    if long_orders is None:
        return whole
    places = number_rows(orders, ["o_orderkey"], ["c_custkey"], into="_place")
    long_places = places.join(long_orders.select(F.col("l_orderkey").alias("o_orderkey")), "o_orderkey", "left_semi")
    going_on = nested.where("part_no > 0").join(long_places.select("o_orderkey", "_place"), "o_orderkey")
    return whole.unionByName(
        going_on.join(customers, "c_custkey", "left_semi").select(
            "c_custkey",
            (F.col("_place") - 1).alias("order_offset"),
            "line_offset",
            F.array(F.struct("o_orderkey", "line")).alias("order"),
        )
    )
