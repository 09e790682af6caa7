"""Counting, page and batch manifests, page assignment and the scan envelope.

Positions are 1-based, pages and batches 0-based. A page holds ``page_size``
records and a batch ``batch_size`` pages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from entityframe.functions.numbering import number_rows, whole_div
from entityframe.operators.flatten import first_rows
from entityframe.options import BATCH_SIZE, PAGE_SIZE


def entity_count(df: DataFrame) -> DataFrame:
    """``n``: the record count."""
    return df.agg(F.count(F.lit(1)).alias("n"))


def _pieces(total: int, size: int) -> int:
    return -(-total // size)


def page_manifest(spark: SparkSession, total: int, page_size: int = PAGE_SIZE) -> DataFrame:
    """One row per page. A range, not an exploded array: it is made in parallel at any count."""
    start = F.col("id") * page_size
    return spark.range(_pieces(total, page_size)).select(
        F.col("id").alias("page_no"),
        (start + 1).alias("start_position"),
        F.least(F.lit(page_size), F.lit(total) - start).alias("max_results"),
    )


def batch_manifest(
    spark: SparkSession, total: int, page_size: int = PAGE_SIZE, batch_size: int = BATCH_SIZE
) -> DataFrame:
    """One row per batch of pages, by arithmetic instead of grouping the page manifest."""
    pages = _pieces(total, page_size)
    rows_per_batch = page_size * batch_size
    return spark.range(_pieces(pages, batch_size)).select(
        F.col("id").alias("batch_no"),
        F.least(F.lit(batch_size), F.lit(pages) - F.col("id") * batch_size).alias("pages"),
        F.least(F.lit(rows_per_batch), F.lit(total) - F.col("id") * rows_per_batch).alias(
            "row_count"
        ),
    )


def assign_pages(
    df: DataFrame,
    order_by: list[str],
    page_size: int = PAGE_SIZE,
    batch_size: int = BATCH_SIZE,
    group_by: list[str] = (),
    buckets: int | None = None,
) -> DataFrame:
    """Append ``position``, ``page_no``, ``pos_in_page`` and ``batch_no`` in key order.

    ``group_by`` pages each tenant on its own. The key must be unique, so that
    no record can move between pages from one read to the next.
    """
    numbered = number_rows(df, order_by, group_by, into="position", buckets=buckets)
    before = F.col("position") - 1
    return (
        numbered.withColumn("page_no", whole_div(before, page_size))
        .withColumn("pos_in_page", before - F.col("page_no") * page_size)
        .withColumn("batch_no", whole_div(F.col("page_no"), batch_size))
    )


def reassemble(pages: DataFrame) -> DataFrame:
    """Landed records in page order; the only place a total order is paid for."""
    return pages.orderBy("page_no", "pos_in_page")


def sample_records(df: DataFrame, order_by, rows: int | str = "all") -> DataFrame:
    """The records a schema is inferred from: all of them, or the first few by key."""
    return df if rows == "all" else first_rows(df, order_by, int(rows))


def scan_envelope(df: DataFrame) -> DataFrame:
    """One row about a full read: where it starts, how many records it gave, how many there are."""
    return df.agg(
        F.lit(1).cast("bigint").alias("start_position"),
        F.count(F.lit(1)).alias("max_results"),
        F.count(F.lit(1)).alias("total_count"),
    )
