"""Landed pages: one directory per entity, environment, company and landing.

::

    <root>/<entity>/env=<env>/company_id=<id>/landing=<l>/*.parquet     records, page_no, pos_in_page
    <root>/<entity>/_manifest/env=<env>/landing=<l>/company_id=<id>/    schema, record count, array sizes
    <root>/<entity>/_log/env=<env>/<version>.json                       which landing, replacing or appending

Entities have different schemas, so they never share a root. Within a file the
records are in page order. Only landings in the log are read (``log``).
"""

from __future__ import annotations

import json
import re
import tempfile
import uuid
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from entityframe.functions.numbering import column, whole_div
from entityframe.operators.flatten import check_offsets, largest_sizes
from entityframe.operators.infer import merge_schemas
from entityframe.options import BATCH_SIZE, PAGE_SIZE, OptionError, parse_offsets
from entityframe.sources import log
from entityframe.sources.log import APPEND, REPLACE
from entityframe.sources.paging import assign_pages

PAGE_COLUMNS = ("page_no", "pos_in_page")
BATCHES_PER_FILE = 16


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder under the cluster's shared one (``spark.checkpoint.dir``).

    Only a local session, where every task runs on this machine, is given a
    temporary folder of its own, once, if it has none.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise OptionError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="entityframe-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/entityframe/{purpose}-{uuid.uuid4().hex}"


def stage(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written to the shared folder and read back.

    For a derived frame that is read several times: its joins and aggregates
    run once, later passes read only the columns they use, and a lost executor
    costs no more than its own tasks.
    """
    path = shared_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# Company ids and entity names become directory names as they are.
SAFE_NAME = r"^[A-Za-z0-9][A-Za-z0-9._-]*$"


def check_name(what: str, value: str) -> str:
    if not re.match(SAFE_NAME, value):
        raise OptionError(f"{what} {value!r} must be letters, digits, dots, dashes and underscores")
    return value


def tenant_path(root: str, entity: str, env: str, company_id: str) -> str:
    return f"{root.rstrip('/')}/{check_name('entity', entity)}/{_tenant_dir(env, company_id)}"


def entity_path(root: str, entity: str) -> str:
    return f"{root.rstrip('/')}/{check_name('entity', entity)}"


def _tenant_dir(env: str, company_id: str) -> str:
    return f"env={env}/company_id={check_name('company id', company_id)}"


def write_landing(
    records: DataFrame,
    root: str,
    entity: str,
    company_id: str | Column,
    order_by: list[str],
    production: bool = False,
    page_size: int = PAGE_SIZE,
    batch_size: int = BATCH_SIZE,
    batches_per_file: int = BATCHES_PER_FILE,
    derived: bool = False,
    array_offsets: Mapping | None = None,
    mode: str = REPLACE,
) -> int | None:
    """Land ``records`` as pages, for one company or, given a column, for each of its values.

    Each company is paged on its own. The records are shuffled once, to number
    them; no file holds more than ``batches_per_file`` batches. Pages a company
    already had no longer count, so a repeated run changes nothing; with ``mode="append"`` they
    do, the new records take the positions after them, and the schemas must merge. All of a
    landing counts from the moment its version is published, which is returned
    (None if there was nothing to land); earlier versions can still be read. ``derived``
    says that ``records`` are the result of joins or aggregates, which are then
    staged: numbering reads its keys more than once. ``array_offsets`` names, for arrays that
    continue in further records, the field that says how many elements lie before; readers
    then take sizes and indexes as those of the whole array.
    """
    offsets = dict(parse_offsets(array_offsets or {}))
    check_offsets(records.schema, offsets)
    own = {"company_id", "env", "position", "batch_no", *PAGE_COLUMNS}
    clash = own & {name.lower() for name in records.columns}
    if clash:
        raise OptionError(f"record fields clash with landing columns: {', '.join(sorted(clash))}")
    if derived:
        records = stage(records, f"stage-{entity}")
    if mode not in (REPLACE, APPEND):
        raise OptionError(f"mode must be {REPLACE} or {APPEND}, not {mode!r}")
    spark = records.sparkSession
    env = "production" if production else "sandbox"
    base = entity_path(root, entity)
    after = max((e.version for e in log.entries(log.Files(spark, base), base, env)), default=0)
    landing = uuid.uuid4().hex
    by_company = isinstance(company_id, Column)
    if by_company:
        company = company_id.cast("string")
        unusable = F.concat(
            F.lit("no directory can be named after company id "), F.coalesce(company, F.lit("null"))
        )
        records_of = records.withColumn(
            "company_id",
            F.when(company.rlike(SAFE_NAME), company).otherwise(F.raise_error(unusable)),
        )
        paged = assign_pages(records_of, order_by, page_size, batch_size, ["company_id"])
        if mode == APPEND:
            paged = _after_landed(paged, log.counted_landings(spark, base, env, after), page_size)
            _check_schemas(log.counted_landings(spark, base, env, after), records.schema)
        placed = paged.select(
            *map(column, records.columns), *PAGE_COLUMNS, F.lit(env).alias("env"), "company_id", F.lit(landing).alias("landing")
        ).sortWithinPartitions("company_id", *PAGE_COLUMNS)
        writer, target = placed.write.partitionBy("env", "company_id", "landing"), base
        written = f"{base}/env={env}/company_id=*/landing={landing}"
    else:
        # Numbering leaves each task's rows in page order, and there is one directory to write.
        paged = assign_pages(records, order_by, page_size, batch_size)
        state = log.company_state(spark, base, env, check_name("company id", company_id)) if mode == APPEND else None
        if state is not None:
            merge_schemas(state.schema, records.schema)
            paged = _moved(paged, F.lit(state.records), page_size)
        writer = paged.select(*map(column, records.columns), *PAGE_COLUMNS).write
        target = written = f"{tenant_path(root, entity, env, company_id)}/landing={landing}"
    writer.mode("append").option("maxRecordsPerFile", page_size * batch_size * batches_per_file).parquet(target)
    if by_company and not log.Files(spark, base).names(written):
        return None
    landed = spark.read.schema(landed_schema(records.schema)).option("basePath", base).parquet(written)
    totals = _totals(
        landed.groupBy("company_id") if by_company else landed, records.schema, page_size, offsets
    )
    if not by_company:  # one row even for an entity without records
        totals = totals.withColumn("company_id", F.lit(company_id))
    manifest = totals.select(
        F.lit(env).alias("env"),
        F.lit(landing).alias("landing"),
        "*",
        F.lit(records.schema.json()).alias("schema"),
        F.lit(page_size).alias("page_size"),
        F.lit(batch_size).alias("batch_size"),
        F.lit(",".join(order_by)).alias("order_by"),
        F.lit(json.dumps(list(offsets.items()))).alias("array_offsets"),
    )
    manifest.write.mode("append").partitionBy("env", "landing", "company_id").json(f"{base}/{log.MANIFEST}")
    return log.publish(spark, base, env, landing, mode, after)


def _moved(paged: DataFrame, before: Column, page_size: int) -> DataFrame:
    """Pages whose positions come after ``before`` others."""
    place = F.col("page_no") * page_size + F.col("pos_in_page") + before
    moved = paged.withColumn("_place", place)
    return moved.withColumns(
        {"page_no": whole_div(F.col("_place"), page_size), "pos_in_page": F.pmod("_place", F.lit(page_size))}
    ).drop("_place")


def _after_landed(paged: DataFrame, counted: DataFrame, page_size: int) -> DataFrame:
    before = counted.groupBy("company_id").agg(F.sum("records").alias("_landed"))
    joined = paged.join(before, "company_id", "left")
    return _moved(joined, F.coalesce("_landed", F.lit(0)), page_size).drop("_landed")


def _check_schemas(counted: DataFrame, new: T.StructType) -> None:
    """Fails where the schema of some company cannot take in the new one; a row per different schema is looked at."""
    for row in counted.select("schema").distinct().toLocalIterator():
        merge_schemas(T.StructType.fromJson(json.loads(row["schema"])), new)


def _totals(landed, schema: T.StructType, page_size: int, offsets: Mapping) -> DataFrame:
    """Record count and array widths, from one pass over the arrays alone.

    Fails unless the positions follow each other without gap: numbering reads its input
    several times, so one that changes meanwhile leaves gaps or repeats.
    """
    sizes = largest_sizes(schema, offsets)
    position = F.col("page_no") * page_size + F.col("pos_in_page") + 1
    n = F.count(F.lit(1))
    total = F.sum(position.cast("decimal(38,0)"))
    low, high = F.min(position), F.max(position)
    twice = n.cast("decimal(18,0)") * (low + high).cast("decimal(19,0)")
    wrong = (n > 0) & ((high - low + 1 != n) | (total * 2 != twice))
    message = F.lit("positions are not those of the records; land a frame that reads the same each time")
    counted = landed.agg(
        F.coalesce(low, F.lit(1)).alias("first_position"),
        F.when(wrong, F.raise_error(message).cast("bigint")).otherwise(n).alias("records"),
        *(F.max(size).alias(f"max{i}") for i, (_, size) in enumerate(sizes)),
        *(F.min_by(size, position).alias(f"first{i}") for i, (_, size) in enumerate(sizes)),
    )
    kept = [name for name in ("company_id",) if name in counted.columns]

    def widths(policy: str) -> Column:
        entries = [
            F.struct(
                F.array(*map(F.lit, path)).alias("path"),
                F.coalesce(F.col(f"{policy}{i}"), F.lit(0)).alias("size"),
            )
            for i, (path, _) in enumerate(sizes)
        ]
        return F.to_json(F.array(*entries)) if entries else F.lit("[]")

    return counted.select(
        *kept, "records", "first_position", widths("max").alias("max_sizes"), widths("first").alias("first_sizes")
    )


def landed_schema(records: T.StructType) -> T.StructType:
    """Record fields, page columns, and partition columns as text: company ``001`` stays ``001``."""
    return T.StructType(
        [
            *records.fields,
            *(T.StructField(name, T.LongType()) for name in PAGE_COLUMNS),
            T.StructField("env", T.StringType()),
            T.StructField("company_id", T.StringType()),
            T.StructField("landing", T.StringType()),
        ]
    )


def sizes_from_manifest(text: str) -> dict[tuple[str, ...], int]:
    return {tuple(entry["path"]): entry["size"] for entry in json.loads(text)}
