"""JSON lines that are no record of the schema: set aside with their place instead of ending the load."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from entityframe.functions.numbering import column
from entityframe.operators.infer import readable_type


def _unused(stem: str, schema: T.StructType) -> str:
    taken = {name.lower() for name in schema.fieldNames()}
    while stem.lower() in taken:
        stem = "_" + stem
    return stem


def _parsed(schema: T.StructType) -> tuple[Column, T.StructType, str]:
    """The record in a line, with a field that holds the line where it cannot be read as one."""
    readable = readable_type(schema)
    corrupt = _unused("_corrupt", readable)
    wider = T.StructType([*readable.fields, T.StructField(corrupt, T.StringType())])
    # A null record is a row without values, as in a strict load.
    source = F.when(F.trim("value") != "null", F.col("value"))
    how = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt}
    return F.from_json(source, wider, how), readable, corrupt


def accepted(lines: DataFrame, schema: T.StructType, counts: Observation) -> DataFrame:
    """The records that can be read; ``counts`` gets ``records`` and ``rejected`` in the same pass."""
    record, readable, corrupt = _parsed(schema)
    parsed = lines.select(record.alias("_record"))
    bad = F.coalesce(F.col("_record").getField(corrupt).isNotNull(), F.lit(False))
    seen = parsed.observe(
        counts,
        F.count(F.when(~bad, 1)).alias("records"),
        F.count(F.when(bad, 1)).alias("rejected"),
    )
    return seen.where(~bad).select(*(F.col("_record").getField(f.name).alias(f.name) for f in readable.fields))


def rejected(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """``file, line, problem, text`` of each line that is no record; ``line`` counts from 1 in its file.

    A file is read in blocks by several tasks. The lines before a block are added up from one
    small row per block, so no file is read by one task to count its lines.
    """
    lines = spark.read.text(path).select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_row"),
    )
    blocks = lines.groupBy("file", "_block").agg(F.min("_row").alias("_first"), F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy("file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("_n").over(earlier), F.lit(0))
    blocks = blocks.withColumn("_before", before)
    record, _, corrupt = _parsed(schema)
    bad = lines.where(F.trim("value") != "").where(record.getField(corrupt).isNotNull())
    problem = F.when(F.try_parse_json("value").isNull(), "not JSON").otherwise("not a record of the schema")
    return bad.join(blocks, ["file", "_block"]).select(
        "file",
        (F.col("_before") + F.col("_row") - F.col("_first") + 1).alias("line"),
        problem.alias("problem"),
        column("value").alias("text"),
    )
