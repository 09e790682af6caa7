"""Intermediate tables in the folder that the whole cluster shares."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_path(spark: SparkSession, purpose: str) -> str:
    """A new path under ``spark.checkpoint.dir``.

    Only where that is unset and every task runs on this machine, as in tests,
    a temporary folder takes its place.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="llm-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/llm/{purpose}-{uuid.uuid4().hex}"


def stage(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written to the shared folder and read back, which cuts its lineage.

    A lost executor then repeats only its own tasks, and a frame used more than
    once is computed once.
    """
    path = shared_path(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
