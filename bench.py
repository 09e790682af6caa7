"""Times the queries at one scale and prints one JSON line.

Each query is planned and run in full (every output cell is computed and
dropped by the no-op sink), in three rounds over all queries; the fastest of its
runs is reported, so that JVM start-up and compilation are not charged to the
queries that happen to come first. ``partitions`` is what a plan asks for before
Spark merges partitions that are small at this scale.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from entityframe.plans.queries import QUERIES  # noqa: E402

HEADLINE = [
    "sql_over_entity",
    "flatten_structs",
    "expand_arrays",
    "expand_arrays_max",
    "expand_nested_arrays",
    "expand_scalar_array",
    "page_assign",
    "page_reassemble",
    "tenant_select",
    "reader_load_expanded",
    "format_load",
    "infer_schema",
    "array_profile",
    "coerce_types",
    "coerce_nested",
    "json_entity",
    "landing_two_schemas",
    "envelope_pages",
    "page_coverage",
    "landing_append",
    "infer_number_profile",
    "unflatten_round_trip",
    "sql_over_landed",
]
# Input rows a query has to read, for the throughput figures.
ROWS_READ = {
    "sql_over_entity": ("orders", "lineitem"),
    "flatten_structs": ("orders",),
    "expand_arrays": ("orders", "lineitem"),
    "page_assign": ("orders",),
}


def session() -> SparkSession:
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("entityframe-bench")
        .config("spark.sql.shuffle.partitions", cpus if cpus.isdigit() else "8")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="bench-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    wanted = os.environ.get("BENCH_QUERIES")
    names = wanted.split(",") if wanted else HEADLINE
    if wanted == "all":
        names = list(QUERIES)
    spark = session()

    def run(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    rounds = [{name: run(name) for name in names} for _ in range(3)]
    seconds = {name: round(min(times[name] for times in rounds), 3) for name in names}

    count = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet").count() for t in ("orders", "lineitem")}
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    partitions = {
        name: QUERIES[name](spark, sf_dir).rdd.getNumPartitions()
        for name in ROWS_READ
        if name in seconds
    }
    rates = {
        name: round(sum(count[t] for t in tables) / seconds[name])
        for name, tables in ROWS_READ.items()
        if name in seconds
    }
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "rows_per_sec": rates,
                "partitions": partitions,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
