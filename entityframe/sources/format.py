"""``spark.read.format("entity_pages")``: the registered reader over landed pages.

Every landed file is one input partition, read as a stream of Arrow batches, so
no task or driver ever holds an entity. The options are those of
``EntityReader``, which should be preferred where a query filters or uses few
columns: Spark can push neither into a Python data source.
"""

from __future__ import annotations

import json
import os
import sys

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs
import pyarrow.parquet
from pyspark import cloudpickle
from pyspark.sql import SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.pandas.types import to_arrow_type

from entityframe.functions.paths import FlatColumn, check_collisions, walk
from entityframe.functions.typing import converted_type
from entityframe.options import OptionError, ScanOptions
from entityframe.sources import log
from entityframe.sources.landing import entity_path, sizes_from_manifest, tenant_path

SHORT_NAME = "entity_pages"
ROWS_PER_BATCH = 10_000


def register(spark: SparkSession) -> None:
    """Make the format known to the session; executors need no installed copy of the package."""
    cloudpickle.register_pickle_by_value(sys.modules["entityframe"])
    spark.dataSource.register(EntityPages)


def open_path(path: str) -> tuple[pyarrow.fs.FileSystem, str]:
    if path.startswith("file:"):
        path = "/" + path[len("file:") :].lstrip("/")
    if "://" in path:
        return pyarrow.fs.FileSystem.from_uri(path)
    return pyarrow.fs.LocalFileSystem(), os.path.abspath(path)


def data_files(path: str) -> list[str]:
    fs, base = open_path(path)
    found = fs.get_file_info(pyarrow.fs.FileSelector(base, allow_not_found=True))
    names = (info.path for info in found if info.type == pyarrow.fs.FileType.File)
    return sorted(n for n in names if not n.rsplit("/", 1)[-1].startswith(("_", ".")))


def _read(fs: pyarrow.fs.FileSystem, name: str) -> str:
    with fs.open_input_stream(name) as stream:
        return stream.read().decode().strip()


def read_state(options: ScanOptions) -> log.State:
    """What counts of the company, as the reader finds it, through pyarrow: no session is at hand here."""
    base, env = entity_path(options.path, options.entity), options.environment
    fs, _ = open_path(base)
    published = [log.read_entry(_read(fs, name)) for name in data_files(log.log_path(base, env))]
    published = [e for e in published if options.version is None or e.version <= options.version]
    manifests = {}
    for entry in published:
        for name in data_files(f"{log.manifest_root(base, env)}/landing={entry.landing}/company_id={options.company_id}"):
            text = _read(fs, name)
            if text:
                manifests[entry.landing] = json.loads(text)
    state = log.fold(published, manifests)
    if state is None:
        raise OptionError(f"no pages of {options.table_name} are landed")
    return state


def array_sizes(options: ScanOptions, manifest: log.State) -> dict:
    """Stated sizes, or the widths counted when the pages were landed."""
    if isinstance(options.array_sizes, dict):
        return options.array_sizes
    if options.array_sizes == "first" and options.order_by:
        if ",".join(options.order_by) != manifest.order_by:
            raise OptionError(
                "the format knows the widths of the first record by the landing order only; "
                "EntityReader looks up the first by another key"
            )
    return sizes_from_manifest(getattr(manifest, f"{options.array_sizes}_sizes"))


def output_columns(options: ScanOptions, manifest: log.State) -> list[FlatColumn]:
    if options.expand_arrays and json.loads(manifest.array_offsets):
        raise OptionError("arrays were landed in parts; EntityReader knows their places in the whole array")
    records = manifest.schema
    roots = [FlatColumn(f.name, (f.name,), f.dataType) for f in records.fields]
    if not options.expand_structs:
        return roots
    flat = walk(
        records,
        array_sizes(options, manifest),
        options.expand_arrays,
        options.max_flat_columns,
    )
    check_collisions(flat, records.names if options.keep_nested else [], False)
    return [*roots, *(c for c in flat if not c.is_root)] if options.keep_nested else flat


class EntityPages(DataSource):
    @classmethod
    def name(cls) -> str:
        return SHORT_NAME

    def _parsed(self) -> ScanOptions:
        if "schema" in self.options:
            raise OptionError("state a schema with .schema(...), not as an option")
        options = ScanOptions.from_options(self.options)
        if options.file_format != "parquet":
            raise OptionError("the registered format reads Parquet pages")
        if not options.path or options.company_id is None:
            raise OptionError("path and companyId are required")
        return options

    def schema(self) -> T.StructType:
        options = self._parsed()
        return T.StructType(
            [
                T.StructField(
                    c.name,
                    converted_type(c.dtype, options),
                    True,
                    {} if c.is_root else c.metadata,
                )
                for c in output_columns(options, read_state(options))
            ]
        )

    def reader(self, schema: T.StructType) -> DataSourceReader:
        options = self._parsed()
        known = {c.name: c for c in output_columns(options, read_state(options))}
        return PageReader(options, schema, [known.get(f.name) for f in schema.fields])


class PageFile(InputPartition):
    def __init__(self, path: str):
        super().__init__(path)


class PageReader(DataSourceReader):
    def __init__(self, options: ScanOptions, schema: T.StructType, sources: list):
        self.options, self.schema, self.sources = options, schema, sources

    def partitions(self) -> list[InputPartition]:
        o = self.options
        where = tenant_path(o.path, o.entity, o.environment, o.company_id)
        return [
            PageFile(name)
            for landing in read_state(o).landings
            for name in data_files(f"{where}/landing={landing}")
        ]

    def read(self, partition: PageFile):
        fs, _ = open_path(self.options.path)
        roots = sorted({c.steps[0] for c in self.sources if c is not None})
        fields = [
            pa.field(f.name, to_arrow_type(f.dataType, timestamp_utc=True)) for f in self.schema.fields
        ]
        with fs.open_input_file(partition.value) as file:
            pages = pyarrow.parquet.ParquetFile(file, coerce_int96_timestamp_unit="us")
            # An empty column list would lose the row count.
            present = [r for r in roots if r in pages.schema_arrow.names] or ["page_no"]
            for batch in pages.iter_batches(ROWS_PER_BATCH, columns=present):
                columns = [
                    pa.nulls(batch.num_rows, field.type)
                    if source is None or source.steps[0] not in present
                    else as_type(take(batch, source.steps), field.type)
                    for source, field in zip(self.sources, fields)
                ]
                yield pa.RecordBatch.from_arrays(columns, schema=pa.schema(fields))


def take(batch: pa.RecordBatch, steps) -> pa.Array:
    """The column at ``steps``; null below a null parent or past the end of an array."""
    value = batch.column(batch.schema.get_field_index(steps[0]))
    for step in steps[1:]:
        if isinstance(step, int):
            long_enough = pc.greater(pc.list_value_length(value), step)
            at = pc.add(value.offsets[:-1], step)
            value = value.values.take(pc.if_else(long_enough, at, pa.scalar(None, at.type)))
        else:
            value = pc.struct_field(value, step)
    return value


def as_type(value: pa.Array, target: pa.DataType) -> pa.Array:
    """``value`` under the scalar rules, at any depth."""
    source = value.type
    if source == target:
        return value
    if pa.types.is_struct(target):
        names = [source.field(i).name for i in range(source.num_fields)]
        children = [
            as_type(pc.struct_field(value, f.name), f.type)
            if f.name in names
            else pa.nulls(len(value), f.type)
            for f in target
        ]
        return pa.StructArray.from_arrays(children, fields=list(target), mask=value.is_null())
    if pa.types.is_list(target):
        lengths = pc.fill_null(pc.list_value_length(value), 0).to_numpy(zero_copy_only=False)
        offsets = pa.array(np.concatenate([[0], np.cumsum(lengths)]).astype("int32"))
        items = as_type(value.flatten(), target.value_type)
        return pa.ListArray.from_arrays(offsets, items, type=target, mask=value.is_null())
    if pa.types.is_integer(target) and pa.types.is_timestamp(source):
        whole = pc.floor_temporal(value, unit="millisecond")
        return whole.cast(pa.timestamp("ms", source.tz)).cast(pa.int64())
    if pa.types.is_integer(target) and pa.types.is_date32(source):
        return value.cast(pa.timestamp("ms")).cast(pa.int64())
    if pa.types.is_decimal(target) and pa.types.is_decimal(source) and source.scale > target.scale:
        value = pc.round(value, target.scale, "half_towards_infinity")
    return value.cast(target)
