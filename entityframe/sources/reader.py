"""``EntityReader``: options in, typed and flattened DataFrame out, over Spark's own file scan."""

from __future__ import annotations

import json
import re
import zlib
from dataclasses import replace

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from entityframe.functions.numbering import column
from entityframe.functions.paths import array_paths
from entityframe.operators.flatten import flatten
from entityframe.operators.infer import as_variant, infer_schema, parse_records
from entityframe.options import OptionError, ScanOptions, parse_offsets
from entityframe.sources import answers as api
from entityframe.sources import log, paging, rejects
from entityframe.sources.landing import (
    PAGE_COLUMNS,
    entity_path,
    landed_schema,
    sizes_from_manifest,
    stage,
    tenant_path,
)
from entityframe.sources.observed import Observations


class EntityReader:
    """Builds one load the way ``spark.read`` does.

    Pages are Parquet written by ``write_landing`` or, with ``fileFormat`` set
    to ``json``, files of one JSON record per line as an API exporter leaves
    them. With ``jsonPages`` a line is one answer of the API: a page of records
    with its place among all of them.

    >>> EntityReader(spark).option("path", root).option("companyId", "001") \\
    ...     .option("entity", "invoice").option("expandArrays", True).load()
    """

    def __init__(self, spark: SparkSession):
        self._spark = spark
        self._options: dict[str, object] = {}
        self._inferred: dict[ScanOptions, T.StructType] = {}
        self._parsed: dict[tuple, DataFrame] = {}
        self._counts: list[Observation] = []

    def option(self, name: str, value) -> "EntityReader":
        self._options[name.lower()] = value
        return self

    def options(self, **options) -> "EntityReader":
        for name, value in options.items():
            self.option(name, value)
        return self

    def schema(self, schema) -> "EntityReader":
        return self.option("schema", schema)

    @property
    def scan_options(self) -> ScanOptions:
        return ScanOptions.from_options(self._options)

    def _tenant(self) -> tuple[str, str, str, str]:
        options = self.scan_options
        if not options.path:
            raise OptionError("path is required")
        if options.company_id is None:
            raise OptionError("companyId is required")
        return options.path, options.entity, options.environment, options.company_id

    def record_schema(self) -> T.StructType:
        """The stated schema, else the landed one, else (JSON) the one all records have together."""
        options = self.scan_options
        if options.schema is not None:
            return options.schema
        if options.file_format == "json":
            source = replace(options, array_sizes="max")  # plays no part, and a mapping has no hash
            if source not in self._inferred:
                self._inferred[source] = self._infer_json()
            return self._inferred[source]
        return self._state().schema

    def _infer_json(self) -> T.StructType:
        options = self.scan_options
        how = {
            "decimals": options.decimal_forced,  # a stated decimalType keeps fractions exact
            "on_conflict": options.on_conflict,
        }
        skip = options.on_unreadable == "reject"
        if options.sample_rows == "all" and not options.json_pages:
            where = self._tenant()
            try:
                return Observations(self._spark, entity_path(*where[:2]), tenant_path(*where), skip).schema(**how)
            except AnalysisException as error:
                if error.getCondition() != "PATH_NOT_FOUND":
                    raise
                raise self._nothing_landed() from error
        lines = self._json_lines()
        how["skip_unreadable"] = skip
        if options.sample_rows == "all":
            return infer_schema(lines, "value", **how)
        record = as_variant(lines, "value", options.on_unreadable == "reject")
        lines = lines.where(~F.is_variant_null(record))
        # Number keys sort as numbers, any other as text.
        keys = {
            f"k{i}{kind}": F.try_variant_get(record, f"$[{json.dumps(name)}]", dtype)
            for i, name in enumerate(options.order_by)
            for kind, dtype in (("n", "decimal(38,10)"), ("t", "string"))
        }
        return infer_schema(
            lines.withColumns(keys), "value", options.sample_rows, list(keys), **how
        )

    def _state(self) -> log.State:
        root, entity, env, company_id = self._tenant()
        tenant_path(root, entity, env, company_id)  # refuses names that cannot be directories
        state = log.company_state(self._spark, entity_path(root, entity), env, company_id, self.scan_options.version)
        if state is None:
            raise self._nothing_landed()
        return state

    def _nothing_landed(self) -> OptionError:
        return OptionError(
            f"no pages of {self.scan_options.table_name} are landed; "
            "give an explicit schema to read an empty entity"
        )

    def _text_lines(self) -> DataFrame:
        try:
            lines = self._spark.read.text(tenant_path(*self._tenant()))
        except AnalysisException as error:
            raise self._nothing_landed() from error
        return lines.where(F.trim("value") != "")

    def answers(self) -> DataFrame:
        """Landed API answers, parsed once per reader into a staged table; see ``parse_answers``."""
        where = self._tenant()
        if where not in self._parsed:
            self._parsed[where] = stage(api.parse_answers(self._text_lines()), "answers")
        return self._parsed[where]

    def coverage(self) -> DataFrame:
        """Positions that the landed answers do not give exactly once; none of an entity answered whole."""
        return api.coverage(self.answers())

    def _json_lines(self) -> DataFrame:
        """``value``: one record per row, of answers as a variant with its page and place."""
        options = self.scan_options
        if not options.json_pages:
            return self._text_lines()
        key = (*self._tenant(), options.answers)
        if key not in self._parsed:
            found = self.answers()
            if options.answers != "any":
                api.check_answers(found, repeats=options.answers == "distinct")
            if options.answers == "distinct":
                found = stage(api.without_repeats(found), "distinct")
            self._parsed[key] = found
        return api.answer_records(self._parsed[key], options.page_size)

    def rejects(self) -> DataFrame:
        """``file, line, problem, text`` of JSON lines that are no record of the schema."""
        options = self.scan_options
        if options.file_format != "json" or options.json_pages:
            raise OptionError("rejects are kept for fileFormat json without jsonPages")
        return rejects.rejected(self._spark, tenant_path(*self._tenant()), self.record_schema())

    def counts(self) -> dict[str, int]:
        """``records`` and ``rejected`` of the last load under onUnreadable reject, once an action has run on it."""
        if not self._counts:
            raise OptionError("counts are kept of a load with onUnreadable set to reject")
        return self._counts[-1].get

    def pages(self) -> DataFrame:
        """Landed records as they are, with ``page_no`` and ``pos_in_page`` where they were paged.

        Only the company's own directory is listed; ``env`` and ``company_id``
        are dropped, as they are constants of the load.
        """
        try:
            return self._landed_pages()
        except (AnalysisException, OptionError):
            if self.scan_options.schema is None or self._anything_landed():
                raise
            # A stated schema is enough to read an entity that has never been landed.
            return self._spark.createDataFrame([], self._page_schema())

    def _page_schema(self) -> T.StructType:
        fields = landed_schema(self.record_schema()).fields
        paged = self.scan_options.file_format == "parquet" or self.scan_options.json_pages
        return T.StructType(fields[:-3] if paged else self.record_schema().fields)

    def _anything_landed(self) -> bool:
        if self.scan_options.file_format == "parquet":
            try:
                return self._state() is not None
            except OptionError:
                return False
        try:
            self._spark.read.text(tenant_path(*self._tenant()))
        except AnalysisException:
            return False
        return True

    def _landed_pages(self) -> DataFrame:
        root, entity, env, company_id = self._tenant()
        if self.scan_options.file_format == "json":
            keep = PAGE_COLUMNS if self.scan_options.json_pages else ()
            lines, schema = self._json_lines(), self.record_schema()
            if self.scan_options.on_unreadable == "reject" and not keep:
                self._counts.append(Observation(f"records-{len(self._counts)}"))
                return rejects.accepted(lines, schema, self._counts[-1])
            if keep and self.scan_options.schema is not None:  # a cast would be less strict than reading text
                lines = lines.withColumn("value", F.to_json("value"))
            records = parse_records(lines, "value", schema, keep)
            own = [name for name in records.columns if name not in keep]
            return records.select(*map(column, own), *keep)
        state = self._state()
        where = tenant_path(root, entity, env, company_id)
        schema = self.scan_options.schema or state.schema
        return (
            self._spark.read.schema(landed_schema(schema))
            .option("basePath", entity_path(root, entity))
            .parquet(*(f"{where}/landing={landing}" for landing in state.landings))
            .drop("env", "company_id", "landing")
        )

    def load(self) -> DataFrame:
        records = self.pages().drop(*PAGE_COLUMNS)
        return flatten(records, self._with_landed_sizes(records))

    def _with_landed_sizes(self, records: DataFrame) -> ScanOptions:
        """Widths were counted when the pages were landed, so no load has to count them again."""
        options = self.scan_options
        policy = options.array_sizes
        if options.file_format == "parquet" and options.expand_arrays and not options.array_offsets:
            options = replace(options, array_offsets=self._landed_offsets(records.schema))
        if not (options.expand_structs and isinstance(policy, str)):
            return options
        paths = array_paths(records.schema)
        if options.file_format != "parquet" or not paths:
            return options
        try:
            manifest = self._state()
        except OptionError:
            if options.schema is None:
                raise
            return options if self._anything_landed() else replace(options, array_sizes={p: 0 for p in paths})
        if policy == "first" and options.order_by and ",".join(options.order_by) != manifest.order_by:
            return options
        # Without expandArrays the widths still tell which arrays never have an element.
        landed = sizes_from_manifest(manifest.max_sizes if policy == "max" else manifest.first_sizes)
        return replace(options, array_sizes={path: landed.get(path, 0) for path in paths})

    def _landed_offsets(self, schema: T.StructType):
        """Arrays that were landed in parts; a stated schema may leave them out."""
        try:
            offsets = parse_offsets(self._state().array_offsets)
        except OptionError:  # nothing landed: ``pages`` has decided whether that is an error
            return ()
        known = set(array_paths(schema))
        return tuple((path, name) for path, name in offsets if path in known and name in schema.names)

    def envelope(self) -> DataFrame:
        """``start_position``, ``max_results`` and ``total_count`` of a full read."""
        if self.scan_options.json_pages:
            return api.stated_envelope(self.answers())
        return paging.scan_envelope(self.pages())

    def page_manifest(self) -> DataFrame:
        """Pages of ``pageSize`` records; counting Parquet records reads file footers only."""
        return paging.page_manifest(self._spark, self.pages().count(), self.scan_options.page_size)

    def batch_manifest(self) -> DataFrame:
        options = self.scan_options
        return paging.batch_manifest(
            self._spark, self.pages().count(), options.page_size, options.batch_size
        )

    def sample(self, rows: int) -> DataFrame:
        """The first ``rows`` landed records in page order.

        Pages say where a record lies, so the scan skips all files and row groups of later pages.
        """
        state, options = self._state(), self.scan_options
        if options.file_format != "parquet":
            raise OptionError("samples in page order are taken from landed Parquet pages")
        last = (rows - 1) // state.page_size
        return self.pages().where(F.col("page_no") <= last).orderBy(*PAGE_COLUMNS).limit(rows)

    def load_view(self) -> str:
        """Register the load as a temporary view and return the view's name."""
        name = view_name(self.scan_options)
        self.load().createOrReplaceTempView(name)
        return name


def companies(spark: SparkSession, root: str, entity: str, schema: T.StructType, version: int | None = None) -> DataFrame:
    """All companies of an entity at once; filters on ``env`` and ``company_id`` prune directories.

    What counts is joined on the directory columns, so Spark reads only those landings.
    """
    base = entity_path(root, entity)
    pages = spark.read.schema(landed_schema(schema)).parquet(base)
    counted = [
        log.counted_landings(spark, base, env, version).select(F.lit(env).alias("env"), "company_id", "landing")
        for env in ("production", "sandbox")
    ]
    kept = pages.join(counted[0].union(counted[1]), ["env", "company_id", "landing"], "left_semi")
    return kept.drop("landing").withColumn("table_name", F.concat_ws(":", "company_id", F.lit(entity)))


def view_name(options: ScanOptions) -> str:
    """``companyId:entity`` as a plain SQL identifier; names of more than letters and digits end in a hash of them."""
    name = re.sub(r"\W", "_", options.table_name)
    if not options.table_name.replace(":", "", 1).isalnum():
        name = f"{name}_{zlib.crc32(options.table_name.encode()):08x}"
    return name if not name[0].isdigit() else f"t_{name}"
