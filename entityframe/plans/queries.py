"""One query per operator over the given tables; ``ORACLES`` holds the same results in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from entityframe.functions.typing import convert
from entityframe.operators.coerce import coerce, project
from entityframe.operators.flatten import array_profile, flatten, lineage
from entityframe.operators.infer import (
    infer_schema,
    number_profile,
    parse_records,
    schema_paths,
    union_entities,
)
from entityframe.operators.parts import elements, with_offsets
from entityframe.operators.unflatten import unflatten
from entityframe.options import ScanOptions
from entityframe.plans.records import (
    LINE_FIELDS,
    LINES_PER_PART,
    accounts,
    invoice_headers,
    invoices,
    table,
    with_lines,
)
from entityframe.sources import format as entity_format
from entityframe.sources import paging
from entityframe.sources.landing import (
    BATCHES_PER_FILE,
    shared_dir,
    stage,
    tenant_path,
    write_landing,
)
from entityframe.sources.reader import EntityReader, view_name

Query = Callable[[SparkSession, str], DataFrame]

PAGE_SIZE = 100
OVERLAP = 20
COMPANY = "0042"  # starts with a zero: it must stay text
REF = [
    "customer_ref_value",
    "customer_ref_name",
    "customer_ref_nation_value",
    "customer_ref_nation_name",
]
HEADER = ["o_orderkey", "part_no", "o_orderstatus", "o_totalprice", "o_orderdate"]


# --- scans and sources ---------------------------------------------------------------------


def entity_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coerce(table(spark, sf_dir, "orders"))


def _landed_orders(
    spark: SparkSession, sf_dir: str, purpose: str, batches_per_file: int = BATCHES_PER_FILE
) -> EntityReader:
    root = shared_dir(spark, purpose)
    write_landing(
        table(spark, sf_dir, "orders"),
        root,
        "orders",
        COMPANY,
        ["o_orderkey"],
        page_size=PAGE_SIZE,
        batches_per_file=batches_per_file,
    )
    return EntityReader(spark).options(path=root, companyId=COMPANY, entity="orders")


def entity_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _landed_orders(spark, sf_dir, "entity_select")
    root = orders.scan_options.path
    write_landing(table(spark, sf_dir, "customer"), root, "customer", COMPANY, ["c_custkey"])
    customers = EntityReader(spark).options(path=root, companyId=COMPANY, entity="customer")
    return (
        orders.load()
        .select(F.lit("orders").alias("entity"), F.col("o_orderkey").alias("id"))
        .union(customers.load().select(F.lit("customer"), "c_custkey"))
    )


def tenant_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = shared_dir(spark, "tenant_select")
    company = F.format_string("%03d", F.pmod("user_id", F.lit(4)))
    write_landing(table(spark, sf_dir, "events"), root, "events", company, ["event_id"])
    reader = EntityReader(spark).options(path=root, companyId="001", entity="events")
    return reader.load().select("event_id", "value")


def _landed_twice(spark: SparkSession, sf_dir: str, purpose: str) -> EntityReader:
    """Orders of even keys, then those of odd keys with one more field, appended to each company."""
    root = shared_dir(spark, purpose)
    orders = table(spark, sf_dir, "orders")
    key = F.col("o_orderkey")
    company = F.format_string("%03d", F.pmod("o_custkey", F.lit(3)))
    first = orders.where(key % 2 == 0).select("o_orderkey", "o_custkey", "o_totalprice")
    write_landing(first, root, "orders", company, ["o_orderkey"], page_size=PAGE_SIZE)
    second = orders.where(key % 2 == 1).select("o_orderkey", "o_custkey", "o_orderpriority")
    write_landing(second, root, "orders", company, ["o_orderkey"], page_size=PAGE_SIZE, mode="append")
    return EntityReader(spark).options(path=root, companyId="001", entity="orders")


def landing_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records landed later take the positions after those before, and the schemas are merged."""
    pages = _landed_twice(spark, sf_dir, "landing_append").pages()
    position = F.col("page_no") * PAGE_SIZE + F.col("pos_in_page") + 1
    return pages.select("o_orderkey", "o_totalprice", "o_orderpriority", position.alias("position"))


def landing_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What an earlier version of a landed entity held, beside what it holds now."""
    reader = _landed_twice(spark, sf_dir, "landing_snapshot")
    now = reader.load().select(F.lit("now").alias("at"), "o_orderkey", "o_orderpriority")
    earlier = reader.option("version", 1).load()
    priority = F.lit(None).cast("string") if "o_orderpriority" not in earlier.columns else F.col("o_orderpriority")
    return now.unionByName(earlier.select(F.lit("before").alias("at"), "o_orderkey", priority.alias("o_orderpriority")))


def sample_landed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first records of a landed entity, found by their page."""
    return _landed_orders(spark, sf_dir, "sample_landed").sample(250).select("o_orderkey", "o_custkey", "o_totalprice")


def landing_two_schemas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One company is landed with a further field; later landings of others leave it its schema."""
    root = shared_dir(spark, "landing_two_schemas")
    events = table(spark, sf_dir, "events")
    number = F.pmod("user_id", F.lit(4))
    company = F.format_string("%03d", number)
    first = events.where(number == 3).select("event_id", "value", "event_type")
    write_landing(first, root, "events", F.lit("003"), ["event_id"], page_size=PAGE_SIZE)
    rest = events.where(number < 3).select("event_id", "user_id")
    write_landing(rest, root, "events", company, ["event_id"])
    reader = EntityReader(spark).options(path=root, companyId="003", entity="events")
    return reader.load().select("event_id", "value", "event_type")


def _answers(paged: DataFrame, total: int, lost=None, longer=None) -> DataFrame:
    """Pages of ``paged`` as API answers, without those that are ``lost``; ``longer`` ones also give what
    the next page begins with."""
    entity = F.struct("position", "o_orderkey", "o_totalprice")
    page = F.col("page_no")
    if longer is not None:
        again = (F.col("pos_in_page") < OVERLAP) & (page > 0) & longer(page - 1)
        paged = paged.withColumn("page_no", F.explode(F.when(again, F.array(page, page - 1)).otherwise(F.array(page))))
    if lost is not None:
        paged = paged.where(~lost(F.col("page_no")))
    first = F.min("position").alias("startPosition")
    return paged.groupBy("page_no").agg(F.sort_array(F.collect_list(entity)).alias("found"), first).select(
        F.transform("found", lambda x: x.dropFields("position")).alias("entities"),
        "startPosition",
        F.size("found").alias("maxResults"),
        F.lit(total).alias("totalCount"),
    )


def _answered_orders(
    spark: SparkSession, sf_dir: str, purpose: str, more: int = 0, lost=None, longer=None, repeated=None
) -> EntityReader:
    """Orders landed as answers that state ``more`` records than there are."""
    root = shared_dir(spark, purpose)
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    paged = paging.assign_pages(orders, ["o_orderkey"], PAGE_SIZE)
    answers = _answers(paged, orders.count() + more, lost, longer)
    if repeated is not None:
        page = F.call_function("div", F.col("startPosition"), F.lit(PAGE_SIZE))
        times = F.when(repeated(page), F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
        answers = answers.withColumn("_time", F.explode(times)).drop("_time")
    answers.write.json(tenant_path(root, "orders", "sandbox", COMPANY))
    return EntityReader(spark).options(
        path=root, companyId=COMPANY, entity="orders", fileFormat="json", jsonPages=True, pageSize=PAGE_SIZE
    )


def _positioned(reader: EntityReader) -> DataFrame:
    position = F.col("page_no") * PAGE_SIZE + F.col("pos_in_page") + 1
    return reader.pages().select(position.alias("position"), "o_orderkey", "o_totalprice")


def envelope_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed API answers, a page of entities each, as one entity."""
    reader = _answered_orders(spark, sf_dir, "envelope_pages")
    total = reader.envelope().first()["total_count"]
    return _positioned(reader).withColumn("total_count", F.lit(total))


def page_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where landed answers leave gaps, overlap, or stay short of the stated total."""
    reader = _answered_orders(
        spark, sf_dir, "page_coverage", 250,
        lost=lambda page: page % 7 == 3, longer=lambda page: page % 5 == 1, repeated=lambda page: page % 6 == 2,
    )
    return reader.coverage()


def envelope_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers that overlap and were landed twice, read with each position once."""
    reader = _answered_orders(
        spark, sf_dir, "envelope_distinct", longer=lambda page: page % 5 == 1, repeated=lambda page: page % 6 == 2
    )
    return _positioned(reader.option("answers", "distinct"))


def entity_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return paging.entity_count(table(spark, sf_dir, "orders"))


def page_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    total = table(spark, sf_dir, "orders").count()
    return paging.page_manifest(spark, total, PAGE_SIZE)


def batch_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    total = table(spark, sf_dir, "orders").count()
    return paging.batch_manifest(spark, total, PAGE_SIZE)


def page_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey")
    return paging.assign_pages(orders, ["o_orderkey"], PAGE_SIZE).drop("pos_in_page")


def page_reassemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = paging.reassemble(_landed_orders(spark, sf_dir, "page_reassemble").pages())
    position = F.col("page_no") * PAGE_SIZE + F.col("pos_in_page") + 1
    return pages.select(position.alias("position"), "o_orderkey")


def sample_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coerce(paging.sample_records(table(spark, sf_dir, "orders"), ["o_orderkey"], 1))


def scan_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    return paging.scan_envelope(table(spark, sf_dir, "orders"))


def format_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    landed = _landed_orders(spark, sf_dir, "format_load", batches_per_file=1).scan_options
    entity_format.register(spark)
    return (
        spark.read.format(entity_format.SHORT_NAME)
        .option("companyId", landed.company_id)
        .option("entity", landed.entity)
        .load(landed.path)
    )


LINE_OFFSET = {("line",): "line_offset"}


def _landed_invoices(
    spark: SparkSession, sf_dir: str, purpose: str, array_offsets: dict | None = LINE_OFFSET
) -> EntityReader:
    root = shared_dir(spark, purpose)
    write_landing(
        invoices(spark, sf_dir),
        root,
        "invoice",
        COMPANY,
        ["o_orderkey", "part_no"],
        page_size=PAGE_SIZE,
        derived=True,
        array_offsets=array_offsets,
    )
    return EntityReader(spark).options(
        path=root, companyId=COMPANY, entity="invoice", expandArrays=True
    )


def format_load_expanded(spark: SparkSession, sf_dir: str) -> DataFrame:
    landed = _landed_invoices(spark, sf_dir, "format_load_expanded", None).scan_options
    entity_format.register(spark)
    loaded = (
        spark.read.format(entity_format.SHORT_NAME)
        .options(companyId=landed.company_id, entity=landed.entity, expandArrays=True)
        .load(landed.path)
    )
    # The format counts elements within a part.
    first_part = F.col("part_no") == 0
    return loaded.select(
        "o_orderkey",
        "part_no",
        *REF,
        *(F.when(first_part, F.col(c)).alias(c) for c in ("line_0_l_partkey", "line_1_l_extendedprice")),
    )


def reader_load_expanded(spark: SparkSession, sf_dir: str) -> DataFrame:
    loaded = _landed_invoices(spark, sf_dir, "reader_load_expanded").load()
    return loaded.select(
        "o_orderkey", "part_no", "o_orderdate", *REF, "line_0_l_partkey", "line_1_l_extendedprice"
    )


def json_load_expanded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Invoices landed as JSON lines: inferred over all records, parsed, expanded."""
    root = shared_dir(spark, "json_load_expanded")
    where = tenant_path(root, "invoice", "production", COMPANY)
    coerce(invoices(spark, sf_dir)).write.json(where)
    loaded = (
        EntityReader(spark)
        .options(path=root, companyId=COMPANY, entity="invoice", production=True)
        .options(fileFormat="json", expandArrays=True, arraySizes={"line": 2}, arrayOffsets={"line": "line_offset"})
        .load()
    )
    return loaded.select(
        "o_orderkey", "part_no", "o_orderdate", *REF, "line_0_l_partkey", "line_1_l_extendedprice"
    )


# --- schema inference ----------------------------------------------------------------------


def _schema_rows(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """A schema as rows: as many as it has leaves, however large the input was."""
    rows = [
        F.struct(F.lit(path).alias("path"), F.lit(dtype).alias("type"))
        for path, dtype in schema_paths(schema)
    ]
    return spark.range(1).select(F.inline(F.array(*rows)))


def infer_invoice_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    inv = coerce(invoices(spark, sf_dir))
    text = inv.select(F.to_json(F.struct("*")).alias("json"))
    return _schema_rows(spark, infer_schema(text, "json"))


def infer_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers of more digits than a double or a long holds come back as they went in."""
    wide = F.concat(F.lit("9876543210"), F.format_string("%012d", "o_orderkey"))
    cents = F.concat(F.lit("1234567"), F.format_string("%010d", "o_orderkey"), F.lit(".25"))
    text = table(spark, sf_dir, "orders").select(
        F.format_string('{"id": %d, "wide": %s, "cents": %s}', "o_orderkey", wide, cents).alias("json")
    )
    records = parse_records(text, "json", infer_schema(text, "json"))
    return records.select(
        "id", F.col("wide").cast("string").alias("wide"), F.col("cents").cast("string").alias("cents")
    )


def infer_number_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digits of each numeric field; long codes, which are text, leave the type of the amount alone."""
    key = F.col("o_orderkey")
    price = F.col("o_totalprice").cast("decimal(12,2)").cast("string")
    amount = F.when(key % 2 == 0, key.cast("string")).otherwise(F.concat(F.lit("-"), price))
    code = F.lpad(key.cast("string"), 18, "7")
    json = F.format_string('{"code": "%s", "amount": %s, "part": [{"q": %d}, {"q": %d.125}]}', code, amount, key, key)
    text = table(spark, sf_dir, "orders").select(json.alias("json"))
    types = F.create_map(*(F.lit(v) for pair in schema_paths(infer_schema(text, "json")) for v in pair))
    return number_profile(text, "json").withColumn("type", F.get(F.map_values(F.map_filter(types, lambda k, v: k == F.col("path"))), F.lit(0)))


def json_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines that broke off, and records of another shape, are reported; the others are loaded."""
    root = shared_dir(spark, "json_rejects")
    key = F.col("o_orderkey")
    whole = F.format_string('{"id": %d, "note": "%s"}', key, F.col("o_orderpriority"))
    line = (
        F.when(key % 10 == 3, F.substring(whole, 1, 12))
        .when(key % 10 == 7, F.format_string('{"id": [%d], "note": "%s"}', key, F.col("o_orderpriority")))
        .otherwise(whole)
    )
    lines = table(spark, sf_dir, "orders").select(line.alias("value"))
    lines.write.text(tenant_path(root, "orders", "sandbox", COMPANY))
    reader = EntityReader(spark).options(
        path=root, companyId=COMPANY, entity="orders", fileFormat="json", onUnreadable="reject", schema="id bigint, note string"
    )
    loaded = reader.load().select(F.lit(None).cast("string").alias("problem"), F.concat_ws(" ", "id", "note").alias("text"))
    return reader.rejects().select("problem", "text").unionByName(loaded)


def infer_increments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders that arrive state by state, each with fields of its own, read by a new reader every time."""
    root = shared_dir(spark, "infer_increments")
    where = tenant_path(root, "orders", "sandbox", COMPANY)
    orders = table(spark, sf_dir, "orders")
    cents = F.format_string("1234567%010d.25", "o_orderkey").cast("decimal(38,2)")
    fields = {
        "F": {"total": F.col("o_totalprice"), "code": F.col("o_orderkey")},
        "P": {"priority": F.struct(F.col("o_orderpriority").alias("name"))},
        "O": {"priority": F.struct(F.col("o_custkey").alias("customer")), "code": cents},
    }
    for state, own in fields.items():
        record = F.struct(F.col("o_orderkey").alias("id"), *(value.alias(name) for name, value in own.items()))
        lines = orders.where(F.col("o_orderstatus") == state).select(F.to_json(record).alias("value"))
        lines.write.mode("append").text(where)
        reader = EntityReader(spark).options(
            path=root, companyId=COMPANY, entity="orders", fileFormat="json", decimalType="source", keepNested=False
        )
        schema = reader.record_schema()
    loaded = reader.schema(schema).load()
    return loaded.select("id", "total", "priority_name", "priority_customer", F.col("code").cast("string").alias("code"))


def infer_conflict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A field that is a number in some records and text in others is read as text."""
    root = shared_dir(spark, "infer_conflict")
    key = F.col("o_orderkey")
    note = F.when(key % 2 == 0, key.cast("string")).otherwise(
        F.concat(F.lit('"'), F.col("o_orderpriority"), F.lit('"'))
    )
    table(spark, sf_dir, "orders").select(
        F.format_string('{"id": %d, "note": %s}', key, note).alias("value")
    ).write.text(tenant_path(root, "orders", "sandbox", COMPANY))
    reader = EntityReader(spark).options(path=root, companyId=COMPANY, entity="orders")
    return reader.options(fileFormat="json", onConflict="string").load()


def infer_array_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    inv = invoices(spark, sf_dir)

    def element(line):
        price = line["l_extendedprice"]
        return F.struct(
            line["l_partkey"].alias("l_partkey"),
            F.when(price >= 1000, price).alias("large"),
            F.when(price < 1000, price).alias("small"),
        )

    text = inv.select(
        F.to_json(F.struct("o_orderkey", F.transform("line", element).alias("line"))).alias("json")
    )
    return _schema_rows(spark, infer_schema(text, "json"))


def infer_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    record = F.struct(
        key,
        F.when(key % 2 == 1, F.struct(F.col("o_custkey").alias("value"))).alias("ref"),
        F.when(key % 3 == 1, F.col("o_orderpriority")).alias("note"),
    )
    text = table(spark, sf_dir, "orders").select(
        F.to_json(record, {"ignoreNullFields": "false"}).alias("json")
    )
    records = parse_records(text, "json", infer_schema(text, "json"))
    return flatten(records, keep_nested=False).select("o_orderkey", "ref_value", "note")


def merge_schemas(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.col("c_name").alias("name"),
        F.col("c_nationkey").alias("nationkey"),
        "c_mktsegment",
    )
    supplier = table(spark, sf_dir, "supplier").select(
        "s_suppkey", F.col("s_name").alias("name"), F.col("s_nationkey").alias("nationkey")
    )
    return union_entities(customer, supplier)


def json_entity(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "props")
    schema = infer_schema(events, "props")
    parsed = events.select("event_id", F.from_json("props", schema).alias("props"))
    return flatten(parsed, keep_nested=False)


ACCOUNT_OFFSETS = {("order",): "order_offset", ("order", "line"): "line_offset"}


def profile_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = accounts(spark, sf_dir).select("order_offset", "line_offset", "order")
    return array_profile(records, ACCOUNT_OFFSETS)


def part_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of an order landed in parts of any size, by flag: each line's index in the whole order."""
    fields = ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity"]
    parts = table(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_returnflag", "l_linestatus").agg(
        F.sort_array(F.collect_list(F.struct(*fields))).alias("line")
    )
    by = ["l_returnflag", "l_linestatus"]
    placed = with_offsets(stage(parts, "flag-parts"), ["l_orderkey"], by, "line", "line_offset")
    rows = elements(placed, "line", "line_offset", "item", "line_index")
    return rows.select("l_orderkey", *by, "line_index", "item.l_linenumber", "item.l_partkey")


# --- flattening ----------------------------------------------------------------------------


def flatten_structs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatten(invoice_headers(spark, sf_dir), keep_nested=False)


def flatten_additive(spark: SparkSession, sf_dir: str) -> DataFrame:
    flat = flatten(invoices(spark, sf_dir))
    return flat.select(
        "o_orderkey",
        "part_no",
        F.col("customer_ref.nation.name").alias("nested_nation"),
        F.coalesce("line_size", F.lit(0)).alias("nested_lines"),
        *REF,
    )


def expand_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    flat = flatten(
        invoices(spark, sf_dir), expand_arrays=True, array_sizes={"line": 3}, array_offsets=LINE_OFFSET
    )
    return flat.select(
        "o_orderkey", "part_no", *(f"line_{i}_{f}" for i in range(3) for f in LINE_FIELDS)
    )


def _line_cells(spark: SparkSession, sf_dir: str, sizes: str) -> DataFrame:
    """Expanded part keys, one row per cell, as how many columns there are depends on the data."""
    narrow = invoices(spark, sf_dir).select(
        "o_orderkey",
        "line_offset",
        F.transform("line", lambda x: F.struct(x["l_partkey"].alias("l_partkey"))).alias("line"),
    )
    flat = flatten(
        stage(narrow, "line-cells"),  # read twice: for the widths, then for the cells
        expand_arrays=True,
        array_sizes=sizes,
        array_offsets=LINE_OFFSET,
        order_by=("o_orderkey", "line_offset"),
        keep_nested=False,
    )
    cells = [name for name in flat.columns if name.endswith("_l_partkey")]
    long = flat.unpivot(["o_orderkey"], cells, "cell", "l_partkey")
    return long.where("l_partkey is not null").select(
        "o_orderkey",
        F.split_part("cell", F.lit("_"), F.lit(2)).cast("bigint").alias("line_index"),
        "l_partkey",
    )


def expand_arrays_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _line_cells(spark, sf_dir, "first")


def expand_arrays_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _line_cells(spark, sf_dir, "max")


def expand_scalar_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return flatten(vectors, expand_arrays=True, array_sizes="max", keep_nested=False)


def expand_nested_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    flat = flatten(
        accounts(spark, sf_dir),
        expand_arrays=True,
        array_sizes={("order",): 2, ("order", "line"): 2},
        array_offsets=ACCOUNT_OFFSETS,
    )
    # All these places lie in the first part.
    return flat.where("order_offset = 0 and line_offset = 0").select(
        "c_custkey",
        *(f"order_{i}_o_orderkey" for i in range(2)),
        *(f"order_{i}_line_{j}_l_partkey" for i in range(2) for j in range(2)),
    )


def flatten_no_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatten(invoices(spark, sf_dir), expand_arrays=False, keep_nested=False).drop("line_offset")


def flatten_empty_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    detail = invoices(spark, sf_dir).select(
        "o_orderkey", "part_no", "line_offset", "line_size", F.struct("line").alias("detail")
    )
    flat = flatten(detail, array_sizes={"detail.line": 0}, keep_nested=False)
    return flat.select(
        "o_orderkey",
        "part_no",
        (F.col("line_offset") + F.array_size("detail_line")).alias("reached"),
        F.col("line_size").alias("detail_line_size"),
    )


def landed_empty_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An array that no record has an element of stays one array column under the default options."""
    root = shared_dir(spark, "landed_empty_array")
    nothing = F.filter("line", lambda x: F.lit(False))
    records = invoices(spark, sf_dir).select(
        "o_orderkey", "part_no", F.struct(nothing.alias("line"), F.col("o_orderstatus").alias("status")).alias("detail")
    )
    write_landing(records, root, "detail", COMPANY, ["o_orderkey", "part_no"], derived=True)
    flat = EntityReader(spark).options(path=root, companyId=COMPANY, entity="detail").load()
    return flat.select(
        "o_orderkey", "detail_status", F.array_size("detail_line").alias("detail_line_size")
    )


def nested_passthrough(spark: SparkSession, sf_dir: str) -> DataFrame:
    nested = flatten(invoices(spark, sf_dir), expand_structs=False, expand_arrays=True)
    return nested.select(
        "o_orderkey",
        "part_no",
        F.col("customer_ref.nation.name").alias("nation_name"),
        F.get("line", (-F.col("line_offset")).cast("int"))["l_partkey"].alias("first_partkey"),
    )


def flatten_default_options(spark: SparkSession, sf_dir: str) -> DataFrame:
    flat = flatten(invoices(spark, sf_dir), ScanOptions.from_options({}))
    return flat.select(*HEADER, *REF, F.array_size("line").alias("part_lines"), "line_size")


def unflatten_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Invoices flattened to columns and built again: the first three lines of each."""
    flat = flatten(invoices(spark, sf_dir).where("part_no = 0"), expand_arrays=True, array_sizes={"line": 3}, keep_nested=False)
    back = unflatten(flat)
    return back.select(
        "o_orderkey",
        "o_totalprice",
        F.col("customer_ref.value").alias("customer"),
        F.col("customer_ref.nation.name").alias("nation"),
        F.array_size("line").alias("lines"),
        F.array_join(F.transform("line", lambda x: x["l_partkey"].cast("string")), ",").alias("parts"),
    )


def flat_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where each flat column comes from, and in how many records it has a value."""
    flat = flatten(
        invoices(spark, sf_dir), expand_arrays=True, array_sizes={"line": 2}, array_offsets=LINE_OFFSET
    )
    sources = lineage(flat)
    filled = flat.agg(*(F.count(name).alias(name) for name, _ in sources))
    rows = [
        F.struct(
            F.lit(name).alias("flat_name"),
            F.lit(path).alias("source_path"),
            F.col(name).alias("filled"),
        )
        for name, path in sources
    ]
    return filled.select(F.inline(F.array(*rows)))


def flatten_null_parent(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    detail = F.when(key % 5 != 0, F.struct(F.col("o_orderpriority").alias("priority")))
    ref = F.when(
        key % 3 != 0, F.struct(F.col("o_custkey").alias("value"), detail.alias("detail"))
    )
    orders = table(spark, sf_dir, "orders").select(key, ref.alias("ref"))
    return flatten(orders, keep_nested=False)


# --- row projection and scalar conversion --------------------------------------------------


def coerce_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    typed = table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.col("l_linenumber").cast("tinyint").alias("as_byte"),
        F.col("l_linenumber").cast("smallint").alias("as_short"),
        F.col("l_partkey").alias("as_long"),
        F.col("l_quantity").cast("float").alias("as_float"),
        F.col("l_extendedprice").alias("as_double"),
        (F.col("l_discount") > 0.05).alias("as_boolean"),
        F.col("l_returnflag").alias("as_enum"),
        F.col("l_linestatus").alias("as_string"),
        F.col("l_shipdate").alias("as_date"),
    )
    return coerce(typed)


def coerce_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", F.col("l_shipdate").alias("at"), F.col("l_partkey").alias("part")
    )
    key = F.col("o_orderkey")
    headers = table(spark, sf_dir, "orders").select(
        key, F.when(key % 4 != 0, F.struct(F.col("o_orderdate").alias("at"))).alias("header")
    )
    records, _ = with_lines(headers, lines, ["at", "part"], "shipment", LINES_PER_PART)
    return coerce(records).select(
        "o_orderkey",
        "part_no",
        F.col("header.at").alias("header_at"),
        F.col("header").isNotNull().alias("has_header"),
        F.array_join("shipment.at", ",").alias("shipped_at"),
        F.array_join("shipment.part", ",").alias("parts"),
    )


def date_to_millis(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return coerce(events.select("event_id", F.col("ts").alias("millis")))


def decimal_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    declared = T.DecimalType(19, 4)
    total = F.col("o_totalprice").cast(declared)
    whole = ScanOptions.from_options({"decimalType": "decimal(10,0)"})
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        convert(total, declared, ScanOptions()).cast("string").alias("exact"),
        convert(total, declared, whole).cast("string").alias("whole"),
    )


def missing_field(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = T.StructType.fromDDL(
        "o_orderkey bigint, memo string, ref struct<value: bigint>, o_custkey bigint"
    )
    return flatten(project(table(spark, sf_dir, "orders"), wanted), keep_nested=False)


# --- query surface -------------------------------------------------------------------------


def sql_over_entity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: revenue of the first line of each invoice, per nation of the customer."""
    options = ScanOptions(company_id=COMPANY, entity="invoice", expand_arrays=True, array_sizes={("line",): 1}, array_offsets=tuple(LINE_OFFSET.items()))
    view = view_name(options)
    flatten(invoices(spark, sf_dir), options).createOrReplaceTempView(view)
    return spark.sql(_revenue_by_nation(view))


def _revenue_by_nation(view: str) -> str:
    return f"""
        select customer_ref_nation_name as nation, count(*) as invoices,
               round(sum(line_0_l_extendedprice), 2) as first_line_revenue
        from {view}
        where part_no = 0 and line_0_l_partkey is not null
        group by customer_ref_nation_name
        """


def sql_over_landed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship over an entity that was landed, through the view a load registers."""
    reader = _landed_invoices(spark, sf_dir, "sql_over_landed").option("arraySizes", {"line": 1})
    return spark.sql(_revenue_by_nation(reader.load_view()))


QUERIES: dict[str, Query] = {
    "entity_scan": entity_scan,
    "entity_select": entity_select,
    "tenant_select": tenant_select,
    "landing_two_schemas": landing_two_schemas,
    "landing_append": landing_append,
    "landing_snapshot": landing_snapshot,
    "sample_landed": sample_landed,
    "envelope_pages": envelope_pages,
    "envelope_distinct": envelope_distinct,
    "page_coverage": page_coverage,
    "json_rejects": json_rejects,
    "infer_increments": infer_increments,
    "entity_count": entity_count,
    "page_manifest": page_manifest,
    "page_assign": page_assign,
    "batch_manifest": batch_manifest,
    "page_reassemble": page_reassemble,
    "sample_scan": sample_scan,
    "scan_envelope": scan_envelope,
    "format_load": format_load,
    "format_load_expanded": format_load_expanded,
    "reader_load_expanded": reader_load_expanded,
    "json_load_expanded": json_load_expanded,
    "infer_schema": infer_invoice_schema,
    "infer_numbers": infer_numbers,
    "infer_number_profile": infer_number_profile,
    "infer_conflict": infer_conflict,
    "infer_array_union": infer_array_union,
    "infer_nulls": infer_nulls,
    "merge_schemas": merge_schemas,
    "array_profile": profile_arrays,
    "part_offsets": part_offsets,
    "flatten_structs": flatten_structs,
    "flatten_additive": flatten_additive,
    "expand_arrays": expand_arrays,
    "expand_arrays_first": expand_arrays_first,
    "expand_arrays_max": expand_arrays_max,
    "expand_scalar_array": expand_scalar_array,
    "expand_nested_arrays": expand_nested_arrays,
    "flatten_no_arrays": flatten_no_arrays,
    "flatten_empty_array": flatten_empty_array,
    "landed_empty_array": landed_empty_array,
    "nested_passthrough": nested_passthrough,
    "flatten_default_options": flatten_default_options,
    "flat_lineage": flat_lineage,
    "unflatten_round_trip": unflatten_round_trip,
    "flatten_null_parent": flatten_null_parent,
    "coerce_types": coerce_types,
    "coerce_nested": coerce_nested,
    "date_to_millis": date_to_millis,
    "decimal_cast": decimal_cast,
    "missing_field": missing_field,
    "json_entity": json_entity,
    "sql_over_entity": sql_over_entity,
    "sql_over_landed": sql_over_landed,
}
