"""The same results in SQL over the flat tables, for checking against another engine."""

from __future__ import annotations

_LINES = """
ranked as (
  select *, row_number() over (partition by l_orderkey order by l_linenumber, l_partkey,
    l_suppkey, l_extendedprice, l_quantity) - 1 as rn,
    count(*) over (partition by l_orderkey) as total
  from lineitem),
lines as (
  select l_orderkey, rn // 10000 as part_no, any_value(total) as n, count(*) as part_lines,
    list({'l_linenumber': l_linenumber, 'l_partkey': l_partkey, 'l_suppkey': l_suppkey,
          'l_extendedprice': l_extendedprice, 'l_quantity': l_quantity} order by rn) as line
  from ranked group by all)"""

_INVOICES = f"""with {_LINES},
inv as (
  select o_orderkey, coalesce(part_no, 0) as part_no, o_orderstatus, o_totalprice,
    epoch_us(o_orderdate) // 1000 as o_orderdate, o_custkey as customer_ref_value,
    c_name as customer_ref_name, n_nationkey as customer_ref_nation_value,
    n_name as customer_ref_nation_name, case when part_no = 0 then line end as line, n, part_lines
  from orders left join customer on o_custkey = c_custkey
    left join nation on c_nationkey = n_nationkey
    left join lines on o_orderkey = l_orderkey)
"""

_REF = """customer_ref_value, customer_ref_name, customer_ref_nation_value,
  customer_ref_nation_name"""

_THREE_LINES = ", ".join(
    f"line[{i + 1}].{f} as line_{i}_{f}"
    for i in range(3)
    for f in ("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity")
)

_LINE_CELLS = """select o_orderkey, rn as line_index, l_partkey
  from orders join ranked on o_orderkey = l_orderkey where rn < ({size})"""

_SOURCES = [
    ("customer_ref_value", "customer_ref.value", "customer_ref_value"),
    ("customer_ref_name", "customer_ref.name", "customer_ref_name"),
    ("customer_ref_nation_value", "customer_ref.nation.value", "customer_ref_nation_value"),
    ("customer_ref_nation_name", "customer_ref.nation.name", "customer_ref_nation_name"),
] + [
    (f"line_{i}_{f}", f"line[{i}].{f}", f"line[{i + 1}].{f}")
    for i in range(2)
    for f in ("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity")
]

_PAGED = """with p as (
  select o_orderkey, row_number() over (order by o_orderkey) as position from orders)
"""

_ALL_PAGES = """with t as (select count(*) as n from orders),
pages as (
  select page_no, page_no * 100 + 1 as start_position, least(100, n - page_no * 100) as max_results
  from t, unnest(range((n + 99) // 100)) as r(page_no))
"""


def _values(rows: list[tuple[str, str]], names: str) -> str:
    body = ", ".join("(" + ", ".join(f"'{text}'" for text in row) + ")" for row in rows)
    return f"select * from (values {body}) as v({names})"


ORACLES: dict[str, str] = {
    "entity_scan": """select o_orderkey, o_custkey, o_orderstatus, o_totalprice,
        epoch_us(o_orderdate) // 1000 as o_orderdate, o_orderpriority from orders""",
    "entity_select": """select 'orders' as entity, o_orderkey as id from orders
        union all select 'customer', c_custkey from customer""",
    "landing_append": """select o_orderkey, case when o_orderkey % 2 = 0 then o_totalprice end as o_totalprice,
        case when o_orderkey % 2 = 1 then o_orderpriority end as o_orderpriority,
        row_number() over (order by o_orderkey % 2, o_orderkey) as position
        from orders where o_custkey % 3 = 1""",
    "landing_snapshot": """select 'now' as at, o_orderkey,
          case when o_orderkey % 2 = 1 then o_orderpriority end as o_orderpriority from orders where o_custkey % 3 = 1
        union all select 'before', o_orderkey, null from orders where o_custkey % 3 = 1 and o_orderkey % 2 = 0""",
    "sample_landed": "select o_orderkey, o_custkey, o_totalprice from orders order by o_orderkey limit 250",
    "landing_two_schemas": "select event_id, value, event_type from events where user_id % 4 = 3",
    "envelope_pages": _PAGED
    + """select position, o_orderkey, o_totalprice, (select count(*) from orders) as total_count
        from p join orders using (o_orderkey)""",
    "envelope_distinct": _PAGED
    + "select position, o_orderkey, o_totalprice from p join orders using (o_orderkey)",
    "page_coverage": """with t as (select count(*) as n from orders),
        pages as (select page_no, page_no * 100 + 1 as s, n as rows,
            least(n, page_no * 100 + 100 + case when page_no % 5 = 1 then 20 else 0 end) + 1 as e
          from t, unnest(range((n + 99) // 100)) as r(page_no) where page_no % 7 <> 3),
        swept as (select *, greatest(1, coalesce(max(e) over (order by s rows between unbounded preceding
            and 1 preceding), 1)) as before from pages),
        twice as (select *, case when page_no % 6 = 2 then e else least(e, before) end as again from swept),
        fresh as (select *, greatest(s, coalesce(max(case when again > s then again end) over (order by s
            rows between unbounded preceding and 1 preceding), 1)) as f from twice),
        found as (
          select 'gap' as kind, before as first, s - 1 as last from fresh
          union all select 'overlap', f, again - 1 from fresh
          union all select 'short', max(e), any_value(rows) + 250 from fresh)
        select kind, first, last, last - first + 1 as records from found where first <= last""",
    "infer_increments": """select o_orderkey as id,
        case o_orderstatus when 'F' then o_totalprice::decimal(38,2) end as total,
        case o_orderstatus when 'P' then o_orderpriority end as priority_name,
        case o_orderstatus when 'O' then o_custkey end as priority_customer,
        case o_orderstatus when 'F' then o_orderkey::varchar || '.00'
            when 'O' then '1234567' || lpad(o_orderkey::varchar, 10, '0') || '.25' end as code
        from orders where o_orderstatus in ('F', 'P', 'O')""",
    "json_rejects": """select case when o_orderkey % 10 = 3 then 'not JSON'
          when o_orderkey % 10 = 7 then 'not a record of the schema' end as problem,
        case when o_orderkey % 10 = 3 then substr(printf('{"id": %d, "note": "%s"}', o_orderkey, o_orderpriority), 1, 12)
          when o_orderkey % 10 = 7 then printf('{"id": [%d], "note": "%s"}', o_orderkey, o_orderpriority)
          else o_orderkey || ' ' || o_orderpriority end as text from orders""",
    "infer_number_profile": """with texts as (
          select 'amount' as path, 'double' as type, case when o_orderkey % 2 = 0 then o_orderkey::varchar
            else '-' || o_totalprice::decimal(12,2)::varchar end as t from orders
          union all select 'part[].q', 'double', o_orderkey::varchar from orders
          union all select 'part[].q', 'double', o_orderkey::varchar || '.125' from orders),
        split as (select path, type, t like '-%' as negative,
            ltrim(split_part(ltrim(t, '-'), '.', 1), '0') as whole,
            rtrim(split_part(ltrim(t, '-'), '.', 2), '0') as fraction from texts)
        select path, type, count(*) as numbers, cast(max(length(whole)) as integer) as whole_digits,
          cast(max(length(fraction)) as integer) as fraction_digits,
          cast(max(length(ltrim(whole || fraction, '0'))) as integer) as significant_digits,
          bool_or(negative) as negative from split group by all""",
    "tenant_select": "select event_id, value from events where user_id % 4 = 1",
    "entity_count": "select count(*) as n from orders",
    "page_manifest": _ALL_PAGES + "select page_no, start_position, max_results from pages",
    "page_assign": _PAGED
    + """select o_orderkey, position, (position - 1) // 100 as page_no,
        (position - 1) // 3000 as batch_no from p""",
    "batch_manifest": _ALL_PAGES
    + """select page_no // 30 as batch_no, count(*) as pages,
        cast(sum(max_results) as bigint) as row_count from pages group by 1""",
    "page_reassemble": _PAGED + "select position, o_orderkey from p",
    "sample_scan": """select o_orderkey, o_custkey, o_orderstatus, o_totalprice,
        epoch_us(o_orderdate) // 1000 as o_orderdate, o_orderpriority
        from orders order by o_orderkey limit 1""",
    "scan_envelope": """select cast(1 as bigint) as start_position, count(*) as max_results,
        count(*) as total_count from orders""",
    "format_load": """select o_orderkey, o_custkey, o_orderstatus, o_totalprice,
        epoch_us(o_orderdate) // 1000 as o_orderdate, o_orderpriority from orders""",
    "format_load_expanded": _INVOICES
    + f"""select o_orderkey, part_no, {_REF}, line[1].l_partkey as line_0_l_partkey,
        line[2].l_extendedprice as line_1_l_extendedprice from inv""",
    "json_load_expanded": _INVOICES
    + """select o_orderkey, part_no, o_orderdate, customer_ref_value, customer_ref_name,
        cast(customer_ref_nation_value as bigint) as customer_ref_nation_value,
        customer_ref_nation_name, line[1].l_partkey as line_0_l_partkey,
        line[2].l_extendedprice as line_1_l_extendedprice from inv""",
    "reader_load_expanded": _INVOICES
    + f"""select o_orderkey, part_no, o_orderdate, {_REF},
        line[1].l_partkey as line_0_l_partkey,
        line[2].l_extendedprice as line_1_l_extendedprice from inv""",
    "infer_schema": _values(
        [
            ("customer_ref.name", "string"),
            ("customer_ref.nation.name", "string"),
            ("customer_ref.nation.value", "bigint"),
            ("customer_ref.value", "bigint"),
            ("line[].l_extendedprice", "double"),
            ("line[].l_linenumber", "bigint"),
            ("line[].l_partkey", "bigint"),
            ("line[].l_quantity", "double"),
            ("line[].l_suppkey", "bigint"),
            ("line_offset", "bigint"),
            ("line_size", "bigint"),
            ("o_orderdate", "bigint"),
            ("o_orderkey", "bigint"),
            ("o_orderstatus", "string"),
            ("o_totalprice", "double"),
            ("part_no", "bigint"),
        ],
        "path, type",
    ),
    "infer_numbers": """select o_orderkey as id, '9876543210' || lpad(o_orderkey::varchar, 12, '0') as wide,
        '1234567' || lpad(o_orderkey::varchar, 10, '0') || '.25' as cents from orders""",
    "infer_conflict": """select o_orderkey as id,
        case when o_orderkey % 2 = 0 then o_orderkey::varchar else o_orderpriority end as note
        from orders""",
    "infer_array_union": _values(
        [
            ("line[].l_partkey", "bigint"),
            ("line[].large", "double"),
            ("line[].small", "double"),
            ("o_orderkey", "bigint"),
        ],
        "path, type",
    ),
    "infer_nulls": """select o_orderkey,
        case when o_orderkey % 2 = 1 then o_custkey end as ref_value,
        case when o_orderkey % 3 = 1 then o_orderpriority end as note from orders""",
    "merge_schemas": """select c_custkey, s_suppkey, name, nationkey, c_mktsegment from (
        select c_custkey, null as s_suppkey, c_name as name, c_nationkey as nationkey, c_mktsegment
        from customer union all
        select null, s_suppkey, s_name, s_nationkey, null from supplier)""",
    "array_profile": """select 'order' as path, cast(max(n) as integer) as max_size
          from (select count(*) as n from orders group by o_custkey)
        union all select 'order.line', cast(coalesce(max(n), 0) as integer)
          from (select count(*) as n from lineitem semi join orders on l_orderkey = o_orderkey group by l_orderkey)""",
    "part_offsets": """select l_orderkey, l_returnflag, l_linestatus, l_linenumber, l_partkey,
        row_number() over (partition by l_orderkey order by l_returnflag, l_linestatus, l_linenumber,
          l_partkey, l_suppkey, l_extendedprice, l_quantity) - 1 as line_index from lineitem""",
    "flatten_structs": _INVOICES
    + f"""select o_orderkey, o_orderstatus, o_totalprice, o_orderdate, {_REF} from inv
        where part_no = 0""",
    "flatten_additive": _INVOICES
    + f"""select o_orderkey, part_no, customer_ref_nation_name as nested_nation,
        coalesce(n, 0) as nested_lines, {_REF} from inv""",
    "expand_arrays": _INVOICES + f"select o_orderkey, part_no, {_THREE_LINES} from inv",
    "expand_arrays_first": _INVOICES
    + _LINE_CELLS.format(size="select coalesce(n, 0) from inv order by o_orderkey, part_no limit 1"),
    "expand_arrays_max": _INVOICES + _LINE_CELLS.format(size="select max(n) from inv"),
    "expand_scalar_array": "select vec_id, label, "
    + ", ".join(f"embedding[{i + 1}] as embedding_{i}" for i in range(64))
    + " from embeddings",
    "expand_nested_arrays": f"""with {_LINES},
        acc as (select o_custkey as c_custkey, list({{'o_orderkey': o_orderkey, 'line': line}} order by o_orderkey) as o
          from orders left join lines on o_orderkey = l_orderkey and part_no = 0 group by o_custkey)
        select c.c_custkey, """
    + ", ".join(
        [f"o[{i + 1}].o_orderkey as order_{i}_o_orderkey" for i in range(2)]
        + [
            f"o[{i + 1}].line[{j + 1}].l_partkey as order_{i}_line_{j}_l_partkey"
            for i in range(2)
            for j in range(2)
        ]
    )
    + " from customer c left join acc on c.c_custkey = acc.c_custkey",
    "flatten_no_arrays": _INVOICES
    + f"""select o_orderkey, part_no, n as line_size, o_orderstatus, o_totalprice, o_orderdate, {_REF} from inv""",
    "flatten_empty_array": _INVOICES
    + """select o_orderkey, part_no, part_no * 10000 + part_lines as reached, n as detail_line_size from inv""",
    "landed_empty_array": _INVOICES
    + """select o_orderkey, o_orderstatus as detail_status,
        case when n is not null then 0 end as detail_line_size from inv""",
    "nested_passthrough": _INVOICES
    + """select o_orderkey, part_no, customer_ref_nation_name as nation_name,
        line[1].l_partkey as first_partkey from inv""",
    "flatten_default_options": _INVOICES
    + f"""select o_orderkey, part_no, o_orderstatus, o_totalprice, o_orderdate, {_REF},
        cast(part_lines as integer) as part_lines, n as line_size from inv""",
    "flat_lineage": _INVOICES
    + " union all ".join(
        f"select '{name}' as flat_name, '{path}' as source_path, count({value}) as filled from inv"
        for name, path, value in _SOURCES
    ),
    "unflatten_round_trip": _INVOICES
    + """select o_orderkey, o_totalprice, customer_ref_value as customer, customer_ref_nation_name as nation,
        cast(case when n is not null then least(n, 3) end as integer) as lines,
        array_to_string(list_transform(line[1:3], lambda x: x.l_partkey), ',') as parts
        from inv where part_no = 0""",
    "flatten_null_parent": """select o_orderkey,
        case when o_orderkey % 3 <> 0 then o_custkey end as ref_value,
        case when o_orderkey % 3 <> 0 and o_orderkey % 5 <> 0 then o_orderpriority end
          as ref_detail_priority from orders""",
    "coerce_types": """select l_orderkey, l_linenumber, cast(l_linenumber as tinyint) as as_byte,
        cast(l_linenumber as smallint) as as_short, l_partkey as as_long,
        cast(l_quantity as float) as as_float, l_extendedprice as as_double,
        l_discount > 0.05 as as_boolean, l_returnflag as as_enum, l_linestatus as as_string,
        epoch_us(l_shipdate) // 1000 as as_date from lineitem""",
    "coerce_nested": """with shipped as (
        select l_orderkey, l_shipdate, l_partkey, row_number() over (partition by l_orderkey
            order by l_shipdate, l_partkey) - 1 as rn from lineitem),
        parts as (select l_orderkey, rn // 10000 as part_no, count(*) as n,
            list({'at': epoch_us(l_shipdate) // 1000, 'part': l_partkey} order by rn) as shipment
          from shipped group by all)
        select o_orderkey, coalesce(part_no, 0) as part_no,
          case when o_orderkey % 4 <> 0 then epoch_us(o_orderdate) // 1000 end as header_at,
          o_orderkey % 4 <> 0 as has_header,
          array_to_string(list_transform(shipment, lambda x: x['at']), ',') as shipped_at,
          array_to_string(list_transform(shipment, lambda x: x['part']), ',') as parts
        from orders left join parts on o_orderkey = l_orderkey""",
    "date_to_millis": "select event_id, epoch_us(ts) // 1000 as millis from events",
    "decimal_cast": """select o_orderkey, cast(cast(cast(o_totalprice as decimal(19,4)) as decimal(38,10)) as varchar) as exact,
        cast(cast(cast(o_totalprice as decimal(19,4)) as decimal(10,0)) as varchar) as whole
        from orders""",
    "missing_field": """select o_orderkey, cast(null as varchar) as memo,
        cast(null as bigint) as ref_value, o_custkey from orders""",
    "json_entity": "select event_id, json_extract(props, '$.k')::bigint as props_k from events",
    "sql_over_entity": _INVOICES
    + """select customer_ref_nation_name as nation, count(*) as invoices,
        round(sum(line[1].l_extendedprice), 2) as first_line_revenue
        from inv where part_no = 0 and n > 0 group by 1""",
    "sql_over_landed": _INVOICES
    + """select customer_ref_nation_name as nation, count(*) as invoices,
        round(sum(line[1].l_extendedprice), 2) as first_line_revenue
        from inv where part_no = 0 and n > 0 group by 1""",
}
