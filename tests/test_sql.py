"""The flat result must compose with any Spark SQL: joins, windows, rollups, set operations."""

import pytest

from compare import connect, spark_table, sql_table
from entityframe.operators.flatten import flatten
from entityframe.plans.oracles import _INVOICES
from entityframe.plans.records import invoices, table

ORACLE_VIEW = _INVOICES + """, invoice as (
  select o_orderkey, part_no, o_orderstatus, customer_ref_value, customer_ref_nation_name,
    line[1].l_suppkey as line_0_l_suppkey, line[1].l_extendedprice as line_0_l_extendedprice,
    line[2].l_extendedprice as line_1_l_extendedprice from inv)
"""

SQL = {
    "join": """select n_name as nation, count(*) as n from invoice
        join supplier on line_0_l_suppkey = s_suppkey join nation on s_nationkey = n_nationkey
        where n_name <> customer_ref_nation_name group by n_name""",
    "semi and anti": """select count(*) as n from customer c where exists
        (select 1 from invoice i where i.customer_ref_value = c.c_custkey)
        and not exists (select 1 from invoice i where i.customer_ref_value = c.c_custkey
          and i.line_1_l_extendedprice is null)""",
    "window": """select customer_ref_value, o_orderkey, rn from (
        select customer_ref_value, o_orderkey, row_number() over (partition by customer_ref_value
          order by line_0_l_extendedprice desc nulls last, o_orderkey) as rn from invoice) t
        where rn <= 2""",
    "rollup": """select customer_ref_nation_name as nation, o_orderstatus as status, count(*) as n,
        max(line_1_l_extendedprice) as top from invoice
        group by rollup (customer_ref_nation_name, o_orderstatus)""",
    "set operations": """select customer_ref_value as k from invoice where line_0_l_suppkey is null
        intersect select customer_ref_value from invoice where o_orderstatus = 'F'
        union select s_suppkey from supplier where s_suppkey < 3""",
    "filter on an element": """select o_orderkey from invoice
        where line_0_l_extendedprice > 2 * line_1_l_extendedprice""",
}


@pytest.fixture(scope="module")
def views(spark, data):
    flat = flatten(invoices(spark, data), expand_arrays=True, array_sizes={"line": 2})
    flat.createOrReplaceTempView("invoice")
    for name in ("supplier", "nation", "customer"):
        table(spark, data, name).createOrReplaceTempView(name)


@pytest.mark.parametrize("name", SQL)
def test_sql_over_a_flat_view(spark, data, views, name):
    expected = sql_table(connect(data), ORACLE_VIEW + SQL[name])
    assert spark_table(spark.sql(SQL[name])) == expected
    assert expected[1]
