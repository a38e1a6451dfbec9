"""The same star shape over the order-entry tables: orders feed, customer → nation → region."""

from __future__ import annotations

from orrery.models.table import (
    DATE, INT, LONG, TEXT, Band, Dimension, Field, Hop, Reference, Star, Table, money,
)

REGION = Table("region", ("r_regionkey",), (
    Field("r_regionkey", INT, required=True),
    Field("r_name", TEXT, required=True, length=25),
))
NATION = Table("nation", ("n_nationkey",), (
    Field("n_nationkey", INT, required=True),
    Field("n_name", TEXT, required=True, length=25),
    Field("n_regionkey", INT, required=True),
))
CUSTOMER = Table("customer", ("c_custkey",), (
    Field("c_custkey", LONG, required=True),
    Field("c_name", TEXT, required=True, length=25),
    Field("c_nationkey", INT, required=True),
    Field("c_acctbal", money(18)),
    Field("c_mktsegment", TEXT, length=10),
))
SUPPLIER = Table("supplier", ("s_suppkey",), (
    Field("s_suppkey", LONG, required=True),
    Field("s_name", TEXT, required=True, length=25),
    Field("s_nationkey", INT, required=True),
    Field("s_acctbal", money(18)),
))
PART = Table("part", ("p_partkey",), (
    Field("p_partkey", LONG, required=True),
    Field("p_name", TEXT, required=True, length=55),
    Field("p_brand", TEXT, length=10),
    Field("p_type", TEXT, length=25),
    Field("p_size", INT),
    Field("p_retailprice", money(18)),
))
ORDERS = Table("orders", ("o_orderkey",), (
    Field("o_orderkey", LONG, required=True),
    Field("o_custkey", LONG, required=True),
    Field("o_orderstatus", TEXT, length=1),
    Field("o_totalprice", money(18), required=True),
    Field("o_orderdate", DATE, required=True),
    Field("o_orderpriority", TEXT, length=15),
))
LINEITEM = Table("lineitem", ("l_orderkey", "l_linenumber"), (
    Field("l_orderkey", LONG, required=True),
    Field("l_partkey", LONG, required=True),
    Field("l_suppkey", LONG, required=True),
    Field("l_linenumber", INT, required=True),
    Field("l_quantity", money(18), required=True),
    Field("l_extendedprice", money(18), required=True),
    Field("l_discount", money(18)),
    Field("l_tax", money(18)),
    Field("l_returnflag", TEXT, length=1),
    Field("l_linestatus", TEXT, length=1),
    Field("l_shipdate", DATE, required=True),
))
TABLES = {t.name: t for t in (REGION, NATION, CUSTOMER, SUPPLIER, PART, ORDERS, LINEITEM)}
REFERENCES = (
    Reference("nation", ("n_regionkey",), "region", ("r_regionkey",)),
    Reference("customer", ("c_nationkey",), "nation", ("n_nationkey",)),
    Reference("supplier", ("s_nationkey",), "nation", ("n_nationkey",)),
    Reference("orders", ("o_custkey",), "customer", ("c_custkey",)),
    Reference("lineitem", ("l_orderkey",), "orders", ("o_orderkey",)),
    Reference("lineitem", ("l_partkey",), "part", ("p_partkey",)),
    Reference("lineitem", ("l_suppkey",), "supplier", ("s_suppkey",)),
)
STAR = Star(
    references=REFERENCES,
    feed=ORDERS,
    dimensions=(
        Dimension("dim_customer", CUSTOMER, {
            "c_custkey": "customer_key",
            "c_nationkey": "nation_key",
        }),
        Dimension("dim_nation", NATION, {
            "n_nationkey": "nation_key",
            "n_regionkey": "region_key",
        }),
        Dimension("dim_region", REGION, {"r_regionkey": "region_key"}),
        Dimension("dim_supplier", SUPPLIER, {
            "s_suppkey": "supplier_key",
            "s_nationkey": "nation_key",
        }),
    ),
    hops=(
        Hop("dim_customer", {"o_custkey": "customer_key"}, {
            "customer_key": "customer_key",
            "customer_nation": "nation_key",
        }),
        Hop("dim_nation", {"customer_nation": "nation_key"}, {
            "nation_key": "nation_key",
            "nation_region": "region_key",
        }),
        Hop("dim_region", {"nation_region": "region_key"}, {"region_key": "region_key"}),
    ),
    silver={
        "order_key": "o_orderkey",
        "customer_key": "customer_key",
        "nation_key": "nation_key",
        "region_key": "region_key",
        "order_date": "o_orderdate",
        "total_price": "o_totalprice",
    },
    date="order_date",
    gold=Band(
        bridge="dim_supplier",
        dimension="dim_nation",
        key="nation_key",
        title="n_name",
        measures={
            "avg_supplier_balance": ("bridge", "s_acctbal"),
            "avg_order_price": ("fact", "total_price"),
        },
        order_by="avg_supplier_balance",
    ),
)
LINES = Star(
    references=REFERENCES,
    feed=LINEITEM,
    dimensions=(
        Dimension("dim_supplier", SUPPLIER, {"s_suppkey": "supplier_key", "s_nationkey": "nation_key"}),
        Dimension("dim_part", PART, {"p_partkey": "part_key"}),
    ),
    hops=(
        Hop("dim_supplier", {"l_suppkey": "supplier_key"}, {"supplier_key": "supplier_key", "nation_key": "nation_key"}),
        Hop("dim_part", {"l_partkey": "part_key"}, {"part_key": "part_key", "brand": "p_brand"}),
    ),
    silver={
        "order_key": "l_orderkey",
        "line_number": "l_linenumber",
        "supplier_key": "supplier_key",
        "nation_key": "nation_key",
        "part_key": "part_key",
        "brand": "brand",
        "quantity": "l_quantity",
        "ship_date": "l_shipdate",
    },
    date="ship_date",
    gold=Band(
        bridge="dim_supplier",
        dimension="dim_supplier",
        key="supplier_key",
        title="s_name",
        measures={"avg_quantity": ("fact", "quantity")},
        order_by="avg_quantity",
    ),
)
