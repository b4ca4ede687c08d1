"""The report tables as views of the sample star schema (orders, lineitem, part, …).

Each table is one lazy expression over Parquet. Partners share one id space:
a supplier has twice its key, a customer twice its key plus one; warehouses are
the regions of partners under the same ids.
"""

from __future__ import annotations

import os
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stocklens.config import ReportConfig, Site
from stocklens.functions.numbers import to_decimal
from stocklens.sources.tables import Tables

AS_OF = date(2001, 8, 1)
YEAR = 2000
COMPANY = 1000
ITEM_KIND = 51

# The sample's categories, number of makers, document types and states.
CATEGORIES = ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")
MAKERS = 25
DOC_TYPES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")
STATES = {1: "O", 2: "F", 3: "P"}

SAMPLE_CONFIG = ReportConfig(
    excluded_purchase_type=5,
    sales_types=(1, 2, 3, 4),
    export_types=(1, 2),
    retail_purchase_types=(1, 2, 3, 4),
    deals_transfer_types=(2,),
    site_transfer_types=(2, 3),
    pending_type=5,
    arrival_type_names=("1-URGENT", "2-HIGH", "3-MEDIUM"),
    supplier_on_line=True,
    warehouse_on_line=True,
    own=Site("own", (0, 1, 2, 3), ("ASIA", "EUROPE")),
    tql=Site(
        "tql",
        (4,),
        ("AFRICA",),
        deals_reserved="supplier_order_units",
        logistics_suppliers=("Supplier#000000003", "Supplier#000000004"),
    ),
    dsv=Site(
        "dsv",
        (5,),
        ("AMERICA",),
        logistics_suppliers=("Supplier#000000005", "Supplier#000000007"),
    ),
    dream_cargo=Site(
        "dc", (6,), ("MIDDLE EAST",), logistics_suppliers=("Supplier#000000009",)
    ),
    hub=Site("hub", (7,), ("MIDDLE EAST",)),
    incoming=Site("inc", (8,)),
    export_category_patterns=("ECONOMY%", "PROMO%"),
    retail_excluded_patterns=("PROMO%",),
    laptop_categories=("SMALL", "STANDARD"),
    refurbished_patterns=("%tandar%",),
    refurbished_header_patterns=("%tandard%",),
    refurbished_header="Standrad",
    refurbished_header_fixed="Standard",
    refurbished_block_patterns=("%tandard%",),
    export_name_patterns=("%ring%",),
    deal_excluded_maker="Brand#3",
    priority_categories=("ECONOMY", "SMALL"),
    portable_patterns=("%mall%", "%edium%"),
    suggestion_excluded_makers=("Brand#1", "Brand#2"),
    line_value_floor=50000.0,
    item_year=YEAR,
    # wide enough for any stock of the sample at any scale
    need_precision=18,
)


# Columns of the sample files that the views use.
COLUMNS = {
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_quantity double, "
        "l_extendedprice double, l_discount double, l_returnflag string, l_linestatus string"
    ),
    "part": (
        "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
        "p_retailprice double"
    ),
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_mktsegment string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "region": "r_regionkey int, r_name string",
    "events": "event_id bigint, ts timestamp_ntz",
}


def read(spark: SparkSession, directory: str, name: str) -> DataFrame:
    """A sample file, with its columns declared: no job is spent on finding them out."""
    return spark.read.schema(COLUMNS[name]).parquet(os.path.join(directory, f"{name}.parquet"))


def sample_tables(spark: SparkSession, directory: str) -> Tables:
    """The report tables over the sample directory."""

    def source(name: str) -> DataFrame:
        return read(spark, directory, name)

    def small(key: str, names: dict) -> DataFrame:
        return _named(spark, key, names)

    views = {
        "documents": lambda: _documents(source("orders")),
        "document_stock": lambda: _document_stock(source("orders")),
        "lines": lambda: _lines(source("lineitem")),
        "items": lambda: _items(source("part")),
        "partners": lambda: _partners(source("supplier"), source("customer")),
        "partner_extra": lambda: _partner_extra(source("supplier"), source("customer")),
        "categories": lambda: small("mtrcategory", {c: c for c in CATEGORIES}),
        "makers": lambda: small(
            "mtrmanfctr", {f"Brand#{i}": f"Brand#{i}" for i in range(1, MAKERS + 1)}
        ),
        "warehouses": lambda: _warehouses(
            source("supplier"), source("customer"), source("nation"), source("region")
        ),
        "branches": lambda: _branches(source("customer")),
        "doc_types": lambda: small("fprms", dict(enumerate(DOC_TYPES, 1))),
        "periods": lambda: small("period", {m: f"Month {m}" for m in range(1, 13)}),
        "countries": lambda: _countries(source("nation")),
        "states": lambda: small("finstates", STATES),
        "item_costs": lambda: _item_costs(source("orders"), source("lineitem")),
        "item_month": lambda: _item_month(source("orders"), source("lineitem")),
        "item_year": lambda: _item_year(source("orders"), source("lineitem")),
        "stock": lambda: _stock(source("lineitem")),
        "products": lambda: _products(source("part")),
    }
    return Tables(lambda name: views[name]())


def _named(spark: SparkSession, key: str, names: dict) -> DataFrame:
    """A small dimension of the company, all active."""
    rows = ", ".join(f"({k!r}, {v!r}, {COMPANY}, 1, {ITEM_KIND})" for k, v in names.items())
    columns = f"{key}, name, company, isactive, sodtype"
    return spark.sql(f"SELECT * FROM VALUES {rows} AS dim({columns})")


def _source():
    """Open orders are purchases, finished ones sales, partly delivered ones transfers."""
    status = F.col("o_orderstatus")
    return F.when(status == "O", 1251).when(status == "F", 1351).when(status == "P", 1151)


def _documents(orders: DataFrame) -> DataFrame:
    c = F.col
    status = c("o_orderstatus")
    return orders.select(
        c("o_orderkey").alias("findoc"),
        F.lit(COMPANY).alias("company"),
        _source().alias("sosource"),
        F.lit(0).alias("soredir"),
        F.when(status == "O", 12).otherwise(13).alias("sodtype"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("fprms"),
        F.lit(201).alias("tfprms"),
        F.month("o_orderdate").alias("period"),
        c("o_orderdate").alias("trndate"),
        c("o_orderdate").alias("sotime"),
        c("o_orderkey").cast("string").alias("fincode"),
        c("o_orderkey").alias("seriesnum"),
        c("o_totalprice").alias("sumamnt"),
        (c("o_custkey") * 2 + 1).alias("trdr"),
        c("o_custkey").alias("branch"),
        F.when(status == "O", 1).when(status == "F", 2).when(status == "P", 3).alias("finstates"),
        (c("o_orderkey") % 3).cast("int").alias("fullytransf"),
        F.lit(0).alias("iscancel"),
        (c("o_orderkey") % 8).cast("int").alias("origin"),
        F.lit(1).alias("apprv"),
    )


def _document_stock(orders: DataFrame) -> DataFrame:
    return orders.select(
        F.col("o_orderkey").alias("findoc"),
        F.lit(None).cast("bigint").alias("whouse"),
        (F.col("o_custkey") * 2 + 1).alias("whousesec"),
    )


def _lines(lineitem: DataFrame) -> DataFrame:
    c = F.col
    quantity, value, flag = c("l_quantity"), c("l_extendedprice"), c("l_returnflag")
    is_open = c("l_linestatus") == "O"
    return lineitem.select(
        c("l_orderkey").alias("findoc"),
        F.lit(COMPANY).alias("company"),
        F.lit(ITEM_KIND).alias("sodtype"),
        c("l_partkey").alias("mtrl"),
        (c("l_suppkey") * 2).alias("supplier"),
        (c("l_suppkey") * 2).alias("whouse"),
        F.when(is_open, 1).otherwise(0).alias("pending"),
        F.when(is_open, 11).alias("restmode"),
        quantity.alias("qty"),
        quantity.alias("qty1"),
        F.when(flag == "A", quantity).otherwise(0.0).alias("qty1cov"),
        F.when(flag == "R", 1.0).otherwise(0.0).alias("qty1canc"),
        (value / quantity).alias("price"),
        c("l_discount").alias("disc1prc"),
        value.alias("lineval"),
        value.alias("ltrnlineval"),
    )


def _items(part: DataFrame) -> DataFrame:
    c = F.col
    key = c("p_partkey")
    return part.select(
        key.alias("mtrl"),
        F.lit(COMPANY).alias("company"),
        F.lit(ITEM_KIND).alias("sodtype"),
        key.cast("string").alias("code"),
        c("p_name").alias("name"),
        c("p_type").alias("mtrcategory"),
        c("p_brand").alias("mtrmanfctr"),
        F.when(key % 2 == 0, key + 1).alias("relitem"),
        c("p_size").cast("double").alias("gweight"),
        c("p_retailprice").alias("pricer"),
        F.when(key % 7 != 0, F.concat(F.lit("PN-"), key)).alias("cccpartnoexp"),
        F.when(key % 5 != 0, F.concat(F.lit("Size "), c("p_size"))).alias("cccbarcodetp"),
    )


def _partner_ids(key: str, odd: int):
    return (F.col(key) * 2 + odd).alias("trdr")


def _partners(supplier: DataFrame, customer: DataFrame) -> DataFrame:
    def view(df: DataFrame, p: str, key: str, odd: int) -> DataFrame:
        nation = F.col(f"{p}_nationkey")
        return df.select(
            _partner_ids(key, odd),
            F.col(key).cast("string").alias("code"),
            F.col(f"{p}_name").alias("name"),
            F.when(nation % 2 == 0, 113).otherwise(100).alias("socurrency"),
            nation.alias("country"),
        )

    return view(supplier, "s", "s_suppkey", 0).unionByName(view(customer, "c", "c_custkey", 1))


def _partner_extra(supplier: DataFrame, customer: DataFrame) -> DataFrame:
    ids = supplier.select(_partner_ids("s_suppkey", 0)).unionByName(
        customer.select(_partner_ids("c_custkey", 1))
    )
    return ids.withColumn("sodtype", F.lit(13))


def _branches(customer: DataFrame) -> DataFrame:
    return customer.select(
        F.col("c_custkey").alias("branch"),
        F.col("c_mktsegment").alias("name"),
        F.lit(COMPANY).alias("company"),
    )


def _countries(nation: DataFrame) -> DataFrame:
    return nation.select(F.col("n_nationkey").alias("country"), F.col("n_name").alias("name"))


def _products(part: DataFrame) -> DataFrame:
    return part.select(
        F.col("p_partkey").alias("productid"), F.col("p_retailprice").alias("pricetosell")
    )


def _warehouses(
    supplier: DataFrame, customer: DataFrame, nation: DataFrame, region: DataFrame
) -> DataFrame:
    places = nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        F.col("n_nationkey").alias("nation"), F.col("r_name").alias("name")
    )
    ids = supplier.select(
        (F.col("s_suppkey") * 2).alias("whouse"), F.col("s_nationkey").alias("nation")
    ).unionByName(
        customer.select(
            (F.col("c_custkey") * 2 + 1).alias("whouse"), F.col("c_nationkey").alias("nation")
        )
    )
    return ids.join(places, "nation").select("whouse", "name", F.lit(COMPANY).alias("company"))


def _dated_lines(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    return orders.join(lineitem, orders.o_orderkey == lineitem.l_orderkey)


def _item_costs(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    price = F.col("l_extendedprice") / F.col("l_quantity")
    return (
        _dated_lines(orders, lineitem)
        .groupBy(F.col("l_partkey").alias("mtrl"), F.year("o_orderdate").alias("fiscprd"))
        .agg(
            to_decimal(F.avg(price), 12, 2).cast("double").alias("purfifo"),
            to_decimal(F.min(price), 12, 2).cast("double").alias("standcost"),
        )
        .withColumns({"company": F.lit(COMPANY), "period": F.lit(1000)})
    )


def _item_month(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    """Sales by month, one row per line: the reports sum them anyway."""
    sales = _dated_lines(orders.filter(_source() == 1351), lineitem)
    return sales.select(
        F.col("l_partkey").alias("mtrl"),
        F.lit(COMPANY).alias("company"),
        F.year("o_orderdate").alias("fiscprd"),
        F.month("o_orderdate").alias("period"),
        F.col("l_quantity").alias("salqty"),
    )


def _item_year(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    dated = _dated_lines(orders, lineitem)
    return dated.select(
        F.col("l_partkey").alias("mtrl"),
        F.lit(COMPANY).alias("company"),
        F.year("o_orderdate").alias("fiscprd"),
    ).distinct()


def _stock(lineitem: DataFrame) -> DataFrame:
    """Stock per product and source, one row per line: the reports sum them anyway."""
    c = F.col
    quantity, flag = c("l_quantity"), c("l_returnflag")
    source = (c("l_suppkey") % 10).cast("int")
    product = c("l_partkey").cast("string")

    def units(condition):
        return F.when(condition, quantity).otherwise(0.0)

    return lineitem.select(
        c("l_partkey").alias("productid"),
        F.when(source == 8, F.concat(F.lit("ID"), product))
        .otherwise(product)
        .alias("supplierproductid"),
        source.alias("supplierid"),
        units(flag == "N").alias("unitsinstock"),
        units((c("l_linestatus") == "F") & (flag == "A")).alias("customerorderunits"),
        units(flag == "R").alias("supplierorderunits"),
    )


def previous_export(spark: SparkSession, directory: str) -> DataFrame:
    """An earlier export: two thirds of the items, some with a new price entered."""
    key, price = F.col("p_partkey"), F.col("p_retailprice")
    return (
        read(spark, directory, "part")
        .filter(key % 3 != 0)
        .select(
            key.cast("string").alias("code"),
            price.alias("last_price"),
            F.when(key % 5 == 0, price * 0.9).alias("new_price"),
            key.alias("row_no"),
        )
    )
