"""Shape of the plans: what is read, how often, and how it is joined."""

from __future__ import annotations

import os
import re

import pytest
from pyspark.sql import functions as F

from checks.queries import CFG, QUERIES
from stocklens.config import ReportConfig
from stocklens.operators import lines as L
from stocklens.operators import movements as M
from stocklens.operators.stock import PRODUCT, SUPPLIER_KEY, stock_facts, stock_position
from stocklens.operators.suppliers import item_suppliers, supplier_list
from stocklens.plans import transfers as T
from stocklens.plans.deals import unordered_deal_report
from stocklens.plans.export import export_report
from stocklens.plans.labels import (
    DEAL_LABELS,
    EXPORT_LABELS,
    RETAIL_LABELS,
    labelled,
    transfer_labels,
)
from stocklens.plans.retail import retail_category_share
from stocklens.sources.sample import AS_OF, YEAR, sample_tables
from stocklens.sources.tables import SCHEMAS, Tables
from tests.erp import AS_OF as ERP_AS_OF
from tests.erp import Erp, day

DIRECTORY = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(DIRECTORY), reason="no sample data")


@pytest.fixture(scope="module")
def t(spark):
    return sample_tables(spark, DIRECTORY)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def scans(text: str, table: str) -> int:
    return len(re.findall(rf"FileScan parquet .*{table}\.parquet", text))


@pytest.mark.parametrize(
    "name",
    ["deal_report", "transfer_suggestions", "export_report", "retail_category_share", "new_items"],
)
def test_reports_join_by_key_in_the_jvm(spark, name):
    text = plan(QUERIES[name](spark, DIRECTORY))
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "CollectLimit"):
        assert node not in text
    # no global window, no single-partition exchange
    assert "Window" not in text
    assert "SinglePartition" not in text


def test_stock_is_read_once(t):
    assert scans(plan(stock_position(t.stock, CFG)), "lineitem") == 1
    assert scans(plan(stock_facts(t.stock, CFG, (PRODUCT, SUPPLIER_KEY))), "lineitem") == 1


def test_movements_read_headers_and_lines_once(t):
    moves = M.item_movements(
        t,
        CFG,
        AS_OF,
        settled_purchases=True,
        sales_days=(90, 30),
        transfer_types=CFG.site_transfer_types,
    )
    text = plan(moves)
    assert scans(text, "lineitem") == 1
    # headers and their stock side
    assert scans(text, "orders") == 2


def test_transfer_report_reads_lines_three_times(t):
    """Once for movements, once as stock (a table of its own elsewhere), once for the site."""
    text = plan(T.transfer_suggestions(t, CFG, CFG.dsv, AS_OF))
    assert scans(text, "lineitem") == 3


@pytest.mark.parametrize("exclude", [(), CFG.logistics_companies])
def test_supplier_lists_read_purchases_once(t, exclude):
    """The distinct pairs are used three times and exchanged once."""
    df = supplier_list(item_suppliers(t, CFG, exclude=exclude))
    df.collect()
    final = plan(df).split("Initial Plan")[0]
    assert scans(final, "lineitem") == 1 and "ReusedExchange" in final


def test_scans_are_pruned_and_filtered(spark, t):
    text = plan(QUERIES["export_invoice_lines"](spark, DIRECTORY))
    assert "GreaterThanOrEqual(o_orderdate" in text and "LessThan(o_orderdate" in text
    seen = plan(T.items_seen_at(t, CFG, CFG.dsv))
    columns = re.findall(r"ReadSchema: struct<([^>]*)>", seen)
    assert "l_partkey:bigint,l_suppkey:bigint" in columns


@pytest.mark.parametrize(
    ("name", "unread"),
    [
        ("sales_lines", {"l_discount", "l_returnflag", "l_linestatus", "l_extendedprice"}),
        ("purchase_lines", {"l_discount"}),
    ],
)
def test_line_exchanges_carry_only_what_is_shown(spark, name, unread):
    """Salts of NULL ids hash a few shown columns: a hash of all would keep every column alive."""
    seen = re.findall(r"ReadSchema: struct<([^>]*l_partkey[^>]*)>", plan(QUERIES[name](spark, DIRECTORY)))
    assert seen and not any(c in columns for c in unread for columns in seen)


def test_customers_and_branches_are_looked_up_per_document(spark):
    """Both joins of the sales query are below the one of headers and lines."""
    text = QUERIES["sales_lines"](spark, DIRECTORY)._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in text.splitlines() if "Join " in line]
    depth = {key: max(len(j) - len(j.lstrip(" :+-")) for j in joins if key in j)
             for key in ("(doc_id#", "(branch_id#", "(partner_id#")}
    assert depth["(branch_id#"] > depth["(doc_id#"] and depth["(partner_id#"] > depth["(doc_id#"]


def test_sums_are_taken_before_the_shuffle(t):
    text = plan(stock_position(t.stock, CFG))
    assert "partial_sum" in text and text.count("Exchange") == 1


# ---- hot keys ---------------------------------------------------------------------------------

LINES = 200_000


def hot_company(spark, hot_document: bool) -> Tables:
    """Sales of which one document, or one item, holds a third of all lines.

    The last of the ``LINES + 1`` lines has a document and an item of its own that do not exist.
    """
    erp = Erp()
    erp.category(1, "Laptops")
    small = erp.tables(spark)
    n = F.col("id")
    hot = n % 3 == 0
    mostly = F.when(hot, -1).otherwise(n)
    doc, item = (mostly, n) if hot_document else (n, mostly)

    def column(name, sql_type, values):
        return values.get(name, F.lit(None)).cast(sql_type).alias(name)

    def frame(table, **values):
        fields = [f.strip().split(" ") for f in SCHEMAS[table].split(",")]
        return spark.range(LINES + 1).select(*[column(f[0], f[1], values) for f in fields])

    lit = F.lit
    documents = frame(
        "documents",
        findoc=n - 1,
        company=lit(1000),
        sosource=lit(1351),
        soredir=lit(0),
        sodtype=lit(13),
        fprms=lit(7061),
        trndate=lit(day(1)),
        trdr=n,
    )
    tables = {
        "documents": documents,
        "document_stock": frame("document_stock", findoc=n - 1, whouse=lit(1000)),
        "lines": frame("lines", findoc=doc, company=lit(1000), mtrl=item, qty1=lit(1.0)),
        "items": frame(
            "items", mtrl=n - 1, company=lit(1000), code=n - 1, mtrmanfctr=lit(1)
        ),
        "partners": frame("partners", trdr=n, name=n),
    }
    return Tables(lambda name: tables.get(name, getattr(small, name)))


@pytest.fixture
def small_partitions(spark):
    """Thresholds at which a small test has skewed partitions and no broadcast of large sides."""
    changed = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "50KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.autoBroadcastJoinThreshold": "100KB",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "100KB",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k, None) for k in changed}
    for k, v in changed.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def run_plan(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    return plan(df)


def test_a_hot_document_is_split(spark, small_partitions):
    t = hot_company(spark, hot_document=True)
    moves = M.item_movements(t, ReportConfig(), ERP_AS_OF, purchases=False, sales_days=[30])
    total = moves.agg(F.sum("sold_30").alias("sold"))
    assert "skew=true" in run_plan(total)
    assert total.collect()[0]["sold"] == LINES


def test_a_hot_item_is_split(spark, small_partitions):
    t = hot_company(spark, hot_document=False)
    lines = L.document_lines(t, ReportConfig(), F.lit(True))
    named = L.with_partner(L.with_item(lines, t), t).agg(F.count("item_code").alias("named"))
    assert "skew=true" in run_plan(named)
    assert named.collect()[0]["named"] == LINES


def test_every_report_column_has_a_heading(t):
    reports = {
        "deals": (unordered_deal_report(t, CFG, AS_OF), DEAL_LABELS, 27),
        "transfers": (T.transfer_suggestions(t, CFG, CFG.dsv, AS_OF), transfer_labels(CFG.dsv), 23),
        "export": (export_report(t, CFG, YEAR, AS_OF), EXPORT_LABELS, 33),
        "retail": (retail_category_share(t, CFG, YEAR), RETAIL_LABELS, 10),
    }
    for df, labels, count in reports.values():
        found = labelled(df, labels).columns
        assert found == list(labels.values()) and len(set(found)) == count
        assert set(df.columns) - set(labels) <= {"block", "rank", "is_detail"}
