"""Facts that hold for any data, checked on the smallest sample."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from checks.queries import CFG, QUERIES
from stocklens.operators.stock import stock_position
from stocklens.plans.retail import retail_category_share
from stocklens.sources.sample import YEAR, sample_tables

DIRECTORY = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(DIRECTORY), reason="no sample data")


@pytest.fixture(scope="module")
def t(spark):
    return sample_tables(spark, DIRECTORY)


def test_shares_of_a_category_quarter_add_up_to_100(t):
    shares = retail_category_share(t, CFG, YEAR).groupBy("category", "quarter")
    off = shares.agg(
        F.abs(F.sum("share_pct") - 100).alias("off"), (F.count("*") * 0.005).alias("rounding")
    )
    assert off.filter("off > rounding").collect() == []


def test_suggestions_stay_within_availability(spark):
    rows = QUERIES["hub_suggestion"](spark, DIRECTORY).join(
        QUERIES["own_store_suggestion"](spark, DIRECTORY), ["code", "available"]
    )
    over = rows.filter("store_suggestion + hub_suggestion > greatest(available, 0)")
    assert over.collect() == []
    assert rows.filter("store_suggestion < 0").collect() == []


def test_one_pass_equals_sums_per_site(t):
    wide = stock_position(t.stock, CFG)
    for site in (CFG.own, CFG.tql, CFG.dsv, CFG.dream_cargo, CFG.hub):
        single = (
            t.stock.filter(F.col("supplierid").isin(*site.stock_sources))
            .groupBy("productid")
            .agg(F.sum("unitsinstock").alias("one"))
        )
        both = wide.join(single, "productid", "full")
        assert both.filter(~F.col("one").eqNullSafe(F.col(f"{site.name}_on_hand"))).count() == 0


def test_new_and_known_items_are_all_items(spark):
    got = QUERIES["new_items"](spark, DIRECTORY)
    counts = {r["status"]: r["count"] for r in got.groupBy("status").count().collect()}
    items = sample_tables(spark, DIRECTORY).items.count()
    assert counts["NEW"] + counts[None] == items
    assert counts["NEW"] > 0


def test_headers_cover_the_categories_with_details(spark):
    report = QUERIES["deal_report"](spark, DIRECTORY)
    headers = {r[0] for r in report.filter("is_detail = 0").select("category").collect()}
    details = {r[0] for r in report.filter("is_detail = 1").select("category").collect()}
    assert headers == (details - {"STANDARD"}) | {CFG.refurbished_header}
