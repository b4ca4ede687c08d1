"""One small case per report rule, with rows worked out by hand."""

from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from stocklens.config import DSV_COMPANY, ReportConfig
from stocklens.functions.dates import entry_clock, in_last_days
from stocklens.functions.numbers import number_text, to_decimal, to_whole
from stocklens.functions.text import (
    ACCENTED,
    PLAIN,
    matches_any,
    normalise_key,
    split_list,
    text_key,
)
from stocklens.operators import lines as L
from stocklens.operators import movements as M
from stocklens.operators.costs import (
    arrival_price,
    blended_cost,
    line_fifo_cost,
    monthly_sales,
    year_costs,
)
from stocklens.operators.stock import stock_position
from stocklens.operators.suppliers import (
    item_suppliers,
    list_width,
    supplier_columns,
    supplier_list,
    supplier_rows,
)
from stocklens.plans import deals as D
from stocklens.plans.export import export_report, export_vs_retail_stock
from stocklens.plans.retail import retail_category_share
from stocklens.plans.transfers import site_candidates, transfer_suggestions, with_suggestions
from stocklens.sources.tables import ambiguous_ids, lookup
from tests.erp import (
    AS_OF,
    DREAM_W,
    DSV_W,
    HUB_W,
    ORDER,
    OTHER_TYPE,
    PACKING,
    PAPADA,
    TQL_W,
    Erp,
    day,
    rows,
)

CFG = ReportConfig()


@pytest.fixture
def erp():
    e = Erp()
    e.category(1, "Laptops")
    e.category(2, "Exp Laptops")
    e.partner(1, "Supplier A")
    e.partner(2, "Supplier B", currency=113)
    e.partner(50, "Customer", kind=13)
    return e


def values(spark, sql_type, *items):
    return spark.createDataFrame([(v,) for v in items], f"v {sql_type}")


def mapped(df, c):
    return [r[0] for r in df.select(c).collect()]


# ---- text, numbers, dates ---------------------------------------------------------------------


def test_text_key_agrees_with_collation(spark):
    texts = ["ΆΛΦΑ ", "αλφα", "Οδός", "ΟΔΟΣ", "προϊόν", "ΠΡΟΙΟΝ  ", "Ώρα", "ωρα", " x", "x", "é"]
    df = values(spark, "string", *texts)
    pairs = df.crossJoin(df.select(F.col("v").alias("w")))
    ci_ai = "UNICODE_CI_AI_RTRIM"
    wrong = pairs.filter(
        (text_key(F.col("v")) == text_key(F.col("w")))
        != (F.collate("v", ci_ai) == F.collate("w", ci_ai))
    )
    assert wrong.collect() == []
    assert len(ACCENTED) == len(PLAIN)


def test_patterns_ignore_case_and_keep_null(spark):
    df = values(spark, "string", "Exp Laptops", "Laptops", None)
    assert mapped(df, matches_any(F.col("v"), ("%EXP%",))) == [True, False, None]


def test_keys(spark):
    texts = [" 00123 ", "123.0", "nan", "", "AB-1", None, "None", "<NA>", "1.5", "9007199254740993"]
    got = mapped(values(spark, "string", *texts), normalise_key(F.col("v")))
    want = ["123", "123", None, None, "AB-1", None, None, None, "1.5", "9007199254740993"]
    assert got == want


def test_keys_lose_every_white_space_around_them(spark):
    texts = ["\t00123\n", "\r\n AB-1\t", "\u00a0nan\u2003", " \t\n ", "A B\tC"]
    got = mapped(values(spark, "string", *texts), normalise_key(F.col("v")))
    assert got == ["123", "AB-1", None, None, "A B\tC"]


def test_tokens(spark):
    df = values(spark, "string", "A, B,,C", None, "")
    assert mapped(df, split_list(F.col("v"))) == [["A", "B", "C"], None, []]
    assert mapped(df, split_list(F.col("v"), drop_empty=False)) == [
        ["A", "B", "", "C"],
        None,
        [""],
    ]


def test_conversions(spark):
    df = values(spark, "double", 7.9, -7.9, 100.1 / 20, None)
    assert mapped(df, to_whole(F.col("v"))) == [7, -7, 5, None]
    assert [str(x) for x in mapped(df, to_decimal(F.col("v"), 10, 2))] == [
        "7.90",
        "-7.90",
        "5.01",
        "None",
    ]
    assert mapped(values(spark, "double", 23.0, 900.1, None), number_text(F.col("v"))) == [
        "23",
        "900.1",
        None,
    ]


def test_clock_has_twelve_hours(spark):
    df = values(spark, "timestamp", datetime(2025, 1, 1, 13, 23), datetime(2025, 1, 1, 0, 5))
    assert mapped(df, entry_clock(F.col("v"))) == ["01:23", "12:05"]


def test_day_window_edges(spark):
    df = values(spark, "timestamp", day(0), day(30), day(31), day(-1))
    assert mapped(df, in_last_days(F.col("v"), AS_OF, 30)) == [True, True, False, False]


# ---- lines ------------------------------------------------------------------------------------


def test_purchase_without_known_type_is_dropped(spark, erp):
    erp.item(1, "1")
    for fprms in (ORDER, None, 9999, 2020):
        erp.purchase(1, 5.0, fprms=fprms)
    t = erp.tables(spark)
    assert rows(L.purchase_lines(t, CFG), "doc_no") == [("D1",)]
    every = L.purchase_lines(t, CFG, exclude_type=False)
    assert rows(every, "doc_no") == [("D1",), ("D2",), ("D3",), ("D4",)]


def test_document_without_lines_is_kept(spark, erp):
    erp.document(1251, 12, ORDER, 1, day(1), PAPADA)
    got = rows(L.purchase_lines(erp.tables(spark), CFG), "doc_no", "item_code", "quantity")
    assert got == [("D1", None, 0.0)]


def test_open_quantity_needs_all_three_figures(spark, erp):
    erp.item(1, "1")
    erp.purchase(1, 10.0, qty1cov=3.0, qty1canc=1.0)
    erp.purchase(1, 10.0, qty1cov=None)
    erp.purchase(1, 10.0, restmode=None)
    t = erp.tables(spark)
    assert rows(L.purchase_lines(t, CFG), "doc_no", "open_quantity") == [
        ("D1", 6.0),
        ("D2", None),
        ("D3", 0.0),
    ]
    got = M.expected_arrivals(t, CFG, AS_OF, [CFG.own])
    assert rows(got, "key", "own_arrivals") == [("1", 6.0)]


def test_prices_by_currency(spark, erp):
    erp.item(1, "1")
    erp.purchase(1, 8.0, price=5.0, trdr=1)
    erp.purchase(1, 8.0, price=5.0, trdr=2, ltrnlineval=100.04)
    erp.purchase(1, 0.0, price=5.0, trdr=2)
    got = rows(L.purchase_lines(erp.tables(spark), CFG), "doc_no", "euro_price")
    assert got == [("D1", 5.0), ("D2", 12.51), ("D3", 0.0)]


def test_sales_need_known_maker_and_warehouse(spark, erp):
    erp.item(1, "1")
    erp.item(2, "2", mtrmanfctr=None)
    erp.sale(1, 3.0)
    erp.sale(2, 3.0)
    erp.sale(1, 3.0, whouse=None)
    t = erp.tables(spark)
    assert rows(L.sales_lines(t, CFG), "doc_no", "entry_clock") == [("D1", "01:23")]
    assert rows(M.recent_sales(t, CFG, AS_OF, (30, 90)), "key", "sold_30", "sold_90") == [
        ("1", 3.0, 3.0)
    ]


def test_sales_windows_and_types(spark, erp):
    erp.item(1, "1")
    for back, fprms in ((0, 7061), (30, 7201), (31, 7061), (90, 7203), (91, 7061), (-1, 7061)):
        erp.sale(1, 1.0, back=back, fprms=fprms)
    t = erp.tables(spark)
    assert rows(M.recent_sales(t, CFG, AS_OF, (30, 90)), "sold_30", "sold_90") == [(2.0, 4.0)]
    exported = M.recent_sales(t, CFG, AS_OF, (90,), types=CFG.export_types)
    assert rows(exported, "sold_90") == [(2.0,)]


def test_sales_by_channel(spark, erp):
    erp.item(1, "1")
    erp.sale(1, 1.0, whouse=HUB_W)
    erp.sale(1, 2.0, whouse=HUB_W, fprms=7201)
    erp.sale(1, 4.0, fprms=7201)
    erp.sale(1, 8.0)
    erp.sale(1, 0.5)
    got = M.sales_by_channel(erp.tables(spark), CFG, AS_OF, 30, min_quantity=1.0)
    assert rows(got, "hub_sales", "store_sales", "non_hub_sales") == [(3.0, 9.0, 8.0)]


def test_transfers(spark, erp):
    erp.item(1, "1")
    erp.transfer(1, 1.0, DSV_W, PAPADA)
    erp.transfer(1, 2.0, TQL_W, PAPADA)
    erp.transfer(1, 4.0, PAPADA, HUB_W, fprms=2501)
    erp.transfer(1, 8.0, DSV_W, PAPADA, state=1)
    t = erp.tables(spark)
    got = M.transfers_in(t, CFG, AS_OF, CFG.dsv, CFG.site_transfer_types)
    columns = ("transfers", "to_store_transfers", "to_hub_transfers")
    assert rows(got, *columns) == [(7.0, 1.0, 4.0)]
    only = M.transfers_in(t, CFG, AS_OF, CFG.dsv, CFG.deals_transfer_types)
    assert rows(only, *columns) == [(3.0, 1.0, None)]


def test_two_names_of_one_id_repeat_rows(spark, erp):
    erp.category(7, "Phones")
    erp.category(7, "Mobile phones")
    erp.category(7, "Phones")
    t = erp.tables(spark)
    df = values(spark, "int", 7).withColumnRenamed("v", "category_id")
    found = lookup(df, t.categories, "mtrcategory", "name", "category_id", "category")
    assert rows(found, "category") == [("Mobile phones",), ("Phones",)]
    assert rows(ambiguous_ids(t.categories, "mtrcategory", "name"), "mtrcategory", "names") == [
        (7, 2)
    ]


# ---- stock and arrivals -----------------------------------------------------------------------


def test_two_rows_of_one_source_are_summed(spark, erp):
    erp.stock(1, 18, units=3.0)
    erp.stock(1, 18, units=4.0)
    erp.stock(1, 13, units=1.0, customer=2.0)
    erp.stock(1, 39, units=5.0)
    erp.stock(1, 41, units=0.0, customer=1.0, supplier=6.0)
    got = stock_position(erp.tables(spark).stock, CFG)
    columns = ("productid", "incoming", "own_on_hand", "own_reserved", "dsv_on_hand")
    assert rows(got, *columns) == [(1, 7.0, 6.0, 2.0, None)]
    assert rows(got, "tql_reserved", "tql_deals_reserved") == [(1.0, 6.0)]


def test_arrivals_that_net_to_zero_have_no_price(spark, erp):
    erp.item(1, "1")
    erp.purchase(1, 5.0, price=2.0)
    erp.purchase(1, -5.0, price=2.0)
    erp.purchase(1, 5.0, fprms=OTHER_TYPE)
    got = M.expected_arrivals(erp.tables(spark), CFG, AS_OF, [CFG.own])
    assert rows(got, "own_arrivals", "own_weighted_price") == [(0.0, None)]


def test_prices_of_two_sites_add_up_unless_pooled(spark, erp):
    erp.item(1, "1")
    erp.purchase(1, 4.0, price=10.0)
    erp.purchase(1, 1.0, price=20.0, whouse=DSV_W, fprms=PACKING)
    t = erp.tables(spark)
    named = M.named_movements(M.item_movements(t, CFG, AS_OF), t, CFG)
    sites = CFG.deals_sites
    sums = M.by_item_code(named, t, M.arrival_sums(sites))
    assert mapped(sums, arrival_price(sites)) == [30.0]
    assert mapped(sums, arrival_price(sites, "pooled")) == [12.0]
    cost = blended_cost(F.lit(5.0), F.lit(8.0), sites, "pooled")
    assert mapped(sums, cost) == [(5 * 8 + 5 * 12) / 10]
    with pytest.raises(ValueError):
        arrival_price(sites, "mean")


def test_blended_cost_without_anything_is_null(spark):
    df = spark.range(1).selectExpr(
        *[f"CAST(NULL AS DOUBLE) {s.name}_{m}" for s in CFG.deals_sites
          for m in ("arrivals", "arrivals_value")]
    )
    cost = blended_cost(F.lit(0.0), F.lit(None).cast("double"), CFG.deals_sites)
    assert mapped(df, cost) == [None]


def test_virtual_arrivals_come_from_logistics_companies(spark, erp):
    erp.item(1, "1")
    erp.partner(3, DSV_COMPANY)
    erp.purchase(1, 2.0, trdr=3)
    erp.purchase(1, 4.0, trdr=1)
    erp.purchase(1, 8.0, trdr=3, whouse=TQL_W)
    t = erp.tables(spark)
    assert rows(M.virtual_arrivals(t, CFG, AS_OF, (CFG.dsv, CFG.tql)), "virtual_arrivals") == [
        (2.0,)
    ]
    assert rows(M.virtual_arrivals(t, CFG, AS_OF, (CFG.tql,)), "virtual_arrivals") == []


def test_net_stock_needs_an_incoming_row(spark, erp):
    erp.item(1, "1", relitem=2)
    erp.item(2, "2")
    erp.stock(1, 13, units=5.0, customer=1.0)
    erp.stock(2, 13, units=5.0)
    erp.stock(2, 18, units=2.0)
    erp.stock(2, 42, units=1.0, customer=4.0)
    got = export_vs_retail_stock(erp.tables(spark), CFG)
    assert rows(got, "item_id", "export_stock", "export_net", "retail_incoming", "retail_net") == [
        (1, 5.0, None, "2", 4.0),
        (2, 5.0, 4.0, "", None),
    ]


# ---- costs and months -------------------------------------------------------------------------


def test_year_costs(spark, erp):
    for fiscprd, period, fifo in ((2025, 1000, 5.0), (2025, 3, 99.0), (2024, 1000, 4.0)):
        erp.add(
            "item_costs", mtrl=1, company=1000, fiscprd=fiscprd, period=period, purfifo=fifo,
            standcost=fifo + 1,
        )
    erp.add("item_costs", mtrl=2, company=1000, fiscprd=2024, period=1000, purfifo=7.0)
    got = year_costs(erp.tables(spark).item_costs, CFG, 2025)
    columns = ("item_id", "fifo_this_year", "fifo_last_year", "standard_this_year")
    assert rows(got, *columns) == [(1, 5.0, 4.0, 6.0), (2, None, 7.0, None)]
    per_line = line_fifo_cost(erp.tables(spark).item_costs, CFG)
    assert rows(per_line, "item_id", "doc_year", "fifo_cost") == [
        (1, 2024, 4.0),
        (1, 2025, 5.0),
        (2, 2024, 7.0),
    ]


def test_months_cross_the_year(spark, erp):
    for fiscprd, period, quantity in (
        (2025, 1, 1.0),
        (2024, 12, 2.0),
        (2024, 11, 4.0),
        (2024, 10, 8.0),
        (2024, 9, 16.0),
        (2025, 0, 32.0),
        (2024, 1000, 64.0),
        (2025, 2, 128.0),
        (2024, 13, 256.0),
    ):
        erp.add(
            "item_month", mtrl=1, company=1000, fiscprd=fiscprd, period=period, salqty=quantity
        )
    got = monthly_sales(erp.tables(spark).item_month, CFG, date(2025, 1, 20))
    assert rows(got, "month_3", "month_2", "month_1", "month_0") == [(8.0, 4.0, 2.0, 1.0)]


# ---- suppliers --------------------------------------------------------------------------------


def test_items_of_one_description_share_suppliers(spark, erp):
    erp.partner(3, "A & B")
    erp.partner(4, DSV_COMPANY)
    erp.partner(5, None)
    erp.item(1, "1", name="Phone X")
    erp.item(2, "2", name="PHONE X ")
    erp.item(3, "3", name=None)
    erp.item(4, "4", name="Phone X")
    erp.item(5, "5", name="Other")
    for mtrl, trdr in ((1, 1), (1, 1), (2, 3), (3, 1), (4, 4), (5, 5)):
        erp.purchase(mtrl, 1.0, trdr=trdr)
    t = erp.tables(spark)
    exclude = CFG.logistics_companies
    deals = supplier_list(item_suppliers(t, CFG, exclude=exclude))
    both = "A & B, Supplier A"
    assert rows(deals, "item_id", "suppliers") == [(1, both), (2, both), (3, None)]
    everyone = supplier_list(item_suppliers(t, CFG))
    all_three = f"A & B, {DSV_COMPANY}, Supplier A"
    assert rows(everyone, "item_id", "suppliers") == [
        (1, all_three),
        (2, all_three),
        (3, None),
        (4, all_three),
        (5, None),
    ]


def test_supplier_columns(spark):
    df = spark.createDataFrame([(1, "A, B,,C"), (2, None)], "item_id int, suppliers string")
    wide = supplier_columns(df, 2)
    assert rows(wide, "item_id", "suppliers", "supplier_1", "supplier_2") == [
        (1, "A, B,,C", "A", "B"),
        (2, None, None, None),
    ]
    assert "suppliers" not in supplier_columns(df, 2, keep=False).columns
    raw = supplier_columns(df, 3, keep=False, drop_empty=False)
    assert rows(raw, "item_id", "supplier_3") == [(1, ""), (2, None)]
    assert rows(list_width(df), "max_tokens") == [(3,)]
    assert rows(list_width(df.limit(0)), "max_tokens") == [(0,)]
    assert rows(supplier_rows(df), "item_id", "place", "supplier") == [
        (1, 1, "A"),
        (1, 2, "B"),
        (1, 3, "C"),
    ]


# ---- transfer suggestions ---------------------------------------------------------------------


@pytest.fixture
def site(erp):
    """Item 1 at the outside site, related to item 2 in the stores."""
    erp.item(1, "1", relitem=2)
    erp.item(2, "2")
    doc = erp.document(1251, 12, OTHER_TYPE, 1, day(100), DSV_W)
    erp.line(doc, 1, 1.0, whouse=DSV_W)
    return erp


def suggestions(spark, erp, cfg=CFG):
    t = erp.tables(spark)
    found = with_suggestions(site_candidates(t, cfg, cfg.dsv, AS_OF), cfg, cfg.dsv)
    return rows(found, "available", "minimum_quantity", "store_suggestion", "hub_suggestion")


def test_idle_laptop_keeps_twenty_other_items_five(spark, site):
    site.stock(1, 43, units=30.0)
    assert suggestions(spark, site) == [(30, 20, 0, 0.0)]
    site.rows["categories"][0]["name"] = "Phones"
    assert suggestions(spark, site) == [(30, 5, 0, 0.0)]


def test_idle_item_keeps_no_more_than_available(spark, site):
    site.stock(1, 43, units=12.9, customer=2.0)
    assert suggestions(spark, site)[0][:2] == (10, 10)


def test_unknown_or_excluded_maker_keeps_nothing(spark, site):
    site.stock(1, 43, units=30.0)
    site.rows["items"][0]["mtrmanfctr"] = None
    assert suggestions(spark, site) == [(30, 0, 0, 0.0)]
    site.maker(2, "SONY")
    site.rows["items"][0]["mtrmanfctr"] = 2
    assert suggestions(spark, site) == [(30, 0, 0, 0.0)]


def test_store_suggestion_is_capped(spark, site):
    site.stock(1, 43, units=7.0)
    site.sale(2, 8.0)
    assert suggestions(spark, site) == [(7, 0, 7, 0.0)]


def test_store_suggestion_covers_sales_by_half_more(spark, site):
    site.stock(1, 43, units=50.0)
    site.stock(2, 13, units=3.0, customer=1.0)
    site.sale(2, 9.0)
    site.transfer(2, 1.0, DSV_W, PAPADA)
    site.purchase(2, 2.0)
    # 1.5 * 9 - (3 + 1 + 2 - 1) = 8.5, rounded
    assert suggestions(spark, site) == [(50, 0, 9, 0.0)]


def test_hub_gets_what_the_stores_leave(spark, site):
    site.stock(1, 43, units=10.0)
    site.stock(2, 42, units=1.0, customer=2.0)
    site.sale(2, 4.0)
    site.sale(2, 9.0, whouse=HUB_W, fprms=7201)
    # stores: 1.5 * 4 = 6; hub: 9 - (1 - 2) = 10, of which 10 - 6 are left
    assert suggestions(spark, site) == [(10, 0, 6, 4.0)]


def test_negative_availability_goes_to_the_hub(spark, site):
    site.stock(1, 43, units=1.0, customer=5.0)
    site.purchase(1, 2.0, whouse=DSV_W)
    site.sale(2, 4.0)
    site.sale(2, 4.0, whouse=HUB_W)
    assert suggestions(spark, site) == [(-2, 0, 0, -2.0)]


def test_need_beyond_its_precision_raises(spark, site):
    site.stock(1, 43, units=7.0)
    site.sale(2, 6667.0)
    with pytest.raises(Exception, match="NUMERIC_VALUE_OUT_OF_RANGE"):
        suggestions(spark, site)
    assert suggestions(spark, site, CFG.with_(need_precision=12)) == [(7, 0, 7, 0.0)]


def test_candidates_were_seen_at_the_site_and_have_stock(spark, site):
    site.item(3, "3")
    site.stock(3, 43, units=5.0)
    assert suggestions(spark, site) == []
    site.stock(1, 43, units=0.9)
    assert suggestions(spark, site) == []
    site.purchase(1, 0.5, whouse=DSV_W)
    assert suggestions(spark, site)[0][0] == 0


def test_transfer_report_for_each_site(spark, site):
    site.stock(1, 43, units=4.0)
    site.stock(1, 41, units=6.0)
    site.stock(2, 42, units=3.0, key="2 ")
    site.line(1, 1, 1.0, whouse=TQL_W)
    t = site.tables(spark)
    columns = ("code", "related_code", "site_stock", "hub_stock", "minimum_quantity")
    assert rows(transfer_suggestions(t, CFG, CFG.dsv, AS_OF), *columns) == [("1", "2", 4, 3, 0)]
    assert rows(transfer_suggestions(t, CFG, CFG.tql, AS_OF), *columns) == [("1", "2", 6, 3, 0)]


# ---- deals ------------------------------------------------------------------------------------


def deal_main(spark, erp, **options):
    t = erp.tables(spark)
    moves = D.deal_movements(t, CFG, AS_OF)
    return t, D.deal_main(t, CFG, AS_OF, moves, **options)


def test_deal_measures_of_both_branches(spark, erp):
    erp.partner(3, DSV_COMPANY)
    erp.item(1, "1", name="Laptop EXP", mtrcategory=2, relitem=2)
    erp.item(2, "2", name="Laptop", mtrcategory=1, pricer=77.0)
    for product in (1, 2):
        erp.stock(product, 13, units=10.0, customer=1.0)
        erp.stock(product, 41, units=4.0, customer=50.0, supplier=2.0)
        erp.stock(product, 18, units=3.0, key="ID2" if product == 2 else None)
    erp.purchase(2, 3.0, trdr=3)
    erp.purchase(1, 5.0, price=20.0)
    erp.purchase(1, 5.0, price=30.0, whouse=DREAM_W)
    erp.transfer(1, 2.0, DSV_W, PAPADA)
    erp.sale(1, 6.0, back=60)
    erp.sale(2, 7.0, back=3, fprms=7201)
    for mtrl, fifo in ((1, 8.0), (2, 9.0)):
        erp.add(
            "item_costs", mtrl=mtrl, company=1000, fiscprd=2025 if mtrl == 1 else 2024,
            period=1000, purfifo=fifo, standcost=5.0,
        )
    _, main = deal_main(spark, erp)
    got = {r["code"]: r.asDict() for r in main.collect()}
    one, two = got["1"], got["2"]
    assert (one["ready_stock"], one["reserved"], one["own_stock"]) == (14.0, 3.0, 7.0)
    assert (one["actual_stock"], one["actual_b2b"], one["virtual_arrivals"]) == (None, 12.0, 3.0)
    assert (one["final_stock"], one["sold_90"], one["sold_30"]) == (11.0, 6.0, 7.0)
    assert (one["standard_cost"], one["fifo_price"], one["net_retail"]) == (50.0, 8.0, 77.0)
    # (7 + 4) * 8 + 10 * 50 over 11 + 10
    assert one["blended_cost"] == pytest.approx((11 * 8 + 10 * 50) / 21)
    assert (one["related_stock"], one["related_arrivals"], one["related_reserved"]) == (
        10.0,
        3.0,
        51.0,
    )
    assert one["related_net"] == -38.0
    assert (two["own_stock"], two["actual_stock"], two["actual_b2b"]) == (10.0, 14.0, None)
    assert (two["final_stock"], two["sold_90"], two["fifo_price"]) == (3.0, 7.0, 9.0)
    assert (two["net_retail"], two["related_code"]) == (77.0, "")


def test_deal_floors(spark, erp):
    erp.category(3, "Refurbished Laptops")
    erp.maker(2, "Apple")
    erp.item(1, "1", mtrcategory=2)
    erp.stock(1, 13, units=1.0)
    erp.item(2, "2", mtrcategory=2)
    erp.stock(2, 13, units=2.0)
    erp.item(3, "3")
    erp.stock(3, 13, units=9.0)
    erp.item(4, "4")
    erp.stock(4, 18, units=10.0)
    erp.item(5, "5", mtrcategory=3)
    erp.stock(5, 13, units=6.0)
    erp.item(6, "6", mtrmanfctr=2)
    erp.stock(6, 13, units=50.0)
    erp.item(7, "7", mtrmanfctr=None)
    erp.stock(7, 13, units=50.0)
    _, main = deal_main(spark, erp)
    assert rows(main, "code") == [("2",), ("4",), ("5",), ("7",)]


def test_related_items_of_export_products_are_left_out(spark, erp):
    erp.item(1, "1", name="Laptop exp", mtrcategory=2, relitem=2)
    erp.item(2, "2", name="Laptop", mtrcategory=1)
    erp.item(3, "3", name="Laptop 3", mtrcategory=1)
    erp.item(4, "4", name="Sold out EXP", mtrcategory=2, relitem=3)
    erp.stock(1, 13, units=20.0)
    erp.stock(2, 13, units=20.0)
    erp.stock(3, 13, units=20.0)
    # reserved beyond stock: not offered itself, yet its related item is left out
    erp.stock(4, 13, units=20.0, customer=30.0)
    _, main = deal_main(spark, erp)
    assert rows(D.deal_detail(main, CFG), "code", "final_stock") == [("1", 20)]


def test_header_blocks(spark, erp):
    erp.category(3, "Refurbished Laptops")
    erp.category(4, "EXP Cables")
    erp.item(1, "1", name="b", mtrcategory=2)
    erp.item(2, "2", name="a", mtrcategory=2)
    erp.item(3, "3", mtrcategory=3)
    erp.item(4, "4", mtrcategory=4)
    for product, units in ((1, 20.0), (2, 20.0), (3, 20.0), (4, 20.0)):
        erp.stock(product, 13, units=units)
    erp.purchase(1, 1.0, trdr=1)
    t = erp.tables(spark)
    got = D.deal_report(t, CFG, AS_OF).collect()
    assert [(r["block"], r["category"], r["is_detail"], r["code"]) for r in got] == [
        (1, "Exp Laptops", 0, None),
        (1, "Exp Laptops", 1, "2"),
        (1, "Exp Laptops", 1, "1"),
        (2, "EXP Cables", 0, None),
        (2, "EXP Cables", 1, "4"),
        (2, "Refurbirshed", 0, None),
        (3, "Refurbished Laptops", 1, "3"),
    ]
    assert [r["suppliers"] for r in got[:3]] == [None, "", "Supplier A"]
    fixed = D.deal_report(t, CFG, AS_OF, fix_header=True).collect()
    assert [(r["block"], r["category"]) for r in fixed[-2:]] == [
        (3, "Refurbished"),
        (3, "Refurbished Laptops"),
    ]


# ---- export and retail ------------------------------------------------------------------------


def test_twin_lines_are_listed_once(spark, erp):
    erp.item(1, "1")
    doc = erp.sale(1, 100.0, fprms=7201, back=10, price=50.0)
    erp.line(doc, 1, 100.0, price=50.0)
    erp.line(doc, 1, 100.0, price=60.0)
    erp.line(doc, 1, 100.0, price=25.0)
    erp.line(doc, 1, 0.5, price=9999.0)
    t = erp.tables(spark)
    assert rows(L.export_lines(t, CFG, 2025), "line_value") == [(5000.0,), (6000.0,)]
    assert L.export_invoice_lines(t, CFG, 2025).count() == 3
    assert L.export_invoice_lines(t, CFG, 2024).count() == 0


def test_pending_orders(spark, erp):
    erp.item(1, "1")

    def order(trdr=50, restmode=11, pending=1, disc1prc=0.125, **values):
        base = dict(tfprms=201)
        doc = erp.document(1351, 13, 7021, trdr, day(5), PAPADA, **{**base, **values})
        erp.line(
            doc, 1, 100.0, price=50.0, restmode=restmode, pending=pending, disc1prc=disc1prc
        )

    order()
    order(trdr=1)  # a supplier: its source would be 1251
    order(restmode=None)
    order(pending=0)
    order(tfprms=202)
    order(iscancel=1)
    order(origin=6)
    order(apprv=0)
    got = L.pending_order_lines(erp.tables(spark), CFG, 2025)
    assert rows(got, "doc_no", "discount") == [("D1", 0.13)]


def test_export_report_blanks_without_retail_item(spark, erp):
    erp.item(1, "1", relitem=2)
    erp.item(2, "2")
    erp.add("products", productid=2, pricetosell=19.9)
    erp.add("item_month", mtrl=2, company=1000, fiscprd=2025, period=6, salqty=4.0)
    erp.sale(1, 100.0, fprms=7201, price=50.0)
    erp.sale(2, 100.0, fprms=7203, price=50.0)
    erp.purchase(1, 1.0)
    got = export_report(erp.tables(spark), CFG, 2025, AS_OF)
    assert len(got.columns) == 33
    columns = ("item_code", "retail_code", "net_retail", "month_1", "month_0", "suppliers")
    assert rows(got, *columns) == [
        ("1", "2", "19.9", "0", "4", "Supplier A"),
        ("2", "", "", "", "", None),
    ]


def test_retail_shares(spark, erp):
    erp.category(3, None)
    erp.item(1, "1")
    erp.item(2, "2", mtrcategory=2)
    erp.item(3, "3", mtrcategory=3)
    for mtrl, qty, trdr, fprms in (
        (1, 1.0, 1, 2061),
        (1, 2.0, 2, 2061),
        (1, 0.5, 2, 2061),
        (1, 9.0, 2, ORDER),
        (2, 9.0, 1, 2061),
        (3, 9.0, 1, 2061),
    ):
        erp.purchase(mtrl, qty, trdr=trdr, fprms=fprms)
    got = retail_category_share(erp.tables(spark), CFG, 2025)
    assert [tuple(map(str, r)) for r in rows(got, "supplier", "quarter", "share_pct")] == [
        ("Supplier A", "2", "33.33"),
        ("Supplier B", "2", "66.67"),
    ]
