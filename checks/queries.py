"""One Spark query per operator or report, over the sample tables of a directory."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stocklens.functions.dates import entry_clock
from stocklens.functions.numbers import number_text, or_zero, to_decimal
from stocklens.functions.text import matches_any, normalise_key, same_text, same_text_collated, split_list
from stocklens.operators import lines as L
from stocklens.operators import movements as M
from stocklens.operators import snapshots as N
from stocklens.operators.costs import line_fifo_cost, monthly_sales, year_costs
from stocklens.operators.stock import (
    INCOMING_KEY,
    PRODUCT,
    SUPPLIER_KEY,
    facts_for_items,
    stock_facts,
    stock_position,
)
from stocklens.operators.suppliers import (
    item_suppliers,
    list_width,
    supplier_columns,
    supplier_list,
    supplier_pages,
    supplier_places,
    supplier_spread,
    supplier_wide,
    with_list_size,
)
from stocklens.plans import deals as D
from stocklens.plans.export import export_report, export_vs_retail_stock, items_with_related
from stocklens.plans.items import (
    category_dimension,
    own_key,
    related_key,
    report_items,
    with_item_year,
)
from stocklens.plans.labels import (
    DEAL_LABELS,
    EXPORT_LABELS,
    RETAIL_LABELS,
    labelled,
    transfer_labels,
)
from stocklens.plans.retail import ordered_retail_report, retail_category_share
from stocklens.plans.transfers import (
    items_seen_at,
    ordered_transfer_report,
    site_candidates,
    transfer_suggestions,
    with_suggestions,
)
from stocklens.sources.sample import (
    AS_OF,
    SAMPLE_CONFIG,
    YEAR,
    previous_export,
    read,
    sample_tables,
)
from stocklens.sources.sinks import (
    read_versioned,
    scratch_dir,
    write_counted,
    write_full,
    write_versioned,
    write_year,
)
from stocklens.sources.tables import Tables, of_company, stage

CFG = SAMPLE_CONFIG
PAGE = 50  # names in one cell of a paged supplier list
Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def over_tables(f=None, *, name: str | None = None):
    """Register a query that only needs the report tables."""
    if f is None:
        return partial(over_tables, name=name)
    QUERIES[name or f.__name__] = lambda spark, directory: f(sample_tables(spark, directory))
    return f


def over_directory(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def money(df: DataFrame, *columns: str, digits: int = 4) -> DataFrame:
    """Round sums and quotients, whose last bits depend on the order of summing."""
    return df.withColumns({c: to_decimal(F.col(c), 18, digits).cast("double") for c in columns})


# ---- sources and sinks ------------------------------------------------------------------------


@over_tables
def scan_documents(t):
    d = of_company(t.documents, CFG.company).filter(F.col("sosource") == CFG.purchase_source)
    return d.select(
        "findoc", "sosource", "fprms", "period", F.to_date("trndate").alias("trndate"), "sumamnt"
    )


@over_tables
def scan_stock(t):
    own = t.stock.filter(F.col("supplierid").isin(*CFG.own.stock_sources))
    return own.groupBy("productid", "supplierproductid", "supplierid").agg(
        F.sum("unitsinstock").alias("units_in_stock"),
        F.sum("customerorderunits").alias("customer_order_units"),
        F.sum("supplierorderunits").alias("supplier_order_units"),
    )


@over_tables
def staged_purchases(t):
    staged = stage(L.purchase_lines(t, CFG).select("doc_type", "item_code", "quantity", "open_quantity"))
    by_type = staged.groupBy("doc_type").agg(
        F.count("*").alias("lines"),
        F.sum("quantity").alias("quantity"),
        F.sum("open_quantity").alias("open_quantity"),
    )
    items = (
        staged.filter(F.col("item_code").isNotNull())
        .select("doc_type", "item_code")
        .distinct()
        .groupBy("doc_type")
        .agg(F.count("*").alias("items"))
    )
    return by_type.join(items, "doc_type", "left")


@over_directory
def sink_full_refresh(spark, directory):
    t, path = sample_tables(spark, directory), scratch_dir(spark)
    for year in (YEAR - 1, YEAR):
        write_full(retail(t, year), path)
    return spark.read.parquet(path)


@over_directory
def sink_versioned_refresh(spark, directory):
    t, path = sample_tables(spark, directory), scratch_dir(spark)
    for year in (YEAR - 1, YEAR):
        write_versioned(retail(t, year), path)
    return read_versioned(spark, path)


@over_directory
def sink_year_slice(spark, directory):
    t, path = sample_tables(spark, directory), scratch_dir(spark)
    for year in (YEAR - 1, YEAR, YEAR):
        write_year(retail(t, year).withColumn("report_year", F.lit(year)), path)
    return spark.read.parquet(path)


@over_tables
def report_row_counts(t):
    reports = {
        "retail": retail_category_share(t, CFG, YEAR),
        "export": export_report(t, CFG, YEAR, AS_OF),
        "transfers": transfer_suggestions(t, CFG, CFG.dsv, AS_OF),
        "deals": D.deal_report(t, CFG, AS_OF),
    }
    counts = [
        df.agg(F.count(F.lit(1)).alias("report_rows")).select(
            F.lit(name).alias("report"), "report_rows"
        )
        for name, df in reports.items()
    ]
    return reduce(DataFrame.unionByName, counts)


@over_directory
def written_report_counts(spark, directory):
    t, folder = sample_tables(spark, directory), scratch_dir(spark)
    reports = {
        "retail": retail_category_share(t, CFG, YEAR),
        "export": export_report(t, CFG, YEAR, AS_OF),
        "transfers": transfer_suggestions(t, CFG, CFG.dsv, AS_OF),
        "deals": D.deal_report(t, CFG, AS_OF),
    }
    counts = [(name, write_counted(df, f"{folder}/{name}")) for name, df in reports.items()]
    return spark.createDataFrame(counts, "report string, report_rows long")


# ---- lines ------------------------------------------------------------------------------------


@over_tables
def document_lines(t):
    bought = L.document_lines(t, CFG, L.is_purchase(CFG), keep_empty=True)
    named = L.with_partner(L.with_item(bought, t), t)
    return named.select(
        "doc_id", "item_id", "qty1", "item_code", "partner", "currency", "line_value"
    )


@over_tables
def purchase_lines(t):
    return L.purchase_lines(t, CFG).drop("item_id", "series_no", "weight")


@over_tables
def sales_lines(t):
    return L.sales_lines(t, CFG)


@over_tables
def sales_excluding_types(t):
    kept = L.sales_lines(t, CFG).filter(~F.col("doc_type_id").isin(*CFG.export_types))
    kept = kept.filter(F.col("warehouse") != "AFRICA")
    return kept.select("doc_no", "item_code", "quantity", "warehouse", "doc_type_id")


@over_tables
def transfer_lines(t):
    rows = L.transfer_lines(t, CFG, CFG.site_transfer_types)
    return rows.drop("item_id", "series_no", "period")


@over_tables
def open_quantity(t):
    rows = L.document_lines(t, CFG, L.is_purchase(CFG), warehouse=False)
    return rows.select(
        "doc_id", "item_id", "qty1", "rest_mode", L.open_quantity().alias("open_quantity")
    )


@over_tables
def unit_prices(t):
    rows = L.document_lines(t, CFG, L.is_sale(CFG, CFG.export_types), warehouse=False)
    return L.with_partner(rows, t).select(
        "doc_id",
        "item_id",
        "qty",
        "currency",
        L.euro_unit_price(CFG).alias("euro_price"),
        L.foreign_unit_price(CFG).alias("foreign_price"),
    )


@over_tables
def export_invoice_lines(t):
    return L.export_invoice_lines(t, CFG, YEAR).drop("related_id", "doc_year")


@over_tables
def pending_order_lines(t):
    return L.pending_order_lines(t, CFG, YEAR).drop("related_id", "doc_year")


@over_tables
def export_lines_union(t):
    return L.export_lines(t, CFG, YEAR).drop("related_id", "doc_year")


@over_directory
def entry_time(spark, directory):
    events = read(spark, directory, "events")
    return events.select("event_id", entry_clock(F.col("ts")).alias("entry_clock"))


# ---- lookups ----------------------------------------------------------------------------------


@over_tables
def dimension_lookup(t):
    items = L.with_maker(L.with_category(L.with_item(_item_ids(t), t), t), t)
    return items.select("item_id", "item_code", "category", "maker")


def _item_ids(t: Tables) -> DataFrame:
    return t.items.select(F.col("mtrl").alias("item_id"))


@over_tables
def category_like(t):
    items = L.with_category(L.with_item(_item_ids(t), t), t)
    kept = items.filter(
        matches_any(F.col("category"), CFG.export_category_patterns)
        | matches_any(F.col("category"), CFG.refurbished_patterns)
    )
    kept = kept.filter(~matches_any(F.col("description"), ("%old%",)))
    return kept.select("item_code", "description", "category")


@over_directory
def collated_key_join(spark, directory):
    """Names joined to their shouted forms with trailing blanks."""
    part = read(spark, directory, "part")
    names = part.select(F.col("p_name").alias("name")).distinct()
    shouted = part.select(
        F.concat(F.upper("p_name"), F.lit("  ")).alias("loud_name"),
        F.col("p_retailprice").alias("price"),
    )
    joined = names.join(shouted, same_text(names["name"], shouted["loud_name"]))
    grouped = joined.groupBy("name").agg(
        F.count("*").alias("items"), F.max("price").alias("top_price")
    )
    return grouped


@over_directory
def unicode_key_join(spark, directory):
    """Names joined to shouted forms with accents on their vowels, under a Unicode collation."""
    part = read(spark, directory, "part")
    names = part.select(F.col("p_name").alias("name")).distinct()
    shouted = part.select(
        F.concat(F.translate(F.upper("p_name"), "AEIOU", "ÁÉÍÓÚ"), F.lit("  ")).alias("loud_name"),
        F.col("p_retailprice").alias("price"),
    )
    joined = names.join(shouted, same_text_collated(names["name"], shouted["loud_name"]))
    return joined.groupBy("name").agg(F.count("*").alias("items"), F.max("price").alias("top_price"))


@over_tables
def related_item(t):
    found = items_with_related(t)
    return found.select("code", "related_code", "related_net_price")


@over_tables
def item_year_data(t):
    return with_item_year(_item_ids(t), t, CFG)


@over_tables
def stock_for_items(t):
    facts = stock_facts(t.stock, CFG, (PRODUCT,))
    wanted = {"own": (PRODUCT, own_key(), ["own_on_hand", "own_reserved", "hub_on_hand"])}
    items = items_with_related(t)
    found = facts_for_items(items, facts, wanted)
    return items.select("item_id", "code").join(found, "item_id", "left").select(
        "code",
        F.col("own_own_on_hand").alias("own_on_hand"),
        F.col("own_own_reserved").alias("own_reserved"),
        F.col("own_hub_on_hand").alias("hub_on_hand"),
    )


@over_tables
def prefixed_key_lookup(t):
    items = items_with_related(t)
    found = facts_for_items(
        items,
        stock_facts(t.stock, CFG, (INCOMING_KEY,)),
        {"coming": (INCOMING_KEY, own_key(), ["incoming"])},
    )
    return items.select("item_id", "code").join(found, "item_id", "left").select(
        "code", F.col("coming_incoming").alias("incoming")
    )


@over_tables
def related_item_position(t):
    items = items_with_related(t)
    found = facts_for_items(
        items,
        stock_facts(t.stock, CFG, (SUPPLIER_KEY, INCOMING_KEY)),
        {
            "source": (
                SUPPLIER_KEY,
                related_key(),
                ["own_on_hand", "hub_on_hand", "all_reserved"],
            ),
            "coming": (INCOMING_KEY, related_key(), ["incoming"]),
        },
    )
    stock = or_zero(F.col("source_own_on_hand")) + or_zero(F.col("source_hub_on_hand"))
    coming, reserved = or_zero(F.col("coming_incoming")), or_zero(F.col("source_all_reserved"))
    return items.select("item_id", "code", "related_code").join(found, "item_id", "left").select(
        "code",
        "related_code",
        stock.alias("related_stock"),
        coming.alias("related_arrivals"),
        reserved.alias("related_reserved"),
        (stock + coming - reserved).alias("related_net"),
    )


@over_tables
def items_seen_at_site(t):
    return items_seen_at(t, CFG, CFG.dsv)


# ---- stock and movements ----------------------------------------------------------------------


@over_tables(name="stock_position")
def stock_position_by_site(t):
    return stock_position(t.stock, CFG)


@over_tables
def expected_arrivals(t):
    rows = M.expected_arrivals(t, CFG, AS_OF, CFG.deals_sites)
    return money(rows, *[f"{s.name}_weighted_price" for s in CFG.deals_sites])


@over_tables
def virtual_arrivals(t):
    return M.virtual_arrivals(t, CFG, AS_OF, (CFG.dsv, CFG.tql))


@over_tables
def sales_last_30_90(t):
    return M.recent_sales(t, CFG, AS_OF, (30, 90))


@over_tables
def sales_by_channel(t):
    return M.sales_by_channel(t, CFG, AS_OF, 30, min_quantity=1.0)


@over_tables
def transfers_in(t):
    return M.transfers_in(t, CFG, AS_OF, CFG.dsv, CFG.site_transfer_types)


@over_tables
def monthly_sales_trend(t):
    return monthly_sales(t.item_month, CFG, AS_OF)


@over_tables
def fifo_price(t):
    costs = year_costs(t.item_costs, CFG, AS_OF.year)
    return costs.select(
        "item_id",
        "fifo_this_year",
        F.coalesce("fifo_this_year", "fifo_last_year").alias("fifo_with_fallback"),
        "standard_this_year",
    )


@over_tables(name="line_fifo_cost")
def line_fifo(t):
    lines = L.export_invoice_lines(t, CFG, YEAR)
    found = lines.join(line_fifo_cost(t.item_costs, CFG), ["item_id", "doc_year"], "left")
    return found.select(
        "doc_no",
        "item_code",
        "quantity",
        to_decimal(F.col("fifo_cost"), 10, 0).alias("fifo_cost"),
    )


# ---- suppliers --------------------------------------------------------------------------------


def _lists(t: Tables, per_list: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    pairs = item_suppliers(t, CFG, exclude=CFG.logistics_companies)
    return supplier_list(pairs, per_list)


@over_tables(name="supplier_list")
def suppliers_of_items(t):
    return _lists(t)


@over_tables
def supplier_list_width(t):
    return list_width(_lists(t, with_list_size), sizes="tokens")


@over_tables
def supplier_tokens(t):
    def piped(lists: DataFrame) -> DataFrame:
        listed = F.array_join(split_list(F.col("suppliers")), "|")
        return with_list_size(lists).withColumn("listed", listed)

    return _lists(t, piped).select("item_id", "tokens", "listed")


@over_tables(name="supplier_columns")
def spread_suppliers(t):
    return _lists(t, lambda lists: supplier_columns(lists, 5))


@over_tables(name="supplier_spread")
def every_supplier(t):
    return supplier_spread(item_suppliers(t, CFG, exclude=CFG.logistics_companies))


@over_tables
def supplier_places_by_range(t):
    return supplier_places(item_suppliers(t, CFG, exclude=CFG.logistics_companies))


@over_tables(name="supplier_wide")
def suppliers_across(t):
    return supplier_wide(item_suppliers(t, CFG, exclude=CFG.logistics_companies))


@over_tables(name="supplier_pages")
def paged_lists(t):
    return supplier_pages(item_suppliers(t, CFG, exclude=CFG.logistics_companies), page_size=PAGE)[0]


@over_tables(name="supplier_list_ids")
def items_with_list_ids(t):
    return supplier_pages(item_suppliers(t, CFG, exclude=CFG.logistics_companies), page_size=PAGE)[1]


# ---- transfer suggestions ---------------------------------------------------------------------


def _suggested(t: Tables) -> DataFrame:
    return with_suggestions(site_candidates(t, CFG, CFG.dsv, AS_OF), CFG, CFG.dsv)


@over_tables
def minimum_quantity(t):
    return _suggested(t).select("code", "available", "activity", "minimum_quantity")


@over_tables
def own_store_suggestion(t):
    return _suggested(t).select("code", "available", "store_suggestion")


@over_tables
def hub_suggestion(t):
    return _suggested(t).select("code", "available", "hub_wanted", "hub_suggestion")


@over_tables(name="transfer_suggestions")
def transfers_dsv(t):
    return transfer_suggestions(t, CFG, CFG.dsv, AS_OF)


@over_tables
def transfer_suggestions_tql(t):
    return ordered_transfer_report(t, CFG, CFG.tql, AS_OF)


@over_tables
def flag_positive(t):
    rows = transfer_suggestions(t, CFG, CFG.dsv, AS_OF)
    rows = rows.select("code", number_text(F.col("virtual_arrivals")).alias("virtual_arrivals"))
    return N.flag_positive(rows, "virtual_arrivals")


# ---- deals ------------------------------------------------------------------------------------


def _deals(t: Tables) -> tuple[DataFrame, DataFrame]:
    moves = stage(D.deal_movements(t, CFG, AS_OF))
    return moves, stage(D.deal_main(t, CFG, AS_OF, moves))


@over_tables
def stock_position_metrics(t):
    return _deals(t)[1].select(
        "code",
        "ready_stock",
        "reserved",
        "own_stock",
        "free_stock",
        "incoming",
        "actual_stock",
        "actual_b2b",
        "virtual_arrivals",
        "final_stock",
    )


@over_tables
def deal_candidates(t):
    main = _deals(t)[1].drop("item_id")
    return money(main, "standard_cost", "blended_cost")


@over_tables
def standard_cost(t):
    return money(_deals(t)[1].select("code", "category", "standard_cost"), "standard_cost")


@over_tables
def blended_cost(t):
    rows = _deals(t)[1].select("code", "category", "fifo_price", "blended_cost")
    return money(rows, "blended_cost")


@over_tables
def exclude_related_items(t):
    return D.deal_detail(_deals(t)[1], CFG).drop(
        "item_id", "last_price", "new_price", "status"
    )


@over_tables
def category_header_rows(t):
    main = _deals(t)[1]
    return D.category_header_rows(main, D.deal_detail(main, CFG), CFG)


@over_tables
def deal_report(t):
    rows = D.deal_report(t, CFG, AS_OF)
    return rows.drop("last_price", "new_price", "status")


@over_directory
def deal_export(spark, directory):
    t, prev = sample_tables(spark, directory), previous_export(spark, directory)
    return money(D.deal_export(t, CFG, AS_OF, prev), "last_price", digits=2)


@over_directory
def deal_export_second_run(spark, directory):
    """Export, write, enter prices, write, export again from what was written."""
    t, prev = sample_tables(spark, directory), previous_export(spark, directory)
    first, edited = scratch_dir(spark), scratch_dir(spark)
    N.write_snapshot(D.deal_export(t, CFG, AS_OF, prev, numbered=True), first, numbered=True)
    seen = spark.read.parquet(first)
    entered = F.when(F.col("incoming") % 2 == 0, F.col("free_stock") + 0.25)
    N.write_snapshot(seen.withColumn("new_price", entered), edited, numbered=True)
    again = D.deal_export(t, CFG, AS_OF, N.read_snapshot(spark, edited))
    rows = again.select("code", "category", "last_price", "new_price", "status")
    return money(rows, "last_price", digits=2)


@over_tables
def labelled_deal_report(t):
    return labelled(D.deal_report(t, CFG, AS_OF).drop("block", "rank", "is_detail"), DEAL_LABELS)


@over_tables
def labelled_transfer_report(t):
    report = ordered_transfer_report(t, CFG, CFG.dsv, AS_OF)
    return labelled(report, transfer_labels(CFG.dsv))


@over_tables
def labelled_export_report(t):
    return labelled(export_report(t, CFG, YEAR, AS_OF), EXPORT_LABELS)


# ---- export and retail ------------------------------------------------------------------------


@over_tables(name="export_vs_retail_stock")
def export_and_retail_stock(t):
    return export_vs_retail_stock(t, CFG)


@over_tables(name="export_report")
def export_invoices(t):
    return export_report(t, CFG, YEAR, AS_OF)


def retail(t: Tables, year: int = YEAR) -> DataFrame:
    return money(retail_category_share(t, CFG, year), "value", digits=2)


@over_tables(name="retail_category_share")
def retail_of_the_year(t):
    return retail(t)


@over_tables
def labelled_retail_report(t):
    report = money(ordered_retail_report(t, CFG, YEAR), "value", digits=2)
    return labelled(report, RETAIL_LABELS)


# ---- from one run to the next -----------------------------------------------------------------


def _current(t: Tables) -> DataFrame:
    """The item list of a new run, its codes written as a spreadsheet would."""
    items = report_items(t, CFG, category_dimension(t, CFG))
    code = F.when(F.col("item_id") % 4 == 0, F.concat(F.lit(" "), "code", F.lit(".0 ")))
    return items.select(F.coalesce(code, F.col("code")).alias("code"), "description")


@over_directory
def new_items(spark, directory):
    current = _current(sample_tables(spark, directory))
    return N.new_items(current, previous_export(spark, directory))


@over_directory
def carry_forward_overrides(spark, directory):
    current = _current(sample_tables(spark, directory))
    rows = N.carry_forward_overrides(current, previous_export(spark, directory))
    return money(rows, "last_price", digits=2)


def _spreadsheet_keys(spark: SparkSession, directory: str) -> DataFrame:
    key = F.col("p_partkey")
    text = (
        F.when(key % 6 == 0, F.concat(F.lit(" 00"), key, F.lit(" ")))
        .when(key % 6 == 1, F.concat(key, F.lit(".0")))
        .when(key % 6 == 2, F.concat(F.lit("AB-"), key))
        .when(key % 6 == 3, F.lit("nan"))
        .when(key % 6 == 4, F.lit("  "))
        .otherwise(key.cast("string"))
    )
    return read(spark, directory, "part").select("p_partkey", text.alias("raw"))


@over_directory
def normalised_keys(spark, directory):
    keys = _spreadsheet_keys(spark, directory)
    return keys.select("p_partkey", normalise_key(F.col("raw")).alias("normalised"))


@over_directory
def coerce_integers(spark, directory):
    keys = _spreadsheet_keys(spark, directory)
    return N.coerce_integers(keys.withColumn("raw", F.trim("raw")), ["raw"])
