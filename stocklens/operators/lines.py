"""Document lines: header joined to lines, and the kinds of lines the reports use."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stocklens.config import ReportConfig
from stocklens.functions.dates import entry_clock, in_year
from stocklens.functions.numbers import or_zero, to_decimal
from stocklens.sources.tables import Tables, active, dimension, lookup, of_company


# ---- header and lines -------------------------------------------------------------------------


def document_lines(
    t: Tables,
    cfg: ReportConfig,
    where: Column,
    *,
    warehouse: bool = True,
    destination: bool = False,
    keep_empty: bool = False,
    flags: Mapping[str, Column] | None = None,
    headers: Callable[[DataFrame], DataFrame] | None = None,
    line_values: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Lines of the documents that meet ``where``, with their header's columns.

    ``flags`` are further columns computed on the header. ``headers`` filters the headers
    or looks up names for them, once per document, before they meet their lines.
    ``line_values`` are computed from columns of the line alone, before lines are
    exchanged, so that only the values travel; a document without lines has them as of
    a line of NULLs.

    ``keep_empty`` also returns documents without lines. They come from an anti
    join on the distinct document ids instead of an outer join, so that the
    inner join stays free to split a document that holds a large part of all
    lines.
    """
    d = F.col
    docs = of_company(t.documents, cfg.company).filter(where)
    docs = docs.select(
        d("findoc").alias("doc_id"),
        d("sosource").alias("source"),
        d("trndate").alias("doc_time"),
        d("sotime").alias("entry_time"),
        d("fincode").alias("doc_no"),
        d("seriesnum").alias("series_no"),
        d("sumamnt").alias("doc_total"),
        d("fprms").alias("doc_type_id"),
        d("period").alias("period_id"),
        d("trdr").alias("doc_partner_id"),
        d("branch").alias("branch_id"),
        d("finstates").alias("state_id"),
        *[c.alias(name) for name, c in (flags or {}).items()],
    )
    if destination or (warehouse and not cfg.warehouse_on_line):
        side = t.document_stock.select(
            d("findoc").alias("side_id"),
            d("whouse").alias("doc_warehouse_id"),
            d("whousesec").alias("destination_id"),
        )
        docs = docs.join(side, d("doc_id") == d("side_id"), "left")
        # A computed key: headers are then exchanged once more before they meet the lines.
        # Only a join of two exchanges can be split at run time, and a document may be hot.
        docs = docs.withColumn("doc_id", F.coalesce("side_id", "doc_id")).drop("side_id")

    if headers:
        docs = headers(docs)

    columns = {
        "findoc": "doc_id",
        "company": "line_company",
        "mtrl": "item_id",
        "whouse": "line_warehouse_id",
        "pending": "pending_line",
        "restmode": "rest_mode",
        "qty": "qty",
        "qty1": "qty1",
        "qty1cov": "qty_covered",
        "qty1canc": "qty_cancelled",
        "price": "unit_price",
        "disc1prc": "discount",
        "lineval": "line_value",
        "ltrnlineval": "home_line_value",
    }
    if cfg.supplier_on_line:
        columns["supplier"] = "line_supplier_id"
    lines = t.lines.select(*[d(k).alias(v) for k, v in columns.items()])
    values = dict(line_values or {})

    found = docs.join(lines.withColumns(values) if values else lines, "doc_id", "inner")
    if keep_empty:
        without = docs.join(lines.select("doc_id").distinct(), "doc_id", "left_anti")
        if values:
            nulls = {f.name: F.lit(None).cast(f.dataType) for f in lines.schema if f.name != "doc_id"}
            without = without.withColumns(nulls).withColumns(values)
        found = found.unionByName(without, allowMissingColumns=True)

    partner = d("doc_partner_id")
    if cfg.supplier_on_line:
        is_purchase = d("source") == cfg.purchase_source
        partner = F.when(is_purchase, d("line_supplier_id")).otherwise(partner)
    found = found.withColumn("partner_id", partner)
    if warehouse:
        place = "line_warehouse_id" if cfg.warehouse_on_line else "doc_warehouse_id"
        found = found.withColumn("warehouse_id", d(place))
    return found


def is_purchase(cfg: ReportConfig) -> Column:
    return (F.col("sosource") == cfg.purchase_source) & (F.col("sodtype") == cfg.supplier_kind)


def is_sale(cfg: ReportConfig, types: tuple[int, ...]) -> Column:
    return (
        (F.col("sosource") == cfg.sales_source)
        & (F.col("soredir") == 0)
        & (F.col("sodtype") == cfg.customer_kind)
        & F.col("fprms").isin(*types)
    )


def is_open_transfer(cfg: ReportConfig, types: tuple[int, ...]) -> Column:
    return (
        (F.col("sosource") == cfg.transfer_source)
        & F.col("fprms").isin(*types)
        & F.col("fullytransf").isin(*cfg.open_transfer_states)
    )


# ---- measures of one line ---------------------------------------------------------------------


def open_quantity() -> Column:
    """Units still to come: ordered less covered less cancelled, where a rest is kept.

    A NULL among the three leaves NULL; lines that keep no rest have 0.
    """
    rest = F.col("qty1") - F.col("qty_covered") - F.col("qty_cancelled")
    return F.when(F.col("rest_mode").isNotNull(), rest).otherwise(0.0)


def home_price() -> Column:
    """Unit price of a line priced in foreign currency, from its value in home currency."""
    qty = or_zero(F.col("qty"))
    quotient = F.col("home_line_value") / F.when(qty != 0, qty)
    return F.when(qty != 0, to_decimal(quotient, 10, 2).cast("double")).otherwise(0.0)


def euro_unit_price(cfg: ReportConfig) -> Column:
    """Unit price in home currency; needs the partner's ``currency``."""
    foreign = F.col("currency") != cfg.home_currency
    return F.when(foreign, home_price()).otherwise(or_zero(F.col("unit_price")))


def foreign_unit_price(cfg: ReportConfig) -> Column:
    """Unit price in the partner's currency, 0 for partners paid in home currency."""
    foreign = F.col("currency") != cfg.home_currency
    return F.when(foreign, or_zero(F.col("unit_price"))).otherwise(0.0)


# ---- lookups ----------------------------------------------------------------------------------

# Columns that tell rows apart and are shown anyway: rows with a NULL id are dealt over tasks by them
SALT_COLUMNS = ("doc_no", "item_code", "item_id", "quantity")


def _salt_by(df: DataFrame) -> list[str]:
    return [c for c in SALT_COLUMNS if c in df.columns]


def with_item(df: DataFrame, t: Tables) -> DataFrame:
    items = t.items.select(
        F.col("mtrl").alias("item_id"),
        F.col("code").alias("item_code"),
        F.col("name").alias("description"),
        F.col("mtrcategory").alias("category_id"),
        F.col("mtrmanfctr").alias("maker_id"),
        F.col("gweight").alias("weight"),
        F.col("cccpartnoexp").alias("part_no"),
        F.col("relitem").alias("related_id"),
    )
    return df.join(items, "item_id", "left")


def with_partner(df: DataFrame, t: Tables) -> DataFrame:
    partners = t.partners.select(
        F.col("trdr").alias("partner_id"),
        F.col("code").alias("partner_code"),
        F.col("name").alias("partner"),
        F.col("socurrency").alias("currency"),
        F.col("country").alias("country_id"),
    )
    return df.join(partners, "partner_id", "left")


def warehouse_names(t: Tables, cfg: ReportConfig, as_key: str, as_name: str) -> DataFrame:
    return dimension(of_company(t.warehouses, cfg.company), "whouse", "name", as_key, as_name)


def with_category(df: DataFrame, t: Tables) -> DataFrame:
    return lookup(df, t.categories, "mtrcategory", "name", "category_id", "category", _salt_by(df))


def with_maker(df: DataFrame, t: Tables) -> DataFrame:
    return lookup(df, t.makers, "mtrmanfctr", "name", "maker_id", "maker", _salt_by(df))


def with_warehouse(df: DataFrame, t: Tables, cfg: ReportConfig, how: str = "left") -> DataFrame:
    return df.join(warehouse_names(t, cfg, "warehouse_id", "warehouse"), "warehouse_id", how)


def with_branch(df: DataFrame, t: Tables, cfg: ReportConfig) -> DataFrame:
    dim = of_company(t.branches, cfg.company)
    return lookup(df, dim, "branch", "name", "branch_id", "branch", _salt_by(df))


def with_doc_type(df: DataFrame, t: Tables) -> DataFrame:
    return lookup(df, t.doc_types, "fprms", "name", "doc_type_id", "doc_type", _salt_by(df))


def with_country(df: DataFrame, t: Tables) -> DataFrame:
    return lookup(df, t.countries, "country", "name", "country_id", "country", _salt_by(df))


def with_period(df: DataFrame, t: Tables) -> DataFrame:
    return lookup(df, t.periods, "period", "name", "period_id", "period", _salt_by(df))


def with_state(df: DataFrame, t: Tables, cfg: ReportConfig) -> DataFrame:
    dim = t.states.filter(active(t.states, cfg.company))
    return lookup(df, dim, "finstates", "name", "state_id", "state", _salt_by(df))


# ---- kinds of lines ---------------------------------------------------------------------------


def purchase_lines(t: Tables, cfg: ReportConfig, *, exclude_type: bool = True) -> DataFrame:
    """Supplier document lines with supplier, item, prices and what is still to come.

    The excluded type is tested on the type's own table: a document of no or an
    unknown type is dropped with it. ``exclude_type=False`` keeps every type.
    """
    types = dimension(t.doc_types, "fprms", "name", "doc_type_id", "doc_type")
    if exclude_type:
        types = types.filter(F.col("doc_type_id") != cfg.excluded_purchase_type)

    def of_known_type(docs: DataFrame) -> DataFrame:
        return docs.join(types.select("doc_type_id"), "doc_type_id", "left_semi")

    values = {
        "quantity": or_zero(F.col("qty1")),
        "open_quantity": open_quantity(),
        "home_price": home_price(),
    }
    found = document_lines(
        t,
        cfg,
        is_purchase(cfg),
        keep_empty=True,
        headers=of_known_type if exclude_type else None,
        line_values=values,
    )
    # names of large dimensions first, on narrow rows, the widest last; then the small ones
    found = with_item(with_partner(with_warehouse(found, t, cfg), t), t)
    found = found.join(types, "doc_type_id", "inner" if exclude_type else "left")
    found = with_maker(with_category(with_period(found, t), t), t)
    foreign = F.col("currency") != cfg.home_currency
    return found.select(
        "period",
        F.to_date("doc_time").alias("doc_date"),
        "doc_type",
        "doc_no",
        "series_no",
        F.col("partner_code").alias("supplier_code"),
        F.col("partner").alias("supplier"),
        or_zero(F.col("doc_total")).alias("doc_total"),
        "item_code",
        "description",
        "item_id",
        "quantity",
        "open_quantity",
        or_zero(F.col("unit_price")).alias("price"),
        or_zero(F.col("weight")).alias("weight"),
        or_zero(F.col("line_value")).alias("line_value"),
        "category",
        "maker",
        "currency",
        F.when(foreign, F.col("home_price")).otherwise(or_zero(F.col("unit_price"))).alias("euro_price"),
        "warehouse",
    )


def sales_lines(t: Tables, cfg: ReportConfig) -> DataFrame:
    """Sales lines of known makers and warehouses."""
    def named(docs: DataFrame) -> DataFrame:
        """Customer and branch of the header: looked up once per document, not once per line."""
        docs = with_partner(docs.withColumn("partner_id", F.col("doc_partner_id")), t)
        return with_branch(docs.drop("partner_id"), t, cfg)

    found = document_lines(
        t,
        cfg,
        is_sale(cfg, cfg.sales_types),
        headers=named,
        line_values={"quantity": or_zero(F.col("qty1"))},
    )
    found = with_warehouse(found, t, cfg, "inner")
    found = with_item(found, t)
    makers = dimension(t.makers, "mtrmanfctr", "name", "maker_id", "maker")
    found = with_category(found.join(makers, "maker_id", "inner"), t)
    return found.select(
        F.to_date("doc_time").alias("doc_date"),
        entry_clock(F.col("entry_time")).alias("entry_clock"),
        "doc_no",
        "warehouse",
        "branch",
        F.col("partner_code").alias("customer_code"),
        F.col("partner").alias("customer"),
        or_zero(F.col("doc_total")).alias("doc_total"),
        "item_code",
        "description",
        "category",
        "maker",
        "quantity",
        "doc_type_id",
    )


def transfer_lines(t: Tables, cfg: ReportConfig, types: tuple[int, ...]) -> DataFrame:
    """Open internal transfers with the warehouse they leave and the one they go to."""
    found = document_lines(
        t, cfg, is_open_transfer(cfg, types), destination=True, keep_empty=True
    )
    found = with_warehouse(found, t, cfg)
    names = warehouse_names(t, cfg, "destination_id", "destination")
    found = found.join(names, "destination_id", "left")
    found = with_period(found, t)
    found = with_doc_type(with_item(found, t), t)
    return found.select(
        "period",
        F.to_date("doc_time").alias("doc_date"),
        "doc_type",
        "doc_no",
        "series_no",
        "item_code",
        "description",
        "item_id",
        or_zero(F.col("qty1")).alias("quantity"),
        open_quantity().alias("open_quantity"),
        "warehouse",
        "destination",
    )


# ---- lines of the export report ---------------------------------------------------------------

EXPORT_LINE_COLUMNS = (
    "doc_date",
    "entry_clock",
    "doc_no",
    "warehouse",
    "branch",
    "customer_code",
    "country",
    "customer",
    "doc_total",
    "item_code",
    "description",
    "part_no",
    "category",
    "maker",
    "quantity",
    "euro_price",
    "foreign_price",
    "discount",
    "line_value",
    "state",
    "item_id",
    "related_id",
    "doc_year",
)


def export_invoice_lines(t: Tables, cfg: ReportConfig, year: int) -> DataFrame:
    """Export invoice lines of a year above the value and quantity floors."""
    return _export_lines(t, cfg, year, {"invoice": _is_export_invoice(cfg)})


def pending_order_lines(t: Tables, cfg: ReportConfig, year: int) -> DataFrame:
    """Approved, uncancelled orders of a year not yet delivered, with the same columns."""
    return _export_lines(t, cfg, year, {"pending": _is_pending_order(cfg)})


def export_lines(t: Tables, cfg: ReportConfig, year: int) -> DataFrame:
    """Invoices and pending orders together; identical lines are listed once."""
    arms = {"invoice": _is_export_invoice(cfg), "pending": _is_pending_order(cfg)}
    return _export_lines(t, cfg, year, arms).distinct()


def _is_export_invoice(cfg: ReportConfig) -> Column:
    return is_sale(cfg, cfg.export_types)


def _is_pending_order(cfg: ReportConfig) -> Column:
    return (
        (F.col("fprms") == cfg.pending_type)
        & (F.col("tfprms") == cfg.pending_target_type)
        & (F.col("iscancel") == 0)
        & (F.col("origin") != cfg.pending_excluded_origin)
        & (F.col("apprv") == 1)
    )


def _export_lines(
    t: Tables, cfg: ReportConfig, year: int, arms: dict[str, Column]
) -> DataFrame:
    """Lines of one or both arms from one pass over headers and lines.

    A line that belongs to both arms comes out once for each.
    """
    where = in_year(F.col("trndate"), year) & reduce(lambda a, b: a | b, arms.values())
    lines = document_lines(t, cfg, where, flags=arms)
    lines = lines.filter(
        (or_zero(F.col("qty1")) >= cfg.line_quantity_floor)
        & (or_zero(F.col("line_value")) > cfg.line_value_floor)
    )
    belongs = {arm: F.col(arm) for arm in arms}
    if "pending" in arms:
        # the document's source must be the one of its partner's kind: 12 -> 1251, 13 -> 1351
        kinds = t.partner_extra.select(
            F.col("trdr").alias("doc_partner_id"), F.col("sodtype").alias("partner_kind")
        )
        lines = lines.join(kinds, "doc_partner_id", "left")
        belongs["pending"] &= (
            (F.col("source") == F.col("partner_kind") * 100 + 51)
            & (F.col("pending_line") == 1)
            & (F.col("line_company") == cfg.company)
            & F.col("rest_mode").isNotNull()
        )
    listed = F.array_compact(F.array(*[F.when(c, F.lit(a)) for a, c in belongs.items()]))
    lines = lines.withColumn("arm", F.explode(listed))
    rounded = to_decimal(or_zero(F.col("discount")), 10, 2).cast("double")
    discount = F.when(F.col("arm") == "pending", rounded).otherwise(or_zero(F.col("discount")))
    return _named_export_lines(lines, t, cfg, discount)


def _named_export_lines(
    lines: DataFrame, t: Tables, cfg: ReportConfig, discount: Column
) -> DataFrame:
    found = with_country(with_partner(with_item(lines, t), t), t)
    found = with_maker(with_category(found, t), t)
    found = with_state(with_branch(with_warehouse(found, t, cfg), t, cfg), t, cfg)
    computed = {
        "doc_date": F.to_date("doc_time"),
        "entry_clock": entry_clock(F.col("entry_time")),
        "customer_code": F.col("partner_code"),
        "customer": F.col("partner"),
        "doc_total": or_zero(F.col("doc_total")),
        "quantity": or_zero(F.col("qty1")),
        "euro_price": euro_unit_price(cfg),
        "foreign_price": foreign_unit_price(cfg),
        "discount": discount,
        "line_value": or_zero(F.col("line_value")),
        "doc_year": F.year("doc_time"),
    }
    return found.select(*[computed.get(c, F.col(c)).alias(c) for c in EXPORT_LINE_COLUMNS])
