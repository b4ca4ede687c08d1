"""Item movements: purchases to come, units sold and transfers, from one pass over the lines.

The lines table is the largest input and does not tell what kind of document a
line belongs to, so every separate pass would shuffle all of it. One pass sums
per item, document type, supplier and place; names are looked up on the sums.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stocklens.config import ReportConfig, Site
from stocklens.functions.dates import in_last_days
from stocklens.functions.numbers import or_zero, sum_where
from stocklens.functions.text import in_folded, in_texts, text_key
from stocklens.operators.lines import (
    document_lines,
    home_price,
    is_open_transfer,
    is_purchase,
    is_sale,
    open_quantity,
    warehouse_names,
    with_doc_type,
    with_partner,
)
from stocklens.sources.tables import Tables, left_lookup


def item_movements(
    t: Tables,
    cfg: ReportConfig,
    as_of: date,
    *,
    purchases: bool = True,
    settled_purchases: bool = False,
    sales_days: Iterable[int] = (),
    sales_min_quantity: float | None = None,
    transfer_types: tuple[int, ...] = (),
) -> DataFrame:
    """Sums per item, document type, supplier and place.

    Purchases count by what is still to come (``open_quantity`` and its value),
    sales by the units of each window (``sold_<days>``), transfers by units.
    ``settled_purchases`` keeps purchases of which nothing is to come, too.
    """
    days = sorted(sales_days)
    kinds: list[Column] = []
    if purchases:
        kinds.append(is_purchase(cfg) & (F.col("fprms") != cfg.excluded_purchase_type))
    if days:
        recent = in_last_days(F.col("trndate"), as_of, days[-1])
        kinds.append(is_sale(cfg, cfg.sales_types) & recent)
    if transfer_types:
        kinds.append(is_open_transfer(cfg, transfer_types))

    lines = document_lines(
        t, cfg, reduce(lambda a, b: a | b, kinds), destination=bool(transfer_types)
    )
    bought = F.col("source") == cfg.purchase_source
    sold = F.col("source") == cfg.sales_source
    counts = F.lit(True) if settled_purchases else open_quantity() != 0
    quantity = or_zero(F.col("qty1"))
    enough = F.lit(True) if sales_min_quantity is None else quantity >= sales_min_quantity
    lines = lines.filter(F.when(bought, counts).when(sold, enough).otherwise(True))

    destination = F.col("destination_id") if transfer_types else F.lit(None).cast("int")
    windows = {
        f"sold_{n}": F.when(sold & in_last_days(F.col("doc_time"), as_of, n), quantity)
        for n in days
    }
    measured = lines.select(
        "item_id",
        "source",
        "doc_type_id",
        F.when(bought, F.col("partner_id")).alias("partner_id"),
        "warehouse_id",
        destination.alias("destination_id"),
        F.when(bought & (open_quantity() != 0), open_quantity()).alias("open_quantity"),
        or_zero(F.col("unit_price")).alias("price"),
        home_price().alias("home_price"),
        *[c.alias(name) for name, c in windows.items()],
        F.when(~bought & ~sold, quantity).alias("moved"),
    )
    return measured.groupBy(*measured.columns[:6]).agg(
        F.sum("open_quantity").alias("open_quantity"),
        F.expr("sum(open_quantity * price)").alias("open_value"),
        F.expr("sum(open_quantity * home_price)").alias("open_value_foreign"),
        *[F.sum(name).alias(name) for name in windows],
        F.sum("moved").alias("moved"),
    )


def named_movements(moves: DataFrame, t: Tables, cfg: ReportConfig) -> DataFrame:
    """Movements with what the report rules test: places, document type and supplier."""
    named = left_lookup(moves, warehouse_names(t, cfg, "warehouse_id", "warehouse"), "warehouse_id")
    named = left_lookup(named, warehouse_names(t, cfg, "destination_id", "destination"), "destination_id")
    named = with_partner(with_doc_type(named, t), t)
    place, goal, partner = (text_key(F.col(c)) for c in ("warehouse", "destination", "partner"))
    sites = (cfg.own, cfg.tql, cfg.dream_cargo, cfg.dsv, cfg.hub)
    foreign = F.col("currency") != cfg.home_currency
    return named.select(
        "item_id",
        "doc_type_id",
        "partner",
        "open_quantity",
        F.when(foreign, F.col("open_value_foreign"))
        .otherwise(F.col("open_value"))
        .alias("open_value"),
        *[c for c in moves.columns if c.startswith("sold_")],
        "moved",
        place.isNotNull().alias("at_known_place"),
        *[in_folded(place, s.warehouses).alias(f"at_{s.name}") for s in sites],
        *[in_folded(goal, s.warehouses).alias(f"to_{s.name}") for s in (cfg.own, cfg.hub)],
        in_texts(F.col("doc_type"), cfg.arrival_type_names).alias("arriving"),
        *[
            in_folded(partner, s.logistics_suppliers).alias(f"via_{s.name}")
            for s in sites
            if s.logistics_suppliers
        ],
        F.col("doc_type_id").isin(*cfg.export_types).alias("exported"),
    )


# ---- measures over named movements ------------------------------------------------------------


def arrival_sums(sites: Iterable[Site]) -> list[Column]:
    """Per site: units on order or in transit to it, and their value."""
    return [
        sum_where(f"arriving AND at_{s.name}", value).alias(f"{s.name}_{name}")
        for s in sites
        for name, value in (("arrivals", "open_quantity"), ("arrivals_value", "open_value"))
    ]


def virtual_sum(cfg: ReportConfig, via: Iterable[Site]) -> Column:
    """Units to arrive at own stores from the logistics companies of sites.

    They already lie at those sites.
    """
    companies = " OR ".join(f"via_{s.name}" for s in via)
    condition = f"arriving AND at_{cfg.own.name} AND ({companies})"
    return sum_where(condition, "open_quantity").alias("virtual_arrivals")


def sold_sum(days: int, name: str, condition: str = "TRUE") -> Column:
    """Units sold in a window, from known warehouses."""
    return sum_where(f"at_known_place AND {condition}", f"sold_{days}").alias(name)


def channel_sums(cfg: ReportConfig, days: int) -> list[Column]:
    """Hub sales; sales without export types; the same without the hub."""
    hub = f"at_{cfg.hub.name}"
    return [
        sold_sum(days, "hub_sales", hub),
        sold_sum(days, "store_sales", "NOT exported"),
        sold_sum(days, "non_hub_sales", f"NOT exported AND NOT {hub}"),
    ]


def transfer_sums(cfg: ReportConfig, site: Site) -> list[Column]:
    """Units on the way: all, from a site to own stores, and from anywhere to the hub."""
    return [
        F.sum("moved").alias("transfers"),
        sum_where(f"at_{site.name} AND to_{cfg.own.name}", "moved").alias("to_store_transfers"),
        sum_where(f"to_{cfg.hub.name}", "moved").alias("to_hub_transfers"),
    ]


# ---- sums per item code -----------------------------------------------------------------------

SALES_COLUMNS = ("sold_", "hub_sales", "store_sales", "non_hub_sales")


def by_item_code(named: DataFrame, t: Tables, sums: list[Column]) -> DataFrame:
    """The sums per item code, under the comparison of :func:`text_key`.

    Sums per item id first: the item join then meets one row per item, however
    many lines an item has. Sales count only for items of a known maker.
    """
    per_item = named.groupBy("item_id").agg(*sums)
    makers = t.makers.select("mtrmanfctr").distinct().withColumn("known_maker", F.lit(True))
    items = t.items.select("mtrl", "code", "mtrmanfctr").join(makers, "mtrmanfctr", "left")
    items = items.select(
        F.col("mtrl").alias("item_id"), text_key(F.col("code")).alias("key"), "known_maker"
    )
    joined = per_item.join(items, "item_id", "inner").filter(F.col("key").isNotNull())
    measures = [c for c in per_item.columns if c != "item_id"]
    return joined.groupBy("key").agg(
        *[
            (sum_where("known_maker", c) if c.startswith(SALES_COLUMNS) else F.sum(c)).alias(c)
            for c in measures
        ]
    )


def weighted_price(site: Site) -> Column:
    """Mean home price of a site's arrivals, by quantity; NULL when they net to 0."""
    return F.try_divide(F.col(f"{site.name}_arrivals_value"), F.col(f"{site.name}_arrivals"))


# ---- stand-alone results ----------------------------------------------------------------------


def expected_arrivals(
    t: Tables, cfg: ReportConfig, as_of: date, sites: Iterable[Site]
) -> DataFrame:
    """Per item code and site: units to arrive and their weighted price."""
    sites = list(sites)
    named = named_movements(item_movements(t, cfg, as_of), t, cfg)
    sums = by_item_code(named, t, arrival_sums(sites))
    kept = reduce(lambda a, b: a | b, [F.col(f"{s.name}_arrivals").isNotNull() for s in sites])
    return sums.filter(kept).select(
        "key",
        *[
            c
            for s in sites
            for c in (
                F.col(f"{s.name}_arrivals"),
                weighted_price(s).alias(f"{s.name}_weighted_price"),
            )
        ],
    )


def virtual_arrivals(
    t: Tables, cfg: ReportConfig, as_of: date, via: Iterable[Site]
) -> DataFrame:
    """Per item code: units to arrive at own stores that already lie at the sites."""
    named = named_movements(item_movements(t, cfg, as_of), t, cfg)
    sums = by_item_code(named, t, [virtual_sum(cfg, via)])
    return sums.filter(F.col("virtual_arrivals").isNotNull())


def recent_sales(
    t: Tables,
    cfg: ReportConfig,
    as_of: date,
    days: Iterable[int],
    types: tuple[int, ...] | None = None,
) -> DataFrame:
    """Units sold per item code in each window of days, over all or some document types."""
    days = list(days)
    moves = item_movements(t, cfg, as_of, purchases=False, sales_days=days)
    named = named_movements(moves, t, cfg)
    chosen = ", ".join(map(str, types or ()))
    condition = "TRUE" if types is None else f"doc_type_id IN ({chosen})"
    sums = by_item_code(named, t, [sold_sum(n, f"sold_{n}", condition) for n in days])
    return sums.filter(F.col(f"sold_{max(days)}").isNotNull())


def sales_by_channel(
    t: Tables, cfg: ReportConfig, as_of: date, days: int, min_quantity: float | None = None
) -> DataFrame:
    moves = item_movements(
        t, cfg, as_of, purchases=False, sales_days=[days], sales_min_quantity=min_quantity
    )
    sums = by_item_code(named_movements(moves, t, cfg), t, channel_sums(cfg, days))
    some = [F.col(c).isNotNull() for c in ("hub_sales", "store_sales")]
    return sums.filter(some[0] | some[1])


def transfers_in(
    t: Tables, cfg: ReportConfig, as_of: date, site: Site, types: tuple[int, ...]
) -> DataFrame:
    """Units in open transfers per item code: all, site to own stores, any place to the hub."""
    moves = item_movements(t, cfg, as_of, purchases=False, transfer_types=types)
    return by_item_code(named_movements(moves, t, cfg), t, transfer_sums(cfg, site))
