"""Stock per product and site, and lookups of such facts for items and their related items."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stocklens.config import ReportConfig, Site
from stocklens.functions.numbers import add_up, sum_where
from stocklens.functions.text import text_key

MEASURES = {
    "customer_order_units": "customerorderunits",
    "supplier_order_units": "supplierorderunits",
}


def _at(site: Site) -> str:
    return f"supplierid IN ({', '.join(map(str, site.stock_sources))})"


def site_sums(cfg: ReportConfig) -> list[Column]:
    """Per site: units on hand and reserved; NULL where the site has no row.

    ``<site>_reserved`` reads the customer orders; ``<site>_deals_reserved`` the
    measure the deals report takes for that site.
    """
    sums = []
    for s in (cfg.own, cfg.tql, cfg.dsv, cfg.dream_cargo, cfg.hub):
        sums += [
            sum_where(_at(s), "unitsinstock").alias(f"{s.name}_on_hand"),
            sum_where(_at(s), "customerorderunits").alias(f"{s.name}_reserved"),
        ]
        if s.deals_reserved != "customer_order_units":
            measure = MEASURES[s.deals_reserved]
            sums.append(sum_where(_at(s), measure).alias(f"{s.name}_deals_reserved"))
    sums.append(sum_where(_at(cfg.incoming), "unitsinstock").alias("incoming"))
    sums.append(F.sum("customerorderunits").alias("all_reserved"))
    return sums


def deals_reserved(site: Site) -> str:
    """Column of the units reserved at a site, as the deals report counts them."""
    plain = site.deals_reserved == "customer_order_units"
    return f"{site.name}_{'reserved' if plain else 'deals_reserved'}"


def stock_position(stock: DataFrame, cfg: ReportConfig) -> DataFrame:
    """One row per product: every site and measure from one pass over the stock table."""
    return stock.groupBy("productid").agg(F.count("*").alias("stock_rows"), *site_sums(cfg))


# ---- facts by key -----------------------------------------------------------------------------
#
# Reports need the same facts twice, for an item and for its related item, under up to three
# keys. Facts therefore carry the kind of their key; items ask for (kind, key) pairs, one join
# answers them all, and one grouping brings the answers of an item back to one row. Neither the
# stock table nor the document lines are read twice.

PRODUCT, SUPPLIER_KEY, INCOMING_KEY, MOVES = "product", "supplier", "incoming", "moves"


def stock_facts(stock: DataFrame, cfg: ReportConfig, kinds: Iterable[str]) -> DataFrame:
    """Site sums by product id, by supplier's product id, and by the prefixed incoming key.

    The table is summed once per pair of ids; only those sums are spread over the keys.
    """
    pairs = stock.groupBy("productid", "supplierproductid").agg(*site_sums(cfg))
    source_key = text_key(F.col("supplierproductid"))
    start = len(cfg.incoming_key_prefix) + 1
    prefixed = source_key.startswith(text_key(F.lit(cfg.incoming_key_prefix)))
    keys = {
        PRODUCT: F.col("productid").cast("string"),
        SUPPLIER_KEY: source_key,
        INCOMING_KEY: F.when(
            prefixed & F.col("incoming").isNotNull(),
            source_key.substr(F.lit(start), F.length(source_key)),
        ),
    }
    measures = pairs.columns[2:]
    keyed = pairs.select(*measures, _spread({k: keys[k] for k in kinds}))
    keyed = keyed.filter(F.col("key").isNotNull())
    return keyed.groupBy("kind", "key").agg(*[F.sum(m).alias(m) for m in measures])


def _spread(keys: Mapping[str, Column]) -> Column:
    """One row per kind of key, with columns ``kind`` and ``key``."""
    return F.inline(
        F.array(*[F.struct(F.lit(k).alias("kind"), c.alias("key")) for k, c in keys.items()])
    )


def movement_facts(by_code: DataFrame) -> DataFrame:
    """Sums per item code in the form of facts."""
    return by_code.withColumn("kind", F.lit(MOVES))


def facts_for_items(
    items: DataFrame,
    facts: DataFrame,
    wanted: Mapping[str, tuple[str, Column, Iterable[str]]],
) -> DataFrame:
    """Per ``item_id``, the wanted measures, named ``<role>_<measure>``.

    ``wanted`` maps a role to the kind of its key, the key, and the measures it
    takes. A missing fact leaves NULL; ``<role>_found`` tells a missing row from
    an empty measure. Items with no key at all have no row: left join the result.
    """
    asks = F.array(
        *[
            F.struct(F.lit(role).alias("role"), F.lit(kind).alias("kind"), key.alias("key"))
            for role, (kind, key, _) in wanted.items()
        ]
    )
    asked = items.select("item_id", F.inline(asks)).filter(F.col("key").isNotNull())
    found = asked.join(facts.withColumn("found", F.lit(True)), ["kind", "key"], "left")
    answers = [
        F.expr(f"max({m}) FILTER (WHERE role = '{role}')").alias(f"{role}_{m}")
        for role, (_, _, measures) in wanted.items()
        for m in ("found", *measures)
    ]
    return found.groupBy("item_id").agg(*answers)


# ---- net positions ----------------------------------------------------------------------------


def net_across_sites(cfg: ReportConfig, role: str) -> Column:
    """Stock and incoming less reserved over five sites; NULL without an incoming row.

    A site without a row counts 0 once the product has any row.
    """
    sites = [s.name for s in (cfg.own, cfg.hub, cfg.dsv, cfg.tql, cfg.dream_cargo)]
    on_hand = add_up(f"{role}_{s}_on_hand" for s in sites)
    reserved = add_up(f"{role}_{s}_reserved" for s in sites)
    return F.when(F.col(f"{role}_found"), on_hand + F.col(f"{role}_incoming") - reserved)
