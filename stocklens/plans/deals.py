"""Special deals: which items can be offered, grouped under category headers."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stocklens.functions.dates import session_today
from stocklens.config import ReportConfig
from stocklens.functions.numbers import add_up, or_zero, to_decimal, to_whole
from stocklens.functions.text import in_texts, matches_any, text_key
from stocklens.operators.costs import (
    arrival_quantity,
    blended_cost,
    fifo_price,
    standard_cost,
    year_costs,
)
from stocklens.operators.movements import (
    arrival_sums,
    by_item_code,
    item_movements,
    named_movements,
    sold_sum,
    virtual_sum,
)
from stocklens.operators.snapshots import carry_forward_overrides, new_items
from stocklens.operators.stock import (
    INCOMING_KEY,
    MOVES,
    PRODUCT,
    SUPPLIER_KEY,
    deals_reserved,
    facts_for_items,
    movement_facts,
    stock_facts,
)
from stocklens.operators.suppliers import (
    in_order_with_suppliers,
    named_suppliers,
    with_list_key,
    with_list_part,
    with_lists,
    with_suppliers,
)
from stocklens.plans.items import category_dimension, own_key, related_key, report_items
from stocklens.sources.sinks import Scratch
from stocklens.sources.tables import Tables, new_folder, stage

SALES_DAYS = (90, 30)


# ---- items with their facts -------------------------------------------------------------------


def deal_movements(t: Tables, cfg: ReportConfig, as_of: date) -> DataFrame:
    """Movements behind the report. All purchases stay in, for the supplier list."""
    return item_movements(
        t,
        cfg,
        as_of,
        settled_purchases=True,
        sales_days=SALES_DAYS,
        transfer_types=cfg.deals_transfer_types,
    )


def deal_items(t: Tables, cfg: ReportConfig, as_of: date, moves: DataFrame) -> DataFrame:
    """Items of the export and the laptop categories with stock, movements and costs.

    One row per item and branch: branch 1 for export categories, 2 for laptops.
    """
    categories = category_dimension(t, cfg, item_kind=False)
    is_export = F.col("category_of_kind") & matches_any(
        F.col("category"), cfg.export_category_patterns
    )
    is_laptop = in_texts(F.col("category"), cfg.laptop_categories)
    branches = F.array_compact(F.array(F.when(is_export, 1), F.when(is_laptop, 2)))
    categories = categories.select("category_id", "category", F.explode(branches).alias("branch"))
    items = report_items(t, cfg, categories)

    sums = [
        *arrival_sums(cfg.deals_sites),
        virtual_sum(cfg, (cfg.dsv, cfg.tql)),
        sold_sum(90, "sold_90"),
        sold_sum(90, "sold_90_export", "exported"),
        sold_sum(30, "sold_30"),
        F.sum("moved").alias("transfers"),
    ]
    by_code = by_item_code(named_movements(moves, t, cfg), t, sums)
    stock = stock_facts(t.stock, cfg, (PRODUCT, SUPPLIER_KEY, INCOMING_KEY))
    facts = stock.unionByName(movement_facts(by_code), allowMissingColumns=True)

    sites = cfg.deals_sites
    on_hand = [f"{s.name}_on_hand" for s in sites]
    reserved = [deals_reserved(s) for s in sites]
    arrivals = [f"{s.name}_{m}" for s in sites for m in ("arrivals", "arrivals_value")]
    wanted = {
        "own": (PRODUCT, own_key(), [*on_hand, *reserved, "incoming"]),
        "here": (MOVES, own_key(), [*arrivals, "sold_90", "sold_90_export", "transfers"]),
        "related": (MOVES, related_key(), ["virtual_arrivals", "sold_30"]),
        "source": (SUPPLIER_KEY, related_key(), ["own_on_hand", "hub_on_hand", "all_reserved"]),
        "coming": (INCOMING_KEY, related_key(), ["incoming"]),
    }
    found = facts_for_items(items, facts, wanted)
    found = found.withColumnsRenamed({f"here_{a}": a for a in arrivals})
    return (
        items.join(found, "item_id", "left")
        .join(year_costs(t.item_costs, cfg, as_of.year), "item_id", "left")
    )


# ---- measures ---------------------------------------------------------------------------------


def ready_stock(cfg: ReportConfig) -> Column:
    return add_up(f"own_{s.name}_on_hand" for s in cfg.deals_sites)


def reserved_stock(cfg: ReportConfig) -> Column:
    return add_up(f"own_{deals_reserved(s)}" for s in cfg.deals_sites)


def incoming() -> Column:
    return or_zero(F.col("own_incoming"))


def virtual() -> Column:
    return or_zero(F.col("related_virtual_arrivals"))


def is_first_branch() -> Column:
    return F.col("branch") == 1


def is_refurbished(cfg: ReportConfig) -> Column:
    return matches_any(F.col("category"), cfg.refurbished_patterns)


def blended_stock(cfg: ReportConfig) -> Column:
    """Stock the blended cost weighs: own stock less virtual arrivals never below 0."""
    own = F.greatest(or_zero(F.col("own_own_on_hand")) - virtual(), F.lit(0.0))
    elsewhere = ready_stock(cfg) - or_zero(F.col("own_own_on_hand"))
    return F.when(is_first_branch(), own + elsewhere).otherwise(ready_stock(cfg))


def qualifies(cfg: ReportConfig) -> Column:
    """Branch 1: enough stock and arrivals. Branch 2: enough net stock or incoming, no Apple.

    Refurbished items have a floor of their own in both.
    """
    arriving = arrival_quantity(cfg.deals_sites)
    first = ready_stock(cfg) - virtual() + arriving
    refurbished = F.when(is_refurbished(cfg), F.lit(True)).otherwise(False)
    keep_first = (first > cfg.final_stock_floor) | (refurbished & (first > cfg.refurbished_floor))
    net = ready_stock(cfg) + incoming() - reserved_stock(cfg)
    keep_second = (
        (net > cfg.laptop_floor)
        | (incoming() > cfg.laptop_floor)
        | (refurbished & (ready_stock(cfg) + arriving > cfg.refurbished_floor))
    ) & ~in_texts(F.coalesce(F.col("maker"), F.lit("")), (cfg.deal_excluded_maker,))
    return F.when(is_first_branch(), keep_first).otherwise(keep_second)


def deal_main(
    t: Tables, cfg: ReportConfig, as_of: date, moves: DataFrame, cost_mode: str = "sum"
) -> DataFrame:
    """Items of both branches that qualify, one schema; identical rows once."""
    sites = cfg.deals_sites
    first = is_first_branch()
    ready, reserved = ready_stock(cfg), reserved_stock(cfg)
    fifo = fifo_price(~first)
    related_stock = or_zero(F.col("source_own_on_hand")) + or_zero(F.col("source_hub_on_hand"))
    related_coming = or_zero(F.col("coming_incoming"))
    related_reserved = or_zero(F.col("source_all_reserved"))
    blank = F.lit(None).cast("double")

    items = deal_items(t, cfg, as_of, moves).filter(qualifies(cfg))
    columns = {
        "item_id": F.col("item_id"),
        "code": F.col("code"),
        "category": F.coalesce(F.col("category"), F.lit("")),
        "maker": F.coalesce(F.col("maker"), F.lit("")),
        "description": F.col("description"),
        "ready_stock": ready,
        "reserved": reserved,
        "own_stock": or_zero(F.col("own_own_on_hand")) - F.when(first, virtual()).otherwise(0.0),
        "free_stock": ready - reserved,
        "incoming": incoming(),
        "actual_stock": F.when(first, blank).otherwise(incoming() + ready - reserved),
        "actual_b2b": F.when(
            first, ready + incoming() - (reserved + or_zero(F.col("here_transfers")))
        ),
        "virtual_arrivals": F.when(first, F.col("related_virtual_arrivals")),
        "final_stock": F.when(first, incoming() + (ready - virtual()) - reserved).otherwise(
            incoming()
        ),
        "sold_90": or_zero(
            F.when(first, F.col("here_sold_90")).otherwise(F.col("here_sold_90_export"))
        ),
        "sold_30": or_zero(F.col("related_sold_30")),
        "standard_cost": standard_cost(sites, cost_mode),
        "fifo_price": fifo,
        "net_retail": F.when(first, F.col("related_net_price")).otherwise(F.col("net_price")),
        "blended_cost": blended_cost(blended_stock(cfg), fifo, sites, cost_mode),
        "part_no": F.coalesce(F.col("part_no"), F.lit("")),
        "specs": F.coalesce(F.col("specs"), F.lit("")),
        "related_code": F.coalesce(F.col("related_code"), F.lit("")),
        "related_stock": related_stock,
        "related_arrivals": related_coming,
        "related_reserved": related_reserved,
        "related_net": related_stock + related_coming - related_reserved,
    }
    for s in sites:
        columns[f"{s.name}_arrivals"] = or_zero(F.col(f"{s.name}_arrivals"))
    return items.select(*[c.alias(name) for name, c in columns.items()]).distinct()


# ---- detail, headers, report ------------------------------------------------------------------

DETAIL_COLUMNS = (
    "code",
    "category",
    "maker",
    "description",
    "free_stock",
    "incoming",
    "actual_retail_only",
    "actual_b2b",
    "virtual_arrivals",
    "final_stock",
    "sold_90",
    "sold_30",
    "standard_cost",
    "fifo_price",
    "net_retail",
    "blended_cost",
    "part_no",
    "specs",
    "related_code",
    "related_stock",
    "related_arrivals",
    "related_reserved",
    "related_net",
    "last_price",
    "new_price",
    "status",
    "suppliers",
)


def exclude_related_items(main: DataFrame, cfg: ReportConfig) -> DataFrame:
    """Drop items that are the related item of an export-named product in the list."""
    named = main.filter(matches_any(F.col("description"), cfg.export_name_patterns))
    related = named.select(text_key(F.col("related_code")).alias("_key")).distinct()
    keyed = main.withColumn("_key", text_key(F.col("code")))
    return keyed.join(related, "_key", "left_anti").drop("_key")


def deal_detail(main: DataFrame, cfg: ReportConfig) -> DataFrame:
    """Rows to offer, with quantities as whole numbers and prices to two digits."""
    kept = exclude_related_items(main, cfg)
    kept = kept.filter((F.col("actual_b2b") > 0) | F.col("actual_b2b").isNull())
    whole = ("free_stock", "incoming", "actual_b2b") + (
        "related_stock",
        "related_arrivals",
        "related_reserved",
        "related_net",
    )
    money = ("standard_cost", "fifo_price", "net_retail", "blended_cost")
    computed = {
        **{c: to_whole(F.col(c)) for c in whole},
        **{c: to_decimal(F.col(c), 10, 2) for c in money},
        "actual_retail_only": to_whole(F.col("actual_stock")),
        "final_stock": to_whole(F.coalesce(F.col("actual_stock"), F.col("final_stock"))),
        "last_price": F.lit(None).cast("double"),
        "new_price": F.lit(None).cast("double"),
        "status": F.lit(None).cast("string"),
    }
    names = [c for c in DETAIL_COLUMNS if c != "suppliers"]
    return kept.select("item_id", *[computed.get(c, F.col(c)).alias(c) for c in names])


def with_supplier_lists(
    rows: DataFrame, t: Tables, cfg: ReportConfig, moves: DataFrame
) -> DataFrame:
    """Add the list of suppliers, '' where there is none."""
    listed = with_suppliers(rows, deal_pairs(t, cfg, moves))
    return listed.withColumn("suppliers", F.coalesce("suppliers", F.lit("")))


def deal_pairs(t: Tables, cfg: ReportConfig, moves: DataFrame) -> DataFrame:
    """Items and the suppliers they were bought from, without logistics companies."""
    bought = moves.filter(F.col("source") == cfg.purchase_source)
    return named_suppliers(bought, t, exclude=cfg.logistics_companies)


def header_label(cfg: ReportConfig, fix_header: bool = False) -> Column:
    """Category of a header row; refurbished categories share one label."""
    label = cfg.refurbished_header_fixed if fix_header else cfg.refurbished_header
    folded = matches_any(F.col("category"), cfg.refurbished_header_patterns)
    return F.when(folded, F.lit(label)).otherwise(F.col("category"))


def category_header_rows(
    main: DataFrame, detail: DataFrame, cfg: ReportConfig, fix_header: bool = False
) -> DataFrame:
    """One row per category that has details, or for the refurbished label."""
    labels = main.select("category").distinct()
    labels = labels.select(header_label(cfg, fix_header).alias("category"))
    headers = labels.groupBy(text_key(F.col("category")).alias("_key")).agg(
        F.min("category").alias("category")
    )
    with_detail = detail.select(text_key(F.col("category")).alias("_key")).distinct()
    with_detail = with_detail.withColumn("_has", F.lit(True))
    label = cfg.refurbished_header_fixed if fix_header else cfg.refurbished_header
    kept = headers.join(with_detail, "_key", "left").filter(
        F.col("_has").isNotNull() | in_texts(F.col("category"), (label,))
    )
    return kept.select("category")


def blocks(cfg: ReportConfig) -> Column:
    """Blocks a row is listed in: 1 priority categories, 2 others, 3 refurbished.

    A category that is both a priority and refurbished is listed in both blocks.
    """
    priority = in_texts(F.col("category"), cfg.priority_categories)
    refurbished = matches_any(F.col("category"), cfg.refurbished_block_patterns)
    first = F.when(priority, 1).when(~refurbished, 2)
    return F.array_compact(F.array(first, F.when(refurbished, 3)))


def priority_rank(cfg: ReportConfig) -> Column:
    """Place of a priority category in block 1; one place for all others."""
    rank = F.lit(0)
    for place, name in reversed(list(enumerate(cfg.priority_categories, 1))):
        rank = F.when(in_texts(F.col("category"), (name,)), place).otherwise(rank)
    return F.when(F.col("block") == 1, rank).otherwise(0)


def deal_rows(
    main: DataFrame, detail: DataFrame, cfg: ReportConfig, fix_header: bool = False
) -> DataFrame:
    """Headers and details with their sort keys ``block``, ``rank`` and ``is_detail``."""
    headers = category_header_rows(main, detail, cfg, fix_header)
    rows = headers.withColumn("is_detail", F.lit(0)).unionByName(
        detail.withColumn("is_detail", F.lit(1)), allowMissingColumns=True
    )
    rows = rows.withColumn("block", F.explode(blocks(cfg)))
    return rows.withColumn("rank", priority_rank(cfg))


def staged_deals(
    t: Tables,
    cfg: ReportConfig,
    as_of: date | None = None,
    cost_mode: str = "sum",
    scratch: Scratch | None = None,
) -> tuple[DataFrame, DataFrame, str]:
    """Movements and qualifying items, and the folder whose ``main`` holds the items.

    Both are staged: they are read more than once and are far smaller than the lines
    they come from. Given a ``Scratch``, they are staged in its folder and deleted with it.
    """
    spark = t.lines.sparkSession
    as_of = as_of or session_today(spark)
    moves = stage(deal_movements(t, cfg, as_of), scratch=scratch)
    folder = new_folder(spark, scratch)
    main = stage(deal_main(t, cfg, as_of, moves, cost_mode), path=f"{folder}/main")
    return moves, main, folder


def unordered_deal_report(
    t: Tables,
    cfg: ReportConfig,
    as_of: date | None = None,
    cost_mode: str = "sum",
    fix_header: bool = False,
    scratch: Scratch | None = None,
) -> DataFrame:
    """Rows of the report with their sort keys; without ``as_of``, as of today.

    Given a ``Scratch``, act on the report inside its block (:func:`staged_deals`).
    """
    moves, main, _ = staged_deals(t, cfg, as_of, cost_mode, scratch)
    listed = with_supplier_lists(deal_detail(main, cfg), t, cfg, moves)
    rows = deal_rows(main, listed, cfg, fix_header)
    return rows.select(*DETAIL_COLUMNS, "block", "rank", "is_detail")


def ordered_deal_report(
    t: Tables,
    cfg: ReportConfig,
    as_of: date | None = None,
    cost_mode: str = "sum",
    fix_header: bool = False,
    scratch: Scratch | None = None,
    change: Callable[[DataFrame], DataFrame] = lambda rows: rows,
    numbered: bool = False,
) -> DataFrame:
    """Rows of :func:`unordered_deal_report` in output order, their lists attached after the sort.

    ``change`` is applied to the rows before they are sorted, while they have no lists yet.
    The sorted rows are staged next to the qualifying items. ``numbered`` rows carry their
    place in the output order as ``row_no`` and stand by their list instead: a task, and the
    writer of its file, then hold a few lists and not those of all descriptions.
    """
    moves, main, folder = staged_deals(t, cfg, as_of, cost_mode, scratch)
    pairs = deal_pairs(t, cfg, moves)
    detail = (with_list_part if numbered else with_list_key)(deal_detail(main, cfg), pairs)
    rows = in_report_order(change(deal_rows(main, detail, cfg, fix_header)))
    ordered = f"{folder}/ordered"
    if numbered:
        placed = rows.withColumn("row_no", F.monotonically_increasing_id())
        listed = with_lists(stage(placed, path=ordered), pairs)
    else:
        listed = in_order_with_suppliers(rows, pairs, ordered)
    blank = F.when(F.col("is_detail") == 1, F.lit(""))
    listed = listed.withColumn("suppliers", F.coalesce("suppliers", blank))
    number = ["row_no"] if numbered else []
    return listed.select(*DETAIL_COLUMNS, "block", "rank", "is_detail", *number)


def in_report_order(rows: DataFrame) -> DataFrame:
    """Blocks, categories, header before details, most stock first."""
    return rows.orderBy(
        "block",
        "rank",
        text_key(F.col("category")),
        "is_detail",
        F.desc("final_stock"),
        text_key(F.col("description")),
        "code",
    )


def deal_report(
    t: Tables,
    cfg: ReportConfig,
    as_of: date | None = None,
    cost_mode: str = "sum",
    fix_header: bool = False,
    scratch: Scratch | None = None,
) -> DataFrame:
    """The report in its output order; ``scratch`` as in :func:`unordered_deal_report`."""
    return ordered_deal_report(t, cfg, as_of, cost_mode, fix_header, scratch)


def deal_export(
    t: Tables,
    cfg: ReportConfig,
    as_of: date | None,
    previous: DataFrame,
    numbered: bool = False,
    **options,
) -> DataFrame:
    """The report with what it takes from the previous export: NEW flags and last prices.

    Written with ``write_snapshot``, it is the previous export of the next run. ``numbered``
    (:func:`ordered_deal_report`) its rows have their ``row_no`` already, and no order.
    """

    def carried(rows: DataFrame) -> DataFrame:
        return carry_forward_overrides(new_items(rows, previous), previous)

    rows = ordered_deal_report(t, cfg, as_of, change=carried, numbered=numbered, **options)
    return rows.select(*DETAIL_COLUMNS, *(["row_no"] if numbered else []))
