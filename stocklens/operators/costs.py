"""Costs of items: FIFO, standard and blended."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stocklens.config import ReportConfig, Site
from stocklens.functions.dates import month_index, month_index_of
from stocklens.functions.numbers import add_up, or_zero, sum_where
from stocklens.sources.tables import of_company


def year_costs(costs: DataFrame, cfg: ReportConfig, year: int) -> DataFrame:
    """Per item: FIFO cost of the year and of the year before, standard cost of the year."""
    rows = of_company(costs, cfg.company).filter(
        (F.col("period") == cfg.year_cost_period) & F.col("fiscprd").isin(year, year - 1)
    )
    this, last = f"fiscprd = {year}", f"fiscprd = {year - 1}"
    return rows.groupBy(F.col("mtrl").alias("item_id")).agg(
        sum_where(this, "purfifo").alias("fifo_this_year"),
        sum_where(last, "purfifo").alias("fifo_last_year"),
        sum_where(this, "standcost").alias("standard_this_year"),
    )


def fifo_price(fall_back: bool | Column) -> Column:
    """FIFO cost of this year, or last year's where allowed and this year has none."""
    this, last = F.col("fifo_this_year"), F.col("fifo_last_year")
    allowed = fall_back if isinstance(fall_back, Column) else F.lit(fall_back)
    return F.coalesce(this, F.when(allowed, last))


def line_fifo_cost(costs: DataFrame, cfg: ReportConfig) -> DataFrame:
    """FIFO cost per item and year, to be joined on a line's item and year."""
    rows = of_company(costs, cfg.company).filter(F.col("period") == cfg.year_cost_period)
    return rows.groupBy(
        F.col("mtrl").alias("item_id"), F.col("fiscprd").alias("doc_year")
    ).agg(F.sum("purfifo").alias("fifo_cost"))


def arrival_price(sites: Iterable[Site], mode: str = "sum") -> Column:
    """Price of all arrivals of an item.

    ``sum`` adds the weighted prices of the sites, as the report does; ``pooled``
    weighs all sites together.
    """
    names = [s.name for s in sites]
    if mode == "sum":
        return add_up(f"try_divide({n}_arrivals_value, {n}_arrivals)" for n in names)
    if mode == "pooled":
        value = add_up(f"{n}_arrivals_value" for n in names)
        return or_zero(F.try_divide(value, add_up(f"{n}_arrivals" for n in names)))
    raise ValueError(f"unknown mode: {mode}")


def arrival_quantity(sites: Iterable[Site]) -> Column:
    return add_up(f"{s.name}_arrivals" for s in sites)


def standard_cost(sites: Iterable[Site], mode: str = "sum") -> Column:
    """Price of the arrivals, or the year's standard cost when there is none."""
    price = arrival_price(sites, mode)
    return F.when(price == 0, F.col("standard_this_year")).otherwise(price)


def blended_cost(
    stock: Column, fifo: Column, sites: Iterable[Site], mode: str = "sum"
) -> Column:
    """Mean cost of stock at FIFO and arrivals at their price; NULL when both are 0."""
    sites = list(sites)
    arriving = arrival_quantity(sites)
    total = or_zero(stock * fifo) + arriving * arrival_price(sites, mode)
    return F.try_divide(total, stock + arriving)


# ---- monthly sales ----------------------------------------------------------------------------

MONTHS_BACK = (3, 2, 1, 0)


def monthly_sales(balances: DataFrame, cfg: ReportConfig, as_of) -> DataFrame:
    """Per item: units sold in the month of ``as_of`` and in each of the three before.

    Months are compared by their running index, so January follows December and
    the rows of period 0 (opening) and 1000 (year) are left out.
    """
    now = month_index_of(as_of)
    index = month_index(F.col("fiscprd"), F.col("period"))
    rows = of_company(balances, cfg.company).filter(
        F.col("period").between(1, 12)
        & index.between(now - MONTHS_BACK[0], now)
        & F.col("fiscprd").between((now - MONTHS_BACK[0] - 1) // 12, as_of.year)
    )
    rows = rows.select(F.col("mtrl").alias("item_id"), (now - index).alias("back"), "salqty")
    return rows.groupBy("item_id").agg(
        *[sum_where(f"back = {k}", "salqty").alias(f"month_{k}") for k in MONTHS_BACK]
    )
