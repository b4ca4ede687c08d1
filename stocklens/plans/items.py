"""Items with their category, maker and related item: the rows the item reports start from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stocklens.config import ReportConfig
from stocklens.functions.text import text_key
from stocklens.sources.tables import Tables, active


def category_dimension(t: Tables, cfg: ReportConfig, *, item_kind: bool = True) -> DataFrame:
    """Active categories of the company, with a flag for those of the item kind."""
    c = t.categories
    kept = c.filter(active(c, cfg.company))
    of_kind = F.col("sodtype") == cfg.item_kind
    if item_kind:
        kept = kept.filter(of_kind)
    return kept.select(
        F.col("mtrcategory").alias("category_id"),
        F.col("name").alias("category"),
        of_kind.alias("category_of_kind"),
    )


def report_items(t: Tables, cfg: ReportConfig, categories: DataFrame) -> DataFrame:
    """Items of the company in the given categories, with maker and related item."""
    makers = t.makers.filter(active(t.makers, cfg.company)).select(
        F.col("mtrmanfctr").alias("maker_id"), F.col("name").alias("maker")
    )
    items = t.items.filter(
        (F.col("company") == cfg.company) & (F.col("sodtype") == cfg.item_kind)
    ).select(
        F.col("mtrl").alias("item_id"),
        "code",
        F.col("name").alias("description"),
        F.col("mtrcategory").alias("category_id"),
        F.col("mtrmanfctr").alias("maker_id"),
        F.col("relitem").alias("related_id"),
        F.col("pricer").alias("net_price"),
        F.col("cccpartnoexp").alias("part_no"),
        F.col("cccbarcodetp").alias("specs"),
    )
    found = items.join(categories, "category_id", "inner").join(makers, "maker_id", "left")
    return with_related(found, t)


def with_related(items: DataFrame, t: Tables) -> DataFrame:
    """Add the related item's code and net price, NULL when there is none."""
    related = t.items.select(
        F.col("mtrl").alias("related_id"),
        F.col("code").alias("related_code"),
        F.col("pricer").alias("related_net_price"),
    )
    return items.join(related, "related_id", "left")


def own_key() -> Column:
    return text_key(F.col("code"))


def related_key() -> Column:
    return text_key(F.col("related_code"))


def with_item_year(items: DataFrame, t: Tables, cfg: ReportConfig) -> DataFrame:
    """Flag items that have data in the configured fiscal year."""
    rows = t.item_year.filter(
        (F.col("company") == cfg.company) & (F.col("fiscprd") == cfg.item_year)
    )
    rows = rows.select(F.col("mtrl").alias("item_id"), F.col("fiscprd").alias("item_year"))
    return items.join(rows, "item_id", "left")
